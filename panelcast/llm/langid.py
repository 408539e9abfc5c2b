"""Language by compression: the language whose dictionary makes a text smallest.

A language's model is a raw-content zstandard dictionary, pieces of sampled texts of that language.
Every text is encoded whole with every dictionary; matches into the right one make it smaller.
"""

import re
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import write_once

#: Texts a language's dictionary is made of at most, and bytes that each gives.
ROWS, PIECE = 128, 512
#: Bytes encoded at once: the dictionary counts anew for each part of a long text.
PART = 1 << 14
LEVEL = 5
#: Extra bytes that halve the weight of a language in the score.
HALVE = 4.0
#: A text is rejected if the second language is not larger by this share of the smallest size.
MARGIN = 0.02
#: Languages whose dictionaries a task holds at the same time.
SLICE = 256

WORD = re.compile(r"[^\W\d_]+")
FOUND = "lang string, n long, size long, second long, weight double"


def plain(text: str | None) -> bytes:
    """Words of letters in lower case, a word that repeats at once taken once."""
    found = WORD.findall((text or "").lower())
    if found and not "".join(found).isalpha():  # signs that count as letters of a word, such as fractions
        found = [w for w in ("".join(filter(str.isalpha, w)) for w in found) if w]
    return " ".join(w for w, _ in groupby(found)).encode("utf-8", "surrogatepass")


def piece(text: str | None, size: int = PIECE) -> bytes | None:
    """Whole words of about ``size`` bytes from the middle of a text; None without letters."""
    raw = plain(text)
    if len(raw) > size:
        cut = raw[(len(raw) - size) // 2:][:size]
        raw = b" ".join(cut.split(b" ")[1:-1]) or cut
    return raw or None


def encoder(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)


def encoded_size(raw: bytes, by: zstandard.ZstdCompressor) -> int:
    return sum(len(by.compress(raw[a:a + PART])) for a in range(0, len(raw), PART))


def sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", rows: int = ROWS, size: int = PIECE) -> DataFrame:
    """(lang, n, pieces): labelled rows of each language, and pieces of at most ``rows`` distinct texts.

    The texts are those with the smallest hashes, so copies count once and partitioning does not
    matter.  A first pass estimates the distinct texts of a language; the second keeps about four
    times the rows wanted, or all, by hash, so that only pieces of those are shuffled.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    counts = write_once(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("h").alias("distinct")), "languages")
    share = F.least(F.lit(1.0), 4.0 * rows / F.greatest("distinct", F.lit(1)))

    @F.pandas_udf("binary")
    def cut(col: pd.Series) -> pd.Series:
        return pd.Series([piece(t, size) for t in col])

    near = known.join(counts.withColumn("share", share), "lang").where(
        F.shiftrightunsigned("h", 1).cast("double") <= F.col("share") * float(2 ** 63)).select("lang", "h", cut("text").alias("piece"))
    # the condition on pieces stands behind the aggregation, else it would be tested on every row before the draw
    once = near.groupBy("lang", "h").agg(F.min("piece").alias("piece")).where("piece is not null")
    first = once.withColumn("at", F.row_number().over(W.partitionBy("lang").orderBy("h"))).where(F.col("at") <= rows)
    return first.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("h", "piece"))).alias("pieces")).join(counts, "lang").select(
        "lang", "n", F.col("pieces.piece").alias("pieces"))


def _measure(models: list[tuple[str, int, bytes]]):
    """Column function of a text: the best of these languages, its size, the next size, the sum of weights."""
    @F.pandas_udf(FOUND)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoders = [encoder(d) for _, _, d in models]
        for col in batches:
            out = []
            for text in col:
                raw = plain(text)
                if not raw:
                    out.append((None, None, None, None, None))
                    continue
                sizes = [encoded_size(raw, e) for e in encoders]
                best = min(range(len(sizes)), key=lambda i: (sizes[i], -models[i][1], models[i][0].encode()))
                rest = [s for i, s in enumerate(sizes) if i != best]
                weight = float(np.exp2((sizes[best] - np.array(sizes)) / HALVE).sum())
                out.append((models[best][0], models[best][1], sizes[best], min(rest) if rest else None, weight))
            yield pd.DataFrame(out, columns=["lang", "n", "size", "second", "weight"]).astype(
                {"n": "Int64", "size": "Int64", "second": "Int64"})
    return measure


def _merged(found: DataFrame) -> DataFrame:
    """One row for each ``row`` from those of several slices of languages."""
    order = F.sort_array(F.collect_list(F.struct("size", (-F.col("n")).alias("less"), F.encode("lang", "UTF-8").alias("name"), "second", "weight", "lang")))
    lists = found.where("size is not null").groupBy("row").agg(order.alias("o"))
    best = F.col("o")[0]
    others = F.array_min(F.concat(F.transform(F.slice("o", 2, F.size("o")), lambda x: x["size"]), F.col("o.second")))
    weight = F.aggregate("o", F.lit(0.0), lambda s, x: s + x["weight"] * F.pow(F.lit(2.0), (best["size"] - x["size"]) / F.lit(HALVE)))
    merged = lists.select("row", F.struct(best["lang"].alias("lang"), (-best["less"]).alias("n"), best["size"].alias("size"),
                                          others.alias("second"), weight.alias("weight")).alias("found"))
    return found.select("row").distinct().join(merged, "row", "left")


def classify(docs: DataFrame, learn_from: Column | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             rows: int = ROWS, size: int = PIECE, margin: float = MARGIN, languages_at_once: int = SLICE) -> DataFrame:
    """(doc_id, lang_pred, score, encoded_size, rejected) of every row.

    Dictionaries are fitted on at most ``rows`` distinct texts of each language, ``size`` bytes each,
    among the rows that meet ``learn_from`` and have a language.  Every text is encoded whole, in
    parts of 16 KiB, in lower case and as words of letters, a word that follows itself taken once.
    ``lang_pred`` is the language with the smallest sum, of equal ones that with more labelled rows,
    then the first by name.  ``rejected`` marks margins below ``margin`` of the smallest size.
    ``score`` is 2^(-bytes / 4) of the best language over the sum for all.  Missing texts and texts
    without a letter, and all texts if no language could be learnt, give ``und``, score 0, rejected.
    With more than ``languages_at_once`` languages the texts are read once for each slice of about so
    many, dealt by hash, so that a task never holds all dictionaries.  A language whose texts have no letter is not learnt.
    """
    learnt = write_once(sample(docs if learn_from is None else docs.where(learn_from), text_col, lang_col, rows, size), "dictionaries")
    n_slices = -(-learnt.count() // languages_at_once)

    def slices():
        for k in range(n_slices):
            part = learnt.where(F.pmod(F.xxhash64("lang"), F.lit(n_slices)) == k).collect()
            yield [(r.lang, r.n, b" ".join(bytes(p) for p in r.pieces)) for r in part]

    asked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if n_slices <= 1:
        models = next(slices(), [])
        empty = F.from_json(F.lit(None).cast("string"), FOUND)
        found = asked.select("doc_id", (_measure(models)("text") if models else empty).alias("found"))
    else:
        asked = write_once(asked.withColumn("row", F.monotonically_increasing_id()), "numbered")
        parts = [asked.select("row", _measure(models)("text").alias("f")).select("row", "f.*") for models in slices() if models]
        every = write_once(reduce(DataFrame.union, parts), "slices")
        found = asked.select("row", "doc_id").join(_merged(every), "row", "left").drop("row")
    size_, second = F.col("found.size"), F.col("found.second")
    return found.select(
        "doc_id", F.coalesce("found.lang", F.lit("und")).alias("lang_pred"), F.coalesce(1 / F.col("found.weight"), F.lit(0.0)).alias("score"),
        size_.alias("encoded_size"), F.coalesce((second - size_) < margin * size_, size_.isNull()).alias("rejected"))
