"""Document fingerprints from content-defined chunks.

A gear hash over the last 32 bytes decides, by content alone, where a text is cut; the mask is
stricter below the normal chunk size and looser above it (normalised chunking).  The fingerprint is
the set of chunk digests with their lengths; containment weighs shared chunks by length.
"""

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 2024) for b in range(256)] + [0], np.uint32)
REACH = 32
MIN, NORMAL, MAX = 16, 48, 192
EASE = 2
#: Characters of a text that one step hashes as an array.
STEP = 1 << 20


def gear(raw: bytes) -> np.ndarray:
    """Gear hash at each byte, by doubling the window: the sum of G[byte] << distance."""
    h = GEAR[np.frombuffer(raw, np.uint8)]
    step = 1
    while step < REACH:
        if len(h) > step:
            h = np.r_[h[:step], h[step:] + (h[:-step] << np.uint32(step))]
        step *= 2
    return h


def cut_places(raw: bytes) -> list[int]:
    """Ends of the chunks of a text."""
    if not raw:
        return []
    bits = int(np.log2(NORMAL))
    strict, loose = [], []
    for at in range(0, len(raw), STEP):
        lead = min(at, REACH - 1)
        h = gear(raw[at - lead:at + STEP])[lead:]
        maybe = np.flatnonzero(h >> np.uint32(32 - bits + EASE) == 0)
        strict += (maybe[h[maybe] >> np.uint32(32 - bits - EASE) == 0] + at + 1).tolist()
        loose += (maybe + at + 1).tolist()
    out, start, n = [], 0, len(raw)
    while n - start > MIN:
        normal, most = min(start + NORMAL, n), min(start + MAX, n)
        i = bisect.bisect_left(strict, start + MIN)
        if i < len(strict) and strict[i] < normal:
            end = strict[i]
        else:
            i = bisect.bisect_left(loose, normal)
            end = loose[i] if i < len(loose) and loose[i] < most else most
        out.append(end)
        start = end
    if start < n:
        out.append(n)
    return out


def chunk_set(raw: bytes) -> dict[int, int]:
    """digest -> length of the distinct chunks."""
    out, start = {}, 0
    for end in cut_places(raw):
        out[xxhash.xxh32_intdigest(raw[start:end])] = end - start
        start = end
    return out


def spell(chunks: dict[int, int]) -> str:
    """Fingerprint as text: ten hex digits a chunk, digest then length, in the order of digests."""
    return "".join(f"{d:08x}{n:02x}" for d, n in sorted(chunks.items()))


def read(fingerprint: str) -> dict[int, int]:
    return {int(fingerprint[i:i + 8], 16): int(fingerprint[i + 8:i + 10], 16) for i in range(0, len(fingerprint), 10)}


def containment(a: dict[int, int], b: dict[int, int]) -> float:
    """Share of ``a``'s chunks, by length, that ``b`` holds; two empty sets are alike, one is not."""
    if not a or not b:
        return float(not a and not b)
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def raw_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def fingerprint(text):
    """Column: fingerprint of a text; empty for a missing or empty one."""
    @F.pandas_udf("string")
    def udf(col: pd.Series) -> pd.Series:
        return col.map(lambda t: spell(chunk_set(raw_bytes(t))), na_action=None)
    return udf(text)


def edit(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the start of ``following``, or all of that."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a bucket come in descending order, the row after its last one marked as ``tail``."""
    held = None
    for pdf in batches:
        out = []
        for row in pdf.itertuples(index=False):
            own = None if row.tail and held is None else chunk_set(raw_bytes(row.text))
            if held is not None:
                before, chunks = held
                text = edit(before.text or "", row.text or "")
                raw = raw_bytes(text)
                edited = chunk_set(raw)
                out.append((before.doc_id, before.missing, len(before.text or ""), hashlib.sha256(raw).hexdigest(),
                            spell(chunks), spell(edited), containment(chunks, edited), containment(chunks, own)))
            held = None if row.tail else (row, own)
        yield pd.DataFrame(out, columns=["doc_id", "missing", *RESULT[1:]])


RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def with_following(docs: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """(bucket, tail, doc_id, text): documents in buckets of descending ids, and after each bucket the row that follows.

    The last row is followed by the first.  Missing ids come last; rows with one id are ordered by
    a hash of their text.  Only the largest id of each bucket passes through the driver.
    """
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-2**63)).alias("doc_id"), F.col(text_col).alias("text"),
                      F.col(id_col).isNull().alias("missing"))
    ids = own.select("doc_id")
    splits = np.array(sorted(set(ids.approxQuantile("doc_id", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)))
                             if buckets > 1 else []), np.int64)

    @F.pandas_udf("int")
    def bucket_of(k: pd.Series) -> pd.Series:
        return pd.Series(len(splits) - np.searchsorted(splits, k.to_numpy(), "left"))  # descending

    heads = sorted((r.bucket, r.head) for r in ids.groupBy(bucket_of("doc_id").alias("bucket")).agg(F.max("doc_id").alias("head")).collect())
    also = {head: heads[i - 1][0] for i, (_, head) in enumerate(heads)}

    @F.pandas_udf("array<struct<bucket: int, tail: boolean>>")
    def places(k: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([[{"bucket": x, "tail": False}, *([{"bucket": also[i], "tail": True}] if i in also else [])] for i, x in zip(k, b)])

    return own.withColumn("at", F.explode(places("doc_id", bucket_of("doc_id")))).select("at.bucket", "at.tail", "doc_id", "missing", "text")


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how much of the text's they hold.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many of
    the next document in descending order of ids, the first after the last.  ``near_edited`` and
    ``near_next`` are the length-weighted share of the text's chunks found in the edited text and
    in the next document.  Missing texts are empty; a single row follows itself; repeated rows stay
    rows of their own; an empty table gives no rows.  The text is shuffled once.
    """
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    placed = with_following(docs, id_col, text_col, 4 * n)
    ordered = (placed.repartition(n, "bucket").sortWithinPartitions("bucket", "tail", F.desc("doc_id"), F.xxhash64("text")))
    out = ordered.mapInPandas(_grouped, "doc_id long, missing boolean, n_chars long, edited_sha256 string, fingerprint string, "
                              "edited_fingerprint string, near_edited double, near_next double")
    return out.select(F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), *RESULT[1:])


def _grouped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    return _compare(batches)
