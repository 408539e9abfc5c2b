"""Removal of passages that start in an earlier document, by level-wise doubling of windows.

Level one looks at windows of half the length.  Of the half windows inside each full window only
the one with the smallest hash is looked up, so every full window is represented, equal windows by
equal halves, and about two in ``window / 2`` half windows are shuffled.  Halves found in one
document alone die; full windows whose half survives are built at twice the length and compared.
Twice the asked length is not reached: coverage by longer windows adds no word.
"""

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once
from .blobs import chunk_bits, chunks, gather
from .words import WordHash, bounds, mix, sliding, window_hashes, words

#: Words that one step of a task holds as arrays; more wait for the next step.
STEP_WORDS = 300_000
#: Windows that a task gathers before it hands them to the shuffle.
FLUSH_WINDOWS = 1_500_000
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: A window's place: document, tag of the text, number of words before it.
ROW = {"d": np.int64, "t": np.uint32, "p": np.int32}


def _steps(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(rows, word hashes one after another, bounds) of some documents at a time; short ones too."""
    hashes, rows, parts, n = WordHash(), [], [], 0
    for pdf in batches:
        if pdf["text"].map(type).eq(bytes).any():
            pdf = pdf.assign(text=pdf["text"].map(_inflated))
        for row in pdf.itertuples(index=False):
            w = hashes.array(words(row.text))
            rows.append(row)
            parts.append(w)
            n += len(w)
            if n >= STEP_WORDS:
                yield rows, np.concatenate(parts), bounds([len(p) for p in parts])
                rows, parts, n = [], [], 0
    if rows:
        yield rows, np.concatenate(parts), bounds([len(p) for p in parts])


def _halves(h: np.ndarray, at: np.ndarray, window: int, half: int):
    """Hashes of half windows, the least of those in each full window, and which windows lie in one document."""
    n = len(h)
    left = np.repeat(at[1:], np.diff(at)) - np.arange(n)
    small = np.full(n, NONE)
    w = window_hashes(h, half)
    small[:len(w)] = w
    small[left < half] = NONE
    inside = left[:n - window + 1] >= window
    return small, sliding(small, window - half + 1)[:n - window + 1], inside


def _anchored(small, least, inside, width):
    """Places whose half window stands for at least one full window."""
    x = np.r_[np.zeros(width - 1, np.uint64), np.where(inside, least, np.uint64(0)), np.zeros(width - 1, np.uint64)]
    return np.flatnonzero(sliding(x, width, np.maximum) == small[:len(x) - width + 1])


def _level_one(window: int, half: int):
    def run(batches):
        for rows, h, at in _steps(batches):
            if len(h) < window:
                continue
            place = _anchored(*_halves(h, at, window, half), window - half + 1)
            small = window_hashes(h, half)
            place = place[place < len(small)]
            doc = np.searchsorted(at, place, "right") - 1
            out = pd.DataFrame({"d": doc, "half": small[place].view(np.int64)}).drop_duplicates()
            ids = np.array([r.doc_id for r in rows], np.int64)
            yield pd.DataFrame({"doc_id": ids[out["d"].to_numpy()], "half": out["half"].to_numpy()})
    return run


def _dominated(h, k, d):
    """Order by window, and whether a smaller document holds the same window."""
    order = np.lexsort((d, k, h))
    h, k, d = h[order], k[order], d[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (k[1:] != k[:-1])] if len(h) else np.zeros(0, bool)
    return order, d > d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else np.zeros(0, bool)


def text_tag(text: str) -> int:
    """Tells rows with one id apart."""
    return xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass"))


def _level_two(window: int, half: int, bits: int):
    names = ["chunk", "h", "k", "d", "t", "p", "known"]

    def flush(parts):
        h, k, d, t, p = (np.concatenate(x) for x in zip(*parts))
        order, later = _dominated(h, k, d)
        h, k, d, t, p = h[order], k[order], d[order], t[order], p[order]
        out = []
        for known in (True, False):
            take = later if known else ~later
            a, b, *own = h[take], k[take], d[take], t[take], p[take]
            for c, s in chunks(a, bits):
                keys = (b"", b"") if known else (a[s].tobytes(), b[s].tobytes())
                out.append((c, *keys, *(x[s].tobytes() for x in own), known))
        return pd.DataFrame(out, columns=names)

    def run(batches):
        parts, n = [], 0
        for rows, h, at in _steps(batches):
            if len(h) < window:
                continue
            alive = np.unique(np.concatenate([np.asarray(r.halves, np.int64) for r in rows])).view(np.uint64)
            small, least, inside = _halves(h, at, window, half)
            place = _anchored(small, least, inside, window - half + 1)
            place = place[np.isin(small[place], alive)]
            kept = np.full(len(small), NONE)
            kept[place] = small[place]
            start = np.flatnonzero(inside & (sliding(kept, window - half + 1)[:len(inside)] == least) & (least != NONE))
            if not len(start):
                continue
            doc = np.searchsorted(at, start, "right") - 1
            ids = np.array([r.doc_id for r in rows], np.int64)
            tags = np.array([text_tag(r.text) for r in rows], np.uint32)
            parts.append((window_hashes(h, window)[start], window_hashes(h, window, 1)[start].astype(np.uint32), ids[doc], tags[doc],
                          (start - at[doc]).astype(np.int32)))
            n += len(start)
            if n >= FLUSH_WINDOWS:
                yield flush(parts)
                parts, n = [], 0
        if parts:
            yield flush(parts)
    return run


def bucket_of(d: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each document, by a hash of its number, so that numbers with a stride spread, too."""
    return (mix(d.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _compare(buckets: int):
    """Windows that a smaller document holds, by bucket of documents; rows come in the order of chunks."""
    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        asked, known = pdf[~pdf["known"]], pdf[pdf["known"]]
        h, k = gather(asked["h"], np.uint64), gather(asked["k"], np.uint32)
        order, later = _dominated(h, k, gather(asked["d"], np.int64))
        hit = order[later]
        d, t, p = (np.r_[gather(asked[c], kind)[hit], gather(known[c], kind)] for c, kind in ROW.items())
        bucket = bucket_of(d, buckets)
        order = np.lexsort((p, t, d, bucket))
        d, t, p, bucket = d[order], t[order], p[order], bucket[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(d) else []
        out = [(int(bucket[a]), d[a:b].tobytes(), t[a:b].tobytes(), p[a:b].tobytes()) for a, b in zip(starts, [*starts[1:], len(d)])]
        return pd.DataFrame(out, columns=["bucket", *ROW])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n, last = [], 0, None
        for pdf in batches:
            for chunk, part in pdf.groupby("chunk"):
                if chunk != last and n >= FLUSH_WINDOWS:
                    yield settle(pd.concat(held))
                    held, n = [], 0
                held.append(part)
                n, last = n + sum(map(len, part["p"])) // 4, chunk
        if held:
            yield settle(pd.concat(held))
    return run


def _starts(pdf: pd.DataFrame) -> pd.DataFrame:
    """One row a document: where its repeated windows start."""
    d, t, p = (gather(pdf[c], kind) for c, kind in ROW.items())
    order = np.lexsort((p, t, d))
    d, t, p = d[order], t[order], p[order]
    starts = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (t[1:] != t[:-1])])
    out = [(int(d[a]), int(t[a]), p[a:b].tobytes()) for a, b in zip(starts, [*starts[1:], len(d)])]
    return pd.DataFrame(out, columns=["id", "tag", "starts"])


def _cut(text, starts, window: int) -> tuple[list[bytes], int]:
    """Words left when every window at ``starts`` is removed, and how many there were."""
    w = words(text)
    if starts is None or not len(w):
        return w, len(w)
    step, s = np.zeros(len(w) + 1, np.int64), np.frombuffer(starts, np.int32)
    s = s[s + window <= len(w)]
    np.add.at(step, s, 1)
    np.add.at(step, s + window, -1)
    return [w[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)], len(w)


def _deflated(text):
    """Column: the text as deflated bytes, about three fifths of what the shuffle's own compression leaves."""
    @F.pandas_udf("binary")
    def udf(col: pd.Series) -> pd.Series:
        return col.map(lambda t: None if t is None else zlib.compress(t.encode("utf-8", "surrogatepass"), 1))
    return udf(text)


def _inflated(raw: bytes | None) -> str | None:
    return None if raw is None else zlib.decompress(raw).decode("utf-8", "surrogatepass")


def repeated_windows(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tag, starts): places of the ``window``-word sequences that also start in a document with a smaller id.

    ``starts`` holds 32-bit integers; ``tag`` is a hash of the text, for rows that share an id.  Rows without an id neither lose windows nor take any away.
    Windows are told apart by 96 bits of hash over 64-bit word hashes.  A window that many
    documents hold is reduced to its smallest document inside each task before the shuffle, and all
    rows travel in blobs keyed by the window's hash, so no key gathers its documents in one place.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    spark, half = docs.sparkSession, (window + 1) // 2
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null")
    bits = chunk_bits(docs, text_col)
    anchors = write_once(own.mapInPandas(_level_one(window, half), "doc_id long, half long"), "anchors")
    repeated = anchors.groupBy("half").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b").select("half")
    alive = anchors.join(repeated, "half").groupBy("doc_id").agg(F.collect_set("half").alias("halves"))
    asked = own.select("doc_id", _deflated("text").alias("text")).join(alive, "doc_id").mapInPandas(
        _level_two(window, half, bits), "chunk long, h binary, k binary, d binary, t binary, p binary, known boolean")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    # a task answers for many chunks at once, and buckets are larger than chunks, so that blobs stay few
    later = asked.repartition(n, "chunk").sortWithinPartitions("chunk").mapInPandas(
        _compare(1 << max(bits - 4, 0)), "bucket long, d binary, t binary, p binary")
    return later.groupBy("bucket").applyInPandas(_starts, "id long, tag long, starts binary")


def without_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Every row of ``docs`` with ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text``.

    Each word covered by a window that also starts in a document with a smaller id is removed;
    windows are judged on the input.  ``kept_text`` joins the words left by one space; without
    ``with_text`` neither it nor the text is returned.  A missing or empty text has no words; texts
    shorter than a window stay whole; rows with the same id are one document for the comparison and
    stay rows of their own.  An empty table gives no rows.  Columns of ``docs`` keep their values
    unless they bear the name of a result.  Texts are shuffled twice, deflated.
    """
    # The result is read by one scan, so a lost task repeats that scan and not the comparison.
    spans = write_once(repeated_windows(docs, window, id_col, text_col), "spans")
    new = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    by_id = spans.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("tag", "starts"))).alias("__starts"))
    old = [c for c in docs.columns if c not in new and (with_text or c != text_col)]
    packed = docs.select(*[c for c in old if c != text_col], _deflated(F.col(text_col)).alias("__deflated"))
    joined = packed.join(by_id.withColumnRenamed("id", "__id"), F.col(id_col).cast("long") == F.col("__id"), "left")

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string" + ", kept_text string, own_text string" * with_text)
    def cut(deflated: pd.Series, starts: pd.Series) -> pd.DataFrame:
        out = []
        for z, s in zip(deflated, starts):
            t = _inflated(z)
            left, n = _cut(t, dict(s).get(text_tag(t)) if s and t else None, window)
            kept = b" ".join(left)
            out.append((n, n - len(left), hashlib.sha256(kept).hexdigest(), *([kept.decode("utf-8", "replace"), t] if with_text else [])))
        return pd.DataFrame(out, columns=new + ["own_text"] * with_text)

    return (joined.withColumn("__cut", cut("__deflated", "__starts"))
            .select(*[F.col("__cut.own_text").alias(c) if c == text_col else F.col(c) for c in old], *[F.col(f"__cut.{c}").alias(c) for c in new]))
