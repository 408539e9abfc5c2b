"""Near-duplicates by SimHash, found through an inverted index over byte positions.

Two 64-bit fingerprints that differ in at most four bits differ in at most four bytes, so at least
four of their eight bytes agree, each in its own place.  Any four places contain one of twenty
triples of places (the places fall into classes of three, three and two; a triple is taken if it
lies in one class, or has two places in a class and one in the next).  A posting list holds the
fingerprints that share the bytes of one such triple.  Within a list the shared positional bytes of
each pair are tallied; pairs that reach the guaranteed minimum are verified by their distance.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once
from .components import connected_components
from .words import words

BYTES = 8
#: Fingerprints of one posting list that one task compares; longer lists are cut into tiles.
TILE = 4096
CLASS = (0, 0, 0, 1, 1, 1, 2, 2)


def place_triples() -> list[tuple[int, int, int]]:
    """Twenty triples of byte places such that any four places contain at least one."""
    out = []
    for triple in combinations(range(BYTES), 3):
        count = [sum(CLASS[p] == c for p in triple) for c in range(3)]
        if 3 in count or any(count[c] == 2 and count[(c + 1) % 3] == 1 for c in range(3)):
            out.append(triple)
    return out


def simhash(text: str | None, shingle: int, seed: int) -> int:
    """Fingerprint as an unsigned integer; 0 without words."""
    w = words(text, lower=True)
    if not w:
        return 0
    n, counts = max(1, len(w) - shingle + 1), np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        h = np.array([xxhash.xxh64_intdigest(b" ".join(w[i:i + shingle]), seed) for i in range(at, min(n, at + (1 << 16)))], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprint(text, shingle: int = 4, seed: int = 42):
    """Column: SimHash of the word shingles, repeats included, as a signed long.

    A bit is set if it is set in over half of the shingles' XXH64.  Fewer words than a shingle make
    one shingle; a missing or empty text has fingerprint 0.
    """
    @F.pandas_udf("long")
    def udf(col: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, shingle, seed) for t in col], np.uint64).view(np.int64))
    return udf(text)


def _near(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Count filter on shared positional bytes, then the bit distance of what is left."""
    x = np.atleast_1d(a ^ b)
    shared = (x.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    out = shared >= BYTES - distance
    out[out] = np.bitwise_count(x[out]) <= distance
    return out


def _forest(fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join all near fingerprints of one list, fewer than it has members."""
    label, out = np.arange(len(fp)), []
    for i in range(len(fp) - 1):
        near = i + 1 + np.flatnonzero(_near(fp[i + 1:], fp[i], distance))
        for other in set(label[near].tolist()) - {int(label[i])}:
            out.append((i, int(near[label[near] == other][0])))
            label[label == other] = label[i]
    return out


def _list_links(distance: int):
    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def of(key, tile, fp):
            starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])])
            sizes, found = np.diff(np.r_[starts, len(key)]), []
            pairs = starts[sizes == 2]
            pairs = pairs[_near(fp[pairs], fp[pairs + 1], distance)] if len(pairs) else pairs
            a, b = [fp[pairs]], [fp[pairs + 1]]
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                found += [(s + i, s + j) for i, j in _forest(fp[s:s + n], distance)]
            if found:
                at = np.array(found)
                a.append(fp[at[:, 0]])
                b.append(fp[at[:, 1]])
            return pd.DataFrame({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

        rest = None
        for pdf in batches:
            part = (pdf["key"].to_numpy(), pdf["tile"].to_numpy(), np.ascontiguousarray(pdf["fp"].to_numpy()).view(np.uint64))
            if rest is not None:
                part = tuple(np.concatenate(x) for x in zip(rest, part))
            if not len(part[0]):
                continue
            key, tile, fp = part
            last = np.flatnonzero((key != key[-1]) | (tile != tile[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            rest = tuple(x[cut:] for x in part)
            if cut:
                yield of(key[:cut], tile[:cut], fp[:cut])
        if rest is not None and len(rest[0]):
            yield of(*rest)
    return links


def near_links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` differing in at most ``distance`` bits.

    Two fingerprints are connected by the result if and only if a chain of such pairs connects
    them.  A posting list with more than ``TILE`` members is cut into blocks; each two blocks meet
    in a task of their own, so that no list is gathered whole.
    """
    if not 0 <= distance <= 4:
        raise ValueError("the index covers distances from 0 to 4")
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    keys = [F.lit(k << 24) + byte(p) * 65536 + byte(q) * 256 + byte(r) for k, (p, q, r) in enumerate(place_triples())]
    posted = fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    long_lists = (posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE)
                  .select("key", F.ceil(F.col("n") / TILE).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    tiles = F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.expr(
        "transform(sequence(0, blocks - 1), j -> least(j, own) * cast(blocks as bigint) + greatest(j, own))"))
    tiled = (posted.join(long_lists, "key", "left").withColumn("own", own)
             .select("fp", "key", F.explode(tiles).alias("tile")))
    n = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (tiled.repartition(n, "key", "tile").sortWithinPartitions("key", "tile", "fp")
            .mapInPandas(_list_links(distance), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, shingle: int = 4, seed: int = 42, distance: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row.

    ``fingerprint`` has 16 lower-case hex digits; ``component_id`` is the smallest id among all rows
    that a chain of links reaches, the row's own included.  Rows without words have fingerprint
    zero and are linked like any other.  Repeated rows stay repeated rows.  A missing id is ignored
    by the minimum.  An empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    marked = write_once(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle, seed).alias("fp")), "simhash")
    fps = write_once(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    groups = write_once(connected_components(near_links(fps, distance)), "groups")
    labelled = fps.join(groups, fps["fp"] == groups["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    least = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labelled.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
