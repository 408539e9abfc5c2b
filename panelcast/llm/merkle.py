"""Merkle manifest of a dataset: a tree for each group, a tree over the groups' roots, a proof for each row.

Rows are numbered within their group by a distributed sort.  A superblock is an aligned run of
``2 ** HEIGHT`` nodes; folding superblocks, then superblocks of their roots and so on, gives the
roots.  On the way back the nodes outside a superblock that its proofs need are cogrouped with its
nodes, which finishes the proofs and folds them in the same task.
"""

import hashlib
from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import write_once

HEIGHT = 10
#: Steps of a proof as bytes: what stands beside a node, then its digest if something does.
ALONE, RIGHT, LEFT = b"0", b">", b"<"
OUTER = "tree string, place long, steps binary, subroot binary, root binary"


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests, joined as lowercase hex text."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def levels_of(nodes: list[bytes], height: int) -> list[list[bytes]]:
    """The nodes of an aligned run and of the ``height`` levels above them; runs of two, the last may hold one."""
    out = [nodes]
    for _ in range(height):
        below = out[-1]
        out.append([digest(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return out


def steps_of(levels: list[list[bytes]], at: int) -> bytes:
    """What stands beside the path from node ``at`` up to the top of ``levels``."""
    steps = []
    for nodes in levels[:-1]:
        if at % 2:
            steps += [LEFT, nodes[at - 1]]
        elif at + 1 < len(nodes):
            steps += [RIGHT, nodes[at + 1]]
        else:
            steps.append(ALONE)
        at //= 2
    return b"".join(steps)


def siblings(steps: bytes) -> list[tuple[bytes, bytes]]:
    out, i = [], 0
    while i < len(steps):
        side, i = steps[i:i + 1], i + 1
        width = 0 if side == ALONE else 32
        out.append((side, steps[i:i + width]))
        i += width
    return out


def folded(node: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a node and what stands beside its path lead to."""
    for side, other in path:
        node = digest(node) if side == ALONE else digest(node, other) if side == RIGHT else digest(other, node)
    return node


def height_of(size: int) -> int:
    """Levels above the nodes of a superblock: all that its tree has, or ``HEIGHT``."""
    return min(HEIGHT, max(int(size) - 1, 0).bit_length())


def field(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")))


def leaf_of(fields: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields]), 256))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place`` from 0 within ``group`` by ``order``, and the group's ``size``.

    A range sort cuts groups of any size into parts; only a count for each part and group is
    ranked.  Rows are written in order, so that a place never changes when a task runs again.
    """
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    sorted_ = write_once(ranged.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33)
    runs = sorted_.groupBy(group, part.alias("part")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    each = W.partitionBy(group)
    runs = write_once(runs.select(
        group, "part", (F.sum("n").over(each.orderBy("part")) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(each).alias("size")), "runs")
    return sorted_.withColumn("part", part).join(runs, [group, "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def block() -> Column:
    return F.shiftright("place", HEIGHT).alias("block")


def folded_up(nodes: DataFrame) -> list[DataFrame]:
    """Tables (tree, place, size, node): the given nodes, the roots of their superblocks, and so on to one node a tree."""
    def reduce(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        size = int(pdf["size"].iloc[0])
        top = levels_of([bytes(x) for x in pdf["node"]], height_of(size))[-1]
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "size": [-(-size >> HEIGHT)], "node": top})

    levels = [nodes.select("tree", "place", "size", "node")]
    largest = nodes.agg(F.max("size")).first()[0] or 0
    while True:
        up = levels[-1].groupBy("tree", block()).applyInPandas(reduce, "tree string, place long, size long, node binary")
        levels.append(write_once(up, "superblocks"))
        largest = -(-largest >> HEIGHT)
        if largest <= 1:
            return levels


def handed_down(nodes: DataFrame, outer: DataFrame, finish, schema: str) -> DataFrame:
    """``finish`` of each node with what stands beside its whole path, superblock by superblock.

    ``outer`` has the paths above the superblocks, at most one row for each.
    """
    def exchange(pdf: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        levels = levels_of([bytes(x) for x in pdf["node"]], height_of(pdf["size"].iloc[0]))
        inner = [steps_of(levels, i) for i in range(len(pdf))]
        return finish(pdf, inner, above.iloc[0])

    keyed = outer.select("tree", F.col("place").alias("block"), *[c for c in outer.columns if c not in ("tree", "place")])
    return nodes.withColumn("block", block()).groupBy("tree", "block").cogroup(keyed.groupBy("tree", "block")).applyInPandas(exchange, schema)


def _paths(pdf: pd.DataFrame, inner: list[bytes], above) -> pd.DataFrame:
    return pd.DataFrame({"tree": pdf["tree"], "place": pdf["place"], "steps": [i + bytes(above["steps"]) for i in inner],
                         "subroot": [bytes(above["subroot"])] * len(pdf), "root": [bytes(above["root"])] * len(pdf)})


def manifest(docs: DataFrame, fields: list[str], group: str, order: str, changed: Mapping[str, Column] | None = None) -> DataFrame:
    """(order, group, place, leaf, subroot, root, proof_sha256, folded_root, verified, tampered) of every row.

    A leaf is the SHA-256 of the ``fields``, each ``-`` if it is null, else its byte count, ``:`` and
    its text.  Within a ``group`` (null is one) leaves ascend by ``order`` (nulls first), then by
    digest; two neighbours at a time become their digest, the last may be alone, up to the subroot.
    Subroots by group (null first, then by bytes) lead to the root in the same way.
    ``proof_sha256`` is the digest of what stands beside the path from the leaf to the root.
    ``changed`` gives fields as they are claimed; ``folded_root`` starts at the claimed leaf and
    ``verified`` tells whether it ends at the root.  Rows that are equal stand side by side.  An empty
    table gives no rows.  Long texts are hashed by the JVM; only digests travel.
    """
    changed = dict(changed or {})
    cols = [F.col(f) for f in fields]
    leaf, claimed = leaf_of(cols), leaf_of([changed.get(f, F.col(f)) for f in fields])
    name = F.col(group).cast("string")
    rows = docs.select(F.col(order).alias("id"), F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit(":"), name)).alias("tree"),
                       leaf.alias("node"), claimed.alias("claimed"))
    rows = write_once(rows.withColumn("claimed", F.when(F.col("claimed") != F.col("node"), F.col("claimed"))), "leaves")
    # a table may repeat one row very often; the number spreads equal rows over parts
    leaves = write_once(numbered(rows.withColumn("again", F.monotonically_increasing_id()), "tree", ["id", "node", "again"]).drop("again"), "placed")
    trees = folded_up(leaves)
    over = numbered(trees[-1].select(F.lit("").alias("top"), "tree", "node"), "top", ["tree"])
    groups = write_once(over.select(F.col("top").alias("tree"), F.col("tree").alias("name"), "place", "size", "node"), "subroots")
    tops = folded_up(groups)
    empty = F.lit(b"")
    outer = tops[-1].select("tree", "place", empty.alias("steps"), empty.alias("subroot"), F.col("node").alias("root"))
    for nodes in reversed(tops[:-1]):
        outer = write_once(handed_down(nodes, outer, _paths, OUTER), "outer")
    # from here on a path belongs to a group's own tree, and the node it starts from is its subroot
    outer = groups.select("name", "place", F.col("node").alias("subroot")).join(outer.select("place", "steps", "root"), "place").select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "steps", "subroot", "root")
    for nodes in reversed(trees[1:-1]):
        outer = write_once(handed_down(nodes, outer, _paths, OUTER), "outer")

    def finish(pdf: pd.DataFrame, inner: list[bytes], above) -> pd.DataFrame:
        steps, root = bytes(above["steps"]), bytes(above["root"])
        beyond, out = siblings(steps), []
        for node, claim, own in zip(pdf["node"], pdf["claimed"], inner):
            path = siblings(own) + beyond
            back = folded(bytes(node if claim is None else claim), path)
            proof = digest(*[other for side, other in path if side != ALONE])
            out.append((bytes(node).hex(), proof.hex(), back.hex(), back == root, claim is not None))
        frame = pd.DataFrame(out, columns=["leaf", "proof_sha256", "folded_root", "verified", "tampered"])
        for c in ("id", "tree", "place"):
            frame[c] = pdf[c].to_numpy()
        return frame.assign(subroot=bytes(above["subroot"]).hex(), root=root.hex())

    kind = leaves.schema["id"].dataType.simpleString()
    out = handed_down(leaves, outer, finish, f"id {kind}, tree string, place long, leaf string, subroot string, root string, "
                                             "proof_sha256 string, folded_root string, verified boolean, tampered boolean")
    own = F.when(F.col("tree") != "-", F.substring("tree", 2, 2 ** 31 - 1))
    return out.select(F.col("id").alias(order), own.alias("group"), "place", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "tampered")


ORACLE = """
WITH RECURSIVE
bits(v, k, c) AS (SELECT range, 0, range FROM range(256)
  UNION ALL SELECT v, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE k = 8),
d AS (SELECT *, CASE WHEN lang IS NULL THEN '-' ELSE ':' || lang END AS tree,
  list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
              lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])) AS crc FROM documents, crc_table),
f AS (SELECT doc_id, tree, coalesce(xor(crc, 4294967295) % 7 = 0, FALSE) AS changed,
  coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') AS head,
  n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail FROM d),
g AS (SELECT doc_id, tree, sha256(head || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
  sha256(head || coalesce(strlen(CAST(n_chars + CAST(changed AS INT) AS VARCHAR)) || ':' || (n_chars + CAST(changed AS INT)), '-') || tail) AS claim
  FROM f),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
  count(*) OVER (PARTITION BY tree) AS size FROM g),
nodes(tree, level, place, size, node) AS (SELECT tree, 0, place, size, leaf FROM placed
  UNION ALL SELECT tree, level + 1, place // 2, (any_value(size) + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM nodes WHERE size > 1 GROUP BY tree, level, place // 2),
subroots AS (SELECT tree, level AS height, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS size
  FROM nodes WHERE size = 1),
tops(level, place, size, node) AS (SELECT 0, place, size, subroot FROM subroots
  UNION ALL SELECT level + 1, place // 2, (any_value(size) + 1) // 2, sha256(string_agg(node, '' ORDER BY place))
  FROM tops WHERE size > 1 GROUP BY level, place // 2),
steps AS (SELECT p.tree, p.place AS leaf_place, n.level, n.place AS at, o.node AS beside
  FROM placed p JOIN nodes n ON n.tree = p.tree AND n.size > 1 AND n.place = p.place >> n.level
       LEFT JOIN nodes o ON o.tree = n.tree AND o.level = n.level AND o.place = xor(n.place, 1)
  UNION ALL
  SELECT p.tree, p.place, s.height + n.level, n.place, o.node
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN tops n ON n.size > 1 AND n.place = s.place >> n.level
       LEFT JOIN tops o ON o.level = n.level AND o.place = xor(n.place, 1)),
paths AS (SELECT tree, leaf_place AS place, sha256(coalesce(string_agg(beside, '' ORDER BY level), '')) AS proof_sha256 FROM steps GROUP BY ALL),
fold(tree, place, level, node) AS (SELECT tree, place, 0, claim FROM placed
  UNION ALL SELECT f.tree, f.place, f.level + 1, sha256(CASE WHEN s.beside IS NULL THEN f.node WHEN s.at % 2 = 1 THEN s.beside || f.node ELSE f.node || s.beside END)
  FROM fold f JOIN steps s ON s.tree = f.tree AND s.leaf_place = f.place AND s.level = f.level)
SELECT p.doc_id, p.leaf, r.subroot, t.node AS root, coalesce(h.proof_sha256, sha256('')) AS proof_sha256, l.node AS folded_root, l.node = t.node AS verified
FROM placed p JOIN subroots r ON r.tree = p.tree JOIN (SELECT node FROM tops WHERE size = 1) t ON TRUE
     LEFT JOIN paths h ON h.tree = p.tree AND h.place = p.place
     JOIN (SELECT tree, place, arg_max(node, level) AS node FROM fold GROUP BY ALL) l ON l.tree = p.tree AND l.place = p.place
"""
