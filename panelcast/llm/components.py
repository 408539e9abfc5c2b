"""Connected components of a table of links, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once


def _state(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links(a, b)``; the component is its smallest node.

    Each round links all larger neighbours of a node to its smallest one, then the smaller ones,
    and writes the links to the shared folder, so that lineage stays one round long.  Rounds grow
    with the logarithm of the number of nodes.  Minima combine before the shuffle and the rows of a
    star meet their centre in a join that Spark can split.  Links from a node to itself, and
    missing ends, join nothing; an empty table gives no rows.
    """
    edges = write_once(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                       .where("hi > lo and a is not null and b is not null").distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").select(F.when(F.col("lo") == F.col("m"), F.col("hi")).otherwise(F.col("lo")).alias("hi"),
                                                F.col("m").alias("lo")).distinct())
        edges = write_once(small, "links")
        state, before = _state(edges), state
        if state == before:
            break
    return (edges.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
            .union(edges.select("lo", "lo").distinct()))
