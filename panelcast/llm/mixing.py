"""Interleaving of sources at target weights by Pfair scheduling, in DataFrame functions alone.

A source of weight w releases its j-th block at slot floor((j - 1) / w), due by ceil(j / w).  In
each slot the released block with the earliest deadline runs (ties: by source).  Weights are whole
shares of a period, which grows with the number of sources, so the schedule of one period repeats;
it is worked out once and joined to the blocks of every period.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import write_once

#: Least period, and slots of a period for each source: at most a 50th of the slots is dealt evenly.
PERIOD = 1000
SLOTS = 50
BLOCK = 16
#: Slots in one inner fold, so that what is gathered is copied in pieces.
CHUNK = 1000
#: Hex digits of the ordering hash that cut a source into parts for ranking.
PART_DIGITS = 3


def shares(sizes: DataFrame, weight, period: int = PERIOD) -> DataFrame:
    """(source, units) of ``sizes(source, ...)``: whole shares of ``period`` after the column ``weight``.

    Each source gets at least one unit; the rest is dealt in proportion, by largest remainder (ties:
    by source).  One row a source; more sources than ``period`` are an error.
    """
    n = sizes.count()
    if n > period:
        raise ValueError("more sources than slots in a period")
    every = Window.partitionBy()
    ideal = F.col("w") / F.sum("w").over(every) * (period - n)
    dealt = (sizes.select("source", weight.cast("double").alias("w")).withColumn("ideal", ideal)
             .withColumn("whole", F.floor("ideal")).withColumn("left", F.lit(period - n) - F.sum("whole").over(every))
             .withColumn("turn", F.row_number().over(Window.orderBy(F.desc(F.round(F.col("ideal") - F.col("whole"), 9)), "source"))))
    return dealt.select("source", (1 + F.col("whole") + (F.col("turn") <= F.col("left")).cast("long")).alias("units"))


def period_schedule(units: DataFrame, period: int = PERIOD) -> DataFrame:
    """(source, turn, slot): the slot of each source's blocks in the first period, ``turn`` from 0.

    Sources with equal units have equal windows and take turns in their order, so the state of the
    fold over the slots has one entry for each different number of units (fewer than the root of
    twice the period), not for each source.  The entry's next block is released at ``r``, due by
    ``d``; the released one with the earliest deadline runs.  The shares must sum to the period.
    """
    listed = units.withColumn("pos", F.row_number().over(Window.orderBy("source")))
    classes = (listed.groupBy("units").agg(F.sort_array(F.collect_list("pos")).alias("pos"))
               .groupBy().agg(F.sort_array(F.collect_list(F.struct("units", "pos"))).alias("s")))

    def upcoming(i: str, k: str) -> str:
        turn = f"({k}) div size(s[{i}].pos)"
        return (f"named_struct('d', (({turn} + 1) * {period} + s[{i}].units - 1) div s[{i}].units, 'p', s[{i}].pos[cast(({k}) % size(s[{i}].pos) as int)], "
                f"'i', {i}, 'k', {k}, 'r', if(({k}) < s[{i}].units * size(s[{i}].pos), {turn} * {period} div s[{i}].units, {period}L))")

    kind = "array<struct<pos: int, turn: bigint, slot: int>>"
    inner = f"""aggregate(sequence(a, least(a + {CHUNK}, {period}) - 1), named_struct('next', chunk.next, 'out', cast(array() as {kind})),
        (state, t) -> transform(array(array_min(filter(state.next, x -> x.r <= t))), b -> named_struct(
            'next', transform(state.next, x -> if(x.i = b.i, {upcoming("x.i", "x.k + 1")}, x)),
            'out', concat(state.out, array(named_struct('pos', b.p, 'turn', b.k div size(s[b.i].pos), 'slot', t)))))[0])"""
    fold = f"""aggregate(sequence(0, {period} - 1, {CHUNK}),
        named_struct('next', transform(sequence(0, size(s) - 1), i -> {upcoming("i", "0L")}), 'out', cast(array() as array<{kind}>)),
        (chunk, a) -> transform(array({inner}), x -> named_struct('next', x.next, 'out', concat(chunk.out, array(x.out))))[0],
        chunk -> chunk.out)"""
    slots = classes.where("size(s) > 0").select(F.explode(F.expr(fold)).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    return slots.join(listed.select("source", "pos"), "pos").select("source", "turn", "slot")


def ranked(docs: DataFrame, id_col: str, source_col: str, block: int) -> DataFrame:
    """``docs`` with ``__rank``, from 0, in its source in the order of a hash of the id.

    A source is ranked in parts of the hash, which are small next to the source, and the parts'
    counts are added up; no source is gathered in one task.  ``source_col`` has no NULL, so the join
    of the counts has the keys of the ranking and needs no second shuffle of the rows.
    """
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    keyed = docs.withColumns({"__source": F.col(source_col).cast("string"), "__hash": key}).withColumn("__part", F.substring("__hash", 1, PART_DIGITS))
    counts = keyed.groupBy("__source", "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("__source").alias("__s"), F.col("__part").alias("__p"),
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__source", "__part").orderBy("__hash")) - 1
    return (keyed.withColumn("__inside", inside)
            .join(counts.hint("merge"), (F.col("__source") == F.col("__s")) & (F.col("__part") == F.col("__p")), "left")
            .withColumn("__rank", F.col("__before") + F.col("__inside")))


def mixed(docs: DataFrame, weight=None, id_col: str = "doc_id", source_col: str = "source", block: int = BLOCK,
          period: int | None = None) -> DataFrame:
    """Every row of ``docs`` with ``units``, ``block``, ``slot``, ``release``, ``deadline`` and ``place``.

    ``weight`` is an aggregate over the rows of a source (by default the square root of their
    number).  A period has ``period`` slots, by default ``SLOTS`` a source and ``PERIOD`` at least,
    so a share differs from its target by a 50th of it and two slots at most, or is one to two
    slots where the target is less than one.  Blocks are ``block`` rows of one source, the last one maybe fewer.  After any number
    of slots each source that still has blocks has run within one block of its share.  Every row
    has one place; ordering by ``place`` gives the mixture, in which a source that has run out
    leaves its slots empty.  Rows without a source are a source of their own, rows without an id
    come in one place of the hash; an empty table gives no rows.
    """
    new = ["units", "block", "slot", "release", "deadline", "place"]
    old = [c for c in docs.columns if c not in new]
    weight = F.sqrt(F.count(F.lit(1))) if weight is None else weight
    name = F.concat(F.when(F.col(source_col).isNull(), "-").otherwise("+"), F.coalesce(F.col(source_col).cast("string"), F.lit("")))
    docs = docs.select(*old).withColumn("__name", name)
    sizes = write_once(docs.groupBy(F.col("__name").alias("source")).agg(weight.alias("w")), "sizes")
    period = max(PERIOD, SLOTS * sizes.count()) if period is None else period
    units = write_once(shares(sizes, F.col("w"), period), "shares")
    plan = write_once(period_schedule(units, period).join(units, "source"), "schedule").select(
        F.col("source").alias("__plan"), "turn", "slot", "units")
    rows = (ranked(docs, id_col, "__name", block)
            .withColumn("block", F.floor(F.col("__rank") / block))
            .join(units.select(F.col("source").alias("__u"), F.col("units").alias("__units")), F.col("__name") == F.col("__u"))
            .withColumn("__cycle", F.floor(F.col("block") / F.col("__units"))))
    # one row a slot of the period: Spark broadcasts it while it is small
    out = rows.join(plan.withColumnsRenamed({"turn": "__turn", "slot": "__slot"}),
                    (F.col("__name") == F.col("__plan")) & (F.col("block") % F.col("__units") == F.col("__turn")))
    slot = F.col("__cycle") * period + F.col("__slot")
    return out.select(
        *old, F.col("__units").alias("units"), "block", slot.alias("slot"), F.expr(f"block * {period} div __units").alias("release"),
        F.expr(f"((block + 1) * {period} + __units - 1) div __units").alias("deadline"),
        (slot * block + F.col("__rank") % block).alias("place"))


def oracle(block: int = BLOCK, period: int = PERIOD) -> str:
    """The registered query in DuckDB's SQL: shares, then slot after slot by recursion."""
    return f"""WITH RECURSIVE named AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS name FROM documents),
sizes AS (SELECT name, sqrt(count(*)) AS w FROM named GROUP BY name),
ideal AS (SELECT name, w / (SELECT sum(w) FROM sizes) * ({period} - (SELECT count(*) FROM sizes)) AS x FROM sizes),
units AS (
  SELECT name, CAST(1 + floor(x) + CASE WHEN row_number() OVER (ORDER BY round(x - floor(x), 9) DESC, name)
                                  <= {period} - count(*) OVER () - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS BIGINT) AS units
  FROM ideal),
listed AS (SELECT list(name ORDER BY name) AS names, list(units ORDER BY name) AS u FROM units),
run(t, done, pick) AS (
  SELECT -1, list_transform(u, lambda x: CAST(0 AS BIGINT)), CAST(NULL AS BIGINT) FROM listed
  UNION ALL
  SELECT t + 1, list_transform(done, lambda n, i: n + CASE WHEN i = p THEN 1 ELSE 0 END), p
  FROM (SELECT run.t, run.done,
               list_min(list_transform(list_filter(range(1, len(u) + 1), lambda i: done[i] * {period} // u[i] <= t + 1 AND done[i] < u[i]),
                 lambda i: [((done[i] + 1) * {period} + u[i] - 1) // u[i], i]))[2] AS p
        FROM run, listed WHERE t < {period} - 1)),
schedule AS (
  SELECT names[pick] AS name, row_number() OVER (PARTITION BY pick ORDER BY t) - 1 AS turn, t AS slot FROM run, listed WHERE pick IS NOT NULL),
ranked AS (
  SELECT doc_id, source, name, units, row_number() OVER (PARTITION BY name ORDER BY md5(CAST(doc_id AS VARCHAR))) - 1 AS r
  FROM named JOIN units USING (name))
SELECT doc_id, source, units, r // {block} AS block, r // {block} // units * {period} + slot AS slot,
       r // {block} * {period} // units AS release, ((r // {block} + 1) * {period} + units - 1) // units AS deadline,
       (r // {block} // units * {period} + slot) * {block} + r % {block} AS place
FROM ranked JOIN schedule ON ranked.name = schedule.name AND r // {block} % units = turn"""
