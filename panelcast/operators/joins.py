"""Lookups of the fact table in its dimensions.

No join here forces a broadcast of a table that grows with the data: Spark compares the measured
size with ``spark.sql.autoBroadcastJoinThreshold`` and otherwise runs a sort-merge join whose hot
partitions are split by AQE.  ``salted_lookup`` is the explicit form for a known hot key.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import fallback_chain
from ..sources.staging import write_once
from .clean import handle_missing, one_hot_type


def join_covariates_3key(fact: DataFrame, covariates: DataFrame) -> DataFrame:
    """(Store, Date, IsHoliday): rows whose flags disagree get missing covariates."""
    return fact.join(covariates, ["Store", "Date", "IsHoliday"], "left")


def join_covariates_2key(fact: DataFrame, covariates: DataFrame) -> DataFrame:
    """Clean the covariates, drop their flag, join on (Store, Date)."""
    clean = handle_missing(covariates).drop("IsHoliday")
    return fact.join(clean, ["Store", "Date"], "left")


def join_stores(fact: DataFrame, stores: DataFrame) -> DataFrame:
    return fact.join(stores, "Store", "left")


def join_store_onehot(fact: DataFrame, stores: DataFrame) -> DataFrame:
    """Store size and one-hot type."""
    return fact.join(one_hot_type(stores.select("Store", "Type", "Size")), "Store", "left")


def salted_lookup(fact: DataFrame, dim: DataFrame, on: Sequence[str], salts: int, spread: Sequence[str]) -> DataFrame:
    """Left lookup for a key that may hold a large share of the rows and a dimension too big to
    broadcast: fact rows spread over ``salts`` buckets by ``spread``, the dimension is repeated
    once per bucket."""
    bucket = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return fact.withColumn("_salt", bucket).join(copies, [*on, "_salt"], "left").drop("_salt")


def join_forecast(keys: DataFrame, forecast: DataFrame, on: Sequence[str] = ("unique_id", "ds")) -> DataFrame:
    """Requested keys keep their rows; forecasts are matched by series and week."""
    return keys.join(forecast, list(on), "left")


def holiday_lookup(df: DataFrame) -> DataFrame:
    """Distinct (unique_id, ds, IsHoliday) with a missing flag read as False."""
    flag = F.coalesce(F.col("IsHoliday").cast("boolean"), F.lit(False))
    return df.select("unique_id", "ds", flag.alias("IsHoliday")).distinct()


def join_holidays(oof: DataFrame, lookup: DataFrame) -> DataFrame:
    out = oof.join(lookup, ["unique_id", "ds"], "left")
    return out.withColumn("IsHoliday", F.coalesce("IsHoliday", F.lit(False)))


def nearest_events(rows: DataFrame, events: DataFrame, at: str, by: Sequence[str] = ()) -> DataFrame:
    """``rows`` with ``last_event`` and ``next_event``: the nearest value of ``at`` among ``events`` on either side, itself included.

    For event tables of any size.  Distinct places of rows and events are sorted together by range;
    each part carries its events on and back, and the ends of the parts tell what lies beyond its
    borders, so no row meets more than its own neighbours and a place that holds many rows counts
    once.  With ``by`` only events with equal keys count.  Missing keys or places find nothing.
    """
    keys = [*by, at]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    marks = rows.select(*keys, F.lit(False).alias("_event")).union(events.select(*keys, F.lit(True))).where(known)
    marks = marks.groupBy(*keys).agg(F.max("_event").alias("_event"))
    placed = write_once(marks.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "marks")
    hit = F.when(F.col("_event"), F.col(at))
    own, over = W.partitionBy("_part", *by), W.partitionBy(*(by or [F.lit(0)]))  # without keys: one row a part
    beyond = (W.unboundedPreceding, -1)
    ends = placed.groupBy("_part", *by).agg(F.max(hit).alias("_high"), F.min(hit).alias("_low"))
    ends = ends.select("_part", *by, F.last("_high", ignorenulls=True).over(over.orderBy("_part").rowsBetween(*beyond)).alias("_before"),
                       F.last("_low", ignorenulls=True).over(over.orderBy(F.desc("_part")).rowsBetween(*beyond)).alias("_after"))
    carried = placed.withColumns({"_last": F.last(hit, ignorenulls=True).over(own.orderBy(at)),
                                  "_next": F.last(hit, ignorenulls=True).over(own.orderBy(F.desc(at)))})
    found = carried.join(ends, ["_part", *by]).select(
        *keys, F.coalesce("_last", "_before").alias("last_event"), F.coalesce("_next", "_after").alias("next_event"))
    return rows.join(found, keys, "left")


def map_lookup(df: DataFrame, table: DataFrame, key: str, value: str) -> DataFrame:
    """Attach ``value`` by ``key``; unknown keys stay missing."""
    return df.join(table.select(key, value), key, "left")


def with_fallbacks(
    df: DataFrame, by_id: DataFrame, overall: DataFrame, prediction: str = "prediction"
) -> DataFrame:
    """Missing predictions take the series' last value, then the overall value.

    ``by_id`` is (unique_id, last_y), ``overall`` a one-row frame (median_y).
    """
    out = df.join(by_id.select("unique_id", "last_y"), "unique_id", "left")
    out = out.crossJoin(F.broadcast(overall.select("median_y")))
    return out.withColumn(prediction, fallback_chain(prediction, "last_y", "median_y")).drop("last_y", "median_y")


def semi_join_ids(df: DataFrame, ids: DataFrame, key: str = "unique_id") -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def anti_join_ids(left: DataFrame, right: DataFrame, key: str = "Id") -> DataFrame:
    return left.select(key).join(right.select(key), key, "left_anti")


def id_differences(template: DataFrame, predictions: DataFrame, key: str = "Id") -> DataFrame:
    """Ids missing from the predictions and ids the template does not know."""
    missing = anti_join_ids(template, predictions, key).withColumn("side", F.lit("missing"))
    extra = anti_join_ids(predictions, template, key).withColumn("side", F.lit("extra"))
    return missing.unionByName(extra)


def join_grid_covariates(grid: DataFrame, store_dates: DataFrame, store: Column) -> DataFrame:
    """Future grid (unique_id, ds) left join covariates on the store parsed from the id."""
    right = store_dates.withColumnRenamed("Date", "ds")
    return grid.withColumn("Store", store).join(right, ["Store", "ds"], "left").drop("Store")


def reindex_product(
    ids: DataFrame, key: str, dates: DataFrame, table: DataFrame, table_date: str = "Date"
) -> DataFrame:
    """Every (key, date) pair of two short axes, with the table's values or missing.

    ``dates`` is one row holding an array of dates, so the pairs are an ``explode`` per key.
    """
    grid = ids.select(key).distinct().crossJoin(F.broadcast(dates))
    grid = grid.select(key, F.explode("dates").alias(table_date))
    return grid.join(table, [key, table_date], "left")


def cross_configs(series: DataFrame, configs: DataFrame) -> DataFrame:
    """Every configuration for every series; the configuration list is a literal table."""
    return series.crossJoin(F.broadcast(configs))


def restore_order(template: DataFrame, predictions: DataFrame, position: str = "pos") -> DataFrame:
    """Predictions in the template's order."""
    return template.select("Id", position).join(predictions, "Id", "left").orderBy(position)

