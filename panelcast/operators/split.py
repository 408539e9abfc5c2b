"""Time splits, series filters, samples and back-tests."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.staging import write_once
from .quantiles import exact_quantiles


def cutoff_date(df: DataFrame, valid_weeks: int, date: str = "Date") -> DataFrame:
    """One row (cutoff): first of the last ``valid_weeks`` distinct dates.

    Fails when the frame has no more than ``valid_weeks`` dates.
    """
    latest = df.select(F.col(date).alias("d")).distinct().orderBy(F.desc("d")).limit(valid_weeks + 1)
    days = F.sort_array(F.collect_list("d"))
    few = F.raise_error(F.lit("Not enough dates for the requested validation split.")).cast("date")
    return latest.agg(
        F.when(F.count("*") > valid_weeks, F.get(days, F.lit(1))).otherwise(few).alias("cutoff"))


def cutoff_value(df: DataFrame, valid_weeks: int, date: str = "Date") -> Column:
    """The cutoff as a scalar subquery, evaluated once before the scan that uses it."""
    return cutoff_date(df, valid_weeks, date).scalar()


def time_split(df: DataFrame, valid_weeks: int, date: str = "Date") -> tuple[DataFrame, DataFrame]:
    """(train, valid): the last ``valid_weeks`` distinct dates are held out."""
    cut = cutoff_value(df, valid_weeks, date)
    return df.filter(F.col(date) < cut), df.filter(F.col(date) >= cut)


def complete_series(
    long: DataFrame, cutoff: Column, horizon: int, min_train: int = 52, key: str = "unique_id", date: str = "ds",
) -> DataFrame:
    """Ids of full-length series with enough training weeks and a complete validation window.

    All three lengths come from one pass over the panel.
    """
    sizes = long.withColumn("_train", F.col(date) < cutoff).groupBy(key).agg(
        F.count("*").alias("n"), F.count_if("_train").alias("n_train"), F.count_if(~F.col("_train")).alias("n_valid"))
    longest = sizes.agg(F.max("n")).scalar()
    return sizes.filter(
        (F.col("n") == longest) & (F.col("n_train") >= min_train) & (F.col("n_valid") == horizon)).select(key)


def stratified_sample(
    long: DataFrame, n_series: int, seed: int = 42, key: str = "unique_id", target: str = "y",
) -> DataFrame:
    """``n_series // 4`` series from each quartile of mean sales.

    Quartile edges are interpolated and right-closed.  The draw orders by a seeded hash, so it
    does not depend on partitioning.  The panel is read once, for the means, which are written; each
    task keeps the first of its own series in a quartile before those meet.
    """
    means = write_once(long.groupBy(key).agg(F.avg(target).alias("mean_y")).filter("mean_y is not null"), "means")
    edges = [r.value for r in exact_quantiles(means, "mean_y", [0.25, 0.5, 0.75]).orderBy("prob").collect()]
    mean, band = F.col("mean_y"), F.lit(3)
    for q in reversed(range(len(edges))):
        band = F.when(mean <= F.lit(edges[q]), q).otherwise(band)
    drawn = means.select(key, band.alias("quartile"), F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed)))).alias("_draw"))
    place = F.row_number().over(W.partitionBy("quartile").orderBy("_draw", key))
    return drawn.withColumn("_place", place).filter(F.col("_place") <= n_series // 4).select(key, "quartile")


def backtest_window(
    long: DataFrame, cutoff: Column, horizon: int, context: int, key: str = "unique_id", date: str = "ds",
) -> tuple[DataFrame, DataFrame]:
    """(history, actuals) of one held-out window.

    History is the last ``context`` weeks before the cutoff, actuals the ``horizon`` weeks after;
    series with an incomplete window or no history are left out of both.
    """
    marked = long.withColumn("_past", F.col(date) < cutoff)
    series = W.partitionBy(key)
    rank = F.row_number().over(W.partitionBy(key, "_past").orderBy(F.desc(date)))
    usable = marked.withColumns({
        "_n_valid": F.count_if(~F.col("_past")).over(series),
        "_n_past": F.count_if("_past").over(series),
        "_back": rank,
    }).filter((F.col("_n_valid") == horizon) & (F.col("_n_past") > 0))
    history = usable.filter(F.col("_past") & (F.col("_back") <= context))
    actual = usable.filter(~F.col("_past"))
    helpers = ["_past", "_n_valid", "_n_past", "_back"]
    return history.drop(*helpers), actual.drop(*helpers)


def insample_windows(long: DataFrame, step: int, key: str = "unique_id", date: str = "ds") -> DataFrame:
    """Cut each series into back-to-back windows of ``step`` weeks, counted from its first week.

    Adds ``window`` (0, 1, ...) and ``cutoff``, the first week of the window: a forecast for the
    row may use only weeks before that cutoff.
    """
    first = F.min(date).over(W.partitionBy(key))
    index = F.floor(F.datediff(F.col(date), first) / 7 / step).cast("int")
    return long.withColumn("window", index).withColumn("cutoff", F.date_add(first, F.col("window") * (7 * step)))
