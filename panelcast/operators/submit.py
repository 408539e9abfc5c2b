"""From forecasts to a checked submission."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import series_id, submission_id
from ..functions.scalars import clip_nonnegative
from .joins import join_forecast, with_fallbacks


def forecast_keys(requests: DataFrame) -> DataFrame:
    """(unique_id, ds, Id) of the requested rows."""
    return requests.select(series_id().alias("unique_id"), F.col("Date").alias("ds"), submission_id().alias("Id"))


def predict_submission(
    requests: DataFrame, forecast: DataFrame, by_id: DataFrame, overall: DataFrame
) -> DataFrame:
    """Requested keys -> forecast by week -> fallbacks -> clip -> (Id, Weekly_Sales)."""
    joined = join_forecast(forecast_keys(requests), forecast.select("unique_id", "ds", "prediction"))
    filled = with_fallbacks(joined, by_id, overall)
    return filled.select("Id", clip_nonnegative("prediction").alias("Weekly_Sales"))


def prediction_gate(predictions: DataFrame, requests: DataFrame, template: DataFrame) -> DataFrame:
    """(check, ok, n_bad): the rules a submission must meet, as data.

    Predictions and template are each counted by id, map side first, and meet in one full join; a
    missing id meets nothing.
    """
    exact = set(predictions.columns) == {"Id", "Weekly_Sales"}
    value = F.col("Weekly_Sales")
    ours = predictions.groupBy("Id").agg(
        F.count("*").alias("_n"), F.count_if(value.isNull() | F.isnan(value)).alias("_nulls"), F.count_if(value < 0).alias("_negative"))
    known = template.groupBy("Id").agg(F.count("*").alias("_t"))
    one = ours.join(known, "Id", "full").agg(
        *[F.coalesce(F.sum(f"_{c}"), F.lit(0)).alias(c) for c in ("n", "nulls", "negative")],
        F.coalesce(F.sum(F.when(F.col("_n").isNull(), F.col("_t"))), F.lit(0)).alias("missing"),
        F.coalesce(F.sum(F.when(F.col("_t").isNull(), F.col("_n"))), F.lit(0)).alias("extra"))
    one = one.crossJoin(F.broadcast(requests.agg(F.count("*").alias("expected"))))
    bad = {
        "columns": F.lit(0 if exact else 1), "row_count": F.abs(F.col("n") - F.col("expected")),
        "not_null": F.col("nulls"), "nonnegative": F.col("negative"),
        "missing_ids": F.col("missing"), "extra_ids": F.col("extra"),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("check"), v.cast("bigint").alias("n_bad")) for k, v in bad.items()])
    return one.select(F.explode(rows).alias("r")).select(
        "r.check", (F.col("r.n_bad") == 0).alias("ok"), "r.n_bad")


def require_gate(gate: DataFrame) -> None:
    """Run the gate and fail naming the broken rules."""
    broken = [(r["check"], r["n_bad"]) for r in gate.filter(~F.col("ok")).collect()]
    if broken:
        raise ValueError(f"submission rejected: {broken}")
