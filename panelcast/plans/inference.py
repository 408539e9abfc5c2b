"""From run ledger to a checked submission file."""

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..models import baselines, grouped
from ..operators import ledger as runs
from ..operators import submit
from ..operators.joins import restore_order
from ..sources import files, model_store
from ..sources.staging import write_once


def candidates(ledger: DataFrame, documented: dict[str, float] | None = None) -> DataFrame:
    """Ranked (experiment, val_wmae, label, run_id, source): live runs or documented values."""
    known = runs.DOCUMENTED_RESULTS if documented is None else documented
    spark = ledger.sparkSession
    table = spark.createDataFrame(list(known.items()), "experiment string, documented_wmae double")
    experiments = ledger.select("experiment").union(table.select("experiment")).distinct()
    return runs.with_documented(experiments, ledger, table).orderBy("val_wmae", "experiment")


def stored_labels(spark: SparkSession, stores: Mapping[str, str]) -> DataFrame:
    """(experiment, label) of every stored label with a fitted series; a store that cannot be read has none.

    A store with a manifest counts by its live versions, another by its rows.
    """
    out = spark.createDataFrame([], "experiment string, label string")
    for experiment, path in stores.items():
        if model_store.manifests(spark, path):
            labels = [(experiment, k) for k in model_store.live_labels(spark, path)]
            out = out.union(spark.createDataFrame(labels, out.schema))
            continue
        try:
            fitted = spark.read.schema(schemas.MODEL_STORE).parquet(path).filter("status = 'fitted'")
        except AnalysisException:
            continue
        out = out.union(fitted.select(F.lit(experiment), "label").distinct())
    return out


def select_run(ledger: DataFrame, stores: Mapping[str, str]) -> Row | None:
    """(experiment, label, ...) of the best-ranked run whose models are stored.

    A family known by its documented error alone has no run to load.
    """
    ranked = write_once(candidates(ledger), "candidates")
    usable = ranked.select("experiment", "label").join(stored_labels(ledger.sparkSession, stores), ["experiment", "label"])
    return runs.next_usable(ranked, usable.withColumn("usable", F.lit(True))).first()


def serve_best(
    ledger: DataFrame, families: Mapping[str, Sequence[Mapping]], stores: Mapping[str, str], long: DataFrame,
    requests: DataFrame, template: DataFrame, horizon: int, path: str,
) -> Row | None:
    """Rank, next usable run, load, forecast, gate, write in template order; returns the run.

    Without a usable run every request takes its fallback.
    """
    spark, run = long.sparkSession, select_run(ledger, stores)
    forecast = spark.createDataFrame([], grouped.FORECAST)
    if run is not None:
        config = next(c for c in families[run.experiment] if c["label"] == run.label)
        ids, version = long.select("unique_id").distinct(), model_store.live(spark, stores[run.experiment], run.label)
        models = model_store.load(version, ids) if version else files.load_models(spark, stores[run.experiment], run.label, ids)
        forecast = grouped.forecast_models(models, long, run.experiment, config, horizon)
    checked_submission(requests, template, forecast, *baselines.fallbacks(long), path)
    return run


def checked_submission(
    requests: DataFrame, template: DataFrame, forecast: DataFrame, by_id: DataFrame, overall: DataFrame, path: str,
) -> DataFrame:
    """Predict, run the gate, write in template order; returns the gate table.

    Nothing is written when a rule is broken.
    """
    predictions = write_once(submit.predict_submission(requests, forecast, by_id, overall), "predictions")
    gate = write_once(submit.prediction_gate(predictions, requests, template), "gate")
    submit.require_gate(gate)
    files.write_submission(restore_order(template, predictions), path)
    return gate.orderBy(F.col("check"))
