"""Run ledger: ranking, selection and the documented fallback."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DIVERGED = 1e12

# Best documented validation error per model family.
DOCUMENTED_RESULTS = {
    "XGBoost": 1692.15,
    "TimesFM": 1815.32,
    "Prophet": 1855.10,
    "N-BEATS": 1858.23,
    "LightGBM": 1769.42,
    "TFT": 2216.19,
    "PatchTST": 2331.97,
    "DLinear": 2555.44,
    "ARIMA": 2657.08,
    "SARIMA": 2115.13,
}


def rank_runs(ledger: DataFrame) -> DataFrame:
    return ledger.orderBy(F.asc_nulls_last("val_wmae"), "seq")


def best_run(ledger: DataFrame) -> DataFrame:
    """Lowest validation error; the earlier run wins a tie."""
    return rank_runs(ledger.filter("val_wmae is not null")).limit(1)


def finished(ledger: DataFrame, limit: float = DIVERGED) -> DataFrame:
    return ledger.filter((F.col("run_status") == "FINISHED") & (F.col("val_wmae") < limit))


def best_per_experiment(ledger: DataFrame, limit: float = DIVERGED) -> DataFrame:
    """One finished, not diverged run per experiment, ranked across experiments."""
    w = W.partitionBy("experiment").orderBy("val_wmae", "seq")
    best = finished(ledger, limit).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return best.orderBy("val_wmae", "experiment")


def with_documented(experiments: DataFrame, ledger: DataFrame, documented: DataFrame) -> DataFrame:
    """Live best run, else the documented value, else the experiment is left out.

    ``experiments`` is (experiment), ``documented`` (experiment, documented_wmae).
    """
    live = best_per_experiment(ledger).select("experiment", "val_wmae", "label", "run_id")
    out = experiments.join(live, "experiment", "left").join(documented, "experiment", "left")
    is_live = F.col("val_wmae").isNotNull()
    return (
        out.withColumn("source", F.when(is_live, "ledger").when(F.col("documented_wmae").isNotNull(), "documented"))
        .withColumn("label", F.when(is_live, F.col("label")).otherwise("documented"))
        .withColumn("val_wmae", F.coalesce("val_wmae", "documented_wmae"))
        .filter("source is not null").drop("documented_wmae")
    )


def next_usable(candidates: DataFrame, artifacts: DataFrame) -> DataFrame:
    """The best-ranked candidate whose artifact can be loaded."""
    usable = candidates.join(artifacts.filter("usable").select("experiment"), "experiment", "left_semi")
    return usable.orderBy("val_wmae", "experiment").limit(1)


def stability_report(ledger: DataFrame, limit: float = DIVERGED) -> DataFrame:
    """Flags runs whose error is missing or astronomically large."""
    stable = F.coalesce((F.col("val_wmae") < limit) & ~F.isnan("val_wmae"), F.lit(False))
    return ledger.withColumn("stable", stable)
