"""Evaluation, selection and data quality."""

from pyspark.sql import functions as F

from ..functions import ids
from ..models import baselines
from ..operators import joins, ledger, metrics, split, submit
from ..sources import staging, tables
from . import registry as r
from .aggregates import RAW, raw_seasonal
from .joins import DIFF, template_and_predicted
from .registry import query, text
from .scans import LEDGER, SEASONAL, SHOWN, build_ledger, seasonal_submission, shown, small


def _fact(spark, sf_dir, grain="ragged"):
    return tables.staged_fact(spark, sf_dir, grain)


@query("evaluate_forecast", text(r.panel(), r.CUT, RAW, """
SELECT Dept, CAST(SUM((CASE WHEN IsHoliday THEN 5 ELSE 1 END) * abs(Weekly_Sales - prediction)) AS DOUBLE)
  / CAST(SUM(CASE WHEN IsHoliday THEN 5 ELSE 1 END) AS DOUBLE) AS wmae FROM raw GROUP BY Dept"""))
def evaluate_forecast(spark, sf_dir):
    oof = raw_seasonal(spark, sf_dir).withColumnRenamed("Date", "ds").drop("IsHoliday")
    holidays = joins.holiday_lookup(_fact(spark, sf_dir).withColumnRenamed("Date", "ds"))
    return metrics.evaluate_forecast(oof, holidays, ["Dept"])


def _magnitude(c):
    return f"CASE WHEN abs({c}) < 1e12 THEN round({c}, 2) ELSE floor(log10({c})) END AS {c}"


@query("train_val_report", text(*LEDGER, f"""
SELECT label, {_magnitude('train_wmae')}, {_magnitude('val_wmae')}, {_magnitude('gap_pct')}, status FROM ledger"""))
def train_val_report(spark, sf_dir):
    fact = _fact(spark, sf_dir, "dense")
    scored = baselines.baseline_predictions(fact, split.cutoff_value(fact, tables.HORIZON))
    return metrics.train_val_report(scored).withColumns({c: small(c) for c in ("train_wmae", "val_wmae", "gap_pct")})


@query("fallback_flagging", text(r.panel(), r.CUT, RAW, "SELECT unique_id, Date, prediction IS NULL AS used_fallback FROM raw"))
def fallback_flagging(spark, sf_dir):
    return metrics.flag_fallback(raw_seasonal(spark, sf_dir)).select("unique_id", "Date", "used_fallback")


@query("holiday_vs_nonholiday", text(r.panel(), r.CUT, RAW, """
SELECT IsHoliday, AVG(abs(Weekly_Sales - prediction)) AS mae, COUNT(*) AS n FROM raw GROUP BY IsHoliday"""))
def holiday_vs_nonholiday(spark, sf_dir):
    return metrics.mae_by(raw_seasonal(spark, sf_dir), ["IsHoliday"])


# The template is last year's rows moved a year ahead, so ids are missing and extra.
@query("prediction_gate", text(*DIFF, r.FALLBACKS, f"submission AS ({SEASONAL})", """
facts AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (Weekly_Sales IS NULL) AS nulls, COUNT(*) FILTER (Weekly_Sales < 0) AS neg,
  (SELECT COUNT(*) FROM valid) AS expected,
  (SELECT COUNT(*) FROM predicted WHERE Id NOT IN (SELECT Id FROM submission)) AS missing,
  (SELECT COUNT(*) FROM submission WHERE Id NOT IN (SELECT Id FROM predicted)) AS extra FROM submission),
checks AS (SELECT unnest(['columns', 'row_count', 'not_null', 'nonnegative', 'missing_ids', 'extra_ids']) AS "check",
                  unnest([0, abs(n - expected), nulls, neg, missing, extra]) AS n_bad FROM facts)""", """
SELECT "check", n_bad = 0 AS ok, CAST(n_bad AS BIGINT) AS n_bad FROM checks"""))
def prediction_gate(spark, sf_dir):
    valid, moved = template_and_predicted(spark, sf_dir)
    predictions = staging.write_once(seasonal_submission(spark, sf_dir), "predictions")
    return submit.prediction_gate(predictions, valid, moved.select(ids.submission_id().alias("Id")))


BEST = """best AS (SELECT * FROM ledger WHERE run_status = 'FINISHED' AND val_wmae < 1e12
  QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY val_wmae, seq) = 1)"""
DOCUMENTED = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in ledger.DOCUMENTED_RESULTS.items())


@query("documented_fallback", text(*LEDGER, BEST, f"""
documented AS (SELECT * FROM (VALUES {DOCUMENTED}) AS d(experiment, documented_wmae)),
experiments AS (SELECT DISTINCT experiment FROM ledger UNION SELECT experiment FROM documented)""", """
SELECT e.experiment, round(coalesce(b.val_wmae, documented_wmae), 2) AS val_wmae, coalesce(b.label, 'documented') AS label,
       b.run_id, CASE WHEN b.val_wmae IS NOT NULL THEN 'ledger' ELSE 'documented' END AS source
FROM experiments e LEFT JOIN best b ON b.experiment = e.experiment LEFT JOIN documented d ON d.experiment = e.experiment
WHERE b.val_wmae IS NOT NULL OR documented_wmae IS NOT NULL"""))
def documented_fallback(spark, sf_dir):
    runs = build_ledger(spark, sf_dir)
    documented = spark.createDataFrame(
        list(ledger.DOCUMENTED_RESULTS.items()), "experiment string, documented_wmae double")
    experiments = runs.select("experiment").union(documented.select("experiment")).distinct()
    out = ledger.with_documented(experiments, runs, documented)
    return out.withColumn("val_wmae", F.round("val_wmae", 2))


@query("select_best_model", text(*LEDGER, BEST, f"SELECT {SHOWN}, run_id FROM best AS ledger ORDER BY ledger.val_wmae, experiment"))
def select_best_model(spark, sf_dir):
    return shown(ledger.best_per_experiment(build_ledger(spark, sf_dir)), "run_id")


# An experiment's artifact counts as usable when none of its runs needed the fallback.
@query("next_best_on_failure", text(*LEDGER, BEST, """
usable AS (SELECT experiment FROM ledger GROUP BY experiment HAVING SUM(fallback_series) = 0)""", f"""
SELECT {SHOWN} FROM best AS ledger WHERE experiment IN (SELECT experiment FROM usable)
ORDER BY ledger.val_wmae, experiment LIMIT 1"""))
def next_best_on_failure(spark, sf_dir):
    runs = build_ledger(spark, sf_dir)
    artifacts = runs.groupBy("experiment").agg((F.sum("fallback_series") == 0).alias("usable"))
    return shown(ledger.next_usable(ledger.best_per_experiment(runs), artifacts))


@query("stability_report", text(*LEDGER, f"SELECT {SHOWN}, ledger.val_wmae < 1e12 AS stable FROM ledger"))
def stability_report(spark, sf_dir):
    return shown(ledger.stability_report(build_ledger(spark, sf_dir)), "stable")
