"""Sources and sinks."""

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions.ids import submission_id
from ..models import baselines, grouped
from ..operators import ledger, panel, split, submit
from ..sources import files, model_store, staging, tables
from . import registry as r
from .registry import query, text


def _csv_copy(spark, name, build, **options):
    """The derived table written in the published CSV layout."""
    path = staging.new_path(spark, f"csv-{name}")
    build.write.options(header=True, nullValue="NA", **options).csv(path)
    return path


@query("scan_fact", text(r.panel(), "SELECT Store, Dept, Date, Weekly_Sales, IsHoliday FROM panel"))
def scan_fact(spark, sf_dir):
    path = _csv_copy(spark, "train", tables.staged_fact(spark, sf_dir).select(
        "Store", "Dept", "Date", "Weekly_Sales", "IsHoliday"))
    return files.read_fact(spark, path)


@query("scan_covariates", text(r.covariates(), "SELECT * FROM covariates"))
def scan_covariates(spark, sf_dir):
    path = _csv_copy(spark, "features", tables.staged_covariates(spark, sf_dir))
    return files.read_covariates(spark, path)


@query("scan_stores", text(r.stores(), "SELECT Store, Type, Size FROM stores"))
def scan_stores(spark, sf_dir):
    path = _csv_copy(spark, "stores", tables.staged_stores(spark, sf_dir), lineSep="\r")
    return files.read_stores(spark, path)


TEMPLATE = text(r.panel(), r.CUT, "SELECT unique_id || '_' || strftime(Date, '%Y-%m-%d') AS Id FROM valid")


@query("scan_submission_template", TEMPLATE)
def scan_submission_template(spark, sf_dir):
    _, valid = split.time_split(tables.staged_fact(spark, sf_dir), tables.HORIZON)
    template = valid.select(submission_id().alias("Id"), F.lit(0.0).alias("Weekly_Sales"))
    return files.read_template(spark, _csv_copy(spark, "template", template)).select("Id")


@query("scan_all_merged", text(r.panel(), r.covariates(), r.stores(), r.CUT, """
SELECT p.Store, p.Dept, p.Date, p.IsHoliday, CASE WHEN p.Date < cutoff THEN p.Weekly_Sales END AS Weekly_Sales,
       c.Temperature, c.Fuel_Price, c.MarkDown1, c.MarkDown5, c.CPI, c.Unemployment, s.Type, s.Size,
       CASE WHEN p.Date < cutoff THEN 'train' ELSE 'test' END AS part
FROM panel p CROSS JOIN cut LEFT JOIN covariates c ON p.Store = c.Store AND p.Date = c.Date AND p.IsHoliday = c.IsHoliday
     LEFT JOIN stores s ON p.Store = s.Store"""))
def scan_all_merged(spark, sf_dir):
    train, valid = split.time_split(tables.staged_fact(spark, sf_dir), tables.HORIZON)
    right = tables.staged_covariates(spark, sf_dir), tables.staged_stores(spark, sf_dir)
    train = files.load_merged(train, *right).withColumn("part", F.lit("train"))
    test = files.load_merged(valid.drop("Weekly_Sales"), *right).withColumn("part", F.lit("test"))
    return train.unionByName(test, allowMissingColumns=True).select(
        "Store", "Dept", "Date", "IsHoliday", "Weekly_Sales", "Temperature", "Fuel_Price", "MarkDown1", "MarkDown5",
        "CPI", "Unemployment", "Type", "Size", "part")


@query("holiday_calendar", text(r.panel(), r.HOLIDAYS, """
SELECT holiday, ds, COUNT(unique_id) AS n_series FROM holidays LEFT JOIN panel ON ds = Date GROUP BY holiday, ds"""))
def holiday_calendar(spark, sf_dir):
    events = spark.createDataFrame(
        cal.holiday_dates(tables.FIRST_YEAR, tables.LAST_YEAR), "holiday string, ds date")
    active = tables.staged_fact(spark, sf_dir).groupBy(F.col("Date").alias("ds")).agg(F.count("*").alias("n"))
    return events.join(active, "ds", "left").select("holiday", "ds", F.coalesce("n", F.lit(0)).alias("n_series"))


SEASONAL = """SELECT v.unique_id || '_' || strftime(v.Date, '%Y-%m-%d') AS Id,
       greatest(coalesce(t.Weekly_Sales, b.last_y, median_y), 0.0) AS Weekly_Sales
FROM valid v CROSS JOIN overall LEFT JOIN train t ON t.unique_id = v.unique_id AND t.Date = v.Date - 364
     LEFT JOIN by_id b ON b.unique_id = v.unique_id"""


def seasonal_submission(spark, sf_dir):
    train, valid = split.time_split(tables.staged_fact(spark, sf_dir), tables.HORIZON)
    forecast = baselines.seasonal_naive(train, valid).withColumnRenamed("Date", "ds")
    long = train.select("unique_id", F.col("Date").alias("ds"), F.col("Weekly_Sales").alias("y"))
    return submit.predict_submission(valid, forecast, *baselines.fallbacks(long))


@query("write_submission", text(r.panel(), r.CUT, r.FALLBACKS, SEASONAL))
def write_submission(spark, sf_dir):
    rows = seasonal_submission(spark, sf_dir).withColumn("pos", F.md5("Id"))
    path = staging.new_path(spark, "submission")
    files.write_submission(rows, path)
    return spark.read.schema("Id string, Weekly_Sales double").option("header", True).csv(path)


BASELINES = """
rows AS (
  SELECT p.*, p.Date < cutoff AS is_train, a.Weekly_Sales AS lag_52, b.Weekly_Sales AS lag_104, s.roll_mean_26,
         l.last_y, m.mean_y, median_y,
         CASE WHEN p.Date < cutoff THEN 0 ELSE (p.Date - cutoff) / 7 + 1 END AS h
  FROM panel p CROSS JOIN cut CROSS JOIN overall
       LEFT JOIN train a ON a.unique_id = p.unique_id AND a.Date = p.Date - 364
       LEFT JOIN train b ON b.unique_id = p.unique_id AND b.Date = p.Date - 728
       LEFT JOIN spine s ON s.unique_id = p.unique_id AND s.Date = p.Date - 364
       LEFT JOIN by_id l ON l.unique_id = p.unique_id
       LEFT JOIN (SELECT unique_id, AVG(Weekly_Sales) AS mean_y FROM train GROUP BY unique_id) m ON m.unique_id = p.unique_id),
scored AS (
  SELECT seq, experiment, label, regime, unique_id, Date, IsHoliday, is_train, Weekly_Sales AS y,
         CASE label WHEN 'seasonal_52' THEN lag_52 WHEN 'seasonal_104' THEN lag_104 WHEN 'smooth_52' THEN roll_mean_26
              WHEN 'last_value' THEN last_y WHEN 'series_mean' THEN mean_y WHEN 'overall_median' THEN median_y
              ELSE last_y * pow(2.0, h) END AS raw, coalesce(raw, last_y, median_y) AS prediction
  FROM rows CROSS JOIN (VALUES (0, 'Seasonal', 'seasonal_52', 'balanced'), (1, 'Seasonal', 'seasonal_104', 'underfit'),
    (2, 'Seasonal', 'smooth_52', 'balanced'), (3, 'Constant', 'last_value', 'underfit'),
    (4, 'Constant', 'series_mean', 'underfit'), (5, 'Constant', 'overall_median', 'underfit'),
    (6, 'Growth', 'doubling', 'overfit')) AS runs(seq, experiment, label, regime)),
errors AS (
  SELECT seq, experiment, label, regime,
    SUM(CASE WHEN is_train THEN (CASE WHEN IsHoliday THEN 5.0 ELSE 1.0 END) * abs(y - prediction) END)::DOUBLE
      / SUM(CASE WHEN is_train THEN (CASE WHEN IsHoliday THEN 5.0 ELSE 1.0 END) END)::DOUBLE AS train_wmae,
    SUM(CASE WHEN NOT is_train THEN (CASE WHEN IsHoliday THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END) * abs(y - prediction) END)
      / SUM(CASE WHEN NOT is_train THEN (CASE WHEN IsHoliday THEN 5.0 ELSE 1.0 END) END)::DOUBLE AS val_wmae,
    COUNT(DISTINCT CASE WHEN NOT is_train AND raw IS NULL THEN unique_id END) AS fallback_series,
    COUNT(DISTINCT CASE WHEN NOT is_train THEN unique_id END) AS series
  FROM scored GROUP BY ALL),
ledger AS (
  SELECT CAST(seq AS INTEGER) AS seq, experiment, label, regime, train_wmae, val_wmae,
         (val_wmae - train_wmae) / NULLIF(train_wmae, 0) * 100 AS gap_pct, fallback_series,
         CASE WHEN gap_pct IS NULL THEN 'unknown' WHEN gap_pct > 25 THEN 'overfit' WHEN gap_pct < -10 THEN 'underfit'
              ELSE 'good' END AS status,
         CASE WHEN fallback_series * 2 > series THEN 'FAILED' ELSE 'FINISHED' END AS run_status,
         substr(md5(label), 1, 12) AS run_id
  FROM errors)"""
LEDGER = [r.panel("dense"), r.CUT, r.FALLBACKS, r.SPINE.format(source="train"), BASELINES]


def build_ledger(spark, sf_dir):
    """Ledger of the baseline sweep on the dense panel, run once per session."""
    def build():
        fact = tables.staged_fact(spark, sf_dir, "dense")
        return baselines.baseline_ledger(fact, split.cutoff_value(fact, tables.HORIZON))
    return staging.staged(spark, ("ledger", sf_dir), build)


def small(c):
    """Rounded for comparison; a diverged figure is shown as its order of magnitude."""
    return F.when(F.abs(F.col(c)) < ledger.DIVERGED, F.round(c, 2)).otherwise(F.floor(F.log10(c)).cast("double"))


def shown(df, *extra):
    return df.select("experiment", "label", small("val_wmae").alias("val_wmae"), *extra)


SHOWN = "experiment, label, CASE WHEN val_wmae < 1e12 THEN round(val_wmae, 2) ELSE floor(log10(val_wmae)) END AS val_wmae"


@query("write_run_results", text(*LEDGER, f"SELECT {SHOWN}, regime, status, run_id FROM ledger"))
def write_run_results(spark, sf_dir):
    path = staging.new_path(spark, "results")
    runs = build_ledger(spark, sf_dir)
    files.write_run_results(runs.filter("regime = 'balanced'"), path)
    files.write_run_results(runs.filter("regime <> 'balanced'"), path)
    return shown(files.read_run_results(spark, path), "regime", "status", "run_id")


@query("scan_run_ledger", text(*LEDGER, f"SELECT {SHOWN}, run_id FROM ledger ORDER BY ledger.val_wmae, seq LIMIT 1"))
def scan_run_ledger(spark, sf_dir):
    path = staging.new_path(spark, "results")
    files.write_run_results(build_ledger(spark, sf_dir), path)
    return shown(ledger.best_run(files.read_run_results(spark, path)), "run_id")


# A model of one coefficient, last year's week times a factor: closed form, and out of reach of short series.
MEMORY = {"label": "seasonal_memory", "regime": "plain", "order": [0, 0, 0], "seasonal_order": [1, 0, 0, 52], "trend": "n"}


def published(spark, sf_dir):
    """(train, valid, root of a store with one published version)."""
    train, valid = split.time_split(tables.staged_fact(spark, sf_dir), tables.HORIZON)
    long = staging.write_once(panel.to_long(train), "long")
    root = staging.new_path(spark, "store")
    model_store.publish(grouped.final_refit(long, "SARIMA", MEMORY), root, "SARIMA", MEMORY, *baselines.fallbacks(long))
    return long, valid, root


STORED = [r.panel(), r.CUT, r.FALLBACKS, r.SPINE.format(source="train"), r.KNOWN, """
years AS (SELECT unique_id, y, lag(y, 52) OVER (PARTITION BY unique_id ORDER BY Date) AS x FROM filled),
models AS (SELECT unique_id, COUNT(*) >= 61 AS ok, least(greatest(SUM(x * y) / SUM(x * x), -tanh(4)), tanh(4)) AS factor FROM years GROUP BY unique_id)"""]


@query("model_artifact_store", text(*STORED, """
SELECT 'SARIMA' AS family, 'seasonal_memory' AS label, '{"order": [0, 0, 0], "seasonal_order": [1, 0, 0, 52], "trend": "n"}' AS params,
  unique_id, CASE WHEN ok THEN round(factor, 9) END AS factor, CASE WHEN ok THEN 'fitted' ELSE 'failed' END AS status, last_y, median_y,
  (SELECT COUNT(*) FROM models WHERE ok) AS n_fitted, (SELECT COUNT(*) FROM models WHERE NOT ok) AS n_failed
FROM models JOIN by_id USING (unique_id) CROSS JOIN overall"""))
def model_artifact_store(spark, sf_dir):
    """Every row of the live version with what its manifest says."""
    _, _, root = published(spark, sf_dir)
    row, models = model_store.live(spark, root)
    named = [F.lit(row[c]).cast(k).alias(c) for k, names in (("string", ("family", "label", "params")), ("double", ("median_y",)), ("bigint", ("n_fitted", "n_failed")))
             for c in names]
    return models.select(*named, "unique_id", F.round(F.col("coefs")[0], 9).alias("factor"), "status", "last_y")


@query("model_artifact_load", text(*STORED, """
past AS (SELECT unique_id, Date, y FROM filled),
ends AS (SELECT unique_id, MAX(Date) AS last_d FROM filled GROUP BY unique_id)""", """
SELECT v.unique_id, coalesce(ok, FALSE) AS loaded,
  round(CASE WHEN ok THEN factor * p.y ELSE coalesce(last_y, median_y) END, 2) AS next_week
FROM (SELECT DISTINCT unique_id FROM valid) v CROSS JOIN overall LEFT JOIN models m ON m.unique_id = v.unique_id LEFT JOIN by_id b ON b.unique_id = v.unique_id
     LEFT JOIN ends e ON e.unique_id = v.unique_id LEFT JOIN past p ON p.unique_id = v.unique_id AND p.Date = e.last_d - 357"""))
def model_artifact_load(spark, sf_dir):
    """Next week of every requested series from the live version, or its fallback; a later version without its parts is passed over."""
    long, valid, root = published(spark, sf_dir)
    row = model_store.manifests(spark, root)[0]
    newer = row.asDict() | {"run_id": "lost", "published": row.published + 1}
    spark.createDataFrame([tuple(newer.values())], model_store.MANIFEST).write.mode("append").parquet(f"{root}/manifest")
    models = model_store.load(model_store.live(spark, root), valid.select("unique_id").distinct())
    ahead = grouped.forecast_models(models.where("loaded"), long, "SARIMA", MEMORY, 1).select("unique_id", "prediction")
    out = models.join(ahead, "unique_id", "left")
    return out.select("unique_id", "loaded", F.round(F.coalesce("prediction", "fallback"), 2).alias("next_week"))
