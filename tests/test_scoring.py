import datetime as dt

import pytest
from conftest import friday
from pyspark.sql import functions as F

from panelcast.functions.scalars import abs_error
from panelcast.models.grids import FAMILIES
from panelcast.operators import aggregates, joins, ledger, metrics, submit
from panelcast.plans import inference
from panelcast.sources import files, staging

SCORED = "y double, prediction double, IsHoliday boolean"


def test_wmae_counts_the_weight_of_missing_predictions(spark):
    df = spark.createDataFrame([(10.0, 7.0, True), (10.0, None, True), (4.0, 5.0, False), (4.0, 6.0, None)], SCORED)
    assert metrics.wmae(df).first()[0] == (5 * 3 + 1 + 2) / 12


def test_wmae_is_mae_without_holidays(spark):
    df = spark.createDataFrame([(1.0, 2.0, False), (5.0, 2.0, False)], SCORED)
    assert metrics.wmae(df).first()[0] == df.agg(F.avg(abs_error("y", "prediction"))).first()[0]


def test_train_val_report(spark):
    rows = [("a", True, 10.0, 8.0, False), ("a", False, 10.0, 7.0, False), ("b", True, 1.0, 1.0, False), ("b", False, 1.0, 2.0, True)]
    df = spark.createDataFrame(rows, "label string, is_train boolean, y double, prediction double, IsHoliday boolean")
    got = {r.label: (r.train_wmae, r.val_wmae, r.gap_pct, r.status) for r in metrics.train_val_report(df).collect()}
    assert got == {"a": (2.0, 3.0, 50.0, "overfit"), "b": (0.0, 1.0, None, "unknown")}


def test_plausible_forecast(spark):
    history = spark.createDataFrame([(k, v) for k in "abcde" for v in (1.0, -2.0)] + [("n", float("nan")), ("n", 3.0)], "unique_id string, y double")
    forecast = spark.createDataFrame(
        [("a", 100.0), ("b", 1e17), ("c", float("nan")), ("c", 1.0), ("d", float("inf")), ("n", 150.0)], "unique_id string, prediction double")
    got = dict(map(tuple, metrics.plausible(forecast, history).collect()))
    assert got == {"a": True, "b": False, "c": False, "d": False, "e": False, "n": True}


def test_worst_series_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(1, 2, 5.0, 0.0), (1, 1, 5.0, 0.0), (2, 1, 9.0, 0.0), (3, 1, 1.0, None)], "Store int, Dept int, y double, prediction double")
    assert [(r.Store, r.Dept) for r in metrics.worst_series(df, 3).collect()] == [(2, 1), (1, 1), (1, 2)]


def test_last_value_skips_missing(spark):
    df = spark.createDataFrame([("a", friday(0), 1.0), ("a", friday(1), None), ("b", friday(0), None)], "unique_id string, ds date, y double")
    assert list(map(tuple, aggregates.last_value_by_series(df).collect())) == [("a", 1.0)]


def test_step_metrics_of_an_empty_log_are_zero(spark):
    empty = spark.createDataFrame([], "step long, grad_total_norm double, grad_max_norm double, grad_nonfinite_count int")
    assert tuple(aggregates.step_metric_summary(empty).first()) == (0.0,) * 6


RUNS = "seq int, experiment string, label string, regime string, val_wmae double, run_status string, run_id string"


@pytest.fixture
def runs(spark):
    return spark.createDataFrame([
        (0, "A", "a0", "x", 5.0, "FINISHED", "r0"), (1, "A", "a1", "x", 3.0, "FINISHED", "r1"), (2, "A", "a2", "x", 3.0, "FINISHED", "r2"),
        (3, "B", "b0", "x", 1.0, "FAILED", "r3"), (4, "B", "b1", "x", 4.0, "FINISHED", "r4"),
        (5, "C", "c0", "x", 7.7e102, "FINISHED", "r5"), (6, "C", "c1", "x", None, "FINISHED", "r6")], RUNS)


def test_selection(spark, runs):
    assert ledger.best_run(runs.filter("experiment = 'A'")).first().label == "a1"
    assert [r.label for r in ledger.best_per_experiment(runs).collect()] == ["a1", "b1"]
    documented = spark.createDataFrame([("C", 6.0), ("D", 2.0)], "experiment string, documented_wmae double")
    names = spark.createDataFrame([(x,) for x in "ABCDE"], "experiment string")
    got = {r.experiment: (r.val_wmae, r.source) for r in ledger.with_documented(names, runs, documented).collect()}
    assert got == {"A": (3.0, "ledger"), "B": (4.0, "ledger"), "C": (6.0, "documented"), "D": (2.0, "documented")}
    artifacts = spark.createDataFrame([("A", False), ("B", True)], "experiment string, usable boolean")
    assert ledger.next_usable(ledger.best_per_experiment(runs), artifacts).first().label == "b1"
    assert {r.label for r in ledger.stability_report(runs).filter("not stable").collect()} == {"c0", "c1"}
    assert inference.candidates(runs, {"D": 2.0}).first().experiment == "D"


def _submission(spark, rows, schema="Id string, Weekly_Sales double"):
    return spark.createDataFrame(rows, schema)


GOOD = [("1_1_2012-11-02", 1.0), ("1_1_2012-11-09", 0.0)]


@pytest.mark.parametrize("rows, schema, broken", [
    (GOOD, "Id string, Weekly_Sales double", set()),
    (GOOD, "Id string, Sales double", None),
    (GOOD[:1], "Id string, Weekly_Sales double", {"row_count", "missing_ids"}),
    ([GOOD[0], (GOOD[1][0], None)], "Id string, Weekly_Sales double", {"not_null"}),
    ([GOOD[0], (GOOD[1][0], float("nan"))], "Id string, Weekly_Sales double", {"not_null"}),
    ([GOOD[0], (GOOD[1][0], -1.0)], "Id string, Weekly_Sales double", {"nonnegative"}),
    ([GOOD[0], ("9_9_2012-11-09", 1.0)], "Id string, Weekly_Sales double", {"missing_ids", "extra_ids"}),
])
def test_each_gate_rule(spark, rows, schema, broken):
    template = _submission(spark, GOOD).select("Id")
    requests = spark.createDataFrame([(1, 1, dt.date(2012, 11, 2)), (1, 1, dt.date(2012, 11, 9))], "Store int, Dept int, Date date")
    predictions = _submission(spark, rows, schema)
    if broken is None:
        gate = submit.prediction_gate(predictions.withColumn("Weekly_Sales", F.col("Sales")), requests, template)
        broken = {"columns"}
    else:
        gate = submit.prediction_gate(predictions, requests, template)
    assert {r["check"] for r in gate.filter("not ok").collect()} == broken
    if broken:
        with pytest.raises(ValueError, match="rejected"):
            submit.require_gate(gate)
    else:
        submit.require_gate(gate)


def test_submission_fallbacks_clip_and_file_order(spark):
    requests = spark.createDataFrame(
        [(1, 1, friday(0)), (1, 1, friday(1)), (1, 2, friday(0)), (2, 1, friday(0))], "Store int, Dept int, Date date")
    forecast = spark.createDataFrame([("1_1", friday(0), -5.0), ("1_1", friday(1), float("nan"))], "unique_id string, ds date, prediction double")
    by_id = spark.createDataFrame([("1_1", 4.0), ("1_2", 6.0)], "unique_id string, last_y double")
    overall = spark.createDataFrame([(9.0,)], "median_y double")
    ids = [f"1_1_{friday(1)}", f"2_1_{friday(0)}", f"1_2_{friday(0)}", f"1_1_{friday(0)}"]
    template_path, out = staging.new_path(spark, "t"), staging.new_path(spark, "s")
    spark.createDataFrame([(i, 0.0) for i in ids], "Id string, Weekly_Sales double").coalesce(1).write.option("header", True).csv(template_path)
    template = files.read_template(spark, template_path)
    gate = inference.checked_submission(requests, template, forecast, by_id, overall, out)
    assert gate.filter("not ok").count() == 0
    lines = []
    for part in sorted(p for p in __import__("os").listdir(out) if p.startswith("part-")):
        with open(f"{out}/{part}") as f:
            lines += [x.strip() for x in f if not x.startswith("Id,")]
    assert lines == [f"{ids[0]},4.0", f"{ids[1]},9.0", f"{ids[2]},6.0", f"{ids[3]},0.0"]


def test_readers_handle_na_nan_and_carriage_returns(spark, tmp_path):
    (tmp_path / "train.csv").write_text("Store,Dept,Date,Weekly_Sales,IsHoliday\n1,2,2010-02-05,24924.5,FALSE\n1,2,2010-02-12,NaN,TRUE\n1,2,2010-02-19,NA,\n")
    (tmp_path / "stores.csv").write_text("Store,Type,Size\r1,A,151315\r2,C,42\r")
    got = files.read_fact(spark, str(tmp_path / "train.csv")).orderBy("Date").collect()
    assert [(r.Weekly_Sales, r.IsHoliday) for r in got] == [(24924.5, False), (None, True), (None, None)]
    assert [tuple(r) for r in files.read_stores(spark, str(tmp_path / "stores.csv")).orderBy("Store").collect()] == [(1, "A", 151315), (2, "C", 42)]


def test_model_store_round_trip(spark):
    path = staging.new_path(spark, "m")
    models = spark.createDataFrame([("m", "1_1", [1.0, 2.0], "fitted"), ("m", "1_2", None, "failed"), ("n", "1_1", [3.0], "fitted")],
                                   "label string, unique_id string, coefs array<double>, status string")
    files.write_models(models, path)
    ids = spark.createDataFrame([("1_1",), ("1_2",), ("7_7",)], "unique_id string")
    got = {r.unique_id: r.coefs for r in files.load_models(spark, path, "m", ids).collect()}
    assert got == {"1_1": [1.0, 2.0], "1_2": None, "7_7": None}
    files.write_models(models.filter("label = 'm'").withColumn("status", F.lit("failed")), path)  # a rerun of one label
    assert files.load_models(spark, path, "m", ids).where("coefs is null").count() == 3
    assert files.load_models(spark, path, "n", ids).where("coefs is not null").count() == 1


def test_selection_skips_runs_without_stored_models(spark):
    ledger = spark.createDataFrame(
        [("A", "a1", 1.0, "FINISHED"), ("B", "b1", 2.0, "FINISHED"), ("C", "c2", 3.0, "FINISHED"), ("C", "c1", 2.5, "FAILED")],
        "experiment string, label string, val_wmae double, run_status string").withColumns({"seq": F.col("label"), "run_id": F.col("label")})
    stored = "label string, unique_id string, coefs array<double>, status string"
    b, c = staging.new_path(spark, "b"), staging.new_path(spark, "c")
    files.write_models(spark.createDataFrame([("b1", "1_1", None, "failed"), ("b9", "1_1", [1.0], "fitted")], stored), b)
    files.write_models(spark.createDataFrame([("c1", "1_1", [1.0], "fitted"), ("c2", "1_1", [1.0], "fitted")], stored), c)
    run = inference.select_run(ledger, {"A": staging.new_path(spark, "a"), "B": b, "C": c})
    assert (run.experiment, run.label) == ("C", "c2")
    assert inference.select_run(ledger, {"B": b}) is None


def test_holiday_join_defaults_to_false(spark):
    oof = spark.createDataFrame([("a", friday(0)), ("a", friday(1)), ("a", friday(2))], "unique_id string, ds date")
    flags = spark.createDataFrame([("a", friday(0), True), ("a", friday(1), None)], "unique_id string, ds date, IsHoliday boolean")
    out = joins.join_holidays(oof, joins.holiday_lookup(flags)).orderBy("ds").collect()
    assert [r.IsHoliday for r in out] == [True, False, False]


def test_grid_sizes():
    sizes = {name: len(make()) for name, make in FAMILIES.items()}
    assert (sizes["ARIMA"], sizes["SARIMA"], sizes["Additive"], sizes["CovariateRidge"]) == (30, 16, 15, 20)
    for make in FAMILIES.values():
        labels = [c["label"] for c in make()]
        assert len(labels) == len(set(labels))


def test_staged_table_is_built_once_and_again_when_gone(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert staging.staged(spark, ("t", "once"), build).count() == staging.staged(spark, ("t", "once"), build).count() == 3
    assert len(calls) == 1
    key = (spark.sparkContext.applicationId, "t", "once")
    path, schema = staging._tables[key]
    staging._tables[key] = path + "-gone", schema
    assert staging.staged(spark, ("t", "once"), build).count() == 3 and len(calls) == 2


def test_each_job_runs_end_to_end(spark):
    import numpy as np

    from panelcast.models import grids
    from panelcast.operators import panel
    from panelcast.plans import series_models

    rng = np.random.default_rng(8)
    rows = [(f"{s}_{d}", friday(i), float(100 * s + 10 * d + 20 * np.sin(i / 8.3) + rng.normal())) for s in range(1, 5) for d in (1, 2) for i in range(150)]
    long = spark.createDataFrame(rows + [("9_9", friday(0), 1.0)], "unique_id string, ds date, y double")
    configs = grids.pick(grids.additive(), "underfit_1", "balanced_1")
    report = series_models.sweep(long, 39, "Additive", configs, 8).collect()
    assert {r.label for r in report} == {"underfit_1", "balanced_1"} and all(r.val_wmae > 0 for r in report)
    models = series_models.refit(long, 39, "Additive", configs[1])
    assert models.filter("status = 'fitted'").count() == 8 and panel.last_date(long).count() == 9
