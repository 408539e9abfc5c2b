import numpy as np
import pytest
from conftest import friday
from pyspark.sql import functions as F

from panelcast import schemas
from panelcast.models import gbt, grids
from panelcast.operators.metrics import wmae_expr
from panelcast.plans import global_model

KEYS = ("Store", "Dept")


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        x = {c: float(rng.integers(0, 9)) for c in schemas.CALENDAR_FEATURES}
        x.update(Store=int(i % 3), Dept=int(i % 4), lag_52=None if i % 5 == 0 else float(i % 11), IsHoliday=float(i % 10 == 0))
        rows.append((friday(i // 12), *[x[c] for c in schemas.CALENDAR_FEATURES], 100.0 * (i % 3) + 7 * x["Month"] + float(rng.normal())))
    kinds = ", ".join(f"{c} {'int' if c in KEYS else 'double'}" for c in schemas.CALENDAR_FEATURES)
    df = spark.createDataFrame(rows, f"Date date, {kinds}, Weekly_Sales double")
    return df.filter(F.col("Date") < F.lit(friday(25))), df.filter(F.col("Date") >= F.lit(friday(25)))


BASE = {"max_depth": 3, "learning_rate": 0.3, "min_child_samples": 2, "subsample": 0.8, "num_leaves": 31}


def test_prefixes_are_the_smaller_models(parts):
    train, valid = parts
    table, pipeline, bins = gbt.prepare(train, schemas.CALENDAR_FEATURES, KEYS)
    table.cache()
    held_out = gbt.vectors(pipeline, valid, schemas.CALENDAR_FEATURES, KEYS, keep=["IsHoliday"])
    large = gbt.fit_trees(table, {**BASE, "n_estimators": 6}, bins)
    errors = gbt.prefix_errors(large, held_out)
    assert len(errors) == 6
    for n in (1, 3, 6):
        small = gbt.fit_trees(table, {**BASE, "n_estimators": n}, bins)
        want = small.transform(held_out).agg(wmae_expr("Weekly_Sales", "prediction", F.col("IsHoliday").cast("boolean"))).first()[0]
        assert errors[n - 1] == pytest.approx(want, rel=1e-9)


def test_groups_differ_in_the_number_of_trees_alone():
    configs = grids.trees()
    groups = gbt.nested(configs)
    assert sum(map(len, groups)) == len(configs) == 24 and len(groups) == 15
    assert all(len({(c["max_depth"], c["learning_rate"], c["subsample"]) for c in g}) == 1 and g[0]["n_estimators"] == max(c["n_estimators"] for c in g)
               for g in groups)


def test_sweep_keeps_going_past_a_failing_fit(spark, parts):
    configs = [{"label": "a", "regime": "r", **BASE, "n_estimators": 2}, {"label": "bad", "regime": "r", **BASE, "n_estimators": 2, "learning_rate": -1.0},
               {"label": "b", "regime": "r", **BASE, "n_estimators": 4}]
    ledger = global_model.sweep(*parts, configs)
    rows = {r.label: r for r in ledger.collect()}
    assert [rows[c["label"]].seq for c in configs] == [0, 1, 2]
    assert rows["bad"].run_status == "FAILED" and rows["bad"].val_wmae is None
    assert rows["a"].run_status == rows["b"].run_status == "FINISHED" and rows["b"].train_wmae < rows["a"].train_wmae
    assert rows["a"].params["changed"] == "num_leaves" and len({r.run_id for r in rows.values()}) == 3
    label, pipeline, model = global_model.refit_best(ledger, configs, parts[0].unionByName(parts[1]))
    assert label in ("a", "b") and model.getNumTrees == {"a": 2, "b": 4}[label]


def test_holiday_weight_counts_in_the_weighted_family(spark):
    rows = [(float(i % 2), float(i % 3 == 0), 10.0 if i % 3 == 0 else 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, IsHoliday double, Weekly_Sales double")
    table, _, bins = gbt.prepare(df, ["a"])
    plain, weighted = (gbt.fit_trees(table, {"n_estimators": 1, "max_depth": 1}, bins, w) for w in (False, True))
    mean = [m.transform(table).agg(F.avg("prediction")).first()[0] for m in (plain, weighted)]
    assert mean[0] == pytest.approx(10 / 3, abs=0.2) and mean[1] == pytest.approx(50 / 7, abs=0.2)
