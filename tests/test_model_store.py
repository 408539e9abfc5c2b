import glob
import os

from pyspark.sql import functions as F

from panelcast.operators.ledger import rank_runs
from panelcast.plans import inference
from panelcast.sources import model_store, staging

STORED = "unique_id string, coefs array<double>, status string"
CONFIG = {"label": "m", "regime": "r", "order": [1, 0, 0]}


def fallbacks(spark):
    return spark.createDataFrame([("1_1", 1.0), ("1_2", 2.0), ("9_9", None)], "unique_id string, last_y double"), spark.createDataFrame([(7.0,)], "median_y double")


def publish(spark, root, value, label="m"):
    models = spark.createDataFrame([("1_1", [value], "fitted"), ("1_2", None, "failed")], STORED)
    return model_store.publish(models, root, "ARIMA", {**CONFIG, "label": label}, *fallbacks(spark))


def test_the_latest_version_is_live(spark):
    root = staging.new_path(spark, "store")
    assert model_store.live(spark, root) is None and model_store.live_labels(spark, root) == []
    first = publish(spark, root, 1.0)
    second = publish(spark, root, 2.0)
    version = model_store.live(spark, root)
    assert version.manifest.run_id == second != first
    row = version.manifest
    assert (row.family, row.label, row.params, row.n_series, row.n_fitted, row.n_failed, row.median_y) == ("ARIMA", "m", '{"order": [1, 0, 0]}', 3, 1, 2, 7.0)
    ids = spark.createDataFrame([("1_1",), ("1_2",), ("9_9",), ("5_5",)], "unique_id string")
    got = {r.unique_id: (r.coefs, r.fallback, r.loaded) for r in model_store.load(version, ids).collect()}
    assert got == {"1_1": ([2.0], 1.0, True), "1_2": (None, 2.0, False), "9_9": (None, 7.0, False), "5_5": (None, 7.0, False)}


def test_a_half_written_or_damaged_version_is_not_served(spark):
    root = staging.new_path(spark, "store")
    good = publish(spark, root, 1.0)
    # parts without a manifest row: the job died before it was published
    spark.createDataFrame([("1_1", [5.0], "fitted", None)], model_store.PARTS).write.parquet(f"{root}/parts/run=dead")
    assert model_store.live(spark, root).manifest.run_id == good
    # a manifest row without its parts
    row = model_store.manifests(spark, root)[0].asDict()
    spark.createDataFrame([tuple({**row, "run_id": "gone", "published": row["published"] + 1}.values())], model_store.MANIFEST).write.mode("append").parquet(f"{root}/manifest")
    assert model_store.live(spark, root).manifest.run_id == good
    # other rows than were counted
    other = publish(spark, root, 2.0)
    assert model_store.live(spark, root).manifest.run_id == other
    spark.createDataFrame([("1_1", [3.0], "fitted", None)], model_store.PARTS).write.mode("append").parquet(f"{root}/parts/run={other}")
    assert model_store.live(spark, root).manifest.run_id == good
    # a part that cannot be read
    last = publish(spark, root, 4.0)
    for path in glob.glob(f"{root.removeprefix('file:')}/parts/run={last}/part-*"):
        with open(path, "wb") as f:
            f.write(b"no parquet")
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert model_store.live(spark, root).manifest.run_id == good
    assert model_store.live_labels(spark, root) == ["m"]


def test_selection_passes_over_a_lost_winner(spark):
    ledger = spark.createDataFrame([(0, "A", "a1", 1.0, "FINISHED", "x"), (1, "B", "b1", 2.0, "FINISHED", "y")],
                                   "seq int, experiment string, label string, val_wmae double, run_status string, run_id string")
    a, b = staging.new_path(spark, "a"), staging.new_path(spark, "b")
    publish(spark, a, 1.0, "a1")
    publish(spark, b, 1.0, "b1")
    assert inference.select_run(ledger, {"A": a, "B": b}).label == "a1"
    run = model_store.manifests(spark, a)[0].run_id
    spark.createDataFrame([("7_7", [3.0], "fitted", None)], model_store.PARTS).write.mode("append").parquet(f"{a}/parts/run={run}")
    assert inference.select_run(ledger, {"A": a, "B": b}).label == "b1"
    assert rank_runs(ledger.withColumn("val_wmae", F.lit(1.0))).first().label == "a1"
