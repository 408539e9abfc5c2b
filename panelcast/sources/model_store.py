"""Fitted models as versions: parts under the run's own key, a manifest row published after them.

A version counts from the moment its manifest row exists.  Readers take the latest version whose
parts still are what the row says, so a half-written, lost or damaged one is passed over.
"""

import json
import time
import uuid
from collections.abc import Mapping
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

PARTS = "unique_id string, coefs array<double>, status string, last_y double"
MANIFEST = ("run_id string, family string, label string, params string, n_series bigint, n_fitted bigint, n_failed bigint, digest bigint, "
            "median_y double, published bigint")


class Version(NamedTuple):
    manifest: Row
    models: DataFrame


def _parts(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    return spark.read.schema(PARTS).parquet(f"{root}/parts/run={run_id}")


def _summary(parts: DataFrame) -> Row:
    counts = [F.count("*").alias("n_series")] + [F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("fitted", "failed")]
    return parts.agg(*counts, F.coalesce(F.bit_xor(F.xxhash64("unique_id", "coefs", "status", "last_y")), F.lit(0)).alias("digest")).first()


def publish(models: DataFrame, root: str, family: str, config: Mapping, by_id: DataFrame, overall: DataFrame) -> str:
    """Write (unique_id, coefs, status) with every series' fallback, then the manifest row; returns the run id.

    ``by_id`` is (unique_id, last_y), ``overall`` one row (median_y).  A series that has a fallback and
    no model is listed as failed.
    """
    spark, run_id = models.sparkSession, uuid.uuid4().hex
    every = models.select("unique_id", "coefs", "status").join(by_id.select("unique_id", "last_y"), "unique_id", "full")
    every.withColumn("status", F.coalesce("status", F.lit("failed"))).select("unique_id", "coefs", "status", "last_y").write.parquet(f"{root}/parts/run={run_id}")
    found = _summary(_parts(spark, root, run_id))
    params = json.dumps({k: v for k, v in config.items() if k not in ("label", "regime")}, sort_keys=True)
    median = overall.first()
    row = (run_id, family, config["label"], params, *found, None if median is None else median[0], time.time_ns())
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return run_id


def manifests(spark: SparkSession, root: str) -> list[Row]:
    """Rows of all published versions, latest first; none if there is no manifest."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifest").collect()  # a row a version
    except PySparkException:
        return []
    return sorted(rows, key=lambda r: (-r.published, r.run_id))


def live(spark: SparkSession, root: str, label: str | None = None) -> Version | None:
    """The latest version (of a label) whose parts can be read and are those that were counted."""
    for row in manifests(spark, root):
        if label is not None and row.label != label:
            continue
        try:
            parts = _parts(spark, root, row.run_id)
            found = _summary(parts)
        except (PySparkException, Py4JJavaError):
            continue
        if tuple(found) == (row.n_series, row.n_fitted, row.n_failed, row.digest):
            return Version(row, parts)
    return None


def live_labels(spark: SparkSession, root: str) -> list[str]:
    """Labels with a live version that has a fitted series."""
    labels = dict.fromkeys(r.label for r in manifests(spark, root))
    return [k for k in labels if (v := live(spark, root, k)) and v.manifest.n_fitted]


def load(version: Version, ids: DataFrame) -> DataFrame:
    """(unique_id, coefs, fallback, loaded) of the requested series; a series unknown to the version takes the overall value."""
    fitted = F.when(F.col("status") == "fitted", F.col("coefs"))
    out = ids.select("unique_id").join(version.models.select("unique_id", fitted.alias("coefs"), "last_y"), "unique_id", "left")
    return out.select("unique_id", "coefs", F.coalesce("last_y", F.lit(version.manifest.median_y).cast("double")).alias("fallback"),
                      F.col("coefs").isNotNull().alias("loaded"))
