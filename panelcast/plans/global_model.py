"""Train and select one global model: features, split, sweep, ledger, final refit."""

import datetime as dt
import hashlib
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..models import gbt
from ..operators import lags, split
from ..operators.ledger import best_run
from ..operators.metrics import fit_report
from ..sources.staging import ensure_checkpoint_dir, write_once


def feature_parts(merged: DataFrame, events: Sequence[dt.date], horizon: int) -> tuple[DataFrame, DataFrame]:
    """(train, valid) model frames with calendar lags, written once and read by every fit."""
    cutoff = split.cutoff_value(merged, horizon)
    frame = lags.calendar_feature_frame(merged, events, keep=["unique_id", "Date", "Weekly_Sales"])
    frame = write_once(frame.withColumn("is_train", F.col("Date") < cutoff), "features")
    return frame.filter("is_train"), frame.filter("not is_train")


FAMILIES = {"categorical": (schemas.CALENDAR_FEATURES, ("Store", "Dept"), False), "weighted": (schemas.POSITIONAL_FEATURES, (), True)}


def sweep(
    train: DataFrame, valid: DataFrame, configs: Sequence[Mapping], experiment: str = "Trees", family: str = "categorical", at_once: int = 4,
) -> DataFrame:
    """Ledger rows of every configuration, in the order given.

    Features are indexed and assembled once.  Configurations that differ in the number of trees share
    one fit, whose first trees are the smaller model; ``at_once`` fits run side by side.  Names of
    parameters without a counterpart, or taken at another value, stand under ``changed``.  A fit that
    fails leaves FAILED rows and the others go on.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    features, keys, weighted = FAMILIES[family]
    table, pipeline, bins = gbt.prepare(train, features, keys)
    table = write_once(table, "vectors")
    held_out = write_once(gbt.vectors(pipeline, valid, features, keys), "vectors")

    def fit(group: Sequence[Mapping]) -> dict[str, tuple[float | None, float | None, str]]:
        try:
            model = gbt.fit_trees(table, group[0], bins, weighted)
            inside, outside = gbt.prefix_errors(model, table), gbt.prefix_errors(model, held_out)
            return {c["label"]: (inside[c["n_estimators"] - 1], outside[c["n_estimators"] - 1], "FINISHED") for c in group}
        except (PySparkException, Py4JJavaError):
            return {c["label"]: (None, None, "FAILED") for c in group}

    with ThreadPoolExecutor(at_once) as pool:
        found = {label: e for part in pool.map(fit, gbt.nested(configs)) for label, e in part.items()}
    rows = []
    for seq, c in enumerate(configs):
        params = {k: str(v) for k, v in c.items()} | {"changed": ",".join(gbt.to_mllib(c)[1])}
        run_id = hashlib.md5(f"{experiment}|{family}|{dict(c)}".encode()).hexdigest()[:12]
        inside, outside, state = found[c["label"]]
        rows.append((seq, experiment, c["label"], c["regime"], params, inside, outside, 0, state, run_id))
    ledger = spark.createDataFrame(rows, "seq int, experiment string, label string, regime string, params map<string,string>, train_wmae double, "
                                         "val_wmae double, fallback_series bigint, run_status string, run_id string")
    return write_once(fit_report(ledger), "ledger")


def refit_best(ledger: DataFrame, configs: Sequence[Mapping], rows: DataFrame, family: str = "categorical") -> tuple[str, PipelineModel, GBTRegressionModel]:
    """(label, feature pipeline, trees) of the winning configuration on all rows."""
    label = best_run(ledger).select("label").first()[0]
    config = next(c for c in configs if c["label"] == label)
    features, keys, weighted = FAMILIES[family]
    ensure_checkpoint_dir(rows.sparkSession)
    table, pipeline, bins = gbt.prepare(rows, features, keys)
    return label, pipeline, gbt.fit_trees(write_once(table, "vectors"), config, bins, weighted)
