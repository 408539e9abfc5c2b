"""Global boosted trees on MLlib."""

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.scalars import clip_nonnegative, fallback_chain, holiday_weight
from ..operators.metrics import fit_report, wmae_expr
from ..operators.rows import to_double
from ..sources.staging import ensure_checkpoint_dir

SEED = 42
MAX_DEPTH = 30
UNBOUNDED_DEPTH = 10
# Below every real feature value, so a tree can split the missing rows off.
MISSING = -1e15

# Sweep parameters and the MLlib parameter that plays the same part.
PARAMETER_NAMES = {
    "n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize",
    "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy",
    "min_child_weight": "minInstancesPerNode", "min_child_samples": "minInstancesPerNode",
}


def to_mllib(config: Mapping) -> tuple[dict, list[str]]:
    """(MLlib parameters, names without a counterpart or taken at another value) of one sweep configuration."""
    params, ignored = {}, []
    for name, value in config.items():
        if name in ("label", "regime"):
            continue
        target = PARAMETER_NAMES.get(name)
        if target is None:
            ignored.append(name)
        elif target == "maxDepth":
            params[target] = UNBOUNDED_DEPTH if value < 0 else min(int(value), MAX_DEPTH)
            ignored += [name] * (params[target] != value)
        elif target == "minInstancesPerNode":
            params[target] = max(1, int(value))
            ignored += [name] * (params[target] != value)
        elif target == "featureSubsetStrategy":
            params[target] = "all" if value >= 1 else str(float(value))
        else:
            params[target] = value
    return params, ignored


def fill_for_trees(frame: DataFrame, features: Sequence[str]) -> DataFrame:
    """Doubles without missing or infinite values, as MLlib trees need them."""
    def ready(c):
        x = F.col(c).cast("double")
        return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(MISSING)).otherwise(x)

    return frame.withColumns({c: ready(c) for c in features})


def train_weighted(frame: DataFrame, config: Mapping, target: str = "Weekly_Sales") -> PipelineModel:
    """Squared error with holiday weights over the positional feature frame (column ``weight``)."""
    ensure_checkpoint_dir(frame.sparkSession)
    params, _ = to_mllib(config)
    assembler = VectorAssembler(inputCols=list(schemas.POSITIONAL_FEATURES), outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol=target, weightCol="weight", seed=SEED, **params)
    return Pipeline(stages=[assembler, trees]).fit(frame)


def train_categorical(frame: DataFrame, config: Mapping, target: str = "Weekly_Sales") -> PipelineModel:
    """Unweighted, with Store and Dept as categories, over the calendar feature frame.

    The bin count follows the number of categories, so no category is merged.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    params, _ = to_mllib(config)
    keys = ["Store", "Dept"]
    numeric = [c for c in schemas.CALENDAR_FEATURES if c not in keys]
    sizes = frame.agg(*[F.count_distinct(k).alias(k) for k in keys]).first()
    index = StringIndexer(inputCols=keys, outputCols=[f"{k}_index" for k in keys], handleInvalid="keep")
    assembler = VectorAssembler(inputCols=[f"{k}_index" for k in keys] + numeric, outputCol="features")
    trees = GBTRegressor(featuresCol="features", labelCol=target, seed=SEED,
                         maxBins=max(32, *[sizes[k] + 2 for k in keys]), **params)
    return Pipeline(stages=[index, assembler, trees]).fit(fill_for_trees(frame, numeric))


def score_categorical(model: PipelineModel, frame: DataFrame) -> DataFrame:
    numeric = [c for c in schemas.CALENDAR_FEATURES if c not in ("Store", "Dept")]
    return model.transform(fill_for_trees(frame, numeric))


def score_weighted(model: PipelineModel, frame: DataFrame) -> DataFrame:
    return model.transform(to_double(frame, schemas.POSITIONAL_FEATURES))


def prepare(frame: DataFrame, features: Sequence[str], keys: Sequence[str] = (), target: str = "Weekly_Sales", keep: Sequence[str] = ()) -> tuple[DataFrame, PipelineModel, int]:
    """(vector table, pipeline that makes it, bins): indexed and assembled once for any number of fits.

    ``keys`` are taken as categories, as many bins as they have values; ``weight`` is the holiday weight.
    """
    numeric = [c for c in features if c not in keys]
    bins = 32
    stages = []
    if keys:
        sizes = frame.agg(*[F.count_distinct(k).alias(k) for k in keys]).first()
        bins = max(bins, *[sizes[k] + 2 for k in keys])
        stages.append(StringIndexer(inputCols=list(keys), outputCols=[f"{k}_index" for k in keys], handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[f"{c}_index" if c in keys else c for c in features], outputCol="features"))
    model = Pipeline(stages=stages).fit(fill_for_trees(frame, numeric))
    return vectors(model, frame, features, keys, target, keep), model, bins


def vectors(model: PipelineModel, frame: DataFrame, features: Sequence[str], keys: Sequence[str] = (), target: str = "Weekly_Sales", keep: Sequence[str] = ()) -> DataFrame:
    ready = model.transform(fill_for_trees(frame, [c for c in features if c not in keys]))
    held = holiday_weight(F.col("IsHoliday").cast("boolean")).cast("double") if "IsHoliday" in frame.columns else F.lit(1.0)
    return ready.select("features", F.col(target).cast("double").alias(target), held.alias("weight"), *keep)


def fit_trees(table: DataFrame, config: Mapping, bins: int = 32, weighted: bool = False, target: str = "Weekly_Sales") -> GBTRegressionModel:
    """Boosted trees on a vector table."""
    params, _ = to_mllib(config)
    more = {"weightCol": "weight"} if weighted else {}
    return GBTRegressor(featuresCol="features", labelCol=target, seed=SEED, maxBins=bins, **more, **params).fit(table)


def prefix_errors(model: GBTRegressionModel, table: DataFrame) -> list[float]:
    """Weighted absolute error of the first 1, 2, ... trees of a model, from one pass over a vector table."""
    return list(model.copy({model.weightCol: "weight"}).evaluateEachIteration(table, "absolute"))


def nested(configs: Sequence[Mapping]) -> list[list[Mapping]]:
    """Configurations that differ in the number of trees alone, most trees first: one fit holds all of a group."""
    groups: dict[tuple, list[Mapping]] = {}
    for c in configs:
        groups.setdefault(tuple(sorted((k, str(v)) for k, v in to_mllib(c)[0].items() if k != "maxIter")), []).append(c)
    return [sorted(g, key=lambda c: -c["n_estimators"]) for g in groups.values()]


def evaluate(scored_train: DataFrame, scored_valid: DataFrame, label: str, target: str = "Weekly_Sales") -> DataFrame:
    """(label, train_wmae, val_wmae, gap_pct, status)."""
    train = scored_train.agg(wmae_expr(target, "prediction").alias("train_wmae"))
    valid = scored_valid.agg(wmae_expr(target, "prediction").alias("val_wmae"))
    both = train.crossJoin(F.broadcast(valid)).select(F.lit(label).alias("label"), "train_wmae", "val_wmae")
    return fit_report(both)


def serve(scored: DataFrame, by_id: DataFrame, overall: DataFrame) -> DataFrame:
    """(unique_id, ds, prediction) -> fallbacks for series without a score, clipped at 0."""
    out = scored.join(by_id, "unique_id", "left").crossJoin(F.broadcast(overall))
    filled = fallback_chain("prediction", "last_y", "median_y")
    return out.select("unique_id", "ds", clip_nonnegative(filled).alias("prediction"))


def feature_importance(model: PipelineModel, features: Sequence[str], spark, k: int = 20) -> DataFrame:
    """Top k (feature, importance); the model's own short vector is the only driver-side data."""
    values = model.stages[-1].featureImportances.toArray()
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    rows = [(name, float(v)) for name, v in zip(features, values)]
    return spark.createDataFrame(rows, schema).orderBy(F.desc("importance"), "feature").limit(k)
