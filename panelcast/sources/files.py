"""Readers and writers of the file layout."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.scalars import nan_to_null


def _csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("nullValue", "NA")
    df = reader.options(dateFormat="yyyy-MM-dd", **options).csv(path)
    doubles = {f.name: nan_to_null(f.name) for f in schema if f.dataType == T.DoubleType()}
    return df.withColumns(doubles) if doubles else df


def read_fact(spark: SparkSession, path: str, target: bool = True) -> DataFrame:
    """Training rows, or request rows without a target."""
    return _csv(spark, path, schemas.FACT if target else schemas.REQUESTS)


def read_covariates(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, schemas.COVARIATES)


def read_stores(spark: SparkSession, path: str, line_sep: str = "\r") -> DataFrame:
    """Store dimension; the published file ends its rows with a bare carriage return."""
    return _csv(spark, path, schemas.STORES, lineSep=line_sep)


def read_template(spark: SparkSession, path: str) -> DataFrame:
    """Submission template with ``pos``, an order key over file, block and row."""
    df = _csv(spark, path, schemas.TEMPLATE)
    pos = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row"))
    return df.select("Id", pos.alias("pos"))


def write_submission(submission: DataFrame, path: str, position: str = "pos") -> None:
    """(Id, Weekly_Sales) as CSV in template order.

    Range partitioning gives ordered part files; nothing is funnelled through a single task.
    """
    ordered = submission.orderBy(position).select("Id", "Weekly_Sales")
    ordered.write.option("header", True).csv(path)


def write_run_results(ledger: DataFrame, path: str) -> None:
    """Append finished runs, one folder per experiment."""
    ledger.write.mode("append").partitionBy("experiment").parquet(path)


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_models(models: DataFrame, path: str) -> None:
    """(label, unique_id, coefs, status), one folder per label; a label written again replaces its rows, others stay."""
    models.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("label").parquet(path)


def load_models(spark: SparkSession, path: str, label: str, ids: DataFrame) -> DataFrame:
    """Coefficients of one label for the requested series; absent or failed ones are missing."""
    stored = spark.read.schema(schemas.MODEL_STORE).parquet(path).filter(F.col("label") == label)
    fitted = stored.filter("status = 'fitted'").select("unique_id", "coefs")
    return ids.select("unique_id").join(fitted, "unique_id", "left")


def load_merged(fact: DataFrame, covariates: DataFrame, stores: DataFrame) -> DataFrame:
    """Fact joined with covariates on three keys and with stores, sorted by series and date."""
    from ..operators.joins import join_covariates_3key, join_stores
    return join_stores(join_covariates_3key(fact, covariates), stores).orderBy("Store", "Dept", "Date")
