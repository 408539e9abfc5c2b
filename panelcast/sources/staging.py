"""Written intermediate tables.

A frame that several branches of a job read is written once as Parquet and read back: lineage
ends there, a lost executor costs one task, and later scans prune columns and know their size.
"""

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_tables: dict[tuple, tuple[str, StructType]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every node can reach: ``spark.checkpoint.dir``, else the context's checkpoint folder, else the warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give iterative fits a place to cut their lineage, if the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/panelcast/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark removes the shuffle files of a query once it has ended, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_and_clean(df: DataFrame, name: str) -> DataFrame:
    """``write_once``, and the shuffle files of that write are gone when it returns."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return write_once(df, name)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


def staged(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """Table ``key`` of this session, built and written on first use, or again if it is gone."""
    full = (spark.sparkContext.applicationId, *key)
    if full in _tables:
        path, schema = _tables[full]
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException:
            del _tables[full]
    path = new_path(spark, "-".join(str(k).strip("/").replace("/", "_") for k in key))
    df = build()
    df.write.parquet(path)
    _tables[full] = path, df.schema
    return spark.read.schema(df.schema).parquet(path)


def forget() -> None:
    """Drop the memory of staged tables, so changed inputs are read again."""
    _tables.clear()
