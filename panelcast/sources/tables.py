"""Retail panels derived from the order tables.

A line item is a sale, booked on the Friday of its shipping week.  The department is the part
type, the store is the supplier's region (``dense``) or nation (``ragged``, with gaps).  Amounts
are whole cents, so sums are exact in any order.
"""

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import holiday_dates, is_rule_holiday, week_friday
from ..functions.ids import series_id
from .staging import staged

# Part types in alphabetical order; their position is the department number.
DEPARTMENTS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# Years the order tables cover, and the horizon in weeks.
FIRST_YEAR, LAST_YEAR = 1995, 2001
HORIZON = 39

# The columns used, so that reading a table needs no look at its files.
SCHEMAS = {
    "lineitem": "l_partkey bigint, l_suppkey bigint, l_extendedprice double, l_shipdate timestamp_ntz",
    "orders": "o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_type string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}

EVENTS: list[dt.date] = [d for _, d in holiday_dates(FIRST_YEAR, LAST_YEAR)]
STORE_KEY = {"dense": "n_regionkey", "ragged": "n_nationkey"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.rint(F.col(amount) * 100).cast("bigint")


def department(part_type: str = "p_type") -> Column:
    place = F.array_position(F.array(*[F.lit(d) for d in DEPARTMENTS]), F.col(part_type))
    return F.nullif(place, F.lit(0)).cast("int")


def fact(spark: SparkSession, sf_dir: str, grain: str = "ragged") -> DataFrame:
    """(Store, Dept, Date, Weekly_Sales, IsHoliday): one row per series and week with sales."""
    sales = read(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", week_friday(F.col("l_shipdate").cast("date")).alias("Date"),
        cents("l_extendedprice").alias("cents"))
    part = read(spark, sf_dir, "part").select("p_partkey", department().alias("Dept"))
    weekly = (
        sales.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier_store(spark, sf_dir, grain), F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("Store", "Dept", "Date").agg(F.sum("cents").cast("double").alias("Weekly_Sales"))
    )
    return weekly.withColumn("IsHoliday", is_rule_holiday("Date"))


def supplier_store(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", F.col(STORE_KEY[grain]).alias("Store"))


def covariates(spark: SparkSession, sf_dir: str, grain: str = "ragged") -> DataFrame:
    """Store-week covariates from the orders of the store's customers; NULL where none match."""
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.col(STORE_KEY[grain]).alias("Store"))
    orders = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderpriority", cents("o_totalprice").alias("c"),
        week_friday(F.col("o_orderdate").cast("date")).alias("Date"))

    def mean_where(status):
        hit = F.when(F.col("o_orderstatus") == status, F.col("c"))
        return F.sum(hit).cast("double") / F.nullif(F.count(hit), F.lit(0))

    markdowns = [
        F.sum(F.when(F.substring("o_orderpriority", 1, 1) == str(i), F.col("c"))).cast("double").alias(f"MarkDown{i}")
        for i in range(1, 6)]
    weekly = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("Store", "Date").agg(
        (F.sum("c").cast("double") / F.count("c")).alias("Temperature"),
        F.count("c").cast("double").alias("Fuel_Price"),
        *markdowns, mean_where("F").alias("CPI"), mean_where("P").alias("Unemployment"))
    return weekly.withColumn("IsHoliday", is_rule_holiday("Date"))


def stores(spark: SparkSession, sf_dir: str, grain: str = "ragged") -> DataFrame:
    """(Store, Type, Size) from the suppliers of the store."""
    sizes = supplier_store(spark, sf_dir, grain).groupBy("Store").agg(
        (F.count("*") * 1000).cast("int").alias("Size"))
    kind = F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit("C")), (F.col("Store") % 3 + 1).cast("int"))
    return sizes.select("Store", kind.alias("Type"), "Size")


def staged_fact(spark: SparkSession, sf_dir: str, grain: str = "ragged") -> DataFrame:
    """The weekly fact table with its series id, aggregated once per session and written."""
    return staged(spark, ("fact", grain, sf_dir),
                  lambda: fact(spark, sf_dir, grain).withColumn("unique_id", series_id()))


def staged_covariates(spark: SparkSession, sf_dir: str, grain: str = "ragged") -> DataFrame:
    return staged(spark, ("covariates", grain, sf_dir), lambda: covariates(spark, sf_dir, grain))


def staged_stores(spark: SparkSession, sf_dir: str, grain: str = "ragged") -> DataFrame:
    return staged(spark, ("stores", grain, sf_dir), lambda: stores(spark, sf_dir, grain))
