"""Declared schemas and fixed column lists."""

from pyspark.sql import types as T

FACT = T.StructType([
    T.StructField("Store", T.IntegerType(), False),
    T.StructField("Dept", T.IntegerType(), False),
    T.StructField("Date", T.DateType(), False),
    T.StructField("Weekly_Sales", T.DoubleType(), True),
    T.StructField("IsHoliday", T.BooleanType(), True),
])

REQUESTS = T.StructType([f for f in FACT if f.name != "Weekly_Sales"])

COVARIATES = T.StructType([
    T.StructField("Store", T.IntegerType(), False),
    T.StructField("Date", T.DateType(), False),
    T.StructField("Temperature", T.DoubleType(), True),
    T.StructField("Fuel_Price", T.DoubleType(), True),
    T.StructField("MarkDown1", T.DoubleType(), True),
    T.StructField("MarkDown2", T.DoubleType(), True),
    T.StructField("MarkDown3", T.DoubleType(), True),
    T.StructField("MarkDown4", T.DoubleType(), True),
    T.StructField("MarkDown5", T.DoubleType(), True),
    T.StructField("CPI", T.DoubleType(), True),
    T.StructField("Unemployment", T.DoubleType(), True),
    T.StructField("IsHoliday", T.BooleanType(), True),
])

STORES = T.StructType([
    T.StructField("Store", T.IntegerType(), False),
    T.StructField("Type", T.StringType(), True),
    T.StructField("Size", T.IntegerType(), True),
])

TEMPLATE = T.StructType([
    T.StructField("Id", T.StringType(), False),
    T.StructField("Weekly_Sales", T.DoubleType(), True),
])

MODEL_STORE = T.StructType([
    T.StructField("label", T.StringType(), False),
    T.StructField("unique_id", T.StringType(), False),
    T.StructField("coefs", T.ArrayType(T.DoubleType()), True),
    T.StructField("status", T.StringType(), False),
])

# Column names and closed value lists of the retail data set.
MARKDOWNS = ["MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4", "MarkDown5"]
FILLED_COVARIATES = ["CPI", "Unemployment"]
STORE_TYPES = ["A", "B", "C"]
CALENDAR_COLUMNS = ["Year", "Month", "WeekOfYear", "DaysSinceLastHoliday", "DaysToNextHoliday"]
FUTURE_COLUMNS = (
    ["IsHoliday", "Temperature", "Fuel_Price"] + MARKDOWNS + FILLED_COVARIATES + CALENDAR_COLUMNS
)
STATIC_COLUMNS = ["Store", "Dept", "Size", "Type_A", "Type_B", "Type_C"]

LAG_WEEKS = 52
ROLL_WEEKS = 26
POSITIONAL_LAGS = [26, 52]
POSITIONAL_WINDOWS = [4, 13, 26]
POSITIONAL_SHIFT = 26

CALENDAR_LAG_COLUMNS = ["lag_52", "roll_mean_26_lag52", "roll_std_26_lag52"]
POSITIONAL_LAG_COLUMNS = (
    [f"lag_{k}" for k in POSITIONAL_LAGS]
    + [f"rolling_mean_{w}" for w in POSITIONAL_WINDOWS]
    + [f"rolling_std_{w}" for w in POSITIONAL_WINDOWS]
)
_TYPE_FLAGS = [f"Type_{t}" for t in STORE_TYPES]

# Model frame with calendar lags (24 columns) and with positional lags (29 columns).
CALENDAR_FEATURES = (
    ["Store", "Dept"] + FUTURE_COLUMNS[:10] + ["Size"] + _TYPE_FLAGS
    + CALENDAR_COLUMNS + CALENDAR_LAG_COLUMNS
)
# The published features, in the published order.
POSITIONAL_FEATURES = [
    "lag_26", "lag_52", "rolling_mean_4", "rolling_mean_13", "rolling_mean_26", "rolling_std_4", "rolling_std_13",
    "rolling_std_26", "WeekOfYear", "Month", "Year", "Type_A", "Type_B", "Type_C", "Size", "IsHoliday", "DaysSinceLastHoliday",
    "DaysToNextHoliday", "Fuel_Price", "Temperature", "CPI", "Unemployment", "MarkDown1", "MarkDown2", "MarkDown3", "MarkDown4",
    "MarkDown5", "Store", "Dept",
]
