"""Series and submission identifiers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def series_id(store="Store", dept="Dept") -> Column:
    """``Store_Dept``."""
    return F.concat_ws("_", F.col(store).cast("string"), F.col(dept).cast("string"))


def submission_id(store="Store", dept="Dept", date="Date") -> Column:
    """``Store_Dept_yyyy-MM-dd``."""
    return F.concat_ws("_", F.col(store).cast("string"), F.col(dept).cast("string"),
                       F.date_format(F.col(date), "yyyy-MM-dd"))


def split_series_id(unique_id="unique_id") -> tuple[Column, Column]:
    """Split once on the first underscore; a malformed part becomes NULL, not an error."""
    parts = F.split(F.col(unique_id), "_", 2)
    return F.get(parts, F.lit(0)).try_cast("int"), F.get(parts, F.lit(1)).try_cast("int")
