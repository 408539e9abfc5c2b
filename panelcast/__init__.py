"""Weekly retail panels on Spark: features, splits, forecasts, scoring and submission checks.

Every operator takes DataFrames and returns a DataFrame.  Importing this package starts nothing.
"""

__version__ = "0.1.0"
