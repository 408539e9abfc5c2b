"""Query registry and the SQL fragments the oracle texts share."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


TYPES = "['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD']"
STORE = {"dense": "n_regionkey", "ragged": "n_nationkey"}
HORIZON = 39


def holiday_sql(d: str) -> str:
    return (f"(CASE WHEN month({d}) = 2 THEN day({d}) BETWEEN 8 AND 14 WHEN month({d}) = 9 THEN day({d}) BETWEEN 5 AND 11 "
            f"WHEN month({d}) = 11 THEN day({d}) BETWEEN 23 AND 29 WHEN month({d}) = 12 THEN day({d}) BETWEEN 25 AND 31 "
            f"ELSE FALSE END)")


def panel(grain: str = "ragged") -> str:
    """panel(unique_id, Store, Dept, Date, Weekly_Sales, IsHoliday)."""
    return f"""sales AS (
  SELECT CAST({STORE[grain]} AS INTEGER) AS Store, CAST(list_position({TYPES}, p_type) AS INTEGER) AS Dept,
         CAST(date_trunc('week', l_shipdate) AS DATE) + 4 AS Date,
         CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) AS Weekly_Sales
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
  GROUP BY 1, 2, 3),
panel AS (
  SELECT Store || '_' || Dept AS unique_id, Store, Dept, Date, Weekly_Sales, {holiday_sql('Date')} AS IsHoliday FROM sales)"""


def covariates(grain: str = "ragged") -> str:
    marks = ", ".join(
        f"CAST(SUM(CASE WHEN substr(o_orderpriority, 1, 1) = '{i}' THEN c END) AS DOUBLE) AS MarkDown{i}" for i in range(1, 6))

    def mean(status):
        return (f"CAST(SUM(CASE WHEN o_orderstatus = '{status}' THEN c END) AS DOUBLE) / "
                f"NULLIF(COUNT(CASE WHEN o_orderstatus = '{status}' THEN c END), 0)")
    return f"""orders_cents AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders),
covariates AS (
  SELECT CAST({STORE[grain]} AS INTEGER) AS Store, CAST(date_trunc('week', o_orderdate) AS DATE) + 4 AS Date,
         CAST(SUM(c) AS DOUBLE) / COUNT(c) AS Temperature, CAST(COUNT(c) AS DOUBLE) AS Fuel_Price, {marks},
         {mean('F')} AS CPI, {mean('P')} AS Unemployment,
         {holiday_sql("(CAST(date_trunc('week', o_orderdate) AS DATE) + 4)")} AS IsHoliday
  FROM orders_cents JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY {STORE[grain]}, CAST(date_trunc('week', o_orderdate) AS DATE) + 4)"""


def stores(grain: str = "ragged") -> str:
    return f"""stores AS (
  SELECT CAST({STORE[grain]} AS INTEGER) AS Store,
         CASE {STORE[grain]} % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS Type, CAST(COUNT(*) * 1000 AS INTEGER) AS Size
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY {STORE[grain]})"""


HOLIDAYS = """holidays AS (
  SELECT holiday, CAST(d AS DATE) AS ds FROM (
    SELECT unnest(generate_series(DATE '1995-01-06', DATE '2001-12-28', INTERVAL 7 DAY)) AS d) AS weeks,
    (VALUES ('Super_Bowl', 2, 8, 14), ('Labor_Day', 9, 5, 11), ('Thanksgiving', 11, 23, 29), ('Christmas', 12, 25, 31))
      AS rule(holiday, m, lo, hi)
  WHERE month(d) = m AND day(d) BETWEEN lo AND hi)"""

# Fill in date order within a store; markdowns missing -> 0.
CLEAN = """clean AS (
  SELECT Store, Date, IsHoliday, Temperature, Fuel_Price,
         coalesce(MarkDown1, 0) AS MarkDown1, coalesce(MarkDown2, 0) AS MarkDown2, coalesce(MarkDown3, 0) AS MarkDown3,
         coalesce(MarkDown4, 0) AS MarkDown4, coalesce(MarkDown5, 0) AS MarkDown5,
         coalesce(last_value(CPI IGNORE NULLS) OVER p, first_value(CPI IGNORE NULLS) OVER f) AS CPI,
         coalesce(last_value(Unemployment IGNORE NULLS) OVER p, first_value(Unemployment IGNORE NULLS) OVER f) AS Unemployment
  FROM covariates
  WINDOW p AS (PARTITION BY Store ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY Store ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""

CUT = f"""cut AS (
  SELECT MIN(Date) AS cutoff FROM (SELECT DISTINCT Date FROM panel ORDER BY Date DESC LIMIT {HORIZON})),
train AS (SELECT panel.* FROM panel, cut WHERE Date < cutoff),
valid AS (SELECT panel.* FROM panel, cut WHERE Date >= cutoff)"""

FALLBACKS = """by_id AS (SELECT unique_id, arg_max(Weekly_Sales, Date) AS last_y FROM train GROUP BY unique_id),
overall AS (SELECT median(Weekly_Sales) AS median_y FROM train)"""


def event_distance(d: str) -> str:
    """Two scalar subqueries over holidays."""
    return (f"coalesce((SELECT CAST(MIN({d} - ds) AS DOUBLE) FROM holidays WHERE ds <= {d}), 'inf'::DOUBLE) AS DaysSinceLastHoliday, "
            f"coalesce((SELECT CAST(MIN(ds - {d}) AS DOUBLE) FROM holidays WHERE ds >= {d}), 'inf'::DOUBLE) AS DaysToNextHoliday")


CALENDAR = """calendar AS (
  SELECT d.Date, CAST(year(d.Date) AS INTEGER) AS Year, CAST(month(d.Date) AS INTEGER) AS Month,
         CAST(weekofyear(d.Date) AS INTEGER) AS WeekOfYear,
         coalesce(MIN(CASE WHEN ds <= d.Date THEN CAST(d.Date - ds AS DOUBLE) END), 'inf'::DOUBLE) AS DaysSinceLastHoliday,
         coalesce(MIN(CASE WHEN ds >= d.Date THEN CAST(ds - d.Date AS DOUBLE) END), 'inf'::DOUBLE) AS DaysToNextHoliday
  FROM (SELECT DISTINCT Date FROM {source}) AS d CROSS JOIN holidays GROUP BY d.Date)"""

# spine(unique_id, Date, y) with trailing 26-week statistics.
SPINE = """spans AS (SELECT unique_id, MIN(Date) AS a, MAX(Date) AS b FROM {source} GROUP BY unique_id),
weeks AS (SELECT unique_id, CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS Date FROM spans),
spine AS (
  SELECT unique_id, Date, y, AVG(y) OVER w AS roll_mean_26, stddev_samp(y) OVER w AS roll_std_26
  FROM (SELECT weeks.unique_id, weeks.Date, s.Weekly_Sales AS y
        FROM weeks LEFT JOIN {source} AS s ON s.unique_id = weeks.unique_id AND s.Date = weeks.Date) AS dense
  WINDOW w AS (PARTITION BY unique_id ORDER BY Date ROWS BETWEEN 25 PRECEDING AND CURRENT ROW))"""

# filled(unique_id, Date, y): the spine with gaps on a straight line.
KNOWN = """known AS (SELECT unique_id, Date, y, y0, y1, Date - d0 AS off, d1 - d0 AS span FROM (
  SELECT unique_id, Date, y,
    last_value(y IGNORE NULLS) OVER p AS y0, last_value(CASE WHEN y IS NOT NULL THEN Date END IGNORE NULLS) OVER p AS d0,
    first_value(y IGNORE NULLS) OVER f AS y1, first_value(CASE WHEN y IS NOT NULL THEN Date END IGNORE NULLS) OVER f AS d1
  FROM spine
  WINDOW p AS (PARTITION BY unique_id ORDER BY Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY unique_id ORDER BY Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))),
filled AS (
  SELECT unique_id, Date, coalesce(y, y0 + (y1 - y0) * (CAST(off AS DOUBLE) / CAST(span AS DOUBLE))) AS y FROM known)"""


def text(*parts: str) -> str:
    """WITH the given CTEs, then the final select."""
    *ctes, body = parts
    return "WITH " + ",\n".join(ctes) + "\n" + body if ctes else body
