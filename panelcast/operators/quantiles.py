"""Exact quantiles of a whole column without gathering the column in one task.

``percentile`` and ``median`` keep every distinct value of a group in one buffer, which is fine
for a bounded group (a series' weeks) and not for a full table.  Here a mergeable sketch brackets
the wanted rank, a histogram of fixed size narrows the bracket to one bin, and only the distinct
values of that bin are ordered.  Nothing wider than the histogram is shuffled.  The column alone is
written first, since it is scanned three times.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once

BINS = 4096
ACCURACY = 10_000

# brackets: values around each wanted rank.  The sketch is off by at most total / ACCURACY ranks and the bracket is three times as wide; a miss would cost time in
#   the outer bins, not exactness.
# located: histogram of the bracket with one bin on either side and the rank each bin starts at.
# chosen: the bin that holds each rank.  Broadcast sides have a few rows per probability.
SEARCH = """
WITH sketch AS (
  SELECT count(*) AS total,
         percentile_approx(x, array(:edges), :accuracy) AS q FROM {rows}),
brackets AS (SELECT total, inline(array(:items)) FROM sketch WHERE total > 0),
ranks AS (
  SELECT prob, place - floor(place) AS frac, explode(array_distinct(array(floor(place), ceil(place)))) AS rank
  FROM (SELECT prob, prob * (total - 1) AS place FROM brackets)),
placed AS (
  SELECT /*+ BROADCAST(b) */ prob, x,
    CASE WHEN x < lo THEN -1 WHEN x > hi THEN :bins
         ELSE least(floor(coalesce((x - lo) / nullif(hi - lo, 0D), 0D) * :bins), :bins - 1) END AS bin
  FROM {rows} CROSS JOIN brackets b),
bins AS (SELECT prob, bin, count(*) AS n, min(x) AS lo, max(x) AS hi FROM placed GROUP BY prob, bin),
located AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY prob ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM bins),
chosen AS (
  SELECT /*+ BROADCAST(r) */ l.prob, r.frac, r.rank, l.lo, l.hi, l.start
  FROM located l JOIN ranks r ON l.prob = r.prob AND r.rank >= l.start AND r.rank < l.start + l.n),
counted AS (
  SELECT /*+ BROADCAST(c) */ c.prob, c.frac, c.rank, c.start, x, count(*) AS n
  FROM {rows} JOIN chosen c ON x BETWEEN c.lo AND c.hi GROUP BY c.prob, c.frac, c.rank, c.start, x),
seen AS (
  SELECT *, start + sum(n) OVER (PARTITION BY prob, rank ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM counted),
hit AS (SELECT prob, frac, rank, min(x) AS x FROM seen WHERE upto > rank GROUP BY prob, frac, rank),
ends AS (SELECT prob, frac, min_by(x, rank) AS x0, max_by(x, rank) AS x1 FROM hit GROUP BY prob, frac)
SELECT prob, x0 + (x1 - x0) * frac AS value FROM ends
"""


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float]) -> DataFrame:
    """(prob, value) with linear interpolation between neighbours; NULL and NaN are ignored.

    Values must be finite.  An empty column gives no rows.
    """
    raw = F.col(column).cast("double")
    rows = write_once(df.select(raw.alias("x")).filter(raw.isNotNull() & ~F.isnan(raw)), "column")
    margin = 3.0 / ACCURACY
    edges = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)]
    items = [f"named_struct('prob', {float(p)}D, 'lo', q[{2 * i}], 'hi', q[{2 * i + 1}])" for i, p in enumerate(probs)]
    text = (
        SEARCH.replace(":edges", ", ".join(f"{e!r}D" for e in edges)).replace(":items", ", ".join(items))
        .replace(":accuracy", str(ACCURACY)).replace(":bins", str(BINS)))
    return df.sparkSession.sql(text, rows=rows)


def exact_median(df: DataFrame, column: str, name: str = "median") -> DataFrame:
    """One row with the exact median; NULL for an empty column.  Values must be finite."""
    return exact_quantiles(df, column, [0.5]).agg(F.max("value").alias(name))
