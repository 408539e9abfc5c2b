import math
import statistics

from conftest import friday
from pyspark.sql import functions as F

from panelcast.operators import lags, panel


def by_series(rows):
    out = {}
    for s, d, day, y, _ in rows:
        out.setdefault((s, d), {})[day] = y
    return out


def same(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9))


def brute_calendar(history, day, first=None, last=None):
    ref = day.fromordinal(day.toordinal() - 364)
    if not history or not min(history) <= ref <= max(history):
        return None, None, None
    window = [history[r] for r in (ref.fromordinal(ref.toordinal() - 7 * k) for k in range(26)) if r in history]
    return history.get(ref), statistics.fmean(window) if window else None, statistics.stdev(window) if len(window) > 1 else None


def test_calendar_lags_on_the_history_itself(gappy):
    df, rows = gappy
    series = by_series(rows)
    for r in lags.calendar_lags(df).collect():
        want = brute_calendar(series[r.Store, r.Dept], r.Date)
        assert all(same(a, b) for a, b in zip((r.lag_52, r.roll_mean_26_lag52, r.roll_std_26_lag52), want)), r


def test_calendar_lags_of_requests_and_cutoff(spark, gappy):
    df, rows = gappy
    series = by_series(rows)
    keys = [(s, d, friday(i)) for s, d in [(1, 1), (1, 2), (2, 1), (9, 9)] for i in range(100, 230, 3)]
    requests = spark.createDataFrame(keys, "Store int, Dept int, Date date")
    cut = friday(120)
    for cutoff in (None, cut):
        past = {k: {d: y for d, y in v.items() if cutoff is None or d < cutoff} for k, v in series.items()}
        got = lags.calendar_lags(df.drop("IsHoliday"), requests, cutoff=cutoff).collect()
        assert len(got) == len(keys)
        for r in got:
            want = brute_calendar(past.get((r.Store, r.Dept), {}), r.Date)
            assert all(same(a, b) for a, b in zip((r.lag_52, r.roll_mean_26_lag52, r.roll_std_26_lag52), want)), (cutoff, r)


def test_lookup_join_agrees_with_the_window_form(gappy):
    df, _ = gappy
    df = df.withColumn("unique_id", F.concat_ws("_", "Store", "Dept"))
    long = df.select("unique_id", "Date", F.col("Weekly_Sales").alias("y"))
    spine = lags.rolling_calendar(panel.weekly_spine(long, date="Date"))
    joined = lags.calendar_lookup(df.select("unique_id", "Date"), spine)
    window = lags.calendar_lags(df).select(*joined.columns)
    key = lambda r: (r.unique_id, r.Date)
    for a, b in zip(sorted(joined.collect(), key=key), sorted(window.collect(), key=key), strict=True):
        assert all(same(x, y) for x, y in zip(a[2:], b[2:])), (a, b)


def test_positional_lags_count_rows(gappy):
    df, rows = gappy
    got = {(r.Store, r.Dept, r.Date): r for r in lags.rolling_positional(lags.lag_positional(df)).collect()}
    for (s, d), history in by_series(rows).items():
        days = sorted(history)
        ys = [history[x] for x in days]
        for i, day in enumerate(days):
            r = got[s, d, day]
            assert r.lag_26 == (ys[i - 26] if i >= 26 else None) and r.lag_52 == (ys[i - 52] if i >= 52 else None)
            for w in (4, 13, 26):
                window = ys[max(0, i - 26 - w + 1): i - 25] if i >= 26 else []
                assert same(r[f"rolling_mean_{w}"], statistics.fmean(window) if window else None)
                assert same(r[f"rolling_std_{w}"], statistics.stdev(window) if len(window) > 1 else 0.0)


def test_no_lag_reads_past_the_cutoff(gappy):
    df, _ = gappy
    cut = friday(100)
    spoiled = df.withColumn("Weekly_Sales", F.when(F.col("Date") < F.lit(cut), F.col("Weekly_Sales")).otherwise(1e9))
    cases = [
        lambda x: lags.lag_with_cutoff(x, 26, cut).drop("Weekly_Sales"),
        lambda x: lags.calendar_lags(x, cutoff=cut).drop("Weekly_Sales"),
    ]
    for case in cases:
        assert sorted(map(str, case(df).collect())) == sorted(map(str, case(spoiled).collect()))


def test_serving_lags_need_only_the_tail(spark, gappy):
    df, _ = gappy
    requests = spark.createDataFrame([(1, 1, friday(i)) for i in range(150, 189)], "Store int, Dept int, Date date")
    full = lags.serve_positional_features(df, requests.withColumn("IsHoliday", F.lit(False)))
    tail = lags.serve_positional_features(panel.tail_n(df, 52), requests.withColumn("IsHoliday", F.lit(False)))
    cols = ["Date", "lag_26", "lag_52", "rolling_mean_26", "rolling_std_4"]
    assert sorted(map(tuple, full.select(cols).collect())) == sorted(map(tuple, tail.select(cols).collect()))
    assert full.filter(F.col("lag_26") == 0).count() == 13  # weeks 27..39 have no known lag-26 source
