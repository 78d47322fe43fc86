"""Verification between sources, against a re-fetch, by proxies; frames as they arrive."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.operators import checks, statistics, verify

DAY0 = date(2023, 1, 2)
KEYS = ["source", "symbol"]


def closes(spark, **sources):
    """Bars of symbol X with the given closes by source, null where a day is missing."""
    rows = [(s, "X", DAY0 + timedelta(i), float(v)) for s, values in sources.items() for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "source string, symbol string, date date, close double")


def said(spark, peers=("p", "q"), **sources):
    r = verify.cross_source(verify.peer_statistics(closes(spark, **sources), "us", list(peers), ["symbol"]), ["symbol"]).first()
    return r.verdict, r.severity, r.peer, r.others


def walk(n, seed=0):
    return 100 * np.exp(np.cumsum(np.random.default_rng(seed).normal(0, 0.02, n)))


def test_rows_are_counted_against_the_peer(spark):
    prices = walk(300)
    third = [p if i % 3 == 0 else None for i, p in enumerate(prices)]
    assert said(spark, us=third, p=prices)[:2] == ("short", "warn")
    assert said(spark, us=third, p=prices, q=prices) == ("dropping", "error", None, "p, q")
    assert said(spark, us=third, p=prices, q=third) == ("coverage_disputed", "warn", "q", "p")
    assert said(spark, us=prices, p=prices, q=third)[:3] == ("agree", None, "p")  # asked in order; q is never reached


def test_a_scaled_copy_is_settled_by_a_third_source(spark):
    prices = walk(60)
    assert said(spark, us=prices * 100, p=prices)[:2] == ("unsettled", "error")
    assert said(spark, us=prices * 100, p=prices, q=prices) == ("outvoted", "error", "p", "q")
    assert said(spark, us=prices * 100, p=prices, q=prices * 100) == ("peer_outlier", "warn", "p", "q")


def test_conventions_drift_and_short_windows_do_not_tell(spark):
    prices, up = walk(300), np.linspace(1, 1.3, 300)
    assert said(spark, us=prices, p=prices * up)[:2] == ("drift", "warn")
    wobble = prices[:60] * 1.2 * (1 + 0.0005 * (np.arange(60) % 2))
    assert said(spark, us=prices[:60], p=wobble)[:2] == ("inconclusive", "warn")


def test_unlike_returns_need_six_dates_and_are_an_error(spark):
    a, b = 100 + walk(300, 1) / 100, 100 + walk(300, 2) / 100
    assert said(spark, us=a, p=b)[:2] == ("unlike_returns", "error")
    assert said(spark, us=a[:5], p=b[:5])[0] == "agree"
    assert said(spark, us=a)[:2] == ("no_peer", "warn")
    later = [None] * 300 + list(b)
    assert said(spark, us=a, p=later) == ("unreachable", "warn", None, "p")


def test_bars_are_scanned_once(spark, sf_dir):
    from tidelake.plans import catalogue_verify

    plan = catalogue_verify.cross_source_verdict(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


BARS = "source string, symbol string, date date, open double, high double, low double, close double, volume double, arrival int"


def bar(i, factor=1.0, arrival=0, **over):
    row = {"open": 10.0, "high": 12.0, "low": 9.0, "close": 11.0}
    prices = {k: v * factor for k, v in row.items()} | over
    return ("s", "X", DAY0 + timedelta(i), prices["open"], prices["high"], prices["low"], prices["close"], over.get("volume", 5.0), arrival)


def consistency(spark, stored, again, **k):
    return verify.self_consistency(spark.createDataFrame(stored, BARS), spark.createDataFrame(again, BARS), KEYS, arrival="arrival", **k).first()


def test_every_price_counts_and_only_the_stored_window(spark):
    stored = [bar(i) for i in range(10) if i != 4]
    again = [bar(i, high=12.6) if i == 3 else bar(i) for i in range(14) if i != 6]
    r = consistency(spark, stored, again)
    assert (r.n_vanished, r.n_appeared, r.n_repeated, r.worst_column, r.uniform) == (1, 1, 0, "high", False)
    assert r.worst_drift == pytest.approx(0.6 / 12.6)


def test_repeats_ratios_and_row_limits(spark):
    stored = [bar(i) for i in range(10)]
    r = consistency(spark, stored, [bar(i, 0.5) for i in range(10)])
    assert r.uniform and r.worst_column == "open" and r.worst_drift == pytest.approx(1.0)
    two = consistency(spark, stored[:2], [bar(i, 0.5) for i in range(2)])
    assert not two.uniform  # two ratios don't make one
    twice = consistency(spark, stored, [bar(i) for i in range(10)] + [bar(3, close=99.0, arrival=1)])
    assert twice.n_repeated == 1 and twice.worst_column == "close"
    capped = consistency(spark, stored, [bar(i) for i in range(5, 10)], most_rows=5)
    assert capped.n_vanished == 0 and capped.worst_column is None
    assert consistency(spark, stored[:1], []) is None


def test_series_lose_gain_and_revise_metrics(spark):
    kind = "source string, series_id string, metric string, date date, value double"
    stored = [("s", "M", m, DAY0 + timedelta(i), float(i)) for m in ("a", "b") for i in range(4)]
    again = [("s", "M", m, DAY0 + timedelta(i), i + (2.0 if i == 2 else 0.0)) for m in ("a", "c") for i in range(6)]
    rows = verify.series_consistency(spark.createDataFrame(stored, kind), spark.createDataFrame(again, kind), ["source", "series_id"])
    r = rows.first()
    assert (r.lost, r.gained, r.worst_metric, r.n_revised, r.largest, r.n_vanished, r.n_appeared) == (["b"], ["c"], "a", 1, 2.0, 0, 0)
    found = verify.series_consistency_violations(rows, F.col("source"), F.col("series_id")).collect()
    assert sorted(v.severity for v in found) == ["error", "warn", "warn"]
    blank = spark.createDataFrame([("s", "N", None, DAY0 + timedelta(i), None) for i in range(3)], kind)
    (v,) = verify.series_consistency_violations(verify.series_consistency(blank, blank, ["source", "series_id"]), F.col("source"), F.col("series_id")).collect()
    assert v.detail == "no value could be compared"


def test_one_healthy_relation_is_enough_and_stale_series_are_unavailable(spark):
    states = spark.createDataFrame([("a", "holds", 0.8), ("a", "frozen", 0.9), ("b", "broken", 0.8), ("b", "frozen", 0.95), ("c", "unrelated", 0.1)], "k string, state string, baseline double")
    assert dict(verify.proxy_verdicts(states, "k").collect()) == {"a": "holds", "b": "frozen", "c": "proxy_unavailable"}
    own = spark.createDataFrame([("a", 900, date(2024, 1, 1)), ("b", 900, date(2024, 1, 30)), ("d", 100, date(2024, 1, 30)), ("e", 900, date(2024, 1, 30))], "k string, n_returns int, newest date")
    got = dict(verify.proxy_verdicts(states, "k", own, F.lit("2024-02-01").cast("date")).collect())
    assert got == {"a": "proxy_unavailable", "b": "frozen", "d": "proxy_unavailable", "e": "proxy_unavailable"}
    found = verify.proxy_violations(spark.createDataFrame(list(got.items()), "k string, verdict string"), "k", F.lit("s")).collect()
    assert {(v.series_id, v.check, v.severity) for v in found} == {("b", "proxy", "error"), *((k, "proxy_unavailable", "warn") for k in "ade")}


def test_metrics_share_one_rhythm(spark):
    weeks = [("s", "cot", f"m{m}", DAY0 + timedelta(7 * i)) for m in range(11) for i in range(40)]
    rows = spark.createDataFrame(weeks, "source string, series_id string, metric string, date date")
    r = statistics.freshness_threshold(rows, ["source", "series_id"], 3 * 86_400).first()
    assert r.threshold == 21 * 86_400
    assert statistics.expected_windows(rows, ["source"], ["series_id", "metric"], 3 * 86_400).first().expected_hours == 504.0
    late = checks.freshness(rows, "series", ["source", "series_id"], F.lit("2023-10-20").cast("date"), 86_400)
    assert late.count() == 0


def test_hourly_holes_leave_weekends_out(spark):
    start = datetime(2024, 1, 1)  # a Monday
    hours = [start + timedelta(hours=h) for h in range(24 * 14)]
    kept = [h for h in hours if h.weekday() < 5 and h not in (start + timedelta(hours=30), start + timedelta(hours=31))]
    rows = spark.createDataFrame([("s", h) for h in kept], "source string, date timestamp")
    assert statistics.implied_missing(rows, ["source"]).first().n_missing == 2
    weekly = [DAY0 + timedelta(7 * i) for i in range(15)] + [DAY0 + timedelta(7 * 14 + 17 + 7 * i) for i in range(2)]  # 17.5 days would be half way
    rows = spark.createDataFrame([("s", datetime(d.year, d.month, d.day, 12 if i > 14 else 0)) for i, d in enumerate(weekly)], "source string, date timestamp")
    assert statistics.implied_missing(rows, ["source"]).first().n_missing == 1  # 2.5 steps are 2


def test_frames_are_judged_as_they_arrive(spark):
    now, lit = F.lit("2023-03-01").cast("date"), lambda t: F.lit(t).cast("date")
    good = spark.createDataFrame([bar(i) for i in range(20)], BARS)
    assert {v.check for v in verify.verify_frame(good, "bars", now, lit("2023-01-02"), lit("2023-01-31"), "1d", "arrival").collect()} <= {"variance"}
    checks_of = lambda df, *a: {(v.check, v.severity) for v in verify.verify_frame(df, *a).collect()}
    hourly = good.withColumn("date", F.timestamp_seconds(1672617600 + F.datediff("date", F.lit(DAY0)) * 3600))
    assert ("interval", "error") in checks_of(hourly, "bars", now, None, None, "1d")
    assert ("range", "error") in checks_of(good, "bars", now, lit("2023-01-05"), None, "1d")
    texts = good.withColumn("close", F.when(F.day("date") == 5, "1,234").when(F.day("date") == 6, F.lit(None)).otherwise("11"))
    assert {("numeric", "error"), ("nulls", "error")} <= checks_of(texts, "bars", now)
    assert checks_of(good.withColumn("date", F.col("date").cast("timestamp_ntz")), "bars", now) == {("index", "error")}
    assert checks_of(good.withColumn("date", F.col("date").cast("string")), "bars", now) == {("index", "error")}
    assert checks_of(good.select("source", "symbol", "date").withColumnRenamed("symbol", "series_id"), "series", now) == {("columns", "error")}
    events = "source string, series_id string, event_id string, scheduled_ts timestamp, observed_ts timestamp, revision_seq int"
    t = datetime(2023, 1, 5)
    rows = [("s", "U", "e1", t, t - timedelta(1), 0), ("s", "U", "e1", t, t, 2), ("s", "U", "e2", t, t, 0), ("s", "U", "e2", t, t, 0)]
    assert checks_of(spark.createDataFrame(rows, events), "events", now) == {("bitemporal", "error"), ("key", "error"), ("revision_seq", "error")}
