"""Marts brought up to date in part are the marts built whole; the exchange's calendar; pagination; lags in blocks."""

import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.functions import calendar
from tidelake.operators import align, contracts, upkeep
from tidelake.plans import gold, jobs, marts
from tidelake.sources import lake

BARS = "source string, symbol string, interval string, date timestamp_ntz, open double, high double, low double, close double, volume double"


def bars(spark, seed=1):
    """Three sources: daily, with holes, and one so sparse that its halo lies years back."""
    rng = random.Random(seed)
    rows = []
    for source, symbol, step in (("a", "X", 1), ("a", "Y", 3), ("b", "X", 1), ("s", "Z", 45), ("s", "X", 1)):
        d = date(2021, 1, 3)
        while d < date(2024, 3, 20):
            p = rng.uniform(10, 20)
            rows.append((source, symbol, "1d", datetime(d.year, d.month, d.day), p, p + 1, p - 1, p + rng.uniform(-1, 1), rng.uniform(1, 9)))
            d += timedelta(rng.randint(1, 2 * step))
    return spark.createDataFrame(rows, BARS)


def rounded(df):
    return df.select(*(F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes)).select(*sorted(df.columns))


def test_an_increment_equals_the_whole_rebuild(spark, tmp_path):
    rows = bars(spark).persist()
    old = rows.where(F.col("date") < datetime(2024, 2, 10))
    later = rows.where((F.col("date") < datetime(2024, 2, 25)) | (F.col("source") != "a"))
    changed = spark.createDataFrame([("a", date(2024, 2, 10)), ("s", date(2024, 2, 10)), ("s", date(2024, 2, 28)), ("b", date(2024, 2, 10))], "source string, since date")
    path = str(tmp_path / "mart")
    marts.write_whole(gold.bars_daily(old), path)
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "mart").glob("source=*/month=*/*.parquet")}
    marts.write_increment(marts.increment(marts.BARS, later, changed), path)
    got = spark.read.parquet(path).drop("month").withColumn("source", F.col("source").cast("string"))
    assert upkeep.unchanged(rounded(got), rounded(gold.bars_daily(later)))
    same = [p for p, at in kept.items() if p.exists() and p.stat().st_mtime_ns == at]
    assert len(same) == len([p for p in kept if "month=2024-02" not in str(p)])  # other months were not touched
    plan = marts.increment(marts.BARS, later, changed)
    assert plan.where("source = 's' AND symbol = 'Z'").count() == later.where("source = 's' AND symbol = 'Z' AND date >= '2024-02-01'").count()
    rows.unpersist()


def test_series_and_events_in_part(spark, tmp_path):
    rng = random.Random(4)
    schema = "source string, series_id string, metric string, date timestamp_ntz, value double"
    rows = [(s, i, m, datetime(2020 + k // 12, k % 12 + 1, 5), rng.uniform(1, 9)) for s in "ab" for i in ("u", "v") for m in (None, "m") for k in range(50)]
    whole = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "series")
    marts.write_whole(gold.series_features(whole.where(F.col("date") < datetime(2024, 1, 1))), path)
    marts.write_increment(marts.increment(marts.SERIES, whole, spark.createDataFrame([("a", date(2024, 1, 5)), ("b", date(2024, 1, 5))], "source string, since date")), path)
    assert upkeep.unchanged(rounded(spark.read.parquet(path).drop("month").withColumn("source", F.col("source").cast("string"))), rounded(gold.series_features(whole)))
    kind = "source string, calendar string, event_id string, series_id string, reference_date date, scheduled_ts timestamp_ntz, observed_ts timestamp_ntz, actual double, revision_seq int"
    made = [("c", "k", f"E{e}:{date(2023, e % 12 + 1, 1)}", f"E{e}", date(2023, e % 12 + 1, 1), datetime(2023, 2, 1), datetime(2023, 2, 1 + r), float(e + r), r) for e in range(30) for r in range(4)]
    events, path = spark.createDataFrame(made, kind), str(tmp_path / "events")
    marts.write_whole(gold.events_revisions(events.where("revision_seq < 2 OR series_id <> 'E7'")), path, "reference_date")
    marts.write_increment(marts.events_increment(events, spark.createDataFrame([("c", date(2023, 8, 1))], "source string, reference_date date")), path, "reference_date")
    assert upkeep.unchanged(rounded(spark.read.parquet(path).drop("month").withColumn("source", F.col("source").cast("string"))), rounded(gold.events_revisions(events)))


def test_a_night_rewrites_only_what_changed(spark, tmp_path):
    base = str(tmp_path / "lake")
    rows = bars(spark, 2).withColumn("date", F.col("date").cast("timestamp"))
    rows.where("date < '2024-03-01'").write.partitionBy("source", "symbol", "interval").parquet(lake.group_path(base, "bars"))
    assert jobs.build_marts(spark, base) == ["fct_bars_daily"]
    rows.where("date >= '2024-03-01' AND source = 'b'").write.mode("append").partitionBy("source", "symbol", "interval").parquet(lake.group_path(base, "bars"))
    jobs.build_marts(spark, base, changed={"bars": spark.createDataFrame([("b", date(2024, 3, 1))], "source string, since date")})
    part = rounded(lake.read_mart(spark, base, "fct_bars_daily")).collect()
    folders = sorted(p.name for p in (tmp_path / "lake/gold/fct_bars_daily/source=b").glob("month=2024-0*"))
    jobs.build_marts(spark, base)
    assert sorted(map(str, part)) == sorted(map(str, rounded(lake.read_mart(spark, base, "fct_bars_daily")).collect())) and folders[-1] == "month=2024-03"


#: Days the New York exchange has published as closed.
PUBLISHED = """1998-01-01 1998-01-19 1998-02-16 1998-04-10 1998-05-25 1998-07-03 1998-09-07 1998-11-26 1998-12-25
2001-01-01 2001-01-15 2001-02-19 2001-04-13 2001-05-28 2001-07-04 2001-09-03 2001-09-11 2001-09-12 2001-09-13 2001-09-14 2001-11-22 2001-12-25
2021-01-01 2021-01-18 2021-02-15 2021-04-02 2021-05-31 2021-07-05 2021-09-06 2021-11-25 2021-12-24
2022-01-17 2022-02-21 2022-04-15 2022-05-30 2022-06-20 2022-07-04 2022-09-05 2022-11-24 2022-12-26
2023-01-02 2023-01-16 2023-02-20 2023-04-07 2023-05-29 2023-06-19 2023-07-04 2023-09-04 2023-11-23 2023-12-25
2024-01-01 2024-01-15 2024-02-19 2024-03-29 2024-05-27 2024-06-19 2024-07-04 2024-09-02 2024-11-28 2024-12-25
2025-01-01 2025-01-09 2025-01-20 2025-02-17 2025-04-18 2025-05-26 2025-06-19 2025-07-04 2025-09-01 2025-11-27 2025-12-25"""


def test_the_calendar_is_the_published_one(spark):
    want = {date.fromisoformat(d) for d in PUBLISHED.split()}
    years = spark.createDataFrame([(y,) for y in sorted({d.year for d in want})], "year int")
    rows = calendar.holidays(years).collect()
    assert {r.day for r in rows} == want and len(rows) == len(want)
    days = calendar.trading_days(spark, F.lit("2024-01-01"), F.lit("2024-12-31"))
    assert days.count() == 252 and days.where("weekday(day) > 4").count() == 0
    easters = {1990: (4, 15), 2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25)}
    got = {r.year: (r.e.month, r.e.day) for r in spark.createDataFrame([(y,) for y in easters], "year int").select("year", calendar.easter(F.col("year")).alias("e")).collect()}
    assert got == easters


def test_pages_that_lose_or_repeat_a_row_name_their_edge(spark):
    start, end = "2024-01-01", "2024-03-31"
    days = [date(2024, 1, 1) + timedelta(i) for i in range(91)]
    whole = spark.createDataFrame([("v", "X", d, 1.0, 2.0, 0.5, 1.0 + d.day % 5, 3.0) for d in days], "source string, symbol string, date date, open double, high double, low double, close double, volume double")
    spans = contracts.cuts(start, end, 4, 7)
    assert spans[0][0] == start and spans[-1][1] == end and len(spans) == 4 and all(date.fromisoformat(b) + timedelta(1) == date.fromisoformat(c) for (_, b), (c, _) in zip(spans, spans[1:]))
    good = lambda a, b: whole.where(F.col("date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    assert contracts.pagination(whole, good, start, end, 4, 7).count() == 0
    open_end = lambda a, b: good(a, b).where((F.col("date") < F.lit(b).cast("date")) | (F.lit(b) != spans[1][1]))
    (lost,) = contracts.pagination(whole, open_end, start, end, 4, 7).collect()
    assert (lost.side, str(lost.date), lost.n, str(lost.boundary)) == ("missing", spans[1][1], 1, spans[2][0])
    twice = lambda a, b: whole.where(F.col("date").between(F.date_sub(F.lit(a).cast("date"), 1), F.lit(b).cast("date"))) if a == spans[3][0] else good(a, b)
    (extra,) = contracts.pagination(whole, twice, start, end, 4, 7).collect()
    assert (extra.side, str(extra.boundary)) == ("extra", spans[3][0])
    lit = lambda x: F.lit(x).cast("date")
    frame = whole.withColumn("date", F.col("date").cast("timestamp"))
    pull = lambda f: lambda a, b: f(a, b).withColumn("date", F.col("date").cast("timestamp"))
    stages = {f: {r.stage: (r.outcome, r.detail) for r in contracts.trial(spark, frame, frame, lit(start), lit(end), lit("2024-05-01"), pull=pull(p)).collect()} for f, p in (("good", good), ("bad", lambda a, b: good(a, b).where(F.col("date") < F.lit(b).cast("date"))))}
    assert stages["good"]["pagination"][0] == "passed" and stages["bad"]["pagination"][0] == "failed" and "around 2024" in stages["bad"]["pagination"][1]


@pytest.mark.parametrize("block", [7, 60, 86_400])
def test_lags_in_blocks_are_lags_whole(spark, block):
    rng = np.random.default_rng(3)
    rows = []
    for sym in ("X", "Y"):
        at = np.sort(rng.choice(np.arange(-100, 400), 430, replace=False))
        rows += [(sym, int(b), float(p), float(q)) for b, p, q in zip(at, 100 + rng.normal(0, 1, 430), 100 + rng.normal(0, 1, 430))]
    got = {(r.symbol, r.lag): (r.corr, r.n) for r in align.lead_lag(spark.createDataFrame(rows, "symbol string, bucket long, base_mid double, quote_mid double"), ["symbol"], 3, block).collect()}
    for sym in ("X", "Y"):
        own = [r for r in rows if r[0] == sym]
        x, y = ({b[1]: float(np.log(b[c] / a[c])) for a, b in zip(own, own[1:])} for c in (2, 3))
        for k in range(-3, 4):
            pairs = [(x[b], y[b + k]) for b in x if b + k in y and all(b + (j if k > 0 else -j) in {r[1] for r in own} for j in range(1, abs(k) + 1))]
            assert got[sym, k][1] == len(pairs) and got[sym, k][0] == pytest.approx(np.corrcoef(np.array(pairs).T)[0, 1])
