"""A small lake on disk: mixed depths, drifting parts, upserts, compaction, publishing, history."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidelake.operators import upkeep
from tidelake.plans import gold, silver
from tidelake.sources import lake

BARS = "date timestamp, open double, high double, low double, close double, volume double"
TICK = "symbol string, bid_price string, bid_qty string, ask_price string, ask_qty string, update_id long, received_at long"


@pytest.fixture()
def base(spark, tmp_path):
    base = str(tmp_path / "lake")
    day = lambda i: datetime(2024, 1, i)
    for symbol in ("BTCUSDT", "ETHUSDT"):
        rows = [(day(i), 10.0 + i, 11.0 + i, 9.0 + i, 10.5 + i, 5.0) for i in range(1, 11)]
        spark.createDataFrame(rows, BARS).coalesce(1).write.parquet(lake.group_path(base, "bars", source="binance", symbol=symbol, interval="1d"))
    flat = spark.createDataFrame([(day(i), float(i)) for i in range(1, 4)], "date timestamp, value double")
    flat.coalesce(1).write.parquet(lake.group_path(base, "series", source="fred", series_id="UNRATE"))
    flat.coalesce(1).write.parquet(lake.group_path(base, "series", source="fut", series_id="BTC", metric="funding_rate"))
    events = [("CPI:2024-01-01", "CPI", day(2), day(2), 2.1, None, None, 0), ("CPI:2024-01-01", "CPI", day(2), day(5), 2.4, None, None, 1)]
    kind = "event_id string, series_id string, scheduled_ts timestamp, observed_ts timestamp, actual double, forecast double, previous double, revision_seq int"
    spark.createDataFrame(events, kind).coalesce(1).write.parquet(lake.group_path(base, "events", source="fredcal", calendar="us_macro"))
    for source, f in (("binance", 1.0), ("coinbase", 0.9993)):
        ticks = [("X", f"{100 * f:.4f}", "1", f"{100 * f + 0.2:.4f}", "1", i, 1704067200000 + i * 1000) for i in range(60)]
        df = spark.createDataFrame(ticks, TICK)
        df = df.withColumn("last_size", F.lit("3")) if source == "coinbase" else df
        df.coalesce(1).write.parquet(lake.group_path(base, "microstructure", source=source, kind="book_ticker", symbol="X", date="2024-01-01"))
    return base


def test_views_and_sql(spark, base):
    names = lake.register_views(spark, base)
    assert {"bars", "series", "events", "book_ticker"} <= set(names) and "trades" not in names
    rows = lake.query(spark, "SELECT symbol, interval, arg_max(close, date) AS last, count(*) // 3 AS n, date_diff('day', min(date), max(date)) AS span FROM bars WHERE interval = '1d' GROUP BY ALL ORDER BY symbol", base).collect()
    assert [tuple(r) for r in rows] == [("BTCUSDT", "1d", 20.5, 3, 9), ("ETHUSDT", "1d", 20.5, 3, 9)]
    plan = lake.read_bars(spark, base).where("source = 'binance' AND symbol = 'BTCUSDT'").select("close")._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "symbol" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_quoted_text_is_not_translated():
    assert lake.translated("SELECT 'a//b', \"x\" // 2 FROM t") == "SELECT 'a//b', `x`  div  2 FROM t"


def test_series_of_both_depths(spark, base):
    rows = lake.read_series(spark, base)
    assert {(r.series_id, r.metric) for r in rows.collect()} == {("UNRATE", None), ("BTC", "funding_rate")}
    assert lake.wide_series(rows.where("metric IS NOT NULL")).columns == ["date", "funding_rate"]
    assert [tuple(r) for r in lake.list_series(rows, ["source", "series_id"]).collect()] == [("fred", "UNRATE"), ("fut", "BTC")]


def test_ticks_of_two_venues_align(spark, base):
    from tidelake.operators import align

    ticks = lake.read_kind(spark, base, "book_ticker")
    assert lake.sources_of(spark, base, "book_ticker") == ["binance", "coinbase"]
    report = align.cross_venue_report(align.mids(ticks), "binance", "coinbase").first()
    assert report.n == 60 and -7.1 < report.mean_bps < -6.9


def test_marts_over_the_lake(spark, base):
    bars = gold.bars_daily(silver.bars(lake.read_bars(spark, base)))
    first = bars.where("symbol = 'BTCUSDT'").orderBy("date").first()
    assert first.ret_simple is None and first.true_range == 2.0 and first.atr_14 == 2.0
    event = gold.events_revisions(silver.events(lake.read_events(spark, base))).first()
    assert (event.source, event.calendar, event.initial_value, event.latest_value, event.n_revisions, event.days_to_latest) == ("fredcal", "us_macro", 2.1, 2.4, 1, 3)
    upkeep.replace_path(bars, lake.gold_path(base, "fct_bars_daily"))
    assert lake.query(spark, "SELECT count(*) AS n FROM fct_bars_daily", base).first().n == 20


def test_upsert_is_idempotent_and_survives_a_cut(spark, base):
    path = lake.group_path(base, "bars", source="binance", symbol="BTCUSDT", interval="1d")
    fresh = spark.createDataFrame([(datetime(2024, 1, 10), 1.0, 2.0, 0.5, 1.5, 9.0), (datetime(2024, 1, 11), 1.0, 2.0, 0.5, 1.5, 9.0)], BARS)
    for _ in range(2):
        upkeep.upsert(spark, fresh, path, ["date"], ["date"])
        rows = {r.date.day: r.close for r in spark.read.parquet(path).collect()}
        assert len(rows) == 11 and rows[10] == rows[11] == 1.5
    import os

    os.rename(path, path + ".old")
    assert upkeep.recover(spark, path) == "restored" and spark.read.parquet(path).count() == 11
    assert upkeep.recover(spark, path) == "clean"
    with pytest.raises(Exception):
        upkeep.replace_path(fresh.withColumn("x", F.raise_error(F.lit("no"))), path)
    assert spark.read.parquet(path).count() == 11


def test_compaction_joins_parts_of_other_types(spark, tmp_path):
    path = str(tmp_path / "part")
    spark.createDataFrame([(1, None)], "id int, note int").coalesce(1).write.parquet(path)
    spark.createDataFrame([(2, "late")], "id long, note string").coalesce(1).write.mode("append").parquet(path)
    assert upkeep.compact(spark, path) == 2
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, None), (2, "late")]
    assert upkeep.compact(spark, path) == 0


def test_only_listed_sources_leave(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("c", 4)], "source string, v int")
    allowed = spark.createDataFrame([("bars", "a"), ("series", "b"), ("bars", None)], "group string, source string")
    upkeep.publish(rows, allowed, "bars", str(tmp_path / "out"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("a", 1)]


def test_history_replaces_a_run(spark, tmp_path):
    path = str(tmp_path / "dq")
    spark.createDataFrame([("2024-01-01", 5)], "run_date string, n_error long").write.parquet(path)
    for n in (1, 2):
        upkeep.record_run(spark, spark.createDataFrame([("2024-01-02", "daily", n)], "run_date string, cadence string, n_error long"), path, ["run_date", "cadence"])
    assert sorted((r.run_date, r.cadence, r.n_error) for r in spark.read.parquet(path).collect()) == [("2024-01-01", "daily", 5), ("2024-01-02", "daily", 2)]


def test_a_night_and_its_repeat(spark, base):
    from tidelake.plans import jobs
    from tidelake.registry import Registry, Source

    registry = Registry([Source("binance", "bars", {"BTCUSDT": "BTCUSDT"}, "1d", redistributable=True)])
    for _ in range(2):
        found = jobs.nightly(spark, base, "2024-03-01 00:00:00", registry)["violations"]
        assert {(r.group, r.check) for r in found.collect()} == {("bars", "freshness"), ("series", "freshness")}
    runs = spark.read.parquet(f"{base}/quality/dq_runs").collect()
    assert len(runs) == 1 and (runs[0].n_violations, runs[0].n_warn, runs[0].groups) == (4, 4, "bars,series")
    assert {m for m in lake.GOLD if lake.exists(spark, lake.gold_path(base, m))} == set(lake.GOLD)


def test_weekly_names_what_moved(spark, base):
    from tidelake.plans import jobs

    stored = lake.read_bars(spark, base)
    k = F.dayofmonth("date")
    again = stored.where(k != 3).withColumn("close", F.when(F.col("symbol") == "ETHUSDT", F.col("close") * 0.5).when(k == 4, F.col("close") + 1).otherwise(F.col("close")))
    found = {(r.series_id, r.severity, r.detail) for r in jobs.weekly(stored, again, F.lit("2024-01-10").cast("date")).collect()}
    assert found == {
        ("BTCUSDT", "error", "settled close values changed, history was revised"), ("BTCUSDT", "error", "1 stored dates vanished"),
        ("ETHUSDT", "warn", "settled close values changed by one ratio, as after a corporate action"), ("ETHUSDT", "error", "1 stored dates vanished"),
    }


def test_a_cut_at_any_step_of_a_swap_loses_nothing(spark, tmp_path):
    import os

    rows = lambda n: spark.createDataFrame([(i, float(i)) for i in n], "id long, v double").coalesce(1)
    steps = {
        "written": lambda p: rows([9]).write.parquet(p + ".new-x"),
        "moved away": lambda p: (rows([9]).write.parquet(p + ".new-x"), os.rename(p, p + ".old")),
        "moved in": lambda p: (os.rename(p, p + ".old"), rows(range(5)).write.parquet(p)),
    }
    for name, cut in steps.items():
        path = str(tmp_path / name.replace(" ", "_"))
        rows(range(5)).write.parquet(path)
        cut(path)
        upkeep.upsert(spark, rows([4, 5]), path, ["id"], ["id"])
        assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4, 5], name
        assert not [f for f in os.listdir(tmp_path) if ".new-" in f or f.endswith(".old")]
    quality = str(tmp_path / "dq")
    spark.createDataFrame([("2024-01-01", "daily", 5)], "run_date string, cadence string, n_error long").write.parquet(quality)
    os.rename(quality, quality + ".old")
    upkeep.record_run(spark, spark.createDataFrame([("2024-01-02", "daily", 1)], "run_date string, cadence string, n_error long"), quality, ["run_date", "cadence"], {"run_date": "2024-01-02", "cadence": "daily"})
    assert spark.read.parquet(quality).count() == 2


def test_a_rename_that_fails_is_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "x")
    spark.range(3).write.parquet(path)
    real, seen = upkeep._rename, []

    def broken(fs, a, b):
        seen.append(1)
        if len(seen) == 2:
            raise OSError("no")
        real(fs, a, b)

    monkeypatch.setattr(upkeep, "_rename", broken)
    with pytest.raises(OSError):
        upkeep.replace_path(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3


def test_the_last_of_equal_keys_in_a_batch_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    upkeep.upsert(spark, spark.createDataFrame([(1, "first"), (2, "x"), (1, "last")], "id int, v string").coalesce(1), path, ["id"], ["id"])
    assert dict(spark.read.parquet(path).collect()) == {1: "last", 2: "x"}


def test_compaction_loses_no_digits(spark, tmp_path):
    def merged(name, *parts):
        path = str(tmp_path / name)
        for value, kind in parts:
            spark.createDataFrame([(value,)], f"v {kind}").coalesce(1).write.mode("append").parquet(path)
        upkeep.compact(spark, path)
        return {r.v for r in spark.read.parquet(path).collect()}, spark.read.parquet(path).dtypes[0][1]

    assert merged("a", (0.5, "float"), (123456789.123, "double")) == ({0.5, 123456789.123}, "double")
    assert merged("b", (7, "smallint"), (2**40 + 1, "bigint")) == ({7, 2**40 + 1}, "bigint")
    assert merged("c", (7, "int"), (0.1, "double")) == ({7.0, 0.1}, "double")
    with pytest.raises(ValueError, match="no type"):
        merged("d", (2**60 + 1, "bigint"), (0.1, "double"))
    assert {r.v for f in (tmp_path / "d").glob("*.parquet") for r in spark.read.parquet(str(f)).collect()} == {2**60 + 1, 0.1}
    assert upkeep.wider("decimal(10,2)", "bigint") == "decimal(21,2)" and upkeep.wider("float", "int") == "double"
    with pytest.raises(ValueError):
        upkeep.wider("string", "int")


def test_settled_partitions_are_compacted_and_recovered(spark, tmp_path):
    import os

    for d in ("2024-01-01", "2024-01-02", "2024-01-05"):
        for i in range(3):
            spark.createDataFrame([(i,)], "v int").coalesce(1).write.mode("append").parquet(str(tmp_path / f"kind=trades/date={d}"))
    cut = str(tmp_path / "kind=trades/date=2024-01-02")
    os.rename(cut, cut + ".old")
    done = upkeep.compact_settled(spark, str(tmp_path), "2024-01-05")
    assert {k.rpartition("=")[2]: n for k, n in done.items()} == {"2024-01-01": 3, "2024-01-02": 3}
    assert spark.read.parquet(cut).count() == 3 and upkeep.compact_settled(spark, str(tmp_path), "2024-01-05") == {}


def test_a_repeat_without_violations_clears_the_run(spark, base):
    from tidelake.plans import jobs

    found = spark.createDataFrame([("bars", "s", "X", None, "nulls", "error", "1 null")], "group string, source string, series_id string, metric string, check string, severity string, detail string")
    assert jobs.record(spark, base, found, "2024-03-01 00:00:00", "daily").count() == 1
    assert jobs.record(spark, base, found, "2024-03-01 00:00:00", "weekly").count() == 1
    assert jobs.record(spark, base, found.limit(0), "2024-03-01 05:00:00", "daily").count() == 0
    runs = {r.cadence: r.n_violations for r in lake.query(spark, "SELECT cadence, n_violations FROM dq_runs ORDER BY run_ts DESC LIMIT 200", base).collect()}
    assert runs == {"daily": 0, "weekly": 1}
    assert lake.query(spark, "SELECT * FROM dq_violations", base).count() == 1
    from tidelake.schemas import DQ_RUNS

    assert [r.cadence for r in upkeep.history(spark, f"{base}/quality/dq_runs", DQ_RUNS).collect()] == ["daily", "weekly"]
    assert upkeep.history(spark, f"{base}/quality/none", DQ_RUNS).count() == 0


def test_published_files_are_bounded(spark, tmp_path):
    rows = spark.range(1000).select(F.lit("a").alias("source"), F.col("id").alias("date"))
    allowed = spark.createDataFrame([("bars", "a")], "group string, source string")
    assert upkeep.publish(rows, allowed, "bars", str(tmp_path / "out"), file_rows=300) == 4
    files = [spark.read.parquet(str(f)).count() for f in (tmp_path / "out").glob("*.parquet")]
    assert sum(files) == 1000 and max(files) < 600
    assert upkeep.publish(rows, allowed, "bars", str(tmp_path / "out")) == 1


MIDS = """
SELECT source, received_at // 1000 AS second, -- arg_max(a, b) // not code
    arg_max(
        (TRY_CAST(bid_price AS DOUBLE) + TRY_CAST(ask_price AS DOUBLE)) / 2, received_at
    ) AS mid
FROM book_ticker WHERE date = DATE '2024-01-01' AND source IN ('binance', 'coinbase')
GROUP BY source, second ORDER BY second, source
"""


def test_sql_of_nested_calls_windows_and_filters(spark, base):
    rows = lake.query(spark, MIDS, base).collect()
    assert len(rows) == 120 and rows[0].second == 1704067200 and {round(r.mid, 4) for r in rows} == {100.1, 100.03}
    over = lake.query(spark, "SELECT symbol, arg_max(close, date) OVER (PARTITION BY symbol) AS last, /* // */ close FROM bars", base).collect()
    assert len(over) == 20 and {r.last for r in over} == {20.5}
    kept = lake.query(spark, "SELECT arg_max(close, date) FILTER (WHERE close < 15) AS c, arg_min(nullif(close, 11.5), date) AS d FROM bars", base).first()
    assert (kept.c, kept.d) == (14.5, 12.5)
    glob = f"{base}/bronze/group=bars/source=*/symbol=*/interval=*/*.parquet"
    n = lake.query(spark, f"SELECT symbol, count(*) AS n FROM read_parquet('{glob}', hive_partitioning = true, union_by_name = true) GROUP BY symbol", base).collect()
    assert {(r.symbol, r.n) for r in n} == {("BTCUSDT", 10), ("ETHUSDT", 10)}
    assert lake.query(spark, f"SELECT count(*) AS n FROM read_parquet('{glob}')", base).first().n == 20


def test_sql_of_lists_names_units_and_filtered_windows(spark, base):
    one = lambda s: lake.query(spark, s, base).collect()
    glob = lambda s: f"{base}/bronze/group=bars/source=binance/symbol={s}/interval=1d/*.parquet"
    rows = one(f"SELECT symbol, count(*) AS n FROM read_parquet(['{glob('BTCUSDT')}', '{glob('ETHUSDT')}'], hive_partitioning = true, union_by_name = true) GROUP BY ALL ORDER BY 1")
    assert [tuple(r) for r in rows] == [("BTCUSDT", 10), ("ETHUSDT", 10)]
    flat, deep = f"{base}/bronze/group=series/source=*/series_id=*/*.parquet", f"{base}/bronze/group=series/source=*/series_id=*/metric=*/*.parquet"
    both = lake.query(spark, f"SELECT * FROM read_parquet('{flat}', hive_partitioning=true) UNION ALL BY NAME SELECT * FROM read_parquet('{deep}', hive_partitioning=true)", base)
    assert {(r.series_id, r.metric) for r in both.collect()} == {("UNRATE", None), ("BTC", "funding_rate")} and both.count() == 6
    assert lake._by_name("SELECT 'UNION ALL BY NAME' UNION  all by name SELECT 2") == ["SELECT 'UNION ALL BY NAME' ", " SELECT 2"]
    over = one("SELECT symbol, date, count(*) FILTER (WHERE close > 15) OVER (PARTITION BY symbol) AS n, sum(close) FILTER (WHERE close > (10 + 5)) OVER (PARTITION BY symbol ORDER BY date) AS s, arg_max(close, date) FILTER (WHERE close < 15) OVER (PARTITION BY symbol) AS l FROM bars ORDER BY symbol, date")
    assert over[0].n == 6 and over[0].s is None and over[9].s == sum(15.5 + i for i in range(6)) and over[3].l == 14.5
    spans = one("SELECT date_diff('hour', TIMESTAMP '2024-01-01 10:59:00', TIMESTAMP '2024-01-01 12:01:00') AS h, date_diff('month', DATE '2024-01-31', DATE '2024-03-01') AS m, date_diff('year', DATE '2023-12-31', DATE '2024-01-01') AS y, date_diff('day', DATE '2024-01-01', DATE '2024-02-01') AS d, date_diff('week', DATE '2024-01-07', DATE '2024-01-08') AS w")
    assert tuple(spans[0]) == (2, 2, 1, 31, 1)
    left = lake.query(spark, "SELECT * EXCLUDE (open, high), quantile_cont(close, 0.25) OVER (PARTITION BY symbol) AS q FROM bars", base)
    assert {"open", "high"}.isdisjoint(left.columns) and left.first().q == 13.75
    assert "volume" not in lake.query(spark, "SELECT * EXCLUDE volume FROM bars", base).columns
    odd = lake.query(spark, """SELECT close AS "it's", 'a "b" // c' AS t, symbol AS "q""x" FROM bars""", base)
    assert odd.columns == ["it's", "t", 'q"x'] and odd.first()[1] == 'a "b" // c'


def test_only_named_views_are_made(spark, base):
    for v in ("bars", "series", "events", "book_ticker"):
        spark.catalog.dropTempView(v)
    lake.query(spark, "SELECT count(*) FROM series", base)
    assert spark.catalog.tableExists("series") and not spark.catalog.tableExists("bars")
    with pytest.raises(FileNotFoundError):
        lake.load_bars(spark, base, "NONE", "binance")
    assert lake.load_bars(spark, base, "BTCUSDT", "binance").count() == 10 and lake.load_series(spark, base, "BTC", "fut", "funding_rate").count() == 3
    assert lake.count_events(spark, base, "fredcal", "us_macro") == 2 and lake.count_events(spark, base, "fredcal", "none") == 0


def names_of():
    """Sources whose own names are not the canonical ones."""
    from tidelake.registry import Registry, Source

    return Registry([
        Source("binance", "bars", {"BTCUSDT": "XBT", "ETHUSDT": "XETH"}, "1d", redistributable=True), Source("fred", "series", {"UNRATE": "LNS14"}),
        Source("fut", "series", {"BTC": "BTC-PERP"}), Source("fredcal", "events", {"CPI": "CPIAUCSL", "PPI": "PPIACO"}),
    ])


def feeds():
    """Functions that tasks run: workers cannot import this module, so they travel with their task."""

    def bars_of(*days, close=1.5):
        import pandas as pd

        return pd.DataFrame([(datetime(2024, 1, d), 1.0, 2.0, 0.5, close, 9.0) for d in days], columns=["date", "open", "high", "low", "close", "volume"])

    def task_fetch(source, name, start, end):
        """A feed by native names: two sources with news, one without, one that is down, one with a damaged frame."""
        import pandas as pd

        from tidelake.sources.rest import NoNewData

        if name == "XETH":
            raise NoNewData(name)
        if source == "fut":
            raise RuntimeError("down")
        if name == "LNS14":
            assert start == "2024-01-04", start
            return pd.DataFrame({"date": [datetime(2024, 1, 4), datetime(2024, 1, 5), datetime(2024, 1, 5)], "value": [4.0, None, 6.0]})
        if name == "CPIAUCSL":
            return [{"event_id": "CPI:2024-01-01", "series_id": "CPI", "scheduled_ts": datetime(2024, 1, 2), "observed_ts": datetime(2024, 1, 1), "actual": 2.6, "forecast": None, "previous": None, "revision_seq": 2}]
        if name == "PPIACO":
            raise NoNewData(name)
        assert (name, start) == ("XBT", "2024-01-10"), (name, start)
        return bars_of(9, 10, 11, 11, 12).assign(volume=["9", "9", "no", "7", "9"])

    return bars_of, task_fetch


bars_of, task_fetch = feeds()


def test_everything_is_updated_in_one_plan_by_native_names(spark, base):
    from tidelake.sources import fleet

    done = fleet.update_all(spark, base, names_of(), task_fetch, "2024-01-12", parallel=2)
    assert (done["updated"], done["failed"]) == (4, 1)
    assert [tuple(r) for r in done["failures"].collect()] == [("series", "fut/BTC", "RuntimeError", "down")]
    rows = {r.date.day: (r.close, r.volume) for r in lake.load_bars(spark, base, "BTCUSDT", "binance").collect()}
    assert len(rows) == 11 and rows[10] == (1.5, 9.0) and rows[11] == (1.5, 7.0) and rows[8] == (18.5, 5.0)  # the last of the 11th stays, the 12th still forms
    assert {r.date.day: r.value for r in lake.load_series(spark, base, "UNRATE", "fred").collect()} == {1: 1.0, 2: 2.0, 3: 3.0, 4: 4.0, 5: 6.0}
    assert lake.load_series(spark, base, "BTC", "fut", "funding_rate").count() == 3 and lake.count_events(spark, base, "fredcal", "us_macro") == 3
    found = {(r.group, r.series_id, r.check) for r in done["violations"].collect()}
    assert {("bars", "BTCUSDT", "range"), ("bars", "BTCUSDT", "numeric"), ("bars", "BTCUSDT", "index"), ("series", "UNRATE", "index"), ("events", "CPI", "bitemporal")} <= found


def test_an_unregistered_series_and_a_frame_without_columns(spark, base):
    from tidelake.registry import Registry, Source
    from tidelake.sources import fleet

    registry = Registry([Source("binance", "bars", {"BTCUSDT": "XBT"}, "1d")])
    done = fleet.update_all(spark, base, registry, lambda *_: bars_of(10, 11).drop(columns=["volume"]), "2024-01-12", parallel=2)
    assert {r.series: r.error for r in done["failures"].collect()} == {"binance/ETHUSDT/1d": "ValueError", "fred/UNRATE": "ValueError", "fut/BTC": "ValueError"}
    assert {(r.series_id, r.check, r.detail) for r in done["violations"].collect()} == {("BTCUSDT", "columns", "missing volume")}
    assert lake.load_bars(spark, base, "BTCUSDT", "binance").where("volume IS NULL").count() == 2  # stored whatever the judgement


def test_jobs_do_not_grow_with_series(spark, tmp_path):
    from tidelake.registry import Registry, Source
    from tidelake.sources import fleet

    jobs = {}
    for n in (5, 200):
        base = str(tmp_path / f"lake{n}")
        rows = spark.range(n).select(F.lit("v").alias("source"), F.concat(F.lit("S"), F.col("id")).alias("symbol"), F.lit("1d").alias("interval"), F.lit(datetime(2024, 1, 3)).alias("date"), *(F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")))
        rows.write.partitionBy("source", "symbol", "interval").parquet(lake.group_path(base, "bars"))
        registry = Registry([Source("v", "bars", {f"S{i}": f"native-{i}" for i in range(n)}, "1d")])
        spark.sparkContext.setJobGroup(f"fleet-{n}", "count jobs")
        done = fleet.update_all(spark, base, registry, lambda source, name, *_: bars_of(3, 4, close=float(name.split("-")[1])), "2024-01-10", parallel=2)
        assert done["updated"] == n and done["failed"] == 0
        jobs[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fleet-{n}"))
        spark.sparkContext.setJobGroup("other", "")
        assert lake.read_bars(spark, base).where("day(date) = 4 AND close = CAST(substr(symbol, 2) AS DOUBLE)").count() == n
    assert abs(jobs[200] - jobs[5]) <= 6, jobs


def test_a_commit_cut_short_is_applied(spark, base, monkeypatch):
    from tidelake.sources import fleet

    fresh = spark.createDataFrame([(datetime(2024, 1, 9), 7.0, "binance", "BTCUSDT", "1d", 0)], "date timestamp, close double, source string, symbol string, interval string, arrival long")
    put = fleet._apply

    def cut(*args):
        raise RuntimeError("cut")

    monkeypatch.setattr(fleet, "_apply", cut)
    with pytest.raises(RuntimeError, match="cut"):
        fleet.merge(spark, base, "bars", fresh, lambda: lake.read_bars(spark, base), ["date"])
    assert lake.load_bars(spark, base, "BTCUSDT", "binance").where("close = 7.0").count() == 0
    monkeypatch.setattr(fleet, "_apply", put)
    assert fleet.recover(spark, base) == ["bars"] and fleet.recover(spark, base) == []
    assert lake.load_bars(spark, base, "BTCUSDT", "binance").where("close = 7.0").count() == 1 and lake.read_bars(spark, base).count() == 20


def test_one_series_is_updated_by_its_native_name(spark, base):
    from tidelake.sources import updates

    asked = []

    def fetch(source, name, start, end):
        asked.append((source, name, start))
        if source == "fred":
            return spark.createDataFrame([(datetime(2024, 1, 4), 4.0)], "date timestamp, value double")
        return spark.createDataFrame([(datetime(2024, 1, d), 1.0, 2.0, 0.5, 1.5, 9.0) for d in (10, 11, 12)], BARS)

    registry = names_of()
    assert {r.check for r in updates.update_bars(spark, base, registry, "binance", "BTCUSDT", "1d", fetch, "2024-01-12").collect()} == {"variance"}
    assert updates.update_series(spark, base, registry, "fred", "UNRATE", fetch, "2024-01-12").count() == 0
    assert asked == [("binance", "XBT", "2024-01-10"), ("fred", "LNS14", "2024-01-04")]
    rows = {r.date.day: r.close for r in lake.load_bars(spark, base, "BTCUSDT", "binance").collect()}
    assert len(rows) == 11 and rows[10] == rows[11] == 1.5 and rows[9] == 19.5
    with pytest.raises(FileNotFoundError):
        updates.update_bars(spark, base, registry, "binance", "NEW", "1d", fetch, "2024-01-12")
    with pytest.raises(ValueError):
        updates.load(registry, fetch, "bars", "binance", "DOGE")
    assert updates.update_bars(spark, base, registry, "binance", "BTCUSDT", "1d", fetch, "2024-01-11").count() == 0


def test_backfill_and_migration(spark, base, tmp_path):
    import pandas as pd

    from tidelake.registry import Registry, Source
    from tidelake.sources import fleet, updates

    registry = Registry([Source("binance", "bars", {"SOLUSDT": "SOL", "BAD": "BAD"}, "1d"), Source("cot", "series", {"GOLD": "088691"})])

    def fetch(source, name, start, end):
        if name == "BAD":
            raise RuntimeError("delisted")
        if source == "cot":
            return pd.DataFrame({"date": [datetime(2024, 1, 2)], "longs": [1.0], "shorts": [2.0]})
        return bars_of(1, 2)

    done = fleet.backfill(spark, base, registry, fetch, "bars", "binance", today="2024-01-02", parallel=2)
    assert done["saved"] == 1 and [r.series for r in done["failures"].collect()] == ["binance/BAD/1d"]
    assert lake.load_bars(spark, base, "SOLUSDT", "binance").count() == 1
    assert fleet.backfill(spark, base, registry, fetch, "series", "cot", parallel=2)["saved"] == 1
    assert {r.metric for r in lake.load_series(spark, base, "GOLD", "cot").collect()} == {"longs", "shorts"}
    with pytest.raises(ValueError):
        fleet.backfill(spark, base, registry, fetch, "bars", "nobody")
    old = str(tmp_path / "old")
    spark.createDataFrame([(datetime(2024, 1, d), 1.0, 2.0, 0.5, 1.5, 9.0) for d in (1, 2, 3)], BARS).write.parquet(old)
    assert updates.migrate_bars(spark, old, base, "kraken", "XBT") == 3 and lake.load_bars(spark, base, "XBT", "kraken").count() == 3


def test_a_night_with_updates_records_failures_and_drift(spark, base):
    from tidelake.plans import jobs
    from tidelake.sources import fleet

    registry = names_of()
    for _ in range(2):  # a repeat replaces its record
        done = jobs.nightly(spark, base, "2024-01-12 00:00:00", registry, update=lambda: fleet.update_all(spark, base, registry, lambda s, n, a, b: bars_of(11) if n == "XBT" else task_fetch(s, n, "2024-01-04", b), "2024-01-12", parallel=2))
        assert done["failed"] == 1 and [(r.series, r.error) for r in done["failures"].collect()] == [("fut/BTC", "RuntimeError")]
        assert [(r.group, r.source, r.symbol) for r in done["drift"].collect()] == [("events", "fredcal", "PPI")]
        assert ("events", "CPI", "bitemporal") in {(r.group, r.series_id, r.check) for r in done["violations"].collect()}
    runs = lake.query(spark, "SELECT n_updated, n_failed FROM dq_runs", base).collect()
    assert [tuple(r) for r in runs] == [(done["updated"], 1)]
    assert lake.query(spark, "SELECT count(*) FROM dq_failures", base).first()[0] == 1 and lake.query(spark, "SELECT symbol FROM dq_drift", base).first()[0] == "PPI"
    assert not lake.exists(spark, f"{base}/staging/*")


def test_a_week_counts_what_could_not_be_checked(spark, base):
    from tidelake.plans import jobs

    own = {k: lake.load_bars(spark, base, k, "binance").select("date", "open", "high", "low", "close", "volume").toPandas() for k in ("BTCUSDT",)}
    fred, fut = (lake.load_series(spark, base, *k).select("date", "value").toPandas() for k in (("UNRATE", "fred"), ("BTC", "fut")))

    def refetch(source, name, start, end):
        if name == "XETH":
            raise RuntimeError("down")
        if name == "XBT":
            return own["BTCUSDT"][own["BTCUSDT"]["date"].dt.day != 3]
        if name == "LNS14":
            return fred.assign(value=fred["value"] + (fred["date"].dt.day == 2))
        return fut.rename(columns={"value": "funding_rate"}).assign(other=None)[["date", "funding_rate"]]

    pairs = spark.createDataFrame([("BTCUSDT", "ETHUSDT")], "symbol string, other string")
    done = jobs.weekly_run(spark, base, "2024-02-01 00:00:00", refetch, names_of(), pairs=pairs, parallel=2)
    assert (done["checked"], done["failed"], done["failures"].first().series) == (3, 1, "binance/ETHUSDT/1d")
    found = {(r.group, r.series_id, r.check, r.severity) for r in done["violations"].collect()}
    assert ("bars", "BTCUSDT", "self_consistency", "error") in found and ("series", "UNRATE", "self_consistency", "warn") in found
    assert ("bars", "BTCUSDT", "proxy_unavailable", "warn") in found
    assert lake.query(spark, "SELECT n_violations FROM dq_runs WHERE cadence = 'weekly'", base).first()[0] == len(found)


def test_the_tape_of_one_day_is_checked(spark, base):
    from tidelake.plans import jobs

    declared = spark.createDataFrame([("binance", "X", "book_ticker"), ("binance", "X", "depth")], "source string, symbol string, kind string")
    now = F.lit("2024-01-02 01:00:00").cast("timestamp")
    found = {(r.source, r.series_id, r.check) for r in jobs.run_checks(spark, base, now, declared=declared, disk_gb=(100.0, 1.0)).where("group IN ('microstructure', 'host')").collect()}
    assert found == {("binance", "X", "capture"), ("binance", "X", "activity"), ("coinbase", "X", "activity"), (None, None, "disk")}


def test_the_catalogue_is_written_with_health(spark, base):
    import json

    from tidelake.plans import jobs
    from tidelake.registry import Registry, Source

    registry = Registry([Source("binance", "bars", {"BTCUSDT": "BTCUSDT"}, "1d"), Source("ghost", "series", {"U": "U"})])
    path = f"{base}/catalogue.json"
    jobs.write_catalogue(spark, base, registry, "2024-01-11 00:00:00", path)
    with open(path) as f:
        rows = {r["source"]: r for r in json.load(f)["sources"]}
    assert rows["binance"]["n_rows"] == 20 and rows["binance"]["health"] == "ok" and rows["ghost"]["health"] == "unknown"
    assert {(r["group"], r["symbol"]) for r in jobs.drift(spark, base, registry).collect()} == {("series", "U")}


def test_a_published_lake_holds_what_may_leave(spark, base, tmp_path):
    from tidelake.plans import jobs
    from tidelake.registry import Registry, Source

    registry = Registry([
        Source("binance", "bars", {"BTCUSDT": "BTCUSDT"}, "1d", redistributable=True), Source("fred", "series", {"UNRATE": "UNRATE"}),
        Source("fut", "bars", {"BTC": "BTC"}, redistributable=True), Source("fredcal", "events", {"CPI": "CPI"}, redistributable=True),
    ])
    jobs.nightly(spark, base, "2024-03-01 00:00:00", registry)
    out = str(tmp_path / "public")
    done = jobs.publish_lake(spark, base, out, registry)
    assert set(done) == {"bars", "series", "events", "fct_bars_daily", "fct_series_features", "fct_events_revisions", "dim_sources", "dq_runs", "dq_violations"}
    sources = lambda path: {r.source for r in spark.read.parquet(f"{out}/{path}").select("source").distinct().collect()}
    assert sources("bronze/group=bars") == {"binance"} and sources("bronze/group=events") == {"fredcal"}
    assert sources("bronze/group=series") == set()  # fut may leave as bars, not as series
    assert sources("gold/fct_bars_daily") == {"binance"} and sources("gold/fct_series_features") == set() and sources("gold/fct_events_revisions") == {"fredcal"}
