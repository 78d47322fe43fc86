"""Operators on small tables with known answers."""

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelake.functions.columns import average_rank, correlation, last_of, to_double
from tidelake.operators import align, checks, statistics, upkeep, verify
from tidelake.registry import Registry, Source, dashed_symbol
from tidelake.sources import payloads, rest
from tidelake.streaming import tape


def test_alignment_fills_forward_between_the_common_ends(spark):
    rows = [("a", 0, 100.0), ("a", 3, 101.0), ("a", 6, 102.0), ("b", 2, 200.0), ("b", 5, 201.0), ("b", 8, 202.0)]
    quotes = spark.createDataFrame([(s, "X", t * 1000, t, m) for s, t, m in rows], "source string, symbol string, received_at long, update_id long, mid double")
    got = {r.bucket: (r.base_mid, r.quote_mid) for r in align.aligned_mids(quotes, "a", "b").collect()}
    assert sorted(got) == [2, 3, 4, 5, 6] and got[4] == (101.0, 200.0)


def test_basis_in_points(spark):
    got = spark.createDataFrame([(100.0, 100.5), (100.0, 99.5)], "b double, q double").select(align.basis_bps(F.col("b"), F.col("q")).alias("basis_bps"))
    r = align.basis_summary(got.withColumn("k", F.lit(1)), ["k"]).first()
    assert (r.n, r.mean_bps, r.min_bps, r.max_bps, r.share_positive) == (2, pytest.approx(0), pytest.approx(-50), pytest.approx(50), 0.5)


def test_lead_is_found(spark):
    rng = np.random.default_rng(0)
    base = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, 62)))
    rows = [("X", i, float(base[i]), float(base[i - 2])) for i in range(2, 62)]
    aligned = spark.createDataFrame(rows, "symbol string, bucket long, base_mid double, quote_mid double")
    peak = align.peak_lag(align.lead_lag(aligned, ["symbol"]), ["symbol"], 1000).first()
    assert (peak.lag, peak.lag_ms, peak.leader) == (2, 2000, "base") and peak.corr == pytest.approx(1)


def test_numbers_nulls_and_ranks_as_defined(spark):
    rows = [(v,) for v in ("1.5", " 2 ", "1d", "1f", "1_000", "1,2", "", None, "1e3", "NaN", "-.5", "0x1")]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").select(to_double(F.col("v"))).collect()]
    assert got[:9] == [1.5, 2.0, None, None, None, None, None, None, 1000.0] and got[9] != got[9] and got[10:] == [-0.5, None]
    k = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, None)], "k int, v double")
    assert k.agg(last_of(F.col("v"), F.col("k"))).first()[0] == 20.0
    assert k.agg(correlation(F.lit(1.0), F.col("v"))).first()[0] is None
    x = pd.Series(np.random.default_rng(1).integers(0, 9, 40).astype(float))
    ranked = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, v double").select("i", average_rank(Window.orderBy("v"), Window.partitionBy("v")).alias("r"))
    assert [r.r for r in ranked.orderBy("i").collect()] == x.rank().tolist()


def days(n, start="2024-01-01"):
    return [date.fromisoformat(start) + timedelta(i) for i in range(n)]


def bars(spark, rows):
    return spark.createDataFrame(rows, "source string, symbol string, date date, open double, high double, low double, close double, volume double")


def test_good_bars_pass_and_damage_is_named(spark):
    good = [("s", "X", d, 10.0, 11.0, 9.0, 10.5 + i * 0.01, 5.0) for i, d in enumerate(days(3))]
    now = F.lit("2024-01-05").cast("date")
    assert verify.verify_bars(bars(spark, good), ["source", "symbol"], now).count() == 0
    bad = [*good, ("s", "X", date(2024, 1, 3), 10.0, 9.0, 9.0, 99.0, -1.0), ("s", "X", date(2025, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0)]
    found = {r.check for r in verify.verify_bars(bars(spark, bad), ["source", "symbol"], now).collect()}
    assert {"index", "ohlc_coherent", "volume", "future_dates", "returns"} <= found
    assert verify.verify_bars(bars(spark, []), ["source", "symbol"], now).first().check == "empty"
    assert verify.structure(bars(spark, good).drop("close"), "bars").first().check == "columns"
    assert verify.structure(bars(spark, good), "nope").first().check == "group"


def test_proxy_holds_breaks_and_freezes(spark):
    rng = np.random.default_rng(3)
    n, rho = 900, 0.85
    x = rng.normal(0, 1, n)
    y = rho * x + (1 - rho**2) ** 0.5 * rng.normal(0, 1, n)
    broken, frozen = y.copy(), y.copy()
    broken[-180:] = rng.normal(0, 1, 180)
    frozen[-180:] = 0.0
    rows = [(p, d, float(a), float(b)) for p, s in (("ok", y), ("broken", broken), ("frozen", frozen), ("other", rng.normal(0, 1, n))) for d, a, b in zip(days(n, "2020-01-01"), x, s)]
    states = verify.proxies(spark.createDataFrame(rows, "pair string, date date, x double, y double"), ["pair"])
    got = {r.pair: r for r in states.collect()}
    assert {p: r.state for p, r in got.items()} == {"ok": "holds", "broken": "broken", "frozen": "frozen", "other": "unrelated"}
    roll = pd.Series(x[:-180]).rolling(180).corr(pd.Series(y[:-180])).min()
    assert got["ok"].floor == pytest.approx(min(0.30, roll))
    verdict = verify.proxy_verdicts(spark.createDataFrame([("a", "broken"), ("a", "holds"), ("b", "broken"), ("c", "unrelated")], "k string, state string"), "k")
    assert dict(verdict.collect()) == {"a": "holds", "b": "broken", "c": "proxy_unavailable"}


def test_third_source_adjudicates(spark):
    rows = [(s, "X", d, 1.0, 1.0, 1.0, float((100 + i) * f), 1.0) for s, f in (("us", 100), ("peer", 1), ("third", 1), ("friend", 100)) for i, d in enumerate(days(10))]
    b = bars(spark, rows)
    assert verify.adjudicate(b, "us", "peer", "third", ["symbol"]).first().severity == "error"
    assert verify.adjudicate(b, "us", "peer", "friend", ["symbol"]).first().severity == "warn"


def test_last_write_wins_twice_is_once(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "B", 1.0), (3, "c", 2.0)], "k int, v string, w double")
    once = upkeep.last_write_wins(a, b, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", None), (2, "B", 1.0), (3, "c", 2.0)]
    assert upkeep.unchanged(once, upkeep.last_write_wins(once, b, ["k"]))
    assert upkeep.schema_drift(a, b) == ([], ["w"])


def test_unknown_streams_raise_and_unknown_types_go(spark):
    m = spark.createDataFrame([('{"stream":"btcusdt@trade","data":{"s":"BTCUSDT","t":7,"p":"1.10","q":"2","T":1,"E":2,"m":true}}', 9), ('{"stream":"x@kline"}', 9)], "message string, received_at long")
    with pytest.raises(Exception, match="unknown stream"):
        tape.route(m).collect()
    t = tape.trades(tape.route(m.where("message LIKE '%@trade%'"))).first()
    assert (t.symbol, t.trade_id, t.price, t.buyer_is_maker) == ("BTCUSDT", 7, "1.10", True)
    assert tape.route(m, "type", strict=False).count() == 0


def test_vintages_number_revisions_and_carry_the_initial_print(spark):
    rows = [("U", date(2024, 1, 1), date(2024, 2, 1), 2.1), ("U", date(2024, 1, 1), date(2024, 3, 1), 2.4), ("U", date(2024, 2, 1), date(2024, 3, 5), 3.0), ("U", date(2024, 2, 1), date(2024, 3, 6), None)]
    got = payloads.events_from_vintages(spark.createDataFrame(rows, "series_id string, ref_date date, realtime_start date, value double"))
    assert sorted((r.event_id, r.revision_seq, r.actual, r.previous, r.scheduled_ts) for r in got.collect()) == [
        ("U:2024-01-01", 0, 2.1, None, date(2024, 2, 1)), ("U:2024-01-01", 1, 2.4, None, date(2024, 2, 1)), ("U:2024-02-01", 0, 3.0, 2.1, date(2024, 3, 5))
    ]


def test_payloads_parse(spark):
    one = lambda body, **k: spark.createDataFrame([(body, *k.values())], "body string, " + ", ".join(f"{n} string" for n in k))
    k = payloads.positional_klines(one('[[1704067200000,"1","2","0.5","1.5","9",0]]', symbol="X")).first()
    assert (k.date, k.open, k.close, k.volume) == (datetime(2024, 1, 1), 1.0, 1.5, 9.0)
    p = payloads.pair_ohlc(one('{"result":{"XBT":[[1704067200,"1","2","0","1.5","x","9",3],[1704067200,"1","2","0","1.7","x","9",3]],"last":5}}', symbol="X")).collect()
    assert len(p) == 1 and p[0].close == 1.7
    o = payloads.observations(one('{"observations":[{"date":"2024-01-01","value":"."},{"date":"2024-02-01","value":"3.5"}]}', series_id="U")).collect()
    assert [r.value for r in o] == [None, 3.5]
    f = payloads.funding(one('[{"fundingTime":1704067200000,"fundingRate":"0.0001","markPrice":""}]', symbol="X")).first()
    assert (f.funding_rate, f.mark_price) == (0.0001, None)
    lines = spark.createDataFrame([("V", "DATE,OPEN,CLOSE"), ("V", "01/02/2024,13.1,13.2")], "series_id string, line string")
    assert [(r.date, r.value) for r in payloads.csv_last_column(lines).collect()] == [(datetime(2024, 1, 2), 13.2)]
    m = payloads.renamed_metrics(one('[{"d":"2024-01-02","a":"5"}]', series_id="C"), "d", {"a": "longs", "b": "shorts"}).first()
    assert (m.longs, m.shorts) == (5.0, None)
    with pytest.raises(Exception):
        payloads.adjusted_eod(one('[{"date":"nonsense","adjOpen":"1"}]', symbol="X")).collect()


def test_paging_stops_repeats_and_retries(spark):
    book = {0: rest.Page([1, 2], 1), 1: rest.Page([3], None)}
    assert list(rest.pages(0, book.get)) == [[1, 2], [3]]
    with pytest.raises(RuntimeError, match="repeats"):
        list(rest.pages(0, lambda c: rest.Page([1], 0)))
    with pytest.raises(RuntimeError, match="more than"):
        list(rest.pages(0, lambda c: rest.Page([1], c + 1), most=5))
    answers, slept = [(503, ""), (429, ""), (200, "ok")], []
    assert rest.with_retries(lambda: answers.pop(0), sleep=slept.append) == "ok" and slept == [1, 2]
    with pytest.raises(RuntimeError, match="404"):
        rest.with_retries(lambda: (404, ""), sleep=slept.append)
    rows = rest.fetch_all(spark, ["A", "B"], lambda s: 0, lambda s, c: rest.Page([[s, c]], 1 if c == 0 else None)).collect()
    assert sorted((r.symbol, r.page) for r in rows) == [("A", 0), ("A", 1), ("B", 0), ("B", 1)]


def test_registry_guards_its_names(spark):
    a = Source("v", "bars", {"BTCUSDT": "BTC"}, redistributable=True)
    with pytest.raises(ValueError):
        Registry([a, a])
    with pytest.raises(ValueError):
        Source("w", "bars", {})
    r = Registry([a, Source("v", "series", {"U": "U"})])
    assert r.get("bars", "v").native("BTCUSDT") == "BTC" and dashed_symbol("BTCUSDT") == "BTC-USD"
    with pytest.raises(ValueError):
        a.native("ETH")
    assert [tuple(x) for x in r.allowed(spark).collect()] == [("bars", "v")] and r.declared(spark).count() == 2


def test_host_checks(spark):
    assert checks.disk(spark, 100, 50).count() == 0
    assert checks.disk(spark, 100, 5).first().severity == "error" and checks.disk(spark, 100, 15).first().severity == "warn"
    files = spark.createDataFrame([(f"/l/date=2024-01-0{d}/p{i}",) for d, n in ((1, 60), (2, 210), (3, 9), (5, 300)) for i in range(n)], "path string")
    got = [(r.severity, r.detail) for r in checks.small_files(files, F.lit("2024-01-05").cast("date")).collect()]
    assert got == [("error", "210 files in /l/date=2024-01-02"), ("warn", "60 files in /l/date=2024-01-01")]


def test_implied_missing_skips_weekends(spark):
    work = [d for d in days(40) if d.weekday() < 5]
    lost = [d for d in work if d not in (date(2024, 1, 10), date(2024, 1, 15))]
    rows = spark.createDataFrame([("s", d) for d in lost], "source string, date date")
    assert statistics.implied_missing(rows, ["source"]).first().n_missing == 2


def test_a_trial_passes_fails_and_skips(spark):
    from tidelake.operators import contracts

    rows = [("new", "X", d, 10.0, 15.0, 9.0, 10.0 + i % 5, 5.0) for i, d in enumerate(days(30))]
    lit = lambda t: F.lit(t).cast("date")
    run = lambda a, b, **k: {r.stage: r.outcome for r in contracts.trial(spark, a, b, lit("2024-01-01"), lit("2024-01-31"), lit("2024-02-01"), **k).collect()}
    good = bars(spark, rows)
    assert run(good, good) == dict.fromkeys(("contract", "frame", "determinism", "range", "completeness"), "passed") | dict.fromkeys(("pagination", "peer_completeness", "cross_source"), "skipped")
    peer = good.withColumn("source", F.lit("old"))
    staged = run(good, good, stored=peer, peer="old")
    assert staged.pop("pagination") == "skipped" and set(staged.values()) == {"passed"}
    thin = bars(spark, [r for i, r in enumerate(rows) if i % 6 != 5])
    got = run(thin, good, stored=peer, peer="old")
    assert (got["determinism"], got["completeness"], got["peer_completeness"]) == ("failed", "failed", "failed")
    assert run(good.drop("close"), good) == {"contract": "failed"}
    assert contracts.negative(good, "low").count() == 0


def test_streams_in_pieces_are_streams_whole(spark):
    rng = np.random.default_rng(11)
    ids = np.cumsum(rng.choice([1, 1, 1, 4, -3], 400)) + 1000
    at = np.cumsum(rng.integers(0, 40, 400)) + rng.choice([0, 5000], 400).cumsum()
    rows = [(s, int(i), int(i), int(t), n) for s in ("A", "B") for n, (i, t) in enumerate(zip(ids, at))] + [("A", None, None, 5, 900), ("C", 1, 2, None, 1)]
    frame = spark.createDataFrame(rows, "symbol string, start_seq long, end_seq long, received_at long, arrival long")
    for f, seq in ((tape.sequence_gaps, {}), (tape.order_breaks, {"seq": "end_seq"})):
        src = frame if f is tape.sequence_gaps else frame.where("end_seq IS NOT NULL")
        whole, pieces = (sorted(map(str, f(src, ["symbol"], ["received_at", "arrival"], width=w, **seq).collect())) for w in (1 << 40, 700))
        assert whole == pieces and len(whole) > 50
    plan = tape.sequence_gaps(frame, ["symbol"], ["received_at", "arrival"])._jdf.queryExecution().optimizedPlan().toString()
    assert "__chunk" in plan.split("windowspecdefinition(")[1].split(")")[0]


def test_grids_in_blocks_are_grids_whole(spark, monkeypatch):
    from tidelake.operators import align

    rng = np.random.default_rng(12)
    rows = [("X", int(b), float(b) if rng.random() < 0.5 else None, float(-b) if rng.random() < 0.5 else None) for b in sorted(rng.choice(3000, 120, replace=False))]
    rows += [("Y", 5, 1.0, None), ("Z", 1, 1.0, None), ("Z", 2000, None, 2.0), ("Z", 2001, 3.0, None)]
    wide = spark.createDataFrame(rows, "symbol string, bucket long, base_mid double, quote_mid double")
    whole = sorted(map(tuple, align.forward_filled(wide, ["symbol"]).collect()))
    monkeypatch.setattr(align, "BLOCK", 64)
    assert sorted(map(tuple, align.forward_filled(wide, ["symbol"]).collect())) == whole
    x = [r for r in rows if r[0] == "X"]
    lo = max(next(r[1] for r in x if r[2] is not None), next(r[1] for r in x if r[3] is not None))
    hi = min(max(r[1] for r in x if r[2] is not None), max(r[1] for r in x if r[3] is not None))
    last = lambda b, c: [r[c] for r in x if r[1] <= b and r[c] is not None][-1]
    assert [r for r in whole if r[0] == "X"] == [("X", b, last(b, 2), last(b, 3)) for b in range(lo, hi + 1)]
    assert [r for r in whole if r[0] == "Z"] == [("Z", 2000, 1.0, 2.0)]


def test_lags_skip_holes_of_the_grid(spark):
    from tidelake.operators import align

    rng = np.random.default_rng(13)
    price = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, 200)))
    rows = [("X", int(b), float(price[b]), float(price[b - 2])) for b in range(2, 200)]
    got = {r.lag: r for r in align.lead_lag(spark.createDataFrame(rows, "symbol string, bucket long, base_mid double, quote_mid double"), ["symbol"], 3).collect()}
    assert got[2].corr == pytest.approx(1.0) and got[2].n == 195 and abs(got[0].corr) < 0.4
    holes = [r for r in rows if r[1] % 10]
    n = {r.lag: r.n for r in align.lead_lag(spark.createDataFrame(holes, "symbol string, bucket long, base_mid double, quote_mid double"), ["symbol"], 1).collect()}
    assert n[1] < n[0]


def test_messages_of_both_venues_decode(spark):
    raw = [
        ('{"type":"match","product_id":"BTC-USD","trade_id":7,"price":"1.10","size":"2","side":"buy","time":"t","sequence":9}', 5),
        ('{"type":"snapshot","product_id":"BTC-USD","bids":[["1.0","2"]],"asks":[]}', 5),
        ('{"type":"l2update","product_id":"BTC-USD","changes":[["buy","1.0","0"]],"time":"t"}', 5),
        ('{"type":"subscriptions"}', 5),
    ]
    routed = tape.route(spark.createDataFrame(raw, "message string, received_at long"), "type", strict=False)
    t = tape.decode(routed, "trades", "type").first()
    assert (t.symbol, t.trade_id, t.price, t.quantity, t.sequence) == ("BTCUSDT", 7, "1.10", "2", 9)
    s = tape.decode(routed, "snapshot", "type").first()
    assert (s.bids, s.asks, s.snapshot_time) == ([["1.0", "2"]], [], None)
    assert tape.decode(routed, "depth", "type").first().changes == [["buy", "1.0", "0"]]
    with pytest.raises(Exception, match="feed error"):
        tape.route(spark.createDataFrame([('{"type":"error","message":"no"}', 1)], "message string, received_at long"), "type", strict=False).collect()


def test_a_paged_source_is_a_data_source(spark):
    def fetch(symbol, cursor):
        return rest.Page([[symbol, cursor]], cursor + 1 if cursor < 2 else None) if symbol != "NONE" else rest.Page([])

    spark.dataSource.register(rest.paged_source("pages_of_a_vendor", lambda symbol: 0, fetch))
    rows = spark.read.format("pages_of_a_vendor").option("symbols", "A,B").load()
    assert rows.rdd.getNumPartitions() == 2
    assert sorted((r.symbol, r.page, r.body) for r in rows.collect()) == [(s, k, f'[["{s}", {k}]]') for s in "AB" for k in range(3)]
    with pytest.raises(Exception, match="NONE"):
        spark.read.format("pages_of_a_vendor").option("symbols", "NONE").load().collect()


def test_forward_reading_probes_before_data_and_ends_after():
    listed, asked = {250: [250, 260], 261: [270]}, []

    def fetch(at):
        asked.append(at)
        return next((rows for t, rows in listed.items() if at == t), [250, 260] if at == 200 else [])

    assert list(rest.forward(0, 1000, fetch, lambda t: t, probe_ms=100)) == [[250, 260], [270]]
    assert asked == [0, 100, 200, 261, 271]
    assert list(rest.forward(0, 300, lambda at: [], lambda t: t, probe_ms=100)) == []


def test_a_trial_without_a_peer_is_held_to_a_calendar(spark):
    from tidelake.operators import contracts

    lit = lambda t: F.lit(t).cast("date")
    week = statistics.weekdays(spark, "2024-01-01", "2024-01-31")
    rows = [("new", "X", d, 10.0, 15.0, 9.0, 10.0 + i % 5, 5.0) for i, d in enumerate(days(30)) if d.weekday() < 5]
    run = lambda some: {r.stage: r.outcome for r in contracts.trial(spark, bars(spark, some), bars(spark, some), lit("2024-01-01"), lit("2024-01-31"), lit("2024-02-01"), calendar=week).collect()}
    assert run(rows)["calendar_completeness"] == "passed" and run([r for i, r in enumerate(rows) if i % 4 != 2])["calendar_completeness"] == "failed"


def test_a_constant_series_stays_one_when_parts_of_it_are_added_up(spark):
    close = F.when(F.col("id") % 2 == 0, 1.5).otherwise(1.0 + (F.col("id") % 4 - 1) * 2.0**-53)  # the others differ in their last bit
    rows = spark.range(0, 376, 1, 4).select((F.col("id") % 2).cast("string").alias("source"), F.lit("X").alias("symbol"), close.alias("close"))
    assert [tuple(r) for r in verify.constant(rows, ["source", "symbol"]).collect()] == [("0", "X", 188)]
