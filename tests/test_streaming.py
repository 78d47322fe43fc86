"""Streams: the replayable source, handover, event-time tracking, sessions, anchored depth."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelake.streaming import capture, tape, tracker

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TICKS = "source string, symbol string, kind string, start_seq long, end_seq long, received_at long, arrival long"
HANDED = "source string, symbol string, kind string, connection int, seq long, received_at long, event string"
KEYS = ["source", "symbol", "kind"]


@pytest.fixture()
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield spark
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def messages(spark, n, streams=("btcusdt@trade", "ethusdt@trade"), first=0):
    rows = [(s, json.dumps({"stream": s, "data": {"t": i}}), 1000 + i) for s in streams for i in range(first, first + n)]
    return spark.createDataFrame(rows, "stream string, message string, received_at long")


def run(stream, tmp_path, batches=None):
    """Runs a stream into a folder; stops it after some batches, or when all is read."""
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        if batches is None:
            query.processAllAvailable()
        else:
            for _ in range(600):
                if (query.lastProgress.batchId if query.lastProgress else -1) >= batches - 1 or not query.isActive:
                    break
                query.awaitTermination(0.1)
    finally:
        query.stop()
    return query


def test_a_source_that_is_cut_between_batches_gives_each_message_once(spark, tmp_path):
    path = str(tmp_path / "landed")
    assert capture.land(messages(spark, 250), path, segment=40) == 14
    spark.dataSource.register(capture.landed("landed_feed", path, per_batch=60, per_task=25))
    stream = lambda: spark.readStream.format("landed_feed").load()
    run(stream(), tmp_path, batches=2)  # cut with most of the feed unread
    read = lambda: spark.read.schema(capture.MESSAGE).parquet(str(tmp_path / "out"))
    seen = read().count()
    assert 0 < seen < 500
    capture.land(messages(spark, 30, first=250), path, segment=40, start={"btcusdt@trade": 250, "ethusdt@trade": 250})
    run(stream(), tmp_path)
    rows = read().collect()
    assert sorted((r.stream, r.offset) for r in rows) == [(s, i) for s in ("btcusdt@trade", "ethusdt@trade") for i in range(280)]
    assert all(json.loads(r.message)["data"]["t"] == r.offset == r.received_at - 1000 for r in rows)


def test_a_feed_that_lacks_messages_raises_and_one_that_is_away_is_tried_again():
    away = iter([OSError("away"), OSError("away"), 7])

    def call():
        x = next(away)
        if isinstance(x, OSError):
            raise x
        return x

    waits = []
    assert capture.backoff(call, sleep=waits.append) == 7 and waits == [1.0, 2.0]
    with pytest.raises(OSError):
        capture.backoff(lambda: (_ for _ in ()).throw(OSError("gone")), attempts=9, sleep=waits.append)
    assert max(waits) == 60.0
    done = []
    reader = capture._FeedReader(lambda: {"a": 2}, lambda: {"a": 50, "b": 3}, lambda s, a, b: [(i, "m", i) for i in range(a, b) if i != 30], done.append, 20, 6)
    assert reader.initialOffset() == {"a": 2} and reader.latestOffset() == {"a": 22, "b": 3}
    spans = reader.partitions({"a": 2}, {"a": 22, "b": 3})
    assert [(p.stream, p.first, p.last) for p in spans] == [("a", 2, 8), ("a", 8, 14), ("a", 14, 20), ("a", 20, 22), ("b", 0, 3)]
    assert len(list(reader.read(spans[0]))) == 6 and reader.latestOffset()["a"] == 42
    with pytest.raises(ValueError, match="gave 31 for 30"):
        list(reader.read(capture.Span("a", 28, 34)))
    reader.commit({"a": 22})
    assert done == [{"a": 22}]


def stream_of(spark, tmp_path, rows, schema, parts):
    """A file stream of rows, a part of them a batch."""
    path = str(tmp_path / "in")
    for i, some in enumerate(parts(rows)):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(path)
        os.utime(next(p for p in sorted((tmp_path / "in").glob("*.parquet"), key=lambda p: p.stat().st_mtime)[::-1]), (1000 + i, 1000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def by(n):
    return lambda rows: [rows[i : i + n] for i in range(0, len(rows), n)]


def finished(stream, tmp_path, name="out"):
    query = stream.writeStream.format("parquet").option("path", str(tmp_path / name)).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start()
    assert query.awaitTermination(180)
    return query


def test_a_handover_drops_what_was_replayed_and_says_how_much(rocks, tmp_path):
    row = lambda c, s, at, e="message", sym="X": ("v", sym, "trades", c, s, at, e)
    old, new = [1, 2, 3, 4, 5], [3, 4, 5, 6, 7]
    rows = [row(0, s, 10 + s) for s in old[:3]] + [row(1, 3, 20), row(1, 4, 21)]  # the successor begins while the old one drains
    rows += [row(0, 4, 22), row(1, 5, 23), row(0, 5, 24), row(0, None, 25, "closed"), row(1, 6, 26), row(1, 7, 27), row(1, 7, 28)]
    rows += [row(1, None, 29, "closed"), row(2, 7, 30), row(2, None, 31), row(2, None, 32, "closed"), row(3, 9, 33)]  # 2 ends inside its overlap
    rows += [row(0, 1, 40, sym="Y"), row(0, None, 41, "closed", "Y"), row(1, 5, 42, sym="Y")]
    finished(capture.handed_over(stream_of(rocks, tmp_path, rows, HANDED, by(6))), tmp_path)
    got = rocks.read.parquet(str(tmp_path / "out")).collect()
    kept = lambda sym: [(r.connection, r.seq) for r in sorted((r for r in got if r.symbol == sym and r.event == "message"), key=lambda r: r.received_at)]
    assert [s for _, s in kept("X") if s is not None] == [1, 2, 3, 4, 5, 6, 7, 7, 9] and (2, None) in kept("X") and kept("Y") == [(0, 1), (1, 5)]
    handed = sorted((r.symbol, r.connection, r.floor, r.duplicates) for r in got if r.event == "handover")
    assert handed == [("X", 1, 5, 3), ("X", 2, 7, 1), ("X", 3, 7, 0), ("Y", 1, 1, 0)]
    assert new[:3] == [3, 4, 5]


def test_handover_equals_the_batch_form(rocks, tmp_path):
    rng = np.random.default_rng(2)
    old, new = [], []
    for sym in "ABC":
        ids = np.arange(100, 220)
        old += [("v", sym, "trades", 0, int(i), int(1000 + i), "message") for i in ids[:80]] + [("v", sym, "trades", 0, None, 1185, "closed")]
        new += [("v", sym, "trades", 1, int(i), int(2000 + i), "message") for i in ids[int(rng.integers(40, 80)) :]]
    finished(capture.handed_over(stream_of(rocks, tmp_path, old + new, HANDED, by(90))), tmp_path)
    got = {r.symbol: (r.n_kept, r.n_duplicates) for r in rocks.read.parquet(str(tmp_path / "out")).where("connection = 1").groupBy("symbol").agg(F.count_if(F.col("event") == "message").alias("n_kept"), F.sum("duplicates").alias("n_duplicates")).collect()}
    frame = lambda rows: rocks.createDataFrame(rows, HANDED)
    floors = frame(old).groupBy(*KEYS).agg(F.max("seq").alias("floor"))
    assert got == {r.symbol: (r.n_kept, r.n_duplicates) for r in tape.overlap_counts(frame(new), floors, KEYS, "seq").collect()}


@pytest.mark.parametrize("cut", [400, 150])
def test_a_handover_takes_a_micro_batch_in_any_order(rocks, tmp_path, cut):
    old = [("v", "A", "trades", 0, i, 1000 + i, "message") for i in range(100)] + [("v", "A", "trades", 0, None, 1100, "closed")]
    new = [("v", "A", "trades", 1, i, 2000 + i, "message") for i in range(50, 200)]
    late = [("v", "A", "trades", 0, i, 3000 + i, "message") for i in (40, 199, 250)]  # after the close: two were brought by somebody
    rng = np.random.default_rng(4)
    first, second = old + new[:49], new[49:] + late
    rows = [r for part in (first, second) for r in (part[i] for i in rng.permutation(len(part)))] if cut == 150 else [(old + new)[i] for i in rng.permutation(251)] + late
    finished(capture.handed_over(stream_of(rocks, tmp_path, rows, HANDED, lambda rows: [rows[: min(cut, 251)], rows[min(cut, 251) :]])), tmp_path)
    got = rocks.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.seq for r in got if r.event == "message") == [*range(200), 250]
    assert [(r.connection, r.received_at, r.floor, r.duplicates) for r in got if r.event == "handover"] == [(1, 2050, 99, 50)]


END = ("v", "END", "trades", 0, 0, 10**9, 10**6)


@pytest.mark.parametrize("contiguous", [True, False])
def test_tracking_in_event_time_equals_the_batch_form(rocks, tmp_path, contiguous):
    rng = np.random.default_rng(5)
    ids = np.cumsum(rng.choice([1, 1, 1, 3, -2], 400)) + 100
    rows = [("v", "XY"[n % 2], "trades", int(i), int(i), 1_000_000 + 40 * n, n) for n, i in enumerate(ids)] + [("v", "Y", "trades", 5, None, 1_000_000, 900)]
    frame = rocks.createDataFrame(rows, TICKS)
    batch = tape.sequence_gaps(frame, KEYS, ["received_at", "arrival"]) if contiguous else tape.order_breaks(frame.where("end_seq IS NOT NULL"), KEYS, ["received_at", "arrival"], "end_seq")
    mixed = rows[:]
    for a in range(0, 400, 50):  # out of order within the delay
        part = mixed[a : a + 50]
        rng.shuffle(part)
        mixed[a : a + 50] = [tuple(x) for x in part]
    mixed = [(a, b, c, int(d), None if e is None else int(e), int(f), int(g)) for a, b, c, d, e, f, g in mixed]
    stream = stream_of(rocks, tmp_path, [*mixed, END], TICKS, lambda r: [*by(37)(r[:-1]), r[-1:]])
    finished(tracker.stream_gaps(stream, contiguous, delay="5 seconds", idle_ms=10_000), tmp_path)
    got = sorted((tuple(r) for r in rocks.read.parquet(str(tmp_path / "out")).collect()), key=repr)
    assert got == sorted((tuple(r) for r in batch.select(*KEYS, "last_seq", "next_seq", "missing_count").collect()), key=repr) and got


def test_late_ids_move_nothing_and_state_ends_after_silence(rocks, tmp_path):
    row = lambda sym, i, at: ("v", sym, "trades", i, i, at, i)
    parts = [[row("X", i, 1000 + i) for i in range(1, 11)], [row("Y", 1, 60_000)], [row("X", 99, 1005), row("X", 11, 61_000), row("Y", 2, 61_000)], [row("Y", 5, 200_000)], [row("Z", 1, 900_000)], [row("Z", 2, 900_001)]]
    stream = stream_of(rocks, tmp_path, parts, TICKS, lambda p: p)
    query = finished(tracker.stream_gaps(stream, delay="5 seconds", idle_ms=100_000), tmp_path)
    rows = {tuple(r)[1:] for r in rocks.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {("Y", "trades", 2, 5, 2)}  # the late 99 of X is no gap, nor is 11 after it
    sizes = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert max(sizes) > sizes[-1]


def test_a_session_counts_all_its_batches_and_stops_on_a_live_source(spark, tmp_path):
    kind = "source string, kind string, symbol string, reason string, received_at long"
    src = str(tmp_path / "in")
    for i in range(12):
        spark.createDataFrame([("v", "trades", "X", None, 1704067200000 + i)] * 4 + [("v", "gaps", "X", "sequence_jump" if i % 3 else "handover", 1704067200000 + i)], kind).coalesce(1).write.mode("append").parquet(src)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 2)
    try:
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(src)
        run = capture.Capture(stream, str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "sessions"), 1, "0 seconds", capture.is_gap())
        run.query.processAllAvailable()
        assert run.stop(9) == 60 == spark.read.parquet(str(tmp_path / "out")).count()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    marks = sorted((r.event, r.at_ms, r.message_count, r.gap_count) for r in spark.read.parquet(str(tmp_path / "sessions")).collect())
    assert marks == [("start", 1, 0, 0), ("stop", 9, 60, 8)]


def test_a_session_on_an_endless_source_stops_and_goes_on_from_its_checkpoint(spark, tmp_path):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 2000).load()
    rows = rate.select(F.lit("v").alias("source"), F.lit("trades").alias("kind"), F.lit("X").alias("symbol"), F.unix_millis("timestamp").alias("received_at"), "value")
    total = 0
    for n in range(2):
        run = capture.Capture(rows, str(tmp_path / "out"), str(tmp_path / "cp"), str(tmp_path / "sessions"), n, "0 seconds")
        run.query.awaitTermination(3)
        total += run.stop(n + 1, wait=20)
    written = spark.read.parquet(str(tmp_path / "out"))
    assert total == written.count() == written.select("value").distinct().count() > 0


def brute_depth(deltas, snapshots):
    out, past = [], {}
    for key, at, first, final in sorted(deltas, key=lambda d: (d[0], d[1], d[3], d[2])):
        before = [s for s in snapshots if s[0] == key and s[1] <= at]
        if not before:
            out.append((key, at, first, final, None, None, "unanchored", None))
            continue
        anchor = max((s[1], s[2]) for s in before)
        if final <= anchor[1]:
            out.append((key, at, first, final, *anchor, "stale", None))
            continue
        known = past.get((key, anchor))
        lacks = max(0, first - (anchor[1] if known is None else known) - 1)
        out.append((key, at, first, final, *anchor, "gap" if lacks else "anchor" if known is None else "ok", lacks))
        past[key, anchor] = final
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [7, 50, 10**6])
def test_depth_is_held_to_the_snapshot_before_it(spark, width):
    rng = np.random.default_rng(width)
    deltas, snapshots = [], []
    for key in ("A", None, "B"):
        u = 100
        for at in sorted(rng.integers(0, 300, 120).tolist()):
            first = u + 1 + int(rng.choice([0, 0, 0, 2, -1]))
            u = max(u, first + int(rng.integers(0, 3)))
            deltas.append((key or "N", at, first, u))
            if rng.random() < 0.05:
                snapshots.append((key or "N", at, u - int(rng.integers(-2, 6))))
    got = tape.anchored_depth(spark.createDataFrame(deltas, "symbol string, received_at long, first_update_id long, final_update_id long"), spark.createDataFrame(snapshots, "symbol string, received_at long, last_update_id long"), ["symbol"], width)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_depth(deltas, snapshots)
