"""Registered queries: streams made of the events table, anchored depth, marts in part, calendar, trials, mirrors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions import calendar
from tidelake.operators import contracts
from tidelake.plans import gold, marts
from tidelake.plans import standins as st
from tidelake.plans.catalogue import _FEATURES, day, query, rounded
from tidelake.session import work_path
from tidelake.sources import fleet, mirror
from tidelake.streaming import capture, tape, tracker

# Streams


@query(
    "stream_messages_once",
    """SELECT 'user' || CAST(user_id % 3 AS VARCHAR) || '@trade' AS stream, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS offset, event_id AS trade_id, epoch_us(ts) // 1000 AS received_at, 'trades' AS kind FROM events""",
)
def stream_messages_once(spark, d):
    """All events as messages of a landed feed, read by a stream that is stopped and started again on its way."""
    rows = st.read(spark, d, "events")
    stream = F.concat(F.lit("user"), (F.col("user_id") % 3).cast("string"), F.lit("@trade"))
    message = F.to_json(F.struct(stream.alias("stream"), F.struct(F.col("event_id").alias("t")).alias("data")))
    path = work_path(spark, "landed")
    capture.land(rows.select(stream.alias("stream"), message.alias("message"), F.unix_millis(F.col("ts").cast("timestamp")).alias("received_at"), "event_id"), f"{path}/feed", order=["event_id"])
    name = f"feed_{path[-12:]}"
    spark.dataSource.register(capture.landed(name, f"{path}/feed", per_batch=40_000, per_task=10_000))
    read = lambda: tape.route(spark.readStream.format(name).load())
    query = read().writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").start()
    try:
        query.awaitTermination(2)  # wherever that is
    finally:
        query.stop()
    got = capture.drained(read(), path, now=False)
    return got.select("stream", "offset", F.get_json_object("message", "$.data.t").cast("bigint").alias("trade_id"), "received_at", "kind")


_KEYED = f"WITH {st.QUOTES}, tops AS (SELECT source, symbol, max(update_id) AS top FROM quotes GROUP BY 1, 2)"


@query(
    "stream_handover",
    f"""{_KEYED}, old AS (SELECT q.source, q.symbol, q.update_id, top FROM quotes q JOIN tops t ON q.source = t.source AND q.symbol = t.symbol WHERE update_id <= top // 2), floors AS (SELECT source, symbol, max(update_id) AS floor FROM old GROUP BY 1, 2)
SELECT q.source AS source, q.symbol AS symbol, count(*) FILTER (WHERE update_id > floor) AS n_kept, count(*) FILTER (WHERE update_id <= floor) AS n_duplicates, max(floor) AS floor
FROM quotes q JOIN tops t ON q.source = t.source AND q.symbol = t.symbol JOIN floors f ON q.source = f.source AND q.symbol = f.symbol WHERE update_id > top // 4 GROUP BY 1, 2""",
)
def stream_handover(spark, d):
    """Each stream of quotes over two connections: the second begins at a quarter of its ids, the first ends at half."""
    rows = st.quotes(spark, d)
    keys = ["source", "symbol"]
    tops = rows.groupBy(*keys).agg(F.max("update_id").alias("top"))
    rows = rows.join(tops, keys)
    row = lambda some, connection, event: some.select(*keys, F.lit("quotes").alias("kind"), F.lit(connection).alias("connection"), "seq", "received_at", F.lit(event).alias("event"))
    old = row(rows.where("update_id <= top div 2").withColumn("seq", F.col("update_id")), 0, "message")
    ends = old.groupBy(*keys).agg(F.max("received_at").alias("received_at")).withColumn("seq", F.lit(None).cast("bigint"))
    new = row(rows.where("update_id > top div 4").withColumn("seq", F.col("update_id")), 1, "message")
    path = work_path(spark, "handover")
    for part in (old, row(ends, 0, "closed"), new):  # a stream's rows of a part lie in one file, in order
        part.repartition(*keys).sortWithinPartitions(*keys, "seq").write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(new.schema).parquet(f"{path}/in")
    got = capture.drained(capture.handed_over(stream), path).where("connection = 1")
    return got.groupBy(*keys).agg(F.count_if(F.col("event") == "message").alias("n_kept"), F.sum("duplicates").alias("n_duplicates"), F.max("floor").alias("floor"))


_JUMPS = f"""WITH {st.QUOTES}, seq AS (SELECT source, symbol, update_id AS start_seq, lag(update_id) OVER (PARTITION BY source, symbol ORDER BY received_at, update_id) AS last_seq FROM quotes)"""


@query("stream_gaps_event_time", f"{_JUMPS} SELECT source, symbol, 'quotes' AS kind, last_seq, start_seq AS next_seq, start_seq - last_seq - 1 AS missing_count FROM seq WHERE start_seq > last_seq + 1")
def stream_gaps_event_time(spark, d):
    """Jumps of each stream of quotes, tracked in event time; a last row of a stream of its own moves the watermark on."""
    rows = st.quotes(spark, d).select("source", "symbol", F.lit("quotes").alias("kind"), F.col("update_id").alias("start_seq"), F.col("update_id").alias("end_seq"), "received_at", F.col("update_id").alias("arrival"))
    last = rows.agg(F.max("received_at").alias("at")).select(*(F.lit("end").alias(c) for c in ("source", "symbol", "kind")), F.lit(0).cast("bigint").alias("start_seq"), F.lit(0).cast("bigint").alias("end_seq"), (F.col("at") + 10 * 86_400_000).alias("received_at"), F.lit(0).cast("bigint").alias("arrival"))
    path = work_path(spark, "tracked")
    rows.unionByName(last).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    return capture.drained(tracker.stream_gaps(stream, delay="1 day", slot_ms=86_400_000), path)


# Anchored depth: every event is a change of one to five updates, every fiftieth also a snapshot


_DEPTH = f"""WITH {st.QUOTES.replace("epoch_ms(ts)", "epoch_us(ts) // 1000")}, deltas AS (SELECT source, symbol, received_at, update_id AS first_update_id, update_id + update_id % 5 AS final_update_id FROM quotes),
snaps AS (SELECT source, symbol, received_at, max(update_id + update_id % 7 - 3) AS last_update_id FROM quotes WHERE update_id % 50 = 7 GROUP BY 1, 2, 3),
anchored AS (SELECT d.source AS source, d.symbol AS symbol, d.received_at AS received_at, first_update_id, final_update_id, s.received_at AS anchor_at, last_update_id AS anchor_id
    FROM deltas d ASOF LEFT JOIN snaps s ON d.source = s.source AND d.symbol = s.symbol AND d.received_at >= s.received_at),
fresh AS (SELECT *, anchor_id IS NOT NULL AND final_update_id > anchor_id AS is_fresh FROM anchored),
chained AS (SELECT *, lag(final_update_id) OVER (PARTITION BY source, symbol, anchor_at, is_fresh ORDER BY received_at, final_update_id, first_update_id) AS past FROM fresh)"""


@query(
    "anchored_depth",
    f"""{_DEPTH} SELECT source, symbol, received_at, first_update_id, final_update_id, anchor_at, anchor_id,
    CASE WHEN anchor_id IS NULL THEN 'unanchored' WHEN NOT is_fresh THEN 'stale' WHEN first_update_id > coalesce(past, anchor_id) + 1 THEN 'gap' WHEN past IS NULL THEN 'anchor' ELSE 'ok' END AS state,
    CASE WHEN is_fresh THEN greatest(first_update_id - coalesce(past, anchor_id) - 1, 0) END AS missing_count FROM chained""",
)
def anchored_depth(spark, d):
    u = F.col("update_id")
    rows = st.quotes(spark, d, nearest=False)
    deltas = rows.select("source", "symbol", "received_at", u.alias("first_update_id"), (u + u % 5).alias("final_update_id"))
    snapshots = rows.where(u % 50 == 7).select("source", "symbol", "received_at", (u + u % 7 - 3).alias("last_update_id"))
    return tape.anchored_depth(deltas, snapshots, ["source", "symbol"])


@query("anchored_states", f"{_DEPTH} SELECT source, count(*) FILTER (WHERE anchor_id IS NULL) AS n_unanchored, count(*) FILTER (WHERE anchor_id IS NOT NULL AND NOT is_fresh) AS n_stale, coalesce(CAST(sum(greatest(first_update_id - coalesce(past, anchor_id) - 1, 0)) FILTER (WHERE is_fresh) AS BIGINT), 0) AS n_missing FROM chained GROUP BY 1")
def anchored_states(spark, d):
    rows = anchored_depth(spark, d)
    return rows.groupBy("source").agg(F.count_if(F.col("state") == "unanchored").alias("n_unanchored"), F.count_if(F.col("state") == "stale").alias("n_stale"), F.coalesce(F.sum("missing_count"), F.lit(0)).alias("n_missing"))


# Marts in part

_FEATURE_COLUMNS = ("ret_simple", "ret_log", "true_range", "atr_14", "realized_vol_20d", "realized_vol_30d", "volume_z_30d")


@query("bars_daily_in_part", f"{_FEATURES} SELECT source, symbol, date, open, high, low, close, volume, prev_close, {', '.join(f'round({c}, 6) AS {c}' for c in _FEATURE_COLUMNS)} FROM feat")
def bars_daily_in_part(spark, d):
    """The bars mart stored as of one day and brought up to date from it: what a whole rebuild gives."""
    rows, cut = st.bars(spark, d), day("1997-05-20")
    path = work_path(spark, "mart")
    marts.write_whole(gold.bars_daily(rows.where(F.col("date") < cut)), path)
    changed = rows.where(F.col("date") >= cut).groupBy("source").agg(F.min("date").alias("since"))
    marts.write_increment(marts.increment(marts.BARS, rows, changed), path)
    stored = spark.read.schema(gold.bars_daily(rows).withColumn("month", F.lit("")).schema).parquet(path).drop("month")
    return rounded(stored, *_FEATURE_COLUMNS)


@query(
    "events_revisions_in_part",
    f"""WITH {st.PRINTS} SELECT source, calendar, series_id, event_id, CAST(split_part(event_id, ':', 2) AS DATE) AS reference_date, arg_min(actual, revision_seq) AS initial_value, arg_max(actual, revision_seq) AS latest_value, CAST(max(revision_seq) AS BIGINT) AS n_revisions FROM prints GROUP BY 1, 2, 3, 4, 5""",
)
def events_revisions_in_part(spark, d):
    """The revisions mart of first prints, brought up to date for every event that later rows revise."""
    rows = st.prints(spark, d).withColumns({"reference_date": F.split_part("event_id", F.lit(":"), F.lit(2)).cast("date"), "revision_seq": F.col("revision_seq").cast("int")})
    path = work_path(spark, "mart")
    marts.write_whole(gold.events_revisions(rows.where("revision_seq < 2")), path, "reference_date")
    changed = rows.where("revision_seq >= 2").select("source", "reference_date").distinct()
    marts.write_increment(marts.events_increment(rows, changed), path, "reference_date")
    stored = spark.read.schema(gold.events_revisions(rows).withColumn("month", F.lit("")).schema).parquet(path)
    return stored.select("source", "calendar", "series_id", "event_id", "reference_date", "initial_value", "latest_value", "n_revisions")


# Calendar

_NTH = "CAST(make_date(y, {m}, 1) + CAST((({w} - (isodow(make_date(y, {m}, 1)) - 1)) + 7) % 7 + 7 * ({n} - 1) AS INTEGER) AS DATE)"
_FIXED = "CASE isodow(make_date(y, {m}, {d})) WHEN 6 THEN {sat} WHEN 7 THEN make_date(y, {m}, {d}) + 1 ELSE make_date(y, {m}, {d}) END"
_EASTER = """e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years), e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2), e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM e3), easter AS (SELECT y, make_date(y, n // 31, n % 31 + 1) AS e FROM e4)"""
_HOLIDAYS = f"""years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), {_EASTER}, holidays AS (
    SELECT {_FIXED.format(m=1, d=1, sat="NULL")} AS day, 'New Year' AS name FROM years UNION ALL SELECT {_NTH.format(m=1, w=0, n=3)}, 'King' FROM years WHERE y >= 1998 UNION ALL SELECT {_NTH.format(m=2, w=0, n=3)}, 'Washington' FROM years
    UNION ALL SELECT e - 2, 'Good Friday' FROM easter UNION ALL SELECT CAST(make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS DATE), 'Memorial' FROM years
    UNION ALL SELECT {_FIXED.format(m=6, d=19, sat="make_date(y, 6, 18)")}, 'Juneteenth' FROM years WHERE y >= 2022 UNION ALL SELECT {_FIXED.format(m=7, d=4, sat="make_date(y, 7, 3)")}, 'Independence' FROM years
    UNION ALL SELECT {_NTH.format(m=9, w=0, n=1)}, 'Labor' FROM years UNION ALL SELECT {_NTH.format(m=11, w=3, n=4)}, 'Thanksgiving' FROM years UNION ALL SELECT {_FIXED.format(m=12, d=25, sat="make_date(y, 12, 24)")}, 'Christmas' FROM years
    UNION ALL SELECT CAST(d AS DATE), n FROM (VALUES {", ".join(f"('{d}', '{n}')" for d, n in calendar.CLOSED.items())}) v(d, n) WHERE year(CAST(d AS DATE)) IN (SELECT y FROM years))"""


@query("exchange_holidays", f"WITH {_HOLIDAYS}, n AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n_orders FROM orders GROUP BY 1) SELECT h.day AS day, name, coalesce(n_orders, 0) AS n_orders FROM holidays h LEFT JOIN n ON n.day = h.day WHERE h.day IS NOT NULL")
def exchange_holidays(spark, d):
    """The exchange's closed days in all years of orders, and the orders of those days."""
    orders = st.read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    n = orders.groupBy("day").agg(F.count("*").alias("n_orders"))
    return calendar.holidays(orders.select(F.year("day").alias("year")).distinct()).join(n, "day", "left").fillna(0, ["n_orders"])


# Updates by native names


@query(
    "update_native_names",
    f"""WITH {st.BARS}, w AS (SELECT source, symbol AS name, '1d' AS part, max(date) AS w FROM bars GROUP BY 1, 2), natives AS (SELECT s AS source, CAST(k AS VARCHAR) AS name, 'native-' || s || CAST(k AS VARCHAR) AS native FROM (SELECT unnest(['A', 'N']) AS s), (SELECT unnest(range(0, 8)) AS k))
SELECT 'bars' AS "group", w.source AS source, w.name AS name, part, native, strftime(w, '%Y-%m-%d') AS start FROM w LEFT JOIN natives n ON n.source = w.source AND n.name = w.name WHERE w < DATE '1998-11-20'""",
)
def update_native_names(spark, d):
    """What a night asks each source for: stored series by the source's own name; those without one fail when they are fetched."""
    marks = st.bars(spark, d).groupBy("source", F.col("symbol").alias("name"), F.lit("1d").alias("part")).agg(F.max("date").alias("watermark"))
    n = F.col("id").cast("string")
    natives = spark.range(8).select(F.lit("bars").alias("group"), F.explode(F.array(F.lit("A"), F.lit("N"))).alias("source"), n.alias("name")).withColumn("native", F.concat(F.lit("native-"), "source", "name"))
    return fleet.asked(marks, natives, day("1998-11-20"), "bars")


# Trials and mirrors

_PIECES = contracts.cuts("1995-01-01", "1998-06-30", 5, 3)


@query(
    "pagination_faults",
    f"""WITH {st.BARS}, edges AS (SELECT unnest([{", ".join(f"DATE '{a}'" for a, _ in _PIECES[1:])}]) AS e), faults AS (
    SELECT source, symbol, date, 'missing' AS side, 1 AS n FROM bars WHERE date = DATE '{_PIECES[1][1]}' UNION ALL SELECT source, symbol, date, 'extra', 1 FROM bars WHERE date = DATE '{_PIECES[2][1]}')
SELECT CAST(date AS DATE) AS date, side, boundary, count(*) AS n_rows FROM (SELECT *, (SELECT e FROM edges ORDER BY abs(date_diff('day', e, date)), e LIMIT 1) AS boundary FROM faults) GROUP BY 1, 2, 3""",
)
def pagination_faults(spark, d):
    """Bars fetched in seeded pieces by a source that leaves out one piece's last day and gives another's twice."""
    rows = st.bars(spark, d)
    whole = rows.where(F.col("date").between(day("1995-01-01"), day("1998-06-30")))

    def pull(a: str, b: str) -> DataFrame:
        end = F.col("date") < day(b) if (a, b) == _PIECES[1] else F.col("date") <= day(b)
        start = F.col("date") >= (day(_PIECES[2][1]) if (a, b) == _PIECES[3] else day(a))
        return rows.where(start & end)

    wrong = contracts.pagination(whole, pull, "1995-01-01", "1998-06-30", 5, 3)
    return wrong.groupBy("date", "side", "boundary").agg(F.sum("n").alias("n_rows"))


@query(
    "mirror_states",
    """WITH a AS (SELECT 'group=bars/source=' || o_orderstatus || '/' || CAST(o_orderkey AS VARCHAR) AS path, o_custkey AS size, CAST(o_orderkey % 97 AS VARCHAR) AS s FROM orders), b AS (SELECT path, CASE WHEN o % 11 = 0 THEN size + 1 ELSE size END AS size, CASE WHEN o % 13 = 0 THEN 'other' WHEN o % 3 = 0 THEN NULL ELSE s END AS s FROM (SELECT *, CAST(split_part(path, '/', 3) AS BIGINT) AS o FROM a) WHERE o % 7 <> 0 UNION ALL SELECT 'group=bars/source=X/' || CAST(c_custkey AS VARCHAR), c_custkey, NULL FROM customer)
SELECT coalesce(a.path, b.path) AS path, coalesce(a.size, b.size) AS size, CASE WHEN b.path IS NULL THEN 'local' WHEN a.path IS NULL THEN 'remote' WHEN a.size = b.size AND coalesce(a.s = b.s, true) THEN 'same' ELSE 'differs' END AS state FROM a FULL JOIN b ON a.path = b.path""",
)
def mirror_states(spark, d):
    """Two listings of as many files as there are orders, some lost, changed in size or content, or there alone."""
    o = F.col("o_orderkey")
    a = st.read(spark, d, "orders").select(F.concat_ws("/", F.lit("group=bars"), F.concat(F.lit("source="), "o_orderstatus"), o.cast("string")).alias("path"), F.col("o_custkey").alias("size"), (o % 97).cast("string").alias("checksum"), o)
    b = a.where(o % 7 != 0).withColumns({"size": F.when(o % 11 == 0, F.col("size") + 1).otherwise(F.col("size")), "checksum": F.when(o % 13 == 0, "other").when(o % 3 != 0, F.col("checksum"))})
    more = st.read(spark, d, "customer").select(F.concat(F.lit("group=bars/source=X/"), F.col("c_custkey").cast("string")).alias("path"), F.col("c_custkey").alias("size"), F.lit(None).cast("string").alias("checksum"))
    return mirror.compared(a.drop("o_orderkey"), b.drop("o_orderkey").unionByName(more))
