"""Registered queries: updates, payloads, message decoding, checks of frames as they arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.operators import checks, upkeep, verify
from tidelake.plans import standins as st
from tidelake.plans.catalogue import BAR_KEYS, _DAMAGED, _vsql, damaged, day, query
from tidelake.sources import payloads
from tidelake.streaming import tape

# Updates

_HELD = f"WITH {st.BARS}, stored AS (SELECT * FROM bars WHERE date < DATE '1997-01-01' + 30 * CAST(symbol AS INTEGER) AND NOT (source = 'A' AND symbol = '3'))"


@query(
    "update_from_watermark",
    f"""{_HELD}, w AS (SELECT source, symbol, max(date) AS w FROM stored GROUP BY 1, 2), fresh AS (SELECT b.source AS source, b.symbol AS symbol, date, open, high, low, close + 1 AS close, volume FROM bars b JOIN w ON b.source = w.source AND b.symbol = w.symbol WHERE date >= w AND date < DATE '1999-06-01')
SELECT * FROM fresh UNION ALL SELECT s.* FROM stored s WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.source = s.source AND f.symbol = s.symbol AND f.date = s.date)""",
)
def update_from_watermark(spark, d):
    rows = st.bars(spark, d)
    cut = F.date_add(day("1997-01-01"), F.col("symbol").cast("int") * 30)
    stored = rows.where((F.col("date") < cut) & ~((F.col("source") == "A") & (F.col("symbol") == "3")))
    fresh = upkeep.advance(stored, rows.withColumn("close", F.col("close") + 1), BAR_KEYS, day("1999-06-01"))
    return upkeep.last_write_wins(stored, fresh, [*BAR_KEYS, "date"])


@query(
    "upsert_repeated_keys",
    f"""WITH {st.BARS}, twice AS (SELECT source, symbol, date, open + v AS open, high, low, close, volume, v AS version FROM bars, (SELECT unnest([1, 2, 3]) AS v) WHERE day(date) <= 4 AND (v < 3 OR symbol = '2'))
SELECT * FROM (SELECT * FROM twice QUALIFY row_number() OVER (PARTITION BY source, symbol, date ORDER BY version DESC) = 1) UNION ALL SELECT b.*, NULL FROM bars b WHERE day(date) > 4""",
)
def upsert_repeated_keys(spark, d):
    rows = st.bars(spark, d)
    twice = rows.where(F.day("date") <= 4).withColumn("version", F.explode(F.array(F.lit(3), F.lit(1), F.lit(2)))).where("version < 3 OR symbol = '2'")
    return upkeep.last_write_wins(rows, twice.withColumn("open", F.col("open") + F.col("version")), [*BAR_KEYS, "date"], ["version"])


_PULLS = f"WITH {st.BARS}, a AS (SELECT * FROM bars), b AS (SELECT source, symbol, date, open, high, low, CASE WHEN day(date) = 11 THEN close + 1 ELSE close END AS close, volume FROM a UNION ALL SELECT * FROM a WHERE day(date) = 12)"


@query("pulls_differ", f"{_PULLS} SELECT 'first' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT 'second', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)")
def pulls_differ(spark, d):
    a = st.bars(spark, d)
    b = a.withColumn("close", F.when(F.day("date") == 11, F.col("close") + 1).otherwise(F.col("close"))).unionByName(a.where(F.day("date") == 12))
    return upkeep.differing(a, b)


@query("registry_drift", f"WITH {st.BARS}, declared AS (SELECT s.s AS source, CAST(k AS VARCHAR) AS symbol FROM (SELECT unnest(['A', 'N', 'X']) AS s) s, (SELECT unnest(range(0, 12)) AS k) k) SELECT source, symbol FROM declared WHERE NOT EXISTS (SELECT 1 FROM bars b WHERE b.source = declared.source AND b.symbol = declared.symbol)")
def registry_drift(spark, d):
    declared = spark.range(12).select(F.explode(F.array(*map(F.lit, "ANX"))).alias("source"), F.col("id").cast("string").alias("symbol"))
    return checks.not_stored(declared, st.bars(spark, d), BAR_KEYS)


@query(
    "latest_violations",
    """WITH v AS (SELECT CAST(o_orderdate AS DATE) AS run_ts, o_orderpriority AS "group", CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS severity, o_orderkey AS n FROM orders)
SELECT * FROM v ORDER BY run_ts DESC, "group" NULLS FIRST, severity NULLS FIRST, n LIMIT 200""",
)
def latest_violations(spark, d):
    rows = st.read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("run_ts"), F.col("o_orderpriority").alias("group"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("severity"), F.col("o_orderkey").alias("n"))
    return upkeep.newest_first(rows, 200)


# Payloads: bodies are made of stored rows and parsed back


def _bodies(rows: DataFrame, keys: list[Column], record: Column, wrap=lambda c: F.to_json(c)) -> DataFrame:
    """One body for each key and year."""
    return rows.groupBy(*keys, F.year("date").alias("y")).agg(wrap(F.collect_list(record)).alias("body")).drop("y")


def _ms(date: str = "date") -> Column:
    return F.unix_millis(F.col(date).cast("timestamp"))


_NAMED_BARS = f"WITH {st.BARS} SELECT source || '/' || symbol AS symbol, date, open, high, low, close, volume FROM bars"


def named_bars(spark, d) -> DataFrame:
    return st.bars(spark, d).withColumn("symbol", F.concat_ws("/", "source", "symbol"))


@query("parse_klines", _NAMED_BARS)
def parse_klines(spark, d):
    record = F.array(_ms().cast("string"), *(F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")))
    return payloads.positional_klines(_bodies(named_bars(spark, d), [F.col("symbol")], record)).withColumn("date", F.col("date").cast("date"))


@query("parse_unified", _NAMED_BARS)
def parse_unified(spark, d):
    stale = F.array(_ms().cast("string"), *(F.lit("0") for _ in range(5)))
    record = F.array(_ms().cast("string"), *(F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")))
    rows = named_bars(spark, d).groupBy("symbol", F.year("date").alias("y")).agg(F.to_json(F.concat(F.collect_list(stale), F.collect_list(record))).alias("body"))
    return payloads.unified_ohlcv(rows.select("symbol", F.replace("body", F.lit('"'), F.lit("")).alias("body"))).withColumn("date", F.col("date").cast("date"))


@query("parse_pair_ohlc", _NAMED_BARS)
def parse_pair_ohlc(spark, d):
    record = F.array(F.unix_timestamp(F.col("date").cast("timestamp")).cast("string"), *(F.col(c).cast("string") for c in ("open", "high", "low", "close")), F.lit("0"), F.col("volume").cast("string"))
    wrap = lambda c: F.concat(F.lit('{"error":[],"result":{"last":17,"PAIR":'), F.to_json(c), F.lit("}}"))
    return payloads.pair_ohlc(_bodies(named_bars(spark, d), [F.col("symbol")], record, wrap)).withColumn("date", F.col("date").cast("date"))


_COUNTS = "n AS (SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, count(*) AS n, sum(o_custkey) AS k FROM orders GROUP BY 1, 2)"


def counts(spark, d) -> DataFrame:
    return st.read(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").alias("date")).agg(F.count("*").alias("n"), F.sum("o_custkey").alias("k"))


@query("parse_observations", f"WITH {_COUNTS} SELECT series_id, date, CASE WHEN k % 4 <> 0 THEN CAST(k AS DOUBLE) END AS value FROM n")
def parse_observations(spark, d):
    record = F.struct(F.col("date").cast("string").alias("date"), F.when(F.col("k") % 4 == 0, ".").otherwise(F.col("k").cast("string")).alias("value"))
    rows = _bodies(counts(spark, d), [F.col("series_id")], record, lambda c: F.to_json(F.struct(c.alias("observations"))))
    return payloads.observations(rows).withColumn("date", F.col("date").cast("date"))


@query("parse_csv", f"WITH {_COUNTS} SELECT series_id, date, CAST(k AS DOUBLE) AS value FROM n WHERE date >= DATE '1996-01-01' AND date <= DATE '1997-12-31'")
def parse_csv(spark, d):
    line = F.concat_ws(",", F.date_format("date", "MM/dd/yyyy"), F.col("n").cast("string"), F.concat(F.lit(" "), F.col("k").cast("string")))
    lines = counts(spark, d).select("series_id", line.alias("line")).unionByName(spark.range(1).select(F.lit("1-URGENT").alias("series_id"), F.lit("DATE,OPEN,CLOSE").alias("line")))
    return payloads.csv_last_column(lines, "1996-01-01", "1997-12-31").withColumn("date", F.col("date").cast("date"))


@query("parse_metrics", f"WITH {_COUNTS} SELECT series_id, date, CAST(n AS DOUBLE) AS longs, CASE WHEN k % 5 <> 0 THEN CAST(k AS DOUBLE) END AS shorts, CAST(NULL AS DOUBLE) AS swaps FROM n")
def parse_metrics(spark, d):
    record = F.struct(F.col("date").cast("string").alias("report"), F.col("n").cast("string").alias("long_all"), F.when(F.col("k") % 5 != 0, F.col("k").cast("string")).alias("short_all"))
    rows = _bodies(counts(spark, d), [F.col("series_id")], record)
    return payloads.renamed_metrics(rows, "report", {"long_all": "longs", "short_all": "shorts", "swap_all": "swaps"}).withColumn("date", F.col("date").cast("date"))


@query("parse_funding", f"WITH {_COUNTS} SELECT series_id AS symbol, date, n / 1000.0 AS funding_rate, CASE WHEN k % 3 <> 0 THEN CAST(k AS DOUBLE) END AS mark_price FROM n")
def parse_funding(spark, d):
    record = F.struct(_ms().alias("fundingTime"), (F.col("n") / 1000.0).cast("string").alias("fundingRate"), F.when(F.col("k") % 3 == 0, "").otherwise(F.col("k").cast("string")).alias("markPrice"))
    return payloads.funding(_bodies(counts(spark, d), [F.col("series_id").alias("symbol")], record)).withColumn("date", F.col("date").cast("date"))


# Messages


def _message(*fields: tuple[str, Column]) -> Column:
    """A JSON object; names may differ by case alone."""
    text = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    parts = [F.concat(F.lit(f'"{n[1:]}":'), c.cast("string")) if n[0] == "=" else F.concat(F.lit(f'"{n}":'), text(c)) for n, c in fields]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _ticks(spark, d) -> DataFrame:
    u = F.col("update_id")
    return st.quotes(spark, d, nearest=False).select("symbol", "received_at", u.alias("u"), F.concat((u % 1000).cast("string"), F.lit(".50")).alias("price"), F.concat((u % 7).cast("string"), F.lit(".0")).alias("size"))


_TICK = "WITH t AS (SELECT 'S' || CAST(user_id % 3 AS VARCHAR) AS symbol, epoch_us(ts) // 1000 AS received_at, event_id AS u, CAST(event_id % 1000 AS VARCHAR) || '.50' AS price, CAST(event_id % 7 AS VARCHAR) || '.0' AS size FROM events)"


def _streamed(rows: DataFrame, suffix: str, *fields: tuple[str, Column]) -> DataFrame:
    message = _message(("stream", F.concat(F.lower("symbol"), F.lit(suffix))), ("=data", _message(*fields)))
    return tape.route(rows.select(message.alias("message"), "received_at"))


def _typed(rows: DataFrame, kind: str, *fields: tuple[str, Column]) -> DataFrame:
    product = F.concat("symbol", F.lit("-USD"))
    return tape.route(rows.select(_message(("type", F.lit(kind)), ("product_id", product), *fields).alias("message"), "received_at"), "type")


@query("decode_trades", f"{_TICK} SELECT symbol, u AS trade_id, price, size AS quantity, CAST(received_at - 5 AS VARCHAR) AS trade_time, CAST(received_at - 3 AS VARCHAR) AS event_time, u % 2 = 0 AS buyer_is_maker, received_at FROM t")
def decode_trades(spark, d):
    rows = _ticks(spark, d)
    at = F.col("received_at")
    return tape.trades(_streamed(rows, "@trade", ("e", F.lit("trade")), ("=E", at - 3), ("s", F.col("symbol")), ("=t", F.col("u")), ("p", F.col("price")), ("q", F.col("size")), ("=T", at - 5), ("=m", F.col("u") % 2 == 0)))


@query("decode_book", f"{_TICK} SELECT symbol, price AS bid_price, size AS bid_qty, price || '1' AS ask_price, size || '2' AS ask_qty, u AS update_id, received_at FROM t")
def decode_book(spark, d):
    more = lambda c, x: F.concat(c, F.lit(x))
    return tape.decode(_streamed(_ticks(spark, d), "@bookTicker", ("=u", F.col("u")), ("s", F.col("symbol")), ("b", F.col("price")), ("B", F.col("size")), ("a", more("price", "1")), ("A", more("size", "2"))), "book_ticker")


@query("decode_depth", f"{_TICK} SELECT symbol, u AS first_update_id, u + 2 AS final_update_id, CAST(received_at AS VARCHAR) AS event_time, 2 AS n_bids, price AS best_bid, size AS last_size, 0 AS n_asks, received_at FROM t")
def decode_depth(spark, d):
    levels = F.concat(F.lit('[["'), "price", F.lit('","1.0"],["1.0","'), "size", F.lit('"]]'))
    rows = tape.decode(_streamed(_ticks(spark, d), "@depth@100ms", ("=E", F.col("received_at")), ("s", F.col("symbol")), ("=U", F.col("u")), ("=u", F.col("u") + 2), ("=b", levels), ("=a", F.lit("[]"))), "depth")
    return rows.select("symbol", "first_update_id", "final_update_id", "event_time", F.size("bids").alias("n_bids"), F.col("bids")[0][0].alias("best_bid"), F.col("bids")[1][1].alias("last_size"), F.size("asks").alias("n_asks"), "received_at")


@query("decode_matches", f"{_TICK} SELECT symbol || 'USDT' AS symbol, u AS trade_id, price, size AS quantity, CASE WHEN u % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, 'T' || CAST(received_at AS VARCHAR) AS trade_time, u + 9 AS sequence, received_at FROM t")
def decode_matches(spark, d):
    u = F.col("u")
    side, time = F.when(u % 2 == 0, "buy").otherwise("sell"), F.concat(F.lit("T"), F.col("received_at").cast("string"))
    return tape.decode(_typed(_ticks(spark, d), "last_match", ("=trade_id", u), ("price", F.col("price")), ("size", F.col("size")), ("side", side), ("time", time), ("=sequence", u + 9)), "trades", "type")


@query("decode_tickers", f"{_TICK} SELECT symbol || 'USDT' AS symbol, price AS bid_price, size AS bid_qty, price || '1' AS ask_price, size || '2' AS ask_qty, u AS update_id, price, '3' AS last_size, u + 1 AS trade_id, CAST(NULL AS VARCHAR) AS side, 'T' || CAST(received_at AS VARCHAR) AS event_time, received_at FROM t")
def decode_tickers(spark, d):
    more = lambda c, x: F.concat(c, F.lit(x))
    fields = (
        ("best_bid", F.col("price")), ("best_bid_size", F.col("size")), ("best_ask", more("price", "1")), ("best_ask_size", more("size", "2")), ("=sequence", F.col("u")), ("price", F.col("price")), ("last_size", F.lit("3")),
        ("=trade_id", F.col("u") + 1), ("time", F.concat(F.lit("T"), F.col("received_at").cast("string"))),
    )
    return tape.decode(_typed(_ticks(spark, d), "ticker", *fields), "book_ticker", "type")


@query("decode_heartbeats", f"{_TICK} SELECT symbol || 'USDT' AS symbol, u AS last_trade_id, u + 4 AS sequence, 'T' AS heartbeat_time, received_at FROM t")
def decode_heartbeats(spark, d):
    return tape.decode(_typed(_ticks(spark, d), "heartbeat", ("=last_trade_id", F.col("u")), ("=sequence", F.col("u") + 4), ("time", F.lit("T"))), "heartbeat", "type")


@query("decode_updates", f"{_TICK} SELECT symbol || 'USDT' AS symbol, 1 AS n_changes, 'buy' AS side, price, size, 'T' AS event_time, received_at FROM t")
def decode_updates(spark, d):
    change = F.concat(F.lit('[["buy","'), "price", F.lit('","'), "size", F.lit('"]]'))
    rows = tape.decode(_typed(_ticks(spark, d), "l2update", ("=changes", change), ("time", F.lit("T"))), "depth", "type")
    c = F.col("changes")
    return rows.select("symbol", F.size(c).alias("n_changes"), c[0][0].alias("side"), c[0][1].alias("price"), c[0][2].alias("size"), "event_time", "received_at")


@query("book_snapshots", f"{_TICK} SELECT symbol, u AS last_update_id, price AS best_bid, 0 AS n_asks, received_at FROM t")
def book_snapshots(spark, d):
    body = _message(("=lastUpdateId", F.col("u")), ("=bids", F.concat(F.lit('[["'), "price", F.lit('","1"]]'))), ("=asks", F.lit("[]")))
    rows = tape.book_snapshot(_ticks(spark, d).select("symbol", body.alias("body"), "received_at"))
    return rows.select("symbol", "last_update_id", F.col("bids")[0][0].alias("best_bid"), F.size("asks").alias("n_asks"), "received_at")


@query("reconnect_gaps", f"WITH {st.QUOTES} SELECT source, symbol, 'trades' AS kind, 'reconnect' AS reason, max(update_id) AS last_seq, CAST(1000 AS BIGINT) AS gap_start_ms, CAST(2500 AS BIGINT) AS gap_end_ms FROM quotes GROUP BY 1, 2")
def reconnect_gaps(spark, d):
    positions = st.quotes(spark, d).groupBy("source", "symbol").agg(F.max("update_id").alias("position")).withColumn("kind", F.lit("trades"))
    return tape.reconnect_gaps(positions, 1000, 2500)


@query(
    "overlap_counts",
    f"""WITH {st.QUOTES}, floors AS (SELECT source, symbol, CAST(max(update_id) // 2 AS BIGINT) AS floor FROM quotes WHERE source <> 'error' GROUP BY 1, 2), twice AS (SELECT source, symbol, update_id FROM quotes UNION ALL SELECT source, symbol, update_id FROM quotes WHERE update_id % 3 = 0)
SELECT t.source AS source, t.symbol AS symbol, count(DISTINCT update_id) FILTER (WHERE floor IS NULL OR update_id > floor) AS n_kept, count(*) - count(DISTINCT update_id) FILTER (WHERE floor IS NULL OR update_id > floor) AS n_duplicates FROM twice t LEFT JOIN floors f ON t.source = f.source AND t.symbol = f.symbol GROUP BY 1, 2""",
)
def overlap_counts(spark, d):
    rows = st.quotes(spark, d).select("source", "symbol", "update_id")
    floors = rows.where("source <> 'error'").groupBy("source", "symbol").agg(F.expr("max(update_id) div 2").alias("floor"))
    return tape.overlap_counts(rows.unionByName(rows.where("update_id % 3 = 0")), floors, ["source", "symbol"], "update_id")


# Frames as they arrive


@query(
    "events_frame",
    f"""{_DAMAGED}, back AS (SELECT source, series_id, count(*) AS n FROM damaged WHERE observed_ts < scheduled_ts GROUP BY 1, 2),
twice AS (SELECT source, series_id, CAST(sum(n - 1) AS BIGINT) AS n FROM (SELECT source, series_id, event_id, revision_seq, count(*) AS n FROM damaged GROUP BY 1, 2, 3, 4) WHERE n > 1 GROUP BY 1, 2),
shape AS (SELECT source, series_id, event_id, min(revision_seq) AS lo, max(revision_seq) AS hi, count(*) AS n, count(DISTINCT revision_seq) AS d FROM damaged GROUP BY 1, 2, 3), holes AS (SELECT source, series_id, count(*) AS n FROM shape WHERE lo <> 0 OR hi <> n - 1 OR d <> n GROUP BY 1, 2)
{_vsql("events", "bitemporal", "error", "CAST(n AS VARCHAR) || ' rows observed before scheduled'", sid="series_id")} FROM back
UNION ALL {_vsql("events", "key", "error", "CAST(n AS VARCHAR) || ' repeated event_id and revision_seq'", sid="series_id")} FROM twice
UNION ALL {_vsql("events", "revision_seq", "error", "CAST(n AS VARCHAR) || ' events whose revisions are not contiguous'", sid="series_id")} FROM holes""",
)
def events_frame(spark, d):
    return verify.verify_events(damaged(spark, d))


_THIN = f"WITH {st.SERIES}, thin AS (SELECT source, series_id, metric, date, CASE WHEN (series_id = '2-HIGH' AND metric = 'revenue') OR day(date) = 3 THEN NULL ELSE value END AS value FROM series)"


@query("series_nulls", f"""{_THIN}, n AS (SELECT source, series_id, metric, count(*) AS n FROM thin GROUP BY 1, 2, 3 HAVING count(value) = 0) {_vsql("series", "nulls", "warn", "'all ' || CAST(n AS VARCHAR) || ' values are null'", sid="series_id", metric="metric")} FROM n""")
def series_nulls(spark, d):
    gone = ((F.col("series_id") == "2-HIGH") & F.coalesce(F.col("metric") == "revenue", F.lit(False))) | (F.day("date") == 3)
    rows = st.series(spark, d).withColumn("value", F.when(~gone, F.col("value")))
    return verify.missing_values(rows, "series", ["source", "series_id", "metric"], ["value"])


@query(
    "range_violations",
    f"""WITH {st.BARS}, b AS (SELECT source, symbol, count(*) AS n FROM bars WHERE date < DATE '1996-02-01' GROUP BY 1, 2), a AS (SELECT source, symbol, count(*) AS n FROM bars WHERE date > DATE '2001-05-02' GROUP BY 1, 2)
{_vsql("bars", "range", "error", "CAST(n AS VARCHAR) || ' rows before the requested start'", sid="symbol")} FROM b UNION ALL {_vsql("bars", "range", "error", "CAST(n AS VARCHAR) || ' rows after the requested end'", sid="symbol")} FROM a""",
)
def range_violations(spark, d):
    return verify.out_of_range(st.bars(spark, d), "bars", BAR_KEYS, day("1996-02-01"), day("2001-05-01"))


@query(
    "unsorted_index",
    f"""WITH {st.BARS}, o AS (SELECT source, symbol, date, CASE WHEN symbol IN ('1', '4') THEN date_diff('day', DATE '1990-01-01', date) * 37 % 5003 ELSE date_diff('day', DATE '1990-01-01', date) END AS arrival FROM bars),
b AS (SELECT source, symbol, date < lag(date) OVER (PARTITION BY source, symbol ORDER BY arrival) AS back FROM o), n AS (SELECT source, symbol, count(*) AS k FROM b WHERE back GROUP BY 1, 2) {_vsql("bars", "index", "warn", "CAST(k AS VARCHAR) || ' steps back in time'", sid="symbol")} FROM n""",
)
def unsorted_index(spark, d):
    n = F.datediff("date", day("1990-01-01"))
    rows = st.bars(spark, d).withColumn("arrival", F.when(F.col("symbol").isin("1", "4"), n * 37 % 5003).otherwise(n))
    return verify.unsorted(rows, "bars", BAR_KEYS, "arrival")
