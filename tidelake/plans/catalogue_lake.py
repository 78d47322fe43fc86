"""Registered queries: upkeep, publishing, quality history, listings, the tape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.columns import to_double
from tidelake.operators import upkeep
from tidelake.plans import standins as st
from tidelake.plans.catalogue import BAR_KEYS, day, query, rounded
from tidelake.sources import lake
from tidelake.streaming import tape

_FRESH = f"WITH {st.BARS}, fresh AS (SELECT source, symbol, date, open + 1 AS open, high, low, close, volume FROM bars WHERE day(date) <= 4 UNION ALL SELECT source, symbol, date + 4000, open, high, low, close, volume FROM bars WHERE day(date) = 20)"


def fresh(spark, d) -> DataFrame:
    rows = st.bars(spark, d)
    return rows.where(F.day("date") <= 4).withColumn("open", F.col("open") + 1).unionByName(rows.where(F.day("date") == 20).withColumn("date", F.date_add("date", 4000)))


@query("upsert_last_write_wins", f"{_FRESH} SELECT * FROM fresh UNION ALL SELECT b.* FROM bars b WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.source = b.source AND f.symbol = b.symbol AND f.date = b.date)")
def upsert_last_write_wins(spark, d):
    return upkeep.last_write_wins(st.bars(spark, d), fresh(spark, d), [*BAR_KEYS, "date"])


@query("watermarks", f"WITH {st.SERIES} SELECT source, series_id, max(date) AS watermark FROM series GROUP BY 1, 2")
def watermarks(spark, d):
    return upkeep.watermarks(st.series(spark, d), ["source", "series_id"])


@query("settled_only", f"WITH {st.BARS} SELECT * FROM bars WHERE date + 1 <= DATE '1997-05-05'")
def settled_only(spark, d):
    return upkeep.drop_forming(st.bars(spark, d), day("1997-05-05"), "1d")


_ALLOWED = "allowed AS (SELECT n_name AS source, CASE WHEN n_regionkey = 1 THEN 'bars' ELSE 'series' END AS \"group\" FROM nation WHERE n_regionkey IN (1, 3)), rows AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE n_name END AS source, CAST(c_custkey % 30 AS INTEGER) AS k FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def listed(spark, d) -> tuple[DataFrame, DataFrame]:
    nation, customer = st.read(spark, d, "nation"), st.read(spark, d, "customer")
    allowed = nation.where("n_regionkey IN (1, 3)").select(F.col("n_name").alias("source"), F.when(F.col("n_regionkey") == 1, "bars").otherwise("series").alias("group"))
    rows = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "c_name", F.when(F.col("c_custkey") % 10 != 0, F.col("n_name")).alias("source"), (F.col("c_custkey") % 30).cast("int").alias("k"))
    return rows, allowed


@query("publish_allowlist", f"WITH {_ALLOWED} SELECT c_custkey, c_name, source, k FROM rows WHERE source IN (SELECT source FROM allowed WHERE \"group\" = 'bars')")
def publish_allowlist(spark, d):
    rows, allowed = listed(spark, d)
    return upkeep.publishable(rows, allowed, "bars")


@query("catalogue_counts", f"WITH {st.BARS} SELECT source, count(*) AS n_rows, max(date) AS newest FROM bars WHERE source IN ('A', 'R') GROUP BY 1")
def catalogue_counts(spark, d):
    return upkeep.catalogue_counts(st.bars(spark, d), spark.sql("SELECT * FROM VALUES ('A'), ('R'), ('X') AS t(source)"))


@query("list_series", f"WITH {st.SERIES} SELECT DISTINCT source, series_id, metric FROM series")
def list_series(spark, d):
    return lake.list_series(st.series(spark, d), ["source", "series_id", "metric"])


_VIOLATIONS = "v AS (SELECT CAST(o_orderdate AS DATE) AS run_date, CASE WHEN o_orderkey % 4 = 0 THEN 'weekly' ELSE 'daily' END AS cadence, CASE WHEN o_orderkey % 3 = 0 THEN 'error' ELSE 'warn' END AS severity, CASE o_custkey % 3 WHEN 0 THEN 'bars' WHEN 1 THEN 'events' ELSE 'series' END AS g FROM orders)"


@query(
    "dq_runs_summary",
    f"""WITH {_VIOLATIONS} SELECT run_date, cadence, count(*) AS n_violations, count(*) FILTER (WHERE severity = 'error') AS n_error, count(*) FILTER (WHERE severity = 'warn') AS n_warn, array_to_string(list_sort(list(DISTINCT g)), ',') AS groups FROM v GROUP BY 1, 2""",
)
def dq_runs_summary(spark, d):
    k = F.col("o_custkey") % 3
    rows = st.read(spark, d, "orders").select(
        F.col("o_orderdate").cast("date").alias("run_date"), F.when(F.col("o_orderkey") % 4 == 0, "weekly").otherwise("daily").alias("cadence"),
        F.when(F.col("o_orderkey") % 3 == 0, "error").otherwise("warn").alias("severity"), F.when(k == 0, "bars").when(k == 1, "events").otherwise("series").alias("group"),
    )
    return upkeep.dq_runs(rows, ["run_date", "cadence"])


@query(
    "quality_summary",
    f"""WITH {st.BARS}, h AS (SELECT source, symbol, date, CASE WHEN volume > 45 THEN NULL ELSE open END AS open, high, CASE WHEN day(date) = 2 THEN -low ELSE low END AS low, close, volume FROM bars WHERE source <> 'N' UNION ALL SELECT source, symbol, DATE '2001-11-05' + CAST(day(date) AS INTEGER), 1, 2, 1, 2, 3 FROM bars WHERE source = 'N' AND date < DATE '1999-01-01' AND day(date) < 4),
s AS (SELECT source, symbol, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date, count(DISTINCT date) AS n_dates, count(*) FILTER (WHERE open IS NULL) AS null_open, count(*) FILTER (WHERE high IS NULL) AS null_high, count(*) FILTER (WHERE low IS NULL) AS null_low,
    count(*) FILTER (WHERE close IS NULL) AS null_close, count(*) FILTER (WHERE volume IS NULL) AS null_volume, count(*) FILTER (WHERE low <= 0 OR high < low) AS n_bad_prices FROM h GROUP BY 1, 2),
t AS (SELECT * EXCLUDE (n_dates), CAST(date_diff('day', last_date, DATE '2001-11-10') AS BIGINT) AS days_stale, n_rows - n_dates AS n_repeated, CAST(date_diff('day', first_date, last_date) AS BIGINT) + 1 - n_dates AS n_missing_days FROM s)
SELECT *, CASE WHEN null_open + null_high + null_low + null_close + null_volume = 0 AND n_bad_prices = 0 AND n_repeated = 0 AND n_missing_days = 0 AND days_stale <= 3 THEN 'CLEAN' ELSE 'CHECK' END AS status FROM t""",
)
def quality_summary(spark, d):
    rows = st.bars(spark, d)
    old = rows.where("source <> 'N'").withColumn("open", F.when(~(F.col("volume") > 45), F.col("open"))).withColumn("low", F.when(F.day("date") == 2, -F.col("low")).otherwise(F.col("low")))
    late = rows.where((F.col("source") == "N") & (F.col("date") < day("1999-01-01")) & (F.day("date") < 4))
    new = late.select("source", "symbol", F.date_add(day("2001-11-05"), F.day("date")).alias("date"), *(F.lit(float(v)).alias(c) for c, v in (("open", 1), ("high", 2), ("low", 1), ("close", 2), ("volume", 3))))
    return upkeep.quality_summary(old.unionByName(new), BAR_KEYS, day("2001-11-10"))


@query("tumbling_counts", f"WITH {st.QUOTES} SELECT source, symbol, received_at // 3600000 AS bucket, count(*) AS n FROM quotes GROUP BY 1, 2, 3")
def tumbling_counts(spark, d):
    return tape.tumbling(st.quotes(spark, d), ["source", "symbol"], F.col("received_at"), st.HOUR_MS)


_MESSAGES = "m AS (SELECT event_id AS arrival, '{\"type\":\"' || CASE event_type WHEN 'click' THEN 'match' WHEN 'view' THEN 'ticker' WHEN 'error' THEN 'heartbeat' ELSE event_type END || '\",\"seq\":' || CAST(event_id AS VARCHAR) || '}' AS message FROM events)"


@query("route_messages", f"WITH {_MESSAGES} SELECT arrival, message, CASE json_extract_string(message, '$.type') WHEN 'match' THEN 'trades' WHEN 'ticker' THEN 'book_ticker' WHEN 'heartbeat' THEN 'heartbeat' END AS kind FROM m WHERE json_extract_string(message, '$.type') IN ('match', 'ticker', 'heartbeat')")
def route_messages(spark, d):
    kind = F.when(F.col("event_type") == "click", "match").when(F.col("event_type") == "view", "ticker").when(F.col("event_type") == "error", "heartbeat").otherwise(F.col("event_type"))
    message = F.concat(F.lit('{"type":"'), kind, F.lit('","seq":'), F.col("event_id").cast("string"), F.lit("}"))
    return tape.route(st.read(spark, d, "events").select(F.col("event_id").alias("arrival"), message.alias("message")), "type", strict=False)


@query("json_fields", f"WITH {st.QUOTES} SELECT json_extract_string(props, '$.k') AS k, count(*) AS n, round(avg(mid), 6) AS mean FROM quotes GROUP BY 1")
def json_fields(spark, d):
    return rounded(st.quotes(spark, d).groupBy(F.get_json_object("props", "$.k").alias("k")).agg(F.count("*").alias("n"), F.avg("mid").alias("mean")), "mean")


@query(
    "overlap_dedup",
    f"""WITH {st.QUOTES}, floors AS (SELECT source, symbol, CAST(max(update_id) // 2 AS BIGINT) AS floor FROM quotes WHERE source <> 'error' GROUP BY 1, 2), twice AS (SELECT source, symbol, update_id FROM quotes UNION ALL SELECT source, symbol, update_id FROM quotes WHERE update_id % 3 = 0)
SELECT DISTINCT t.source AS source, t.symbol AS symbol, update_id FROM twice t LEFT JOIN floors f ON t.source = f.source AND t.symbol = f.symbol WHERE floor IS NULL OR update_id > floor""",
)
def overlap_dedup(spark, d):
    rows = st.quotes(spark, d).select("source", "symbol", "update_id")
    floors = rows.where("source <> 'error'").groupBy("source", "symbol").agg(F.expr("max(update_id) div 2").alias("floor"))
    return tape.drop_overlap(rows.unionByName(rows.where("update_id % 3 = 0")), floors, ["source", "symbol"], "update_id")


@query("text_numbers", "SELECT c_custkey, v, TRY_CAST(v AS DOUBLE) AS x FROM (SELECT c_custkey, CASE c_custkey % 8 WHEN 0 THEN '1d' WHEN 1 THEN '1,234.5' WHEN 2 THEN '' WHEN 3 THEN ' 1.5 ' WHEN 4 THEN '1e3' WHEN 5 THEN '-.5' WHEN 6 THEN '12.' ELSE '0x10' END AS v FROM customer)")
def text_numbers(spark, d):
    k = F.col("c_custkey") % 8
    v = F.when(k == 0, "1d").when(k == 1, "1,234.5").when(k == 2, "").when(k == 3, " 1.5 ").when(k == 4, "1e3").when(k == 5, "-.5").when(k == 6, "12.").otherwise("0x10")
    return st.read(spark, d, "customer").select("c_custkey", v.alias("v")).withColumn("x", to_double(F.col("v")))
