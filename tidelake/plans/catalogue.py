"""Registered queries over the stand-in groups, each beside its DuckDB SQL.

Floats are rounded to 6 places on both sides, counts are bigint, and every order is total.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.operators import align, checks, statistics, upkeep, verify
from tidelake.plans import gold, silver, standins as st
from tidelake.sources import lake, payloads
from tidelake.streaming import tape

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
BAR_KEYS = ["source", "symbol"]


def query(name: str, sql: str):
    """Registers a function under a name with its SQL."""

    def add(f):
        QUERIES[name], SQL[name] = f, sql
        return f

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def day(text: str):
    return F.lit(text).cast("date")


# Bars

_FEATURES = f"""WITH {st.BARS}, prev AS (
    SELECT *, lag(close) OVER (PARTITION BY source, symbol ORDER BY date) AS prev_close FROM bars
), ret AS (
    SELECT *, close / nullif(prev_close, 0) - 1 AS ret_simple, CASE WHEN close > 0 AND prev_close > 0 THEN ln(close / prev_close) END AS ret_log,
           greatest(high - low, abs(high - prev_close), abs(low - prev_close)) AS true_range FROM prev
), feat AS (
    SELECT *, avg(true_range) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS atr_14, stddev_samp(ret_log) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS realized_vol_20d,
           stddev_samp(ret_log) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS realized_vol_30d,
           (volume - avg(volume) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)) / nullif(stddev_samp(volume) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 0) AS volume_z_30d
    FROM ret WINDOW w AS (PARTITION BY source, symbol ORDER BY date)
)"""


@query(
    "bars_daily_features",
    f"""{_FEATURES} SELECT source, symbol, date, open, high, low, close, volume, prev_close, round(ret_simple, 6) AS ret_simple, round(ret_log, 6) AS ret_log, round(true_range, 6) AS true_range,
    round(atr_14, 6) AS atr_14, round(realized_vol_20d, 6) AS realized_vol_20d, round(realized_vol_30d, 6) AS realized_vol_30d, round(volume_z_30d, 6) AS volume_z_30d FROM feat""",
)
def bars_daily_features(spark, d):
    return rounded(gold.bars_daily(st.bars(spark, d)), "ret_simple", "ret_log", "true_range", "atr_14", "realized_vol_20d", "realized_vol_30d", "volume_z_30d")


@query("bars_true_range", f"{_FEATURES} SELECT source, symbol, date, round(true_range, 6) AS true_range, round(atr_14, 6) AS atr_14 FROM feat")
def bars_true_range(spark, d):
    return rounded(gold.bars_daily(st.bars(spark, d)).select(*BAR_KEYS, "date", "true_range", "atr_14"), "true_range", "atr_14")


@query("bars_realized_vol", f"{_FEATURES} SELECT source, symbol, date, round(ret_log, 6) AS ret_log, round(realized_vol_20d, 6) AS realized_vol_20d, round(realized_vol_30d, 6) AS realized_vol_30d FROM feat")
def bars_realized_vol(spark, d):
    return rounded(gold.bars_daily(st.bars(spark, d)).select(*BAR_KEYS, "date", "ret_log", "realized_vol_20d", "realized_vol_30d"), "ret_log", "realized_vol_20d", "realized_vol_30d")


@query("bars_volume_z", f"{_FEATURES} SELECT source, symbol, date, volume, round(volume_z_30d, 6) AS volume_z_30d FROM feat")
def bars_volume_z(spark, d):
    return rounded(gold.bars_daily(st.bars(spark, d)).select(*BAR_KEYS, "date", "volume", "volume_z_30d"), "volume_z_30d")


@query("bars_silver", f"WITH {st.BARS} SELECT source, symbol, '1d' AS interval, CAST(date AS TIMESTAMP) AS date, open, high, low, close, volume FROM bars")
def bars_silver(spark, d):
    return silver.bars(st.bars(spark, d).withColumn("interval", F.lit("1d")))


@query("top_vol_days", f"{_FEATURES} SELECT source, symbol, date, round(realized_vol_30d, 6) AS realized_vol_30d FROM feat ORDER BY round(realized_vol_30d, 6) DESC NULLS LAST, source, symbol, date LIMIT 25")
def top_vol_days(spark, d):
    rows = rounded(gold.bars_daily(st.bars(spark, d)).select(*BAR_KEYS, "date", "realized_vol_30d"), "realized_vol_30d")
    return rows.orderBy(F.desc_nulls_last("realized_vol_30d"), *BAR_KEYS, "date").limit(25)


@query("latest_n_per_symbol", f"WITH {st.BARS} SELECT source, symbol, date, close FROM bars QUALIFY row_number() OVER (PARTITION BY source, symbol ORDER BY date DESC) <= 5")
def latest_n_per_symbol(spark, d):
    place = F.row_number().over(Window.partitionBy(*BAR_KEYS).orderBy(F.desc("date")))
    return st.bars(spark, d).withColumn("place", place).where("place <= 5").select(*BAR_KEYS, "date", "close")


@query(
    "basis_self_join",
    f"""WITH {st.BARS} SELECT b.date AS date, b.symbol AS symbol, b.close AS base_close, c.close AS quote_close, round(c.close / b.close * 10000 - 10000, 1) AS bps
    FROM bars b JOIN bars c ON b.date = c.date AND b.symbol = c.symbol WHERE b.source = 'A' AND c.source = 'R'""",
)
def basis_self_join(spark, d):
    return align.basis_self_join(st.bars(spark, d), "A", "R")


# Series

_SERIES_FEATURES = f"""WITH {st.SERIES}, a AS (
    SELECT *, lag(value) OVER (PARTITION BY source, series_id, metric ORDER BY date) AS prev_value FROM series
), b AS (SELECT *, value - prev_value AS change, (value - prev_value) / nullif(prev_value, 0) AS change_pct FROM a)
SELECT source, series_id, metric, date, value, prev_value, round(change, 6) AS change, round(change_pct, 6) AS change_pct,
       round((change - avg(change) OVER w) / nullif(stddev_samp(change) OVER w, 0), 6) AS change_z_12obs
FROM b WINDOW w AS (PARTITION BY source, series_id, metric ORDER BY date ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"""


@query("series_features", _SERIES_FEATURES)
def series_features(spark, d):
    return rounded(gold.series_features(st.series(spark, d)), "change", "change_pct", "change_z_12obs")


@query("series_silver_mixed_depth", f"WITH {st.SERIES} SELECT source, series_id, metric, CAST(date AS TIMESTAMP) AS date, value FROM series")
def series_silver_mixed_depth(spark, d):
    long = st.obs(spark, d).unpivot(["source", "series_id", "date"], ["n_orders", "revenue"], "metric", "value")
    return silver.series(st.flat(spark, d), long)


@query("series_wide_pivot", f"WITH {st.SERIES} SELECT date, max(value) FILTER (WHERE metric = 'n_orders') AS n_orders, max(value) FILTER (WHERE metric = 'revenue') AS revenue FROM series WHERE series_id = '1-URGENT' GROUP BY date")
def series_wide_pivot(spark, d):
    return lake.wide_series(st.series(spark, d).where("series_id = '1-URGENT'"), ["n_orders", "revenue"])


@query("series_metric_unpivot", f"WITH {st.OBS} SELECT source, series_id, date, 'n_orders' AS metric, n_orders AS value FROM obs UNION ALL SELECT source, series_id, date, 'revenue', revenue FROM obs")
def series_metric_unpivot(spark, d):
    return upkeep.unpivot_metrics(st.obs(spark, d), ["source", "series_id", "date"])


# Events

_REVISIONS = f"""WITH {st.PRINTS}, r AS (
    SELECT source, calendar, series_id, event_id, CAST(split_part(event_id, ':', 2) AS DATE) AS reference_date, min(scheduled_ts) AS scheduled_ts, arg_min(actual, revision_seq) AS initial_value, arg_max(actual, revision_seq) AS latest_value,
           min(observed_ts) AS initial_observed_ts, max(observed_ts) AS latest_observed_ts, CAST(max(revision_seq) AS BIGINT) AS n_revisions FROM prints GROUP BY ALL
) SELECT *, round(latest_value - initial_value, 6) AS total_revision, round((latest_value - initial_value) / nullif(initial_value, 0), 6) AS revision_pct,
         CAST(date_diff('day', initial_observed_ts, latest_observed_ts) AS BIGINT) AS days_to_latest FROM r"""


@query("events_revisions", _REVISIONS)
def events_revisions(spark, d):
    return rounded(gold.events_revisions(silver.events(st.prints(spark, d))), "total_revision", "revision_pct")


@query("events_silver", f"WITH {st.PRINTS} SELECT source, calendar, event_id, series_id, CAST(split_part(event_id, ':', 2) AS DATE) AS reference_date, scheduled_ts, observed_ts, actual, revision_seq FROM prints")
def events_silver(spark, d):
    return silver.events(st.prints(spark, d))


_VINTAGES = """vintages AS (
    SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS ref_date, CAST(o_orderdate AS DATE) AS realtime_start, max(o_totalprice) AS value FROM orders GROUP BY 1, 2, 3
)"""


def vintages(spark, d) -> DataFrame:
    rows = st.read(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("series_id"), F.trunc("o_orderdate", "month").alias("ref_date"), F.col("o_orderdate").cast("date").alias("realtime_start"))
    return rows.agg(F.max("o_totalprice").alias("value"))


@query(
    "events_from_vintages",
    f"""WITH {_VINTAGES}, r AS (
    SELECT *, row_number() OVER (PARTITION BY series_id, ref_date ORDER BY realtime_start, value) - 1 AS seq, min(realtime_start) OVER (PARTITION BY series_id, ref_date) AS scheduled_ts FROM vintages
), i AS (SELECT series_id, ref_date, lag(value) OVER (PARTITION BY series_id ORDER BY ref_date) AS previous FROM r WHERE seq = 0)
SELECT r.series_id || ':' || strftime(r.ref_date, '%Y-%m-%d') AS event_id, r.series_id AS series_id, scheduled_ts, realtime_start AS observed_ts, value AS actual, previous, CAST(seq AS INTEGER) AS revision_seq
FROM r LEFT JOIN i ON r.series_id = i.series_id AND r.ref_date = i.ref_date""",
)
def events_from_vintages(spark, d):
    return payloads.events_from_vintages(vintages(spark, d))


@query(
    "events_asof",
    f"""WITH {_VINTAGES}, v AS (SELECT *, lead(realtime_start) OVER (PARTITION BY series_id, ref_date ORDER BY realtime_start) AS realtime_end FROM vintages)
SELECT series_id, ref_date, value FROM v WHERE realtime_start <= DATE '1997-03-15' AND (realtime_end IS NULL OR DATE '1997-03-15' < realtime_end)""",
)
def events_asof(spark, d):
    end = F.lead("realtime_start").over(Window.partitionBy("series_id", "ref_date").orderBy("realtime_start"))
    return silver.as_of(vintages(spark, d).withColumn("realtime_end", end), "1997-03-15").select("series_id", "ref_date", "value")


# Venues

_MIDS = f"""WITH {st.QUOTES}, mids AS (
    SELECT symbol, source, received_at // 3600000 AS bucket, arg_max(mid, row(received_at, update_id)) AS mid FROM quotes WHERE source IN ('click', 'view') GROUP BY 1, 2, 3
)"""
_ALIGNED = f"""{_MIDS}, wide AS (
    SELECT symbol, bucket, max(mid) FILTER (WHERE source = 'click') AS base_mid, max(mid) FILTER (WHERE source = 'view') AS quote_mid FROM mids GROUP BY 1, 2
), span AS (
    SELECT symbol, greatest(min(bucket) FILTER (WHERE base_mid IS NOT NULL), min(bucket) FILTER (WHERE quote_mid IS NOT NULL)) AS lo,
           least(max(bucket) FILTER (WHERE base_mid IS NOT NULL), max(bucket) FILTER (WHERE quote_mid IS NOT NULL)) AS hi, min(bucket) AS start, count(base_mid) AS n_base, count(quote_mid) AS n_quote FROM wide GROUP BY 1
), grid AS (SELECT symbol, lo, unnest(range(start, hi + 1)) AS bucket FROM span WHERE n_base > 0 AND n_quote > 0 AND lo <= hi), filled AS (
    SELECT g.symbol AS symbol, g.bucket AS bucket, g.lo AS lo, last_value(base_mid IGNORE NULLS) OVER w AS base_mid, last_value(quote_mid IGNORE NULLS) OVER w AS quote_mid
    FROM grid g LEFT JOIN wide ON g.symbol = wide.symbol AND g.bucket = wide.bucket WINDOW w AS (PARTITION BY g.symbol ORDER BY g.bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), aligned AS (SELECT symbol, bucket, base_mid, quote_mid FROM filled WHERE bucket >= lo)"""
VENUES = ("click", "view")


@query("mids_by_bucket", f"{_MIDS} SELECT * FROM mids")
def mids_by_bucket(spark, d):
    return align.mids_by_bucket(st.quotes(spark, d).where(F.col("source").isin(*VENUES)), st.HOUR_MS, ["symbol"])


def aligned(spark, d) -> DataFrame:
    return align.aligned_mids(st.quotes(spark, d), *VENUES, st.HOUR_MS)


@query("venue_align_ffill", f"{_ALIGNED} SELECT * FROM aligned")
def venue_align_ffill(spark, d):
    return aligned(spark, d)


@query(
    "basis_summary",
    f"""{_ALIGNED}, b AS (SELECT symbol, (quote_mid - base_mid) / nullif(base_mid, 0) * 10000 AS x FROM aligned)
SELECT symbol, count(x) AS n, round(avg(x), 4) AS mean_bps, round(stddev_samp(x), 4) AS std_bps, round(min(x), 6) AS min_bps, round(max(x), 6) AS max_bps, round(avg(CASE WHEN x > 0 THEN 1.0 WHEN x <= 0 THEN 0.0 END), 6) AS share_positive FROM b GROUP BY symbol""",
)
def basis_summary(spark, d):
    rows = align.basis_summary(aligned(spark, d).withColumn("basis_bps", align.basis_bps(F.col("base_mid"), F.col("quote_mid"))), ["symbol"])
    return rounded(rows, "min_bps", "max_bps", "share_positive").withColumns({c: F.round(c, 4) for c in ("mean_bps", "std_bps")})




def _daily_sql() -> str:
    """The alignment with the day among its keys."""
    head, _, tail = _ALIGNED.partition("mids AS (")
    tail = tail.replace("SELECT symbol, source,", "SELECT symbol, date, source,").replace("GROUP BY 1, 2, 3", "GROUP BY 1, 2, 3, 4", 1)
    tail = tail.replace("SELECT symbol, bucket, max(mid)", "SELECT symbol, date, bucket, max(mid)").replace("FROM mids GROUP BY 1, 2", "FROM mids GROUP BY 1, 2, 3")
    tail = tail.replace("SELECT symbol, greatest", "SELECT symbol, date, greatest").replace("FROM wide GROUP BY 1", "FROM wide GROUP BY 1, 2").replace("SELECT symbol, lo, unnest", "SELECT symbol, date, lo, unnest")
    tail = tail.replace("SELECT g.symbol AS symbol,", "SELECT g.symbol AS symbol, g.date AS date,").replace("g.symbol = wide.symbol AND", "g.symbol = wide.symbol AND g.date = wide.date AND").replace("PARTITION BY g.symbol ORDER", "PARTITION BY g.symbol, g.date ORDER")
    return head + "mids AS (" + tail.replace("SELECT symbol, bucket, base_mid, quote_mid FROM filled", "SELECT symbol, date, bucket, base_mid, quote_mid FROM filled")


@query(
    "cross_venue_basis",
    f"""{_daily_sql()} SELECT symbol, date, bucket, base_mid, quote_mid, round((quote_mid - base_mid) / nullif(base_mid, 0) * 10000, 6) AS basis_bps, count(*) OVER (PARTITION BY symbol, date) AS day_buckets,
    round(100.0 * CAST(count(*) OVER (PARTITION BY symbol, date) AS DOUBLE) / 24.0, 2) AS day_coverage_pct FROM aligned""",
)
def cross_venue_basis(spark, d):
    return rounded(gold.cross_venue_basis(st.quotes(spark, d), *VENUES, st.HOUR_MS), "basis_bps")


_LAGS = f"""{_ALIGNED}, rets AS (
    SELECT symbol, bucket, CASE WHEN base_mid > 0 AND lag(base_mid) OVER w > 0 THEN ln(base_mid / lag(base_mid) OVER w) END AS x, CASE WHEN quote_mid > 0 AND lag(quote_mid) OVER w > 0 THEN ln(quote_mid / lag(quote_mid) OVER w) END AS y
    FROM aligned WINDOW w AS (PARTITION BY symbol ORDER BY bucket)
), pairs AS (
    SELECT a.symbol AS symbol, k AS lag, a.x AS x, b.y AS y FROM (SELECT *, unnest(range(-5, 6)) AS k FROM rets) a JOIN rets b ON a.symbol = b.symbol AND b.bucket = a.bucket + k WHERE a.x IS NOT NULL AND b.y IS NOT NULL
), lags AS (SELECT symbol, CAST(lag AS INTEGER) AS lag, covar_samp(x, y) / nullif(stddev_samp(x) * stddev_samp(y), 0) AS corr, count(*) AS n FROM pairs GROUP BY 1, 2)"""


@query("lead_lag_corr", f"{_LAGS} SELECT symbol, lag, round(corr, 6) AS corr, n FROM lags")
def lead_lag_corr(spark, d):
    return rounded(align.lead_lag(aligned(spark, d), ["symbol"], 5), "corr")


@query(
    "lead_lag_peak",
    f"""{_LAGS}, best AS (SELECT symbol, lag, corr FROM lags WHERE corr IS NOT NULL QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY corr DESC, lag) = 1)
SELECT symbol, lag, CAST(lag * 3600000 AS BIGINT) AS lag_ms, round(corr, 4) AS corr, CASE WHEN lag > 0 THEN 'base' WHEN lag < 0 THEN 'quote' ELSE 'simultaneous' END AS leader FROM best""",
)
def lead_lag_peak(spark, d):
    lags = align.lead_lag(aligned(spark, d), ["symbol"], 5)
    return align.peak_lag(lags, ["symbol"], st.HOUR_MS)


# Checks

_V = "SELECT '{g}' AS \"group\", {src} AS source, {sid} AS series_id, {metric} AS metric, '{check}' AS \"check\", {sev} AS severity, {detail} AS detail"


def _vsql(g, check, sev, detail, src="source", sid="CAST(NULL AS VARCHAR)", metric="CAST(NULL AS VARCHAR)"):
    return _V.format(g=g, check=check, sev=sev if sev.startswith("CASE") or sev == "severity" else f"'{sev}'", detail=detail, src=src, sid=sid, metric=metric)


_FRESH = f"""WITH {st.BARS}, g AS (
    SELECT source, symbol, date, CAST(date_diff('day', lag(date) OVER (PARTITION BY source, symbol ORDER BY date), date) AS BIGINT) * 86400 AS gap FROM bars
), k AS (SELECT *, row_number() OVER (PARTITION BY source, symbol ORDER BY date DESC) AS place FROM g WHERE gap IS NOT NULL),
q AS (SELECT source, symbol, quantile_cont(gap, 0.9) AS q90 FROM k WHERE place <= 30 GROUP BY 1, 2),
n AS (SELECT source, symbol, max(date) AS newest, count(*) AS n FROM bars GROUP BY 1, 2),
t AS (SELECT n.source AS source, n.symbol AS symbol, newest, CASE WHEN n >= 3 THEN greatest(q90 * 3, 86400.0) END AS threshold FROM n LEFT JOIN q ON n.source = q.source AND n.symbol = q.symbol)"""


@query("freshness_threshold", f"{_FRESH} SELECT source, symbol, newest, round(CAST(threshold AS DOUBLE), 6) AS threshold FROM t")
def freshness_threshold(spark, d):
    return rounded(statistics.freshness_threshold(st.bars(spark, d), BAR_KEYS, 86_400), "threshold")


@query(
    "freshness",
    f"""{_FRESH}, late AS (SELECT *, CAST(date_diff('day', newest, DATE '2001-11-09') AS BIGINT) * 86400 AS age FROM t)
{_vsql("bars", "freshness", "warn", "'age ' || CAST(age AS VARCHAR) || ' s over ' || CAST(CAST(round(threshold) AS BIGINT) AS VARCHAR) || ' s'", sid="symbol")} FROM late WHERE age > threshold""",
)
def freshness(spark, d):
    return checks.freshness(st.bars(spark, d), "bars", BAR_KEYS, day("2001-11-09"), 86_400)


_HOLES = f"""WITH {st.BARS}, holes AS (SELECT source, symbol, date, CASE WHEN volume > 45 THEN NULL ELSE open END AS open, high, low, close, CASE WHEN volume > 20 THEN NULL ELSE volume END AS volume FROM bars)"""


def holes(spark, d) -> DataFrame:
    return st.bars(spark, d).withColumn("open", F.when(~(F.col("volume") > 45), F.col("open"))).withColumn("volume", F.when(~(F.col("volume") > 20), F.col("volume")))


@query(
    "null_rate",
    f"""{_HOLES}, c AS (SELECT source, symbol, count(*) AS n_rows, count(*) FILTER (WHERE open IS NULL) AS n_open, count(*) FILTER (WHERE close IS NULL) AS n_close, count(*) FILTER (WHERE volume IS NULL) AS n_volume FROM holes GROUP BY 1, 2),
u AS (SELECT source, symbol, n_rows, 'open' AS k, n_open AS n_null, 0.1 AS tol FROM c UNION ALL SELECT source, symbol, n_rows, 'close', n_close, 0.0 FROM c UNION ALL SELECT source, symbol, n_rows, 'volume', n_volume, 0.5 FROM c)
{_vsql("bars", "nulls", "error", "k || ' ' || CAST(n_null AS VARCHAR) || ' of ' || CAST(n_rows AS VARCHAR) || ' null'", sid="symbol")} FROM u WHERE CAST(n_null AS DOUBLE) / n_rows > tol""",
)
def null_rate(spark, d):
    return checks.nulls(holes(spark, d), "bars", BAR_KEYS, {"open": 0.1, "close": 0.0, "volume": 0.5})


EVENT_KEYS = ["source", "calendar"]


@query(
    "bitemporal_order",
    f"""WITH {st.PRINTS}, n AS (SELECT source, calendar, count(*) FILTER (WHERE observed_ts < scheduled_ts) AS n FROM prints GROUP BY 1, 2)
{_vsql("events", "bitemporal_order", "error", "CAST(n AS VARCHAR) || ' observed before scheduled'", sid="calendar")} FROM n WHERE n > 0""",
)
def bitemporal_order(spark, d):
    return checks.bitemporal_order(st.prints(spark, d), EVENT_KEYS)


_DAMAGED = f"""WITH {st.PRINTS}, damaged AS (
    SELECT * FROM prints WHERE NOT (CAST(series_id AS BIGINT) % 7 = 0 AND revision_seq = 0) AND NOT (CAST(series_id AS BIGINT) % 11 = 0 AND revision_seq = 1)
    UNION ALL SELECT * FROM prints WHERE CAST(series_id AS BIGINT) % 13 = 0 AND revision_seq = 0
)"""


def damaged(spark, d) -> DataFrame:
    rows, key = st.prints(spark, d), F.col("series_id").cast("bigint")
    kept = rows.where(~((key % 7 == 0) & (F.col("revision_seq") == 0)) & ~((key % 11 == 0) & (F.col("revision_seq") == 1)))
    return kept.unionByName(rows.where((key % 13 == 0) & (F.col("revision_seq") == 0)))


@query(
    "initial_print",
    f"""{_DAMAGED}, e AS (SELECT source, calendar, event_id, count(*) FILTER (WHERE revision_seq = 0) AS k FROM damaged GROUP BY 1, 2, 3),
n AS (SELECT source, calendar, count(*) FILTER (WHERE k = 0) AS n0, count(*) FILTER (WHERE k > 1) AS n2 FROM e GROUP BY 1, 2)
{_vsql("events", "initial_print", "error", "CAST(n0 AS VARCHAR) || ' without initial print, ' || CAST(n2 AS VARCHAR) || ' with several'", sid="calendar")} FROM n WHERE n0 + n2 > 0""",
)
def initial_print(spark, d):
    return checks.initial_print(damaged(spark, d), EVENT_KEYS)


_SHAPE = f"{_DAMAGED}, shape AS (SELECT source, calendar, event_id, min(revision_seq) AS lo, max(revision_seq) AS hi, count(*) AS n, count(DISTINCT revision_seq) AS d FROM damaged GROUP BY 1, 2, 3), bad AS (SELECT * FROM shape WHERE lo <> 0 OR hi <> n - 1 OR d <> n)"


@query("revision_contiguity", f"{_SHAPE} SELECT source, calendar, event_id, lo, hi, n, d FROM bad")
def revision_contiguity(spark, d):
    return checks.revision_shape(damaged(spark, d), EVENT_KEYS)


@query(
    "revision_seq",
    f"""{_SHAPE}, k AS (SELECT source, calendar, count(*) AS n FROM bad GROUP BY 1, 2)
{_vsql("events", "revision_seq", "error", "CAST(n AS VARCHAR) || ' events with gaps in their revisions'", sid="calendar")} FROM k""",
)
def revision_seq(spark, d):
    return checks.revision_seq(damaged(spark, d), EVENT_KEYS)


_PRESENT = f"""WITH {st.QUOTES}, present AS (SELECT DISTINCT source, symbol, CASE WHEN update_id % 2 = 0 THEN 'trades' ELSE 'book_ticker' END AS kind, date FROM quotes WHERE (update_id // 24) % 5 <> 0 AND NOT (source = 'error' AND symbol = 'S2' AND update_id % 2 = 0)),
today AS (SELECT * FROM present WHERE date = DATE '2024-01-03')"""


def present(spark, d) -> DataFrame:
    rows = st.quotes(spark, d).where("(update_id div 24) % 5 <> 0 AND NOT (source = 'error' AND symbol = 'S2' AND update_id % 2 = 0)")
    return rows.select("source", "symbol", F.when(F.col("update_id") % 2 == 0, "trades").otherwise("book_ticker").alias("kind"), "date").distinct()


@query(
    "capture_absent",
    f"""{_PRESENT}, declared AS (SELECT DISTINCT source, symbol, kind FROM present UNION SELECT 'ghost', 'S0', 'trades')
{_vsql("microstructure", "capture", "error", "'declared stream absent'", sid="symbol", metric="kind")} FROM declared WHERE NOT EXISTS (SELECT 1 FROM today t WHERE t.source = declared.source AND t.symbol = declared.symbol AND t.kind = declared.kind)""",
)
def capture_absent(spark, d):
    rows = present(spark, d)
    declared = rows.select("source", "symbol", "kind").distinct().unionByName(spark.range(1).select(F.lit("ghost").alias("source"), F.lit("S0").alias("symbol"), F.lit("trades").alias("kind")))
    return checks.capture(declared, rows.where(F.col("date") == day("2024-01-03")), ["source", "symbol", "kind"])


@query(
    "activity",
    f"""{_PRESENT}, pairs AS (SELECT DISTINCT source, symbol FROM today), wanted AS (SELECT source, symbol, unnest(['trades', 'book_ticker']) AS kind FROM pairs)
{_vsql("microstructure", "activity", "warn", "'no ' || kind", sid="symbol", metric="kind")} FROM wanted WHERE NOT EXISTS (SELECT 1 FROM today t WHERE t.source = wanted.source AND t.symbol = wanted.symbol AND t.kind = wanted.kind)""",
)
def activity(spark, d):
    return checks.activity(present(spark, d).where(F.col("date") == day("2024-01-03")))


@query(
    "venue_pair",
    f"""{_PRESENT}, k AS (SELECT symbol, min(source) AS source FROM today WHERE source IN ('click', 'view') AND kind = 'book_ticker' AND NOT (source = 'view' AND symbol = 'S1') GROUP BY symbol HAVING count(DISTINCT source) = 1)
{_vsql("microstructure", "venue_pair", "error", "'only ' || source", sid="symbol")} FROM k WHERE (SELECT count(DISTINCT source) FROM present WHERE source IN ('click', 'view')) = 2""",
)
def venue_pair(spark, d):
    rows = present(spark, d)
    today = rows.where((F.col("date") == day("2024-01-03")) & (F.col("kind") == "book_ticker") & ~((F.col("source") == "view") & (F.col("symbol") == "S1")))
    return checks.venue_pair(today, rows, VENUES)


_TRADES = f"""WITH {st.QUOTES}, trades AS (SELECT source, symbol, 'trades' AS kind, received_at, update_id AS start_seq, update_id AS end_seq FROM quotes WHERE update_id % 17 <> 0),
seq AS (SELECT symbol, start_seq, lag(end_seq) OVER (PARTITION BY symbol ORDER BY received_at, end_seq) AS last_seq FROM (SELECT 'ALL' AS symbol, received_at, start_seq, end_seq FROM trades)),
jumps AS (SELECT symbol, last_seq, start_seq AS next_seq, start_seq - last_seq - 1 AS missing_count FROM seq WHERE start_seq > last_seq + 1)"""


def trades(spark, d) -> DataFrame:
    rows = st.quotes(spark, d).where("update_id % 17 <> 0")
    return rows.select(F.lit("ALL").alias("symbol"), "received_at", F.col("update_id").alias("start_seq"), F.col("update_id").alias("end_seq"))


@query("sequence_gaps_contiguous", f"{_TRADES} SELECT * FROM jumps")
def sequence_gaps_contiguous(spark, d):
    return tape.sequence_gaps(trades(spark, d), ["symbol"], ["received_at", "end_seq"])


_ORDER_ONLY = f"""WITH {st.QUOTES}, o AS (SELECT source, symbol, update_id, max(update_id) OVER (PARTITION BY source, symbol ORDER BY mid, update_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_seq FROM quotes)"""


@query("sequence_gaps_ordering_only", f"{_ORDER_ONLY} SELECT source, symbol, last_seq, update_id AS next_seq, CAST(NULL AS BIGINT) AS missing_count FROM o WHERE update_id <= last_seq")
def sequence_gaps_ordering_only(spark, d):
    return tape.order_breaks(st.quotes(spark, d), ["source", "symbol"], ["mid", "update_id"])


_GAPS = f"""WITH {st.QUOTES}, records AS (
    SELECT source, symbol, CASE WHEN update_id % 10 = 0 AND source <> 'view' THEN 'sequence_jump' ELSE 'reconnect' END AS reason, CASE WHEN update_id % 10 = 0 AND source <> 'view' THEN CAST(update_id % 7 AS VARCHAR) WHEN update_id % 3 = 0 THEN 'n/a' END AS missing_count
    FROM quotes
), sums AS (SELECT source, symbol, count(*) FILTER (WHERE reason = 'sequence_jump') AS n_jumps, count(*) FILTER (WHERE reason = 'reconnect') AS n_reconnects, CAST(coalesce(sum(TRY_CAST(missing_count AS BIGINT)), 0) AS BIGINT) AS n_missing FROM records GROUP BY 1, 2)"""


def gap_records(spark, d) -> DataFrame:
    jump = (F.col("update_id") % 10 == 0) & (F.col("source") != "view")
    missing = F.when(jump, (F.col("update_id") % 7).cast("string")).when(F.col("update_id") % 3 == 0, "n/a")
    return st.quotes(spark, d).select("source", "symbol", F.when(jump, "sequence_jump").otherwise("reconnect").alias("reason"), missing.alias("missing_count"))


@query("gap_summary", f"{_GAPS} SELECT source, symbol, n_jumps, n_reconnects, n_missing FROM sums")
def gap_summary(spark, d):
    return checks.gap_summary(gap_records(spark, d), ["source", "symbol"])


@query(
    "gap_violations",
    f"""{_GAPS}, s AS (SELECT *, CASE WHEN n_jumps > 0 THEN 'error' WHEN n_reconnects > 24 THEN 'warn' END AS severity FROM sums)
{_vsql("microstructure", "gaps", "severity", "CAST(n_jumps AS VARCHAR) || ' jumps, ' || CAST(n_missing AS VARCHAR) || ' missing, ' || CAST(n_reconnects AS VARCHAR) || ' reconnects'", sid="symbol")} FROM s WHERE severity IS NOT NULL""",
)
def gap_violations(spark, d):
    return checks.gaps(gap_records(spark, d), ["source", "symbol"])


_TICKS = f"""WITH {st.QUOTES}, ticks AS (
    SELECT source, symbol, CAST(update_id AS VARCHAR) AS bid_price, CASE WHEN update_id % 50 = 0 THEN '1d' ELSE CAST(update_id + (update_id % 9) - 1 AS VARCHAR) END AS ask_price, CAST(update_id % 31 - 1 AS VARCHAR) AS bid_qty, '2.50' AS ask_qty FROM quotes
), n AS (SELECT source, symbol, count(*) FILTER (WHERE TRY_CAST(bid_price AS DOUBLE) > TRY_CAST(ask_price AS DOUBLE)) AS n_crossed, count(*) FILTER (WHERE TRY_CAST(bid_qty AS DOUBLE) < 0 OR TRY_CAST(ask_qty AS DOUBLE) < 0) AS n_negative FROM ticks GROUP BY 1, 2)"""


def ticks(spark, d) -> DataFrame:
    u = F.col("update_id")
    ask = F.when(u % 50 == 0, "1d").otherwise((u + u % 9 - 1).cast("string"))
    return st.quotes(spark, d).select("source", "symbol", u.cast("string").alias("bid_price"), ask.alias("ask_price"), (u % 31 - 1).cast("string").alias("bid_qty"), F.lit("2.50").alias("ask_qty"), "received_at", "update_id")


@query("crossed_book", f"""{_TICKS} {_vsql("microstructure", "crossed_book", "error", "CAST(n_crossed AS VARCHAR) || ' crossed, ' || CAST(n_negative AS VARCHAR) || ' negative sizes'", sid="symbol")} FROM n WHERE n_crossed + n_negative > 0""")
def crossed_book(spark, d):
    return checks.crossed_book(ticks(spark, d))


@query("text_mids", f"{_TICKS} SELECT source, symbol, update_id, (TRY_CAST(bid_price AS DOUBLE) + TRY_CAST(ask_price AS DOUBLE)) / 2 AS mid FROM (SELECT source, symbol, update_id, CAST(update_id AS VARCHAR) AS bid_price, CASE WHEN update_id % 50 = 0 THEN '1d' ELSE CAST(update_id + (update_id % 9) - 1 AS VARCHAR) END AS ask_price FROM quotes)")
def text_mids(spark, d):
    return align.mids(ticks(spark, d)).drop("received_at")
