"""Registered queries: verification of frames, of sources against each other, completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators import contracts, statistics, verify
from tidelake.plans import standins as st
from tidelake.plans.catalogue import BAR_KEYS, _HOLES, _vsql, day, holes, query, rounded


def bent(spark, d) -> DataFrame:
    """Bars with known damage: closes above the high, negative volumes, repeats, far jumps."""
    rows = st.bars(spark, d)
    k = F.day("date")
    close = F.when(k == 3, F.col("close") + 10).when((k == 9) & (F.col("symbol") == "4"), F.col("close") * 40).otherwise(F.col("close"))
    rows = rows.withColumn("close", close).withColumn("volume", F.when(k == 5, -F.col("volume")).otherwise(F.col("volume")))
    return rows.unionByName(rows.where(k == 7))


_BENT = f"""WITH {st.BARS}, b0 AS (
    SELECT source, symbol, date, open, high, low, CASE WHEN day(date) = 3 THEN close + 10 WHEN day(date) = 9 AND symbol = '4' THEN close * 40 ELSE close END AS close, CASE WHEN day(date) = 5 THEN -volume ELSE volume END AS volume FROM bars
), bent AS (SELECT * FROM b0 UNION ALL SELECT * FROM b0 WHERE day(date) = 7)"""
_SLACK = "abs(close) * 1e-6"


@query(
    "ohlc_coherence",
    f"""{_BENT}, n AS (SELECT source, symbol, count(*) AS n, min(date) AS d FROM bent WHERE NOT (low <= high + {_SLACK} AND open <= high + {_SLACK} AND close <= high + {_SLACK} AND open >= low - {_SLACK} AND close >= low - {_SLACK}) GROUP BY 1, 2)
{_vsql("bars", "ohlc_coherent", "error", "CAST(n AS VARCHAR) || ' incoherent bars, first ' || strftime(d, '%Y-%m-%d')", sid="symbol")} FROM n""",
)
def ohlc_coherence(spark, d):
    return verify.ohlc(bent(spark, d), BAR_KEYS)


@query("negative_volume", f"""{_BENT}, n AS (SELECT source, symbol, count(*) AS n FROM bent WHERE volume < 0 GROUP BY 1, 2) {_vsql("bars", "volume", "error", "CAST(n AS VARCHAR) || ' negative volumes'", sid="symbol")} FROM n""")
def negative_volume(spark, d):
    return verify.volume(bent(spark, d), BAR_KEYS)


@query("dup_keys", f"{_BENT} SELECT source, symbol, date, count(*) AS n FROM bent GROUP BY 1, 2, 3 HAVING count(*) > 1")
def dup_keys(spark, d):
    return verify.duplicate_keys(bent(spark, d), [*BAR_KEYS, "date"])


@query("repeated_dates", f"""{_BENT}, n AS (SELECT source, symbol, date FROM bent GROUP BY 1, 2, 3 HAVING count(*) > 1), k AS (SELECT source, symbol, count(*) AS k FROM n GROUP BY 1, 2) {_vsql("bars", "index", "error", "CAST(k AS VARCHAR) || ' repeated dates'", sid="symbol")} FROM k""")
def repeated_dates(spark, d):
    return verify.index(bent(spark, d), "bars", BAR_KEYS)


@query(
    "implausible_returns",
    f"""{_BENT}, one AS (SELECT * FROM b0), r AS (SELECT source, symbol, close / lag(close) OVER (PARTITION BY source, symbol ORDER BY date) - 1 AS ret FROM one)
SELECT source, symbol, count(*) AS n, round(max(ret), 6) AS biggest FROM r WHERE abs(ret) > 5 GROUP BY 1, 2""",
)
def implausible_returns(spark, d):
    return rounded(verify.implausible(bent(spark, d).dropDuplicates([*BAR_KEYS, "date"]), BAR_KEYS), "biggest")


_STEPS = "steps AS (SELECT l_returnflag AS source, CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, CASE WHEN l_suppkey % 3 = 0 THEN 1.5 ELSE l_discount END AS close FROM lineitem)"


@query("constant_series", f"WITH {_STEPS} SELECT source, symbol, count(close) AS n FROM steps GROUP BY 1, 2 HAVING count(close) >= 2 AND min(close) = max(close)")
def constant_series(spark, d):
    rows = st.read(spark, d, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_suppkey").cast("string").alias("symbol"), F.when(F.col("l_suppkey") % 3 == 0, 1.5).otherwise(F.col("l_discount")).alias("close"))
    return verify.constant(rows, BAR_KEYS)


@query(
    "numeric_parse",
    """WITH t AS (SELECT o_orderpriority AS source, CASE o_orderkey % 5 WHEN 0 THEN '1,234.5' WHEN 1 THEN '1d' WHEN 2 THEN ' 1e3 ' WHEN 3 THEN CAST(o_orderkey AS VARCHAR) END AS price, CASE WHEN o_orderkey % 4 = 0 THEN 'abc' ELSE '0.5' END AS size FROM orders),
u AS (SELECT source, 'price' AS k, price AS v FROM t UNION ALL SELECT source, 'size', size FROM t)
SELECT source, k AS "column", count(*) AS n_bad, min(v) AS sample FROM u WHERE v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL GROUP BY 1, 2""",
)
def numeric_parse(spark, d):
    k = F.col("o_orderkey") % 5
    price = F.when(k == 0, "1,234.5").when(k == 1, "1d").when(k == 2, " 1e3 ").when(k == 3, F.col("o_orderkey").cast("string"))
    rows = st.read(spark, d, "orders").select(F.col("o_orderpriority").alias("source"), price.alias("price"), F.when(F.col("o_orderkey") % 4 == 0, "abc").otherwise("0.5").alias("size"))
    return verify.unparseable(rows, ["source"], ["price", "size"])


_GAP_CTE = f"""WITH {st.BARS}, g AS (SELECT source, symbol, date, CAST(date_diff('day', lag(date) OVER (PARTITION BY source, symbol ORDER BY date), date) AS BIGINT) * 86400 AS gap FROM bars),
c AS (SELECT source, symbol, gap, count(*) AS n FROM g WHERE gap IS NOT NULL GROUP BY 1, 2, 3),
m AS (SELECT source, symbol, gap AS modal_gap, CAST(sum(n) OVER (PARTITION BY source, symbol) AS BIGINT) AS n_gaps FROM c QUALIFY row_number() OVER (PARTITION BY source, symbol ORDER BY n DESC, gap) = 1)"""


@query("modal_gap", f"{_GAP_CTE} SELECT source, symbol, n_gaps, modal_gap FROM m WHERE n_gaps >= 2")
def modal_gap(spark, d):
    return statistics.modal_gap(st.bars(spark, d), BAR_KEYS)


@query("interval_modal_gap", f"""{_GAP_CTE} {_vsql("bars", "interval", "error", "'modal gap ' || CAST(modal_gap AS VARCHAR) || ' s'", sid="symbol")} FROM m WHERE modal_gap <> 172800""")
def interval_modal_gap(spark, d):
    return verify.interval(st.bars(spark, d), "bars", BAR_KEYS, 172_800)


@query(
    "future_or_range",
    f"""WITH {st.BARS}, n AS (SELECT source, symbol, count(*) FILTER (WHERE date > DATE '2001-06-03') AS n_future, count(*) FILTER (WHERE date < DATE '1995-02-01') AS n_before, count(*) FILTER (WHERE date > DATE '2001-05-02') AS n_after FROM bars GROUP BY 1, 2)
SELECT * FROM n WHERE n_future + n_before + n_after > 0""",
)
def future_or_range(spark, d):
    return verify.outside(st.bars(spark, d), BAR_KEYS, day("2001-06-01"), day("1995-02-01"), day("2001-05-01"))


_PAIRS = f"WITH {st.BARS}, pairs AS (SELECT a.symbol AS symbol, a.date AS date, a.close AS a, b.close AS b FROM bars a JOIN bars b ON a.symbol = b.symbol AND a.date = b.date WHERE a.source = 'A' AND b.source = 'R')"


def pairs(spark, d) -> DataFrame:
    return statistics.paired(st.bars(spark, d), "A", "R", ["symbol"])


@query("cross_source_median", f"{_PAIRS} SELECT symbol, count(*) AS n_shared, round(median(abs(a - b) / abs(b)), 6) AS median_rel_diff FROM pairs GROUP BY 1")
def cross_source_median(spark, d):
    return rounded(statistics.median_difference(pairs(spark, d), ["symbol"]), "median_rel_diff")


_CORR = "covar_samp(x, y) / nullif(stddev_samp(x) * stddev_samp(y), 0)"


@query(
    "return_correlation",
    f"""{_PAIRS}, r AS (SELECT symbol, a / lag(a) OVER w - 1 AS x, b / lag(b) OVER w - 1 AS y FROM pairs WINDOW w AS (PARTITION BY symbol ORDER BY date))
SELECT symbol, count(*) AS n_returns, round({_CORR}, 6) AS ret_corr FROM r WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1""",
)
def return_correlation(spark, d):
    return rounded(statistics.return_correlation(pairs(spark, d), ["symbol"]), "ret_corr")




@query("ratio_trend_spearman", f"{_PAIRS}, k AS (SELECT symbol, rank() OVER (PARTITION BY symbol ORDER BY a / b) + (count(*) OVER (PARTITION BY symbol, a / b) - 1) / 2.0 AS x, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) AS DOUBLE) AS y FROM pairs) SELECT symbol, count(*) AS n, round({_CORR}, 6) AS trend FROM k GROUP BY 1")
def ratio_trend_spearman(spark, d):
    return rounded(statistics.ratio_trend(pairs(spark, d), ["symbol"]), "trend")


# Three venues made of the bars' dates, so that every verdict between sources occurs.

_VENUES = f"""WITH {st.BARS}, base AS (
    SELECT symbol, date, 1000 + (dayofyear(date) * 37 % 101) / 10.0 + CAST(symbol AS INTEGER) AS v, 1000 + (dayofyear(date) * 53 % 97) / 10.0 AS w, CAST(date_diff('day', DATE '1995-01-01', date) AS INTEGER) AS n FROM (SELECT DISTINCT symbol, date FROM bars)
), venues AS (
    SELECT 'us' AS source, symbol, date, CAST(v AS DOUBLE) AS close FROM base WHERE NOT (symbol IN ('1', '8') AND n % 3 <> 0) AND NOT (symbol = '5' AND n > 250)
    UNION ALL SELECT 'p1', symbol, CASE WHEN symbol = '7' THEN date + 4000 ELSE date END, CAST(CASE WHEN symbol IN ('2', '6') THEN v * 100 WHEN symbol = '3' THEN v * (1 + n / 2000.0) WHEN symbol = '4' THEN w WHEN symbol = '5' THEN v * (1.2 + (n % 2) * 0.0006) ELSE v END AS DOUBLE)
    FROM base WHERE symbol <> '9' AND NOT (symbol = '5' AND n > 250)
    UNION ALL SELECT 'p2', symbol, date, CAST(CASE WHEN symbol IN ('0', '2') THEN v * 100 ELSE v END AS DOUBLE) FROM base WHERE symbol IN ('0', '1', '2', '6', '8') AND NOT (symbol = '8' AND n % 3 <> 0)
)"""


def venues(spark, d) -> DataFrame:
    yearday, n, symbol = F.dayofyear("date"), F.datediff("date", day("1995-01-01")), F.col("symbol")
    base = st.bars(spark, d).select("symbol", "date").distinct().select("symbol", "date", n.alias("n"), (1000 + (yearday * 37 % 101) / 10.0 + symbol.cast("int")).alias("v"), (1000 + (yearday * 53 % 97) / 10.0).alias("w"))
    n, v, thin, short = F.col("n"), F.col("v"), F.col("n") % 3 != 0, (symbol == "5") & (F.col("n") > 250)
    p1 = F.when(symbol.isin("2", "6"), v * 100).when(symbol == "3", v * (1 + n / 2000.0)).when(symbol == "4", F.col("w")).when(symbol == "5", v * (1.2 + (n % 2) * 0.0006)).otherwise(v)
    p2 = F.when(symbol.isin("0", "2"), v * 100).otherwise(v)
    us = (~(symbol.isin("1", "8") & thin) & ~short, F.col("date"), v)
    one = ((symbol != "9") & ~short, F.when(symbol == "7", F.date_add("date", 4000)).otherwise(F.col("date")), p1)
    two = (symbol.isin("0", "1", "2", "6", "8") & ~((symbol == "8") & thin), F.col("date"), p2)
    offer = lambda name, x: F.when(x[0], F.struct(F.lit(name).alias("source"), x[1].alias("date"), x[2].alias("close")))
    offers = F.explode(F.filter(F.array(offer("us", us), offer("p1", one), offer("p2", two)), lambda o: o.isNotNull()))
    return base.select("symbol", offers.alias("o")).select("o.source", "symbol", "o.date", "o.close")


_VERDICT = f"""{_VENUES}, span AS (SELECT symbol, min(date) AS lo, max(date) AS hi, count(*) AS n_ours FROM venues WHERE source = 'us' GROUP BY 1),
peers AS (SELECT s.symbol AS symbol, v.source AS peer, any_value(n_ours) AS n_ours, count(*) FILTER (WHERE v.date BETWEEN lo AND hi) AS n_theirs FROM span s JOIN venues v ON s.symbol = v.symbol WHERE v.source <> 'us' GROUP BY 1, 2),
met AS (SELECT a.symbol AS symbol, b.source AS peer, a.date AS date, a.close AS a, b.close AS b FROM venues a JOIN venues b ON a.symbol = b.symbol AND a.date = b.date WHERE a.source = 'us' AND b.source <> 'us'),
moves AS (SELECT *, a / lag(a) OVER w - 1 AS x, b / lag(b) OVER w - 1 AS y, CAST(row_number() OVER w AS DOUBLE) AS t, rank() OVER (PARTITION BY symbol, peer ORDER BY a / b) + (count(*) OVER (PARTITION BY symbol, peer, a / b) - 1) / 2.0 AS r FROM met WINDOW w AS (PARTITION BY symbol, peer ORDER BY date)),
sums AS (SELECT symbol, peer, count(*) AS n_shared, median(abs(a - b) / abs(b)) AS med, count(x) FILTER (WHERE y IS NOT NULL) AS n_returns, covar_samp(x, y) / nullif(stddev_samp(x) * stddev_samp(y), 0) AS corr, covar_samp(r, t) / nullif(stddev_samp(r) * stddev_samp(t), 0) AS trend FROM moves GROUP BY 1, 2),
said AS (SELECT p.symbol AS symbol, p.peer AS peer, med, coalesce(n_shared, 0) AS n_shared, CASE WHEN n_theirs = 0 THEN 'unreachable' WHEN n_ours / n_theirs < 0.7 THEN 'short' WHEN n_shared IS NULL THEN 'unreachable'
    WHEN med > 0.05 AND n_returns >= 5 AND corr >= 0.9 AND abs(trend) >= 0.8 AND n_shared >= 3 THEN 'drift' WHEN med > 0.05 AND n_returns >= 5 AND corr >= 0.9 AND trend IS NOT NULL AND n_shared >= 3 AND n_shared < 250 THEN 'inconclusive' WHEN med > 0.05 THEN 'apart'
    WHEN n_shared >= 6 AND n_returns >= 5 AND corr < 0.9 THEN 'unlike_returns' ELSE 'agree' END AS said FROM peers p LEFT JOIN sums s ON p.symbol = s.symbol AND p.peer = s.peer),
firsts AS (SELECT symbol, min(peer) AS peer FROM said WHERE said NOT IN ('short', 'unreachable') GROUP BY 1),
walk AS (SELECT span.symbol AS symbol, f.peer AS peer, fs.said AS said,
    (SELECT count(*) FROM said x WHERE x.symbol = span.symbol) AS n_peers, (SELECT count(*) FROM said x WHERE x.symbol = span.symbol AND x.said = 'short') AS n_short,
    (SELECT string_agg(x.peer, ', ' ORDER BY x.peer) FROM said x WHERE x.symbol = span.symbol AND x.said = 'short') AS short, (SELECT string_agg(x.peer, ', ' ORDER BY x.peer) FROM said x WHERE x.symbol = span.symbol AND x.said = 'unreachable') AS lost,
    (SELECT string_agg(x.peer, ', ' ORDER BY x.peer) FROM said x WHERE x.symbol = span.symbol AND x.said = 'short' AND x.peer < f.peer) AS before,
    (SELECT min(x.peer) FROM said x WHERE x.symbol = span.symbol AND x.peer <> f.peer AND x.n_shared > 0) AS third FROM span LEFT JOIN firsts f ON span.symbol = f.symbol LEFT JOIN said fs ON f.symbol = fs.symbol AND f.peer = fs.peer),
verdicts AS (SELECT w.symbol AS symbol, w.peer AS peer, CASE WHEN n_peers = 0 THEN 'no_peer' WHEN w.said = 'apart' AND third IS NULL THEN 'unsettled' WHEN w.said = 'apart' AND t.med > 0.05 THEN 'outvoted' WHEN w.said = 'apart' THEN 'peer_outlier'
    WHEN w.said = 'agree' AND before IS NOT NULL THEN 'coverage_disputed' WHEN w.said IS NOT NULL THEN w.said WHEN n_short > 1 THEN 'dropping' WHEN n_short = 1 THEN 'short' ELSE 'unreachable' END AS verdict, third, before, short, lost
    FROM walk w LEFT JOIN said t ON w.symbol = t.symbol AND w.third = t.peer),
judged AS (SELECT symbol, verdict, CASE WHEN verdict = 'agree' THEN NULL WHEN verdict IN ('unlike_returns', 'outvoted', 'unsettled', 'dropping') THEN 'error' ELSE 'warn' END AS severity, peer,
    coalesce(CASE WHEN verdict IN ('outvoted', 'peer_outlier') THEN third WHEN verdict = 'coverage_disputed' THEN before WHEN verdict IN ('dropping', 'short') THEN short WHEN verdict = 'unreachable' THEN lost END, '') AS others FROM verdicts)"""


@query("cross_source_verdict", f"{_VERDICT} SELECT symbol, verdict, severity, peer, others FROM judged")
def cross_source_verdict(spark, d):
    return verify.cross_source(verify.peer_statistics(venues(spark, d), "us", ["p1", "p2"], ["symbol"]), ["symbol"])


@query(
    "cross_source_violations",
    f"""{_VERDICT}, texts AS (SELECT symbol, severity, CASE verdict WHEN 'no_peer' THEN 'no other source has it' WHEN 'drift' THEN 'levels apart from ' || peer || ', moves alike, the ratio drifts one way'
    WHEN 'inconclusive' THEN 'levels apart from ' || peer || ', moves alike, too few dates to tell a drift' WHEN 'unlike_returns' THEN 'levels match ' || peer || ', moves do not' WHEN 'outvoted' THEN 'apart from ' || peer || ' and from ' || others
    WHEN 'peer_outlier' THEN 'apart from ' || peer || ' but matches ' || others WHEN 'unsettled' THEN 'apart from ' || peer || ', no third source' WHEN 'coverage_disputed' THEN 'matches ' || peer || ' but has far fewer rows than ' || others
    WHEN 'dropping' THEN 'far fewer rows than ' || others WHEN 'short' THEN 'far fewer rows than ' || others WHEN 'unreachable' THEN 'nothing to compare with ' || others END AS detail FROM judged WHERE severity IS NOT NULL)
{_vsql("bars", "cross_source", "severity", "detail", src="'us'", sid="symbol")} FROM texts""",
)
def cross_source_violations(spark, d):
    return verify.cross_source_violations(venues(spark, d), "us", ["p1", "p2"], ["symbol"])


_AGAIN = f"""WITH {st.BARS}, stored AS (SELECT * FROM bars WHERE day(date) <> 14), fetched AS (
    SELECT source, symbol, date, open * k AS open, CASE WHEN symbol = '3' AND day(date) = 11 THEN high * 1.03 ELSE high * k END AS high, low * k AS low, CASE WHEN symbol <> '3' AND day(date) = 11 THEN close * k * 1.01 ELSE close * k END AS close,
           CASE WHEN day(date) = 12 THEN volume * 1.5 ELSE volume END AS volume, 0 AS arrival FROM (SELECT *, CASE WHEN symbol = '2' THEN 0.5 ELSE 1.0 END AS k FROM bars) WHERE day(date) <> 13 AND NOT (symbol = '2' AND day(date) = 11)
    UNION ALL SELECT source, symbol, date, open * 1.2, high, low, close, volume, 1 FROM bars WHERE symbol = '5' AND day(date) = 7
    UNION ALL SELECT source, symbol, date + 5000, open, high, low, close, volume, 2 FROM bars WHERE day(date) = 20
), again AS (SELECT *, count(*) OVER (PARTITION BY source, symbol, date) AS n FROM fetched QUALIFY row_number() OVER (PARTITION BY source, symbol, date ORDER BY arrival DESC) = 1)"""


def again(spark, d) -> DataFrame:
    k, symbol, rows = F.day("date"), F.col("symbol"), st.bars(spark, d)
    by = F.when(symbol == "2", 0.5).otherwise(1.0)
    high = F.when((symbol == "3") & (k == 11), F.col("high") * 1.03).otherwise(F.col("high") * by)
    close = F.when((symbol != "3") & (k == 11), F.col("close") * by * 1.01).otherwise(F.col("close") * by)
    first = rows.where((k != 13) & ~((symbol == "2") & (k == 11))).withColumns({"open": F.col("open") * by, "high": high, "low": F.col("low") * by, "close": close, "volume": F.when(k == 12, F.col("volume") * 1.5).otherwise(F.col("volume")), "arrival": F.lit(0)})
    twice = rows.where((symbol == "5") & (k == 7)).withColumns({"open": F.col("open") * 1.2, "arrival": F.lit(1)})
    later = rows.where(k == 20).withColumns({"date": F.date_add("date", 5000), "arrival": F.lit(2)})
    return first.unionByName(twice).unionByName(later)


_PRICE = "CASE WHEN a.{c} = 0 AND s.{c} <> 0 THEN CAST('inf' AS DOUBLE) ELSE abs(s.{c} - a.{c}) / nullif(abs(a.{c}), 0) END AS m_{c}, s.{c} / nullif(a.{c}, 0) AS r_{c}"
_CONSISTENCY = f"""{_AGAIN}, span AS (SELECT source, symbol, min(date) AS lo, max(date) AS hi, count(*) AS n_stored FROM stored GROUP BY 1, 2),
j AS (SELECT coalesce(s.source, a.source) AS source, coalesce(s.symbol, a.symbol) AS symbol, coalesce(s.date, a.date) AS date, s.date IS NOT NULL AS is_old, a.date IS NOT NULL AS is_new, coalesce(n, 0) AS n, {", ".join(_PRICE.format(c=c) for c in verify.PRICES)}, abs(s.volume - a.volume) / nullif(abs(a.volume), 0) AS m_volume
    FROM stored s FULL JOIN again a ON s.source = a.source AND s.symbol = a.symbol AND s.date = a.date),
c AS (SELECT j.source AS source, j.symbol AS symbol, count(*) FILTER (WHERE is_old AND is_new) AS n_shared, CAST(sum(greatest(n - 1, 0)) AS BIGINT) AS n_repeated, count(*) FILTER (WHERE is_old AND NOT is_new) AS n_vanished, count(*) FILTER (WHERE NOT is_old AND date BETWEEN lo AND hi) AS n_appeared,
    {", ".join(f"max(m_{c}) FILTER (WHERE m_{c} > 1e-6) AS w_{c}, count(r_{c}) > 2 AND stddev_samp(r_{c}) < 1e-6 AS u_{c}" for c in verify.PRICES)}, count(*) FILTER (WHERE m_volume > 0.01) AS n_volume
    FROM j JOIN span ON j.source = span.source AND j.symbol = span.symbol WHERE n_stored >= 2 GROUP BY 1, 2),
w AS (SELECT *, greatest({", ".join(f"coalesce(w_{c}, -1)" for c in verify.PRICES)}) AS bar FROM c),
found AS (SELECT source, symbol, n_shared, n_repeated, n_vanished, n_appeared, CASE {" ".join(f"WHEN w_{c} = bar THEN '{c}'" for c in verify.PRICES)} END AS worst_column, CASE WHEN bar >= 0 THEN bar END AS worst_drift,
    coalesce(CASE {" ".join(f"WHEN w_{c} = bar THEN u_{c}" for c in verify.PRICES)} END, FALSE) AS uniform, n_volume FROM w)"""


def consistency(spark, d) -> DataFrame:
    return verify.self_consistency(st.bars(spark, d).where(F.day("date") != 14), again(spark, d), BAR_KEYS, arrival="arrival")


@query("self_consistency", f"{_CONSISTENCY} SELECT * REPLACE (round(worst_drift, 6) AS worst_drift) FROM found")
def self_consistency(spark, d):
    return rounded(consistency(spark, d), "worst_drift")


@query(
    "self_consistency_violations",
    f"""{_CONSISTENCY} {_vsql("bars", "self_consistency", "error", "CAST(n_repeated AS VARCHAR) || ' repeated dates in the re-fetch'", sid="symbol")} FROM found WHERE n_repeated > 0
UNION ALL {_vsql("bars", "self_consistency", "error", "CAST(n_vanished AS VARCHAR) || ' stored dates vanished'", sid="symbol")} FROM found WHERE n_vanished > 0
UNION ALL {_vsql("bars", "self_consistency", "warn", "CAST(n_appeared AS VARCHAR) || ' dates appeared inside the stored window'", sid="symbol")} FROM found WHERE n_appeared > 0
UNION ALL {_vsql("bars", "self_consistency", "CASE WHEN uniform THEN 'warn' ELSE 'error' END", "'settled ' || worst_column || ' values changed' || CASE WHEN uniform THEN ' by one ratio, as after a corporate action' ELSE ', history was revised' END", sid="symbol")} FROM found WHERE worst_column IS NOT NULL
UNION ALL {_vsql("bars", "self_consistency", "warn", "CAST(n_volume AS VARCHAR) || ' settled volumes changed'", sid="symbol")} FROM found WHERE n_volume > 0""",
)
def self_consistency_violations(spark, d):
    return verify.consistency_violations(consistency(spark, d), "bars", F.col("source"), F.col("symbol"))


@query(
    "series_revision",
    f"""WITH {st.SERIES}, again AS (SELECT source, series_id, metric, date, CASE WHEN day(date) = 8 THEN value + 1 ELSE value + 1e-10 END AS value FROM series WHERE metric IS NOT NULL AND day(date) <> 9), stored AS (SELECT * FROM series WHERE metric IS NOT NULL),
j AS (SELECT s.source AS source, s.series_id AS series_id, s.metric AS metric, s.value AS old, a.value AS new FROM stored s LEFT JOIN again a ON s.source = a.source AND s.series_id = a.series_id AND s.metric = a.metric AND s.date = a.date),
n AS (SELECT source, series_id, metric, count(*) FILTER (WHERE NOT abs(new - old) <= 1e-9 + 1e-6 * abs(old)) AS n_revised, count(*) FILTER (WHERE new IS NULL) AS n_vanished FROM j GROUP BY 1, 2, 3)
SELECT * FROM n WHERE n_revised + n_vanished > 0""",
)
def series_revision(spark, d):
    stored = st.series(spark, d).where("metric IS NOT NULL")
    fresh = stored.where(F.day("date") != 9).withColumn("value", F.when(F.day("date") == 8, F.col("value") + 1).otherwise(F.col("value") + 1e-10))
    return verify.series_revisions(stored, fresh, ["source", "series_id", "metric"])


_SERIES_AGAIN = f"""WITH {st.SERIES}, stored AS (SELECT source, series_id, metric, date, value FROM series WHERE metric IS NOT NULL AND NOT (day(date) = 10 AND series_id = '2-HIGH')), fetched AS (
    SELECT source, series_id, metric, date, CASE WHEN day(date) = 8 AND series_id <> '5-LOW' THEN value + 1 WHEN day(date) = 15 AND metric = 'revenue' AND series_id = '1-URGENT' THEN value + 5 ELSE value + 1e-10 END AS value FROM series WHERE metric IS NOT NULL AND NOT (day(date) = 9 AND series_id = '3-MEDIUM') AND NOT (series_id = '4-NOT SPECIFIED' AND metric = 'n_orders')
    UNION ALL SELECT source, series_id, 'extra', date, value FROM series WHERE metric = 'revenue' AND series_id = '2-HIGH'
), dates AS (SELECT source, series_id, date, max(is_old) AS is_old, max(is_new) AS is_new FROM (SELECT source, series_id, date, 1 AS is_old, 0 AS is_new FROM stored UNION ALL SELECT source, series_id, date, 0, 1 FROM fetched) GROUP BY 1, 2, 3),
span AS (SELECT source, series_id, min(date) AS lo, max(date) AS hi, count(DISTINCT date) AS n FROM stored GROUP BY 1, 2),
moved AS (SELECT d.source AS source, d.series_id AS series_id, count(*) FILTER (WHERE is_old = 1 AND is_new = 0) AS n_vanished, count(*) FILTER (WHERE is_old = 0 AND date BETWEEN lo AND hi) AS n_appeared FROM dates d JOIN span s ON d.source = s.source AND d.series_id = s.series_id WHERE n >= 2 GROUP BY 1, 2),
names AS (SELECT coalesce(a.source, b.source) AS source, coalesce(a.series_id, b.series_id) AS series_id, CASE WHEN b.metric IS NULL THEN a.metric END AS lost, CASE WHEN a.metric IS NULL THEN b.metric END AS gained
    FROM (SELECT DISTINCT source, series_id, metric FROM stored) a FULL JOIN (SELECT DISTINCT source, series_id, metric FROM fetched) b ON a.source = b.source AND a.series_id = b.series_id AND a.metric = b.metric),
lists AS (SELECT source, series_id, string_agg(lost, ', ' ORDER BY lost) AS lost, string_agg(gained, ', ' ORDER BY gained) AS gained FROM names GROUP BY 1, 2),
revised AS (SELECT s.source AS source, s.series_id AS series_id, s.metric AS metric, count(*) AS n_revised, max(abs(s.value - f.value)) AS largest FROM stored s JOIN fetched f ON s.source = f.source AND s.series_id = f.series_id AND s.metric = f.metric AND s.date = f.date WHERE NOT abs(f.value - s.value) <= 1e-9 + 1e-6 * abs(s.value) GROUP BY 1, 2, 3),
worst AS (SELECT source, series_id, metric, n_revised, count(*) OVER (PARTITION BY source, series_id) - 1 AS n_more FROM revised QUALIFY row_number() OVER (PARTITION BY source, series_id ORDER BY largest DESC, metric DESC) = 1)"""


@query(
    "series_consistency_violations",
    f"""{_SERIES_AGAIN} {_vsql("series", "self_consistency", "error", "CAST(n_vanished AS VARCHAR) || ' stored dates vanished'", sid="series_id")} FROM moved WHERE n_vanished > 0
UNION ALL {_vsql("series", "self_consistency", "warn", "CAST(n_appeared AS VARCHAR) || ' dates appeared inside the stored window'", sid="series_id")} FROM moved WHERE n_appeared > 0
UNION ALL {_vsql("series", "self_consistency", "error", "'no longer served: ' || lost", sid="series_id")} FROM lists WHERE lost IS NOT NULL
UNION ALL {_vsql("series", "self_consistency", "warn", "'served but not stored: ' || gained", sid="series_id")} FROM lists WHERE gained IS NOT NULL
UNION ALL {_vsql("series", "self_consistency", "warn", "CAST(n_revised AS VARCHAR) || ' settled values of ' || metric || CASE WHEN n_more > 0 THEN ' and ' || CAST(n_more AS VARCHAR) || ' more metrics' ELSE '' END || ' revised'", sid="series_id")} FROM worst""",
)
def series_consistency_violations(spark, d):
    rows = st.series(spark, d).where("metric IS NOT NULL")
    k, sid, value = F.day("date"), F.col("series_id"), F.col("value")
    stored = rows.where(~((k == 10) & (sid == "2-HIGH")))
    moved = F.when((k == 8) & (sid != "5-LOW"), value + 1).when((k == 15) & (F.col("metric") == "revenue") & (sid == "1-URGENT"), value + 5).otherwise(value + 1e-10)
    fetched = rows.where(~((k == 9) & (sid == "3-MEDIUM")) & ~((sid == "4-NOT SPECIFIED") & (F.col("metric") == "n_orders"))).withColumn("value", moved)
    extra = rows.where((F.col("metric") == "revenue") & (sid == "2-HIGH")).withColumn("metric", F.lit("extra"))
    return verify.series_consistency_violations(verify.series_consistency(stored, fetched.unionByName(extra), ["source", "series_id"]), F.col("source"), F.col("series_id"))


_DAILY_RETURNS = """daily AS (SELECT CAST(o_orderdate AS DATE) AS date, CAST(sum(o_custkey) AS DOUBLE) AS a, CAST(sum(o_custkey + o_orderkey % 100) AS DOUBLE) AS b, CAST(count(*) AS DOUBLE) AS c FROM orders GROUP BY 1),
rets AS (SELECT p.pair AS pair, date, CASE p.pair WHEN 'a/b' THEN a ELSE a END AS v, CASE p.pair WHEN 'a/b' THEN b ELSE c END AS u FROM daily, (SELECT unnest(['a/b', 'a/c']) AS pair) p),
xy AS (SELECT pair, date, v / nullif(lag(v) OVER w, 0) - 1 AS x, u / nullif(lag(u) OVER w, 0) - 1 AS y FROM rets WINDOW w AS (PARTITION BY pair ORDER BY date)),
good AS (SELECT * FROM xy WHERE x IS NOT NULL AND y IS NOT NULL)"""


def return_pairs(spark, d) -> DataFrame:
    total = lambda c: F.sum(c).cast("double")
    daily = st.read(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        total(F.col("o_custkey")).alias("a"), total(F.col("o_custkey") + F.col("o_orderkey") % 100).alias("b"), F.count("*").cast("double").alias("c")
    )
    long = daily.select("date", F.explode(F.array(F.struct(F.lit("a/b").alias("pair"), F.col("a").alias("v"), F.col("b").alias("u")), F.struct(F.lit("a/c").alias("pair"), F.col("a").alias("v"), F.col("c").alias("u")))).alias("p")).select("date", "p.*")
    one = statistics.returns(long, ["pair"], "v").withColumnRenamed("ret", "x")
    return statistics.returns(one, ["pair"], "u").withColumnRenamed("ret", "y").select("pair", "date", "x", "y")


@query(
    "proxy_rolling_corr",
    f"""WITH {_DAILY_RETURNS}, w AS (SELECT pair, date, count(*) OVER w AS n, covar_samp(x, y) OVER w / nullif(stddev_samp(x) OVER w * stddev_samp(y) OVER w, 0) AS corr FROM good WINDOW w AS (PARTITION BY pair ORDER BY date ROWS BETWEEN 179 PRECEDING AND CURRENT ROW))
SELECT pair, date, round(corr, 6) AS corr FROM w WHERE n = 180""",
)
def proxy_rolling_corr(spark, d):
    return rounded(statistics.rolling_correlation(return_pairs(spark, d), ["pair"]), "corr")


@query(
    "proxy_state",
    f"""WITH {_DAILY_RETURNS}, k AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY date DESC) <= 180 AS recent FROM good),
base AS (SELECT pair, count(*) AS n_past, {_CORR} AS baseline FROM k WHERE NOT recent GROUP BY 1),
w AS (SELECT pair, date, count(*) OVER w AS n, covar_samp(x, y) OVER w / nullif(stddev_samp(x) OVER w * stddev_samp(y) OVER w, 0) AS corr FROM k WHERE NOT recent WINDOW w AS (PARTITION BY pair ORDER BY date ROWS BETWEEN 179 PRECEDING AND CURRENT ROW)),
low AS (SELECT pair, min(corr) AS lowest FROM w WHERE n = 180 GROUP BY 1), cur AS (SELECT pair, {_CORR} AS current FROM k WHERE recent GROUP BY 1)
SELECT base.pair AS pair, round(baseline, 6) AS baseline, round(least(0.30, coalesce(lowest, 0.30)), 6) AS floor, round(current, 6) AS current,
       CASE WHEN baseline IS NULL OR baseline < 0.75 THEN 'unrelated' WHEN current IS NULL THEN 'frozen' WHEN current < least(0.30, coalesce(lowest, 0.30)) THEN 'broken' ELSE 'holds' END AS state
FROM base LEFT JOIN low ON base.pair = low.pair JOIN cur ON base.pair = cur.pair WHERE n_past >= 400""",
)
def proxy_state(spark, d):
    return rounded(verify.proxies(return_pairs(spark, d), ["pair"]), "baseline", "floor", "current")


_PROXIES = f"""WITH daily AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS date, CAST(sum(o_custkey) AS DOUBLE) AS a, CAST(sum(o_custkey * (100 + o_orderkey % 10)) AS DOUBLE) AS b, 1000.0 + (dayofyear(any_value(CAST(o_orderdate AS DATE))) * 53 % 97) AS w FROM orders GROUP BY 1, 2),
late AS (SELECT *, row_number() OVER (PARTITION BY p ORDER BY date DESC) <= 181 AS late FROM daily),
two AS (SELECT p, 'far' AS other, date, a, CASE WHEN p IN ('2-HIGH', '5-LOW') AND late THEN w WHEN p = '3-MEDIUM' AND late THEN 1.0 WHEN p = '4-NOT SPECIFIED' THEN w ELSE b END AS u FROM late UNION ALL SELECT p, 'near', date, a, b FROM late WHERE p = '5-LOW'),
xy AS (SELECT p, other, date, a / nullif(lag(a) OVER o, 0) - 1 AS x, u / nullif(lag(u) OVER o, 0) - 1 AS y FROM two WINDOW o AS (PARTITION BY p, other ORDER BY date)), good AS (SELECT * FROM xy WHERE x IS NOT NULL AND y IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY p, other ORDER BY date DESC) <= 180 AS recent FROM good),
base AS (SELECT p, other, count(*) AS n_past, {_CORR} AS baseline FROM k WHERE NOT recent GROUP BY 1, 2),
roll AS (SELECT p, other, count(*) OVER o AS n, covar_samp(x, y) OVER o / nullif(stddev_samp(x) OVER o * stddev_samp(y) OVER o, 0) AS corr FROM k WHERE NOT recent WINDOW o AS (PARTITION BY p, other ORDER BY date ROWS BETWEEN 179 PRECEDING AND CURRENT ROW)),
low AS (SELECT p, other, min(corr) AS lowest FROM roll WHERE n = 180 GROUP BY 1, 2), cur AS (SELECT p, other, {_CORR} AS current FROM k WHERE recent GROUP BY 1, 2),
states AS (SELECT base.p AS p, base.other AS other, baseline, CASE WHEN baseline IS NULL OR baseline < 0.75 THEN 'unrelated' WHEN current IS NULL THEN 'frozen' WHEN current < least(0.30, coalesce(lowest, 0.30)) THEN 'broken' ELSE 'holds' END AS state
    FROM base LEFT JOIN low ON base.p = low.p AND base.other = low.other JOIN cur ON base.p = cur.p AND base.other = cur.other WHERE n_past >= 400),
own AS (SELECT p, count(*) - 1 AS n_returns, max(date) AS newest FROM daily GROUP BY 1)"""


def proxy_states(spark, d) -> tuple[DataFrame, DataFrame]:
    total = lambda c: F.sum(c).cast("double")
    date = F.col("o_orderdate").cast("date")
    daily = st.read(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("p"), date.alias("date")).agg(total(F.col("o_custkey")).alias("a"), total(F.col("o_custkey") * (100 + F.col("o_orderkey") % 10)).alias("b"))
    daily = daily.withColumns({"w": 1000.0 + (F.dayofyear("date") * 53 % 97), "late": F.row_number().over(Window.partitionBy("p").orderBy(F.desc("date"))) <= 181})
    p, late = F.col("p"), F.col("late")
    far = F.when(p.isin("2-HIGH", "5-LOW") & late, F.col("w")).when((p == "3-MEDIUM") & late, 1.0).when(p == "4-NOT SPECIFIED", F.col("w")).otherwise(F.col("b"))
    two = F.array(F.struct(F.lit("far").alias("other"), far.alias("u")), F.when(p == "5-LOW", F.struct(F.lit("near").alias("other"), F.col("b").alias("u"))))
    long = daily.select("p", "date", "a", F.explode(F.filter(two, lambda x: x.isNotNull())).alias("o")).select("p", "date", "a", "o.*")
    x = statistics.returns(long, ["p", "other"], "a").withColumnRenamed("ret", "x")
    pairs = statistics.returns(x, ["p", "other"], "u").withColumnRenamed("ret", "y").select("p", "other", "date", "x", "y")
    own = daily.groupBy("p").agg((F.count("*") - 1).alias("n_returns"), F.max("date").alias("newest"))
    return verify.proxies(pairs, ["p", "other"]), own


@query("proxy_verdicts", f"{_PROXIES}, said AS (SELECT own.p AS p, count(*) FILTER (WHERE state <> 'unrelated') AS n, count(*) FILTER (WHERE state = 'holds') AS h, arg_max(state, baseline) FILTER (WHERE state <> 'unrelated') AS s, any_value(n_returns) AS n_returns, any_value(newest) AS newest FROM own LEFT JOIN states ON own.p = states.p GROUP BY 1) SELECT p, CASE WHEN n_returns < 400 OR DATE '2001-08-10' - newest > 14 THEN 'proxy_unavailable' WHEN n = 0 THEN 'proxy_unavailable' WHEN h > 0 THEN 'holds' ELSE s END AS verdict FROM said")
def proxy_verdicts(spark, d):
    states, own = proxy_states(spark, d)
    return verify.proxy_verdicts(states, "p", own, day("2001-08-10"))


@query("strongest_proxy", f"{_PROXIES} SELECT p, other, round(baseline, 6) AS baseline FROM states WHERE state <> 'unrelated' QUALIFY row_number() OVER (PARTITION BY p ORDER BY round(baseline, 9) DESC, other) = 1")
def strongest_proxy(spark, d):
    states, _ = proxy_states(spark, d)
    return rounded(verify.strongest_proxy(states.withColumn("baseline", F.round("baseline", 9)), "p", "other"), "baseline")


_LEVELS = """WITH stored AS (SELECT DISTINCT l_returnflag AS source, CAST(l_suppkey AS VARCHAR) || '/' || CAST(l_partkey AS VARCHAR) AS symbol FROM lineitem), related AS (SELECT DISTINCT CAST(ps.l_suppkey AS VARCHAR) || '/' || CAST(ps.l_partkey AS VARCHAR) AS symbol FROM lineitem ps WHERE ps.l_partkey % 3 = 0),
levels AS (SELECT a.source AS source, a.symbol AS symbol, count(b.source) AS n_peers, CASE WHEN count(b.source) > 0 THEN 'corroborated' WHEN any_value(r.symbol) IS NOT NULL THEN 'proxy_only' ELSE 'self_only' END AS level
    FROM stored a LEFT JOIN stored b ON a.symbol = b.symbol AND a.source <> b.source LEFT JOIN related r ON a.symbol = r.symbol GROUP BY a.source, a.symbol)"""


def levels(spark, d) -> DataFrame:
    symbol = F.concat_ws("/", "l_suppkey", "l_partkey").alias("symbol")
    items = st.read(spark, d, "lineitem").select(F.col("l_returnflag").alias("source"), symbol, "l_partkey")
    return verify.verification_level(items, items.where("l_partkey % 3 = 0"))  # parts that have a related instrument


@query("verification_level", f"{_LEVELS} SELECT * FROM levels")
def verification_level(spark, d):
    return levels(spark, d)


@query(
    "weakest_level",
    f"""{_LEVELS} SELECT source, CASE min(CASE level WHEN 'self_only' THEN 0 WHEN 'proxy_only' THEN 1 ELSE 2 END) WHEN 0 THEN 'self_only' WHEN 1 THEN 'proxy_only' ELSE 'corroborated' END AS weakest,
    count(*) FILTER (WHERE level = 'self_only') AS n_self_only, count(*) FILTER (WHERE level = 'proxy_only') AS n_proxy_only, count(*) FILTER (WHERE level = 'corroborated') AS n_corroborated FROM levels GROUP BY 1""",
)
def weakest_level(spark, d):
    return verify.weakest_level(levels(spark, d))


_RHYTHM = f"""WITH {st.SERIES}, d AS (SELECT DISTINCT source, series_id, date FROM series), g AS (SELECT source, series_id, date, CAST(date_diff('day', lag(date) OVER (PARTITION BY source, series_id ORDER BY date), date) AS BIGINT) * 86400 AS gap FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY source, series_id ORDER BY date DESC) AS place FROM g WHERE gap IS NOT NULL), q AS (SELECT source, series_id, quantile_cont(gap, 0.9) AS q90 FROM k WHERE place <= 30 GROUP BY 1, 2),
n AS (SELECT source, series_id, max(date) AS newest, count(*) AS n FROM d GROUP BY 1, 2),
t AS (SELECT n.source AS source, n.series_id AS series_id, newest, CASE WHEN n >= 3 THEN greatest(q90 * 3, 86400) END AS threshold FROM n LEFT JOIN q ON n.source = q.source AND n.series_id = q.series_id)"""


@query("freshness_series", f"{_RHYTHM} SELECT source, series_id, newest, round(CAST(threshold AS DOUBLE), 6) AS threshold FROM t")
def freshness_series(spark, d):
    return rounded(statistics.freshness_threshold(st.series(spark, d), ["source", "series_id"], 86_400), "threshold")


_WINDOWS = f"{_RHYTHM}, best AS (SELECT source, newest, round(CAST(threshold AS DOUBLE) / 3600, 1) AS expected_hours FROM t WHERE threshold IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY newest DESC, series_id) = 1)"


@query("expected_windows", f"{_WINDOWS} SELECT source, newest, expected_hours FROM best")
def expected_windows(spark, d):
    return statistics.expected_windows(st.series(spark, d), ["source"], ["series_id"], 86_400)


@query(
    "source_health",
    f"""WITH {st.BARS}, n AS (SELECT source, symbol, max(date) AS newest FROM bars GROUP BY 1, 2), s AS (SELECT source, symbol, CASE WHEN symbol = '9' THEN 'events' ELSE 'bars' END AS "group", CASE WHEN symbol = '7' THEN NULL ELSE newest END AS newest, CASE WHEN symbol IN ('1', '2', '3') THEN 30.0 * CAST(symbol AS INTEGER) END AS expected_hours FROM n),
h AS (SELECT *, date_diff('hour', newest, TIMESTAMP '2001-11-05 00:00:00') AS hours, coalesce(expected_hours, CASE "group" WHEN 'events' THEN 168 ELSE 24 END * 1.5) AS ok, coalesce(expected_hours * 2, CASE "group" WHEN 'events' THEN 168 ELSE 24 END * 3) AS most FROM s)
SELECT source, symbol, "group", newest, CAST(expected_hours AS DOUBLE) AS expected_hours, CASE WHEN hours IS NULL THEN 'unknown' WHEN hours <= ok THEN 'ok' WHEN hours <= most THEN 'warn' ELSE 'late' END AS health FROM h""",
)
def source_health(spark, d):
    symbol = F.col("symbol")
    rows = st.bars(spark, d).groupBy("source", "symbol").agg(F.max("date").alias("newest"))
    rows = rows.select("source", "symbol", F.when(symbol == "9", "events").otherwise("bars").alias("group"), F.when(symbol != "7", F.col("newest")).alias("newest"), F.when(symbol.isin("1", "2", "3"), symbol.cast("int") * 30.0).alias("expected_hours"))
    return statistics.health(rows, day("2001-11-05"))


# Completeness


@query(
    "calendar_gaps",
    f"""WITH {st.BARS}, span AS (SELECT source, symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY 1, 2), days AS (SELECT source, symbol, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS missing FROM span)
SELECT d.source AS source, d.symbol AS symbol, missing FROM days d LEFT JOIN bars b ON d.source = b.source AND d.symbol = b.symbol AND d.missing = b.date WHERE b.date IS NULL""",
)
def calendar_gaps(spark, d):
    return statistics.calendar_gaps(st.bars(spark, d), BAR_KEYS)


@query(
    "weekday_gaps",
    f"""WITH {st.BARS}, span AS (SELECT source, symbol, min(date) AS lo, max(date) AS hi FROM bars GROUP BY 1, 2), days AS (SELECT source, symbol, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS missing FROM span)
SELECT d.source AS source, d.symbol AS symbol, missing FROM days d LEFT JOIN bars b ON d.source = b.source AND d.symbol = b.symbol AND d.missing = b.date WHERE b.date IS NULL AND isodow(missing) <= 5 AND missing <> DATE '1996-12-25'""",
)
def weekday_gaps(spark, d):
    return statistics.calendar_gaps(st.bars(spark, d), BAR_KEYS, statistics.weekdays(spark, "1995-01-01", "2001-12-31", ["1996-12-25"]))


@query(
    "completeness_vs_peer",
    f"""WITH {st.BARS}, mine AS (SELECT DISTINCT symbol, date FROM bars WHERE source = 'A'), theirs AS (SELECT DISTINCT symbol, date FROM bars WHERE source = 'R')
SELECT t.symbol AS symbol, count(*) AS n_peer, count(*) FILTER (WHERE m.date IS NULL) AS n_missing, round(count(*) FILTER (WHERE m.date IS NULL) / count(*), 6) AS share_missing FROM theirs t LEFT JOIN mine m ON t.symbol = m.symbol AND t.date = m.date GROUP BY 1""",
)
def completeness_vs_peer(spark, d):
    return rounded(statistics.missing_against_peer(st.bars(spark, d), "A", "R", ["symbol"]), "share_missing")


@query(
    "implied_missing",
    f"""{_GAP_CTE}, e AS (SELECT g.source AS source, g.symbol AS symbol, g.date - CAST(gap // 86400 AS INTEGER) AS start, modal_gap, CAST(round_even(gap / modal_gap, 0) AS BIGINT) - 1 AS steps FROM g JOIN m ON g.source = m.source AND g.symbol = m.symbol WHERE gap > 1.5 * modal_gap),
h AS (SELECT source, symbol, CASE WHEN modal_gap <= 86400 THEN (SELECT count(*) FROM (SELECT unnest(generate_series(CAST(1 AS BIGINT), steps)) AS k) WHERE isodow(start + CAST(k * modal_gap // 86400 AS INTEGER)) <= 5) ELSE steps END AS hole FROM e),
n AS (SELECT source, symbol, count(*) AS n_rows FROM bars GROUP BY 1, 2), f AS (SELECT source, symbol, sum(hole) AS n_missing FROM h GROUP BY 1, 2)
SELECT m.source AS source, m.symbol AS symbol, n_rows, modal_gap, CAST(coalesce(n_missing, 0) AS BIGINT) AS n_missing FROM m JOIN n ON m.source = n.source AND m.symbol = n.symbol LEFT JOIN f ON m.source = f.source AND m.symbol = f.symbol WHERE n_rows >= 12""",
)
def implied_missing(spark, d):
    return statistics.implied_missing(st.bars(spark, d), BAR_KEYS)


# Contracts


@query("not_null", f"""{_HOLES} SELECT 'open' AS "column", count(*) AS n FROM holes WHERE open IS NULL UNION ALL SELECT 'volume', count(*) FROM holes WHERE volume IS NULL""")
def not_null(spark, d):
    return contracts.not_null(holes(spark, d), ["open", "close", "volume"])


@query("accepted_values", "SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def accepted_values(spark, d):
    return contracts.accepted_values(st.read(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query(
    "backward_revisions",
    f"""WITH {st.PRINTS}, m AS (SELECT event_id, CASE WHEN CAST(series_id AS BIGINT) % 5 = 0 THEN 10 - revision_seq ELSE revision_seq END AS revision_seq, observed_ts FROM prints),
b AS (SELECT *, lag(observed_ts) OVER (PARTITION BY event_id ORDER BY revision_seq) AS was FROM m) SELECT event_id, revision_seq FROM b WHERE observed_ts < was""",
)
def backward_revisions(spark, d):
    seq = F.when(F.col("series_id").cast("bigint") % 5 == 0, 10 - F.col("revision_seq")).otherwise(F.col("revision_seq"))
    return contracts.backward_revisions(st.prints(spark, d).withColumn("revision_seq", seq))
