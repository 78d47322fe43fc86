"""Statistics of paired and single series: peers, trends, proxies, gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.columns import average_rank, correlation, relative_difference, seconds_of

PROXY_WINDOW = 180


def returns(rows: DataFrame, keys: list[str], value: str = "close") -> DataFrame:
    """rows with ret, the relative change from the row before by date."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy("date"))
    return rows.withColumn("ret", F.try_divide(F.col(value), before) - 1)


def paired(rows: DataFrame, left: str, right: str, keys: list[str], value: str = "close") -> DataFrame:
    """keys, date, a, b: two sources' values on the dates that both have."""
    a = rows.where(F.col("source") == left).select(*keys, "date", F.col(value).alias("a"))
    b = rows.where(F.col("source") == right).select(*keys, "date", F.col(value).alias("b"))
    return a.join(b, [*keys, "date"])


def median_difference(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Shared dates and the exact median of |a - b| / |b|."""
    diff = relative_difference(F.col("a"), F.col("b"))
    return pairs.groupBy(*keys).agg(F.count("*").alias("n_shared"), F.median(diff).alias("median_rel_diff"))


def return_correlation(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Correlation of the relative changes of a and b over shared dates."""
    by = Window.partitionBy(*keys).orderBy("date")
    change = lambda c: F.try_divide(F.col(c), F.lag(c).over(by)) - 1
    rets = pairs.select(*keys, change("a").alias("x"), change("b").alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    return rets.groupBy(*keys).agg(F.count("*").alias("n_returns"), correlation(F.col("x"), F.col("y")).alias("ret_corr"))


def ratio_trend(pairs: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """Spearman's correlation of a / b with time; null for a constant ratio or too few dates."""
    rows = pairs.select(*keys, "date", F.try_divide(F.col("a"), F.col("b")).alias("ratio")).where("ratio IS NOT NULL")
    rank = average_rank(Window.partitionBy(*keys).orderBy("ratio"), Window.partitionBy(*keys, "ratio"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("date"))
    ranked = rows.select(*keys, rank.alias("r"), place.cast("double").alias("t"))
    trend = F.when(F.count("*") >= least, correlation(F.col("r"), F.col("t")))
    return ranked.groupBy(*keys).agg(F.count("*").alias("n"), trend.alias("trend"))


def rolling_correlation(pairs: DataFrame, keys: list[str], window: int = PROXY_WINDOW) -> DataFrame:
    """keys, date, corr over the last ``window`` pairs; rows before a window is full are left out."""
    by = Window.partitionBy(*keys).orderBy("date").rowsBetween(-(window - 1), 0)
    rows = pairs.where("x IS NOT NULL AND y IS NOT NULL")
    rows = rows.select(*keys, "date", F.count("*").over(by).alias("n"), correlation(F.col("x"), F.col("y"), by).alias("corr"))
    return rows.where(F.col("n") == window).select(*keys, "date", "corr")


def split_recent(rows: DataFrame, keys: list[str], recent: int = PROXY_WINDOW) -> DataFrame:
    """rows with recent: whether a row is among the latest ``recent`` by date."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("date")))
    return rows.withColumn("recent", place <= recent)


def gap_seconds(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, date, gap: seconds since the row before; a first row is left out."""
    by = Window.partitionBy(*keys).orderBy("date")
    gap = seconds_of(F.col("date")) - seconds_of(F.lag("date").over(by))
    return rows.select(*keys, "date", gap.alias("gap")).where("gap IS NOT NULL")


def modal_gap(rows: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """The most frequent gap, the smallest of equals, for series with enough gaps."""
    counted = gap_seconds(rows, keys).groupBy(*keys, "gap").agg(F.count("*").alias("n"))
    best = counted.groupBy(*keys).agg(F.sum("n").alias("n_gaps"), F.max_by("gap", F.struct("n", -F.col("gap"))).alias("modal_gap"))
    return best.where(F.col("n_gaps") >= least)


def freshness_threshold(rows: DataFrame, keys: list[str], sla_seconds: int | Column, last: int = 30, factor: float = 3.0) -> DataFrame:
    """keys, newest, threshold in seconds: the larger of the SLA and 3 times the 0.9 quantile of the last gaps.

    A date counts once, however many metrics share it.  Null for a series with fewer than
    three dates.  sla_seconds may be a column over the keys.
    """
    rows = rows.select(*keys, "date").distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("date")))
    gaps = gap_seconds(rows, keys).withColumn("place", place).where(F.col("place") <= last)
    level = gaps.groupBy(*keys).agg(F.percentile("gap", F.lit(0.9)).alias("q90"))
    newest = rows.groupBy(*keys).agg(F.max("date").alias("newest"), F.count("*").alias("n"))
    sla = sla_seconds if isinstance(sla_seconds, Column) else F.lit(float(sla_seconds))
    threshold = F.when(F.col("n") >= 3, F.greatest(F.col("q90") * factor, sla.cast("double")))
    return newest.join(level, keys, "left").select(*keys, "newest", threshold.alias("threshold"))


def expected_windows(rows: DataFrame, by: list[str], keys: list[str], sla_seconds: int | Column) -> DataFrame:
    """by, newest, expected_hours: the freshness threshold of each source's most recently updated series.

    by and keys tell a series; null keys are a series of their own.  Of equally new ones the
    first in key order counts.  Sources whose series are all too short are left out.
    """
    each = freshness_threshold(rows, [*by, *keys], sla_seconds).where("threshold IS NOT NULL")
    order = F.struct(-seconds_of(F.col("newest")), *(x for k in keys for x in (F.col(k).isNull().alias(f"no_{k}"), F.col(k))))
    best = each.groupBy(*by).agg(F.min_by(F.struct("newest", "threshold"), order).alias("b"))
    return best.select(*by, F.col("b.newest").alias("newest"), F.round(F.col("b.threshold") / 3600, 1).alias("expected_hours"))


#: Hours between updates by group, where a source's own window is not known. Fixed values.
CADENCE_HOURS = {"bars": 24, "series": 72, "events": 168}


def health(sources: DataFrame, now: Column) -> DataFrame:
    """sources (group, newest, expected_hours) with health: ok, warn, late or unknown.

    Up to the expected hours a source is ok and up to twice these it warns; without them up
    to 1.5 and 3 times its group's cadence, a day for groups that have none.
    """
    hours = (seconds_of(now) - seconds_of(F.col("newest"))) / 3600
    usual = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in CADENCE_HOURS.items() for x in kv)), F.col("group")), F.lit(24))
    own = F.col("expected_hours") > 0
    limit, most = F.when(own, F.col("expected_hours")).otherwise(usual * 1.5), F.when(own, F.col("expected_hours") * 2).otherwise(usual * 3)
    return sources.withColumn("health", F.when(hours.isNull(), "unknown").when(hours <= limit, "ok").when(hours <= most, "warn").otherwise("late"))


def calendar_gaps(rows: DataFrame, keys: list[str], calendar: DataFrame | None = None) -> DataFrame:
    """keys, missing: days between the first and last date that a series lacks.

    calendar: a table of expected days (column day); all days without it.
    """
    days = rows.select(*keys, F.to_date("date").alias("missing")).distinct()
    span = days.groupBy(*keys).agg(F.min("missing").alias("lo"), F.max("missing").alias("hi"))
    wanted = span.select(*keys, F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("missing"))
    if calendar is not None:
        wanted = wanted.join(calendar.select(F.col("day").alias("missing")), "missing", "left_semi")
    return wanted.join(days, [*keys, "missing"], "left_anti").select(*keys, "missing")


def weekdays(spark, start: str, end: str, holidays: list[str] | None = None) -> DataFrame:
    """A table of Monday-to-Friday days without the given holidays."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("day")).where("weekday(day) < 5")
    return days.where(~F.col("day").isin([F.lit(h).cast("date") for h in holidays])) if holidays else days


def implied_missing(rows: DataFrame, keys: list[str], least: int = 12) -> DataFrame:
    """Observations that a series' own modal gap implies but lacks.

    A hole is a gap over 1.5 times the modal one; it lacks gap / modal - 1 observations,
    half rounded to even, at steps of the modal gap.  Steps on weekend days are not missing
    where the modal gap is a day or less.
    """
    day = 86_400
    at = seconds_of(F.col("date"))
    every = Window.partitionBy(*keys)
    gaps = rows.select(*keys, at.alias("at")).withColumn("gap", F.col("at") - F.lag("at").over(every.orderBy("at")))
    gaps = gaps.withColumn("n", F.count("*").over(Window.partitionBy(*keys, "gap")))
    gaps = gaps.withColumn("modal_gap", F.max_by("gap", F.when(F.col("gap").isNotNull(), F.struct("n", -F.col("gap")))).over(every))
    start = F.col("at") - F.col("gap")
    steps = F.bround(F.col("gap") / F.col("modal_gap")).cast("bigint") - 1
    upto = lambda t: F.least(F.greatest(F.floor((t - 1 - start) / F.col("modal_gap")), F.lit(0)), steps)
    days = F.filter(F.sequence(F.floor(start / day), F.floor((start + steps * F.col("modal_gap")) / day)), lambda d: F.pmod(d + 3, F.lit(7)) < 5)
    weekday = F.aggregate(days, F.lit(0).cast("bigint"), lambda s, d: s + upto((d + 1) * day) - upto(d * day))
    lacks = F.when(F.col("modal_gap") <= day, weekday).otherwise(steps)
    hole = (F.col("modal_gap") > 0) & (F.col("gap") > 1.5 * F.col("modal_gap"))
    gaps = gaps.select(*keys, F.col("modal_gap"), F.when(hole, lacks).alias("lacks"))
    out = gaps.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.max("modal_gap").alias("modal_gap"), F.sum("lacks").alias("n_missing"))
    return out.where((F.col("n_rows") >= least) & F.col("modal_gap").isNotNull()).withColumn("n_missing", F.coalesce("n_missing", F.lit(0)).cast("bigint"))


def missing_against_peer(rows: DataFrame, ours: str, peer: str, keys: list[str]) -> DataFrame:
    """Peer days that our source lacks, and their share of the peer's days."""
    mine = rows.where(F.col("source") == ours).select(*keys, "date").distinct()
    theirs = rows.where(F.col("source") == peer).select(*keys, "date").distinct()
    lacks = theirs.join(mine, [*keys, "date"], "left_anti").groupBy(*keys).agg(F.count("*").alias("n_missing"))
    total = theirs.groupBy(*keys).agg(F.count("*").alias("n_peer"))
    n = F.coalesce("n_missing", F.lit(0)).cast("bigint")
    return total.join(lacks, keys, "left").select(*keys, "n_peer", n.alias("n_missing"), (n / F.col("n_peer")).alias("share_missing"))
