"""Data-quality checks: pure functions from tables to violation rows.

Times and thresholds are arguments.  A violation has group, source, series_id, metric,
check, severity and detail; results of several checks are joined with ``union_all``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.functions.columns import seconds_of, to_double
from tidelake.operators.statistics import freshness_threshold
from tidelake.schemas import VIOLATION

RECONNECTS_PER_DAY = 24
DISK_WARN, DISK_ERROR = (0.80, 3.0), (0.90, 1.5)
FILES_WARN, FILES_ERROR = 50, 200


def violation(rows: DataFrame, group: str, check: str, severity: str | Column, detail: Column, source: Column | None = None, series_id: Column | None = None, metric: Column | None = None) -> DataFrame:
    """Shapes rows as violations; names that a check doesn't have are null."""
    text = lambda c: (F.lit(None) if c is None else c).cast("string")
    level = F.lit(severity) if isinstance(severity, str) else severity
    return rows.select(
        F.lit(group).alias("group"), text(source).alias("source"), text(series_id).alias("series_id"), text(metric).alias("metric"),
        F.lit(check).alias("check"), level.alias("severity"), detail.cast("string").alias("detail"),
    )


def union_all(found: list[DataFrame], spark=None) -> DataFrame:
    """All violations of several checks."""
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], VIOLATION)


def _n(count: Column, what: str) -> Column:
    return F.concat(count.cast("bigint").cast("string"), F.lit(" " + what))


def freshness(rows: DataFrame, group: str, keys: list[str], now: Column, sla_seconds: int | Column) -> DataFrame:
    """Series whose newest row is older than their own rhythm allows."""
    age = seconds_of(now) - seconds_of(F.col("newest"))
    late = freshness_threshold(rows, keys, sla_seconds).where(age > F.col("threshold"))
    detail = F.concat_ws(" ", F.lit("age"), age.cast("string"), F.lit("s over"), F.round("threshold").cast("bigint").cast("string"), F.lit("s"))
    return violation(late, group, "freshness", "warn", detail, F.col("source"), F.col(keys[1]) if len(keys) > 1 else None)


def null_rates(rows: DataFrame, keys: list[str], tolerances: dict[str, float]) -> DataFrame:
    """keys, column, n_rows, n_null, tolerance where a column's share of nulls is above its tolerance."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in tolerances))
    long = counts.unpivot([*keys, "n_rows"], list(tolerances), "column", "n_null")
    limit = F.element_at(F.create_map(*(F.lit(x) for kv in tolerances.items() for x in kv)), F.col("column"))
    return long.withColumn("tolerance", limit).where(F.col("n_null") / F.col("n_rows") > F.col("tolerance"))


def nulls(rows: DataFrame, group: str, keys: list[str], tolerances: dict[str, float]) -> DataFrame:
    bad = null_rates(rows, keys, tolerances)
    detail = F.concat_ws(" ", F.col("column"), F.col("n_null").cast("string"), F.lit("of"), F.col("n_rows").cast("string"), F.lit("null"))
    return violation(bad, group, "nulls", "error", detail, F.col("source"), F.col(keys[1]) if len(keys) > 1 else None)


def bitemporal_order(events: DataFrame, keys: list[str]) -> DataFrame:
    """Prints observed before they were scheduled, counted for each calendar."""
    bad = events.groupBy(*keys).agg(F.count_if(F.col("observed_ts") < F.col("scheduled_ts")).alias("n")).where("n > 0")
    return violation(bad, "events", "bitemporal_order", "error", _n(F.col("n"), "observed before scheduled"), F.col(keys[0]), F.col(keys[-1]))


def initial_print(events: DataFrame, keys: list[str]) -> DataFrame:
    """Events that have no initial print, or several."""
    prints = events.groupBy(*keys, "event_id").agg(F.count_if(F.col("revision_seq") == 0).alias("k"))
    bad = prints.groupBy(*keys).agg(F.count_if(F.col("k") == 0).alias("none"), F.count_if(F.col("k") > 1).alias("many")).where("none + many > 0")
    detail = F.concat(_n(F.col("none"), "without initial print, "), _n(F.col("many"), "with several"))
    return violation(bad, "events", "initial_print", "error", detail, F.col(keys[0]), F.col(keys[-1]))


def revision_shape(events: DataFrame, keys: list[str]) -> DataFrame:
    """keys, event_id of events whose revisions are not 0, 1, 2, ... each once."""
    seq = F.col("revision_seq")
    shape = events.groupBy(*keys, "event_id").agg(F.min(seq).alias("lo"), F.max(seq).alias("hi"), F.count("*").alias("n"), F.countDistinct(seq).alias("d"))
    return shape.where("lo <> 0 OR hi <> n - 1 OR d <> n OR lo IS NULL")


def revision_seq(events: DataFrame, keys: list[str]) -> DataFrame:
    bad = revision_shape(events, keys).groupBy(*keys).agg(F.count("*").alias("n"))
    return violation(bad, "events", "revision_seq", "error", _n(F.col("n"), "events with gaps in their revisions"), F.col(keys[0]), F.col(keys[-1]))


def not_stored(declared: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """keys of declared series of which nothing is stored."""
    return declared.select(*keys).distinct().join(stored.select(*keys).distinct(), keys, "left_anti")


def capture(declared: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Declared streams that a day lacks."""
    absent = not_stored(declared, present, keys)
    return violation(absent, "microstructure", "capture", "error", F.lit("declared stream absent"), F.col("source"), F.col("symbol"), F.col("kind"))


def activity(present: DataFrame, required: tuple[str, ...] = ("trades", "book_ticker")) -> DataFrame:
    """Required kinds that a captured symbol lacks; the pseudo-symbol _all is exempt."""
    pairs = present.where(F.col("symbol") != "_all").select("source", "symbol").distinct()
    wanted = pairs.withColumn("kind", F.explode(F.array(*(F.lit(k) for k in required))))
    absent = wanted.join(present.select("source", "symbol", "kind").distinct(), ["source", "symbol", "kind"], "left_anti")
    return violation(absent, "microstructure", "activity", "warn", F.concat(F.lit("no "), F.col("kind")), F.col("source"), F.col("symbol"), F.col("kind"))


def gap_summary(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_jumps, n_reconnects, n_missing of gap records."""
    return gaps.groupBy(*keys).agg(
        F.count_if(F.col("reason") == "sequence_jump").alias("n_jumps"), F.count_if(F.col("reason") == "reconnect").alias("n_reconnects"),
        F.coalesce(F.sum(F.col("missing_count").try_cast("bigint")), F.lit(0)).alias("n_missing"),
    )


def gaps(records: DataFrame, keys: list[str]) -> DataFrame:
    """Any sequence jump is an error; many reconnects alone are a warning; else silence."""
    rows = gap_summary(records, keys).withColumn("severity", F.when(F.col("n_jumps") > 0, "error").when(F.col("n_reconnects") > RECONNECTS_PER_DAY, "warn")).where("severity IS NOT NULL")
    detail = F.concat_ws(", ", _n(F.col("n_jumps"), "jumps"), _n(F.col("n_missing"), "missing"), _n(F.col("n_reconnects"), "reconnects"))
    return violation(rows, "microstructure", "gaps", F.col("severity"), detail, F.col("source"), F.col("symbol") if "symbol" in keys else None)


def crossed_counts(ticks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_crossed, n_negative: bids above asks and negative sizes among text quotes."""
    bid, ask = to_double(F.col("bid_price")), to_double(F.col("ask_price"))
    negative = (to_double(F.col("bid_qty")) < 0) | (to_double(F.col("ask_qty")) < 0)
    return ticks.groupBy(*keys).agg(F.count_if(bid > ask).alias("n_crossed"), F.count_if(negative).alias("n_negative"))


def crossed_book(ticks: DataFrame) -> DataFrame:
    bad = crossed_counts(ticks, ["source", "symbol"]).where("n_crossed + n_negative > 0")
    return violation(bad, "microstructure", "crossed_book", "error", F.concat(_n(F.col("n_crossed"), "crossed, "), _n(F.col("n_negative"), "negative sizes")), F.col("source"), F.col("symbol"))


def lone_venues(present: DataFrame, ever: DataFrame, venues: tuple[str, str], keys: list[str]) -> DataFrame:
    """keys, source where exactly one of two venues is present though both have been captured."""
    known = F.col("source").isin(*venues)
    both = ever.where(known).agg(F.countDistinct("source").alias("k")).where("k = 2")
    alone = present.where(known).groupBy(*keys).agg(F.countDistinct("source").alias("k"), F.first("source").alias("source")).where("k = 1").select(*keys, "source", F.lit(2).cast("bigint").alias("k"))
    return alone.join(F.broadcast(both), "k").select(*keys, "source")  # one row at most


def venue_pair(present: DataFrame, ever: DataFrame, venues: tuple[str, str]) -> DataFrame:
    bad = lone_venues(present, ever, venues, ["symbol"])
    return violation(bad, "microstructure", "venue_pair", "error", F.concat(F.lit("only "), F.col("source")), F.col("source"), F.col("symbol"))


def disk(spark, total_gb: float, free_gb: float) -> DataFrame:
    """One violation at most, from the host's figures."""
    used = 1 - free_gb / total_gb
    level = "error" if used >= DISK_ERROR[0] or free_gb < DISK_ERROR[1] else "warn" if used >= DISK_WARN[0] or free_gb < DISK_WARN[1] else None
    rows = [("host", None, None, None, "disk", level, f"{used:.0%} used, {free_gb:.1f} GB free")] if level else []
    return spark.createDataFrame(rows, VIOLATION)


def small_files(files: DataFrame, today: Column, worst: int = 10) -> DataFrame:
    """Settled partition folders of many files, the worst first. files: path (of a file), as a listing gives it."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    day = F.regexp_extract("path", "date=([0-9-]+)", 1).try_cast("date")
    counts = files.where(day < today).groupBy(folder.alias("folder")).agg(F.count("*").alias("n")).where(F.col("n") >= FILES_WARN)
    rows = counts.orderBy(F.desc("n"), "folder").limit(worst)
    return violation(rows, "host", "small_files", F.when(F.col("n") >= FILES_ERROR, "error").otherwise("warn"), F.concat_ws(" ", F.col("n").cast("string"), F.lit("files in"), F.col("folder")))
