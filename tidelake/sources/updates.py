"""Extending one stored series from its source: updates, first loads, migration.

All series at once are ``fleet``'s.  Fetching is given by the caller, as nothing here opens a
connection: ``fetch(source, native, start, end)`` gets a series by the source's own name and
returns a frame as stored rows are (bars: date and prices; series: date and
a column a metric; events: the events' columns) and raises NoNewData where there is none.
A frame is judged as it arrives and stored whatever the judgement.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import upkeep, verify
from tidelake.registry import Registry
from tidelake.schemas import ROW_KEYS, VIOLATION
from tidelake.sources import lake
from tidelake.sources.rest import NoNewData

Fetch = Callable[[str, str, str | None, str | None], DataFrame]


def load(registry: Registry, fetch: Fetch, group: str, source: str, symbol: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """A fetched frame of a registered source's symbol; an unknown source or symbol raises ValueError before any fetch."""
    native = registry.get(group, source).native(symbol)
    return fetch(source, native, start, end)


def _told(spark: SparkSession, violations: DataFrame) -> DataFrame:
    """Violations of one frame, a few rows, freed from the frame they were found in."""
    return spark.createDataFrame(violations.collect(), VIOLATION)


def _none(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], VIOLATION)


def _newest(spark: SparkSession, path: str):
    upkeep.recover(spark, path)
    return spark.read.option("recursiveFileLookup", "true").parquet(path).agg(F.max("date")).first()[0] if lake.exists(spark, path) else None


def save_bars(spark: SparkSession, base: str, source: str, symbol: str, interval: str, rows: DataFrame) -> None:
    """Stores bars of one series, merging them with what is there."""
    upkeep.upsert(spark, rows, lake.group_path(base, "bars", source=source, symbol=symbol, interval=interval), ROW_KEYS["bars"], ["date"])


def save_series(spark: SparkSession, base: str, source: str, series_id: str, wide: DataFrame) -> None:
    """Stores observations of one series: a lone value column flat, several columns as a folder a metric."""
    root = lake.group_path(base, "series", source=source, series_id=series_id)
    metrics = [c for c in wide.columns if c != "date"]
    for m in metrics:
        path = root if metrics == ["value"] else f"{root}/metric={m}"
        upkeep.upsert(spark, wide.select("date", F.col(f"`{m}`").alias("value")), path, ROW_KEYS["series"], ["date"])


def save_events(spark: SparkSession, base: str, source: str, calendar: str, rows: DataFrame) -> int:
    """Stores events of a calendar; how many rows it has then."""
    upkeep.upsert(spark, rows, lake.group_path(base, "events", source=source, calendar=calendar), ROW_KEYS["events"], ["event_id", "revision_seq"])
    return lake.count_events(spark, base, source, calendar)


def update_bars(spark: SparkSession, base: str, registry: Registry, source: str, symbol: str, interval: str, fetch: Fetch, today: str) -> DataFrame:
    """Extends a stored series of bars; the violations of the frame that came.

    It is fetched from the watermark itself, and bars of today, which still form, are not
    stored.  FileNotFoundError without a stored series; no new rows are no failure.
    """
    watermark = _newest(spark, lake.group_path(base, "bars", source=source, symbol=symbol, interval=interval))
    if watermark is None:
        raise FileNotFoundError(f"{source}/{symbol}/{interval} is not stored; backfill it first")
    day, now = f"{watermark:%Y-%m-%d}", F.lit(today).cast("date")
    if day >= today:
        return _none(spark)
    try:
        fresh = load(registry, fetch, "bars", source, symbol, day).where(F.col("date") < now).persist()
    except NoNewData:
        return _none(spark)
    try:
        if fresh.isEmpty():
            return _none(spark)
        told = fresh.withColumns({"source": F.lit(source), "symbol": F.lit(symbol)})
        found = _told(spark, verify.verify_frame(told, "bars", now, start=F.lit(day).cast("date"), interval_name=interval))
        save_bars(spark, base, source, symbol, interval, fresh)
        return found
    finally:
        fresh.unpersist()


def update_series(spark: SparkSession, base: str, registry: Registry, source: str, series_id: str, fetch: Fetch, today: str) -> DataFrame:
    """Extends a stored series, all its metrics, from the day after its watermark; the violations of the frame."""
    watermark = _newest(spark, lake.group_path(base, "series", source=source, series_id=series_id))
    if watermark is None:
        raise FileNotFoundError(f"{source}/{series_id} is not stored; backfill it first")
    after = spark.range(1).select(F.date_format(F.date_add(F.lit(watermark), 1), "yyyy-MM-dd")).first()[0]
    try:
        wide = load(registry, fetch, "series", source, series_id, after).persist()
    except NoNewData:
        return _none(spark)
    try:
        long = upkeep.unpivot_metrics(wide, ["date"]).withColumns({"source": F.lit(source), "series_id": F.lit(series_id)})
        found = _told(spark, verify.verify_frame(long, "series", F.lit(today).cast("date"), start=F.lit(watermark).cast("date")))
        save_series(spark, base, source, series_id, wide)
        return found
    finally:
        wide.unpersist()


def update_events(spark: SparkSession, base: str, registry: Registry, source: str, calendar: str, series_id: str, fetch: Fetch, start: str, today: str) -> DataFrame:
    """Fetches a series' whole release history again, as revisions are rows of old periods; the violations of the frame."""
    rows = load(registry, fetch, "events", source, series_id, start).persist()
    try:
        found = _told(spark, verify.verify_frame(rows.withColumn("source", F.lit(source)), "events", F.lit(today).cast("date")))
        save_events(spark, base, source, calendar, rows)
        return found
    finally:
        rows.unpersist()


def migrate_bars(spark: SparkSession, old: str, base: str, source: str, symbol: str, interval: str = "1d") -> int:
    """Copies bars of an older layout into the lake and reads them back; how many rows. What differs raises."""
    path = lake.group_path(base, "bars", source=source, symbol=symbol, interval=interval)
    rows = spark.read.parquet(old)
    upkeep.replace_path(rows.sortWithinPartitions("date"), path)
    if not upkeep.unchanged(rows, spark.read.parquet(path).select(*rows.columns)):
        raise ValueError(f"{old} and {path} differ")
    return rows.count()
