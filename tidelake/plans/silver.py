"""Typed projections of the bronze groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bars(raw: DataFrame) -> DataFrame:
    """Bars with naive timestamps and double prices."""
    prices = [F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")]
    return raw.select("source", "symbol", "interval", F.col("date").cast("timestamp_ntz").alias("date"), *prices)


def series(flat: DataFrame, by_metric: DataFrame) -> DataFrame:
    """Both depths of series as one; rows of the flat depth have a null metric."""
    rows = flat.unionByName(by_metric, allowMissingColumns=True)
    metric = F.col("metric") if "metric" in rows.columns else F.lit(None)
    return rows.select("source", "series_id", metric.cast("string").alias("metric"), F.col("date").cast("timestamp_ntz").alias("date"), F.col("value").cast("double").alias("value"))


def events(raw: DataFrame, tolerant: bool = False) -> DataFrame:
    """Events with their reference date, the second part of the event id.

    A malformed id raises, or gives a null date if tolerant.
    """
    part = F.split_part("event_id", F.lit(":"), F.lit(2))
    numbers = [F.col(c).cast("double").alias(c) for c in ("actual", "forecast", "previous") if c in raw.columns]
    return raw.select(
        "source", "calendar", "event_id", "series_id", (part.try_cast("date") if tolerant else part.cast("date")).alias("reference_date"),
        F.col("scheduled_ts").cast("timestamp_ntz").alias("scheduled_ts"), F.col("observed_ts").cast("timestamp_ntz").alias("observed_ts"),
        *numbers, F.col("revision_seq").cast("int").alias("revision_seq"),
    )


def as_of(vintages: DataFrame, day, start: str = "realtime_start", end: str = "realtime_end") -> DataFrame:
    """Values as they were known on a day: start <= day < end, an open end counting as later."""
    day = F.lit(day).cast("date")
    return vintages.where((F.col(start) <= day) & (F.col(end).isNull() | (day < F.col(end))))
