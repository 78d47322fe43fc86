"""Marts that a night brings up to date: what changed, and what its windows look back on, is all that is read.

A mart is stored by source and month.  A change of a series from some day on can move that
day's row and all later ones, so the months from then on are rewritten for its source, by
Spark's dynamic partition overwrite; other partitions stay.  Rows before those months are
read as far as windows reach: a halo of rows, found in a span of days, or, for series too
sparse for that, in all their rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.operators import upkeep
from tidelake.plans import gold


@dataclass(frozen=True)
class Windowed:
    """A mart of windows over a series. halo: rows before a row that its values depend on."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    halo: int


BARS = Windowed("fct_bars_daily", gold.bars_daily, ("source", "symbol"), 30)
SERIES = Windowed("fct_series_features", gold.series_features, ("source", "series_id", "metric"), 13)
#: Days in which a halo is looked for first, for each of its rows.
SPAN_DAYS = 4
PARTS = ["source", "month"]


def month(date: str) -> Column:
    """The month of a day, by which marts are stored."""
    return F.date_format(date, "yyyy-MM")


def _same(rows: DataFrame, few: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """rows with few's row of the same keys, nulls being equal."""
    named = few.select(*(F.col(k).alias(f"of_{k}") for k in keys), *(c for c in few.columns if c not in keys))
    return rows.join(named, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys], how).drop(*(f"of_{k}" for k in keys))


def since_of(changed: DataFrame) -> DataFrame:
    """source, from_day: the first day of the first month to rewrite. changed: source, since (a day), a row a changed series."""
    return changed.groupBy("source").agg(F.trunc(F.min("since").cast("date"), "month").alias("from_day"))


def increment(mart: Windowed, rows: DataFrame, changed: DataFrame) -> DataFrame:
    """The mart's rows of all months to rewrite, as a whole rebuild would make them.

    rows: all rows of the group, of which only those of changed sources are read, from
    the halo on.  changed: source, since.
    """
    keys = list(mart.keys)
    rows = _same(rows, since_of(changed), ["source"])
    day = F.col("date").cast("date")
    near = day >= F.date_sub("from_day", SPAN_DAYS * mart.halo)
    held = rows.where(near).groupBy(*keys).agg(F.count_if(day < F.col("from_day")).alias("held"))
    short = _same(rows.where(~near).select(*keys).distinct(), held, keys, "left").where(F.coalesce("held", F.lit(0)) < mart.halo)
    far = _same(rows.where(~near), short.select(*keys).withColumn("sparse", F.lit(1)), keys).drop("sparse")
    before = rows.where(near & (day < F.col("from_day"))).unionByName(far)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("date")))
    before = before.withColumn("place", place).where(F.col("place") <= mart.halo).drop("place")
    whole = rows.where(day >= F.col("from_day")).unionByName(before)
    built = mart.build(whole.drop("from_day"))
    return _same(built, since_of(changed), ["source"]).where(F.col("date").cast("date") >= F.col("from_day")).drop("from_day")


def write_whole(built: DataFrame, path: str, date: str = "date") -> None:
    """Stores a mart by source and month."""
    upkeep.replace_path(built.withColumn("month", month(date)), path, PARTS)


def write_increment(rows: DataFrame, path: str, date: str = "date") -> None:
    """Puts the partitions that rows belong to in place of the stored ones; all others stay."""
    out = rows.withColumn("month", month(date)).repartition(*PARTS)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(path)


def events_increment(events: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of the revisions mart of every month (of reference dates) that a changed event is in, each event read whole.

    changed: source, reference_date of events with new rows.
    """
    months = changed.select("source", month("reference_date").alias("month")).distinct()
    return gold.events_revisions(_same(events.withColumn("month", month("reference_date")), months, PARTS).drop("month"))
