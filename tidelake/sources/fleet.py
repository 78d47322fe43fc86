"""Updates and re-fetches of all stored series as one plan.

What to ask for is a table: a row a series with its native name and start.  Tasks fetch,
each series on its own, so a source that fails gives a failure row and stops no other.  What
came is written once, checked by group and merged by group; the number of jobs does not
depend on the number of series.

``fetch(source, native, start, end)`` runs in tasks, opens its own connections, and returns
a pandas frame or a list of dicts (bars: date and prices; series: date and a column a
metric; events: the events' columns).  It raises NoNewData where there is none.

Merged partitions are written beside the lake and put in place by one overwrite of just
these partitions.  A commit that was cut short is applied again by recover().
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.columns import to_double
from tidelake.operators import upkeep, verify
from tidelake.operators.checks import union_all, violation
from tidelake.registry import Registry
from tidelake.schemas import BARS, EVENTS, REQUIRED, SERIES, VIOLATION
from tidelake.sources import lake
from tidelake.sources.rest import NoNewData

TaskFetch = Callable[[str, str, str | None, str | None], object]

ASK = "group string, source string, name string, part string, native string, start string"
_FETCHED = f"{ASK}, status string, error string, detail string, missing string, arrival bigint, date timestamp, metric string, cells map<string,string>"
PRICES = ("open", "high", "low", "close", "volume")
FAILURE = "group string, series string, error string, detail string"


def native_names(spark: SparkSession, registry: Registry) -> DataFrame:
    """group, source, name, native of every registered series."""
    rows = [(s.group, s.name, name, native) for s in registry.sources.values() for name, native in s.symbols.items()]
    return spark.createDataFrame(rows, "group string, source string, name string, native string")


def asked(marks: DataFrame, natives: DataFrame, today: Column, group: str) -> DataFrame:
    """What to ask sources for, as ASK, of stored series of bars or observations.

    marks: source, name, part, watermark.  Bars are asked for from their watermark on, so
    that what was stored while it formed is healed, and not at all if that is today;
    observations from the day after.  A series that the registry does not name has a null
    native name, which fails when it is fetched.
    """
    day = F.to_date("watermark")
    start = day if group == "bars" else F.date_add(day, 1)
    due = marks.where(day < today) if group == "bars" else marks
    own = natives.where(F.col("group") == group).select("source", "name", "native")
    return due.join(own, ["source", "name"], "left").select(F.lit(group).alias("group"), "source", "name", "part", "native", F.date_format(start, "yyyy-MM-dd").alias("start"))


def asks(spark: SparkSession, base: str, registry: Registry, today: str, events_start: str) -> DataFrame:
    """What to ask for everything that is stored; calendars whose source is not registered are left out."""
    natives, now, found = native_names(spark, registry), F.lit(today).cast("date"), []
    if lake.exists(spark, lake.group_path(base, "bars")):
        marks = upkeep.watermarks(lake.read_bars(spark, base), ["source", "symbol", "interval"]).withColumnsRenamed({"symbol": "name", "interval": "part"})
        found.append(asked(marks, natives, now, "bars"))
    if lake.exists(spark, lake.group_path(base, "series")):
        marks = upkeep.watermarks(lake.read_series(spark, base), ["source", "series_id"]).select("source", F.col("series_id").alias("name"), F.lit("").alias("part"), "watermark")
        found.append(asked(marks, natives, now, "series"))
    if lake.exists(spark, lake.group_path(base, "events")):
        held = lake.read_events(spark, base).select("source", F.col("calendar").alias("part")).distinct()
        own = natives.where("group = 'events'")
        found.append(held.join(own, "source").select("group", "source", "name", "part", "native", F.lit(events_start).alias("start")))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], ASK)


def _text(value: object) -> str | None:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return repr(float(value)) if isinstance(value, float) else str(value)


def _cells(frame: pd.DataFrame, columns: list[str]) -> list[dict[str, str | None]]:
    texts = [[_text(v) for v in frame[c].tolist()] for c in columns]
    return [dict(zip(columns, row)) for row in zip(*texts)]


def _rows(group: str, frame: pd.DataFrame) -> pd.DataFrame:
    """arrival, date, metric, cells of a fetched frame; series become long, a lone value column having no metric."""
    n = len(frame)
    date = pd.to_datetime(frame["date"], utc=True).dt.tz_localize(None) if "date" in frame.columns else pd.Series([pd.NaT] * n, dtype="datetime64[ns]")
    other = [c for c in frame.columns if c != "date"]
    if group != "series":
        cells = _cells(frame, other) if other else [{} for _ in range(n)]
        return pd.DataFrame({"arrival": range(n), "date": date.to_numpy(), "metric": [None] * n, "cells": cells})
    long = [pd.DataFrame({"arrival": range(n), "date": date.to_numpy(), "metric": [None if other == ["value"] else m] * n, "cells": [{"value": _text(v)} for v in frame[m].tolist()]}) for m in other]
    return pd.concat(long, ignore_index=True) if long else pd.DataFrame({"arrival": [], "date": [], "metric": [], "cells": []})


def fetched(wanted: DataFrame, fetch: TaskFetch, path: str, parallel: int | None = None) -> DataFrame:
    """Fetches wanted (ASK) in tasks and writes what came to path: a row of status for each series, and its rows.

    status: ok, empty or failed, null in rows.  missing: columns that a frame lacks.
    arrival: a row's place in its frame, which no shuffle changes.
    """
    spark = wanted.sparkSession
    columns = [c.split()[0] for c in _FETCHED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ask in pdf.itertuples(index=False):
                told = dict(zip(columns, ask))
                empty = pd.DataFrame([told | {"status": "ok"}])
                try:
                    if ask.native is None:
                        raise ValueError(f"{ask.source} does not map {ask.name}")
                    frame = fetch(ask.source, ask.native, ask.start, None)
                    frame = frame if isinstance(frame, pd.DataFrame) else pd.DataFrame(frame)
                    if not len(frame):
                        raise NoNewData(ask.native)
                    lacks = [c for c in [*([] if ask.group == "events" else ["date"]), *REQUIRED[ask.group]] if c not in frame.columns]
                    rows = _rows(ask.group, frame).assign(**told, missing=", ".join(lacks) or None)
                    empty["missing"] = ", ".join(lacks) or None
                except NoNewData:
                    empty["status"], rows = "empty", None
                except Exception as error:  # noqa: BLE001  (whatever a source raises is recorded)
                    empty = empty.assign(status="failed", error=type(error).__name__, detail=str(error)[:500])
                    rows = None
                for out in (empty, rows):
                    if out is not None:
                        out = out.reindex(columns=columns)
                        out["arrival"], out["date"] = out["arrival"].astype("Int64"), pd.to_datetime(out["date"])
                        yield out.astype({c: object for c in columns if c not in ("arrival", "date")}).where(lambda x: x.notna(), None)

    tasks = parallel or 4 * spark.sparkContext.defaultParallelism
    spread = wanted.select(*(c.split()[0] for c in ASK.split(", "))).repartition(tasks, "group", "source", "name", "part")
    spread.mapInPandas(run, _FETCHED).write.parquet(path)
    return spark.read.schema(_FETCHED).parquet(path)


def failures_of(got: DataFrame) -> DataFrame:
    """group, series, error, detail of what could not be fetched."""
    label = F.concat_ws("/", "source", "name", F.when((F.col("group") == "bars") & (F.col("part") != ""), F.col("part")))
    return got.where("status = 'failed'").select("group", label.alias("series"), "error", "detail")


def bars_of(got: DataFrame) -> DataFrame:
    """Fetched bars: date, prices as the text that came, source, symbol, interval, arrival, asked (the start asked for)."""
    cell = lambda c: F.try_element_at("cells", F.lit(c)).alias(c)
    rows = got.where("group = 'bars' AND status IS NULL")
    return rows.select("date", *map(cell, PRICES), "source", F.col("name").alias("symbol"), F.col("part").alias("interval"), "arrival", F.col("start").cast("date").alias("asked"), "missing")


def series_of(got: DataFrame) -> DataFrame:
    """Fetched observations: date, value as the text that came, source, series_id, metric, arrival, asked."""
    rows = got.where("group = 'series' AND status IS NULL")
    return rows.select("date", F.try_element_at("cells", F.lit("value")).alias("value"), "source", F.col("name").alias("series_id"), "metric", "arrival", F.col("start").cast("date").alias("asked"), "missing")


def events_of(got: DataFrame) -> DataFrame:
    """Fetched events in their own columns, with arrival."""
    own = [f for f in EVENTS if f.name not in ("source", "calendar")]
    rows = got.where("group = 'events' AND status IS NULL")
    return rows.select(*(F.try_element_at("cells", F.lit(f.name)).try_cast(f.dataType).alias(f.name) for f in own), "source", F.col("part").alias("calendar"), "arrival", "missing")


def judged(spark: SparkSession, got: DataFrame, today: Column) -> DataFrame:
    """Violations of all fetched frames, each held to what was asked for; frames that lack columns are not checked further."""
    lacking = got.where("status = 'ok' AND missing IS NOT NULL")
    found = []
    for group in REQUIRED:
        bad = lacking.where(F.col("group") == group)
        found.append(violation(bad, group, "columns", "error", F.concat(F.lit("missing "), F.col("missing")), F.col("source"), F.col("name")))
    bars = bars_of(got).where(F.col("missing").isNull() & (F.col("date") < today)).drop("missing")
    for name in [r["part"] for r in got.where("group = 'bars'").select("part").distinct().collect()]:  # a few lengths of bars
        own = bars.where(F.col("interval") == name)
        found.append(verify.verify_frame(own, "bars", today, F.col("asked"), interval_name=name, arrival="arrival"))
    series = series_of(got).where("missing IS NULL").drop("missing")
    found.append(verify.verify_frame(series, "series", today, F.col("asked")))
    found.append(verify.verify_events(events_of(got).where("missing IS NULL").drop("missing")))
    return union_all(found, spark).where("NOT (check = 'empty' AND series_id IS NULL)")  # a group of which nothing came


def _staging(base: str) -> str:
    return f"{base.rstrip('/')}/staging"


def _delete(spark: SparkSession, path: str) -> None:
    _, fs, at = upkeep._fs(spark, path)
    fs.delete(at, True)


def _apply(spark: SparkSession, ready: str, root: str, schema: T.StructType, parts: list[str]) -> None:
    rows = spark.read.schema(schema).parquet(ready)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(root)
    _delete(spark, ready)


#: Where each kind of commit goes: its group, its columns and the folders of a series.
_PLACES = {
    "bars": ("bars", BARS, ["source", "symbol", "interval"]),
    "flat": ("series", T.StructType([f for f in SERIES if f.name != "metric"]), ["source", "series_id"]),
    "metrics": ("series", SERIES, ["source", "series_id", "metric"]),
    "events": ("events", EVENTS, ["source", "calendar"]),
}


def commit(rows: DataFrame, base: str, kind: str, order: list[str]) -> None:
    """Puts whole partitions of a group in place of those that are stored.

    rows are written beside the lake first, and count as committed once their folder has
    its final name; from then on recover() finishes what is cut short.
    """
    spark = rows.sparkSession
    group, schema, parts = _PLACES[kind]
    ready = f"{_staging(base)}/commit-{kind}-{uuid.uuid4().hex}"
    whole = lake._conform(rows, schema).repartition(*parts).sortWithinPartitions(*parts, *order)
    whole.write.partitionBy(*parts).parquet(f"{ready}.tmp")
    jvm, fs, at = upkeep._fs(spark, ready)
    upkeep._rename(fs, jvm.org.apache.hadoop.fs.Path(f"{ready}.tmp"), at)
    _apply(spark, ready, lake.group_path(base, group), schema, parts)


def recover(spark: SparkSession, base: str) -> list[str]:
    """Applies commits that were cut short, drops unfinished ones and old fetches; the kinds applied."""
    done = []
    for path in lake.folders_of(spark, f"{_staging(base)}/*"):
        name = path.rsplit("/", 1)[-1]
        kind = name.split("-")[1] if name.startswith("commit-") and not name.endswith(".tmp") else None
        if kind in _PLACES:
            group, schema, parts = _PLACES[kind]
            _apply(spark, path, lake.group_path(base, group), schema, parts)
            done.append(kind)
        else:
            _delete(spark, path)
    return done


def merge(spark: SparkSession, base: str, kind: str, fresh: DataFrame, stored: Callable[[], DataFrame], keys: list[str]) -> None:
    """Merges fresh rows into the series that they belong to, the last to arrive winning; other series are not read whole."""
    group, _, parts = _PLACES[kind]
    if fresh.isEmpty():
        return
    touched = fresh.select(*parts).distinct()
    held = stored().join(touched, parts, "left_semi") if lake.exists(spark, lake.group_path(base, group)) else fresh.limit(0).drop("arrival")
    commit(upkeep.last_write_wins(held, fresh, [*parts, *keys], ["arrival"]), base, kind, keys)


def store(spark: SparkSession, base: str, got: DataFrame, today: Column | None = None) -> None:
    """Stores what was fetched, whatever its checks found; bars of today, which still form, are not stored if today is given."""
    bars = bars_of(got).drop("asked", "missing")
    bars = (bars.where(F.col("date") < today) if today is not None else bars).withColumns({c: to_double(F.col(c)) for c in PRICES})
    merge(spark, base, "bars", bars, lambda: lake.read_bars(spark, base), ["date"])
    series = series_of(got).drop("asked", "missing").withColumn("value", to_double(F.col("value")))
    merge(spark, base, "flat", series.where("metric IS NULL").drop("metric"), lambda: lake.read_series(spark, base).where("metric IS NULL").drop("metric"), ["date"])
    merge(spark, base, "metrics", series.where("metric IS NOT NULL"), lambda: lake.read_series(spark, base).where("metric IS NOT NULL"), ["date"])
    merge(spark, base, "events", events_of(got).drop("missing"), lambda: lake.read_events(spark, base), ["event_id", "revision_seq"])


def changed_by(got: DataFrame) -> dict[str, DataFrame]:
    """What fetched rows have changed, by group: source and since (a day) of series, source and reference_date of events."""
    since = lambda group: got.where((F.col("group") == group) & F.col("status").isNull()).groupBy("source").agg(F.min(F.col("date").cast("date")).alias("since"))
    day = F.split_part("event_id", F.lit(":"), F.lit(2)).try_cast("date")
    return {"bars": since("bars"), "series": since("series"), "events": events_of(got).select("source", day.alias("reference_date")).distinct()}


def update_all(spark: SparkSession, base: str, registry: Registry, fetch: TaskFetch, today: str, events_start: str = "1990-01-01", parallel: int | None = None) -> dict:
    """Updates everything stored: updated, failed, and tables of failures (FAILURE), violations (VIOLATION) and what changed.

    A series without news counts as updated, a calendar's does not.  Tables lie in the
    lake's staging folder until the next update.
    """
    recover(spark, base)
    now = F.lit(today).cast("date")
    at = f"{_staging(base)}/update-{uuid.uuid4().hex}"
    got = fetched(asks(spark, base, registry, today, events_start), fetch, f"{at}/fetched", parallel)
    violations = judged(spark, got, now)
    violations.write.parquet(f"{at}/violations")
    store(spark, base, got, now)
    counts = got.where("status IS NOT NULL").agg(F.count_if(F.expr("status = 'ok' OR (status = 'empty' AND group <> 'events')")).alias("ok"), F.count_if(F.col("status") == "failed").alias("failed")).first()
    return {"updated": counts["ok"], "failed": counts["failed"], "failures": failures_of(got), "violations": spark.read.schema(VIOLATION).parquet(f"{at}/violations"), "changed": changed_by(got)}


def backfill(spark: SparkSession, base: str, registry: Registry, fetch: TaskFetch, group: str, source: str, names: Iterable[str] | None = None, start: str | None = None, calendar: str = "default", today: str | None = None, parallel: int | None = None) -> dict:
    """Loads whole histories of a source's names, all registered ones by default: saved, failures (FAILURE)."""
    spec = registry.get(group, source)
    part = {"bars": spec.interval or "1d", "series": "", "events": calendar}[group]
    rows = [(group, source, n, part, spec.symbols.get(n), start) for n in (sorted(spec.symbols) if names is None else names)]
    recover(spark, base)
    got = fetched(spark.createDataFrame(rows, ASK), fetch, f"{_staging(base)}/backfill-{uuid.uuid4().hex}", parallel)
    store(spark, base, got, F.lit(today).cast("date") if today else None)
    return {"saved": got.where("status = 'ok'").count(), "failures": failures_of(got)}
