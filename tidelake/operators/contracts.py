"""Contracts of marts, and the staged trial that a new source's frames go through."""

from __future__ import annotations

import random
from collections.abc import Callable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelake.operators.statistics import calendar_gaps, implied_missing, missing_against_peer
from tidelake.operators.upkeep import unchanged
from tidelake.operators.verify import cross_source, outside, peer_statistics, structure, verify_bars

#: Most of a peer's days, of a calendar's days, of an own rhythm's steps that may be missing.
PEER_MISSING, CALENDAR_MISSING, SERIES_MISSING = 0.01, 0.12, 0.10


def not_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    """column, n of columns that hold nulls."""
    counts = rows.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns)).withColumn("k", F.lit(0))
    return counts.unpivot("k", columns, "column", "n").where("n > 0").select("column", "n")


def accepted_values(rows: DataFrame, column: str, values: list[str]) -> DataFrame:
    """value, n of values that are not accepted; null is not judged."""
    bad = rows.where(F.col(column).isNotNull() & ~F.col(column).isin(values))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def negative(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose value is below 0."""
    return rows.where(F.col(column) < 0)


def backward_revisions(events: DataFrame) -> DataFrame:
    """event_id, revision_seq of revisions observed before the one they revise."""
    before = F.lag("observed_ts").over(Window.partitionBy("event_id").orderBy("revision_seq"))
    return events.withColumn("before", before).where(F.col("observed_ts") < F.col("before")).select("event_id", "revision_seq")


def cuts(start: str, end: str, pieces: int = 4, seed: int = 0) -> list[tuple[str, str]]:
    """The days from start to end in consecutive ranges that begin at seeded days."""
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    inner = sorted(random.Random(f"{seed}:{start}:{end}").sample(range(1, (last - first).days + 1), min(pieces - 1, (last - first).days)))
    begins = [first, *(first + timedelta(n) for n in inner)]
    return [(a.isoformat(), (b - timedelta(1)).isoformat()) for a, b in zip(begins, [*begins[1:], last + timedelta(1)])]


def pagination(whole: DataFrame, pull: Callable[[str, str], DataFrame], start: str, end: str, pieces: int = 4, seed: int = 0) -> DataFrame:
    """date, side, n, boundary: rows in which a range fetched in pieces differs from it fetched whole.

    whole: the frame of start .. end.  pull(start, end) fetches a piece.  side is missing
    (the whole alone has the row, n times more often) or extra; boundary is the first day
    of the piece at whose edge the row lies, the nearer of two.  A source that pages
    correctly gives no rows.
    """
    spans = cuts(start, end, pieces, seed)
    union = reduce(DataFrame.unionByName, [pull(a, b).select(*whole.columns) for a, b in spans])
    side = lambda rows, n: rows.withColumn("n", F.lit(n))
    counts = side(whole, 1).unionByName(side(union, -1)).groupBy(*whole.columns).agg(F.sum("n").alias("n")).where("n <> 0")
    edges = F.array(*(F.lit(a).cast("date") for a, _ in spans[1:] or spans))
    day = F.to_date("date")
    near = F.array_min(F.transform(edges, lambda e: F.struct(F.abs(F.datediff(day, e)).alias("d"), e.alias("e"))))["e"]
    return counts.select("date", F.when(F.col("n") > 0, "missing").otherwise("extra").alias("side"), F.abs("n").alias("n"), near.alias("boundary"))


def trial(spark: SparkSession, first: DataFrame, again: DataFrame, start: Column, end: Column, now: Column, stored: DataFrame | None = None, peer: str | None = None, calendar: DataFrame | None = None, pull: Callable[[str, str], DataFrame] | None = None) -> DataFrame:
    """stage, outcome (passed, failed, skipped), detail of two pulls of one source's bars.

    A stage that cannot be run is skipped, which is not a pass.  calendar: expected days
    (column day), for sources without a peer; holidays make it the looser one.  pull(start,
    end) fetches a part of the range, for the pagination stage.  Only counts, and a faulty
    piece's first day, reach the driver.
    """
    keys = ["source", "symbol"]
    rows: list[tuple[str, str, str]] = []

    def stage(name: str, bad: int | None, what: str) -> bool:
        rows.append((name, "skipped" if bad is None else "failed" if bad else "passed", "" if bad is None else f"{bad} {what}"))
        return not bad

    contract = structure(first, "bars").count()
    if stage("contract", contract, "structural faults"):
        stage("frame", verify_bars(first, keys, now).where("severity = 'error'").count(), "violations")
        stage("determinism", int(not unchanged(first, again)), "differing pulls")
        stage("range", outside(first, keys, now, start, end).count(), "series out of range")
        if pull is None:
            stage("pagination", None, "")
        else:
            ends = first.select(start.cast("string"), end.cast("string")).first()
            wrong = pagination(first, pull, *ends).groupBy("boundary").agg(F.sum("n").alias("n")).orderBy("boundary").collect()  # at most one row a piece
            stage("pagination", sum(r["n"] for r in wrong), "rows differ around " + ", ".join(str(r["boundary"]) for r in wrong))
        thin = implied_missing(first, keys).where(F.col("n_missing") > SERIES_MISSING * (F.col("n_rows") + F.col("n_missing")))
        stage("completeness", thin.count(), "series with holes")
        if calendar is not None:
            lacks = calendar_gaps(first, keys, calendar).groupBy(*keys).agg(F.count("*").alias("n_missing"))
            days = first.groupBy(*keys).agg(F.countDistinct(F.to_date("date")).alias("n"))
            thin = days.join(lacks, keys).where(F.col("n_missing") > CALENDAR_MISSING * (F.col("n") + F.col("n_missing")))
            stage("calendar_completeness", thin.count(), "series that lack the calendar's days")
        if stored is not None and peer is not None:
            both = stored.unionByName(first)
            ours = first.first()["source"]
            stage("peer_completeness", missing_against_peer(both, ours, peer, ["symbol"]).where(F.col("share_missing") > PEER_MISSING).count(), "symbols that lack a peer's days")
            stage("cross_source", cross_source(peer_statistics(both, ours, [peer], ["symbol"]), ["symbol"]).where("severity = 'error'").count(), "symbols apart from the peer")
        else:
            stage("peer_completeness", None, "")
            stage("cross_source", None, "")
    return spark.createDataFrame(rows, "stage string, outcome string, detail string")
