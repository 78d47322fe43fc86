"""Jobs over a whole lake: marts, checks, the nightly round, the weekly verification."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.operators import checks, statistics, upkeep, verify
from tidelake.operators.align import mids
from tidelake.plans import gold, marts, silver
from tidelake.registry import NO_NULLS, Registry
from tidelake.schemas import DQ_DRIFT, DQ_FAILURES, DQ_RUNS, DQ_VIOLATIONS, VIOLATION
from tidelake.sources import files, fleet, lake

BAR_KEYS, SERIES_KEYS, EVENT_KEYS = ["source", "symbol", "interval"], ["source", "series_id"], ["source", "calendar"]
SLA_SECONDS = 3 * 86_400
RUN_KEYS = ["run_date", "cadence"]


def build_marts(spark: SparkSession, base: str, registry: Registry | None = None, venues: tuple[str, str] = ("binance", "coinbase"), changed: dict[str, DataFrame] | None = None) -> list[str]:
    """Brings every mart whose groups are there up to date; their names.

    changed: by group, what an update has changed (bars, series: source, since; events:
    source, reference_date).  Stored marts of these groups are rewritten where that matters;
    without it, and where a mart is not stored by source and month yet, it is built whole.
    """
    built: dict[str, DataFrame] = {}
    done: list[str] = []

    def mart(name: str, group: str, whole: Callable[[], DataFrame], part: Callable[[DataFrame], DataFrame], date: str = "date") -> None:
        path = lake.gold_path(base, name)
        if changed is not None and lake.exists(spark, f"{path}/source=*/month=*"):
            if group in changed:
                marts.write_increment(part(changed[group]), path, date)
        else:
            marts.write_whole(whole(), path, date)
        done.append(name)

    if lake.exists(spark, lake.group_path(base, "bars")):
        bars = silver.bars(lake.read_bars(spark, base)).where("interval = '1d'")
        mart("fct_bars_daily", "bars", lambda: gold.bars_daily(bars), lambda c: marts.increment(marts.BARS, bars, c))
    if lake.exists(spark, lake.group_path(base, "series")):
        rows = lake.read_series(spark, base)
        series = silver.series(rows, rows.limit(0))
        mart("fct_series_features", "series", lambda: gold.series_features(series), lambda c: marts.increment(marts.SERIES, series, c))
    if lake.exists(spark, lake.group_path(base, "events")):
        events = silver.events(lake.read_events(spark, base))
        mart("fct_events_revisions", "events", lambda: gold.events_revisions(events), lambda c: marts.events_increment(events, c), "reference_date")
    if {*venues} <= {*lake.sources_of(spark, base, "book_ticker")}:
        ticks = lake.read_kind(spark, base, "book_ticker")
        built["fct_cross_venue_basis"] = gold.cross_venue_basis(mids(ticks), *venues)
    if registry:
        built["dim_sources"] = gold.dim_sources(registry.frame(spark))
    for name, rows in built.items():
        upkeep.replace_path(rows, lake.gold_path(base, name))
    return [*done, *built]


def sla_of(registry: Registry | None) -> Column:
    """Seconds that each source's newest row may be old, by its name; SLA_SECONDS where it is not registered."""
    known = {s.name: s.sla_seconds for s in registry.sources.values()} if registry else {}
    table = F.create_map(*(F.lit(x) for kv in known.items() for x in kv)) if known else None
    return F.lit(SLA_SECONDS) if table is None else F.coalesce(F.try_element_at(table, F.col("source")), F.lit(SLA_SECONDS))


def _nulls(rows: DataFrame, group: str, keys: list[str], columns: dict[str, float], registry: Registry | None) -> list[DataFrame]:
    """Null checks of all sources, each by its own tolerances: one pass for each different contract."""
    own: dict[tuple, list[str]] = {}
    for s in registry.sources.values() if registry else []:
        if s.group == group and s.null_tolerance:
            own.setdefault(tuple(sorted(s.null_tolerance.items())), []).append(s.name)
    named = [n for names in own.values() for n in names]
    found = [checks.nulls(rows.where(F.col("source").isin(names)), group, keys, dict(limits)) for limits, names in own.items()]
    rest = rows.where(~F.coalesce(F.col("source").isin(named), F.lit(False))) if named else rows
    return [*found, checks.nulls(rest, group, keys, columns)] if columns else found


def drift(spark: SparkSession, base: str, registry: Registry) -> DataFrame:
    """group, source, symbol of declared series that the lake does not hold."""
    held = []
    for group, read, name in (("bars", lake.read_bars, "symbol"), ("series", lake.read_series, "series_id"), ("events", lake.read_events, "series_id")):
        if lake.exists(spark, lake.group_path(base, group)):
            held.append(read(spark, base).select(F.lit(group).alias("group"), "source", F.col(name).alias("symbol")).distinct())
    declared = registry.declared(spark)
    for rows in held:
        declared = declared.join(rows, ["group", "source", "symbol"], "left_anti")
    return declared


def tape_checks(spark: SparkSession, base: str, day: str, declared: DataFrame | None = None, venues: tuple[str, str] = ("binance", "coinbase")) -> list[DataFrame]:
    """Checks of one settled day of the tape: absent streams, silent kinds, gaps, crossed books, lone venues.

    Which streams there were is read from folder names.  declared: source, symbol, kind.
    """
    present = lake.tape_partitions(spark, base)
    if present.isEmpty():
        return []
    today = present.where(F.col("date") == day)
    found = [checks.activity(today), checks.venue_pair(today.where("kind = 'book_ticker'"), present, venues)]
    if declared is not None:
        found.append(checks.capture(declared, today, ["source", "symbol", "kind"]))
    if lake.sources_of(spark, base, "gaps"):
        found.append(checks.gaps(lake.read_kind(spark, base, "gaps").where(F.col("date") == day), ["source", "symbol"]))
    if lake.sources_of(spark, base, "book_ticker"):
        found.append(checks.crossed_book(lake.read_kind(spark, base, "book_ticker").where(F.col("date") == day)))
    return found


def run_checks(
    spark: SparkSession, base: str, now: Column, registry: Registry | None = None, day: str | None = None, declared: DataFrame | None = None, disk_gb: tuple[float, float] | None = None
) -> DataFrame:
    """Violations of all stored groups, by each source's own age limit and null tolerance.

    day: the settled day of the tape to check, yesterday by default.  declared: the streams
    that should be captured.  disk_gb: the host's total and free space.
    """
    found = []
    sla = sla_of(registry)
    if lake.exists(spark, lake.group_path(base, "bars")):
        bars = lake.read_bars(spark, base)
        found += [checks.freshness(bars, "bars", BAR_KEYS, now, sla), *_nulls(bars, "bars", BAR_KEYS, NO_NULLS, registry), verify.ohlc(bars, BAR_KEYS[:2]), verify.volume(bars, BAR_KEYS[:2]), verify.index(bars, "bars", ["source", "interval", "symbol"])]
    if lake.exists(spark, lake.group_path(base, "series")):
        series = lake.read_series(spark, base)
        found += [checks.freshness(series, "series", SERIES_KEYS, now, sla), *_nulls(series, "series", [*SERIES_KEYS, "metric"], {}, registry)]
    if lake.exists(spark, lake.group_path(base, "events")):
        events = lake.read_events(spark, base)
        found += [checks.bitemporal_order(events, EVENT_KEYS), checks.initial_print(events, EVENT_KEYS), checks.revision_seq(events, EVENT_KEYS)]
    if lake.exists(spark, lake.group_path(base, "microstructure")):
        day = day or spark.range(1).select(F.date_format(F.date_sub(F.to_date(now), 1), "yyyy-MM-dd")).first()[0]
        found += tape_checks(spark, base, day, declared)
        days = lake.folders_of(spark, lake.group_path(base, "microstructure", source=None, kind=None, symbol=None, date=None))
        listed = files.listing(spark, days).where("name LIKE '%.parquet'").select(F.concat_ws("/", "folder", "name").alias("path"))
        found.append(checks.small_files(listed, F.to_date(now)))
    if disk_gb:
        found.append(checks.disk(spark, *disk_gb))
    return checks.union_all(found, spark)


def record(spark: SparkSession, base: str, violations: DataFrame, now: str, cadence: str, updated: int = 0, failures: DataFrame | None = None, lacking: DataFrame | None = None) -> DataFrame:
    """Puts a run's violations, failures, drift and counts into the quality history; the violations as recorded.

    failures: group, series, error, detail of what could not be fetched.  lacking: group,
    source, symbol of registered series that are not stored.  A run that is made again
    replaces itself, whatever it finds.
    """
    at = F.lit(now).cast("timestamp")
    run = {"run_date": spark.range(1).select(F.date_format(at, "yyyy-MM-dd")).first()[0], "cadence": cadence}
    told = {"run_ts": at, **{k: F.lit(v) for k, v in run.items()}}
    quality = f"{base.rstrip('/')}/quality"
    for name, schema, rows in (("dq_violations", DQ_VIOLATIONS, violations), ("dq_failures", DQ_FAILURES, failures), ("dq_drift", DQ_DRIFT, lacking)):
        if rows is not None:
            upkeep.record_run(spark, rows.withColumns(told).select(*schema.fieldNames()), f"{quality}/{name}", RUN_KEYS, run)
    own = (F.col("run_date") == run["run_date"]) & (F.col("cadence") == cadence)
    tonight = spark.read.schema(DQ_VIOLATIONS).parquet(f"{quality}/dq_violations").where(own)
    failed = spark.read.schema(DQ_FAILURES).parquet(f"{quality}/dq_failures").where(own).count() if failures is not None else 0
    sums = upkeep.dq_runs(tonight, RUN_KEYS)
    row = spark.range(1).select(*(v.alias(k) for k, v in told.items())).join(sums, RUN_KEYS, "left").fillna(0, ["n_violations", "n_error", "n_warn"]).fillna("", ["groups"])
    row = row.withColumns({"n_updated": F.lit(updated).cast("bigint"), "n_failed": F.lit(failed).cast("bigint")})
    upkeep.record_run(spark, row.select(*DQ_RUNS.fieldNames()), f"{quality}/dq_runs", RUN_KEYS, run)
    return tonight


def nightly(
    spark: SparkSession, base: str, now: str, registry: Registry | None = None, cadence: str = "daily", update: Callable[[], dict] | None = None, declared: DataFrame | None = None, disk_gb: tuple[float, float] | None = None
) -> dict:
    """Updates what is stored, builds the marts, runs the checks and records them: updated, failed, failures, violations, drift.

    update: extends the stored series, as ``fleet.update_all`` with a registry and a fetch
    function does; what its frames violated on arrival comes before what the checks find.
    failures, violations and drift are as recorded.  A night that is run again replaces its
    record.
    """
    came = update() if update else None
    build_marts(spark, base, registry, changed=came.get("changed") if came else None)
    if lake.exists(spark, lake.group_path(base, "bars")):
        today = F.lit(now).cast("date")
        upkeep.write_csv(upkeep.quality_summary(lake.read_bars(spark, base), BAR_KEYS, today), f"{base.rstrip('/')}/quality/quality_summary.csv")
    found = run_checks(spark, base, F.lit(now).cast("timestamp"), registry, declared=declared, disk_gb=disk_gb)
    lacking = drift(spark, base, registry) if registry else None
    arrived = [came["violations"]] if came else []
    violations = record(spark, base, checks.union_all([*arrived, found]), now, cadence, came["updated"] if came else 0, came["failures"] if came else None, lacking)
    fleet.recover(spark, base)  # the fetched frames have done their work
    of = lambda name, schema: spark.read.schema(schema).parquet(f"{base.rstrip('/')}/quality/{name}").where((F.col("run_date") == F.date_format(F.lit(now).cast("timestamp"), "yyyy-MM-dd")) & (F.col("cadence") == cadence))
    return {
        "updated": came["updated"] if came else 0, "failed": came["failed"] if came else 0, "violations": violations,
        "failures": of("dq_failures", DQ_FAILURES) if came else spark.createDataFrame([], DQ_FAILURES), "drift": of("dq_drift", DQ_DRIFT) if registry else spark.createDataFrame([], DQ_DRIFT),
    }


def weekly(stored: DataFrame, again: DataFrame, today: Column, most_rows: int | None = None) -> DataFrame:
    """Violations of stored bars against a fresh fetch of them, settled days only."""
    rows = verify.self_consistency(verify.settled(stored, today), verify.settled(again, today), ["source", "symbol"], most_rows)
    return verify.consistency_violations(rows, "bars", F.col("source"), F.col("symbol"))


def weekly_series(stored: DataFrame, again: DataFrame, today: Column, arrival: str | None = None) -> DataFrame:
    """Violations of stored observations against a fresh fetch of them, settled days only."""
    rows = verify.series_consistency(verify.settled(stored, today), verify.settled(again, today), SERIES_KEYS, arrival)
    return verify.series_consistency_violations(rows, F.col("source"), F.col("series_id"))


def weekly_proxies(bars: DataFrame, pairs: DataFrame, today: Column) -> DataFrame:
    """Proxy violations of stored daily bars. pairs: symbol, other, the instruments to hold each series to.

    A series is a source and symbol; it is held to each source's series of the other symbols.
    """
    series = F.concat_ws("/", "source", "symbol")
    rets = statistics.returns(bars.where("close IS NOT NULL").select(series.alias("series"), "symbol", "date", "close"), ["series", "symbol"]).where("ret IS NOT NULL")
    mine = rets.join(pairs.select("symbol", "other").distinct(), "symbol").select("series", "other", "date", F.col("ret").alias("x"))
    theirs = rets.select(F.col("symbol").alias("other"), F.col("series").alias("proxy"), "date", F.col("ret").alias("y"))
    states = verify.proxies(mine.join(theirs, ["other", "date"]).select("series", "proxy", "date", "x", "y"), ["series", "proxy"])
    own = rets.groupBy("series").agg(F.count("*").alias("n_returns"), F.max("date").alias("newest"))
    verdicts = verify.proxy_verdicts(states, "series", own, today)
    return verify.proxy_violations(verdicts.withColumn("symbol", F.substring_index("series", "/", -1)), "symbol", F.substring_index("series", "/", 1))


def weekly_run(
    spark: SparkSession, base: str, now: str, refetch: fleet.TaskFetch, registry: Registry, series: bool = True, pairs: DataFrame | None = None, parallel: int | None = None
) -> dict:
    """Verifies everything stored against its own sources and records it: checked, failed, failures, violations.

    refetch(source, native, start, end) runs in tasks and returns a series' whole history,
    as ``fleet`` says.  All series are fetched, compared and judged in one plan.  A series
    whose re-fetch fails, brings nothing or is not registered is a failure: it is neither
    checked nor passed.  Proxy relations that are not available are recorded too.
    """
    today = F.lit(now).cast("date")
    fleet.recover(spark, base)
    asks, found = [], []
    natives = fleet.native_names(spark, registry)
    start = F.lit(None).cast("string")
    daily = lake.read_bars(spark, base).where("interval = '1d'") if lake.exists(spark, lake.group_path(base, "bars")) else None
    held = lake.read_series(spark, base) if series and lake.exists(spark, lake.group_path(base, "series")) else None
    for group, rows, name in (("bars", daily, "symbol"), ("series", held, "series_id")):
        if rows is not None:
            own = rows.select("source", F.col(name).alias("name")).distinct()
            own = own.join(natives.where(F.col("group") == group).select("source", "name", "native"), ["source", "name"], "left")
            asks.append(own.select(F.lit(group).alias("group"), "source", "name", F.lit("1d" if group == "bars" else "").alias("part"), "native", start.alias("start")))
    violations, failures, checked = spark.createDataFrame([], VIOLATION), spark.createDataFrame([], fleet.FAILURE), 0
    if asks:
        got = fleet.fetched(reduce(DataFrame.unionByName, asks), refetch, f"{base.rstrip('/')}/staging/weekly-{uuid.uuid4().hex}", parallel)
        ok = got.where("status = 'ok'").select("group", "source", "name")
        if daily is not None:
            again = fleet.bars_of(got).withColumns({c: F.col(c).cast("double") for c in fleet.PRICES})
            caps = {s.name: s.max_rows_per_call for s in registry.sources.values() if s.group == "bars"}
            stored = daily.join(ok.where("group = 'bars'").select("source", F.col("name").alias("symbol")), ["source", "symbol"], "left_semi")
            for cap in sorted(set(caps.values()), key=str):  # as many plans as sources have different limits
                of = lambda rows, names=[n for n, c in caps.items() if c == cap]: rows.where(F.col("source").isin(names))
                rows = verify.self_consistency(verify.settled(of(stored), today), verify.settled(of(again), today), ["source", "symbol"], cap, "arrival")
                found.append(verify.consistency_violations(rows, "bars", F.col("source"), F.col("symbol")))
        if held is not None:
            again = fleet.series_of(got).withColumn("value", F.col("value").cast("double"))
            stored = held.join(ok.where("group = 'series'").select("source", F.col("name").alias("series_id")), SERIES_KEYS, "left_semi")
            found.append(weekly_series(stored, again, today, "arrival"))
        nothing = got.where("status = 'empty'").select("group", F.concat_ws("/", "source", "name").alias("series"), F.lit("NoNewData").alias("error"), F.lit("no rows").alias("detail"))
        failures = fleet.failures_of(got).unionByName(nothing)
        checked = ok.count()
    if pairs is not None and daily is not None:
        found.append(weekly_proxies(daily, pairs, today))
    violations = record(spark, base, checks.union_all([violations, *found], spark), now, "weekly", checked, failures)
    kept = spark.read.schema(DQ_FAILURES).parquet(f"{base.rstrip('/')}/quality/dq_failures").where((F.col("cadence") == "weekly") & (F.col("run_date") == F.date_format(F.lit(now).cast("timestamp"), "yyyy-MM-dd")))
    fleet.recover(spark, base)
    return {"checked": checked, "failed": kept.count(), "failures": kept, "violations": violations}


def expected_windows(spark: SparkSession, base: str, registry: Registry | None = None) -> DataFrame:
    """group, source, newest, expected_hours of every source that is stored."""
    found = []
    for group, read, keys in (("bars", lake.read_bars, ["symbol", "interval"]), ("series", lake.read_series, ["series_id", "metric"])):
        if lake.exists(spark, lake.group_path(base, group)):
            rows = statistics.expected_windows(read(spark, base), ["source"], keys, sla_of(registry))
            found.append(rows.select(F.lit(group).alias("group"), "*"))
    if lake.exists(spark, lake.group_path(base, "events")):
        events = lake.read_events(spark, base).withColumn("date", F.col("observed_ts"))
        found.append(statistics.expected_windows(events, ["source"], ["calendar", "series_id"], sla_of(registry)).select(F.lit("events").alias("group"), "*"))
    return checks.union_all(found) if found else spark.createDataFrame([], "group string, source string, newest timestamp, expected_hours double")


def write_catalogue(spark: SparkSession, base: str, registry: Registry, now: str, path: str) -> dict:
    """Writes the catalogue of registered sources as JSON: description, rows, newest date, window, health; returns it.

    A row a source reaches the driver; the registry is a small table.
    """
    counts = []
    for group, read, date in (("bars", lake.read_bars, "date"), ("series", lake.read_series, "date"), ("events", lake.read_events, "observed_ts")):
        if lake.exists(spark, lake.group_path(base, group)):
            rows = read(spark, base).withColumn("date", F.col(date).cast("timestamp"))
            counts.append(upkeep.catalogue_counts(rows).select(F.lit(group).alias("group"), "source", "n_rows", F.col("newest")))
    stored = checks.union_all(counts) if counts else spark.createDataFrame([], "group string, source string, n_rows bigint, newest timestamp")
    windows = expected_windows(spark, base, registry).select("group", "source", "expected_hours")
    dim = registry.frame(spark).withColumnRenamed("name", "source")
    rows = dim.join(stored, ["group", "source"], "left").join(windows, ["group", "source"], "left")
    graded = statistics.health(rows, F.lit(now).cast("timestamp")).orderBy("group", "source").collect()
    made = {"generated_at": now, "sources": [r.asDict() for r in graded]}
    upkeep.write_json(spark, made, path)
    return made


#: The group whose allowlist a mart's rows follow.
MART_GROUPS = {"fct_bars_daily": "bars", "fct_series_features": "series", "fct_events_revisions": "events"}


def publish_lake(spark: SparkSession, base: str, out: str, registry: Registry) -> dict[str, int]:
    """Writes a public copy of the lake: groups and marts of allowed sources, the dimension, the quality history; files of each.

    Rows leave only if their source is on the allowlist of their own group.  Failures and
    drift, which name what sources call their series, stay.
    """
    allowed, done = registry.allowed(spark), {}
    for group, read in (("bars", lake.read_bars), ("series", lake.read_series), ("events", lake.read_events)):
        if lake.exists(spark, lake.group_path(base, group)):
            done[group] = upkeep.publish(read(spark, base), allowed, group, lake.group_path(out, group))
    for mart, group in MART_GROUPS.items():
        if lake.exists(spark, lake.gold_path(base, mart)):
            done[mart] = upkeep.publish(lake.read_mart(spark, base, mart), allowed, group, lake.gold_path(out, mart))
    whole = {"dim_sources": lake.gold_path(base, "dim_sources"), **{t: f"{base.rstrip('/')}/quality/{t}" for t in ("dq_runs", "dq_violations")}}
    for name, path in whole.items():
        if lake.exists(spark, path):
            rows = spark.read.option("mergeSchema", "true").parquet(path)
            upkeep.replace_path(rows, f"{out.rstrip('/')}/{path.removeprefix(base.rstrip('/')).strip('/')}", files=1)
            done[name] = 1
    return done
