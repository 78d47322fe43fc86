"""Writing the lake: last write wins, watermarks, compaction, publishing, quality history."""

from __future__ import annotations

import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.schemas import GROUP_KEYS
from tidelake.sources import files
from tidelake.sources.lake import exists

_DAY = 86_400
#: Lengths of bar intervals in seconds; others are not judged as forming.
INTERVAL_SECONDS = {"1m": 60, "5m": 300, "15m": 900, "30m": 1800, "1h": 3600, "4h": 14_400, "1d": _DAY, "1w": 7 * _DAY}


def last_write_wins(stored: DataFrame, fresh: DataFrame, keys: list[str], tie: list[str] | None = None) -> DataFrame:
    """Rows of both, one for each key: the fresh one where there are two.

    Columns are matched by name, missing ones null.  tie: columns that order rows of one
    key within a side, the last one staying, such as a source's page and place in it.
    Without it rows of a key that repeats within a side are ordered by their own values:
    another row than the last to arrive may stay, but always the same.
    """
    both = stored.withColumn("__side", F.lit(0)).unionByName(fresh.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    order = [F.desc("__side"), *(F.col(c).desc_nulls_last() for c in tie or value_order(both, [*keys, "__side"]))]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return both.withColumn("__place", place).where("__place = 1").drop("__side", "__place")


def value_order(rows: DataFrame, but: list[str]) -> list[str]:
    """Columns that order rows by what is in them, whatever partitions they are in."""
    return sorted(f.name for f in rows.schema if f.name not in but and "map<" not in f.dataType.simpleString())


def drop_forming(bars: DataFrame, now: Column, interval: str) -> DataFrame:
    """Bars whose interval has ended; an interval of unknown length passes."""
    seconds = INTERVAL_SECONDS.get(interval)
    return bars if seconds is None else bars.where(F.unix_timestamp(F.col("date").cast("timestamp")) + seconds <= F.unix_timestamp(now.cast("timestamp")))


def watermarks(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, watermark: the newest date; for series it spans a series' metrics."""
    return rows.groupBy(*keys).agg(F.max("date").alias("watermark"))


def advance(stored: DataFrame, fetched: DataFrame, keys: list[str], today: Column, from_watermark: bool = True) -> DataFrame:
    """Fetched rows that may extend stored series: settled ones from each series' watermark on.

    from_watermark: the watermark's own row is fetched again, so that what was stored while
    it formed is replaced; otherwise rows start after it.  Series that are not stored are
    not extended: they are backfilled first.
    """
    rows = fetched.join(watermarks(stored, keys), keys).where(F.col("date") < today)
    return rows.where(F.col("date") >= F.col("watermark") if from_watermark else F.col("date") > F.col("watermark")).drop("watermark")


def schema_drift(stored: DataFrame, fresh: DataFrame) -> tuple[list[str], list[str]]:
    """Columns that fresh rows lose and gain."""
    return sorted({*stored.columns} - {*fresh.columns}), sorted({*fresh.columns} - {*stored.columns})


def unpivot_metrics(wide: DataFrame, keys: list[str]) -> DataFrame:
    """A wide series as keys, metric, value; a lone value column has a null metric."""
    metrics = [c for c in wide.columns if c not in keys]
    if metrics == ["value"]:
        return wide.select(*keys, F.lit(None).cast("string").alias("metric"), "value")
    return wide.unpivot(keys, metrics, "metric", "value")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _rename(fs, a, b) -> None:
    """Moves a path; a file system that says it did not raises."""
    if not fs.rename(a, b):
        raise OSError(f"cannot rename {a.toString()} to {b.toString()}")


def replace_path(df: DataFrame, path: str, partition_by: list[str] | None = None, files: int | None = None) -> None:
    """Writes df beside path and then takes path's place; df may read from path.

    The old data is moved away before the new is moved in, and deleted only once the new is
    there.  A swap that was cut short before is finished or undone first; whoever reads the
    path to make df calls recover() before reading.
    """
    spark = df.sparkSession
    recover(spark, path)
    fresh, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old"
    out = df.coalesce(files) if files else df
    jvm, fs, at = _fs(spark, path)
    new, away = jvm.org.apache.hadoop.fs.Path(fresh), jvm.org.apache.hadoop.fs.Path(old)
    try:
        (out.write.partitionBy(*partition_by) if partition_by else out.write).parquet(fresh)
    except Exception:
        fs.delete(new, True)
        raise
    if fs.exists(at):
        _rename(fs, at, away)
    try:
        _rename(fs, new, at)
    except Exception:
        if fs.exists(away) and not fs.exists(at):
            _rename(fs, away, at)
        raise
    fs.delete(away, True)


def recover(spark: SparkSession, path: str) -> str:
    """After a cut-short swap: restores the old data if the path is gone; drops leftovers.

    Returns clean, finished or restored.  The old data is deleted only where the new is in place.
    """
    jvm, fs, at = _fs(spark, path)
    old = jvm.org.apache.hadoop.fs.Path(f"{path}.old")
    state = "clean"
    if fs.exists(old):
        if fs.exists(at):
            fs.delete(old, True)
            state = "finished"
        else:
            _rename(fs, old, at)
            state = "restored"
    for left in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}.new-*")) or []:
        fs.delete(left.getPath(), True)
    return state


def upsert(spark: SparkSession, fresh: DataFrame, path: str, keys: list[str], order: list[str], tie: list[str] | None = None) -> None:
    """Merges fresh rows into a Parquet path, last write winning, sorted within files."""
    recover(spark, path)
    stored = spark.read.parquet(path) if exists(spark, path) else fresh.limit(0)
    replace_path(last_write_wins(stored, fresh, keys, tie).sortWithinPartitions(*order), path)


_INTEGERS = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}
#: Digits that each integer type may have.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _decimal(kind: str) -> tuple[int, int] | None:
    """Digits before and after the point of a decimal or integer type."""
    if kind in _DIGITS:
        return _DIGITS[kind], 0
    if kind.startswith("decimal("):
        digits, scale = (int(x) for x in kind[8:-1].split(","))
        return digits - scale, scale
    return None


def wider(a: str, b: str) -> str:
    """The type that holds all values of both without loss; types without one raise ValueError."""
    if a == b or b == "void":
        return a
    if a == "void":
        return b
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.get)
    for whole, real in ((a, b), (b, a)):
        if real == "double" and (whole == "float" or _INTEGERS.get(whole, 8) < 8):
            return "double"
        if real == "float" and whole in ("tinyint", "smallint"):
            return "float"
        if real == "float" and whole == "int":
            return "double"
        if (whole, real) == ("date", "timestamp_ntz"):
            return "timestamp_ntz"
    left, right = _decimal(a), _decimal(b)
    if left and right:
        before, after = max(left[0], right[0]), max(left[1], right[1])
        if before + after <= 38:
            return f"decimal({before + after},{after})"
    raise ValueError(f"no type holds all values of {a} and {b}")


def _all_null(parts: list[DataFrame], column: str, kind: str) -> bool:
    return all(p.where(F.col(f"`{column}`").isNotNull()).isEmpty() for p in parts if (column, kind) in p.dtypes)


def compact(spark: SparkSession, path: str) -> int:
    """Merges a partition's part files to one; how many there were, 0 if fewer than two.

    Columns are joined by name.  Where files differ in a column's type it takes the
    narrowest one that holds all values, files in which it is all null having no say; if
    there is none, nothing is touched and ValueError is raised.  Files of one schema are
    read as one table.
    """
    recover(spark, path)
    jvm, fs, at = _fs(spark, path)
    files = sorted(f.getPath().toString() for f in fs.listStatus(at) if f.getPath().getName().endswith(".parquet"))
    if len(files) < 2:
        return 0
    alike: dict[str, list[str]] = {}
    for f in files:
        alike.setdefault(spark.read.parquet(f).schema.json(), []).append(f)
    parts = [spark.read.parquet(*some) for some in alike.values()]
    kinds: dict[str, list[str]] = {}
    for c, k in dict.fromkeys(x for p in parts for x in p.dtypes):
        kinds.setdefault(c, []).append(k)
    wide = {}
    for c, own in kinds.items():
        said = own if len(own) == 1 else [k for k in own if not _all_null(parts, c, k)] or own[:1]
        wide[c] = reduce(wider, said)
    whole = None
    for p in parts:
        p = p.select(*((F.col(f"`{c}`") if c in p.columns else F.lit(None)).cast(k).alias(c) for c, k in wide.items()))
        whole = p if whole is None else whole.unionByName(p)
    replace_path(whole, path, files=1)
    return len(files)


def partitions(spark: SparkSession, root: str, since: str | None = None, today: str | None = None, least: int = 1) -> list[str]:
    """Folders below a root that hold ``least`` Parquet files or more, or did before a swap that was cut short.

    since, today: only folders whose date= is in since .. today (open); without them all
    folders.  Folder names are read here, files are listed folder by folder in tasks.
    """
    folders = [f for f in files.folders(spark, root) if _in_days(f, since, today)]
    rows = files.listing(spark, folders).where("name LIKE '%.parquet'")
    real = F.regexp_replace("folder", "[.]old$", "")
    counts = rows.withColumns({"cut": F.col("folder") != real, "folder": real}).where(~F.col("folder").rlike("[.]new-[0-9a-f]+$"))
    counts = counts.groupBy("folder").agg(F.count("*").alias("n"), F.max("cut").alias("cut")).where((F.col("n") >= least) | F.col("cut"))
    return sorted(r["folder"] for r in counts.collect())  # the folders to work on


def _in_days(folder: str, since: str | None, today: str | None) -> bool:
    day = re.search("date=([0-9-]+)", folder)
    if since is None and today is None:
        return True
    return bool(day) and (since is None or day[1] >= since) and (today is None or day[1] < today)


def compact_settled(spark: SparkSession, root: str, today: str, parallel: int = 4, since: str | None = None) -> dict[str, int]:
    """Compacts every partition folder below a root whose date= is before today; folder to files merged.

    since: the first day to look at; a nightly run names the day of its last one, so that
    what is compacted is not listed again.  A folder that cannot be merged is left as it is
    and counts -1; swaps that were cut short are finished or undone.  Folders are jobs of
    their own, ``parallel`` of them at a time.
    """
    settled = partitions(spark, root, since, today, 2)

    def one(folder: str) -> int:
        try:
            return compact(spark, folder)
        except ValueError:
            return -1

    with ThreadPoolExecutor(parallel) as pool:
        return {f: n for f, n in zip(settled, pool.map(one, settled)) if n}


def settled_partitions(folders: DataFrame, today: Column) -> DataFrame:
    """Folders whose date= is before today. folders: path."""
    day = F.regexp_extract("path", "date=([0-9-]+)", 1).try_cast("date")
    return folders.where(day < today)


def publishable(rows: DataFrame, allowed: DataFrame, group: str | None = None) -> DataFrame:
    """Rows whose source is on the allowlist; a null source and an unlisted one never leave."""
    keys = ["source"] if group else ["group", "source"]
    pairs = allowed.where(F.col("group") == group).select("source") if group else allowed.select("group", "source")
    return rows.join(pairs.distinct(), keys, "left_semi")


#: Rows of a published file.
FILE_ROWS = 5_000_000


def publish(rows: DataFrame, allowed: DataFrame, group: str, path: str, order: list[str] | None = None, file_rows: int = FILE_ROWS) -> int:
    """Writes what may be republished, in order, in files of at most about ``file_rows`` rows; the number of files.

    A small group is one file.  order: columns that files are cut along, a group's keys for
    instance; a frequent source is cut by the columns after it.
    """
    out = publishable(rows, allowed, group)
    files = max(1, -(-out.count() // file_rows))
    keys = [c for c in order or GROUP_KEYS.get(group, ["source"]) if c in out.columns]
    if files > 1:
        out = out.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    replace_path(out, path, files=1 if files == 1 else None)
    return files


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of two tables holds more often than the other, with side: first or second."""
    one = a.exceptAll(b).withColumn("side", F.lit("first"))
    return one.unionByName(b.exceptAll(a).withColumn("side", F.lit("second")))


def unchanged(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows, as often."""
    return differing(a, b).isEmpty()


def dq_runs(violations: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_violations, n_error, n_warn, groups of violation rows."""
    groups = F.array_join(F.sort_array(F.collect_set("group")), ",")
    return violations.groupBy(*keys).agg(
        F.count("*").alias("n_violations"), F.count_if(F.col("severity") == "error").alias("n_error"), F.count_if(F.col("severity") == "warn").alias("n_warn"), groups.alias("groups")
    )


def record_run(spark: SparkSession, fresh: DataFrame, path: str, keys: list[str], run: dict[str, str] | None = None) -> None:
    """Adds a run to a quality history; a run that is recorded again replaces itself.

    keys: the columns that tell a run.  run: their values; without it they are those that
    fresh rows hold, so that a repeat without rows replaces nothing.  Rows of before
    cadences were kept count as daily.
    """
    recover(spark, path)
    if exists(spark, path):
        stored = spark.read.option("mergeSchema", "true").parquet(path)
        cadence = F.coalesce("cadence", F.lit("daily")) if "cadence" in stored.columns else F.lit("daily")
        stored = stored.withColumn("cadence", cadence)
        if run is None:
            stored = stored.join(fresh.select(*keys).distinct(), keys, "left_anti")
        else:
            stored = stored.where(~reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(run[c])) for c in keys)))
        fresh = stored.unionByName(fresh, allowMissingColumns=True)
    replace_path(fresh, path)


def newest_first(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Rows of a quality history, the newest run first and each run in a fixed order; at most ``most`` of them."""
    out = rows.orderBy(F.desc("run_ts"), *(F.col(c).asc_nulls_first() for c in rows.columns if c != "run_ts"))
    return out if most is None else out.limit(most)


def history(spark: SparkSession, path: str, schema: T.StructType, most: int | None = None) -> DataFrame:
    """A quality history, newest run first; empty before the first run.  most: how many rows."""
    recover(spark, path)
    rows = spark.read.option("mergeSchema", "true").parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    return newest_first(rows, most)


def catalogue_counts(rows: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """source, n_rows, newest, of published sources if an allowlist is given."""
    kept = rows if allowed is None else rows.join(allowed.select("source").distinct(), "source", "left_semi")
    return kept.groupBy("source").agg(F.count("*").alias("n_rows"), F.max("date").alias("newest"))


def quality_summary(bars: DataFrame, keys: list[str], today: Column) -> DataFrame:
    """One row for each series: size, span, staleness, repeats, nulls, prices that can't be, days that lack."""
    price = (F.col("low") <= 0) | (F.col("high") < F.col("low"))
    rows = bars.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.countDistinct("date").alias("n_dates"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("open", "high", "low", "close", "volume")), F.count_if(price).alias("n_bad_prices"),
    )
    stale = F.datediff(today, "last_date").cast("bigint")
    lacks = F.datediff("last_date", "first_date").cast("bigint") + 1 - F.col("n_dates")
    rows = rows.withColumns({"days_stale": stale, "n_repeated": F.col("n_rows") - F.col("n_dates"), "n_missing_days": lacks}).drop("n_dates")
    nulls = sum((F.col(f"null_{c}") for c in ("open", "high", "low", "close", "volume")), F.lit(0))
    clean = (nulls == 0) & (F.col("n_bad_prices") == 0) & (F.col("n_repeated") == 0) & (F.col("n_missing_days") == 0) & (F.col("days_stale") <= 3)
    return rows.withColumn("status", F.when(clean, "CLEAN").otherwise("CHECK"))


def write_json(spark: SparkSession, rows: dict | list, path: str) -> None:
    """Writes a small document, such as a catalogue of sources, to any file system: beside its path, then over it in one step."""
    jvm, fs, at = _fs(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(f"{path}.tmp")
    out = fs.create(part, True)
    try:
        out.write(bytearray(json.dumps(rows, indent=2, default=str).encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(rename, 1)
    over[0] = rename.OVERWRITE
    at = fs.makeQualified(at)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), at, over)


def write_csv(rows: DataFrame, path: str) -> None:
    """Writes a report, such as the quality summary, as one CSV part with a header."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
