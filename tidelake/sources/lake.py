"""Reading the lake: paths, group readers, named views, and SQL over them.

A lake is ``<base>/bronze/group=../..``, ``<base>/gold/<mart>`` and ``<base>/quality/..`` in
Parquet, local or in an object store.  Partition values stay text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.schemas import BARS, DQ_DRIFT, DQ_FAILURES, DQ_RUNS, DQ_VIOLATIONS, EVENTS, SERIES, TAPE

QUALITY = {"dq_runs": DQ_RUNS, "dq_violations": DQ_VIOLATIONS, "dq_failures": DQ_FAILURES, "dq_drift": DQ_DRIFT}
GOLD = ("fct_bars_daily", "fct_series_features", "fct_events_revisions", "fct_cross_venue_basis", "dim_sources")


def exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob names anything, in any file system Spark knows."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def group_path(base: str, group: str, **keys: str | None) -> str:
    """Path of a group narrowed by its partition keys, in their order; a null key is any value."""
    parts = [f"{k}={'*' if v is None else v}" for k, v in keys.items()]
    return "/".join([base.rstrip("/"), "bronze", f"group={group}", *parts])


def gold_path(base: str, mart: str) -> str:
    return f"{base.rstrip('/')}/gold/{mart}"


def read_mart(spark: SparkSession, base: str, mart: str) -> DataFrame:
    """A stored mart, its source as text and without the month that it is stored by."""
    rows = spark.read.parquet(gold_path(base, mart))
    return rows.withColumn("source", F.col("source").cast("string")).drop("month") if "month" in rows.columns else rows


def _read(spark: SparkSession, root: str, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.option("basePath", root)
    return (reader.schema(schema) if schema else reader.option("mergeSchema", "true")).parquet(path)


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df's columns in the schema's order and types; columns it lacks are null."""
    return df.select(*((F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def read_bars(spark: SparkSession, base: str) -> DataFrame:
    root = group_path(base, "bars")
    return _conform(_read(spark, root, root, BARS), BARS)


def read_events(spark: SparkSession, base: str) -> DataFrame:
    root = group_path(base, "events")
    return _conform(_read(spark, root, root, EVENTS), EVENTS)


def read_series(spark: SparkSession, base: str) -> DataFrame:
    """Series of both depths; one reader for each, as a root of mixed depth is refused."""
    root = group_path(base, "series")
    found = None
    for depth in (group_path(base, "series", source=None, series_id=None) + "/*.parquet", group_path(base, "series", source=None, series_id=None, metric=None)):
        if exists(spark, depth):
            part = _conform(_read(spark, root, depth), SERIES)
            found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], SERIES) if found is None else found


def load_bars(spark: SparkSession, base: str, symbol: str, source: str, interval: str = "1d") -> DataFrame:
    """One stored series of bars; FileNotFoundError if there is none."""
    path = group_path(base, "bars", source=source, symbol=symbol, interval=interval)
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return read_bars(spark, base).where((F.col("source") == source) & (F.col("symbol") == symbol) & (F.col("interval") == interval))


def load_series(spark: SparkSession, base: str, series_id: str, source: str, metric: str | None = None) -> DataFrame:
    """One stored series, or one metric of it; FileNotFoundError if there is none."""
    path = group_path(base, "series", source=source, series_id=series_id, **({"metric": metric} if metric else {}))
    if not exists(spark, path):
        raise FileNotFoundError(path)
    rows = read_series(spark, base).where((F.col("source") == source) & (F.col("series_id") == series_id))
    return rows.where(F.col("metric") == metric) if metric else rows


def count_events(spark: SparkSession, base: str, source: str, calendar: str) -> int:
    """Rows of a calendar, 0 where there is none."""
    path = group_path(base, "events", source=source, calendar=calendar)
    return spark.read.schema(EVENTS).parquet(path).count() if exists(spark, path) else 0


def read_kind(spark: SparkSession, base: str, kind: str, source: str | None = None) -> DataFrame:
    """A tape kind of one or all sources, joined by column name; lost columns are null.

    A source's types are those of one of its files, so one footer is read for each source.
    """
    root = group_path(base, "microstructure")
    keys = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "date")])
    schema = T.StructType([*TAPE[kind].fields, *(f for f in keys if f.name not in TAPE[kind].fieldNames())])
    found = None
    for path in sources_of(spark, base, kind) if source is None else [source]:
        at = group_path(base, "microstructure", source=path, kind=kind)
        if exists(spark, at):
            own = {f.name: f for f in spark.read.option("basePath", root).parquet(at).schema}
            part = _conform(_read(spark, root, at, T.StructType([own.get(f.name, f) for f in schema])), schema)
            found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], schema) if found is None else found


def folders_of(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob names; with one for each key of a partition, a name a folder and none a file."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at) or []
    return [f.getPath().toString() for f in found]


def sources_of(spark: SparkSession, base: str, kind: str) -> list[str]:
    """Names of the sources that hold a tape kind, from folder names alone."""
    found = folders_of(spark, group_path(base, "microstructure", source=None, kind=kind))
    return sorted({f.rsplit("/", 2)[1].partition("=")[2] for f in found})


def tape_partitions(spark: SparkSession, base: str) -> DataFrame:
    """source, kind, symbol, date of all tape partitions, from folder names alone."""
    found = folders_of(spark, group_path(base, "microstructure", source=None, kind=None, symbol=None, date=None))
    rows = [tuple(part.partition("=")[2] for part in f.rsplit("/", 4)[1:]) for f in found]
    return spark.createDataFrame(rows, "source string, kind string, symbol string, date string")


def register_views(spark: SparkSession, base: str, only: set[str] | None = None) -> list[str]:
    """Makes a temp view of every group, tape kind, mart and quality table that is there, or of those in ``only``; their names."""
    names = []

    def view(name: str, is_there: Callable[[], bool], read: Callable[[], DataFrame]) -> None:
        if (only is None or name in only) and is_there():
            read().createOrReplaceTempView(name)
            names.append(name)

    for group, read in (("bars", read_bars), ("series", read_series), ("events", read_events)):
        view(group, lambda g=group: exists(spark, group_path(base, g)), lambda r=read: r(spark, base))
    for kind in TAPE:
        view(kind, lambda k=kind: bool(sources_of(spark, base, k)), lambda k=kind: read_kind(spark, base, k))
    for mart in GOLD:
        view(mart, lambda m=mart: exists(spark, gold_path(base, m)), lambda m=mart: read_mart(spark, base, m))
    for name, schema in QUALITY.items():
        path = f"{base.rstrip('/')}/quality/{name}"
        view(name, lambda p=path: exists(spark, p), lambda p=path, s=schema: spark.read.schema(s).parquet(p))
    return names


#: Text that is no code: quoted text, quoted names, comments.
_QUIET = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|/\*.*?\*/", re.DOTALL)
_DEPTH = {"(": 1, "[": 1, ")": -1, "]": -1}


def _close(text: str, at: int) -> int:
    """Where the bracket closes that was opened before ``at``; -1 if it does not."""
    depth = 1
    for i in range(at, len(text)):
        depth += _DEPTH.get(text[i], 0)
        if depth == 0:
            return i
    return -1


def _split(text: str, mark: str = ",") -> list[str]:
    """Parts of text between marks that are in no bracket."""
    parts, depth, begin = [], 0, 0
    for i, c in enumerate(text):
        depth += _DEPTH.get(c, 0)
        if depth == 0 and text.startswith(mark, i):
            parts.append(text[begin:i])
            begin = i + len(mark)
    return [*parts, text[begin:]]


def _calls(text: str, name: str, to: Callable[[list[str]], str | None]) -> str:
    """text with each call of a function put as ``to`` says of its arguments; None leaves the call."""
    out, at = "", 0
    for m in re.finditer(rf"\b{name}\s*\(", text, re.IGNORECASE):
        if m.start() < at:
            continue
        end = _close(text, m.end())
        if end < 0:
            return text
        args = [_calls(a, name, to).strip() for a in _split(text[m.end() : end])]
        put = to(args)
        out += text[at : m.start()] + (f"{text[m.start() : m.end()]}{', '.join(args)})" if put is None else put)
        at = end + 1
    return out + text[at:]


def _by(name: str) -> Callable[[list[str]], str | None]:
    """arg_max or arg_min of two arguments: rows whose value is null don't count."""
    return lambda a: f"{name}({a[0]}, CASE WHEN ({a[0]}) IS NOT NULL THEN {a[1]} END)" if len(a) == 2 else None


def _filtered_windows(text: str) -> str:
    """Aggregates with both FILTER and OVER, which windows do not take, with their condition inside."""
    at = 0
    while m := re.compile(r"\)\s*FILTER\s*\(\s*WHERE\b", re.IGNORECASE).search(text, at):
        at = m.end()
        end, depth, begin = _close(text, m.end()), 1, m.start()
        if end < 0 or not re.match(r"\s*OVER\b", text[end + 1 :], re.IGNORECASE):
            continue
        while depth:
            begin -= 1
            depth -= _DEPTH.get(text[begin], 0)
        args, name = [a.strip() for a in _split(text[begin + 1 : m.start()])], re.search(r"(\w+)\s*$", text[:begin])[1].lower()
        which = len(args) - 1 if name in ("max_by", "min_by") else 0
        value = "1" if args[which] == "*" else args[which]
        args[which] = f"CASE WHEN {text[m.end() : end].strip()} THEN {value} END"
        put = f"({', '.join(args)})"
        text = text[:begin] + put + text[end + 1 :]
        at = begin + len(put)
    return text


def translated(sql: str, files: Callable[[list[str], list[str]], str] | None = None) -> str:
    """sql with another dialect's spellings put as Spark has them, quoted text and comments left alone.

    arg_max and arg_min, aggregates with FILTER and OVER, date_diff of any unit,
    quantile_cont, * EXCLUDE, read_parquet, // , DESCRIBE SELECT, "names" in backticks.
    files: the relation that stands for read_parquet's paths and options.
    """
    quiet: list[str] = []

    def hide(m: re.Match) -> str:
        inner = m[0][1:-1]
        quiet.append("`" + inner.replace('""', '"').replace("`", "``") + "`" if m[0][0] == '"' else m[0])
        return f"\x00{len(quiet) - 1}\x00"

    show = lambda text: re.sub("\x00(\\d+)\x00", lambda m: quiet[int(m[1])], text)

    def literal(text: str) -> str | None:
        shown = show(text.strip())
        return shown[1:-1].replace("''", "'") if re.fullmatch("\x00\\d+\x00", text.strip()) and shown[0] == "'" else None

    def apart(a: list[str]) -> str | None:
        """Boundaries of a unit between two times."""
        unit = (literal(a[0]) or "").upper()
        if len(a) != 3 or not unit.isalpha():
            return None
        return f"datediff({a[2]}, {a[1]})" if unit == "DAY" else f"timestampdiff({unit}, date_trunc('{unit}', {a[1]}), date_trunc('{unit}', {a[2]}))"

    def parquet(a: list[str]) -> str | None:
        several = a[0].startswith("[") and a[0].endswith("]")
        paths = [literal(x) for x in (_split(a[0][1:-1]) if several else a[:1])]
        if None in paths:
            return None
        return (files or (lambda p, _: f"parquet.`{p[0]}`"))(paths, [show(x) for x in a[1:]])

    text = _QUIET.sub(hide, sql)
    quantile = lambda a: f"percentile({a[0]}, {a[1]})" if len(a) == 2 else None
    for name, to in (("arg_max", _by("max_by")), ("arg_min", _by("min_by")), ("date_diff", apart), ("quantile_cont", quantile), ("read_parquet", parquet)):
        text = _calls(text, name, to)
    text = _filtered_windows(text)
    text = re.sub(r"\*\s*EXCLUDE\s*\(", "* EXCEPT (", text, flags=re.IGNORECASE)
    text = re.sub("\\*\\s*EXCLUDE\\s+(\\w+|\x00\\d+\x00)", r"* EXCEPT (\1)", text, flags=re.IGNORECASE)
    text = re.sub(r"^\s*DESCRIBE\s+SELECT\b", "DESCRIBE QUERY SELECT", text, flags=re.IGNORECASE)
    return show(text.replace("//", " div "))


def _by_name(sql: str) -> list[str]:
    """The queries between which SQL says UNION ALL BY NAME outside of brackets and quotes."""
    quiet: list[str] = []
    text = _QUIET.sub(lambda m: quiet.append(m[0]) or f"\x00{len(quiet) - 1}\x00", sql)
    parts = _split(re.sub(r"\bUNION\s+ALL\s+BY\s+NAME\b", "\x01", text, flags=re.IGNORECASE), "\x01")
    return [re.sub("\x00(\\d+)\x00", lambda m: quiet[int(m[1])], p) for p in parts]


def query(spark: SparkSession, sql: str, base: str) -> DataFrame:
    """Runs SQL over the lake's views; only those that it names are made.

    UNION ALL BY NAME may stand between whole queries.
    """
    known = {"bars", "series", "events", *TAPE, *GOLD, *QUALITY}
    register_views(spark, base, {n for n in known if re.search(rf"\b{n}\b", sql)})

    def files(paths: list[str], options: list[str]) -> str:
        if not options and len(paths) == 1:
            return f"parquet.`{paths[0]}`"
        wanted = {k.strip().lower() for k, _, v in (o.partition("=") for o in options) if v.strip().lower() in ("true", "1")}
        reader = spark.read.option("mergeSchema", "union_by_name" in wanted)
        if "hive_partitioning" in wanted:  # columns of all key=value folders of the paths
            whole = [p.split("/") for p in paths]
            plain = [p[: next((i for i, x in enumerate(p) if "=" in x or "*" in x), len(p))] for p in whole]
            root = plain[0]
            for p in plain[1:]:
                root = root[: next((i for i, (x, y) in enumerate(zip(root, p)) if x != y), min(len(root), len(p)))]
            reader = reader.option("basePath", "/".join(root) or "/")
        name = f"files_{abs(hash((*paths, *sorted(wanted)))):x}"
        reader.parquet(*paths).createOrReplaceTempView(name)
        return name

    parts = [spark.sql(translated(p, files)) for p in _by_name(sql)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def list_series(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The different keys of a group, in order."""
    return rows.select(*keys).distinct().orderBy(*(F.col(k).asc_nulls_first() for k in keys))


def wide_series(rows: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """One series' metrics as columns, a row for each date."""
    grouped = rows.groupBy("date")
    return (grouped.pivot("metric", metrics) if metrics else grouped.pivot("metric")).agg(F.first("value")).orderBy("date")


def describe(df: DataFrame) -> list[dict[str, str]]:
    """Names and types of columns."""
    return [{"name": f.name, "type": f.dataType.simpleString()} for f in df.schema]
