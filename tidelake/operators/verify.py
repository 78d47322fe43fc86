"""Verification of frames and of sources against each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.columns import average_rank, correlation, drift, is_close, to_double
from tidelake.operators.checks import _n, union_all, violation
from tidelake.operators.statistics import modal_gap, returns, rolling_correlation, split_recent
from tidelake.schemas import REQUIRED, VIOLATION

#: Fixed values. Limits of the decision between sources: rows against a peer's, median difference, correlation of
#: returns, trend of a ratio; shared dates that tell a trend, and that tell unlike returns.
COVERAGE, MEDIAN_DIFF, RETURN_CORR, ONE_WAY_TREND, SHARED_LEAST, DATES_LEAST = 0.7, 0.05, 0.9, 0.80, 250, 6
#: Limits of proxies.
PROXY_BASELINE, PROXY_FLOOR, PROXY_WINDOW, PROXY_LEAST, PROXY_STALE_DAYS = 0.75, 0.30, 180, 400, 14
JUMP = 5.0
PRICE_DRIFT, VOLUME_DRIFT = 1e-6, 0.01


#: Columns that tell a series or its rows apart and carry no observation.
_LABELS = {"source", "symbol", "series_id", "metric", "interval", "date", "arrival"}


def structure(frame: DataFrame, group: str) -> DataFrame:
    """Unknown group, missing columns, dates that are none or have no zone, no rows: what makes other checks pointless.

    A series needs one column at least that is not a label.
    """
    spark = frame.sparkSession
    one = spark.range(1)
    if group not in REQUIRED:
        return violation(one, group, "group", "error", F.lit(f"unknown group {group}"))
    missing = [c for c in REQUIRED[group] if c not in frame.columns]
    if group == "series" and not {*frame.columns} - _LABELS:
        missing = ["value"]
    if missing or not frame.columns:
        return violation(one, group, "columns", "error", F.lit("missing " + ", ".join(missing)))
    kind = dict(frame.dtypes).get("date")
    if group != "events" and kind not in ("timestamp", "date"):
        return violation(one, group, "index", "error", F.lit("dates have no time zone" if kind == "timestamp_ntz" else f"date is {kind or 'missing'}"))
    return violation(frame.agg(F.count("*").alias("n")).where("n = 0"), group, "empty", "error", F.lit("no rows"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n of keys that more than one row has; nulls are one key."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def index(rows: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """Dates that a series holds more than once."""
    bad = duplicate_keys(rows, [*keys, "date"]).groupBy(*keys).agg(F.count("*").alias("k"))
    return violation(bad, group, "index", "error", _n(F.col("k"), "repeated dates"), F.col(keys[0]), F.col(keys[-1]))


def unsorted(rows: DataFrame, group: str, keys: list[str], ordinal: str) -> DataFrame:
    """Series whose dates go back in the order of arrival."""
    back = F.col("date") < F.lag("date").over(Window.partitionBy(*keys).orderBy(ordinal))
    bad = rows.select(*keys, back.alias("back")).groupBy(*keys).agg(F.count_if("back").alias("k")).where("k > 0")
    return violation(bad, group, "index", "warn", _n(F.col("k"), "steps back in time"), F.col(keys[0]), F.col(keys[-1]))


def outside(rows: DataFrame, keys: list[str], now: Column, start: Column, end: Column) -> DataFrame:
    """keys, n_future, n_before, n_after: dates beyond now + 2 days, or outside start .. end + 1 day."""
    date = F.col("date")
    counts = rows.groupBy(*keys).agg(
        F.count_if(date > F.date_add(now, 2)).alias("n_future"), F.count_if(date < start).alias("n_before"), F.count_if(date > F.date_add(end, 1)).alias("n_after")
    )
    return counts.where("n_future + n_before + n_after > 0")


def interval(rows: DataFrame, group: str, keys: list[str], expected_seconds: int) -> DataFrame:
    """Series of three rows or more whose most frequent gap is not the expected one."""
    bad = modal_gap(rows, keys, 2).where(F.col("modal_gap") != expected_seconds)
    return violation(bad, group, "interval", "error", F.concat(F.lit("modal gap "), F.col("modal_gap").cast("string"), F.lit(" s")), F.col(keys[0]), F.col(keys[-1]))


def unparseable(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """keys, column, n_bad, sample of text values that are no numbers."""
    long = rows.unpivot(keys, columns, "column", "text")
    bad = F.col("text").isNotNull() & to_double(F.col("text")).isNull()
    return long.groupBy(*keys, "column").agg(F.count_if(bad).alias("n_bad"), F.min(F.when(bad, F.col("text"))).alias("sample")).where("n_bad > 0")


def incoherent(bars: DataFrame) -> DataFrame:
    """Bars that break low <= open, close <= high by more than a millionth of the close."""
    slack = F.abs(F.col("close")) * 1e-6
    ok = (F.col("low") <= F.col("high") + slack) & (F.col("open") <= F.col("high") + slack) & (F.col("close") <= F.col("high") + slack) & (F.col("open") >= F.col("low") - slack) & (F.col("close") >= F.col("low") - slack)
    return bars.where(~ok)


def ohlc(bars: DataFrame, keys: list[str]) -> DataFrame:
    bad = incoherent(bars).groupBy(*keys).agg(F.count("*").alias("n"), F.min("date").alias("first"))
    return violation(bad, "bars", "ohlc_coherent", "error", F.concat(_n(F.col("n"), "incoherent bars, first "), F.to_date("first").cast("string")), F.col("source"), F.col("symbol"))


def volume(bars: DataFrame, keys: list[str]) -> DataFrame:
    bad = bars.groupBy(*keys).agg(F.count_if(F.col("volume") < 0).alias("n")).where("n > 0")
    return violation(bad, "bars", "volume", "error", _n(F.col("n"), "negative volumes"), F.col("source"), F.col("symbol"))


def implausible(bars: DataFrame, keys: list[str], limit: float = JUMP) -> DataFrame:
    """keys, n, biggest of changes above ``limit`` in size; a fall cannot pass a limit over 1."""
    rets = returns(bars, keys).where(F.abs(F.col("ret")) > limit)
    return rets.groupBy(*keys).agg(F.count("*").alias("n"), F.max("ret").alias("biggest"))


def constant(rows: DataFrame, keys: list[str], value: str = "close") -> DataFrame:
    """keys, n of series of two or more rows whose values are all the same."""
    return rows.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most")).where("n >= 2 AND least = most").select(*keys, "n")


def verify_bars(bars: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """All checks of a bars frame; structural failures suppress the rest."""
    first = structure(bars, "bars")
    if not first.isEmpty():
        return first
    return union_all(
        [
            index(bars, "bars", keys), ohlc(bars, keys), volume(bars, keys), future(bars, "bars", keys, now),
            violation(implausible(bars, keys), "bars", "returns", "warn", _n(F.col("n"), "implausible changes"), F.col("source"), F.col("symbol")),
            violation(constant(bars, keys), "bars", "variance", "warn", F.lit("constant close"), F.col("source"), F.col("symbol")),
        ]
    )


#: Seconds between rows of each interval that resolution is checked for.
SPACING = {"1d": 86_400, "1h": 3600, "1m": 60}


def out_of_range(rows: DataFrame, group: str, keys: list[str], start: Column | None, end: Column | None) -> DataFrame:
    """Rows before the requested start, or after the requested end and a day."""
    date, found = F.col("date"), []
    for bad, what in (((date < start) if start is not None else None, "rows before the requested start"), ((date > F.date_add(end, 1)) if end is not None else None, "rows after the requested end")):
        if bad is not None:
            n = rows.groupBy(*keys).agg(F.count_if(bad).alias("n")).where("n > 0")
            found.append(violation(n, group, "range", "error", _n(F.col("n"), what), F.col(keys[0]), F.col(keys[-1])))
    return union_all(found, rows.sparkSession)


def future(rows: DataFrame, group: str, keys: list[str], now: Column) -> DataFrame:
    """Rows dated more than two days ahead."""
    late = rows.groupBy(*keys).agg(F.count_if(F.col("date") > F.date_add(now, 2)).alias("n")).where("n > 0")
    return violation(late, group, "future_dates", "error", _n(F.col("n"), "future dates"), F.col(keys[0]), F.col(keys[-1]))


def not_numeric(rows: DataFrame, group: str, keys: list[str], columns: list[str]) -> DataFrame:
    """Text values that are no numbers, in columns that are text."""
    texts = [c for c in columns if dict(rows.dtypes).get(c) == "string"]
    if not texts:
        return rows.sparkSession.createDataFrame([], VIOLATION)
    detail = F.concat(_n(F.col("n_bad"), "values of "), F.col("column"), F.lit(" are no numbers, such as "), F.col("sample"))
    return violation(unparseable(rows, keys, texts), group, "numeric", "error", detail, F.col(keys[0]), F.col(keys[-1]))


def missing_values(rows: DataFrame, group: str, keys: list[str], columns: list[str]) -> DataFrame:
    """Nulls: any one of bars is an error; observations warn only where a series has no value at all."""
    counts = rows.groupBy(*keys).agg(F.count("*").alias("n_rows"), *(F.count_if(to_double(F.col(c)).isNull() & (F.col(c).isNull() | (F.lit(group) == "bars"))).alias(c) for c in columns))
    long = counts.unpivot([*keys, "n_rows"], columns, "column", "n")
    metric = F.col("metric") if "metric" in keys else None
    series = F.col([k for k in keys if k != "metric"][-1])
    if group == "bars":
        bad = long.where("n > 0")
        return violation(bad, group, "nulls", "error", F.concat(_n(F.col("n"), "nulls in "), F.col("column")), F.col(keys[0]), series)
    return violation(long.where("n = n_rows"), group, "nulls", "warn", F.concat(F.lit("all "), _n(F.col("n"), "values are null")), F.col(keys[0]), series, metric)


def verify_series(rows: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """All checks of long observations (keys, metric, date, value); structural failures suppress the rest."""
    first = structure(rows, "series")
    if not first.isEmpty():
        return first
    by_metric = [*keys, "metric"] if "metric" in rows.columns else keys
    repeated = duplicate_keys(rows, [*by_metric, "date"]).groupBy(*keys).agg(F.count("*").alias("k"))
    index_ = violation(repeated, "series", "index", "error", _n(F.col("k"), "repeated dates"), F.col(keys[0]), F.col(keys[-1]))
    return union_all([index_, future(rows, "series", keys, now), not_numeric(rows, "series", keys, ["value"]), missing_values(rows, "series", by_metric, ["value"])])


def verify_events(rows: DataFrame, source: str = "source", series: str = "series_id") -> DataFrame:
    """All checks of an events frame: order of times, repeated keys, revisions that are not 0, 1, 2, ..."""
    first = structure(rows, "events")
    if not first.isEmpty():
        return first
    keys = [source, series]
    back = rows.groupBy(*keys).agg(F.count_if(F.col("observed_ts") < F.col("scheduled_ts")).alias("n")).where("n > 0")
    twice = duplicate_keys(rows, [*keys, "event_id", "revision_seq"]).groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("n"))
    shape = rows.where("revision_seq IS NOT NULL").groupBy(*keys, "event_id").agg(F.min("revision_seq").alias("lo"), F.max("revision_seq").alias("hi"), F.count("*").alias("n"), F.countDistinct("revision_seq").alias("d"))
    holes = shape.where("lo <> 0 OR hi <> n - 1 OR d <> n").groupBy(*keys).agg(F.count("*").alias("n"))
    tell = lambda bad, check, what: violation(bad, "events", check, "error", _n(F.col("n"), what), F.col(source), F.col(series))
    return union_all([tell(back, "bitemporal", "rows observed before scheduled"), tell(twice, "key", "repeated event_id and revision_seq"), tell(holes, "revision_seq", "events whose revisions are not contiguous")])


def verify_frame(frame: DataFrame, group: str, now: Column, start: Column | None = None, end: Column | None = None, interval_name: str | None = None, arrival: str | None = None) -> DataFrame:
    """All checks of a frame as it arrived: bars (source, symbol), long series (source, series_id), events.

    start, end and interval_name are what was asked for; arrival orders rows as they came.
    A frame that fails structurally is not checked further.
    """
    if group == "events":
        return verify_events(frame)
    keys = ["source", "symbol"] if group == "bars" else ["source", "series_id"]
    first = structure(frame, group)
    if not first.isEmpty():
        return first
    if group == "bars":
        prices = [c for c in REQUIRED["bars"] if c in frame.columns]
        numbers = frame.withColumns({c: to_double(F.col(c)) for c in prices if dict(frame.dtypes)[c] == "string"})
        found = [verify_bars(numbers, keys, now), not_numeric(frame, group, keys, prices), missing_values(numbers, group, keys, prices)]
    else:
        found = [verify_series(frame, keys, now)]
    found.append(out_of_range(frame, group, keys, start, end))
    if interval_name in SPACING:
        found.append(interval(frame, group, keys, SPACING[interval_name]))
    if arrival:
        found.append(unsorted(frame, group, keys, arrival))
    return union_all(found)


def settled(rows: DataFrame, today: Column) -> DataFrame:
    """Rows before today."""
    return rows.where(F.col("date") < today)


PRICES = ("open", "high", "low", "close")


def self_consistency(stored: DataFrame, again: DataFrame, keys: list[str], most_rows: int | None = None, arrival: str | None = None) -> DataFrame:
    """What a re-fetch changes in stored, settled bars, a row for each series of two or more of them.

    keys, n_shared, n_repeated (rows of the re-fetch beyond one a date), n_vanished (stored
    dates it lacks), n_appeared (dates inside the stored window that only it has),
    worst_column and worst_drift (the price column that moved most against the re-fetch,
    null if none moved), uniform (that column moved by one ratio over three or more dates),
    n_volume (dates whose volume moved).

    most_rows: how many rows a source serves a call; only a series' latest so many are
    compared.  Of repeated dates the last by ``arrival`` counts; without it the one of the
    largest prices does, wherever it lies.  One shuffle by series.
    """
    if most_rows is not None:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("date")))
        stored = stored.withColumn("__place", place).where(F.col("__place") <= most_rows).drop("__place")
    columns = [*PRICES, "volume"]
    order = F.col(arrival) if arrival else F.lit(0)
    side = lambda df, fresh: df.select(*keys, "date", *(F.col(c).cast("double").alias(c) for c in columns), F.lit(fresh).alias("fresh"), (order if fresh else F.lit(0)).cast("bigint").alias("at"))
    rows = side(stored, False).unionByName(side(again, True)).repartition(*keys)
    old, new = ~F.col("fresh"), F.col("fresh")
    last = lambda which: F.max_by(F.struct(*columns), F.when(which, F.struct(F.lit(1), "at", *columns)))
    rows = rows.groupBy(*keys, "date").agg(F.count_if(old).alias("n_old"), F.count_if(new).alias("n_new"), last(old).alias("old"), last(new).alias("new"))
    every = Window.partitionBy(*keys)
    stored_date = F.when(F.col("n_old") > 0, F.col("date"))
    rows = rows.withColumns({"lo": F.min(stored_date).over(every), "hi": F.max(stored_date).over(every), "both": (F.col("n_old") > 0) & (F.col("n_new") > 0)})
    pair = lambda c: (F.when(F.col("both"), F.col(f"old.{c}")), F.when(F.col("both"), F.col(f"new.{c}")))
    worst, spread = {}, {}
    for c in PRICES:
        before, after = pair(c)
        moved = drift(before, after)
        worst[c] = F.max(F.when(moved > PRICE_DRIFT, moved))
        ratio = F.try_divide(before, after)
        spread[c] = (F.count(ratio) > 2) & (F.count_if((after == 0) & (before != 0)) == 0) & (F.stddev_samp(ratio) < 1e-6)
    bar = F.greatest(*(F.coalesce(F.col(f"w_{c}"), F.lit(-1.0)) for c in PRICES))
    first = F.coalesce(*(F.when((F.col(f"w_{c}") == bar), F.struct(F.lit(c).alias("name"), F.col(f"w_{c}").alias("by"), F.col(f"u_{c}").alias("uniform"))) for c in PRICES))
    counted = rows.groupBy(*keys).agg(
        F.count_if(F.col("n_old") > 0).alias("n_stored"), F.count_if("both").alias("n_shared"), F.sum(F.greatest(F.col("n_new") - 1, F.lit(0))).alias("n_repeated"),
        F.count_if((F.col("n_old") > 0) & (F.col("n_new") == 0)).alias("n_vanished"),
        F.count_if((F.col("n_old") == 0) & F.col("date").between(F.col("lo"), F.col("hi"))).alias("n_appeared"),
        *(worst[c].alias(f"w_{c}") for c in PRICES), *(spread[c].alias(f"u_{c}") for c in PRICES), F.count_if(drift(*pair("volume")) > VOLUME_DRIFT).alias("n_volume"),
    ).where("n_stored >= 2").withColumn("worst", first)
    return counted.select(
        *keys, "n_shared", "n_repeated", "n_vanished", "n_appeared", F.col("worst.name").alias("worst_column"), F.col("worst.by").alias("worst_drift"),
        F.coalesce("worst.uniform", F.lit(False)).alias("uniform"), "n_volume",
    )


def consistency_violations(rows: DataFrame, group: str, source: Column, series: Column) -> DataFrame:
    """Violations of what self_consistency has found."""
    moved = F.col("worst_column").isNotNull()
    kind = F.when(F.col("uniform"), " by one ratio, as after a corporate action").otherwise(", history was revised")
    shape = lambda cond, severity, text: violation(rows.where(cond), group, "self_consistency", severity, text, source, series)
    return union_all(
        [
            shape("n_repeated > 0", "error", _n(F.col("n_repeated"), "repeated dates in the re-fetch")),
            shape("n_vanished > 0", "error", _n(F.col("n_vanished"), "stored dates vanished")),
            shape("n_appeared > 0", "warn", _n(F.col("n_appeared"), "dates appeared inside the stored window")),
            shape(moved, F.when(F.col("uniform"), "warn").otherwise("error"), F.concat(F.lit("settled "), F.col("worst_column"), F.lit(" values changed"), kind)),
            shape("n_volume > 0", "warn", _n(F.col("n_volume"), "settled volumes changed")),
        ]
    )


def series_consistency(stored: DataFrame, again: DataFrame, keys: list[str], arrival: str | None = None) -> DataFrame:
    """What a re-fetch changes in stored, settled observations (keys, metric, date, value), a row a series.

    keys, n_repeated, n_vanished and n_appeared (dates of any metric, as for bars), lost and
    gained (names of metrics), worst_metric, n_revised and largest (of the metric with the
    largest absolute change beyond tolerance), n_more (other revised metrics), n_compared.
    A lone null metric is the metric ``value``.  Of repeated dates the last by ``arrival``
    counts; without it the largest value does.
    """
    order = F.col(arrival) if arrival else F.lit(0)
    side = lambda df, fresh: df.select(*keys, F.coalesce("metric", F.lit("value")).alias("metric"), "date", F.col("value").cast("double").alias("value"), F.lit(fresh).alias("fresh"), (order if fresh else F.lit(0)).cast("bigint").alias("at"))
    rows = side(stored, False).unionByName(side(again, True)).repartition(*keys)
    old, new = ~F.col("fresh"), F.col("fresh")
    last = lambda which: F.max_by(F.struct("value"), F.when(which, F.struct(F.lit(1), "at", "value")))["value"]
    cells = rows.groupBy(*keys, "metric", "date").agg(F.count_if(old).alias("n_old"), F.count_if(new).alias("n_new"), last(old).alias("old"), last(new).alias("new"))
    compared = F.col("old").isNotNull() & F.col("new").isNotNull()
    revised = compared & ~is_close(F.col("old"), F.col("new"))
    metrics = cells.groupBy(*keys, "metric").agg(
        F.count_if(F.col("n_old") > 0).alias("k_old"), F.count_if(F.col("n_new") > 0).alias("k_new"), F.count_if(compared).alias("k"),
        F.count_if(revised).alias("n_revised"), F.max(F.when(revised, F.abs(F.col("old") - F.col("new")))).alias("largest"),
    )
    worst = F.max_by(F.struct("metric", "n_revised", "largest"), F.when(F.col("n_revised") > 0, F.struct("largest", "metric")))
    names = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("metric"))))
    by_series = metrics.groupBy(*keys).agg(
        names((F.col("k_old") > 0) & (F.col("k_new") == 0)).alias("lost"), names((F.col("k_old") == 0) & (F.col("k_new") > 0)).alias("gained"), worst.alias("w"),
        F.count_if(F.col("n_revised") > 0).alias("m"), F.sum("k").alias("n_compared"),
    )
    dates = cells.groupBy(*keys, "date").agg((F.max("n_old") > 0).alias("is_old"), (F.max("n_new") > 0).alias("is_new"), F.max("n_new").alias("n_new"))
    every = Window.partitionBy(*keys)
    stored_date = F.when(F.col("is_old"), F.col("date"))
    dates = dates.withColumns({"lo": F.min(stored_date).over(every), "hi": F.max(stored_date).over(every)}).groupBy(*keys).agg(
        F.count_if("is_old").alias("n_stored"), F.sum(F.greatest(F.col("n_new") - 1, F.lit(0))).alias("n_repeated"),
        F.count_if(F.col("is_old") & ~F.col("is_new")).alias("n_vanished"), F.count_if(~F.col("is_old") & F.col("date").between(F.col("lo"), F.col("hi"))).alias("n_appeared"),
    ).where("n_stored >= 2")
    return dates.join(by_series, keys).select(
        *keys, "n_repeated", "n_vanished", "n_appeared", "lost", "gained", F.col("w.metric").alias("worst_metric"), F.coalesce("w.n_revised", F.lit(0)).alias("n_revised"),
        F.col("w.largest").alias("largest"), F.greatest(F.col("m") - 1, F.lit(0)).alias("n_more"), "n_compared",
    )


def series_consistency_violations(rows: DataFrame, source: Column, series: Column) -> DataFrame:
    """Violations of what series_consistency has found; a revision warns, as agencies revise by design."""
    shape = lambda cond, severity, text: violation(rows.where(cond), "series", "self_consistency", severity, text, source, series)
    other = F.when(F.col("n_more") > 0, F.concat(F.lit(" and "), _n(F.col("n_more"), "more metrics"))).otherwise("")
    quiet = "n_compared = 0 AND n_repeated = 0 AND n_vanished = 0 AND n_appeared = 0 AND size(lost) = 0 AND size(gained) = 0"
    return union_all(
        [
            shape("n_repeated > 0", "error", _n(F.col("n_repeated"), "repeated dates in the re-fetch")),
            shape("n_vanished > 0", "error", _n(F.col("n_vanished"), "stored dates vanished")),
            shape("n_appeared > 0", "warn", _n(F.col("n_appeared"), "dates appeared inside the stored window")),
            shape("size(lost) > 0", "error", F.concat(F.lit("no longer served: "), F.array_join("lost", ", "))),
            shape("size(gained) > 0", "warn", F.concat(F.lit("served but not stored: "), F.array_join("gained", ", "))),
            shape("n_revised > 0", "warn", F.concat(_n(F.col("n_revised"), "settled values of "), F.col("worst_metric"), other, F.lit(" revised"))),
            shape(quiet, "warn", F.lit("no value could be compared")),
        ]
    )


def series_revisions(stored: DataFrame, again: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_revised, n_vanished of long series (date, value); values are compared within tolerance."""
    a = stored.select(*keys, "date", F.col("value").alias("old"), F.lit(True).alias("in_old"))
    b = again.select(*keys, "date", F.col("value").alias("new"), F.lit(True).alias("in_new"))
    rows = a.join(b, [*keys, "date"], "full_outer")
    revised = F.col("old").isNotNull() & F.col("new").isNotNull() & ~is_close(F.col("new"), F.col("old"))
    return rows.groupBy(*keys).agg(F.count_if(revised).alias("n_revised"), F.count_if(F.col("in_new").isNull()).alias("n_vanished")).where("n_revised + n_vanished > 0")


def _twelve_digits(x: Column) -> Column:
    """x to twelve significant digits, so that rounding noise of a division makes no ranks."""
    scale = F.pow(F.lit(10.0), 12 - F.ceil(F.log10(F.abs(x))))
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def peer_statistics(bars: DataFrame, ours: str, peers: list[str], keys: list[str]) -> DataFrame:
    """What the decision between our source and each peer needs, a row for each of our series and peer.

    keys, peer, n_ours, n_any (all rows of the peer), n_theirs (those in our span of dates),
    n_shared dates, n_compared (with a difference), median_rel_diff of |a - b| / |b|,
    n_returns and ret_corr over shared dates, trend (Spearman's, of a / b with time; a ratio
    that is constant to twelve digits, as of a scaled copy, has none).  Bars are scanned and shuffled once, by series.
    """
    known = bars.where(F.col("source").isin(ours, *peers)).select(*keys, "date", "source", F.col("close").cast("double").alias("close")).repartition(*keys)
    close = lambda name: F.max(F.when(F.col("source") == name, F.struct("close")))
    wide = known.groupBy(*keys, "date").agg(close(ours).alias("us"), F.array(*(F.struct(F.lit(p).alias("peer"), close(p).alias("them")) for p in peers)).alias("all"))
    own_date, every = F.when(F.col("us").isNotNull(), F.col("date")), Window.partitionBy(*keys)
    rows = wide.withColumns({"lo": F.min(own_date).over(every), "hi": F.max(own_date).over(every)}).where("lo IS NOT NULL").select(*keys, "date", "us", "lo", "hi", F.explode("all").alias("p"))
    rows = rows.select(*keys, "date", F.col("us").isNotNull().alias("is_us"), F.col("p.peer").alias("peer"), F.col("p.them").isNotNull().alias("is_them"), F.col("date").between(F.col("lo"), F.col("hi")).alias("inside"), F.col("us.close").alias("a"), F.col("p.them.close").alias("b"))
    shared = F.col("is_us") & F.col("is_them")
    rows = rows.withColumn("shared", shared).withColumn("ratio", F.when(shared, _twelve_digits(F.try_divide(F.col("a"), F.col("b"))))).withColumn("rated", F.col("ratio").isNotNull())
    by = Window.partitionBy(*keys, "peer", "shared").orderBy("date")
    change = lambda c: F.when(F.col("shared"), F.try_divide(F.col(c), F.lag(c).over(by)) - 1)
    rows = rows.withColumns({"x": change("a"), "y": change("b")})
    place = F.row_number().over(Window.partitionBy(*keys, "peer", "rated").orderBy("date")).cast("double")
    rank = average_rank(Window.partitionBy(*keys, "peer", "rated").orderBy("ratio"), Window.partitionBy(*keys, "peer", "rated", "ratio"))
    rows = rows.withColumns({"t": F.when(F.col("rated"), place), "r": F.when(F.col("rated"), rank)})
    diff = F.when(F.col("shared"), drift(F.col("a"), F.col("b")))
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    return rows.groupBy(*keys, "peer").agg(
        F.count_if("is_us").alias("n_ours"), F.count_if("is_them").alias("n_any"), F.count_if(F.col("is_them") & F.col("inside")).alias("n_theirs"), F.count_if("shared").alias("n_shared"),
        F.count(diff).alias("n_compared"), F.median(diff).alias("median_rel_diff"), F.count_if(both).alias("n_returns"),
        F.when(F.count_if(both) >= DATES_LEAST - 1, correlation(F.col("x"), F.col("y"))).alias("ret_corr"), F.when(F.count("t") >= 3, correlation(F.col("r"), F.col("t"))).alias("trend"),
    )


def peer_outcome() -> Column:
    """What one peer says, of a row of peer_statistics.

    Thin coverage is ``short``.  A large median difference between alike returns is a
    ``drift`` if the ratio trends one way, ``inconclusive`` if it has a trend but few dates;
    any other large difference is ``apart``.  A small one with unlike returns is
    ``unlike_returns``.  ``unreachable``: nothing to compare; ``none``: not a peer.
    """
    apart, alike = F.col("median_rel_diff") > MEDIAN_DIFF, F.col("ret_corr") >= RETURN_CORR
    return (
        F.when(F.col("n_any") == 0, "none")
        .when(F.col("n_theirs") == 0, "unreachable")
        .when(F.col("n_ours") / F.nullif(F.col("n_theirs"), F.lit(0)) < COVERAGE, "short")
        .when((F.col("n_shared") == 0) | (F.col("n_compared") == 0), "unreachable")
        .when(apart & alike & (F.abs(F.col("trend")) >= ONE_WAY_TREND), "drift")
        .when(apart & alike & F.col("trend").isNotNull() & (F.col("n_shared") < SHARED_LEAST), "inconclusive")
        .when(apart, "apart")
        .when((F.col("n_shared") >= DATES_LEAST) & (F.col("ret_corr") < RETURN_CORR), "unlike_returns")
        .otherwise("agree")
    )


#: Severity of each verdict; agreement has none.
VERDICTS = {
    "agree": None, "no_peer": "warn", "drift": "warn", "inconclusive": "warn", "unlike_returns": "error", "outvoted": "error", "peer_outlier": "warn",
    "unsettled": "error", "coverage_disputed": "warn", "dropping": "error", "short": "warn", "unreachable": "warn",
}


def cross_source(stats: DataFrame, keys: list[str]) -> DataFrame:
    """keys, verdict, severity, peer, others: what all peers together say, a row for each of our series.

    Peers are asked in the order of their names, and the first that can be compared
    decides.  If it is apart from us, the first other one that shares dates settles it: we
    are ``outvoted`` if that is apart from us too, else the peer is the outlier; without
    one it is ``unsettled``.  Peers that came before and have far more rows dispute an
    agreement; if none could be compared, two of them convict us of dropping rows.
    """
    said = stats.withColumn("said", peer_outcome())
    decides = F.col("said").isin("drift", "inconclusive", "apart", "unlike_returns", "agree")
    names = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("peer"))))
    shares = F.when(F.col("n_shared") > 0, F.struct("peer", (F.col("median_rel_diff") > MEDIAN_DIFF).alias("apart")))
    rows = said.groupBy(*keys).agg(
        F.count_if(F.col("said") != "none").alias("n_peers"), F.min_by(F.struct("peer", "said"), F.when(decides, F.col("peer"))).alias("first"),
        names(F.col("said") == "short").alias("short"), names(F.col("said") == "unreachable").alias("lost"), F.array_sort(F.collect_list(shares)).alias("shares"),
    )
    third = F.filter("shares", lambda s: s["peer"] != F.col("first.peer"))
    before = F.filter("short", lambda p: p < F.col("first.peer"))
    rows = rows.withColumns({"third": F.get(third, F.lit(0)), "before": before})
    first = F.col("first.said")
    verdict = (
        F.when(F.col("n_peers") == 0, "no_peer")
        .when((first == "apart") & F.col("third").isNull(), "unsettled")
        .when((first == "apart") & F.col("third.apart"), "outvoted")
        .when(first == "apart", "peer_outlier")
        .when((first == "agree") & (F.size("before") > 0), "coverage_disputed")
        .when(first.isNotNull(), first)
        .when(F.size("short") > 1, "dropping")
        .when(F.size("short") == 1, "short")
        .otherwise("unreachable")
    )
    others = F.when(verdict.isin("outvoted", "peer_outlier"), F.array("third.peer")).when(verdict == "coverage_disputed", F.col("before")).when(verdict.isin("dropping", "short"), F.col("short")).when(verdict == "unreachable", F.col("lost"))
    severity = F.try_element_at(F.create_map(*(F.lit(x) for kv in VERDICTS.items() if kv[1] for x in kv)), verdict)
    return rows.select(*keys, verdict.alias("verdict"), severity.alias("severity"), F.col("first.peer").alias("peer"), F.coalesce(F.array_join(others, ", "), F.lit("")).alias("others"))


def cross_source_violations(bars: DataFrame, ours: str, peers: list[str], keys: list[str], series: str = "symbol") -> DataFrame:
    """Violations of our source's series against its peers; one that agrees has none."""
    texts = {
        "no_peer": F.lit("no other source has it"), "drift": F.concat(F.lit("levels apart from "), F.col("peer"), F.lit(", moves alike, the ratio drifts one way")),
        "inconclusive": F.concat(F.lit("levels apart from "), F.col("peer"), F.lit(", moves alike, too few dates to tell a drift")),
        "unlike_returns": F.concat(F.lit("levels match "), F.col("peer"), F.lit(", moves do not")), "outvoted": F.concat_ws(" ", F.lit("apart from"), "peer", F.lit("and from"), "others"),
        "peer_outlier": F.concat_ws(" ", F.lit("apart from"), "peer", F.lit("but matches"), "others"), "unsettled": F.concat(F.lit("apart from "), F.col("peer"), F.lit(", no third source")),
        "coverage_disputed": F.concat_ws(" ", F.lit("matches"), "peer", F.lit("but has far fewer rows than"), "others"), "dropping": F.concat(F.lit("far fewer rows than "), F.col("others")),
        "short": F.concat(F.lit("far fewer rows than "), F.col("others")), "unreachable": F.concat(F.lit("nothing to compare with "), F.col("others")),
    }
    detail = F.coalesce(*(F.when(F.col("verdict") == k, t) for k, t in texts.items()))
    rows = cross_source(peer_statistics(bars, ours, peers, keys), keys).where("severity IS NOT NULL")
    return violation(rows, "bars", "cross_source", F.col("severity"), detail, F.lit(ours), F.col(series))


def adjudicate(bars: DataFrame, ours: str, peer: str, third: str, keys: list[str]) -> DataFrame:
    """keys, severity where we and a peer are apart: error if a third source is apart from us too, else warn."""
    stats = peer_statistics(bars, ours, [third], keys).where("n_shared > 0")
    return stats.select(*keys, F.when(F.col("median_rel_diff") > MEDIAN_DIFF, "error").otherwise("warn").alias("severity"))


def proxies(pairs: DataFrame, keys: list[str], window: int = PROXY_WINDOW, least: int = PROXY_LEAST) -> DataFrame:
    """keys, baseline, floor, current, state of return pairs (x, y) by date.

    The baseline and the lowest rolling correlation leave the latest window out.  A pair
    with a low baseline is unrelated; a current correlation that cannot be computed is
    frozen, one under min(0.30, the lowest seen) is broken.
    """
    rows = split_recent(pairs.where("x IS NOT NULL AND y IS NOT NULL"), keys, window)
    past = rows.where(~F.col("recent"))
    base = past.groupBy(*keys).agg(F.count("*").alias("n_past"), correlation(F.col("x"), F.col("y")).alias("baseline"))
    low = rolling_correlation(past, keys, window).groupBy(*keys).agg(F.min("corr").alias("lowest"))
    now = rows.where("recent").groupBy(*keys).agg(correlation(F.col("x"), F.col("y")).alias("current"))
    out = base.where(F.col("n_past") >= least).join(low, keys, "left").join(now, keys)
    floor = F.least(F.lit(PROXY_FLOOR), F.coalesce("lowest", F.lit(PROXY_FLOOR)))
    state = F.when(F.col("baseline").isNull() | (F.col("baseline") < PROXY_BASELINE), "unrelated").when(F.col("current").isNull(), "frozen").when(F.col("current") < floor, "broken").otherwise("holds")
    return out.select(*keys, "baseline", floor.alias("floor"), "current", state.alias("state"))


def strongest_proxy(states: DataFrame, key: str, other: str) -> DataFrame:
    """key, other, baseline of the related instrument with the highest baseline, the first name of equals."""
    rows = states.where(F.col("state") != "unrelated")
    return rows.groupBy(key).agg(F.max("baseline").alias("baseline"), F.min_by(other, F.struct(-F.col("baseline"), F.col(other))).alias(other)).select(key, other, "baseline")


def proxy_verdicts(states: DataFrame, key: str, own: DataFrame | None = None, today: Column | None = None) -> DataFrame:
    """key, verdict: holds if any related instrument does, else the state of the most related one.

    ``proxy_unavailable`` without related instruments.  own: key, n_returns, newest of all
    series under check; with it, a series of too few returns, or one whose newest date is
    older than 14 days, is unavailable whatever its pairs say.
    """
    related = F.col("state") != "unrelated"
    strength = F.col("baseline") if "baseline" in states.columns else F.lit(0.0)
    rows = states.groupBy(key).agg(
        F.count_if(related).alias("n"), F.count_if(F.col("state") == "holds").alias("h"), F.max_by("state", F.when(related, F.struct(strength, "state"))).alias("s")
    )
    if own is not None:
        rows = own.select(key, "n_returns", "newest").join(rows, key, "left")
    verdict = F.when(F.coalesce("n", F.lit(0)) == 0, "proxy_unavailable").when(F.col("h") > 0, "holds").otherwise(F.col("s"))
    if own is not None:
        stale = (F.datediff(today, "newest") > PROXY_STALE_DAYS) if today is not None else F.lit(False)
        verdict = F.when((F.col("n_returns") < PROXY_LEAST) | stale, "proxy_unavailable").otherwise(verdict)
    return rows.select(key, verdict.alias("verdict"))


def proxy_violations(verdicts: DataFrame, key: str, source: Column) -> DataFrame:
    """Violations of proxy verdicts: a frozen feed is an error, a broken relation a warning, none at all its own warning."""
    bad = verdicts.where("verdict IN ('frozen', 'broken')")
    severity = F.when(F.col("verdict") == "frozen", "error").otherwise("warn")
    text = F.when(F.col("verdict") == "frozen", "no variance against its most related instrument").otherwise("stopped following every related instrument")
    none = verdicts.where("verdict = 'proxy_unavailable'")
    return union_all([violation(bad, "bars", "proxy", severity, text, source, F.col(key)), violation(none, "bars", "proxy_unavailable", "warn", F.lit("no proxy verdict is possible"), source, F.col(key))])


def verification_level(stored: DataFrame, related: DataFrame) -> DataFrame:
    """source, symbol, n_peers, level: corroborated by another source, by a proxy only, or by itself.

    stored: source, symbol pairs; related: symbols that have a proxy.
    """
    own = stored.select("source", "symbol").distinct()
    peers = own.groupBy("symbol").agg((F.count("source") - 1).alias("n_peers"))  # a row for each symbol
    linked = related.select("symbol").distinct().withColumn("has_proxy", F.lit(True))
    rows = own.join(peers, "symbol", "left").join(linked, "symbol", "left")
    n = F.greatest(F.coalesce("n_peers", F.lit(0)), F.lit(0)).cast("bigint")
    level = F.when(n > 0, "corroborated").when(F.col("has_proxy"), "proxy_only").otherwise("self_only")
    return rows.select("source", "symbol", n.alias("n_peers"), level.alias("level"))


def weakest_level(levels: DataFrame) -> DataFrame:
    """source, weakest level and how many series have each."""
    order = F.when(F.col("level") == "self_only", 0).when(F.col("level") == "proxy_only", 1).otherwise(2)
    return levels.groupBy("source").agg(
        F.min_by("level", order).alias("weakest"), *(F.count_if(F.col("level") == k).alias(f"n_{k}") for k in ("self_only", "proxy_only", "corroborated"))
    )
