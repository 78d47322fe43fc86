"""Vendor payloads to bronze rows: parsing alone, no transport.

Each function takes a table of raw response bodies (column body, one JSON or CSV text a
row, and symbol or series_id where the body doesn't say) and returns rows of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.columns import to_double

_OHLCV = ("open", "high", "low", "close", "volume")


def _bars(df: DataFrame, date: Column, values: list[Column], *keep: str) -> DataFrame:
    return df.select(*keep, date.alias("date"), *(v.alias(n) for n, v in zip(_OHLCV, values)))


def _rows(raw: DataFrame, kind: str, path: Column | None = None) -> DataFrame:
    return raw.withColumn("r", F.explode(F.from_json(path if path is not None else F.col("body"), kind)))


def keep_last(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the one of the highest order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return rows.withColumn("__place", place).where("__place = 1").drop("__place")


def positional_klines(raw: DataFrame) -> DataFrame:
    """Klines as arrays: open time in ms, then open, high, low, close, volume as text."""
    r = _rows(raw, "array<array<string>>")
    return _bars(r, F.timestamp_millis(F.col("r")[0].cast("bigint")), [to_double(F.col("r")[i]) for i in range(1, 6)], "symbol")


def pair_ohlc(raw: DataFrame) -> DataFrame:
    """Bars under the one key of ``result`` that isn't ``last``; times in seconds; of equal dates the last stays."""
    result = F.from_json(F.get_json_object("body", "$.result"), "map<string,string>")
    pair = F.filter(F.map_keys(result), lambda k: k != "last")[0]
    r = raw.select("symbol", F.posexplode(F.from_json(F.element_at(result, pair), "array<array<string>>")).alias("at", "r"))
    date = F.timestamp_seconds(F.col("r")[0].cast("bigint"))
    rows = _bars(r, date, [to_double(F.col("r")[i]) for i in (1, 2, 3, 4, 6)], "symbol", "at")
    return keep_last(rows, ["symbol", "date"], "at").drop("at")


def unified_ohlcv(raw: DataFrame) -> DataFrame:
    """Bars as arrays of numbers, times in ms; of equal times the last stays."""
    r = raw.select("symbol", F.posexplode(F.from_json("body", "array<array<string>>")).alias("at", "r"))
    rows = _bars(r, F.timestamp_millis(F.col("r")[0].cast("bigint")), [to_double(F.col("r")[i]) for i in range(1, 6)], "symbol", "at")
    return keep_last(rows, ["symbol", "date"], "at").drop("at")


def adjusted_eod(raw: DataFrame) -> DataFrame:
    """End-of-day records of which the adjusted columns are used; a date that isn't one raises."""
    names = ("adjOpen", "adjHigh", "adjLow", "adjClose", "adjVolume")
    r = _rows(raw, f"array<struct<date: string, {', '.join(f'{n}: string' for n in names)}>>")
    return _bars(r, F.col("r.date").cast("timestamp"), [to_double(F.col(f"r.{n}")) for n in names], "symbol")


def titled_columns(frame: DataFrame) -> DataFrame:
    """A frame with capitalised columns, Date in any zone, as bars in UTC."""
    lower = frame.toDF(*(c.lower() for c in frame.columns))
    return _bars(lower, F.col("date").cast("timestamp"), [F.col(c).cast("double") for c in _OHLCV], "symbol")


def observations(raw: DataFrame) -> DataFrame:
    """Dated values; a value that is no number, such as ``.``, is null and its row stays."""
    r = _rows(raw, "array<struct<date: string, value: string>>", F.get_json_object("body", "$.observations"))
    return r.select("series_id", F.col("r.date").cast("timestamp").alias("date"), to_double(F.col("r.value")).alias("value"))


def csv_last_column(lines: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Lines (series_id, line) of a CSV: the first column is the date (month/day/year), the last the value."""
    cells = F.split("line", ",")
    date = F.try_to_timestamp(F.trim(cells[0]), F.lit("MM/dd/yyyy"))
    rows = lines.select("series_id", date.alias("date"), to_double(F.trim(F.element_at(cells, -1))).alias("value")).where("date IS NOT NULL")
    if start:
        rows = rows.where(F.col("date") >= F.lit(start).cast("timestamp"))
    return rows.where(F.col("date") <= F.lit(end).cast("timestamp")) if end else rows


def renamed_metrics(raw: DataFrame, date_field: str, names: dict[str, str]) -> DataFrame:
    """Records of many fields as a wide series: fields renamed to metrics, absent ones null."""
    r = _rows(raw, "array<map<string,string>>")
    field = lambda n: F.try_element_at(F.col("r"), F.lit(n))
    return r.select("series_id", field(date_field).cast("timestamp").alias("date"), *(to_double(field(a)).alias(b) for a, b in names.items()))


def funding(raw: DataFrame) -> DataFrame:
    """Funding records as a wide series of funding_rate and mark_price; an empty text is null."""
    r = _rows(raw, "array<struct<fundingTime: bigint, fundingRate: string, markPrice: string>>")
    return r.select("symbol", F.timestamp_millis("r.fundingTime").alias("date"), to_double(F.col("r.fundingRate")).alias("funding_rate"), to_double(F.col("r.markPrice")).alias("mark_price"))


def events_from_vintages(vintages: DataFrame) -> DataFrame:
    """Vintages (series_id, ref_date, realtime_start, value) as bitemporal events.

    A release's revisions are numbered in the order they became known; its schedule is the
    first of them; previous is the initial print of the period before.  Values that are
    null are no print.
    """
    prints = vintages.where(F.col("value").isNotNull())
    of = Window.partitionBy("series_id", "ref_date")
    rows = prints.withColumn("revision_seq", (F.row_number().over(of.orderBy("realtime_start", "value")) - 1).cast("int")).withColumn("scheduled_ts", F.min("realtime_start").over(of))
    initial = rows.where("revision_seq = 0").select("series_id", "ref_date", F.lag("value").over(Window.partitionBy("series_id").orderBy("ref_date")).alias("previous"))
    event = F.concat_ws(":", "series_id", F.date_format("ref_date", "yyyy-MM-dd"))
    return rows.join(initial, ["series_id", "ref_date"], "left").select(
        event.alias("event_id"), "series_id", "scheduled_ts", F.col("realtime_start").alias("observed_ts"), F.col("value").alias("actual"), "previous", "revision_seq"
    )
