"""The lake's groups, made from the driver's tables, in Spark and in DuckDB SQL.

bars: line items by return flag (source), supplier (symbol) and ship day.  obs, series:
orders by priority and day, with metrics and a flat total.  prints: an order's line items
as successive revisions.  quotes and trades: user events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HOUR_MS = 3_600_000
#: About as many rows of both tables as a task of a large join takes, so that its sorts do not grow with the tables.
TASK_ROWS = 400_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    price = "l_extendedprice"
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("source"), (F.col("l_suppkey") % 10).cast("string").alias("symbol"), F.col("l_shipdate").cast("date").alias("date"))
    return rows.agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.sum("l_quantity").alias("volume"))


BARS = """bars AS (
    SELECT l_returnflag AS source, CAST(l_suppkey % 10 AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
           arg_min(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low,
           arg_max(l_extendedprice, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice)) AS close, sum(l_quantity) AS volume
    FROM lineitem GROUP BY 1, 2, 3
)"""


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").groupBy(F.lit("orders").alias("source"), F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").alias("date"))
    return rows.agg(F.count("*").cast("double").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


OBS = """obs AS (
    SELECT 'orders' AS source, o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS n_orders, round(sum(o_totalprice), 2) AS revenue
    FROM orders GROUP BY 1, 2, 3
)"""


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "orders").groupBy(F.lit("orders").alias("source"), F.lit("ALL").alias("series_id"), F.col("o_orderdate").cast("date").alias("date"))
    return rows.agg(F.count("*").cast("double").alias("value"))


FLAT = """flat AS (
    SELECT 'orders' AS source, 'ALL' AS series_id, CAST(o_orderdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2, 3
)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = obs(spark, sf_dir).unpivot(["source", "series_id", "date"], ["n_orders", "revenue"], "metric", "value")
    return flat(spark, sf_dir).unionByName(long, allowMissingColumns=True).select("source", "series_id", "metric", "date", "value")


SERIES = f"""{OBS}, {FLAT}, series AS (
    SELECT source, series_id, NULL AS metric, date, value FROM flat
    UNION ALL SELECT source, series_id, 'n_orders', date, n_orders FROM obs UNION ALL SELECT source, series_id, 'revenue', date, revenue FROM obs
)"""


def prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, items = read(spark, sf_dir, "orders"), read(spark, sf_dir, "lineitem")
    tasks = max(spark.sparkContext.defaultParallelism, -(-(orders.count() + items.count()) // TASK_ROWS))  # counts of files' footers
    orders, items = orders.repartition(tasks, "o_orderkey"), items.repartition(tasks, "l_orderkey")
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey)
    by = Window.partitionBy("l_orderkey").orderBy("l_shipdate", "l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey", "l_quantity")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    return rows.select(
        F.concat_ws(":", F.col("o_orderkey").cast("string"), day).alias("event_id"), F.col("o_orderkey").cast("string").alias("series_id"), F.col("o_orderpriority").alias("calendar"),
        F.col("o_orderdate").alias("scheduled_ts"), F.col("l_shipdate").alias("observed_ts"), F.col("l_extendedprice").alias("actual"), (F.row_number().over(by) - 1).alias("revision_seq"), F.lit("orders").alias("source"),
    )


PRINTS = """prints AS (
    SELECT CAST(o_orderkey AS VARCHAR) || ':' || strftime(o_orderdate, '%Y-%m-%d') AS event_id, CAST(o_orderkey AS VARCHAR) AS series_id, o_orderpriority AS calendar, o_orderdate AS scheduled_ts,
           l_shipdate AS observed_ts, l_extendedprice AS actual, CAST(row_number() OVER (PARTITION BY o_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_extendedprice, l_suppkey, l_quantity) - 1 AS INTEGER) AS revision_seq,
           'orders' AS source
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def quotes(spark: SparkSession, sf_dir: str, nearest: bool = True) -> DataFrame:
    """nearest: received_at is the nearest millisecond, halves away from zero, as DuckDB's epoch_ms gives it; else the last one begun."""
    at = F.col("ts").cast("timestamp")
    ms = F.unix_millis(F.timestamp_micros(F.round(F.unix_micros(at), -3)) if nearest else at)
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("source"), F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")).alias("symbol"), ms.alias("received_at"), F.col("event_id").alias("update_id"), F.col("value").alias("mid"), F.to_date("ts").alias("date"), "props"
    )


QUOTES = """quotes AS (
    SELECT event_type AS source, 'S' || CAST(user_id % 3 AS VARCHAR) AS symbol, epoch_ms(ts) AS received_at, event_id AS update_id, value AS mid, CAST(ts AS DATE) AS date, props FROM events
)"""
