"""The marts: daily bars, series features, event revisions, venue basis, the source dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.columns import first_of, last_of, log_return, simple_return, true_range, z_score
from tidelake.operators.align import aligned_mids, basis_bps

_DAY_SECONDS = 86_400


def bars_daily(bars: DataFrame) -> DataFrame:
    """Returns, ranges, volatility and volume scores of daily bars.

    All frames are of rows in date order within a source and symbol; one shuffle serves
    all of them.  Short frames at a series' start are used as they are.
    """
    by = Window.partitionBy("source", "symbol").orderBy("date")
    back = lambda n: by.rowsBetween(-(n - 1), 0)
    before = F.col("prev_close")
    rows = bars.withColumn("prev_close", F.lag("close").over(by))
    rows = rows.withColumns({"ret_simple": simple_return(F.col("close"), before), "ret_log": log_return(F.col("close"), before), "true_range": true_range(F.col("high"), F.col("low"), before)})
    return rows.withColumns(
        {
            "atr_14": F.avg("true_range").over(back(14)),
            "realized_vol_20d": F.stddev_samp("ret_log").over(back(20)),
            "realized_vol_30d": F.stddev_samp("ret_log").over(back(30)),
            "volume_z_30d": z_score(F.col("volume"), back(30)),
        }
    )


def series_features(series: DataFrame) -> DataFrame:
    """Change, relative change, and the change's z-score against the 12 observations before it."""
    by = Window.partitionBy("source", "series_id", "metric").orderBy("date")
    past = by.rowsBetween(-12, -1)
    rows = series.withColumn("prev_value", F.lag("value").over(by)).withColumn("change", F.col("value") - F.col("prev_value"))
    rows = rows.withColumn("change_pct", F.try_divide(F.col("change"), F.nullif(F.col("prev_value"), F.lit(0.0))))
    spread = F.nullif(F.stddev_samp("change").over(past), F.lit(0.0))
    return rows.withColumn("change_z_12obs", F.try_divide(F.col("change") - F.avg("change").over(past), spread))


def events_revisions(events: DataFrame) -> DataFrame:
    """One row for each event: first and latest value, when they were observed, how often and how far it was revised."""
    seq = F.col("revision_seq")
    rows = events.groupBy("source", "calendar", "series_id", "event_id", "reference_date").agg(
        F.min("scheduled_ts").alias("scheduled_ts"), first_of(F.col("actual"), seq).alias("initial_value"), last_of(F.col("actual"), seq).alias("latest_value"),
        F.min("observed_ts").alias("initial_observed_ts"), F.max("observed_ts").alias("latest_observed_ts"), F.max("revision_seq").cast("bigint").alias("n_revisions"),
    )
    moved = F.col("latest_value") - F.col("initial_value")
    return rows.withColumns(
        {
            "total_revision": moved,
            "revision_pct": F.try_divide(moved, F.nullif(F.col("initial_value"), F.lit(0.0))),
            "days_to_latest": F.datediff("latest_observed_ts", "initial_observed_ts").cast("bigint"),
        }
    )


def cross_venue_basis(quotes: DataFrame, base: str, quote: str, width_ms: int = 1000) -> DataFrame:
    """Aligned mids of two venues by symbol and day, their basis, and how much of the day is covered."""
    rows = aligned_mids(quotes, base, quote, width_ms, ["symbol", "date"])
    day = F.count("*").over(Window.partitionBy("symbol", "date"))
    covered = F.round(F.lit(100.0) * day / F.lit(_DAY_SECONDS * 1000 / width_ms), 2)
    return rows.withColumns({"basis_bps": basis_bps(F.col("base_mid"), F.col("quote_mid")), "day_buckets": day, "day_coverage_pct": covered})


def dim_sources(registry: DataFrame) -> DataFrame:
    """The source dimension, a row for each registered source and group."""
    return registry.orderBy("group", "name")
