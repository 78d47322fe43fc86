"""Two venues' mids on one gap-free grid: alignment, basis, lead and lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.functions.columns import correlation, epoch_bucket, last_of, to_double

DAY_MS = 86_400_000


def mids(ticks: DataFrame) -> DataFrame:
    """source, symbol, received_at, update_id, mid of top-of-book ticks with text prices."""
    mid = (to_double(F.col("bid_price")) + to_double(F.col("ask_price"))) / 2
    return ticks.select("source", "symbol", "received_at", "update_id", mid.alias("mid"))


def mids_by_bucket(quotes: DataFrame, width_ms: int, keys: list[str]) -> DataFrame:
    """The last non-null mid of each source and bucket; equal arrivals are told apart by update_id.

    Collapsed before anything is pivoted or sorted, so only one row a bucket is shuffled on.
    """
    rows = quotes.withColumn("bucket", epoch_bucket(F.col("received_at"), width_ms))
    return rows.groupBy(*keys, "source", "bucket").agg(last_of(F.col("mid"), F.col("received_at"), F.col("update_id")).alias("mid"))


#: Buckets that one task fills at a time; a day of seconds.
BLOCK = 86_400


def forward_filled(wide: DataFrame, keys: list[str]) -> DataFrame:
    """keys, bucket, base_mid, quote_mid for every bucket in which both venues have been seen.

    wide: keys, bucket, base_mid, quote_mid with gaps.  The grid runs from the later of the
    first values to the earlier of the last; a gap takes the value before it.  It is filled
    in blocks of BLOCK buckets; what a block starts with comes from the blocks before it, a
    table of one row a block.
    """
    mids_ = ("base_mid", "quote_mid")
    seen = lambda c: F.when(F.col(c).isNotNull(), F.col("bucket"))
    wide = wide.withColumn("block", F.floor(F.col("bucket") / F.lit(BLOCK)))
    tails = wide.groupBy(*keys, "block").agg(*(F.max_by(c, seen(c)).alias(f"last_{c}") for c in mids_), *(f(seen(c)).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in mids_))
    every = Window.partitionBy(*keys)
    by = every.orderBy("block")
    until = lambda c, end: F.last(f"last_{c}", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, end))
    lo, hi = (g(*(f(f"{f.__name__}_{c}").over(every) for c in mids_)) for g, f in ((F.greatest, F.min), (F.least, F.max)))
    start = F.least(*(F.min(f"min_{c}").over(every) for c in mids_))
    both = (F.count("min_base_mid").over(every) > 0) & (F.count("min_quote_mid").over(every) > 0)
    tails = tails.withColumns({"lo": F.when(both, lo), "hi": hi, "start": start, "next": F.lead("block").over(by), **{f"before_{c}": until(c, -1) for c in mids_}, **{f"upto_{c}": until(c, 0) for c in mids_}}).where("lo <= hi")
    blocks = tails.withColumn("at", F.explode(F.sequence("block", F.greatest(F.col("block"), F.coalesce(F.col("next") - 1, F.col("block"))))))  # those without rows too
    carried = lambda c: F.when(F.col("at") == F.col("block"), F.col(f"before_{c}")).otherwise(F.col(f"upto_{c}")).alias(f"carried_{c}")
    blocks = blocks.select(*keys, F.col("at").alias("block"), "lo", "hi", "start", *map(carried, mids_)).where((F.col("block") * BLOCK <= F.col("hi")) & ((F.col("block") + 1) * BLOCK > F.col("lo")))
    grid = blocks.withColumn("bucket", F.explode(F.sequence(F.greatest(F.col("block") * BLOCK, "start"), F.least((F.col("block") + 1) * BLOCK - 1, F.col("hi")))))
    past = Window.partitionBy(*keys, "block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    filled = lambda c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.col(f"carried_{c}")).alias(c)
    rows = grid.join(wide, [*keys, "block", "bucket"], "left").select(*keys, "bucket", "lo", *map(filled, mids_))
    return rows.where("bucket >= lo").select(*keys, "bucket", *mids_)


def aligned_mids(quotes: DataFrame, base: str, quote: str, width_ms: int = 1000, keys: list[str] | None = None) -> DataFrame:
    """Mids of two venues on a common grid, by symbol (and day, if among the keys)."""
    keys = keys or ["symbol"]
    rows = quotes.where(F.col("source").isin(base, quote))
    if "date" in keys and "date" not in rows.columns:
        rows = rows.withColumn("date", F.to_date(F.timestamp_millis("received_at")))
    last = mids_by_bucket(rows, width_ms, keys)
    wide = last.groupBy(*keys, "bucket").pivot("source", [base, quote]).agg(F.first("mid"))
    return forward_filled(wide.withColumnRenamed(base, "base_mid").withColumnRenamed(quote, "quote_mid"), keys)


def basis_bps(base: Column, quote: Column) -> Column:
    """(quote - base) / base in basis points."""
    return F.try_divide(quote - base, base) * 10_000


def basis_summary(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and share above zero of basis_bps."""
    b = F.col("basis_bps")
    return rows.groupBy(*keys).agg(
        F.count(b).alias("n"), F.avg(b).alias("mean_bps"), F.stddev_samp(b).alias("std_bps"), F.min(b).alias("min_bps"), F.max(b).alias("max_bps"),
        F.avg((b > 0).cast("double")).alias("share_positive"),
    )


def lead_lag(aligned: DataFrame, keys: list[str], max_lag: int = 10, block: int = BLOCK) -> DataFrame:
    """keys, lag, corr, n: correlation of base's log return with quote's, lag buckets later.

    All lags come from one window and one aggregate; a lag over a hole of the grid does not
    count.  The grid is read in blocks of ``block`` buckets (more than max_lag): the mids
    that a block's first return starts from come from a table of one row a block, and rows
    within max_lag of a block's edge are there in the next block too, to be looked at from it.
    """
    rows = aligned.where("bucket IS NOT NULL").select(*keys, "bucket", "base_mid", "quote_mid", F.floor(F.col("bucket") / F.lit(block)).alias("block"))
    by = Window.partitionBy(*keys, "block").orderBy("bucket")
    tails = rows.groupBy(*keys, "block").agg(F.max_by(F.struct("base_mid", "quote_mid"), "bucket").alias("tail"))
    tails = tails.select(*(F.col(k).alias(f"of_{k}") for k in keys), F.col("block").alias("of_block"), F.lag("tail").over(Window.partitionBy(*keys).orderBy("block")).alias("before"))
    first = F.row_number().over(by) == 1
    rows = rows.withColumns({"first": first, "base_past": F.lag("base_mid").over(by), "quote_past": F.lag("quote_mid").over(by)})
    rows = rows.join(tails, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys] + [F.col("block") == F.col("of_block")])
    past = lambda c: F.when(F.col("first"), F.col(f"before.{c}_mid")).otherwise(F.col(f"{c}_past"))
    ret = lambda c: F.when((F.col(f"{c}_mid") > 0) & (past(c) > 0), F.ln(F.col(f"{c}_mid") / past(c)))
    near = F.array_distinct(F.transform(F.array(*(F.col("bucket") + F.lit(k) for k in (-max_lag, 0, max_lag))), lambda b: F.floor(b / F.lit(block))))
    rets = rows.select(*keys, "bucket", "block", ret("base").alias("x"), ret("quote").alias("y"), F.explode(near).alias("at"))
    lags = range(-max_lag, max_lag + 1)
    by = Window.partitionBy(*keys, "at").orderBy("bucket")
    met = {f"y_{k}": F.when(F.lead("bucket", k).over(by) == F.col("bucket") + k, F.lead("y", k).over(by)) for k in lags}
    rows = rets.select(*keys, "x", "block", "at", *(v.alias(n) for n, v in met.items())).where(F.col("block") == F.col("at"))
    both = lambda k: F.count_if(F.col("x").isNotNull() & F.col(f"y_{k}").isNotNull())
    sums = rows.groupBy(*keys).agg(*(F.struct(F.lit(k).alias("lag"), correlation(F.col("x"), F.col(f"y_{k}")).alias("corr"), both(k).alias("n")).alias(f"l_{k}") for k in lags))
    return sums.select(*keys, F.explode(F.array(*(F.col(f"l_{k}") for k in lags))).alias("l")).select(*keys, "l.lag", "l.corr", "l.n").where("n > 0")


def peak_lag(lags: DataFrame, keys: list[str], width_ms: int) -> DataFrame:
    """The lag of the highest correlation (the least of equals) and which venue leads."""
    best = lags.where("corr IS NOT NULL").groupBy(*keys).agg(F.max_by(F.struct("lag", "corr"), F.struct("corr", -F.col("lag"))).alias("b"))
    lag = F.col("b.lag")
    leader = F.when(lag > 0, "base").when(lag < 0, "quote").otherwise("simultaneous")
    return best.select(*keys, lag.alias("lag"), (lag * width_ms).cast("bigint").alias("lag_ms"), F.round("b.corr", 4).alias("corr"), leader.alias("leader"))


def cross_venue_report(quotes: DataFrame, base: str, quote: str, width_ms: int = 1000, max_lag: int = 10) -> DataFrame:
    """Basis summary and leader of each symbol."""
    rows = aligned_mids(quotes, base, quote, width_ms)
    summary = basis_summary(rows.withColumn("basis_bps", basis_bps(F.col("base_mid"), F.col("quote_mid"))), ["symbol"])
    return summary.join(peak_lag(lead_lag(rows, ["symbol"], max_lag), ["symbol"], width_ms), "symbol", "left")


def basis_self_join(bars: DataFrame, base: str, quote: str) -> DataFrame:
    """Closes of two sources on the same day and symbol, and their basis to a tenth of a point."""
    b = bars.where(F.col("source") == base).select("date", "symbol", F.col("close").alias("base_close"))
    c = bars.where(F.col("source") == quote).select("date", "symbol", F.col("close").alias("quote_close"))
    return b.join(c, ["date", "symbol"]).withColumn("bps", F.round(F.try_divide(F.col("quote_close"), F.col("base_close")) * 10_000 - 10_000, 1))
