"""Column helpers with defined nulls where Spark's own functions raise or keep them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

_NUMBER = r"^\s*[-+]?(\d+\.?\d*([eE][-+]?\d+)?|\.\d+([eE][-+]?\d+)?|[Nn]a[Nn]|[Ii]nf(inity)?)\s*$"


def to_double(text: Column) -> Column:
    """A tolerant parse: digits, exponents, NaN and Infinity; anything else is null.

    Spark alone would read '1d' and '1f' as numbers.
    """
    return F.when(text.cast("string").rlike(_NUMBER), text.cast("string").try_cast("double"))


def last_of(value: Column, *order: Column) -> Column:
    """Aggregate: the value of the highest order among rows whose value is not null."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))


def first_of(value: Column, *order: Column) -> Column:
    """Aggregate: the value of the lowest order among rows whose value is not null."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))


def correlation(x: Column, y: Column, over: WindowSpec | None = None) -> Column:
    """Pearson's correlation; null for a constant side or fewer than two rows, never an error."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    parts = [F.covar_samp(x, y), F.stddev_samp(x), F.stddev_samp(y)]
    cov, sx, sy = [p.over(over) for p in parts] if over is not None else parts
    return F.try_divide(cov, F.nullif(sx * sy, F.lit(0.0)))


def average_rank(order: WindowSpec, ties: WindowSpec) -> Column:
    """Ranks in which equal values share the mean of their places."""
    return F.rank().over(order) + (F.count("*").over(ties) - 1) / F.lit(2.0)


def is_close(a: Column, b: Column, rtol: float = 1e-6, atol: float = 1e-9) -> Column:
    """|a - b| <= atol + rtol |b|."""
    return F.abs(a - b) <= F.lit(atol) + F.lit(rtol) * F.abs(b)


def relative_difference(a: Column, b: Column) -> Column:
    """|a - b| / |b|, null where b is 0."""
    return F.try_divide(F.abs(a - b), F.abs(b))


def drift(before: Column, after: Column) -> Column:
    """|before - after| / |after|: infinite where after is 0 and before is not, null where both are."""
    return F.when((after == 0) & (before != 0), F.lit(float("inf"))).otherwise(F.try_divide(F.abs(before - after), F.abs(after)))


def simple_return(price: Column, before: Column) -> Column:
    return F.try_divide(price, before) - 1


def log_return(price: Column, before: Column) -> Column:
    """ln of the ratio; null unless both prices are above 0."""
    return F.when((price > 0) & (before > 0), F.ln(price / before))


def true_range(high: Column, low: Column, before: Column) -> Column:
    """Largest of the day's range and the gaps to the close before; the range alone on a first row."""
    return F.greatest(high - low, F.abs(high - before), F.abs(low - before))


def z_score(value: Column, over: WindowSpec) -> Column:
    """Distance from the window's mean in sample deviations; null where these are 0 or missing."""
    return F.try_divide(value - F.avg(value).over(over), F.nullif(F.stddev_samp(value).over(over), F.lit(0.0)))


def epoch_bucket(ms: Column, width_ms: int) -> Column:
    """Number of the tumbling bucket of a millisecond timestamp."""
    return ((ms - F.pmod(ms, F.lit(width_ms))) / F.lit(width_ms)).cast("long")


def seconds_of(ts: Column) -> Column:
    """Whole seconds since the epoch of a timestamp with or without zone."""
    return F.unix_timestamp(ts.cast("timestamp"))
