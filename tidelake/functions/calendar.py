"""An exchange's calendar as column expressions: holiday rules by year, observed days, Easter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Days on which the New York exchange was closed outside its rules.
CLOSED = {
    "1994-04-27": "mourning", "2001-09-11": "attack", "2001-09-12": "attack", "2001-09-13": "attack", "2001-09-14": "attack", "2004-06-11": "mourning", "2007-01-02": "mourning",
    "2012-10-29": "storm", "2012-10-30": "storm", "2018-12-05": "mourning", "2025-01-09": "mourning",
}
MONDAY, THURSDAY, FRIDAY = 0, 3, 4


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The n-th Monday (0) .. Sunday (6) of a month; the last one for n = -1."""
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n < 0:
        last = F.last_day(first)
        return F.date_sub(last, F.pmod(F.weekday(last) - weekday, F.lit(7)))
    return F.date_add(first, F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + 7 * (n - 1))


def observed(day: Column, saturday: bool = True) -> Column:
    """A fixed day moved off the weekend: Sunday to Monday, and Saturday to Friday unless that is not done."""
    moved = F.date_sub(day, 1) if saturday else F.lit(None).cast("date")
    return F.when(F.weekday(day) == 5, moved).when(F.weekday(day) == 6, F.date_add(day, 1)).otherwise(day)


def easter(year: Column) -> Column:
    """Easter Sunday of the Gregorian calendar (the anonymous computus)."""
    whole = lambda a, b: F.floor(a / F.lit(b)).cast("int")
    golden, century, rest = F.pmod(year, F.lit(19)), whole(year, 100), F.pmod(year, F.lit(100))
    leap = century - whole(century, 4) - whole(century - whole(century + 8, 25) + 1, 3)
    epact = F.pmod(19 * golden + leap + 15, F.lit(30))
    week = F.pmod(32 + 2 * F.pmod(century, F.lit(4)) + 2 * whole(rest, 4) - epact - F.pmod(rest, F.lit(4)), F.lit(7))
    late = whole(golden + 11 * epact + 22 * week, 451)
    n = epact + week - 7 * late + 114
    return F.make_date(year, whole(n, 31), F.pmod(n, F.lit(31)) + 1)


def rules(year: Column) -> list[tuple[str, int, Column]]:
    """Name, first year and day of each holiday of the New York exchange; a null day is none that year."""
    fixed = lambda m, d: F.make_date(year, F.lit(m), F.lit(d))
    return [
        ("New Year", 1885, observed(fixed(1, 1), saturday=False)),  # the Friday before is the old year's
        ("King", 1998, nth_weekday(year, 1, MONDAY, 3)),
        ("Washington", 1971, nth_weekday(year, 2, MONDAY, 3)),
        ("Good Friday", 1908, F.date_sub(easter(year), 2)),
        ("Memorial", 1971, nth_weekday(year, 5, MONDAY, -1)),
        ("Juneteenth", 2022, observed(fixed(6, 19))),
        ("Independence", 1954, observed(fixed(7, 4))),
        ("Labor", 1887, nth_weekday(year, 9, MONDAY, 1)),
        ("Thanksgiving", 1942, nth_weekday(year, 11, THURSDAY, 4)),
        ("Christmas", 1954, observed(fixed(12, 25))),
    ]


def holidays(years: DataFrame) -> DataFrame:
    """day, name of the weekdays on which the exchange is closed. years: column year; rules hold from 1971 on."""
    year = F.col("year")
    found = F.array(*(F.struct(F.when(year >= since, day).alias("day"), F.lit(name).alias("name")) for name, since, day in rules(year)))
    shut = F.array(*(F.struct(F.lit(d).cast("date").alias("day"), F.lit(n).alias("name")) for d, n in CLOSED.items()))
    own = F.filter(shut, lambda s: F.year(s["day"]) == year)
    return years.select(F.explode(F.concat(found, own)).alias("h")).select("h.day", "h.name").where("day IS NOT NULL")


def trading_days(spark: SparkSession, start: Column, end: Column) -> DataFrame:
    """A table of the exchange's days (column day) from start to end, as calendar_gaps takes it."""
    days = spark.range(1).select(F.explode(F.sequence(start.cast("date"), end.cast("date"), F.expr("interval 1 day"))).alias("day")).where("weekday(day) < 5")
    off = holidays(days.select(F.year("day").alias("year")).distinct()).select("day")
    return days.join(off, "day", "left_anti")
