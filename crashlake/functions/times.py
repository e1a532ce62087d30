"""UTC days and weeks, fuzzy time equality, dates carried in crash ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def utc_day_is(ts: Column, day) -> Column:
    """Half-open range on the bare column, so that it reaches the parquet scan."""
    start = F.lit(day).cast("date").cast("timestamp")
    return (ts >= start) & (ts < start + F.expr("INTERVAL 1 DAY"))


def utc_day_near(ts: Column, day) -> Column:
    start = F.lit(day).cast("date").cast("timestamp")
    return (ts > start - F.expr("INTERVAL 1 DAY")) & (ts < start + F.expr("INTERVAL 2 DAY"))


def tstz_between(ts: Column, first: Column, last: Column) -> Column:
    """From the start of the first day to the end of the last day."""
    return (ts >= first.cast("timestamp")) & (ts < F.date_add(last, 1).cast("timestamp"))


def in_range(ts: Column, start, end) -> Column:
    return (ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp"))


def days_between(day: Column, start=None, end=None) -> Column:
    """Closed range of days; an open side is no condition."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (day >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (day <= F.lit(end).cast("date"))
    return cond


def ts_in_days(ts: Column, start=None, end=None) -> Column:
    """Timestamps inside a closed range of UTC days, written as a pushable range."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (ts >= F.lit(start).cast("date").cast("timestamp"))
    if end is not None:
        cond = cond & (ts < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp"))
    return cond


def week_begins_utc(ts: Column) -> Column:
    """Monday 00:00 UTC of the week."""
    return F.date_trunc("week", ts)


def week_ends_utc(ts: Column) -> Column:
    return F.date_trunc("week", ts) + F.expr("INTERVAL 7 DAY")


def local_time(ts: Column, zone: str = "America/Los_Angeles") -> Column:
    return F.from_utc_timestamp(ts, zone)


def seconds_between(a: Column, b: Column) -> Column:
    """Seconds from a to b, with fractions."""
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(1e6)


def same_time_fuzzy(t1: Column, t2: Column, s1: Column, s2: Column) -> Column:
    """Do both the clocks and the counters differ by the same time, give or take 60 s?

    True when a counter is missing, so that incomplete reports are not left out.
    """
    drift = seconds_between(t1, t2) - (s2 - s1)
    return F.when(s1.isNull() | s2.isNull(), F.lit(True)).otherwise(drift.between(-60, 60))


def ooid_date(c: Column) -> Column:
    """Day in the last six digits of a crash id; NULL for an id without one."""
    tail = F.right(c, F.lit(7))
    return F.when(tail.rlike("^[0-9]{7}$"),
                  F.try_to_date(F.concat(F.lit("20"), F.right(c, F.lit(6))), "yyyyMMdd"))


def ooid_depth(c: Column) -> Column:
    """Storage depth digit; 0 stands for the old depth of 4."""
    digit = F.substring(F.right(c, F.lit(7)), 1, 1).try_cast("int")
    return F.when(ooid_date(c).isNotNull(), F.when(digit == 0, 4).otherwise(digit))


def uuid_to_date(c: Column, century: str = "20") -> Column:
    return F.try_to_date(F.concat(F.lit(century), F.right(c, F.lit(6))), "yyyyMMdd")


def with_ooid(df, ts: str, depth: int = 2, name: str = "uuid", base: str | None = None):
    """Give every row a crash id that carries its day and the storage depth.

    ``base`` names a column with a 36-character uuid; without it a random one is drawn.
    """
    if not 1 <= depth <= 4:
        raise ValueError("depth must be 1 to 4")
    source = F.col(base) if base else F.uuid()
    return df.withColumn(name, F.concat(F.substring(source, 1, 29), F.lit(str(depth)),
                                        F.date_format(F.col(ts), "yyMMdd")))
