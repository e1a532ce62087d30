"""Crash codes, ratios, trend classes and other small measures."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def daily_crash_code(process_type: Column, hang: Column) -> Column:
    """One letter per kind of crash; small letters are hangs."""
    kind = F.lower(F.coalesce(process_type, F.lit("browser")))
    return (F.when(kind == "content", F.lit("T"))
            .when((kind == "browser") & hang.isNotNull(), F.lit("c"))
            .when((kind == "plugin") & hang.isNotNull(), F.lit("p"))
            .when(kind == "plugin", F.lit("P"))
            .otherwise(F.lit("C")))


def crash_hadu(crashes: Column, adu: Column, throttle: Column | None = None) -> Column:
    """Crashes per 100 active daily users, corrected for throttling; 0 without users."""
    throttle = F.lit(1.0) if throttle is None else throttle.cast("double")
    ratio = crashes.cast("double") * 100 / adu.cast("double") / throttle
    return F.when(adu == 0, F.lit(0.0)).otherwise(F.round(ratio, 3))


def unthrottle(n: Column, percent: Column) -> Column:
    """Estimate of all crashes from those that passed a percentage throttle."""
    share = F.when(percent > 0, percent / F.lit(100.0)).otherwise(F.lit(1.0))
    return n + n * (1 - share) / share


def trend_class(change: Column) -> Column:
    """Class of a rank change; NULL is a signature that is new to the list."""
    return (F.when(change.isNull(), F.lit("new")).when(F.abs(change) < 5, F.lit("static"))
            .when(change > 0, F.lit("up")).otherwise(F.lit("down")))


def dominant_os(windows: Column, mac: Column, linux: Column) -> Column:
    return (F.when((windows >= mac) & (windows >= linux), F.lit("Windows NT"))
            .when((mac >= windows) & (mac >= linux), F.lit("Mac OS X"))
            .otherwise(F.lit("Linux")))


def content_count(process_type: Column, n: Column) -> Column:
    """Sum of ``n`` over content rows."""
    return F.sum(F.when(F.lower(process_type) == "content", F.coalesce(n, F.lit(0))).otherwise(0))


def plugin_count(process_type: Column, n: Column) -> Column:
    return F.sum(F.when(F.lower(process_type) == "plugin", F.coalesce(n, F.lit(0))).otherwise(0))
