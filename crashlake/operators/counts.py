"""Signature counts by uptime, OS and product; domains and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.functions.text import url_parts
from crashlake.functions.times import ts_in_days
from crashlake.operators import common as C
from crashlake.operators.intervals import interval_join
from crashlake.session import bounded_rows


def _apart(rows: list) -> bool:
    """Whether levels (value, low, high) in the order of their lower bounds do not overlap."""
    return all(a[2] <= b[1] for a, b in zip(rows, rows[1:]))


def uptime_level(df: DataFrame, levels: DataFrame, value: str = "uptime_level",
                 uptime: str = "uptime", inner: bool = True) -> DataFrame:
    """Bucket of ``[min, max)`` that the uptime falls in; a row for each where buckets overlap.

    A short table of buckets that lie apart becomes one CASE expression; any other is joined
    by bins, with the same rows.
    """
    cols = levels.select(value, "min_uptime", "max_uptime").where("min_uptime < max_uptime")
    rows = bounded_rows(cols)
    if rows is not None and _apart(rows := sorted(rows, key=lambda r: (r[1], r[2]))):
        level: Column | None = None
        for v, low, high in rows:
            hit = (F.col(uptime) >= low) & (F.col(uptime) < high)
            level = F.when(hit, F.lit(v)) if level is None else level.when(hit, F.lit(v))
        out = df.withColumn(value, F.lit(None) if level is None else level)
        return out.where(F.col(value).isNotNull()) if inner else out
    joined = interval_join(df, cols, uptime, "min_uptime", "max_uptime", how="inner" if inner else "left")
    return joined.drop("min_uptime", "max_uptime")


def signature_counts(clean: DataFrame, product_versions: DataFrame, dim: str, start=None,
                     end=None, levels: DataFrame | None = None) -> DataFrame:
    """Reports per signature and ``uptime``, ``os`` or ``product``, of live versions, by day."""
    keys = {"uptime": "uptime_level", "os": "os_version_string", "product": "product_version_id"}
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    if dim == "uptime":
        r = uptime_level(r, levels)
    pv = product_versions.select("product_version_id", "build_date", "sunset_date")
    by = list(dict.fromkeys(["report_date", "signature", keys[dim], "product_version_id"]))
    rows = r.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).join(pv, "product_version_id") \
        .where(C.live_on(F.col("report_date")))
    return rows.groupBy("report_date", "signature", keys[dim]) \
        .agg(F.sum("_n").alias("report_count"))


def domain_counts(clean: DataFrame, start=None, end=None) -> DataFrame:
    """Reports per version, domain and day."""
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    return r.groupBy("product_version_id", "domain", "report_date") \
        .agg(F.count(F.lit(1)).alias("report_count"))


def top_urls(reports: DataFrame, level: str = "page", start=None, end=None,
             keys: tuple[str, ...] = ("product", "version")) -> DataFrame:
    """Crashes per page or host and day; needs a protocol, and more than one crash."""
    field = {"page": "page", "domain": "host"}[level]
    r = C.report_day(reports.where(ts_in_days(F.col("date_processed"), start, end)))
    r = r.where(F.col("url").contains("://")) \
        .withColumn(level, url_parts(F.col("url"))[field]).where(F.col(level).isNotNull())
    return r.groupBy("report_date", *keys, level) \
        .agg(F.count(F.lit(1)).alias("crash_count")).where("crash_count > 1")
