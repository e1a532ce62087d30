"""Hourly cleaning: reports -> clean facts, user info, bad rows, and new dimension values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from crashlake.functions import platforms as P, text as X, versions as V
from crashlake.functions.times import ts_in_days
from crashlake.operators.dims import grow_lookup, grow_os_versions, windows_rows
from crashlake.operators.processing import finished_reports

CLEAN_COLUMNS = (
    "uuid", "date_processed", "client_crash_date", "product_version_id", "build", "signature",
    "install_age", "uptime", "reason", "address", "os_name", "os_major", "os_minor",
    "os_version_string", "hang_id", "flash_version", "process_type", "release_channel",
    "duplicate_of", "domain", "architecture", "cores")
USER_COLUMNS = ("uuid", "date_processed", "email", "user_comments", "url", "app_notes")


@dataclass
class Dims:
    """Dimension frames that the cleaning reads."""

    product_versions: DataFrame
    builds: DataFrame
    channel_matches: DataFrame
    os_matches: DataFrame
    windows_versions: DataFrame


@dataclass
class Cleaned:
    """``staged`` has every row once; the others are filters and projections of it."""

    staged: DataFrame

    @property
    def clean(self) -> DataFrame:
        return self.staged.where(~F.col("is_bad")).select(*CLEAN_COLUMNS)

    @property
    def user_info(self) -> DataFrame:
        some = F.lit(False)
        for c in USER_COLUMNS[2:]:
            some = some | X.nonzero_string(F.col(c)) | (F.col(c) != "")
        return self.staged.where(~F.col("is_bad") & F.coalesce(some, F.lit(False))) \
            .select(*USER_COLUMNS)

    @property
    def bad(self) -> DataFrame:
        return self.staged.where(F.col("is_bad")).select("uuid", "date_processed")


def version_keys(product_versions: DataFrame, builds: DataFrame) -> DataFrame:
    """Join table version -> id: betas by build id, all others by version and channel only.

    One row per key (the smallest id where several fit), so that a report never doubles.
    """
    pv = product_versions.select(
        "product_version_id", F.lower("product_name").alias("_product"),
        F.lower("release_version").alias("_version"), F.lower("build_type").alias("_channel"))
    any_build = F.lit(-1).cast("bigint")
    plain = pv.where(F.col("_channel") != "beta").withColumn("_build", any_build)
    b = builds.select("product_version_id", F.col("build_id").cast("bigint").alias("_build"))
    beta = pv.where(F.col("_channel") == "beta").join(b, "product_version_id")
    return (plain.unionByName(beta).groupBy("_product", "_version", "_channel", "_build")
            .agg(F.min("product_version_id").alias("product_version_id")))


def build_reports_clean(reports: DataFrame, dims: Dims, done: DataFrame | None = None,
                        duplicates: DataFrame | None = None, start=None, end=None,
                        old_channel: tuple[str, str, str] | None = None) -> Cleaned:
    """Clean the finished reports of ``[start, end)``.

    ``done`` (clean rows of the days around) and ``duplicates`` are optional inputs. All
    joins are on equality with small dimensions or on the unique crash id. ``old_channel``
    is (product, version head, pre mark) of a product that sent no channel.
    """
    if start is not None or end is not None:
        r = finished_reports(reports, start, end)
    else:
        r = reports.where(F.col("completed_datetime").isNotNull())
    if done is not None:
        near = F.lit(True)
        if start is not None:
            near = F.col("date_processed").between(
                F.lit(start).cast("timestamp") - F.expr("INTERVAL 1 DAY"),
                F.lit(end).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
        r = r.join(done.where(near).select("uuid"), "uuid", "left_anti")
    r = X.clean_nulls(r)
    channel = F.col("release_channel")
    if old_channel is not None:
        channel = P.fix_channel(F.col("product"), F.col("version"), channel, *old_channel)
    r = r.withColumns({
        "_os": F.col("os_name"),
        "os_version": P.strip_linux_version(F.col("os_name"), F.col("os_version")),
        "_channel_text": channel,
        "build": V.build_numeric(F.col("build")),
        "cores": X.get_cores(F.col("cpu_info")),
        "architecture": F.col("cpu_name"),
    })
    r = P.ilike_map(r, dims.channel_matches, "_channel_text", "release_channel", "release_channel")
    r = P.ilike_map(r, dims.os_matches, "_os", "os_name", "os_name")
    r = r.withColumn("os_name", P.default_unknown(F.col("os_name")))
    parts = F.when(F.col("os_name") != X.UNKNOWN, P.os_version_parts(F.col("os_version")))
    r = r.withColumn("_p", parts).withColumns({
        "os_major": F.coalesce(F.col("_p.major"), F.lit(0)),
        "os_minor": F.coalesce(F.col("_p.minor"), F.lit(0))})
    r = r.withColumn("os_version_string", P.os_version_string(
        F.col("os_name"), F.col("os_major"), F.col("os_minor"),
        windows_rows(dims.windows_versions)))
    keys = version_keys(dims.product_versions, dims.builds)
    r = r.withColumns({
        "_product": F.lower("product"), "_version": F.lower("version"),
        "_channel": F.lower("release_channel")})
    r = r.withColumn("_build", F.when(F.col("_channel") == "beta", F.col("build"))
                     .otherwise(F.lit(-1)).cast("bigint"))
    r = r.join(keys, ["_product", "_version", "_channel", "_build"], "left")
    if duplicates is not None:
        near = F.lit(True)
        if start is not None:
            near = F.col("date_processed").between(
                F.lit(start).cast("timestamp") - F.expr("INTERVAL 1 DAY"),
                F.lit(start).cast("timestamp") + F.expr("INTERVAL 1 DAY"))
        links = duplicates.where(near).groupBy("uuid").agg(F.min("duplicate_of").alias("duplicate_of"))
        r = r.drop("duplicate_of").join(links, "uuid", "left")
    elif "duplicate_of" not in r.columns:
        r = r.withColumn("duplicate_of", F.lit(None).cast("string"))
    bad = F.col("product_version_id").isNull() | F.col("release_channel").isNull()
    r = r.withColumn("is_bad", bad)
    keep = [c for c in (*CLEAN_COLUMNS, *USER_COLUMNS[2:])]
    dims_in = [c for c in ("os_version",) if c in r.columns]
    return Cleaned(r.select(*keep, "_os", *dims_in, "is_bad"))


def new_dimension_values(staged: DataFrame, lookups: dict[str, DataFrame | None],
                         dims: Dims, os_versions: DataFrame | None = None) -> dict[str, DataFrame]:
    """New rows of the lookups ``reason``, ``address``, ``flash_version``, ``domain``,
    ``signature`` (compared exactly) and ``os_versions``."""
    out = {c: grow_lookup(staged, lookups.get(c), c, exact=c == "signature")
           for c in ("reason", "address", "flash_version", "domain", "signature")}
    raw = staged.select(F.col("_os").alias("os_name"), "os_version")
    out["os_versions"] = grow_os_versions(raw, dims.os_matches, dims.windows_versions, os_versions)
    return out


def day_is_complete(clean: DataFrame, day, hours: int = 1) -> bool:
    """Does the last hour of the UTC day have rows?"""
    end = F.date_add(F.lit(day).cast("date"), 1).cast("timestamp")
    last = F.col("date_processed").between(end - F.expr(f"INTERVAL {int(hours)} HOUR"), end)
    return not clean.where(last).limit(1).isEmpty()


def keep_days(df: DataFrame, start, end, ts: str = "date_processed") -> DataFrame:
    return df.where(ts_in_days(F.col(ts), start, end))
