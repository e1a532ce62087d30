"""Crashes per active user: dense marts by day and by build, and their views."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions import metrics as M, versions as V
from crashlake.functions.times import days_between, ts_in_days
from crashlake.operators import common as C


def _os_short(os_names: DataFrame) -> DataFrame:
    return os_names.select("os_name", "os_short_name")


def crashes_by_user(clean: DataFrame, product_versions: DataFrame, crash_types: DataFrame,
                    os_names: DataFrame, product_adu: DataFrame, start=None, end=None,
                    today=None) -> DataFrame:
    """Reports and users per version, day, OS and crash type, zeros included.

    A row stands for every version and OS that has a user count that day, once per crash
    type. Versions built more than a year before ``today`` are left out.
    """
    r = C.crash_kind(C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end))),
                     crash_types)
    keys = ["product_version_id", "report_date", "os_name", "crash_type"]
    counts = r.groupBy(*keys).agg(F.count("uuid").alias("report_count"))
    adu = (product_adu.where(days_between(F.col("adu_date"), start, end))
           .groupBy("product_version_id", "os_name", F.col("adu_date").alias("report_date"))
           .agg(F.sum("adu_count").alias("adu")))
    pv = product_versions
    if today is not None:
        pv = pv.where(F.col("build_date") >= F.add_months(F.lit(today).cast("date"), -12))
    pv = pv.select("product_version_id", "rapid_beta_id")
    dense = adu.join(pv, "product_version_id").join(_os_short(os_names), "os_name")
    dense = C.with_crash_types(dense, crash_types, "crash_type")
    rows = dense.join(counts, keys, "left").withColumn(
        "report_count", F.coalesce("report_count", F.lit(0)))
    rows = C.to_parents(rows, include_self=True)
    return rows.groupBy("product_version_id", "report_date", "os_short_name", "crash_type").agg(
        F.sum("report_count").alias("report_count"), F.sum("adu").alias("adu"))


def crashes_by_user_build(clean: DataFrame, product_versions: DataFrame, crash_types: DataFrame,
                          os_names: DataFrame, builds: DataFrame, build_adu: DataFrame,
                          start=None, end=None) -> DataFrame:
    """The same per build date, with distinct crash ids, for seven days after each build.

    All versions count nightly and aurora reports under their own id; rapid betas count
    their beta reports under the parent's id.
    """
    keys = ["product_version_id", "build_date", "report_date", "os_name", "crash_type"]
    r = C.crash_kind(C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end))),
                     crash_types)
    b = builds.select("product_version_id", F.col("build_id").cast("bigint").alias("build")).distinct()
    pv = product_versions.select("product_version_id", "rapid_beta_id")
    channel = F.lower("release_channel")
    r = r.where(channel.isin("nightly", "aurora", "beta")) \
        .join(b, ["product_version_id", "build"]).join(pv, "product_version_id")
    target = F.when(channel == "beta", F.col("rapid_beta_id")).otherwise(F.col("product_version_id"))
    counts = (r.withColumns({"product_version_id": target,
                             "build_date": V.build_date(F.col("build"))})
              .where(F.col("product_version_id").isNotNull())
              .groupBy(*keys).agg(F.countDistinct("uuid").alias("report_count")))
    adu = (build_adu.where(days_between(F.col("adu_date"), start, end))
           .groupBy("product_version_id", "os_name", "build_date",
                    F.col("adu_date").alias("report_date"))
           .agg(F.sum("adu_count").alias("adu")))
    # a version has rows for the build dates it has builds of (a parent: of its betas)
    own = b.join(pv, "product_version_id").withColumn("build_date", V.build_date(F.col("build")))
    ids = F.explode(F.array_compact(F.array("product_version_id", "rapid_beta_id")))
    has_build = own.select(ids.alias("product_version_id"), "build_date").distinct()
    dense = (adu.join(has_build, ["product_version_id", "build_date"], "left_semi")
             .where(F.col("report_date") <= F.date_add("build_date", 6))
             .join(_os_short(os_names), "os_name"))
    dense = C.with_crash_types(dense, crash_types, "crash_type")
    return dense.join(counts, keys, "left").select(
        "product_version_id", "report_date", "build_date", "os_short_name", "crash_type",
        F.coalesce("report_count", F.lit(0)).alias("report_count"), "adu")


def _throttles(product_versions: DataFrame, channels: DataFrame) -> DataFrame:
    """Version id, names and the throttle of its channel."""
    c = channels.select(F.lower("product_name").alias("_p"), F.lower("release_channel").alias("_c"),
                        F.col("throttle").cast("double").alias("throttle"))
    pv = product_versions.select(
        "product_version_id", "product_name", "version_string",
        F.lower("product_name").alias("_p"), F.lower("build_type").alias("_c"))
    return pv.join(c, ["_p", "_c"]).drop("_p", "_c")


def crashes_by_user_view(cbu: DataFrame, product_versions: DataFrame, channels: DataFrame,
                         os_names: DataFrame, crash_types: DataFrame) -> DataFrame:
    """Rows with names and the throttle-adjusted count."""
    return (cbu.join(_throttles(product_versions, channels), "product_version_id")
            .join(_os_short(os_names), "os_short_name")
            .join(crash_types.select("crash_type", "crash_type_short"), "crash_type")
            .withColumn("adjusted_report_count", F.col("report_count") / F.col("throttle")))


def crashes_by_user_build_view(cbub: DataFrame, product_versions: DataFrame, channels: DataFrame,
                               os_names: DataFrame, crash_types: DataFrame) -> DataFrame:
    """The same by build date, summed over report days."""
    rows = crashes_by_user_view(cbub, product_versions, channels, os_names, crash_types)
    return rows.groupBy(
        "product_version_id", "product_name", "version_string", "os_short_name", "os_name",
        "crash_type", "crash_type_short", "build_date", "throttle").agg(
        F.sum("report_count").alias("report_count"),
        F.sum("adjusted_report_count").alias("adjusted_report_count"), F.sum("adu").alias("adu"))


def crashes_by_user_rollup(cbu: DataFrame, crash_types: DataFrame) -> DataFrame:
    """Over the crash types that count; users are taken once, not once per type."""
    counted = crash_types.where("include_agg").select("crash_type")
    return (cbu.join(counted, "crash_type", "left_semi")
            .groupBy("product_version_id", "report_date", "os_short_name")
            .agg(F.sum("report_count").alias("report_count"), F.min("adu").alias("adu")))


def _ratio(rows: DataFrame, keys: list[str]) -> DataFrame:
    summed = rows.groupBy(*keys, "throttle").agg(
        F.sum("report_count").alias("crashes"), F.sum("adu").alias("adu_count"))
    return summed.withColumns({
        "adjusted_crashes": F.round(F.col("crashes") / F.col("throttle")).cast("bigint"),
        "crash_ratio": M.crash_hadu(F.col("crashes"), F.col("adu_count"), F.col("throttle"))})


def product_crash_ratio(cbu: DataFrame, product_versions: DataFrame, channels: DataFrame,
                        crash_types: DataFrame) -> DataFrame:
    rows = crashes_by_user_rollup(cbu, crash_types) \
        .join(_throttles(product_versions, channels), "product_version_id") \
        .withColumnRenamed("report_date", "adu_date")
    return _ratio(rows, ["product_version_id", "product_name", "version_string", "adu_date"])


def product_os_crash_ratio(cbu: DataFrame, product_versions: DataFrame, channels: DataFrame,
                           crash_types: DataFrame, os_names: DataFrame) -> DataFrame:
    rows = crashes_by_user_rollup(cbu, crash_types) \
        .join(_throttles(product_versions, channels), "product_version_id") \
        .join(_os_short(os_names), "os_short_name").withColumnRenamed("report_date", "adu_date")
    return _ratio(rows, ["product_version_id", "product_name", "version_string", "os_short_name",
                         "os_name", "adu_date"])
