"""Crash-ratio graphs, coded daily counts, and build trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions import metrics as M, versions as V
from crashlake.functions.text import initcap1
from crashlake.functions.times import days_between, ts_in_days
from crashlake.operators import common as C
from crashlake.operators.users import _throttles


def home_page_graph(clean: DataFrame, product_versions: DataFrame, crash_types: DataFrame,
                    channels: DataFrame, product_adu: DataFrame, start=None, end=None,
                    today=None) -> DataFrame:
    """Reports, users and crashes per 100 users, per version and day.

    Browser hangs are not counted. Parents of rapid betas sum their betas, at throttle 1.
    """
    r = C.crash_kind(C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end))),
                     crash_types.where("include_agg"))
    keys = ["product_version_id", "report_date"]
    counts = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("report_count"))
    adu = (product_adu.where(days_between(F.col("adu_date"), start, end))
           .groupBy("product_version_id", F.col("adu_date").alias("report_date"))
           .agg(F.sum("adu_count").alias("adu")))
    pv = product_versions
    if today is not None:
        pv = pv.where(F.col("sunset_date") > F.add_months(F.lit(today).cast("date"), -12))
    pv = pv.select("product_version_id", "build_date", "sunset_date", "rapid_beta_id") \
        .join(_throttles(product_versions, channels), "product_version_id")
    rows = counts.join(pv, "product_version_id").where(C.live_on(F.col("report_date"))) \
        .join(adu, keys).select(*keys, "report_count", "adu", "throttle", "rapid_beta_id")
    own = F.struct(F.col("product_version_id").alias("id"), F.col("throttle").alias("t"))
    parent = F.when(F.col("rapid_beta_id").isNotNull(),
                    F.struct(F.col("rapid_beta_id").alias("id"), F.lit(1.0).alias("t")))
    spread = rows.withColumn("_to", F.explode(F.array_compact(F.array(own, parent))))
    out = spread.groupBy(F.col("_to.id").alias("product_version_id"), "report_date").agg(
        F.sum("report_count").alias("report_count"), F.sum("adu").alias("adu"),
        F.min("_to.t").alias("_throttle"))
    return out.withColumn("crash_hadu", M.crash_hadu(
        F.col("report_count"), F.col("adu"), F.col("_throttle"))).drop("_throttle")


def home_page_graph_build(clean: DataFrame, product_versions: DataFrame, crash_types: DataFrame,
                          channels: DataFrame, build_adu: DataFrame, start=None, end=None
                          ) -> DataFrame:
    """Reports and users per version, build date and day, seven days after each build."""
    r = C.crash_kind(C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end))),
                     crash_types.where("include_agg"))
    channel = F.lower("release_channel")
    r = r.where(channel.isin("nightly", "aurora", "beta")) \
        .withColumns({"build_date": V.build_date(F.col("build")), "_beta": channel == "beta"}) \
        .where(F.col("build_date") >= F.date_sub("report_date", 6))
    keys = ["product_version_id", "build_date", "report_date"]
    counts = r.groupBy(*keys, "_beta").agg(F.count(F.lit(1)).alias("report_count"))
    pv = product_versions.select("product_version_id", F.col("build_date").alias("_from"),
                                 F.col("sunset_date").alias("_to"), "rapid_beta_id")
    rows = counts.join(pv, "product_version_id") \
        .where(F.col("report_date").between(F.col("_from"), F.col("_to")))
    target = F.when(F.col("_beta"), F.col("rapid_beta_id")).otherwise(F.col("product_version_id"))
    rows = rows.withColumn("product_version_id", target) \
        .where(F.col("product_version_id").isNotNull()) \
        .groupBy(*keys).agg(F.sum("report_count").alias("report_count"))
    adu = (build_adu.where(days_between(F.col("adu_date"), start, end))
           .groupBy("product_version_id", "build_date", F.col("adu_date").alias("report_date"))
           .agg(F.sum("adu_count").alias("adu")))
    listed = _throttles(product_versions, channels).select("product_version_id")
    return rows.join(adu, keys).join(listed, "product_version_id", "left_semi")


def home_page_graph_view(graph: DataFrame, product_versions: DataFrame) -> DataFrame:
    return graph.join(product_versions.select("product_version_id", "product_name",
                                              "version_string"), "product_version_id")


def home_page_graph_build_view(graph: DataFrame, product_versions: DataFrame,
                               channels: DataFrame) -> DataFrame:
    rows = graph.join(_throttles(product_versions, channels), "product_version_id")
    out = rows.groupBy("product_version_id", "product_name", "version_string", "build_date",
                       "throttle").agg(F.sum("report_count").alias("report_count"),
                                       F.sum("adu").alias("adu"))
    return out.withColumn("crash_hadu", M.crash_hadu(
        F.col("report_count"), F.col("adu"), F.col("throttle"))).drop("throttle")


def daily_crashes(clean: DataFrame, product_versions: DataFrame, os_names: DataFrame,
                  start=None, end=None) -> DataFrame:
    """Counts by one-letter crash code, and distinct hangs under code ``H``."""
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    code = M.daily_crash_code(F.col("process_type"), F.col("hang_id"))
    keys = ["product_version_id", "os_name", "report_date"]
    coded = r.groupBy(*keys, code.alias("report_type")).agg(F.count(F.lit(1)).alias("count"))
    hangs = r.groupBy(*keys).agg(F.countDistinct("hang_id").alias("count")) \
        .withColumn("report_type", F.lit("H"))
    pv = product_versions.select("product_version_id", "build_date", "sunset_date")
    return (coded.unionByName(hangs).join(pv, "product_version_id")
            .where(C.live_on(F.col("report_date")))
            .join(os_names.select("os_name", initcap1(F.col("os_short_name")).alias("os_short_name")),
                  "os_name")
            .select("count", "report_type", "product_version_id", "os_short_name",
                    F.col("report_date").alias("adu_day")))


def daily_crashes_old(reports: DataFrame, productdims: DataFrame, visibility: DataFrame,
                      start=None, end=None) -> DataFrame:
    """The same for the old version list, straight from reports."""
    r = C.report_day(reports.where(ts_in_days(F.col("date_processed"), start, end)))
    short = F.substring("os_name", 1, 3)
    r = r.withColumn("os_short_name", short).where(F.lower(short).isin("win", "lin", "mac"))
    keys = ["product", "version", "os_short_name", "report_date"]
    code = M.daily_crash_code(F.col("process_type"), F.col("hang_id"))
    coded = r.groupBy(*keys, code.alias("report_type")).agg(F.count(F.lit(1)).alias("count"))
    hangs = r.where(F.col("hang_id").isNotNull()).groupBy(*keys) \
        .agg(F.countDistinct("hang_id").alias("count")).withColumn("report_type", F.lit("H"))
    p = productdims.select("id", "product", "version")
    v = visibility.where(~F.col("ignore")).select(F.col("productdims_id").alias("id"),
                                                  "start_date", "end_date")
    return (coded.unionByName(hangs).join(p, ["product", "version"]).join(v, "id")
            .where(F.col("report_date").between(F.col("start_date"), F.col("end_date")))
            .select("count", "report_type", F.col("id").alias("product_version_id"),
                    "os_short_name", F.col("report_date").alias("adu_day")))


def nightly_builds(clean: DataFrame, product_versions: DataFrame, builds: DataFrame,
                   start=None, end=None) -> DataFrame:
    """Reports of nightly and aurora builds by days since the build, up to 14.

    A build id listed for several platforms counts once for each of them.
    """
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    r = r.where(F.lower("release_channel").isin("nightly", "aurora"))
    counts = r.groupBy("product_version_id", "build", "report_date") \
        .agg(F.count(F.lit(1)).alias("_n"))
    listed = builds.groupBy("product_version_id", F.col("build_id").cast("bigint").alias("build")) \
        .agg(F.count(F.lit(1)).alias("_times"))
    pv = product_versions.select("product_version_id", F.col("build_date").alias("_from"),
                                 F.col("sunset_date").alias("_to"))
    rows = counts.join(listed, ["product_version_id", "build"]).join(pv, "product_version_id")
    rows = rows.withColumn("build_date", V.build_date(F.col("build"))) \
        .withColumn("days_out", F.datediff("report_date", "build_date")) \
        .where((F.col("days_out") <= 14)
               & F.col("report_date").between(F.col("_from"), F.col("_to")))
    return rows.groupBy("product_version_id", "build_date", "report_date", "days_out").agg(
        F.sum(F.col("_n") * F.col("_times")).alias("report_count"))


def crash_trends(nightly: DataFrame, product_versions: DataFrame, product: str, version: str,
                 start, end) -> DataFrame:
    """Rows of one nightly or aurora version between two days."""
    pv = product_versions.where((F.lower("product_name") == product.lower())
                                & (F.lower("version_string") == version.lower()))
    pv = pv.select("product_version_id", "product_name", "version_string")
    return nightly.where(days_between(F.col("report_date"), start, end)) \
        .join(pv, "product_version_id")


def trend_histogram(trends: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Reports by days after the build: columns 0 … 7, and 8 for everything later."""
    offset = F.least("days_out", F.lit(8))
    sums = [F.sum(F.when(offset == i, F.col("report_count")).otherwise(0)).alias(f"day{i}")
            for i in range(9)]
    return trends.groupBy(*(keys or ["report_date"])).agg(*sums)
