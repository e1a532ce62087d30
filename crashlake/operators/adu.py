"""Active daily users per version and OS, by day and by build date."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions import platforms as P, versions as V
from crashlake.functions.times import days_between
from crashlake.functions.text import UNKNOWN

BUILD_WINDOW_DAYS = 6


def mapped_adu(raw_adu: DataFrame, guid_map: DataFrame | None, os_matches: DataFrame,
               start=None, end=None) -> DataFrame:
    """Feed rows under canonical product and OS names, summed per build.

    The feed is reduced here, before any join with versions.
    """
    r = raw_adu.where(days_between(F.col("adu_date"), start, end))
    r = P.ilike_map(r, os_matches, "product_os_platform", "os_name", "os_name")
    if guid_map is not None:
        names = guid_map.select(F.regexp_replace("productid", r"^[{}]+|[{}]+$", "")
                                .alias("product_guid"), F.col("product_name").alias("_mapped"))
        r = r.join(names, "product_guid", "left")
    else:
        r = r.withColumn("_mapped", F.lit(None).cast("string"))
    return r.groupBy(
        F.lower(F.coalesce("_mapped", "product_name")).alias("_product"),
        F.lower("product_version").alias("_version"), F.lower("build_channel").alias("_channel"),
        V.build_numeric(F.col("build")).alias("build_id"),
        F.coalesce("os_name", F.lit(UNKNOWN)).alias("os_name"), "adu_date",
    ).agg(F.sum("adu_count").alias("adu_count"))


def _versions(product_versions: DataFrame) -> DataFrame:
    return product_versions.select(
        "product_version_id", F.lower("product_name").alias("_product"),
        F.lower("version_string").alias("_string"), F.lower("release_version").alias("_release"),
        F.lower("build_type").alias("_channel"), "build_date", "sunset_date", "rapid_beta_id")


def _live_days(pv: DataFrame, adu: DataFrame) -> DataFrame:
    """Version x day while it is live, for the days that the feed has (bounded by lifetimes)."""
    days = pv.withColumn("adu_date", F.explode(
        F.expr("sequence(build_date, date_add(sunset_date, 1), interval 1 day)")))
    return days.join(adu.select("adu_date").distinct(), "adu_date", "left_semi")


def product_adu(raw_adu: DataFrame, product_versions: DataFrame, builds: DataFrame,
                guid_map: DataFrame | None, os_matches: DataFrame, start=None, end=None) -> DataFrame:
    """Users per version, OS and day.

    Releases, nightlies, auroras (by version text) and ESR (version + ``esr``) have a row for
    every live day, 0 under OS Unknown without users; betas need a matching build.
    """
    adu = mapped_adu(raw_adu, guid_map, os_matches, start, end)
    pv = _versions(product_versions)
    per_version = adu.groupBy("_product", "_version", "_channel", "os_name", "adu_date") \
        .agg(F.sum("adu_count").alias("adu_count"))
    text = F.when(F.col("_channel") == "esr", F.concat("_version", F.lit("esr"))) \
        .otherwise(F.col("_version"))
    named = per_version.where(F.col("_channel").isin("release", "nightly", "aurora", "esr")) \
        .withColumn("_string", text).drop("_version")
    dense = _live_days(pv.where(F.col("_channel").isin("release", "nightly", "aurora", "esr")), adu)
    plain = dense.join(named, ["_product", "_string", "_channel", "adu_date"], "left").select(
        "product_version_id", F.coalesce("os_name", F.lit(UNKNOWN)).alias("os_name"), "adu_date",
        F.coalesce("adu_count", F.lit(0)).alias("adu_count"))
    b = builds.select("product_version_id", F.col("build_id").cast("bigint").alias("build_id")).distinct()
    beta_keys = pv.where(F.col("_channel") == "beta").join(b, "product_version_id")
    betas = (adu.where(F.col("_channel") == "beta").withColumnRenamed("_version", "_release")
             .join(beta_keys, ["_product", "_release", "_channel", "build_id"])
             .where(F.col("adu_date").between(F.col("build_date"), F.date_add("sunset_date", 1)))
             .select("product_version_id", "os_name", "adu_date", "adu_count"))
    return (plain.unionByName(betas).groupBy("product_version_id", "os_name", "adu_date")
            .agg(F.sum("adu_count").cast("bigint").alias("adu_count")))


def build_adu(raw_adu: DataFrame, product_versions: DataFrame, builds: DataFrame,
              guid_map: DataFrame | None, os_matches: DataFrame, start=None, end=None) -> DataFrame:
    """Users per version, OS, build date and day, for the first seven days of a build.

    Nightlies and auroras by version text; betas by build id, under their parent's id.
    """
    adu = mapped_adu(raw_adu, guid_map, os_matches, start, end) \
        .withColumn("_bdate", V.build_date(F.col("build_id"))) \
        .where((F.col("_bdate").isNotNull())
               & (F.col("adu_date") <= F.date_add("_bdate", BUILD_WINDOW_DAYS)))
    pv = _versions(product_versions)
    live = F.col("adu_date").between(F.col("build_date"), F.date_add("sunset_date", 1))
    cols = ["product_version_id", "os_name", "adu_date", F.col("_bdate").alias("build_date"),
            "adu_count"]
    plain = (adu.withColumnRenamed("_version", "_string")
             .join(pv.where(F.col("_channel").isin("nightly", "aurora")),
                   ["_product", "_string", "_channel"]).where(live).select(*cols))
    b = builds.select("product_version_id", F.col("build_id").cast("bigint").alias("build_id")).distinct()
    keys = pv.where((F.col("_channel") == "beta") & F.col("rapid_beta_id").isNotNull()) \
        .join(b, "product_version_id")
    betas = (adu.withColumnRenamed("_version", "_release")
             .join(keys, ["_product", "_release", "_channel", "build_id"]).where(live)
             .withColumn("product_version_id", F.col("rapid_beta_id")).select(*cols))
    return (plain.unionByName(betas)
            .groupBy("product_version_id", "os_name", "adu_date", "build_date")
            .agg(F.sum("adu_count").cast("bigint").alias("adu_count")))
