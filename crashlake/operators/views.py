"""Views over the dimensions: product info, selectors, default and current versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def product_info(product_versions: DataFrame, channels: DataFrame, products: DataFrame,
                 release_channels: DataFrame) -> DataFrame:
    """Versions with throttle (in percent) and sort keys."""
    c = channels.select(F.lower("product_name").alias("_p"), F.lower("release_channel").alias("_c"),
                        F.round(F.col("throttle").cast("double") * 100, 2).alias("throttle"))
    p = products.select(F.lower("product_name").alias("_p"), F.col("sort").alias("product_sort"))
    s = release_channels.select(F.lower("release_channel").alias("_c"),
                                F.col("sort").alias("channel_sort"))
    pv = product_versions.withColumns({"_p": F.lower("product_name"), "_c": F.lower("build_type")})
    return pv.join(c, ["_p", "_c"]).join(p, "_p").join(s, "_c").select(
        "product_version_id", "product_name", "version_string", F.lit("new").alias("which_table"),
        F.col("build_date").alias("start_date"), F.col("sunset_date").alias("end_date"),
        F.col("featured_version").alias("is_featured"), "build_type", "throttle", "version_sort",
        "product_sort", "channel_sort", "has_builds", "is_rapid_beta")


def product_selector(product_versions: DataFrame, today) -> DataFrame:
    return product_versions.where(F.col("sunset_date") >= F.lit(today).cast("date")).select(
        "product_name", "version_string", F.lit("new").alias("which_table"), "version_sort",
        "has_builds", "is_rapid_beta")


def default_versions(info: DataFrame, today, builds_only: bool = False) -> DataFrame:
    """One version per product: live first, then featured, then by channel.

    Ties go to the highest version. The list of versions of a product is short.
    """
    day = F.lit(today).cast("date")
    live = day.between(F.col("start_date"), F.col("end_date"))
    rows = info.where("has_builds") if builds_only else info
    w = Window.partitionBy("product_name").orderBy(
        F.desc(live), F.desc("is_featured"), F.desc("channel_sort"), F.desc("version_sort"),
        "version_string")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1") \
        .select("product_name", "version_string", "product_version_id")


def current_versions(info: DataFrame) -> DataFrame:
    return info.orderBy("product_name", F.desc("version_sort"), "version_string").select(
        "product_name", "product_version_id", "version_string", "is_featured", "start_date",
        "end_date", "build_type", "throttle")


def products_versions(info: DataFrame, versions: list[str] | None = None) -> DataFrame:
    """Info of ``product:version`` texts, or of all versions."""
    rows = info.select("is_featured", "throttle", "end_date", "start_date", "build_type",
                       F.col("product_name").alias("product"),
                       F.col("version_string").alias("version"), "has_builds")
    if not versions:
        return rows
    return rows.where(F.concat_ws(":", "product", "version").isin(versions))


def products_list(products: DataFrame, defaults: DataFrame) -> DataFrame:
    d = defaults.select("product_name", F.col("version_string").alias("default_version"))
    return products.join(d, "product_name", "left").select(
        "product_name", "sort", "rapid_release_version", "release_name", "default_version")


def versions_info(product_versions: DataFrame, builds: DataFrame,
                  versions: list[str] | None = None) -> DataFrame:
    """Versions with the list of their build ids (a version has few builds)."""
    b = builds.select("product_version_id", "build_id").distinct().groupBy("product_version_id") \
        .agg(F.array_sort(F.collect_list("build_id")).alias("build_id"))
    rows = product_versions.join(b, "product_version_id", "left").select(
        F.concat_ws(":", "product_name", "version_string").alias("product_version"),
        "version_string", "product_name", "major_version", "release_version",
        F.col("build_type"), "build_id", "is_rapid_beta")
    return rows.where(F.col("product_version").isin(versions)) if versions else rows


def featured(info: DataFrame, today, products: list[str] | None = None) -> DataFrame:
    """Featured live versions per product."""
    day = F.lit(today).cast("date")
    rows = info.where(F.col("is_featured") & day.between(F.col("start_date"), F.col("end_date")))
    if products:
        rows = rows.where(F.col("product_name").isin(products))
    w = F.array_sort(F.collect_list(F.struct("version_sort", "version_string")))
    return rows.groupBy("product_name").agg(
        F.transform(w, lambda s: s["version_string"]).alias("versions"))


def nightly_builds_of(product_versions: DataFrame, builds: DataFrame, product: str, since,
                      version: str | None = None) -> DataFrame:
    """Builds of nightly and aurora versions of a product since a date, newest first."""
    from crashlake.functions.versions import build_date
    pv = product_versions.where((F.col("product_name") == product)
                                & F.lower("build_type").isin("nightly", "aurora"))
    if version is not None:
        pv = pv.where(F.col("version_string") == version)
    rows = builds.join(pv.select("product_version_id", F.col("product_name").alias("product"),
                                 F.col("version_string").alias("version"), "beta_number",
                                 "build_type"), "product_version_id")
    day = build_date(F.col("build_id"))
    return rows.withColumn("date", day).where(day >= F.lit(since).cast("date")).select(
        "product", "version", "platform", "build_type", "build_id", "beta_number", "repository",
        "date").orderBy(F.desc("date"), "product", "version", "platform", "build_id")


def version_ids(product_versions: DataFrame, product: str, versions: list[str]) -> DataFrame:
    """Ids of the listed versions of a product as one array."""
    hit = (F.lower("product_name") == product.lower()) \
        & F.lower("version_string").isin([v.lower() for v in versions])
    return product_versions.where(hit).agg(
        F.array_sort(F.collect_list("product_version_id")).alias("product_version_ids"))
