"""The daily crash extract: one row per report with bugs, users and duplicate link."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions import platforms as P, text as X
from crashlake.functions.times import utc_day_is

EXTRACT_COLUMNS = (
    "signature", "url", "uuid_url", "client_crash_date", "date_processed", "last_crash",
    "product", "version", "build", "branch", "os_name", "os_version", "cpu_info", "address",
    "bug_list", "user_comments", "uptime_seconds", "email", "adu_count", "topmost_filenames",
    "addons_checked", "flash_version", "hangid", "reason", "process_type", "app_notes",
    "install_age", "duplicate_of", "release_channel", "productid")


def adu_by_os_prefix(reports: DataFrame, adu: DataFrame) -> DataFrame:
    """Users of each (product, version, OS name, OS version) among the reports.

    OS names agree in three letters and the report's OS version contains the feed's. Only
    the distinct combinations are matched, on equality of product, version and prefix.
    """
    keys = ["product", "version", "os_name", "os_version"]
    combos = reports.select(*keys).distinct().withColumn("_p", F.substring("os_name", 1, 3))
    feed = (adu.groupBy(F.col("product_name").alias("product"),
                        F.col("product_version").alias("version"),
                        F.substring("product_os_platform", 1, 3).alias("_p"),
                        F.coalesce("product_os_version", F.lit("")).alias("_v"))
            .agg(F.sum("adu_count").alias("_n")))
    hits = combos.join(feed, ["product", "version", "_p"]).where(F.col("os_version").contains(F.col("_v")))
    return hits.groupBy(*keys).agg(F.sum("_n").alias("adu_count"))


def daily_extract(reports: DataFrame, duplicates: DataFrame, associations: DataFrame,
                  raw_adu: DataFrame, day=None, url_base: str = "",
                  products: list[str] | None = None, versions: list[str] | None = None) -> DataFrame:
    """Extract rows with printable cells.

    Users are those of the day after ``day``. Without a day every report is extracted, with
    the users of the day after its own.
    """
    r = reports
    if day is not None:
        r = r.where(utc_day_is(F.col("date_processed"), day))
    if products:
        r = r.where(F.col("product").isin(products))
    if versions:
        r = r.where(F.col("version").isin(versions))
    r = r.withColumn("_adu_day", F.date_add(F.to_date("date_processed"), 1))
    keys = ["product", "version", "os_name", "os_version", "_adu_day"]
    combos = r.select(*keys).distinct().withColumn("_p", F.substring("os_name", 1, 3))
    feed = (raw_adu.groupBy(F.col("product_name").alias("product"),
                            F.col("product_version").alias("version"),
                            F.substring("product_os_platform", 1, 3).alias("_p"),
                            F.col("adu_date").alias("_adu_day"), "product_os_version")
            .agg(F.sum("adu_count").alias("_n")))
    users = (combos.join(feed, ["product", "version", "_p", "_adu_day"])
             .where(F.col("os_version").contains(F.col("product_os_version")))
             .groupBy(*keys).agg(F.sum("_n").alias("adu_count")))
    bugs = associations.groupBy("signature").agg(
        F.array_join(F.array_sort(F.collect_list("bug_id")).cast("array<string>"), ",").alias("bug_list"))
    links = duplicates.groupBy("uuid").agg(F.min("duplicate_of").alias("duplicate_of"))
    r = (r.drop("duplicate_of").join(users, keys, "left").join(bugs, "signature", "left")
         .join(links, "uuid", "left"))
    stamp = lambda c: F.date_format(c, "yyyyMMddHHmm")
    raw = r.select(
        "uuid", "signature", "url", F.concat(F.lit(url_base), "uuid").alias("uuid_url"),
        stamp("client_crash_date").alias("client_crash_date"),
        stamp("date_processed").alias("date_processed"), "last_crash", "product", "version",
        "build", F.lit("").alias("branch"), F.trim("os_name").alias("os_name"),
        P.linux_version(F.trim("os_name"), F.col("os_version")).alias("os_version"),
        F.concat("cpu_name", F.lit(" | "), "cpu_info").alias("cpu_info"), "address",
        F.coalesce("bug_list", F.lit("")).alias("bug_list"),
        F.replace("user_comments", F.lit("\t"), F.lit(" ")).alias("user_comments"),
        F.col("uptime").alias("uptime_seconds"), X.useful_email(F.col("email")).alias("email"),
        "adu_count", "topmost_filenames",
        F.when(F.col("addons_checked").isNull(), F.lit("[unknown]"))
        .when(F.col("addons_checked"), F.lit("checked")).otherwise(F.lit("not"))
        .alias("addons_checked"),
        "flash_version", F.col("hang_id").alias("hangid"), "reason", "process_type", "app_notes",
        "install_age", "duplicate_of", "release_channel", "productid")
    return raw.select("uuid", *[X.cell(F.col(c)).alias(c) for c in EXTRACT_COLUMNS])


def extract_csv(extract: DataFrame) -> DataFrame:
    """The 30 columns in order, sorted by processing time."""
    return extract.orderBy("date_processed", "uuid").select(*EXTRACT_COLUMNS)
