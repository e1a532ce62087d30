"""Hang pairs: the browser side and the plugin side of one hang."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions.times import days_between, ts_in_days
from crashlake.operators import common as C


def daily_hangs(clean: DataFrame, user_info: DataFrame, start=None, end=None) -> DataFrame:
    """One row per plugin report of a hang, with its browser side.

    The browser report must have a user-info row of the plugin report's day. Browser rows
    are reduced to one per hang and day before the join, so a hang id with many reports
    never gives all pairs. Duplicate leaders are listed once each, in order.
    """
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end))) \
        .where(F.coalesce(F.col("hang_id"), F.lit("")) != "")
    kind = F.lower("process_type")
    info = user_info.where(ts_in_days(F.col("date_processed"), start, end)) \
        .select("uuid", F.to_date("date_processed").alias("report_date"), "url")
    browser = (r.where((kind == "browser") & F.col("signature").startswith("hang | "))
               .join(info, ["uuid", "report_date"])
               .groupBy("hang_id", "report_date").agg(
                   F.min("uuid").alias("uuid"),
                   F.min("product_version_id").alias("product_version_id"),
                   F.min("signature").alias("browser_signature"),
                   F.collect_set("duplicate_of").alias("_dups"), F.min("url").alias("url")))
    plugin = r.where(kind == "plugin").select(
        "hang_id", "report_date", F.col("uuid").alias("plugin_uuid"),
        F.col("signature").alias("plugin_signature"), "flash_version",
        F.col("duplicate_of").alias("_dup"))
    all_dups = F.array_sort(F.array_distinct(F.array_compact(F.concat("_dups", F.array("_dup")))))
    return plugin.join(browser, ["hang_id", "report_date"]).select(
        "uuid", "plugin_uuid", "report_date", "product_version_id", "browser_signature",
        "plugin_signature", "hang_id", "flash_version",
        F.when(F.size(all_dups) > 0, all_dups).alias("duplicates"), "url")


def hang_report(hangs: DataFrame, product_versions: DataFrame) -> DataFrame:
    """Hang pairs with product and version names."""
    pv = product_versions.select("product_version_id", F.col("product_name").alias("product"),
                                 F.col("version_string").alias("version"))
    return hangs.join(pv, "product_version_id").select(
        "product", "version", "browser_signature", "plugin_signature",
        F.col("hang_id").alias("browser_hangid"), "flash_version", "url", "uuid", "duplicates",
        F.col("report_date").alias("report_day"), "plugin_uuid")


def _hang_rows(report: DataFrame, product: str, version: str, end, days: int) -> DataFrame:
    first = F.date_sub(F.lit(end).cast("date"), days)
    return report.where((F.lower("product") == product.lower())
                        & (F.lower("version") == version.lower())
                        & days_between(F.col("report_day"), first, None))


def hang_report_page(report: DataFrame, product: str, version: str, end, days: int,
                     size: int, number: int = 1) -> DataFrame:
    """One page of the hang report, newest day first."""
    rows = _hang_rows(report, product, version, end, days)
    return C.page(rows, [F.desc("report_day"), "uuid", "plugin_uuid"], size, number)


def hang_report_counts(report: DataFrame, product: str, version: str, end, days: int,
                       size: int) -> DataFrame:
    return C.page_count(_hang_rows(report, product, version, end, days), size)


def paired_uuid(clean: DataFrame, uuid: str, hang_id: str | None = None) -> DataFrame:
    """Ids of the other reports of a crash's hang, within a day of it.

    The day comes from the crash id, so only three days of facts are read.
    """
    from crashlake.functions.times import ooid_date
    day = ooid_date(F.lit(uuid))
    ts = F.col("date_processed")
    near = (ts >= F.date_sub(day, 1).cast("timestamp")) & (ts < F.date_add(day, 2).cast("timestamp"))
    around = clean.where(near).select("uuid", "hang_id")
    if hang_id is not None:
        hit = around.where(F.col("hang_id") == hang_id)
    else:
        own = around.where(F.col("uuid") == uuid).select("hang_id")
        hit = around.join(own.where(F.col("hang_id").isNotNull()).distinct(), "hang_id", "left_semi")
    return hit.where(F.col("uuid") != uuid).select("uuid")


def hang_pairs(clean: DataFrame) -> DataFrame:
    """For every report of a hang, the first other report of the hang on the same day.

    Batch form of the lookup above: two smallest ids per hang and day, no pairs of pairs.
    """
    r = C.report_day(clean.where(F.coalesce(F.col("hang_id"), F.lit("")) != ""))
    lowest = r.groupBy("hang_id", "report_date").agg(F.min("uuid").alias("_a"))
    rest = r.join(lowest, ["hang_id", "report_date"]).where(F.col("uuid") != F.col("_a"))
    second = rest.groupBy("hang_id", "report_date", "_a").agg(F.min("uuid").alias("_b"))
    return r.join(second, ["hang_id", "report_date"]).select(
        "uuid", "hang_id", "report_date",
        F.when(F.col("uuid") == F.col("_a"), F.col("_b")).otherwise(F.col("_a")).alias("paired"))
