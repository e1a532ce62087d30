"""Top-crasher marts and their rankings.

All builders take a closed range of days and do any number of days in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crashlake.functions import metrics as M, versions as V
from crashlake.functions.times import ts_in_days
from crashlake.operators import common as C

TCBS_KEYS = ["signature", "report_date", "product_version_id", "process_type", "release_channel"]


def _counts() -> list:
    os_count = lambda name: F.count_if(F.col("os_name") == name)
    return [F.count(F.lit(1)).alias("report_count"), os_count("Windows").alias("win_count"),
            os_count("Mac OS X").alias("mac_count"), os_count("Linux").alias("lin_count"),
            F.count("hang_id").alias("hang_count"),
            F.count_if(F.col("uptime") < 60).alias("startup_count")]


COUNT_COLUMNS = ["report_count", "win_count", "mac_count", "lin_count", "hang_count",
                 "startup_count"]


def _sums() -> list:
    return [F.sum(c).alias(c) for c in COUNT_COLUMNS]


def tcbs(clean: DataFrame, product_versions: DataFrame, start=None, end=None) -> DataFrame:
    """Crash counts per signature, day, version, process type and channel.

    Facts are reduced before they meet the versions; rows of rapid betas are added to their
    parents by the same job.
    """
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    counted = r.groupBy(*TCBS_KEYS).agg(*_counts())
    pv = product_versions.select("product_version_id", "build_date", "sunset_date",
                                 "rapid_beta_id", F.lower("build_type").alias("_type"))
    rows = counted.join(pv, "product_version_id").where(C.live_on(F.col("report_date")))
    rows = C.to_parents(rows, include_self=True, cond=F.col("_type") == "beta")
    return rows.groupBy(*TCBS_KEYS).agg(*_sums())


def tcbs_build(clean: DataFrame, product_versions: DataFrame, start=None, end=None) -> DataFrame:
    """The same by build date, over the seven days after each build.

    Nightlies and auroras whose version fits the channel, and betas under their parents.
    """
    keys = ["signature", "report_date", "build_date", "product_version_id", "process_type",
            "release_channel"]
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    r = r.where(F.lower("release_channel").isin("nightly", "aurora", "beta")) \
        .withColumn("build_date", V.build_date(F.col("build"))) \
        .where(F.col("report_date") <= F.date_add("build_date", 6))
    counted = r.groupBy(*keys).agg(*_counts())
    pv = product_versions.select("product_version_id", F.col("build_date").alias("_from"),
                                 F.col("sunset_date").alias("_to"), "rapid_beta_id",
                                 "version_string")
    rows = counted.join(pv, "product_version_id") \
        .where(F.col("report_date").between(F.col("_from"), F.col("_to")))
    beta = F.lower("release_channel") == "beta"
    fits = V.version_matches_channel(F.col("version_string"), F.col("release_channel"))
    target = F.when(beta, F.col("rapid_beta_id")).when(fits, F.col("product_version_id"))
    return rows.withColumn("product_version_id", target) \
        .where(F.col("product_version_id").isNotNull()).groupBy(*keys).agg(*_sums())


#: Names of the four levels, by what is kept besides version and signature.
LEVELS = {(0, 0): "process_type and release_channel", (0, 1): "process_type",
          (1, 0): "release_channel", (1, 1): "All"}


def tcbs_ranking(tcbs_rows: DataFrame, start=None, end=None) -> DataFrame:
    """Rank of every signature at four levels of detail, day by day, over all versions."""
    r = tcbs_rows
    if start is not None or end is not None:
        from crashlake.functions.times import days_between
        r = r.where(days_between(F.col("report_date"), start, end))
    base = ["report_date", "product_version_id", "signature"]
    day, pv, sig, pt, ch = (F.col(c) for c in (*base, "process_type", "release_channel"))
    summed = r.groupingSets(
        [[day, pv, sig], [day, pv, sig, pt], [day, pv, sig, ch], [day, pv, sig, pt, ch]],
        day, pv, sig, pt, ch,
    ).agg(F.sum("report_count").alias("report_count"),
          F.grouping("process_type").alias("_gp"), F.grouping("release_channel").alias("_gc"))
    level = None
    for (gp, gc), name in LEVELS.items():
        hit = (F.col("_gp") == gp) & (F.col("_gc") == gc)
        level = F.when(hit, F.lit(name)) if level is None else level.when(hit, F.lit(name))
    rows = summed.withColumn("aggregation_level", level).drop("_gp", "_gc")
    keys = ["report_date", "aggregation_level"]
    return C.dense_rank_by(rows, keys, "report_count", "rank_report_count", "total_reports")


def rank_compare(clean: DataFrame, start=None, end=None) -> DataFrame:
    """Count, rank and share of every signature within its version and day."""
    keys = ["report_date", "product_version_id"]
    r = C.report_day(clean.where(ts_in_days(F.col("date_processed"), start, end)))
    counts = r.groupBy(*keys, "signature").agg(F.count(F.lit(1)).alias("report_count"))
    rows = C.dense_rank_by(counts, keys, "report_count", "rank_report_count", "total_reports")
    share = F.round(F.col("report_count") / F.col("total_reports"), 5)
    return rows.withColumns({"rank_days": F.lit(1), "percent_of_total": share})


def top_signatures(reports: DataFrame, product_end, associations: DataFrame | None = None,
                   days: int = 14, n: int = 500) -> DataFrame:
    """The n signatures with most crashes in the ``days`` up to an end day, per the docs:
    count, mean uptime and bug list. Any end day can be computed again at any time."""
    end = F.lit(product_end).cast("date")
    r = reports.where((F.col("date_processed") >= F.date_sub(end, days - 1).cast("timestamp"))
                      & (F.col("date_processed") < F.date_add(end, 1).cast("timestamp")))
    top = (r.groupBy("signature").agg(F.count(F.lit(1)).alias("report_count"),
                                      F.round(F.avg("uptime"), 3).alias("mean_uptime"))
           .orderBy(F.desc("report_count"), "signature").limit(n))
    if associations is None:
        return top
    bugs = associations.groupBy("signature").agg(
        F.array_sort(F.collect_list("bug_id")).alias("bug_list"))
    return top.join(bugs, "signature", "left")


def csv_rows(top: DataFrame) -> DataFrame:
    """Text-safe columns of the top-crasher download, in its order of columns."""
    sig = F.replace(F.replace(F.replace(F.col("signature"), F.lit(","), F.lit(" ")),
                              F.lit("\n"), F.lit(" ")), F.lit('"'), F.lit("&quot;"))
    return top.select(
        F.col("current_rank").alias("Rank"),
        F.coalesce(F.col("change_in_rank").cast("string"), F.lit("new")).alias("Change In Rank"),
        F.col("percent_of_total").alias("Percentage of All Crashes"),
        F.coalesce(F.col("previous_percent_of_total").cast("string"), F.lit("null"))
        .alias("Previous Percentage"),
        sig.alias("Signature"), F.col("report_count").alias("Total"),
        F.col("win_count").alias("Win"), F.col("mac_count").alias("Mac"),
        F.col("lin_count").alias("Linux"), F.col("versions_count").alias("Version Count"),
        F.replace("versions", F.lit(","), F.lit(";")).alias("Versions"))


def type_counts() -> list:
    """Content and plugin counts over mart rows."""
    return [M.content_count(F.col("process_type"), F.col("report_count")).alias("content_count"),
            M.plugin_count(F.col("process_type"), F.col("report_count")).alias("plugin_count")]
