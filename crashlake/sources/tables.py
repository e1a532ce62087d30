"""Stored tables: weekly facts, daily marts, retention and reduced copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_weekly(df: DataFrame, path: str, ts: str = "date_processed", mode: str = "append") -> None:
    """Rows go to the partition of their Monday; ``overwrite`` replaces whole weeks only."""
    week = F.to_date(F.date_trunc("week", F.col(ts)))
    rows = df.withColumn("week", week)
    # every writer task holds a share of each week: no shuffle, and files of even size
    (rows.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy("week").parquet(path))


def read_weekly(spark: SparkSession, path: str, start=None, end=None,
                ts: str = "date_processed") -> DataFrame:
    """Rows of closed days ``[start, end]``; other weeks are not even listed."""
    df = spark.read.parquet(path)
    if start is not None:
        first = F.lit(start).cast("date")
        df = df.where((F.col("week") >= F.to_date(F.date_trunc("week", first)))
                      & (F.col(ts) >= first.cast("timestamp")))
    if end is not None:
        last = F.lit(end).cast("date")
        df = df.where((F.col("week") <= last) & (F.col(ts) < F.date_add(last, 1).cast("timestamp")))
    return df


def stored_signature(df: DataFrame) -> DataFrame:
    """A missing signature is stored as ``##null##`` and a blank one as ``##empty##``."""
    s = F.col("signature")
    return df.withColumn("signature", F.when(s.isNull(), F.lit("##null##"))
                         .when(s == "", F.lit("##empty##")).otherwise(s))


def loaded_signature(df: DataFrame) -> DataFrame:
    s = F.col("signature")
    return df.withColumn("signature", F.when(s == "##null##", F.lit(None).cast("string"))
                         .when(s == "##empty##", F.lit("")).otherwise(s))


def write_processed(df: DataFrame, path: str) -> None:
    """Processed crashes by day."""
    rows = stored_signature(df).withColumn("processed_date", F.to_date("date_processed"))
    rows.write.mode("append").partitionBy("processed_date").parquet(path)


def apply_retention(spark: SparkSession, path: str, cutoff, partition: str = "week") -> int:
    """Drop the partitions before a cutoff day; gives the number dropped.

    Whole partition folders go, nothing is rewritten.
    """
    days = [r[0] for r in spark.read.parquet(path).select(partition).distinct()
            .where(F.col(partition) < F.lit(cutoff).cast("date")).collect()]
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for day in days:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, f"{partition}={day}"), True)
    return len(days)


def keep_recent(df: DataFrame, cutoff, day: str) -> DataFrame:
    """Rows of and after the cutoff day, as a partition or range filter."""
    return df.where(F.col(day) >= F.lit(cutoff))


# Day column by which a table is cut in a reduced copy; None empties it.
COPY_DAY = {
    "raw_adu": "adu_date", "product_adu": "adu_date", "tcbs": "report_date",
    "tcbs_build": "build_date", "reports_duplicates": "date_processed",
    "daily_hangs": "report_date", "build_adu": "build_date", "crashes_by_user": "report_date",
    "crashes_by_user_build": "build_date", "home_page_graph": "report_date",
    "home_page_graph_build": "build_date", "nightly_builds": "report_date",
    "sessions": None, "server_status": None, "reports_bad": None,
}


def mini_copy(tables: dict[str, DataFrame], cutoff) -> dict[str, DataFrame]:
    """Reduced warehouse: marts from the cutoff on, some empty, dimensions whole.

    Releases reach back another 180 days.
    """
    from crashlake.functions.versions import build_date
    out = {}
    for name, df in tables.items():
        if name == "releases_raw":
            first = F.date_sub(F.lit(cutoff).cast("date"), 180)
            out[name] = df.where(build_date(F.col("build_id")) >= first)
        elif name in COPY_DAY:
            day = COPY_DAY[name]
            out[name] = df.where(F.lit(False)) if day is None else \
                df.where(F.col(day) >= F.lit(cutoff).cast("date"))
        else:
            out[name] = df
    return out


def write_copy(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
