"""Extracts for people outside: daily crash data, top-crasher lists, report dumps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from crashlake.functions.text import bowdlerize
from crashlake.operators.extract import extract_csv
from crashlake.operators.topcrash import csv_rows


def write_daily_extract(extract: DataFrame, day: dt.date, private: str,
                        public: str | None = None) -> list[str]:
    """Tab-separated, gzipped extract of a day, and its public form without person data.

    Each is a folder with a dated name. The header is written only when there are rows, so
    that a day without crashes still has its (empty) folder.
    """
    rows = extract_csv(extract)
    header = not extract.limit(1).isEmpty()
    out = []
    for folder, infix, df in ((private, "", rows), (public, "-pub", bowdlerize(rows))):
        if folder is None:
            continue
        path = f"{folder}/{day:%Y%m%d}{infix}-crashdata.csv.gz"
        (df.write.mode("overwrite").option("sep", "\t").option("compression", "gzip")
         .option("header", header).option("emptyValue", "").csv(path))
        out.append(path)
    return out


def top_crashers_csv(top: DataFrame, path: str) -> None:
    """Download form of a top-crasher list (at most its limit of rows, so one file)."""
    csv_rows(top).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def daily_by_version_csv(daily: DataFrame, path: str) -> None:
    """Crashes per user by day, one row per version and day."""
    rows = daily.select(F.col("report_date").alias("Date"), F.col("product_name").alias("Product"),
                        F.col("version_string").alias("Version"),
                        F.col("report_count").alias("Crashes"), F.col("adu").alias("ADU"),
                        F.concat(F.round(F.col("throttle") * 100, 2), F.lit("%")).alias("Throttle"),
                        F.col("crash_hadu").alias("Ratio"))
    rows.write.mode("overwrite").option("header", True).csv(path)


def recent_days(df: DataFrame, n: int, ts: str = "date_processed") -> DataFrame:
    """Rows of the n most recent days that have any.

    The list of days is small however many rows there are; it is joined as a semi join.
    """
    rows = df.withColumn("day", F.to_date(ts))
    days = rows.select("day").distinct().orderBy(F.desc("day")).limit(n)
    return rows.join(days, "day", "left_semi")


def export_days(df: DataFrame, n: int, path: str, ts: str = "date_processed") -> None:
    recent_days(df, n, ts).write.mode("overwrite").partitionBy("day").json(path)
