"""Raw crash store: ingest, scans, samples, exports and the mover."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from crashlake.functions.times import ooid_date, uuid_to_date, with_ooid
from crashlake.operators.rules import DISCARD, throttle

JSON_MAP = "map<string,string>"


def ingest_raw(df: DataFrame, rules: list[tuple], minimal: dict[str, str] | None = None,
               never_discard: bool = True, bucket: Column | None = None) -> DataFrame:
    """Form submissions -> raw crashes with id, submit time, throttle verdict and day.

    Input: ``form`` (map), ``received`` (timestamp), ``dump`` and, if the client has one,
    ``uuid``. Discarded crashes are left out. Works on batch and stream.
    """
    base = df if "uuid" in df.columns else with_ooid(df, "received")
    raw = base.withColumn("raw", F.map_filter(
        "form", lambda k, v: k != "upload_file_minidump")).drop("form")
    out = throttle(raw, rules, minimal=minimal, never_discard=never_discard, bucket=bucket)
    return (out.where(F.col("legacy_processing") != DISCARD)
            .withColumnRenamed("received", "submitted_timestamp")
            .withColumn("submit_date", F.to_date("submitted_timestamp")))


def parse_json(c: Column) -> Column:
    """JSON text -> map of texts; bad JSON gives an empty map."""
    return F.coalesce(F.from_json(c, JSON_MAP), F.create_map().cast(JSON_MAP))


def prefix_range(prefix: str) -> tuple[dt.date, dt.date]:
    """Days that a ``yymmdd`` prefix (2, 4 or 6 digits) stands for."""
    if len(prefix) not in (2, 4, 6) or not prefix.isdigit():
        raise ValueError("a date prefix has 2, 4 or 6 digits")
    year = 2000 + int(prefix[:2])
    first_month, last_month = (int(prefix[2:4]),) * 2 if len(prefix) > 2 else (1, 12)
    if len(prefix) == 6:
        day = dt.date(year, first_month, int(prefix[4:]))
        return day, day
    return (dt.date(year, first_month, 1),
            dt.date(year, last_month, calendar.monthrange(year, last_month)[1]))


def scan_date(df: DataFrame, prefix: str, ordered: bool = False) -> DataFrame:
    """Crashes submitted on the days of a prefix; a filter on the day partition."""
    first, last = prefix_range(prefix)
    rows = df.where(F.col("submit_date").between(F.lit(first), F.lit(last)))
    return rows.orderBy("submitted_timestamp", "uuid") if ordered else rows


def _drawn(seed: int) -> list[Column]:
    """Order of a draw: the md5 of seed and id, which any engine computes alike."""
    return [F.md5(F.concat(F.lit(f"{seed}|"), F.col("uuid"))), F.col("uuid")]


def sample_crashes(df: DataFrame, n: int, dates: list | None = None, seed: int = 0) -> DataFrame:
    """Uniform sample of n crashes of the given days, the same at every run of a seed.

    The n smallest by md5 are kept: every task keeps its own n, and those are merged.
    """
    rows = df if dates is None else df.where(
        F.col("submit_date").isin([F.lit(d).cast("date") for d in dates]))
    return rows.orderBy(*_drawn(seed)).limit(n)


def sample_by_day(df: DataFrame, n: int, day: str = "submit_date", seed: int = 0) -> DataFrame:
    """Uniform sample of up to n crashes of every day, the same at every run of a seed.

    Ids alone are ranked, and each task drops all but its n smallest of a day before they are
    shuffled, so a day's task sees n ids for every task before it, not the day. The rows are
    then found by a semi join on day and id.
    """
    rank = F.row_number().over(Window.partitionBy(day).orderBy(*_drawn(seed)))
    ids = df.select(day, "uuid").withColumn("_rank", rank).where(F.col("_rank") <= n).select(day, "uuid")
    return df.join(ids, [day, "uuid"], "left_semi")


def export_for_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Crashes whose id is listed; the days in the ids cut the scan to their partitions."""
    wanted = ids.select("uuid", uuid_to_date(F.col("uuid")).alias("_d")).distinct()
    bounds = wanted.agg(F.min("_d").alias("a"), F.max("_d").alias("b"))
    low, high = bounds.select("a").scalar(), bounds.select("b").scalar()
    # the submit day can differ from the id's day around midnight
    near = (F.col("submit_date") >= F.date_sub(low, 1)) & (F.col("submit_date") <= F.date_add(high, 1))
    return df.where(near).join(wanted.select("uuid"), "uuid", "left_semi")


CRASH_KINDS = {"meta": ["uuid", "raw", "submitted_timestamp"], "raw": ["uuid", "dump"]}


def get_crash(df: DataFrame, uuid: str, kind: str = "processed", day: str | None = None) -> DataFrame:
    """One crash by id. The day in the id prunes the partitions, a day either side."""
    rows = df.where(F.col("uuid") == uuid)
    if day is not None:
        at = ooid_date(F.lit(uuid))
        rows = rows.where(F.col(day).between(F.date_sub(at, 1), F.date_add(at, 1)))
    return rows.select(*CRASH_KINDS[kind]) if kind in CRASH_KINDS else rows


def read_json_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of raw JSON lines ``{"uuid", "submitted_timestamp", "dump", …fields}``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return raw_from_json(reader.load(path))


def raw_from_json(lines: DataFrame) -> DataFrame:
    """Lines of JSON -> raw crashes; a bad line keeps an empty document and a NULL id."""
    m = lines.select(parse_json(F.col("value")).alias("m"))
    meta = ("uuid", "submitted_timestamp", "dump", "legacy_processing")
    ts = F.col("m")["submitted_timestamp"].try_cast("timestamp")
    return m.select(
        F.col("m")["uuid"].alias("uuid"),
        F.map_filter("m", lambda k, v: ~k.isin(*meta)).alias("raw"),
        ts.alias("submitted_timestamp"), F.col("m")["dump"].alias("dump"),
        F.coalesce(F.col("m")["legacy_processing"].try_cast("int"), F.lit(0))
        .alias("legacy_processing"), F.to_date(ts).alias("submit_date"))


def move_raw(spark: SparkSession, src: str, dst: str, checkpoint: str):
    """Copy everything new from one store to the other, then stop; restarts lose nothing."""
    return (read_json_stream(spark, src).writeStream.format("parquet")
            .option("path", dst).option("checkpointLocation", checkpoint)
            .partitionBy("submit_date").trigger(availableNow=True).start())
