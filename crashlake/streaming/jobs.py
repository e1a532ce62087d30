"""Structured Streaming forms of the continuous and hourly work.

Every builder takes a streaming frame (or a batch one, in tests) and gives a frame or a
started query. Event times are ``timestamp``; late rows are handled by watermarks. Duplicates
and hang pairs are in ``windows``, counters of all levels and pool members in ``states``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from crashlake.operators.clean import Dims, build_reports_clean
from crashlake.operators.processing import process_raw
from crashlake.operators.rules import ESR_RULE, apply_rules, throttle
from crashlake.session import cut_lineage


def recent_counts(events: DataFrame, minutes: int, member: str, ts: str = "ts",
                  duration: str = "duration", late: str = "10 minutes") -> DataFrame:
    """Count and mean duration of the last N minutes, moving by the minute."""
    return (events.withWatermark(ts, late)
            .groupBy(F.window(ts, f"{int(minutes)} minutes", "1 minute").alias("w"), member)
            .agg(F.count(F.lit(1)).alias("count"), F.avg(duration).alias("mean_duration"))
            .select(F.col("w.end").alias("window_end"), member, "count", "mean_duration"))


def processed(raw: DataFrame, rules: list | None = None) -> DataFrame:
    """Continuous raw -> processed transform; stateless, so any trigger will do."""
    return process_raw(apply_rules(raw, [ESR_RULE] if rules is None else rules))


def throttled(raw: DataFrame, rules: list[tuple], **options) -> DataFrame:
    return throttle(raw, rules, **options)


def first_seen_only(reports: DataFrame, ts: str = "date_processed", late: str = "1 day") -> DataFrame:
    """Each crash id once; ids are remembered for as long as late rows may come."""
    return reports.withWatermark(ts, late).dropDuplicatesWithinWatermark(["uuid"])


def _start(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str):
    return (df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _epoch(checkpoint: str, epoch: int) -> str:
    """Name of a batch that no other stream into the same folder uses: every checkpoint counts from 0."""
    return f"run{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{epoch}"


def _stored(spark: SparkSession, path: str, batch: DataFrame, epoch: str) -> DataFrame | None:
    """Rows of earlier batches within a day of this one; None before the first batch.

    Rows of the same epoch are those of a failed attempt, which is about to be replaced.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return None
    low, high = batch.agg(F.min("date_processed"), F.max("date_processed")).first()
    day = dt.timedelta(days=1)
    return df.where((F.col("epoch") != epoch) & F.col("week").between(
        F.lit((low - 8 * day).date()), F.lit((high + day).date()))
        & F.col("date_processed").between(F.lit(low - day), F.lit(high + day)))


def _write_epoch(df: DataFrame, path: str, epoch: str) -> None:
    """Replace what this epoch wrote before: a repeated batch leaves the same rows."""
    week = F.to_date(F.date_trunc("week", F.col("date_processed")))
    (df.withColumns({"week": week, "epoch": F.lit(epoch)}).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("week", "epoch").parquet(path))


def append_clean(reports: DataFrame, dims: Dims, path: str, user_path: str, bad_path: str,
                 checkpoint: str):
    """Hourly cleaning of arriving reports: facts, user info and bad rows.

    Ids that are stored already are skipped, so that reports sent twice count once, also by a
    stream with another checkpoint, whatever its batches hold.
    """
    def each(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        epoch = _epoch(checkpoint, number)
        done = _stored(batch.sparkSession, path, batch, epoch)
        out = build_reports_clean(batch.dropDuplicates(["uuid"]), dims, done)
        out.staged = cut_lineage(out.staged)
        _write_epoch(out.clean, path, epoch)
        _write_epoch(out.user_info, user_path, epoch)
        told = _stored(batch.sparkSession, bad_path, batch, epoch)
        _write_epoch(out.bad if told is None else out.bad.join(told.select("uuid"), "uuid", "left_anti"), bad_path, epoch)
    return _start(reports, each, checkpoint)
