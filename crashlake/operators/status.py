"""Health of the pipeline: job queue, freshness, lag, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from crashlake.functions.times import seconds_between


def server_status(jobs: DataFrame, processors: DataFrame, now, interval_s: int = 300) -> DataFrame:
    """One row: newest and oldest job, mean times of recent jobs, waiting jobs, processors."""
    done = F.col("completed_datetime")
    at = F.lit(now).cast("timestamp")
    recent = done > at - F.expr(f"INTERVAL {int(interval_s)} SECOND")

    def mean(start: str):
        return F.coalesce(F.avg(F.when(recent, seconds_between(F.col(start), done))), F.lit(0.0))
    return jobs.agg(
        F.max(done).alias("date_recently_completed"),
        F.min(F.when(done.isNull(), F.col("queued_datetime"))).alias("date_oldest_job_queued"),
        mean("started_datetime").alias("avg_process_sec"),
        mean("queued_datetime").alias("avg_wait_sec"),
        F.count_if(done.isNull()).alias("waiting_job_count"),
    ).withColumns({"processors_count": processors.agg(F.count(F.lit(1))).scalar(),
                   "date_created": at})


def jobs_in_queue(jobs: DataFrame) -> DataFrame:
    return jobs.where(F.col("completed_datetime").isNull()).agg(F.count(F.lit(1)).alias("count"))


def latest_status(statuses: DataFrame, n: int = 1) -> DataFrame:
    return statuses.orderBy(F.desc("date_created")).limit(n)


def seconds_since_last_report(reports: DataFrame, now, days: int = 3) -> DataFrame:
    """Seconds from the newest report to ``now``; the whole look-back when there is none."""
    at = F.lit(now).cast("timestamp")
    first = at - F.expr(f"INTERVAL {int(days)} DAY")
    r = reports.where((F.col("date_processed") > F.date_trunc("day", first))
                      & (F.col("date_processed") < F.date_trunc("day", first)
                         + F.expr(f"INTERVAL {int(days) + 1} DAY")))
    newest = F.coalesce(F.max("date_processed"), first)
    return r.agg(F.round(seconds_between(newest, at)).cast("bigint").alias("seconds"))


def processing_lag(reports: DataFrame, by: str | None = None) -> DataFrame:
    """Least, greatest and mean seconds from arrival to completion."""
    lag = seconds_between(F.col("date_processed"), F.col("completed_datetime"))
    rows = reports.where(F.col("completed_datetime").isNotNull()).withColumn("_lag", lag)
    grouped = rows.groupBy(by) if by else rows.groupBy()
    return grouped.agg(F.round(F.min("_lag"), 3).alias("min_lag"),
                       F.round(F.max("_lag"), 3).alias("max_lag"),
                       F.round(F.avg("_lag"), 3).alias("avg_lag"))


COUNTER_LEVELS = (("minute", "yyyy-MM-dd'T'HH:mm"), ("hour", "yyyy-MM-dd'T'HH"),
                  ("day", "yyyy-MM-dd"), ("month", "yyyy-MM"), ("year", "yyyy"))


def counter_names(verdict: str = "legacy_processing", process_type: str = "process_type",
                  hang: str = "hang_id") -> Column:
    """Names of the counters that a submission adds to."""
    kind = F.coalesce(F.col(process_type), F.lit("default"))
    special = kind != "default"
    hung = special & F.col(hang).isNotNull()
    return F.array_compact(F.array(
        F.lit("submitted_crash_reports"),
        F.concat(F.lit("submitted_crash_reports_legacy_throttle_"), F.col(verdict).cast("string")),
        F.when(hung, F.lit("submitted_crash_report_hang_pairs"))
        .when(special, F.concat(F.lit("submitted_oop_"), kind, F.lit("_crash_reports")))))


def submission_counters(crashes: DataFrame, ts: str = "submitted_timestamp",
                        verdict: str = "legacy_processing", process_type: str = "process_type",
                        hang: str = "hang_id") -> DataFrame:
    """Counters per minute, hour, day, month and year.

    Minutes are counted first; the coarser levels are sums of minutes, so the facts are
    shuffled once and not once per level.
    """
    minute = (crashes.select(F.date_trunc("minute", F.col(ts)).alias("_m"),
                             F.explode(counter_names(verdict, process_type, hang)).alias("counter"))
              .groupBy("_m", "counter").agg(F.count(F.lit(1)).alias("_n")))
    keys = F.array(*[F.date_format("_m", fmt) for _, fmt in COUNTER_LEVELS])
    return (minute.select(F.explode(keys).alias("period"), "counter", "_n")
            .groupBy("period", "counter").agg(F.sum("_n").alias("count")))


def recent_activity(events: DataFrame, minutes: int, member: str, ts: str = "ts",
                    duration: str | None = None) -> DataFrame:
    """Count (and mean duration) of the last N whole minutes, for every minute and member."""
    window = F.window(F.col(ts), f"{int(minutes)} minutes", "1 minute")
    aggs = [F.count(F.lit(1)).alias("count")]
    if duration:
        aggs.append(F.round(F.avg(duration), 6).alias("mean_duration"))
    rows = events.groupBy(window.alias("w"), member).agg(*aggs)
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       member, *[c for c in ("count", "mean_duration") if c in rows.columns])


def under_performing(counts: DataFrame, member: str, value: str) -> DataFrame:
    """Members more than one standard deviation (of the population) below the mean."""
    limit = counts.agg(F.avg(value) - F.stddev_pop(value)).scalar()
    return counts.where(F.col(value) < limit).select(member, value)
