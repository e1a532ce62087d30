"""Registered queries of feeds, jobs and streams that write: into the session's folder, and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from crashlake.operators import extract
from crashlake.plans import jobs as J
from crashlake.plans.checks_marts import _CLEAN, _sig_count_sql
from crashlake.plans.checks_streams import LATE
from crashlake.plans.checks_text import THROTTLE, _raw
from crashlake.plans.registry import Context, query
from crashlake.plans.warehouse import Warehouse
from crashlake.sources import exports, feeds, raw
from crashlake.streaming import jobs as S
from crashlake.streaming.replay import drain, replay, stream_folder

FIRST, LAST = dt.date(2024, 1, 3), dt.date(2024, 1, 5)
_DAYS = f"BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"


def _csv(df, c: Context, name: str) -> str:
    path = stream_folder(c.spark, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


_ADU = ("adu_count", "product_name", "product_os_platform", "product_os_version", "product_version", "build", "build_channel", "product_guid")


def _adu_feed(c: Context) -> str:
    return _csv(c.t("raw_adu").select("adu_count", F.concat(F.col("adu_date").cast("string"), F.lit(" 00:00:00")).alias("date"), *_ADU[1:]), c, "adu")


@query("a4_adu_feed", "SELECT adu_date, " + ", ".join(_ADU).replace("product_os_version", "nullif(product_os_version, '') AS product_os_version") + " FROM raw_adu",
       text=("adu_date",))
def _(c: Context):
    """An empty cell of the feed is NULL."""
    return feeds.load_raw_adu(c.spark, _adu_feed(c)).select("adu_date", *_ADU)


@query("a6_bug_feed", """SELECT event_id AS bug_id, CASE WHEN k % 5 = 0 THEN 'NEW' ELSE 'RESOLVED' END AS bug_status, CASE WHEN k % 3 = 0 THEN 'FIXED' END AS resolution,
 concat('said "', event_type, '", ', CAST(k AS STRING)) AS short_desc, concat('[@ sig_', CAST(k % 20 AS STRING), ' ]', chr(10), '[@ f(int, char) ]') AS cf_crash_signature FROM ev""")
def _(c: Context):
    k = F.col("k")
    rows = c.t("ev").select(
        F.col("event_id").alias("bug_id"), F.when(k % 5 == 0, "NEW").otherwise("RESOLVED").alias("bug_status"), F.when(k % 3 == 0, "FIXED").alias("resolution"),
        F.concat(F.lit('said "'), "event_type", F.lit('", '), k.cast("string")).alias("short_desc"),
        F.concat(F.lit("[@ sig_"), (k % 20).cast("string"), F.lit(" ]\n[@ f(int, char) ]")).alias("cf_crash_signature"))
    return feeds.load_bugs(c.spark, _csv(rows, c, "bugs"))


@query("a8_module_feed", """SELECT DISTINCT concat('lib', CAST(k % 8 AS STRING), '.dll') AS filename, concat('lib', CAST(k % 8 AS STRING), '.pdb') AS debug_file, concat('ID', CAST(k AS STRING)) AS debug_id,
 CASE WHEN k % 4 > 0 THEN concat('1.', CAST(k % 4 AS STRING)) END AS module_version, product, version, os_name, reason FROM reports""")
def _(c: Context):
    k = F.col("k")
    rows = c.t("reports").select(
        F.concat(F.lit("lib"), (k % 8).cast("string"), F.lit(".dll")).alias("filename"), F.concat(F.lit("lib"), (k % 8).cast("string"), F.lit(".pdb")).alias("debug_file"),
        F.concat(F.lit("ID"), k.cast("string")).alias("debug_id"), F.when(k % 4 > 0, F.concat(F.lit("1."), (k % 4).cast("string"))).alias("module_version"),
        "product", "version", "os_name", "reason")
    return feeds.load_modules(c.spark, _csv(rows, c, "modules")).distinct()


def _warehouse(c: Context, **tables) -> Warehouse:
    w = Warehouse(c.spark, stream_folder(c.spark, "warehouse"))
    dims = {"product_versions": c.pv, "product_version_builds": c.t("product_version_builds"), "product_productid_map": c.t("guid_map"),
            "os_name_matches": c.tables.small("os_matches"), "release_channel_matches": c.tables.small("channel_matches"),
            "windows_versions": c.tables.small("windows_versions"), "uptime_levels": c.t("uptime_levels")}
    for name, df in {**dims, **tables}.items():
        w.write(name, df)
    return w


@query("a7_bulk_load_backfill", f"SELECT * FROM product_adu WHERE adu_date {_DAYS}", text=("adu_date",))
def _(c: Context):
    """The users' table loaded in bulk, then its view rebuilt for three days, twice."""
    w = _warehouse(c, raw_adu=feeds.load_lookup(c.spark, "raw_adu", _adu_feed(c)))
    for _ in range(2):
        J.backfill(w, FIRST, LAST, dt.date(2024, 2, 1), ["product_adu"])
    return w.table("product_adu")


_EXTRACT = ("signature", "url", "product", "version", "email", "uptime_seconds", "process_type", "release_channel", "productid")


@query("a9_daily_extract_files", f"""SELECT side, coalesce(signature, '\\N') AS signature, CASE WHEN side = 'public' THEN 'URL (removed)' ELSE coalesce(url, '\\N') END AS url, product, version,
 CASE WHEN side = 'private' AND email LIKE '%@%' THEN 'yes' END AS email, CAST(uptime AS STRING) AS uptime_seconds, coalesce(process_type, '\\N') AS process_type, release_channel, productid
FROM reports, (VALUES ('private'), ('public')) AS v(side) WHERE report_date = DATE '{LAST}'""")
def _(c: Context):
    none = c.spark.createDataFrame([], "uuid string, duplicate_of string")
    assoc = c.spark.createDataFrame([], "signature string, bug_id long")
    day = extract.daily_extract(c.t("reports"), none, assoc, c.t("raw_adu"), LAST)
    folder = stream_folder(c.spark, "extract")
    paths = exports.write_daily_extract(day, LAST, f"{folder}/private", f"{folder}/public")
    read = [c.spark.read.option("header", True).option("sep", "\t").csv(p).select(F.lit(side).alias("side"), *_EXTRACT)
            for p, side in zip(paths, ("private", "public"))]
    return read[0].unionByName(read[1])


@query("k2_stream_recent", """SELECT w + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS "count", round(avg(value), 6) AS mean_duration FROM (
 SELECT event_type, value, unnest([date_trunc('minute', ts), date_trunc('minute', ts) - INTERVAL 1 MINUTE, date_trunc('minute', ts) - INTERVAL 2 MINUTE, date_trunc('minute', ts) - INTERVAL 3 MINUTE, date_trunc('minute', ts) - INTERVAL 4 MINUTE]) AS w FROM ev) AS q GROUP BY ALL""",
       text=("window_end",))
def _(c: Context):
    events = replay(c.t("ev").select("event_id", "ts", "event_type", "value"), "recent", "ts", by="event_id")
    out = drain(S.recent_counts(events, 5, "event_type", duration="value", late=LATE), "windows")
    return out.withColumns({"mean_duration": F.round("mean_duration", 6), "window_end": F.date_format("window_end", "yyyy-MM-dd HH:mm:ss")})


@query("k5_stream_throttle", """SELECT event_id, CASE WHEN accepted THEN 0 WHEN p0 AND (k % 20 > 10 OR (k % 20 = 10 AND user_id % 10 >= 5)) THEN 2 ELSE 1 END AS verdict FROM (
 SELECT *, k % 10 <> 9 AND user_id % 3 = 0 AS p0, k % 9 = 0 OR k % 3 <> 2 OR CASE WHEN k % 10 = 9 THEN false WHEN user_id % 3 = 0 THEN user_id % 100 < 10 WHEN user_id % 3 = 1 THEN user_id % 100 < 50 ELSE false END AS accepted FROM ev) AS q""")
def _(c: Context):
    crashes = replay(_raw(c).select("event_id", "raw", "user_id", "submitted_timestamp"), "raw", "submitted_timestamp", by="event_id").where("event_id IS NOT NULL")
    out = S.throttled(crashes, THROTTLE, minimal={"Product0": "10.5"}, never_discard=False, bucket=F.col("user_id") % 100, out="verdict")
    return drain(out.select("event_id", "verdict"), "verdicts")


@query("k6_stream_first_seen", "SELECT uuid, date_processed FROM reports", text=("date_processed",))
def _(c: Context):
    """Every report is sent twice, in different batches."""
    r = c.t("reports").select("uuid", "date_processed")
    twice = r.withColumn("sent", F.explode(F.array(F.concat("uuid", F.lit("a")), F.concat(F.lit("b"), "uuid"))))
    return drain(S.first_seen_only(replay(twice, "sent", "date_processed", by="sent"), late=LATE), "seen").where("uuid IS NOT NULL").drop("sent")


@query("k9_stream_clean", f"SELECT {_CLEAN} FROM clean", text=("date_processed", "client_crash_date"))
def _(c: Context):
    """Facts appended batch by batch; a second stream sees every report again and adds none."""
    folder = stream_folder(c.spark, "hourly")
    for run in ("one", "two"):
        S.append_clean(replay(c.t("reports"), "arrived", "date_processed").where("uuid IS NOT NULL"), c.dims, f"{folder}/clean", f"{folder}/info",
                       f"{folder}/bad", f"{folder}/{run}").awaitTermination()
    return c.spark.read.parquet(f"{folder}/clean").drop("week", "epoch", "duplicate_of")


@query("k10_mover_restarts", "SELECT uuid, product, report_date AS submit_date FROM reports", text=("submit_date",))
def _(c: Context):
    """Half of the files are moved, then the mover is started anew upon all of them."""
    folder = stream_folder(c.spark, "mover")
    lines = c.t("reports").select("k", F.to_json(F.struct("uuid", F.date_format("date_processed", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("submitted_timestamp"),
                                                          F.col("product").alias("ProductName"), F.lit("d").alias("dump"))).alias("value"))
    for half in (0, 1):
        lines.where(F.col("k") % 2 == half).select("value").write.mode("append").text(f"{folder}/src")
        raw.move_raw(c.spark, f"{folder}/src", f"{folder}/dst", f"{folder}/checkpoint").awaitTermination()
    return c.spark.read.parquet(f"{folder}/dst").select("uuid", F.col("raw")["ProductName"].alias("product"), "submit_date")


@query("l4_backfill_hours", f"SELECT {_CLEAN} FROM clean WHERE report_date {_DAYS}", text=("date_processed", "client_crash_date"))
def _(c: Context):
    """Three days cleaned in steps of a day, and half of one of them once more in steps of six hours."""
    near = c.t("reports").where(F.col("report_date").between(FIRST - dt.timedelta(1), LAST + dt.timedelta(1)))
    w = _warehouse(c, reports=near)
    start, end = (dt.datetime.combine(d, dt.time()) for d in (FIRST, LAST + dt.timedelta(1)))
    J.clean_hours(w, start, end, 24)
    J.clean_hours(w, start, start + dt.timedelta(hours=12), 6)
    return w.table("reports_clean").drop("week", "hour", "duplicate_of")


@query("l5_backfill_signature_counts", f"SELECT * FROM ({_sig_count_sql('uptime_level', 'JOIN uptime_levels ON uptime >= min_uptime AND uptime < max_uptime')}) AS q WHERE report_date {_DAYS}",
       text=("report_date",))
def _(c: Context):
    w = _warehouse(c, reports_clean=c.clean)
    J.backfill_signature_counts(w, FIRST, LAST, ("uptime",))
    return w.table("uptime_signature_counts")


@query("l7_catch_up", f"SELECT * FROM product_adu WHERE adu_date {_DAYS}", text=("adu_date",))
def _(c: Context):
    """The first day is run once (L1), then every day missed since; views come in the order of their needs (L6)."""
    w = _warehouse(c, raw_adu=c.t("raw_adu"))
    J.run_day(w, J.order(["crashes_by_user"])[0], FIRST)
    J.catch_up(w, "product_adu", LAST)
    return w.table("product_adu")


@query("l13_reprocess", "SELECT uuid, upper(product) AS product, date_processed FROM reports WHERE k % 7 = 0", text=("date_processed",))
def _(c: Context):
    """Picked crashes of the first half, then those since; a third run finds nothing new."""
    crashes = c.t("reports").select("uuid", "product", F.col("date_processed").alias("submitted_timestamp"), "k")
    half = F.col("submitted_timestamp") < "2024-01-15"
    w = _warehouse(c, raw_crashes=crashes.where(half))
    again = lambda df: df.select("uuid", F.upper("product").alias("product"), F.col("submitted_timestamp").alias("date_processed"))
    for rows in (crashes.where(half), crashes, crashes):
        w.write("raw_crashes", rows)
        J.reprocess(w, lambda df: df.where("k % 7 = 0"), again)
    return w.table("reprocessed")
