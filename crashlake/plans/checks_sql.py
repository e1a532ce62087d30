"""Registered queries written as SQL text, with the library's functions by their SQL names."""

from __future__ import annotations

from crashlake.functions import sql_names
from crashlake.plans.checks_fields import _V
from crashlake.plans.checks_reads import _summary_sql
from crashlake.plans.event_views import sql
from crashlake.plans.registry import Context, query


def _run(c: Context, text: str):
    views = {"events": c.t("events"), "reports_clean": c.clean, "product_versions": c.pv, "uptime_levels": c.t("uptime_levels"),
             "reports": c.t("reports")}
    return sql_names.register(c.spark, views).sql(text)


@query("l12_sql_versions", "WITH " + _V + """SELECT event_id, concat(p2, CASE WHEN kind = 5 THEN '002' ELSE '000' END,
  CASE ch WHEN 'release' THEN 'r000' WHEN 'aurora' THEN 'a002' WHEN 'nightly' THEN 'a001' WHEN 'ESR' THEN 'x000'
   ELSE CASE kind WHEN 1 THEN 'b001' WHEN 2 THEN 'b002' WHEN 3 THEN concat('b00', CAST(bn AS STRING)) ELSE 'b099' END END) AS by_channel,
 concat(p2, CASE WHEN kind = 5 THEN '002' ELSE '000' END, 'b00', CAST(bn AS STRING)) AS by_beta, p2 AS major_sort,
 concat(p2, CASE WHEN kind = 5 THEN '002' ELSE '000' END, CASE WHEN kind IN (1, 2, 3, 4, 5) THEN 'b' ELSE 'z' END, '000') AS old,
 concat(CAST(maj AS STRING), '.', CAST(mino AS STRING)) AS major, CASE WHEN bn <> 1 THEN concat(v, 'b', CAST(bn - 1 AS STRING)) ELSE v END AS s2,
 CASE WHEN bn <> 1 THEN concat(v, 'b', CAST(bn - 1 AS STRING)) WHEN ch = 'nightly' THEN concat(v, 'a1') WHEN ch = 'aurora' THEN concat(v, 'a2') ELSE v END AS s3,
 CASE WHEN kind = 1 THEN ch = 'nightly' WHEN kind = 2 THEN ch = 'aurora' WHEN kind = 4 THEN ch IN ('release', 'ESR') ELSE ch IN ('Beta', 'release') END AS fits,
 CASE kind WHEN 1 THEN 'nightly' WHEN 2 THEN 'aurora' ELSE 'ERROR' END AS suffix, ch = 'Beta' AND (maj > 12 OR (maj = 12 AND mino >= 5)) AS rapid
FROM (SELECT *, concat(lpad(CAST(maj AS STRING), 3, '0'), lpad(CAST(mino AS STRING), 3, '0')) AS p2 FROM vers) AS q""")
def _(c: Context):
    return _run(c, sql("WITH " + _V + """SELECT event_id, version_sort(v, 0, ch) AS by_channel, version_sort(v, CAST(bn AS INT)) AS by_beta,
 major_version_sort(v) AS major_sort, old_version_sort(v) AS old, major_version(v) AS major, version_string(v, CAST(bn - 1 AS INT)) AS s2,
 version_string(v, CAST(bn - 1 AS INT), ch) AS s3, version_matches_channel(v, ch) AS fits, aurora_or_nightly(v) AS suffix, is_rapid_beta(ch, v, '12.5') AS rapid FROM vers"""))


@query("l12_sql_reports", """SELECT uuid, CASE WHEN process_type = 'content' THEN 'T' WHEN process_type = 'plugin' THEN CASE WHEN hang_id IS NULL THEN 'P' ELSE 'p' END ELSE CASE WHEN hang_id IS NULL THEN 'C' ELSE 'c' END END AS code,
 CASE WHEN k % 5 = 0 THEN 0.0e0 ELSE round(uptime * 100.0e0 / ((k % 5) * 1000) / 0.1e0, 3) END AS hadu, CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 4 + 1 AS INT) END AS cores,
 CASE WHEN build <> 'local' THEN CAST(build AS BIGINT) END AS build_id, CASE WHEN build <> 'local' THEN report_date - CAST(k % 10 AS INT) + CASE WHEN release_channel = 'release' THEN 126 ELSE 63 END END AS sunset,
 CASE WHEN last_crash IS NULL THEN true ELSE (epoch_us(date_processed) - epoch_us(client_crash_date)) / 1e6 - (uptime - last_crash) BETWEEN -60 AND 60 END AS same,
 date_processed >= TIMESTAMP '2024-01-10' AND date_processed < TIMESTAMP '2024-01-11' AS on_day, date_processed > TIMESTAMP '2024-01-09' AND date_processed < TIMESTAMP '2024-01-12' AS near_day,
 date_processed >= TIMESTAMP '2024-01-05' AND date_processed < TIMESTAMP '2024-01-13' AS alive, strftime(date_trunc('week', date_processed), '%Y-%m-%d') AS week,
 report_date AS id_day, 2 AS id_depth, coalesce(email <> '', false) AS mailed FROM reports""", text=("sunset", "id_day"))
def _(c: Context):
    return _run(c, """SELECT uuid, daily_crash_code(process_type, hang_id) AS code, crash_hadu(uptime, k % 5 * 1000, 0.1D) AS hadu, get_cores(cpu_info) AS cores,
 build_numeric(build) AS build_id, sunset_date(build, release_channel) AS sunset, same_time_fuzzy(client_crash_date, date_processed, last_crash, uptime) AS same,
 utc_day_is(date_processed, DATE '2024-01-10') AS on_day, utc_day_near(date_processed, DATE '2024-01-10') AS near_day,
 tstz_between(date_processed, DATE '2024-01-05', DATE '2024-01-12') AS alive, date_format(week_begins_utc(date_processed), 'yyyy-MM-dd') AS week,
 ooid_date(uuid) AS id_day, ooid_depth(uuid) AS id_depth, nonzero_string(email) AS mailed FROM reports""")


@query("l12_sql_type_counts", """SELECT product, CAST(sum(CASE WHEN process_type = 'content' THEN k ELSE 0 END) AS BIGINT) AS content, CAST(sum(CASE WHEN process_type = 'plugin' THEN k ELSE 0 END) AS BIGINT) AS plugin
FROM reports GROUP BY product""")
def _(c: Context):
    return _run(c, """SELECT product, sum(content_count_state(0, process_type, k)) AS content, sum(plugin_count_state(0, process_type, k)) AS plugin
FROM reports GROUP BY product""")


@query("l12_sql_summary", "SELECT 'uptime' AS report_type, * FROM (" + _summary_sql("uptime_string", "clean JOIN uptime_levels ON uptime >= min_uptime AND uptime < max_uptime")
       + ") AS a UNION ALL SELECT 'products', * FROM (" + _summary_sql("concat(product_name, ' ', version_string)", "clean JOIN product_versions USING (product_version_id)", "100", 3)
       + ") AS b UNION ALL SELECT 'flash_version', * FROM (" + _summary_sql("CASE WHEN flash_version = '' THEN 'Unknown/No Flash' ELSE flash_version END") + ") AS c")
def _(c: Context):
    return _run(c, """SELECT 'uptime' AS report_type, * FROM signature_summary('uptime') UNION ALL SELECT 'products', * FROM signature_summary('products')
UNION ALL SELECT 'flash_version', * FROM signature_summary('flash_version')""")


@query("l12_sql_version_ids", "SELECT product_version_id FROM product_versions WHERE product_name = 'Atlas' AND version_string IN ('1.0', '4.0a1')")
def _(c: Context):
    return _run(c, "SELECT product_version_id FROM get_product_version_ids('ATLAS', array('1.0', '4.0A1'))")


@query("l12_sql_processing", """SELECT count(*) AS report_count, round(min(lag), 6) AS min_lag, round(max(lag), 6) AS max_lag, round(avg(lag), 6) AS avg_lag
FROM (SELECT (epoch_us(completed_datetime) - epoch_us(date_processed)) / 1e6 AS lag FROM reports WHERE completed_datetime IS NOT NULL AND date_processed >= TIMESTAMP '2024-01-10') AS q""")
def _(c: Context):
    return _run(c, """SELECT report_count, round(min_lag, 6) AS min_lag, round(max_lag, 6) AS max_lag, round(avg_lag, 6) AS avg_lag
FROM watch_report_processing(TIMESTAMP '2024-01-10')""")
