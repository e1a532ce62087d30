"""Registered queries of the read operators, over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from crashlake.operators import bugs, campaigns, graphs, hangs, reads, status, topcrash, views
from crashlake.operators.common import page
from crashlake.plans.checks_marts import (_ADDONS, _ASSOC, _CBUV, _HANGS, _INFO, _NIGHTLY, _addons,
                                          _assoc, _cbu_view, _info, _signature_tables, _SIGV)
from crashlake.plans.registry import TODAY, Context, query

NOW = dt.datetime(2024, 2, 1)
ALL_TIME = {"from_date": "2023-12-01", "to_date": "2024-02-01", "result_number": 1000000}


def _search_sql(where: str) -> str:
    return f"""SELECT signature, count(*) AS "count", count(*) FILTER (os_name LIKE 'Windows%') AS is_windows, count(*) FILTER (os_name LIKE 'Mac%') AS is_mac, count(*) FILTER (os_name LIKE 'Linux%') AS is_linux,
 CAST(0 AS BIGINT) AS is_solaris, count(hang_id) AS numhang, count(*) FILTER (process_type = 'plugin') AS numplugin FROM reports WHERE {where} GROUP BY signature"""


@query("j1_search_signatures", _search_sql("signature ILIKE '%SIG_1%'"))
def _(c: Context):
    return reads.search_signatures(c.t("reports"), {**ALL_TIME, "terms": "SIG_1", "search_mode": "contains"}, NOW)


@query("j1_search_hangs", _search_sql("hang_id IS NOT NULL AND signature LIKE 'hang%' AND product IN ('Atlas', 'Mobile') AND (version = '1.0' OR (product = 'Mobile' AND version = '2.0')) AND (os_name LIKE 'Windows%' OR os_name LIKE 'Linux%')"))
def _(c: Context):
    p = {**ALL_TIME, "terms": ["hang"], "search_mode": "starts_with", "products": ["Atlas", "Mobile"],
         "versions": ["1.0", "Mobile:2.0"], "os": ["windows", "linux"], "report_type": "hang"}
    return reads.search_signatures(c.t("reports"), p, NOW)


@query("j1_search_plugins", _search_sql("process_type = 'plugin' AND concat('flash', CAST(k % 5 AS STRING), '.dll') ILIKE 'flash3%' AND reason IN ('reason_1', 'reason_3')"))
def _(c: Context):
    r = c.t("reports").withColumns({
        "plugin_filename": F.concat(F.lit("flash"), (F.col("k") % 5).cast("string"), F.lit(".dll")),
        "plugin_name": F.lit("x")})
    p = {**ALL_TIME, "report_process": "plugin", "plugin_in": "filename", "plugin_terms": "flash3",
         "plugin_search_mode": "starts_with", "reasons": ["reason_1", "reason_3"]}
    return reads.search_signatures(r, p, NOW)


@query("j1_search_crashes", """SELECT uuid, signature, product, build FROM reports WHERE signature = 'sig_7' AND build >= '20240105000000' AND build <= '20240115000000' AND (process_type IS NULL OR process_type = 'browser') AND hang_id IS NULL""")
def _(c: Context):
    p = {**ALL_TIME, "terms": "sig_7", "search_mode": "is_exactly", "build_from": "2024-01-05",
         "build_to": "2024-01-15", "report_process": "browser", "report_type": "crash"}
    return reads.search_crashes(c.t("reports"), p, NOW).select("uuid", "signature", "product", "build")


@query("j1_search_words", """SELECT signature, count(*) AS n FROM reports WHERE regexp_matches(lower(signature), '(^|[^a-z0-9_])sig_4([^a-z0-9_]|$)') GROUP BY signature""")
def _(c: Context):
    return reads.search_signatures(c.t("reports"), {**ALL_TIME, "terms": "sig_4"}, NOW).select("signature", F.col("count").alias("n"))


@query("j1_search_total", "SELECT count(*) AS total, count(DISTINCT signature) AS signatures FROM reports WHERE product = 'Atlas'")
def _(c: Context):
    return reads.search_total(c.t("reports"), {**ALL_TIME, "products": "Atlas"}, NOW)


@query("j2_report_list", "SELECT uuid, product, version, build, os_name, reason, address FROM reports WHERE signature = 'hang | sig_3'")
def _(c: Context):
    return reads.report_list(c.t("reports"), {**ALL_TIME, "signature": "hang | sig_3"}, NOW).select(
        "uuid", "product", "version", "build", "os_name", "reason", "address")


@query("j3_comments", """SELECT uuid, date_processed, user_comments, nullif(email, '') AS email FROM reports WHERE signature = 'sig_8' AND user_comments IS NOT NULL""", text=("date_processed",))
def _(c: Context):
    return reads.comments(c.t("reports"), {**ALL_TIME, "signature": "sig_8"}, NOW)


# comment search: every document is the comment of a report
@query("j3_comment_search", """SELECT doc_id, lang FROM documents WHERE text ILIKE '%error%' OR text ILIKE '%license%'""")
def _(c: Context):
    from crashlake.functions.search import term_filter
    return c.t("documents").where(term_filter(F.col("text"), ["error", "license"], "contains")).select("doc_id", "lang")


@query("j4_hang_pairs", """WITH m AS (SELECT hang_id, report_date, uuid, count(*) OVER w AS n, min(uuid) OVER w AS a FROM clean WHERE hang_id <> '' WINDOW w AS (PARTITION BY hang_id, report_date)),
s AS (SELECT hang_id, report_date, min(uuid) AS b FROM m WHERE uuid <> a GROUP BY ALL)
SELECT m.uuid, m.hang_id, m.report_date, CASE WHEN m.uuid = m.a THEN s.b ELSE m.a END AS paired FROM m JOIN s USING (hang_id, report_date)""", text=("report_date",))
def _(c: Context):
    return hangs.hang_pairs(c.clean)


@query("j5_frequency", """SELECT build AS build_date, count(*) FILTER (m) AS "count", count(*) AS total, count(*) FILTER (m AND w) AS count_windows, count(*) FILTER (m AND a) AS count_mac, count(*) FILTER (m AND l) AS count_linux,
 round(count(*) FILTER (m) / count(*), 5) AS frequency, CASE WHEN count(*) FILTER (w) > 0 THEN round(count(*) FILTER (m AND w) / count(*) FILTER (w), 5) ELSE 0 END AS frequency_windows,
 CASE WHEN count(*) FILTER (a) > 0 THEN round(count(*) FILTER (m AND a) / count(*) FILTER (a), 5) ELSE 0 END AS frequency_mac,
 CASE WHEN count(*) FILTER (l) > 0 THEN round(count(*) FILTER (m AND l) / count(*) FILTER (l), 5) ELSE 0 END AS frequency_linux
FROM (SELECT build, coalesce(signature = 'sig_5', false) AS m, os_name LIKE 'Windows%' AS w, os_name LIKE 'Mac%' AS a, os_name LIKE 'Linux%' AS l FROM reports) AS q GROUP BY build HAVING count(*) FILTER (m) > 0""")
def _(c: Context):
    return reads.frequency(c.t("reports"), "sig_5", dict(ALL_TIME), NOW)


_BOTH = """, both_ AS (SELECT signature, CAST(sum(report_count) FILTER (cur) AS BIGINT) AS n, CAST(sum(report_count) FILTER (NOT cur) AS BIGINT) AS b, coalesce(CAST(sum(win_count) FILTER (cur) AS BIGINT), 0) AS win_count, coalesce(CAST(sum(mac_count) FILTER (cur) AS BIGINT), 0) AS mac_count,
 coalesce(CAST(sum(lin_count) FILTER (cur) AS BIGINT), 0) AS lin_count, coalesce(CAST(sum(hang_count) FILTER (cur) AS BIGINT), 0) AS hang_count, coalesce(CAST(sum(startup_count) FILTER (cur) AS BIGINT), 0) AS startup_count,
 coalesce(CAST(sum(report_count) FILTER (cur AND process_type = 'content') AS BIGINT), 0) AS content_count, coalesce(CAST(sum(report_count) FILTER (cur AND process_type = 'plugin') AS BIGINT), 0) AS plugin_count
 FROM (SELECT *, report_date > DATE '2024-01-15' AS cur FROM tcbs WHERE report_date > DATE '2023-12-31' AND report_date <= DATE '2024-01-30') AS z GROUP BY signature),
cur AS (SELECT *, rank() OVER (ORDER BY n DESC) - 1 AS current_rank FROM both_ WHERE n > 0), prev AS (SELECT signature, rank() OVER (ORDER BY b DESC) - 1 AS previous_rank, b FROM both_ WHERE b > 0)
"""


@query("j6_top_crashers", "WITH " + _SIGV + "sp AS (SELECT DISTINCT signature, pvid FROM sigv WHERE pvid IS NOT NULL)" + _BOTH + """
SELECT signature, n AS report_count, win_count, mac_count, lin_count, hang_count, content_count, plugin_count, current_rank, previous_rank, previous_rank - current_rank AS change_in_rank,
 round(n / (SELECT sum(n) FROM both_), 9) AS percent_of_total, round(b / (SELECT sum(b) FROM both_), 9) AS previous_percent_of_total,
 round(n / (SELECT sum(n) FROM both_) - b / (SELECT sum(b) FROM both_), 9) AS change_in_percent_of_total, round(startup_count / n, 5) AS startup_percent,
 (SELECT min(first_report) FROM sigv AS s WHERE s.signature = c.signature AND pvid IS NOT NULL) AS first_report
FROM (SELECT cur.* EXCLUDE (b), prev.previous_rank, prev.b FROM cur LEFT JOIN prev USING (signature)) AS c""", text=("first_report",))
def _(c: Context):
    sigs, _pairs, rollup = _signature_tables(c)
    return reads.top_crashers(c.tcbs, c.pv, sigs, rollup, None, None, "2024-01-30", hours=15 * 24,
                              limit=100000).drop("versions", "versions_count")


@query("a10_top_crashers_csv", "WITH " + _SIGV + "sp AS (SELECT DISTINCT signature, pvid FROM sigv WHERE pvid IS NOT NULL)" + _BOTH + """
SELECT current_rank AS "Rank", signature AS "Signature", n AS "Total", win_count AS "Win", mac_count AS "Mac", lin_count AS "Linux",
 coalesce(CAST(previous_rank - current_rank AS STRING), 'new') AS "Change In Rank",
 (SELECT count(*) FROM sp WHERE sp.signature = c.signature) AS "Version Count"
FROM (SELECT cur.*, prev.previous_rank FROM cur LEFT JOIN prev USING (signature)) AS c""")
def _(c: Context):
    sigs, _pairs, rollup = _signature_tables(c)
    top = reads.top_crashers(c.tcbs, c.pv, sigs, rollup, None, None, "2024-01-30", hours=15 * 24, limit=100000)
    return topcrash.csv_rows(top).select("Rank", "Signature", "Total", "Win", "Mac", "Linux", "Change In Rank", "Version Count")


_DAILY = """daily AS (SELECT product_name, version_string, report_date, throttle, CAST(sum(n) AS BIGINT) AS report_count, CAST(sum(u) AS BIGINT) AS adu FROM (
 SELECT product_name, version_string, report_date, throttle, os_name, sum(report_count) AS n, max(adu) AS u FROM cbuv GROUP BY ALL) AS q GROUP BY ALL)
"""
_HADU = "CASE WHEN adu = 0 THEN 0 ELSE round(CAST(report_count AS DOUBLE) * 100 / adu / throttle, 3) END"


@query("j7_crashes_daily", "WITH " + _CBUV + ", " + _DAILY + f"SELECT *, {_HADU} AS crash_hadu FROM daily", text=("report_date",))
def _(c: Context):
    return reads.crashes_daily(_cbu_view(c), None)


@query("j7_crashes_daily_by_os", "WITH " + _CBUV + f""" SELECT *, {_HADU} AS crash_hadu FROM (SELECT product_name, version_string, report_date, throttle, os_name, CAST(sum(report_count) AS BIGINT) AS report_count, CAST(max(adu) AS BIGINT) AS adu FROM cbuv GROUP BY ALL) AS q""", text=("report_date",))
def _(c: Context):
    return reads.crashes_daily(_cbu_view(c), None, separated_by="os")


@query("d14_daily_totals", "WITH " + _CBUV + ", " + _DAILY + f"""SELECT product_name, version_string, CAST(sum(report_count) AS BIGINT) AS crashes, CAST(sum(adu) AS BIGINT) AS users, round(sum({_HADU}), 3) AS ratio FROM daily GROUP BY ALL""")
def _(c: Context):
    return reads.daily_totals(reads.crashes_daily(_cbu_view(c), None), "version_string")


@query("j8_d13_trend_histogram", "WITH " + _NIGHTLY + "SELECT report_date, product_version_id, " + ", ".join(
    f"CAST(coalesce(sum(report_count) FILTER (least(days_out, 8) = {i}), 0) AS BIGINT) AS day{i}" for i in range(9)) + " FROM nb GROUP BY ALL", text=("report_date",))
def _(c: Context):
    return graphs.trend_histogram(c.nightly, ["report_date", "product_version_id"])


@query("j8_crash_trends", "WITH " + _NIGHTLY + """SELECT nb.*, product_name, version_string FROM nb JOIN product_versions AS pv USING (product_version_id) WHERE product_name = 'Atlas' AND version_string = '4.0a1'""", text=("report_date", "build_date"))
def _(c: Context):
    return graphs.crash_trends(c.nightly, c.pv, "atlas", "4.0A1", "2023-12-01", "2024-02-01")


@query("j9_signature_histories", """SELECT product_version_id, signature, report_date, report_count, CAST(sum(report_count) OVER w AS BIGINT) AS total_crashes, round(report_count / sum(report_count) OVER w, 9) AS percent_of_total
FROM (SELECT DISTINCT product_version_id, signature, report_date, report_count FROM tcbs) AS h WINDOW w AS (PARTITION BY product_version_id, signature)""", text=("report_date",))
def _(c: Context):
    return reads.signature_histories(c.tcbs)


_HIST = """hist AS (SELECT DISTINCT report_date, report_count FROM tcbs JOIN product_versions USING (product_version_id) WHERE product_name = 'Boreal' AND version_string = '1.0' AND signature = '')
"""


@query("j9_signature_history", "WITH " + _HIST + "SELECT report_date, report_count, round(report_count / sum(report_count) OVER (), 9) AS percent_of_total FROM hist", text=("report_date",))
def _(c: Context):
    return reads.signature_history(c.tcbs, c.pv, "Boreal", "1.0", "##empty##", "2023-12-01", "2024-02-01")


@query("j21_plot_points", "WITH " + _HIST + "SELECT CAST(epoch_ms(CAST(report_date AS TIMESTAMP)) AS BIGINT) AS x, report_count AS y FROM hist")
def _(c: Context):
    h = reads.signature_history(c.tcbs, c.pv, "Boreal", "1.0", "##empty##", "2023-12-01", "2024-02-01")
    return reads.plot_points(h)


def _summary_sql(category: str, source: str = "clean", scale: str = "1", places: int = 5) -> str:
    return f"""SELECT signature, category, n AS report_count, round(n * {scale} / sum(n) OVER (PARTITION BY signature), {places}) AS percent FROM (SELECT signature, {category} AS category, count(*) AS n FROM {source} GROUP BY ALL) AS q"""


def _summary(name: str, report_type: str, oracle: str) -> None:
    @query(name, oracle)
    def _(c: Context):
        return reads.signature_summary(c.clean, c.pv, report_type, levels=c.t("uptime_levels"))


_summary("j10_summary_uptime", "uptime", _summary_sql("uptime_string", "clean JOIN uptime_levels ON uptime >= min_uptime AND uptime < max_uptime"))
_summary("j10_summary_products", "products", _summary_sql("concat(product_name, ' ', version_string)", "clean JOIN product_versions USING (product_version_id)", "100", 3))
_summary("j10_summary_os", "os", _summary_sql("os_version_string"))
_summary("j10_summary_process_type", "process_type", _summary_sql("process_type"))
_summary("j10_summary_flash_version", "flash_version", _summary_sql("CASE WHEN flash_version = '' THEN 'Unknown/No Flash' ELSE flash_version END"))
_summary("j10_summary_architecture", "architecture", _summary_sql("architecture"))


@query("j11_signature_urls", """SELECT signature, url, count(*) AS crash_count FROM reports WHERE url <> '' AND product = 'Atlas' AND date_processed >= TIMESTAMP '2024-01-01' AND date_processed < TIMESTAMP '2024-02-01' GROUP BY ALL""")
def _(c: Context):
    return reads.signature_urls(c.t("reports"), None, "2024-01-01", "2024-02-01", ["Atlas"], ["ALL"])


@query("j12_hang_report_page", "WITH " + _HANGS + """SELECT browser_signature, plugin_signature, uuid, plugin_uuid, report_date AS report_day FROM hangs JOIN product_versions AS pv USING (product_version_id)
WHERE pv.product_name = 'Atlas' AND pv.version_string = '1.0' AND report_date >= DATE '2024-01-30' - 30 ORDER BY report_date DESC, uuid, plugin_uuid LIMIT 10 OFFSET 10""", text=("report_day",))
def _(c: Context):
    rep = hangs.hang_report(c.hang_rows, c.pv)
    return hangs.hang_report_page(rep, "Atlas", "1.0", "2024-01-30", 30, 10, 2).select(
        "browser_signature", "plugin_signature", "uuid", "plugin_uuid", "report_day")


@query("j13_extensions", "WITH " + _ADDONS + """SELECT uuid, addon_key, addon_version, CASE WHEN addon_key = 'common' THEN 'Common' WHEN addon_key = 'addon1' THEN 'One' END AS name,
 CASE WHEN addon_key = 'common' THEN '2.0' WHEN addon_key = 'addon1' THEN '1.1' END AS latest_version, CASE WHEN addon_key = 'common' THEN false WHEN addon_key = 'addon1' THEN addon_version <> '1.1' ELSE false END AS out_of_date FROM addons""")
def _(c: Context):
    latest = c.spark.sql("SELECT * FROM VALUES ('common', 'Common', '2.0'), ('addon1', 'One', '1.1') AS t(addon_key, name, latest_version)")
    return reads.extensions(_addons(c), None, latest)


@query("j14_bugs", "WITH " + _ASSOC + "SELECT bug_id AS id, signature FROM assoc WHERE signature IN ('sig_1', 'sig_3', 'none')")
def _(c: Context):
    return bugs.bugs_for_signatures(_assoc(c), ["sig_1", "sig_3", "none"])


@query("j15_current_versions", "WITH " + _INFO + "SELECT product_name, product_version_id, version_string, is_featured, start_date, end_date, build_type, throttle FROM info", text=("start_date", "end_date"))
def _(c: Context):
    return views.current_versions(_info(c))


@query("j15_products_versions", "WITH " + _INFO + "SELECT is_featured, throttle, end_date, start_date, build_type, product_name AS product, version_string AS version, has_builds FROM info WHERE version_string IN ('1.0', '2.0b1') AND product_name = 'Atlas'", text=("start_date", "end_date"))
def _(c: Context):
    return views.products_versions(_info(c), ["Atlas:1.0", "Atlas:2.0b1", "Atlas:9"])


@query("j15_products", "WITH " + _INFO + """SELECT p.product_name, p.sort, p.rapid_release_version, p.release_name, d.version_string AS default_version FROM products AS p LEFT JOIN (SELECT product_name, version_string FROM (SELECT *, row_number() OVER (PARTITION BY product_name
 ORDER BY (DATE '2024-02-01' BETWEEN start_date AND end_date) DESC, is_featured DESC, channel_sort DESC, version_sort DESC, version_string) AS n FROM info) AS q WHERE n = 1) AS d USING (product_name)""")
def _(c: Context):
    return views.products_list(c.t("products"), views.default_versions(_info(c), TODAY))


@query("j15_versions_info", """SELECT concat(product_name, ':', version_string) AS product_version, build_type, is_rapid_beta, (SELECT string_agg(CAST(build_id AS STRING), ',' ORDER BY build_id) FROM (SELECT DISTINCT product_version_id, build_id FROM product_version_builds) AS b WHERE b.product_version_id = pv.product_version_id) AS builds FROM product_versions AS pv""")
def _(c: Context):
    return views.versions_info(c.pv, c.t("product_version_builds")).select(
        "product_version", "build_type", "is_rapid_beta", F.array_join(F.col("build_id").cast("array<string>"), ",").alias("builds"))


@query("j15_featured", "WITH " + _INFO + "SELECT product_name, string_agg(version_string, ',' ORDER BY version_sort) AS versions FROM info WHERE is_featured AND DATE '2024-02-01' BETWEEN start_date AND end_date GROUP BY product_name")
def _(c: Context):
    f = views.featured(_info(c), TODAY)
    return f.select("product_name", F.array_join("versions", ",").alias("versions"))


@query("j16_nightly_builds_of", """SELECT pv.product_name AS product, pv.version_string AS version, platform, build_type, build_id, beta_number, repository, CAST(strptime(substr(CAST(build_id AS STRING), 1, 8), '%Y%m%d') AS DATE) AS "date" FROM product_version_builds JOIN product_versions AS pv USING (product_version_id)
WHERE product_name = 'Atlas' AND build_type IN ('Nightly', 'Aurora') AND CAST(strptime(substr(CAST(build_id AS STRING), 1, 8), '%Y%m%d') AS DATE) >= DATE '2024-01-05'""", text=("date",))
def _(c: Context):
    return views.nightly_builds_of(c.pv, c.t("product_version_builds"), "Atlas", "2024-01-05")


@query("j18_version_ids", "SELECT string_agg(product_version_id, ',' ORDER BY product_version_id) AS ids FROM product_versions WHERE product_name = 'Atlas' AND version_string IN ('1.0', '4.0a1')")
def _(c: Context):
    v = views.version_ids(c.pv, "ATLAS", ["1.0", "4.0a1"])
    return v.select(F.array_join("product_version_ids", ",").alias("ids"))


# ---- jobs, freshness, counters: every report is a job of the queue -----------------------


def _jobs(c: Context):
    r = c.t("reports")
    return r.select("uuid", F.col("date_processed").alias("queued_datetime"), "started_datetime", "completed_datetime")


@query("g30_server_status", """SELECT max(completed_datetime) AS date_recently_completed, min(date_processed) FILTER (completed_datetime IS NULL) AS date_oldest_job_queued,
 round(coalesce(avg((epoch_us(completed_datetime) - epoch_us(started_datetime)) / 1e6) FILTER (completed_datetime > TIMESTAMP '2024-01-20'), 0), 3) AS avg_process_sec, round(coalesce(avg((epoch_us(completed_datetime) - epoch_us(date_processed)) / 1e6) FILTER (completed_datetime > TIMESTAMP '2024-01-20'), 0), 3) AS avg_wait_sec,
 count(*) FILTER (completed_datetime IS NULL) AS waiting_job_count, (SELECT count(DISTINCT user_id) FROM ev) AS processors_count FROM reports""", text=("date_recently_completed", "date_oldest_job_queued"))
def _(c: Context):
    s = status.server_status(_jobs(c), c.t("ev").select("user_id").distinct(), "2024-02-01", 12 * 86400)
    return s.drop("date_created").withColumns({n: F.round(n, 3) for n in ("avg_process_sec", "avg_wait_sec")})


@query("h7_jobs_in_queue", "SELECT count(*) AS \"count\" FROM reports WHERE completed_datetime IS NULL")
def _(c: Context):
    return status.jobs_in_queue(_jobs(c))


@query("j17_latest_status", "SELECT report_date AS date_created, count(*) AS waiting FROM reports GROUP BY report_date ORDER BY report_date DESC LIMIT 12", text=("date_created",))
def _(c: Context):
    days = c.t("reports").groupBy(F.col("report_date").alias("date_created")).agg(F.count(F.lit(1)).alias("waiting"))
    return status.latest_status(days, 12)


@query("j20_crashiest_versions", """SELECT signature, product, version, n FROM (SELECT *, row_number() OVER (PARTITION BY signature ORDER BY n DESC, product DESC, version DESC) AS i FROM (SELECT signature, product, version, count(*) AS n FROM reports GROUP BY ALL) AS g) AS q WHERE i = 1""")
def _(c: Context):
    return reads.crashiest_version(c.t("reports"), ["signature"])


@query("j20_crashes_by_os", """SELECT w AS count_windows, a AS count_mac, l AS count_linux, CASE WHEN w >= a AND w >= l THEN 'Windows NT' WHEN a >= w AND a >= l THEN 'Mac OS X' ELSE 'Linux' END AS dominant_os FROM (
 SELECT count(*) FILTER (os_name LIKE 'Windows%') AS w, count(*) FILTER (os_name LIKE 'Mac%') AS a, count(*) FILTER (os_name LIKE 'Linux%') AS l FROM reports WHERE signature = 'sig_5') AS q""")
def _(c: Context):
    return reads.crashes_by_os(reads.frequency(c.t("reports"), "sig_5", dict(ALL_TIME), NOW))


@query("j22_freshness", "SELECT CAST(round((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(date_processed))) / 1e6) AS BIGINT) AS seconds FROM reports")
def _(c: Context):
    return status.seconds_since_last_report(c.t("reports"), "2024-02-01", 60)


@query("j23_processing_lag", """SELECT product, round(min(l), 3) AS min_lag, round(max(l), 3) AS max_lag, round(avg(l), 3) AS avg_lag FROM (SELECT product, (epoch_us(completed_datetime) - epoch_us(date_processed)) / 1e6 AS l FROM reports WHERE completed_datetime IS NOT NULL) AS q GROUP BY product""")
def _(c: Context):
    return status.processing_lag(c.t("reports"), "product")


@query("d16_submission_counters", """WITH n AS (SELECT date_processed AS ts, unnest(['submitted_crash_reports', concat('submitted_crash_reports_legacy_throttle_', CAST(k % 3 AS STRING)),
  CASE WHEN process_type IS NULL THEN NULL WHEN hang_id IS NOT NULL THEN 'submitted_crash_report_hang_pairs' ELSE concat('submitted_oop_', process_type, '_crash_reports') END]) AS counter FROM reports)
SELECT period, counter, count(*) AS "count" FROM (SELECT counter, unnest([strftime(ts, '%Y-%m-%dT%H:%M'), strftime(ts, '%Y-%m-%dT%H'), strftime(ts, '%Y-%m-%d'), strftime(ts, '%Y-%m'), strftime(ts, '%Y')]) AS period FROM n WHERE counter IS NOT NULL) AS q GROUP BY ALL""")
def _(c: Context):
    r = c.t("reports").withColumns({"submitted_timestamp": F.col("date_processed"), "legacy_processing": F.col("k") % 3})
    return status.submission_counters(r)


@query("e7_recent_activity", """SELECT w AS window_start, w + INTERVAL 5 MINUTE AS window_end, event_type, count(*) AS "count", round(avg(value), 6) AS mean_duration FROM (
 SELECT event_type, value, unnest([date_trunc('minute', ts), date_trunc('minute', ts) - INTERVAL 1 MINUTE, date_trunc('minute', ts) - INTERVAL 2 MINUTE, date_trunc('minute', ts) - INTERVAL 3 MINUTE, date_trunc('minute', ts) - INTERVAL 4 MINUTE]) AS w FROM ev) AS q GROUP BY ALL""", text=("window_start", "window_end"))
def _(c: Context):
    return status.recent_activity(c.t("ev"), 5, "event_type", duration="value")


@query("d15_under_performing", """WITH n AS (SELECT user_id, count(*) AS n FROM ev GROUP BY user_id) SELECT user_id, n FROM n WHERE n < (SELECT avg(n) - stddev_pop(n) FROM n)""")
def _(c: Context):
    n = c.t("ev").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return status.under_performing(n, "user_id", "n")


# ---- bugs and campaigns ------------------------------------------------------------------

_FEED = """feed AS (SELECT DISTINCT 1000 + k AS bug_id, CASE WHEN k % 5 = 0 THEN 'NEW' ELSE 'RESOLVED' END AS bug_status, 'x' AS resolution, concat('bug ', CAST(k AS STRING)) AS short_desc,
  CASE WHEN k % 7 = 0 THEN [] WHEN k % 2 = 0 THEN [concat('sig_', CAST(k % 20 AS STRING)), 'unseen'] ELSE [concat('hang | sig_', CAST(k % 20 AS STRING))] END AS sigs FROM ev WHERE k < 60),
bugs0 AS (SELECT DISTINCT 1000 + k AS bug_id, 'OLD' AS status, '' AS resolution, 'old' AS short_desc FROM ev WHERE k % 2 = 0),
assoc0 AS (SELECT DISTINCT 1000 + k AS bug_id, concat('sig_', CAST(k % 4 AS STRING)) AS signature FROM ev WHERE k % 2 = 0),
named AS (SELECT bug_id, unnest(sigs) AS signature FROM feed),
gone AS (SELECT a.* FROM assoc0 AS a WHERE a.bug_id IN (SELECT bug_id FROM feed) AND NOT EXISTS (SELECT 1 FROM named AS n WHERE n.bug_id = a.bug_id AND n.signature = a.signature)),
fresh AS (SELECT * FROM named AS n WHERE NOT EXISTS (SELECT 1 FROM assoc0 AS a WHERE n.bug_id = a.bug_id AND n.signature = a.signature) AND n.signature IN (SELECT signature FROM reports))
"""


def _bug_frames(c: Context):
    ev, k = c.t("ev"), F.col("k")
    text = (F.when(k % 7 == 0, F.lit("")).when(k % 2 == 0, F.concat(F.lit("[@ sig_"), (k % 20).cast("string"), F.lit("] [@ unseen ]")))
            .otherwise(F.concat(F.lit("[@hang | sig_"), (k % 20).cast("string"), F.lit("]"))))
    feed = ev.where(k < 60).select(
        (k + 1000).alias("bug_id"), F.when(k % 5 == 0, F.lit("NEW")).otherwise(F.lit("RESOLVED")).alias("bug_status"),
        F.lit("x").alias("resolution"), F.concat(F.lit("bug "), k.cast("string")).alias("short_desc"),
        text.alias("cf_crash_signature")).distinct()
    old = ev.where(k % 2 == 0)
    bugs0 = old.select((k + 1000).alias("bug_id"), F.lit("OLD").alias("status"), F.lit("").alias("resolution"), F.lit("old").alias("short_desc")).distinct()
    assoc0 = old.select((k + 1000).alias("bug_id"), F.concat(F.lit("sig_"), (k % 4).cast("string")).alias("signature")).distinct()
    return feed, bugs0, assoc0, c.t("reports")


@query("g29_bugs", "WITH " + _FEED + """SELECT * FROM bugs0 WHERE bug_id NOT IN (SELECT bug_id FROM feed)
UNION ALL SELECT f.bug_id, f.bug_status, f.resolution, f.short_desc FROM feed AS f WHERE len(f.sigs) > 0 AND (f.bug_id IN (SELECT bug_id FROM bugs0) OR f.bug_id IN (SELECT bug_id FROM fresh))""")
def _(c: Context):
    return bugs.update_bug_associations(*_bug_frames(c))[0]


@query("g29_bug_associations", "WITH " + _FEED + """SELECT * FROM assoc0 AS a WHERE NOT EXISTS (SELECT 1 FROM gone AS g WHERE g.bug_id = a.bug_id AND g.signature = a.signature) UNION ALL SELECT * FROM fresh""")
def _(c: Context):
    return bugs.update_bug_associations(*_bug_frames(c))[1]


@query("f7_association_changes", "WITH " + _FEED + """SELECT bug_id, signature, 'remove' AS change FROM gone UNION ALL SELECT bug_id, signature, 'add' FROM fresh""")
def _(c: Context):
    feed, _b, assoc, reports = _bug_frames(c)
    return bugs.association_changes(feed, assoc, reports)


_MAIL = """contacts AS (SELECT DISTINCT user_id AS id, concat('user', CAST(user_id AS STRING), '@example.org') AS email, user_id % 7 <> 0 AS subscribe_status, concat('t', CAST(user_id AS STRING)) AS subscribe_token FROM ev WHERE user_id % 5 <> 4),
campaigns AS (SELECT DISTINCT k AS id, CASE WHEN k % 2 = 0 THEN 'Atlas' ELSE 'Boreal' END AS product, 'sig_3' AS signature FROM ev WHERE k < 10),
sent AS (SELECT DISTINCT k AS email_campaigns_id, user_id AS email_contacts_id, CASE WHEN user_id % 3 = 0 THEN 'failed' ELSE 'sent' END AS status FROM ev WHERE k < 10 AND user_id % 9 = 0)
"""


def _mail(c: Context):
    ev, k, u = c.t("ev"), F.col("k"), F.col("user_id")
    contacts = ev.where(u % 5 != 4).select(
        u.alias("id"), F.concat(F.lit("user"), u.cast("string"), F.lit("@example.org")).alias("email"),
        (u % 7 != 0).alias("subscribe_status"), F.concat(F.lit("t"), u.cast("string")).alias("subscribe_token")).distinct()
    camps = ev.where(k < 10).select(k.alias("id"), F.when(k % 2 == 0, F.lit("Atlas")).otherwise(F.lit("Boreal")).alias("product"),
                                    F.lit("sig_3").alias("signature")).distinct()
    sent = ev.where((k < 10) & (u % 9 == 0)).select(
        k.alias("email_campaigns_id"), u.alias("email_contacts_id"),
        F.when(u % 3 == 0, F.lit("failed")).otherwise(F.lit("sent")).alias("status")).distinct()
    return contacts, camps, sent


_RECIPIENTS = _MAIL + """, done AS (SELECT co.email FROM campaigns AS ca JOIN sent AS s ON s.email_campaigns_id = ca.id JOIN contacts AS co ON co.id = s.email_contacts_id WHERE ca.product = 'Atlas'),
rcp AS (SELECT contact_id, email, crash_date, uuid, subscribe_token FROM (SELECT co.id AS contact_id, r.email, r.client_crash_date AS crash_date, r.uuid, co.subscribe_token, row_number() OVER (PARTITION BY r.email ORDER BY r.client_crash_date DESC, r.uuid DESC) AS n
 FROM reports AS r LEFT JOIN contacts AS co ON r.email = co.email WHERE r.product = 'Atlas' AND length(r.email) > 4 AND co.subscribe_status IS NOT FALSE AND co.email NOT IN (SELECT email FROM done)) AS q WHERE n = 1)
"""


def _recipients(c: Context):
    contacts, camps, sent = _mail(c)
    return campaigns.campaign_recipients(c.t("reports"), contacts, camps, sent, "Atlas", [], None, "2024-01-01", "2024-02-01")


@query("g31_c13_campaign_recipients", "WITH " + _RECIPIENTS + "SELECT * FROM rcp", text=("crash_date",))
def _(c: Context):
    return _recipients(c)


@query("g31_campaign_volume", "SELECT count(DISTINCT email) AS total FROM reports WHERE product = 'Atlas' AND regexp_matches(email, '.*@.*[.][a-zA-Z]{2,4}')")
def _(c: Context):
    return campaigns.campaign_volume(c.t("reports"), "Atlas", [], None, "2024-01-01", "2024-02-01")


@query("g32_messages", "WITH " + _RECIPIENTS + """SELECT email, concat('To ', email, ': crash of ', strftime(crash_date, '%Y-%m-%dT%H:%M:%S'), ' https://c.example.org/', uuid, ' stop: https://u.example.org/', subscribe_token, '/off') AS message FROM rcp""")
def _(c: Context):
    body = F.lit("To *|EMAIL_ADDRESS|*: crash of *|CRASH_DATE|* *|CRASH_URL|* stop: *|UNSUBSCRIBE_URL|*")
    out = campaigns.render_messages(_recipients(c), body, "https://u.example.org/%s/off", "https://c.example.org/%s")
    return out.select("email", "message")


@query("j19_campaign_page", "WITH " + _MAIL + "SELECT id, product, signature FROM campaigns ORDER BY id DESC LIMIT 4 OFFSET 4")
def _(c: Context):
    return campaigns.campaign_page(_mail(c)[1], 2, 4)


@query("j19_campaign_status", "WITH " + _MAIL + "SELECT email_campaigns_id, status, count(status) AS \"count\" FROM sent GROUP BY ALL")
def _(c: Context):
    return campaigns.campaign_status(_mail(c)[2])


@query("f3_f4_latest", "SELECT uuid, date_processed FROM reports ORDER BY date_processed DESC, uuid LIMIT 1", text=("date_processed",))
def _(c: Context):
    return page(c.t("reports").select("uuid", "date_processed"), [F.desc("date_processed"), "uuid"], 1)


