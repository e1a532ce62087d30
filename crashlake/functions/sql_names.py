"""The library's functions under SQL names, for queries written as SQL text.

All are SQL functions of the session: their bodies are inlined into the plan of the query that
calls them, so filters are pushed down and code is generated as for any expression. Each body
says the same as the Column function of that name; tests hold the two against each other.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

#: name -> (parameters, type, body). Later ones may use earlier ones.
SCALARS: dict[str, tuple[str, str, str]] = {
    "nonzero_string": ("t STRING", "BOOLEAN", "coalesce(trim(t) <> '', false)"),
    "initcap1": ("t STRING", "STRING", "concat(upper(substr(t, 1, 1)), substr(t, 2))"),
    "get_cores": ("cpu STRING", "INT", r"CASE WHEN cpu RLIKE r'[|] [0-9]+$' THEN try_cast(regexp_extract(cpu, r'[|] ([0-9]+)$', 1) AS INT) END"),
    "url2domain": ("url STRING", "STRING", r"nullif(regexp_extract(url, r'^([\w:]+:/+(?:\w+\.)*\w+).*', 1), '')"),
    "build_numeric": ("build STRING", "BIGINT", "CASE WHEN build RLIKE '^[0-9]+$' THEN try_cast(build AS BIGINT) END"),
    "build_date": ("build STRING", "DATE", "try_to_date(substr(build, 1, 8), 'yyyyMMdd')"),
    "sunset_date": ("build STRING, build_type STRING", "DATE",
                    "date_add(build_date(build), CASE WHEN lower(build_type) IN ('release', 'esr') THEN 126 ELSE 63 END)"),
    "to_major_version": ("version STRING", "STRING", r"nullif(regexp_extract(version, r'^([0-9]+\.[0-9]+)', 1), '')"),
    "major_version": ("version STRING", "STRING",
                      r"CASE WHEN regexp_extract(version, r'^([0-9]+.[0-9]+)', 1) RLIKE r'^[0-9]+\.[0-9]+' "
                      r"THEN regexp_extract(version, r'^([0-9]+.[0-9]+)', 1) END"),
    "version_sort_digit": ("digit STRING", "STRING",
                           "coalesce(CASE WHEN try_cast(nullif(digit, '') AS INT) > 999 THEN '###' "
                           "ELSE lpad(CAST(try_cast(nullif(digit, '') AS INT) AS STRING), 3, '0') END, '000')"),
    "major_version_sort": ("version STRING", "STRING",
                           r"concat(version_sort_digit(regexp_extract(version, r'^([0-9]+)', 1)), "
                           r"version_sort_digit(regexp_extract(version, r'^[0-9]+\.([0-9]+)', 1)))"),
    "old_version_sort": ("version STRING", "STRING", r"""CASE WHEN version RLIKE r'^([0-9]+)[^0-9]*\.([0-9]+)([a-z]?)[^.]*(?:\.([0-9]+))?([a-z]?).*$' THEN
        concat(version_sort_digit(regexp_extract(version, r'^([0-9]+)', 1)),
         version_sort_digit(regexp_extract(version, r'^[0-9]+[^0-9]*\.([0-9]+)', 1)),
         version_sort_digit(regexp_extract(version, r'^([0-9]+)[^0-9]*\.([0-9]+)([a-z]?)[^.]*(?:\.([0-9]+))?([a-z]?).*$', 4)),
         CASE WHEN regexp_extract(version, r'^([0-9]+)[^0-9]*\.([0-9]+)([a-z]?)[^.]*(?:\.([0-9]+))?([a-z]?).*$', 3) <> ''
          OR regexp_extract(version, r'^([0-9]+)[^0-9]*\.([0-9]+)([a-z]?)[^.]*(?:\.([0-9]+))?([a-z]?).*$', 5) <> '' THEN 'b' ELSE 'z' END, '000') END"""),
    "version_part": ("version STRING, place INT", "STRING",
                     r"nullif(regexp_extract(version, r'^([0-9]+)\.([0-9]+)([a-zA-Z]*)([0-9]*)(?:\.([0-9]+))?(?:([a-zA-Z]+)([0-9]*))?.*$', place), '')"),
    "version_letter": ("version STRING, beta_no INT", "STRING",
                       "CASE WHEN coalesce(beta_no > 0, false) OR contains(version, '(beta)') THEN 'b' "
                       "ELSE coalesce(version_part(version, 3), version_part(version, 6)) END"),
    "version_digit": ("version STRING, beta_no INT", "STRING",
                      "CASE WHEN contains(version, '(beta)') THEN '99' WHEN coalesce(beta_no > 0, false) THEN CAST(beta_no AS STRING) "
                      "ELSE coalesce(version_part(version, 4), version_part(version, 7)) END"),
    "version_sort": ("version STRING, beta_no INT DEFAULT 0, channel STRING DEFAULT ''", "STRING", r"""CASE WHEN version RLIKE r'^[0-9]+\.[0-9]+' THEN
        concat(version_sort_digit(version_part(version, 1)), version_sort_digit(version_part(version, 2)), version_sort_digit(version_part(version, 5)),
         CASE lower(coalesce(channel, '')) WHEN 'beta' THEN 'b' WHEN 'nightly' THEN 'a' WHEN 'aurora' THEN 'a' WHEN 'release' THEN 'r' WHEN 'esr' THEN 'x'
          ELSE CASE WHEN version_letter(version, beta_no) = 'esr' THEN 'x' ELSE coalesce(version_letter(version, beta_no), 'r') END END,
         version_sort_digit(CASE lower(coalesce(channel, '')) WHEN 'beta' THEN coalesce(version_digit(version, beta_no), '99')
          WHEN 'nightly' THEN '1' WHEN 'aurora' THEN '2' WHEN 'release' THEN '0' WHEN 'esr' THEN '0' ELSE version_digit(version, beta_no) END)) END"""),
    "version_string": ("version STRING, beta_number INT, channel STRING DEFAULT ''", "STRING",
                       "CASE WHEN beta_number <> 0 THEN concat(version, 'b', CAST(beta_number AS STRING)) WHEN lower(channel) = 'nightly' THEN concat(version, 'a1') "
                       "WHEN lower(channel) = 'aurora' THEN concat(version, 'a2') ELSE version END"),
    "version_matches_channel": ("version STRING, channel STRING", "BOOLEAN",
                                "CASE WHEN version IS NOT NULL AND channel IS NOT NULL THEN (endswith(lower(version), 'a1') AND startswith(lower(channel), 'nightly')) "
                                "OR (endswith(lower(version), 'a2') AND lower(channel) = 'aurora') OR (endswith(lower(version), 'esr') AND lower(channel) IN ('release', 'esr')) "
                                "OR (NOT contains(lower(version), 'a') AND NOT endswith(lower(version), 'esr') AND lower(channel) IN ('beta', 'release')) END"),
    "aurora_or_nightly": ("version STRING", "STRING",
                          "CASE WHEN endswith(version, 'a1') THEN 'nightly' WHEN endswith(version, 'a2') THEN 'aurora' WHEN version IS NOT NULL THEN 'ERROR' END"),
    "is_rapid_beta": ("channel STRING, version STRING, first_rapid STRING", "BOOLEAN",
                      "lower(channel) = 'beta' AND major_version_sort(version) >= major_version_sort(first_rapid)"),
    "daily_crash_code": ("process_type STRING, hang_id STRING", "STRING",
                         "CASE lower(coalesce(process_type, 'browser')) WHEN 'content' THEN 'T' WHEN 'plugin' THEN if(hang_id IS NULL, 'P', 'p') "
                         "WHEN 'browser' THEN if(hang_id IS NULL, 'C', 'c') ELSE 'C' END"),
    "crash_hadu": ("crashes BIGINT, adu BIGINT, throttle DOUBLE DEFAULT 1.0", "DOUBLE",
                   "CASE WHEN adu = 0 THEN 0.0D ELSE round(CAST(crashes AS DOUBLE) * 100 / CAST(adu AS DOUBLE) / throttle, 3) END"),
    "content_count_state": ("running_count BIGINT, process_type STRING, crash_count BIGINT", "BIGINT",
                            "coalesce(running_count, 0) + CASE WHEN lower(process_type) = 'content' THEN coalesce(crash_count, 0) ELSE 0 END"),
    "plugin_count_state": ("running_count BIGINT, process_type STRING, crash_count BIGINT", "BIGINT",
                           "coalesce(running_count, 0) + CASE WHEN lower(process_type) = 'plugin' THEN coalesce(crash_count, 0) ELSE 0 END"),
    "utc_day_is": ("ts TIMESTAMP, day DATE", "BOOLEAN", "ts >= CAST(day AS TIMESTAMP) AND ts < CAST(day AS TIMESTAMP) + INTERVAL 1 DAY"),
    "utc_day_near": ("ts TIMESTAMP, day DATE", "BOOLEAN",
                     "ts > CAST(day AS TIMESTAMP) - INTERVAL 1 DAY AND ts < CAST(day AS TIMESTAMP) + INTERVAL 2 DAY"),
    "tstz_between": ("ts TIMESTAMP, first_day DATE, last_day DATE", "BOOLEAN",
                     "ts >= CAST(first_day AS TIMESTAMP) AND ts < CAST(date_add(last_day, 1) AS TIMESTAMP)"),
    "week_begins_utc": ("ts TIMESTAMP", "TIMESTAMP", "date_trunc('week', ts)"),
    "week_ends_utc": ("ts TIMESTAMP", "TIMESTAMP", "date_trunc('week', ts) + INTERVAL 7 DAY"),
    "pacific2ts": ("ts TIMESTAMP", "TIMESTAMP", "from_utc_timestamp(ts, 'America/Los_Angeles')"),
    "same_time_fuzzy": ("t1 TIMESTAMP, t2 TIMESTAMP, s1 INT, s2 INT", "BOOLEAN",
                        "CASE WHEN s1 IS NULL OR s2 IS NULL THEN true ELSE (unix_micros(t2) - unix_micros(t1)) / 1e6D - (s2 - s1) BETWEEN -60 AND 60 END"),
    "ooid_date": ("id STRING", "DATE", "CASE WHEN right(id, 7) RLIKE '^[0-9]{7}$' THEN try_to_date(concat('20', right(id, 6)), 'yyyyMMdd') END"),
    "ooid_depth": ("id STRING", "INT",
                   "CASE WHEN ooid_date(id) IS NOT NULL THEN if(left(right(id, 7), 1) = '0', 4, CAST(left(right(id, 7), 1) AS INT)) END"),
    "trend_class": ("change BIGINT", "STRING",
                    "CASE WHEN change IS NULL THEN 'new' WHEN abs(change) < 5 THEN 'static' WHEN change > 0 THEN 'up' ELSE 'down' END"),
}

#: Views that the functions over tables read, by the names they have there.
VIEWS = ("reports_clean", "product_versions", "uptime_levels")

#: Functions over the views; a row for each is (parameters, result, body).
TABLE_FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "signature_summary": (
        "report_type STRING, wanted STRING DEFAULT NULL, product STRING DEFAULT NULL",
        "TABLE(signature STRING, category STRING, report_count BIGINT, percent DOUBLE)",
        """SELECT signature, category, n, CASE WHEN report_type = 'products' THEN round(n * 100 / sum(n) OVER (PARTITION BY signature), 3)
 ELSE round(n / sum(n) OVER (PARTITION BY signature), 5) END FROM (SELECT signature, category, count(*) AS n FROM (
 SELECT r.signature, CASE report_type WHEN 'products' THEN concat(v.product_name, ' ', v.version_string) WHEN 'os' THEN os_version_string
   WHEN 'process_type' THEN process_type WHEN 'architecture' THEN architecture
   WHEN 'flash_version' THEN CASE WHEN flash_version = '' THEN 'Unknown/No Flash' ELSE flash_version END END AS category
  FROM reports_clean AS r LEFT JOIN product_versions AS v ON v.product_version_id = r.product_version_id
  WHERE report_type IN ('products', 'os', 'process_type', 'architecture', 'flash_version') AND (wanted IS NULL OR r.signature = wanted)
   AND (report_type <> 'products' OR v.product_version_id IS NOT NULL)
   AND (report_type = 'products' OR product IS NULL OR lower(v.product_name) = lower(product))
 UNION ALL SELECT r.signature, l.uptime_string FROM reports_clean AS r JOIN uptime_levels AS l ON r.uptime >= l.min_uptime AND r.uptime < l.max_uptime
   LEFT JOIN product_versions AS v ON v.product_version_id = r.product_version_id
  WHERE report_type = 'uptime' AND (wanted IS NULL OR r.signature = wanted) AND (product IS NULL OR lower(v.product_name) = lower(product)))
 GROUP BY signature, category)"""),
    "get_product_version_ids": (
        "product STRING, versions ARRAY<STRING>", "TABLE(product_version_id STRING)",
        "SELECT product_version_id FROM product_versions WHERE lower(product_name) = lower(product) "
        "AND exists(versions, v -> lower(v) = lower(version_string))"),
    "watch_report_processing": (
        "since TIMESTAMP", "TABLE(report_count BIGINT, min_lag DOUBLE, max_lag DOUBLE, avg_lag DOUBLE)",
        "SELECT count(*), min(lag), max(lag), avg(lag) FROM (SELECT (unix_micros(completed_datetime) - unix_micros(date_processed)) / 1e6D AS lag "
        "FROM reports WHERE completed_datetime IS NOT NULL AND date_processed >= since)"),
}


def register(spark: SparkSession, views: dict | None = None) -> SparkSession:
    """Make the functions known to the session's SQL.

    ``views`` (name -> frame) become temporary views; a function over tables is made when
    the views it reads are there. ``content_count`` and ``plugin_count`` of a group are sums of
    their states: ``sum(content_count_state(0, process_type, n))``, which are combined before
    they are shuffled.
    """
    for name, frame in (views or {}).items():
        frame.createOrReplaceTempView(name)
    for name, (parameters, kind, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    needs = {"signature_summary": VIEWS, "get_product_version_ids": ("product_versions",), "watch_report_processing": ("reports",)}
    for name, (parameters, kind, body) in TABLE_FUNCTIONS.items():
        if all(spark.catalog.tableExists(v) for v in needs[name]):
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    return spark
