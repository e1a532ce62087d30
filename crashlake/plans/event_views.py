"""Crash tables derived from the event table, as SQL that Spark and DuckDB both run.

Every view is a projection or aggregate of ``events`` (or of a view before it), so its rows
grow with the events. ``sql(names)`` gives the WITH clause for a query text.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from crashlake import schemas as S

VIEWS: dict[str, str] = {}

VIEWS["ev"] = """
SELECT event_id, ts, CAST(ts AS DATE) AS d, user_id, event_type, value,
 CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, lpad(CAST(event_id AS STRING), 17, '0') AS pid
FROM events"""

VIEWS["reports"] = """
SELECT concat(substr(pid, 1, 8), '-', substr(pid, 9, 4), '-4000-8000-', substr(pid, 13, 5), '2',
   substr(replace(CAST(d AS STRING), '-', ''), 3)) AS uuid,
 ts AS date_processed, d AS report_date, ts - (k % 60) * INTERVAL '1' SECOND AS client_crash_date,
 CASE WHEN user_id % 3 = 0 THEN 'Atlas' WHEN user_id % 3 = 1 THEN 'Boreal' ELSE 'Mobile' END AS product,
 concat(CAST(user_id % 4 + 1 AS STRING), '.0') AS version,
 CASE user_id % 4 WHEN 0 THEN 'release' WHEN 1 THEN 'beta' WHEN 2 THEN 'aurora'
   ELSE CASE WHEN k = 99 THEN 'custom' ELSE 'nightly-x' END END AS release_channel,
 CASE WHEN k = 98 THEN 'local' ELSE concat(replace(CAST(d - CAST(k % 10 AS INT) AS STRING), '-', ''), '000000') END AS build,
 CASE WHEN k = 97 THEN NULL WHEN event_type = 'error' THEN concat('hang | sig_', CAST(k % 20 AS STRING))
   ELSE concat('sig_', CAST(k % 20 AS STRING)) END AS signature,
 CASE user_id % 5 WHEN 0 THEN 'Windows NT' WHEN 1 THEN 'Windows 7' WHEN 2 THEN 'Mac OS X' WHEN 3 THEN 'Linux' ELSE NULL END AS os_name,
 CASE user_id % 5 WHEN 0 THEN '5.1.2600 Service Pack 3' WHEN 1 THEN '6.1.7601' WHEN 2 THEN '10.8.2' WHEN 3 THEN '0.0.0 Linux 3.2.0 i686' ELSE NULL END AS os_version,
 CASE event_type WHEN 'purchase' THEN 'plugin' WHEN 'signup' THEN 'content' WHEN 'view' THEN NULL ELSE 'browser' END AS process_type,
 CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND k % 2 = 0) THEN concat('h', CAST(user_id AS STRING)) ELSE NULL END AS hang_id,
 CAST(floor(value * 10) AS INT) AS uptime, CAST(floor(value * 1000) AS INT) AS install_age,
 CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(floor(value * 7) AS INT) END AS last_crash,
 CASE WHEN k % 7 = 0 THEN NULL ELSE concat('reason_', CAST(k % 7 AS STRING)) END AS reason,
 CASE WHEN k % 11 = 0 THEN NULL ELSE concat('0x', CAST(k % 11 AS STRING)) END AS address,
 CASE WHEN k % 2 = 0 THEN 'x86' ELSE 'amd64' END AS cpu_name,
 CASE WHEN k % 13 = 0 THEN 'unknown' ELSE concat('family 6 model 23 stepping 10 | ', CAST(k % 4 + 1 AS STRING)) END AS cpu_info,
 CASE WHEN k % 5 = 0 THEN NULL ELSE concat('http://host', CAST(k % 5 AS STRING), '.example.org/p', CAST(k AS STRING), '?q=1') END AS url,
 CASE WHEN k % 3 = 0 THEN concat('user', CAST(user_id AS STRING), '@example.org') ELSE '' END AS email,
 CASE WHEN k % 4 = 0 THEN concat('it broke at ', CAST(k AS STRING)) ELSE NULL END AS user_comments,
 CASE WHEN k % 6 = 0 THEN 'with notes' ELSE NULL END AS app_notes,
 CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 1 THEN '' ELSE concat('11.', CAST(k % 9 AS STRING)) END AS flash_version,
 concat('src/file', CAST(k % 8 AS STRING), '.cpp') AS topmost_filenames,
 CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false ELSE NULL END AS addons_checked,
 concat('{p', CAST(user_id % 3 AS STRING), '@example.org}') AS productid,
 ts + (k % 30) * INTERVAL '1' SECOND AS started_datetime,
 CASE WHEN k = 96 THEN NULL ELSE ts + (k % 30 + 5) * INTERVAL '1' SECOND END AS completed_datetime,
 user_id, k
FROM ev"""

VIEWS["releases"] = """
SELECT DISTINCT product, version, release_channel, build, user_id % 4 AS line, k % 2 AS odd FROM reports
WHERE build <> 'local' AND release_channel <> 'custom'"""

VIEWS["product_versions"] = """
SELECT DISTINCT concat(product, '|', version, CASE WHEN line = 1 THEN concat('|b', CAST(odd + 1 AS STRING)) ELSE '' END) AS product_version_id,
 product AS product_name, version AS major_version, version AS release_version,
 CASE line WHEN 1 THEN concat(version, 'b', CAST(odd + 1 AS STRING)) WHEN 2 THEN concat(version, 'a2') WHEN 3 THEN concat(version, 'a1') ELSE version END AS version_string,
 CASE WHEN line = 1 THEN CAST(odd + 1 AS INT) ELSE NULL END AS beta_number,
 concat('00', substr(version, 1, 1), '000000', CASE line WHEN 1 THEN concat('b00', CAST(odd + 1 AS STRING)) WHEN 2 THEN 'a002' WHEN 3 THEN 'a001' ELSE 'r000' END) AS version_sort,
 DATE '2023-12-15' AS build_date,
 CASE WHEN line = 0 THEN DATE '2023-12-15' + 126 WHEN line = 2 THEN DATE '2023-12-15' + 40 ELSE DATE '2023-12-15' + 63 END AS sunset_date,
 CASE line WHEN 0 THEN 'Release' WHEN 1 THEN 'Beta' WHEN 2 THEN 'Aurora' ELSE 'Nightly' END AS build_type,
 false AS is_rapid_beta, CASE WHEN line = 1 THEN concat(product, '|', version) ELSE NULL END AS rapid_beta_id,
 line IN (2, 3) AS has_builds, line IN (0, 1) AS featured_version
FROM releases
UNION ALL
SELECT DISTINCT concat(product, '|', version), product, version, version, concat(version, 'b'), 0, concat('00', substr(version, 1, 1), '000000r000'),
 DATE '2023-12-15', DATE '2023-12-15' + 63, 'Beta', true, CAST(NULL AS STRING), true, false
FROM releases WHERE line = 1"""

VIEWS["product_version_builds"] = """
SELECT DISTINCT concat(product, '|', version, CASE WHEN line = 1 THEN concat('|b', CAST(odd + 1 AS STRING)) ELSE '' END) AS product_version_id,
 CAST(build AS BIGINT) AS build_id, CASE WHEN line = 0 THEN 'linux' ELSE 'win' END AS platform, 'main' AS repository
FROM releases WHERE (line <> 1 OR CAST(substr(build, 8, 1) AS INT) % 2 = odd)"""

VIEWS["raw_adu"] = """
SELECT d AS adu_date, product AS product_name, os_name AS product_os_platform,
 CASE WHEN os_version IS NULL THEN '' ELSE substr(os_version, 1, 2) END AS product_os_version, version0 AS product_version, build,
 channel AS build_channel, CASE WHEN product = 'Mobile' THEN 'p2@example.org' ELSE 'other' END AS product_guid,
 CAST(count(*) AS BIGINT) * 1000 AS adu_count
FROM (SELECT report_date AS d, product, os_name, os_version, build,
  CASE release_channel WHEN 'nightly-x' THEN 'nightly' ELSE release_channel END AS channel,
  CASE user_id % 4 WHEN 2 THEN concat(version, 'a2') WHEN 3 THEN concat(version, 'a1') ELSE version END AS version0 FROM reports) AS r
GROUP BY d, product, os_name, CASE WHEN os_version IS NULL THEN '' ELSE substr(os_version, 1, 2) END, version0, build, channel"""

VIEWS["crash_types"] = """
SELECT * FROM (VALUES ('Browser', 'crash', 'browser', false, 'C', true), ('OOP Plugin', 'oop', 'plugin', false, 'P', true),
 ('Hang Browser', 'hang-b', 'plugin', true, 'c', false), ('Hang Plugin', 'hang-p', 'browser', true, 'p', true),
 ('Content', 'content', 'content', false, 'T', true)) AS t(crash_type, crash_type_short, process_type, has_hang_id, old_code, include_agg)"""

VIEWS["os_names"] = """
SELECT * FROM (VALUES ('Windows', 'win'), ('Mac OS X', 'mac'), ('Linux', 'lin')) AS t(os_name, os_short_name)"""

VIEWS["uptime_levels"] = """
SELECT * FROM (VALUES (1, '< 1 min', 0, 60), (2, '1-5 min', 60, 300), (3, '5-15 min', 300, 900),
 (4, '15-60 min', 900, 3600), (5, '> 1 hour', 3600, 31557600)) AS t(uptime_level, uptime_string, min_uptime, max_uptime)"""

VIEWS["channels"] = """
SELECT product_name, release_channel, CASE WHEN release_channel = 'Release' THEN 0.1e0 ELSE 1.0e0 END AS throttle
FROM (SELECT DISTINCT product_name, build_type AS release_channel FROM product_versions) AS c"""

VIEWS["products"] = """
SELECT * FROM (VALUES ('Atlas', 1, '2.0', 'atlas'), ('Boreal', 2, '2.0', 'boreal'), ('Mobile', 3, '3.0', 'mobile'))
 AS t(product_name, sort, rapid_release_version, release_name)"""

VIEWS["release_channels"] = """
SELECT * FROM (VALUES ('Nightly', 1), ('Aurora', 2), ('Beta', 3), ('Release', 4)) AS t(release_channel, sort)"""

VIEWS["guid_map"] = """
SELECT * FROM (VALUES ('Mobile', '{p2@example.org}'), ('Unused', '{zz@example.org}')) AS t(product_name, productid)"""

# ---- results of the cleaning, computed in SQL for the checks only ---------------------

ORACLE_VIEWS: dict[str, str] = {}

ORACLE_VIEWS["vkeys"] = """
SELECT lower(product_name) AS p, release_version AS v, lower(build_type) AS c, CAST(-1 AS BIGINT) AS b, min(product_version_id) AS id
FROM product_versions WHERE build_type <> 'Beta' GROUP BY ALL
UNION ALL
SELECT lower(product_name), release_version, 'beta', build_id, min(product_version_id)
FROM product_versions JOIN product_version_builds USING (product_version_id) WHERE build_type = 'Beta' GROUP BY ALL"""

ORACLE_VIEWS["staged"] = r"""
SELECT r.*, k.id AS product_version_id, (k.id IS NULL OR r.channel IS NULL) AS is_bad FROM (
 SELECT uuid, date_processed, report_date, client_crash_date, coalesce(signature, '') AS signature,
  coalesce(reason, 'Unknown') AS reason, coalesce(address, 'Unknown') AS address,
  coalesce(flash_version, 'Unknown') AS flash_version, product, version,
  coalesce(process_type, 'Browser') AS process_type, hang_id, uptime, install_age, email, user_comments, url, app_notes,
  CASE WHEN regexp_full_match(build, '[0-9]+') THEN CAST(build AS BIGINT) END AS build, cpu_name AS architecture,
  CAST(nullif(regexp_extract(cpu_info, '[|] ([0-9]+)$', 1), '') AS INT) AS cores,
  coalesce(nullif(regexp_extract(coalesce(url, ''), '^([a-z]+://([a-z0-9]+[.])*[a-z0-9]+)', 1), ''), '') AS domain,
  CASE WHEN release_channel = 'release' THEN 'Release' WHEN release_channel = 'beta' THEN 'Beta'
   WHEN release_channel = 'aurora' THEN 'Aurora' WHEN release_channel LIKE 'nightly%' THEN 'Nightly' END AS channel,
  CASE WHEN os_name LIKE 'Windows%' THEN 'Windows' WHEN os_name LIKE 'Mac%' THEN 'Mac OS X'
   WHEN os_name LIKE 'Linux%' THEN 'Linux' ELSE 'Unknown' END AS os_name,
  CASE WHEN os_name = 'Linux' THEN '3.2.0 i686' ELSE os_version END AS os_version
 FROM reports WHERE completed_datetime IS NOT NULL) AS r
LEFT JOIN vkeys AS k ON lower(r.product) = k.p AND r.version = k.v AND lower(r.channel) = k.c
 AND k.b = CASE WHEN r.channel = 'Beta' THEN r.build ELSE -1 END"""

ORACLE_VIEWS["clean"] = """
SELECT uuid, date_processed, report_date, client_crash_date, product_version_id, build, signature, install_age, uptime,
 reason, address, os_name, os_major, os_minor,
 CASE os_name WHEN 'Windows' THEN CASE WHEN os_major = 5 THEN 'Windows XP' ELSE 'Windows 7' END
  WHEN 'Mac OS X' THEN 'OS X 10.8' ELSE os_name END AS os_version_string,
 hang_id, flash_version, process_type, channel AS release_channel, domain, architecture, cores,
 CAST(strptime(substr(CAST(build AS STRING), 1, 8), '%Y%m%d') AS DATE) AS bdate, email, user_comments, url, app_notes
FROM (SELECT *, CASE WHEN os_name = 'Unknown' THEN 0 ELSE CAST(regexp_extract(os_version, '^([0-9]+)', 1) AS INT) END AS os_major,
  CASE WHEN os_name = 'Unknown' THEN 0 ELSE CAST(regexp_extract(os_version, '^[0-9]+[.]([0-9]+)', 1) AS INT) END AS os_minor
 FROM staged WHERE NOT is_bad) AS s"""

ORACLE_VIEWS["adu0"] = """
SELECT adu_date, coalesce(g.product_name, a.product_name) AS p, product_version AS v, build_channel AS c,
 CASE WHEN regexp_full_match(build, '[0-9]+') THEN CAST(build AS BIGINT) END AS build_id,
 CASE WHEN regexp_full_match(build, '[0-9]+') THEN CAST(strptime(substr(build, 1, 8), '%Y%m%d') AS DATE) END AS bdate,
 CASE WHEN product_os_platform LIKE 'Windows%' THEN 'Windows' WHEN product_os_platform LIKE 'Mac%' THEN 'Mac OS X'
  WHEN product_os_platform LIKE 'Linux%' THEN 'Linux' ELSE 'Unknown' END AS os_name, adu_count
FROM raw_adu AS a LEFT JOIN guid_map AS g ON a.product_guid = trim(g.productid, '{}')"""

ORACLE_VIEWS["product_adu"] = """
SELECT product_version_id, os_name, adu_date, CAST(sum(n) AS BIGINT) AS adu_count FROM (
 SELECT pv.product_version_id, coalesce(a.os_name, 'Unknown') AS os_name, dd.adu_date, coalesce(a.adu_count, 0) AS n
 FROM product_versions AS pv JOIN (SELECT DISTINCT adu_date FROM raw_adu) AS dd ON dd.adu_date BETWEEN pv.build_date AND pv.sunset_date + 1
 LEFT JOIN adu0 AS a ON a.p = pv.product_name AND a.v = pv.version_string AND a.c = lower(pv.build_type) AND a.adu_date = dd.adu_date
 WHERE pv.build_type IN ('Release', 'Nightly', 'Aurora')
 UNION ALL
 SELECT pv.product_version_id, a.os_name, a.adu_date, a.adu_count FROM product_versions AS pv
 JOIN adu0 AS a ON a.p = pv.product_name AND a.v = pv.release_version AND a.c = 'beta'
 WHERE pv.build_type = 'Beta' AND a.adu_date BETWEEN pv.build_date AND pv.sunset_date + 1
 AND EXISTS (SELECT 1 FROM product_version_builds AS b WHERE b.product_version_id = pv.product_version_id AND b.build_id = a.build_id)) AS u
GROUP BY product_version_id, os_name, adu_date"""

ORACLE_VIEWS["build_adu"] = """
SELECT product_version_id, os_name, adu_date, build_date, CAST(sum(n) AS BIGINT) AS adu_count FROM (
 SELECT pv.product_version_id, a.os_name, a.adu_date, a.bdate AS build_date, a.adu_count AS n
 FROM product_versions AS pv JOIN adu0 AS a ON a.p = pv.product_name AND a.v = pv.version_string AND a.c = lower(pv.build_type)
 WHERE pv.build_type IN ('Nightly', 'Aurora') AND a.adu_date BETWEEN pv.build_date AND pv.sunset_date + 1 AND a.adu_date <= a.bdate + 6
 UNION ALL
 SELECT pv.rapid_beta_id, a.os_name, a.adu_date, a.bdate, a.adu_count FROM product_versions AS pv
 JOIN adu0 AS a ON a.p = pv.product_name AND a.v = pv.release_version AND a.c = 'beta'
 WHERE pv.build_type = 'Beta' AND pv.rapid_beta_id IS NOT NULL AND a.adu_date BETWEEN pv.build_date AND pv.sunset_date + 1 AND a.adu_date <= a.bdate + 6
 AND EXISTS (SELECT 1 FROM product_version_builds AS b WHERE b.product_version_id = pv.product_version_id AND b.build_id = a.build_id)) AS u
GROUP BY product_version_id, os_name, adu_date, build_date"""

ORACLE_VIEWS["tcbs0"] = """
SELECT signature, report_date, product_version_id, process_type, release_channel, count(*) AS report_count,
 count(*) FILTER (os_name = 'Windows') AS win_count, count(*) FILTER (os_name = 'Mac OS X') AS mac_count,
 count(*) FILTER (os_name = 'Linux') AS lin_count, count(hang_id) AS hang_count, count(*) FILTER (uptime < 60) AS startup_count
FROM clean JOIN product_versions USING (product_version_id)
WHERE report_date BETWEEN build_date AND sunset_date GROUP BY ALL"""

ORACLE_VIEWS["tcbs"] = """
SELECT * FROM tcbs0
UNION ALL
SELECT signature, report_date, rapid_beta_id, process_type, release_channel, CAST(sum(report_count) AS BIGINT), CAST(sum(win_count) AS BIGINT),
 CAST(sum(mac_count) AS BIGINT), CAST(sum(lin_count) AS BIGINT), CAST(sum(hang_count) AS BIGINT), CAST(sum(startup_count) AS BIGINT)
FROM tcbs0 JOIN product_versions USING (product_version_id)
WHERE build_type = 'Beta' AND rapid_beta_id IS NOT NULL GROUP BY signature, report_date, rapid_beta_id, process_type, release_channel"""

ORACLE_VIEWS["kinded"] = """
SELECT c.*, t.crash_type, t.include_agg FROM clean AS c JOIN crash_types AS t
ON lower(c.process_type) = t.process_type AND (c.hang_id IS NOT NULL) = t.has_hang_id"""

ORACLE_VIEWS["cbu0"] = """
SELECT a.product_version_id, a.adu_date AS report_date, o.os_short_name, t.crash_type,
 (SELECT count(*) FROM kinded AS k WHERE k.product_version_id = a.product_version_id AND k.report_date = a.adu_date
   AND k.os_name = a.os_name AND k.crash_type = t.crash_type) AS report_count, a.adu_count AS adu
FROM product_adu AS a JOIN os_names AS o USING (os_name) CROSS JOIN crash_types AS t
JOIN product_versions AS pv ON pv.product_version_id = a.product_version_id"""

ORACLE_VIEWS["cbu"] = """
SELECT * FROM cbu0
UNION ALL
SELECT rapid_beta_id, report_date, os_short_name, crash_type, CAST(sum(report_count) AS BIGINT), CAST(sum(adu) AS BIGINT)
FROM cbu0 JOIN product_versions USING (product_version_id) WHERE rapid_beta_id IS NOT NULL
GROUP BY rapid_beta_id, report_date, os_short_name, crash_type"""

ORACLE_VIEWS["cbub"] = """
SELECT n.id AS product_version_id, n.report_date, n.build_date, o.os_short_name, n.crash_type, n.report_count, n.adu FROM (
 SELECT a.product_version_id AS id, a.adu_date AS report_date, a.build_date, a.os_name, t.crash_type,
  (SELECT count(DISTINCT k.uuid) FROM kinded AS k JOIN product_versions AS pv ON pv.product_version_id = k.product_version_id
    JOIN product_version_builds AS b ON b.product_version_id = k.product_version_id AND b.build_id = k.build
    WHERE a.product_version_id = CASE WHEN k.release_channel = 'Beta' THEN pv.rapid_beta_id ELSE k.product_version_id END
    AND k.release_channel IN ('Nightly', 'Aurora', 'Beta') AND k.bdate = a.build_date AND k.report_date = a.adu_date
    AND k.os_name = a.os_name AND k.crash_type = t.crash_type) AS report_count, a.adu_count AS adu
 FROM build_adu AS a CROSS JOIN crash_types AS t
 WHERE EXISTS (SELECT 1 FROM product_version_builds AS b JOIN product_versions AS pv USING (product_version_id)
  WHERE a.product_version_id IN (b.product_version_id, pv.rapid_beta_id)
  AND CAST(strptime(substr(CAST(b.build_id AS STRING), 1, 8), '%Y%m%d') AS DATE) = a.build_date)) AS n
JOIN os_names AS o USING (os_name)"""

_NAMES = [*VIEWS, *ORACLE_VIEWS]


def sql(body: str) -> str:
    """Put the views a query needs in front of it, in order."""
    texts = {**VIEWS, **ORACLE_VIEWS}
    need: set[str] = set()

    def visit(text: str) -> None:
        for name in _NAMES:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                visit(texts[name])
    visit(body)
    views = ",\n".join(f"{n} AS ({texts[n].strip()})" for n in _NAMES if n in need)
    body = body.strip()
    if not views:
        return body
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


class Tables:
    """The driver's tables and the derived views as lazy Spark frames of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._made: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A driver table; time columns become UTC timestamps at load."""
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        casts = {f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields
                 if f.dataType.typeName() == "timestamp_ntz"}
        return df.withColumns(casts) if casts else df

    def view(self, name: str) -> DataFrame:
        if name not in self._made:
            if name in VIEWS:
                inputs = {n: self.view(n) for n in ("events", *VIEWS)
                          if n != name and re.search(rf"\b{n}\b", VIEWS[name])}
                text = VIEWS[name]
                if inputs:  # frames are named in braces, so those of the text are doubled
                    text = text.replace("{", "{{").replace("}", "}}")
                for n in inputs:
                    text = re.sub(rf"\b(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
                used = {n: df for n, df in inputs.items() if "{" + n + "}" in text}
                self._made[name] = self.spark.sql(text, **used) if used else self.spark.sql(text)
            else:
                self._made[name] = self.raw(name)
        return self._made[name]

    def small(self, name: str) -> DataFrame:
        """Fixed rule tables of the package."""
        rows, columns = {
            "windows_versions": (S.WINDOWS_VERSIONS, "windows_version_name, major_version, minor_version"),
            "os_matches": (S.OS_NAME_MATCHES, "os_name, match_string"),
            "channel_matches": (S.CHANNEL_MATCHES, "release_channel, match_string"),
        }[name]
        values = ", ".join(str(tuple(r)) for r in rows)
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS t({columns})")
