"""Registered queries of the cleaning, the dimensions and the daily marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from crashlake.operators import (correlations, counts, dims, duplicates, explosive, extract,
                                 graphs, hangs, signatures, topcrash, users, views)
from crashlake.operators.clean import new_dimension_values
from crashlake.operators.common import page_count
from crashlake.plans.registry import TODAY, Context, query

_CLEAN = """uuid, date_processed, client_crash_date, product_version_id, build, signature, install_age, uptime,
 reason, address, os_name, os_major, os_minor, os_version_string, hang_id, flash_version, process_type, release_channel,
 domain, architecture, cores"""


@query("g1_reports_clean", f"SELECT {_CLEAN} FROM clean", text=("date_processed", "client_crash_date"))
def _(c: Context):
    return c.clean.drop("duplicate_of")


@query("g1_reports_bad", "SELECT uuid, date_processed FROM staged WHERE is_bad", text=("date_processed",))
def _(c: Context):
    return c.cleaned.bad


@query("g1_reports_user_info", """SELECT uuid, date_processed, email, user_comments, url, app_notes FROM clean
WHERE email <> '' OR user_comments <> '' OR url <> '' OR app_notes <> ''""", text=("date_processed",))
def _(c: Context):
    return c.cleaned.user_info


# ids seen on even hours count as cleaned before
@query("c12_g1_skip_done", """SELECT uuid, product_version_id FROM clean
WHERE uuid NOT IN (SELECT uuid FROM reports WHERE hour(date_processed) % 2 = 0)""")
def _(c: Context):
    from crashlake.operators.clean import build_reports_clean
    done = c.t("reports").where(F.hour("date_processed") % 2 == 0).select("uuid", "date_processed")
    return build_reports_clean(c.t("reports"), c.dims, done).clean.select("uuid", "product_version_id")


@query("g2_grow_lookup", """
SELECT lower(f) AS value, min(ts) AS first_seen FROM (
 SELECT CASE WHEN k % 2 = 0 THEN upper(reason) ELSE reason END AS f, date_processed AS ts, reason FROM (
  SELECT coalesce(reason, 'Unknown') AS reason, date_processed, k FROM reports) AS a) AS b
WHERE lower(f) NOT IN ('reason_1', 'reason_2') GROUP BY lower(f)""", text=("first_seen",))
def _(c: Context):
    new = c.t("reports").select(
        F.when(F.col("k") % 2 == 0, F.upper(F.coalesce("reason", F.lit("Unknown"))))
        .otherwise(F.coalesce("reason", F.lit("Unknown"))).alias("reason"), "date_processed")
    known = c.spark.createDataFrame([("REASON_1",), ("reason_2",)], "reason string")
    return dims.grow_lookup(new, known, "reason").select(F.lower("reason").alias("value"), "first_seen")


@query("g2_new_dimension_values", """
SELECT 'address' AS kind, address AS value, min(date_processed) AS first_seen FROM staged GROUP BY address
UNION ALL SELECT 'flash_version', flash_version, min(date_processed) FROM staged GROUP BY flash_version
UNION ALL SELECT 'domain', domain, min(date_processed) FROM staged GROUP BY domain
UNION ALL SELECT 'signature', signature, min(date_processed) FROM staged GROUP BY signature""", text=("first_seen",))
def _(c: Context):
    found = new_dimension_values(c.cleaned.staged.withColumn("date_processed", F.col("date_processed")),
                                 {}, c.dims)
    out = None
    for kind in ("address", "flash_version", "domain", "signature"):
        part = found[kind].select(F.lit(kind).alias("kind"), F.col(kind).alias("value"), "first_seen")
        out = part if out is None else out.unionByName(part)
    return out


@query("g3_os_versions", """
SELECT os_name, os_major AS major_version, os_minor AS minor_version, os_version_string FROM clean
WHERE os_name <> 'Unknown' GROUP BY ALL""")
def _(c: Context):
    raw = c.cleaned.staged.select(F.col("_os").alias("os_name"), "os_version")
    return dims.grow_os_versions(raw, c.dims.os_matches, c.dims.windows_versions).drop("os_version_id")


# reports and delayed copies of every third of them
_DUP_REPORTS = """dup_reports AS (
 SELECT uuid, date_processed, client_crash_date, uptime, install_age, product, version, build, signature, cpu_name, cpu_info,
  os_name, os_version, address, topmost_filenames, reason, app_notes, url FROM reports
 UNION ALL
 SELECT concat('c', substr(uuid, 2)), date_processed + INTERVAL '10' MINUTE, client_crash_date + INTERVAL '40' SECOND, uptime + 20, install_age + k % 150,
  product, version, build, signature, cpu_name, cpu_info, os_name, os_version, address, topmost_filenames, reason, app_notes, url
 FROM reports WHERE k % 3 = 0),
"""
_DUP_KEYS = ("product, version, build, signature, cpu_name, cpu_info, os_name, os_version, address, "
             "topmost_filenames, reason, app_notes, url")


def _dup_reports(c: Context):
    cols = ["uuid", "date_processed", "client_crash_date", "uptime", "install_age", *duplicates.IDENTITY]
    r = c.t("reports")
    copy = r.where(F.col("k") % 3 == 0).withColumns({
        "uuid": F.concat(F.lit("c"), F.substring("uuid", 2, 40)),
        "date_processed": F.col("date_processed") + F.expr("INTERVAL 10 MINUTE"),
        "client_crash_date": F.col("client_crash_date") + F.expr("INTERVAL 40 SECOND"),
        "uptime": F.col("uptime") + 20, "install_age": F.col("install_age") + F.col("k") % 150})
    return r.select(*cols).unionByName(copy.select(*cols))


_FUZZY = """((l.uptime IS NULL OR f.uptime IS NULL OR (epoch_us(f.client_crash_date) - epoch_us(l.client_crash_date)) / 1e6 - (f.uptime - l.uptime) BETWEEN -60 AND 60) OR f.uptime < 60)
 AND (epoch_us(f.client_crash_date) - epoch_us(l.client_crash_date)) / 1e6 - (f.install_age - l.install_age) BETWEEN -60 AND 60 AND f.uuid <> l.uuid"""


@query("g4_reports_duplicates", "WITH " + _DUP_REPORTS + f"""
led AS (SELECT *, first_value(uuid) OVER (PARTITION BY {_DUP_KEYS} ORDER BY client_crash_date, uuid) AS leader FROM dup_reports),
foll AS (SELECT f.uuid, l.uuid AS duplicate_of, f.date_processed FROM led AS f JOIN dup_reports AS l ON f.leader = l.uuid WHERE {_FUZZY})
SELECT * FROM foll UNION ALL
SELECT uuid, uuid, date_processed FROM dup_reports WHERE uuid IN (SELECT duplicate_of FROM foll)""", text=("date_processed",))
def _(c: Context):
    return duplicates.find_duplicates(_dup_reports(c))


@query("g5_sliding_duplicates", "WITH " + _DUP_REPORTS + f"""
slots AS (SELECT *, unnest(range(CAST(ceil((epoch_us(date_processed) - 3600000000) / 1800000000.0) AS BIGINT), CAST(floor(epoch_us(date_processed) / 1800000000.0) AS BIGINT) + 1)) AS slot FROM dup_reports),
led AS (SELECT *, first_value(uuid) OVER (PARTITION BY slot, {_DUP_KEYS} ORDER BY client_crash_date, uuid) AS leader FROM slots),
foll AS (SELECT f.uuid, l.uuid AS duplicate_of, f.slot FROM led AS f JOIN slots AS l ON f.leader = l.uuid AND f.slot = l.slot WHERE {_FUZZY}),
both_ AS (SELECT * FROM foll UNION ALL SELECT DISTINCT duplicate_of, duplicate_of, slot FROM foll)
SELECT uuid, arg_min(duplicate_of, slot) AS duplicate_of FROM both_ GROUP BY uuid""")
def _(c: Context):
    return duplicates.find_duplicates_sliding(_dup_reports(c)).select("uuid", "duplicate_of")


_SIGV = """sigv AS (
 SELECT n.*, coalesce(e.id, l.id) AS pvid FROM (SELECT coalesce(signature, '') AS signature, product, version, build, min(date_processed) AS first_report
  FROM reports GROUP BY ALL) AS n
 LEFT JOIN (SELECT product_name AS p, release_version AS v, CAST(build_id AS STRING) AS b, min(product_version_id) AS id
  FROM product_versions JOIN product_version_builds USING (product_version_id) GROUP BY ALL) AS e ON n.product = e.p AND n.version = e.v AND n.build = e.b
 LEFT JOIN (SELECT product_name AS p, release_version AS v, min(product_version_id) AS id FROM product_versions JOIN product_version_builds USING (product_version_id)
  WHERE build_type IN ('Release', 'Nightly', 'Aurora') GROUP BY ALL) AS l ON n.product = l.p AND n.version = l.v),
"""


def _signature_tables(c: Context):
    return signatures.update_signatures(c.t("reports"), c.pv, c.t("product_version_builds"))


@query("g6_signatures", "WITH " + _SIGV + """x AS (SELECT 1)
SELECT signature, min(first_report) AS first_report, min(TRY_CAST(build AS BIGINT)) AS first_build FROM sigv WHERE pvid IS NOT NULL GROUP BY signature""",
       text=("first_report",))
def _(c: Context):
    return _signature_tables(c)[0]


@query("g6_signature_products", "WITH " + _SIGV + """x AS (SELECT 1)
SELECT signature, pvid AS product_version_id, min(first_report) AS first_report FROM sigv WHERE pvid IS NOT NULL GROUP BY ALL""",
       text=("first_report",))
def _(c: Context):
    return _signature_tables(c)[1]


@query("g6_signature_rollup", "WITH " + _SIGV + """sp AS (SELECT DISTINCT signature, pvid FROM sigv WHERE pvid IS NOT NULL)
SELECT signature, product_name, count(*) AS ver_count, string_agg(version_string, ', ' ORDER BY version_sort, version_string) AS versions
FROM sp JOIN product_versions ON product_version_id = pvid GROUP BY signature, product_name""")
def _(c: Context):
    rollup = _signature_tables(c)[2]
    return rollup.select("signature", "product_name", "ver_count",
                         F.array_join("version_list", ", ").alias("versions"))


# a release list in the event data: one row per product, version, channel and build
_RELEASES = """rel AS (SELECT DISTINCT lower(product) AS product_name, CASE WHEN line = 0 AND odd = 1 THEN concat(version, 'esr') WHEN line = 2 THEN concat(version, 'a2') WHEN line = 3 THEN concat(version, 'a1') ELSE version END AS version,
 CASE line WHEN 0 THEN 'Release' WHEN 1 THEN 'Beta' WHEN 2 THEN 'Aurora' ELSE 'Nightly' END AS build_type, CAST(build AS BIGINT) AS build_id,
 CASE WHEN line = 1 THEN odd + 1 ELSE NULL END AS beta_number, CASE WHEN line = 0 THEN 'linux' ELSE 'win' END AS platform, 'main' AS repository FROM releases),
recent AS (SELECT CASE product_name WHEN 'atlas' THEN 'Atlas' WHEN 'boreal' THEN 'Boreal' ELSE 'Mobile' END AS p, *,
  CASE WHEN version LIKE '%esr' THEN 'ESR' ELSE build_type END AS bt, CAST(strptime(substr(CAST(build_id AS STRING), 1, 8), '%Y%m%d') AS DATE) AS bd,
  CAST(substr(version, 1, 1) AS INT) >= CASE WHEN product_name = 'mobile' THEN 3 ELSE 1 END AS is_rapid, build_type = 'Beta' AND product_name <> 'boreal' AS is_rb FROM rel
  WHERE CAST(strptime(substr(CAST(build_id AS STRING), 1, 8), '%Y%m%d') AS DATE) > DATE '2024-02-01' - 30),
copied AS (SELECT p, version, beta_number, build_id, bt, bd, platform, is_rapid, is_rb FROM recent UNION ALL
 SELECT 'Runtime', version, beta_number, build_id, bt, bd, platform, is_rapid, is_rb FROM recent WHERE p = 'Atlas' AND CAST(substr(version, 1, 1) AS INT) >= 3)
"""
_NEW_VERSIONS = "WITH " + _RELEASES + """, fresh AS (
SELECT p AS product_name, version AS release_version, CASE WHEN coalesce(beta_number, 0) <> 0 THEN concat(version, 'b', CAST(beta_number AS STRING)) ELSE version END AS version_string,
 beta_number, min(bd) AS build_date, bt AS build_type, false AS is_rapid_beta, lower(bt) IN ('aurora', 'nightly') AS has_builds, CAST(NULL AS STRING) AS parent
FROM copied WHERE is_rapid AND NOT is_rb GROUP BY p, version, beta_number, bt
UNION ALL SELECT p, version, concat(version, 'b'), 0, min(bd), 'beta', true, true, NULL FROM copied WHERE is_rapid AND is_rb GROUP BY p, version
UNION ALL SELECT c.p, c.version, concat(c.version, 'b', CAST(beta_number AS STRING)), beta_number, min(c.bd), 'beta', false, false, concat(c.version, 'b')
 FROM copied AS c WHERE is_rapid AND is_rb GROUP BY c.p, c.version, beta_number)
"""


def _new_versions(c: Context):
    r = c.t("releases")
    line, odd = F.col("line"), F.col("odd")
    rel = r.select(
        F.lower("product").alias("product_name"),
        F.when((line == 0) & (odd == 1), F.concat("version", F.lit("esr")))
        .when(line == 2, F.concat("version", F.lit("a2")))
        .when(line == 3, F.concat("version", F.lit("a1"))).otherwise(F.col("version")).alias("version"),
        F.element_at(F.array(*[F.lit(x) for x in ("Release", "Beta", "Aurora", "Nightly")]),
                     (line + 1).cast("int")).alias("build_type"),
        F.col("build").cast("bigint").alias("build_id"),
        F.when(line == 1, (odd + 1).cast("int")).alias("beta_number"),
        F.when(line == 0, F.lit("linux")).otherwise(F.lit("win")).alias("platform"),
        F.lit("main").alias("repository")).distinct()
    products = c.spark.createDataFrame(
        [("Atlas", "1.0", "1.0", "Atlas"), ("Boreal", "1.0", "99.0", "Boreal"),
         ("Mobile", "3.0", "1.0", "Mobile"), ("Runtime", "3.0", "99.0", "Runtime")],
        "product_name string, rapid_release_version string, rapid_beta_version string, release_name string")
    repos = c.spark.createDataFrame([("Main",)], "repository string")
    specials = c.spark.createDataFrame(
        [], "platform string, repository string, release_channel string, release_name string, "
            "product_name string, min_version string")
    return dims.update_product_versions(rel, products, repos, specials, None, None, TODAY, 30,
                                        copies=(("Atlas", "Runtime"),))


@query("g7_product_versions", _NEW_VERSIONS + """
SELECT product_name, release_version, version_string, beta_number, build_date,
 build_date + CASE WHEN build_type IN ('Release', 'ESR') THEN 126 ELSE 63 END AS own_sunset, build_type, is_rapid_beta, has_builds, parent FROM fresh
""".replace("own_sunset", "sunset_date").replace(
    "build_date + CASE", "CASE WHEN parent IS NULL THEN build_date ELSE (SELECT min(g.build_date) FROM fresh AS g WHERE g.product_name = fresh.product_name "
    "AND g.release_version = fresh.release_version AND g.is_rapid_beta) END + CASE"), text=("build_date", "sunset_date"))
def _(c: Context):
    v, _builds = _new_versions(c)
    names = v.select(F.col("product_version_id").alias("rapid_beta_id"), F.col("version_string").alias("parent"))
    return v.join(names, "rapid_beta_id", "left").select(
        "product_name", "release_version", "version_string", "beta_number", "build_date",
        "sunset_date", "build_type", "is_rapid_beta", "has_builds", "parent")


@query("g7_product_version_builds", _NEW_VERSIONS + """
SELECT DISTINCT f.product_name, f.version_string, c.build_id, c.platform FROM copied AS c JOIN fresh AS f
ON c.p = f.product_name AND c.version = f.release_version AND lower(c.bt) = lower(f.build_type) AND c.beta_number IS NOT DISTINCT FROM f.beta_number""")
def _(c: Context):
    v, b = _new_versions(c)
    return b.join(v.select("product_version_id", "product_name", "version_string"), "product_version_id") \
        .select("product_name", "version_string", "build_id", "platform")


@query("l8_append_releases", "WITH " + _RELEASES + """, ok AS (SELECT *, bd BETWEEN DATE '2005-01-01' AND DATE '2024-03-01' AS good FROM recent)
SELECT product_name, version, build_type, build_id, platform, beta_number FROM ok WHERE good AND build_type <> 'Nightly'
AND NOT (build_type = 'Beta' AND build_id % 2000000 = 0)""")
def _(c: Context):
    r = c.t("releases")
    new = r.select(F.lower("product").alias("product_name"),
                   F.when((F.col("line") == 0) & (F.col("odd") == 1), F.concat("version", F.lit("esr")))
                   .when(F.col("line") == 2, F.concat("version", F.lit("a2")))
                   .when(F.col("line") == 3, F.concat("version", F.lit("a1")))
                   .otherwise(F.col("version")).alias("version"),
                   F.when(F.col("line") == 0, F.lit("linux")).otherwise(F.lit("win")).alias("platform"),
                   F.col("build").cast("bigint").alias("build_id"),
                   F.element_at(F.array(*[F.lit(x) for x in ("Release", "Beta", "Aurora", "Nightly")]),
                                (F.col("line") + 1).cast("int")).alias("build_type"),
                   F.when(F.col("line") == 1, (F.col("odd") + 1).cast("int")).alias("beta_number"))
    from crashlake.functions.versions import build_date
    new = new.where(build_date(F.col("build_id")) > F.date_sub(F.lit(TODAY).cast("date"), 30))
    stored = new.where((F.col("build_type") == "Beta") & (F.col("build_id") % 2000000 == 0))
    channels = c.t("release_channels").where("release_channel <> 'Nightly'")
    return dims.append_releases(new, stored, c.t("products"), channels, TODAY)


@query("l11_version_order", """SELECT product_version_id, row_number() OVER (PARTITION BY product_name ORDER BY version_sort, version_string, product_version_id) AS sort_key
FROM product_versions""")
def _(c: Context):
    return dims.version_order(c.pv).select("product_version_id", F.col("sort_key").cast("bigint").alias("sort_key"))


@query("g8_product_adu", "SELECT * FROM product_adu", text=("adu_date",))
def _(c: Context):
    return c.product_adu


@query("g9_build_adu", "SELECT * FROM build_adu", text=("adu_date", "build_date"))
def _(c: Context):
    return c.build_adu


@query("g10_tcbs", "SELECT * FROM tcbs", text=("report_date",))
def _(c: Context):
    return c.tcbs


@query("g11_tcbs_build", """
SELECT signature, bdate AS build_date, report_date,
 CASE WHEN release_channel = 'Beta' THEN rapid_beta_id ELSE product_version_id END AS product_version_id, process_type, release_channel,
 count(*) AS report_count, count(*) FILTER (os_name = 'Windows') AS win_count, count(*) FILTER (os_name = 'Mac OS X') AS mac_count,
 count(*) FILTER (os_name = 'Linux') AS lin_count, count(hang_id) AS hang_count, count(*) FILTER (uptime < 60) AS startup_count
FROM clean JOIN product_versions USING (product_version_id)
WHERE report_date BETWEEN build_date AND sunset_date AND report_date <= bdate + 6
 AND ((release_channel = 'Beta' AND rapid_beta_id IS NOT NULL) OR (release_channel = 'Aurora' AND version_string LIKE '%a2') OR (release_channel = 'Nightly' AND version_string LIKE '%a1'))
GROUP BY ALL""", text=("report_date", "build_date"))
def _(c: Context):
    return topcrash.tcbs_build(c.clean, c.pv)


@query("g12_tcbs_ranking", """
WITH lv AS (
 SELECT report_date, product_version_id, signature, NULL AS process_type, NULL AS release_channel, 'All' AS aggregation_level, sum(report_count) AS n FROM tcbs GROUP BY ALL
 UNION ALL SELECT report_date, product_version_id, signature, process_type, NULL, 'process_type', sum(report_count) FROM tcbs GROUP BY ALL
 UNION ALL SELECT report_date, product_version_id, signature, NULL, release_channel, 'release_channel', sum(report_count) FROM tcbs GROUP BY ALL
 UNION ALL SELECT report_date, product_version_id, signature, process_type, release_channel, 'process_type and release_channel', sum(report_count) FROM tcbs GROUP BY ALL)
SELECT report_date, product_version_id, signature, process_type, release_channel, aggregation_level, CAST(n AS BIGINT) AS report_count,
 CAST(sum(n) OVER (PARTITION BY report_date, aggregation_level) AS BIGINT) AS total_reports,
 CAST(dense_rank() OVER (PARTITION BY report_date, aggregation_level ORDER BY n DESC) AS INT) AS rank_report_count FROM lv""", text=("report_date",))
def _(c: Context):
    return topcrash.tcbs_ranking(c.tcbs)


@query("g13_rank_compare", """
SELECT report_date, product_version_id, signature, 1 AS rank_days, n AS report_count, CAST(sum(n) OVER w AS BIGINT) AS total_reports,
 CAST(dense_rank() OVER (PARTITION BY report_date, product_version_id ORDER BY n DESC) AS INT) AS rank_report_count,
 round(CAST(n AS DOUBLE) / CAST(sum(n) OVER w AS DOUBLE), 5) AS percent_of_total
FROM (SELECT report_date, product_version_id, signature, count(*) AS n FROM clean GROUP BY ALL) AS q
WINDOW w AS (PARTITION BY report_date, product_version_id)""", text=("report_date",))
def _(c: Context):
    return topcrash.rank_compare(c.clean)


@query("g14_crashes_by_user", "SELECT * FROM cbu", text=("report_date",))
def _(c: Context):
    return c.cbu


@query("g15_crashes_by_user_build", "SELECT * FROM cbub", text=("report_date", "build_date"))
def _(c: Context):
    return c.cbub


_HPG = """hpg AS (
 SELECT n.product_version_id, n.report_date, n.report_count, a.adu, round(n.report_count * 100.0e0 / a.adu / ch.throttle, 3) AS crash_hadu, pv.rapid_beta_id
 FROM (SELECT product_version_id, report_date, count(*) AS report_count FROM kinded WHERE include_agg GROUP BY ALL) AS n
 JOIN (SELECT product_version_id, adu_date AS report_date, CAST(sum(adu_count) AS BIGINT) AS adu FROM product_adu GROUP BY ALL) AS a USING (product_version_id, report_date)
 JOIN product_versions AS pv USING (product_version_id) JOIN channels AS ch ON ch.product_name = pv.product_name AND ch.release_channel = pv.build_type
 WHERE n.report_date BETWEEN pv.build_date AND pv.sunset_date),
graph AS (SELECT product_version_id, report_date, report_count, adu, crash_hadu FROM hpg UNION ALL
 SELECT rapid_beta_id, report_date, CAST(sum(report_count) AS BIGINT), CAST(sum(adu) AS BIGINT), round(sum(report_count) * 100.0e0 / sum(adu), 3)
 FROM hpg WHERE rapid_beta_id IS NOT NULL GROUP BY rapid_beta_id, report_date)
"""


@query("g16_home_page_graph", "WITH " + _HPG + "SELECT * FROM graph", text=("report_date",))
def _(c: Context):
    return c.graph


_HPGB = """graphb AS (
 SELECT n.product_version_id, n.build_date, n.report_date, n.report_count, a.adu FROM (
  SELECT CASE WHEN k.release_channel = 'Beta' THEN pv.rapid_beta_id ELSE k.product_version_id END AS product_version_id, k.bdate AS build_date, k.report_date, count(*) AS report_count
  FROM kinded AS k JOIN product_versions AS pv USING (product_version_id)
  WHERE include_agg AND k.bdate >= k.report_date - 6 AND k.report_date BETWEEN pv.build_date AND pv.sunset_date AND k.release_channel IN ('Nightly', 'Aurora', 'Beta') GROUP BY ALL) AS n
 JOIN (SELECT product_version_id, build_date, adu_date AS report_date, CAST(sum(adu_count) AS BIGINT) AS adu FROM build_adu GROUP BY ALL) AS a
 USING (product_version_id, build_date, report_date))
"""


@query("g17_home_page_graph_build", "WITH " + _HPGB + "SELECT * FROM graphb", text=("report_date", "build_date"))
def _(c: Context):
    return c.graph_build


_CODE = """CASE WHEN lower(process_type) = 'content' THEN 'T' WHEN lower(process_type) = 'plugin' THEN CASE WHEN hang_id IS NULL THEN 'P' ELSE 'p' END
 ELSE CASE WHEN hang_id IS NULL THEN 'C' ELSE 'c' END END"""


@query("g18_daily_crashes", f"""
WITH live AS (SELECT c.*, concat(upper(substr(os_short_name, 1, 1)), substr(os_short_name, 2)) AS osn FROM clean AS c
 JOIN product_versions AS pv USING (product_version_id) JOIN os_names USING (os_name) WHERE report_date BETWEEN build_date AND sunset_date)
SELECT count(*) AS "count", {_CODE} AS report_type, product_version_id, osn AS os_short_name, report_date AS adu_day FROM live GROUP BY ALL
UNION ALL SELECT count(DISTINCT hang_id), 'H', product_version_id, osn, report_date FROM live GROUP BY product_version_id, osn, report_date""", text=("adu_day",))
def _(c: Context):
    return graphs.daily_crashes(c.clean, c.pv, c.t("os_names"))


@query("g18_daily_crashes_old", f"""
WITH r AS (SELECT *, substr(os_name, 1, 3) AS osn FROM reports WHERE lower(substr(os_name, 1, 3)) IN ('win', 'lin', 'mac')
 AND product = 'Atlas' AND version IN ('1.0', '2.0') AND report_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20')
SELECT count(*) AS "count", {_CODE} AS report_type, CAST(substr(version, 1, 1) AS INT) AS product_version_id, osn AS os_short_name, report_date AS adu_day FROM r GROUP BY ALL
UNION ALL SELECT count(DISTINCT hang_id), 'H', CAST(substr(version, 1, 1) AS INT), osn, report_date FROM r WHERE hang_id IS NOT NULL GROUP BY ALL""", text=("adu_day",))
def _(c: Context):
    p = c.spark.createDataFrame([(1, "Atlas", "1.0"), (2, "Atlas", "2.0"), (3, "Atlas", "3.0")],
                                "id int, product string, version string")
    v = c.spark.sql("""SELECT * FROM VALUES (1, false, DATE '2024-01-03', DATE '2024-01-20'),
      (2, false, DATE '2024-01-03', DATE '2024-01-20'), (3, true, DATE '2024-01-03', DATE '2024-01-20')
      AS t(productdims_id, ignore, start_date, end_date)""")
    return graphs.daily_crashes_old(c.t("reports"), p, v)


_NIGHTLY = """nb AS (SELECT product_version_id, bdate AS build_date, report_date, CAST(report_date - bdate AS INT) AS days_out, count(*) AS report_count
 FROM clean JOIN product_versions AS pv USING (product_version_id) JOIN product_version_builds AS b USING (product_version_id)
 WHERE clean.build = b.build_id AND release_channel IN ('Nightly', 'Aurora') AND report_date - bdate <= 14 AND report_date BETWEEN pv.build_date AND pv.sunset_date GROUP BY ALL)
"""


@query("g19_nightly_builds", "WITH " + _NIGHTLY + "SELECT * FROM nb", text=("report_date", "build_date"))
def _(c: Context):
    return c.nightly


_HANGS = """uinfo AS (SELECT uuid, report_date, url FROM clean WHERE email <> '' OR user_comments <> '' OR url <> '' OR app_notes <> ''),
hangs AS (SELECT min(b.uuid) AS uuid, p.uuid AS plugin_uuid, p.report_date, min(b.product_version_id) AS product_version_id, min(b.signature) AS browser_signature,
 p.signature AS plugin_signature, p.hang_id, p.flash_version, min(i.url) AS url
 FROM clean AS b JOIN clean AS p ON p.hang_id = b.hang_id JOIN uinfo AS i ON b.uuid = i.uuid
 WHERE b.signature LIKE 'hang | %' AND b.hang_id <> '' AND b.process_type = 'browser' AND p.process_type = 'plugin'
 AND b.date_processed > p.report_date - INTERVAL 1 DAY AND b.date_processed < p.report_date + INTERVAL 2 DAY AND i.report_date = p.report_date
 GROUP BY p.uuid, p.report_date, p.signature, p.hang_id, p.flash_version)
"""


@query("g20_daily_hangs", "WITH " + _HANGS + "SELECT * FROM hangs", text=("report_date",))
def _(c: Context):
    return c.hang_rows.drop("duplicates")


@query("h6_hang_report", "WITH " + _HANGS + """SELECT pv.product_name AS product, pv.version_string AS version, browser_signature, plugin_signature,
 hang_id AS browser_hangid, flash_version, url, uuid, report_date AS report_day, plugin_uuid FROM hangs JOIN product_versions AS pv USING (product_version_id)""", text=("report_day",))
def _(c: Context):
    return hangs.hang_report(c.hang_rows, c.pv).drop("duplicates")


_R = [f"r{i}" for i in range(10)]
_EXPL = """rates AS (SELECT t.product_version_id, t.signature, t.report_date, CAST(t.n AS DOUBLE) * 1e6 / a.n AS rate, 30 * 1e6 / a.n AS dv
 FROM (SELECT product_version_id, signature, report_date, sum(report_count) AS n FROM tcbs GROUP BY ALL) AS t
 JOIN (SELECT product_version_id, adu_date, CAST(sum(adu_count) AS DOUBLE) AS n FROM product_adu WHERE adu_count > 0 GROUP BY ALL) AS a
 ON a.product_version_id = t.product_version_id AND a.adu_date = t.report_date),
ends AS (SELECT unnest(generate_series(DATE '2024-01-10', DATE '2024-01-30', INTERVAL 1 DAY))::DATE AS last_date),
wide AS (SELECT e.last_date, r.product_version_id, r.signature, """ + ", ".join(
    f"coalesce(sum(rate) FILTER (e.last_date - r.report_date = {i}), 0) AS r{i}" for i in range(10)) + ", " + ", ".join(
    f"coalesce(sum(dv) FILTER (e.last_date - r.report_date = {i}), 0) AS m{i}" for i in range(3)) + """
 FROM rates AS r JOIN ends AS e ON r.report_date BETWEEN e.last_date - 9 AND e.last_date GROUP BY ALL),
stat AS (SELECT *, (""" + "+".join(_R[1:]) + ")/9 AS avg9, greatest(" + ",".join(_R[1:]) + ") AS max9, (r0+r1+r2)/3 AS avg3, (m0+m1+m2)/3 AS div3, (" + "+".join(_R[3:]) + ")/7 AS avg7 FROM wide)"
_EXPL_SEL = """SELECT last_date, product_version_id, signature,
 CASE WHEN r0 > 10 THEN round((r0 - avg9) / greatest(max9 - avg9, m0), 2) END AS oneday,
 CASE WHEN avg3 > 10 THEN round((avg3 - avg7) / greatest(sqrt((""" + "+".join(
    f"({r}-avg7)*({r}-avg7)" for r in _R[3:]) + ")/6), div3), 2) END AS threeday, " + ", ".join(
    f"round({r}, 2) AS day{i}" for i, r in enumerate(_R)) + " FROM stat WHERE r0 > 10 OR avg3 > 10"


@query("g21_explosiveness", "WITH " + _EXPL + "\n" + _EXPL_SEL, text=("last_date",))
def _(c: Context):
    return explosive.explosiveness(c.tcbs, c.product_adu, "2024-01-10", "2024-01-30")


@query("g22_correlations", """SELECT report_date, product_version_id, os_name, reason, signature, count(*) AS crash_count
FROM clean JOIN product_versions USING (product_version_id) WHERE report_date BETWEEN build_date AND sunset_date GROUP BY ALL""", text=("report_date",))
def _(c: Context):
    return correlations.correlations(c.clean, c.pv)


_ADDONS = """addons AS (SELECT uuid, concat('addon', CAST(k % 5 AS STRING)) AS addon_key, concat('1.', CAST(k % 3 AS STRING)) AS addon_version FROM reports WHERE k % 4 <> 0
 UNION ALL SELECT uuid, 'common', '2.0' FROM reports WHERE k % 3 <> 1)
"""


def _addons(c: Context):
    r = c.t("reports")
    k = F.col("k")
    one = r.where(k % 4 != 0).select("uuid", F.concat(F.lit("addon"), (k % 5).cast("string")).alias("addon_key"),
                                     F.concat(F.lit("1."), (k % 3).cast("string")).alias("addon_version"))
    two = r.where(k % 3 != 1).select("uuid", F.lit("common").alias("addon_key"), F.lit("2.0").alias("addon_version"))
    return one.unionByName(two)


@query("g22_correlation_addons", "WITH " + _ADDONS + """SELECT report_date, product_version_id, os_name, reason, signature, addon_key, addon_version, count(*) AS crash_count
FROM clean JOIN product_versions USING (product_version_id) JOIN addons USING (uuid) WHERE report_date BETWEEN build_date AND sunset_date GROUP BY ALL""", text=("report_date",))
def _(c: Context):
    return correlations.correlation_addons(c.clean, c.pv, _addons(c))


@query("g22_correlation_cores", """SELECT report_date, product_version_id, os_name, reason, signature, architecture, cores, count(*) AS crash_count
FROM clean JOIN product_versions USING (product_version_id) WHERE report_date BETWEEN build_date AND sunset_date AND architecture <> '' AND cores >= 0 GROUP BY ALL""", text=("report_date",))
def _(c: Context):
    return correlations.correlation_cores(c.clean, c.pv)


def _share_sql(items: str, cols: str) -> str:
    return f"""SELECT s.product_version_id, s.signature, {', '.join('s.' + x for x in cols.split(', '))}, s.signature_count, t.signature_total, a.overall_count, o.overall_total,
 round(s.signature_count / t.signature_total, 5) AS signature_share, round(a.overall_count / o.overall_total, 5) AS overall_share,
 round(s.signature_count / t.signature_total - a.overall_count / o.overall_total, 5) AS difference
FROM (SELECT product_version_id, signature, {cols}, count(*) AS signature_count FROM base JOIN {items} USING (uuid) GROUP BY ALL) AS s
JOIN (SELECT product_version_id, signature, count(*) AS signature_total FROM base GROUP BY ALL) AS t USING (product_version_id, signature)
JOIN (SELECT product_version_id, {cols}, count(*) AS overall_count FROM base JOIN {items} USING (uuid) GROUP BY ALL) AS a USING (product_version_id, {cols})
JOIN (SELECT product_version_id, count(*) AS overall_total FROM base GROUP BY ALL) AS o USING (product_version_id)"""


@query("g23_interesting_addons", "WITH " + _ADDONS + ", base AS (SELECT uuid, product_version_id, signature FROM clean)\n" + _share_sql("addons", "addon_key"))
def _(c: Context):
    return correlations.correlate(c.clean, _addons(c), ["addon_key"], ["product_version_id"])


@query("g23_interesting_addon_versions", "WITH " + _ADDONS + ", base AS (SELECT uuid, product_version_id, signature FROM clean)\n" + _share_sql("addons", "addon_key, addon_version"))
def _(c: Context):
    return correlations.correlate(c.clean, _addons(c), ["addon_key", "addon_version"], ["product_version_id"])


@query("g25_core_counts", """WITH base AS (SELECT uuid, product_version_id, signature FROM clean WHERE architecture <> '' AND cores >= 0),
items AS (SELECT uuid, architecture, cores FROM clean WHERE architecture <> '' AND cores >= 0)
""" + _share_sql("items", "architecture, cores"))
def _(c: Context):
    return correlations.core_counts(c.clean, ["product_version_id"])


_MODULES = """mods AS (SELECT report_date, concat('lib', CAST(k % 30 AS STRING), '.so') AS filename, concat('lib', CAST(k % 30 AS STRING), '.pdb') AS debug_file,
 concat('D', CAST(user_id % 7 AS STRING)) AS debug_id, concat('1.', CAST(k % 4 AS STRING)) AS module_version, product, version, os_name, coalesce(reason, 'Unknown') AS reason FROM reports)
"""


def _modules(c: Context):
    r, k = c.t("reports"), F.col("k")
    lib = F.concat(F.lit("lib"), (k % 30).cast("string"))
    return r.select("report_date", F.concat(lib, F.lit(".so")).alias("filename"), F.concat(lib, F.lit(".pdb")).alias("debug_file"),
                    F.concat(F.lit("D"), (F.col("user_id") % 7).cast("string")).alias("debug_id"),
                    F.concat(F.lit("1."), (k % 4).cast("string")).alias("module_version"),
                    "product", "version", "os_name", F.coalesce("reason", F.lit("Unknown")).alias("reason"))


@query("g23_correlation_modules", "WITH " + _MODULES + """SELECT product, version, os_name, reason, filename, module_version, count(*) AS crash_count FROM mods GROUP BY ALL""")
def _(c: Context):
    return correlations.correlation_modules(_modules(c))


@query("g24_module_list", "WITH " + _MODULES + "SELECT DISTINCT report_date, filename, debug_file, debug_id, module_version FROM mods", text=("report_date",))
def _(c: Context):
    return correlations.module_list(_modules(c), ["report_date", "filename", "debug_file", "debug_id", "module_version"])


def _sig_count_sql(col: str, join: str = "") -> str:
    return f"""SELECT report_date, signature, {col}, count(*) AS report_count FROM clean JOIN product_versions USING (product_version_id) {join}
WHERE report_date BETWEEN build_date AND sunset_date GROUP BY ALL"""


@query("g26_uptime_signature_counts", _sig_count_sql("uptime_level", "JOIN uptime_levels ON uptime >= min_uptime AND uptime < max_uptime"), text=("report_date",))
def _(c: Context):
    return counts.signature_counts(c.clean, c.pv, "uptime", levels=c.t("uptime_levels"))


@query("g26_os_signature_counts", _sig_count_sql("os_version_string"), text=("report_date",))
def _(c: Context):
    return counts.signature_counts(c.clean, c.pv, "os")


@query("g26_product_signature_counts", _sig_count_sql("product_version_id"), text=("report_date",))
def _(c: Context):
    return counts.signature_counts(c.clean, c.pv, "product")


@query("g27_top_urls", """SELECT report_date, product, version, regexp_extract(url, '^([^?&=;]*)', 1) AS page, count(*) AS crash_count FROM reports WHERE url IS NOT NULL GROUP BY ALL HAVING count(*) > 1""", text=("report_date",))
def _(c: Context):
    return counts.top_urls(c.t("reports"))


@query("g27_top_domains", """SELECT report_date, product, version, regexp_extract(url, '^[a-z]+://([^/?&=;]+)', 1) AS domain, count(*) AS crash_count FROM reports WHERE url IS NOT NULL GROUP BY ALL HAVING count(*) > 1""", text=("report_date",))
def _(c: Context):
    return counts.top_urls(c.t("reports"), "domain")


_ASSOC = "assoc AS (SELECT DISTINCT concat('sig_', CAST(k % 20 AS STRING)) AS signature, 1000 + k % 40 AS bug_id FROM ev)\n"


def _assoc(c: Context):
    k = F.col("k")
    return c.t("ev").select(
        F.concat(F.lit("sig_"), (k % 20).cast("string")).alias("signature"), (k % 40 + 1000).alias("bug_id")).distinct()


@query("g28_daily_extract", "WITH " + _ASSOC + """, au AS (
 SELECT r.uuid, CAST(sum(a.adu_count) AS BIGINT) AS adu_count FROM reports AS r JOIN raw_adu AS a ON a.adu_date = r.report_date + 1 AND r.product = a.product_name AND r.version = a.product_version
 AND substr(r.os_name, 1, 3) = substr(a.product_os_platform, 1, 3) AND r.os_version LIKE concat('%', a.product_os_version, '%') GROUP BY r.uuid),
bl AS (SELECT signature, string_agg(CAST(bug_id AS STRING), ',' ORDER BY bug_id) AS bug_list FROM assoc GROUP BY signature)
SELECT uuid, coalesce(r.signature, '\\N') AS signature, coalesce(url, '\\N') AS url, concat('https://crashes.example.org/', uuid) AS uuid_url,
 strftime(client_crash_date, '%Y%m%d%H%M') AS client_crash_date, strftime(date_processed, '%Y%m%d%H%M') AS date_processed, coalesce(CAST(last_crash AS STRING), '\\N') AS last_crash,
 product, version, build, '' AS branch, coalesce(os_name, '\\N') AS os_name, CASE WHEN os_name = 'Linux' THEN '3.2.0 i686' ELSE coalesce(os_version, '\\N') END AS os_version,
 concat(cpu_name, ' | ', cpu_info) AS cpu_info, coalesce(address, '\\N') AS address, coalesce(bl.bug_list, '') AS bug_list, coalesce(user_comments, '\\N') AS user_comments,
 CAST(uptime AS STRING) AS uptime_seconds, CASE WHEN email LIKE '%@%' THEN 'yes' ELSE '' END AS email, coalesce(CAST(au.adu_count AS STRING), '\\N') AS adu_count, topmost_filenames,
 CASE WHEN addons_checked IS NULL THEN '[unknown]' WHEN addons_checked THEN 'checked' ELSE 'not' END AS addons_checked, coalesce(flash_version, '\\N') AS flash_version,
 coalesce(hang_id, '\\N') AS hangid, coalesce(reason, '\\N') AS reason, coalesce(process_type, '\\N') AS process_type, coalesce(app_notes, '\\N') AS app_notes, CAST(install_age AS STRING) AS install_age,
 '\\N' AS duplicate_of, release_channel, productid FROM reports AS r LEFT JOIN au USING (uuid) LEFT JOIN bl ON bl.signature = r.signature""".replace("\\\\", "\\"))
def _(c: Context):
    none = c.spark.createDataFrame([], "uuid string, duplicate_of string")
    return extract.daily_extract(c.t("reports"), none, _assoc(c), c.t("raw_adu"),
                                 url_base="https://crashes.example.org/")


@query("c18_adu_by_os_prefix", """SELECT r.product, r.version, r.os_name, r.os_version, CAST(sum(a.adu_count) AS BIGINT) AS adu_count
FROM (SELECT DISTINCT product, version, os_name, os_version FROM reports) AS r JOIN raw_adu AS a ON r.product = a.product_name AND r.version = a.product_version
AND substr(r.os_name, 1, 3) = substr(a.product_os_platform, 1, 3) AND r.os_version LIKE concat('%', a.product_os_version, '%') GROUP BY ALL""")
def _(c: Context):
    return extract.adu_by_os_prefix(c.t("reports"), c.t("raw_adu"))


@query("g33_domain_counts", "SELECT product_version_id, domain, report_date, count(*) AS report_count FROM clean GROUP BY ALL", text=("report_date",))
def _(c: Context):
    return counts.domain_counts(c.clean)


@query("g34_top_signatures", "WITH " + _ASSOC + """SELECT q.*, (SELECT string_agg(CAST(bug_id AS STRING), ',' ORDER BY bug_id) FROM assoc AS a WHERE a.signature = q.signature) AS bugs FROM (
 SELECT signature, count(*) AS report_count, round(avg(uptime), 3) AS mean_uptime FROM reports GROUP BY signature ORDER BY report_count DESC, signature NULLS FIRST LIMIT 500) AS q""")
def _(c: Context):
    top = topcrash.top_signatures(c.t("reports"), "2024-01-30", _assoc(c), days=60)
    return top.select("signature", "report_count", "mean_uptime",
                      F.array_join(F.col("bug_list").cast("array<string>"), ",").alias("bugs"))


# ---- views over marts ------------------------------------------------------------------

_INFO = """info AS (SELECT pv.product_version_id, pv.product_name, pv.version_string, 'new' AS which_table, pv.build_date AS start_date, pv.sunset_date AS end_date, pv.featured_version AS is_featured,
 pv.build_type, round(c.throttle * 100, 2) AS throttle, pv.version_sort, p.sort AS product_sort, rc.sort AS channel_sort, pv.has_builds, pv.is_rapid_beta
 FROM product_versions AS pv JOIN channels AS c ON c.product_name = pv.product_name AND c.release_channel = pv.build_type JOIN products AS p ON p.product_name = pv.product_name
 JOIN release_channels AS rc ON rc.release_channel = pv.build_type)
"""


def _info(c: Context):
    return views.product_info(c.pv, c.t("channels"), c.t("products"), c.t("release_channels"))


@query("h1_product_info", "WITH " + _INFO + "SELECT * FROM info", text=("start_date", "end_date"))
def _(c: Context):
    return _info(c)


@query("h1_product_selector", """SELECT product_name, version_string, 'new' AS which_table, version_sort, has_builds, is_rapid_beta FROM product_versions WHERE DATE '2024-02-01' <= sunset_date""")
def _(c: Context):
    return views.product_selector(c.pv, TODAY)


def _default_sql(where: str) -> str:
    return "WITH " + _INFO + f"""SELECT product_name, version_string, product_version_id FROM (SELECT *, row_number() OVER (PARTITION BY product_name
 ORDER BY (DATE '2024-02-01' BETWEEN start_date AND end_date) DESC, is_featured DESC, channel_sort DESC, version_sort DESC, version_string) AS n FROM info {where}) AS q WHERE n = 1"""


@query("h2_default_versions", _default_sql(""))
def _(c: Context):
    return views.default_versions(_info(c), TODAY)


@query("h2_default_versions_builds", _default_sql("WHERE has_builds"))
def _(c: Context):
    return views.default_versions(_info(c), TODAY, builds_only=True)


_CBUV = """cbuv AS (SELECT u.product_version_id, pv.product_name, pv.version_string, u.os_short_name, o.os_name, u.crash_type, t.crash_type_short, u.report_date, u.report_count,
 u.report_count / c.throttle AS adjusted_report_count, u.adu, c.throttle FROM cbu AS u JOIN product_versions AS pv USING (product_version_id)
 JOIN channels AS c ON c.product_name = pv.product_name AND c.release_channel = pv.build_type JOIN os_names AS o USING (os_short_name) JOIN crash_types AS t USING (crash_type))
"""


def _cbu_view(c: Context):
    return users.crashes_by_user_view(c.cbu, c.pv, c.t("channels"), c.t("os_names"), c.t("crash_types"))


@query("h3_crashes_by_user_view", "WITH " + _CBUV + "SELECT * FROM cbuv", text=("report_date",))
def _(c: Context):
    return _cbu_view(c)


@query("h3_crashes_by_user_build_view", """SELECT u.product_version_id, pv.product_name, pv.version_string, u.os_short_name, o.os_name, u.crash_type, t.crash_type_short, u.build_date,
 CAST(sum(u.report_count) AS BIGINT) AS report_count, sum(u.report_count / c.throttle) AS adjusted_report_count, CAST(sum(u.adu) AS BIGINT) AS adu, c.throttle FROM cbub AS u JOIN product_versions AS pv USING (product_version_id)
 JOIN channels AS c ON c.product_name = pv.product_name AND c.release_channel = pv.build_type JOIN os_names AS o USING (os_short_name) JOIN crash_types AS t USING (crash_type) GROUP BY ALL""", text=("build_date",))
def _(c: Context):
    return users.crashes_by_user_build_view(c.cbub, c.pv, c.t("channels"), c.t("os_names"), c.t("crash_types"))


_ROLL = """roll AS (SELECT product_version_id, report_date, os_short_name, CAST(sum(report_count) AS BIGINT) AS report_count, min(adu) AS adu FROM cbu JOIN crash_types USING (crash_type) WHERE include_agg GROUP BY ALL)
"""


@query("h4_crashes_by_user_rollup", "WITH " + _ROLL + "SELECT * FROM roll", text=("report_date",))
def _(c: Context):
    return users.crashes_by_user_rollup(c.cbu, c.t("crash_types"))


_RATIO = """CAST(sum(r.report_count) AS BIGINT) AS crashes, CAST(sum(r.adu) AS BIGINT) AS adu_count, c.throttle, CAST(round(sum(r.report_count) / c.throttle) AS BIGINT) AS adjusted_crashes,
 CASE WHEN sum(r.adu) = 0 THEN 0 ELSE round(CAST(sum(r.report_count) AS DOUBLE) * 100 / sum(r.adu) / c.throttle, 3) END AS crash_ratio
FROM roll AS r JOIN product_versions AS pv USING (product_version_id) JOIN channels AS c ON c.product_name = pv.product_name AND c.release_channel = pv.build_type"""


@query("h4_product_crash_ratio", "WITH " + _ROLL + "SELECT product_version_id, pv.product_name, pv.version_string, r.report_date AS adu_date, " + _RATIO + " GROUP BY product_version_id, pv.product_name, pv.version_string, r.report_date, c.throttle", text=("adu_date",))
def _(c: Context):
    return users.product_crash_ratio(c.cbu, c.pv, c.t("channels"), c.t("crash_types"))


@query("h4_product_os_crash_ratio", "WITH " + _ROLL + "SELECT product_version_id, pv.product_name, pv.version_string, o.os_short_name, o.os_name, r.report_date AS adu_date, " + _RATIO
       + " JOIN os_names AS o ON o.os_short_name = r.os_short_name GROUP BY product_version_id, pv.product_name, pv.version_string, o.os_short_name, o.os_name, r.report_date, c.throttle", text=("adu_date",))
def _(c: Context):
    return users.product_os_crash_ratio(c.cbu, c.pv, c.t("channels"), c.t("crash_types"), c.t("os_names"))


@query("h5_home_page_graph_view", "WITH " + _HPG + "SELECT g.*, pv.product_name, pv.version_string FROM graph AS g JOIN product_versions AS pv USING (product_version_id)", text=("report_date",))
def _(c: Context):
    return graphs.home_page_graph_view(c.graph, c.pv)


@query("h5_home_page_graph_build_view", "WITH " + _HPGB + """SELECT product_version_id, pv.product_name, pv.version_string, g.build_date, CAST(sum(report_count) AS BIGINT) AS report_count, CAST(sum(adu) AS BIGINT) AS adu,
 CASE WHEN sum(adu) = 0 THEN 0 ELSE round(CAST(sum(report_count) AS DOUBLE) * 100 / sum(adu) / c.throttle, 3) END AS crash_hadu
FROM graphb AS g JOIN product_versions AS pv USING (product_version_id) JOIN channels AS c ON c.product_name = pv.product_name AND c.release_channel = pv.build_type
GROUP BY product_version_id, pv.product_name, pv.version_string, g.build_date, c.throttle""", text=("build_date",))
def _(c: Context):
    return graphs.home_page_graph_build_view(c.graph_build, c.pv, c.t("channels"))


@query("f2_page_count", "WITH " + _HANGS + "SELECT count(*) AS total_count, CAST(floor(count(*) / 50) AS BIGINT) AS total_pages FROM hangs")
def _(c: Context):
    return page_count(c.hang_rows, 50)
