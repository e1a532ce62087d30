"""Registered queries of the sources and sinks that have a plain query form."""

from __future__ import annotations

from pyspark.sql import functions as F

from crashlake.operators.topcrash import COUNT_COLUMNS
from crashlake.plans.checks_text import THROTTLE, _raw
from crashlake.plans.registry import Context, query
from crashlake.sources import exports, feeds, raw, tables


def _stored(c: Context):
    """Raw crashes as stored: by submit day."""
    r = c.t("reports")
    return r.select("uuid", F.create_map(F.lit("Product"), "product").alias("raw"),
                    F.col("date_processed").alias("submitted_timestamp"), F.lit("dump").alias("dump"),
                    F.col("report_date").alias("submit_date"), "k")


@query("a1_ingest_raw", """SELECT event_id, CASE WHEN accepted THEN 0 ELSE 1 END AS legacy_processing, d AS submit_date FROM (
 SELECT *, k % 10 <> 9 AND user_id % 3 = 0 AS p0, k % 9 = 0 OR k % 3 <> 2 OR CASE WHEN k % 10 = 9 THEN false WHEN user_id % 3 = 0 THEN user_id % 100 < 10 WHEN user_id % 3 = 1 THEN user_id % 100 < 50 ELSE false END AS accepted FROM ev) AS q
WHERE NOT (NOT accepted AND p0 AND (k % 20 > 10 OR (k % 20 = 10 AND user_id % 10 >= 5)))""", text=("submit_date",))
def _(c: Context):
    forms = _raw(c).withColumnsRenamed({"raw": "form", "submitted_timestamp": "received"}).withColumn("dump", F.lit(""))
    out = raw.ingest_raw(forms, THROTTLE, {"Product0": "10.5"}, never_discard=False, bucket=F.col("user_id") % 100)
    return out.select("event_id", "legacy_processing", "submit_date")


@query("a2_weekly_partitions", "SELECT date_trunc('week', date_processed) AS week, count(*) AS n FROM reports GROUP BY ALL", text=("week",))
def _(c: Context):
    df = c.t("reports").groupBy(F.date_trunc("week", "date_processed").alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return df.withColumn("week", F.date_format("week", "yyyy-MM-dd HH:mm:ss"))


@query("a3_stored_signatures", """SELECT uuid, CASE WHEN signature IS NULL THEN '##null##' WHEN k % 2 = 0 THEN '##empty##' ELSE signature END AS signature FROM reports""")
def _(c: Context):
    r = c.t("reports").withColumn("signature", F.when((F.col("k") % 2 == 0) & F.col("signature").isNotNull(), F.lit("")).otherwise(F.col("signature")))
    return tables.stored_signature(r).select("uuid", "signature")


@query("a5_release_files", """SELECT DISTINCT lower(product) AS product_name, version, CASE WHEN line = 0 THEN 'linux' ELSE 'win' END AS platform, CAST(build AS BIGINT) AS build_id,
 CASE line WHEN 0 THEN 'Release' WHEN 1 THEN 'Beta' WHEN 2 THEN 'Aurora' ELSE 'Nightly' END AS build_type, CAST(CASE WHEN line = 1 THEN odd + 1 END AS INT) AS beta_number, CASE line WHEN 0 THEN 'release' WHEN 1 THEN 'beta' ELSE 'main-x' END AS repository
FROM (SELECT product, CASE WHEN line = 2 THEN concat(version, 'a2') WHEN line = 3 THEN concat(version, 'a1') ELSE version END AS version, build, line, odd FROM releases) AS r
WHERE line > 1 OR build = (SELECT max(build) FROM releases AS x WHERE x.product = r.product AND x.version = r.version AND x.line = r.line AND (r.line = 0 OR x.odd = r.odd))""")
def _(c: Context):
    line, odd = F.col("line"), F.col("odd")
    stamp = F.concat_ws("-", F.substring("build", 1, 4), F.substring("build", 5, 2), F.substring("build", 7, 2), F.lit("03-00-00-main-x"))
    version = F.when(line == 1, F.concat("version", F.lit("b"), (odd + 1).cast("string"))).when(line == 0, F.col("version"))
    release = F.concat(F.lit("/ftp/"), F.lower("product"), F.lit("/candidates/"), version, F.lit("-candidates/build"), "build",
                       F.lit("/"), F.when(line == 0, F.lit("linux")).otherwise(F.lit("win")), F.lit("_info.txt"))
    night = F.concat(F.lit("/ftp/"), F.lower("product"), F.lit("/nightly/"), F.substring("build", 1, 4), F.lit("/"), F.substring("build", 5, 2), F.lit("/"), stamp,
                     F.lit("/app-"), "version", F.when(line == 2, F.lit("a2")).otherwise(F.lit("a1")), F.lit(".en-US.win.txt"))
    files = c.t("releases").select(
        F.when(line < 2, release).otherwise(night).alias("path"),
        F.when(line < 2, F.concat(F.lit("x=1\nbuildID="), "build", F.lit("\nrev=abc\n"))).otherwise(F.concat("build", F.lit("\nrev\n"))).alias("value")).distinct()
    return feeds.parse_info_files(files).distinct()


@query("a11_recent_days", """SELECT uuid, report_date AS day FROM reports WHERE report_date IN (SELECT DISTINCT report_date FROM reports ORDER BY report_date DESC LIMIT 40)""", text=("day",))
def _(c: Context):
    return exports.recent_days(c.t("reports"), 40).select("uuid", "day")


@query("a12_sample_crashes", "SELECT uuid FROM reports ORDER BY md5(concat('7|', uuid)), uuid LIMIT 200")
def _(c: Context):
    return raw.sample_crashes(_stored(c), 200, seed=7).select("uuid")


@query("a12_sample_by_day", """SELECT report_date AS submit_date, uuid FROM reports
QUALIFY row_number() OVER (PARTITION BY report_date ORDER BY md5(concat('7|', uuid)), uuid) <= 20""", text=("submit_date",))
def _(c: Context):
    return raw.sample_by_day(_stored(c), 20, seed=7).select("submit_date", "uuid")


@query("a13_scan_date", """SELECT uuid FROM reports WHERE report_date BETWEEN DATE '2024-01-01' AND DATE '2024-12-31'""")
def _(c: Context):
    return raw.scan_date(_stored(c), "24", ordered=True).select("uuid")


@query("a14_export_for_ids", """SELECT uuid, product FROM reports WHERE k % 10 = 3""")
def _(c: Context):
    ids = c.t("reports").where(F.col("k") % 10 == 3).select("uuid")
    return raw.export_for_ids(_stored(c), ids).select("uuid", F.col("raw")["Product"].alias("product"))


@query("a15_mini_copy", """SELECT 'tcbs' AS tbl, count(*) AS n FROM tcbs WHERE report_date >= DATE '2024-01-15' UNION ALL SELECT 'product_adu', count(*) FROM product_adu WHERE adu_date >= DATE '2024-01-15'
UNION ALL SELECT 'product_versions', count(*) FROM product_versions UNION ALL SELECT 'reports_bad', CAST(0 AS BIGINT)""")
def _(c: Context):
    cut = tables.mini_copy({"tcbs": c.tcbs, "product_adu": c.product_adu, "product_versions": c.pv,
                            "reports_bad": c.cleaned.bad}, "2024-01-15")
    out = None
    for name, df in cut.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        out = part if out is None else out.unionByName(part)
    return out


@query("a16_retention", "SELECT uuid FROM reports WHERE report_date >= DATE '2024-01-04'")
def _(c: Context):
    return tables.keep_recent(c.t("reports"), "2024-01-04", "report_date").select("uuid")


# every document becomes a line of JSON; those in one language are cut short and cannot be read
@query("a17_bad_json", """SELECT doc_id, CASE WHEN lang = 'en' THEN text END AS text FROM documents""")
def _(c: Context):
    full = F.to_json(F.struct("text", "lang"))
    line = F.when(F.col("lang") == "en", full).otherwise(F.concat(F.lit("{"), full))
    return c.t("documents").select("doc_id", raw.parse_json(line)["text"].alias("text"))


@query("a19_get_crash", """SELECT uuid, product FROM reports WHERE uuid = (SELECT max(uuid) FROM reports)""")
def _(c: Context):
    last = c.t("reports").agg(F.max("uuid").alias("u")).first()["u"]
    return raw.get_crash(_stored(c), last, "meta").select("uuid", F.col("raw")["Product"].alias("product"))


@query("tcbs_totals", "SELECT report_date, " + ", ".join(f"CAST(sum({x}) AS BIGINT) AS {x}" for x in COUNT_COLUMNS) + " FROM tcbs GROUP BY report_date", text=("report_date",))
def _(c: Context):
    return c.tcbs.groupBy("report_date").agg(*[F.sum(x).alias(x) for x in COUNT_COLUMNS])
