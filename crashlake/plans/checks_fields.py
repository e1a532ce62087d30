"""Registered queries of the scalar functions, over every event or page."""

from __future__ import annotations


from pyspark.sql import functions as F

from crashlake.functions import metrics as M, platforms as P, text as X, times as T, versions as V
from crashlake.operators.counts import uptime_level
from crashlake.operators.intervals import interval_join
from crashlake.operators.patterns import ilike_join
from crashlake.plans.registry import Context, query

# one version text per event: plain, a1, a2, bN, esr, or a milestone
_V = """vers AS (SELECT event_id, k, user_id, k % 30 AS maj, user_id % 10 AS mino, user_id % 4 + 1 AS bn, k % 6 AS kind,
 concat(CAST(k % 30 AS STRING), '.', CAST(user_id % 10 AS STRING), CASE k % 6 WHEN 0 THEN '' WHEN 1 THEN 'a1' WHEN 2 THEN 'a2'
  WHEN 3 THEN concat('b', CAST(user_id % 4 + 1 AS STRING)) WHEN 4 THEN 'esr' ELSE '.2pre' END) AS v,
 CASE k % 5 WHEN 0 THEN 'release' WHEN 1 THEN 'Beta' WHEN 2 THEN 'aurora' WHEN 3 THEN 'nightly' ELSE 'ESR' END AS ch FROM ev)
"""


def _vers(c: Context):
    k, u = F.col("k"), F.col("user_id")
    tail = (F.when(k % 6 == 0, F.lit("")).when(k % 6 == 1, F.lit("a1")).when(k % 6 == 2, F.lit("a2"))
            .when(k % 6 == 3, F.concat(F.lit("b"), (u % 4 + 1).cast("string")))
            .when(k % 6 == 4, F.lit("esr")).otherwise(F.lit(".2pre")))
    ch = (F.when(k % 5 == 0, F.lit("release")).when(k % 5 == 1, F.lit("Beta"))
          .when(k % 5 == 2, F.lit("aurora")).when(k % 5 == 3, F.lit("nightly")).otherwise(F.lit("ESR")))
    return c.t("ev").select(
        "event_id", "k", "user_id",
        F.concat((k % 30).cast("string"), F.lit("."), (u % 10).cast("string"), tail).alias("v"),
        ch.alias("ch"), (u % 4 + 1).cast("int").alias("bn"))


@query("b1_clean_nulls", """SELECT uuid, coalesce(signature, '') AS signature, coalesce(reason, 'Unknown') AS reason, coalesce(address, 'Unknown') AS address,
 coalesce(flash_version, 'Unknown') AS flash_version, coalesce(os_name, 'Unknown') AS os_name, coalesce(process_type, 'Browser') AS process_type,
 CASE WHEN url IS NULL THEN '' ELSE regexp_extract(url, '^(http://[a-z0-9.]+)', 1) END AS domain FROM reports""")
def _(c: Context):
    return X.clean_nulls(c.t("reports")).select("uuid", "signature", "reason", "address", "flash_version",
                                               "os_name", "process_type", "domain")


@query("b2_in_range", """SELECT uuid FROM reports WHERE date_processed >= TIMESTAMP '2024-01-01' AND date_processed < TIMESTAMP '2024-01-30 12:00:00' AND completed_datetime IS NOT NULL""")
def _(c: Context):
    from crashlake.operators.processing import finished_reports
    return finished_reports(c.t("reports"), "2024-01-01", "2024-01-30 12:00:00").select("uuid")


@query("b3_b19_linux_versions", """SELECT uuid, CASE WHEN os_name = 'Linux' THEN '3.2.0 i686' ELSE os_version END AS stripped,
 CASE WHEN os_name = 'Linux' THEN CASE k % 4 WHEN 0 THEN '3.2.0 i686' WHEN 1 THEN '2.6.35 ?arch?' WHEN 2 THEN '' ELSE '3.0.1 x86_64' END ELSE os_version END AS tidy FROM reports""")
def _(c: Context):
    r = c.t("reports")
    text = (F.when(~F.col("os_name").eqNullSafe("Linux"), F.col("os_version"))
            .when(F.col("k") % 4 == 0, F.col("os_version"))
            .when(F.col("k") % 4 == 1, F.lit("0.0.0 linux 2.6.35-22-generic"))
            .when(F.col("k") % 4 == 2, F.lit("unknown"))
            .when(F.col("k") % 4 == 3, F.lit("0.0.0 Linux 3.0.1 SMP x86_64 GNU")))
    return r.select("uuid", P.strip_linux_version(F.col("os_name"), F.col("os_version")).alias("stripped"),
                    P.linux_version(F.col("os_name"), text).alias("tidy"))


@query("b4_fix_channel", "WITH " + _V + """SELECT event_id, CASE WHEN user_id % 2 = 0 AND v LIKE '2.1%' THEN CASE WHEN v LIKE '%pre%' THEN 'beta' ELSE 'release' END ELSE ch END AS channel FROM vers""")
def _(c: Context):
    product = F.when(F.col("user_id") % 2 == 0, F.lit("OLDIE")).otherwise(F.lit("other"))
    return _vers(c).select("event_id", P.fix_channel(product, F.col("v"), F.col("ch"), "oldie").alias("channel"))


@query("b5_ilike_map", """SELECT uuid, CASE WHEN os_name LIKE 'Windows%' THEN 'Windows' WHEN os_name LIKE 'Mac%' THEN 'Mac OS X' WHEN os_name LIKE 'Linux%' THEN 'Linux' ELSE 'Unknown' END AS os,
 CASE WHEN release_channel LIKE 'nightly%' THEN 'Nightly' WHEN release_channel = 'custom' THEN NULL ELSE concat(upper(substr(release_channel, 1, 1)), substr(release_channel, 2)) END AS channel FROM reports""")
def _(c: Context):
    r = P.ilike_map(c.t("reports"), c.tables.small("os_matches"), "os_name", "os_name", "os")
    r = P.ilike_map(r, c.tables.small("channel_matches"), "release_channel", "release_channel", "channel")
    return r.select("uuid", P.default_unknown(F.col("os")).alias("os"), "channel")


@query("b6_b7_os_versions", """SELECT event_id, mj AS major, mn AS minor, CASE user_id % 3 WHEN 0 THEN CASE concat(CAST(mj AS STRING), '.', CAST(mn AS STRING)) WHEN '3.5' THEN 'Windows NT' WHEN '4.0' THEN 'Windows NT'
  WHEN '4.1' THEN 'Windows 98' WHEN '4.9' THEN 'Windows Me' WHEN '5.0' THEN 'Windows 2000' WHEN '5.1' THEN 'Windows XP' WHEN '6.0' THEN 'Windows Vista' WHEN '6.1' THEN 'Windows 7' ELSE 'Windows Unknown' END
 WHEN 1 THEN CASE WHEN mj BETWEEN 10 AND 11 AND mn BETWEEN 0 AND 20 THEN concat('OS X ', CAST(mj AS STRING), '.', CAST(mn AS STRING)) ELSE 'OS X Unknown' END ELSE 'Linux' END AS label
FROM (SELECT event_id, user_id, CAST(CASE WHEN k % 9 = 7 THEN 0 WHEN k % 9 = 8 THEN 0 ELSE k % 13 END AS INT) AS mj,
 CAST(CASE WHEN k % 9 IN (6, 7, 8) THEN 0 ELSE user_id % 25 END AS INT) AS mn FROM ev) AS q""")
def _(c: Context):
    k, u = F.col("k"), F.col("user_id")
    base = F.concat((k % 13).cast("string"), F.lit("."), (u % 25).cast("string"), F.lit(".77 x"))
    text = (F.when(k % 9 == 6, F.concat((k % 13).cast("string"), F.lit(".1234")))
            .when(k % 9 == 7, F.lit("1000.2")).when(k % 9 == 8, F.lit("none")).otherwise(base))
    name = F.when(u % 3 == 0, F.lit("Windows")).when(u % 3 == 1, F.lit("Mac OS X")).otherwise(F.lit("Linux"))
    from crashlake.schemas import WINDOWS_VERSIONS
    df = c.t("ev").select("event_id", name.alias("n"), P.os_version_parts(text).alias("p"))
    return df.select("event_id", "p.major", "p.minor",
                     P.os_version_string(F.col("n"), F.col("p.major"), F.col("p.minor"), list(WINDOWS_VERSIONS)).alias("label"))


@query("b8_get_cores", """SELECT uuid, CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(k % 4 + 1 AS INT) END AS cores FROM reports""")
def _(c: Context):
    return c.t("reports").select("uuid", X.get_cores(F.col("cpu_info")).alias("cores"))


@query("b9_url2domain", r"""SELECT page_id, CASE WHEN regexp_matches(url, '^[a-zA-Z0-9_:]+:/+([a-zA-Z0-9_]+[.])*[a-zA-Z0-9_]+') THEN regexp_extract(url, '^([a-zA-Z0-9_:]+:/+([a-zA-Z0-9_]+[.])*[a-zA-Z0-9_]+)', 1) END AS domain FROM pages""")
def _(c: Context):
    return c.t("pages").select("page_id", X.url2domain(F.col("url")).alias("domain"))


@query("b10_url_parts", """SELECT page_id, regexp_extract(url, '^([^?&=;]*)', 1) AS page, regexp_extract(url, '^[a-z]+://([^/?&=;]+)', 1) AS host, regexp_extract(url, '^([a-z]+)://', 1) AS protocol
FROM pages WHERE regexp_matches(url, '^[a-z]+://[^/?&=;]+')""")
def _(c: Context):
    df = c.t("pages").select("page_id", X.url_parts(F.col("url")).alias("u"))
    return df.where("u IS NOT NULL").select("page_id", "u.page", "u.host", "u.protocol")


@query("b11_b12_builds", """SELECT uuid, CASE WHEN build <> 'local' THEN CAST(build AS BIGINT) END AS build_id,
 CASE WHEN build <> 'local' THEN report_date - CAST(k % 10 AS INT) END AS build_day,
 CASE WHEN build <> 'local' THEN report_date - CAST(k % 10 AS INT) + CASE WHEN release_channel = 'release' THEN 126 ELSE 63 END END AS sunset FROM reports""", text=("build_day", "sunset"))
def _(c: Context):
    return c.t("reports").select("uuid", V.build_numeric(F.col("build")).alias("build_id"),
                                 V.build_date(F.col("build")).alias("build_day"),
                                 V.sunset_date(F.col("build"), F.col("release_channel")).alias("sunset"))


@query("b13_major_version", "WITH " + _V + """SELECT event_id, concat(CAST(maj AS STRING), '.', CAST(mino AS STRING)) AS major, concat(CAST(maj AS STRING), '.', CAST(mino AS STRING)) AS to_major FROM vers""")
def _(c: Context):
    return _vers(c).select("event_id", V.major_version(F.col("v")).alias("major"),
                           V.to_major_version(F.col("v")).alias("to_major"))


@query("b14_version_sort", "WITH " + _V + """SELECT event_id, concat(lpad(CAST(maj AS STRING), 3, '0'), lpad(CAST(mino AS STRING), 3, '0')) AS major_sort,
 concat(p, CASE kind WHEN 0 THEN 'r000' WHEN 1 THEN 'a001' WHEN 2 THEN 'a002' WHEN 3 THEN concat('b00', CAST(bn AS STRING)) WHEN 4 THEN 'x000' ELSE 'pre000' END) AS plain,
 concat(p, CASE ch WHEN 'release' THEN 'r000' WHEN 'aurora' THEN 'a002' WHEN 'nightly' THEN 'a001' WHEN 'ESR' THEN 'x000'
  ELSE CASE kind WHEN 1 THEN 'b001' WHEN 2 THEN 'b002' WHEN 3 THEN concat('b00', CAST(bn AS STRING)) ELSE 'b099' END END) AS by_channel,
 concat(p, 'b00', CAST(bn AS STRING)) AS by_beta,
 concat(lpad(CAST(maj AS STRING), 3, '0'), lpad(CAST(mino AS STRING), 3, '0'), CASE WHEN kind = 5 THEN '002' ELSE '000' END, CASE WHEN kind IN (1, 2, 3, 4, 5) THEN 'b' ELSE 'z' END, '000') AS old
FROM (SELECT *, concat(lpad(CAST(maj AS STRING), 3, '0'), lpad(CAST(mino AS STRING), 3, '0'), CASE WHEN kind = 5 THEN '002' ELSE '000' END) AS p FROM vers) AS q""")
def _(c: Context):
    v = F.col("v")
    return _vers(c).select(
        "event_id", V.major_version_sort(v).alias("major_sort"), V.version_sort(v).alias("plain"),
        V.version_sort(v, channel=F.col("ch")).alias("by_channel"),
        V.version_sort(v, F.col("bn")).alias("by_beta"), V.old_version_sort(v).alias("old"))


@query("b15_version_string", "WITH " + _V + """SELECT event_id, CASE WHEN bn <> 1 THEN concat(v, 'b', CAST(bn - 1 AS STRING)) ELSE v END AS s2,
 CASE WHEN bn <> 1 THEN concat(v, 'b', CAST(bn - 1 AS STRING)) WHEN ch = 'nightly' THEN concat(v, 'a1') WHEN ch = 'aurora' THEN concat(v, 'a2') ELSE v END AS s3 FROM vers""")
def _(c: Context):
    b = F.col("bn") - 1
    return _vers(c).select("event_id", V.version_string(F.col("v"), b).alias("s2"),
                           V.version_string(F.col("v"), b, F.col("ch")).alias("s3"))


@query("b16_channel_tests", "WITH " + _V + """SELECT event_id, CASE WHEN kind = 1 THEN ch = 'nightly' WHEN kind = 2 THEN ch = 'aurora' WHEN kind = 4 THEN ch IN ('release', 'ESR') ELSE ch IN ('Beta', 'release') END AS fits,
 CASE kind WHEN 1 THEN 'nightly' WHEN 2 THEN 'aurora' ELSE 'ERROR' END AS suffix, ch = 'Beta' AND (maj > 12 OR (maj = 12 AND mino >= 5)) AS rapid FROM vers""")
def _(c: Context):
    v = F.col("v")
    return _vers(c).select("event_id", V.version_matches_channel(v, F.col("ch")).alias("fits"),
                           V.aurora_or_nightly(v).alias("suffix"),
                           V.is_rapid_beta(F.col("ch"), v, F.lit("12.5")).alias("rapid"))


_ROW = "ROW(maj, 'zzzzzz', 0, mino, CASE kind WHEN 1 THEN 'a' WHEN 2 THEN 'a' WHEN 3 THEN 'b' WHEN 4 THEN 'esr' ELSE 'zzzzzz' END, CASE kind WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN bn ELSE 0 END, CASE WHEN kind = 5 THEN 2 ELSE 0 END, CASE WHEN kind = 5 THEN 'pre' ELSE 'zzzzzz' END)"


@query("b17_version_compare", "WITH " + _V + f"""SELECT event_id, CAST(CASE WHEN {_ROW} < ROW(10, 'zzzzzz', 0, 5, 'b', 2, 0, 'zzzzzz') THEN -1 WHEN {_ROW} > ROW(10, 'zzzzzz', 0, 5, 'b', 2, 0, 'zzzzzz') THEN 1 ELSE 0 END AS INT) AS cmp,
 concat_ws('.', CASE WHEN maj = 0 THEN NULL ELSE CAST(maj AS STRING) END,
  nullif(concat(CASE WHEN mino = 0 THEN '' ELSE CAST(mino AS STRING) END, CASE kind WHEN 1 THEN 'a1' WHEN 2 THEN 'a2' WHEN 3 THEN concat('b', CAST(bn AS STRING)) WHEN 4 THEN 'esr' ELSE '' END), ''),
  CASE WHEN kind = 5 THEN '2pre' ELSE NULL END) AS short FROM vers""")
def _(c: Context):
    v = F.col("v")
    return _vers(c).select("event_id", V.version_compare(v, F.lit("10.5b2")).alias("cmp"),
                           V.version_denormalize(V.version_key(v)).alias("short"))


@query("b18_release_class", "WITH " + _V + """SELECT event_id, CASE kind WHEN 0 THEN 'major' WHEN 1 THEN 'development' WHEN 2 THEN 'development' WHEN 3 THEN 'development' WHEN 5 THEN 'milestone' END AS release_class FROM vers""")
def _(c: Context):
    return _vers(c).select("event_id", V.release_class(F.col("v")).alias("release_class"))


@query("b20_b21_codes_and_ratios", """SELECT uuid, CASE WHEN process_type = 'content' THEN 'T' WHEN process_type = 'plugin' THEN CASE WHEN hang_id IS NULL THEN 'P' ELSE 'p' END ELSE CASE WHEN hang_id IS NULL THEN 'C' ELSE 'c' END END AS code,
 CASE WHEN k % 5 = 0 THEN 0.0e0 ELSE round(uptime * 100.0e0 / ((k % 5) * 1000) / 0.1e0, 3) END AS hadu FROM reports""")
def _(c: Context):
    return c.t("reports").select("uuid", M.daily_crash_code(F.col("process_type"), F.col("hang_id")).alias("code"),
                                 M.crash_hadu(F.col("uptime"), F.col("k") % 5 * 1000, F.lit(0.1)).alias("hadu"))


@query("b22_b23_days_and_weeks", """SELECT uuid, date_processed >= TIMESTAMP '2024-01-10' AND date_processed < TIMESTAMP '2024-01-11' AS on_day, date_processed > TIMESTAMP '2024-01-09' AND date_processed < TIMESTAMP '2024-01-12' AS near_day,
 date_processed >= TIMESTAMP '2024-01-05' AND date_processed < TIMESTAMP '2024-01-13' AS alive, date_trunc('week', date_processed) AS week_start, date_trunc('week', date_processed) + INTERVAL 7 DAY AS week_end, date_processed - INTERVAL 8 HOUR AS pacific FROM reports""",
       text=("week_start", "week_end", "pacific"))
def _(c: Context):
    ts = F.col("date_processed")
    day = lambda d: F.lit(d).cast("date")
    weeks = lambda x: F.date_format(x, "yyyy-MM-dd HH:mm:ss")
    return c.t("reports").select(
        "uuid", T.utc_day_is(ts, "2024-01-10").alias("on_day"), T.utc_day_near(ts, "2024-01-10").alias("near_day"),
        T.tstz_between(ts, day("2024-01-05"), day("2024-01-12")).alias("alive"),
        weeks(T.week_begins_utc(ts)).alias("week_start"), weeks(T.week_ends_utc(ts)).alias("week_end"),
        T.local_time(ts).alias("pacific"))


@query("b24_same_time_fuzzy", """SELECT uuid, CASE WHEN last_crash IS NULL THEN true ELSE (epoch_us(date_processed) - epoch_us(client_crash_date)) / 1e6 - (uptime - last_crash) BETWEEN -60 AND 60 END AS same FROM reports""")
def _(c: Context):
    return c.t("reports").select("uuid", T.same_time_fuzzy(
        F.col("client_crash_date"), F.col("date_processed"), F.col("last_crash"), F.col("uptime")).alias("same"))


@query("b25_strings", """SELECT doc_id, trim(lang) <> '' AS some, concat(upper(substr(lang, 1, 1)), substr(lang, 2)) AS cap, concat(upper(substr(text, 1, 1)), substr(text, 2)) AS cap_text FROM documents""")
def _(c: Context):
    return c.t("documents").select("doc_id", X.nonzero_string(F.col("lang")).alias("some"),
                                   X.initcap1(F.col("lang")).alias("cap"), X.initcap1(F.col("text")).alias("cap_text"))


@query("b26_b27_crash_ids", """SELECT uuid, report_date AS day, 2 AS depth, concat(substr(uuid, 1, 29), '3', strftime(client_crash_date, '%y%m%d')) AS fresh,
 CASE WHEN k % 4 = 0 THEN NULL ELSE 4 END AS old_depth FROM reports""", text=("day",))
def _(c: Context):
    r = T.with_ooid(c.t("reports"), "client_crash_date", 3, "fresh", base="uuid")
    odd = F.when(F.col("k") % 4 == 0, F.lit("not an id")).otherwise(F.concat(F.substring("uuid", 1, 29), F.lit("0"), F.substring("uuid", 31, 6)))
    return r.select("uuid", T.ooid_date(F.col("uuid")).alias("day"), T.ooid_depth(F.col("uuid")).alias("depth"),
                    "fresh", T.ooid_depth(odd).alias("old_depth"))


@query("b43_bug_signatures", """SELECT event_id, array_to_string(CASE k % 4 WHEN 0 THEN ['sig_a'] WHEN 1 THEN ['f(int)', 'g'] WHEN 2 THEN [] ELSE ['x | y'] END, ';') AS found FROM ev""")
def _(c: Context):
    k = F.col("k")
    field = (F.when(k % 4 == 0, F.lit("[@ sig_a ] and [@sig_a]")).when(k % 4 == 1, F.lit("[@ f(int) ]\n[@ g]"))
             .when(k % 4 == 3, F.lit("about [@x | y] [@ open")))
    return c.t("ev").select("event_id", F.array_join(X.signatures_in_bug(field), ";").alias("found"))


@query("b44_scrub", "SELECT uuid, product, version, signature FROM reports")
def _(c: Context):
    return X.scrub(c.t("reports").select("uuid", "product", "version", "signature", "url", "email", "user_id"))


@query("b44_bowdlerize", "SELECT uuid, 'URL (removed)' AS url, '' AS email FROM reports")
def _(c: Context):
    return X.bowdlerize(c.t("reports").select("uuid", "url", "email"))


@query("b45_cells", r"""SELECT doc_id, replace(replace(regexp_replace(text, '^[ \t\n\r\f\v]+|[ \t\n\r\f\v]+$', '', 'g'), chr(13), ''), chr(10), ' | ') AS cell, CASE WHEN text LIKE '%@%' THEN 'yes' ELSE '' END AS has_mail, coalesce(CAST(nullif(n_chars % 7, 0) AS STRING), '\N') AS n FROM documents""")
def _(c: Context):
    return c.t("documents").select("doc_id", X.cell(F.col("text")).alias("cell"), X.useful_email(F.col("text")).alias("has_mail"),
                                   X.cell(F.nullif(F.col("n_chars") % 7, F.lit(0))).alias("n"))


@query("b46_case_insensitive", """SELECT doc_id, lower(lang) = 'en' AS is_en, text ILIKE '%the %' AS has_the, regexp_matches(text, '(?i)licen[sc]e') AS licensed, strpos(lower(text), 'error') AS at,
 regexp_replace(text, 'the ', '_ ', 'gi') AS swapped, len(regexp_split_to_array(text, '(?i)and')) AS parts FROM documents""")
def _(c: Context):
    t = F.col("text")
    return c.t("documents").select(
        "doc_id", X.ci_equals(F.col("lang"), F.lit("EN")).alias("is_en"), X.ci_like(t, "%THE %").alias("has_the"),
        X.ci_matches(t, "LICEN[SC]E").alias("licensed"), X.ci_position("ERROR", t).cast("bigint").alias("at"),
        X.ci_replace(t, "THE ", "_ ").alias("swapped"), F.size(X.ci_split(t, "AND")).cast("bigint").alias("parts"))


@query("b48_b49_b50_small_measures", """SELECT event_id, CASE WHEN k % 10 = 9 THEN 'new' WHEN abs(k - 50) < 5 THEN 'static' WHEN k > 50 THEN 'up' ELSE 'down' END AS trend,
 CAST(user_id AS DOUBLE) + user_id * (1 - t) / t AS all_crashes, CASE WHEN k >= user_id AND k >= 40 THEN 'Windows NT' WHEN user_id >= k AND user_id >= 40 THEN 'Mac OS X' ELSE 'Linux' END AS os
FROM (SELECT *, CASE WHEN k % 20 > 0 THEN (k % 20) / 100.0e0 ELSE 1.0e0 END AS t FROM ev) AS q""")
def _(c: Context):
    k = F.col("k")
    return c.t("ev").select(
        "event_id", M.trend_class(F.when(k % 10 != 9, k - 50)).alias("trend"),
        M.unthrottle(F.col("user_id").cast("double"), k % 20).alias("all_crashes"),
        M.dominant_os(k, F.col("user_id"), F.lit(40)).alias("os"))


_SPANS = """spans AS (SELECT event_id AS span_id, ts AS opens, ts + (CASE WHEN k = 0 THEN 1440 ELSE k % 10 * 7 END) * INTERVAL '1' MINUTE AS closes
 FROM ev WHERE event_type IN ('signup', 'error'))
"""


@query("c5_interval_join", "WITH " + _SPANS + "SELECT uuid, span_id FROM reports JOIN spans ON date_processed >= opens AND date_processed < closes")
def _(c: Context):
    minutes = F.expr("CASE WHEN k = 0 THEN 1440 ELSE k % 10 * 7 END * INTERVAL '1' MINUTE")
    spans = c.t("ev").where(F.col("event_type").isin("signup", "error")).select(
        F.col("event_id").alias("span_id"), F.col("ts").alias("opens"), (F.col("ts") + minutes).alias("closes"))
    return interval_join(c.t("reports"), spans, "date_processed", "opens", "closes").select("uuid", "span_id")


@query("c6_lifetime_join", """SELECT e.event_id, l.event_id AS life_id FROM ev AS e JOIN ev AS l ON e.user_id = l.user_id AND l.k % 4 = 0
 AND e.d BETWEEN l.d AND l.d + l.k % 12""")
def _(c: Context):
    lives = c.t("ev").where("k % 4 = 0").select("user_id", F.col("event_id").alias("life_id"), F.col("d").alias("born"),
                                               F.date_add("d", F.col("k") % 12).alias("gone"))
    points = c.t("ev").select("event_id", "user_id", "d")
    return interval_join(points, lives, "d", "born", "gone", keys=("user_id",), closed=True).select("event_id", "life_id")


_TEXTS = """texts AS (SELECT event_id, concat(event_type, '::', CAST(event_id AS STRING), '::u', CAST(user_id AS STRING), '::k', CAST(k AS STRING)) AS name FROM ev),
likes AS (SELECT event_id AS rule_id, CASE k % 4 WHEN 0 THEN concat('%::U', CAST(user_id AS STRING), '::K', CAST(k AS STRING))
  WHEN 1 THEN concat(upper(event_type), '::', substr(CAST(event_id AS STRING), 1, 3), '%') WHEN 2 THEN concat('%::', CAST(event_id % 1000 AS STRING), '::_%')
  ELSE concat('%:u', CAST(user_id AS STRING), '_::k', CAST(k % 10 AS STRING), '%') END AS likes FROM ev WHERE k % 5 = 0)
"""


@query("c4_pattern_join", "WITH " + _TEXTS + "SELECT event_id, rule_id FROM texts JOIN likes ON name ILIKE likes")
def _(c: Context):
    text = lambda n: F.col(n).cast("string")
    texts = c.t("ev").select("event_id", F.concat(F.col("event_type"), F.lit("::"), text("event_id"), F.lit("::u"), text("user_id"),
                                                  F.lit("::k"), text("k")).alias("name"))
    likes = (F.when(F.col("k") % 4 == 0, F.concat(F.lit("%::U"), text("user_id"), F.lit("::K"), text("k")))
             .when(F.col("k") % 4 == 1, F.concat(F.upper("event_type"), F.lit("::"), F.substring(text("event_id"), 1, 3), F.lit("%")))
             .when(F.col("k") % 4 == 2, F.concat(F.lit("%::"), (F.col("event_id") % 1000).cast("string"), F.lit("::_%")))
             .otherwise(F.concat(F.lit("%:u"), text("user_id"), F.lit("_::k"), (F.col("k") % 10).cast("string"), F.lit("%"))))
    rules = c.t("ev").where("k % 5 = 0").select(F.col("event_id").alias("rule_id"), likes.alias("likes"))
    return ilike_join(texts, rules, "name", "likes").select("event_id", "rule_id")


@query("c5_uptime_levels", "SELECT uuid, uptime_string FROM reports JOIN uptime_levels ON uptime >= min_uptime AND uptime < max_uptime")
def _(c: Context):
    return uptime_level(c.t("reports"), c.t("uptime_levels"), "uptime_string").select("uuid", "uptime_string")


@query("c3_c14_key_joins", """SELECT p.product_name, count(*) AS n FROM reports AS r JOIN products AS p ON lower(r.product) = lower(p.release_name) AND (CASE WHEN r.flash_version = '' THEN NULL ELSE r.flash_version END) IS NOT DISTINCT FROM NULL GROUP BY p.product_name""")
def _(c: Context):
    p = c.t("products").select("product_name", F.lower("release_name").alias("key"), F.lit(None).cast("string").alias("none"))
    r = c.t("reports").select(F.lower("product").alias("key"), F.nullif("flash_version", F.lit("")).alias("fv"))
    hit = r.join(p, (r["key"] == p["key"]) & r["fv"].eqNullSafe(p["none"]))
    return hit.groupBy("product_name").agg(F.count(F.lit(1)).alias("n"))


@query("d7_type_counts", """SELECT signature, CAST(sum(CASE WHEN process_type = 'content' THEN report_count ELSE 0 END) AS BIGINT) AS content_count, CAST(sum(CASE WHEN process_type = 'plugin' THEN report_count ELSE 0 END) AS BIGINT) AS plugin_count FROM tcbs GROUP BY signature""")
def _(c: Context):
    from crashlake.operators.topcrash import type_counts
    return c.tcbs.groupBy("signature").agg(*type_counts())


@query("d6_bug_lists", """SELECT signature, count(*) AS bug_count, string_agg(CAST(bug_id AS STRING), ',' ORDER BY bug_id) AS bugs FROM
(SELECT DISTINCT concat('sig_', CAST(k % 20 AS STRING)) AS signature, 1000 + k % 40 AS bug_id FROM ev) AS a WHERE signature IN (SELECT signature FROM reports) GROUP BY signature""")
def _(c: Context):
    from crashlake.operators.signatures import signature_bugs
    from crashlake.plans.checks_marts import _assoc
    out = signature_bugs(c.t("reports"), _assoc(c))
    return out.select("signature", "bug_count", F.array_join(F.col("bug_list").cast("array<string>"), ",").alias("bugs"))


