"""Registered queries of the processor: raw maps, rules, throttle, dumps, signatures."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from crashlake.functions.signature import SignatureRules, c_signature, java_signature, normalize_frame
from crashlake.operators import correlations, processing as P, rules as R
from crashlake.plans.registry import Context, query


def _raw(c: Context):
    """One raw crash per event: a map of texts, a submit time, and a dump text."""
    k, u = F.col("k"), F.col("user_id")
    s = F.unix_seconds("ts")
    text = lambda x: x.cast("string")
    entries = {
        "ProductName": F.when(k % 10 != 9, F.concat(F.lit("Product"), text(u % 3))),
        "Version": F.concat(text(k % 20), F.lit("."), text(u % 10)),
        "BuildID": F.lit("20240101000000"),
        "ProductID": F.concat(F.lit("p"), text(u % 4)),
        "ReleaseChannel": F.when(k % 3 == 0, F.lit("esr")).when(k % 3 == 1, F.lit("beta")),
        "URL": F.when(k % 4 == 0, F.repeat(F.lit("u"), k * 4)),
        "Comments": F.when(k % 9 == 0, F.lit("help")),
        "CrashTime": F.when(k % 5 != 0, text(s - k)),
        "timestamp": F.when(k % 10 == 5, text(s - 7)),
        "StartupTime": F.when(k % 6 != 0, text(s - k * 2 + 40)),
        "InstallTime": F.when(k % 8 != 0, text(s - u * 100)),
        "SecondsSinceLastCrash": F.when(k % 7 == 0, F.lit("soon")).when(k % 7 == 1, text(u)),
        "ProcessType": F.when(k % 4 == 1, F.lit("plugin")).when(k % 4 == 2, F.lit("content")),
        "PluginName": F.when(k % 8 == 1, F.lit("Flash")),
        "HangID": F.when(k % 11 == 0, F.concat(F.lit("h"), text(u))),
        "Hang": F.when(k % 22 == 0, F.lit("1")),
        "EMCheckCompatibility": F.when(k % 3 == 0, F.lit("True")).when(k % 3 == 1, F.lit("no")),
        "Add-ons": F.when(k % 5 == 1, F.concat(F.lit("a%40x:1."), text(u % 5), F.lit(",b"), text(k % 3)))
        .when(k % 5 == 2, F.lit("c+d:%zz")),
    }
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), v.alias("value")) for n, v in entries.items()])
    m = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))
    return c.t("ev").select("event_id", "k", "user_id", F.col("pid").alias("uuid"), m.alias("raw"),
                            F.col("ts").alias("submitted_timestamp"))


@query("b28_truncate_fields", """SELECT event_id, CASE WHEN k % 10 <> 9 THEN concat('Product', CAST(user_id % 3 AS STRING)) END AS product, concat(CAST(k % 20 AS STRING), '.', CAST(user_id % 10 AS STRING)) AS version,
 CASE WHEN k % 4 = 0 THEN least(k * 4, 255) END AS url_length, CASE WHEN k % 10 = 9 THEN 'WARNING: raw crash misses ProductName' ELSE '' END AS notes FROM ev""")
def _(c: Context):
    df = P.truncate_fields(_raw(c))
    return df.select("event_id", "product", "version", F.length("url").alias("url_length"),
                     F.array_join("notes", ";").alias("notes"))


@query("b29_derive_times", """SELECT event_id, crash - install AS install_age, greatest(0, crash - startup) AS uptime, CASE WHEN k % 7 = 1 THEN user_id END AS last_crash, crash AS crash_time FROM (
 SELECT *, coalesce(CASE WHEN k % 8 <> 0 THEN s - user_id * 100 END, startup) AS install FROM (SELECT *, coalesce(CASE WHEN k % 6 <> 0 THEN s - k * 2 + 40 END, crash) AS startup FROM (
  SELECT *, CASE WHEN k % 5 <> 0 THEN s - k WHEN k % 10 = 5 THEN s - 7 ELSE s END AS crash FROM (SELECT event_id, k, user_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s FROM ev) AS a) AS b) AS c) AS d""")
def _(c: Context):
    return P.derive_times(_raw(c)).select("event_id", "install_age", "uptime", "last_crash", "crash_time")


@query("b30_b31_hang_and_plugin", """SELECT event_id, CASE WHEN k % 11 = 0 THEN concat('h', CAST(user_id AS STRING)) END AS hang_id, CAST(CASE WHEN k % 22 = 0 THEN 1 WHEN k % 11 = 0 THEN -1 ELSE 0 END AS INT) AS hang_type,
 CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS addons_checked, CASE k % 3 WHEN 0 THEN 'esr' WHEN 1 THEN 'beta' ELSE 'unknown' END AS release_channel,
 CASE WHEN k % 8 = 1 THEN 'Flash' WHEN k % 4 = 1 THEN '' END AS plugin_name FROM ev""")
def _(c: Context):
    df = P.plugin_fields(P.hang_type(_raw(c)))
    return df.select("event_id", "hang_id", "hang_type", "addons_checked", "release_channel", "plugin_name")


@query("b32_addons", """SELECT event_id, unnest(CASE k % 5 WHEN 1 THEN ['a@x', concat('b', CAST(k % 3 AS STRING))] WHEN 2 THEN ['c d'] ELSE [] END) AS addon,
 unnest(CASE k % 5 WHEN 1 THEN [concat('1.', CAST(user_id % 5 AS STRING)), ''] WHEN 2 THEN ['%zz'] ELSE [] END) AS version FROM ev""")
def _(c: Context):
    a = F.explode(P.parse_addons(F.col("raw")["Add-ons"])).alias("a")
    return _raw(c).select("event_id", a).select("event_id", F.col("a.id").alias("addon"), "a.version")


@query("b39_rules", """SELECT event_id, concat(CAST(k % 20 AS STRING), '.', CAST(user_id % 10 AS STRING), CASE WHEN k % 3 = 0 THEN 'esr' ELSE '' END) AS version,
 CASE WHEN user_id % 4 = 2 THEN 'Renamed' WHEN k % 10 = 9 THEN NULL ELSE concat('Product', CAST(user_id % 3 AS STRING)) END AS product FROM ev""")
def _(c: Context):
    names = c.spark.sql("SELECT * FROM VALUES ('p2', 'Renamed') AS t(productid, product_name)")
    df = R.rename_products(R.apply_rules(_raw(c), [R.ESR_RULE]), names)
    return df.select("event_id", F.col("raw")["Version"].alias("version"), F.col("raw")["ProductName"].alias("product"))


@query("b40_rule_modes", """SELECT event_id, CASE WHEN k % 3 = 0 THEN 'first' WHEN k % 3 = 1 THEN 'second' ELSE 'third' END AS stopped_at_predicate,
 CASE WHEN k % 3 = 0 THEN 'third' WHEN k % 3 = 1 THEN 'second' ELSE 'third' END AS stopped_at_success, k % 3 = 1 OR user_id % 2 = 0 AS succeeded FROM ev""")
def _(c: Context):
    def put(value, verdict):
        return R.Action("Mark", lambda s, d: F.lit(value), lambda s, d: verdict)
    rules = [R.Rule(R.key_equals("ReleaseChannel", "esr"), put("first", F.lit(False))),
             R.Rule(R.key_equals("ReleaseChannel", "beta"), put("second", F.lit(True))),
             R.Rule(R.always, put("third", F.col("user_id") % 2 == 0))]
    one = R.apply_rules(_raw(c), rules, mode="until_predicate_succeeds")
    one = one.withColumn("stopped_at_predicate", F.col("raw")["Mark"])
    two = R.apply_rules(one, rules, mode="until_action_succeeds", outcome="succeeded")
    return two.select("event_id", "stopped_at_predicate", F.col("raw")["Mark"].alias("stopped_at_success"), "succeeded")


#: Site rules of the example: comments always, pre-release channels always, a tenth of one product.
THROTTLE = [
    ("Comments", lambda v: v != "", 100),
    ("ReleaseChannel", lambda v: v.isin("nightly", "aurora", "beta", "esr"), 100),
    ("ProductName", "Product0", 10),
    ("Version", re.compile(r"\..*?[a-zA-Z]+"), 100),
    ("ProductName", "Product1", 50),
    (None, True, 0),
]


@query("b41_b42_throttle", """SELECT event_id, CASE WHEN accepted THEN 0 WHEN p0 AND (k % 20 > 10 OR (k % 20 = 10 AND user_id % 10 >= 5)) THEN 2 ELSE 1 END AS verdict FROM (
 SELECT *, k % 10 <> 9 AND user_id % 3 = 0 AS p0, k % 9 = 0 OR k % 3 <> 2 OR CASE WHEN k % 10 = 9 THEN false WHEN user_id % 3 = 0 THEN user_id % 100 < 10 WHEN user_id % 3 = 1 THEN user_id % 100 < 50 ELSE false END AS accepted FROM ev) AS q""")
def _(c: Context):
    df = R.throttle(_raw(c), THROTTLE, minimal={"Product0": "10.5"}, never_discard=False,
                    bucket=F.col("user_id") % 100, out="verdict")
    return df.select("event_id", "verdict")


def _dumped(c: Context):
    """Dump texts: header lines, a blank line, frames of two threads."""
    k, u = F.col("k"), F.col("user_id")
    text = lambda x: x.cast("string")
    nl = F.lit("\n")
    head = F.concat_ws(
        "\n", F.lit("OS|Windows NT|6.1.7601"), F.lit("CPU|x86|family 6|2"), F.lit("too short"),
        F.when(k % 4 != 3, F.concat(F.lit("Crash|EXCEPTION_"), text(k % 5), F.lit("|0x"), text(k), F.lit("|"),
                                    F.when(k % 4 == 2, F.lit("1")).otherwise(F.lit("0")))),
        F.lit("Module|other.dll|1.0|o.pdb|ID|0|0|1"),
        F.when(k % 3 == 0, F.lit("Module|NPSWF32_11_2_202.dll||f.pdb|ID2|0|0|0"))
        .when(k % 3 == 1, F.lit("Module|libflashplayer.so|10.3|f|ID3|0|0|0")))
    t0 = F.concat_ws(
        "\n", F.when(k % 2 == 0, F.lit("0|0|ntdll.dll|KiFastSystemCallRet|||0x1")),
        F.lit("0|1|msvcrt.dll|memcpy|src/mem.c|12|0x2"),
        F.concat(F.lit("0|2|app.dll|run"), text(k % 7), F.lit("(int ,char *)|src\\app.cpp|"), text(u), F.lit("|0x3")),
        F.lit("0|3|app.dll|main|||0x4"))
    t1 = F.concat_ws("\n", F.concat(F.lit("1|0|lib.so||/a/b/file"), text(k % 6), F.lit(".cc|7|0x9")),
                     F.lit("1|1|lib.so||||0xa"))
    return c.t("ev").select("event_id", "k", "user_id", F.concat(head, nl, nl, t0, nl, t1).alias("dump"),
                            F.when(k % 10 == 0, 1).when(k % 10 == 5, -1).otherwise(0).alias("hang_type"))


@query("b33_dump_header", """SELECT event_id, 'Windows NT' AS os_name, '6.1.7601' AS os_version, 'x86' AS cpu_name, 'family 6 | 2' AS cpu_info, CASE WHEN k % 4 <> 3 THEN concat('EXCEPTION_', CAST(k % 5 AS STRING)) END AS reason,
 CASE WHEN k % 4 <> 3 THEN concat('0x', CAST(k AS STRING)) END AS address, CAST(CASE k % 4 WHEN 3 THEN NULL WHEN 2 THEN 1 ELSE 0 END AS INT) AS crashed_thread, CASE k % 3 WHEN 0 THEN '11.2.202' WHEN 1 THEN '10.3' ELSE '[blank]' END AS flash_version FROM ev""")
def _(c: Context):
    return P.parse_dump_header(_dumped(c)).select("event_id", "os_name", "os_version", "cpu_name", "cpu_info",
                                                  "reason", "address", "crashed_thread", "flash_version")


_THREAD = "CASE WHEN k % 10 = 0 THEN 0 WHEN k % 4 = 3 THEN NULL WHEN k % 4 = 2 THEN 1 ELSE 0 END"


@query("b34_b35_frames", f"""WITH f AS (SELECT event_id, k, user_id, {_THREAD} AS t FROM ev)
SELECT event_id, frame_text, row_number() OVER (PARTITION BY event_id ORDER BY i) - 1 AS pos FROM (
 SELECT event_id, 0 AS i, 'KiFastSystemCallRet' AS frame_text FROM f WHERE t = 0 AND k % 2 = 0 UNION ALL SELECT event_id, 1, 'memcpy' FROM f WHERE t = 0
 UNION ALL SELECT event_id, 2, concat('run', CAST(k % 7 AS STRING), '(int, char*)') FROM f WHERE t = 0 UNION ALL SELECT event_id, 3, 'main' FROM f WHERE t = 0
 UNION ALL SELECT event_id, 0, concat('file', CAST(k % 6 AS STRING), '.cc#7') FROM f WHERE t = 1 UNION ALL SELECT event_id, 1, 'lib.so@0xa' FROM f WHERE t = 1) AS q""")
def _(c: Context):
    df = P.parse_frames(P.parse_dump_header(_dumped(c)))
    return P.explode_frames(df, "event_id").select("event_id", "frame_text", F.col("pos").cast("bigint").alias("pos"))


@query("b36_b38_dump_signatures", f"""SELECT event_id, CASE WHEN t IS NULL THEN CASE WHEN k % 10 = 5 THEN 'hang' ELSE 'EMPTY: no crashing thread identified' END ELSE concat(CASE WHEN k % 10 = 0 THEN 'chromehang | ' WHEN k % 10 = 5 THEN 'hang | ' ELSE '' END,
 CASE WHEN t = 0 THEN concat('memcpy | run', CAST(k % 7 AS STRING), '(int, char*)') ELSE concat('file', CAST(k % 6 AS STRING), '.cc#7') END) END AS signature,
 CASE WHEN t IS NULL AND false THEN '' ELSE 'src/mem.c' END AS top_file FROM (SELECT event_id, k, {_THREAD} AS t FROM ev) AS q""")
def _(c: Context):
    df = P.parse_frames(P.parse_dump_header(_dumped(c))).withColumn("java_stack_trace", F.lit(None).cast("string"))
    return P.add_signature(df).select("event_id", "signature", F.col("topmost_filenames").alias("top_file"))


# signatures again, from frame lists with own rules: sentinels, prefixes, irrelevant frames
_RULES = SignatureRules(irrelevant=("skip",), prefix=("pre", "go"), sentinels=("top", ("maybe", "with")), max_length=60)


@query("b36_c_signature", """SELECT event_id, CASE k % 6 WHEN 0 THEN concat('top', '') WHEN 1 THEN 'pre1 | go2 | end''''s' WHEN 2 THEN 'maybe' WHEN 3 THEN 'a' WHEN 4 THEN 'skip1' ELSE concat('hang | ', repeat('x', 50), '...') END AS signature,
 CAST(CASE k % 6 WHEN 4 THEN 1 WHEN 5 THEN 1 ELSE 0 END AS INT) AS notes FROM ev""")
def _(c: Context):
    k = F.col("k")
    frames = (F.when(k % 6 == 0, F.array(*[F.lit(x) for x in ("pre", "a", "top", "b")]))
              .when(k % 6 == 1, F.array(*[F.lit(x) for x in ("skip0", "pre1", "skip2", "go2", "end's", "z")]))
              .when(k % 6 == 2, F.array(*[F.lit(x) for x in ("pre", "maybe", "with")]))
              .when(k % 6 == 3, F.array(*[F.lit(x) for x in ("a", "maybe")]))
              .when(k % 6 == 4, F.array(*[F.lit(x) for x in ("skip1", "skip2")]))
              .otherwise(F.array(F.repeat(F.lit("x"), F.lit(80)))))
    sig = c_signature(frames, F.when(k % 6 == 5, -1).otherwise(0), F.lit(0), _RULES)
    return c.t("ev").select("event_id", sig.alias("s")).select("event_id", "s.signature", F.size("s.notes").alias("notes"))


@query("b35_normalize_frame", """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN concat('f<int>(', lang, '*, ', source, ')') WHEN doc_id % 4 = 1 THEN concat(source, '.c#', CAST(n_chars AS STRING)) WHEN doc_id % 4 = 2 THEN concat(lang, '@0x', CAST(doc_id AS STRING)) ELSE concat('js_Interpret', lang, ':', CAST(n_chars AS STRING)) END AS frame FROM documents""")
def _(c: Context):
    i, text = F.col("doc_id") % 4, F.col("n_chars").cast("string")
    fn = (F.when(i == 0, F.concat(F.lit("f<12u>("), "lang", F.lit(" *,"), "source", F.lit(")")))
          .when(i == 3, F.concat(F.lit("js_Interpret"), "lang")))
    src = F.when(i == 1, F.concat(F.lit("/a/b\\c\\"), "source", F.lit(".c//")))
    return c.t("documents").select("doc_id", normalize_frame(
        F.col("lang"), fn, src, text, F.concat(F.lit("0x"), F.col("doc_id").cast("string"))).alias("frame"))


@query("b37_java_signature", """SELECT event_id, CASE k % 4 WHEN 0 THEN concat('Exc', CAST(k AS STRING), ': it broke at a.b(F.java)') WHEN 1 THEN concat('NoColon', CAST(k AS STRING), ': at x.y(G.java)') WHEN 2 THEN 'E: at long.one(H.java)' ELSE 'Only: line' END AS signature FROM ev""")
def _(c: Context):
    k = F.col("k")
    n = k.cast("string")
    trace = (F.when(k % 4 == 0, F.concat(F.lit("  Exc"), n, F.lit(" : it broke  \n at a.b(F.java:12)\n at c")))
             .when(k % 4 == 1, F.concat(F.lit("NoColon"), n, F.lit("\r\nat x.y(G.java:"), n, F.lit(")")))
             .when(k % 4 == 2, F.concat(F.lit("E: "), F.repeat(F.lit("d"), F.lit(400)), F.lit("\nat long.one(H.java:9)")))
             .otherwise(F.lit("Only: line\n")))
    return c.t("ev").select("event_id", java_signature(trace)["signature"].alias("signature"))


@query("k4_process_raw", f"""SELECT event_id, CASE WHEN th IS NULL THEN CASE WHEN k % 11 = 0 THEN 'hang' ELSE 'EMPTY: no crashing thread identified' END ELSE
 concat(CASE WHEN k % 22 = 0 THEN 'chromehang | ' WHEN k % 11 = 0 THEN 'hang | ' ELSE '' END, CASE WHEN th = 0 THEN concat('memcpy | run', CAST(k % 7 AS STRING), '(int, char*)') ELSE concat('file', CAST(k % 6 AS STRING), '.cc#7') END) END AS signature,
 concat(CAST(k % 20 AS STRING), '.', CAST(user_id % 10 AS STRING), CASE WHEN k % 3 = 0 THEN 'esr' ELSE '' END) AS version, true AS success
FROM (SELECT event_id, k, user_id, {_THREAD.replace("k % 10 = 0", "k % 22 = 0")} AS th FROM ev) AS q""")
def _(c: Context):
    from crashlake.streaming.jobs import processed
    raw = _raw(c).join(_dumped(c).select("event_id", "dump"), "event_id")
    return processed(raw).select("event_id", "signature", "version", "success")


@query("b51_correlation_report", """SELECT CAST(k AS STRING) AS report, CASE k % 2 WHEN 0 THEN 'Windows NT' ELSE 'Mac OS X' END AS platform, concat('sig_', CAST(user_id AS STRING)) AS signature, CASE WHEN user_id % 3 = 0 THEN 'UNKNOWN' ELSE 'EXC_BAD' END AS reason,
 CAST(CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id + 5 END AS BIGINT) AS crash_count, CAST(k AS BIGINT) AS percent, concat('lib', CAST(event_id AS STRING), '.dll') AS module FROM ev""")
def _(c: Context):
    # per event: a platform line, a blank, a signature line, and one body line
    k, u, i = F.col("k"), F.col("user_id"), F.col("event_id")
    text = lambda x: x.cast("string")
    sig = F.concat(F.lit("sig_"), text(u))
    lines = F.array(
        F.when(k % 2 == 0, F.lit("Windows NT")).otherwise(F.lit("Mac OS X")),
        F.concat(F.lit("  "), F.when(u % 3 == 0, sig).otherwise(F.concat(F.lit("skip|"), sig, F.lit("|EXC_BAD ("), text(u + 5), F.lit(" crashes)")))),
        F.concat(F.lit("    "), text(k), F.lit("% (6/9) vs.   6% (62/1024) lib"), text(i), F.lit(".dll")), F.lit(""))
    rows = c.t("ev").select(text(k).alias("report"), i, F.posexplode(lines).alias("p", "line"))
    df = rows.select("report", (i * 10 + F.col("p")).alias("line_number"), "line")
    return correlations.parse_correlation_report(df).select("report", "platform", "signature", "reason", "crash_count", "percent", "module")
