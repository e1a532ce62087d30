import re

import pytest
from pyspark.sql import functions as F

from crashlake.operators import processing as P, rules as R

RAW = "uuid string, raw map<string,string>, submitted_timestamp timestamp, dump string"
DUMP = "\n".join(["OS|Linux|3.2.0", "CPU|x86|family 6|2", "bad", "Crash|SIGSEGV|0x0|1",
                  "Module|libflashplayer.so|11.2|f|id|0|0|0", "",
                  "0|0|libc|wait|a.c|1|0x1", "1|0|libc|memcpy|m.c|2|0x2", "1|1|app|boom|b.c|3|0x3",
                  "2|0|x|other||||", "1|2|app|late|||0x4"])


def raw_frame(spark, raw, dump=DUMP):
    return spark.createDataFrame([("e8820616-1462-49b6-9784-e99a32120615", raw, None, dump)], RAW)


def test_raw_to_processed(spark):
    raw = {"ProductName": "Atlas", "Version": "12.0", "BuildID": "20120615000000",
           "CrashTime": "1339750000", "StartupTime": "1339749900", "InstallTime": "1339740000",
           "Add-ons": "a%40b:1.0,broken", "HangID": "h1", "Comments": "x" * 600}
    row = P.process_raw(raw_frame(spark, raw)).first()
    assert row["signature"] == "hang | memcpy | boom"
    assert (row["os_name"], row["cpu_info"], row["crashed_thread"]) == ("Linux", "family 6 | 2", 1)
    assert (row["uptime"], row["install_age"], row["flash_version"]) == (100, 10000, "11.2")
    assert [tuple(a) for a in row["addons"]] == [("a@b", "1.0"), ("broken", "")]
    assert len(row["user_comments"]) == 500 and row["topmost_filenames"] == "a.c"
    assert not row["truncated"] and str(row["date_processed"].date()) == "2012-06-15"


def test_java_trace_wins(spark):
    raw = {"JavaStackTrace": "E: why\nat a.b(C.java:3)"}
    row = P.process_raw(raw_frame(spark, raw)).first()
    assert row["signature"] == "E: why at a.b(C.java)"


def test_no_dump(spark):
    row = P.process_raw(raw_frame(spark, {"ProductName": "A"}, None)).first()
    assert row["signature"] == "EMPTY: no crashing thread identified" and not row["success"]
    assert "misses Version" in row["processor_notes"]


def test_long_stack_is_marked_and_cut(spark):
    lines = ["Crash|X|0x0|0", ""] + [f"0|{i}|m|f{i}|||0x1" for i in range(150)]
    df = P.parse_dump_header(raw_frame(spark, {}, "\n".join(lines)).withColumn("hang_type", F.lit(0)))
    row = P.parse_frames(df).first()
    assert row["truncated"] and len(row["frames"]) == 30


def marks(spark, mode):
    def act(value, verdict):
        return R.Action("m", lambda s, d: F.concat(F.coalesce(d["m"], F.lit("")), F.lit(value)),
                        lambda s, d: F.lit(verdict))
    rules = [R.Rule(R.key_equals("k", "no"), act("1", True)), R.Rule(R.always, act("2", False)),
             R.Rule(R.always, act("3", True)), R.Rule(R.always, act("4", True))]
    df = spark.createDataFrame([({"k": "yes"},)], "raw map<string,string>")
    row = R.apply_rules(df, rules, mode=mode, outcome="o").first()
    return row["raw"].get("m"), row["o"]


@pytest.mark.parametrize("mode,expected", [
    ("all", ("234", True)), ("until_action_succeeds", ("23", True)),
    ("until_action_fails", (None, True)), ("until_predicate_succeeds", ("2", False)),
    ("until_predicate_fails", (None, None))])
def test_rule_modes(spark, mode, expected):
    assert marks(spark, mode) == expected


def test_rule_actions(spark):
    df = spark.createDataFrame([({"ReleaseChannel": "esr", "Version": "10.0"}, {"Version": "10.0"})],
                               "a map<string,string>, b map<string,string>")
    rules = [R.Rule(R.keys_equal("Version", "Version"), R.copy_key("ReleaseChannel", "Copy")),
             R.Rule(R.always, R.format_value("New", "%(Version)s-%(ReleaseChannel)s")),
             R.Rule(R.always, R.format_value("Not", "%(Missing)s"))]
    assert R.apply_rules(df, rules, "a", "b").first()["b"] == \
        {"Version": "10.0", "Copy": "esr", "New": "10.0-esr"}


THROTTLE = [("alpha", re.compile("ALPHA"), 100), ("beta", "BETA", 100),
            ("gamma", lambda v: v == "GAMMA", 100), ("delta", True, 100), (None, True, 0)]


@pytest.mark.parametrize("raw,expected", [
    ({"Version": "3.6", "alpha": "ALPHA"}, 0), ({"Version": "3.4", "alpha": "no"}, 1),
    ({"Version": "3.6", "alpha": "no"}, 2), ({"Version": "3.6", "beta": "BETA"}, 0),
    ({"Version": "3.6", "gamma": "GAMMA"}, 0), ({"Version": "3.6", "delta": "any"}, 0)])
def test_throttle(spark, raw, expected):
    df = spark.createDataFrame([("u", {"ProductName": "p1", **raw})],
                               "uuid string, raw map<string,string>")
    row = R.throttle(df, THROTTLE, minimal={"p1": "3.5"}, never_discard=False).first()
    assert row["legacy_processing"] == expected


def test_throttle_share(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("uuid"),
                                   F.create_map(F.lit("a"), F.lit("b")).alias("raw"))
    kept = R.throttle(df, [(None, True, 10)]).where("legacy_processing = 0").count()
    assert 1700 < kept < 2300
