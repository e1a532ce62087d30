import datetime as dt

import pytest
from pyspark.sql import functions as F

from crashlake.functions import metrics as M, platforms as P, text as X, times as T, versions as V
from crashlake.functions.search import parse_parameters
from crashlake.functions.signature import SignatureRules, c_signature, java_signature, normalize_frame


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


PAD = (0, "zzzzzz", 0, "zzzzzz")


@pytest.mark.parametrize("text,key,back", [
    ("3", [(3, "zzzzzz", 0, "zzzzzz"), PAD, PAD, PAD], "3"),
    ("3.", [(3, "zzzzzz", 0, "zzzzzz"), PAD, PAD, PAD], "3"),
    ("3.5pre", [(3, "zzzzzz", 0, "zzzzzz"), (5, "pre", 0, "zzzzzz"), PAD, PAD], "3.5pre"),
    ("3.6.4plugin3", [(3, "zzzzzz", 0, "zzzzzz"), (6, "zzzzzz", 0, "zzzzzz"),
                      (4, "plugin", 3, "zzzzzz"), PAD], "3.6.4plugin3"),
])
def test_version_keys(spark, text, key, back):
    k = V.version_key(F.lit(text))
    assert [tuple(p) for p in one(spark, k)] == key
    assert one(spark, V.version_denormalize(k)) == back


@pytest.mark.parametrize("a,b,expected", [
    ("3", "3.1", -1), ("3", "3.0", 0), ("3", "3.0pre", 1), ("3.5b2", "3.5b1", 1),
    ("3.5", "3.5b1", 1), ("3.5.1", "3.5.1b3", 1), ("3.?", "3", None)])
def test_version_compare(spark, a, b, expected):
    assert one(spark, V.version_compare(F.lit(a), F.lit(b))) == expected


@pytest.mark.parametrize("version,beta,channel,expected", [
    ("13.0", 0, "", "013000000r000"), ("13.0a1", 0, "nightly", "013000000a001"),
    ("13.0", 3, "", "013000000b003"), ("3.6.12", 0, "release", "003006012r000"),
    ("10.0.2esr", 0, "", "010000002x000"), ("5.0(beta)", 0, "", "005000000b099"),
    ("junk", 0, "", None)])
def test_version_sort(spark, version, beta, channel, expected):
    got = one(spark, V.version_sort(F.lit(version), F.lit(beta), F.lit(channel)))
    assert got == expected


@pytest.mark.parametrize("args,expected", [
    (("m", "fn", "s", "23", "0xF"), "fn"),
    (("m", "js_Interpret", "s", "23", "0xF"), "js_Interpret:23"),
    (("m", "f( *s , &n)", "s", "23", "0xF"), "f(*s, &n)"),
    (("m", "f<3>(s,t,u)", "s", "23", "0xF"), "f<int>(s, t, u)"),
    (("m", "", "source/", "23", "0xF"), "source#23"),
    (("m", "", "\\a\\b\\source", "23", "0xF"), "source#23"),
    (("m", "", "/a/b/source", "", "0xF"), "m@0xF"),
    ((None, "", "", "", "0xF"), "@0xF")])
def test_normal_frames(spark, args, expected):
    cols = [F.lit(a).cast("string") for a in args]
    assert one(spark, normalize_frame(*cols)) == expected


RULES = SignatureRules(irrelevant=("a", "b", "c"), prefix=("d", "e", "f"),
                       sentinels=("stop", ("stop2", "ff")))


def sig(spark, frames, hang=0, thread=0, rules=RULES):
    return one(spark, c_signature(F.lit(frames) if frames else F.array().cast("array<string>"),
                                  F.lit(hang), F.lit(thread).cast("int"), rules))


def test_c_signatures(spark):
    letters = list("abcdefghij")
    assert sig(spark, letters)["signature"] == "d | e | f | g"
    assert sig(spark, letters, hang=-1)["signature"] == "hang | d | e | f | g"
    assert sig(spark, letters, hang=1)["signature"] == "chromehang | d | e | f | g"
    assert sig(spark, ["d", "g", "stop", "z"])["signature"] == "stop"
    assert sig(spark, ["d", "g", "stop2"])["signature"] == "d | g"
    assert sig(spark, ["d", "g", "stop2", "ff"])["signature"] == "stop2"
    assert sig(spark, ["d", "x'y"])["signature"] == "d | x''y"


def test_empty_c_signatures(spark):
    assert sig(spark, [], thread=None)["signature"] == "EMPTY: no crashing thread identified"
    assert sig(spark, [])["signature"] == "EMPTY: no frame data available"
    assert sig(spark, ["a1", "b1"])["signature"] == "a1"
    assert len(sig(spark, [])["notes"]) == 1


def test_long_c_signature(spark):
    got = sig(spark, [c * 70 for c in "defg"])["signature"]
    assert len(got) == 255 and got.endswith("...") and got.startswith("d" * 70 + " | e")


@pytest.mark.parametrize("trace,expected,notes", [
    ("Boom: made up  \nat a.b(F.java:66)", "Boom: made up at a.b(F.java)", 0),
    ("   Boom: " + "t" * 1000 + "\nat a.b(F.java:1)", "Boom: at a.b(F.java)", 1),
    ("   Boom\nat a.b(F.java:1)", "Boom: at a.b(F.java)", 1),
    ("Boom: made up", "Boom: made up", 1),
    (None, "EMPTY: Java stack trace not in expected format", 1)])
def test_java_signatures(spark, trace, expected, notes):
    got = one(spark, java_signature(F.lit(trace).cast("string")))
    assert (got["signature"], len(got["notes"])) == (expected, notes)


def test_crash_ids(spark):
    uid = "e8820616-1462-49b6-9784-e99a32120201"
    assert one(spark, T.ooid_date(F.lit(uid))) == dt.date(2012, 2, 1)
    assert one(spark, T.ooid_depth(F.lit(uid))) == 2
    assert one(spark, T.uuid_to_date(F.lit(uid), "18")) == dt.date(1812, 2, 1)
    assert one(spark, T.ooid_date(F.lit("nothing here"))) is None
    made = T.with_ooid(spark.range(3).select(F.lit("2012-06-15").cast("timestamp").alias("t")), "t")
    rows = [r["uuid"] for r in made.collect()]
    assert len(set(rows)) == 3 and all(len(r) == 36 and r.endswith("2120615") for r in rows)


def test_text_rules(spark):
    assert one(spark, X.initcap1(F.lit("macOS x"))) == "MacOS x"
    assert one(spark, X.url2domain(F.lit("about:config"))) is None
    parts = one(spark, X.url_parts(F.lit("chrome://example/content/x.xul?q=1")))
    assert (parts["host"], parts["page"]) == ("example", "chrome://example/content/x.xul")
    assert one(spark, X.url_parts(F.lit("about:config"))) is None
    assert one(spark, X.cell(F.lit("  a\r\nb\n"))) == "a | b"
    assert one(spark, X.cell(F.lit(None).cast("string"))) == "\\N"
    assert one(spark, X.get_cores(F.lit("family 6"))) is None
    assert one(spark, P.linux_version(F.lit("Linux"), F.lit("0.0.0 Linux 2.6.35 x"))) == "2.6.35 ?arch?"


def test_measures(spark):
    assert one(spark, M.crash_hadu(F.lit(5), F.lit(0))) == 0
    assert one(spark, M.crash_hadu(F.lit(5), F.lit(1000), F.lit(0.1))) == 5.0
    assert one(spark, M.trend_class(F.lit(None).cast("int"))) == "new"
    assert one(spark, M.trend_class(F.lit(-4))) == "static"
    assert one(spark, V.sunset_date(F.lit("20120601000000"), F.lit("ESR"))) == dt.date(2012, 10, 5)


def test_search_parameters():
    now = dt.datetime(2012, 6, 15)
    p = parse_parameters({"to_date": "2030-01-01", "search_mode": "odd", "terms": "x",
                          "result_number": "5"}, now)
    assert p["to_date"] == now and p["from_date"] == dt.datetime(2012, 6, 8)
    assert p["search_mode"] == "default" and p["terms"] == ["x"] and p["result_number"] == 5
    assert p["fields"] == ["signature"] and p["build_from"] is None


def test_long_rule_table_gives_the_same(spark):
    """Above the bound the pattern map joins distinct texts; rows must not change."""
    import crashlake.session as S
    rules = spark.createDataFrame([("A", "a%"), ("B", "b%"), ("AB", "ab%")],
                                  "name string, match_string string")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["abc", "b", None, "x", "abc"])],
                               "i int, t string")
    short = {(r["i"], r["out"]) for r in P.ilike_map(df, rules, "t", "name", "out").collect()}
    kept = P.bounded_rows
    try:
        P.bounded_rows = lambda d: S.bounded_rows(d, 2)
        long = {(r["i"], r["out"]) for r in P.ilike_map(df, rules, "t", "name", "out").collect()}
    finally:
        P.bounded_rows = kept
    assert short == long == {(0, "A"), (1, "B"), (2, None), (3, None), (4, "A")}
