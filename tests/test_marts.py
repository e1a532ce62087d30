import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from crashlake.operators import (campaigns, common, correlations, dims, duplicates, explosive,
                                 graphs, hangs, topcrash, users)
from crashlake.operators.clean import build_reports_clean
from crashlake.operators.duplicates import IDENTITY


def test_every_report_goes_somewhere(events):
    """Clean + bad + already done = finished reports; user info is a part of clean."""
    reports = events.t("reports")
    finished = reports.where("completed_datetime IS NOT NULL").count()
    done = reports.where("k < 10").select("uuid", "date_processed")
    out = build_reports_clean(reports, events.dims, done)
    skipped = reports.where("completed_datetime IS NOT NULL AND k < 10").count()
    assert out.clean.count() + out.bad.count() + skipped == finished
    assert out.clean.select("uuid").distinct().count() == out.clean.count()
    assert out.user_info.join(out.clean, "uuid", "left_anti").isEmpty()


def test_old_channel_rule(events, spark):
    r = events.t("reports").where("product = 'Atlas' AND version = '1.0'").withColumn(
        "release_channel", F.lit(None).cast("string"))
    without = build_reports_clean(r, events.dims)
    with_rule = build_reports_clean(r, events.dims, old_channel=("atlas", "1.0", "pre"))
    assert without.clean.isEmpty() and with_rule.clean.count() > 0


def test_tcbs_totals_match_reports(events):
    """Counts of the mart without parents = live clean reports."""
    parents = events.pv.where("is_rapid_beta").select("product_version_id")
    own = events.tcbs.join(parents, "product_version_id", "left_anti")
    live = events.clean.join(events.pv.select("product_version_id", "build_date", "sunset_date"),
                             "product_version_id") \
        .where(F.to_date("date_processed").between(F.col("build_date"), F.col("sunset_date"))).count()
    assert own.agg(F.sum("report_count")).first()[0] == live
    betas = events.tcbs.join(events.pv.where("rapid_beta_id IS NOT NULL"), "product_version_id") \
        .agg(F.sum("report_count")).first()[0]
    assert events.tcbs.join(parents, "product_version_id").agg(F.sum("report_count")).first()[0] == betas


def test_day_range_equals_days(events):
    whole = topcrash.tcbs(events.clean, events.pv, "2024-01-05", "2024-01-06")
    days = topcrash.tcbs(events.clean, events.pv, "2024-01-05", "2024-01-05").unionByName(
        topcrash.tcbs(events.clean, events.pv, "2024-01-06", "2024-01-06"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, days.collect()))


def test_dense_is_sparse_with_zeros(events):
    """Non-zero rows of the dense mart are the plain counts; each row has all crash types."""
    dense = events.cbu
    per = dense.groupBy("product_version_id", "report_date", "os_short_name").count()
    assert {r["count"] for r in per.collect()} == {5}
    parents = events.pv.where("is_rapid_beta").select("product_version_id")
    own = dense.join(parents, "product_version_id", "left_anti")
    total = own.agg(F.sum("report_count")).first()[0]
    # versions past their sunset have no users any more, and so no rows
    users_of = events.product_adu.withColumnRenamed("adu_date", "report_date")
    kinded = common.crash_kind(common.report_day(events.clean), events.t("crash_types")) \
        .join(events.t("os_names"), "os_name") \
        .join(users_of, ["product_version_id", "os_name", "report_date"], "left_semi")
    assert total == kinded.count() > 0


def test_explosiveness_by_hand(spark):
    day = dt.date(2024, 1, 20)
    tcbs = spark.createDataFrame(
        [("v", "new", day, 50)] + [("v", "old", day - dt.timedelta(days=i), 20) for i in range(10)]
        + [("v", "gone", day - dt.timedelta(days=5), 90)],
        "product_version_id string, signature string, report_date date, report_count long")
    adu = spark.createDataFrame([("v", day - dt.timedelta(days=i), 1000000) for i in range(10)],
                                "product_version_id string, adu_date date, adu_count long")
    rows = {r["signature"]: r for r in explosive.explosiveness(tcbs, adu, day).collect()}
    assert set(rows) == {"new", "old"}
    assert rows["new"]["oneday"] == round(50 / 30, 2) and rows["new"]["day0"] == 50
    # three-day mean 50/3 over a least divisor of 10 (only one day has one)
    assert rows["new"]["threeday"] == round((50 / 3) / 10, 2)
    assert rows["old"]["oneday"] == 0 and rows["old"]["threeday"] == 0


def brute_duplicates(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[tuple(r[k] for k in IDENTITY)].append(r)

    def fuzzy(a, b, x, y):
        if x is None or y is None:
            return True
        return -60 <= (b["client_crash_date"] - a["client_crash_date"]).total_seconds() - (y - x) <= 60
    out = set()
    for g in groups.values():
        lead = min(g, key=lambda r: (r["client_crash_date"], r["uuid"]))
        for f in g:
            if f["uuid"] != lead["uuid"] and (
                    fuzzy(lead, f, lead["uptime"], f["uptime"]) or (f["uptime"] or 99) < 60) \
                    and fuzzy(lead, f, lead["install_age"], f["install_age"]):
                out |= {(f["uuid"], lead["uuid"]), (lead["uuid"], lead["uuid"])}
    return out


def test_duplicates_against_brute_force(spark):
    """One group holds a third of the rows; NULL keys agree with NULL keys."""
    base = dt.datetime(2024, 1, 1, 10)
    rows = []
    for i in range(300):
        r = {k: ("x" if i % 3 == 0 else f"s{i % 7}") for k in IDENTITY}
        r["url"] = None if i % 2 else "u"
        r |= {"uuid": f"u{i:03}", "client_crash_date": base + dt.timedelta(seconds=i * 17 % 200),
              "uptime": None if i % 11 == 0 else i * 13 % 300, "install_age": i * 7 % 150,
              "date_processed": base + dt.timedelta(seconds=i)}
        rows.append(r)
    schema = ", ".join(f"{k} string" for k in IDENTITY) + \
        ", uuid string, client_crash_date timestamp, uptime int, install_age int, date_processed timestamp"
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)
    got = {(r["uuid"], r["duplicate_of"]) for r in duplicates.find_duplicates(df).collect()}
    assert got == brute_duplicates(rows) and len(got) > 50
    known = spark.createDataFrame([("u003", base)], "uuid string, date_processed timestamp")
    rest = duplicates.find_duplicates(df, "2024-01-01 09:00:00", "2024-01-01 12:00:00", known)
    assert {r["uuid"] for r in rest.collect()} == {u for u, _ in got} - {"u003"}


def test_sliding_ranges_include_their_ends(spark):
    """Reports an hour apart to the second share the range that starts at the first."""
    cols = ", ".join(f"{k} string" for k in IDENTITY)
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("u1", t, t, 5, 5, *["s"] * 13), ("u2", t + dt.timedelta(hours=1), t, 5, 5, *["s"] * 13)]
    df = spark.createDataFrame(rows, "uuid string, date_processed timestamp, "
                                     "client_crash_date timestamp, uptime int, install_age int, " + cols)
    assert {r["uuid"] for r in duplicates.find_duplicates_sliding(df).collect()} == {"u1", "u2"}


def test_product_versions_twice_adds_nothing(spark):
    releases = spark.createDataFrame([
        ("atlas", "12.0", "linux", 20240105000000, "Release", None, "Main"),
        ("atlas", "12.0esr", "linux", 20240105000000, "Release", None, "main"),
        ("atlas", "13.0", "linux", 20240106000000, "Beta", 1, "main"),
        ("atlas", "13.0", "win", 20240108000000, "beta", 2, "main"),
        ("atlas", "15.0a1", "win", 20240108000000, "Nightly", None, "main"),
        ("atlas", "15.0a1", "arm", 20240108000000, "Nightly", None, "main"),
        ("atlas", "15.0a2", "win", 20240108000000, "Nightly", None, "main"),
        ("atlas", "16.0a1", "win", 20240108000000, "Nightly", None, "private"),
        ("atlas", "11.0", "win", 20230108000000, "Release", None, "main"),
    ], "product_name string, version string, platform string, build_id long, build_type string, "
       "beta_number int, repository string")
    products = spark.createDataFrame(
        [("Atlas", "5.0", "13.0", "Atlas"), ("Runtime", "15.0", "99.0", "Runtime"),
         ("Pocket", "5.0", "99.0", "Pocket")],
        "product_name string, rapid_release_version string, rapid_beta_version string, release_name string")
    repos = spark.createDataFrame([("main",)], "repository string")
    specials = spark.createDataFrame(
        [("arm", "main", "nightly", "atlas", "Pocket", "15.0")],
        "platform string, repository string, release_channel string, release_name string, "
        "product_name string, min_version string")
    args = (releases, products, repos, specials)
    v, b = dims.update_product_versions(*args, None, None, "2024-01-20", 30, (("Atlas", "Runtime"),))
    got = {(r["product_name"], r["version_string"]): r for r in v.collect()}
    assert set(got) == {("Atlas", "12.0"), ("Atlas", "12.0esr"), ("Atlas", "13.0b"), ("Atlas", "13.0b1"),
                        ("Atlas", "13.0b2"), ("Atlas", "15.0a1"), ("Pocket", "15.0a1"), ("Runtime", "15.0a1")}
    parent, child = got["Atlas", "13.0b"], got["Atlas", "13.0b2"]
    assert parent["is_rapid_beta"] and child["rapid_beta_id"] == parent["product_version_id"]
    assert child["sunset_date"] == parent["sunset_date"] == dt.date(2024, 1, 6) + dt.timedelta(weeks=9)
    assert got["Atlas", "12.0esr"]["build_type"] == "ESR"
    assert b.join(v.where("is_rapid_beta"), "product_version_id").isEmpty() and b.count() == 7
    v2, b2 = dims.update_product_versions(*args, v, b, "2024-01-20", 30, (("Atlas", "Runtime"),))
    assert v2.isEmpty() and b2.isEmpty()


def test_hang_pairs_need_user_info_of_the_day(spark):
    t = dt.datetime(2024, 1, 1, 12)
    cols = "uuid string, date_processed timestamp, process_type string, signature string, hang_id string, " \
           "product_version_id string, flash_version string, duplicate_of string"
    clean = spark.createDataFrame([
        ("b1", t, "browser", "hang | x", "h", "v", "f", "d2"), ("b2", t, "browser", "hang | w", "h", "v", "f", None),
        ("b3", t, "browser", "other", "h", "v", "f", None), ("p1", t, "plugin", "p", "h", "v", "f", "d1"),
        ("p2", t, "plugin", "p", "h2", "v", "f", None), ("b4", t, "browser", "hang | q", "h2", "v", "f", None)], cols)
    info = spark.createDataFrame([("b1", t, "u9"), ("b2", t, "u1")], "uuid string, date_processed timestamp, url string")
    rows = hangs.daily_hangs(clean, info).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["uuid"], r["plugin_uuid"], r["url"], r["duplicates"]) == ("b1", "p1", "u1", ["d1", "d2"])
    assert r["browser_signature"] == "hang | w"


def test_paired_uuid(spark):
    day = dt.datetime(2024, 1, 5, 3)
    ids = [f"0000000{i}-0000-4000-8000-000002240105"[:29] + "2240105" for i in range(3)]
    clean = spark.createDataFrame([(ids[0], "h", day), (ids[1], "h", day), (ids[2], None, day)],
                                  "uuid string, hang_id string, date_processed timestamp")
    assert [r["uuid"] for r in hangs.paired_uuid(clean, ids[0]).collect()] == [ids[1]]
    assert hangs.paired_uuid(clean, ids[2]).isEmpty()


def test_ranks_with_ties(spark):
    df = spark.createDataFrame([("g", s, n) for s, n in zip("abcde", [5, 3, 3, 1, 1])], "g string, s string, n long")
    dense = {r["s"]: (r["r"], r["t"]) for r in common.dense_rank_by(df, ["g"], "n", "r", "t").collect()}
    assert dense == {"a": (1, 13), "b": (2, 13), "c": (2, 13), "d": (3, 13), "e": (3, 13)}
    rank = {r["s"]: r["r"] for r in common.rank_by(df, ["g"], "n", "r", "t").collect()}
    assert rank == {"a": 0, "b": 1, "c": 1, "d": 3, "e": 3}


def test_carry_down_over_chunks(spark):
    df = spark.createDataFrame([("g", i, "h" + str(i) if i in (0, 4, 11) else None) for i in range(15)],
                               "g string, n long, v string")
    rows = common.carry_down(df, "g", "n", {"h": F.col("v")}, chunk=3).collect()
    assert {r["n"]: r["h"] for r in rows} == {i: "h0" if i < 4 else "h4" if i < 11 else "h11" for i in range(15)}


@pytest.mark.parametrize("listed,expected", [
    ([], {"a", "b", None}), (["a"], {"b"}), (["a", None], set())])
def test_not_in_with_nulls(spark, listed, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "e string")
    l = spark.createDataFrame([(x,) for x in listed], "x string")
    assert {r["e"] for r in campaigns.not_in(df, "e", l).collect()} == expected


def test_daily_crashes_hang_counts(spark, events):
    rows = graphs.daily_crashes(events.clean, events.pv, events.t("os_names"))
    coded = rows.where("report_type <> 'H'").agg(F.sum("count")).first()[0]
    assert coded <= events.clean.count()
    assert {r[0] for r in rows.select("os_short_name").distinct().collect()} == {"Win", "Mac", "Lin"}


def test_correlation_report_lines(spark):
    text = ["Windows NT", "  a|b::c(int)|EXC_X (27 crashes)", "    99% (6026/6058) vs.   6% (6245/102490) x.dll",
            "    66% (4010/6058) vs.  20% (20236/102490) y.dll", "", "  plain", "    50% (1/2) vs.  10% (1/10) z.dll",
            "Mac OS X", "  sig|KERN", "    70% (7/10) vs.   1% (1/100) lib one.dylib"]
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate(text)], "report string, line_number long, line string")
    rows = correlations.parse_correlation_report(df).orderBy("line_number").collect()
    got = [(r["platform"], r["signature"], r["reason"], r["crash_count"], r["percent"], r["module"]) for r in rows]
    assert got == [("Windows NT", "b::c(int)", "EXC_X", 27, 99, "x.dll"), ("Windows NT", "b::c(int)", "EXC_X", 27, 66, "y.dll"),
                   ("Windows NT", "plain", "UNKNOWN", -1, 50, "z.dll"), ("Mac OS X", "sig", "KERN", -1, 70, "lib one.dylib")]


def test_users_are_not_multiplied_by_types(events):
    roll = users.crashes_by_user_rollup(events.cbu, events.t("crash_types"))
    once = events.cbu.groupBy("product_version_id", "report_date", "os_short_name").agg(F.max("adu").alias("m"))
    assert roll.agg(F.sum("adu")).first()[0] == once.agg(F.sum("m")).first()[0]
