import datetime as dt
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crashlake.operators import bugs, extract
from crashlake.operators.counts import uptime_level
from crashlake.sources import exports, feeds, raw, tables


def test_weekly_round_trip(events, tmp_path):
    r = events.t("reports")
    path = str(tmp_path / "facts")
    tables.write_weekly(r, path)
    back = tables.read_weekly(events.spark, path, "2024-01-08", "2024-01-14")
    assert {str(x[0]) for x in back.select("week").distinct().collect()} == {"2024-01-08"}
    assert back.count() == r.where("report_date BETWEEN '2024-01-08' AND '2024-01-14'").count()
    n = r.count()
    tables.write_weekly(r.where("report_date = '2024-01-30'"), path, mode="overwrite")
    whole = events.spark.read.parquet(path)
    assert whole.count() == n - r.where("report_date >= '2024-01-29'").count() \
        + r.where("report_date = '2024-01-30'").count()
    assert tables.apply_retention(events.spark, path, "2024-01-15") == 2
    assert events.spark.read.parquet(path).agg(F.min("week")).first()[0] == dt.date(2024, 1, 15)


def test_processed_signatures(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", None, t), ("b", "", t), ("c", "s", t)],
                               "uuid string, signature string, date_processed timestamp")
    tables.write_processed(df, str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    assert {r["signature"] for r in stored.collect()} == {"##null##", "##empty##", "s"}
    assert {r["uuid"]: r["signature"] for r in tables.loaded_signature(stored).collect()} == \
        {"a": None, "b": "", "c": "s"}


def write(path: Path, text: str) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_release_files(spark, tmp_path):
    root = tmp_path / "ftp" / "atlas"
    write(root / "candidates/10.0b4-candidates/build1/linux_info.txt", "buildID=20120516114455\n")
    write(root / "candidates/10.0b4-candidates/build2/linux_info.txt", "x=1\nbuildID=20120516113045\n")
    write(root / "nightly/10.0-candidates/build1/win32_info.txt", "buildID=20120101000000")
    write(root / "nightly/2012/05/2012-05-23-03-00-00-main-line/atlas-15.0a1.en-US.linux.txt", "20120523030000\nabc\n")
    write(root / "nightly/2012/05/2012-05-23-03-00-00-side/atlas-14.0a2.multi.arm.txt", "20120523030001\nabc\n")
    write(root / "nightly/2012/05/2012-05-23-03-00-00-side/readme.txt", "nothing")
    rows = {tuple(r) for r in feeds.load_releases(spark, str(tmp_path / "ftp")).collect()}
    assert rows == {
        ("atlas", "10.0", "linux", 20120516113045, "Beta", 4, "beta"),
        ("atlas", "10.0", "win32", 20120101000000, "Release", None, "release"),
        ("atlas", "15.0a1", "linux", 20120523030000, "Nightly", None, "main-line"),
        ("atlas", "14.0a2", "arm", 20120523030001, "Aurora", None, "side")}


def test_csv_feeds(spark, tmp_path):
    adu = write(tmp_path / "adu.csv", "adu_count,date,product_name,product_os_platform,product_os_version,"
                "product_version,build,build_channel,product_guid\n17,2012-06-15 00:00:00,Atlas,Linux,,1.0,20120615000001,release,{a}\n")
    row = feeds.load_raw_adu(spark, adu).first()
    assert (row["adu_count"], row["adu_date"]) == (17, dt.date(2012, 6, 15))
    levels = write(tmp_path / "levels.csv", "uptime_level,uptime_string,min_uptime,max_uptime\n"
                   "1,< 1 min,00:00:00,00:01:00\n5,> 1 hour,01:00:00,1 year\n")
    lv = feeds.load_lookup(spark, "uptime_levels", levels)
    assert [(r["min_uptime"], r["max_uptime"]) for r in lv.collect()] == [(0, 60), (3600, 31557600)]
    df = spark.createDataFrame([(59,), (60,), (3600,)], "uptime int")
    assert [r["uptime_level"] for r in uptime_level(df, lv).collect()] == [1, 5]
    mods = write(tmp_path / "m.csv", "filename,debug_file,debug_id,module_version,product,version,os_name,reason\na,b,c,1,P,2,W,R\n")
    assert feeds.load_modules(spark, mods).first()["module_version"] == "1"
    with pytest.raises(ValueError):
        feeds.load_lookup(spark, "nothing", mods)


def test_bug_feed(spark, tmp_path):
    path = write(tmp_path / "bugs.csv", 'bug_id,bug_status,resolution,short_desc,cf_crash_signature\n'
                 '5,RESOLVED,WONTFIX,"said ""no""","[@ legitimate(sig)]"\n6,NEW,,free text,""\n'
                 '7,NEW,,two,"[@ one]\n[@ unseen ]"\n8,NEW,,useless,[@ unseen]\n')
    feed = feeds.load_bugs(spark, path)
    old = spark.createDataFrame([(5, "NEW", "", "x"), (6, "NEW", "", "y"), (9, "OLD", "", "z")],
                                "bug_id long, status string, resolution string, short_desc string")
    assoc = spark.createDataFrame([(5, "stale"), (6, "one"), (9, "keep")], "bug_id long, signature string")
    reports = spark.createDataFrame([("legitimate(sig)",), ("one",)], "signature string")
    new_bugs, new_assoc = bugs.update_bug_associations(feed, old, assoc, reports)
    assert {r["bug_id"]: r["status"] for r in new_bugs.collect()} == {5: "RESOLVED", 7: "NEW", 9: "OLD"}
    assert {(r["bug_id"], r["signature"]) for r in new_assoc.collect()} == \
        {(5, "legitimate(sig)"), (7, "one"), (9, "keep")}


def test_daily_extract_files(events, tmp_path):
    none = events.spark.createDataFrame([], "uuid string, duplicate_of string")
    assoc = events.spark.createDataFrame([], "signature string, bug_id long")
    day = dt.date(2024, 1, 5)
    df = extract.daily_extract(events.t("reports"), none, assoc, events.t("raw_adu"), day)
    paths = exports.write_daily_extract(df, day, str(tmp_path / "private"), str(tmp_path / "public"))
    assert [Path(p).name for p in paths] == ["20240105-crashdata.csv.gz", "20240105-pub-crashdata.csv.gz"]

    def lines(path):
        out = []
        for f in sorted(Path(path).glob("*.csv.gz")):
            out += gzip.open(f, "rt").read().splitlines()
        return out
    private, public = lines(paths[0]), lines(paths[1])
    n = events.t("reports").where("report_date = '2024-01-05'").count()
    assert private[0].split("\t") == list(extract.EXTRACT_COLUMNS)
    assert sum(not line.startswith("signature\turl") for line in private) == n
    assert "host" in "".join(private) and "example.org/p" not in "".join(public)
    assert all("URL (removed)" in line for line in public if not line.startswith("signature\turl"))
    empty = extract.daily_extract(events.t("reports"), none, assoc, events.t("raw_adu"), dt.date(2020, 1, 1))
    path = exports.write_daily_extract(empty, dt.date(2020, 1, 1), str(tmp_path / "private"))[0]
    assert lines(path) == []


def test_samples_and_exports(events, tmp_path):
    r = events.t("reports").withColumn("submit_date", F.col("report_date"))
    one = [x["uuid"] for x in raw.sample_crashes(r, 20, ["2024-01-03"], seed=1).collect()]
    assert one == [x["uuid"] for x in raw.sample_crashes(r.repartition(3), 20, ["2024-01-03"], seed=1).collect()]
    assert one != [x["uuid"] for x in raw.sample_crashes(r, 20, ["2024-01-03"], seed=2).collect()]
    exports.export_days(r.select("uuid", "date_processed"), 3, str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").glob("day=*")} == {f"day=2024-01-{d}" for d in (28, 29, 30)}
    ids = r.where("report_date = '2024-01-09'").select("uuid").limit(5)
    assert raw.export_for_ids(r, ids).count() == 5
    uid = ids.first()["uuid"]
    assert raw.get_crash(r, uid, day="submit_date").count() == 1
    assert raw.prefix_range("1202") == (dt.date(2012, 2, 1), dt.date(2012, 2, 29))
    with pytest.raises(ValueError):
        raw.prefix_range("x")


def test_mover_and_bad_json(spark, tmp_path):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    write(src / "a.json", '{"uuid":"u1","submitted_timestamp":"2024-01-01T10:00:00","Product":"A","dump":"d"}\n{bad json\n')
    raw.move_raw(spark, str(src), dst, str(tmp_path / "ck")).awaitTermination()
    rows = {r["uuid"]: r for r in spark.read.parquet(dst).collect()}
    assert rows["u1"]["raw"] == {"Product": "A"} and rows[None]["raw"] == {}
    write(src / "b.json", '{"uuid":"u2","submitted_timestamp":"2024-01-02T10:00:00"}\n')
    raw.move_raw(spark, str(src), dst, str(tmp_path / "ck")).awaitTermination()
    assert sorted(str(r["uuid"]) for r in spark.read.parquet(dst).collect()) == ["None", "u1", "u2"]


def test_mini_copy(events, tmp_path):
    out = tables.mini_copy({"tcbs": events.tcbs, "reports_bad": events.cleaned.bad, "os_names": events.t("os_names")},
                           "2024-01-20")
    tables.write_copy(out, str(tmp_path))
    read = lambda n: events.spark.read.parquet(str(tmp_path / n))
    assert read("tcbs").agg(F.min("report_date")).first()[0] == dt.date(2024, 1, 20)
    assert read("reports_bad").isEmpty() and read("os_names").count() == 3
