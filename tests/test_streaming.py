import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import Row, functions as F

from crashlake.operators import duplicates
from crashlake.operators.clean import build_reports_clean
from crashlake.operators.status import submission_counters, under_performing
from crashlake.streaming import jobs, states, windows
from crashlake.streaming.replay import drain, heartbeat, replay, stream_folder


@pytest.fixture(scope="module")
def stored(events, tmp_path_factory):
    """Reports in three files by time, and the frame that was written."""
    path = str(tmp_path_factory.mktemp("stream") / "reports")
    r = events.t("reports").where("report_date <= '2024-01-12'").withColumn(
        "legacy_processing", F.col("k") % 3)
    for part in ("report_date < '2024-01-05'", "report_date BETWEEN '2024-01-05' AND '2024-01-08'",
                 "report_date > '2024-01-08'"):
        r.where(part).coalesce(1).write.mode("append").parquet(path)
    return path, r


def stream(spark, path):
    batch = spark.read.parquet(path)
    return (spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path), batch)


def run(df, name, mode):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(*a.columns).collect()))


def test_counters(spark, stored):
    s, b = stream(spark, stored[0])
    kinds = b.withColumn("submitted_timestamp", F.col("date_processed"))
    beaten = replay(kinds, "counted", "submitted_timestamp", batches=3)
    got = drain(states.rolled_counters(beaten, late="60 days"), "counters").where("period < '2100'")
    same(got, submission_counters(kinds))


def test_sliding_counts(spark, stored):
    s, b = stream(spark, stored[0])
    make = lambda df: jobs.recent_counts(df, 30, "product", "date_processed", "uptime")
    same(run(make(s), "k2", "complete").drop("mean_duration"), make(b).drop("mean_duration"))
    n = spark.createDataFrame([("a", 10), ("b", 10), ("c", 1)], "m string, n int")
    assert [r["m"] for r in under_performing(n, "m", "n").collect()] == ["c"]


class Handle:
    """Stands for the engine: one key's document and timers, and the watermark."""

    def __init__(self, processor):
        self.at, self.value, self.timers = 0, None, set()
        processor.init(self)

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def listTimers(self):
        return iter(list(self.timers))

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)

    def getCurrentWatermarkInMs(self):
        return self.at


def feed(processor, batches):
    """Batches of (watermark minute, rows) -> everything a key gives; timers fire between batches."""
    handle, out = Handle(processor), []
    for until, rows in batches:
        handle.at = until * states.MINUTE_MS
        if rows:
            out += processor.handleInputRows(("p",), iter([Row(**r) for r in rows]), handle)
        elif any(t <= handle.at for t in handle.timers):
            out += processor.handleExpiredTimer(("p",), handle, None)
    return out, handle


@pytest.mark.parametrize("width", [1, 7, 40])
def test_lagging_members_at_every_minute(width):
    """Silent members, idle stretches, late joiners: the batch rule at each minute, whatever the batches."""
    rng = random.Random(width)
    rows = [(rng.choice([m, m, 500 + m % 37, 900]), rng.choice("abcde" if m > 100 else "abc")) for m in range(300)]
    counts = Counter(rows)
    want = []
    for end in range(min(m for m, _ in rows) + 1, 1500):
        pool = {k for m, k in rows if m < end}
        n = {k: sum(c for (m, who), c in counts.items() if who == k and end - width <= m < end) for k in pool}
        s, q = sum(n.values()), sum(x * x for x in n.values())
        want += [(end, k, x) for k, x in n.items() if s - len(n) * x > 0 and (s - len(n) * x) ** 2 > len(n) * q - s * s]
    for cut in (1, 60, 400, 2000):
        batches = []
        for low in range(0, 1500, cut):
            batches.append((low + cut, [{"minute": m, "member": k, "n": c} for (m, k), c in counts.items() if low <= m < low + cut]))
        got, handle = feed(states._Pool(width), [*batches, (3000, [])])
        assert sorted((r["end"], r["member"], r["count"]) for r in got) == sorted(want)
        assert not json.loads(handle.value[0])["counts"] and not handle.timers
    assert want


def test_periods_come_out_once_when_they_are_over():
    start = states._number(dt.datetime(2023, 12, 31, 23, 58))
    rows = [{"minute": start + i, "n": i + 1} for i in range(4)]
    got, handle = feed(states._Periods(), [(start + 1, rows[:1]), (start + 2, rows[1:2]), (start + 3, rows[2:]), (start + 4, []), (start + 60, [])])
    shown = {r["period"]: r["count"] for r in got}
    assert len(shown) == len(got)
    assert shown == {"2023-12-31T23:58": 1, "2023-12-31T23:59": 2, "2023-12-31T23": 3, "2023-12-31": 3, "2023-12": 3, "2023": 3,
                     "2024-01-01T00:00": 3, "2024-01-01T00:01": 4}
    assert len(handle.timers) == 1 and set(json.loads(handle.value[0])) == {"2024-01-01T00", "2024-01-01", "2024-01", "2024"}


def test_continuous_transform_and_throttle(spark, tmp_path):
    src = tmp_path / "raw"
    src.mkdir()
    for i in range(3):
        (src / f"{i}.json").write_text(json.dumps({
            "uuid": f"0000000{i}-0000-4000-8000-000002240105"[:29] + "2240105", "ProductName": "A", "Version": "1.0",
            "ReleaseChannel": "esr" if i else "release", "submitted_timestamp": "2024-01-05T10:00:00",
            "dump": "Crash|X|0x0|0\n\n0|0|m|fn|||0x1"}))
    from crashlake.sources.raw import raw_from_json, read_json_stream
    lines = spark.read.text(str(src))
    make = lambda raw: jobs.processed(jobs.throttled(raw, [("ReleaseChannel", "esr", 100)])) \
        .select("uuid", "version", "signature", "legacy_processing")
    got = run(make(read_json_stream(spark, str(src), 1)), "k4", "append")
    same(got, make(raw_from_json(lines)))
    assert {(r["version"], r["legacy_processing"]) for r in got.collect()} == {("1.0", 1), ("1.0esr", 0)}


def test_late_and_repeated_ids(spark, stored, tmp_path):
    path = str(tmp_path / "twice")
    _, r = stored
    r.coalesce(1).write.mode("append").parquet(path)
    r.where("report_date = '2024-01-12'").coalesce(1).write.mode("append").parquet(path)
    s, _ = stream(spark, path)
    got = run(jobs.first_seen_only(s, late="20 days").select("uuid"), "k6", "append")
    assert got.count() == r.count() == got.distinct().count()


def test_hang_sides(spark):
    """One row a plugin report, paired or not; browser sides are the least of the day; a hot hang gives no pairs of pairs."""
    day = dt.datetime(2024, 1, 3, 12)
    side = lambda i, hang, kind, t=day, sig="hang | x": (i, t, hang, kind, sig, "11", "v1")
    rows = [side("b2", "h1", "browser"), side("b1", "h1", "Browser", sig="hang | a"), side("p1", "h1", "plugin"), side("p2", "h1", "PLUGIN"),
            side("p3", "h2", "plugin"), side("b3", "h3", "browser"), side("p4", "h3", "plugin", day + dt.timedelta(days=1)),
            side("b4", "h4", "browser", sig="no hang"), side("p5", "h4", "plugin"), side("b5", "h5", "browser"), side("p6", "h5", "plugin"),
            side("p7", "", "plugin"), side("p8", None, "plugin")] + [side(f"c{i}", "h6", "browser") for i in range(60)] + [side(f"q{i}", "h6", "plugin") for i in range(80)]
    clean = spark.createDataFrame(rows, "uuid string, date_processed timestamp, hang_id string, process_type string, signature string, flash_version string, product_version_id string")
    info = clean.where("uuid <> 'b5'").select("uuid", "date_processed", F.concat(F.lit("u"), "uuid").alias("url"))
    out = drain(windows.hang_sides(replay(clean, "c", "date_processed", 2), replay(info, "i", "date_processed", 2), "60 days", salts=3), "sides")
    got = Counter((r.plugin_uuid, r.browser_uuid, r.browser_signature, r.url) for r in out.collect())
    want = [("p1", "b1", "hang | a", "ub1"), ("p2", "b1", "hang | a", "ub1")] + [(p, None, None, None) for p in ("p3", "p4", "p5", "p6")]
    assert got == Counter(want + [(f"q{i}", "c0", "hang | x", "uc0") for i in range(80)])


def test_hang_sides_keep_state_on_disk(spark, tmp_path):
    """No store of the chain is one of the executors' heap, which all user-info rows of a period would have to fit."""
    for name in ("stateStore.providerClass", "join.stateFormatVersion"):
        spark.conf.unset(f"spark.sql.streaming.{name}")
    rows = [("b", dt.datetime(2024, 1, 3), "h", "browser", "hang | x", "11", "v"), ("p", dt.datetime(2024, 1, 3), "h", "plugin", "hang | x", "11", "v")]
    clean = spark.createDataFrame(rows, "uuid string, date_processed timestamp, hang_id string, process_type string, signature string, flash_version string, product_version_id string")
    info = clean.select("uuid", "date_processed", F.lit("u").alias("url"))
    sides = windows.hang_sides(replay(clean, "c", "date_processed", 1), replay(info, "i", "date_processed", 1), "1 day", salts=2)
    query = (sides.writeStream.format("parquet").option("path", str(tmp_path / "rows")).option("checkpointLocation", str(tmp_path / "checkpoint"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    stores = {o.operatorName: dict(o.customMetrics) for o in query.lastProgress.stateOperators}
    assert len(stores) == 2 and all(any(name.startswith("rocksdb") for name in m) for m in stores.values())
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "rows")).select("plugin_uuid", "browser_uuid", "url").collect()] == [("p", "b", "u")]


def test_duplicates_whatever_the_batches(spark, stored):
    """Batches in the order of time with little delay, and batches of all times at once: the links of the whole table."""
    path, _ = stored
    _, b = stream(spark, path)
    near = b.where("report_date <= '2024-01-06'")
    copies = near.withColumn("uuid", F.explode(F.array(F.col("uuid"), F.concat(F.lit("c"), "uuid"))))
    want = duplicates.find_duplicates_sliding(copies).select("uuid", "duplicate_of", "date_processed")
    mixed = drain(windows.duplicate_links(replay(copies, "mixed", "date_processed", 2), "60 days", salts=2), "links")
    same(windows.first_links(mixed).select(*want.columns), want)
    folder = stream_folder(spark, "ordered")
    for day in (("2024-01-01", "2024-01-03"), ("2024-01-04", "2024-01-05"), ("2024-01-06", "2024-01-06")):
        copies.where(F.col("report_date").between(*day)).coalesce(1).write.mode("append").parquet(folder)
    heartbeat(copies, "date_processed", "2024-03-01").write.mode("append").parquet(folder)
    ordered = spark.readStream.schema(copies.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    same(windows.first_links(drain(windows.duplicate_links(ordered, "1 hour", salts=2), "links")).select(*want.columns), want)
    assert not want.isEmpty()


def test_small_groups_are_not_dealt_to_all_salts(spark):
    """A leader meets the salts that its group's rows have, and no others."""
    rows = spark.range(300).select(F.when(F.col("id") < 200, 0).otherwise(F.col("id")).alias("key"), F.col("id").cast("string").alias("uuid"))
    rows = rows.unionByName(rows.where("key > 0").withColumn("uuid", F.concat(F.lit("c"), "uuid"))).withColumn("_salt", windows._salt(16))
    leaders = windows._dealt(rows.groupBy("key").agg(windows._bits(F.col("_salt")).alias("_bits")), 16)
    got = [tuple(r) for r in leaders.select("key", "_salt").collect()]
    assert sorted(got) == sorted(tuple(r) for r in rows.select("key", "_salt").distinct().collect())
    assert len([k for k, _ in got if k == 0]) == 16 and len(got) <= 16 + 2 * 100


def test_hourly_append_is_idempotent(spark, events, stored, tmp_path):
    path, _ = stored
    s, b = stream(spark, path)
    paths = [str(tmp_path / n) for n in ("clean", "info", "bad")]
    for attempt in ("one", "two"):  # the second run sees every report again
        jobs.append_clean(s, events.dims, *paths, str(tmp_path / attempt)).awaitTermination()
    want = build_reports_clean(b, events.dims)
    clean = spark.read.parquet(paths[0])
    assert clean.count() == want.clean.count() == clean.select("uuid").distinct().count()


def test_a_batch_is_dealt_over_the_cluster(spark):
    """Files, and so tasks that write and read, grow with the partitions of the shuffles, batches do not."""
    rows = spark.range(1000).select(F.col("id").cast("string").alias("uuid"), F.timestamp_seconds("id").alias("ts"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "10")
        made = replay(rows, "dealt", "ts", batches=3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    folder = spark._jvm.org.apache.hadoop.fs.Path(stream_folder(spark, "x")).getParent()
    dealt = [f.getPath() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder) if f.getPath().getName().startswith("dealt-")]
    files = spark.read.schema(rows.schema).parquet(*[str(p) for p in dealt])
    assert len(files.inputFiles()) == 12 + 1
    query = made.writeStream.format("memory").queryName("dealt").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("dealt").count() == 1001 and len([p for p in query.recentProgress if p["numInputRows"]]) == 4  # and the heartbeat


def test_a_second_stream_with_other_batches_loses_nothing(spark, events, stored, tmp_path):
    """Its first batch holds a part of the first one's and more: stored rows stay."""
    _, r = stored
    days = [("2024-01-01", "2024-01-04"), ("2024-01-05", "2024-01-12")], [("2024-01-03", "2024-01-12"), ("2024-01-01", "2024-01-02")]
    paths = [str(tmp_path / n) for n in ("clean", "info", "bad")]
    for i, order in enumerate(days):
        for low, high in order:
            r.where(F.col("report_date").between(low, high)).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{i}"))
        jobs.append_clean(stream(spark, str(tmp_path / f"in{i}"))[0], events.dims, *paths, str(tmp_path / f"run{i}")).awaitTermination()
    want = build_reports_clean(r, events.dims)
    for path, df in zip(paths, (want.clean, want.user_info, want.bad)):
        assert sorted(x.uuid for x in spark.read.parquet(path).select("uuid").collect()) == sorted(x.uuid for x in df.select("uuid").collect())
