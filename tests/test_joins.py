"""Interval and pattern joins against nested loops in plain Python."""
import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from crashlake.functions.platforms import ilike_map
from crashlake.operators import patterns
from crashlake.operators.counts import uptime_level
from crashlake.operators.intervals import interval_join
from crashlake.operators.patterns import ilike_join


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def no_loop(df):
    return not any(bad in plan(df) for bad in ("NestedLoop", "Cartesian"))


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("scale,kind", [(1, "int"), (10 ** 15, "long"), (0.37, "double"), (0.01, "decimal(20,4)")])
def test_interval_join(spark, scale, kind, closed):
    """Lengths from nothing to all, negative bounds, overlaps, copies and NULLs; numbers of all kinds."""
    rng = random.Random(5)
    spread = lambda: rng.choice([rng.randint(-40, 40), rng.randint(-2000, 2000)])
    points = [(i, float(spread() * scale)) for i in range(300)] + [(900 + i, float(7 * scale)) for i in range(200)] + [(-1, None)]
    spans = [(i, float((a := spread()) * scale), float((a + rng.choice([-3, 0, 1, 5, 64, 3000])) * scale)) for i in range(400)]
    spans += [(-1, None, float(3 * scale)), (-2, float(scale), None)]
    p = spark.createDataFrame(points, "p long, x double").withColumn("x", F.col("x").cast(kind))
    s = spark.createDataFrame(spans, "s long, a double, b double").withColumns({c: F.col(c).cast(kind) for c in "ab"})
    got = interval_join(p, s, "x", "a", "b", closed=closed)
    pts, sps = p.collect(), s.collect()
    want = Counter((q.p, t.s) for q in pts for t in sps if None not in (q.x, t.a, t.b) and t.a <= q.x and (q.x <= t.b if closed else q.x < t.b))
    assert Counter((r.p, r.s) for r in got.collect()) == want and want
    assert no_loop(got)
    left = interval_join(p, s, "x", "a", "b", closed=closed, how="left")
    lone = {q.p for q in pts} - {k for k, _ in want}
    assert Counter((r.p, r.s) for r in left.collect()) == want + Counter((k, None) for k in lone)


def test_interval_join_of_times_days_and_keys(spark):
    rng = random.Random(6)
    start = dt.datetime(2024, 1, 1)
    points = [(i, i % 3, start + dt.timedelta(seconds=rng.randint(0, 86400 * 9))) for i in range(300)]
    spans = [(i, i % 4, (a := start + dt.timedelta(seconds=rng.randint(0, 86400 * 9))), a + dt.timedelta(seconds=rng.choice([0, 60, 7200, 86400 * 5]))) for i in range(150)]
    p = spark.createDataFrame(points, "p long, k int, t timestamp")
    s = spark.createDataFrame(spans, "s long, k int, a timestamp, b timestamp")
    got = Counter((r.p, r.s) for r in interval_join(p, s, "t", "a", "b", keys=("k",)).collect())
    assert got == Counter((q[0], x[0]) for q in points for x in spans if q[1] == x[1] and x[2] <= q[2] < x[3]) and got
    day = lambda df, *c: df.withColumns({n: F.to_date(n) for n in c})
    got = Counter((r.p, r.s) for r in interval_join(day(p, "t"), day(s, "a", "b"), "t", "a", "b", keys=("k",), closed=True).collect())
    assert got == Counter((q[0], x[0]) for q in points for x in spans if q[1] == x[1] and x[2].date() <= q[2].date() <= x[3].date())
    assert interval_join(p, s.limit(0), "t", "a", "b", ("k",)).isEmpty() and interval_join(p.limit(0), s, "t", "a", "b", ("k",)).isEmpty()
    with pytest.raises(ValueError):
        interval_join(p, s, "t", "a", "b", how="full")


def test_interval_join_of_odd_doubles(spark):
    inf, nan = float("inf"), float("nan")
    p = spark.createDataFrame([(i, x) for i, x in enumerate([0.0, -0.0, inf, -inf, nan, 1e300, -1e300, 0.5])], "p long, x double")
    s = spark.createDataFrame([(0, -inf, inf), (1, 0.0, 1.0), (2, 1e299, inf), (3, -inf, -1e299), (4, 0.0, nan)], "s long, a double, b double")
    loop = p.join(s, (F.col("x") >= F.col("a")) & (F.col("x") < F.col("b")))
    assert Counter((r.p, r.s) for r in interval_join(p, s, "x", "a", "b").collect()) == Counter((r.p, r.s) for r in loop.collect())


@pytest.mark.parametrize("n", [3, 40, 700])
def test_levels_give_the_same_rows_at_any_size(spark, n):
    """Short, long, apart and overlapping level tables: the rows of a range join."""
    p = spark.createDataFrame([(i, (i * 37) % 2100) for i in range(400)], "p long, uptime int")
    for apart in (True, False):
        rows = [(i, i * 3, i * 3 + (3 if apart else 5)) for i in range(n)]
        levels = spark.createDataFrame(rows, "uptime_level long, min_uptime int, max_uptime int")
        got = Counter((r.p, r.uptime_level) for r in uptime_level(p, levels).collect())
        assert got == Counter((i, k) for i in range(400) for k, a, b in rows if a <= (i * 37) % 2100 < b)


def fits(text, like):
    out, i = "", 0
    while i < len(like):
        if like[i] == "\\":
            i += 1
            out += re.escape(like[i])
        else:
            out += {"%": ".*", "_": "."}.get(like[i]) or re.escape(like[i])
        i += 1
    return re.fullmatch(out, text, re.S | re.I) is not None


TEXTS = ["", "a", "ab", "Abc", "abcd", "ABCABC", "50% off", "a_b", "windows nt 5.1", "Windows 7", "x\ny", "aaaaaaaa", "ümlaut", "back\\slash"]
LIKES = ["%", "", "_", "__", "_%", "%__%", "a", "A%", "%b", "%BC%", "a%b", "%a_c%", "abc", r"50\% off", r"a\_b", "windows%", "%nt%", "%5.%1", "x_y",
         "aaa%aaa", "%Mlaut", r"%\\%", "zzz%", "%c%b%"]


def test_pattern_join(spark):
    t = spark.createDataFrame([(i, x) for i, x in enumerate(TEXTS * 2)] + [(-1, None)], "t long, name string")
    r = spark.createDataFrame([(i, x) for i, x in enumerate(LIKES + ["%BC%"])] + [(-1, None)], "r long, likes string")
    got = ilike_join(t, r, "name", "likes")
    want = Counter((i, j) for i, x in enumerate(TEXTS * 2) for j, y in enumerate(LIKES + ["%BC%"]) if fits(x, y))
    assert Counter((x.t, x.r) for x in got.collect()) == want
    assert no_loop(got) and got.columns == ["t", "name", "r", "likes"]
    assert ilike_join(t, r.limit(0), "name", "likes").isEmpty() and ilike_join(t.limit(0), r, "name", "likes").isEmpty()


def test_thousands_of_patterns(spark):
    """Hot texts, a common beginning in every pattern, and the smallest value where several fit."""
    rng = random.Random(3)
    names = ["http://host/" + "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    t = spark.createDataFrame([(i, names[i % 300] if i % 3 else names[0]) for i in range(1200)], "t long, name string")
    likes = sorted({"HTTP://host/%" + "".join(rng.choice("abcdef") for _ in range(rng.randint(1, 4))) + rng.choice(["", "%"]) for _ in range(2000)})
    r = spark.createDataFrame([(f"v{i % 90:02d}", x) for i, x in enumerate(likes)], "value string, match_string string")
    assert len(likes) > 500
    got = {x.t: x.out for x in ilike_map(t, r, "name", "value", "out").collect()}
    want = {}
    for i, row in enumerate(t.collect()):
        want[row.t] = min((f"v{j % 90:02d}" for j, y in enumerate(likes) if fits(row.name, y)), default=None)
    assert got == want and len(set(want.values())) > 5
    assert no_loop(ilike_map(t, r, "name", "value", "out"))


def test_registered_joins_have_no_nested_loop(spark):
    import __spark_entry__ as entry_points
    queries = entry_points.queries()
    for name in ("c4_pattern_join", "c5_interval_join", "c6_lifetime_join"):
        assert no_loop(queries[name](spark, "/root/testdata/sf0.001")), name


def test_pairs_of_patterns_are_not_broadcast(spark):
    """Repeated texts shrink on disk to less than a broadcast may have, and grow in the driver again."""
    t = spark.createDataFrame([(i, f"http://host/{i % 90:03d}/x") for i in range(900)], "t long, name string")
    r = spark.createDataFrame([(i, f"%/{i % 45:03d}/%") for i in range(200)], "r long, likes string")
    got = ilike_join(t, r, "name", "likes")
    text = plan(got)
    assert got.count() == sum(1 for i in range(900) for j in range(200) if i % 90 == j % 45)
    joins = [line for line in text.split("== Initial Plan ==")[0].splitlines() if "BroadcastHashJoin" in line]
    assert not any(key in line for line in joins for key in ("_text", "_like")) and not any("_gram" in line and "Inner" in line for line in joins)


def test_grams_that_no_pattern_is_looked_up_by_are_not_moved(spark, monkeypatch):
    """Of a text of 30 grams the one that decides meets the patterns, and none of a text that fits none."""
    moved, plain = [], patterns._looked_up

    def looked_up(held, keys):
        out = plain(held, keys)
        moved.append((held.count(), out.count()))
        return out

    monkeypatch.setattr(patterns, "_looked_up", looked_up)
    names = [f"common beginning of {i:05d} and the end" for i in range(600)]
    t = spark.createDataFrame(list(enumerate(names)), "t long, name string")
    r = spark.createDataFrame([(i, f"common beginning OF {i:05d}%") for i in range(100)], "r long, likes string")
    got = ilike_join(t, r, "name", "likes")
    assert sorted((x.t, x.r) for x in got.collect()) == [(i, i) for i in range(100)] and no_loop(got)
    assert moved[0][0] > 15000 and moved[0][1] <= 1000


@pytest.mark.parametrize("how,joins", [("inner", 1), ("left", 3)])
def test_pairs_of_intervals_are_not_moved(spark, how, joins):
    """Pairs may be as many as points times intervals: they come out of the last join, which tests the bounds."""
    p = spark.createDataFrame([(i, i % 50) for i in range(400)], "p long, x long")
    s = spark.createDataFrame([(i, i % 20, i % 20 + 30) for i in range(100)], "s long, a long, b long")
    got = interval_join(p, s, "x", "a", "b", how=how)
    steps = [line for line in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    assert len(steps) == joins and sum("Join Inner" in line and ">= a#" in line for line in steps) == 1
    want = Counter((i, j) for i in range(400) for j in range(100) if j % 20 <= i % 50 < j % 20 + 30)
    if how == "left":
        want += Counter((i, None) for i in range(400) if i % 50 == 49)
    assert Counter((r.p, r.s) for r in got.collect()) == want
