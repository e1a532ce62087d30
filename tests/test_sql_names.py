"""SQL functions against the Column functions of the same names, on awkward values."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from crashlake.functions import metrics as M, sql_names, text as X, times as T, versions as V

TEXTS = [None, "", " ", "3", "3.6", "3.6b1", "3.6.4plugin3", "10.0a2", "7.0esr", "4.0 (beta)", "12x5", "1234.5", "2.0.0.1pre", "20240105000000", "local",
         "family 6 | 4", "http://a.b/c?d", "ftp:/x", "0bba929f-8721-460c-dead-a43c20071025", "x2009999", "beta", "Release", "nightly-x", "content", "Plugin"]


@pytest.fixture(scope="module")
def sql(spark):
    return sql_names.register(spark)


ONE = {"nonzero_string": X.nonzero_string, "initcap1": X.initcap1, "get_cores": X.get_cores, "url2domain": X.url2domain, "build_numeric": V.build_numeric,
       "build_date": V.build_date, "to_major_version": V.to_major_version, "major_version": V.major_version, "version_sort_digit": V.version_sort_digit,
       "major_version_sort": V.major_version_sort, "old_version_sort": V.old_version_sort, "version_sort": V.version_sort,
       "aurora_or_nightly": V.aurora_or_nightly, "ooid_date": T.ooid_date, "ooid_depth": T.ooid_depth}
TWO = {"version_matches_channel": V.version_matches_channel, "sunset_date": V.sunset_date, "daily_crash_code": M.daily_crash_code}


def test_functions_of_a_text(sql):
    df = sql.createDataFrame([(t,) for t in TEXTS], "t string")
    for name, fn in ONE.items():
        got = df.select("t", F.expr(f"{name}(t)").alias("x")).collect()
        assert got == df.select("t", fn(F.col("t")).alias("x")).collect(), name


def test_functions_of_two_texts(sql):
    df = sql.createDataFrame([(a, b) for a in TEXTS for b in TEXTS], "a string, b string")
    for name, fn in TWO.items():
        assert df.select(F.expr(f"{name}(a, b)").alias("x")).collect() == df.select(fn(F.col("a"), F.col("b")).alias("x")).collect(), name
    channel = df.select(F.expr("version_sort(a, 0, b)").alias("x"), F.expr("version_string(a, 2, b)").alias("y"), F.expr("is_rapid_beta(b, a, '3.6')").alias("z"))
    a, b = F.col("a"), F.col("b")
    assert channel.collect() == df.select(V.version_sort(a, channel=b).alias("x"), V.version_string(a, F.lit(2), b).alias("y"),
                                          V.is_rapid_beta(b, a, F.lit("3.6")).alias("z")).collect()


def test_functions_of_numbers_and_times(sql):
    t = dt.datetime(2024, 1, 10, 23, 30)
    df = sql.createDataFrame([(n, a, t + dt.timedelta(hours=6 * (n or 0))) for n in (None, 0, 3, 61, -4) for a in (None, 0, 7)], "n int, a int, t timestamp")
    n, a, at = F.col("n"), F.col("a"), F.col("t")
    base = F.lit(t)
    pairs = {"version_sort('3.6', n)": V.version_sort(F.lit("3.6"), n), "version_string('3.6', n)": V.version_string(F.lit("3.6"), n),
             "crash_hadu(n, a, 0.1D)": M.crash_hadu(n, a, F.lit(0.1)), "trend_class(n)": M.trend_class(n),
             "utc_day_is(t, DATE '2024-01-10')": T.utc_day_is(at, "2024-01-10"), "utc_day_near(t, DATE '2024-01-10')": T.utc_day_near(at, "2024-01-10"),
             "tstz_between(t, DATE '2024-01-10', DATE '2024-01-11')": T.tstz_between(at, F.lit("2024-01-10").cast("date"), F.lit("2024-01-11").cast("date")),
             "week_begins_utc(t)": T.week_begins_utc(at), "week_ends_utc(t)": T.week_ends_utc(at), "pacific2ts(t)": T.local_time(at),
             f"same_time_fuzzy(TIMESTAMP '{t}', t, n, a)": T.same_time_fuzzy(base, at, n, a)}
    for text, column in pairs.items():
        assert df.select(F.expr(text).alias("x")).collect() == df.select(column.alias("x")).collect(), text
    counts = df.select(F.lit("Content").alias("p"), "n").unionByName(df.select(F.lit("plugin").alias("p"), "n"))
    counts.createOrReplaceTempView("typed")
    got = sql.sql("SELECT sum(content_count_state(0, p, n)) AS c, sum(plugin_count_state(0, p, n)) AS p FROM typed").first()
    want = counts.select(M.content_count(F.col("p"), F.col("n")).alias("c"), M.plugin_count(F.col("p"), F.col("n")).alias("p")).first()
    assert got == want


def test_filters_by_a_sql_name_reach_the_scan(sql, tmp_path):
    path = str(tmp_path / "t")
    sql.createDataFrame([(dt.datetime(2024, 1, d), d) for d in range(1, 20)], "t timestamp, d int").write.parquet(path)
    sql.read.parquet(path).createOrReplaceTempView("timed")
    df = sql.sql("SELECT d FROM timed WHERE utc_day_is(t, DATE '2024-01-10')")
    assert [r.d for r in df.collect()] == [10]
    assert "GreaterThanOrEqual(t," in df._jdf.queryExecution().executedPlan().toString()
