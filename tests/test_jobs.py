import datetime as dt

import pytest
from pyspark.sql import functions as F

from crashlake.operators import topcrash
from crashlake.plans import jobs as J
from crashlake.plans.warehouse import Warehouse

FIRST, LAST = dt.date(2024, 1, 3), dt.date(2024, 1, 5)


@pytest.fixture(scope="module")
def events(spark):
    """Tables with reports in every hour, as the check for whole days needs."""
    from crashlake.plans.registry import Context
    return Context(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def warehouse(events, tmp_path_factory):
    w = Warehouse(events.spark, str(tmp_path_factory.mktemp("warehouse")))
    for name, df in {
        "product_versions": events.pv, "product_version_builds": events.t("product_version_builds"),
        "raw_adu": events.t("raw_adu"), "crash_types": events.t("crash_types"),
        "os_names": events.t("os_names"), "product_release_channels": events.t("channels"),
        "product_productid_map": events.t("guid_map"), "uptime_levels": events.t("uptime_levels"),
        "os_name_matches": events.tables.small("os_matches"),
        "release_channel_matches": events.tables.small("channel_matches"),
        "windows_versions": events.tables.small("windows_versions"),
        "reports": events.t("reports").where("report_date <= '2024-01-08'"),
    }.items():
        w.write(name, df)
    n = J.clean_hours(w, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 6), hours=24)
    assert n == 4
    return w


def rows(df, *cols):
    return sorted(map(repr, df.select(*cols).collect())) if cols else sorted(map(repr, df.collect()))


def test_steps_stop_at_mondays():
    steps = list(J.hour_steps(dt.datetime(2024, 1, 7, 20), dt.datetime(2024, 1, 8, 8), 6))
    assert steps == [(dt.datetime(2024, 1, 7, 20), dt.datetime(2024, 1, 8)),
                     (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 8, 6)),
                     (dt.datetime(2024, 1, 8, 6), dt.datetime(2024, 1, 8, 8))]
    with pytest.raises(ValueError):
        list(J.hour_steps(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3), 25))


def test_cleaning_again_changes_nothing(warehouse, events):
    before = rows(warehouse.table("reports_clean"), "uuid", "signature", "product_version_id")
    J.clean_hours(warehouse, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 12), hours=6)
    assert rows(warehouse.table("reports_clean"), "uuid", "signature", "product_version_id") == before
    want = events.clean.where("date_processed >= '2024-01-02' AND date_processed < '2024-01-06'")
    assert len(before) == want.count()


def test_order_has_needs_first():
    order = J.order()
    for name in order:
        assert all(order.index(n) < order.index(name) for n in J.JOBS[name].needs)
    assert J.order(["explosiveness"]) == ["tcbs", "product_adu", "explosiveness"]


def test_day_is_built_once(warehouse):
    assert J.run_day(warehouse, "tcbs", FIRST)
    with pytest.raises(J.AlreadyRun):
        J.run_day(warehouse, "tcbs", FIRST)
    assert J.run_day(warehouse, "tcbs", FIRST, check=False) is False
    with pytest.raises(J.NotReady):
        J.run_day(warehouse, "tcbs", dt.date(2024, 1, 20))
    with pytest.raises(J.NotReady):
        J.run_day(warehouse, "crashes_by_user", dt.date(2024, 1, 4))
    assert J.run_day(warehouse, "tcbs", dt.date(2024, 1, 20), check=False) is False


def test_backfill_twice_is_once(warehouse, events):
    names = ["tcbs", "product_adu", "crashes_by_user", "home_page_graph", "nightly_builds", "daily_hangs",
             "rank_compare", "explosiveness", "correlations"]
    assert set(J.backfill(warehouse, FIRST, LAST, dt.date(2024, 2, 1), names)) == set(names)
    once = {n: rows(warehouse.table(n)) for n in names + ["signatures", "signature_products_rollup"]}
    J.backfill(warehouse, FIRST, LAST, dt.date(2024, 2, 1), names)
    assert {n: rows(warehouse.table(n)) for n in once} == once
    want = topcrash.tcbs(events.clean, events.pv, FIRST, LAST)
    assert rows(want) == rows(warehouse.table("tcbs"), *want.columns)
    assert [r[0] for r in warehouse.table("rank_compare").select("report_date").distinct().collect()] == [LAST]
    with pytest.raises(ValueError):
        J.backfill(warehouse, FIRST, dt.date(2024, 3, 1), dt.date(2024, 2, 1))


def test_a_day_without_rows_is_emptied(warehouse, events):
    empty = warehouse.table("tcbs").where(F.lit(False))
    kept = warehouse.table("tcbs").where(F.col("report_date") != F.lit(LAST)).count()
    warehouse.write_days("tcbs", empty.select(*warehouse.table("tcbs").columns), "report_date", LAST, LAST)
    assert warehouse.table("tcbs").count() == kept and not warehouse.has_day("tcbs", LAST, "report_date")
    J.backfill_day(warehouse, "tcbs", LAST)
    assert warehouse.has_day("tcbs", LAST, "report_date")


def test_catch_up(warehouse):
    J.backfill_day(warehouse, "tcbs_build", dt.date(2024, 1, 2))
    assert J.missed_days(warehouse, "tcbs_build", LAST) == [dt.date(2024, 1, d) for d in (3, 4, 5)]
    assert J.catch_up(warehouse, "tcbs_build", LAST) == 3
    assert J.missed_days(warehouse, "tcbs_build", LAST) == []


def test_failed_view_skips_dependents(warehouse, monkeypatch):
    broken = J.Job("build_adu", (), lambda w, a, b: 1 / 0, day="adu_date", feeds=())
    monkeypatch.setitem(J.JOBS, "build_adu", broken)
    for name in list(J.JOBS):
        if name not in ("build_adu", "home_page_graph_build", "product_adu"):
            monkeypatch.delitem(J.JOBS, name)
    state = J.run_all(warehouse, dt.date(2024, 1, 6))
    assert state["build_adu"].startswith("failed") and state["home_page_graph_build"] == "skipped"
    assert state["product_adu"] == "done"


def test_signature_counts(warehouse):
    J.backfill_signature_counts(warehouse, FIRST, LAST)
    days = {r[0] for r in warehouse.table("uptime_signature_counts").select("report_date").distinct().collect()}
    assert days == {FIRST, dt.date(2024, 1, 4), LAST}


def test_reprocess_from_the_mark(warehouse, spark):
    t = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([("a", t), ("b", t + dt.timedelta(hours=1))], "uuid string, submitted_timestamp timestamp")
    warehouse.write("raw_crashes", raw)
    again = lambda df: df.withColumnRenamed("submitted_timestamp", "date_processed")
    assert J.reprocess(warehouse, lambda df: df, again) == 2
    assert J.reprocess(warehouse, lambda df: df, again) == 0
    warehouse.append("raw_crashes", spark.createDataFrame([("c", t + dt.timedelta(hours=1))], raw.schema))
    assert J.reprocess(warehouse, lambda df: df, again) == 1
