"""Registered queries against their SQL. All of them with CRASHLAKE_ALL=1, else a part."""
import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from crashlake.plans import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()
PART = ("b14_version_sort", "b36_b38_dump_signatures", "c12_g1_skip_done", "g1_reports_clean", "g8_product_adu",
        "g13_rank_compare", "g15_crashes_by_user_build", "g21_explosiveness", "g23_interesting_addons",
        "g29_bug_associations", "g31_c13_campaign_recipients", "h4_product_crash_ratio", "j1_search_hangs",
        "j6_top_crashers", "a17_bad_json", "a12_sample_by_day", "c4_pattern_join", "k3_stream_lagging", "k8_stream_duplicates", "l12_sql_summary",
        "l13_reprocess")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    return v if v is None or isinstance(v, (bool, int)) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES) if os.environ.get("CRASHLAKE_ALL") else PART)
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(ORACLES[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in res.fetchall()), key=repr)
    assert got == want and got


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_query_of_the_reports_has_sql():
    """All but the corpus operators, which SQL cannot express in full, are checked by SQL."""
    assert set(ORACLES) <= set(QUERIES)
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_plans_have_no_cross_join_or_single_task_window(spark):
    """Heavy marts: no nested-loop joins over facts, no Python in the plan."""
    for name in ("g1_reports_clean", "g10_tcbs", "g13_rank_compare", "g14_crashes_by_user", "g4_reports_duplicates"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython"):
            assert bad not in plan, (name, bad)
