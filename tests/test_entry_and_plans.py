"""Driver contract at sf0.001 (every key against its SQL oracle) and plan shape."""

from __future__ import annotations

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from engagelake.plans import reports
from engagelake.registry import fact_frame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_small}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["media_id", "visitor_id", "date"]
    assert df.count() > 0


def test_every_query_has_a_callable_and_most_an_oracle():
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, duck, key):
    df = E.queries()[key](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, orows)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_plan_one_event_shuffle_and_broadcasts(spark, sf_small):
    plan = plan_of(fact_frame(spark, sf_small))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan


def test_date_filter_prunes_partitions(spark, sf_small):
    from engagelake.plans.catalog import register_gold_tables
    from engagelake.plans import publish
    from engagelake.plans.gold import _stamp
    from engagelake.plans.workflow import DIM_MEDIA, FACT, FACT_CLUSTER
    from engagelake.session import new_run_dir
    root = new_run_dir(spark, "test-gold")
    manifest = {FACT: publish.stage(_stamp(fact_frame(spark, sf_small), True), root, FACT, "v", "date", FACT_CLUSTER)[0],
                DIM_MEDIA: publish.stage(spark.createDataFrame([("m1", "Facebook")], "media_id string, channel string"), root, DIM_MEDIA, "v")[0]}
    names = register_gold_tables(spark, root, manifest, "test_prunes")
    fact = spark.table(names["fact_media_engagement"])
    dim = spark.table(names["dim_media"])
    df = reports.date_filtered(fact, dim, dt.date(2024, 1, 8), dt.date(2024, 1, 14))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")           # the version's filter comes first
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    import re
    filters = re.findall(r"PartitionFilters: \[[^\]]*\]", plan)
    assert any(">= 2024-01-08" in f and "<= 2024-01-14" in f for f in filters)


def test_fact_scan_is_pruned_and_filtered(spark, sf_small):
    plan = plan_of(fact_frame(spark, sf_small))
    # the rollup's scan reads only the columns it needs and pushes the visitor filter
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double,props:string>" in plan
    assert "PushedFilters: [IsNotNull(user_id)]" in plan


def test_reports_broadcast_the_bounded_dimension(spark, sf_small):
    plan = plan_of(E.queries()["rpt_kpi"](spark, sf_small))
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 3
