"""What one task holds does not grow with the table: lines are dealt by their order, and nothing is shuffled or tripled again."""

import re

import pytest
from pyspark.sql import functions as F

from gridframe.operators import outcomes as oc
from gridframe.plans import QUERIES, SQL, more_queries, report_queries, run_queries, scoring_queries
from gridframe.plans.views import entry
from gridframe.sources import shared
from tests.oracle import assert_same

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_tasks(spark, monkeypatch):
    monkeypatch.setattr(shared, "TASK_ROWS", 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tasks_of_a_group_query_grow_in_number(spark, small_tasks):
    t = oc.outcome_class(entry(spark, SF, venue=False), "group_id", "lane", "finish")
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert t.rdd.getNumPartitions() == n // 200
    assert_same(t, SF, SQL["outcome_class"])


@pytest.mark.parametrize("venue", [True, False])
def test_status_shuffles_lines_once(spark, small_tasks, venue):
    t = oc.target_status(entry(spark, SF, venue=venue), "group_id", "lane", "finish", least=3, extra=[F.first("venue").alias("venue")])
    plan = _plan(t)
    assert "Expand" not in plan
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(group_id" not in plan
    assert t.rdd.getNumPartitions() == spark.read.parquet(f"{SF}/lineitem.parquet").count() // 200


@pytest.mark.parametrize("name", ["b3", "dominance", "stage_decomp", "grid_refit", "grid_refit_probs", "universe_roles", "outcome_crosstab", "target_status_settled", "b0", "b1", "class_decode", "class_encode"])
def test_named_queries_shuffle_lines_once_in_many_tasks(spark, small_tasks, monkeypatch, name):
    plans = []

    def stored(df, to):
        plans.append(_plan(df))
        return shared.stored(df, to)

    for module in (scoring_queries, more_queries, report_queries):
        monkeypatch.setattr(module, "stored", stored)
    df = QUERIES[name](spark, SF)
    lines = [p for p in [*plans, _plan(df)] if "l_orderkey" in p]
    assert len(lines) == 1  # and computed once
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count() // 200
    assert lines[0].count("hashpartitioning(l_orderkey") == 1 and re.search(rf"hashpartitioning\(l_orderkey#\d+L?, {n}\)", lines[0])
    assert "Expand" not in lines[0] and "hashpartitioning(group_id" not in lines[0]
    assert_same(df, SF, SQL[name])


def test_status_counts_distinct_values_as_sql_does(spark):
    rows = [(1, 1, 1), (1, 1, 1), (1, 2, None), (1, None, 2), (2, 9, 7), (2, -3, 7), (2, 9, None), (3, None, None), (None, 1, 1), (None, 1, 2), (None, 2, 2)]
    t = spark.createDataFrame(rows, "g int, lane int, finish int")
    got = oc.target_status(t, "g", "lane", "finish").select("g", "n", "n_lanes", "n_finishes")
    want = t.groupBy("g").agg(F.count("*").alias("n"), F.countDistinct("lane").alias("n_lanes"), F.countDistinct("finish").alias("n_finishes"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_reconciled_targets_are_computed_once(spark, small_tasks):
    df = QUERIES["target_reconcile"](spark, SF)
    assert "lineitem" not in "".join(df.inputFiles())
    assert_same(df, SF, SQL["target_reconcile"])


def test_reconciled_sources_are_computed_once(spark, small_tasks):
    df = QUERIES["source_reconcile"](spark, SF)
    assert "lineitem" not in "".join(df.inputFiles())
    assert_same(df, SF, SQL["source_reconcile"])


def test_stream_parts_are_written_by_many_tasks(spark, small_tasks, monkeypatch, tmp_path):
    monkeypatch.setattr(run_queries, "new_path", lambda spark, name: str(tmp_path / name))
    assert_same(QUERIES["stream_acceptance"](spark, SF), SF, SQL["stream_acceptance"])
    files = list((tmp_path / "stream" / "in").glob("*.parquet"))
    assert len(files) > 4 and len(files) % 4 == 0
