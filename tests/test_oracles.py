"""Every query against its SQL twin, and the shape of every plan."""

import pytest

from __spark_entry__ import entry
from annomill.plans.oracles import ORACLES
from annomill.plans.queries import QUERIES
from compare import check, connect


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(name, spark, sf_dir, duck):
    assert check(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) == []


def test_results_are_not_empty(sf_dir, duck):
    for name, sql in ORACLES.items():
        assert duck.execute(f"SELECT count(*) FROM ({sql})").fetchall()[0][0] > 0, name


def test_entry(spark):
    assert entry(spark).count() == 4


def plan_of(frame) -> str:
    execution = frame._jdf.queryExecution()
    return frame.sparkSession._jvm.PythonSQLUtils.explainString(execution, "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_plan_crosses_tables_or_runs_python(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval"):
        assert operator not in plan


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(QUERIES["batch_usage"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,n_chars:bigint>" in plan
    plan = plan_of(QUERIES["prompts_only"](spark, sf_dir))
    assert "ReadSchema: struct<prompt:string>" in plan


def test_narrow_aggregates_hash(spark, sf_dir):
    for name in ("pivot_wide", "annotation_summary", "need_split", "token_count"):
        assert "SortAggregate" not in plan_of(QUERIES[name](spark, sf_dir))
