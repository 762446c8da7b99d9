"""What the physical plans must not hold, for every registered query."""

import re

import pytest

import tidewater.plans.all  # noqa: F401
from tidewater.operators import rolling, sequences
from tidewater.registry import PLANS
from tidewater.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(PLANS))
def test_no_pairing_of_all_rows_and_no_python(spark, name):
    plan = physical(PLANS[name](Tables(spark, FOLDER)))
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert banned not in plan


def test_scans_read_only_what_is_needed(spark):
    plan = physical(PLANS["rewards"](Tables(spark, FOLDER)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert any("l_orderkey:bigint,l_extendedprice:double,l_shipdate" in s for s in schemas)
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan
    plan = physical(PLANS["date_between"](Tables(spark, FOLDER)))
    assert "GreaterThanOrEqual(o_orderdate" in plan


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sliced_operators_shuffle_the_rows_once(spark, no_broadcast):
    events = Tables(spark, FOLDER).events
    plan = physical(sequences.with_previous(events, "event_id", "value", ["user_id"]))
    rows = [line for line in plan.splitlines() if "Exchange hashpartitioning(_key" in line and "_slice" in line]
    # rows, partial maxima and the carried values: the rows are not shuffled again for the join
    assert len(rows) <= 3
    assert "coalesce(_slice" not in plan.split("SortMergeJoin")[1].splitlines()[0]
    plan = physical(rolling.rolling_count(events, "ts", rolling.HOUR_US, ["user_id"]))
    assert "SortMergeJoin [_key" in plan


def test_windows_over_a_whole_sequence_read_spans(spark, no_broadcast):
    """What meets in one partition has been summed by span before."""
    for name in ("run_length_whole", "rolling_spikes", "max_after_zero"):
        lines = physical(PLANS[name](Tables(spark, FOLDER))).splitlines()
        single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
        # besides the one row that says where to cut, and the last aggregate of a query
        single = [i for i in single if not any(one in " ".join(lines[i : i + 2]) for one in ("partial_percentile_approx", "partial_max("))]
        assert all("_span" in " ".join(lines[i : i + 4]) for i in single)


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in physical(PLANS["top_supp_revenue"](Tables(spark, FOLDER)))


def test_anti_join_needs_no_null_aware_broadcast(spark, no_broadcast):
    plan = physical(PLANS["not_in_sub"](Tables(spark, FOLDER)))
    assert "LeftAnti" in plan and "BroadcastHashJoin" not in plan
