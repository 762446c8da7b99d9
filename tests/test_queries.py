"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from tidewater.registry import ORACLES, PLANS, run_all

FOLDER = os.environ.get("TIDEWATER_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


@pytest.mark.parametrize("name", sorted(set(PLANS) - set(ORACLES)))
def test_runs(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["priority_group", "p_type", "total_hours"]


def test_runner_survives_a_failing_query(spark, monkeypatch, capsys):
    def broken(_):
        raise ValueError("no such thing")

    kept = {"value_counts": PLANS["value_counts"], "broken": broken, "std_pop": PLANS["std_pop"]}
    monkeypatch.setattr("tidewater.registry.PLANS", kept)
    assert run_all(spark, FOLDER) == {"broken": "no such thing"}
    assert "std_value" in capsys.readouterr().out
