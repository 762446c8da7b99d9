"""Named queries: each pairs a DataFrame plan with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.sources.tables import Tables

Plan = Callable[[Tables], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a plan under its function name, with its equivalent SQL where there is one."""

    def register(plan: Plan) -> Plan:
        key = name or plan.__name__
        if key in PLANS:
            raise ValueError(f"query {key!r} is registered twice")
        PLANS[key] = plan
        if sql is not None:
            ORACLES[key] = sql
        return plan

    return register


def runnable(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plan(Tables(spark, folder))


def run_all(spark: SparkSession, folder: str, show: int = 20) -> dict[str, str]:
    """Run every query and print its title and first rows; a failing query does not stop the rest.

    Returns the error text by query name, empty when all succeeded.
    """
    errors = {}
    for title, plan in PLANS.items():
        print(f"--- {title}")
        try:
            plan(Tables(spark, folder)).show(show, truncate=False)
        except Exception as error:  # reported per query, as a report runner must
            errors[title] = str(error)
            print(f"failed: {error}")
    return errors
