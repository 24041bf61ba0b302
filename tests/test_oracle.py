"""Every registered query against its SQL statement, on the small tables, and the shape of its plan."""

import io
from contextlib import redirect_stdout

import pytest

import oracle_check
from conftest import SMALL
from latewatch.plans.catalog import CATALOG


@pytest.fixture(scope="module")
def connection():
    return oracle_check.connect(SMALL)


@pytest.mark.parametrize("name", [n for n, entry in CATALOG.items() if entry.oracle])
def test_query_equals_statement(spark, connection, name):
    df = CATALOG[name].run(spark, SMALL)
    assert oracle_check.compare(df, connection, CATALOG[name].oracle) is None
    plan = io.StringIO()
    with redirect_stdout(plan):
        df.explain()
    for unwanted in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan.getvalue()


def test_flagship_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
