"""Every acceptance query beside its SQL, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__
from acceptance import oracles
from acceptance import queries as acceptance_queries
from acceptance.check import rows_of_spark, rows_of_sql

from .conftest import SMALL

QUERIES = acceptance_queries.queries()
ORACLES = oracles.oracle_sql()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    columns, rows = rows_of_spark(QUERIES[name](spark, SMALL))
    assert (columns, rows) == rows_of_sql(SMALL, ORACLES[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert len(result.columns) == 21 and result.count() > 0


@pytest.mark.parametrize("name", ["payment_enriched", "curated_360", "events_scd1"])
def test_no_python_on_executors(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
