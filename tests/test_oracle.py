"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest

import __spark_entry__ as entry_module
from compare import connect, difference, spark_rows, sql_rows, type_differences
from conftest import SMALL
from support import plan
from tallywork.plans.catalog import REGISTRY

# The operators whose feature is a pairing of small tables, or user code, or products of matrices.
PAIRS_ALLOWED = {"join_cross"}
PYTHON_ALLOWED = {"udf_column", "udf_sql", "ml_kmeans", "ml_kmeans_cost"}


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def check_plan(name, text):
    """No pairing of all rows, no window over the whole table, no Python where none is meant."""
    if name not in PAIRS_ALLOWED:
        assert "CartesianProduct" not in text
        assert "NestedLoopJoin" not in text
    if name not in PYTHON_ALLOWED:
        assert not re.search(r"EvalPython|InPandas|InArrow|BatchEval", text)
    for arguments in re.findall(r"^\(\d+\) Window\b.*?Arguments: (.*?)$", text, re.M | re.S):
        assert not re.search(r"\], \[\], \[", arguments), "window without partition keys"


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_gives_the_rows_of_its_sql(spark, connection, name):
    found = REGISTRY[name](spark, SMALL)
    check_plan(name, plan(found))
    rows = spark_rows(found)
    if REGISTRY[name].oracle:
        assert type_differences(connection, found, REGISTRY[name].oracle) == {}
        assert difference(rows, sql_rows(connection, REGISTRY[name].oracle)) is None
    else:
        assert rows[1].total() > 0


def test_entry_and_names():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(REGISTRY) == 157 and set(REGISTRY) <= set(entry_module.queries())


def test_entry_runs(spark):
    top = entry_module.entry(spark)
    assert top.columns == ["dest_country_name", "arrivals"]
    totals = [row.arrivals for row in top.collect()]
    assert len(totals) == 5 and totals == sorted(totals, reverse=True)
