"""What reaches the scans, and how often a table is scanned."""

import re

import pytest
from pyspark.sql import functions as F

from support import plan
from tallywork.plans.catalog import REGISTRY
from tallywork.sources.tables import flights

from conftest import SMALL


def scans(df, table):
    """The formatted plan's scans of one table."""
    nodes = re.split(r"\n\n(?=\(\d+\) )", plan(df))
    return [n for n in nodes if "Scan parquet" in n.split("\n")[0] and f"{table}.parquet" in n]


@pytest.mark.parametrize(
    ("name", "pushed"),
    [("flt_isin_or", "In(l_partkey"), ("flt_boolcol", "LessThan(l_partkey")],
)
def test_part_key_is_pushed_to_the_line_items(spark, name, pushed):
    (scan,) = scans(REGISTRY[name](spark, SMALL), "lineitem")
    assert pushed in re.search(r"PushedFilters: .*", scan)[0]


@pytest.mark.parametrize("name", ["flt_rowfunc", "flt_const", "flt_like_agg"])
def test_nations_are_cut_before_the_line_items_meet_them(spark, settings, name):
    settings({"spark.sql.autoBroadcastJoinThreshold": "-1"})
    df = REGISTRY[name](spark, SMALL)
    assert any("PushedFilters: [" in s and "n_name" in re.search(r"PushedFilters: .*", s)[0] for s in scans(df, "nation"))
    assert "LeftSemi" in plan(df)


def test_conditions_of_flights_equal_a_filter_on_the_result(tables):
    cut = flights(tables, origin=F.col("n_name") == "NATION_7", destination=F.col("n_name") < "NATION_2")
    late = flights(tables).where("origin_country_name = 'NATION_7' AND dest_country_name < 'NATION_2'")
    assert sorted(cut.collect()) == sorted(late.collect())


@pytest.mark.parametrize(("name", "table"), [("flt_date_range", "orders"), ("ml_prep", "lineitem")])
def test_parts_come_from_one_scan(spark, name, table):
    assert len(scans(REGISTRY[name](spark, SMALL), table)) == 1


def test_parts_without_price_join_no_parts(spark):
    assert not scans(REGISTRY["ml_prep"](spark, SMALL), "part")
