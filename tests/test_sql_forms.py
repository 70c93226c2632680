"""SQL text and DataFrame form of one query give the same rows."""

import pytest

from support import rows, same_rows
from tallywork.plans.catalog import REGISTRY
from tallywork.sources.tables import Tables, flights, order_totals, retail

RETAIL_FORMS = {
    "agg_count_rows": "SELECT count(*) AS n FROM {retail}",
    "agg_count_col": "SELECT count(description) AS n FROM {retail}",
    "agg_count_distinct": "SELECT count(DISTINCT stock_code) AS stock_codes, "
    "count(DISTINCT quantity) AS quantities FROM {retail}",
    "agg_count_distinct_star": "SELECT count(DISTINCT *) AS distinct_rows FROM {retail}",
    "agg_min_max": "SELECT min(quantity) AS min_quantity, max(quantity) AS max_quantity "
    "FROM {retail}",
    "agg_sum": "SELECT country, sum(quantity) AS quantity, "
    "CAST(sum(CAST(unit_price AS DECIMAL(18, 2))) AS DOUBLE) AS unit_prices "
    "FROM {retail} GROUP BY country",
    "agg_sum_distinct": "SELECT CAST(sum(DISTINCT CAST(unit_price AS DECIMAL(18, 2))) AS DOUBLE) "
    "AS distinct_prices FROM {retail}",
    "agg_variance": "SELECT round(var_pop(quantity), 4) AS var_pop, "
    "round(var_samp(quantity), 4) AS var_samp FROM {retail}",
    "agg_stddev": "SELECT country, round(stddev_pop(quantity), 4) AS stddev_pop, "
    "round(stddev_samp(quantity), 4) AS stddev_samp FROM {retail} GROUP BY country",
    "agg_skew_kurt": "SELECT round(skewness(quantity), 4) AS skewness, "
    "round(kurtosis(quantity), 4) AS kurtosis FROM {retail}",
    "agg_map": "SELECT invoice_no, round(avg(quantity), 4) AS avg_quantity, "
    "round(stddev_pop(quantity), 4) AS stddev_pop_quantity FROM {retail} "
    "GROUP BY invoice_no ORDER BY invoice_no",
    "agg_group_count": "SELECT invoice_no, customer_id, count(*) AS lines FROM {retail} "
    "GROUP BY invoice_no, customer_id",
    "flt_contains": "SELECT invoice_no, description FROM {retail} "
    "WHERE instr(description, 'RED') >= 1 OR instr(description, 'BLUE') >= 1",
    "nest_explode": "SELECT description, invoice_no, word FROM "
    "(SELECT *, split(description, ' ') AS parts FROM {retail}) "
    "LATERAL VIEW explode(parts) AS word",
    "win_combined": "SELECT customer_id, CAST(date AS STRING) AS date, quantity, "
    "CAST(rank() OVER falling AS BIGINT) AS rank, "
    "CAST(dense_rank() OVER falling AS BIGINT) AS dense_rank, "
    "max(quantity) OVER falling AS running_max "
    "FROM (SELECT *, CAST(invoice_ts AS DATE) AS date FROM {retail} WHERE customer_id IS NOT NULL) "
    "WINDOW falling AS (PARTITION BY customer_id, date ORDER BY quantity DESC NULLS LAST "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
}
LINE_FORMS = {
    "flt_boolcol": "SELECT l_partkey, CAST(l_shipdate AS STRING) AS shipped, open_late FROM "
    "(SELECT *, l_partkey < 40 AND l_linestatus = 'O' "
    "AND l_shipdate >= timestamp_ntz'1997-01-01 00:00:00' AS open_late FROM {lines}) WHERE open_late",
    "agg_expr": "SELECT l_orderkey, CAST(max(l_shipdate) AS STRING) AS last_shipped, "
    "count(*) FILTER (WHERE l_discount > 0.05D) AS discounted FROM {lines} GROUP BY l_orderkey",
}
FLIGHT_FORMS = {
    "topk_group": "SELECT dest_country_name, sum(count) AS arrivals FROM {flights} "
    "GROUP BY dest_country_name ORDER BY sum(count) DESC, dest_country_name LIMIT 5",
    "proj_global_aggexpr": "SELECT round(avg(count), 4) AS mean_count, "
    "count(DISTINCT dest_country_name) AS destinations FROM {flights}",
    "flt_const": "SELECT * FROM {flights} WHERE dest_country_name = 'NATION_9'",
}


@pytest.mark.parametrize("name", sorted(RETAIL_FORMS))
def test_on_retail(spark, tables, name):
    in_sql = spark.sql(RETAIL_FORMS[name], retail=retail(tables))
    assert same_rows(REGISTRY[name].build(tables), in_sql)


@pytest.mark.parametrize("name", sorted(LINE_FORMS))
def test_on_line_items(spark, tables, name):
    in_sql = spark.sql(LINE_FORMS[name], lines=tables.lineitem)
    assert same_rows(REGISTRY[name].build(tables), in_sql)


@pytest.mark.parametrize("name", sorted(FLIGHT_FORMS))
def test_on_flights(spark, tables, name):
    in_sql = spark.sql(FLIGHT_FORMS[name], flights=flights(tables))
    assert same_rows(REGISTRY[name].build(tables), in_sql)


def test_rollup_and_cube(spark, tables):
    daily = order_totals(tables, "invoice_ts", "country")
    for kind in ("rollup", "cube"):
        in_sql = spark.sql(
            f"SELECT CAST(date AS STRING) AS date, country, grouping_id() AS level, "
            f"sum(quantity) AS total_quantity "
            f"FROM (SELECT CAST(invoice_ts AS DATE) AS date, * FROM {{daily}}) "
            f"GROUP BY {kind}(date, country)",
            daily=daily,
        )
        assert same_rows(REGISTRY[f"agg_{kind}"].build(tables), in_sql)


def test_a_view_name_may_start_with_a_digit(spark, tables):
    flights(tables).createOrReplaceTempView("1998_flights")
    found = spark.sql("SELECT dest_country_name, sum(count) FROM 1998_flights GROUP BY 1")
    assert found.where("`sum(count)` > 10").count() == 25


def test_literals_alone_give_one_row(spark):
    row = spark.sql("SELECT 5, 'five', 5.0").collect()
    assert len(row) == 1 and tuple(row[0])[:2] == (5, "five")


@pytest.fixture(scope="module")
def routes(spark, tmp_path_factory):
    """Three nations, two customers, two suppliers: A to A twice, B to A once, A to B once."""
    folder = str(tmp_path_factory.mktemp("routes"))
    given = {
        "nation": ("n_nationkey long, n_name string", [(1, "A"), (2, "B"), (3, "C")]),
        "customer": ("c_custkey long, c_nationkey long", [(10, 1), (20, 2)]),
        "supplier": ("s_suppkey long, s_nationkey long", [(100, 1), (200, 2)]),
        "orders": ("o_orderkey long, o_custkey long", [(5, 10), (6, 20), (7, None)]),
        "lineitem": (
            "l_orderkey long, l_suppkey long",
            [(5, 100), (5, 100), (5, 200), (6, 100), (6, None), (7, 100)],
        ),
    }
    for name, (schema, values) in given.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return Tables(spark, folder)


def test_all_columns_of_the_routes_and_whether_they_stay_within_a_country(routes):
    found = REGISTRY["proj_selectexpr_star"].build(routes)
    assert found.columns == ["dest_country_name", "origin_country_name", "count", "domestic"]
    assert rows(found) == [("A", "A", 2, True), ("A", "B", 1, False), ("B", "A", 1, False)]


def test_one_row_for_all_routes(routes):
    found = REGISTRY["proj_global_aggexpr"].build(routes)
    assert found.columns == ["mean_count", "destinations"]
    assert rows(found) == [(1.3333, 2)]
