"""Readers, writers, schema modes and their failures."""

import datetime
import hashlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from support import plan, rows, same_rows
from tallywork.plans.files import FLIGHT_SCHEMA
from tallywork.session import scratch_path, scratch_root
from tallywork.sources.readers import (
    bind,
    load_or_empty,
    read_csv,
    read_csv_guessed,
    read_json,
    read_parquet,
    split_malformed,
)
from tallywork.sources.tables import RETAIL_COLUMNS, flights, order_totals, retail
from tallywork.sources.writers import write_csv, write_json, write_parquet


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "test")


@pytest.fixture
def broken_csv(tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text(
        "dest_country_name,origin_country_name,count\nA,B,5\nA,C,many\nB,C,7\n", encoding="utf-8"
    )
    return str(path)


def test_schema_modes_of_csv(spark, broken_csv):
    assert dict(read_csv(spark, broken_csv).dtypes)["count"] == "string"
    lenient = read_csv(spark, broken_csv, schema=FLIGHT_SCHEMA)
    assert rows(lenient, "count") == [(None,), (5,), (7,)]
    dropped = read_csv(spark, broken_csv, schema=FLIGHT_SCHEMA, mode="DROPMALFORMED")
    assert rows(dropped, "count") == [(5,), (7,)]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, broken_csv, schema=FLIGHT_SCHEMA, mode="FAILFAST").collect()


def test_inference(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text("a,b,c,d\n1,2.5,x,2011-12-05 08:30:00\n", encoding="utf-8")
    types = dict(read_csv(spark, str(path), infer=True).dtypes)
    assert types == {"a": "int", "b": "double", "c": "string", "d": "timestamp"}


def test_read_schemas_keep_metadata_but_not_the_null_ban(spark, folder):
    write_json(spark.createDataFrame([("A", "B", None)], "dest_country_name string, "
               "origin_country_name string, count long"), folder)
    read = read_json(spark, folder, schema=FLIGHT_SCHEMA)
    assert read.schema["count"].metadata == {"unit": "flights"}
    assert read.schema["count"].nullable
    assert read.first()["count"] is None


def test_json_failfast_stops(spark, tmp_path):
    path = tmp_path / "flights.json"
    path.write_text('{"dest_country_name": "A", "count": 1}\n{"count": \n', encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_json(spark, str(path), schema=FLIGHT_SCHEMA, mode="FAILFAST").collect()


def test_many_files_read_as_one_table(spark, folder):
    df = spark.range(100).repartition(4).withColumn("s", F.lit("x"))
    write_csv(df, folder)
    schema = "id long, s string"
    globbed = read_csv(spark, f"{folder}/*.csv", schema=schema)
    assert len(globbed.inputFiles()) == 4
    assert same_rows(globbed, df)
    write_json(df, f"{folder}-json")
    assert same_rows(read_json(spark, f"{folder}-json/*.json", schema=schema), df)


@pytest.mark.parametrize("sep", [",", "\t"])
def test_text_files_keep_microseconds_and_separators(spark, folder, sep):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-02 03:04:05.123456' AS ts, 'a,b\tc' AS s, "
        "date'2024-02-29' AS d, CAST(NULL AS STRING) AS n"
    )
    write_csv(df, folder, sep=sep)
    assert same_rows(read_csv(spark, folder, schema=df.schema, sep=sep), df)
    write_json(df, f"{folder}-json")
    assert same_rows(read_json(spark, f"{folder}-json", schema=df.schema), df)


def test_overwrite_and_refusal(spark, folder):
    write_parquet(spark.range(3), folder)
    write_parquet(spark.range(5), folder)
    assert read_parquet(spark, folder).count() == 5
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_csv(spark.range(1), folder, mode="errorifexists")
    write_csv(spark.range(2), folder)
    assert read_csv(spark, folder).count() == 2


def test_date_format_of_written_files(spark, folder):
    df = spark.createDataFrame([(datetime.date(2011, 12, 5),)], "d date")
    write_csv(df, folder, date_format="dd/MM/yyyy")
    assert rows(read_csv(spark, folder)) == [("05/12/2011",)]


def test_guarded_load(spark, folder, broken_csv):
    empty = load_or_empty(spark, lambda: read_csv(spark, f"{folder}/absent"), FLIGHT_SCHEMA)
    assert empty.schema == FLIGHT_SCHEMA and empty.isEmpty()
    found = load_or_empty(spark, lambda: read_csv(spark, broken_csv), FLIGHT_SCHEMA)
    assert found.count() == 3
    with pytest.raises(AnalysisException):
        load_or_empty(spark, lambda: spark.table("no_such_table"), FLIGHT_SCHEMA)


def test_binding_to_a_record_type(spark):
    record = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    bound = bind(spark.sql("SELECT 'x' AS S, 1 AS n, true AS other"), record)
    assert bound.columns == ["n", "s"] and rows(bound) == [(1, "x")]
    with pytest.raises(ValueError, match="missing columns: s"):
        bind(spark.sql("SELECT 1 AS n"), record)


def test_scratch_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    first, second = scratch_path(spark, "a"), scratch_path(spark, "a")
    assert first != second and first.startswith(root)


def test_pushed_filter_and_pruned_columns(tables):
    text = plan(
        read_parquet(tables.spark, tables.path("lineitem"))
        .where("l_shipdate >= timestamp_ntz'1998-07-01 00:00:00'")
        .select("l_orderkey")
    )
    assert "GreaterThanOrEqual(l_shipdate" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_retail_joins_only_what_is_wanted(tables):
    quantities = plan(retail(tables, "quantity"))
    assert "Join" not in quantities
    assert "struct<l_quantity:double,l_returnflag:string>" in quantities
    assert plan(retail(tables, "unit_price"), "simple").count("FileScan parquet") == 2
    assert retail(tables).columns == list(RETAIL_COLUMNS)
    assert retail(tables).count() == tables.lineitem.count()
    with pytest.raises(ValueError, match="no such"):
        retail(tables, "price")


def test_order_totals_equal_the_sums_of_lines(tables):
    by_lines = (
        retail(tables, "invoice_no", "country", "quantity")
        .groupBy("invoice_no", "country")
        .agg(F.sum("quantity").alias("quantity"), F.count("*").alias("lines"))
    )
    assert same_rows(order_totals(tables, "country"), by_lines)


def test_flights_count_every_line(tables):
    assert flights(tables).agg(F.sum("count")).first()[0] == tables.lineitem.count()
    by_key = tables.nation.select("n_name").distinct().count()
    assert by_key == tables.nation.count()


def test_lines_made_distinct_before_their_look_ups(tables):
    ahead = retail(tables, distinct_lines=True)
    assert same_rows(ahead, retail(tables).distinct())


def test_malformed_lines_are_kept_apart(spark, tmp_path):
    path = tmp_path / "mixed.csv"
    path.write_text(
        'dest_country_name,origin_country_name,count\nA,B,5\nA,C,many\nB,C\n"x,y",D,7\nE,F,8,9\n,,\n', encoding="utf-8"
    )
    good, bad = split_malformed(spark, str(path), FLIGHT_SCHEMA, scratch_path(spark, "split"))
    assert good.columns == FLIGHT_SCHEMA.fieldNames()
    assert rows(good) == [(None, None, None), ("A", "B", 5), ("x,y", "D", 7)]
    assert rows(bad, "line") == [("A,C,many",), ("B,C",), ("E,F,8,9",)]
    assert {r["file"].rsplit("/", 1)[1] for r in bad.collect()} == {"mixed.csv"}


def test_files_with_good_or_bad_lines_only(spark, tmp_path):
    for name, line, counts in (("good", "A,B,1", (1, 0)), ("bad", "A,B,x", (0, 1)), ("none", "", (0, 0))):
        path = tmp_path / f"{name}.csv"
        path.write_text(f"dest_country_name,origin_country_name,count\n{line}\n", encoding="utf-8")
        parts = split_malformed(spark, str(path), FLIGHT_SCHEMA, scratch_path(spark, "split"))
        assert tuple(p.count() for p in parts) == counts


@pytest.mark.parametrize(
    "odd",
    ["7", "3000000000", "2.5", "word", "2011-12-05", "2011-12-05 08:30:00", "", "true"],
)
@pytest.mark.parametrize("usual", ["1", "0.5", "2011-12-05", "x"])
def test_guessed_types_are_those_of_full_inference(spark, tmp_path, odd, usual):
    for n in range(6):
        (tmp_path / f"part-{n}.csv").write_text(f"a,b\n{n},{usual}\n{n},{usual}\n", encoding="utf-8")
    # The odd value is in the file that is drawn last, so that the guess does not see it.
    files = spark.read.text(str(tmp_path)).inputFiles()
    last = max(files, key=lambda f: hashlib.md5(f.encode()).hexdigest())
    (tmp_path / last.rsplit("/", 1)[1]).write_text(f"a,b\n7,{usual}\n8,{odd}\n", encoding="utf-8")
    guessed = read_csv_guessed(spark, str(tmp_path), scratch_path(spark, "typed"), sample_files=1)
    full = read_csv(spark, str(tmp_path), infer=True)
    assert guessed.dtypes == full.dtypes
    assert rows(guessed) == rows(full)


def test_guess_reads_the_files_once_if_it_fits(spark, tmp_path):
    path = scratch_path(spark, "numbers")
    spark.range(1_000).selectExpr("id", "id * 0.5 AS half").repartition(8).write.option("header", True).csv(path)
    guessed = read_csv_guessed(spark, path, scratch_path(spark, "typed"), sample_files=2)
    assert dict(guessed.dtypes) == {"id": "int", "half": "double"}
    assert "FileScan parquet" in plan(guessed, "simple") and guessed.count() == 1_000


def test_guess_leaves_odd_files_to_full_inference(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,\n2,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("a,b\n3,4\n5,6,7\n", encoding="utf-8")
    for files in (1, 2):
        guessed = read_csv_guessed(spark, str(tmp_path), scratch_path(spark, "typed"), sample_files=files)
        assert guessed.dtypes == read_csv(spark, str(tmp_path), infer=True).dtypes and guessed.count() == 4
