"""File readers with the three schema modes: inferred, all text, and fixed."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark's default pattern for zone-free timestamps stops at milliseconds.
NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
    mode: str = "PERMISSIVE",
    sep: str = ",",
) -> DataFrame:
    """CSV with a header row. Without ``schema`` and ``infer`` every column is text.

    A fixed schema saves the extra pass that inference makes over the whole input. ``mode`` is
    ``FAILFAST`` (stop), ``PERMISSIVE`` (null fields) or ``DROPMALFORMED`` (skip the row).
    """
    reader = spark.read.option("header", True).option("mode", mode).option("sep", sep)
    reader = reader.option("timestampNTZFormat", NTZ_FORMAT)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


SAMPLE_FILES = 8  # of a folder, by which types are first guessed


def _wider(one: T.DataType, other: T.DataType) -> T.DataType | None:
    """The type that inference gives a column with values of both; None where that is not plain."""
    if one == other:
        return one
    pair = {one.typeName(), other.typeName()}
    if pair == {"integer", "long"}:
        return T.LongType()
    if pair <= {"integer", "long", "double"}:
        return T.DoubleType()
    if pair == {"date", "timestamp"}:
        return T.TimestampType()
    return T.StringType() if "string" in pair else None


def read_csv_guessed(spark: SparkSession, path: str, target: str, sep: str = ",", sample_files: int = SAMPLE_FILES) -> DataFrame:
    """CSV with the types that inference over all files gives, mostly from one read of them.

    Types are guessed from a few files, drawn by their names. All files are then read with these
    types and written to ``target`` as Parquet; that pass also counts the lines that do not fit.
    If there are any, only these lines are inferred anew, the types widened, and the pass
    repeated, which happens once for each wider type at most. A column without values in the
    guess, or of types that do not widen plainly, is left to full inference.
    """
    files = spark.read.text(path).inputFiles()
    drawn = sorted(files, key=lambda f: hashlib.md5(f.encode()).hexdigest())[:sample_files]
    sample = read_csv(spark, drawn, infer=True, sep=sep)
    schema = sample.schema
    filled = sample.agg(*[F.count(f"`{c}`") for c in sample.columns]).first()
    if not all(filled):
        schema = read_csv(spark, path, infer=True, sep=sep).schema
    line = "_unfitting_line"
    while True:
        reader = spark.read.option("header", True).option("sep", sep).option("columnNameOfCorruptRecord", line)
        # Without a pattern of its own a date takes a text with a time, and loses that silently.
        reader = reader.option("timestampNTZFormat", NTZ_FORMAT).option("dateFormat", "yyyy-MM-dd")
        rows = reader.schema(T.StructType([*schema, T.StructField(line, T.StringType())])).csv(path)
        seen = Observation()
        rows.observe(seen, F.count(line).alias("unfitting")).write.mode("overwrite").parquet(target)
        written = spark.read.schema(rows.schema).parquet(target)
        if not seen.get["unfitting"]:
            return written.drop(line)
        lines = f"{target}-lines"
        written.where(F.col(line).isNotNull()).select(line).write.mode("overwrite").text(lines)
        more = spark.read.option("inferSchema", True).option("sep", sep).option("timestampNTZFormat", NTZ_FORMAT).csv(lines).schema
        wider = [_wider(a.dataType, b.dataType) for a, b in zip(schema, more)]
        if len(more) != len(schema) or None in wider or wider == [f.dataType for f in schema]:
            # Lines with fields missing or too many, or types beyond the plain ones.
            schema = read_csv(spark, path, infer=True, sep=sep).schema
            return read_csv(spark, path, schema=schema, sep=sep)
        schema = T.StructType([T.StructField(f.name, kind) for f, kind in zip(schema, wider)])


def split_malformed(
    spark: SparkSession, path: str | list[str], schema: T.StructType, target: str, sep: str = ","
) -> tuple[DataFrame, DataFrame]:
    """CSV rows that fit ``schema``, and the lines that do not, from one pass over the files.

    Both parts are written below ``target``: the good rows with their types, the bad lines as
    they are in ``line`` with the ``file`` they come from, so that they can be mended and read
    again. A line is bad if a field does not parse or fields are missing or too many.
    """
    line = "_malformed_line"
    with_line = T.StructType([*schema, T.StructField(line, T.StringType())])
    rows = (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", line)
        .option("sep", sep)
        .option("timestampNTZFormat", NTZ_FORMAT)
        .schema(with_line)
        .csv(path)
        .withColumn("_file", F.input_file_name())
        .withColumn("_bad", F.col(line).isNotNull())
    )
    rows.write.mode("overwrite").partitionBy("_bad").parquet(target)
    everything = T.StructType(
        [*with_line, T.StructField("_file", T.StringType()), T.StructField("_bad", T.BooleanType())]
    )
    # The folders' names tell the parts apart, so each read opens its own files only.
    both = spark.read.schema(everything).parquet(target)
    good = both.where("NOT _bad").select(*schema.fieldNames())
    bad = both.where("_bad").select(F.col(line).alias("line"), F.col("_file").alias("file"))
    return good, bad


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """JSON lines, inferred unless a schema is given."""
    reader = spark.read.option("mode", mode).option("timestampNTZFormat", NTZ_FORMAT)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.parquet(path)


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Raise unless every name is present (names compare without case)."""
    present = {name.lower() for name in df.columns}
    missing = [name for name in names if name.lower() not in present]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def bind(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind a frame to a record type: its columns, order and types.

    ``DataFrame.to`` alone would fill a missing nullable column with nulls.
    """
    return require_columns(df, schema.fieldNames()).to(schema)


def load_or_empty(
    spark: SparkSession, load: Callable[[], DataFrame], schema: T.StructType
) -> DataFrame:
    """The loaded frame, or no rows of ``schema`` where the path does not exist.

    Loading is lazy, so this vouches for the path and header, not for the content; every other
    failure is raised.
    """
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
