"""Three literal tables used to try out every join type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The tables whose join results the tests expect.
PERSONS = [
    (0, "Bill Chambers", 0, [100]),
    (1, "Matei Zaharia", 1, [500, 250, 100]),
    (2, "Michael Armbrust", 1, [250, 100]),
]
PROGRAMS = [
    (0, "Masters", "School of Information", "UC Berkeley"),
    (2, "Masters", "EECS", "UC Berkeley"),
    (1, "Ph.D.", "EECS", "UC Berkeley"),
]
REPEATED_PROGRAM = (0, "Masters", "Duplicated Row", "Duplicated School")
STATUSES = [(500, "Vice President"), (250, "PMC Member"), (100, "Contributor")]

PROGRAM_SCHEMA = "id int, degree string, department string, school string"


def persons(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        PERSONS, "id int, name string, graduate_program int, spark_status array<int>"
    )


def programs(spark: SparkSession, repeated: bool = False) -> DataFrame:
    rows = PROGRAMS + [REPEATED_PROGRAM] if repeated else PROGRAMS
    return spark.createDataFrame(rows, PROGRAM_SCHEMA)


def statuses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATUSES, "id int, status string")
