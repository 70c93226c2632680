"""Small helpers shared by the tests."""

import contextlib
import io
from collections import Counter

# Thresholds low enough for AQE to treat test data as it treats large partitions.
SMALL_SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


def plan(df, mode="formatted"):
    """The text of the physical plan."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def final_plan(df):
    """The plan that AQE settled on, after running the frame."""
    df.collect()
    return plan(df, "simple").split("== Initial Plan ==")[0]


def rows(df, *columns):
    """Rows as sorted tuples, nulls first."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: [(value is not None, str(value)) for value in row])


def same_rows(left, right):
    """Whether two small frames hold the same columns and rows, repeated rows included."""
    sides = [Counter(repr(tuple(row)) for row in df.collect()) for df in (left, right)]
    return left.columns == right.columns and sides[0] == sides[1]
