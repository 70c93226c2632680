"""User-defined functions in the vectorised form, for use as columns and in SQL text."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _third_power():
    # A local function travels to the executors by value: they need not have this package.
    def power3(number: pd.Series) -> pd.Series:
        value = number.astype("float64")
        return value * value * value

    return F.pandas_udf(power3, T.DoubleType())


# Third power as a double, for whole numbers too; null stays null.
power3 = _third_power()


def power3_native(number: Column) -> Column:
    """The same inside the JVM: prefer this where no user code is needed."""
    value = number.cast("double")
    return value * value * value


def register_udfs(spark: SparkSession) -> None:
    """Make the functions callable by name in SQL text and ``selectExpr``."""
    spark.udf.register("power3", power3)
