"""Arrays of words, structs and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words(text: Column) -> Column:
    return F.split(text, " ")


def word_at(text: Column, position: int) -> Column:
    """The word at a zero-based position, null past the end."""
    return F.get(words(text), F.lit(position))


def explode_words(df: DataFrame, text: str, word: str, keep_empty: bool = False) -> DataFrame:
    """One row per word. Rows without text go, unless ``keep_empty`` is set."""
    explode = F.explode_outer if keep_empty else F.explode
    return df.withColumn(word, explode(words(F.col(text))))
