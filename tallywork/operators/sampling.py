"""Sampling and splitting by a hash of the row's key.

``DataFrame.sample`` and ``randomSplit`` draw by position within a partition, so a rerun on
another layout gives other rows. A hash of the key gives the same rows on any layout, after
a lost executor too, and needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1_000_000


def hash_bucket(keys: Sequence[str], seed: int, portable: bool = False) -> Column:
    """A bucket from 0 to 999,999. ``portable`` hashes with MD5, as other engines can too."""
    if portable:
        text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
        number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    else:
        number = F.xxhash64(*keys, F.lit(seed))
    return F.pmod(number, F.lit(BUCKETS))


def hash_sample(
    df: DataFrame, keys: Sequence[str], fraction: float, seed: int, portable: bool = False
) -> DataFrame:
    """About ``fraction`` of the rows, without replacement; ``keys`` should identify a row."""
    return df.where(hash_bucket(keys, seed, portable) < round(fraction * BUCKETS))


def hash_parts(
    df: DataFrame,
    keys: Sequence[str],
    weights: Sequence[float],
    seed: int,
    portable: bool = False,
) -> DataFrame:
    """Number each row's part (``part``, from 0) by weight: disjoint parts that sum to the whole."""
    whole = sum(weights)
    bucket = hash_bucket(keys, seed, portable)
    part = F.lit(len(weights) - 1)
    upper = sum(weights[:-1])
    for number in range(len(weights) - 2, -1, -1):
        part = F.when(bucket < round(upper / whole * BUCKETS), number).otherwise(part)
        upper -= weights[number]
    return df.withColumn("part", part)


def hash_split(
    df: DataFrame, keys: Sequence[str], weights: Sequence[float], seed: int
) -> list[DataFrame]:
    """The parts as frames of their own."""
    numbered = hash_parts(df, keys, weights, seed)
    return [
        numbered.where(F.col("part") == number).drop("part") for number in range(len(weights))
    ]
