"""What a frame reads, known before it runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Below this many bytes of input a few tasks hold everything, so hot keys are not worth a pass
# of their own. It picks the plan and never the rows.
SMALL_INPUT_BYTES = 32 * 1024 * 1024


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables that a frame reads, as the optimizer knows them.

    Nothing is run for it. Sizes of joins are only guessed at by the optimizer, so the leaves of
    the plan are added up; one of unknown size counts as very large.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def reads_little(*frames: DataFrame) -> bool:
    return sum(input_bytes(df) for df in frames) < SMALL_INPUT_BYTES
