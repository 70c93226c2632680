"""Helpers on vectors that the two vector operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """Rows with an id and a vector that is not null, empty or zero, of finite components only."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(
        F.col(key).isNotNull() & F.col(vector).isNotNull() & fine & F.exists(vector, lambda x: x != 0)
    )


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Packed doubles, all of one length, as rows."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal keys, from batches that are sorted by these keys.

    Holds one batch and the run that is not yet known to end.
    """
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        rest = now if rest is None else pa.concat_tables([rest, now])
        cuts = _cuts(rest, keys)
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            yield rest.slice(low, high - low)
        rest = rest.slice(cuts[-1])
    if rest is not None and len(rest):
        yield rest


def _cuts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where runs start; the last start is where an unfinished run begins."""
    if not len(rows):
        return np.zeros(1, np.int64)
    parts = np.stack([rows[k].to_numpy() for k in keys])
    return np.concatenate([[0], np.flatnonzero((parts[:, 1:] != parts[:, :-1]).any(0)) + 1])
