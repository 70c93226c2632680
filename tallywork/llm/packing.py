"""Fixed-length rows of token ids, packed best-fit-decreasing."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession

from tallywork.llm.shared import table, with_texts

LENGTH = 2_048  # ids of a row
WINDOW_TOKENS = 4_000_000  # ids a task gathers before it packs them (8 MB)
SCHEMA = (
    "n_tokens int, n_segments int, doc_ids array<long>, starts array<long>, "
    "cu_seqlens array<int>, position_resets array<int>, input_ids binary"
)


class Capacities:
    """Open rows by free room, in a segment tree over the room sizes.

    A node counts the rows below it, so the least sufficient room is found by one way up and
    down the tree.
    """

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) of the fullest row with at least ``need`` left."""
        node = self.leaves + need
        if not self.counts[node]:
            while True:
                if node <= 1:
                    return None
                if node % 2 == 0 and self.counts[node + 1]:
                    node += 1
                    break
                node //= 2
            while node < self.leaves:
                node *= 2
                if not self.counts[node]:
                    node += 1
        room = node - self.leaves
        row = self.rows[room].pop()
        self._count(room, -1)
        return room, row

    def _count(self, room: int, change: int) -> None:
        node = self.leaves + room
        while node:
            self.counts[node] += change
            node //= 2


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Item numbers by row; longest items first, each into the fullest row that takes it."""
    rows: list[list[int]] = []
    open_rows = Capacities(length)
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = open_rows.take(sizes[item])
        if found is None:
            found = (length, len(rows))
            rows.append([])
        room, row = found
        rows[row].append(item)
        if room > sizes[item]:
            open_rows.add(room - sizes[item], row)
    return rows


def position_ids(cu_seqlens, length: int) -> np.ndarray:
    """Positions of a row: from 0 in each segment and in the padding behind the last."""
    ends = np.append(np.asarray(cu_seqlens), length)
    return np.concatenate([np.arange(n) for n in np.diff(ends)])


def rank_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Default vocabulary: a rank file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    pairs = (line.split() for line in ranks.splitlines() if line)
    known = {base64.b64decode(token): int(rank) for token, rank in pairs}
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=known, special_tokens={})


def _record(pieces: list[tuple[object, int, np.ndarray]], length: int, pad: int, kind) -> tuple:
    ids = np.full(length, pad, kind)
    ends = np.cumsum([0, *[len(p) for _, _, p in pieces]])
    ids[: ends[-1]] = np.concatenate([p for _, _, p in pieces])
    return (
        int(ends[-1]), len(pieces), [d for d, _, _ in pieces], [s for _, s, _ in pieces],
        ends.tolist(), ends[:-1].tolist(), ids.tobytes(),
    )


def pack(
    docs: DataFrame,
    path: str,
    pattern: str,
    length: int = LENGTH,
    window_tokens: int = WINDOW_TOKENS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Encode documents and lay their ids out in rows of ``length``.

    Every document is followed by an end id, the first free one, which also pads. Null and
    empty texts give the end id alone, so every row of the input is found in the result. A
    document longer than a row is cut into whole rows and a remainder, without loss. A row has
    ``input_ids`` (little-endian integers of two bytes, or four for large vocabularies; the
    column of a file is its id matrix), ``n_tokens`` without padding, and by segment
    ``doc_ids``, ``starts`` (place in the document's ids), ``cu_seqlens`` (cumulative lengths
    from 0) and ``position_resets`` (where positions restart).

    Each task packs what it reads, in windows of ``window_tokens``, so memory is bounded,
    nothing is shuffled, and a lost task is done again from its part of the input alone.
    Which segments share a row depends on how the input is split into tasks.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(Path(path).read_text(encoding="ascii"))  # under a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(ranks.value, pattern)
        end = encoding.max_token_value + 1
        kind = np.dtype("<u2" if end < 2**16 else "<u4")
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        kinds = [
            pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
            pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(),
        ]

        def batch_of(records: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*records, strict=True)) or [[]] * len(names)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def packed(items: list) -> Iterator[pa.RecordBatch]:
            rows = best_fit_decreasing([len(p) for _, _, p in items], length)
            for low in range(0, len(rows), 512):
                chosen = rows[low : low + 512]
                yield batch_of([_record([items[i] for i in row], length, end, kind) for row in chosen])

        waiting: list[tuple[object, int, np.ndarray]] = []
        size = 0
        for batch in batches:
            whole = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoding.encode_to_numpy(value.as_py() or "", disallowed_special=())
                ids = np.append(ids, end).astype(kind)
                cut = len(ids) // length * length
                for start in range(0, cut, length):
                    whole.append(_record([(doc, start, ids[start : start + length])], length, end, kind))
                    if len(whole) == 512:
                        yield batch_of(whole)
                        whole = []
                if cut < len(ids):
                    waiting.append((doc, cut, ids[cut:].copy()))
                    size += len(ids) - cut
                if size >= window_tokens:
                    yield from packed(waiting)
                    waiting, size = [], 0
            if whole:
                yield batch_of(whole)
        if waiting:
            yield from packed(waiting)

    return with_texts(docs).selectExpr(f"CAST(`{key}` AS BIGINT) AS `{key}`", f"`{text}`").mapInArrow(run, SCHEMA)


def op10_packed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in packed rows of ids."""
    import public_tokenizers

    return pack(table(spark, folder, "documents"), rank_file(), public_tokenizers.PATTERN)
