"""Byte-level BPE by dynamic programming over prefixes."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.shared import table, with_texts

# Fixed value: the pattern that byte-level vocabularies of this family split text by.
PIECES = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
CACHED_PIECES = 500_000  # encoded pieces a task remembers
CACHED_PAIRS = 200_000  # outcomes of pair tests a task remembers
CACHED_LENGTH = 32  # longer pieces are encoded each time
START = -1  # stands left of a text's first token


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Default vocabulary: a file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_characters() -> str:
    """The printable character that stands for each byte: its own, or one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return "".join(chr(b) if b in own else chr(next(spare)) for b in range(256))


class Bpe:
    """Encoder and decoder of one vocabulary, given as the text of its JSON file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"]:
            raise ValueError("a byte-level BPE without a prefix space is needed")
        if spec["normalizer"] or model["ignore_merges"] or model["dropout"]:
            raise ValueError("normalizers, dropout and ignored merges are not supported")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {}  # of a token, as its merge joins them
        for i, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = (self.vocabulary[left], self.vocabulary[right])
            self.rank[key] = i
            self.halves.setdefault(self.vocabulary[left + right], key)
        self.added = {t["content"]: t["id"] for t in added}
        # Longest first: the alternation then takes the longest added token at a place.
        names = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None

        characters = _byte_characters()
        self.space = characters[32]
        self.to_characters = {b: c for b, c in enumerate(characters)}
        from_character = {c: b for b, c in enumerate(characters)}
        self.strings = {i: s for s, i in self.vocabulary.items()}
        self.bytes = {i: bytes(from_character[c] for c in s) for i, s in self.strings.items()}
        self.bytes |= {i: s.encode() for s, i in self.added.items()}

        self.table = pa.array([self.bytes.get(i, b"") for i in range(max(self.bytes) + 1)], pa.binary())

        # Every token that ends at a place of a text, found through suffix links in one pass.
        # Tokens that their own text is not encoded to never occur.
        self.suffixes = ahocorasick.Automaton()
        special = set(self.added.values())
        for string, i in self.vocabulary.items():
            if i not in special and self._reachable(string, i):
                self.suffixes.add_word(string, (i, len(string)))
        self.suffixes.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}

    def _reachable(self, string: str, token: int) -> bool:
        """Whether nothing crosses the border of a token's halves before they are merged."""
        if len(string) == 1:
            return True
        halves = self.halves.get(token)
        return halves is not None and self._stays_apart(*halves, below=self.rank[halves])

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """Tokens that stand at an end of a token's text while it is merged, each with the rank
        of the merge that makes it; the single byte first."""
        edge = []
        while (halves := self.halves.get(token)) is not None:
            edge.append((token, self.rank[halves]))
            token = halves[side]
        edge.append((token, -1))
        return edge[::-1]

    def _stays_apart(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether no merge joins the two tokens' texts across their border.

        Merges go by rank. At any time one token of each text stands at the border; a merge of
        these two comes about if its rank is below that of the next merge on either side (of
        equal ones the left goes first). ``below``: only merges of a lower rank count.
        """
        a, b = self._edge(left, 1), self._edge(right, 0)
        never = len(self.rank) if below is None else below
        i = j = 0
        while True:
            next_left = a[i + 1][1] if i + 1 < len(a) else never
            next_right = b[j + 1][1] if j + 1 < len(b) else never
            across = self.rank.get((a[i][0], b[j][0]), never)
            if across < next_left and across <= next_right and across < never:
                return False
            if next_left == next_right == never:
                return True
            if next_left <= next_right:
                i += 1
            else:
                j += 1

    def _tested(self, key: tuple[int, int]) -> bool:
        """Whether the two tokens side by side are what their joint text is encoded to."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        self.pairs[key] = fits = key[0] == START or self._stays_apart(*key)
        return fits

    def encode_piece(self, string: str) -> list[int]:
        """Ids of one piece, in byte characters.

        A sequence is the encoding of its text exactly if all neighbours are compatible, so
        every prefix has one last token: the one that is compatible with the last token of
        the prefix before it. Prefixes are settled from the left; back-pointers give the ids.
        """
        pairs = self.pairs
        last: list[int | None] = [None] * (len(string) + 1)
        last[0] = START
        for end, (token, width) in self.suffixes.iter(string):
            end += 1
            if last[end] is None and (before := last[end - width]) is not None:
                key = (before, token)
                fits = pairs.get(key)
                if self._tested(key) if fits is None else fits:
                    last[end] = token
        ids, place = [], len(string)
        while place:
            if last[place] is None:
                raise ValueError(f"the vocabulary has no token for a byte of {string!r}")
            ids.append(last[place])
            place -= len(self.strings[last[place]])
        return ids[::-1]

    def _packed_piece(self, piece: str) -> bytes:
        known = self.pieces.get(piece)
        if known is None:
            if piece.isascii() and (piece[1:] if piece[0] == " " else piece).isalpha():
                string = piece.replace(" ", self.space)
            else:
                string = piece.encode("utf-8").decode("latin-1").translate(self.to_characters)
            known = array("i", self.encode_piece(string)).tobytes()
            if len(piece) <= CACHED_LENGTH:
                if len(self.pieces) >= CACHED_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = known
        return known

    def forget(self) -> None:
        """Give the memory of both caches back; workers live on and do other work."""
        self.pairs, self.pieces = {}, {}

    def encode_packed(self, text: str | None) -> bytes:
        """Ids of a whole text as packed 32-bit integers."""
        if not text:
            return b""
        parts = self.special.split(text) if self.special else [text]
        packed: list[bytes] = []
        for n, part in enumerate(parts):
            if n % 2:
                packed.append(np.int32(self.added[part]).tobytes())
            else:
                packed.extend(map(self._packed_piece, PIECES.findall(part)))
        return b"".join(packed)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Texts of lists of ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        tokens = pa.ListArray.from_arrays(ids.offsets, self.table.take(ids.values))
        joined = pc.binary_join(tokens, b"")
        try:
            return joined.cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([v.as_py().decode("utf-8", "replace") for v in joined], pa.string())


@lru_cache(maxsize=2)
def _bpe(text: str) -> Bpe:
    """One encoder per worker process and vocabulary."""
    return Bpe(text)


def _vocabulary(spark: SparkSession, path: str):
    """The vocabulary file's text (a few megabytes at most), read by the driver for all tasks."""
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))


def encode(
    docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", back: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """``<key>`` and ``ids`` (array<int>) of every row's whole text; no ids for null or empty.

    With ``back`` also ``decoded``, the text of these ids, from the same pass: two passes would
    need twice the workers at a time.

    Adds no start or end tokens. An added token's string within a text gives its id, as the
    public library has it. Rows keep their order and partitions: nothing is shuffled. Repeated
    rows are encoded like any others; of other columns only those of ``carry`` are read and
    come after the key.
    """
    vocabulary = _vocabulary(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary.value)
        for batch in batches:
            packed = [bpe.encode_packed(v.as_py()) for v in batch.column(1)]
            offsets = np.zeros(len(packed) + 1, np.int64)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(packed), np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
            carried = {c: batch.column(2 + n) for n, c in enumerate(carry)}
            columns = {key: batch.column(0)} | carried | {"ids": ids} | ({"decoded": bpe.decode(ids)} if back else {})
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        bpe.forget()

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *carry))
    schema = f"{kinds}, ids array<int>" + (", decoded string" if back else "")
    return with_texts(docs).select(key, text, *carry).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """``<key>``, ``ids`` and ``decoded`` text of every row of ids; null ids decode to ''."""
    vocabulary = _vocabulary(encoded.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary.value)
        for batch in batches:
            ids = batch.column(1).fill_null([])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), bpe.decode(ids)], names=[key, "ids", "decoded"]
            )

    kind = encoded.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, ids array<int>, decoded string"
    return with_texts(encoded).select(key, "ids").mapInArrow(run, schema)


def digests(docs: DataFrame, path: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document the number of ids and the digests of ids and decoded text, after ``carry``."""
    path = path or tokenizer_file()
    both = encode(docs, path, back=True, carry=carry)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(
        "doc_id",
        *carry,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op7_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids and decoded texts of all documents, as digests."""
    return digests(table(spark, folder, "documents"))
