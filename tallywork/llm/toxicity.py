"""Toxicity by the difference of compressed lengths under two zstandard dictionaries."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.shared import added, held_out, labelled_sample, table, with_column, with_texts

SAMPLE_PER_CLASS = (12_000, 3_000)  # ordinary and toxic documents to learn from, at most
SAMPLE_CHARS = (36_000_000, 10_000_000)  # of their whole texts together
PIECE, PIECES = 64, 60_000  # bytes and number of the pieces that the ordinary dictionary is trained on
WINDOW, STEP = 256, 208  # bytes
ORDINARY_BYTES = 8_192  # dictionary of ordinary text
TOXIC_BYTES = 8_192  # what the toxic dictionary has besides
SEQUENCES = (5, 7, 9)  # lengths of the byte sequences that tell toxic words
LEAST_SHARE = 0.02  # of toxic documents that have such a sequence
LEAST_RATIO = 120  # times as frequent in toxic as in ordinary documents
COUNTERS = 1 << 22
THRESHOLD = 0.3

# Optimal parsing; matches under six bytes, which any two texts share, count for nothing.
PARAMETERS = dict(
    window_log=17, hash_log=15, chain_log=15, search_log=4, min_match=6, target_length=64,
    strategy=zstandard.STRATEGY_BTOPT,
    write_content_size=False, write_checksum=False, write_dict_id=False,
)


def normalised(text: str | None) -> bytes:
    """Lower case, words parted by one space."""
    return b" " + b" ".join((text or "").lower().encode("utf-8", "replace").split()) + b" "


def windows(text: bytes) -> list[bytes]:
    """Overlapping windows over the whole text."""
    return [text[i : i + WINDOW] for i in range(0, max(1, len(text) - WINDOW + STEP), STEP)]


def _sequences(text: bytes, length: int) -> np.ndarray:
    """Counter numbers of the byte sequence that starts at each place."""
    x = np.frombuffer(text, np.uint8).astype(np.uint64)
    n = len(x) - length + 1
    if n <= 0:
        return np.empty(0, np.int64)
    h = np.full(n, length, np.uint64)
    for i in range(length):
        h = (h ^ x[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h % np.uint64(COUNTERS)).astype(np.int64)


def _document_counts(texts: list[bytes]) -> np.ndarray:
    counts = np.zeros(COUNTERS, np.int32)
    for t in texts:
        counts[np.unique(np.concatenate([_sequences(t, k) for k in SEQUENCES]))] += 1
    return counts


def _toxic_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words of toxic documents with a sequence that ordinary ones lack; most frequent first."""
    in_toxic, in_ordinary = _document_counts(toxic), _document_counts(ordinary)
    rate = in_toxic / len(toxic)
    telling = (in_toxic >= max(3, LEAST_SHARE * len(toxic))) & (
        rate >= LEAST_RATIO * in_ordinary / len(ordinary)
    )
    words: Counter = Counter()
    for t in toxic:
        spaces = np.flatnonzero(np.frombuffer(t, np.uint8) == 32)
        found = set()
        for k in SEQUENCES:
            at = np.flatnonzero(telling[_sequences(t, k)])
            word = np.searchsorted(spaces, at, "right") - 1
            word, at = word[word + 1 < len(spaces)], at[word + 1 < len(spaces)]
            inside = at + k - 1 <= spaces[word + 1]
            found |= {t[spaces[w] : spaces[w + 1] + 1] for w in np.unique(word[inside])}
        words.update(found)
    return [w for w, _ in sorted(words.items(), key=lambda item: (-item[1], item[0]))]


def drawn_pieces(texts: list[bytes]) -> list[bytes]:
    """Pieces from anywhere in the texts: all of them, or about ``PIECES`` drawn by their checksum."""
    every = -(-sum(map(len, texts)) // (PIECE * PIECES))
    pieces = (t[i : i + PIECE] for t in texts for i in range(0, len(t), PIECE))
    return [p for p in pieces if zlib.crc32(p) % every == 0]


def _trained(size: int, samples: list[bytes]) -> bytes:
    """A zstandard dictionary; too few samples to train on are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


@dataclass(frozen=True)
class ToxicityModel:
    """Dictionaries of ordinary text and of toxic words beside it, and a calibrated threshold."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last is the constant

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        """For ordinary and toxic text. The first has zeros where the second has its words, so
        their lengths differ only by matches with these words."""
        parameters = zstandard.ZstdCompressionParameters(**PARAMETERS)
        made = []
        for extra in (b"\0" * len(self.toxic), self.toxic):
            data = (self.ordinary + extra).ljust(16, b"\0")
            words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(compression_params=parameters)
            made.append(zstandard.ZstdCompressor(dict_data=words, compression_params=parameters))
        return made[0], made[1]

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.c_[(features - self.mean) / self.scale, np.ones(len(features))]
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def features(text: bytes, compressors) -> list[float]:
    """What the windows' savings under the toxic dictionary come to."""
    ordinary, toxic = compressors
    saved = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in windows(text)], float)
    top = np.sort(saved)[::-1]
    counts = [(saved >= k).sum() for k in (2, 3, 4, 6)]
    return [
        top[0], top[:2].mean(), top[:4].mean(), saved.mean(), saved.sum() / len(saved) ** 0.5,
        *[c / len(saved) for c in counts], np.log1p(counts[1]), np.log1p(counts[3]),
    ]


def _calibrated(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge @ w
        w -= np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, slope)
    return w


def train_toxicity(sample: list[tuple[str, int]], share: float | None) -> ToxicityModel | float:
    """Dictionaries from two thirds of the sample, thresholds from the rest.

    ``share`` is the share of label 1 in the corpus; the calibration weighs the labels by it.
    Where a label is missing there is nothing to tell apart, and the share itself is the score.
    """
    texts = [(normalised(t), v) for t, v in sample]
    learn, rest = [s for i, s in enumerate(texts) if i % 3], texts[::3]
    toxic, ordinary = ([t for t, v in learn if v == k] for k in (1, 0))
    if not toxic or not ordinary or len({v for _, v in rest}) < 2:
        return share or 0.0
    base = _trained(ORDINARY_BYTES, drawn_pieces(ordinary))
    words, size = [], 0
    for word in _toxic_words(toxic, ordinary):
        size += len(word)
        if size > TOXIC_BYTES:
            break
        words.append(word)
    model = ToxicityModel(base, b"".join(words[::-1]), np.zeros(1), np.ones(1), np.zeros(2))
    pair = model.compressors()
    x = np.array([features(t, pair) for t, _ in rest])
    y = np.array([v for _, v in rest], float)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    weights = _calibrated(np.c_[(x - mean) / scale, np.ones(len(x))], y, weight)
    return ToxicityModel(model.ordinary, model.toxic, mean, scale, weights)


def with_toxicity(docs: DataFrame, model: ToxicityModel | float, score: str = "score", text: str = "text") -> DataFrame:
    """All rows and columns with a score (0 to 1) of the whole text; null scores as an empty text.

    Nothing is shuffled and no row is moved; repeated rows score alike. ``score`` must not be a
    column already.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 20 kB
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        pair = None if isinstance(known, float) else known.compressors()
        for batch in batches:
            if pair is None:
                scores = np.full(len(batch), known)
            elif len(batch):
                scores = known.scores(np.array([features(normalised(v.as_py()), pair) for v in batch.column(place)]))
            else:
                scores = np.empty(0)
            yield with_column(batch, score, pa.array(scores, pa.float64()))

    return with_texts(docs).mapInArrow(run, added(docs.schema, score))


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """Train on the labelled documents outside the fold and score all documents.

    Returns ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``THRESHOLD`` on).
    Without usable labels every score is the share of label 1, or 0. A null id is not held out.
    """
    sample, share = labelled_sample(docs, labels, "toxic", folds, fold, SAMPLE_PER_CLASS, SAMPLE_CHARS)
    return with_toxicity(docs.select("doc_id", "text"), train_toxicity(sample, share)).select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents."""
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
