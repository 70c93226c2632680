"""Document quality by gated attention over passages (multiple-instance learning)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.shared import added, held_out, labelled_sample, table, with_column, with_texts

PASSAGE_WORDS = 64
SHAPES = 128  # buckets of character-shape sequences
FACTS = 7
WIDTH, GATE = 24, 12  # of a passage's representation and of the attention
SAMPLE_PER_CLASS = (3_000, 5_000)  # documents of low and high quality to learn from, at most
SAMPLE_CHARS = (12_000_000, 18_000_000)  # of their whole texts together
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.01, 1e-4
THRESHOLD = 0.3


def _character_classes() -> np.ndarray:
    """A class for each byte: letters by case, digits, marks by use, parts of longer characters."""
    classes = np.full(256, 15, np.uint8)
    groups = [" ", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
              ".", ",;:", "!?", "'\"`", "|", "()[]{}<>", "-_/\\", "#", "$%&*@", "+=~^"]
    for number, group in enumerate(groups):
        classes[[ord(c) for c in group]] = number
    classes[128:] = 14
    return classes


CLASSES = _character_classes()


def encode_passages(text: str | None) -> np.ndarray:
    """One row of features for each passage of a whole text; a single row of zeros without words.

    Shares of character-shape sequences, and facts on the words: how many differ, how many are
    short, their length, and how many start upper-case.
    """
    words = (text or "").split()
    if not words:
        return np.zeros((1, SHAPES + FACTS), np.float32)
    passages = [words[i : i + PASSAGE_WORDS] for i in range(0, len(words), PASSAGE_WORDS)]
    joined = [" ".join(p).encode("utf-8", "replace") + b" " for p in passages]
    sizes = np.array([len(b) for b in joined])
    shape = CLASSES[np.frombuffer(b"".join(joined) + b"  ", np.uint8)].astype(np.int64)
    sequence = shape[:-2] * 256 + shape[1:-1] * 16 + shape[2:]
    bucket = (sequence * 2_654_435_761 % 2**32) * SHAPES >> 32
    owner = np.repeat(np.arange(len(joined)), sizes)
    counts = np.bincount(owner * SHAPES + bucket, minlength=len(joined) * SHAPES)
    x = np.empty((len(joined), SHAPES + FACTS), np.float32)
    x[:, :SHAPES] = np.sqrt(counts.reshape(len(joined), SHAPES) / sizes[:, None])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.arange(0, len(words), PASSAGE_WORDS)
    n = np.diff(np.append(starts, len(words)))
    x[:, SHAPES] = [len(set(p)) for p in passages] / n
    x[:, SHAPES + 1] = np.add.reduceat(lengths <= 3, starts) / n
    x[:, SHAPES + 2] = np.minimum(np.add.reduceat(lengths, starts) / n / 10, 5)
    x[:, SHAPES + 3] = np.minimum(np.maximum.reduceat(lengths, starts) / 40, 5)
    x[:, SHAPES + 4] = np.log1p(n) / 4
    x[:, SHAPES + 5] = min(np.log1p(len(words)) / 8, 3)
    x[:, SHAPES + 6] = [sum(w[:1].isupper() for w in p) for p in passages] / n
    return x


@dataclass
class QualityModel:
    """Weights of encoder, attention and classifier."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of documents whose passages are the rows of ``x`` from each start on."""
        p = self.parts
        z = (x - self.mean) / self.scale
        h = np.tanh(z @ p["encode"] + p["encode0"])
        v, u = np.tanh(h @ p["look"]), 1 / (1 + np.exp(-(h @ p["gate"])))
        raw = (v * u) @ p["attend"]
        n = np.diff(np.append(starts, len(x)))
        owner = np.repeat(np.arange(len(starts)), n)
        weight = np.exp(raw - np.maximum.reduceat(raw, starts)[owner])
        weight /= np.add.reduceat(weight, starts)[owner]
        bag = np.add.reduceat(weight[:, None] * h, starts)
        logit = np.clip(bag @ p["judge"] + p["judge0"], -30, 30)
        return dict(z=z, h=h, v=v, u=u, owner=owner, weight=weight, bag=bag, score=1 / (1 + np.exp(-logit)))

    def slopes(self, state: dict[str, np.ndarray], error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients, given each document's error of its logit."""
        p, s = self.parts, state
        from_bag = (error[:, None] * p["judge"])[s["owner"]]
        value = (from_bag * s["h"]).sum(1)
        mean_value = (error * (s["bag"] @ p["judge"]))[s["owner"]]
        raw = (s["weight"] * (value - mean_value))[:, None]
        v = raw * p["attend"] * s["u"] * (1 - s["v"] ** 2)
        u = raw * p["attend"] * s["v"] * s["u"] * (1 - s["u"])
        h = (s["weight"][:, None] * from_bag + v @ p["look"].T + u @ p["gate"].T) * (1 - s["h"] ** 2)
        return {
            "encode": s["z"].T @ h, "encode0": h.sum(0), "look": s["h"].T @ v, "gate": s["h"].T @ u,
            "attend": (raw * s["v"] * s["u"]).sum(0), "judge": s["bag"].T @ error, "judge0": error.sum(keepdims=True),
        }


def train_quality(sample: list[tuple[str, int]], share: float | None) -> QualityModel | float:
    """Adam on the cross entropy of document labels; the same weights for the same sample.

    ``share`` is the share of label 1 in the corpus, by which the labels are weighed. Where a
    label is missing there is nothing to tell apart, and the share itself is the score.
    """
    y = np.array([v for _, v in sample], float)
    if len(set(y)) < 2:
        return share or 0.0
    bags = [encode_passages(t) for t, _ in sample]
    every = np.concatenate(bags)
    rng = np.random.default_rng(3)
    wide = SHAPES + FACTS

    def drawn(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

    parts = {
        "encode": drawn(wide, WIDTH), "encode0": np.zeros(WIDTH), "look": drawn(WIDTH, GATE),
        "gate": drawn(WIDTH, GATE), "attend": drawn(GATE), "judge": drawn(WIDTH), "judge0": np.zeros(1),
    }
    model = QualityModel(every.mean(0), every.std(0) + 0.02, parts)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    first = {k: np.zeros_like(v) for k, v in parts.items()}
    second = {k: np.zeros_like(v) for k, v in parts.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for low in range(0, len(order), BATCH):
            some = order[low : low + BATCH]
            sizes = [len(bags[i]) for i in some]
            state = model.forward(np.concatenate([bags[i] for i in some]), np.cumsum([0, *sizes[:-1]]))
            error = weight[some] * (state["score"] - y[some]) / len(some)
            step += 1
            for k, slope in model.slopes(state, error).items():
                slope = slope + DECAY * parts[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                parts[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def with_quality(docs: DataFrame, model: QualityModel | float, score: str = "score", text: str = "text") -> DataFrame:
    """All rows and columns with a score (0 to 1) of the whole text.

    A null or blank text scores as one passage of zeros. Nothing is shuffled and no row is
    moved; repeated rows score alike. ``score`` must not be a column already.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 40 kB
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            scores = [
                known
                if isinstance(known, float)
                else float(known.forward(encode_passages(v.as_py()), np.array([0]))["score"][0])
                for v in batch.column(place)
            ]
            yield with_column(batch, score, pa.array(scores, pa.float64()))

    return with_texts(docs).mapInArrow(run, added(docs.schema, score))


def quality(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Train on the labelled documents outside the fold and score all documents.

    Returns ``doc_id``, ``held_out``, ``score`` and ``predicted`` (1 from ``THRESHOLD`` on).
    Without usable labels every score is the share of label 1, or 0. A null id is
    not held out.
    """
    sample, share = labelled_sample(docs, labels, "quality", folds, fold, SAMPLE_PER_CLASS, SAMPLE_CHARS)
    return with_quality(docs.select("doc_id", "text"), train_quality(sample, share)).select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents."""
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
