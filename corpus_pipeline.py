"""A corpus from raw documents to token ids: quality, toxicity, near copies, mixture, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm import bpe, minhash, mixing, quality, toxicity
from tallywork.llm.shared import labelled_sample, table, written


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    while name in docs.columns:
        name += "_"
    return name


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = table(spark, sf_dir, "labels")
    sample, share = labelled_sample(
        docs, labels, "quality", 5, 0, quality.SAMPLE_PER_CLASS, quality.SAMPLE_CHARS
    )
    if not sample:  # nothing to learn from: nothing is rejected
        return docs
    score = _unused(docs, "_score")
    scored = quality.with_quality(docs, quality.train_quality(sample, share), score)
    return scored.where(F.col(score) >= quality.THRESHOLD).select(*docs.columns)


def civil_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    labels = table(spark, sf_dir, "labels")
    sample, share = labelled_sample(
        docs, labels, "toxic", 4, 2, toxicity.SAMPLE_PER_CLASS, toxicity.SAMPLE_CHARS
    )
    if not sample:
        return docs
    score = _unused(docs, "_score")
    scored = toxicity.with_toxicity(docs, toxicity.train_toxicity(sample, share), score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies; documents without an id stay as they are.

    Texts count, not ids: a text that is like no other stays, whatever its id has besides.
    """
    return minhash.one_of_each(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, laid out so that runs of slots of the mixture lie together.

    The mixture is an order: no document is left out for being of a large source. The layout
    saves the next stages work only; the order itself is told by ``encoded_documents``.
    """
    # The operator's own columns are called mix_...; such columns of the documents step aside.
    aside = {c: _unused(docs, f"kept_{c}") for c in docs.columns if c.startswith("mix_")}
    placed = mixing.mixed(docs.withColumnsRenamed(aside), mixing.WEIGHTS, mixing.REST_WEIGHT)
    return mixing.in_order(placed).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded texts of the corpus as digests, and each document's place in the mixture.

    ``mix_slot`` and ``mix_place`` say in which order the documents are to be read, whatever
    files and partitions they lie in. They are worked out on the digests, which are short.
    """
    digests = written(bpe.digests(docs, carry=("source",)), "digests")
    return mixing.in_order(mixing.mixed(digests, mixing.WEIGHTS, mixing.REST_WEIGHT))


STAGES = [
    ("quality", good_documents),
    ("toxicity", civil_documents),
    ("near_dedup", distinct_documents),
    ("mixture", mixed_documents),
    ("encoding", encoded_documents),
]

# The classifiers and the tokenizer are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; every result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = written(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
