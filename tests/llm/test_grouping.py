"""Packed documents: nothing lost, no gaps, ids as the public library gives them, few sequences."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywork.llm import grouping
from tallywork.llm.packing import rank_file
from tallywork.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected_pieces(library, docs, capacity):
    """Every piece as the contract says, by the public library."""
    answer = []
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        whole, first = divmod(len(ids), capacity)
        cuts = ([first] if first else []) + [capacity] * whole
        for piece, start in enumerate(itertools.accumulate(cuts[:-1], initial=0)):
            own = ids[start : start + cuts[piece]]
            answer.append((doc, piece, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(answer, key=str)


def check(found, pieces, capacity):
    assert sorted((tuple(r)[:5] for r in found), key=str) == pieces
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        place = 0
        for offset, length in sorted(parts):
            assert offset == place
            place += length
        assert place <= capacity
    return len(bins)


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def packed(docs, capacity=1_024, **more):
    return grouping.packed(docs, rank_file(), public_tokenizers.PATTERN, capacity, **more)


def plain_best_fit(sizes, capacity):
    rooms = []
    for size in sorted(sizes, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= size]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= size
        else:
            rooms.append(capacity - size)
    return len(rooms)


def test_query_packs_all_documents(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op12_best_fit_packing"](spark, SMALL)
    assert found.columns == COLUMNS
    pieces = expected_pieces(library, docs, 1_024)
    number = check(found.collect(), pieces, 1_024)
    lengths = Counter(p[3] for p in pieces)
    assert number <= plain_best_fit([p[3] for p in pieces], 1_024)
    assert number <= grouping.least_bins(lengths, 1_024) + 1


def test_odd_documents(spark, library):
    texts = ["", None, "a", "<|endoftext|> in <|endoftext|>", "ünï日本 ​ 🙂", "\x00\x01", "x" * 3_000, "word " * 5_000]
    docs = list(enumerate(texts)) + [(3, "again"), (3, "again"), (None, "no id"), (-7, "less")]
    docs += [(n, "to be " * (n % 11)) for n in range(100, 300)]
    clashing = ["piece", "length", "part", "nth", "ids", "offset", "sequence_id", "number", "k", "t"]
    found = packed(frame(spark, docs).withColumns({c: F.lit("x") for c in clashing}), 64, with_ids=True)
    found = found.persist()
    pieces = expected_pieces(library, docs, 64)
    check(found.select(COLUMNS).collect(), pieces, 64)
    rows = grouping.sequences(found).collect()
    joined = {r["sequence_id"]: r["input_ids"] for r in rows}
    for r in found.collect():
        assert joined[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == list(r["ids"])
    assert sum(map(len, joined.values())) == sum(p[3] for p in pieces)
    assert all(sum(r["lengths"]) == len(r["input_ids"]) <= 64 for r in rows)


def test_no_documents(spark):
    found = packed(frame(spark, []))
    assert found.collect() == [] and found.select(COLUMNS).columns == COLUMNS


def test_long_text_is_cut_without_loss(spark, library):
    docs = [(1, " ".join(f"w{n}" for n in range(200_000))), (2, "short")]
    check(packed(frame(spark, docs)).collect(), expected_pieces(library, docs, 1_024), 1_024)


@pytest.mark.parametrize("seed", range(4))
def test_counted_best_fit_is_best_fit(seed):
    draw = random.Random(seed)
    sizes = [draw.choice([draw.randrange(1, 101), draw.randrange(20, 40)]) for _ in range(400)]
    demand = Counter(sizes)
    packing = grouping.best_fit(demand, sorted(demand, reverse=True), {}, 100)
    assert grouping.used(packing) == demand and max(map(sum, packing)) <= 100
    assert sum(packing.values()) == plain_best_fit(sizes, 100) >= grouping.least_bins(demand, 100)


def test_operators_keep_every_item():
    rng = np.random.default_rng(0)
    demand = {int(x): int(rng.integers(1, 9)) for x in rng.choice(np.arange(1, 101), 60, replace=False)}
    one, other = (grouping.least_slack(demand, {}, 100, rng) for _ in range(2))
    for _ in range(50):
        child = grouping.mutated(grouping.crossed(one, other, demand, 100, rng), 100, rng)
        assert grouping.used(child) == demand and max(map(sum, child)) <= 100
        one, other = other, child


def test_least_bins_is_below_the_best_packing():
    def best(sizes):  # exact, by trying each bin for each item
        rooms, least = [], [len(sizes)]

        def put(i):
            if len(rooms) >= least[0]:
                return
            if i == len(sizes):
                least[0] = len(rooms)
                return
            for j in range(len(rooms)):
                if rooms[j] >= sizes[i]:
                    rooms[j] -= sizes[i]
                    put(i + 1)
                    rooms[j] += sizes[i]
            rooms.append(10 - sizes[i])
            put(i + 1)
            rooms.pop()

        put(0)
        return least[0]

    draw = random.Random(1)
    for _ in range(150):
        sizes = sorted((draw.randrange(1, 11) for _ in range(draw.randrange(1, 9))), reverse=True)
        demand = Counter(sizes)
        found = sum(grouping.evolved([], demand, 10, (0,), 32)[0].values())
        assert grouping.least_bins(demand, 10) <= best(sizes) == found


def test_islands_beat_best_fit_and_repeat_themselves(spark):
    # Triples that fill a bin exactly, a hard case for best fit: 40 bins are enough.
    draw = random.Random(2)
    demand = Counter()
    for _ in range(40):
        one, two = draw.randrange(260, 380), draw.randrange(260, 380)
        demand.update([one, two, 1_000 - one - two])
    found = grouping.fewest_bins(spark, dict(demand), 1_000, islands=3)
    again = grouping.fewest_bins(spark, dict(demand), 1_000, islands=3)
    assert grouping.used(found) == demand and found == again
    greedy = grouping.best_fit(demand, sorted(demand, reverse=True), {}, 1_000)
    assert 40 <= sum(found.values()) < sum(greedy.values())


def test_counts_beyond_any_corpus():
    # The work follows the number of lengths, not of documents.
    demand = {700: 10**12, 324: 10**12 + 5, 300: 7, 1: 10**9}
    packing = grouping.evolved([], demand, 1_024, (0,), 8)[0]
    assert grouping.used(packing) == demand and sum(packing.values()) <= 10**12 + 3 + 10**6


def test_hot_length_is_numbered_over_tasks(spark):
    docs = spark.range(0, 9_000, 1, 6).selectExpr("id AS doc_id", "if(id % 3 = 0, '', repeat('a ', int(id % 50))) AS text")
    found = packed(docs).select("doc_id", "sequence_id", "offset", "length")
    assert found.count() == 9_000 and found.select("sequence_id", "offset").distinct().count() == 9_000
