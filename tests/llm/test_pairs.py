"""Near-duplicate documents and vectors against brute force, and their odd rows."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from support import rows
from tallywork.llm import minhash, pivots, shared
from tallywork.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_documents(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    links = [
        (i, j)
        for k, (i, x) in enumerate(sets)
        for j, y in sets[:k]
        if x and y and 100 * len(x & y) >= 75 * len(x | y)
    ]
    found = brute_components([i for i, _ in sets], links)
    return sorted((i, len(s), found[i], found[i] == i) for i, s in sets)


def answer(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_documents_equal_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert answer(QUERIES["op1_minhash_near_dedup"](spark, SMALL)) == brute_documents(docs)


def test_drifting_copies_of_few_words(spark):
    # Each text is a change of an earlier one, so similarities lie on both sides of the bound.
    rng = random.Random(5)
    texts = [[f"w{rng.randrange(9999)}" for _ in range(rng.choice([6, 9, 40, 80]))] for _ in range(12)]
    for _ in range(220):
        words = list(rng.choice(texts))
        for _ in range(rng.choice([0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(9999)}"
        texts.append(words)
    docs = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(docs)
    found = answer(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert found == brute_documents(docs)


def test_large_buckets_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PART_ROWS", 7)
    monkeypatch.setattr(minhash, "BLOCK_SETS", 11)
    monkeypatch.setattr(minhash, "PARTNERS", 1)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(5)):
            words[rng.randrange(60)] = f"x{rng.randrange(999)}"
        docs.append((i, " ".join(words)))
    found = answer(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert found == brute_documents(docs)


def test_odd_documents(spark):
    long = "word " * 30_000 + "end"
    data = [
        (1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "one two", "x"), (5, "ONE\x0btwo", "x"),
        (6, "one two", "x"), (7, long, "x"), (8, long, "x"), (None, "one two", "x"), (9, "a b c d e f", None),
        (9, "a b c d e f", None), (10, "É b", "x"), (11, "é b", "x"),
    ]
    # Columns that the operator uses names of its own for.
    df = spark.createDataFrame(data, "doc_id long, text string, node string").withColumn("n", F.lit(1)).withColumn("band", F.lit(2))
    found = minhash.near_duplicates(df)
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by_id[1] == by_id[1] and [by_id[i][0][0] for i in (1, 2, 3)] == [0, 0, 0]
    assert [by_id[i][0][1] for i in (1, 2, 3)] == [1, 2, 3]
    assert by_id[5] == [(1, 4, False)] and by_id[4] == [(1, 4, True)] and by_id[6] == [(1, 6, True)]
    # Five words, and four words with the end: two shingles.
    assert by_id[7] == [(2, 7, True)] and by_id[8] == [(2, 7, False)]
    assert by_id[None] == [(1, None, True)]
    assert by_id[9] == [(2, 9, True)] * 2
    assert by_id[10][0][1] == 10 and by_id[11][0][1] == 11  # only A-Z is lower-cased


A, B = "a text of some ten words that all are its own", "quite another text and it has its very own ten words"


def test_rows_of_one_id_are_one_document(spark):
    # The id 5 is a copy of 3, and has a text of its own as well.
    docs = [(3, A), (5, A), (5, B)]
    found = answer(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert found == brute_documents(docs)
    assert [f[2:] for f in found] == [(3, True), (3, False), (3, False)]


def test_ids_with_several_texts_equal_brute_force(spark):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(200)}" for _ in range(30)) for _ in range(25)]
    texts += [t.replace("w1", "v1", 1) for t in texts[:10]] + ["", None, " "]
    docs = [(rng.randrange(40), rng.choice(texts)) for _ in range(90)] + [(7, texts[0])] * 3
    found = answer(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert found == brute_documents(docs)


def test_one_of_each_group_stays_and_no_unlike_text_goes(spark):
    data = [(3, A, "x"), (5, A, "y"), (5, B, "z"), (5, B, "z"), (None, A, "n"), (8, None, "e"), (8, "", "e"), (9, B + " more", "w")]
    df = spark.createDataFrame(data, "doc_id long, text string, _own string")
    found = minhash.one_of_each(df)
    assert found.columns == df.columns
    kept = sorted((tuple(r) for r in found.collect()), key=str)
    # An empty text is like no other; null counts as empty, and the two rows are one.
    assert [k[:2] for k in kept if k[0] in (3, None)] == [(3, A), (None, A)]
    assert len([k for k in kept if k[1] and k[1].startswith(B)]) == 1
    assert len([k for k in kept if k[0] == 8]) == 1 and len(kept) == 4
    assert minhash.one_of_each(df.limit(0)).collect() == []


def test_no_documents(spark):
    assert answer(minhash.near_duplicates(spark.createDataFrame([], DOCS))) == []


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (300, 200)]
    random.Random(1).shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    found = dict(rows(shared.components(df), "node", "component"))
    assert found == {i: 0 for i in range(61)} | {100: 100, 200: 100, 300: 100}
    assert rows(shared.components(df.where("a < 0"))) == []


def brute_vectors(data, least=0.98):
    known = []
    for i, (key, v, label) in enumerate(data):
        if key is None or label is None or not v or any(c is None or not np.isfinite(c) for c in v) or not any(v):
            continue
        x = np.array(v, float)
        known.append((i, key, label, x / np.linalg.norm(x)))
    links, counts = [], [0] * len(data)
    for k, (i, a, la, x) in enumerate(known):
        for j, b, lb, y in known[:k]:
            if la == lb and len(x) == len(y) and x @ y >= least:
                links.append((a, b))
                counts[i] += 1
                counts[j] += 1
    found = brute_components({k for k, _, _ in data if k is not None}, links)
    return sorted(
        ((k, counts[i], found.get(k), k is None or found[k] == k) for i, (k, _, _) in enumerate(data)), key=str
    )


def vector_answer(df):
    found = df.select("vec_id", "n_links", "component_id", "kept").collect()
    return sorted((tuple(r) for r in found), key=str)


VECTORS = "vec_id long, embedding array<float>, label int"


def clustered(seed, n, size=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, size))
    data = []
    for i in range(n):
        v = centres[rng.integers(9)] + rng.normal(size=size) * rng.choice([0, 0.05, 0.12, 1])
        data.append((i, [float(np.float32(c)) for c in v], int(rng.integers(3))))
    return data


@pytest.mark.parametrize("part", [2_048, 10])
def test_vectors_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(pivots, "LIST_ROWS", part)
    data = clustered(3, 400)
    found = pivots.near_vectors(spark.createDataFrame(data, VECTORS))
    assert vector_answer(found) == brute_vectors(data)


def test_odd_vectors(spark):
    one = [1.0, 2.0, 3.0]
    data = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 3.0], 1), (5, [1.0, float("nan"), 3.0], 1),
        (6, [float("inf"), 1.0, 1.0], 1), (7, one, 1), (8, one, 1), (9, one, 2), (10, one, None),
        (11, [2.0, 4.0, 6.0], 1), (12, [1.0, 2.0], 1), (None, one, 1), (13, [-1.0, -2.0, -3.0], 1), (14, [5.0], 1), (15, [7.0], 1),
    ]
    df = spark.createDataFrame(data, VECTORS).withColumn("node", F.lit("own")).withColumn("links", F.lit(1))
    assert vector_answer(pivots.near_vectors(df)) == brute_vectors(data)


def test_repeated_vector_rows_count(spark):
    data = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1)]
    assert vector_answer(pivots.near_vectors(spark.createDataFrame(data, VECTORS))) == [
        (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False),
    ]


def test_no_vectors(spark):
    assert vector_answer(pivots.near_vectors(spark.createDataFrame([], VECTORS))) == []


def test_registered_vector_query(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    assert vector_answer(QUERIES["op9_vector_near_dedup"](spark, SMALL)) == brute_vectors([tuple(r) for r in table])
