"""Ranked lexical search: exact inner products, found in trees of balls of sparse documents."""

from __future__ import annotations

import heapq
import math
import re
import string
from bisect import insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywork.llm.shared import table, with_texts, written

# Fixed values of the ranking: terms, and the constants of the score.
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
GAP = re.compile("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)

SLAB_ITEMS = 512  # items that one pass over the documents answers
SLAB_CHARS = 16_000_000  # characters of their texts, on average
PART = 1 << 20  # characters of a text that are split into terms at a time
KNOWN_TERMS = 300_000  # terms a task remembers
CELLS = 4_000_000  # documents of a tree times terms of the slab
LEAF = 32  # documents of a leaf
DIRECTIONS = 32  # random directions that nearness is judged by
SLACK = 1e-9  # far above the rounding of the bounds, in parts of the greatest possible product


def counted_terms(text: str) -> Counter:
    """Terms of a whole text as they are written, with their numbers; long texts in parts."""
    if len(text) <= PART:
        return Counter(TERM.findall(text))
    found, place = Counter(), 0
    while place < len(text):
        gap = GAP.search(text, place + PART)
        end = gap.start() if gap else len(text)
        found.update(TERM.findall(text, place, end))
        place = end
    return found


class Vocabulary(dict):
    """Numbers of terms as written; -1 for those that no item has. Remembers a bounded number."""

    def __init__(self, terms: list[str]):
        super().__init__()
        self.numbers = {t: i for i, t in enumerate(terms)}

    def __missing__(self, term: str) -> int:
        if len(self) >= KNOWN_TERMS:
            self.clear()
        self[term] = number = self.numbers.get(term.translate(LOWER), -1)
        return number

    def of(self, counts: Counter) -> dict[int, int]:
        """Counts by number; only A-Z are lower-cased, so that spellings may fall together."""
        found: dict[int, int] = {}
        for term, count in counts.items():
            number = self[term]
            if number >= 0:
                found[number] = found.get(number, 0) + count
        return found


def _counted(docs: DataFrame, terms: list[str], text: str, key: str) -> DataFrame:
    """Documents with any of the terms (``part`` 0), and one row of sums for each task (``part`` 1).

    A task's sums are its documents with any term at all, all their terms, and how many documents
    hold each of the given terms; so statistics cover all rows and cost no shuffle of terms.
    """
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # of one slab of items
    schema = "part byte, doc_id long, n long, docs long, terms array<int>, counts array<long>"
    names = [p.split()[0] for p in schema.split(", ")]
    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        holding = np.zeros(len(shared.value), np.int64)
        documents = total = 0

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            rows = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts = counted_terms(value.as_py() or "")
                n = counts.total()
                if not n:
                    continue
                documents, total = documents + 1, total + n
                found = vocabulary.of(counts)
                if found:
                    holding[list(found)] += 1
                    rows.append((0, doc, n, 0, list(found), list(found.values())))
            if rows:
                yield out(rows)
        held = np.flatnonzero(holding)
        yield out([(1, None, total, documents, held.tolist(), holding[held].tolist())])

    return with_texts(docs).selectExpr(f"CAST(`{key}` AS BIGINT) AS k", f"`{text}` AS t").mapInArrow(run, schema)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(counts: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What each term of a document adds for each unit of the item's weight; whole numbers."""
    m = 100 - 75 + (75 * n * documents) // total
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


class BallTree:
    """A binary tree of balls over sparse documents, halved by nearness to two far ones.

    ``row``, ``term`` and ``value`` hold the documents' impacts, sorted by row; ``scale`` stretches
    the space. Which documents share a node follows their projections on a few random directions;
    that decides how much is pruned and never what is found. Documents lie in the tree's
    ``order``, so that a node holds neighbours ``low`` up to ``high``. A node has its centroid,
    its radius, and the radius upwards along each term, which bounds items of few terms closer.
    """

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, scale: np.ndarray):
        size = int(row[-1]) + 1
        starts = np.searchsorted(row, np.arange(size))
        directions = np.random.default_rng(7).choice(np.float32([-1, 1]), (len(scale), DIRECTIONS))
        stretched = (value * scale[term]).astype(np.float32)
        self.order = np.arange(size)
        self.low, self.high, self.children = [], [], []
        self._grow(np.add.reduceat(stretched[:, None] * directions[term], starts), 0, size)

        place = np.empty(size, np.int64)
        place[self.order] = np.arange(size)
        sort = np.argsort(place[row], kind="stable")
        row, term, value = place[row][sort], term[sort], value[sort]
        self.columns = np.zeros((len(scale), size), np.int32)  # a row for each term, in the tree's order
        self.columns[term, row] = value
        starts = np.append(np.searchsorted(row, np.arange(size)), len(row))
        self._surround(starts, term, value * scale[term], scale)

    def _grow(self, near: np.ndarray, low: int, high: int) -> int:
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append(())
        own = near[low:high]
        if high - low > LEAF and (own != own[0]).any():
            first = own[((own - own.mean(axis=0)) ** 2).sum(axis=1).argmax()]
            second = own[((own - first) ** 2).sum(axis=1).argmax()]
            side = np.argsort(own @ (second - first), kind="stable")
            near[low:high] = own[side]
            self.order[low:high] = self.order[low:high][side]
            middle = (low + high) // 2
            self.children[node] = (self._grow(near, low, middle), self._grow(near, middle, high))
        return node

    def _surround(self, starts: np.ndarray, term: np.ndarray, stretched: np.ndarray, scale: np.ndarray) -> None:
        nodes = len(self.low)
        self.centres, self.tops = np.zeros((2, nodes, len(scale)))
        for node in reversed(range(nodes)):  # children come behind their parents
            if self.children[node]:
                one, two = self.children[node]
                self.centres[node] = self.centres[one] + self.centres[two]
                self.tops[node] = np.maximum(self.tops[one], self.tops[two])
            else:
                own = self.columns[:, self.low[node] : self.high[node]]
                self.centres[node], self.tops[node] = own.sum(axis=1), own.max(axis=1)
        self.centres *= scale / np.subtract(self.high, self.low)[:, None]
        self.tops *= scale
        self.reach = np.zeros(nodes)
        lengths = np.add.reduceat(stretched**2, starts[:-1])
        centre_lengths = (self.centres**2).sum(axis=1)
        for node, (low, high) in enumerate(zip(self.low, self.high, strict=True)):
            part = slice(starts[low], starts[high])
            along = np.add.reduceat(stretched[part] * self.centres[node][term[part]], starts[low:high] - starts[low])
            most = lengths[low:high] + centre_lengths[node]
            self.reach[node] = np.sqrt((np.maximum(most - 2 * along, 0) + SLACK * most).max())

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Above every inner product of a query (of no negative weights) with a vector of a node.

        The product with the centroid plus the query's length times the radius, or, if less, plus
        the upward radius along each term of the query. Rounding is covered by ``SLACK``.
        """
        length = np.sqrt((queries**2).sum(axis=1))[:, None]
        ball = queries @ self.centres.T + length * self.reach
        upwards = queries @ self.tops.T
        return np.minimum(ball, upwards) + SLACK * length * np.sqrt((self.tops**2).sum(axis=1)) + 1


class Best:
    """The highest scores so far of one item: sorted (-score, place of the id, id)."""

    def __init__(self, k: int):
        self.k, self.found = k, []

    def least(self) -> int:
        """What a score must reach to come in."""
        return -self.found[-1][0] if len(self.found) == self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        for at in np.flatnonzero(scores >= self.least()):
            insort(self.found, (-int(scores[at]), ids[at] is None, ids[at] or 0))
        del self.found[self.k :]


def search_tree(tree: BallTree, bounds: np.ndarray, ids: list, item: tuple, best: Best) -> int:
    """Best-first: the subtree with the greatest bound next, until none can reach the least score.

    Leaves are scored with whole numbers. Returns the number of documents scored.
    """
    numbers, weights = item
    waiting = [(-bounds[0], 0)]
    scored = 0
    while waiting:
        bound, node = heapq.heappop(waiting)
        if -bound < best.least():
            break
        if tree.children[node]:
            for child in tree.children[node]:
                heapq.heappush(waiting, (max(bound, -bounds[child]), child))
        else:
            low, high = tree.low[node], tree.high[node]
            best.add((weights[:, None] * tree.columns[numbers, low:high]).sum(axis=0), ids[low:high])
            scored += high - low
    return scored


def _windows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    waiting, size = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - size)
            waiting.append(part)
            size += part.num_rows
            batch = batch.slice(part.num_rows)
            if size == rows:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
    if size:
        yield pa.Table.from_batches(waiting)


def _found(documents: DataFrame, items: list[tuple], weights: np.ndarray, all_docs: int, total: int, k: int) -> DataFrame:
    """Each task's best documents of every item: it grows trees over windows of its documents."""
    shared = documents.sparkSession.sparkContext.broadcast((items, weights))  # of one slab
    schema = "item int, item_id long, doc_id long, score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        scale = np.sqrt(weights.astype(float))  # shared by both sides, so that lengths are alike
        queries = np.zeros((len(items), len(weights)))
        vectors = []
        for at, (_, numbers, counts) in enumerate(items):
            queries[at, numbers] = counts * scale[numbers]
            vectors.append((numbers, counts * weights[numbers]))
        best = [Best(k) for _ in items]
        for window in _windows(batches, max(64, CELLS // len(weights))):
            terms, counts = (window.column(c).combine_chunks() for c in ("terms", "counts"))
            widths = np.diff(terms.offsets.to_numpy())
            row = np.repeat(np.arange(window.num_rows), widths)
            term = terms.flatten().to_numpy()
            value = impacts(counts.flatten().to_numpy(), window.column("n").to_numpy()[row], all_docs, total)
            tree = BallTree(row, term, value, scale)
            known = window.column("doc_id").to_pylist()
            ids = [known[i] for i in tree.order]
            bounds = tree.bounds(queries)
            for at in np.flatnonzero(bounds[:, 0] >= [b.least() for b in best]):
                search_tree(tree, bounds[at], ids, vectors[at], best[at])
        rows = [
            (at, items[at][0], None if none else doc, -score) for at, b in enumerate(best) for score, none, doc in b.found
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "item_id", "doc_id", "score"]
        )

    return documents.select("doc_id", "n", "terms", "counts").mapInArrow(run, schema)


def _slab(docs: DataFrame, items: list[tuple], k: int, text: str, key: str) -> DataFrame | None:
    """The ranked documents of one slab of items, each given as (id, counts of lower-cased terms)."""
    terms = sorted({t for _, counts in items for t in counts})
    number = {t: i for i, t in enumerate(terms)}
    counted = written(_counted(docs, terms, text, key), "terms")
    sums = counted.where("part = 1")
    all_docs, total = sums.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not all_docs or not terms:
        return None
    holding = (
        sums.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
        .groupBy(F.col("x.terms").alias("term"))
        .agg(F.sum("x.counts").alias("df"))
        .collect()  # at most one row for each term of the slab
    )
    weights = np.zeros(len(terms), np.int64)
    for r in holding:
        weights[r["term"]] = weight(all_docs, r["df"])
    vectors = []
    for item, counts in items:
        numbers = np.array(sorted(number[t] for t in counts), int)
        repeats = np.array([counts[terms[i]] for i in numbers], np.int64)
        useful = weights[numbers] > 0
        vectors.append((item, numbers[useful], repeats[useful]))
    found = _found(counted.where("part = 0"), vectors, weights, all_docs, total, k)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: each item's ``k`` best documents.

    Exact whole-number scores above 0, equal ones by ascending ``doc_id`` (null ids last). Null
    and empty texts have no terms: they count in nothing and find nothing. Each row of ``docs``
    is a document, so a repeated id may come more than once; rows of ``items`` that agree in id
    and text are one item, and unlike texts of one id are ranked apart. Whole texts count, however
    long. Empty tables give no rows; other columns are not read, so none can clash.

    Items are answered in slabs of some hundred (bounded, so a slab's terms can be sent to all
    tasks); a slab reads the documents once. Tasks grow trees over windows of the documents that
    have any of its terms, and search every item best-first. A ball bounds its documents' scores
    by the product with its centroid plus the item's length times its radius, rounded upwards, so
    that nothing pruned could have come in; leaves are scored exactly. Only ``k`` rows an item
    leave a task.
    """
    spark = docs.sparkSession
    wanted = items.selectExpr(f"CAST(`{item_key}` AS BIGINT) AS id", f"`{item_text}` AS t").distinct()
    count, chars = wanted.agg(F.count("*"), F.coalesce(F.sum(F.length("t")), F.lit(0))).first()
    slabs = max(1, math.ceil(count / SLAB_ITEMS), math.ceil(chars / SLAB_CHARS))
    answer = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for slab in range(slabs):
        drawn = wanted.where(F.pmod(F.xxhash64("id", "t"), F.lit(slabs)) == slab).collect()  # bounded
        parsed = []
        for r in sorted(drawn, key=lambda r: (r["id"] is None, r["id"] or 0, r["t"] or "")):
            counts: Counter = Counter()
            for term, n in counted_terms(r["t"] or "").items():
                counts[term.translate(LOWER)] += n
            if counts:
                parsed.append((r["id"], counts))
        found = _slab(docs, parsed, k, text, key) if parsed else None
        if found is not None:
            answer = answer.unionByName(found)
    return answer


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
items AS (
  SELECT row_number() OVER () AS i, item_id, regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
),
sums AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs WHERE len(terms) > 0),
asked AS (SELECT i, term, count(*) AS repeats FROM (SELECT i, unnest(terms) AS term FROM items) GROUP BY i, term),
held AS (
  SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY d, term
),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, sums GROUP BY term, n_docs
),
scores AS (
  SELECT i, d, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(terms) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN docs USING (d), sums GROUP BY i, d
),
ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores JOIN items USING (i) JOIN (SELECT d, doc_id FROM docs) USING (d) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
