"""Near-duplicate documents by min-max hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallywork.llm.shared import components, table, with_texts, written
from tallywork.operators.ranking import with_row_numbers

WORDS = 5  # words of a shingle
PERMUTATIONS = 192  # each gives a minimum and a maximum
ROWS = 6  # signature values of a band
BANDS = 2 * PERMUTATIONS // ROWS
SKETCH_BITS = 256
# At a similarity of 0.75 a bit agrees with chance 7/8: 224 bits, deviation 5.3. Pairs at the
# threshold fall below this bound with a chance under one in ten million.
LEAST_EQUAL_BITS = 195
ID_FILTER_BITS = 1 << 23  # of the broadcast filter of ids: 131,072 rows of one word each
# At 0.75 some 288 of the 384 values agree, deviation 8.5.
LEAST_EQUAL_VALUES = 245
PART_ROWS = 2_000  # rows of a bucket that one task compares at a time
BLOCK_SETS = 4_000  # shingle sets that one task holds at a time
PARTNERS = 3  # candidates of a document that are checked before components are first formed
WORD_CACHE = 200_000  # word hashes a task remembers; more are computed again


class WordHashes(dict):
    """Hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text.

    ``bytes.lower`` and ``bytes.split`` treat exactly A-Z and the six ASCII spaces.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    width = min(words, len(h))
    n = len(h) - width + 1
    x = np.full(n, width, np.uint64)
    for i in range(width):
        x = _mixed(x ^ h[i : i + n]) + np.uint64(i)
    return np.unique(x)


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_011)
    a = rng.integers(0, 2**31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, rng.integers(0, 2**32, count, dtype=np.uint32)


def min_max(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima and maxima of the set under every permutation: one pass over the hashes."""
    x32 = (x >> np.uint64(32)).astype(np.uint32)
    low = np.full(len(a), 2**32 - 1, np.uint32)
    high = np.zeros(len(a), np.uint32)
    for i in range(0, len(x32), 512):
        h = x32[i : i + 512, None] * a + b
        np.minimum(low, h.min(0), out=low)
        np.maximum(high, h.max(0), out=high)
    return np.concatenate([low, high])


def signatures(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS) -> DataFrame:
    """Per row: ``node`` (the id), set size, set fingerprint, band keys and a bit sketch.

    A band takes values of different permutations, all minima or all maxima. The sketch has
    one bit from each of 256 signature values; ``bit_count`` of two sketches' xor estimates
    the similarity. Rows without words have no bands.
    """
    schema = "node long, n long, f1 long, f2 long, bands array<long>, sketch array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(PERMUTATIONS)
        cache = WordHashes()
        salt = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            n, f1, f2, bands, sketches = [], [], [], [], []
            for value in batch.column(1):
                x = shingle_set(value.as_py(), words, cache)
                n.append(len(x))
                if not len(x):
                    f1.append(0), f2.append(0), bands.append(None), sketches.append(None)
                    continue
                f1.append(int(x.sum().astype(np.int64)))
                f2.append(int(_mixed(x).sum().astype(np.int64)))
                values = min_max(x, a, b).astype(np.uint64)
                keys = salt.copy()
                for column in values.reshape(BANDS, ROWS).T:
                    keys = _mixed(keys ^ column)
                bands.append(keys.view(np.int64))
                half = SKETCH_BITS // 2
                drawn = np.concatenate([values[:half], values[PERMUTATIONS : PERMUTATIONS + half]])
                bits = (_mixed(drawn) >> np.uint64(63)).astype(np.uint8)
                sketches.append(np.packbits(bits).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(f1, pa.int64()),
                    pa.array(f2, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["node", "n", "f1", "f2", "bands", "sketch"],
            )

    return with_texts(docs).select(key, text).mapInArrow(sign, schema)


def _may_hold(df: DataFrame, ids: DataFrame, column: str, bits: int = ID_FILTER_BITS) -> DataFrame:
    """Rows whose id may be among ``ids``: a one-hash Bloom filter, broadcast.

    Its size is fixed by ``bits`` whatever the number of ids; more ids let more other rows
    pass, and an exact semi join follows. It spares the texts of most rows the shuffle.
    """
    spot = F.pmod(F.xxhash64(F.col("node")), F.lit(bits))
    words = (
        ids.select(spot.alias("spot"))
        .groupBy(F.expr("spot div 64").alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(spot % 64 AS int)))").alias("_bits"))
    )
    here = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))
    return (
        df.withColumn("_spot", here)
        .join(F.broadcast(words), F.expr("_spot div 64 = _word"))
        .where("shiftright(_bits, cast(_spot % 64 AS int)) & 1L = 1L")
        .drop("_spot", "_word", "_bits")
    )


def _sets(docs: DataFrame, ids: DataFrame, text: str, key: str, words: int) -> DataFrame:
    """Full shingle sets of the rows with given ids.

    ``set`` packs the sorted hashes; ``signature`` has one byte of every signature value.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(PERMUTATIONS)
        cache = WordHashes()
        for batch in batches:
            sets = [shingle_set(v.as_py(), words, cache) for v in batch.column(1)]
            signed = [_mixed(min_max(x, a, b).astype(np.uint64)).astype(np.uint8).tobytes() for x in sets]
            columns = [
                batch.column(0),
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array([x.tobytes() for x in sets], pa.large_binary()),
                pa.array(signed, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "set", "signature"])

    rows = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("_text"))
    kept = _may_hold(rows, ids, "node").join(ids, "node", "left_semi")
    return kept.mapInArrow(pack, "node long, n long, set binary, signature binary").where("n > 0")


def _block(node: str, blocks: int):
    return F.pmod(F.xxhash64(F.col(node)), F.lit(blocks))


def _linked(wanted: DataFrame, sets: DataFrame, blocks: int, percent: int) -> DataFrame:
    """Of wanted comparisons (``node``, ``block``, ``partners``) the pairs that are links.

    Partners of a row lie in one block of sets. The block's sets, some thousand, come to a task
    first and stay; the rows with the nodes' own sets then stream past. So a set travels once
    for its block and once for each row that asks, not for each pair, and only links come out.
    """
    stored = sets.select(
        _block("node", blocks).alias("block"), F.lit(0).alias("turn"), "node", "set",
        F.lit(None).cast("array<long>").alias("partners"),
    )
    asked = wanted.join(sets, "node").select("block", F.lit(1).alias("turn"), "node", "set", "partners")
    stream = stored.unionByName(asked).repartition("block").sortWithinPartitions("block", "turn")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        now = None
        for batch in batches:
            found_a, found_b = [], []
            columns = (batch.column(i) for i in range(5))
            for block, turn, node, packed, partners in zip(*columns, strict=True):
                if block.as_py() != now:
                    held, now = {}, block.as_py()
                x, a = np.frombuffer(packed.as_py(), np.uint64), node.as_py()
                if turn.as_py() == 0:
                    held.setdefault(a, []).append(x)
                    continue
                for b in partners.as_py():
                    for y in held.get(b, ()):
                        least, most = sorted((len(x), len(y)))
                        if 100 * least < percent * most:
                            continue
                        common = len(np.intersect1d(x, y, assume_unique=True))
                        if 100 * common >= percent * (len(x) + len(y) - common):
                            found_a.append(min(a, b)), found_b.append(max(a, b))
                            break
            yield pa.RecordBatch.from_arrays(
                [pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], names=["a", "b"]
            )

    return stream.mapInArrow(compare, "a long, b long").distinct()


def _across(rows: DataFrame, blocks: int, percent: int) -> DataFrame:
    """Comparisons still wanted in buckets that hold several components.

    ``rows``: band, node, component, largest (component of the bucket), n, signature, and the
    part (``i``, ``j``) of the bucket. A row that is not of the largest component (``side`` 0)
    meets the others (``side`` 1) of its part. A pair is left out if its sizes or its whole
    signatures are too far apart, or if an earlier bucket has both.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            rest = pa.concat_tables([rest, now]) if rest is not None else now
            part = np.stack([rest[c].to_numpy() for c in ("band", "i", "j")])
            cuts = np.flatnonzero((part[:, 1:] != part[:, :-1]).any(0)) + 1
            if len(cuts):
                done, rest = rest.slice(0, cuts[-1]), rest.slice(cuts[-1])
                yield from _met(done, np.concatenate([[0], cuts]), blocks, percent)
        if rest is not None and len(rest):
            part = np.stack([rest[c].to_numpy() for c in ("band", "i", "j")])
            cuts = np.flatnonzero((part[:, 1:] != part[:, :-1]).any(0)) + 1
            yield from _met(rest, np.concatenate([[0], cuts, [len(rest)]]), blocks, percent)

    ordered = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return ordered.mapInArrow(meet, "node long, block long, partners array<long>")


def _met(rows: pa.Table, cuts: np.ndarray, blocks: int, percent: int) -> Iterator[pa.RecordBatch]:
    node, block, component, largest, side, n = (
        rows[c].to_numpy() for c in ("node", "block", "component", "largest", "side", "n")
    )
    width = 2 * PERMUTATIONS
    signs = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8).reshape(-1, width)
    out_node, out_block, out_partners = [], [], []
    for low, high in zip(cuts[:-1], cuts[1:], strict=True):
        here = np.arange(low, high)
        asking, others = here[side[here] == 0], here[side[here] == 1]
        if not len(asking) or not len(others):
            continue
        own_band = rows["position"][int(low)].as_py()
        for row in asking:
            fits = component[others] != component[row]
            # Of two rows outside the largest component the one with the smaller id asks.
            fits &= (component[others] == largest[row]) | (node[row] < node[others])
            sizes = n[others]
            fits &= 100 * np.minimum(sizes, n[row]) >= percent * np.maximum(sizes, n[row])
            met = others[fits]
            if not len(met):
                continue
            equal = signs[met] == signs[row]
            whole = equal.reshape(len(met), BANDS, ROWS).all(2)
            near = (equal.sum(1) >= LEAST_EQUAL_VALUES) & (whole.argmax(1) == own_band)
            met = met[near]
            for b in np.unique(block[met]):
                out_node.append(node[row])
                out_block.append(b)
                out_partners.append(np.unique(node[met[block[met] == b]]))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(out_node, pa.int64()),
            pa.array(out_block, pa.int64()),
            pa.array(out_partners, pa.list_(pa.int64())),
        ],
        names=["node", "block", "partners"],
    )


def _alike(percent: int) -> str:
    """Condition on two sides' sizes (exact) and sketches (far below the threshold)."""
    differing = " + ".join(f"bit_count(l.sketch[{i}] ^ r.sketch[{i}])" for i in range(SKETCH_BITS // 64))
    return (
        f"100 * least(l.n, r.n) >= {percent} * greatest(l.n, r.n) "
        f"AND {differing} <= {SKETCH_BITS - LEAST_EQUAL_BITS}"
    )


def with_own_ids(docs: DataFrame, own: str, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame | None, bool]:
    """The documents with a column ``own`` (no name of theirs starts like it): an id for every
    (id, text), the least text keeping the id.

    Further texts of an id are numbered behind the greatest id of all, in a fixed order. Also
    returned: which ids these stand for (``own``, ``id``), or None if every id has one text, and
    whether any id has several rows. Ids are known apart by hashes of their texts.
    """
    known = docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"))
    ids = known.where("id IS NOT NULL").groupBy("id").agg(
        F.count("*").alias("rows"), F.min("hash").alias("first"), F.max("hash").alias("last")
    )
    several = written(ids.where("rows > 1").select("id", "first", F.expr("first <> last").alias("unlike")), "repeated")
    rows, unlike = several.agg(F.count("*"), F.count_if("unlike")).first()
    plain = docs.withColumn(own, F.col(key).cast("long"))
    if not unlike:
        return plain, None, rows > 0
    top = known.agg(F.max("id")).first()[0]
    further = known.distinct().join(several.where("unlike"), "id").where("hash <> first").select("id", "hash")
    numbered = with_row_numbers(further, ["id", "hash"], "number").select(
        F.col("id").alias(f"{own}_id"), F.col("hash").alias(f"{own}_hash"), (F.lit(top) + F.col("number")).alias(f"{own}_new")
    )
    same = (F.col(own) == F.col(f"{own}_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(f"{own}_hash"))
    named = plain.join(numbered, same, "left").withColumn(own, F.coalesce(f"{own}_new", own)).select(*docs.columns, own)
    return named, numbered.select(F.col(f"{own}_new").alias("own"), F.col(f"{own}_id").alias("id")), True


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 75, words: int = WORDS
) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent``.

    Returns per input row ``<key>``, ``n_shingles``, ``component_id`` (smallest id reachable)
    and ``kept`` (id = component id). Texts without words (null, empty, blank) have an empty set
    and link with nothing. Rows with a null id link with nothing, have a null component and are
    kept. Rows that share an id are one document: it has the links of all its texts, and all its
    rows one component. Ids lie well below the greatest long. Other columns are not read.
    """
    needed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    named, further, _ = with_own_ids(needed, "own", "text", "key")
    if further is None:
        return text_duplicates(docs, text, key, percent, words)
    found = written(text_duplicates(named, "text", "own", percent, words).drop("kept"), "texts")
    back = found.join(further.withColumnsRenamed({"own": "_own", "id": "_id"}), F.col("own") == F.col("_own"), "left")
    back = back.select(F.coalesce("_id", "own").alias(key), F.col("_own").isNotNull().alias("more"), "n_shingles", "component_id")
    # The components of an id's texts belong together; the one of its own number is among them.
    own = back.where("NOT more").select(F.col(key).alias("_key"), F.col("component_id").alias("a")).distinct()
    links = back.where("more").join(own, F.col(key) == F.col("_key")).select("a", F.col("component_id").alias("b"))
    joined = components(links.where("a <> b").distinct())
    return (
        back.join(joined, F.col("component_id") == F.col("node"), "left")
        .select(key, "n_shingles", F.coalesce("component", "component_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of near copies, with all its columns; rows with a null id all stay.

    Texts count and not ids: of an id with unlike texts each is kept or dropped for itself. Of a
    group the row of the smallest id stays; further texts of an id come behind all ids.
    """
    own = "_own"
    while any(c.startswith(own) for c in docs.columns):
        own = f"_{own}"
    named, _, repeated = with_own_ids(docs, own, text, key)
    kept = text_duplicates(named, text, own).where(f"kept AND {own} IS NOT NULL").select(own).distinct()
    stay = named.where(F.col(key).isNotNull()).join(kept, own, "left_semi")
    if repeated:
        stay = stay.dropDuplicates([own])
    return stay.select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))


def text_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 75, words: int = WORDS
) -> DataFrame:
    """``near_duplicates`` of documents of which no id has unlike texts.

    1. Equal sets become one class before anything else, so copies cost one row each.
    2. Classes are banded. In every band bucket a class meets the bucket's first class and its
       neighbour in id order, never all others; sketches rule out most of these, and the best
       partners of each class are confirmed on full sets. That forms first components.
    3. Whatever else shares a bucket but not a component is then compared inside tasks: whole
       signatures first, full sets after. Members of a bucket's largest component are not
       paired with one another, and a large bucket is cut into parts.
    So links within a component may go unchecked, as they cannot change it; no candidate
    between components does. A pair at the threshold shares no bucket, or falls below the
    sketch bound, with a chance of a few in a million.

    """
    signed = written(signatures(docs, text, key, words), "signatures")
    classes = written(
        signed.where("node IS NOT NULL AND n > 0")
        .groupBy("f1", "f2", "n")
        .agg(F.min("node").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")),
        "classes",
    )
    brief = classes.select("node", "n", "sketch")

    in_bucket = Window.partitionBy("band").orderBy("node")
    shared = written(
        classes.select("node", F.posexplode("bands").alias("position", "band"))
        .select(
            "band",
            "position",
            "node",
            F.first("node").over(in_bucket).alias("first"),
            F.lag("node").over(in_bucket).alias("before"),
            F.lead("node").over(in_bucket).alias("after"),
        )
        .where("before IS NOT NULL OR after IS NOT NULL")
        .drop("after"),
        "buckets",
    )
    sets = written(_sets(docs, shared.select("node").distinct(), text, key, words), "sets")

    near = (
        shared.select(F.explode(F.array_distinct(F.array("first", "before"))).alias("a"), F.col("node").alias("b"))
        .where("a < b")
        .distinct()
    )
    scored = (
        near.join(brief.alias("l"), F.expr("a = l.node"))
        .join(brief.alias("r"), F.expr("b = r.node"))
        .where(_alike(percent))
        .select("a", "b", F.expr(_equal_bits()).alias("bits"))
    )
    best = Window.partitionBy("b").orderBy(F.desc("bits"), "a")
    blocks = -(-sets.count() // BLOCK_SETS) or 1
    tried = (
        scored.withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= PARTNERS)
        .groupBy(F.col("b").alias("node"), _block("a", blocks).alias("block"))
        .agg(F.collect_list("a").alias("partners"))
    )
    links = written(_linked(tried, sets, blocks, percent), "confirmed")
    formed = written(components(links), "formed")

    placed = shared.join(formed, "node", "left").select(
        "band", "position", "node", F.coalesce("component", "node").alias("component")
    )
    mixed = (
        placed.groupBy("band", "component")
        .agg(F.count("*").alias("members"))
        .groupBy("band")
        .agg(
            F.count("*").alias("parts"),
            F.max_by("component", F.struct("members", "component")).alias("largest"),
            F.sum("members").alias("all"),
            (F.sum("members") - F.max("members")).alias("few"),
        )
        .where("parts > 1")
        .select(
            "band", "largest",
            F.expr(f"1 + few div {PART_ROWS}").alias("few_parts"),
            F.expr(f"1 + all div {PART_ROWS}").alias("all_parts"),
        )
    )
    spot = F.expr("xxhash64(node, 7L)")
    open_rows = placed.join(mixed, "band").withColumns(
        {
            "asking": F.expr("component <> largest"),
            "own_few": F.pmod(spot, F.col("few_parts")),
            "own_all": F.pmod(spot, F.col("all_parts")),
        }
    )
    # A bucket of many rows is cut into parts: askers by i, the rest by j.
    askers = open_rows.where("asking").select(
        "*", F.lit(0).alias("side"), F.col("own_few").alias("i"),
        F.explode(F.expr("sequence(0L, all_parts - 1)")).alias("j"),
    )
    others = open_rows.select(
        "*", F.lit(1).alias("side"), F.explode(F.expr("sequence(0L, few_parts - 1)")).alias("i"),
        F.col("own_all").alias("j"),
    )
    dealt = (
        askers.unionByName(others)
        .join(sets.drop("set"), "node")
        .select(
            "band", "position", "i", "j", "node", "component", "largest", "side", "n", "signature",
            _block("node", blocks).alias("block"),
        )
    )
    wanted = written(_across(dealt, blocks, percent), "wanted")
    found = written(links.unionByName(_linked(wanted, sets, blocks, percent)), "confirmed")
    final = components(found)

    class_of = classes.select("f1", "f2", F.col("n").alias("_n"), "node").join(final, "node", "left")
    class_of = class_of.select("f1", "f2", "_n", F.coalesce("component", "node").alias("_component"))
    answered = signed.select("node", "n", "f1", "f2").alias("s").join(
        class_of.alias("c"), F.expr("s.f1 = c.f1 AND s.f2 = c.f2 AND s.n = c._n"), "left"
    )
    component = F.when(F.col("node").isNotNull(), F.coalesce("_component", "node"))
    return answered.select(
        F.col("node").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id")
    ).withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def _equal_bits() -> str:
    differing = " - ".join(f"bit_count(l.sketch[{i}] ^ r.sketch[{i}])" for i in range(SKETCH_BITS // 64))
    return f"{SKETCH_BITS} - {differing}"


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(table(spark, folder, "documents"))
