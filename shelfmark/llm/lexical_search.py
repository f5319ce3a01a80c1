"""Ranked lexical search: bit-sliced Bloom signatures bound every document's score from above, and what they don't exclude is scored exactly."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.text import Batches, folded_words, in_batches, materialise, per_row, sliced

BEST = 10
BLOCK_TERMS = 200_000  # terms counted, and terms of items searched for, in one pass over the documents
PILOT = 64  # documents of the highest bounds whose exact scores give an item's threshold

HASHES = 3
BITS_AN_ENTRY = 12
# A term is entered once for each of these numbers of occurrences that it reaches, so presence at a level and absence at the next bound them.
LEVELS = (1, 2, 3, 5, 9, 17, 65)
BLOCK_ROWS = 512
BLOCK_BITS = 1 << 21  # of one written block
MOST_BITS = 1 << 20  # of one signature; fuller ones exclude less, never wrongly
HELD_ENTRIES = 2_000_000  # of documents that wait for their block to fill

MIXED = 0x9E3779B97F4A7C15
INDEX = "doc_ids array<long>, lengths array<long>, bits int, slices binary, counted array<struct<term:binary,n:long>>"


class _Hashes(dict):
    """64-bit hashes of terms, kept while there are few."""

    def __missing__(self, term: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[term] = made = xxhash.xxh64_intdigest(term)
        return made


def _places(hashes: np.ndarray, level: int, bits: int) -> np.ndarray:
    """(HASHES, n): the slices that terms at a level set."""
    mixed = (hashes ^ np.uint64(MIXED * level % (1 << 64))) * np.uint64(MIXED)
    first, step = mixed & np.uint64(0xFFFFFFFF), (mixed >> np.uint64(32)) | np.uint64(1)
    times = np.arange(HASHES, dtype=np.uint64)[:, None]
    return ((first + times * step) & np.uint64(bits - 1)).astype(np.int64)


class _Signed(NamedTuple):
    doc_id: int | None
    length: int
    entries: list[np.ndarray]  # hashes of the terms at each level


def _slices(block: list[_Signed], bits: int) -> bytes:
    """Signatures side by side: row j holds bit j of every document of the block."""
    matrix = np.zeros((bits, -(-len(block) // 8) * 8), np.uint8)
    for column, doc in enumerate(block):
        for level, hashes in enumerate(doc.entries):
            matrix[_places(hashes, level, bits).ravel(), column] = 1
    return np.packbits(matrix, axis=1).tobytes()


def _signature_bits(entries: int) -> int:
    return min(max(64, 1 << (BITS_AN_ENTRY * entries - 1).bit_length()), MOST_BITS)


def _index(docs: DataFrame, vocabulary: frozenset[bytes], signed: bool = True) -> DataFrame:
    """Blocks of signatures of documents of like size, and in how many documents each term of the vocabulary is.

    Documents without terms are in no block. A task holds at most HELD_ENTRIES entries beyond one document's.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Batches) -> Batches:
        vocabulary, counted, cache = known.value, Counter(), _Hashes()
        waiting: dict[int, list[_Signed]] = {}
        held = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary()]
            types.append(pa.list_(pa.struct([("term", pa.binary()), ("n", pa.int64())])))
            names = ["doc_ids", "lengths", "bits", "slices", "counted"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

        def written(bits: int) -> pa.RecordBatch:
            block = waiting.pop(bits)
            return batch_of([([d.doc_id for d in block], [d.length for d in block], bits, _slices(block, bits), [])])

        for batch in sliced(batches):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                counts = Counter(folded_words(raw))
                if not counts:
                    continue
                counted.update(vocabulary & counts.keys())
                if not signed:
                    continue
                hashes = np.fromiter(map(cache.__getitem__, counts), np.uint64, len(counts))
                times = np.fromiter(counts.values(), np.int64, len(counts))
                entries = [hashes[times >= least] for least in LEVELS if least <= times.max()]
                size = sum(map(len, entries))
                bits = _signature_bits(size)
                waiting.setdefault(bits, []).append(_Signed(doc_id, int(times.sum()), entries))
                held += size
                if len(waiting[bits]) >= min(BLOCK_ROWS, max(8, BLOCK_BITS // bits)):
                    held -= sum(len(e) for d in waiting[bits] for e in d.entries)
                    yield written(bits)
                elif held > HELD_ENTRIES:
                    for bits in list(waiting):
                        yield written(bits)
                    held = 0
        for bits in list(waiting):
            yield written(bits)
        if counted:
            yield batch_of([([], [], 0, b"", [{"term": t, "n": n} for t, n in counted.items()])])

    return in_batches(docs.select("doc_id", F.col("text").cast("binary").alias("raw")), run, INDEX)


class Queries:
    """A block of items: the hashes of their terms, and for each item which terms it has and what they weigh."""

    def __init__(self, items: list[tuple[int, list[tuple[bytes, int]]]], documents: int, terms: int) -> None:
        self.keys = [key for key, _ in items]
        self.weights = [dict(weighted) for _, weighted in items]
        self.at = {key: i for i, key in enumerate(self.keys)}
        vocabulary = sorted({t for weighted in self.weights for t in weighted})
        places = {t: i for i, t in enumerate(vocabulary)}
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in vocabulary], np.uint64)
        self.term = np.array([places[t] for weighted in self.weights for t in weighted], np.int64)
        self.weight = np.array([w for weighted in self.weights for w in weighted.values()], np.int64)
        self.starts = np.cumsum([0, *map(len, self.weights)])
        self.documents, self.terms = documents, terms

    def norm(self, length: int) -> int:
        return 10 + 90 * length * self.documents // self.terms

    def score(self, item: int, counts: Counter, norm: int) -> int:
        """The exact score of a document for an item."""
        total = 0
        for term, weight in self.weights[item].items():
            if times := counts.get(term):
                total += weight * (1_000_000_000 * times // (1000 * times + 8 * norm))
        return total

    def bounds(self, lengths: np.ndarray, bits: int, slices: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """(first item, items x documents): no score is above its bound, for a few items at a time.

        The slices of a term's places, joined by AND, say which documents may hold the term so often; a document's bound is
        the sum over the terms of weight times what the most occurrences that its levels allow are worth.
        """
        rows = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        norms = np.array([self.norm(n) for n in lengths.tolist()], np.int64)
        worth = np.zeros((len(self.hashes), len(lengths)), np.int64)
        there, before = np.arange(len(self.hashes)), None
        reached = np.zeros(len(lengths), np.int64)
        for level, _ in enumerate(LEVELS):
            most = np.minimum(LEVELS[level + 1] - 1, lengths) if level + 1 < len(LEVELS) else lengths
            value = 1_000_000_000 * most // (1000 * most + 8 * norms)
            present = np.bitwise_and.reduce(rows[_places(self.hashes[there], level, bits)], axis=0)
            if before is not None:
                present &= before
            some = present.any(axis=1)
            there, before = there[some], present[some]
            if not len(there):
                break
            worth[there] += np.unpackbits(before, axis=1, count=len(lengths)) * (value - reached)
            reached = value
        step = max(1, 4_000_000 // len(lengths))
        first = 0
        while first < len(self.keys):  # as many items as have `step` terms, one at least
            last = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + step, "right")) - 1)
            part = slice(self.starts[first], self.starts[last])
            weighed = worth[self.term[part]] * self.weight[part, None]
            yield first, np.add.reduceat(weighed, self.starts[first:last] - self.starts[first], axis=0)
            first = last


def _blocks(queries: Queries, batches: Batches) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """(document ids, first item, bounds) for what the index holds, without documents that have no id."""
    for batch in batches:
        for i in range(len(batch)):
            ids = batch.column("doc_ids")[i].values
            lengths = batch.column("lengths")[i].values.to_numpy(zero_copy_only=False)
            kept = np.flatnonzero(ids.is_valid().to_numpy(zero_copy_only=False))
            numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)[kept]
            for first, bounds in queries.bounds(lengths, batch.column("bits")[i].as_py(), batch.column("slices")[i].as_py()):
                yield numbers, first, bounds[:, kept]


def _highest(index: DataFrame, shared, pilot: int) -> DataFrame:
    """For each item the documents of the `pilot` highest bounds above 0."""

    def run(batches: Batches) -> Batches:
        queries = shared.value
        best = np.zeros((len(queries.keys), pilot), np.int64)
        docs = np.zeros((len(queries.keys), pilot), np.int64)
        for ids, first, bounds in _blocks(queries, batches):
            part = slice(first, first + len(bounds))
            values = np.concatenate([best[part], bounds], axis=1)
            owners = np.concatenate([docs[part], np.broadcast_to(ids, bounds.shape)], axis=1)
            top = np.argpartition(-values, pilot - 1, axis=1)[:, :pilot]
            best[part], docs[part] = np.take_along_axis(values, top, 1), np.take_along_axis(owners, top, 1)
        item, place = np.nonzero(best)
        keys = np.array(queries.keys, np.int64)[item]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(docs[item, place]), pa.array(best[item, place])], names=["key", "doc_id", "bound"]
        )

    found = in_batches(index, run, "key long, doc_id long, bound long")
    order = Window.partitionBy("key").orderBy(F.desc("bound"), "doc_id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= pilot).select("key", "doc_id")


def _not_excluded(index: DataFrame, shared, thresholds: dict[int, int]) -> DataFrame:
    """All (key, doc_id) whose bound reaches the item's threshold."""

    def run(batches: Batches) -> Batches:
        queries = shared.value
        keys = np.array(queries.keys, np.int64)
        least = np.array([thresholds.get(key, 1) for key in queries.keys], np.int64)
        for ids, first, bounds in _blocks(queries, batches):
            item, place = np.nonzero(bounds >= least[first : first + len(bounds), None])
            yield pa.RecordBatch.from_arrays([pa.array(keys[first + item]), pa.array(ids[place])], names=["key", "doc_id"])

    return in_batches(index, run, "key long, doc_id long")


def _scored(docs: DataFrame, pairs: DataFrame, shared, best: int) -> DataFrame:
    """(key, doc_id, score): exact scores above 0 of the pairs' documents, the highest `best` of each item in each task."""
    wanted = pairs.distinct().groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("raw")).join(wanted, "doc_id")

    def run(batches: Batches) -> Batches:
        queries = shared.value
        kept: dict[int, list[tuple[int, int]]] = {}
        for batch in sliced(batches):
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "raw", "keys")]
            for doc_id, raw, keys in zip(*columns, strict=True):
                words = folded_words(raw)
                counts, norm = Counter(words), queries.norm(len(words))
                for key in keys:
                    if score := queries.score(queries.at[key], counts, norm):
                        found = kept.setdefault(key, [])
                        found.append((-score, doc_id))
                        if len(found) > 4 * best:
                            found.sort()
                            del found[best:]
        rows = [(key, doc_id, -score) for key, found in kept.items() for score, doc_id in sorted(found)[:best]]
        columns = zip(*rows) if rows else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "doc_id", "score"])

    found = in_batches(texts, run, "key long, doc_id long, score long")
    order = Window.partitionBy("key").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)


def search(docs: DataFrame, items: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS, pilot: int = PILOT) -> DataFrame:
    """Each item's `best` highest-scoring documents: item_id, text (the item's), rank, doc_id, score.

    The signatures are written once. For each block of items (of at most block_terms terms, or one item), a first pass over
    them finds the documents of the highest bounds; the `best`-th of their exact scores is the item's threshold, and a second
    pass takes every document whose bound reaches it. Those are read again and scored exactly, so the ranking is that of all documents.

    NULL and empty texts have no terms: such documents count nowhere, such items have no rows. Documents without an id count in
    the statistics and are not ranked. Repeated documents are ranked a row each; repeated items (id and text) once, and
    items that share an id but not a text each on their own. An item without a match has no rows.
    """
    spark = docs.sparkSession
    distinct = items.select("item_id", "text").distinct().withColumn("_raw", F.col("text").cast("binary"))
    split = per_row(distinct, lambda raw: (sorted(set(folded_words(raw))),), ["_raw"], "terms array<binary>").drop("_raw")
    split = materialise(split.filter(F.size("terms") > 0).withColumn("key", F.monotonically_increasing_id()), "search-items")

    vocabulary = materialise(split.select(F.explode("terms").alias("term")).distinct(), "search-terms")
    deals = max(1, -(-vocabulary.count() // block_terms))
    index = frequencies = None
    for deal in range(deals):
        mine = vocabulary.filter(F.pmod(F.xxhash64("term"), F.lit(deals)) == deal).collect()
        pass_over = _index(docs, frozenset(bytes(r.term) for r in mine), signed=deal == 0)
        written = materialise(pass_over, "signatures")
        index = written if index is None else index
        counts = written.select(F.explode("counted").alias("c")).groupBy("c.term").agg(F.sum("c.n").alias("df"))
        frequencies = counts if frequencies is None else frequencies.unionByName(counts)
    index = index.filter(F.size("doc_ids") > 0).drop("counted")
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)
    totals = index.agg(F.coalesce(F.sum(F.size("doc_ids")), F.lit(0)).alias("n"), F.sum(length).alias("l")).first()

    weight = F.floor(1000 * F.log((2 * F.lit(totals.n) + 2) / (2 * F.col("df") + 1))).cast("long")
    weighted = split.select("key", F.explode("terms").alias("term")).join(frequencies, "term")
    weighted = weighted.withColumn("w", weight).filter("w > 0")
    weighted = weighted.groupBy("key").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    weighted = materialise(weighted, "search-weights")
    total = weighted.agg(F.sum(F.size("terms"))).first()[0] or 0
    results = []
    blocks = max(1, -(-total // block_terms))
    for block in range(blocks):
        rows = weighted.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        asked = sorted((r.key, sorted((bytes(t.term), t.w) for t in r.terms)) for r in rows)
        shared = spark.sparkContext.broadcast(Queries(asked, totals.n, totals.l))
        first = _scored(docs, _highest(index, shared, max(pilot, best)), shared, best)
        thresholds = {r.key: r.score for r in first.filter(F.col("rank") == best).collect()}
        results.append(_scored(docs, _not_excluded(index, shared, thresholds), shared, best))
    if not results:
        return split.limit(0).select("item_id", "text", *[F.lit(0).cast(t).alias(c) for c, t in (("rank", "int"), ("doc_id", "long"), ("score", "long"))])
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found.join(split.drop("terms"), "key").select("item_id", "text", F.col("rank").cast("int"), "doc_id", "score")
