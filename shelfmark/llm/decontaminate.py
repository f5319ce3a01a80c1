"""Benchmark decontamination: a generalised suffix automaton of test items, run over the words of training documents."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.text import FOLDED, Batches, folded_words, in_batches, materialise, per_row, sliced, tucked, untucked
from shelfmark.session import scratch_dir

WINDOW = 13
BLOCK_WORDS = 200_000
FILTER_BITS = 27  # of a run's hash, which choose its bit in the table that every task holds: 16 MB
PAGE_BITS = 16
FACTOR = np.uint64(0x9E3779B97F4A7C15)
COVERAGE = 20  # a document is contaminated if 20 * hit words >= words
MATCH = "n_words long, spans array<struct<start:int,end:int>>, items array<string>, longest int"


class SuffixAutomaton:
    """All substrings of several word sequences.

    A state stands for the strings that end at the same places of the items. `windows` names, for each state that holds a
    string of WINDOW words, the items with that string; `shorts` names, for each state of a whole item of fewer words, its
    length and items.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.longest, self.link, self.step = [0], [-1], [{}]
        self.windows: dict[int, set[str]] = defaultdict(set)
        self.shorts: dict[int, set[str]] = defaultdict(set)
        coded = [
            (item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for item, words in items if words
        ]
        ends = [(item, ids, self._insert(ids)) for item, ids in coded]
        self.least = min((min(len(ids), window) for _, ids in coded), default=window)
        for item, ids, end in ends:
            if len(ids) < window:
                self.shorts[end].add(item)
            else:
                state = length = 0
                for word in ids:
                    state, length = self._advance(state, length, word)
                    if length >= window:
                        self.windows[self._shortened(state)].add(item)
        self._pack()

    def _insert(self, ids: list[int]) -> int:
        last = 0
        for word in ids:
            last = self._extend(last, word)
        return last

    def _copy(self, state: int, length: int) -> int:
        self.longest.append(length)
        self.link.append(self.link[state])
        self.step.append(dict(self.step[state]))
        return len(self.longest) - 1

    def _redirect(self, state: int, word: int, old: int, new: int) -> None:
        while state >= 0 and self.step[state].get(word) == old:
            self.step[state][word] = new
            state = self.link[state]

    def _extend(self, last: int, word: int) -> int:
        """The state of `last`'s longest string with one more word."""
        there = self.step[last].get(word)
        if there is not None:  # another item has it already
            if self.longest[there] == self.longest[last] + 1:
                return there
            clone = self._copy(there, self.longest[last] + 1)
            self.link[there] = clone
            self._redirect(last, word, there, clone)
            return clone
        self.longest.append(self.longest[last] + 1)
        self.link.append(0)
        self.step.append({})
        new = len(self.longest) - 1
        while last >= 0 and word not in self.step[last]:
            self.step[last][word] = new
            last = self.link[last]
        if last >= 0:
            there = self.step[last][word]
            if self.longest[there] != self.longest[last] + 1:
                clone = self._copy(there, self.longest[last] + 1)
                self.link[there] = clone
                self._redirect(last, word, there, clone)
                there = clone
            self.link[new] = there
        return new

    def _advance(self, state: int, length: int, word: int) -> tuple[int, int]:
        """The longest string that ends here and that some item holds."""
        while state and word not in self.step[state]:
            state = self.link[state]
            length = self.longest[state]
        onward = self.step[state].get(word)
        return (0, 0) if onward is None else (onward, length + 1)

    def _shortened(self, state: int) -> int:
        while self.longest[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def _pack(self) -> None:
        """For each state, the nearest state of a whole short item on its chain of suffixes, itself included."""
        self.short_at = [-1] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.longest.__getitem__):
            self.short_at[state] = state if state in self.shorts else self.short_at[self.link[state]]

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Spans of hit words (merged, end exclusive), the items that occur, and the words of the longest match.

        A match is a string of the items that holds a window: a whole short item, or at least a window's words.
        """
        spans: list[list[int]] = []
        found: set[str] = set()
        most = 0
        if len(words) < self.least:
            return [], found, most
        known = np.fromiter(map(self.vocabulary.__contains__, words), bool, len(words))
        edges = np.flatnonzero(np.diff(known, prepend=False, append=False))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - begin < self.least:  # no window lies within so few known words
                continue
            state = length = 0
            for at in range(begin, end):
                state, length = self._advance(state, length, self.vocabulary[words[at]])
                hit = 0
                if length >= self.window:
                    found |= self.windows.get(self._shortened(state), set())
                    hit = self.window
                    most = max(most, length)
                short = self.short_at[state]
                if short == state and self.longest[state] > length:
                    short = self.short_at[self.link[state]]
                while short > 0:
                    hit = max(hit, self.longest[short])
                    found |= self.shorts[short]
                    short = self.short_at[self.link[short]]
                if hit:
                    most = max(most, hit)
                    start = at + 1 - hit
                    while spans and spans[-1][1] >= start:
                        start = min(start, spans.pop()[0])
                    spans.append([start, at + 1])
        return [(a, b) for a, b in spans], found, most


def _pieces(benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """Items as pieces of at most block_words words, which overlap so that no window is lost."""

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for item, raw in zip(batch.column("item").to_pylist(), batch.column("raw").to_pylist(), strict=True):
                words = folded_words(raw)
                for start in range(0, max(len(words) - window + 1, 1 if words else 0), max(block_words - window + 1, 1)):
                    part = words[start : start + max(block_words, window)]
                    rows.append((item, start, len(part), b" ".join(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
                if rows
                else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64(), pa.binary())],
                names=["item", "start", "n", "words"],
            )

    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("raw")
    )
    return in_batches(items, cut, "item string, start long, n long, words binary")


def _runs(words: list[bytes], sizes: list[int]) -> np.ndarray:
    """Hashes of all runs of words of some sizes, each once."""
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    found = [np.zeros(0, np.uint64)]
    for size in sizes:
        run = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for k in range(size if len(run) else 0):
            run = run * FACTOR + hashed[k : k + len(run)]
        found.append(run)
    return np.unique(np.concatenate(found)).view(np.int64)


def _filter(runs: DataFrame) -> np.ndarray:
    """A bit for each value of the last FILTER_BITS bits of a hash: whether a run has it. Tasks make pages of 8 kB."""
    place = F.col("run").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    places = runs.select(F.shiftright(place, PAGE_BITS).alias("page"), place.bitwiseAND(F.lit((1 << PAGE_BITS) - 1)).alias("bit"))
    pages = places.groupBy("page").agg(F.collect_set("bit").alias("bits"))  # at most 65,536 values

    def packed(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(len(batch)):
                bits = np.zeros(1 << PAGE_BITS, np.uint8)
                bits[batch.column(1)[i].values.to_numpy()] = 1
                page = np.packbits(bits, bitorder="little").tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([page], pa.binary())], names=["page", "bits"])

    table = np.zeros((1 << (FILTER_BITS - PAGE_BITS), 1 << (PAGE_BITS - 3)), np.uint8)
    for r in in_batches(pages, packed, "page long, bits binary").collect():  # the table's size at most
        table[r["page"]] = np.frombuffer(r["bits"], np.uint8)
    return table.reshape(-1)


def _candidates(source: DataFrame, dealt: DataFrame, window: int) -> DataFrame:
    """(doc_id, _hash, block): the blocks that hold a window of a document, by hashes, so perhaps a few others.

    Runs of documents that no item has are left out where the document is read, by a table of bits of fixed size; the others
    meet the items' runs in a join.
    """
    spark = source.sparkSession
    sizes = sorted(r["n"] for r in dealt.select(F.least("n", F.lit(window)).alias("n")).distinct().collect())

    def of_items(batches: Batches) -> Batches:
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = raw.split()
                runs = _runs(words, [min(len(words), window)])
                yield pa.RecordBatch.from_arrays([pa.array(runs), pa.array([block] * len(runs), pa.int64())], names=["run", "block"])

    runs = in_batches(dealt.select("block", "words"), of_items, "run long, block long")
    runs = materialise(runs.distinct(), "benchmark-runs")
    held = spark.sparkContext.broadcast(_filter(runs))

    def of_documents(batches: Batches) -> Batches:
        last = (1 << FILTER_BITS) - 1
        for batch in sliced(batches):
            for i, raw in enumerate(batch.column(2).to_pylist()):
                found = _runs(folded_words(raw), sizes)
                place = found & last
                found = found[(held.value[place >> 3] >> (place & 7)) & 1 == 1]
                if len(found):
                    at = pa.array(np.full(len(found), i))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(1).take(at), pa.array(found)], names=["doc_id", "_hash", "run"]
                    )

    kind = source.schema["doc_id"].dataType.simpleString()
    texts = source.select("doc_id", F.xxhash64("text").alias("_hash"), "_raw")
    seen = in_batches(texts, of_documents, f"doc_id {kind}, _hash long, run long")
    return materialise(seen.join(runs, "run").select("doc_id", "_hash", "block").distinct(), "candidates")


def _routed(source: DataFrame, candidates: DataFrame) -> DataFrame:
    """Documents with the block to compare them with, written by block: a pass reads its own ones."""
    d, c = source.select("doc_id", F.xxhash64("text").alias("_hash"), "_raw").alias("d"), candidates.alias("c")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d._hash") == F.col("c._hash"))
    routed = d.join(c, same).select("d.doc_id", "d._hash", "d._raw", "c.block")
    path = scratch_dir(source.sparkSession, "routed")
    routed.hint("rebalance", "block").write.partitionBy("block").parquet(path)
    return source.sparkSession.read.schema(routed.schema).parquet(path)


def match_items(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Documents with the spans of words that benchmark items cover.

    `docs` needs `doc_id` and `text`; all its columns stay, and n_words, spans (merged, in words, end exclusive), items (sorted
    item ids as text) and longest (words of the longest shared string that holds a window, 0 without one) are added. A window is
    `window` consecutive words of an item, or a whole item of fewer words. NULL and empty texts have no words; items without words and
    an empty benchmark match nothing; a NULL item_id reads as the empty text; items that share an id count once; repeated
    documents get a row each.

    The automaton is built on the driver from a block of at most block_words words of items, and broadcast. Items beyond
    one block are dealt over several by hash. Then one read of the documents finds those that share the hash of a window with
    a block, a block's pass reads these alone, and the passes are merged by document.
    """
    return _matched(docs, benchmark, window, block_words)


def _matched(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, cut: bool = False) -> DataFrame:
    """What `match_items` gives. With `cut` there is `_cut` too: the text without the spans' words, NULL without spans. The pass
    that finds the spans makes it, as each pass of a stage keeps a Python worker of its own for each core."""
    pieces = materialise(_pieces(benchmark, window, block_words), "benchmark-pieces")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item", "start"), F.lit(blocks)))
    source = docs.withColumn("_raw", F.col("text").cast("binary"))
    made = ", _cut string" * cut

    def without(raw: bytes | None, spans: list[dict]) -> tuple:
        return ((_cut(raw, spans).decode() if spans else None),) * cut

    def one_pass(source: DataFrame, block: int, made: str = "") -> DataFrame:
        rows = dealt.filter(F.col("block") == block).select("item", "words").collect()
        items = sorted((r["item"], bytes(r["words"]).split()) for r in rows)
        automaton = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(items, window))

        def scan(automaton: SuffixAutomaton, raw: bytes | None) -> tuple:
            words = folded_words(raw)
            spans, found, most = automaton.find(words)
            spans = [{"start": a, "end": b} for a, b in spans]
            return len(words), spans, sorted(found), most, *(without(raw, spans) if made else ())

        return per_row(source, scan, ["_raw"], MATCH + made, setup=lambda: automaton.value, gone=("_raw",))

    if blocks == 1:
        return one_pass(source, 0, made)
    candidates = _candidates(source, dealt, window)
    routed = _routed(source, candidates)
    met = sorted(r["block"] for r in candidates.select("block").distinct().collect()) or [0]
    hits = []
    for b in met:
        passed = one_pass(routed.filter(F.col("block") == b).drop("block"), b).filter(F.col("longest") > 0)
        hits.append(materialise(passed.select("doc_id", "_hash", "spans", "items", "longest").distinct(), f"hits-{b}"))
    united = hits[0]
    for more in hits[1:]:
        united = united.unionByName(more)
    merged = united.groupBy("doc_id", "_hash").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.max("longest").alias("longest"),
    )
    columns = [c for c in docs.columns if c not in ("n_words", "spans", "items", "longest")]
    texts = source.select(*[f"`{c}`" for c in columns], "_raw", F.xxhash64("text").alias("_hash"))
    joined = texts.alias("d").join(
        merged.alias("m"),
        F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d._hash") == F.col("m._hash")),
        "left",
    )
    joined = joined.select(
        *[F.col(f"d.`{c}`") for c in columns],
        "d._raw",
        F.coalesce("m._spans", F.array()).alias("_spans"),
        F.coalesce("m.items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("m.longest", F.lit(0)).alias("longest"),
    )

    def merge(raw: bytes | None, spans: list[dict]) -> tuple:
        out: list[dict] = []
        for s in spans or []:
            if out and s["start"] <= out[-1]["end"]:
                out[-1]["end"] = max(out[-1]["end"], s["end"])
            else:
                out.append(dict(s))
        return len(folded_words(raw)), out, *without(raw, out)

    outputs = "n_words long, spans array<struct<start:int,end:int>>" + made
    spans = per_row(joined, merge, ["_raw", "_spans"], outputs, gone=("_raw", "_spans"))
    return spans.select(*[f"`{c}`" for c in columns], "n_words", "spans", "items", "longest", *["_cut"] * cut)


def _hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + (s["end"] - s["start"]))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    `docs` needs doc_id and text, `benchmark` item_id and text; others are not looked at. NULL, empty and blank texts have no
    words and are clean; without items every document is; repeated rows and NULL doc_ids get a row each.
    """
    found = match_items(docs.select("doc_id", "text"), benchmark)
    hit = _hit_words()
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((hit > 0) & (COVERAGE * hit >= F.col("n_words"))).alias("contaminated"),
    )


def _cut(raw: bytes, spans: list[dict]) -> bytes:
    """A text without the words of the spans; what stands between words stays."""
    places, folded, at = [], raw.translate(FOLDED), 0
    for word in folded.split():
        at = folded.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    out, done = [], 0
    for s in spans:
        out.append(raw[done : places[s["start"]][0]])
        done = places[s["end"] - 1][1]
    return b"".join([*out, raw[done:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without contaminated ones, and without the spans that items cover in the others.

    A document goes if hit words are at least a twentieth of its words; from others the hit spans are cut out and n_chars, if
    there, is counted anew. Documents without a hit stay as they are, and so do other columns of any name. NULL and empty texts
    are kept; repeated rows are judged each, and alike; without items or documents nothing changes.
    """
    used = [c for c in ("doc_id", "text", "n_chars") if c in docs.columns]
    found = _matched(tucked(docs, used), benchmark, cut=True)
    kept = found.filter(~((_hit_words() > 0) & (COVERAGE * _hit_words() >= F.col("n_words"))))
    cut = kept.withColumn("text", F.coalesce("_cut", "text"))
    if "n_chars" in used:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(F.size("spans") > 0, counted).otherwise(F.col("n_chars")))
    return cut.select(untucked(cut, docs.columns, used))
