"""Mixture-controlled packing: deficit round-robin over the token queues of sources, as prefix sums."""

from __future__ import annotations

import os
import zlib
from functools import cache
from itertools import chain, filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.text import Batches, in_batches, materialise, sliced

SEQUENCE = 2048
WINDOW_SEQUENCES = 64
END = 1
VOCABULARY = "word_bpe_49k.json"
CACHED = 500_000  # words whose ids a worker keeps, and as many older ones
TEXT_BYTES = 2 << 20  # of texts that a worker encodes together
CHUNK_ROWS = 4_000
BLOCK_WINDOWS = 4096

_LATIN = "\u0130"  # below it, letters stay letters in lower case
_MARKS = b".,;:!?#*$%&|)"
_ENDED = np.array([END], "<u4").tobytes()


class Encoder:
    """Token ids of texts, by the ids of their words.

    The vocabulary's splitter ends a piece at white space, and none of its rules looks across it, so a text's ids are those of
    its words in turn. Lower case is part of the vocabulary; A-Z may be lowered before, but not where a combining mark or a
    special token's opening could change with it. A word that ends in a letter and then marks like commas is split there too.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)  # ids that end a piece
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True

    @staticmethod
    def lowered(raw: bytes | None) -> bytes:
        if not raw:
            return b""
        return raw if b"\xcc" in raw or b"\xcd" in raw or b"<|" in raw else raw.lower()

    @classmethod
    def words(cls, raw: bytes | None) -> list[bytes]:
        return cls.lowered(raw).split()

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each word. Words of letters are one piece each and go as one text, cut where pieces end."""
        out: dict[str, bytes] = {}
        letters = [w for w in words if w.isalpha() and (w.isascii() or max(w) < _LATIN)]
        for i in range(0, len(letters), 1000):
            some = letters[i : i + 1000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                raw, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
                out.update((w, raw[a:b]) for w, a, b in zip(some, cuts, cuts[1:], strict=False))
        rest = [w for w in words if w not in out]
        for word, coded in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False) if rest else [], strict=True):
            out[word] = np.array(coded.ids, "<u4").tobytes()
        return [out[w] for w in words]

    def learn(self, texts: list[list[bytes]]) -> None:
        """Make the ids of all words of some texts known."""
        if len(self.known) > CACHED:  # words that are used again come back from the older ones
            self.known, self.older = {}, self.known
        self.known[b""] = b""
        new = set(filterfalse(self.known.__contains__, chain.from_iterable(texts)))
        if self.older:
            again = {w: self.older[w] for w in new if w in self.older}
            self.known.update(again)
            new.difference_update(again)
        if not new:
            return
        split = {word: self._split(word) for word in new if word[-1] in _MARKS}
        fresh = new.difference(split).union(*split.values()).difference(self.known, (b"",))
        self.known.update(zip(fresh, self._encoded([w.decode() for w in fresh]), strict=True))
        self.known.update((word, self.known[stem] + self.known[marks]) for word, (stem, marks) in split.items())

    @staticmethod
    def _split(word: bytes) -> tuple[bytes, bytes]:
        """A word that ends in marks as what is before them and the marks, if that ends in a letter or digit."""
        stem = word.rstrip(_MARKS)
        last = stem[-1:]
        if last.isalnum() or (last and stem.decode()[-1].isalpha() and stem.decode()[-1] < _LATIN):
            return stem, word[len(stem) :]
        return word, b""

    def encode(self, words: list[bytes]) -> bytes:
        """Little-endian unsigned 32-bit ids of known words in turn, and the id that ends a document."""
        return b"".join([*map(self.known.__getitem__, words), _ENDED])

    def coded(self, raws: list[bytes | None]) -> list[bytes]:
        """What `encode` gives for the words of each text. Arrow splits the texts and puts the ids of their words side by side, so
        that Python sees each of their different words once."""
        if not raws:
            return []
        texts = pa.array([self.lowered(raw) for raw in raws], pa.binary()).cast(pa.string())
        lists = pc.ascii_split_whitespace(texts)
        words = lists.values.dictionary_encode()
        different = words.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self.learn([different])
        coded = list(map(self.known.__getitem__, different))
        ends = np.zeros(len(coded) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)), out=ends[1:])
        known = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(coded), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(coded))])
        ids = known.take(words.indices)
        bounds = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[lists.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [data[a:b].tobytes() + _ENDED for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


@cache
def _encoder(vocabulary: str) -> Encoder:
    return Encoder(public_tokenizers.path(vocabulary))


def _by_bytes(batches: Batches, column: int) -> Batches:
    """The same rows in batches of about TEXT_BYTES of a binary column, or one row: texts together have fewer different words."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        parts = (np.cumsum(sizes) - sizes) // TEXT_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(row, doc_id, source, n, ids) as a written table: ids as little-endian 16 bits, 32 where the vocabulary needs it."""

    def run(batches: Batches) -> Batches:
        encoder = _encoder(vocabulary)
        width = "<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        for batch in _by_bytes(batches, 2):
            coded, numbers = [], []
            for raw in encoder.coded(batch.column(2).to_pylist()):
                ids = np.frombuffer(raw, "<u4")
                coded.append(ids.astype(width).tobytes())
                numbers.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(numbers, pa.int64()), pa.array(coded, pa.binary())],
                names=["doc_id", "source", "n", "ids"],
            )
            pa.default_memory_pool().release_unused()  # the ids of words leave little room

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")), F.col("text").cast("binary"))
    coded = in_batches(texts, run, f"doc_id {kind}, source string, n long, ids binary")
    return materialise(coded.withColumn("row", F.monotonically_increasing_id()), "tokens")


def _chunked(lengths: DataFrame, rows: int) -> DataFrame:
    return lengths.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(max(1, -(-rows // CHUNK_ROWS)))))


def _queued(lengths: DataFrame, rows: int) -> DataFrame:
    """Each document's place in its source's queue: `before` counts the tokens of the source ahead of it.

    A queue is cut in chunks by hash, which bounds what one task sorts; chunk totals are summed in turn.
    """
    dealt = _chunked(lengths, rows)
    totals = dealt.groupBy("source", "chunk").agg(F.sum("n").alias("chunk_tokens"))
    ahead = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("source", "chunk", F.coalesce(F.sum("chunk_tokens").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "chunk").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return inside.join(bases, ["source", "chunk"]).withColumn("before", F.col("base") + F.col("inside"))


def _served(queued: DataFrame, shares: DataFrame, sequence: int, window: int) -> DataFrame:
    """The piece of each document that each window takes.

    Documents enter as equal packets of at most a sequence. Deficit round-robin gives a source a quantum of tokens a window and
    sends a packet once what it was given and hasn't used, its deficit, covers it. As a queue's packets go in order, that is
    the first window whose quanta together reach the packet's end in the queue: no state has to be carried from task to task.
    A source starts with a deficit in its favour, a part of its first packet; so sources of few packets, whose quanta reach one
    only after many windows, don't all send them in the last.
    """
    number = F.ceil(F.col("n") / sequence)
    end = lambda k: F.floor(k * F.col("n") / number)
    packets = F.sequence(F.lit(1).cast("long"), number)
    quantum = F.col("share") * window
    given = queued.join(shares, "source").withColumn(
        "turns", F.transform(packets, lambda k: F.greatest(F.ceil((F.col("before") + end(k) - F.col("favour")) / quantum), F.lit(1)))
    )
    last = F.filter(
        F.sequence(F.lit(1), F.size("turns")),
        lambda k: (k == F.size("turns")) | (F.get("turns", k - 1) != F.get("turns", k)),
    )
    runs = given.withColumn("lasts", last).select("*", F.posexplode("lasts").alias("nth", "k"))
    start = F.when(F.col("nth") == 0, F.lit(0).cast("long")).otherwise(end(F.get("lasts", F.col("nth") - 1).cast("long")))
    return runs.select(
        F.get("turns", F.col("k") - 1).alias("turn"),
        "source",
        "chunk",
        "row",
        start.alias("start"),
        (end(F.col("k").cast("long")) - start).alias("length"),
    )


def _laid_out(served: DataFrame, sequence: int) -> DataFrame:
    """Pieces cut where sequences end: windows follow each other without gaps, sources take turns in each."""
    order = Window.partitionBy("turn").orderBy("source", "chunk", "row", "start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = materialise(
        served.withColumn("inside", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("chunk", "source"), "served"
    )
    totals = inside.groupBy("turn").agg(F.sum("length").alias("tokens"))
    totals = materialise(totals.withColumn("block", F.floor(F.col("turn") / BLOCK_WINDOWS)), "windows")
    blocks = totals.groupBy("block").agg(F.sum("tokens").alias("tokens"))
    ahead = lambda w: F.coalesce(F.sum("tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a block: 4,096 windows of 131,072 tokens, so a trillion tokens are 2,000 rows.
    blocks = blocks.select("block", ahead(Window.orderBy("block")).alias("block_base"))
    bases = totals.join(blocks, "block").select(
        "turn", (F.col("block_base") + ahead(Window.partitionBy("block").orderBy("turn"))).alias("base")
    )
    placed = inside.join(bases, "turn").withColumn("at", F.col("base") + F.col("inside"))
    first, last = F.floor(F.col("at") / sequence), F.floor((F.col("at") + F.col("length") - 1) / sequence)
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("at"), F.col("sequence_id") * sequence)
    end = F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * sequence)
    return cut.select(
        "row",
        (F.col("start") + begin - F.col("at")).alias("start"),
        (end - begin).alias("length"),
        "sequence_id",
        (begin - F.col("sequence_id") * sequence).alias("offset"),
    )


def _shares(lengths: DataFrame, rows: int, sequence: int, targets: dict[str, float] | None) -> DataFrame:
    """(source, share, favour): the part of each window, and the deficit that a source starts with.

    Sources are taken in the order of a hash, and the part of its first packet that one starts with falls evenly with what the first
    packets before its own hold. So windows get first packets of all sources in like amounts, whatever these weigh.
    """
    leading = F.min(F.struct("chunk", "row", "n"))["n"]
    totals = _chunked(lengths, rows).groupBy("source").agg(F.sum("n").alias("tokens"), leading.alias("n"))
    given: Column = F.lit(None).cast("double")
    if targets:
        wanted = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair])
        given = F.try_element_at(wanted, F.col("source")).cast("double")
    total = totals.agg(F.sum("tokens").alias("all"))
    weights = totals.select(
        "source", F.coalesce(given, F.col("tokens") / total.scalar()).alias("weight"), F.floor(F.col("n") / F.ceil(F.col("n") / sequence)).alias("first")
    )
    weights = materialise(weights, "weights")
    sums = weights.agg(F.sum("weight").alias("all"), F.sum("first").alias("firsts"), F.count("*").alias("n")).first()
    parts = max(1, -(-sums["n"] // CHUNK_ROWS))
    dealt = weights.withColumn("hash", F.xxhash64("source")).withColumn("part", F.pmod("hash", F.lit(parts)))
    totals = dealt.groupBy("part").agg(F.sum("first").alias("tokens"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for thousands of sources
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("hash", "source").rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumn("inside", F.coalesce(F.sum("first").over(within), F.lit(0))).join(bases, "part")
    unserved = 1 - (F.col("base") + F.col("inside")) / F.lit(sums["firsts"] or 1)
    return inside.select(
        "source", (F.col("weight") / F.lit(sums["all"] or 1.0)).alias("share"), (unserved * F.col("first")).alias("favour")
    )


def pack(
    docs: DataFrame,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
    targets: dict[str, float] | None = None,
    vocabulary: str = VOCABULARY,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids.

    `docs` needs doc_id, text and source; others are not looked at. Every token of every document, the end id included, lies in
    exactly one piece. Sequences are full but for the last. A window of `window_sequences` sequences holds each source in its
    target proportion, up to a packet of one sequence; what is missing is made up in the next. `targets` maps sources to
    weights; without one, a source weighs its share of all tokens, so that queues end together. A NULL text is empty and
    has the end id only; NULL sources form the queue of ''; repeated rows and NULL doc_ids are documents of their own.
    """
    coded = tokens(docs, vocabulary)
    lengths = coded.select("row", "source", "n")
    rows = coded.count()
    served = _served(_queued(lengths, rows), _shares(lengths, rows, sequence, targets), sequence, window_sequences * sequence)
    pieces = _laid_out(served, sequence)
    by_row = pieces.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("start", "length", "sequence_id", "offset"))).alias("pieces")
    )
    joined = coded.join(by_row, "row").select("doc_id", "n", "ids", "pieces")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def digest(batches: Batches) -> Batches:
        _encoder.cache_clear()  # texts are encoded: the worker, which lives on, needs the ids of words no more
        for batch in sliced(batches):
            made: list[list] = [[] for _ in names]
            at = []
            for i, (n, ids, parts) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                wide = np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4").astype("<u4")
                for part in parts:
                    piece = wide[part["start"] : part["start"] + part["length"]]
                    at.append(i)
                    row = (part["start"], part["length"], zlib.crc32(piece.tobytes()), n, part["sequence_id"], part["offset"])
                    for column, value in zip(made[1:], (*row, piece), strict=False):
                        column.append(value)
            arrays = [batch.column(0).take(pa.array(at, pa.int64()))]
            arrays += [pa.array(column, pa.int64()) for column in made[1:7]]
            if with_ids:
                arrays.append(pa.array(made[7], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"`{c}` long" for c in names[1:7]) + ", ids array<int>" * with_ids
    return in_batches(joined, digest, schema)
