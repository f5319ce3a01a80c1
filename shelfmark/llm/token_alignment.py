"""Cross-tokenizer alignment as Arrow tables: two tokenizers' tokens of a text, joined where they end at the same byte."""

from __future__ import annotations

import hashlib
import json
import os
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.text import Batches, in_batches, materialise, sliced

LEFT = "byte_bpe_50k.json"
RIGHT = "piece_bpe_32k.model"
SLICE_TEXTS = 64
SLICE_BYTES = 1 << 20
MOST_SHARED = 500_000  # pairs, the most frequent ones, whose counts every task gets
HELD_PAIRS = 1_000_000  # that a task counts before it hands its counts on
PAIR = 1 << 32  # a pair is left id * PAIR + right id
TEXT = 1 << 40  # an end is text * TEXT + byte

LINKED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, left binary, right binary, times binary"


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if printable, else the next free one."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """What the ids of a tokenizer stand for."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = pa.array(tokens, pa.large_binary())
        self.lengths = pa.array(list(map(len, tokens)), pa.int64())
        self.digits = pa.array(list(map(str, range(len(tokens)))), pa.string())


class ByteLevel(Vocabulary):
    """A byte-level vocabulary; a space goes before each text.

    Where its ids are its merges' ranks and it splits by the usual pattern, ids come from the ranks alone, which gives the same
    ids sooner.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are text
        names, byte_of = self.tokenizer.get_vocab(), _byte_of()
        tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            tokens[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        super().__init__(tokens)
        self.ranked = self._ranked(tokens)

    def _ranked(self, tokens: list[bytes]):
        """The same vocabulary as ranks, None if it isn't one."""
        from tiktoken import Encoding

        made = json.loads(self.tokenizer.to_str())
        model, splitter, byte_of = made["model"], made["pre_tokenizer"] or {}, _byte_of()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
        in_turn = [bytes(byte_of[c] for c in "".join(m)) for m in merges]
        usual = splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not splitter.get("add_prefix_space")
        whole = not made["normalizer"] and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback"))
        if not (model.get("type") == "BPE" and usual and whole and sorted(tokens[:256]) == [bytes([b]) for b in range(256)]):
            return None
        if tokens[256 : 256 + len(in_turn)] != in_turn:
            return None
        ranks = {token: i for i, token in enumerate(tokens[: 256 + len(in_turn)])}
        return Encoding("byte-level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.ranked:
            return [self.ranked.encode_ordinary(" " + t) for t in texts]
        return self.by_merges(texts)

    def by_merges(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces(Vocabulary):
    """A vocabulary of pieces with byte fallback, which adds the space itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.processor = SentencePieceProcessor(model_file=path)
        names = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        super().__init__(
            [
                bytes([int(name[3:5], 16)]) if self.processor.is_byte(i) else name.replace("▁", " ").encode()
                for i, name in enumerate(names)
            ]
        )

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


@cache
def vocabulary(name: str) -> Vocabulary:
    path = public_tokenizers.path(name)
    return Pieces(path) if name.endswith(".model") else ByteLevel(path)


def _lists(ids: list[list[int]]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.fromiter(chain.from_iterable(ids), np.int32, offsets[-1])))


def _spelled(words: Vocabulary, ids: pa.ListArray, raws: list[bytes]) -> list[bool]:
    """Whether the joined bytes of each text's tokens are those of a space and the text."""
    taken = words.tokens.take(ids.values)
    bounds = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[ids.offsets.to_numpy()]
    data = memoryview(taken.buffers()[2] or b"")
    return [data[a:b].tobytes() == b" " + raw for raw, a, b in zip(raws, bounds[:-1], bounds[1:], strict=True)]


def _ends(words: Vocabulary, ids: pa.ListArray, side: str) -> pa.Table:
    """(end, side, side_id): a row per token with its text and the byte where it ends there, tokens numbered through."""
    flat, text = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    run = pc.cumulative_sum(words.lengths.take(flat))
    starts = ids.offsets.to_numpy()[:-1]
    base = np.concatenate([[0], run.to_numpy()])[starts]
    return pa.table(
        {
            "end": pc.add(pc.multiply(text, TEXT), pc.subtract(run, pa.array(base).take(text))),
            side: pa.array(np.arange(len(flat))),
            f"{side}_id": flat,
        }
    )


def _counted(values: pa.Array, n: int) -> np.ndarray:
    return np.bincount(values.to_numpy(), minlength=n)


class Aligned:
    """Some texts' links: a row for every stretch of bytes that lies in one token on each side, in order."""

    def __init__(self, left: Vocabulary, right: Vocabulary, texts: list[str]) -> None:
        self.n = len(texts)
        raws = [t.encode() for t in texts]
        coded = [(words, _lists(words.encode(texts))) for words in (left, right)]
        good = [bool(raw) and a and b for raw, a, b in zip(raws, *[_spelled(w, ids, raws) for w, ids in coded], strict=True)]
        if not all(good):  # texts that a side doesn't spell have no tokens
            coded = [(w, _lists([x if g else [] for x, g in zip(ids.to_pylist(), good, strict=True)])) for w, ids in coded]
        self.sizes = [np.diff(ids.offsets.to_numpy()) for _, ids in coded]
        a, b = (_ends(words, ids, side) for (words, ids), side in zip(coded, "ab", strict=True))
        # Each end is in the join once; the token that a stretch lies in is the next one that ends.
        joined = a.join(b, keys="end", join_type="full outer", use_threads=False).combine_chunks()
        joined = joined.take(pc.sort_indices(joined["end"]))
        self.text = pc.shift_right(joined["end"].combine_chunks(), 40)
        has_a, has_b = (joined[s].combine_chunks().is_valid().to_numpy(zero_copy_only=False) for s in "ab")
        self.cut = has_a & has_b
        self.a, self.b = (pc.fill_null_backward(joined[f"{s}_id"]).combine_chunks() for s in "ab")
        group = np.cumsum(self.cut) - self.cut
        self.groups = _counted(self.text.filter(pa.array(self.cut)), self.n)
        self._sides = [
            (words.digits.take(column.filter(pa.array(has))), group[has])
            for words, column, has in ((left, self.a, has_a), (right, self.b, has_b))
        ]

    def written(self) -> list[str]:
        """Each text's groups as left ids|right ids; groups one after the other."""
        total = int(self.groups.sum())
        sides = []
        for digits, group in self._sides:
            offsets = np.searchsorted(group, np.arange(total + 1)).astype(np.int32)
            sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), digits), ","))
        both = pc.binary_join_element_wise(*sides, "|")
        offsets = np.concatenate([[0], np.cumsum(self.groups)]).astype(np.int32)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), both), ";").to_pylist()

    def links(self) -> np.ndarray:
        return _counted(self.text, self.n)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each text's distinct pairs begin, the pairs in order, and how often each is linked."""
        pair = pc.add(pc.multiply(self.a.cast(pa.int64()), PAIR), self.b.cast(pa.int64()))
        counted = pa.table({"text": self.text, "pair": pair}).group_by(["text", "pair"], use_threads=False)
        counted = counted.aggregate([([], "count_all")]).combine_chunks()
        text, pair, times = (counted[c].to_numpy() for c in ("text", "pair", "count_all"))
        order = np.lexsort((pair, text))
        return np.searchsorted(text[order], np.arange(self.n + 1)), pair[order], times[order]


def _steps(left: np.ndarray) -> bytes:
    """Ascending ids as differences, which compress well."""
    return np.diff(left, prepend=0).astype("<u4").tobytes()


def _pairs(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of several texts, one after the other, and how many each text has."""
    sizes = np.array([len(x) // 4 for x in left.to_pylist()], np.int64)
    steps = np.frombuffer(b"".join(left.to_pylist()), "<u4").astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    run = np.concatenate([[0], np.cumsum(steps)])
    a = run[1:] - np.repeat(run[starts[:-1]], sizes)
    return a * PAIR + np.frombuffer(b"".join(right.to_pylist()), "<u4"), sizes


def _slices(raws: list[str]):
    """Ranges of at most SLICE_TEXTS texts of SLICE_BYTES together, one text at least."""
    start = held = 0
    for i, text in enumerate(raws):
        if i > start and (i - start >= SLICE_TEXTS or held + len(text) > SLICE_BYTES):
            yield start, i
            start, held = i, 0
        held += len(text)
    if raws:
        yield start, len(raws)


def linked(docs: DataFrame, left: str = LEFT, right: str = RIGHT, with_groups: bool = False) -> DataFrame:
    """Each document's numbers of tokens, groups and links, and its distinct linked pairs, as a written table."""
    outputs = LINKED + (", groups string" if with_groups else "")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        sides = vocabulary(left), vocabulary(right)
        for batch in sliced(batches):
            texts, ids = [t or "" for t in batch.column("text").to_pylist()], batch.column("doc_id")
            for start, stop in _slices(texts):
                aligned = Aligned(*sides, texts[start:stop])
                groups, (bounds, pairs, times) = aligned.written(), aligned.pairs()
                a, b, times = pairs // PAIR, (pairs % PAIR).astype("<u4"), times.astype("<u4")
                parts = [slice(x, y) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
                columns = [
                    ids.slice(start, stop - start),
                    *(pa.array(n.astype(np.int64)) for n in (*aligned.sizes, aligned.groups, aligned.links())),
                    pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]),
                    pa.array([_steps(a[p]) for p in parts], pa.binary()),
                    pa.array([b[p].tobytes() for p in parts], pa.binary()),
                    pa.array([times[p].tobytes() for p in parts], pa.binary()),
                ]
                names = ["doc_id", *(field.split()[0] for field in LINKED.split(", "))]
                if with_groups:
                    columns, names = [*columns, pa.array(groups)], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    made = in_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, f"doc_id {kind}, {outputs}")
    return materialise(made.withColumn("row", F.monotonically_increasing_id()), "linked", compression="zstd")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best) as a written table: in how many documents a pair is linked, and whether that is its left id's most."""

    def run(batches: Batches) -> Batches:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])

        for batch in sliced(batches):
            pairs, _ = _pairs(batch.column("left"), batch.column("right"))
            counted = pa.table({"pair": pairs}).group_by("pair", use_threads=False).aggregate([([], "count_all")])
            held.append(counted.rename_columns(["pair", "n"]))
            if sum(map(len, held)) > HELD_PAIRS:
                held = [merged()]
                if len(held[0]) > HELD_PAIRS // 2:
                    yield from held.pop().combine_chunks().to_batches()
        if held:
            yield from merged().combine_chunks().to_batches()

    partial = in_batches(links.select("left", "right"), run, "pair long, n long")
    counts = materialise(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    first = F.floor(F.col("pair") / PAIR)
    most = counts.groupBy(first.alias("first")).agg(F.max("n").alias("most"))  # a row for an id of the vocabulary at most
    best = counts.withColumn("first", first).join(most, "first").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return materialise(best, "pair-best")


def _shared_from(counts: DataFrame, most: int) -> int:
    """The least power of two that at most `most` pairs' counts reach."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r.power: r.pairs for r in counts.groupBy(power.alias("power")).agg(F.count("*").alias("pairs")).collect()}
    least = max(sizes, default=0) + 1
    left = most
    while least > 0 and sizes.get(least - 1, 0) <= left:
        least -= 1
        left -= sizes.get(least, 0)
    return 1 << least


def align(
    docs: DataFrame, left: str = LEFT, right: str = RIGHT, with_groups: bool = False, most_shared: int = MOST_SHARED
) -> DataFrame:
    """A row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and with_groups the groups themselves.

    Tokens that share a byte are linked; groups end where tokens of both sides do. A pair's count is the number of documents
    that link it. Of the counts, the most frequent pairs' (most_shared at most) go to every task; links of the others are
    joined with theirs by pair, and as those are rare, no key of that join is hot.

    NULL and empty texts, and texts that one of the vocabularies doesn't spell byte for byte, have no tokens: zeros and an empty
    groups_sha256. Strings of special tokens are text. Repeated documents count a row each; any type of doc_id may be NULL.
    """
    spark = docs.sparkSession
    links = linked(docs, left, right, with_groups)
    counts = pair_counts(links)
    least = _shared_from(counts, most_shared)
    shared = spark.sparkContext.broadcast(counts.filter(F.col("n") >= least).toArrow().combine_chunks())

    def run(batches: Batches) -> Batches:
        known = shared.value
        pairs_known = known["pair"].combine_chunks() if known.num_rows else pa.array([], pa.int64())
        n = np.append(known["n"].to_numpy(), 0).astype(np.int64)
        best = np.append(known["best"].to_numpy(), False).astype(np.int64)
        for batch in sliced(batches):
            pairs, sizes = _pairs(batch.column("left"), batch.column("right"))
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
            place = pc.index_in(pa.array(pairs), value_set=pairs_known).fill_null(known.num_rows).to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[place] * times)])[starts]) for x in (best, n)]
            rest = place == known.num_rows
            offsets = np.concatenate([[0], np.cumsum(rest)])[starts].astype(np.int32)
            rare = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x[rest])) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *map(pa.array, sums), *rare], names=["row", "n_best", "count_sum", "pairs", "times"]
            )

    summed = in_batches(
        links.select("row", "left", "right", "times"), run, "row long, n_best long, count_sum long, pairs array<long>, times array<long>"
    )
    summed = materialise(summed, "shared-sums")
    rare = summed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
    rare = rare.withColumnRenamed("pairs", "pair").join(counts.filter(F.col("n") < least), "pair")
    rare = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"), F.sum(F.col("n") * F.col("times")).alias("rare_sum")
    )
    sums = summed.drop("pairs", "times").join(rare, "row", "left").select(
        "row",
        (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
    )
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return links.join(sums, "row").select(*columns, *(["groups"] if with_groups else []))
