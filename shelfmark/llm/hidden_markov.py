"""Hidden Markov language model: Baum-Welch counts summed over partitions, exact likelihoods by the scaled forward recursion."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.counting import word_counts
from shelfmark.llm.text import Batches, held_out, in_batches, lower_words, materialise, sliced

STATES = 8
ROUNDS = 4
OWN = 4096  # most frequent words, each a symbol of its own
BUCKETS = 4096  # symbols of the other words, by their last letters
ENDING = 4
SYMBOLS = OWN + BUCKETS
LISTED = 1 << 17  # most frequent words, whose counts every task holds
SEGMENT = 512  # tokens of a text that are a sequence of their own, tied to its neighbours by maps of the states
WHOLE = 8192  # tokens of a text whose likelihood is found place by place
RESCALED = 8  # places after which the maps are scaled
SIDE_BY_SIDE = 256  # segments of longer texts at a time
BATCH_TOKENS = 1 << 17  # that are trained on at a time; four times as many are scored
PRIOR = 100.0  # tokens of the overall mix that each state is given
END = b""
SEED = 7


def bucket(word: bytes) -> int:
    return OWN + zlib.crc32(word[-ENDING:]) % BUCKETS


@dataclass
class Model:
    """Chances of the first state, of the next state, and of a symbol in a state (states x symbols)."""

    first: np.ndarray
    onward: np.ndarray
    symbols: np.ndarray


def starting_model(shares: np.ndarray, states: int = STATES) -> Model:
    """States that stay, each with its own distortion of the overall symbol shares; the same on every run."""
    noise = np.exp(np.random.default_rng(SEED).normal(0.0, 0.5, (states, len(shares))))
    symbols = shares * noise
    even = np.full(states, 1.0 / states)
    onward = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(onward, 0.9 if states > 1 else 1.0)
    return Model(even, onward, symbols / symbols.sum(axis=1, keepdims=True))


class TimeMajor:
    """Sequences laid out by place: first all first symbols, longest sequence first, then all second ones, and so on.

    A step of a recursion is then a few operations on (states x sequences).
    """

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        ordered = lengths[self.order]
        steps = int(ordered[0])
        self.active = np.searchsorted(-ordered, -np.arange(1, steps + 1), side="right")
        self.begin = np.concatenate([[0], np.cumsum(self.active)])
        who = np.repeat(np.arange(len(ordered)), ordered)
        place = np.arange(len(who)) - np.repeat(np.cumsum(ordered) - ordered, ordered)
        self.symbols = np.empty(len(place), np.int64)
        self.symbols[self.begin[place] + who] = np.concatenate([sequences[i] for i in self.order])
        self.steps = list(zip(self.begin[:-1].tolist(), self.active.tolist(), strict=True))

    def forward(self, model: Model, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled state chances at each place, the scales, and the symbol chances there. `first`: a column a sequence."""
        emitted = np.take(model.symbols, self.symbols, axis=1)
        chances = np.empty_like(emitted)
        scales = np.empty(emitted.shape[1])
        ahead, turned = first[:, self.order], model.onward.T.copy()
        for a, n in self.steps:
            now = ahead[:, :n] * emitted[:, a : a + n]
            scale = now.sum(axis=0)
            now /= scale
            chances[:, a : a + n], scales[a : a + n] = now, scale
            ahead = turned @ now
        return chances, scales, emitted

    def log10(self, scales: np.ndarray, sequences: int) -> np.ndarray:
        owner = np.concatenate([self.order[:n] for n in self.active])
        return np.bincount(owner, np.log10(scales), sequences)

    def scales(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """The scales alone, and the state chances at the last place, a column for each sequence as long as the longest."""
        emitted = np.take(model.symbols, self.symbols, axis=1)
        scales = np.empty(emitted.shape[1])
        ahead, turned = np.repeat(model.first[:, None], len(self.order), axis=1), model.onward.T.copy()
        for a, n in self.steps:
            now = ahead[:, :n] * emitted[:, a : a + n]
            scale = now.sum(axis=0)
            scales[a : a + n] = scale
            now /= scale
            ahead = turned @ now
        return scales, now


def _transfers(segments: list[np.ndarray], starts: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """For each segment, the map from state chances before it to those at its end, and the log10 of its scale.

    A segment that starts a text has no place before it: its map begins at the states of its first place.
    """
    states = len(model.first)
    laid = TimeMajor(segments)
    emitted = np.take(model.symbols, laid.symbols, axis=1)
    turned = model.onward.T.copy()
    now = np.where(starts[laid.order], np.eye(states)[:, :, None], turned[:, :, None])  # to x from x segments
    maps, logs = np.empty((len(segments), states, states)), np.zeros(len(segments))
    left = [n for _, n in laid.steps[1:]] + [0]
    for step, (a, n) in enumerate(laid.steps):
        if step:
            now = (turned @ now.reshape(states, -1)).reshape(states, states, n)
        now *= emitted[:, None, a : a + n]
        if left[step] < n or step % RESCALED == 0:
            scale = now.sum(axis=(0, 1))
            now /= scale
            logs[:n] += np.log10(scale)
        if left[step] < n:
            maps[left[step] : n] = now[:, :, left[step] :].T
            now = now[:, :, : left[step]].copy()
    back = np.argsort(laid.order)
    return maps[back], logs[back]


def _tied_segments(texts: list[np.ndarray], model: Model) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Texts as segments, the state chances at the place before each (0 where a text begins), and the backward ones at its end."""
    numbers = [-(-len(t) // SEGMENT) for t in texts]
    segments = [t[a : a + SEGMENT] for t in texts for a in range(0, len(t), SEGMENT)]
    before, after = np.zeros((len(model.first), len(segments))), np.ones((len(model.first), len(segments)))
    first = np.cumsum([0, *numbers[:-1]]) if texts else []
    spans = [(a, a + n) for a, n in zip(first, numbers, strict=True) if n > 1]
    inner = [s for a, b in spans for s in range(a, b)]
    begins = {a for a, _ in spans}
    maps = {}
    for a in range(0, len(inner), SIDE_BY_SIDE):
        some = inner[a : a + SIDE_BY_SIDE]
        found, _ = _transfers([segments[s] for s in some], np.array([s in begins for s in some]), model)
        maps.update(zip(some, found, strict=True))
    for a, b in spans:
        state = model.first
        for s in range(a, b - 1):
            state = state @ maps[s]
            before[:, s + 1] = state = state / state.sum()
        for s in range(b - 1, a, -1):
            behind = maps[s] @ after[:, s]
            after[:, s - 1] = behind / behind.max()
    return segments, before, after


def expected_counts(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """Baum-Welch counts of whole texts, a column a state: rows of symbols, then of states before, then of first states."""
    states, n_symbols = model.symbols.shape
    counts = np.zeros((n_symbols + states + 1, states))
    segments, before, after = _tied_segments(texts, model)
    ends = np.cumsum([len(s) for s in segments])
    parts = max(1, int(ends[-1]) // BATCH_TOKENS)  # a very long text is several
    cuts = np.searchsorted(ends, ends[-1] * np.arange(1, parts + 1) // parts) + 1
    for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
        if a < b:
            counts += _segment_counts(segments[a:b], before[:, a:b], after[:, a:b], model)
    return counts


def _segment_counts(segments: list[np.ndarray], before: np.ndarray, after: np.ndarray, model: Model) -> np.ndarray:
    states, n_symbols = model.symbols.shape
    counts = np.zeros((n_symbols + states + 1, states))
    laid = TimeMajor(segments)
    starts = ~before.any(axis=0)
    chances, scales, weighted = laid.forward(model, np.where(starts, model.first[:, None], model.onward.T @ before))
    weighted /= scales  # becomes symbol chance x backward chance / scale
    before, after = before[:, laid.order], after[:, laid.order]
    following = np.zeros((states, states))
    behind = np.ones((states, 0))
    for step in range(len(laid.steps) - 1, -1, -1):
        a, n = laid.steps[step]
        later = behind.shape[1]
        if later < n:  # segments that end here
            ending = after[:, later:n] / (chances[:, a + later : a + n] * after[:, later:n]).sum(axis=0)
            behind = np.concatenate([behind, ending], axis=1) if later else ending
        here = weighted[:, a : a + n]
        here *= behind
        if step:
            earlier = laid.steps[step - 1][0]
            following += chances[:, earlier : earlier + n] @ here.T
        else:
            following += before @ here.T
        chances[:, a : a + n] *= behind  # the chance of each state given the whole text
        behind = model.onward @ here
    for k in range(states):
        counts[:n_symbols, k] = np.bincount(laid.symbols, chances[k], n_symbols)
    counts[n_symbols:-1] = model.onward * following
    counts[-1] = chances[:, : len(segments)] @ starts[laid.order]
    return counts


def reestimated(counts: np.ndarray, shares: np.ndarray) -> Model:
    """The model of the summed counts, with a prior of PRIOR tokens a state."""
    states = counts.shape[1]
    symbols = counts[: len(shares)].T + PRIOR * shares
    onward = counts[len(shares) : -1] + 1.0 / states
    first = counts[-1] + 1.0 / states
    return Model(first / first.sum(), onward / onward.sum(axis=1, keepdims=True), symbols / symbols.sum(axis=1, keepdims=True))


def log_likelihoods(sequences: list[np.ndarray], model: Model) -> np.ndarray:
    """log10 of the exact chance of each sequence. Long ones are cut: their later segments' maps are found side by side."""
    heads = [s[:WHOLE] for s in sequences]
    laid = TimeMajor(heads)
    scales, ends = laid.scales(model)
    logs = laid.log10(scales, len(heads))
    states = {}  # of long texts, whose heads are the longest sequences here
    rest: list[tuple[int, np.ndarray]] = []
    for rank, i in enumerate(laid.order.tolist()):
        if len(sequences[i]) > WHOLE:
            states[i] = ends[:, rank]
            rest += [(i, sequences[i][a : a + SEGMENT]) for a in range(WHOLE, len(sequences[i]), SEGMENT)]
    for a in range(0, len(rest), SIDE_BY_SIDE):
        some = rest[a : a + SIDE_BY_SIDE]
        found = _transfers([s for _, s in some], np.zeros(len(some), bool), model)
        for (i, _), onward, log in zip(some, *found, strict=True):
            state = states[i] @ onward
            logs[i] += log + math.log10(state.sum())
            states[i] = state / state.sum()
    return logs


@dataclass
class Vocabulary:
    """What every task holds: frequent words with their symbols and counts, and the size of each bucket."""

    words: list[bytes]
    counts: np.ndarray
    log_sizes: np.ndarray  # by symbol, log10 of the denominator of a word's chance in it; 0 for a word of its own

    def places(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    def symbols(self) -> np.ndarray:
        own = min(OWN, len(self.words))
        return np.array([*range(own), *map(bucket, self.words[own:])], np.int64)


def _vocabulary(counts: DataFrame) -> tuple[Vocabulary, np.ndarray, int, int]:
    """The vocabulary, the share of each symbol, and the numbers of tokens and of distinct tokens."""
    octave = F.floor(F.log2("n") * 16)  # words of about one count; a few hundred values
    least, room = None, LISTED
    for r in sorted(counts.groupBy(octave.alias("octave")).count().collect(), key=lambda r: -r["octave"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["octave"]
    most = counts.filter(octave >= least).select("word", "n").collect() if least is not None else []
    most = sorted(((r["n"], bytes(r["word"])) for r in most), key=lambda pair: (-pair[0], pair[1]))
    words = [word for _, word in most]
    numbers = np.array([n for n, _ in most], np.int64)
    own = min(OWN, len(words))
    ending = F.crc32(F.substring("word", -ENDING, ENDING)) % BUCKETS
    sizes = counts.groupBy(ending.alias("bucket")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    tokens, distinct = np.zeros(SYMBOLS), np.zeros(SYMBOLS)
    for r in sizes.collect():  # at most BUCKETS rows
        tokens[OWN + r["bucket"]], distinct[OWN + r["bucket"]] = r["n"], r["words"]
    n, v = int(tokens.sum()), int(distinct.sum())
    for i in range(own):
        tokens[i] = numbers[i]
        tokens[bucket(words[i])] -= numbers[i]
        distinct[bucket(words[i])] -= 1
    log_sizes = np.zeros(SYMBOLS)
    log_sizes[OWN:] = np.log10(tokens[OWN:] + distinct[OWN:] + 1)
    shares = (tokens + 0.5) / (tokens + 0.5).sum()
    return Vocabulary(words, numbers, log_sizes), shares, n, v


CODED = "n_tokens long, n_listed long, listed_log double, tied_log double, symbols binary, rare array<binary>, rare_n array<int>"


def _coded(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Texts as symbols, with sums over words that the vocabulary lists, and the words that it doesn't."""
    held = texts.sparkSession.sparkContext.broadcast(vocabulary)
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        vocabulary = held.value
        find, own = vocabulary.places().get, vocabulary.symbols()
        logs = np.log10(vocabulary.counts + 1)
        for batch in sliced(batches):
            made: list[list] = [[] for _ in range(7)]
            for raw in batch.column(2).to_pylist():
                words = [*lower_words(raw), END]
                at = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
                listed = at >= 0
                symbols = np.zeros(len(words), np.int64)
                symbols[listed] = own[at[listed]]
                unlisted = np.flatnonzero(~listed).tolist()
                rare = Counter(words[i] for i in unlisted)
                symbols[unlisted] = [bucket(words[i]) for i in unlisted]
                tied = symbols >= OWN
                known = logs[at[listed]]
                values = (
                    len(words),
                    int(listed.sum()),
                    float(known.sum()),
                    float(known[tied[listed]].sum() - vocabulary.log_sizes[symbols].sum()),
                    symbols.astype("<u2").tobytes(),
                    list(rare),
                    list(rare.values()),
                )
                for column, value in zip(made, values, strict=True):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, made, types)],
                names=["doc_id", "held_out", *(c.split()[0] for c in CODED.split(", "))],
            )

    coded = in_batches(texts, run, f"doc_id {kind}, held_out boolean, {CODED}")
    return materialise(coded.withColumn("row", F.monotonically_increasing_id()), "coded")


def _groups(batches: Batches, column: int, tokens: int = BATCH_TOKENS) -> object:
    """Symbol sequences of some batches, in groups of bounded size, with the rows they are of."""
    for batch in batches:
        rows = batch.column(column).to_pylist()
        begin, size = 0, 0
        for i, raw in enumerate(rows):
            size += len(raw) // 2
            if size >= tokens or i == len(rows) - 1:
                yield batch.slice(begin, i + 1 - begin), [np.frombuffer(r, "<u2") for r in rows[begin : i + 1]]
                begin, size = i + 1, 0


def train(coded: DataFrame, shares: np.ndarray, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over every training text, whole. Tasks hand on one table of counts each, which Spark sums by row."""
    context = coded.sparkSession.sparkContext
    learning = coded.filter("NOT held_out").select("symbols")
    model = starting_model(shares, states)
    columns = [f"s{k}" for k in range(states)]
    for _ in range(rounds):
        held = context.broadcast(model)

        def run(batches: Batches, held=held) -> Batches:
            total = np.zeros((held.value.symbols.shape[1] + states + 1, states))
            for _, texts in _groups(batches, 0):
                total += expected_counts(texts, held.value)
            some = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), *(pa.array(total[some, k]) for k in range(states))], names=["slot", *columns]
            )

        partial = in_batches(learning, run, "slot long, " + ", ".join(f"{c} double" for c in columns))
        counts = np.zeros((len(shares) + states + 1, states))
        for r in partial.groupBy("slot").agg(*[F.sum(c).alias(c) for c in columns]).collect():  # the model's size
            counts[r["slot"]] = [r[c] for c in columns]
        model = reestimated(counts, shares)
        held.unpersist()
    return model


def score(
    docs: DataFrame, modulus: int = 7, value: int = 2, states: int = STATES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `docs` needs doc_id and text. Tokens are lower-cased words and one end a text. The model learns from documents whose
    crc32(doc_id) modulo `modulus` isn't `value`; those without a doc_id are held out. base_score is the add-one unigram
    log10; score is the model's: a hidden state emits a symbol (a frequent word, or a bucket of words of one ending), and a
    bucket emits its word by add-one counts, with one unseen word a bucket. NULL texts are empty and have the end token only;
    repeated rows count and are scored each; with nothing to learn from, the model is even.

    Counts of the 131,072 most frequent words go to every task; all other words of a text meet their counts in a join.
    """
    texts = docs.select(
        "doc_id", held_out("doc_id", modulus, value).alias("held_out"), F.col("text").cast("binary").alias("raw")
    )
    learning = texts.filter("NOT held_out").select(F.lit(None).cast("string").alias("key"), "raw")
    counts = word_counts(learning, lower_words, END)
    vocabulary, shares, n, v = _vocabulary(counts)
    coded = _coded(texts, vocabulary)
    held = docs.sparkSession.sparkContext.broadcast(train(coded, shares, states, rounds))

    def likelihood(batches: Batches) -> Batches:
        for part, texts in _groups(batches, 1, 4 * BATCH_TOKENS):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(log_likelihoods(texts, held.value))], names=["row", "hidden_log"]
            )

    hidden = in_batches(coded.select("row", "symbols"), likelihood, "row long, hidden_log double")
    pairs = coded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r"))
    pairs = pairs.select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("times"))
    rare = (
        pairs.join(counts.select("word", "n"), "word")
        .groupBy("row")
        .agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_log"))
    )
    numbers = coded.select("row", "doc_id", "held_out", "n_tokens", "n_listed", "listed_log", "tied_log")
    joined = numbers.join(hidden, "row").join(rare, "row", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_listed") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("listed_log") + rare_log - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("hidden_log") + F.col("tied_log") + rare_log).alias("score"),
    )
