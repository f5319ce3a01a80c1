"""Toxicity by a weighted finite-state grammar: composed transducers read clauses and weigh what they match."""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.labeled import labels_outside, sampled_texts
from shelfmark.llm.text import Batches, held_out, in_batches, materialise, per_row, remainder, sliced

# Seed words of each class.
INSULTS = (
    "idiot moron stupid loser scum trash clown worthless pathetic disgusting imbecile dumbass bastard asshole bitch retard freak vermin "
    "idiota imbécil estúpido basura escoria crétin imbécile connard ordure salaud abruti dummkopf trottel arschloch abschaum versager"
).split()
THREATS = (
    "kill hurt destroy murder stab shoot strangle burn beat matar matarte destruir quemar golpear tuer détruire brûler frapper töten "
    "umbringen zerstören verbrennen schlagen"
).split()
TARGETS = (
    "you your you're youre he she they them him her his their u ya tu vous il elle ils elles ton votre du dich dein ihr sie er euch "
    "tú usted ustedes él ella ellos te"
).split()
NEGATIONS = "not no never isn't aren't wasn't don't doesn't without nor nicht kein keine nie pas jamais non nunca jamás tampoco".split()
REPORTS = (
    "said says say told called calls reported wrote quoted claimed alleged stated accused according sagte sagt schrieb laut nannte dit "
    "écrit selon déclaré appelé dijo dice según escribió llamó"
).split()

NEGATED_WORDS = 3  # words that a negation reaches
NEAR_WORDS = 6  # words between a target and what hits it, on either side
SEED_INSULT, SEED_THREAT = 1.5, 2.0
PREFIXES = range(3, 9)
LEAST_SUPPORT = 3
LEAST_ODDS = 2.5
MOST_PATTERNS = 20_000  # learned words and beginnings of words, those of the greatest odds; the sample has seldom so many
SAMPLE = {1: 6_000, 0: 18_000}  # labelled documents that are learned from, about so many at most

_BREAKS = b".!?;:|\n\r"
_CURLY = "\u2019".encode()  # read as the plain apostrophe
_SPACED = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 or c == 0x27 else 0x20 for c in range(256)
)
_BROKEN = bytes(0x0A if c in _BREAKS else _SPACED[c] for c in range(256))


@dataclass
class Transducer:
    """A deterministic transducer over symbols; symbols without an arc pass by through `rest`."""

    arcs: dict[tuple[int, str], tuple[int, str]]
    rest: dict[int, int] = field(default_factory=dict)
    start: int = 0

    def read(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol), (self.rest.get(state, state), symbol))


def compose(first: Transducer, second: Transducer, alphabet: set[str]) -> Transducer:
    """The transducer that does what `second` does to what `first` makes of its input."""
    names = {(first.start, second.start): 0}
    arcs, todo = {}, [(first.start, second.start)]
    while todo:
        a, b = todo.pop()
        for symbol in sorted(alphabet):
            onward, middle = first.read(a, symbol)
            after, out = second.read(b, middle)
            if (onward, after) not in names:
                names[onward, after] = len(names)
                todo.append((onward, after))
            arcs[names[a, b], symbol] = (names[onward, after], out)
    return Transducer(arcs)


def _countdown(trigger: str, reach: int, marked: dict[str, str]) -> Transducer:
    """After `trigger`, the next `reach` symbols are marked."""
    arcs = {(k, trigger): (reach, trigger) for k in range(reach + 1)}
    for k in range(1, reach + 1):
        arcs |= {(k, symbol): (k - 1, out) for symbol, out in marked.items()}
    return Transducer(arcs, {k: max(0, k - 1) for k in range(reach + 1)})


# Words come as classes: i insult, t threat, it both. Symbols: I insult, T threat, P target, N negation, R reported speech, o any other word. A match takes on "-" if negated, "~" if
# reported, "@" if aimed at a target
# before it or after it.
ALPHABET = {"I", "T", "P", "N", "R", "o"}
_NEGATION = _countdown("N", NEGATED_WORDS, {"I": "I-", "T": "T-"})
_REPORTED = Transducer(
    {(0, "R"): (1, "R")} | {(1, s): (1, s + "~") for s in ("I", "T", "I-", "T-")}
)
_HITS = [s + n + r for s in "IT" for n in ("", "-") for r in ("", "~")]
_TARGETED = _countdown("P", NEAR_WORDS, {s: s + "@" for s in _HITS})
CLAUSE = compose(compose(_NEGATION, _REPORTED, ALPHABET), _TARGETED, ALPHABET)
CLASSES = {"i", "t", "it"} | ALPHABET - {"I", "T"}
_INSULT = Transducer({(0, "i"): (0, "I"), (0, "it"): (0, "I")})
_THREAT = Transducer({(0, "t"): (0, "T")})
FORWARD = compose(compose(_INSULT, _THREAT, CLASSES), CLAUSE, CLASSES)
_OBJECT = _countdown("P", NEAR_WORDS, {s: s + "@" for s in _HITS})  # reads what FORWARD makes of a clause from its end


def _factor(symbol: str) -> float:
    weight = 1.0 if symbol[0] == "I" else 0.3  # a threat needs somebody to threaten
    if "@" in symbol:
        weight *= 1.5 if symbol[0] == "I" else 5.0
    return weight * (0.3 if "-" in symbol else 1.0) * (0.5 if "~" in symbol else 1.0)


FACTORS = {s + t: _factor(s + t) for s in _HITS for t in ("", "@")}


@dataclass
class Grammar:
    """Weights of whole words and of word beginnings, on top of the seed words."""

    words: dict[str, float]
    prefixes: dict[str, float]

    def __post_init__(self) -> None:
        self.insults = {w: SEED_INSULT for w in INSULTS} | self.words
        self.threats = dict.fromkeys(THREATS, SEED_THREAT)
        self.other = {w: s for s, words in (("P", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}

    def __getstate__(self) -> dict:
        return {"words": self.words, "prefixes": self.prefixes}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def trigger(self) -> ahocorasick.Automaton:
        """What any clause with a match must hold."""
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for word in {*self.insults, *self.threats}:
            automaton.add_word(f" {word} ")
        for prefix in self.prefixes:
            automaton.add_word(f" {prefix}")
        automaton.make_automaton()
        return automaton

    def symbol(self, word: str) -> tuple[str, float]:
        """The class of a word and its weight."""
        weight = self.insults.get(word, 0.0)
        for n in PREFIXES:
            if len(word) <= n:
                break
            weight = max(weight, self.prefixes.get(word[:n], 0.0))
        if weight:
            return "it" if word in self.threats else "i", weight
        if word in self.threats:
            return "t", self.threats[word]
        return self.other.get(word, "o"), 0.0

    def clause(self, words: list[str]) -> float:
        state, read = FORWARD.start, []
        for word in words:
            symbol, weight = self.symbol(word)
            state, out = FORWARD.read(state, symbol)
            read.append((out, weight))
        state, total = _OBJECT.start, 0.0
        for symbol, weight in reversed(read):
            state, out = _OBJECT.read(state, symbol)
            total += weight * FACTORS.get(out, 0.0)
        return total


def clause_scores(raw: bytes | None, grammar: Grammar, trigger: ahocorasick.Automaton) -> tuple[float, int, float, int]:
    """Over the clauses of a text: the sum of their weights, how many match, the greatest weight, and the text's words."""
    if not raw:
        return 0.0, 0, 0.0, 0
    raw = raw.replace(_CURLY, b"'")
    spaced = raw.translate(_SPACED)
    n_words = len(spaced.split())
    text = f" {spaced.decode('utf-8', 'replace').lower()} "
    broken, done = "", -1
    total, matched, most = 0.0, 0, 0.0
    for end, _ in trigger.iter(text):
        if end - 1 <= done:
            continue
        broken = broken or f"\n{raw.translate(_BROKEN).decode('utf-8', 'replace').lower()}\n"
        begin, done = broken.rfind("\n", 0, end) + 1, broken.find("\n", end)
        done = len(broken) if done < 0 else done
        weight = grammar.clause(text[begin:done].split())
        if weight > 0:
            total, matched, most = total + weight, matched + 1, max(most, weight)
    return total, matched, most, n_words


def _features(total: float, matched: int, most: float, n_words: int) -> list[float]:
    rate = 100.0 * total / (n_words + 20)
    return [1.0, math.log1p(total), math.log1p(matched), most / 10.0, math.log1p(rate)]


def learn_grammar(sample: DataFrame, label: str) -> Grammar:
    """Words and word beginnings that toxic documents have and others don't, from counts that Spark sums.

    A candidate's toxic documents count at most as often as different words stand before it: copies of a document, and
    passages that documents share, don't count with every copy. What begins no worse than its shorter beginning is left to that.
    """

    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            pairs: set[tuple[str, str]] = set()
            documents: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for toxic, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = (raw or b"").replace(_CURLY, b"'").translate(_SPACED).decode("utf-8", "replace").lower().split()
                found = {}
                for left, word in zip(["", *words], words, strict=False):
                    if word not in found:
                        found[word] = [f"{word} ", *(word[:n] for n in PREFIXES if len(word) > n)]
                        if toxic:
                            pairs.update((feature, left) for feature in found[word])
                for feature in set().union(*found.values()):
                    documents[feature][toxic] += 1
            rows = [(f, left, 0, 0) for f, left in pairs] + [(f, None, n[1], n[0]) for f, n in documents.items()]
            columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            types = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns, types)), names=["feature", "before", "toxic", "clean"])

    each = in_batches(sample.select(label, "raw"), run, "feature string, before string, toxic long, clean long")
    pairs = each.groupBy("feature", "before").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    counts = pairs.groupBy("feature").agg(
        F.least(F.count("before"), F.sum("toxic")).alias("toxic"), F.sum("clean").alias("clean")
    )
    sizes = {r[label]: r["count"] for r in sample.groupBy(label).count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    usable = counts.filter(F.col("toxic") >= LEAST_SUPPORT).withColumn("odds", odds).filter(F.col("odds") >= LEAST_ODDS)
    best = usable.orderBy(F.desc(F.col("odds") * F.col("toxic")), "feature").limit(MOST_PATTERNS).collect()
    weights = {r["feature"]: float(r["odds"]) for r in best}
    kept: dict[str, float] = {}
    for feature in sorted(weights, key=lambda f: (len(f), f)):
        shorter = [feature[:n] for n in PREFIXES if n < len(feature.rstrip())]
        if not any(kept.get(s, 0.0) >= weights[feature] - 0.7 for s in shorter):
            kept[feature] = weights[feature]
    return Grammar(
        {f.rstrip(): w for f, w in kept.items() if f.endswith(" ")}, {f: w for f, w in kept.items() if not f.endswith(" ")}
    )


def logistic(rows: list[list[float]], labels: list[int], ridge: float = 1.0) -> list[float]:
    """Weights of a logistic regression, by Newton's steps."""
    x, y = np.array(rows, float), np.array(labels, float)
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(x.shape[1])
        weights = weights + np.clip(np.linalg.solve(hessian, x.T @ (y - p) - ridge * weights), -4, 4)
    return weights.tolist()


def score(docs: DataFrame, labels: DataFrame, modulus: int = 5, value: int = 0, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, and the number of matched clauses.

    `docs` needs doc_id and text, `labels` doc_id and toxic. Labels are used only of documents whose crc32(doc_id) modulo
    `modulus` isn't `value`, of about 6,000 toxic and 18,000 other ones at most: three quarters for the grammar's words, a quarter to set
    the score's scale. NULL and empty texts match nothing and get the score of such texts; labels that are NULL or not 0 or 1 are
    left out; with labels of one class or none, seed words alone decide. Repeated rows get a row each; a NULL doc_id is held out.
    """
    usable = labels_outside(labels, "toxic", modulus, value)
    sample = materialise(sampled_texts(docs, usable, "toxic", SAMPLE), "toxic-sample")
    part = remainder(F.concat(F.lit("scale"), F.col("doc_id").cast("string")), 4)
    grammar = learn_grammar(sample.filter(part != 0), "toxic")
    held = docs.sparkSession.sparkContext.broadcast(grammar)

    def measured(frame: DataFrame) -> DataFrame:
        def measure(state: tuple, raw: bytes | None) -> tuple:
            return clause_scores(raw, *state)

        return per_row(
            frame,
            measure,
            ["raw"],
            "total double, n_clauses long, most double, n_words long",
            setup=lambda: (held.value, held.value.trigger()),
        ).drop("raw")

    scale = measured(sample.filter(part == 0)).select("toxic", "total", "n_clauses", "most", "n_words").collect()
    if len({r["toxic"] for r in scale}) == 2:
        weights = logistic([_features(*r[1:]) for r in scale], [r["toxic"] for r in scale], 0.1)
    else:
        weights = [-2.0, 1.0, 0.5, 0.5, 0.5]
    texts = docs.select(
        "doc_id", held_out("doc_id", modulus, value).alias("held_out"), F.col("text").cast("binary").alias("raw")
    )
    rate = 100.0 * F.col("total") / (F.col("n_words") + 20)
    terms = (F.lit(1.0), F.log1p("total"), F.log1p("n_clauses"), F.col("most") / 10.0, F.log1p(rate))
    logit = sum((w * t for w, t in zip(weights[1:], terms[1:], strict=True)), F.lit(weights[0]))
    scored = measured(texts).withColumn("score", 1 / (1 + F.exp(-logit)))
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_clauses"
    )
