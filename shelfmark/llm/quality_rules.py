"""Quality rules: word and line counts, and the Jensen-Shannon distance of a text's histograms from its language's."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.counting import word_counts
from shelfmark.llm.language import declared_language
from shelfmark.llm.text import lower_words, materialise, per_row, spaced_words

REPEAT_WINDOW = 8
COMMON_WORDS = 50
LEAST_REFERENCE_WORDS = 1000  # texts of languages with fewer words in all aren't measured
LEAST_WORDS = 20

# How far a text may be from its language: a distance for any length and one that shrinks as texts grow, for the noise
# of a small sample. For words the latter is the expected distance of that many draws from the reference itself.
CHAR_DISTANCE, CHAR_NOISE = 0.12, 1.3
WORD_DISTANCE = 0.11

_SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
# Classes of bytes: lower, upper, digit, space, other white space, punctuation, other ASCII, beyond ASCII.
_CLASSES = np.array(
    [
        0 if 97 <= c <= 122
        else 1 if 65 <= c <= 90
        else 2 if 48 <= c <= 57
        else 3 if c == 32
        else 4 if 9 <= c <= 13
        else 5 if chr(c) in ".,;:!?'\"()-"
        else 6 if c < 128
        else 7
        for c in range(256)
    ],
    np.uint8,
)
N_CLASSES = 8
HELD_REFERENCES = 1000  # languages whose words a task keeps
STATISTICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
HISTOGRAMS = "chars array<long>, common array<long>"


def repeated_words(words: list[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur twice or more, the first included. `window` is a power of two."""
    if len(words) <= window:
        return 0
    known: dict[bytes, int] = {}
    ranks = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    size = 1
    while size < window:  # ranks of twice as long windows, exactly: equal rank, equal words
        ranks = ranks[:-size] * (len(words) + 1) + ranks[size:]
        values, ranks, counts = np.unique(ranks, return_inverse=True, return_counts=True)
        if len(values) == len(ranks):
            return 0
        size *= 2
    again = counts[ranks] > 1
    depth = np.zeros(len(words) + 1, np.int64)
    depth[: len(again)] += again
    depth[window : window + len(again)] -= again
    return int(np.count_nonzero(np.cumsum(depth)))


def _statistics(raw: bytes | None, words: list[bytes]) -> tuple[int, int, int, int, int]:
    raw = raw or b""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(b"".join(words).translate(None, _CONTINUATION)),
        sum(map(raw.count, (_SYMBOLS[i : i + 1] for i in range(len(_SYMBOLS))))),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def byte_classes(raw: bytes | None) -> np.ndarray:
    return np.bincount(_CLASSES[np.frombuffer(raw or b"", np.uint8)], minlength=N_CLASSES)


def common_words(texts: DataFrame) -> DataFrame:
    """(language, top) as a written table: the COMMON_WORDS most frequent words of each language, by a count of all texts
    (language, raw); languages of under LEAST_REFERENCE_WORDS words aren't in it."""
    counts = word_counts(texts.filter("language IS NOT NULL"), lower_words)
    sizes = counts.groupBy("key").agg(F.sum("n").alias("words")).filter(F.col("words") >= LEAST_REFERENCE_WORDS)
    order = Window.partitionBy("key").orderBy(F.desc("n"), "word")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= COMMON_WORDS)
    best = best.join(sizes, "key").groupBy(F.col("key").alias("language"))
    words = F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda x: x["word"])
    return materialise(best.agg(words.alias("top")), "common-words")


def distance(a: np.ndarray, b: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; 1 if either is empty."""
    if not a.sum() or not b.sum():
        return 1.0
    p, q = a / a.sum(), b / b.sum()
    middle = (p + q) / 2
    total = 0.0
    for x in (p, q):
        some = x > 0
        total += float(np.sum(x[some] * np.log2(x[some] / middle[some])))
    return math.sqrt(max(0.0, total / 2))


def word_noise(n_words: int) -> float:
    """The expected distance of n draws from the histogram they come from."""
    return math.sqrt(COMMON_WORDS / (8 * math.log(2) * n_words))


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the five statistics, base_failed, char_distance, word_distance, kept.

    `docs` needs doc_id, text and lang. A text fails the base rule with under 20 words, or with over 30 % of its words in
    repeated windows of 8. The others are held against the reference of their language: histograms of character classes
    and of its 50 most frequent words, over all documents that pass the base rule. Languages are read as tags, so that `EN` and
    `en-US` are `en`; their references are a table, joined by language. `kept` asks both distances to be within a bound that
    grows for short texts. Texts under 20 words, of no language or of one with under 1,000 words in all aren't measured: their
    distances are NULL and the base rule decides. NULL is read as the empty text; repeated rows get a row each.
    """
    source = docs.select("doc_id", declared_language(F.col("lang")).alias("language"), F.col("text").cast("binary").alias("_raw"))
    top = common_words(source.select("language", F.col("_raw").alias("raw")))

    def measure(known: dict, language: str | None, top: list[bytes] | None, raw: bytes | None) -> tuple:
        words, hist = spaced_words(raw), []
        if top is not None:
            if language not in known:
                if len(known) > HELD_REFERENCES:
                    known.clear()
                known[language] = {w: i for i, w in enumerate(top)}
            place = known[language]
            found = np.fromiter((place.get(w, COMMON_WORDS) for w in lower_words(raw)), np.int64, len(words))
            hist = np.bincount(found, minlength=COMMON_WORDS + 1).tolist()
        return *_statistics(raw, words), byte_classes(raw).tolist(), hist

    asked = source.join(top, "language", "left")
    measured = per_row(asked, measure, ["language", "top", "_raw"], f"{STATISTICS}, {HISTOGRAMS}", setup=dict)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = materialise(measured.drop("_raw", "top").withColumn("base_failed", failed), "histograms")
    sums = [F.sum(F.get("chars", F.lit(i))) for i in range(N_CLASSES)], [F.sum(F.get("common", F.lit(i))) for i in range(COMMON_WORDS + 1)]
    good = measured.filter("NOT base_failed AND size(common) > 0").groupBy("language")
    references = materialise(good.agg(F.array(*sums[0]).alias("all_chars"), F.array(*sums[1]).alias("all_common")), "references")

    def compare(n: int, chars: list[int], common: list[int], all_chars: list[int] | None, all_common: list[int] | None) -> tuple:
        if n < LEAST_WORDS or not common or all_chars is None:
            return None, None, True
        by_char = distance(np.array(chars, float), np.array(all_chars, float))
        by_word = distance(np.array(common, float), np.array(all_common, float))
        near = by_char <= CHAR_DISTANCE + CHAR_NOISE / math.sqrt(n) and by_word <= WORD_DISTANCE + word_noise(n)
        return by_char, by_word, near

    compared = per_row(
        measured.join(references, "language", "left"),
        compare,
        ["n_words", "chars", "common", "all_chars", "all_common"],
        "char_distance double, word_distance double, kept boolean",
    )
    return compared.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("kept")).alias("kept"),
        "char_distance",
        "word_distance",
    )
