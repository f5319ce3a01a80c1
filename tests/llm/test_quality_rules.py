"""Rule statistics against brute force, and the distances' verdicts."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import quality_rules
from tests.llm.conftest import documents


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {p for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for p in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), again, len(repeated), failed


def test_statistics_equal_brute_force(spark):
    rng = random.Random(8)
    bits = ["a", "b", "é\U0001f600", "#x", "\x0b", "\n", "\n \n", "\r\n", "a a a a", "<b>|", " ", " ", "long" * 5]
    texts = [" ".join(rng.choices(bits, k=rng.randrange(0, 80))) for _ in range(300)] + [None, "", "\n\n"]
    rows = quality_rules.judge(documents(spark, list(enumerate(texts)))).collect()
    got = {
        r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows
    }
    assert got == {i: plain_statistics(t) for i, t in enumerate(texts)}
    assert not any(r.kept and r.base_failed for r in rows)


def test_distance_is_a_bounded_symmetric_measure():
    a, b = np.array([1.0, 2, 0]), np.array([0.0, 1, 4])
    assert quality_rules.distance(a, a) == pytest.approx(0)
    assert quality_rules.distance(a, b) == pytest.approx(quality_rules.distance(b, a))
    assert quality_rules.distance(np.array([1.0, 0]), np.array([0.0, 1])) == pytest.approx(1)
    assert quality_rules.distance(a, np.zeros(3)) == 1


def test_prose_is_kept_and_junk_is_not(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = quality_rules.judge(docs).join(labels, "doc_id").filter("NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    assert sum(good) >= 0.97 * len(good) > 50
    assert not any(r.kept for r in rows if r.quality == 0 and r.n_words > 100)


def test_the_language_column_may_be_missing_its_values(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id", "text", "cast(null as string) lang")
    rows = quality_rules.judge(docs).collect()
    assert all(r.kept != r.base_failed for r in rows)  # no reference, so the base rule alone decides


def test_small_languages_are_not_held_against_others(spark, sf_dir):
    """Twelve documents of a language of its own are kept; sixty have a reference; case and region of a tag say nothing."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 8))) for _ in range(80)]

    def text():
        return " ".join(rng.choices(words, [1 / (i + 1) for i in range(80)], k=60)) + "."

    supplied = [(r.doc_id, r.text, r.lang, "a") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    few = [(10_000 + i, text(), "qu", "a") for i in range(12)]
    many = [(20_000 + i, text(), ["ay", "AY", "ay-BO"][i % 3], "a") for i in range(60)]
    rows = {r.doc_id: r for r in quality_rules.judge(documents(spark, supplied + few + many)).collect()}
    assert all(rows[r[0]].kept and rows[r[0]].word_distance is None for r in few)
    assert sum(rows[r[0]].kept for r in many) >= 58
    assert all(rows[r[0]].word_distance is not None for r in many)
