"""Signatures never bound a score too low, and the ranking is that of a plain scan."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm import lexical_search
from shelfmark.llm.queries import ORACLE, QUERIES
from shelfmark.llm.text import folded_words
from tests.comparing import differences, duckdb_over
from tests.llm.conftest import documents

ITEMS = "item_id long, text string"


def plain(rows, items, best=10):
    """(item, rank, doc, score) by scoring every document for every item."""
    docs = [(d, Counter(folded_words(t.encode() if t else None))) for d, t, *_ in rows]
    docs = [(d, c) for d, c in docs if c]
    n, total = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in {(i, t) for i, t in items if t}:
        found = []
        for doc, counts in docs:
            norm = 10 + 90 * sum(counts.values()) * n // total
            score = 0
            for term in set(folded_words(text.encode())):
                if tf := counts[term]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += weight * (10**9 * tf // (1000 * tf + 8 * norm))
            if score > 0 and doc is not None:
                found.append((-score, doc))
        out += [(item, rank, doc, -score) for rank, (score, doc) in enumerate(sorted(found)[:best], 1)]
    return sorted(out)


def got(frame):
    return sorted((r.item_id, r.rank, r.doc_id, r.score) for r in frame.collect())


def sentences(seed, n, longest=60):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Été", "naïve", "ÀB", "x-1"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [" ".join(draw.choices(words, weights, k=draw.randint(0, longest))) for _ in range(n)]


def test_the_ranking_of_a_plain_scan(spark):
    rows = [(i, t) for i, t in enumerate(sentences(1, 400))]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(2000, " ".join(sentences(2, 300)))]  # a long one
    items = [(i, t) for i, t in enumerate(sentences(3, 25, 20))] + [(90, rows[7][1]), (91, "none of these"), (92, "w1")]
    made = lexical_search.search(documents(spark, rows), spark.createDataFrame(items, ITEMS))
    assert got(made) == plain(rows, items)


def test_blocks_of_items_and_terms(spark):
    rows = [(i, t) for i, t in enumerate(sentences(4, 120))]
    items = [(i, t) for i, t in enumerate(sentences(5, 12, 20))]
    frames = documents(spark, rows), spark.createDataFrame(items, ITEMS)
    assert got(lexical_search.search(*frames, best=3, block_terms=40, pilot=1)) == plain(rows, items, best=3)


@pytest.mark.parametrize("most", [64, 1 << 20])
def test_no_bound_is_below_its_score(monkeypatch, most):
    """Also where signatures are fuller than they should be."""
    monkeypatch.setattr(lexical_search, "MOST_BITS", most)
    texts = [Counter(t.encode().split()) for t in sentences(6, 40, 200)]
    texts = [c for c in texts if c]
    block, bits = [], 64
    for counts in texts:
        hashes = np.array([lexical_search._Hashes()[t] for t in counts], np.uint64)
        times = np.array(list(counts.values()))
        entries = [hashes[times >= least] for least in lexical_search.LEVELS if least <= times.max()]
        block.append(lexical_search._Signed(0, int(times.sum()), entries))
        bits = max(bits, lexical_search._signature_bits(sum(map(len, entries))))
    items = [(i, [(w.encode(), 7 + i) for w in sorted(set(t.split()))]) for i, t in enumerate(sentences(7, 20, 30)) if t]
    queries = lexical_search.Queries(items, len(texts), sum(d.length for d in block))
    lengths = np.array([d.length for d in block])
    parts = list(queries.bounds(lengths, bits, lexical_search._slices(block, bits)))
    bounds = np.concatenate([b for _, b in parts])
    exact = np.array([[queries.score(i, c, queries.norm(sum(c.values()))) for c in texts] for i in range(len(items))])
    assert bounds.shape == exact.shape
    assert (bounds >= exact).all()
    if most > 64:
        assert exact.sum() > 0.8 * bounds.sum()


def test_odd_rows(spark, odd, clashing, nothing):
    from tests.llm.conftest import odd_rows

    asked = [(1, "the quick brown fox"), (1, "the quick brown fox"), (2, None), (3, ""), (4, "word 1"), (5, "日本語のテキスト"), (None, "é")]
    items = spark.createDataFrame(asked, ITEMS)
    rows = got(lexical_search.search(odd, items.filter("item_id IS NOT NULL")))
    assert rows == plain(odd_rows(), [a for a in asked if a[0] is not None])
    assert [r[2] for r in rows if r[0] == 1] == [4, 4, 5]  # repeated rows are ranked each, rows without an id are not
    assert len(lexical_search.search(clashing, items).collect()) == len(rows) + 1
    assert lexical_search.search(nothing, items).collect() == []
    assert lexical_search.search(odd, items.filter("false")).collect() == []


def test_query_and_sql(spark, sf_dir):
    name = "op11_lexical_search"
    assert differences(QUERIES[name](spark, sf_dir), duckdb_over(sf_dir), ORACLE[name]) == []
