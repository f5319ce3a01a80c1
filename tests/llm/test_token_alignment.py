"""Groups, links and counts against token loops, and the shared and the joined way to a pair's count."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import pytest

from shelfmark.llm import token_alignment
from shelfmark.llm.queries import QUERIES
from tests.llm.conftest import documents, odd_rows

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(words, ids):
    at, out = 0, []
    for i in ids:
        size = len(words.tokens[i].as_py())
        out.append((at, at + size, i))
        at += size
    return out


def plain(rows):
    """The contract's columns by comparing every token of one side with every token of the other near it."""
    left, right = (token_alignment.vocabulary(n) for n in (token_alignment.LEFT, token_alignment.RIGHT))
    found = []
    for doc_id, text, *_ in rows:
        a = spans(left, left.encode([text])[0]) if text else []
        b = spans(right, right.encode([text])[0]) if text else []
        whole = b" " + (text or "").encode()
        if any(b"".join(words.tokens[i].as_py() for _, _, i in side) != whole for words, side in ((left, a), (right, b))):
            a = b = []
        links, start = [], 0
        for begin, end, i in a:
            while start < len(b) and b[start][1] <= begin:
                start += 1
            at = start
            while at < len(b) and b[at][0] < end:
                links.append((i, b[at][2]))
                at += 1
        cuts = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        sides = []
        for side in (a, b):
            grouped = defaultdict(list)
            for _, end, i in side:
                grouped[bisect_left(cuts, end)].append(str(i))
            sides.append([",".join(grouped[g]) for g in range(len(cuts))])
        groups = ["|".join(pair) for pair in zip(*sides, strict=True)]
        found.append((doc_id, a, b, groups, links))
    counts = Counter(pair for *_, links in found for pair in set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    return [
        (
            doc_id,
            len(a),
            len(b),
            len(groups),
            len(links),
            sum(counts[p] == most[p[0]] for p in links),
            sum(counts[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, a, b, groups, links in found
    ]


def ordered(rows):
    return sorted(rows, key=str)


def got(frame):
    assert frame.columns[:8] == COLUMNS
    return ordered(tuple(r)[:8] for r in frame.collect())


def texts(seed, n):
    draw = random.Random(seed)
    parts = ["Hello", "world", "naïve", "日本", "\U0001f600", "  ", "\n", "\t", "don't", "<s>", "<|endoftext|>", "1234", "x" * 40, "▁", "\x00"]
    return [" ".join(draw.choices(parts, [9] * 13 + [1, 1], k=draw.randint(0, 30))) for _ in range(n)]


def test_ids_by_rank_are_those_by_merges():
    left = token_alignment.vocabulary(token_alignment.LEFT)
    assert left.ranked is not None
    draw = random.Random(5)
    ranges = [(1, 0x24FF), (1, 127), (0x2500, 0xD7FF), (0xE000, 0x1FFFF), (32, 32), (10, 13), (39, 39)]
    some = ["".join(chr(draw.randint(*draw.choice(ranges))) for _ in range(20)) for _ in range(3000)]
    some += [*texts(6, 200), "x" * 50_000, "word " * 20_000, " " * 30_000, "1" * 20_000, *(str(t) for _, t, *_ in odd_rows())]
    assert left.encode(some) == left.by_merges(some)


@pytest.mark.parametrize("most_shared", [token_alignment.MOST_SHARED, 40, 0])
def test_the_columns_of_token_loops(spark, most_shared):
    """All counts shared, the frequent ones, none."""
    rows = [(i, t) for i, t in enumerate(texts(1, 150))] + [(500 + i, "the same text again") for i in range(20)]
    frame = token_alignment.align(documents(spark, rows).repartition(3), most_shared=most_shared)
    assert got(frame) == ordered(plain(rows))


def test_partial_counts_that_are_handed_on_early(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts(2, 60))]
    links = token_alignment.linked(documents(spark, rows).coalesce(1))
    want = sorted(map(tuple, token_alignment.pair_counts(links).collect()))
    monkeypatch.setattr(token_alignment, "HELD_PAIRS", 10)
    assert sorted(map(tuple, token_alignment.pair_counts(links).collect())) == want


def test_groups_cover_the_text(spark):
    row = token_alignment.align(documents(spark, [(1, "An example, naïvely tokenised: 日本語 <s>")]), with_groups=True).first()
    left, right = (token_alignment.vocabulary(n) for n in (token_alignment.LEFT, token_alignment.RIGHT))
    for group in row.groups.split(";"):
        a, b = (side.split(",") for side in group.split("|"))
        assert b"".join(left.tokens[int(i)].as_py() for i in a) == b"".join(right.tokens[int(i)].as_py() for i in b)
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256


def test_odd_rows(spark, odd, clashing, nothing):
    want = ordered(plain(odd_rows()))
    assert got(token_alignment.align(odd)) == want
    assert got(token_alignment.align(clashing)) == want
    assert token_alignment.align(nothing).collect() == []
    zeros = [r for r in want if r[0] in (1, 2)]
    assert zeros == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert got(QUERIES["op12_token_alignment"](spark, sf_dir)) == ordered(plain([(r.doc_id, r.text) for r in docs]))
