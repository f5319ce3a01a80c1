"""SimHash components against all pairs, and the covering masks against every small difference."""

from __future__ import annotations

import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from shelfmark.llm import simhash
from shelfmark.llm.components import connected_components
from tests.llm.conftest import documents


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    least = dict.fromkeys(prints)
    owner = {i: i for i in prints}

    def find(x):
        while owner[x] != x:
            x = owner[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            x, y = find(a), find(b)
            owner[max(x, y)] = min(x, y)
    return {i: find(i) for i in least}


def near_texts(seed=5, n=300):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.choice((0, 2, 3, 4, 60, 200)))) for _ in range(n // 3)]
    for _ in range(n - len(texts)):
        base = rng.choice(texts).split()
        if base and rng.random() < 0.7:
            base[rng.randrange(len(base))] = rng.choice(words)
        texts.append(" ".join(base).upper() if rng.random() < 0.2 else "\n".join(base))
    return texts


@pytest.mark.parametrize("bucket", [2, 3, 4096])
def test_components_equal_all_pairs(spark, bucket):
    texts = near_texts()
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    expected = plain_components(prints)
    rows = simhash.components(documents(spark, list(enumerate(texts))), bucket=bucket).collect()
    assert {r.doc_id: r.fingerprint % 2**64 for r in rows} == prints
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert len(set(expected.values())) < len(texts) - 50


def test_masks_cover_every_difference():
    masks = simhash.covering_masks()
    assert len(masks) == 31
    rng = random.Random(1)
    for _ in range(20_000):
        bits = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not mask & bits for mask in masks)
    assert all(28 <= mask.bit_count() <= 36 for mask in masks)


@pytest.mark.parametrize("bucket", [2, 4096])
def test_a_chain_of_close_fingerprints_is_one_component(spark, bucket):
    rng = random.Random(3)
    chain, at = [], 0
    for _ in range(200):
        at ^= sum(1 << b for b in rng.sample(range(63), 4))
        chain.append(at)
    prints = spark.createDataFrame([(p,) for p in sorted(set(chain))], "fingerprint long")
    edges = simhash.near_links(prints, bucket=bucket)
    assert edges.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 4).count() == 0
    roots = {r.root for r in connected_components(edges).collect()}
    assert roots == {min(chain)}


@pytest.mark.parametrize("bucket", [2, 4096])
def test_links_across_the_sign_bit(spark, bucket):
    rng = random.Random(7)
    at, chain = 0, []
    for _ in range(200):
        at ^= sum(1 << b for b in rng.sample(range(64), 4))
        chain.append(at)
    clusters = [chain]
    for _ in range(50):  # a middle, and two prints that differ from it in bit 63 and others
        middle = rng.getrandbits(64)
        clusters.append([middle, *(middle ^ 1 << 63 ^ sum(1 << b for b in rng.sample(range(63), 3)) for _ in range(2))])
    prints = {i: p for i, p in enumerate(p for cluster in clusters for p in cluster)}
    expected = plain_components(prints)
    edges = simhash.near_links(spark.createDataFrame([(simhash._signed(p),) for p in set(prints.values())], "fingerprint long"), bucket=bucket)
    assert edges.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 4).count() == 0
    roots = {r.node % 2**64: r.root for r in connected_components(edges).collect()}
    groups = {}
    for i, p in prints.items():
        groups.setdefault(expected[i], set()).add(roots.get(p, simhash._signed(p)))
    assert all(len(found) == 1 for found in groups.values())
    assert len(groups) == 51


def test_a_bucket_of_three_is_linked_across_the_sign_bit():
    import numpy as np

    prints = np.array([simhash._signed(p) for p in (5, 5 ^ 1 << 63 ^ 1, 5 ^ 1 << 63 ^ 6)], np.int64)
    assert len(simhash._linked(prints, 4)) == 2


def test_one_of_each_keeps_the_least(spark):
    text, other = "a b c d e f g h", "p q r s t u v w x y"
    docs = documents(spark, [(3, text), (2, text), (9, other), (2, text), (None, text), (4, None), (5, "")])
    kept = sorted((r.doc_id, r.text) for r in simhash.one_of_each(docs).collect())
    assert kept == [(2, text), (4, None), (9, other)]
    unique = documents(spark, [(3, text), (2, text), (9, other)])
    assert sorted(r.doc_id for r in simhash.one_of_each(unique).collect()) == [2, 9]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 300)}
