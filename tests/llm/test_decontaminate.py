"""Benchmark matches against brute force and SQL, in one block and in many."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, queries
from tests.comparing import differences, duckdb_over
from tests.llm.conftest import documents


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_match(text, items):
    words, hit, found = plain_words(text), set(), set()
    for item, content in items:
        parts = plain_words(content)
        size = min(13, len(parts))
        for window in {tuple(parts[i : i + size]) for i in range(len(parts) - size + 1)} if parts else ():
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) == window:
                    hit.update(range(i, i + size))
                    found.add(item)
    return len(words), len(hit), sorted(found)


def material(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["é", "ß9"]
    items = [(str(i), " ".join(rng.choices(vocabulary, k=rng.choice((0, 1, 3, 12, 13, 14, 30, 60))))) for i in range(40)]
    texts = []
    for _ in range(120):
        parts = rng.choices(vocabulary, k=rng.randrange(0, 40))
        for _ in range(rng.randrange(3)):
            source = rng.choice(items)[1].split()
            a = rng.randrange(len(source) + 1)
            parts[rng.randrange(len(parts) + 1) : 0] = source[a : a + rng.randrange(1, 40)]
        texts.append(rng.choice((" ", ", ", "\n-")).join(parts).replace("w1", "W1"))
    return items, texts


@pytest.mark.parametrize("block_words", [200_000, 60, 13])
def test_matches_equal_brute_force(spark, block_words):
    items, texts = material()
    benchmark = spark.createDataFrame([(int(i), t) for i, t in items], "item_id long, text string")
    rows = decontaminate.match_items(documents(spark, list(enumerate(texts))), benchmark, block_words=block_words).collect()
    got = {r.doc_id: (r.n_words, sum(s.end - s.start for s in r.spans), list(r["items"])) for r in rows}
    assert got == {i: plain_match(t, items) for i, t in enumerate(texts)}
    assert sum(bool(v[2]) for v in got.values()) > 30
    if block_words == decontaminate.BLOCK_WORDS:
        assert {r.doc_id: r.longest for r in rows} == {i: plain_longest(t, items) for i, t in enumerate(texts)}


def plain_longest(text, items):
    words, most = plain_words(text), 0
    for _, content in items:
        parts = plain_words(content)
        for i in range(len(words)):
            for j in range(len(parts)):
                size = 0
                while i + size < len(words) and j + size < len(parts) and words[i + size] == parts[j + size]:
                    size += 1
                if size >= min(13, len(parts)):
                    most = max(most, size)
    return most


def test_blocks_read_only_documents_that_share_a_window(spark):
    items, texts = material(5)
    texts += [f"only{i} " * 30 for i in range(50)] + [None, ""]
    benchmark = spark.createDataFrame([(int(i), t) for i, t in items], "item_id long, text string")
    docs = documents(spark, [*enumerate(texts), (None, texts[0]), (None, texts[0]), (0, texts[0])])
    source = docs.withColumn("_raw", docs.text.cast("binary"))
    pieces = decontaminate._pieces(benchmark, 13, 60).withColumn("block", F.pmod(F.xxhash64("item", "start"), F.lit(9)))
    found = {(r.doc_id, r.block) for r in decontaminate._candidates(source, pieces, 13).collect()}
    blocks = {}
    for r in pieces.collect():
        blocks.setdefault(r.block, []).append((r["item"], bytes(r["words"]).decode()))
    wanted = {(i, b) for i, t in enumerate(texts) for b, some in blocks.items() if plain_match(t, some)[1]}
    assert found == wanted | {(None, b) for i, b in wanted if i == 0}
    columns = ["doc_id", "n_words", "spans", "items"]
    once = decontaminate.match_items(docs, benchmark).select(columns).collect()
    several = decontaminate.match_items(docs, benchmark, block_words=60).select(columns).collect()
    assert sorted(map(str, once)) == sorted(map(str, several))


@pytest.mark.parametrize("block_words", [200_000, 13])
def test_odd_rows_in_one_block_and_in_many(spark, clashing, nothing, block_words):
    item = " ".join(f"q{i}" for i in range(40))
    benchmark = spark.createDataFrame([(1, item), (None, "lazy dog went"), (3, None), (4, "")], "item_id long, text string")
    rows = decontaminate.match_items(clashing, benchmark, block_words=block_words).collect()
    assert len(rows) == clashing.count()
    assert {(r.doc_id, tuple(r["items"])) for r in rows if r["items"]} == {(4, ("",)), (5, ("",)), (None, ("",))}
    assert {r.score for r in rows} == {"mine"}
    assert decontaminate.match_items(nothing, benchmark, block_words=block_words).count() == 0
    strange = spark.createDataFrame([(1, "zq " * 50)], "item_id long, text string")
    assert not any(r["items"] for r in decontaminate.match_items(clashing, strange, block_words=block_words).collect())


def test_query_equals_sql(spark, sf_dir):
    result = queries.QUERIES["op7_decontamination"](spark, sf_dir)
    assert differences(result, duckdb_over(sf_dir), queries.ORACLE["op7_decontamination"]) == []


def test_decontaminate_drops_and_cuts(spark):
    item = " ".join(f"q{i}" for i in range(13))
    filler = " ".join(f"f{i}" for i in range(400))
    docs = documents(spark, [(1, f"{filler}. {item}! {filler}"), (2, f"a {item} b"), (3, filler), (4, None)])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert set(rows) == {1, 3, 4}
    assert rows[1].text == f"{filler}. ! {filler}"
    assert rows[1].n_chars == len(rows[1].text)
    assert rows[3].text == filler and rows[4].text is None


def test_one_python_pass_finds_and_cuts(spark):
    """Each Python pass of a stage keeps a worker of its own for each core, and with it its memory."""
    item = " ".join(f"w{i}" for i in range(13))
    docs = documents(spark, [(1, item + " end"), (2, "x " * 300 + item.upper() + ", y"), (3, None), (2, "x " * 300 + item + " z\u00e9")])
    benchmark = spark.createDataFrame([("a", item)], "item_id string, text string")
    found = decontaminate.decontaminate(docs, benchmark)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.doc_id, r.text or "") for r in found.collect()) == [(2, "x " * 300 + " z\u00e9"), (2, "x " * 300 + ", y"), (3, "")]


@pytest.mark.parametrize("block_words", [200_000, 13])
def test_cut_texts_are_the_same_in_one_block_and_in_many(spark, block_words):
    items = [" ".join(f"{c}{i}" for i in range(20)) for c in "ab"]
    text = f"one {items[0]} two, {items[1]}! three"
    docs = documents(spark, [(1, text), (1, text), (2, "one two"), (None, items[0]), (3, None)])
    benchmark = spark.createDataFrame([(str(i), t) for i, t in enumerate(items)], "item_id string, text string")
    rows = decontaminate._matched(docs, benchmark, block_words=block_words, cut=True).collect()
    got = sorted((str(r.doc_id), str(r._cut), r.n_words, r.items) for r in rows)
    assert got == [
        ("1", "one  two, ! three", 43, ["0", "1"]),
        ("1", "one  two, ! three", 43, ["0", "1"]),
        ("2", "None", 2, []),
        ("3", "None", 0, []),
        ("None", "", 20, ["0"]),
    ]
