"""Language, toxicity and quality: what was learned, on documents that were held out; and the grammar's own rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import language, quality_pu, queries, toxicity
from tests.llm.conftest import PROSE, documents

SF = "/root/testdata/sf0.01"


def test_languages_are_found_from_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.document_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.text_language == r.lang for r in rows) >= 0.99 * len(rows)
    assert sum(r.kept for r in rows) >= 0.99 * len(rows)


def test_other_evidence_decides_where_the_text_does_not(spark):
    english, german = PROSE * 3, "der schnelle braune fuchs und der faule hund gingen in die stadt und sahen das schiff " * 3
    rows = [(i, english if i % 2 else german, "en" if i % 2 else "de", "a.uk" if i % 2 else "b.de") for i in range(60)]
    rows += [(100, "ok", None, "b.de"), (101, "ok", None, "a.uk"), (102, "ok", "de", None), (103, english, "de", "b.de"), (104, "123", "en", "a.uk")]
    found = {r.doc_id: r for r in language.document_languages(documents(spark, rows)).collect()}
    assert [found[i].language for i in (100, 101, 102, 103)] == ["de", "en", "de", "en"]
    assert (found[104].language, found[104].kept) == ("und", False)


def test_every_declared_language_has_a_model(spark):
    import random

    rng, rows, codes = random.Random(4), [], [a + b for a in "bcdfghjklm" for b in "pqrstvwxz"]
    for code in codes:  # 90 languages of words of their own; the last ten have two documents each
        words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 8))) for _ in range(30)]
        for _ in range(12 if code in codes[:-10] else 2):
            rows.append((len(rows), " ".join(rng.choices(words, k=40)), code, "a"))
    rows.append((len(rows), "mvunde katoli", "zz", "a"))
    found = language.document_languages(documents(spark, rows)).join(documents(spark, rows).select("doc_id", "lang"), "doc_id").collect()
    assert all(r.language == r.lang and r.kept for r in found)


def retagged(spark, tags):
    """The documents of sf0.01, their English ones declared as some tags in turn."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    turn = F.element_at(F.array(*map(F.lit, tags)), (F.pmod(F.xxhash64("doc_id"), F.lit(len(tags))) + 1).cast("int"))
    return docs, docs.withColumn("lang", F.when(F.col("lang") == "en", turn).otherwise(F.col("lang")))


@pytest.mark.parametrize("tags", [["en", "eng", "English", "EN-us"], ["en", "xen", "qen"]])
def test_tags_of_one_language_share_its_chances(spark, tags):
    docs, split = retagged(spark, tags)
    before = {r.doc_id: r for r in language.document_languages(docs).collect()}
    after = {r.doc_id: r for r in language.document_languages(split).collect()}
    assert sum(r.kept for r in after.values()) >= 0.99 * len(after)
    assert sum(r.kept == before[i].kept for i, r in after.items()) >= 0.995 * len(after)
    assert len({after[i].language for i, r in before.items() if r.language == "en" and r.kept}) == 1
    assert language.in_known_language(split).count() == sum(r.kept for r in after.values())


def test_junk_tags_change_nothing(spark, monkeypatch):
    """A tag for nearly every English document, read in several blocks: only those of odd texts are languages of their own."""
    monkeypatch.setattr(language, "BLOCK_ENTRIES", 60_000)
    letters = "abcdefghijklmnopqrstuvwxyz"
    docs, junk = retagged(spark, ["en", *("q" + a + b for a in letters for b in letters)])
    texts = junk.select(language.declared_language(F.col("lang")).alias("declared"), F.col("text").cast("binary").alias("_raw"))
    model, _ = language.train(texts)
    assert len(model.languages) <= 30
    before = {r.doc_id: r.kept for r in language.document_languages(docs).collect()}
    after = {r.doc_id: r.kept for r in language.document_languages(junk).collect()}
    assert sum(after[i] == kept for i, kept in before.items()) >= 0.99 * len(before)


def test_odd_pages_have_a_language(spark):
    english = "<HTML LANG='en'><Script>var das und der = die nicht ein</SCRIPT><p>" + PROSE
    rows = [(i, f"http://h{i % 3}.org/", english) for i in range(12)]
    rows += [(20, None, None), (21, "", ""), (22, "no address", "<p>1 2 3"), (23, "http://a.org", "&#116;h&eacute; quick brown fox and the lazy dog")]
    rows += [(24, "http://a.org", "<script>the quick brown fox"), (None, None, english), (1, "http://h1.org/", english), (25, "u", "word " * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("mine") for c in ("declared", "_text", "host", "language")})
    found = language.page_languages(pages).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert all(by_id[i].language == "en" and by_id[i].kept for i in (*range(12), None, 23))
    assert {(by_id[i].language, by_id[i].kept) for i in (20, 21, 22, 24)} == {("und", False)}
    assert language.page_languages(pages.filter("false")).count() == 0


def test_hosts_share_what_their_domain_has(spark):
    parts = spark.createDataFrame([("A.Example.ORG",), ("src0",), ("",), (None,)], "h string")
    rows = parts.select(*[c.alias(n) for n, c in language.address_parts(parts["h"]).items()]).collect()
    assert [tuple(r) for r in rows] == [
        ("a.example.org", "example.org", "org"), ("src0", None, None), (None, None, None), (None, None, None)
    ]


def test_pages_declare_their_language(spark):
    rows = queries.QUERIES["page_languages"](spark, SF).collect()
    assert sum(r.language == r.declared for r in rows) > 0.95 * len(rows)


def clause(text):
    return toxicity.Grammar({}, {}).clause(text.split())


def test_clauses_weigh_their_matches():
    plain = clause("what an idiot")
    assert clause("you are an idiot") > plain > clause("they wrote what an idiot") > 0
    assert clause("he is not an idiot") < clause("he is an idiot")
    assert clause("burn the wood") < clause("you will burn")
    assert clause("a quiet day") == 0


def test_targets_after_a_hit_count():
    assert clause("i will kill you") > clause("kill the process")
    assert clause("i will kill you") == clause("you will burn")
    assert clause("idiot you") == clause("you idiot") > clause("idiot")
    assert clause("i will not kill you") < clause("i will kill you")
    assert clause("kill a b c d e f you") == clause("kill the process")


def test_typographic_apostrophes_are_apostrophes():
    grammar = toxicity.Grammar({}, {})
    for plain in ("he isn't an idiot.", "you're an idiot", "they don't say: I will kill you"):
        curly = plain.replace("'", "\u2019")
        both = [toxicity.clause_scores(x.encode(), grammar, grammar.trigger()) for x in (plain, curly)]
        assert both[0] == both[1] and both[0][0] > 0


def test_composition_equals_the_cascade():
    import itertools

    for word in itertools.product(sorted(toxicity.ALPHABET), repeat=4):
        state, expected = [0, 0, 0], []
        machines = (toxicity._NEGATION, toxicity._REPORTED, toxicity._TARGETED)
        for symbol in word:
            for i, machine in enumerate(machines):
                state[i], symbol = machine.read(state[i], symbol)
            expected.append(symbol)
        at, got = toxicity.CLAUSE.start, []
        for symbol in word:
            at, out = toxicity.CLAUSE.read(at, symbol)
            got.append(out)
        assert got == expected


def held_out_accuracy(scored, labels, label):
    rows = scored.filter("held_out").join(labels.select("doc_id", label), "doc_id").collect()
    assert len(rows) > 50
    return sum(r.predicted == r[label] for r in rows) / len(rows), rows


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    accuracy, rows = held_out_accuracy(toxicity.score(docs, labels), labels, "toxic")
    assert accuracy >= 0.93
    clean = [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_pu.score(docs, labels)
    accuracy, _ = held_out_accuracy(scored, labels, "quality")
    assert accuracy >= 0.97
    prior = scored.first().class_prior
    assert prior == pytest.approx(labels.agg({"quality": "avg"}).first()[0], abs=0.05)


def test_quality_does_not_use_negative_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    some = docs.filter("doc_id < 300")
    one = {r.doc_id: r.score for r in quality_pu.score(some, labels).collect()}
    two = {r.doc_id: r.score for r in quality_pu.score(some, labels.filter("quality = 1")).collect()}
    assert one == pytest.approx(two)
