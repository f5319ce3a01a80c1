"""Every operator and every stage on odd rows, on more columns than it knows, and on no rows."""

from __future__ import annotations

import pytest

import corpus_pipeline
from shelfmark.llm import (
    decontaminate,
    hidden_markov,
    html_extract,
    language,
    packing,
    personal_data,
    quality_pu,
    quality_rules,
    simhash,
    toxicity,
)

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 0, 1), (None, 1, 1), (6, None, None), (7, 9, 9), (99, 1, 1)], LABELS)


def items(spark):
    rows = [(1, "the quick brown fox"), (1, "the quick brown fox"), (2, None), (3, ""), (None, "saw a ship"), (4, "word " * 40)]
    return spark.createDataFrame(rows, ITEMS)


PER_ROW = {
    "quality": lambda s, d: quality_pu.score(d, labels(s)),
    "simhash": lambda s, d: simhash.components(d),
    "language": lambda s, d: language.document_languages(d),
    "toxicity": lambda s, d: toxicity.score(d, labels(s)),
    "hidden_markov": lambda s, d: hidden_markov.score(d, rounds=1),
    "decontaminate": lambda s, d: decontaminate.contamination(d, items(s)),
    "personal_data": lambda s, d: personal_data.personal_data(d),
    "quality_rules": lambda s, d: quality_rules.judge(d),
}


@pytest.mark.parametrize("name", sorted(PER_ROW))
def test_a_row_for_each_row(spark, odd, clashing, nothing, name):
    result = PER_ROW[name](spark, odd)
    rows = sorted(map(str, result.collect()))
    assert len(rows) == odd.count()
    assert result.columns[0] == "doc_id"
    assert PER_ROW[name](spark, nothing).count() == 0
    if name in ("simhash", "decontaminate", "quality_rules"):
        assert sorted(map(str, PER_ROW[name](spark, clashing).collect())) == rows
    else:
        assert PER_ROW[name](spark, clashing).count() == len(rows)


def test_scores_are_defined(spark, odd):
    for scored in (PER_ROW["quality"](spark, odd), PER_ROW["toxicity"](spark, odd)):
        assert scored.filter("score IS NULL OR score < 0 OR score > 1 OR predicted NOT IN (0, 1)").count() == 0


def test_no_labels_and_one_class(spark, odd):
    none = labels(spark).filter("false")
    assert {r.score for r in quality_pu.score(odd, none).collect()} == {0.5}
    assert toxicity.score(odd, none).count() == odd.count()
    assert toxicity.score(odd, labels(spark).filter("toxic = 0")).count() == odd.count()


def test_packing_takes_every_row(spark, odd, clashing, nothing):
    for docs in (odd, clashing):
        pieces = packing.pack(docs).collect()
        assert sum(r.start == 0 for r in pieces) == odd.count()
        by_sequence = {}
        for r in pieces:
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert sum(n for p in by_sequence.values() for _, n in p) == sum(r.doc_tokens for r in pieces if r.start == 0)
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_columns(spark, clashing, nothing, tmp_path, name):
    items(spark).write.parquet(str(tmp_path / "benchmark.parquet"))
    stage = dict(corpus_pipeline.STAGES)[name]
    result = stage(spark, clashing, str(tmp_path))
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in clashing.schema]
    rows = result.collect()
    assert 0 < len(rows) <= clashing.count()
    assert {r.score for r in rows} == {"mine"}
    assert stage(spark, nothing, str(tmp_path)).count() == 0


def test_odd_pages(spark):
    pages = spark.createDataFrame(
        [
            (1, None, None),
            (2, "u", ""),
            (3, "u", "<p>" * 3000),
            (4, "u", "<article>" + "<p>some words here, and more.</p>" * 5000 + "</article><nav><a href=x>menu</a></nav>"),
            (4, "u", "no markup at all"),
            (None, "u", "<article><p>a &amp b &#x41;&nbsp; &bogus; <b>c"),
            (5, "u", "<<<>>> < p > </ <!-- <p>x"),
            (6, "u", "<article><p>one</p></article"),
        ],
        "page_id long, url string, html string",
    )
    rows = html_extract.extract(pages).collect()
    assert len(rows) == 8
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_extract.extract(pages.filter("false")).count() == 0
