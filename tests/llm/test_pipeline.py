"""The pipeline against a plain version of each stage's rule, and what its entry does without it."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from shelfmark.llm import queries
from shelfmark.llm.text import materialise
from tests.llm.test_decontaminate import plain_match
from tests.llm.test_personal_data import plain_spans
from tests.llm.test_simhash import plain_components, plain_fingerprint

ROOT = Path(__file__).resolve().parents[2]


def test_stages_follow_their_rules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        after[name] = {r.doc_id: r.text for r in docs.collect()}

    assert after["language_id"] == texts
    parts = plain_components({i: plain_fingerprint(t) for i, t in texts.items()})
    assert after["simhash_dedup"] == {i: t for i, t in texts.items() if parts[i] == i}
    hits = {i: plain_match(t, items) for i, t in after["simhash_dedup"].items()}
    clean = {i for i, (n, hit, _) in hits.items() if not hit or 20 * hit < n}
    assert set(after["benchmark_decontamination"]) == clean
    for i, text in after["benchmark_decontamination"].items():
        assert (text == texts[i]) == (hits[i][1] == 0)
        assert plain_match(text, items)[1] == 0
    for i, text in after["pii_masking"].items():
        before = after["benchmark_decontamination"][i]
        assert (text == before) == (not plain_spans(before))
        assert not plain_spans(text)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.ids))
    expected = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in after["pii_masking"].items()}
    assert {i: [x for _, ids in sorted(p) for x in ids] for i, p in pieces.items()} == expected
    assert np.sum([len(x) for x in expected.values()]) > 10_000


def test_each_operator_has_one_query():
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in queries.QUERIES) == 1


def test_the_rest_works_without_this_subpackage(tmp_path):
    shutil.copytree(ROOT / "shelfmark", tmp_path / "shelfmark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "bench.py"):
        shutil.copy(ROOT / name, tmp_path / name)
    check = "import bench, __spark_entry__ as e; q = e.queries(); assert len(q) == 69 and set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", check], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
