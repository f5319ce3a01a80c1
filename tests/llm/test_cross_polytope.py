"""Cells, recall against brute force, exact scores, and copies."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import cross_polytope
from shelfmark.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>"


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)], ROWS)


def nearest(ids, vectors, every=50, best=5):
    """{query: [(score, vec_id)]} by comparing each query with every row."""
    rows = np.asarray(vectors, np.float32).astype(float)
    lengths = np.sqrt((rows * rows).sum(axis=1))
    out = {}
    for i, query in enumerate(ids):
        if query % every == 0:
            scores = rows @ rows[i] / (lengths * lengths[i])
            out[query] = sorted((-round(s, 12), v) for s, v in zip(scores.tolist(), ids, strict=True) if v != query)[:best]
    return out


def got(result):
    found = {}
    for r in sorted(result.collect()):
        found.setdefault(r.query_id, []).append((-round(r.score, 12), r.vec_id))
        assert r.rank == len(found[r.query_id])
    return found


def recall(found, true):
    return sum(len({v for _, v in true[q]} & {v for _, v in found.get(q, [])}) for q in true) / sum(map(len, true.values()))


def drawn(seed, n, width=24):
    return np.random.default_rng(seed).normal(size=(n, width)).astype(np.float32)


def test_rotations_keep_lengths_and_angles():
    rows = drawn(1, 20, 32)
    turned = cross_polytope.rotated(rows.astype(float), 0, 1)
    assert np.allclose(turned @ turned.T, rows @ rows.T, atol=1e-4)


@pytest.mark.parametrize("rows", [1, 500, 50_000, 10**7, 10**12])
def test_a_cell_is_where_coordinates_sum_to_most(rows):
    cells = cross_polytope.Cells(24, rows)
    units = cross_polytope._units(drawn(2, 30).astype(float))
    along = cells.coordinates(units, 1)
    own = cells.of(units, 1)
    assert own.max() < np.prod(cells.axes, dtype=float)
    gaps = cells.gaps(along, own)
    assert np.allclose(np.diag(gaps), 0)
    assert (gaps >= -1e-12).all()
    row, shard = cells.shards_within(along, 0.5)
    reached = set(zip(row.tolist(), shard.tolist(), strict=True))
    assert {(i, int(cells.shard(own[j : j + 1])[0])) for i, j in zip(*np.nonzero(gaps <= 0.5), strict=True)} <= reached


def test_recall_and_exact_scores(spark):
    vectors = drawn(3, 2000)
    vectors[1000:1040] = vectors[0] + 0.01 * vectors[1000:1040]  # a group of near copies
    true = nearest(range(2000), vectors)
    found = got(cross_polytope.neighbours(frame(spark, vectors)))
    assert recall(found, true) >= 0.9
    assert [len(v) for v in found.values()] == [5] * 40
    exact = nearest(range(2000), vectors, best=1999)
    for query, listed in found.items():
        assert set(listed) <= set(exact[query])
        assert listed == sorted(listed)


def test_small_parts_change_nothing(spark):
    vectors = drawn(4, 600)
    want = got(cross_polytope.neighbours(frame(spark, vectors), every=10))
    assert got(cross_polytope.neighbours(frame(spark, vectors), every=10, shard_rows=12)) == want


def test_probing_everything_is_brute_force(spark):
    vectors = drawn(5, 400, 5)
    vectors[200:] = np.round(vectors[200:])  # ties, equal directions, and zeros
    vectors[300] = 0
    kept = [i for i in range(400) if vectors[i].any()]
    true = nearest(kept, vectors[kept], every=20)
    assert got(cross_polytope.neighbours(frame(spark, vectors), every=20, recall=1.0, sample=400)).keys() == true.keys()
    found = got(cross_polytope.neighbours(frame(spark, vectors), every=20, recall=1.0, sample=400))
    for query in true:
        assert [s for s, _ in found[query]] == pytest.approx([s for s, _ in true[query]], abs=1e-9)


def test_copies_are_results(spark):
    """A vector that most rows share: each query lists the smallest other ids of the copies."""
    vectors = drawn(6, 300)
    vectors[50:250] = vectors[50]
    found = got(cross_polytope.neighbours(frame(spark, vectors)))
    for query in (50, 100, 200):
        assert [v for _, v in found[query]] == [v for v in range(50, 60) if v != query][:5]
        assert [s for s, _ in found[query]] == [-1.0] * 5


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]),
        (0, [1.0, 0.0, 0.0]),
        (1, [1.0, 1.0, 0.0]),
        (2, None),
        (3, []),
        (4, [0.0, 0.0, 0.0]),
        (5, [1.0, nan, 0.0]),
        (6, [1.0, inf, 0.0]),
        (7, [1.0, None, 0.0]),
        (None, [1.0, 0.0, 0.0]),
        (8, [1.0, 0.0]),  # of another length
        (50, [2.0, 0.0, 0.0]),
        (-50, [-1.0, 0.0, 0.0]),
        (9, [1e30, 1e30, 1e-30]),
        (100, [0.0, 0.0, 0.0]),
    ]
    odd = spark.createDataFrame(rows, ROWS)
    found = got(cross_polytope.neighbours(odd))
    assert set(found) == {0, 50, -50}
    assert {v for _, v in found[0]} <= {1, 50, -50, 9}
    assert found[0][0] == (-1.0, 50)
    more = odd.withColumns({n: F.lit("mine") for n in ("node", "digest", "size", "v", "table", "score", "rank", "cell")})
    assert got(cross_polytope.neighbours(more)) == found
    assert cross_polytope.neighbours(odd.filter("false")).collect() == []
    assert cross_polytope.neighbours(odd.filter("vec_id = 1")).collect() == []
    doubles = odd.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    huge = doubles.unionByName(spark.createDataFrame([(10, [1e200, 1e200, 0.0]), (11, [1e-200, 0.0, 0.0])], "vec_id long, embedding array<double>"))
    assert {v for _, v in got(cross_polytope.neighbours(huge))[50]} >= {0, 11}


def test_query(spark, sf_dir):
    rows = sorted(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect())
    true = nearest([r.vec_id for r in rows], [r.embedding for r in rows])
    assert recall(got(QUERIES["op13_neighbours"](spark, sf_dir)), true) >= 0.9
