"""Approximate nearest neighbours: pseudo-rotations assign vectors to signed axes, probed cells are compared exactly."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.text import Batches, in_batches, materialise, ship_package, sliced

EVERY = 50  # rows whose id it divides are queries
BEST = 5
TABLES = 2
CELL_ROWS = 64  # rows a cell should have
SHARD_ROWS = 8192  # rows that are compared at once
SAMPLE = 256  # queries whose true neighbours decide how far to probe
RECALL = 0.96  # of them that the probes must find
SLACK = 4  # more candidates kept than asked for, until scores are exact
ROUNDS = 3


@cache
def _signs(width: int, table: int, turn: int) -> np.ndarray:
    return np.random.default_rng([width, table, turn]).choice([-1.0, 1.0], (ROUNDS, width))


def _hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of every row, which keeps lengths."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return rows / np.sqrt(width)


def rotated(units: np.ndarray, table: int, turn: int) -> np.ndarray:
    """Rows after a pseudo-rotation (signs flipped by chance, then Hadamard, in ROUNDS); the width is a power of two."""
    for signs in _signs(units.shape[1], table, turn):
        units = _hadamard(units * signs)
    return units


class Cells:
    """The cells of vectors of one width: a signed axis after each of several pseudo-rotations, the last of only a few axes."""

    def __init__(self, dimension: int, rows: int, shard_rows: int = SHARD_ROWS) -> None:
        self.width = 1 << max(0, dimension - 1).bit_length()
        wanted = max(1, rows // CELL_ROWS)
        self.axes: list[int] = []  # signed axes of each turn
        while not self.axes or (np.prod(self.axes, dtype=float) < wanted and len(self.axes) < 6):
            left = wanted / np.prod(self.axes, dtype=float) if self.axes else wanted
            self.axes.append(2 * min(self.width, 1 << max(0, int(np.ceil(np.log2(max(left, 2) / 2))))))
        self.coarse = int(np.prod(self.axes[:2]))
        self.fine = int(np.prod(self.axes[2:]))
        self.per_shard = max(1, self.coarse * shard_rows // max(rows, 1))

    def padded(self, units: np.ndarray) -> np.ndarray:
        return np.pad(units, ((0, 0), (0, self.width - units.shape[1])))

    def coordinates(self, units: np.ndarray, table: int) -> list[np.ndarray]:
        """Each turn's coordinate along every signed axis."""
        full, out = self.padded(units), []
        for turn, axes in enumerate(self.axes):
            some = rotated(full, table, turn)[:, : axes // 2]
            out.append(np.concatenate([some, -some], axis=1))
        return out

    def of(self, units: np.ndarray, table: int) -> np.ndarray:
        """The cell of every row: the nearest signed axis of each turn."""
        cell = np.zeros(len(units), np.int64)
        for axes, along in zip(self.axes, self.coordinates(units, table), strict=True):
            cell = cell * axes + along.argmax(axis=1)
        return cell

    def shard(self, cell: np.ndarray) -> np.ndarray:
        return cell // self.fine // self.per_shard

    def gaps(self, along: list[np.ndarray], cells: np.ndarray) -> np.ndarray:
        """(rows, cells): how much less a row's coordinates in a cell sum to than in its own cell."""
        gap, left = np.zeros((len(along[0]), len(cells))), cells
        for axes, part in zip(reversed(self.axes), reversed(along), strict=True):
            gap += part.max(axis=1)[:, None] - part[:, left % axes]
            left = left // axes
        return gap

    def shards_within(self, along: list[np.ndarray], reach: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, shard) of all shards that may hold a cell within reach."""
        gap = along[0].max(axis=1)[:, None] - along[0]
        if len(along) > 1:
            second = along[1].max(axis=1)[:, None] - along[1]
            gap = (gap[:, :, None] + second[:, None, :]).reshape(len(gap), -1)
        least = np.minimum.reduceat(gap, np.arange(0, self.coarse, self.per_shard), axis=1)
        return np.nonzero(least <= reach)


def _matrix(values: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of doubles, scaled by powers of two so that no product overflows."""
    rows = np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype(float)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])


def _units(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def cosine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The cosine of each row with the row beside it, in double precision."""
    lengths = np.einsum("ij,ij->i", left, left), np.einsum("ij,ij->i", right, right)
    return np.einsum("ij,ij->i", left, right) / (np.sqrt(lengths[0]) * np.sqrt(lengths[1]))


def _usable(embeddings: DataFrame, every: int) -> tuple[DataFrame, str]:
    """(vec_id, digest, size, v, asked) of rows that take part, as a written table, and the kind of number in v."""
    element = embeddings.schema["embedding"].dataType.elementType.simpleString()
    kind, spark_type = ("<f4", "float") if element == "float" else ("<f8", "double")

    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            ids, lists = batch.column(0), batch.column(1)
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype(kind)  # NULL becomes NaN
            made: list[tuple] = []
            for at, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                row = values[a:b] + np.zeros(1, kind)  # -0 becomes 0
                if ids[at].is_valid and lists[at].is_valid and np.isfinite(row).all() and row.any():
                    raw = row.tobytes()
                    made.append((ids[at].as_py(), hashlib.blake2b(raw, digest_size=16).digest(), b - a, raw))
            columns = zip(*made) if made else ([], [], [], [])
            types = pa.int64(), pa.binary(), pa.int32(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["vec_id", "digest", "size", "v"]
            )

    source = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast(f"array<{spark_type}>"))
    rows = in_batches(source, run, "vec_id long, digest binary, size int, v binary")
    return materialise(rows.withColumn("asked", F.col("vec_id") % every == 0), "vectors"), kind


def _by_size(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, places in the batch, vectors) of the vectors of each length."""
    sizes, values = batch.column("size").to_numpy(), batch.column("v").to_pylist()
    for size in np.unique(sizes).tolist():
        places = np.flatnonzero(sizes == size)
        yield size, places, _matrix([values[i] for i in places], kind)


def _top(scores: np.ndarray, most: int) -> np.ndarray:
    most = min(most, scores.shape[1])
    return np.argpartition(-scores, most - 1, axis=1)[:, :most]


def _reach(nodes: DataFrame, kind: str, rows: int, best: int, tables: int, recall: float, sample: int) -> float | None:
    """How large a gap to probe to, so that `recall` of some queries' true neighbours are found; None without queries.

    At most `sample` queries, those of the least hashes, are compared with all vectors.
    """
    chosen = nodes.filter("asked").orderBy(F.xxhash64("node"), "node").limit(sample).select("node", "size", "v").collect()
    if not chosen:
        return None
    spark = nodes.sparkSession
    asked = spark.sparkContext.broadcast([(r.node, r["size"], bytes(r.v)) for r in chosen])

    def run(batches: Batches) -> Batches:
        kept: dict[int, list[tuple]] = {}
        by_size: dict[int, tuple] = {}
        for size in {s for _, s, _ in asked.value}:
            mine = [(n, v) for n, s, v in asked.value if s == size]
            units, cells = _units(_matrix([v for _, v in mine], kind)), Cells(size, rows)
            by_size[size] = [n for n, _ in mine], units, cells, [cells.coordinates(units, t) for t in range(tables)]
        for batch in sliced(batches):
            ids = batch.column("node").to_numpy()
            for size, places, matrix in _by_size(batch, kind):
                if size not in by_size:
                    continue
                names, queries, cells, along = by_size[size]
                units = _units(matrix)
                scores = queries @ units.T
                scores[np.array(names)[:, None] == ids[places]] = -2
                top = _top(scores, best)
                placed = [cells.of(units, t) for t in range(tables)]
                for i, name in enumerate(names):
                    near = [
                        (scores[i, j], min(cells.gaps([a[i : i + 1] for a in along[t]], placed[t][j : j + 1])[0, 0] for t in range(tables)))
                        for j in top[i].tolist()
                        if scores[i, j] > -2 and (len(kept.get(name, ())) < best or scores[i, j] > kept[name][-1][0])
                    ]
                    if near:
                        kept[name] = sorted(kept.get(name, []) + near, reverse=True)[:best]
        made = [(name, *pair) for name, near in kept.items() for pair in near]
        columns = zip(*made) if made else ([], [], [])
        types = pa.int64(), pa.float64(), pa.float64()
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["query", "score", "gap"])

    found = in_batches(nodes.select("node", "size", "v"), run, "query long, score double, gap double")
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    true = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= best).select("gap").collect()
    gaps = np.sort([r.gap for r in true])
    return float(gaps[min(len(gaps) - 1, int(np.ceil(recall * len(gaps))))]) + 1e-9 if len(gaps) else 0.0


def _dealt(frame: DataFrame, sizes: DataFrame, own: str, other: str) -> DataFrame:
    """Rows in one of their shard's `own` parts by hash, once for each of its `other` parts."""
    joined = frame.join(sizes, ["table", "size", "shard"], "left")
    spread: Column = F.sequence(F.lit(0), F.coalesce(F.col(f"{other}_parts"), F.lit(1)) - 1)
    mine = F.pmod(F.xxhash64("node"), F.coalesce(F.col(f"{own}_parts"), F.lit(1))).cast("int")
    return joined.select(*frame.columns, mine.alias(f"{own}_part"), F.explode(spread).alias(f"{other}_part"))


def _candidates(nodes: DataFrame, kind: str, rows: int, reach: float, best: int, tables: int, shard_rows: int) -> DataFrame:
    """(query, node, first, score): the nodes of the highest cosines in each shard that a query probes, exact scores."""

    def placed(batches: Batches) -> Batches:
        for batch in sliced(batches):
            for size, places, matrix in _by_size(batch, kind):
                cells, taken, units = Cells(size, rows, shard_rows), batch.take(pa.array(places)), _units(matrix)
                for table in range(tables):
                    cell = cells.of(units, table)
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, pa.array(np.full(len(cell), table, np.int32)), pa.array(cells.shard(cell)), pa.array(cell)],
                        names=[*batch.schema.names, "table", "shard", "cell"],
                    )

    def probing(batches: Batches) -> Batches:
        for batch in sliced(batches):
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                for size, places, matrix in _by_size(part, kind):
                    cells, units = Cells(size, rows, shard_rows), _units(matrix)
                    for table in range(tables):
                        row, shard = cells.shards_within(cells.coordinates(units, table), reach)
                        taken = part.take(pa.array(places[row]))
                        yield pa.RecordBatch.from_arrays(
                            [*taken.columns, pa.array(np.full(len(row), table, np.int32)), pa.array(shard), pa.array(np.full(len(row), -1))],
                            names=[*batch.schema.names, "table", "shard", "cell"],
                        )

    schema = "node long, first long, size int, v binary, table int, shard long, cell long"
    narrow = nodes.select("node", "first", "size", "v")
    index = in_batches(narrow, placed, schema)
    queries = in_batches(nodes.filter("asked").select(*narrow.columns), probing, schema)
    key = ["table", "size", "shard"]
    counted = index.groupBy(*key).agg(F.count("*").alias("n_rows")).join(queries.groupBy(*key).agg(F.count("*").alias("n_queries")), key)
    parts = [F.ceil(F.col(f"n_{x}") / (2 * shard_rows)).cast("int").alias(f"{x}_parts") for x in ("rows", "queries")]
    sizes = counted.select(*key, *parts).filter("rows_parts > 1 OR queries_parts > 1")
    sizes = materialise(sizes, "large-shards")
    dealt = _dealt(index, sizes, "rows", "queries").unionByName(_dealt(queries, sizes, "queries", "rows"))

    def compared(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        cell = group["cell"].to_numpy()
        ids, first, values = group["node"].to_numpy(), group["first"].to_numpy(), group["v"].combine_chunks()
        asking, holding = np.flatnonzero(cell < 0), np.flatnonzero(cell >= 0)
        empty = pa.table({"query": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not len(asking) or not len(holding):
            return empty
        holding = holding[np.argsort(cell[holding], kind="stable")]
        asked, held = (_matrix(values.take(pa.array(x)).to_pylist(), kind) for x in (asking, holding))
        cells, table = Cells(group["size"][0].as_py(), rows), group["table"][0].as_py()
        units, queries = _units(held), _units(asked)
        along = cells.coordinates(queries, table)
        there, starts = np.unique(cell[holding], return_index=True)
        stops = [*starts[1:].tolist(), len(holding)]
        most = best + 1 + SLACK
        score, place = np.full((len(asking), most), -2.0), np.zeros((len(asking), most), np.int64)
        gaps = np.concatenate([cells.gaps(along, there[i : i + 64]) <= reach for i in range(0, len(there), 64)], axis=1)
        for at, (start, stop) in enumerate(zip(starts.tolist(), stops, strict=True)):
            probing = np.flatnonzero(gaps[:, at])
            for i in range(0, len(probing), 1024):
                who = probing[i : i + 1024]
                both = np.concatenate([score[who], queries[who] @ units[start:stop].T], axis=1)
                owners = np.concatenate([place[who], np.broadcast_to(np.arange(start, stop), (len(who), stop - start))], axis=1)
                top = _top(both, most)
                score[who], place[who] = np.take_along_axis(both, top, 1), np.take_along_axis(owners, top, 1)
        row, column = np.nonzero(score > -2)
        near = place[row, column]
        return pa.table(
            {"query": ids[asking[row]], "node": ids[holding[near]], "first": first[holding[near]], "score": cosine(asked[row], held[near])}
        )

    ship_package(nodes.sparkSession)
    grouped = dealt.groupBy("table", "size", "shard", "rows_part", "queries_part")
    return grouped.applyInArrow(compared, "query long, node long, first long, score double")


def neighbours(
    embeddings: DataFrame,
    every: int = EVERY,
    best: int = BEST,
    tables: int = TABLES,
    recall: float = RECALL,
    sample: int = SAMPLE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """For each row whose vec_id `every` divides, the `best` rows of the highest cosine found: query_id, rank, vec_id, score.

    All vectors are in the index. A cell is a signed axis after each of several pseudo-rotations; a query probes all cells in
    which its coordinates sum to nearly what they do in its own, in each table. How nearly is measured: `sample` queries at
    most are compared with all vectors, and the reach is what `recall` of their true neighbours need. A shard is the cells of
    about shard_rows vectors; those with over twice as many, or as many queries, are compared in parts.

    Vectors that are NULL, zero, empty or that hold NULL or a value that isn't finite take no part, nor do rows without a
    vec_id. Equal vectors are one vector of several rows, so copies cost nothing and all of them can be results; ties go to the
    smaller vec_id. Repeated rows count once; other rows of a query's own vec_id are not its results. Vectors are compared
    with those of their length.
    """
    usable, kind = _usable(embeddings, every)
    grouped = usable.groupBy("digest").agg(
        F.min("vec_id").alias("first"), F.max("asked").alias("asked"), F.first("size").alias("size"), F.first("v").alias("v")
    )
    nodes = materialise(grouped.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    rows = nodes.count()
    members = usable.select("vec_id", "digest", "asked").distinct().join(nodes.select("digest", "node"), "digest")
    members = materialise(members.drop("digest"), "vector-rows")
    reach = _reach(nodes, kind, rows, best, tables, recall, sample)
    found = _candidates(nodes, kind, rows, -1.0 if reach is None else reach, best, tables, shard_rows)

    near = found.groupBy("query", "node").agg(F.min("first").alias("first"), F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= best + 1)
    leading = members.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).filter(F.col("place") <= best + 1)
    listed = near.select("query", "node", "score").join(leading.select("node", "vec_id"), "node")
    listed = listed.groupBy("query").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("listed")
    )
    asking = members.filter("asked").select(F.col("node").alias("query"), F.col("vec_id").alias("query_id"))
    others = F.filter("listed", lambda x: x["vec_id"] != F.col("query_id"))
    ranked = asking.join(listed, "query").select("query_id", F.posexplode(F.slice(others, 1, best)).alias("at", "found"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("found.vec_id"), (-F.col("found.down")).alias("score")
    )
