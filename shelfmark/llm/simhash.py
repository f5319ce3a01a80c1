"""SimHash near-duplicates by covering locality-sensitive hashing: every pair within the radius meets in some table."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.components import connected_components
from shelfmark.llm.text import Batches, in_batches, lower_words, materialise, per_row, sliced, tucked, untucked

SHINGLE = 4
RADIUS = 4
SEED = 42
BITS = 64
CHUNK = 1 << 15
BUCKET = 4096  # larger buckets are linked by midpoints, not pairwise


def covering_masks(radius: int = RADIUS) -> list[int]:
    """2^(radius+1) - 1 masks of 64 bits, such that any radius bits lie outside some mask.

    Bit i gets a nonzero vector m(i) of radius + 1 bits; mask a holds bit i if m(i) and a have an odd number of ones in common.
    Any radius vectors have a nonzero vector orthogonal to all, and its mask holds none of their bits: two fingerprints that
    differ in at most radius bits agree under that mask.
    """
    size = (1 << (radius + 1)) - 1
    vectors = [1 + i % size for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & a).bit_count() % 2) for a in range(1, size + 1)]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def simhash(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of a text, signed: a bit is set where over half of the shingles' XXH64 have it; 0 without words."""
    words = lower_words(raw)
    if not words:
        return 0
    joined = b" ".join(words)
    begins, ends, at = [], [], 0
    for word in words:
        begins.append(at)
        at += len(word)
        ends.append(at)
        at += 1
    del words
    ends = ends[min(shingle, len(ends)) - 1 :]
    digest, set_in = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for i in range(0, len(ends), CHUNK):  # a very long text goes in chunks
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(begins[i : i + CHUNK], ends[i : i + CHUNK], strict=False)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        set_in += bits.sum(axis=0, dtype=np.int64)
    over_half = np.packbits(2 * set_in > len(ends))
    return _signed(int.from_bytes(over_half.tobytes(), "big"))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every row; a NULL text has no words."""
    raw = docs.select("doc_id", F.col("text").cast("binary").alias("_raw"))
    return per_row(raw, lambda raw: (simhash(raw, shingle),), ["_raw"], "fingerprint long", gone=("_raw",))


def _linked(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the radius."""
    left, edges = prints, []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= radius  # of signed values numpy counts the absolute value's
            for other in left[near]:
                edges.append((int(at), int(other)))
                frontier.append(other)
            left = left[~near]
    return edges


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in sliced(batches):
            edges = [e for prints in batch.column(0).to_pylist() for e in _linked(np.array(prints, np.int64), radius)]
            u, v = zip(*edges, strict=True) if edges else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return in_batches(buckets.select("prints"), run, "u long, v long")


def _midpoint_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links among fingerprints of large buckets: two within the radius share a point at half of it from both.

    At most as many fingerprints lie around a point as points around a fingerprint, so no group is large.
    """
    reach = -(-radius // 2)
    flips = [0] + [
        _signed(sum(1 << i for i in bits)) for n in range(1, reach + 1) for bits in combinations(range(BITS), n)
    ]
    points = prints.select(
        F.col("fingerprint").alias("u"),
        F.explode(F.transform(F.array(*map(F.lit, flips)), lambda x: x.bitwiseXOR(F.col("fingerprint")))).alias("point"),
    )
    first = points.groupBy("point").agg(F.min("u").alias("v"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return points.join(first, "point").filter(
        (F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    ).select("u", "v").distinct()


def near_links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Edges (u, v) that connect what pairs of distinct fingerprints within the radius connect.

    Each fingerprint goes to one bucket in each of the covering tables. Buckets are first counted, with partial sums, and those
    of one fingerprint end there; a bucket of two is its least and greatest. Members of larger ones are gathered and linked in
    the task, by a spanning forest and not by all pairs; beyond `bucket` members, each member meets its partners at midpoints,
    whatever the bucket's size.
    """
    tables = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col("fingerprint").bitwiseAND(F.lit(_signed(mask))).alias("key"))
            for i, mask in enumerate(covering_masks(radius))
        ]
    )
    dealt = prints.select("fingerprint", F.explode(tables).alias("t")).select("fingerprint", "t.i", "t.key")
    counted = dealt.groupBy("i", "key").agg(
        F.count("*").alias("n"), F.min("fingerprint").alias("u"), F.max("fingerprint").alias("v")
    )
    shared = materialise(counted.filter("n > 1"), "buckets")
    twos = shared.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius).filter("n = 2").select("u", "v")
    larger = shared.filter("n > 2").select("i", "key", "n")
    members = materialise(dealt.join(larger, ["i", "key"]), "bucket-members")
    small = members.filter(F.col("n") <= bucket).groupBy("i", "key").agg(F.collect_list("fingerprint").alias("prints"))
    large = members.filter(F.col("n") > bucket).select("fingerprint").distinct()
    return twos.unionByName(_bucket_links(small, radius)).unionByName(_midpoint_links(large, radius))


def rooted_components(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET
) -> DataFrame:
    """(doc_id, fingerprint, component_id, root) of every row of `docs`; root is the least fingerprint of the component."""
    marked = materialise(fingerprints(docs, shingle), "fingerprints")
    prints = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(near_links(prints.select("fingerprint"), radius, bucket))
    rooted = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = materialise(rooted, "rooted")
    least = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "least-ids")
    owners = materialise(rooted.join(least, "root").select("fingerprint", "component_id", "root"), "owners")
    return marked.join(owners, "fingerprint").select("doc_id", "fingerprint", "component_id", "root")


def components(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs`; other columns are not looked at.

    Rows with one fingerprint are one node, so copies cost a row and not a pair each. component_id is the least doc_id that
    can be reached over links of at most `radius` bits. Empty and NULL texts have fingerprint 0 and are linked like others. A
    NULL doc_id is nobody's component_id; a component without any doc_id has NULL. Repeated rows get a row each.
    """
    return rooted_components(docs, shingle, radius, bucket).drop("root")


def hex_digits(fingerprint: str | Column) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Documents without near-duplicates: of each component the row with the least doc_id stays, all its columns unchanged.

    NULL is the greatest doc_id. Of rows that share the doc_id, the one with the least fingerprint stays, and one of those that
    share both.
    """
    found = materialise(rooted_components(docs, shingle, radius), "components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")).alias("first")
    chosen = materialise(found.groupBy("root").agg(first).select("first.doc_id", "first.fingerprint"), "chosen")
    shared = found.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").select("doc_id")
    if shared.isEmpty():  # then doc_id names a row
        return docs.join(chosen.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    used = ["doc_id", "text"]
    marked = tucked(docs, used).withColumn("_raw", F.col("text").cast("binary"))
    marked = per_row(marked, lambda raw: (simhash(raw, shingle),), ["_raw"], "_print long", gone=("_raw",))
    same = marked["doc_id"].eqNullSafe(chosen["doc_id"]) & (marked["_print"] == chosen["fingerprint"])
    kept = marked.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "_print"])
    return kept.select(untucked(kept, docs.columns, used))
