"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.text import remainder


def labels_outside(labels: DataFrame, label: str, modulus: int, value: int) -> DataFrame:
    """(doc_id, label) of documents whose remainder isn't `value`: one row a doc_id; of contradicting labels the greater."""
    usable = labels.filter(F.col(label).isin(0, 1) & (remainder("doc_id", modulus) != value))
    return usable.groupBy("doc_id").agg(F.max(label).cast("int").alias(label))


def sampled_texts(docs: DataFrame, labels: DataFrame, label: str, limits: dict[int, int]) -> DataFrame:
    """(doc_id, label, raw) for about `limits[value]` labelled documents of each value, or all if there are fewer.

    A document is in if the hash of its doc_id lies under the value's share, so the sample is the same on every run.
    """
    counts = {r[label]: r["count"] for r in labels.groupBy(label).count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    inside = F.lit(False)
    for value, limit in limits.items():
        share = min(1.0, limit / max(1, counts.get(value, 0)))
        inside = inside | ((F.col(label) == value) & (place < int(share * (1 << 40))))
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("raw"))
    return texts.join(F.broadcast(labels.filter(inside)), "doc_id")  # the limits bound it
