"""Word counts of a corpus, exact and by key, as a written table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.text import Batches, in_batches, materialise, sliced

HELD = 200_000  # words a task counts before it hands its counts on


def word_counts(
    texts: DataFrame, split: Callable[[bytes | None], list[bytes]], ending: bytes | None = None
) -> DataFrame:
    """(key, word, n) over a table of (key string, raw binary); `ending` is counted once a row as well.

    Tasks count in Python and hand on partial counts, which Spark sums by key and word, partial sums first: a frequent word
    costs one row a task.
    """

    def run(batches: Batches) -> Batches:
        counts: dict[str | None, Counter] = {}

        def flushed() -> pa.RecordBatch:
            keys, words, numbers = [], [], []
            for key, counter in counts.items():
                keys += [key] * len(counter)
                words += counter.keys()
                numbers += counter.values()
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(words, pa.binary()), pa.array(numbers, pa.int64())],
                names=["key", "word", "n"],
            )

        for batch in sliced(batches):
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counter = counts.setdefault(key, Counter())
                counter.update(split(raw))
                if ending is not None:
                    counter[ending] += 1
                if sum(map(len, counts.values())) > HELD:
                    yield flushed()
        yield flushed()

    partial = in_batches(texts, run, "key string, word binary, n long")
    return materialise(partial.groupBy("key", "word").agg(F.sum("n").alias("n")), "word-counts")
