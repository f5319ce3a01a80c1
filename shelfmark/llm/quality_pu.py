"""Quality by positive-unlabelled learning: the non-negative unbiased risk of trusted positives and unlabelled text."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.labeled import labels_outside
from shelfmark.llm.quality_rules import byte_classes
from shelfmark.llm.text import Batches, held_out, in_batches, materialise, per_row, spaced_words

STEPS = 8
FIRST_PRIOR = 0.5
PRIOR_ROUNDS = 2
RIDGE = 1e-3
BINS = 1024
LEAST_POSITIVES = 0.05  # share of positives above the threshold that the prior is read at
NON_NEGATIVE_STEP = 0.5


def features(raw: bytes | None) -> list[float]:
    """Shares and lengths that tell prose from lists, shouting, symbols and repetition; nothing of the words themselves."""
    raw = raw or b""
    words = spaced_words(raw)
    n = len(words)
    classes = byte_classes(raw).astype(float)
    size = max(1.0, classes.sum())
    letters = max(1.0, classes[0] + classes[1] + classes[7])
    lower, upper, digit, space, other_space, punctuation, symbol, beyond = classes / size
    distinct = len(set(words)) / n if n else 1.0
    pairs = len(set(zip(words, words[1:], strict=False))) / (n - 1) if n > 1 else 1.0
    twice = sum(a == b for a, b in zip(words, words[1:], strict=False)) / (n - 1) if n > 1 else 0.0
    bars, shouts = raw.count(b"|") / max(1, n), raw.count(b"!") / max(1, n)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    again = 1 - len(set(lines)) / len(lines) if lines else 0.0
    mean = sum(map(len, words)) / n if n else 0.0
    odd = [symbol, digit, classes[1] / letters, 1 - pairs, twice, bars, shouts, again, other_space]
    return [
        1.0,
        math.log1p(n) / 5,
        float(n == 0),
        float(n < 5),
        float(n < 20),
        mean / 10,
        abs(mean - 5) / 5,
        space,
        punctuation,
        beyond + lower,
        distinct,
        *(min(1.0, 4 * x) for x in odd),
        *(math.sqrt(min(1.0, x)) for x in odd),
        *(float(x > 0.15) for x in odd),
    ]


SIZE = len(features(b""))


def _sums(table: DataFrame, weights: np.ndarray) -> dict[str, np.ndarray | float]:
    """What a step needs, summed over all training rows: counts, losses, gradients and curvature. As long as the weights squared."""
    held = table.sparkSession.sparkContext.broadcast(weights)
    parts = {"n_p": 1, "n_u": 1, "mean_p": SIZE, "plus_p": SIZE, "plus_u": SIZE, "loss_p": 1, "loss_u": 1, "bend_u": SIZE * SIZE}

    def run(batches: Batches) -> Batches:
        total = np.zeros(sum(parts.values()))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, SIZE)
            positive = np.array(batch.column(1).to_pylist(), bool)
            g = x @ held.value
            chance = 1 / (1 + np.exp(-np.clip(g, -40, 40)))
            loss = np.logaddexp(0, g)
            xp, cp = x[positive], chance[positive]
            total += np.concatenate(
                [
                    [positive.sum(), len(x)],
                    xp.sum(axis=0),
                    cp @ xp,
                    chance @ x,
                    [loss[positive].sum(), loss.sum()],
                    (x.T @ (x * (chance * (1 - chance))[:, None])).ravel(),
                ]
            )
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["slot", "value"])

    rows = in_batches(table.select("x", "positive"), run, "slot long, value double").groupBy("slot").agg(F.sum("value").alias("value"))
    flat = np.zeros(sum(parts.values()))
    for r in rows.collect():
        flat[r["slot"]] = r["value"]
    held.unpersist()
    out, at = {}, 0
    for name, length in parts.items():
        out[name] = float(flat[at]) if length == 1 else flat[at : at + length]
        at += length
    return out


def train(table: DataFrame, prior: float, weights: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights that minimise prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)]) with the logistic loss l.

    While the second part, the risk on negatives, isn't below zero, the risk is convex and Newton's step is taken on all of it;
    below zero, the step goes up that part's slope.
    """
    for _ in range(steps):
        s = _sums(table, weights)
        if not s["n_p"] or not s["n_u"]:
            return weights
        negative_risk = s["loss_u"] / s["n_u"] - prior * s["loss_p"] / s["n_p"]
        rising = s["plus_u"] / s["n_u"] - prior * s["plus_p"] / s["n_p"]
        if negative_risk < 0:
            weights = weights + NON_NEGATIVE_STEP * rising
            continue
        gradient = s["plus_u"] / s["n_u"] - prior * s["mean_p"] / s["n_p"] + RIDGE * weights
        bend = s["bend_u"].reshape(SIZE, SIZE) / s["n_u"] + RIDGE * np.eye(SIZE)
        step = np.linalg.solve(bend, gradient)
        weights = weights - step * min(1.0, 10.0 / max(1e-12, float(np.abs(step).max())))
        if float(np.abs(step).max()) < 1e-3:
            break
    return weights


def _chances(table: DataFrame, weights: np.ndarray) -> DataFrame:
    """The table with `score`, computed from the feature array."""
    logit = F.aggregate(
        F.zip_with("x", F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v
    )
    return table.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(40.0)), F.lit(-40.0)))))


def estimate_prior(table: DataFrame, weights: np.ndarray) -> float:
    """The share of positives among unlabelled rows: the least ratio of unlabelled to positive rows above a threshold.

    Above a threshold that only positives pass, unlabelled rows pass as often as the share of positives times positives do. The
    threshold is the one whose upper confidence bound of that ratio is least.
    """
    binned = _chances(table, weights).withColumn("bin", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)))
    rows = binned.groupBy("bin").agg(F.count("*").alias("u"), F.count_if("positive").alias("p")).collect()
    u, p = np.zeros(BINS), np.zeros(BINS)
    for r in rows:
        u[r["bin"]], p[r["bin"]] = r["u"], r["p"]
    if not p.sum():
        return FIRST_PRIOR
    above_u, above_p = np.cumsum(u[::-1]) / u.sum(), np.cumsum(p[::-1]) / p.sum()
    slack = math.sqrt(math.log(40) / (2 * u.sum())) + math.sqrt(math.log(40) / (2 * p.sum()))
    usable = above_p >= LEAST_POSITIVES
    bound = np.where(usable, (above_u + slack) / np.maximum(above_p, 1e-9), np.inf)
    at = int(bound.argmin())
    return float(min(max(above_u[at] / above_p[at], 0.05), 0.99))


def score(docs: DataFrame, labels: DataFrame, modulus: int = 4, value: int = 2, threshold: float = 0.7) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, class_prior.

    `docs` needs doc_id and text, `labels` doc_id and quality. Positives are documents labelled 1 whose crc32(doc_id) modulo
    `modulus` isn't `value`; all documents with such a remainder are the unlabelled text, whatever label they have, so that
    they show the corpus as it is. Labels of 0 aren't used. NULL is the empty text, which is scored by its features; repeated rows get
    a row each; a NULL doc_id is held out; without positives every score is a half.
    """
    texts = docs.select(
        "doc_id", held_out("doc_id", modulus, value).alias("held_out"), F.col("text").cast("binary").alias("_raw")
    )
    measured = per_row(texts, lambda raw: (features(raw),), ["_raw"], "x array<double>").drop("_raw")
    measured = materialise(measured, "quality-features")
    positives = labels_outside(labels, "quality", modulus, value).filter("quality = 1").select("doc_id")
    marked = measured.filter("NOT held_out").join(positives.withColumn("_one", F.lit(True)), "doc_id", "left")
    table = materialise(marked.select("x", F.coalesce("_one", F.lit(False)).alias("positive")), "quality-training")
    prior, weights = FIRST_PRIOR, np.zeros(SIZE)
    for _ in range(PRIOR_ROUNDS):
        weights = train(table, prior, weights)
        prior = estimate_prior(table, weights)
    weights = train(table, prior, weights)
    scored = _chances(measured, weights)
    return scored.select(
        "doc_id",
        "held_out",
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.lit(prior).alias("class_prior"),
    )
