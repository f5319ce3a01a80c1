"""Language identification: text likelihoods fused with declared language, address suffix and smoothed host priors, by Bayes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.text import Batches, in_batches, materialise, per_row, sliced
from shelfmark.session import scratch_dir

BUCKETS = 1 << 13
HELD_LANGUAGES = 256  # whose counts a task holds at once
OVERALL_GRAMS = 1000.0  # trigrams that the shares over all languages count for in each language's model
LEAST_SHARE = 1e-15  # a text's smaller chances count as this, and aren't stored
BLOCK_ENTRIES = 1_000_000  # (tag, trigram) counts that the driver looks at together
SAME_LANGUAGE = 0.1  # nats a trigram by which a tag's text may be less like another tag's than that itself,
SAME_SAMPLED = 3.0  # and as many for one trigram of either, less as the root of their number
UNKNOWN = "und"
TEXT_WEIGHT = 0.2  # neighbouring trigrams overlap, so each counts for a part of an observation
UNKNOWN_PRIOR = 1e-3
HOST_STRENGTH, LEVEL_STRENGTH = 5.0, 20.0  # rows that a parent level's shares count for at a host, and above
EVIDENCE_STRENGTH = 10.0
LEAST_CONFIDENCE = 0.5
CHUNK = 256  # buckets

_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<(script|style)\b.*?(?:</\1\s*>|$)|<[^>]*>", re.I | re.S)

# Codes of ISO 639-1 with the codes of 639-2 and 639-3 and the names that stand for the same language.
CODES = """
ar ara arabic|bg bul bulgarian|ca cat catalan|cs ces cze czech|da dan danish|de deu ger german deutsch|el ell gre greek|en eng english
es spa spanish espanol|et est estonian|fa fas per persian farsi|fi fin finnish|fr fra fre french francais|he heb hebrew|hi hin hindi
hr hrv croatian|hu hun magyar|id ind bahasa|it ita italian italiano|ja jpn japanese|ko kor korean|lt lit|lv lav latvian|nb nob bokmal
nl nld dut dutch|no nor|pl pol polish polski|pt por|ro ron rum romanian|ru rus russian|sk slk slo slovak|sl slv|sr srp serbian
sv swe swedish svenska|th tha thai|tr tur turkish|uk ukr|vi vie|zh zho chi chinese|und mul zxx mis
"""
FAMILIES = [group.split() for group in CODES.strip().replace("\n", "|").split("|")]

# ASCII that isn't a letter separates words; bytes beyond ASCII stay.
_LETTERS = bytes(c if c >= 0x80 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A else 0x20 for c in range(256))


def grams(raw: bytes | None) -> np.ndarray:
    """Buckets of the byte trigrams of a text's lower-cased words, with a space around each word."""
    words = raw.translate(_LETTERS).lower().split() if raw else []
    if not words:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    mixed = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761)
    return (mixed >> np.uint32(32 - 13)).astype(np.int64)


@dataclass
class TextModel:
    """log chance of a trigram bucket in each language, and last in no language: there all buckets are alike.

    A language's log chance of a bucket is that of a language without the bucket (`unseen`, less `totals`) and, where it has the
    bucket, an entry more: `values` at `places`, by bucket from `starts`. So the model grows with what languages have.
    """

    languages: list[str]
    unseen: np.ndarray
    totals: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    values: np.ndarray

    def log_likelihoods(self, raw: bytes | None) -> tuple[np.ndarray, int]:
        found = grams(raw)
        times = np.bincount(found, minlength=BUCKETS)
        total = float(times @ self.unseen) - len(found) * self.totals
        held = np.flatnonzero(times)
        for a in range(0, len(held), CHUNK):
            at = held[a : a + CHUNK]
            sizes = self.starts[at + 1] - self.starts[at]
            entries = np.repeat(self.starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            weights = self.values[entries] * np.repeat(times[at], sizes)
            total += np.bincount(self.places[entries], weights, minlength=len(total))
        total[-1] = -len(found) * np.log(BUCKETS)
        return total, len(found)


def _counts(texts: DataFrame) -> DataFrame:
    """(key, bucket, n): trigram counts of all texts (declared, raw) by declared tag, summed by Spark."""

    def run(batches: Batches) -> Batches:
        counts: dict[str, np.ndarray] = {}

        def flushed() -> pa.RecordBatch:
            rows = [(key, np.flatnonzero(n)) for key, n in counts.items()]
            keys = [key for key, at in rows for _ in range(len(at))]
            at = np.concatenate([at for _, at in rows]) if rows else np.zeros(0, np.int64)
            n = np.concatenate([counts[key][at] for key, at in rows]) if rows else np.zeros(0, np.int64)
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(at, pa.int64()), pa.array(n, pa.int64())], names=["key", "bucket", "n"]
            )

        for batch in sliced(batches):
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key not in counts:
                    if len(counts) >= HELD_LANGUAGES:
                        yield flushed()
                    counts[key] = np.zeros(BUCKETS, np.int64)
                counts[key] += np.bincount(grams(raw), minlength=BUCKETS)
        yield flushed()

    partial = in_batches(texts.filter(F.col("declared") != UNKNOWN), run, "key string, bucket long, n long")
    return materialise(partial.groupBy("key", "bucket").agg(F.sum("n").alias("n")).filter("n > 0"), "trigrams")


def _by_size(counts: DataFrame) -> Iterator[list[tuple[str, np.ndarray, np.ndarray]]]:
    """(tag, buckets, counts) of all tags, those of more text first to a factor of two, in blocks of about BLOCK_ENTRIES entries."""
    sizes = counts.groupBy("key").agg(F.floor(F.log2(F.sum("n"))).alias("size"), F.count("*").alias("entries"))
    sizes = materialise(sizes, "tag-sizes")
    entries = {r["size"]: r.entries for r in sizes.groupBy("size").agg(F.sum("entries").alias("entries")).collect()}
    spans: list[list[int]] = []
    for size in sorted(entries, reverse=True):
        if spans and sum(entries[x] for x in spans[-1]) + entries[size] <= BLOCK_ENTRIES:
            spans[-1].append(size)
        else:
            spans.append([size])
    for span in spans:
        parts = -(-sum(entries[x] for x in span) // BLOCK_ENTRIES)
        for part in range(parts):
            mine = sizes.filter(F.col("size").isin(span) & (F.pmod(F.xxhash64("key"), F.lit(parts)) == part))
            table = counts.join(mine.select("key"), "key").toArrow()
            keys, bucket, n = (table.column(c).to_numpy() for c in ("key", "bucket", "n"))
            order = np.lexsort((bucket, keys.astype(str)))
            keys, bucket, n = keys[order], bucket[order], n[order].astype(float)
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
            tags = [(keys[a], bucket[a:b], n[a:b]) for a, b in zip(starts, [*starts[1:], len(keys)], strict=True)]
            yield sorted(tags, key=lambda tag: (-tag[2].sum(), tag[0]))


def train(texts: DataFrame) -> tuple[TextModel, DataFrame]:
    """The model of the languages that texts (declared, raw) are declared in, and (tag, leader), which language a tag is.

    A tag is the same language as one of more text if its text is nearly as likely there as that tag's own: then their counts
    are one. So several tags of a language don't compete, and the model grows with languages, not with tags.
    """
    spark = texts.sparkSession
    counts = _counts(texts)
    overall = np.zeros(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        overall[r.bucket] = r.n
    unseen = 0.5 + OVERALL_GRAMS * overall / max(1.0, overall.sum())
    leaders, pooled = [], []
    logs, own, total = np.zeros((0, BUCKETS), np.float32), np.zeros(0), np.zeros(0)
    families = scratch_dir(spark, "families")
    schema = "tag string, leader string"
    spark.range(0).select(F.lit("").alias("tag"), F.lit("").alias("leader")).write.parquet(families)
    for block in _by_size(counts):
        found = []
        for tag, bucket, n in block:
            size, best = n.sum(), None
            if leaders:
                worse = own - logs[:, bucket] @ n / size
                worse -= SAME_LANGUAGE + SAME_SAMPLED / np.sqrt(np.minimum(size, total))
                best = int(worse.argmin())
            if best is not None and worse[best] <= 0:
                np.add.at(pooled[best], bucket, n)
                found.append((tag, leaders[best]))
                continue
            mine = np.zeros(BUCKETS)
            mine[bucket] = n
            chance = np.log((mine + unseen) / (size + unseen.sum())).astype(np.float32)
            leaders.append(tag)
            pooled.append(mine)
            logs = np.concatenate([logs, chance[None]])
            own, total = np.append(own, chance @ mine / size), np.append(total, size)
        if found:
            merged = pa.table(dict(zip(("tag", "leader"), zip(*found, strict=True), strict=True)))  # rows of Python would start further workers
            spark.createDataFrame(merged).coalesce(1).write.mode("append").parquet(families)
    order = sorted(range(len(leaders)), key=leaders.__getitem__)
    dense = np.array([pooled[i] for i in order]) if order else np.zeros((0, BUCKETS))
    bucket, place = np.nonzero(dense.T)
    n = dense[place, bucket]
    totals = np.append(np.log(dense.sum(axis=1) + unseen.sum()), 0.0)
    starts = np.searchsorted(bucket, np.arange(BUCKETS + 1))
    languages = [*(leaders[i] for i in order), UNKNOWN]
    model = TextModel(languages, np.log(unseen), totals, starts, place.astype(np.int32), np.log1p(n / unseen[bucket]))
    return model, spark.read.schema(schema).parquet(families)


def _softmax(logs: np.ndarray) -> np.ndarray:
    shifted = np.exp(logs - logs.max())
    return shifted / shifted.sum()


def _summed(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, i, n): expected rows of each language, by the text alone; languages without any have no row."""
    shares = evidence.select(*keys, F.explode("shares").alias("s")).select(*keys, "s.i", "s.p")
    return shares.groupBy(*keys, "i").agg(F.sum("p").alias("n"))


def _level(evidence: DataFrame, key: str) -> DataFrame:
    """Expected rows of each language at each value of a key."""
    sums = _summed(evidence.filter(F.col(key).isNotNull()), [key])
    return materialise(sums.groupBy(key).agg(F.collect_list(F.struct("i", "n")).alias(f"{key}_sums")), key)


def fuse(evidence: DataFrame, languages: list[str]) -> DataFrame:
    """Each row's language and confidence.

    `evidence`: declared, host, domain, suffix and `shares`, (i, p) of the languages that have a chance by the text alone. A host's prior is its
    rows' expected languages, smoothed by its domain's, those by its suffix's, those by all rows'; a row's own share is taken out
    first, so that a text isn't its own prior. What rows of each language declare, and the suffixes they have, give the
    chance of a declaration and of a suffix. Levels are grouped sums, joined by key; a NULL key says nothing.
    """
    size = len(languages)
    joined = evidence
    for key in ("host", "domain", "suffix", "declared"):
        joined = joined.join(_level(evidence, key), key, "left")
    overall = np.zeros(size)
    for r in _summed(evidence, []).collect():  # a row a language
        overall[r["i"]] = r["n"]
    known = {c: i for i, c in enumerate(languages)}
    n_suffixes = max(1, evidence.agg(F.count_distinct("suffix")).first()[0])
    n_declared = max(1, evidence.agg(F.count_distinct("declared")).first()[0])

    def dense(sums: list[dict] | None, value: str) -> np.ndarray | None:
        if sums is None:
            return None
        full = np.zeros(size)
        full[[s["i"] for s in sums]] = [s[value] for s in sums]
        return full

    def decide(shares, n_grams, host, domain, suffix, declared, declaration) -> tuple:
        own = dense(shares, "p")
        host, domain, suffix, declared = (dense(sums, "n") for sums in (host, domain, suffix, declared))
        if not n_grams:
            return UNKNOWN, 0.0, UNKNOWN, False
        others = np.maximum(overall - own, 0.0)
        prior = (others + 1.0) / (others + 1.0).sum()
        logs = np.log(np.maximum(own, LEAST_SHARE))  # the text's likelihoods: `shares` has them over an even prior
        for sums, strength in ((suffix, LEVEL_STRENGTH), (domain, LEVEL_STRENGTH), (host, HOST_STRENGTH)):
            if sums is not None:
                here = np.maximum(sums - own, 0.0)
                prior = (here + strength * prior) / (here.sum() + strength)
        if declaration in known:  # a language of little text is carried by its declaration
            prior[known[declaration]] = max(prior[known[declaration]], UNKNOWN_PRIOR)
        prior[-1] = UNKNOWN_PRIOR
        logs = logs + np.log(prior / prior.sum())
        for sums, values, expected in ((declared, n_declared, known.get(declaration)), (suffix, n_suffixes, None)):
            if sums is not None:
                # Chance of this value among rows of each language: its even share, or for a declaration mostly its own name.
                guess = np.full(size, 1.0 / values)
                if expected is not None:
                    guess = np.where(np.arange(size) == expected, 0.9, 0.1 / values)
                    guess[-1] = 1.0 / values
                here = np.maximum(sums - own, 0.0)
                logs = logs + np.log((here + EVIDENCE_STRENGTH * guess) / (others + EVIDENCE_STRENGTH))
        chances = _softmax(logs)
        best = int(chances.argmax())
        sure = bool(best < size - 1 and chances[best] >= LEAST_CONFIDENCE)
        return languages[best], float(chances[best]), languages[int(own.argmax())], sure

    names = ["shares", "n_grams", "host_sums", "domain_sums", "suffix_sums", "declared_sums", "declared"]
    return per_row(joined, decide, names, "language string, confidence double, text_language string, kept boolean")


def address_parts(host: Column) -> dict[str, Column]:
    """host, its last two labels as domain, and its last label as suffix; a name without a dot has host and domain only."""
    name = F.nullif(F.lower(F.trim(host.cast("string"))), F.lit(""))
    dotted = F.contains(name, F.lit("."))
    return {
        "host": name,
        "domain": F.when(dotted, F.substring_index(name, ".", -2)),
        "suffix": F.when(dotted, F.substring_index(name, ".", -1)),
    }


def declared_language(column: Column) -> Column:
    """The primary part of a language tag, in lower case, as the two-letter code where FAMILIES has it; those of no language are NULL."""
    tag = F.nullif(F.lower(F.regexp_extract(column.cast("string"), r"^\s*([A-Za-z]{2,})", 1)), F.lit(""))
    codes = F.create_map(*[F.lit(x) for group in FAMILIES for name in group for x in (name, group[0])])
    return F.nullif(F.coalesce(F.try_element_at(codes, tag), tag), F.lit(UNKNOWN))


def identify(rows: DataFrame, key: list[str], text: Column, declared: Column, host: Column) -> DataFrame:
    """One row per row: the key columns, language, confidence, text_language, declared, kept.

    Text models learn from all rows with a declared language and of every one that is
    declared; those of little text are smoothed towards the shares over all. `declared` and `language` are the tag of most text
    among those that are one language (see `train`), so tags of the same language share its chances. Texts without a letter are `und`
    and not kept, and so are texts that look like none of the languages or whose likeliest one has a chance under 0.5. A NULL
    text is empty; a NULL declaration, host or suffix is no evidence; without any declaration all rows are `und`. Repeated
    rows get a row each.
    """
    source = rows.select(*key, text.cast("binary").alias("_raw"), declared_language(declared).alias("declared"), host.alias("_host"))
    model, families = train(source.select("declared", "_raw"))
    held = rows.sparkSession.sparkContext.broadcast(model)
    size = len(model.languages)

    def weigh(model: TextModel, raw: bytes | None) -> tuple:
        logs, n = model.log_likelihoods(raw)
        shares = _softmax(TEXT_WEIGHT * logs)
        return [(i, p) for i, p in enumerate(shares.tolist()) if p >= LEAST_SHARE], n

    named = source.join(families.withColumnRenamed("tag", "declared"), "declared", "left")
    source = named.withColumn("declared", F.coalesce("leader", "declared")).drop("leader")
    shares = "shares array<struct<i: int, p: double>>, n_grams long"
    weighed = per_row(source, weigh, ["_raw"], shares, setup=lambda: held.value, gone=("_raw",))
    evidence = materialise(weighed.withColumns(address_parts(F.col("_host"))).drop("_host"), "evidence")
    decided = fuse(evidence, model.languages)
    return decided.select(*key, "language", "confidence", "text_language", "declared", "kept")


def document_languages(docs: DataFrame) -> DataFrame:
    """Languages of documents (doc_id, text, lang as the declared language, source as the host)."""
    return identify(docs, ["doc_id"], F.col("text"), F.col("lang"), F.col("source"))


def _page_text(html: str | None) -> tuple[bytes]:
    """The text between tags, without scripts, styles and comments, with character references decoded."""
    return (unescape(_MARKUP.sub(" ", html or "")).encode(errors="replace"),)


def page_languages(pages: DataFrame) -> DataFrame:
    """Languages of pages (page_id, url, html): the html element's lang, the address's host, the text between tags.

    Names of elements and attributes are read in any case, and references decoded. NULL and empty pages and those without a
    letter are `und`; a missing or malformed address says nothing; repeated pages get a row each; other columns are not read.
    """
    declared = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    host = F.regexp_extract(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    read = pages.select("page_id", "html", declared.alias("_declared"), host.alias("_address"))
    texts = per_row(read, _page_text, ["html"], "_text binary").drop("html")
    return identify(texts, ["page_id"], F.col("_text"), F.col("_declared"), F.col("_address"))


def in_known_language(docs: DataFrame) -> DataFrame:
    """Documents whose language is found, all columns unchanged.

    NULL and empty texts and those without a letter go; a NULL language, source or doc_id is no reason to; of repeated rows all
    stay or none. Rows are rejected by doc_id and a hash of what decided, so rows that share a doc_id don't share their fate. Rejected rows are
    few, and their join is a broadcast where they fit one.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit("")))
    keyed = docs.select("doc_id", "text", "lang", "source", mark.alias("_mark"))
    found = identify(keyed, ["doc_id", "_mark"], F.col("text"), F.col("lang"), F.col("source"))
    rejected = materialise(found.filter("NOT kept").select("doc_id", "_mark").distinct(), "rejected")
    marked = docs.withColumn("_mark", mark)
    same = marked["doc_id"].eqNullSafe(rejected["doc_id"]) & (marked["_mark"] == rejected["_mark"])
    return marked.join(rejected, same, "left_anti").select(*docs.columns)
