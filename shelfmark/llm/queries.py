"""One query per operator of this subpackage over the whole of its table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import cross_polytope, decontaminate, hidden_markov, html_extract, language, lexical_search, packing, personal_data, quality_pu, quality_rules, simhash, token_alignment, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return quality_pu.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash component of every document."""
    found = simhash.components(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash.hex_digits("fingerprint"))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return language.document_languages(table(spark, sf_dir, "documents"))


@query
def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, from its markup, address and text."""
    return language.page_languages(table(spark, sf_dir, "pages"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


@query
def op6_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hidden Markov model's log10 probability of every document."""
    return hidden_markov.score(table(spark, sf_dir, "documents"))


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents that benchmark windows cover."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics of every document, and whether its histograms are near its language's."""
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


@query
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every document lie against each other."""
    return token_alignment.align(table(spark, sf_dir, "documents"))


@query
def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found of every fiftieth."""
    return cross_polytope.neighbours(table(spark, sf_dir, "embeddings"))


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
FOLDED_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op7_decontamination"] = f"""
WITH item_words AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {FOLDED_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, 13 AS n, array_to_string(w[s:s + 12], ' ') AS g
    FROM (SELECT item, w, unnest(generate_series(1, len(w) - 12)) AS s FROM item_words WHERE len(w) >= 13)
    UNION
    SELECT DISTINCT item, len(w) AS n, array_to_string(w, ' ') AS g FROM item_words WHERE len(w) BETWEEN 1 AND 12
),
doc_words AS (SELECT doc_id, {FOLDED_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
    SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM doc_words, sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, s, n, item FROM grams JOIN windows USING (n, g)),
places AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id
),
found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""

ORACLE["op11_lexical_search"] = f"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS place, w, len(w) AS n
    FROM (SELECT doc_id, {FOLDED_WORDS} AS w FROM documents) WHERE len(w) > 0
),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
occurrences AS (
    SELECT place, t, count(*) AS tf FROM (SELECT place, unnest(w) AS t FROM docs) GROUP BY place, t
),
asked AS (SELECT DISTINCT item_id, text, unnest({FOLDED_WORDS}) AS t FROM benchmark),
weights AS (
    SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS weight
    FROM (SELECT t, count(*) AS df FROM occurrences GROUP BY t), totals
),
scored AS (
    SELECT item_id, a.text, place,
           sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM asked a JOIN weights USING (t) JOIN occurrences USING (t) JOIN docs USING (place), totals
    GROUP BY item_id, a.text, place
),
ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank
    FROM scored JOIN docs USING (place) WHERE score > 0 AND doc_id IS NOT NULL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
