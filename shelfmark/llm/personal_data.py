"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Built-in functions only: texts never reach Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.text import materialise, tucked, untucked

KINDS = ("email", "ip", "card", "phone")
CONTEXT = 32  # characters before a candidate that labelers see
ACCEPT = 0.9
EM_ROUNDS = 50


@dataclass(frozen=True)
class Form:
    """A way to write a kind: a pattern, a text without which it can't match, and whether it is the base rule's."""

    kind: str
    pattern: str
    needs: tuple[str, ...]
    base: bool


# Each finds what the plain rule finds, leftmost and non-overlapping, in linear time: a match starts where its run of
# characters starts, or where the last match ended, and repeats don't give characters back where that can't help.
# The card pattern takes runs of 14 to 19 digits whole; longer and shorter runs fail the plain rule's length anyway.
FORMS = (
    Form("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", ("@",), True),
    Form("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", (".",), True),
    Form(
        "card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", (), True
    ),
    Form("phone", r"\+[0-9][\x20().0-9-]+[0-9]", ("+",), True),
    Form(
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]++"
        r"(?:\x20?(?:\.|[(\[{]dot[)\]}])\x20?[A-Za-z0-9-]++)++",
        ("(at)", "[at]", "{at}"),
        False,
    ),
    Form("ip", r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", (":",), False),
    Form("card", r"(?<![0-9.])[0-9]{4}(?:\.[0-9]{4}){3}(?![0-9]|\.[0-9])", (".",), False),
    Form("phone", r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])", (), False),
)

# Gazetteers and context words.
DOMAIN_ENDINGS = (
    "com org net edu gov mil int info biz io co me tv app dev ai uk de fr es it nl be ch at pl pt se no fi dk ie eu ru ua cz "
    "gr tr us ca mx br ar cl jp cn kr in au nz za il sg hk tw"
).split()
COUNTRY_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 "
    "93 94 95 98 212 213 216 218 234 254 351 352 353 354 358 359 370 371 372 380 381 385 386 420 421 852 886 961 962 966 971 972"
).split()
FOR = {
    "email": "mail|e-mail|email|contact|write|courriel|correo|kontakt",
    "ip": "ip|host|server|address|adresse|client|login",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta|iban|account|konto",
    "phone": "tel|phone|call|fax|mobile|cell|whatsapp|telefon|téléphone|teléfono|contact",
}
AGAINST = "version|ver|build|release|isbn|issn|doi|order|invoice|ref|serial|part|chapter|section|page|hash|checksum"


def _arrays(form: Form) -> Column:
    """The matches of a form in `text`: the gap since the last one, characters before and after, the match itself."""
    number = FORMS.index(form)
    parts, found = F.col(f"_parts{number}"), F.col(f"_found{number}")
    return F.transform(
        found,
        lambda value, i: F.struct(
            F.lit(number).alias("form"),
            i.alias("nth"),
            F.char_length(F.get(parts, i)).alias("gap"),
            F.right(F.get(parts, i), F.lit(CONTEXT)).alias("before"),
            value.alias("value"),
            F.left(F.get(parts, i + 1), F.lit(1)).alias("after"),
        ),
    )


def _matched(frame: DataFrame) -> DataFrame:
    """The frame with the candidates of `text` in the array `_hits`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    columns = {}
    for number, form in enumerate(FORMS):
        may = reduce(lambda a, b: a | b, [F.contains(text, F.lit(n)) for n in form.needs]) if form.needs else F.lit(True)
        columns[f"_found{number}"] = F.when(may, F.regexp_extract_all(text, F.lit(form.pattern), F.lit(0))).otherwise(
            F.array().cast("array<string>")
        )
    found = frame.withColumns(columns)
    parts = {
        f"_parts{n}": F.when(F.size(f"_found{n}") > 0, F.split(text, form.pattern, -1)).otherwise(
            F.array().cast("array<string>")
        )
        for n, form in enumerate(FORMS)
    }
    cut = found.withColumns(parts)
    return cut.withColumn("_hits", F.concat(*map(_arrays, FORMS))).drop(*columns, *parts)


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), add) % 10 == 0


def _either(good: Column, bad: Column | None = None) -> Column:
    """A vote: 1 for, -1 against, 0 without opinion."""
    vote = F.when(good, 1)
    return (vote.when(bad, -1) if bad is not None else vote).otherwise(0)


def _at_most_255(part: Column) -> Column:
    """Whether digits, as many as they are, make a number of at most 255."""
    bare = F.concat(F.lit("0"), F.regexp_replace(part, "^0+", ""))
    return (F.char_length(bare) <= 4) & (F.try_to_number(F.right(bare, F.lit(4)), F.lit("9999")) <= 255)


def _labeled(hits: DataFrame) -> DataFrame:
    """Candidates (a row each) with kind, whether the base rule takes them, and the labelers' votes."""
    form = F.col("form")
    kind = F.element_at(F.array(*[F.lit(f.kind) for f in FORMS]), form + 1)
    strict = F.element_at(F.array(*[F.lit(f.base) for f in FORMS]), form + 1)
    hits = hits.withColumns({"kind": kind, "strict": strict, "digits": F.regexp_replace("value", "[^0-9]", "")})
    is_kind = lambda name: F.col("kind") == name
    value, digits, count = F.col("value"), F.col("digits"), F.char_length("digits")
    parts = F.split("value", r"\.")
    luhn = is_kind("card") & count.between(14, 19) & _luhn(digits)
    checked = hits.withColumn(
        "checked",  # what the base rule asks of a match
        F.when(is_kind("email"), F.lit(True))
        .when(is_kind("ip") & F.col("strict"), F.forall(parts, _at_most_255))
        .when(is_kind("card"), luhn)
        .when(is_kind("phone"), count.between(10, 15))
        .otherwise(True),
    )
    ending = F.lower(F.regexp_extract(value, r"[.)\]}]\x20?([A-Za-z0-9-]++)$", 1))
    country = F.regexp_extract(value, rf"^\+({'|'.join(sorted(COUNTRY_CODES, key=len, reverse=True))})", 1)
    issuer = digits.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6(?:011|4|5))")
    listed = (
        F.when(is_kind("email"), _either(ending.isin(DOMAIN_ENDINGS), F.lit(True)))
        .when(is_kind("ip") & F.col("strict"), _either(F.lit(False), parts[0].isin("0", "127", "255")))
        .when(is_kind("card"), _either(issuer, F.lit(True)))
        .when(is_kind("phone") & F.col("strict"), _either(country != "", F.lit(True)))
        .otherwise(0)
    )
    lower = F.lower("before")
    word = lambda words: lower.rlike(rf"(?:^|[^\p{{L}}])(?:{words})[^\p{{L}}]*$")
    context = reduce(lambda a, k: a.when(is_kind(k), word(FOR[k])), KINDS[1:], F.when(is_kind(KINDS[0]), word(FOR[KINDS[0]])))
    edge = F.col("after").rlike(r"^[\p{L}\p{N}_]") | F.col("before").rlike(r"[\p{L}\p{N}_]$")
    return checked.withColumns(
        {
            "base": F.col("strict") & F.col("checked"),
            "v0": _either(F.col("strict")),
            "v1": F.when(
                is_kind("card") | (F.col("strict") & ~is_kind("email")), _either(F.col("checked"), F.lit(True))
            ).otherwise(0),
            "v2": listed,
            "v3": _either(context),
            "v4": _either(F.lit(False), word(AGAINST)),
            "v5": _either(F.lit(False), edge),
        }
    ).drop("digits", "strict", "checked")


VOTES = [f"v{i}" for i in range(6)]
# How often each labeler is taken to be right when it votes, before the data speak, with how many candidates' weight, and at most.
RELIABLE = (0.75, 0.95, 0.7, 0.9, 0.9, 0.8)
MOST_RELIABLE = (0.9, 0.995, 0.9, 0.9, 0.9, 0.9)
PSEUDO = 200.0
LEAST_REAL, MOST_REAL = 0.05, 0.8  # bounds of the share of real candidates


def _posteriors(patterns: list[tuple[tuple[int, ...], int]]) -> list[float]:
    """Chance that candidates of each vote pattern are real, by expectation-maximisation over the hidden truth.

    A labeler that votes is right with one chance, whatever the truth; silence says nothing. It is never taken to be worse than a
    coin, so that no round can turn the labels round.
    """
    right, real = list(RELIABLE), 0.5
    posterior: list[float] = []
    for _ in range(EM_ROUNDS):
        weight = [math.log(a / (1 - a)) for a in right]
        odds = [math.log(real / (1 - real)) + sum(v * w for v, w in zip(votes, weight, strict=True)) for votes, _ in patterns]
        posterior = [1 / (1 + math.exp(-x)) for x in odds]
        total = sum(n for _, n in patterns)
        real = (sum(n * p for (_, n), p in zip(patterns, posterior, strict=True)) + PSEUDO / 2) / (total + PSEUDO)
        real = min(max(real, LEAST_REAL), MOST_REAL)
        for j, (at_first, most) in enumerate(zip(RELIABLE, MOST_RELIABLE, strict=True)):
            agreed = sum(
                n * (p if votes[j] > 0 else 1 - p) for (votes, n), p in zip(patterns, posterior, strict=True) if votes[j]
            )
            voted = sum(n for votes, n in patterns if votes[j])
            right[j] = min(max((agreed + PSEUDO * at_first) / (voted + PSEUDO), 0.5), most)
    return posterior


def _features(pattern: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(v == 1) for v in pattern), *(float(v == -1) for v in pattern)]


def _regressed(patterns: list[tuple[tuple[int, ...], int]], truth: list[float]) -> list[float]:
    """Logistic regression on the vote patterns, by the labels that the voting gave them; Newton's steps with a ridge."""
    x = np.array([_features(p) for p, _ in patterns])
    n, y = np.array([float(c) for _, c in patterns]), np.array(truth)
    weights = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (n * (y - p)) - weights
        step = np.linalg.solve(x.T @ (x * (n * p * (1 - p))[:, None]) + ridge, gradient)
        weights = weights + np.clip(step, -2, 2)
    return weights.tolist()


def fit(labeled: DataFrame) -> dict[str, list[float]]:
    """Classifier weights of each kind, from the counts of vote patterns: at most 3^6 a kind, whatever the corpus."""
    rows = labeled.groupBy("kind", *VOTES).count().collect()
    weights = {}
    for kind in KINDS:
        patterns = sorted((tuple(r[v] for v in VOTES), r["count"]) for r in rows if r["kind"] == kind)
        if patterns:
            weights[kind] = _regressed(patterns, _posteriors(patterns))
    return weights


def _probability(weights: dict[str, list[float]]) -> Column:
    logit = F.lit(-30.0)
    for kind, w in weights.items():
        terms = [F.lit(w[0])]
        for j, v in enumerate(VOTES):
            terms.append(F.when(F.col(v) == 1, w[1 + j]).when(F.col(v) == -1, w[1 + len(VOTES) + j]).otherwise(0.0))
        logit = F.when(F.col("kind") == kind, reduce(lambda a, b: a + b, terms)).otherwise(logit)
    return 1 / (1 + F.exp(-logit))


def _spans(hits: DataFrame) -> DataFrame:
    """(row, kind, start, end, base, probability) of accepted candidates; code points, end exclusive.

    `hits` has a row number and the array of candidates. What the base rule takes stays; of others that don't overlap such a
    span, those that the classifier takes.
    """
    each = hits.select("row", F.explode("_hits").alias("h")).select("row", "h.*")
    width = F.char_length("value")
    order = Window.partitionBy("row", "form").orderBy("nth")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    to_here = order.rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum("gap").over(to_here) + F.coalesce(F.sum(width).over(before), F.lit(0))
    placed = each.withColumns({"start": start, "end": start + width})
    rising = Window.partitionBy("row").orderBy("start", F.desc("base")).rowsBetween(Window.unboundedPreceding, -1)
    falling = Window.partitionBy("row").orderBy(F.desc("start"), "base").rowsBetween(Window.unboundedPreceding, -1)
    candidates = _labeled(placed).withColumns(
        {
            "_left": F.max(F.when(F.col("base"), F.col("end"))).over(rising),
            "_right": F.min(F.when(F.col("base"), F.col("start"))).over(falling),
        }
    )
    free = (F.coalesce("_left", F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("_right"), F.col("end")) >= F.col("end"))
    candidates = candidates.filter(F.col("base") | free).select("row", "kind", "start", "end", "base", *VOTES)
    candidates = materialise(candidates, "candidates")
    scored = candidates.withColumn("probability", _probability(fit(candidates)))
    failed = (F.col("v1") < 0) & (F.col("v3") <= 0)  # what fails its kind's check needs words that speak for it
    kept = scored.filter(F.col("base") | ((F.col("probability") >= ACCEPT) & ~failed))
    return kept.select("row", "kind", "start", "end", "base", "probability")


def _listing(base_only: bool) -> Column:
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    entry = F.struct("start", rank.alias("rank"), "end", F.concat_ws(":", "kind", "start", "end").alias("text"))
    entries = F.array_sort(F.collect_list(F.when(F.col("base") | (not base_only), entry)))
    return F.array_join(F.transform(entries, lambda e: e["text"]), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the count of base spans of each kind, base_sha256, spans.

    `docs` needs doc_id and text. Candidates are what the base rules' patterns match and looser forms (spelled-out mail
    addresses, IPv6, dotted card numbers, phone numbers without country). `spans` lists the base rules' spans and those that the
    classifier adds. A NULL text is empty; empty texts have no spans; repeated rows and NULL doc_ids get a row each.
    """
    marked = _matched(docs.select("doc_id", "text")).select("doc_id", "_hits")
    marked = materialise(marked.withColumn("row", F.monotonically_increasing_id()), "hits")
    found = _spans(marked.filter(F.size("_hits") > 0))
    counts = {f"n_{k}": F.count_if(F.col("base") & (F.col("kind") == k)) for k in KINDS}
    by_row = found.groupBy("row").agg(
        *[c.alias(n) for n, c in counts.items()], _listing(True).alias("base"), _listing(False).alias("spans")
    )
    joined = marked.select("row", "doc_id").join(by_row, "row", "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts],
        F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def mask(docs: DataFrame) -> DataFrame:
    """Documents with the kind's name in brackets in place of each span of personal data; spans that overlap are one.

    Texts without candidates pass by unchanged, in no shuffle; n_chars, if there, is counted anew in the others.
    """
    used = [c for c in ("text", "n_chars") if c in docs.columns]
    marked = _matched(tucked(docs, used))
    clean = marked.filter(F.size("_hits") == 0)
    hit = materialise(marked.filter(F.size("_hits") > 0).withColumn("row", F.monotonically_increasing_id()), "hit-texts")
    order = Window.partitionBy("row").orderBy("start", F.desc("end"), "kind")
    so_far = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = _spans(hit.select("row", "_hits")).withColumn("new", (F.coalesce(so_far, F.lit(0)) <= F.col("start")).cast("int"))
    island = F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    islands = (
        found.withColumn("island", island)
        .groupBy("row", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", -F.col("end"))).alias("kind"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("spans"))
    )
    joined = hit.join(islands, "row", "left")
    since = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("spans", i - 1)["end"])
    kept = F.transform(
        "spans",
        lambda s, i: F.concat(
            F.col("text").substr((since(i) + 1).cast("int"), (s["start"] - since(i)).cast("int")),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
        ),
    )
    last = F.element_at("spans", -1)["end"]
    rest = F.col("text").substr((last + 1).cast("int"), F.char_length("text"))
    masked = joined.withColumn(
        "text", F.when(F.size("spans") > 0, F.concat(F.array_join(kept, ""), rest)).otherwise(F.col("text"))
    )
    if "n_chars" in used:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(F.size("spans") > 0, counted).otherwise(F.col("n_chars")))
    both = clean.select(*used, "_rest").unionByName(masked.select(*used, "_rest"))
    return both.select(untucked(both, docs.columns, used))
