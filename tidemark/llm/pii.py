"""Personal data: exact patterns, and weakly supervised spans beside them.

Spans of e-mail addresses, IP addresses, card and phone numbers come from fixed patterns. Further
candidates (numbers in groups, keys and tokens, people with titles) are judged without labels:
regex, gazetteer and context labelers vote on each; the counts of vote patterns over all texts
go through expectation-maximisation, which gives every labeler a reliability and every
pattern a posterior; posterior-weighted counts of a span's features then train the final
classifier, a naive Bayes over shape, length and neighbourhood that also sees spans no labeler
votes on. The texts are only read by DataFrame expressions; what the driver sees is the table
of counts, whose size is bounded by the numbers of vote patterns and feature values.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table, written

#: Patterns of the contract, made to start only where a run of their first characters starts or the
#: last match ended, and to take digits possessively: the same matches, in time linear in the text.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

#: Candidates beside the patterns above, each between characters that are neither letters nor digits.
CANDIDATE = (
    r"(?<![A-Za-z0-9+@.-])(?:"
    r"(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]++(?: [A-Z][a-z]++)?"
    r"|\(?[0-9]{2,4}\)?[ .-][0-9]{2,4}(?:[ .-][0-9]{2,4}){1,2}"
    r"|(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+"
    r")(?![A-Za-z0-9@])"
)
#: Fixed values of the labelers: gazetteers and context words, for and against.
GIVEN_NAMES = "James|John|Robert|Michael|David|William|Mary|Patricia|Jennifer|Linda|Elizabeth|Maria|Anna|Peter|Paul|Thomas|Hans|Pierre|Marie|Jean|Juan|Jose|Carlos|Carmen"
KEY_PREFIXES = "sk|pk|AKIA|ASIA|ghp|gho|xox|eyJ|api|key|tok"
CUES = "phone|call|tel|mobile|fax|contact|ssn|social|passport|account|iban|key|token|secret|password|name|signed|dear|address"
ANTI_CUES = "version|isbn|issn|page|figure|chapter|section|vol|no|issue|id|sha|commit|hash|build"
LABELERS = ("regex", "gazetteer", "context")
ROUNDS = 50
NO_MATCH = "CAST(array() AS ARRAY<STRUCT<s: BIGINT, e: BIGINT, m: STRING, before: STRING>>)"


def _spans(text: str, pattern: str) -> str:
    """SQL: the pattern's matches in `text`, as array<struct<s, e, m, before>> in code points; before: up to 40 characters since the last match.

    What stands between matches (split) and the matches (regexp_extract_all) alternate. Their lengths
    are added up by doubling steps, of which a text with n matches takes log2(n).
    """
    p = "r'" + pattern + "'"
    step = "transform(acc, (v, i) -> v + IF(i >= k, acc[i - k], 0L))"
    ends = f"aggregate(transform(sequence(0, CAST(ceil(log2(size(z) + 1)) AS INT)), j -> shiftleft(1, j)), transform(z, x -> CAST(length(x.`0`) + coalesce(length(x.`1`), 0) AS BIGINT)), (acc, k) -> {step})"
    found = f"filter(transform(arrays_zip(z, {ends}), y -> named_struct('s', y.`1` - length(y.z.`1`), 'e', y.`1`, 'm', y.z.`1`, 'before', right(y.z.`0`, 40))), x -> x.m IS NOT NULL)"
    return f"element_at(transform(array(arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0))), z -> {found}), 1)"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _luhn(m: str) -> str:
    """SQL: 12 to 19 digits whose Luhn sum is a multiple of ten."""
    doubled = "CASE WHEN i % 2 = 0 THEN CAST(d AS INT) WHEN CAST(d AS INT) > 4 THEN 2 * CAST(d AS INT) - 9 ELSE 2 * CAST(d AS INT) END"
    return f"length({_digits(m)}) BETWEEN 12 AND 19 AND aggregate(transform(split(reverse({_digits(m)}), ''), (d, i) -> {doubled}), 0, (a, d) -> a + d) % 10 = 0"


#: What a match must hold besides its pattern.
CHECKS = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> length(ltrim('0', p)) <= 3 AND CAST(concat('0', right(p, 3)) AS INT) <= 255)",
    "card": _luhn("x.m"),
    "phone": f"length({_digits('x.m')}) BETWEEN 9 AND 15",
}
#: A cheap test that a text can have a match at all.
MAY = {"email": "contains(text, '@')", "ip": "text RLIKE r'[0-9]\\.[0-9]'", "card": "text RLIKE r'[0-9](?:[\\x20-]?[0-9]){11}'", "phone": "contains(text, '+')"}
EMPTY = "CAST(array() AS ARRAY<STRUCT<s: BIGINT, e: BIGINT, kind: STRING>>)"


def base_spans(docs: DataFrame) -> DataFrame:
    """`docs` with an array column of spans for each kind, in the order of the text `text`."""
    for kind, pattern in zip(KINDS, (EMAIL, IP, CARD, PHONE)):
        found = f"transform(filter({_spans('text', pattern)}, x -> {CHECKS[kind]}), x -> named_struct('s', x.s, 'e', x.e, 'kind', '{kind}'))"
        docs = docs.withColumn(kind, F.expr(f"CASE WHEN {MAY[kind]} THEN {found} ELSE {EMPTY} END"))
    return docs


def _overlaps(spans: str) -> str:
    """SQL: whether x overlaps one of `spans`, which are in order and apart; the last that starts before x ends is found by halving."""
    middle = "(r.low + r.high) DIV 2"
    step = f"IF(r.low >= r.high, r, IF({spans}[{middle}].s < x.e, named_struct('low', {middle} + 1, 'high', r.high), named_struct('low', r.low, 'high', {middle})))"
    n = f"CAST(size({spans}) AS BIGINT)"
    return f"coalesce(aggregate(sequence(0, CAST(ceil(log2({n} + 1)) AS INT)), named_struct('low', 0L, 'high', {n}), (r, _) -> {step}, r -> IF(r.low > 0, {spans}[r.low - 1].e > x.s, false)), false)"


def _with_candidates(docs: DataFrame) -> DataFrame:
    """Adds `more`: candidates that overlap no base span, with their votes and features."""
    free = " AND ".join(f"NOT {_overlaps(k)}" for k in KINDS)
    found = f"CASE WHEN text RLIKE r'{CANDIDATE}' THEN filter({_spans('text', CANDIDATE)}, x -> {free}) ELSE {NO_MATCH} END"
    kind = "CASE WHEN x.m RLIKE '^(Mr|Mrs|Ms|Dr|Prof)[.]? ' THEN 'person' WHEN x.m RLIKE '^[(]?[0-9]{2,4}[)]?[ .-]' THEN 'number' ELSE 'key' END"
    regex = "CASE WHEN x.m RLIKE '^([(]?[0-9]{3}[)]?[ .-][0-9]{3}[.-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{4})$' OR x.m RLIKE '^(Mr|Mrs|Ms|Dr|Prof)[.]? [A-Z][a-z]+ [A-Z][a-z]+$' OR (length(x.m) >= 20 AND x.m RLIKE '[0-9].*[0-9].*[0-9]' AND x.m RLIKE '[A-Za-z]' AND NOT x.m RLIKE '-.*-') THEN 1 WHEN x.m RLIKE '^[0-9]{4}[.-][0-9]{2}[.-][0-9]{2}$' OR x.m RLIKE '^[0-9a-f]{40}$' THEN -1 ELSE 0 END"
    gazetteer = f"CASE WHEN x.m RLIKE '({GIVEN_NAMES})' OR x.m RLIKE '^({KEY_PREFIXES})[_-]?' THEN 1 WHEN x.m RLIKE '^(19|20)[0-9]{{2}}[ .-]' THEN -1 ELSE 0 END"
    context = f"CASE WHEN x.before RLIKE '(?i)({CUES})[^A-Za-z0-9]{{0,3}}( is| no| number)?[^A-Za-z0-9]{{0,3}}$' THEN 1 WHEN x.before RLIKE '(?i)({ANTI_CUES})[^A-Za-z0-9]{{0,3}}$' THEN -1 ELSE 0 END"
    features = f"""array(
      concat('k', {kind}), concat('k', {kind}, ':n', least(length(x.m) div 4, 12)),
      concat('k', {kind}, ':d', least(length({_digits('x.m')}) div 3, 8)),
      concat('p', CASE WHEN x.before = '' THEN '^' WHEN x.before RLIKE '[:=]\\\\s*$' THEN ':' WHEN x.before RLIKE '[A-Za-z,]\\\\s$' THEN 'w' WHEN x.before RLIKE '\\\\n$' THEN 'l' ELSE 'o' END),
      concat('c', x.m RLIKE '[A-Z]', x.m RLIKE '[a-z]', x.m RLIKE '[_-]', x.m RLIKE '[(]'))"""
    return docs.withColumn("more", F.expr(f"transform({found}, x -> named_struct('s', x.s, 'e', x.e, 'kind', {kind}, 'votes', array({regex}, {gazetteer}, {context}), 'features', {features}))"))


def reliabilities(patterns: dict[tuple, int], rounds: int = ROUNDS) -> tuple[dict[tuple, float], dict]:
    """Expectation-maximisation over counts of (kind, votes): a posterior for each, and the model.

    Each labeler has a distribution over its three votes given either truth; each kind has its
    share of true spans. It starts from votes that are right rather than wrong.
    """
    kinds = sorted({k for k, _ in patterns})
    share = dict.fromkeys(kinds, 0.5)
    cast = {(j, z): {1: 0.5 if z else 0.1, 0: 0.4, -1: 0.1 if z else 0.5} for j in range(len(LABELERS)) for z in (0, 1)}
    posterior: dict[tuple, float] = {}
    for _ in range(rounds):
        for kind, votes in patterns:
            odds = math.log(share[kind] / (1 - share[kind])) + sum(math.log(cast[j, 1][v] / cast[j, 0][v]) for j, v in enumerate(votes))
            posterior[kind, votes] = 1 / (1 + math.exp(-odds))
        for kind in kinds:
            n = sum(c for (k, _), c in patterns.items() if k == kind)
            share[kind] = (1 + sum(c * posterior[k, v] for (k, v), c in patterns.items() if k == kind)) / (2 + n)
        for (j, z), now in cast.items():
            total = {v: 1.0 + (4.0 if v == (1 if z else -1) else 0.0) for v in (1, 0, -1)}
            for (k, votes), c in patterns.items():
                total[votes[j]] += c * (posterior[k, votes] if z else 1 - posterior[k, votes])
            now |= {v: t / sum(total.values()) for v, t in total.items()}
    return posterior, {"share": share, "cast": cast}


def learn(docs: DataFrame) -> dict[str, float]:
    """Weights of the final classifier by feature, '' for the prior, from all candidates in the column `more`.

    One pass counts candidates by kind, votes and features; the counts are all that is collected.
    """
    rows = docs.select(F.explode("more").alias("x")).groupBy("x.kind", "x.votes", "x.features").count().collect()
    patterns: dict[tuple, int] = defaultdict(int)
    for r in rows:
        patterns[r.kind, tuple(r.votes)] += r["count"]
    posterior, _ = reliabilities(patterns)
    good, bad = defaultdict(lambda: 0.5), defaultdict(lambda: 0.5)
    for r in rows:
        p = posterior[r.kind, tuple(r.votes)]
        for f in ("", *r.features):
            good[f] += r["count"] * p
            bad[f] += r["count"] * (1 - p)
    prior = math.log(good[""] / bad[""])
    return {"": prior} | {f: math.log(good[f] / bad[f]) - prior for f in sorted(good) if f}


def find(docs: DataFrame, text: str = "text", threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """`docs` (or its columns `keep`) with `pii`, an array<struct<s, e, kind>> of base and added spans sorted by start, then kind.

    s and e are code points, e exclusive. A null text counts as empty. Rows stay as they are;
    a column `pii` is replaced, however its name is cased, and no other name clashes, since the
    row travels as one struct. Texts without candidates teach nothing; with none at all, nothing is
    added. Spans are found once and written, with the columns that stay, to the checkpoint folder.
    """
    rows = docs.drop("pii")
    names = [c for c in keep or rows.columns]
    apart = rows.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = written(_with_candidates(base_spans(apart)).select("row", F.concat(*KINDS).alias("base"), "more"))
    weights = learn(found)
    scores = ", ".join(f"'{f}', {w!r}D" for f, w in weights.items() if f) or "'', 0.0D"
    odds = f"{weights['']!r}D + aggregate(x.features, 0.0D, (a, f) -> a + coalesce(try_element_at(map({scores}), f), 0.0D))"
    added = F.expr(f"transform(filter(more, x -> {odds} > {math.log(threshold / (1 - threshold))!r}D), x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind))")
    order = "array('email', 'ip', 'card', 'phone', 'key', 'number', 'person')"
    ranked = F.expr(f"transform(array_sort(transform(spans, x -> named_struct('s', x.s, 'k', array_position({order}, x.kind), 'e', x.e, 'kind', x.kind))), x -> named_struct('s', x.s, 'e', x.e, 'kind', x.kind))")
    return found.withColumn("spans", F.concat("base", added)).select("row", ranked.alias("pii")).select("row.*", "pii")


def _listed(spans: str) -> Column:
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.s, ':', x.e)), ',')")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, counts of the base kinds, a digest of the base spans, all spans."""
    out = find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"]).withColumn("base", F.expr(f"filter(pii, x -> x.kind IN {KINDS})"))
    counts = [F.expr(f"size(filter(base, x -> x.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("pii").alias("spans"))
