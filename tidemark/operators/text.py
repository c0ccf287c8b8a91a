"""Policy texts: lexicon scores that stay in the JVM, and HTML cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import align

#: The two lexicons; single words also count with s, d, ed or ing.
HAWKISH = (
    "hawkish", "hike", "tighten", "tightening", "restrictive", "raise", "raising", "rate increase", "rate increases", "higher rates", "above target", "persistent inflation", "elevated inflation",
    "inflationary pressure", "inflationary pressures", "overheating", "anchor expectations", "anchored expectations", "withdraw accommodation", "remove accommodation", "policy firming", "firmer policy",
    "upside risk", "upside risks", "stronger than expected", "robust growth", "tight labor market", "wage pressure",
)
DOVISH = (
    "dovish", "accommodative", "accommodation", "ease", "easing", "cut", "cuts", "lower rates", "lowering rates", "rate cut", "rate cuts", "soften", "softening", "moderate", "moderating", "disinflation",
    "disinflationary", "below target", "patient", "patience", "stimulus", "stimulative", "support the economy", "supportive policy", "downside risk", "downside risks", "weaker than expected", "slack",
    "labor market slack", "unemployment elevated",
)


def pattern(terms: tuple[str, ...]) -> str:
    return "(?i)" + "|".join(rf"\b{t}\b" if " " in t else rf"\b{t}(?:s|d|ed|ing)?\b" for t in terms)


def lexicon_scores(docs: DataFrame, text: str = "text", up: tuple = HAWKISH, down: tuple = DOVISH) -> DataFrame:
    """Adds hawkish_count, dovish_count, total_tokens and net_score (null without a hit)."""
    t = F.coalesce(F.col(text), F.lit(""))
    counts = {name: F.regexp_count(t, F.lit(p)).cast("long") for name, p in (("hawkish_count", pattern(up)), ("dovish_count", pattern(down)), ("total_tokens", r"\S+"))}
    hits = F.col("hawkish_count") + F.col("dovish_count")
    return docs.withColumns(counts).withColumn("net_score", (F.col("hawkish_count") - F.col("dovish_count")) / F.nullif(hits, F.lit(0)))


def one_a_date(scores: DataFrame, date: str = "release_date", how: str = "longest", priority: Column | None = None) -> DataFrame:
    """One row for each date: the longest text, the one with the smallest priority, or the mean weighted by tokens."""
    if how == "weighted":
        known = F.when(F.col("net_score").isNotNull(), F.col("total_tokens"))
        return scores.groupBy(date).agg((F.sum(F.col("net_score") * known) / F.nullif(F.sum(known), F.lit(0))).alias("net_score"), F.sum("total_tokens").alias("total_tokens"))
    first = [F.desc("total_tokens")] if how == "longest" else [priority.asc(), F.desc("total_tokens")]
    w = Window.partitionBy(date).orderBy(*first, F.desc("net_score"))
    return scores.withColumn("_k", F.row_number().over(w)).where("_k = 1").select(date, "net_score", "total_tokens")


def pooled(scores: DataFrame, *groups: str) -> DataFrame:
    """Per group: texts, hawkish_count, dovish_count, total_tokens and the net score of all its hits together (null without a hit)."""
    out = scores.groupBy(*groups).agg(F.count("*").alias("texts"), *(F.sum(c).alias(c) for c in ("hawkish_count", "dovish_count", "total_tokens")))
    return out.withColumn("net_score", (F.col("hawkish_count") - F.col("dovish_count")) / F.nullif(F.col("hawkish_count") + F.col("dovish_count"), F.lit(0)))


def daily_score(sessions: DataFrame, scores: DataFrame, max_age: int, window: int = 30) -> DataFrame:
    """(session, pos, score): the mean over the last `window` sessions of the last score on or before each, null where it is over `max_age` days old.

    sessions: (session, pos), one market's; scores: (release_date, net_score), one a date; null scores are none.
    """
    one = scores.where("net_score IS NOT NULL").select(F.lit("m").alias("series_id"), F.col("release_date").alias("at"), F.col("release_date").alias("seen"), "net_score")
    rows = align.as_of(sessions.withColumn("series_id", F.lit("m")), one, "at", ["seen", "net_score"], ["series_id"])
    fresh = F.when(F.datediff("session", "seen") <= max_age, F.col("net_score"))
    return rows.select("session", "pos", F.avg(fresh).over(Window.orderBy("pos").rowsBetween(-(window - 1), 0)).alias("score"))


def cleaned_html(html: Column) -> Column:
    """Text of an HTML page: scripts and styles dropped, breaks and paragraphs as newlines, tags removed, blanks collapsed."""
    out = F.regexp_replace(html, r"(?is)<(script|style|sup)\b.*?</\1>", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</p>", "\n")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"[ \t\r]+", " "), r" ?\n[ \n]*", "\n"))
