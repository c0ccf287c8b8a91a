"""Queries of pooled and daily text scores, and of exposures, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evaluate, families, text
from tidemark.plans.label_queries import FEATURES_SQL, features
from tidemark.sources import panel
from tidemark.sources.panel import ctes, table

QUERIES, ORACLE = {}, {}
C = F.col


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


#: Words that stand in the given texts, in place of the lexicons.
UP, DOWN = ("the", "that", "with"), ("and", "und", "le", "of the")


def _counts(names: str, source: str) -> str:
    plain = r"regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', 'x', 'g')"
    return rf"SELECT {names}, len(regexp_extract_all({plain}, '{text.pattern(UP)}')) AS h, len(regexp_extract_all({plain}, '{text.pattern(DOWN)}')) AS d, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS t FROM {source}"


def _scores(spark, sf, name: str):
    return text.lexicon_scores(table(spark, sf, name), up=UP, down=DOWN)


_POOLED = "count(*) AS texts, CAST(sum(h) AS BIGINT) AS hawkish_count, CAST(sum(d) AS BIGINT) AS dovish_count, CAST(sum(t) AS BIGINT) AS total_tokens, round((sum(h) - sum(d)) / nullif(sum(h) + sum(d), 0), 6) AS net_score"


@query("m02_combined_scores", f"WITH s AS ({_counts(chr(39) + 'documents' + chr(39) + ' AS source', 'documents')} UNION ALL {_counts(chr(39) + 'conversations' + chr(39), 'conversations')}) SELECT source, {_POOLED} FROM s GROUP BY 1")
def m02(spark, sf):
    columns = ("hawkish_count", "dovish_count", "total_tokens")
    stores = {name: _scores(spark, sf, name).select(*columns) for name in ("documents", "conversations")}
    return text.pooled(families.consolidated(stores), "source").withColumn("net_score", F.round("net_score", 6))


@query("m06_pooled_scores", f"WITH s AS ({_counts('source, lang', 'documents')}), p AS (SELECT source, {_POOLED} FROM s GROUP BY 1), c AS (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS k FROM s WHERE lang IS NOT NULL GROUP BY 1, 2) SELECT p.*, c.lang AS label FROM p LEFT JOIN c ON p.source IS NOT DISTINCT FROM c.source AND c.k = 1")
def m06(spark, sf):
    scores = _scores(spark, sf, "documents")
    modal = scores.where("lang IS NOT NULL").groupBy("source", "lang").agg(F.count("*").alias("n")).groupBy("source").agg(F.min_by("lang", F.struct(-C("n"), "lang")).alias("label"))
    pooled = text.pooled(scores, "source").withColumn("net_score", F.round("net_score", 6))
    return pooled.join(modal.withColumnRenamed("source", "of"), C("source").eqNullSafe(C("of")), "left").drop("of")


@query("m04_daily_score", f"""{ctes('sessions')}, s AS ({_counts("DATE '1994-01-01' + CAST(doc_id % 1500 AS INT) AS release_date", 'documents')}),
k AS (SELECT release_date, t, (h - d) / nullif(h + d, 0) AS net FROM s), one AS (SELECT release_date, sum(net * t) / nullif(sum(CASE WHEN net IS NOT NULL THEN t END), 0) AS score FROM k GROUP BY 1),
a AS (SELECT s.session, s.pos, CASE WHEN s.session - o.release_date <= 4 THEN o.score END AS score FROM sessions s ASOF LEFT JOIN (SELECT * FROM one WHERE score IS NOT NULL) o ON s.session >= o.release_date)
SELECT session, round(avg(score) OVER (ORDER BY pos ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 6) AS score FROM a""")
def m04(spark, sf):
    dated = _scores(spark, sf, "documents").withColumn("release_date", F.date_add(F.lit("1994-01-01").cast("date"), (C("doc_id") % 1500).cast("int")))
    out = text.daily_score(panel.sessions(spark, sf), text.one_a_date(dated, how="weighted"), 4)
    return out.select("session", F.round("score", 6).alias("score"))


@query("n16_false_switch_rate", f"""{FEATURES_SQL}, x AS (SELECT series_id, pos, CASE WHEN close > sma50 THEN '1' ELSE '0' END AS e FROM f), s AS (SELECT series_id, e, lag(e) OVER w AS b, lead(e, 1) OVER w AS a1, lead(e, 2) OVER w AS a2, lead(e, 3) OVER w AS a3 FROM x WINDOW w AS (PARTITION BY series_id ORDER BY pos))
SELECT series_id, coalesce(count(*) FILTER (e <> b AND (a1 = b OR a2 = b OR a3 = b)) / nullif(count(*) FILTER (e <> b), 0), 0.0) AS rate FROM s GROUP BY 1""")
def n16(spark, sf):
    rows = features(spark, sf).withColumn("exposure", F.when(C("close") > C("sma50"), 1).otherwise(0))
    return evaluate.false_switch_rate(rows)
