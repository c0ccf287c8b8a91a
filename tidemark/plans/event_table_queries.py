"""Queries of corroboration, promotion and tables with varying headers, each with SQL written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import calendar, event_tables
from tidemark.sources.panel import table

QUERIES, ORACLE = {}, {}
C = F.col


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


#: Sources of `documents` stand for issuers, its languages for kinds; words that are common in its texts for the terms of decisions.
ISSUERS = {"signup": ("src1", "src7"), "purchase": ("src2",), "view": ("src0",)}
YES, NO = ("that", "para", "einer", "dans"), ("copyright", "license")


def _candidates(spark, sf):
    day = F.date_add(F.lit("2000-01-01").cast("date"), (C("event_id") % 997).cast("int"))
    return table(spark, sf, "events").select(C("event_type").alias("type"), day.alias("date")).distinct()


def _documents(spark, sf):
    day = F.date_add(F.lit("2000-01-01").cast("date"), ((C("doc_id") * 7) % 1009).cast("int"))
    return table(spark, sf, "documents").select(C("doc_id").alias("id"), C("source").alias("issuer"), C("lang").alias("kind"), C("text").alias("title"), day.alias("date"))


def _has(x: str, terms) -> str:
    return "(" + " OR ".join(f"contains({x}, '{t}')" for t in terms) + ")"


@query("g20_corroboration", f"""WITH d AS (SELECT doc_id AS id, lower(coalesce(source, '')) AS issuer, lower(coalesce(lang, '') || ' ' || coalesce(text, '')) AS kind, DATE '2000-01-01' + CAST((doc_id * 7) % 1009 AS INT) AS date FROM documents WHERE doc_id IS NOT NULL),
k AS (SELECT id, issuer, date FROM d WHERE {_has('kind', YES)} AND NOT {_has('kind', NO)}),
t AS ({' UNION ALL '.join(f"SELECT '{name}' AS type, date, id FROM k WHERE {_has('issuer', terms)}" for name, terms in ISSUERS.items())}),
c AS (SELECT DISTINCT event_type AS type, DATE '2000-01-01' + CAST(event_id % 997 AS INT) AS date FROM events WHERE event_type IN ({', '.join(f"'{x}'" for x in ISSUERS)})),
m AS (SELECT c.type, c.date, min(t.id) FILTER (t.date = c.date) AS same, min(t.id) AS near FROM c LEFT JOIN t ON t.type = c.type AND t.date BETWEEN c.date - 1 AND c.date + 1 GROUP BY 1, 2)
SELECT type, date, CASE WHEN same IS NOT NULL THEN 'confirm' WHEN near IS NOT NULL THEN 'contradict' ELSE 'unknown' END AS verdict, coalesce(same, near) AS evidence_id FROM m""")
def g20(spark, sf):
    found = event_tables.decision_documents(_documents(spark, sf), ISSUERS, YES, NO)
    return event_tables.corroborated(_candidates(spark, sf), found, 1, tuple(ISSUERS)).select("type", "date", "verdict", "evidence_id")


def _promotion(spark, sf):
    """Candidates, decisions and approvals from orders, of which several share a (priority, date)."""
    o = table(spark, sf, "orders").select(C("o_orderpriority").alias("type"), F.to_date("o_orderdate").alias("date"), C("o_orderkey").alias("id"), (C("o_orderkey") % 13).alias("at"), "o_custkey", "o_orderstatus", "o_totalprice")
    release = F.when(C("id") % 5 != 0, C("date").cast("timestamp_ntz") + F.expr("make_dt_interval(0, 8, 30, 0)"))
    candidates = o.select("type", "date", "id", "at", F.lit("US").alias("market"), F.when(C("id") % 2 == 0, "high").otherwise("medium").alias("importance"), C("o_orderstatus").alias("source"), (C("id") % 4).alias("window_days"), release.alias("release"))
    decisions = o.select("type", "date", "id", (C("o_custkey") % 7).alias("at"), F.when(C("o_totalprice") > 20000, "promote").otherwise("quarantine").alias("outcome"))
    importance = F.when(C("id") % 3 == 0, "critical").when(C("id") % 3 == 1, "")
    approvals = o.where("id % 2 = 1").select("type", "date", "id", F.when(C("id") % 11 != 0, C("o_custkey") % 5).alias("at"), importance.alias("importance"), F.when(C("id") % 4 == 1, C("id") % 9).alias("window_days"), C("o_orderstatus").alias("label"))
    return candidates, decisions, approvals


@query("g14_promoted_events", """WITH o AS (SELECT o_orderpriority AS type, CAST(o_orderdate AS DATE) AS date, o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice FROM orders),
c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type, date ORDER BY id % 13 DESC, id DESC) AS k FROM o) WHERE k = 1),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type, date ORDER BY o_custkey % 7 DESC, id DESC) AS k FROM o) WHERE k = 1 AND o_totalprice > 20000),
a AS (SELECT * FROM (SELECT type, date, id, CASE WHEN id % 3 = 0 THEN 'critical' END AS importance, CASE WHEN id % 4 = 1 THEN id % 9 END AS window_days, o_orderstatus AS label, row_number() OVER (PARTITION BY type, date ORDER BY CASE WHEN id % 11 <> 0 THEN o_custkey % 5 END DESC NULLS LAST, id DESC) AS k FROM o WHERE id % 2 = 1) WHERE k = 1)
SELECT c.type, c.date, strftime(CAST(c.date AS TIMESTAMP) + CASE WHEN c.id % 5 <> 0 THEN INTERVAL 510 MINUTE ELSE INTERVAL 0 MINUTE END, '%Y-%m-%d %H:%M') AS release, 'US' AS market, coalesce(a.importance, CASE WHEN c.id % 2 = 0 THEN 'high' ELSE 'medium' END) AS importance,
  c.o_orderstatus AS source, coalesce(a.window_days, c.id % 4) AS window_days, a.label AS approved_label, CASE WHEN a.importance IS NOT NULL THEN 'approval' ELSE 'candidate' END AS importance_from, CASE WHEN a.window_days IS NOT NULL THEN 'approval' ELSE 'candidate' END AS window_from
FROM c JOIN d USING (type, date) LEFT JOIN a USING (type, date)""")
def g14(spark, sf):
    return event_tables.promoted(*_promotion(spark, sf)).withColumn("release", F.date_format("release", "yyyy-MM-dd HH:mm"))


@query("g24_index_table", """SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_totalprice AS DOUBLE) AS value, CAST(o_custkey AS DOUBLE) AS act, CAST(NULL AS DOUBLE) AS ma7, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey % 50 AS DOUBLE) END AS article_count, coalesce(CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END, '') AS event,
  CASE WHEN o_orderkey % 9 = 0 THEN 'article_count' ELSE '' END AS bad FROM orders WHERE o_orderkey % 17 <> 0""")
def g24(spark, sf):
    o = table(spark, sf, "orders")
    raw = o.select(
        F.to_date("o_orderdate").cast("string").alias("Day"), F.when(C("o_orderkey") % 17 != 0, C("o_totalprice").cast("string")).otherwise("n/a").alias(" GPRD"), C("o_custkey").cast("string").alias("Gprd_Act "),
        F.when(C("o_orderkey") % 9 == 0, "many").otherwise((C("o_orderkey") % 50).cast("string")).alias("ARTICLES"), F.when(C("o_orderkey") % 4 > 0, C("o_orderstatus")).alias("Event"),
    )
    return event_tables.index_table(raw).select("date", "value", "act", "ma7", "article_count", "event", F.array_join("bad", ",").alias("bad"))


@query("g18_volume_table", f"SELECT CAST(ts AS DATE) AS date, event_type AS kind, count(*) FILTER (value > 100) AS event_count, '{event_tables.THEME}' AS dominant_theme FROM events GROUP BY 1, 2 HAVING count(*) FILTER (value > 100) > 0")
def g18(spark, sf):
    raw = table(spark, sf, "events").groupBy(F.to_date("ts").alias("DATE"), C("event_type").alias("Source_URL")).agg(F.count_if(C("value") > 100).alias(" Count "))
    return event_tables.volume_table(raw).select("date", C("source_url").alias("kind"), "event_count", "dominant_theme")


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("g25_monthly_context", """WITH m AS (SELECT date_trunc('month', o_orderdate) AS month, o_orderpriority AS p, round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE -o_totalprice END), 4) AS v FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY month ORDER BY v DESC, p) AS k FROM m WHERE v > 0),
t AS (SELECT month, 'monthly_country_gpr=' || string_agg(substr(p, 1, 1) || ':' || printf('%.2f', v), ',' ORDER BY k) AS context FROM r WHERE k <= 3 GROUP BY 1)
SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, context FROM orders JOIN t ON date_trunc('month', o_orderdate) = t.month""")
def g25(spark, sf):
    o = table(spark, sf, "orders")
    signed = F.when(C("o_orderstatus") == "O", C("o_totalprice")).otherwise(-C("o_totalprice"))
    wide = o.groupBy(F.trunc("o_orderdate", "MM").cast("string").alias("Month")).agg(*(F.round(F.sum(F.when(C("o_orderpriority") == p, signed)), 4).alias(f"GPRC_{p[0]}") for p in PRIORITIES), F.lit("1").alias("GPRHC_X"))
    long = event_tables.prefixed_long(wide, "GPRC_", {"month": ("month", "date")})
    return event_tables.monthly_context(o.select(F.to_date("o_orderdate").alias("date")), long)


_TYPES = "CASE event_type WHEN 'signup' THEN 'FOMC' WHEN 'purchase' THEN 'CPI' WHEN 'view' THEN 'ECB_decision' WHEN 'click' THEN 'geopolitical_event' ELSE 'other' END"


@query("g07_event_labels", f"""WITH e AS (SELECT event_id, {_TYPES} AS type, CASE WHEN user_id % 3 = 0 THEN 'geopolitical_event' WHEN user_id % 3 = 1 THEN 'fed_week' END AS approved FROM events),
k AS (SELECT event_id, type, CASE type WHEN 'FOMC' THEN 'fed_week' WHEN 'CPI' THEN 'cpi_week' WHEN 'ECB_decision' THEN 'global_rate_decision' WHEN 'geopolitical_event' THEN CASE WHEN approved = 'geopolitical_event' THEN 'geopolitical_event' END END AS label FROM e)
SELECT event_id, label, type IN ('FOMC', 'CPI') AS first_version FROM k WHERE label IS NOT NULL""")
def g07(spark, sf):
    """Labels of events with all types, and whether the first types alone would give them too."""
    approved = F.when(C("user_id") % 3 == 0, "geopolitical_event").when(C("user_id") % 3 == 1, "fed_week")
    e = table(spark, sf, "events").select("event_id", F.expr(_TYPES).alias("type"), approved.alias("approved_label"))
    first = calendar.labelled(e, later_types=False).select("event_id", F.lit(True).alias("first"))
    return calendar.labelled(e).join(first, "event_id", "left").select("event_id", "label", F.coalesce("first", F.lit(False)).alias("first_version"))


@query("g13_candidate_ids", """WITH c AS (SELECT event_type AS type, CAST(ts AS DATE) AS date, list_sort(list_distinct(list(CAST(user_id % 5 AS VARCHAR)))) AS sources FROM events GROUP BY 1, 2)
SELECT type, date, substr(sha256(type || '|' || CAST(date AS VARCHAR) || '|' || array_to_string(sources, '|')), 1, 16) AS candidate_id FROM c""")
def g13(spark, sf):
    rows = table(spark, sf, "events").groupBy(C("event_type").alias("type"), F.to_date("ts").alias("date")).agg(F.collect_set((C("user_id") % 5).cast("string")).alias("sources"))
    return rows.select("type", "date", calendar.candidate_id("type", "date", "sources").alias("candidate_id"))
