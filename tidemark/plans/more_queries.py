"""Queries of further feature families, calendars, merges and reports, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rolling as R
from tidemark.operators import align, calendar, contracts, families, rules
from tidemark.plans.label_queries import FEATURES_SQL, _labels, features, labels
from tidemark.plans.rolling_queries import _full
from tidemark.sources import panel, readers
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


_HOLD = "min(close) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING)"


@query("c24_follow_through", f"""{ctes('bars')}, t AS (SELECT *, {_full('max(close)', 20, 'close', 1)} AS top20, {_full('max(close)', 50, 'close', 1)} AS top50, {_HOLD} AS low5, count(*) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING) AS ahead FROM bars),
b AS (SELECT series_id, pos + 5 AS resolved, CASE WHEN low5 > CASE WHEN close > top20 THEN top20 ELSE top50 END THEN 1.0 ELSE 0.0 END AS held FROM t WHERE ahead = 5 AND (close > top20 OR close > top50)),
r AS (SELECT *, sum(held) OVER w AS held20, count(*) OVER w AS n, min(resolved) OVER w AS oldest FROM b WINDOW w AS (PARTITION BY series_id ORDER BY resolved ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT x.series_id, x.session, round(CASE WHEN r.n = 20 AND x.pos - r.oldest < 504 THEN r.held20 / 20 END, 6) AS rate FROM bars x ASOF LEFT JOIN r ON x.series_id = r.series_id AND x.pos >= r.resolved""")
def c24(spark, sf):
    return families.follow_through(panel.bars_anchor(spark, sf)).select("series_id", "session", F.round("rate", 6).alias("rate"))


@query("c15_hurst")
def c15(spark, sf):
    return families.hurst(panel.bars_anchor(spark, sf), 60).select("series_id", "session", F.round("hurst", 5).alias("hurst"))


@query("d03_concordance", f"{FEATURES_SQL} SELECT series_id, session, CAST(CASE WHEN ret5 IS NULL OR ret21 IS NULL THEN NULL WHEN sign(ret5) = sign(ret21) AND ret5 <> 0 THEN 1 WHEN sign(ret5) = -sign(ret21) AND ret5 <> 0 THEN -1 ELSE 0 END AS INT) AS concordance FROM f")
def d03(spark, sf):
    return features(spark, sf).select("series_id", "session", families.concordance(C("ret5"), C("ret21")).alias("concordance"))


_PAIR = f"{ctes('bars')}, p AS (SELECT a.session, a.close / b.close AS ratio, a.close FROM bars a JOIN bars b ON a.session = b.session AND b.series_id = 'N' WHERE a.series_id = 'A')"
_O = "OVER (ORDER BY session ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


@query("d07_proxy_breadth", f"{_PAIR} SELECT session, round(ratio, 6) AS ratio, round(CASE WHEN count(ratio) {_O.format(49)} = 50 THEN avg(ratio) {_O.format(49)} END, 6) AS ratio_sma, round(ratio / nullif(lag(ratio, 20) OVER (ORDER BY session), 0) - 1, 6) AS ratio_ret, round(CASE WHEN count(close) {_O.format(62)} >= 50 THEN close / max(close) {_O.format(62)} - 1 END, 6) AS from_high FROM p")
def d07(spark, sf):
    bars = panel.bars_anchor(spark, sf)
    out = families.proxy_breadth(bars.where("series_id = 'A'"), bars.where("series_id = 'N'"))
    return out.select("session", *(F.round(c, 6).alias(c) for c in ("ratio", "ratio_sma", "ratio_ret", "from_high")))


@query("d09_change_zscores", f"""{FEATURES_SQL}, c AS (SELECT series_id, session, pos, last_value(CASE WHEN pos % 5 <> 0 THEN close END IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY session ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS x0 FROM f),
d AS (SELECT *, x0 - lag(x0, 21) OVER (PARTITION BY series_id ORDER BY session) AS x FROM c) SELECT series_id, session, round((x - {_full('avg(x)', 126)}) / nullif({_full('stddev_samp(x)', 126)}, 0), 5) AS z FROM d""")
def d09(spark, sf):
    bars = panel.bars_anchor(spark, sf).withColumn("x", F.when(C("pos") % 5 != 0, C("close")))
    return families.pressure(bars, "x", 21, 126).select("series_id", "session", F.round("z", 5).alias("z"))


@query("d12_surprise", f"{FEATURES_SQL} SELECT series_id, session, round((ret21 - ret5) / nullif({_full('stddev_samp(ret21 - ret5)', 126, 'ret21 - ret5')}, 0), 5) AS z FROM f")
def d12(spark, sf):
    return families.surprise(features(spark, sf), "ret21", "ret5", 126).select("series_id", "session", F.round("z", 5).alias("z"))


_WEEKLY = "w AS (SELECT 's' AS series_id, published AS publication_date, avg(value) / 7 AS v FROM macro WHERE vintage = 0 GROUP BY 1, 2)"


@query("d13_weekly_sentiment", f"""{ctes('sessions', 'macro')}, {_WEEKLY}, o AS (SELECT *, row_number() OVER (ORDER BY publication_date) AS k FROM w)
SELECT s.session, round(CASE WHEN k >= 4 AND s.session - publication_date <= 56 THEN v END, 4) AS score FROM sessions s ASOF LEFT JOIN o ON s.session >= o.publication_date""")
def d13(spark, sf):
    weekly = panel.macro(spark, sf).where("vintage = 0").groupBy(C("published").alias("publication_date")).agg((F.avg("value") / 7).alias("v"))
    return families.weekly_to_sessions(panel.sessions(spark, sf), weekly, "v", 4, 56).select("session", F.round("v", 4).alias("score"))


@query("d16_availability", "SELECT p_name || ' ' || p_partkey AS feature, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_shipdate >= DATE '1998-06-01') AS available FROM part")
def d16(spark, sf):
    wanted = table(spark, sf, "part").select(F.concat_ws(" ", "p_name", "p_partkey").alias("feature"), C("p_partkey").alias("input"))
    present = table(spark, sf, "lineitem").where("l_shipdate >= DATE '1998-06-01'").select(C("l_partkey").alias("input"))
    return families.availability(wanted, present).select("feature", "available")


@query("b15_lookup_enrichment", "SELECT o_orderkey, c_name, n_name, coalesce(r_name, 'none') AS region FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def b15(spark, sf):
    out = table(spark, sf, "orders").join(table(spark, sf, "customer"), C("o_custkey") == C("c_custkey"), "left").join(table(spark, sf, "nation"), C("c_nationkey") == C("n_nationkey"), "left")
    return out.join(table(spark, sf, "region"), C("n_regionkey") == C("r_regionkey"), "left").select("o_orderkey", "c_name", "n_name", F.coalesce("r_name", F.lit("none")).alias("region"))


@query("b16_nested_fields", "SELECT event_id, CAST(json_extract_string(props, '$.ref') AS VARCHAR) AS ref FROM events")
def b16(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.ref").alias("ref"))


@query("b19_vintage_dates", f"{ctes('macro')} SELECT DISTINCT series_id, d AS date FROM (SELECT series_id, obs_date AS d FROM macro UNION ALL SELECT series_id, published FROM macro)")
def b19(spark, sf):
    m = panel.macro(spark, sf)
    return m.select("series_id", C("obs_date").alias("date")).union(m.select("series_id", "published")).distinct()


@query("e04_advance_decline", f"{ctes('members')}, c AS (SELECT session, close - lag(close) OVER (PARTITION BY series_id ORDER BY session) AS d FROM members), n AS (SELECT session, count(*) FILTER (d > 0) - count(*) FILTER (d < 0) AS net FROM c GROUP BY 1) SELECT session, net, CAST(sum(net) OVER (ORDER BY session) AS BIGINT) AS line FROM n")
def e04(spark, sf):
    change = C("close") - R.lag(C("close"), 1)
    net = panel.bars_member(spark, sf).withColumn("d", change).groupBy("session").agg((F.count_if(C("d") > 0) - F.count_if(C("d") < 0)).alias("net"))
    return net.withColumn("line", F.sum("net").over(Window.orderBy("session").rowsBetween(Window.unboundedPreceding, 0)))


@query("e06_up_volume", f"{ctes('members')}, c AS (SELECT session, volume, close - lag(close) OVER (PARTITION BY series_id ORDER BY session) AS d FROM members) SELECT session, round(sum(volume) FILTER (d > 0) / nullif(sum(volume) FILTER (d <> 0), 0), 6) AS up_share FROM c GROUP BY 1")
def e06(spark, sf):
    out = panel.bars_member(spark, sf).withColumn("d", C("close") - R.lag(C("close"), 1)).groupBy("session")
    return out.agg(F.round(F.sum(F.when(C("d") > 0, C("volume"))) / F.nullif(F.sum(F.when(C("d") != 0, C("volume"))), F.lit(0)), 6).alias("up_share"))


@query("g16_export_aggregation", "SELECT CAST(ts AS DATE) AS date, sum(coalesce(user_id, 1)) AS mentions, arg_min(event_id, event_id) AS first_id FROM events WHERE event_type IN ('click', 'error') GROUP BY 1")
def g16(spark, sf):
    rows = table(spark, sf, "events").where("event_type IN ('click', 'error')")
    return rows.groupBy(F.to_date("ts").alias("date")).agg(F.sum(F.coalesce("user_id", F.lit(1))).alias("mentions"), F.min_by("event_id", "event_id").alias("first_id"))


@query("g17_top_columns", "WITH u AS (SELECT p_partkey, name, value, row_number() OVER (PARTITION BY p_partkey ORDER BY value DESC, name) AS k FROM (SELECT p_partkey, 'size' AS name, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part UNION ALL SELECT p_partkey, 'key', CAST(p_partkey AS DOUBLE) FROM part) WHERE value > 0) SELECT p_partkey, array_to_string(list(name ORDER BY k), ',') AS top FROM u WHERE k <= 2 GROUP BY 1")
def g17(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", C("p_size").cast("double").alias("size"), C("p_retailprice").alias("price"), C("p_partkey").cast("double").alias("key"))
    return families.top_columns(rows, "p_partkey", ["size", "price", "key"], 2)


@query("g19_daily_conflicts", "SELECT CAST(ts AS DATE) AS date, count(*) AS n, round(sum(value), 4) AS total, count(DISTINCT event_type) AS types, array_to_string(list_sort(list_distinct(list(event_type)))[1:3], ',') AS first_types FROM events GROUP BY 1")
def g19(spark, sf):
    out = table(spark, sf, "events").groupBy(F.to_date("ts").alias("date"))
    return out.agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.count_distinct("event_type").alias("types"), F.array_join(F.slice(F.array_sort(F.collect_set("event_type")), 1, 3), ",").alias("first_types"))


@query("g21_schedule_integrity", f"{ctes('cal')}, e AS (SELECT type, year(date) AS y, count(*) AS n FROM cal GROUP BY 1, 2) SELECT type, CAST(y AS INT) AS year, n, n <> 240 AS unexpected FROM e")
def g21(spark, sf):
    out = panel.events_calendar(spark, sf).groupBy("type", F.year("date").alias("year")).agg(F.count("*").alias("n"))
    return out.withColumn("unexpected", C("n") != 240)


@query("g22_type_coverage", "SELECT type FROM (VALUES ('FOMC'), ('CPI'), ('budget'), ('global_rate')) t(type) WHERE type NOT IN (SELECT CASE event_type WHEN 'signup' THEN 'FOMC' WHEN 'purchase' THEN 'CPI' ELSE 'x' END FROM events)")
def g22(spark, sf):
    expected = spark.createDataFrame([(t,) for t in ("FOMC", "CPI", "budget", "global_rate")], "type string")
    return contracts.missing(expected, panel.events_calendar(spark, sf), "type")


@query("g26_candidate_report", "WITH q AS (SELECT event_type AS type, CAST(ts AS DATE) AS date, event_id, value IS NULL OR value < 0.05 OR json_extract_string(props, '$.k') IS NULL AS bad FROM events), g AS (SELECT type, date, min(event_id) AS event_id FROM q WHERE NOT bad GROUP BY 1, 2), p AS (SELECT type, count(*) AS promoted FROM g GROUP BY 1), c AS (SELECT type, count(*) AS candidates, count(*) FILTER (bad) AS quarantined FROM q GROUP BY 1) SELECT type, candidates, coalesce(promoted, 0) AS promoted, quarantined, candidates - coalesce(promoted, 0) - quarantined AS review FROM c LEFT JOIN p USING (type)")
def g26(spark, sf):
    return calendar.candidate_report(calendar.candidates(table(spark, sf, "events"), 0.05))


@query("g27_event_dedupe", "SELECT CAST(ts AS DATE) AS date, event_type AS type, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def g27(spark, sf):
    rows = table(spark, sf, "events").select(F.to_date("ts").alias("date"), C("event_type").alias("type"), "event_id")
    return families.latest(rows, ["date", "type"], "event_id")


@query("g10_release_times", f"{ctes('sessions')}, k AS (SELECT session, date_trunc('month', session) AS m, row_number() OVER (PARTITION BY date_trunc('month', session) ORDER BY session) AS k FROM sessions), p AS (SELECT DISTINCT date_trunc('month', session) AS m FROM sessions) SELECT CAST(p.m AS DATE) AS month, k.session AS release_date FROM p JOIN k ON k.m = p.m + INTERVAL 1 MONTH AND k.k = 3")
def g10(spark, sf):
    s = panel.sessions(spark, sf)
    months = s.select(F.trunc("session", "MM").alias("month")).distinct()
    return calendar.release_times(months, s, 3).select("month", F.to_date(F.from_utc_timestamp("released", "America/New_York")).alias("release_date"))


@query("n06_missing_sessions", f"{ctes('bars', 'sessions')}, b AS (SELECT session FROM bars WHERE series_id = 'R'), s AS (SELECT session FROM b JOIN sessions USING (session)) SELECT session FROM sessions WHERE session NOT IN (SELECT session FROM b) AND session BETWEEN (SELECT min(session) FROM s) AND (SELECT max(session) FROM s)")
def n06(spark, sf):
    return contracts.gaps(panel.bars_anchor(spark, sf).where("series_id = 'R'").drop("pos"), panel.sessions(spark, sf)).select("session")


@query("n09_crash_windows", f"{_labels(rules.VOLATILITY)}, w AS (SELECT r_name AS name, DATE '1996-01-01' + r_regionkey * 200 AS a, DATE '1996-01-01' + r_regionkey * 200 + 60 AS b FROM region) SELECT series_id, name, count(*) AS covered, bool_or(label = 'crisis_vol') AS crisis FROM l JOIN w ON session BETWEEN a AND b GROUP BY 1, 2")
def n09(spark, sf):
    first = F.lit("1996-01-01").cast("date")
    w = table(spark, sf, "region").select(C("r_name").alias("name"), F.date_add(first, C("r_regionkey") * 200).alias("a"), F.date_add(first, C("r_regionkey") * 200 + 60).alias("b"))
    return labels(spark, sf, rules.VOLATILITY).join(w, (C("session") >= C("a")) & (C("session") <= C("b"))).groupBy("series_id", "name").agg(F.count("*").alias("covered"), F.bool_or(C("label") == "crisis_vol").alias("crisis"))


@query("n10_transition_summary", f"{_labels(rules.TREND)}, c AS (SELECT *, lag(label) OVER (PARTITION BY series_id ORDER BY pos) AS b FROM l) SELECT b AS before, label AS after, count(*) AS n FROM c WHERE b IS NOT NULL GROUP BY 1, 2")
def n10(spark, sf):
    before = F.lag("label").over(Window.partitionBy("series_id").orderBy("pos"))
    return labels(spark, sf).withColumn("before", before).where("before IS NOT NULL").groupBy("before", C("label").alias("after")).agg(F.count("*").alias("n"))


@query("n20_replay_difference", f"{FEATURES_SQL}, x AS (SELECT series_id, session, 'ret21' AS field, round(ret21, 5) AS v, round(CASE WHEN pos % 100 = 0 THEN ret21 + 1 ELSE ret21 END, 5) AS w FROM f) SELECT series_id, session, field FROM x WHERE v IS DISTINCT FROM w")
def n20(spark, sf):
    f = features(spark, sf).withColumn("ret21", F.round("ret21", 5))
    changed = f.withColumn("ret21", F.when(C("pos") % 100 == 0, C("ret21") + 1).otherwise(C("ret21")))
    return families.field_differences(f, changed, ["series_id", "session"], ["ret21", "rv63"])


@query("n21_activation", f"{FEATURES_SQL}, l AS (SELECT {rules.case(rules.TREND)} AS t, {rules.case(rules.VOLATILITY)} AS v FROM f) SELECT count(*) AS sessions, count(*) FILTER (t <> 'unknown') AS trend, count(*) FILTER (v <> 'unknown') AS volatility FROM l")
def n21(spark, sf):
    out = features(spark, sf).withColumns({"t": rules.label(rules.TREND), "v": rules.label(rules.VOLATILITY)})
    return out.agg(F.count("*").alias("sessions"), F.count_if(C("t") != "unknown").alias("trend"), F.count_if(C("v") != "unknown").alias("volatility"))


@query("n23_state_summary", f"{_labels(rules.TREND)}, c AS (SELECT *, lead(label) OVER (PARTITION BY series_id ORDER BY pos) AS nx FROM l) SELECT label, count(*) AS sessions, round(avg(CASE WHEN nx = label THEN 1.0 WHEN nx IS NOT NULL THEN 0.0 END), 6) AS persistence FROM c GROUP BY 1")
def n23(spark, sf):
    nx = F.lead("label").over(Window.partitionBy("series_id").orderBy("pos"))
    stays = F.when(C("nx") == C("label"), 1.0).when(C("nx").isNotNull(), 0.0)
    return labels(spark, sf).withColumn("nx", nx).groupBy("label").agg(F.count("*").alias("sessions"), F.round(F.avg(stays), 6).alias("persistence"))


@query("n26_nearest_match", f"{_labels(rules.TREND)}, i AS (SELECT series_id, pos FROM l WHERE label = 'bear') SELECT i.series_id, i.pos AS intent, min(l.pos) AS matched FROM i JOIN l ON l.series_id = i.series_id AND l.pos BETWEEN i.pos - 20 AND i.pos + 20 AND l.label = 'bull' GROUP BY 1, 2")
def n26(spark, sf):
    rows = labels(spark, sf)
    intents = rows.where("label = 'bear'").select("series_id", C("pos").alias("intent"))
    return families.nearest_match(intents, rows.where("label = 'bull'"), 20)


@query("o03_history_dedupe", f"{ctes('macro')}, k AS (SELECT *, row_number() OVER (PARTITION BY series_id, obs_date ORDER BY published DESC) AS k FROM macro WHERE published <= DATE '1998-01-01') SELECT series_id, obs_date, value FROM k WHERE k = 1")
def o03(spark, sf):
    return align.latest_revision(panel.macro(spark, sf).where("published <= DATE '1998-01-01'")).select("series_id", "obs_date", "value")


@query("o04_latest_available", f"{ctes('macro')} SELECT series_id, max(published) AS published, arg_max(obs_date, published) AS obs_date FROM (SELECT series_id, published, max(obs_date) AS obs_date FROM macro WHERE published <= DATE '1998-01-01' GROUP BY 1, 2) GROUP BY 1")
def o04(spark, sf):
    known = panel.macro(spark, sf).where("published <= DATE '1998-01-01'")
    return known.groupBy("series_id").agg(F.max("published").alias("published"), F.max_by("obs_date", F.struct("published", "obs_date")).alias("obs_date"))


@query("o06_append_new", "SELECT o_orderkey FROM orders")
def o06(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey")
    old = rows.where("o_orderkey <= 500")
    return families.append_new(old, rows, "o_orderkey")


@query("o08_consolidation", "SELECT source, count(*) AS n, count(DISTINCT k) AS keys FROM (SELECT 'customer' AS source, c_custkey AS k FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier UNION ALL SELECT 'part', p_partkey FROM part) GROUP BY 1")
def o08(spark, sf):
    parts = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    stores = {name: table(spark, sf, name).withColumnRenamed(key, "k") for name, key in parts.items()}
    return families.consolidated(stores).groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("k").alias("keys"))


@query("o09_local_dates", "SELECT CAST(((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS DATE) AS local_date, max(event_id) AS event_id FROM events GROUP BY 1")
def o09(spark, sf):
    rows = table(spark, sf, "events").select(F.to_date(F.from_utc_timestamp(C("ts").cast("timestamp"), "America/New_York")).alias("local_date"), "event_id")
    return families.latest(rows, ["local_date"], "event_id")


@query("o10_synthetic_membership", f"{ctes('members')} SELECT series_id, min(session) AS start, CAST(NULL AS DATE) AS \"end\" FROM members GROUP BY 1")
def o10(spark, sf):
    return panel.bars_member(spark, sf).groupBy("series_id").agg(F.min("session").alias("start")).withColumn("end", F.lit(None).cast("date"))


@query("a10_content_identity")
def a10(spark, sf):
    return contracts.content_identity(table(spark, sf, "lineitem"))


@query("a24_two_columns", "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS value, 'orders' AS source FROM orders WHERE o_orderkey % 10 <> 0")
def a24(spark, sf):
    rows = table(spark, sf, "orders").select(F.when(C("o_orderkey") % 10 != 0, F.to_date("o_orderdate").cast("string")).otherwise("n/a").alias("d"), C("o_totalprice").cast("string").alias("v"))
    return readers.two_columns(rows, "d", "v", "orders")


@query("i03_calendar_staleness", f"{ctes('sessions', 'macro')}, m AS (SELECT DISTINCT published FROM macro WHERE vintage = 0) SELECT s.session, coalesce(s.session - m.published, 1000000000) AS days FROM sessions s ASOF LEFT JOIN m ON s.session >= m.published")
def i03(spark, sf):
    dates = panel.macro(spark, sf).where("vintage = 0").select("published").distinct().withColumn("series_id", F.lit("m"))
    rows = align.as_of(panel.sessions(spark, sf).withColumn("series_id", F.lit("m")), dates.withColumn("seen", C("published")), "published", ["seen"], ["series_id"])
    return rows.select("session", F.coalesce(F.datediff("session", "seen"), F.lit(1_000_000_000)).cast("long").alias("days"))


@query("i12_coverage_report", f"{FEATURES_SQL}, l AS (SELECT series_id, session, {rules.case(rules.TREND)} AS trend, {rules.case(rules.VOLATILITY)} AS volatility, {rules.case(rules.VOLUME)} AS volume_label FROM f), u AS (SELECT series_id, session, trend AS label FROM l UNION ALL SELECT series_id, session, volatility FROM l UNION ALL SELECT series_id, session, volume_label FROM l) SELECT series_id, session, count(*) FILTER (label <> 'unknown') AS classified, bool_and(label <> 'unknown') AS safe FROM u GROUP BY 1, 2")
def i12(spark, sf):
    out = features(spark, sf).select("series_id", "session", F.explode(F.array(*(rules.label(x) for x in (rules.TREND, rules.VOLATILITY, rules.VOLUME)))).alias("label"))
    return out.groupBy("series_id", "session").agg(F.count_if(C("label") != "unknown").alias("classified"), F.bool_and(C("label") != "unknown").alias("safe"))


@query("h13_effective_credit", f"{FEATURES_SQL}, c AS (SELECT series_id, session, CASE WHEN rv_pct > 0.8 THEN 'credit_stress' WHEN rv_pct IS NOT NULL THEN 'credit_calm' ELSE 'unknown' END AS a, CASE WHEN gap_pct > 0.5 THEN 'spread_widening' ELSE 'credit_calm' END AS b FROM f) SELECT series_id, session, CASE WHEN a = 'credit_stress' THEN a WHEN b = 'spread_widening' THEN b WHEN a = 'unknown' THEN b ELSE a END AS label FROM c")
def h13(spark, sf):
    a = F.when(C("rv_pct") > 0.8, "credit_stress").when(C("rv_pct").isNotNull(), "credit_calm").otherwise("unknown")
    b = F.when(C("gap_pct") > 0.5, "spread_widening").otherwise("credit_calm")
    return features(spark, sf).withColumns({"a": a, "b": b}).select("series_id", "session", rules.effective_credit(C("a"), C("b")).alias("label"))
