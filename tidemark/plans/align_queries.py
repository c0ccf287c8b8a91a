"""Queries of alignment, contracts, merges and breadth, each with the same in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import align, breadth, contracts
from tidemark.plans.folders import shared_folder
from tidemark.sources import panel, readers
from tidemark.sources.panel import ctes, table

QUERIES, ORACLE = {}, {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], ORACLE[name] = f, sql
        return f

    return add


def _grid_sql(of: str) -> str:
    return f"grid AS (SELECT series_id, session, s.pos FROM (SELECT DISTINCT series_id FROM {of}) CROSS JOIN sessions s)"


@query("b01_select_upto", f"{ctes('bars')} SELECT session, volume FROM bars WHERE series_id = 'A' AND session <= DATE '1998-06-30'")
def b01(spark, sf):
    return panel.bars_anchor(spark, sf).where("series_id = 'A' AND session <= DATE '1998-06-30'").select("session", "volume")


@query("b02_exact_alignment", f"{ctes('members', 'sessions')}, {_grid_sql('members')} SELECT g.series_id, g.session, m.volume FROM grid g LEFT JOIN members m ON g.series_id = m.series_id AND g.session = m.session")
def b02(spark, sf):
    bars = panel.bars_member(spark, sf)
    return align.exact(align.grid(bars, panel.sessions(spark, sf)), bars.select("series_id", "session", "volume")).select("series_id", "session", "volume")


@query("b04_as_of", f"{ctes('sessions', 'macro')}, firsts AS (SELECT *, row_number() OVER (PARTITION BY series_id, obs_date ORDER BY published, vintage) AS k FROM macro), m AS (SELECT * FROM firsts WHERE k = 1), g AS (SELECT DISTINCT m.series_id, s.session FROM m CROSS JOIN sessions s) SELECT g.series_id, g.session, m.obs_date, m.value FROM g ASOF LEFT JOIN (SELECT series_id, published, max(obs_date) AS obs_date, arg_max(value, obs_date) AS value FROM m GROUP BY 1, 2) m ON g.series_id = m.series_id AND g.session >= m.published")
def b04(spark, sf):
    readings = align.first_release(panel.macro(spark, sf))
    rows = align.grid(readings, panel.sessions(spark, sf))
    return align.as_of(rows, readings, "published", ["obs_date", "value"], ["series_id"]).select("series_id", "session", "obs_date", "value")


@query("b06_strict_lookup", f"{ctes('bars', 'sessions')} SELECT count(*) AS misses, array_to_string(list(d ORDER BY d)[1:5], ',') AS first_misses FROM (SELECT DISTINCT CAST(session AS VARCHAR) AS d FROM sessions WHERE session NOT IN (SELECT session FROM bars WHERE series_id = 'R'))")
def b06(spark, sf):
    return align.strict_lookup(panel.sessions(spark, sf).select("session"), panel.bars_anchor(spark, sf).where("series_id = 'R'"), ["session"])[1]


@query("b07_first_release", f"{ctes('macro')}, a AS (SELECT *, row_number() OVER (PARTITION BY series_id, obs_date ORDER BY published, vintage) AS k FROM macro), b AS (SELECT *, row_number() OVER (PARTITION BY series_id, published ORDER BY obs_date DESC) AS j FROM a WHERE k = 1) SELECT series_id, obs_date, published, value FROM b WHERE j = 1")
def b07(spark, sf):
    return align.first_release(panel.macro(spark, sf)).select("series_id", "obs_date", "published", "value")


@query("b08_vintage_precedence", f"{ctes('macro')}, a AS (SELECT *, row_number() OVER (PARTITION BY series_id, obs_date ORDER BY published, vintage) AS k, row_number() OVER (PARTITION BY series_id, obs_date ORDER BY published DESC, vintage DESC) AS j FROM macro) SELECT l.series_id, l.obs_date, coalesce(f.value, l.value) AS value FROM (SELECT * FROM a WHERE j = 1) l LEFT JOIN (SELECT * FROM a WHERE k = 1 AND vintage = 0) f USING (series_id, obs_date)")
def b08(spark, sf):
    m = panel.macro(spark, sf)
    first = align.first_release(m).where("vintage = 0").select("series_id", "obs_date", F.col("value").alias("first"))
    return align.latest_revision(m).join(first, ["series_id", "obs_date"], "left").select("series_id", "obs_date", align.splice("first", "value").alias("value"))


@query("b10_recent_sessions", f"{ctes('bars')}, e AS (SELECT series_id, max(pos) AS e FROM bars GROUP BY 1) SELECT series_id, session, volume FROM bars JOIN e USING (series_id) WHERE pos > e - 100")
def b10(spark, sf):
    return align.recent(panel.bars_anchor(spark, sf), 100).select("series_id", "session", "volume")


@query("b12_interval_join", f'{ctes("members", "membership")} SELECT m.series_id, m.session, m.volume FROM members m WHERE EXISTS (SELECT 1 FROM membership i WHERE i.series_id = m.series_id AND m.session >= i.start AND (i."end" IS NULL OR m.session <= i."end"))')
def b12(spark, sf):
    return align.members_on(panel.bars_member(spark, sf), panel.membership(spark, sf)).select("series_id", "session", "volume")


@query("b13_corrected_ends", f'{ctes("membership")} SELECT series_id, start, coalesce("end", CASE WHEN CAST(series_id AS INT) % 2 = 0 THEN DATE \'2001-06-01\' END) AS "end" FROM membership')
def b13(spark, sf):
    i = panel.membership(spark, sf)
    fixes = i.where("CAST(series_id AS INT) % 2 = 0").select("series_id", F.lit("2001-06-01").cast("date").alias("corrected"))
    return align.corrected_ends(i, fixes).select("series_id", "start", "end")


@query("b14_survivorship", f'{ctes("membership")} SELECT count(*) AS intervals, count("end") AS ended, count("end") = 0 AS biased FROM membership')
def b14(spark, sf):
    return align.survivorship_biased(panel.membership(spark, sf))


@query("b17_provider_fallback", f"{ctes('bars', 'members')} SELECT series_id, count(*) AS n FROM (SELECT series_id, session FROM members WHERE CAST(series_id AS INT) < 10 UNION ALL SELECT series_id, session FROM members WHERE CAST(series_id AS INT) >= 10 AND CAST(series_id AS INT) % 2 = 0) GROUP BY 1")
def b17(spark, sf):
    bars = panel.bars_member(spark, sf).select("series_id", "session")
    i = F.col("series_id").cast("int")
    return align.fallback(bars.where(i < 10), bars.where((i % 2 == 0) | (i < 5))).groupBy("series_id").agg(F.count("*").alias("n"))


@query("b18_near_dates", f"{ctes('cal')} SELECT DISTINCT a.date, a.type FROM cal a WHERE a.type = 'FOMC' AND EXISTS (SELECT 1 FROM cal b WHERE b.type = 'CPI' AND abs(date_diff('day', a.date, b.date)) <= 2)")
def b18(spark, sf):
    cal = panel.events_calendar(spark, sf)
    others = cal.where("type = 'CPI'").withColumn("type", F.lit("FOMC"))
    return align.near(cal.where("type = 'FOMC'"), others, 2).select("date", "type").distinct()


@query("b20_session_neighbours", f"{ctes('sessions', 'cal')}, d AS (SELECT DISTINCT date FROM cal) SELECT date, (SELECT max(session) FROM sessions s WHERE s.session < d.date) AS previous, (SELECT min(session) FROM sessions s WHERE s.session > d.date) AS next FROM d")
def b20(spark, sf):
    return align.neighbours(panel.events_calendar(spark, sf), panel.sessions(spark, sf))


@query("a03_bar_contract", f"{ctes('bars', 'sessions')} SELECT count(*) AS rows, count(*) FILTER (b.session IS NULL) AS null_dates, count(*) FILTER (s.session IS NULL) AS off_calendar, count(*) FILTER (series_id = 'A' AND b.session = DATE '1998-06-30') AS anchor_rows FROM bars b LEFT JOIN sessions s USING (session)")
def a03(spark, sf):
    return contracts.bar_contract(panel.bars_anchor(spark, sf), panel.sessions(spark, sf), "A", F.lit("1998-06-30").cast("date"))


@query("a04_series_contract", f"{ctes('members')} SELECT series_id, count(*) AS rows, count(*) FILTER (session IS NULL) AS null_dates, count(*) FILTER (close IS NULL) AS null_closes FROM members GROUP BY 1")
def a04(spark, sf):
    return contracts.series_contract(panel.bars_member(spark, sf))


@query("a05_partition_agreement", "SELECT l_linestatus AS partition, count(DISTINCT l_returnflag) AS symbols, count(*) FILTER (l_returnflag IS NULL) AS nulls, count(DISTINCT l_returnflag) = 1 AND count(*) FILTER (l_returnflag IS NULL) = 0 AND min(l_returnflag) = l_linestatus AS agrees FROM lineitem GROUP BY 1")
def a05(spark, sf):
    return contracts.partition_agreement(table(spark, sf, "lineitem"), "l_linestatus", "l_returnflag")


@query("a06_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def a06(spark, sf):
    return contracts.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_GAPS = f"{ctes('bars', 'sessions')}, span AS (SELECT series_id, min(s.pos) AS a, max(s.pos) AS b FROM bars JOIN sessions s USING (session) GROUP BY 1), gap AS (SELECT span.series_id, s.session FROM span JOIN sessions s ON s.pos BETWEEN a AND b WHERE NOT EXISTS (SELECT 1 FROM bars x WHERE x.series_id = span.series_id AND x.session = s.session))"


@query("a06_calendar_gaps", f"{_GAPS} SELECT * FROM gap")
def a06g(spark, sf):
    return contracts.gaps(panel.bars_anchor(spark, sf).drop("pos"), panel.sessions(spark, sf))


@query("a08_gap_summary", f"{_GAPS} SELECT series_id, count(*) AS gaps, array_to_string(list(CAST(session AS VARCHAR) ORDER BY session)[1:5], ',') AS first_gaps FROM gap GROUP BY 1")
def a08(spark, sf):
    return contracts.gap_summary(panel.bars_anchor(spark, sf).drop("pos"), panel.sessions(spark, sf))


@query("a07_expected_sessions", f'{ctes("sessions", "membership")} SELECT i.series_id, count(s.session) AS sessions FROM membership i LEFT JOIN sessions s ON s.session >= i.start AND (i."end" IS NULL OR s.session < i."end") GROUP BY 1')
def a07(spark, sf):
    return contracts.expected_sessions(panel.membership(spark, sf), panel.sessions(spark, sf))


@query("a09_inventory_mismatch", f"{ctes('bars', 'members')} SELECT series_id, count(*) FILTER (volume > 40) AS declared, count(*) AS actual FROM members GROUP BY 1 HAVING count(*) FILTER (volume > 40) <> count(*) OR min(session) FILTER (volume > 40) <> min(session) OR max(session) FILTER (volume > 40) <> max(session)")
def a09(spark, sf):
    bars = panel.bars_member(spark, sf)
    return contracts.inventory_mismatch(contracts.inventory(bars.where("volume > 40")), contracts.inventory(bars))


def _tree(spark, sf) -> str:
    """The members' bars as a tree of one folder for each series, in the shared folder."""
    path = f"{shared_folder(spark)}/bars-{uuid.uuid4().hex}"
    readers.write_bars(panel.bars_member(spark, sf), path)
    return path


@query("a02_partitioned_read", f"""{ctes('members', 'membership')} SELECT series_id, count(*) AS rows, min(session) AS first, max(session) AS last, round(sum(close), 4) AS closes FROM members WHERE series_id IN (SELECT series_id FROM membership WHERE start <= DATE '1995-06-01') GROUP BY 1""")
def a02(spark, sf):
    """Bars of the series that belonged to the universe on a day, read from the tree: their names prune its folders as the query runs."""
    wanted = panel.membership(spark, sf).where("start <= DATE '1995-06-01'").select("series_id")
    bars = readers.read_members(spark, _tree(spark, sf), wanted)
    return bars.groupBy("series_id").agg(F.count("*").alias("rows"), F.min("session").alias("first"), F.max("session").alias("last"), F.round(F.sum("close"), 4).alias("closes"))


@query("a01_csv_round_trip", f"{ctes('members')} SELECT series_id, session, open, high, low, close, volume FROM members WHERE volume > 10")
def a01(spark, sf):
    """Bars written as CSV with empty cells and NaN, and read back typed."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    bars = panel.bars_member(spark, sf)
    bars.withColumn("open", F.when(F.col("volume") > 10, F.col("open")).otherwise(F.lit(float("nan")))).write.option("header", "true").csv(path)
    return readers.read_table(spark, path, "csv", readers.BARS).where("open IS NOT NULL")


@query("a11_inventory", f"{ctes('members')} SELECT series_id, count(*) AS rows, min(session) AS first, max(session) AS last FROM members GROUP BY 1")
def a11(spark, sf):
    return contracts.inventory(panel.bars_member(spark, sf))


@query("a12_overlapping_universe", f'{ctes("membership")} SELECT DISTINCT series_id FROM membership WHERE start <= DATE \'1999-12-31\' AND ("end" IS NULL OR "end" >= DATE \'1999-06-01\')')
def a12(spark, sf):
    return contracts.overlapping(panel.membership(spark, sf), "1999-06-01", "1999-12-31")


@query("a13_missing_symbols", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def a13(spark, sf):
    return contracts.missing(table(spark, sf, "orders"), table(spark, sf, "customer").where("c_acctbal > 0").withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")


@query("a15_range_read", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'")
def a15(spark, sf):
    return table(spark, sf, "lineitem").where("l_returnflag IN ('A', 'R') AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31'").select("l_orderkey", "l_partkey", "l_quantity")


@query("a16_upsert", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def a16(spark, sf):
    old = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return contracts.upsert(old, old.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])


@query("a17_macro_load", "SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'implied_vol_30d' ELSE o_orderpriority END AS name, o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice / 100 ELSE o_totalprice END AS value FROM orders")
def a17(spark, sf):
    from tidemark.sources.readers import macro_long

    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("series_id"), F.when(F.col("o_orderpriority") == "1-URGENT", "implied_vol_30d").alias("logical_name"), "o_orderkey", F.col("o_totalprice").cast("string").alias("value"))
    return macro_long(rows).select("name", "o_orderkey", "value")


@query("a19_quarantine", "SELECT count(*) AS rows, count(*) FILTER (c_acctbal < 0) AS bad, avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END) > 0.01 AS fails FROM customer")
def a19(spark, sf):
    return contracts.quarantined(table(spark, sf, "customer"), F.col("c_acctbal") < 0)


@query("a20_common_end", f"{ctes('members')}, e AS (SELECT min(e) AS e FROM (SELECT max(session) AS e FROM members GROUP BY series_id)) SELECT series_id, count(*) AS n FROM members, e WHERE session <= e GROUP BY 1")
def a20(spark, sf):
    return contracts.common_end(panel.bars_member(spark, sf)).groupBy("series_id").agg(F.count("*").alias("n"))


@query("a22_nested_json", "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN '{\"name\":\"' || c_name || '\",\"segment\":\"' || c_mktsegment || '\"}' ELSE '{\"name\":\"' || c_name || '\"}' END AS json FROM customer")
def a22(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.to_json(F.struct(F.col("c_name").alias("name"), F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("segment")), {"ignoreNullFields": "true"}).alias("json"))


@query("a25_local_dates", "SELECT event_id, CAST(((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS DATE) AS local_date FROM events")
def a25(spark, sf):
    return table(spark, sf, "events").select("event_id", F.to_date(F.from_utc_timestamp(F.col("ts").cast("timestamp"), "America/New_York")).alias("local_date"))


@query("o02_backfill", "SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1 HAVING o_custkey >= 100 UNION ALL SELECT c_custkey, 0 FROM customer WHERE c_custkey < 100")
def o02(spark, sf):
    live = table(spark, sf, "customer").where("c_custkey < 100").select(F.col("c_custkey").alias("o_custkey"), F.lit(0).cast("long").alias("o_orderkey"))
    return contracts.backfill(live, table(spark, sf, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey").where("o_custkey >= 100 OR o_orderkey = 0")


_MEMBER = f"""{ctes('members', 'sessions', 'membership')}, {_grid_sql('members')},
f0 AS (SELECT g.*, m.close, m.volume FROM grid g LEFT JOIN members m ON g.series_id = m.series_id AND g.session = m.session),
f1 AS (SELECT *, close - lag(close) OVER w AS change,
  CASE WHEN count(close) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20 THEN avg(close) OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS sma,
  CASE WHEN count(close) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) >= 30 THEN max(close) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) END AS top,
  CASE WHEN count(close) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) >= 30 THEN min(close) OVER (w ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) END AS bottom
  FROM f0 WINDOW w AS (PARTITION BY series_id ORDER BY session)),
inside AS (SELECT f1.* FROM f1 WHERE EXISTS (SELECT 1 FROM membership i WHERE i.series_id = f1.series_id AND f1.session >= i.start AND (i."end" IS NULL OR f1.session <= i."end"))),
d AS (SELECT session, pos, count(close) AS present, avg(CASE WHEN sma IS NOT NULL AND close IS NOT NULL THEN CASE WHEN close > sma THEN 1.0 ELSE 0.0 END END) AS pct_above,
  count(*) FILTER (change > 0) AS advances, count(*) FILTER (change < 0) AS declines, count(*) FILTER (change = 0) AS unchanged, count(*) FILTER (close = top) AS highs, count(*) FILTER (close = bottom) AS lows, count(top) AS spans,
  sum(CASE WHEN change > 0 THEN volume ELSE 0 END) AS up_volume, sum(CASE WHEN change < 0 THEN volume ELSE 0 END) AS down_volume FROM inside GROUP BY 1, 2)
SELECT session, present, round(pct_above, 6) AS pct_above, advances, declines, CAST(sum(CASE WHEN pos = 1 THEN 0 ELSE advances - declines END) OVER (ORDER BY pos) AS BIGINT) AS ad_line,
  round(CASE WHEN spans > 0 THEN highs / greatest(highs + lows, 1) END, 6) AS high_low, round(up_volume / nullif(up_volume + down_volume, 0), 6) AS up_share,
  round(CASE WHEN count(*) OVER (ORDER BY pos ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) = 10 THEN avg(advances / greatest(advances + declines + unchanged, 1)) OVER (ORDER BY pos ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) END, 6) AS thrust
FROM d"""


@query("e08_member_breadth", _MEMBER)
def e08(spark, sf):
    out = breadth.breadth(panel.bars_member(spark, sf), panel.sessions(spark, sf), panel.membership(spark, sf), sma=20, span=60)
    return out.select("session", "present", F.round("pct_above", 6).alias("pct_above"), "advances", "declines", "ad_line", *(F.round(c, 6).alias(c) for c in ("high_low", "up_share", "thrust")))


@query("e01_sector_breadth", f"""{ctes('members', 'sessions')}, {_grid_sql('members')},
f AS (SELECT g.series_id, g.session, m.close, m.close / nullif(lag(m.close, 21) OVER (PARTITION BY g.series_id ORDER BY g.session), 0) - 1 AS r FROM grid g LEFT JOIN members m ON g.series_id = m.series_id AND g.session = m.session),
d AS (SELECT session, count(*) AS universe, count(r) AS available, count(*) FILTER (r > 0) AS positive, coalesce(array_to_string(list(series_id ORDER BY series_id) FILTER (r IS NULL), ','), '') AS missing FROM f GROUP BY 1)
SELECT session, round(CASE WHEN available = universe THEN positive / available END, 6) AS strict, round(positive / nullif(available, 0), 6) AS available_share, available, universe - available AS n_missing, missing FROM d""")
def e01(spark, sf):
    out = breadth.sector_breadth(panel.bars_member(spark, sf), panel.sessions(spark, sf))
    return out.select("session", F.round("strict", 6).alias("strict"), F.round("available_share", 6).alias("available_share"), "available", "n_missing", "missing")


@query("f05_dispersion", f"""{ctes('bars', 'members')}, b AS (SELECT series_id, session, close / nullif(lag(close) OVER (PARTITION BY series_id ORDER BY session), 0) - 1 AS r FROM bars WHERE series_id = 'A'),
m AS (SELECT series_id, session, close / nullif(lag(close) OVER (PARTITION BY series_id ORDER BY session), 0) - 1 AS r FROM members),
bv AS (SELECT session, CASE WHEN count(r) OVER w = 21 THEN stddev_samp(r) OVER w * sqrt(252) END AS v FROM b WINDOW w AS (PARTITION BY series_id ORDER BY session ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)),
mv AS (SELECT session, CASE WHEN count(r) OVER w = 21 THEN stddev_samp(r) OVER w * sqrt(252) END AS v FROM m WINDOW w AS (PARTITION BY series_id ORDER BY session ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)),
mm AS (SELECT session, avg(v) AS v FROM mv GROUP BY 1)
SELECT session, round(mm.v / CASE WHEN bv.v IS NULL THEN 1e-6 ELSE greatest(bv.v, 1e-6) END, 4) AS dispersion FROM mm JOIN bv USING (session) WHERE bv.v IS NOT NULL""")
def f05(spark, sf):
    anchor = panel.bars_anchor(spark, sf).where("series_id = 'A'")
    out = breadth.dispersion(panel.bars_member(spark, sf), anchor)
    # the anchor's volatility is null in its first sessions, where greatest() leaves the floor
    vol = breadth.R.realized_vol(F.col("r"), 21)
    known = anchor.withColumn("r", breadth.R.period_return(F.col("close"), 1)).withColumn("v", vol).where("v IS NOT NULL").select("session")
    return out.join(known, "session").select("session", F.round("dispersion", 4).alias("dispersion"))
