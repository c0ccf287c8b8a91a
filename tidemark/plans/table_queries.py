"""Queries of feature families and small table jobs, each with SQL written by hand where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rolling as R
from tidemark.operators import align, calendar, evaluate, families, folds, rules
from tidemark.plans.label_queries import FEATURES_SQL, _labels, features, labels
from tidemark.plans.rolling_queries import _frame, _full, _lag
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


def _r(e: str) -> str:
    return f"round(CAST({e} AS DOUBLE), 5)"


@query("d01_trend_features", f"{FEATURES_SQL} SELECT series_id, session, {_r('sma50')} AS sma50, {_r('sma200')} AS sma200, {_r('ret63')} AS ret63 FROM f")
def d01(spark, sf):
    bars, close = panel.bars_anchor(spark, sf), C("close")
    return bars.select("series_id", "session", F.round(R.sma(close, 50), 5).alias("sma50"), F.round(R.sma(close, 200), 5).alias("sma200"), F.round(R.period_return(close, 63), 5).alias("ret63"))


def _scores(spark, sf):
    """Monthly order values over the mean of all of them, less one, as of each session: of one priority for sentiment, another for news."""
    out = {}
    for name, priority in (("sentiment", "1-URGENT"), ("news", "5-LOW")):
        m = panel.macro(spark, sf).where((C("vintage") == 0) & (C("series_id") == priority)).select(F.lit("m").alias("series_id"), "published", "value")
        s = align.as_of(panel.sessions(spark, sf).withColumn("series_id", F.lit("m")), m, "published", ["value"], ["series_id"])
        out[name] = s.select("session", (C("value") / 150000 - 1).alias("score"))
    return out["sentiment"], out["news"]


_TREND2 = ("er20", "slope_sma50", "slope_sma200", "ret63", "ret126", "dd252", "sma50", "sma200", "rv21", "sentiment", "news")
_AS_OF = "SELECT s.session, m.value / 150000 - 1 AS score FROM sessions s ASOF LEFT JOIN (SELECT published, value FROM macro WHERE vintage = 0 AND series_id = '{}') m ON s.session >= m.published"


@query("d02_trend_features", f"""{FEATURES_SQL.replace(ctes('bars'), ctes('bars', 'sessions', 'macro'))}, a AS ({_AS_OF.format('1-URGENT')}), b AS ({_AS_OF.format('5-LOW')}),
p AS (SELECT *, abs(close - {_lag('close', 1)}) AS step, abs(close - {_lag('close', 20)}) AS net, (sma50 - {_lag('sma50', 20)}) / nullif({_lag('sma50', 20)}, 0) AS slope_sma50, (sma200 - {_lag('sma200', 20)}) / nullif({_lag('sma200', 20)}, 0) AS slope_sma200 FROM f),
x AS (SELECT * EXCLUDE (sentiment), net / nullif({_full('sum(step)', 20, 'step')}, 0) AS er20 FROM p)
SELECT series_id, x.session, {', '.join(f'{_r(c)} AS {c}' for c in _TREND2[:-2])}, {_r('a.score')} AS sentiment, {_r('b.score')} AS news, CAST(sign(a.score) * sign(b.score) AS INT) AS sentiment_concordance FROM x LEFT JOIN a ON x.session = a.session LEFT JOIN b ON x.session = b.session""")
def d02(spark, sf):
    out = families.trend_features(panel.bars_anchor(spark, sf), *_scores(spark, sf))
    return out.select("series_id", "session", *(F.round(c, 5).alias(c) for c in _TREND2), "sentiment_concordance")


_CHARACTER = ("sma50", "ret10", "ret21", "ret63", "dd63", "midpoint")


@query("d04_character_features", f"""{FEATURES_SQL}, p AS (SELECT *, {_full('max(close)', 63, 'close')} AS top63, {_full('max(close)', 20, 'close')} AS top, {_full('min(close)', 20, 'close')} AS bottom, {_full('max(close)', 20, 'close', 1)} AS top20, {_full('max(close)', 50, 'close', 1)} AS top50, 4 * {_full('stddev_pop(close)', 20, 'close')} AS width, {_full('avg(volume)', 20, 'volume', 1)} AS volume20 FROM f)
SELECT series_id, session, {', '.join(f'{_r(c)} AS {c}' for c in _CHARACTER[:4])}, {_r('close / top63 - 1')} AS dd63, {_r('(top - bottom) / nullif(top + bottom, 0)')} AS midpoint, CAST(coalesce(close > top20, false) OR coalesce(close > top50, false) AS INT) AS breakout, CAST(width > {_lag('width', 5)} AS INT) AS widening, CAST(volume > volume20 AS INT) AS heavy FROM p""")
def d04(spark, sf):
    out = families.character_features(panel.bars_anchor(spark, sf))
    return out.select("series_id", "session", *(F.round(c, 5).alias(c) for c in _CHARACTER), "breakout", "widening", "heavy")


_VOLATILITY = ("rv10", "rv21", "rv63", "gap_freq", "gap_pct", "day_range", "range_pct")


@query("d06_volatility_features", f"{FEATURES_SQL} SELECT series_id, session, {', '.join(f'{_r(c)} AS {c}' for c in _VOLATILITY)}, {_r('rv10 - rv21')} AS spread FROM f")
def d06(spark, sf):
    """Realised volatilities, gaps and ranges with their percentiles, and the spread of the implied volatility's stand-in over the realised one."""
    return features(spark, sf).select("series_id", "session", *(F.round(c, 5).alias(c) for c in _VOLATILITY), F.round(C("rv10") - C("rv21"), 5).alias("spread"))


_VOLUME = ("volume_z", "gap_freq", "range_pct")


@query("d08_volume_features", f"{FEATURES_SQL} SELECT series_id, session, {', '.join(f'{_r(c)} AS {c}' for c in _VOLUME)} FROM f")
def d08(spark, sf):
    """Volume against its 20 sessions, the share of gaps in 20, and the rank of the day's range in 252."""
    return features(spark, sf).select("series_id", "session", *(F.round(c, 5).alias(c) for c in _VOLUME))


@query("g15_spike_windows", f"""{ctes('bars')}, p AS (SELECT *, {_full('avg(volume)', 60, 'volume', 1)} + 2 * {_full('stddev_pop(volume)', 60, 'volume', 1)} AS most, {_full('avg(volume)', 7, 'volume')} AS m7, {_full('avg(volume)', 60, 'volume', 7)} AS b7, {_full('avg(volume)', 30, 'volume')} AS m30, {_full('avg(volume)', 60, 'volume', 30)} AS b30 FROM bars)
SELECT series_id, session, CASE WHEN m30 > b30 THEN -2 WHEN m7 > b7 THEN -1 ELSE 0 END AS "before", CASE WHEN m30 > b30 THEN 5 WHEN m7 > b7 THEN 3 ELSE 0 END AS "after" FROM p WHERE volume > most""")
def g15(spark, sf):
    out = families.spike_components(panel.bars_anchor(spark, sf), "volume").where(F.size("components") > 0)
    return out.select("series_id", "session", families.spike_window("components").alias("w")).select("series_id", "session", "w.before", "w.after")


_CPI = "m AS (SELECT 'm' AS k, published, avg(value) AS v FROM macro WHERE vintage = 0 GROUP BY 1, 2), s AS (SELECT s.session, s.pos, m.v FROM sessions s ASOF LEFT JOIN m ON s.session >= m.published)"


@query("h15_limb_evidence", f"""{ctes('sessions', 'macro')}, {_CPI}, c AS (SELECT session, pos, v / lag(v, 126) OVER (ORDER BY pos) - 1 AS change6 FROM s),
x AS (SELECT *, lag(change6, 21) OVER (ORDER BY pos) AS lagged, CASE WHEN count(change6) OVER w = 21 THEN regr_slope(change6, pos) OVER w END AS slope FROM c WINDOW w AS (ORDER BY pos ROWS BETWEEN 20 PRECEDING AND CURRENT ROW))
SELECT session, {_r('0.005 - abs(change6 - lagged)')} AS drift_margin, {_r('0 - slope')} AS slope_margin, {_r('0.04 - change6')} AS benign_margin,
  CASE WHEN abs(change6 - lagged) <= 0.005 THEN 1 ELSE 0 END + CASE WHEN slope <= 0 THEN 1 ELSE 0 END + CASE WHEN change6 < 0.04 THEN 1 ELSE 0 END AS limbs FROM x""")
def h15(spark, sf):
    m = panel.macro(spark, sf).where("vintage = 0").groupBy("published").agg(F.avg("value").alias("v")).withColumn("series_id", F.lit("m"))
    s = align.as_of(panel.sessions(spark, sf).withColumn("series_id", F.lit("m")), m, "published", ["v"], ["series_id"]).withColumn("change6", R.period_return(C("v"), 126))
    s = s.withColumns({"change6_lag": R.lag(C("change6"), 21), "change6_slope": R.ols_slope(C("change6"), C("pos"), 21)})
    return families.limb_evidence(s).select("session", *(F.round(c, 5).alias(c) for c in ("drift_margin", "slope_margin", "benign_margin")), "limbs")


@query("a14_universe", "SELECT DISTINCT trim(c_mktsegment) AS symbol FROM customer WHERE c_mktsegment IS NOT NULL")
def a14(spark, sf):
    return table(spark, sf, "customer").select(F.trim("c_mktsegment").alias("symbol")).where("symbol IS NOT NULL").distinct()


@query("a18_required_present", "SELECT n_nationkey AS symbol FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier)")
def a18(spark, sf):
    have = table(spark, sf, "supplier").select(C("s_nationkey").alias("symbol"))
    return table(spark, sf, "nation").select(C("n_nationkey").alias("symbol")).join(have, "symbol", "left_anti")


@query("a21_flat_export", f"{FEATURES_SQL} SELECT series_id, session, {rules.case(rules.TREND)} AS trend, {rules.case(rules.VOLATILITY)} AS volatility, {rules.case(rules.VOLUME)} AS volume_label FROM f")
def a21(spark, sf):
    return features(spark, sf).select("series_id", "session", rules.label(rules.TREND).alias("trend"), rules.label(rules.VOLATILITY).alias("volatility"), rules.label(rules.VOLUME).alias("volume_label"))


@query("a23_vendor_layout", "SELECT event_id, CAST(ts AS DATE) AS session, value AS close, value AS adjusted_close FROM events")
def a23(spark, sf):
    return readers.vendor_bars(table(spark, sf, "events"), {"ts": "session", "value": "close"}).select("event_id", "session", "close", "adjusted_close")


@query("b03_calendar_union", f"{ctes('sessions', 'macro')}, d AS (SELECT session AS date FROM sessions UNION SELECT published FROM macro) SELECT d.date, s.pos FROM d LEFT JOIN sessions s ON s.session = d.date")
def b03(spark, sf):
    s = panel.sessions(spark, sf)
    dates = s.select(C("session").alias("date")).union(panel.macro(spark, sf).select("published")).distinct()
    return dates.join(s.withColumnRenamed("session", "date"), "date", "left")


@query("b09_spread_splice", f"{FEATURES_SQL} SELECT series_id, session, {_r('coalesce(rv21 - gap_pct, rv21 - day_range, ret5 - day_range)')} AS spread FROM f")
def b09(spark, sf):
    f = features(spark, sf).withColumns({"s1": C("rv21") - C("gap_pct"), "s2": C("rv21") - C("day_range"), "s3": C("ret5") - C("day_range")})
    return f.select("series_id", "session", F.round(align.splice("s1", "s2", "s3"), 5).alias("spread"))


@query("b11_required_history", f"{ctes('bars')}, e AS (SELECT series_id, max(pos) AS e FROM bars GROUP BY 1) SELECT series_id, count(*) AS rows, min(session) AS first FROM bars JOIN e USING (series_id) WHERE pos > e - (20 + 252 + 21) GROUP BY 1")
def b11(spark, sf):
    return align.recent(panel.bars_anchor(spark, sf), 20 + 252 + 21).groupBy("series_id").agg(F.count("*").alias("rows"), F.min("session").alias("first"))


@query("c28_atr_ratio")
def c28(spark, sf):
    bars = panel.bars_anchor(spark, sf).withColumn("tr", R.true_range(C("high"), C("low"), C("close")))
    long = folds.atr(bars, 50).select("series_id", "session", C("atr").alias("long"))
    return folds.atr(bars, 14).join(long, ["series_id", "session"]).select("series_id", "session", F.round(C("atr") / F.nullif(C("long"), F.lit(0.0)), 5).alias("ratio"))


@query("h04_trend_character")
def h04(spark, sf):
    return rules.labelled(families.character_features(panel.bars_anchor(spark, sf)), rules.CHARACTER).select("series_id", "session", "label")


@query("d10_credit_features", f"""{FEATURES_SQL}, x AS (SELECT *, list(day_range) {_frame(60)} AS xs, ret21 - ret5 AS differential FROM f) SELECT series_id, session, {_r("CASE WHEN len(xs) = 60 THEN (len(list_filter(xs, lambda y: y < day_range)) + (len(list_filter(xs, lambda y: y = day_range)) + 1) / 2.0) / 60.0 END")} AS level_pct, {_r(_full('regr_slope(day_range, pos)', 21, 'day_range'))} AS slope, {_r('differential')} AS differential FROM x""")
def d10(spark, sf):
    f = features(spark, sf)
    x = C("day_range")
    return f.select("series_id", "session", F.round(R.percentile_average_rank(x, 60), 5).alias("level_pct"), F.round(R.ols_slope(x, C("pos"), 21), 5).alias("slope"), F.round(C("ret21") - C("ret5"), 5).alias("differential"))


@query("d11_inflation_features", f"{ctes('sessions', 'macro')}, {_CPI} SELECT session, {_r('v / lag(v, 63) OVER (ORDER BY pos) - 1')} AS change3, {_r('v / lag(v, 126) OVER (ORDER BY pos) - 1')} AS change6, {_r('CASE WHEN count(v) OVER w = 21 THEN regr_slope(v / 1000, pos) OVER w END')} AS slope FROM s WINDOW w AS (ORDER BY pos ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)")
def d11(spark, sf):
    m = panel.macro(spark, sf).where("vintage = 0").groupBy("published").agg(F.avg("value").alias("v")).withColumn("series_id", F.lit("m"))
    s = align.as_of(panel.sessions(spark, sf).withColumn("series_id", F.lit("m")), m, "published", ["v"], ["series_id"])
    v = C("v")
    return s.select("session", F.round(R.period_return(v, 63), 5).alias("change3"), F.round(R.period_return(v, 126), 5).alias("change6"), F.round(R.ols_slope(v / 1000, C("pos"), 21), 5).alias("slope"))


@query("d14_news_index", f"{ctes('sessions', 'macro')}, {_CPI.replace('m.v FROM', 'm.v / 7000 AS v, m.published FROM')} SELECT session, {_r('CASE WHEN session - published <= 40 THEN avg(v) OVER (ORDER BY pos ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) END')} AS score FROM s")
def d14(spark, sf):
    m = panel.macro(spark, sf).where("vintage = 0").groupBy("published").agg((F.avg("value") / 7000).alias("v")).withColumns({"series_id": F.lit("m"), "seen": C("published")})
    s = align.as_of(panel.sessions(spark, sf).withColumn("series_id", F.lit("m")), m, "published", ["v", "seen"], ["series_id"])
    return s.select("session", F.round(F.when(F.datediff("session", "seen") <= 40, F.avg("v").over(R.last(21))), 5).alias("score"))


@query("d15_bias_rows", f"{ctes('membership')}, s AS (SELECT count(*) AS n, count(\"end\") AS e FROM membership) SELECT 'pct_above' AS feature, 'open_intervals_only' AS warning FROM s WHERE e = 0 UNION ALL SELECT 'high_low', 'some_open_intervals' FROM s WHERE n > e")
def d15(spark, sf):
    s = align.survivorship_biased(panel.membership(spark, sf))
    rows = s.select(F.explode(F.array(F.struct(F.lit("pct_above").alias("feature"), F.lit("open_intervals_only").alias("warning"), C("biased").alias("on")), F.struct(F.lit("high_low").alias("feature"), F.lit("some_open_intervals").alias("warning"), (C("intervals") > C("ended")).alias("on")))).alias("x"))
    return rows.where("x.on").select("x.feature", "x.warning")


@query("g01_normalised_events", f"{ctes('cal')}, w AS (SELECT * FROM (VALUES {', '.join(f"('{t}', '{l}', {calendar.WINDOWS[l][0]}, {calendar.WINDOWS[l][1]})" for t, l in calendar.LABELS.items())}) v(type, label, \"before\", \"after\")) SELECT date, type, label, \"before\", \"after\", publication_date FROM cal JOIN w USING (type)")
def g01(spark, sf):
    return calendar.normalised(panel.events_calendar(spark, sf)).select("date", "type", "label", "before", "after", "publication_date")


@query("g09_window_expansion", f"{ctes('sessions')} SELECT a.session AS anchor, s.session FROM sessions a JOIN sessions s ON s.pos BETWEEN a.pos - 2 AND a.pos + 3")
def g09(spark, sf):
    s = panel.sessions(spark, sf)
    spread = s.select(C("session").alias("anchor"), F.explode(F.sequence(C("pos") - 2, C("pos") + 3)).alias("pos"))
    return spread.join(s, "pos").select("anchor", "session")


@query("g12_quarantine_gate", "WITH q AS (SELECT event_type AS type, value IS NULL OR value < 0.05 OR json_extract_string(props, '$.k') IS NULL AS bad FROM events) SELECT type, count(*) AS n, count(*) FILTER (bad) AS bad, count(*) FILTER (bad) > 0.01 * count(*) AS fails FROM q GROUP BY 1")
def g12(spark, sf):
    return calendar.quarantine_gate(calendar.candidates(table(spark, sf, "events"), 0.05)).select("type", "n", "bad", "fails")


@query("g23_label_at_date", f"{ctes('sessions', 'cal')}, p AS (SELECT max(session) AS d FROM sessions WHERE session <= DATE '1998-06-30') SELECT p.d AS session, coalesce((SELECT min(type) FROM cal WHERE cal.date = p.d), 'none') AS first_type FROM p")
def g23(spark, sf):
    day = panel.sessions(spark, sf).where("session <= DATE '1998-06-30'").agg(F.max("session").alias("session"))
    return day.join(panel.events_calendar(spark, sf), C("session") == C("date"), "left").groupBy("session").agg(F.coalesce(F.min("type"), F.lit("none")).alias("first_type"))


@query("n05_unknown_stretch", f"{_labels(rules.VOLATILITY)}, g AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY pos) - row_number() OVER (PARTITION BY series_id, label ORDER BY pos) AS k FROM l) SELECT series_id, max(n) AS longest FROM (SELECT series_id, k, count(*) AS n FROM g WHERE label = 'unknown' GROUP BY 1, 2) GROUP BY 1")
def n05(spark, sf):
    return evaluate.longest_runs(labels(spark, sf, rules.VOLATILITY)).where("label = 'unknown'").select("series_id", "longest")


_CRASHES = "w AS (SELECT r_name AS name, DATE '1996-01-01' + r_regionkey * 200 AS start, DATE '1996-01-01' + r_regionkey * 200 + 90 AS \"end\" FROM region)"


def _strategy_sql(name: str, average: str) -> str:
    """The four metrics of being long above an average, as one table expression after another."""
    order = "(PARTITION BY series_id ORDER BY pos)"
    to_date = "(PARTITION BY series_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"""{name}x AS (SELECT series_id, pos, session, CASE WHEN close > {average} THEN 0.01 ELSE 0.0 END AS e, ret1 FROM f),
{name}g AS (SELECT *, coalesce(lag(e) OVER {order} * ret1, 0) AS gain, lag(e) OVER {order} AS b, lead(e, 1) OVER {order} AS a1, lead(e, 2) OVER {order} AS a2, lead(e, 3) OVER {order} AS a3 FROM {name}x),
{name}q AS (SELECT *, exp(sum(ln(1 + gain)) OVER {to_date}) AS equity FROM {name}g), {name}p AS (SELECT *, equity / greatest(1.0, max(equity) OVER {to_date}) - 1 AS fall FROM {name}q),
{name}k AS (SELECT x.*, name, row_number() OVER (PARTITION BY series_id, name ORDER BY pos) - 1 AS k FROM {name}x x JOIN w ON session BETWEEN start AND "end"),
{name}l AS (SELECT series_id, avg(lag) AS lag FROM (SELECT series_id, name, coalesce(min(k) FILTER (e = 0), count(*)) AS lag FROM {name}k GROUP BY 1, 2) GROUP BY 1),
{name} AS (SELECT series_id, least(0, min(fall)) AS drawdown, CASE WHEN stddev_samp(gain) > 0 THEN avg(gain) / stddev_samp(gain) * sqrt(252) ELSE 0 END AS sharpe,
  coalesce(count(*) FILTER (e <> b AND (a1 = b OR a2 = b OR a3 = b)) / nullif(count(*) FILTER (e <> b), 0), 0.0) AS switch_rate FROM {name}p GROUP BY 1)"""


@query("n12_promotion_gate", f"""{FEATURES_SQL}, {_CRASHES}, {_strategy_sql('old', 'sma50')}, {_strategy_sql('new', 'sma200')},
g AS (SELECT o.series_id, concat_ws(',', CASE WHEN n.drawdown > o.drawdown THEN 'lower_drawdown' END, CASE WHEN n.sharpe > o.sharpe THEN 'higher_sharpe' END, CASE WHEN newl.lag < oldl.lag THEN 'earlier_crisis_detection' END, CASE WHEN n.switch_rate < o.switch_rate THEN 'lower_false_switch_rate' END) AS winners
  FROM old o JOIN new n USING (series_id) LEFT JOIN oldl ON o.series_id = oldl.series_id LEFT JOIN newl ON o.series_id = newl.series_id)
SELECT series_id, winners <> '' AS passed, winners FROM g""")
def n12(spark, sf):
    """Being long above the average of 50 sessions, against that of 200 as the candidate."""
    first = F.lit("1996-01-01").cast("date")
    windows = table(spark, sf, "region").select(C("r_name").alias("name"), F.date_add(first, C("r_regionkey") * 200).alias("start"), F.date_add(first, C("r_regionkey") * 200 + 90).alias("end"))
    f = features(spark, sf)
    of = lambda average: evaluate.metrics(f.select("series_id", "session", "pos", F.when(C("close") > C(average), 0.01).otherwise(0.0).alias("exposure"), C("ret1").alias("ret")), windows)
    return evaluate.promotion_gate(of("sma50"), of("sma200"))


@query("n18_trades_avoided", f"{FEATURES_SQL}, x AS (SELECT series_id, ret1, lag(CASE WHEN close > sma50 THEN 1 ELSE 0 END) OVER (PARTITION BY series_id ORDER BY pos) AS held FROM f) SELECT series_id, count(*) FILTER (held = 0 AND ret1 < 0) AS avoided FROM x GROUP BY 1")
def n18(spark, sf):
    rows = features(spark, sf).select("series_id", "pos", F.when(C("close") > C("sma50"), 1).otherwise(0).alias("exposure"), C("ret1").alias("ret"))
    return evaluate.trades_avoided(rows)


@query("n25_label_rule_summary", f"{FEATURES_SQL}, l AS (SELECT {rules.case(rules.TREND)} AS label, CASE WHEN rv_pct IS NULL THEN 'cold_start' ELSE 'percentile' END AS path FROM f) SELECT label, path, count(*) AS n FROM l GROUP BY 1, 2")
def n25(spark, sf):
    f = features(spark, sf).select(rules.label(rules.TREND).alias("label"), F.when(C("rv_pct").isNull(), "cold_start").otherwise("percentile").alias("path"))
    return f.groupBy("label", "path").agg(F.count("*").alias("n"))


@query("o05_stale_latest", f"{ctes('macro')} SELECT series_id, max(obs_date) AS latest, max(obs_date) < DATE '2001-12-01' AS stale FROM macro GROUP BY 1")
def o05(spark, sf):
    out = panel.macro(spark, sf).groupBy("series_id").agg(F.max("obs_date").alias("latest"))
    return out.withColumn("stale", C("latest") < F.lit("2001-12-01").cast("date"))


@query("o07_nested_points", "SELECT user_id, event_id, value FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE value > 0) WHERE k = 1")
def o07(spark, sf):
    last = F.max_by(F.struct("event_id", "value"), F.struct("ts", "event_id"))
    return table(spark, sf, "events").where("value > 0").groupBy("user_id").agg(last.alias("last")).select("user_id", "last.event_id", "last.value")


@query("b21_previous_by_window", f"{ctes('sessions')} SELECT session, lag(session) OVER (ORDER BY pos) AS previous FROM sessions")
def b21(spark, sf):
    return panel.sessions(spark, sf).select("session", F.lag("session").over(Window.orderBy("pos")).alias("previous"))


