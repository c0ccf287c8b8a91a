"""Queries of labels, quality, folds, calendars, transition, evaluation and text, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import rolling as R
from tidemark.operators import calendar, evaluate, folds, quality, rules, text, transition
from tidemark.plans.rolling_queries import _frame, _full, _lag
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


# Features of the anchor panel.
_PCT = "len(list_filter({x}s, lambda y: y <= {x})) / 252.0"
FEATURES_SQL = f"""{ctes('bars')},
f0 AS (SELECT *, close / nullif({_lag('close', 1)}, 0) - 1 AS ret1, (high - low) / close AS day_range, abs(open / nullif({_lag('close', 1)}, 0) - 1) AS gap, greatest(high - low, abs(high - {_lag('close', 1)}), abs(low - {_lag('close', 1)})) AS tr FROM bars),
f1 AS (SELECT *, close / nullif({_lag('close', 5)}, 0) - 1 AS ret5, close / nullif({_lag('close', 10)}, 0) - 1 AS ret10, close / nullif({_lag('close', 21)}, 0) - 1 AS ret21, close / nullif({_lag('close', 63)}, 0) - 1 AS ret63,
  close / nullif({_lag('close', 126)}, 0) - 1 AS ret126, {_full('avg(close)', 50, 'close')} AS sma50, {_full('avg(close)', 200, 'close')} AS sma200, close / {_full('max(close)', 252, 'close')} - 1 AS dd252,
  {_full('stddev_samp(ret1)', 10, 'ret1')} * sqrt(252) AS rv10, {_full('stddev_samp(ret1)', 21, 'ret1')} * sqrt(252) AS rv21, {_full('stddev_samp(ret1)', 63, 'ret1')} * sqrt(252) AS rv63,
  (volume - {_full('avg(volume)', 20, 'volume')}) / nullif({_full('stddev_samp(volume)', 20, 'volume')}, 0) AS volume_z, {_full('avg(CASE WHEN gap > 0.5 THEN 1.0 ELSE 0.0 END)', 20, 'gap')} AS gap_freq, {_full('avg(tr)', 14, 'tr')} / nullif({_full('avg(tr)', 50, 'tr')}, 0) AS atr_ratio, 50 * {_full('avg(sign(ret1))', 40, 'ret1')} AS sentiment FROM f0),
f2 AS (SELECT *, list(rv21) {_frame(252)} AS rv21s, list(rv10) {_frame(252)} AS rv10s, count(rv10) {_frame(252)} AS n4, list(gap_freq) {_frame(252)} AS gap_freqs, list(day_range) {_frame(252)} AS day_ranges, count(rv21) {_frame(252)} AS n1, count(gap_freq) {_frame(252)} AS n2, count(day_range) {_frame(252)} AS n3, {_lag('rv21', 5)} AS rv21_5 FROM f1),
f AS (SELECT *, CASE WHEN n1 = 252 THEN {_PCT.format(x='rv21')} END AS rv_pct, CASE WHEN n2 = 252 THEN {_PCT.format(x='gap_freq')} END AS gap_pct, CASE WHEN n3 = 252 THEN {_PCT.format(x='day_range')} END AS range_pct, CASE WHEN n4 = 252 THEN {_PCT.format(x='rv10')} END AS vix_pct, ret5 AS iv_change FROM f2)"""


def features(spark, sf):
    """The anchor panel's features."""
    return features_of(panel.bars_anchor(spark, sf))


def features_of(bars):
    """Features of a panel of bars with pos, in two window passes over one partitioning by series."""
    close = C("close")
    out = bars.withColumns({"ret1": R.period_return(close, 1), "day_range": (C("high") - C("low")) / close, "gap": F.abs(C("open") / F.nullif(R.lag(close, 1), F.lit(0.0)) - 1), "tr": R.true_range(C("high"), C("low"), close)})
    out = out.withColumns({f"ret{n}": R.period_return(close, n) for n in (5, 10, 21, 63, 126)} | {"sma50": R.sma(close, 50), "sma200": R.sma(close, 200), "dd252": R.drawdown(close, 252)} | {f"rv{n}": R.realized_vol(C("ret1"), n) for n in (10, 21, 63)} | {"volume_z": R.zscore(C("volume"), 20), "gap_freq": R.gap_frequency(C("gap"), 20, 0.5), "atr_ratio": R.sma(C("tr"), 14) / F.nullif(R.sma(C("tr"), 50), F.lit(0.0)), "sentiment": 50 * R.sma(F.signum("ret1"), 40)})
    out = out.withColumns({"rv_pct": R.percentile_max_rank(C("rv21"), 252), "gap_pct": R.percentile_max_rank(C("gap_freq"), 252), "range_pct": R.percentile_max_rank(C("day_range"), 252), "rv21_5": R.lag(C("rv21"), 5)})
    return out.withColumns({"vix_pct": R.percentile_max_rank(C("rv10"), 252), "iv_change": C("ret5")})


#: The same over the market panel.
MARKET_SQL = FEATURES_SQL.replace(ctes("bars"), ctes("market")).replace("AS tr FROM bars)", "AS tr FROM market)")

_SHOWN = ("ret63", "sma50", "dd252", "rv21", "rv_pct", "volume_z", "gap_pct", "range_pct")


@query("d05_feature_table", f"{FEATURES_SQL} SELECT series_id, session, {', '.join(f'round({c}, 5) AS {c}' for c in _SHOWN)} FROM f")
def d05(spark, sf):
    return features(spark, sf).select("series_id", "session", *(F.round(c, 5).alias(c) for c in _SHOWN))


def _axis(name: str, ladder: list, overlay: list | None = None) -> None:
    sql = f"{FEATURES_SQL}, l AS (SELECT *, {rules.case(ladder)} AS label FROM f) SELECT series_id, session, {rules.case(overlay, 'label') if overlay else 'label'} AS label FROM l"
    query(name, sql)(lambda spark, sf: rules.labelled(features(spark, sf), ladder, overlay).select("series_id", "session", "label"))


_axis("h01_trend", rules.TREND)
_axis("h02_trend_overlay", rules.TREND, rules.TREND_OVERLAY)
_axis("h05_volatility", rules.VOLATILITY)


# Volatility after events: up to five days after a meeting.
_AFTER = f"{FEATURES_SQL.replace(ctes('bars'), ctes('bars', 'cal'))}, e AS (SELECT DISTINCT CAST(date + k AS DATE) AS session FROM cal, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE type = 'FOMC'), g AS (SELECT f.*, e.session IS NOT NULL AS after_event FROM f LEFT JOIN e USING (session))"


@query("h06_volatility_overlay", f"{_AFTER}, l AS (SELECT *, {rules.case(rules.VOLATILITY)} AS label FROM g) SELECT series_id, session, {rules.case(rules.VOLATILITY_OVERLAY, 'label')} AS label FROM l")
def h06(spark, sf):
    after = panel.events_calendar(spark, sf).where("type = 'FOMC'").select(F.explode(F.sequence(F.date_add("date", 1), F.date_add("date", 5))).alias("session")).distinct()
    f = features(spark, sf).join(after.withColumn("after_event", F.lit(True)), "session", "left").withColumn("after_event", F.coalesce("after_event", F.lit(False)))
    return rules.labelled(f, rules.VOLATILITY, rules.VOLATILITY_OVERLAY).select("series_id", "session", "label")


_axis("h10_volume", rules.VOLUME)

# Wide tables by session: the three anchor series play the inputs of the other axes.
WIDE_SQL = f"""{FEATURES_SQL}, wide AS (SELECT a.session, a.pos, a.ret21, a.ret1, a.rv21, a.rv_pct, a.close / n.close AS ratio, n.ret21 AS bond_ret21, n.ret5 AS n5, r.ret5 AS r5, r.ret21 AS r21, n.rv_pct AS hy_pct, a.dd252 AS from_high, n.gap_pct AS corr_pct, r.range_pct AS eig_pct, n.range_pct AS dispersion_pct, r.gap_pct AS rank_pct
  FROM f a JOIN f n ON a.session = n.session AND n.series_id = 'N' JOIN f r ON a.session = r.session AND r.series_id = 'R' WHERE a.series_id = 'A')"""


def wide(spark, sf):
    f = features(spark, sf)
    a, n, r = (f.where(C("series_id") == s) for s in "ANR")
    n = n.select("session", C("close").alias("n_close"), C("ret21").alias("bond_ret21"), C("ret5").alias("n5"), C("rv_pct").alias("hy_pct"), C("gap_pct").alias("corr_pct"), C("range_pct").alias("dispersion_pct"))
    r = r.select("session", C("ret5").alias("r5"), C("ret21").alias("r21"), C("range_pct").alias("eig_pct"), C("gap_pct").alias("rank_pct"))
    a = a.select("series_id", "session", "pos", "close", "ret21", "ret1", "rv21", "rv_pct", C("dd252").alias("from_high"))
    return a.join(n, "session").join(r, "session").withColumn("ratio", C("close") / C("n_close"))


def _wide_axis(name: str, ladder: list, made: dict, overlay: list | None = None) -> None:
    """made: column: (Spark expression as SQL); the same text serves both engines."""
    more = ", ".join(f"{e} AS {c}" for c, e in made.items())
    query(name, f"{WIDE_SQL}, w AS (SELECT *, {more} FROM wide) SELECT session, {rules.case(ladder)} AS label FROM w")(lambda spark, sf: wide(spark, sf).withColumns({c: F.expr(e) for c, e in made.items()}).withColumn("label", rules.label(ladder)).select("session", "label"))


_LAG = "lag({x}, {n}) OVER (ORDER BY session)"
_wide_axis("h07_breadth", rules.BREADTH, {"ratio_sma": "avg(ratio) OVER (ORDER BY session ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)", "ratio_ret20": f"ratio / {_LAG.format(x='ratio', n=20)} - 1"})
_wide_axis("h11_monetary", rules.MONETARY, {"z2y": "n5", "z10y": "r5", "z_usd": "ret21", "z2y_short": "bond_ret21", "z10y_short": "r21"})
_wide_axis("h12_credit", rules.CREDIT, {"z_usd": "n5", "funding_slope": "r5", "hy_slope": f"hy_pct - {_LAG.format(x='hy_pct', n=5)}", "ig_slope": "r21", "corr": "corr_pct"})
_wide_axis("h14_inflation", rules.INFLATION, {"surprise": "n5", "commodity63": "r21", "yield_slope": "r5", "cpi3": "ret1 / 100", "cpi6": "ret21 / 10", "cpi6_lag": f"{_LAG.format(x='ret21', n=21)} / 10", "cpi_slope": "bond_ret21", "pmi": "30 + 40 * coalesce(corr_pct, 0.5)", "pmi_slope": "n5 - r5", "rotation": "r21 - bond_ret21", "credit": "CASE WHEN hy_pct IS NULL THEN NULL WHEN hy_pct > 0.8 THEN 'credit_stress' WHEN hy_pct > 0.5 THEN 'spread_widening' ELSE 'credit_calm' END", "eps": "ret1 / 10"})
_wide_axis("h09_network", rules.NETWORK, {"dd21": "from_high", "corr": "corr_pct", "eig": "eig_pct", "absorption": "rank_pct - 0.05", "corr_slope": "n5", "eig_slope": "r5", "rank_stability": "abs(ret1)", "vix_pct": "rv_pct", "breadth": "CASE WHEN ret21 < 0 THEN 'weak_breadth' ELSE 'neutral_breadth' END", "credit": "CASE WHEN hy_pct > 0.8 THEN 'credit_stress' END"})
_wide_axis("h08_breadth_overlay", [*rules.BREADTH_OVERLAY, ("unchanged", "true")], {"thrust": "corr_pct", "thrust_low": f"least({_LAG.format(x='corr_pct', n=1)}, {_LAG.format(x='corr_pct', n=5)})", "label": "'weak_breadth'", "above50": "hy_pct", "above50_5": _LAG.format(x="hy_pct", n=5), "above200": "rv_pct", "above200_5": _LAG.format(x="rv_pct", n=5), "high_low": "eig_pct", "high_low_5": _LAG.format(x="eig_pct", n=5), "ad_slope": "r21"})

_STATUS = f"""{FEATURES_SQL}, l AS (SELECT *, {rules.case(rules.TREND)} AS label, {_lag('0', 59)} IS NULL AS short,
  count(volume_z) {_frame(60)} / 60.0 AS share, pos - coalesce(max(CASE WHEN volume_z IS NOT NULL THEN pos END) {_frame(60)}, pos - 60) AS age FROM f),
q AS (SELECT *, CASE WHEN short THEN 'insufficient_history' WHEN age > 3 THEN 'stale_data' WHEN share < 0.7 THEN 'insufficient_data' WHEN label = 'unknown' THEN 'insufficient_history' WHEN share < 0.9 THEN 'degraded' ELSE 'ok' END AS status FROM l)"""


def assessed(spark, sf):
    f = rules.labelled(features(spark, sf), rules.TREND)
    return quality.assessed(f, ["volume_z"], 60, 3, 0.9, C("label"))


@query("i01_quality", f"{_STATUS} SELECT series_id, session, status FROM q")
def i01(spark, sf):
    return assessed(spark, sf).select("series_id", "session", "status")


def _rank_sql(axis: str, x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.RANKS[axis].items()) + " END"


def _leave_sql(axis: str, x: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in rules.LEAVE[axis].items()) + " ELSE 0 END"


def _hysteresis_sql(axis: str, source: str) -> str:
    r, s = _rank_sql(axis, "l.label"), _rank_sql(axis, "h.stable")
    count = "CASE WHEN h.pending = l.label THEN h.n + 1 ELSE 1 END"
    enters = f"({r} > {s} OR (l.label <> h.stable AND {count} >= greatest(1, {_leave_sql(axis, 'h.stable')})))"
    return f"""{source}, h AS (
  SELECT series_id, pos, session, label, label AS stable, CAST(NULL AS VARCHAR) AS pending, 0 AS n FROM l WHERE pos = 1
  UNION ALL
  SELECT l.series_id, l.pos, l.session, l.label, CASE WHEN {enters} THEN l.label ELSE h.stable END, CASE WHEN l.label = h.stable OR {enters} THEN NULL ELSE l.label END, CASE WHEN l.label = h.stable OR {enters} THEN 0 ELSE {count} END
  FROM h JOIN l ON l.series_id = h.series_id AND l.pos = h.pos + 1)
SELECT series_id, session, label, stable AS stable_label, CASE WHEN {_rank_sql(axis, 'label')} > {_rank_sql(axis, 'stable')} THEN label ELSE stable END AS active_label FROM h"""


def _labels(ladder):
    return f"{FEATURES_SQL}, l AS MATERIALIZED (SELECT series_id, pos, session, {rules.case(ladder)} AS label FROM f)"


def labels(spark, sf, ladder=rules.TREND):
    return rules.labelled(features(spark, sf), ladder).select("series_id", "session", "pos", "label")


@query("trend_axis", _hysteresis_sql("trend", _labels(rules.TREND)))
def trend_axis(spark, sf):
    """The flagship: bars, features, raw label, and stable and active label by series."""
    out = folds.hysteresis(labels(spark, sf), rules.RANKS["trend"], rules.LEAVE["trend"])
    return out.select("series_id", "session", "label", "stable_label", "active_label")


@query("i07_hysteresis_volatility", _hysteresis_sql("volatility", _labels(rules.VOLATILITY)))
def i07(spark, sf):
    out = folds.hysteresis(labels(spark, sf, rules.VOLATILITY), rules.RANKS["volatility"], rules.LEAVE["volatility"])
    return out.select("series_id", "session", "label", "stable_label", "active_label")


@query("i08_quality_hysteresis")
def i08(spark, sf):
    rows = assessed(spark, sf).select("series_id", "session", "pos", "label", "status")
    return folds.hysteresis(rows, rules.RANKS["trend"], rules.LEAVE["trend"], freeze=2, status="status").select("series_id", "session", "status", "label", "stable_label", "active_label", "frozen")


@query("i13_debounce")
def i13(spark, sf):
    return folds.debounce(labels(spark, sf, rules.VOLATILITY), {"high_vol": 2, "low_vol": 3}, "label").select("series_id", "session", "label", "confirmed", "pending")


@query("i14_run_length", f"{_labels(rules.TREND)}, g AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY pos) - row_number() OVER (PARTITION BY series_id, label ORDER BY pos) AS k FROM l) SELECT series_id, session, label, row_number() OVER (PARTITION BY series_id, label, k ORDER BY pos) AS length FROM g")
def i14(spark, sf):
    return quality.runs(labels(spark, sf), "label").select("series_id", "session", "label", "length")


def _wilder_sql(seeded: bool, n: int = 14) -> str:
    tr = f"{ctes('bars')}, t AS MATERIALIZED (SELECT series_id, pos, session, greatest(high - low, abs(high - {_lag('close', 1)}), abs(low - {_lag('close', 1)})) AS tr FROM bars)"
    start = f"SELECT series_id, {n} AS pos, avg(tr) AS v FROM t WHERE pos <= {n} GROUP BY 1 HAVING count(*) = {n}" if seeded else "SELECT series_id, 1 AS pos, tr AS v FROM t WHERE pos = 1"
    return f"{tr}, h AS ({start} UNION ALL SELECT t.series_id, t.pos, h.v + (t.tr - h.v) / {n} FROM h JOIN t ON t.series_id = h.series_id AND t.pos = h.pos + 1) SELECT t.series_id, t.session, round(CASE WHEN t.pos >= {n} THEN h.v END, 5) AS value FROM t LEFT JOIN h USING (series_id, pos)"


def _ranges(spark, sf):
    bars = panel.bars_anchor(spark, sf)
    return bars.withColumn("tr", R.true_range(C("high"), C("low"), C("close")))


@query("c11_wilder_atr", _wilder_sql(True))
def c11(spark, sf):
    return folds.atr(_ranges(spark, sf)).select("series_id", "session", F.round("atr", 5).alias("value"))


@query("c12_wilder_ewm", _wilder_sql(False))
def c12(spark, sf):
    return folds.ewm(_ranges(spark, sf)).select("series_id", "session", F.round("ewm", 5).alias("value"))


@query("c13_adx")
def c13(spark, sf):
    return folds.adx(panel.bars_anchor(spark, sf)).select("series_id", "session", F.round("adx", 5).alias("value"))


_H = "(PARTITION BY series_id ORDER BY pos)"
_CHANGED = f"{_labels(rules.TREND)}, c AS (SELECT *, CASE WHEN pos > 1 AND label IS DISTINCT FROM lag(label) OVER {_H} THEN 1 ELSE 0 END AS changed FROM l)"


@query("j01_switch_history", f"""{_CHANGED}, s AS (SELECT *, sum(changed) OVER {_H[:-1]} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS changes, pos - max(CASE WHEN changed = 1 THEN pos END) OVER {_H[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since, coalesce(max(CASE WHEN label = 'bear' THEN 1 ELSE 0 END) OVER {_H[:-1]} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING), 0) AS bad_before FROM c)
SELECT series_id, session, changed, CAST(changes AS BIGINT) AS changes, CASE WHEN since <= 60 THEN since END AS since, bad_before FROM s""")
def j01(spark, sf):
    return evaluate.history(labels(spark, sf)).select("series_id", "session", "changed", "changes", "since", "bad_before")


def _pressure(spark, sf):
    """Component scores of the anchor panel; its percentiles of gaps, volatility and ranges stand for breadth, correlation and credit,
    which the market panel's score (j03_market_score) reads from members, correlations and axes."""
    macro = calendar.painted(calendar.normalised(panel.events_calendar(spark, sf)), panel.sessions(spark, sf)).where(C("label").isin(*transition.MACRO_EVENTS))
    f = features(spark, sf).join(macro.select("session", F.lit(True).alias("event")).distinct(), "session", "left").withColumn("event", F.coalesce("event", F.lit(False)))
    f = f.withColumns({"rv_short": C("rv10"), "rv_long": C("rv63"), "pct_above": C("gap_pct"), "corr_pct": C("rv_pct"), "credit_score": C("range_pct"), "change_point": F.abs(C("ret1"))})
    return transition.scored(transition.components(f))


_PAINTED = f"""w AS (SELECT * FROM (VALUES {', '.join(f"('{t}', '{l}', {calendar.WINDOWS[l][0]}, {calendar.WINDOWS[l][1]})" for t, l in calendar.LABELS.items())}) v(type, label, a, b)),
painted AS (SELECT DISTINCT s.session, w.label FROM cal JOIN w USING (type) JOIN sessions e ON e.session = cal.date JOIN sessions s ON s.pos BETWEEN e.pos + a AND e.pos + b WHERE s.session >= cal.publication_date)"""
_WITH_EVENTS = FEATURES_SQL.replace(ctes("bars"), f"{ctes('bars', 'sessions', 'cal')}, {_PAINTED}")
_CLIP = "greatest(0.0, least(1.0, {}))"
_SCORE = f"""{_WITH_EVENTS}, k AS (SELECT *, greatest(CASE WHEN dd252 IS NOT NULL THEN {_CLIP.format('-dd252 / 0.15')} END, CASE WHEN sma50 IS NOT NULL THEN {_CLIP.format('(sma50 - close) / nullif(sma50, 0) / 0.05')} END) AS tb0, {_CLIP.format('(rv10 / nullif(rv63, 0) - 1) / 0.5')} AS va0, {_CLIP.format('(0.5 - gap_pct) / 0.3')} AS bd0, {_CLIP.format('(volume_z - 1.0) / 2.0')} AS ls0, {_CLIP.format('abs(ret1)')} AS mi0, CASE WHEN session IN (SELECT session FROM painted WHERE label IN {transition.MACRO_EVENTS}) THEN 1.0 ELSE 0.0 END AS me FROM f),
c AS (SELECT *, CASE WHEN dd252 IS NOT NULL OR sma50 IS NOT NULL THEN tb0 END AS tb, CASE WHEN rv10 IS NOT NULL AND rv63 IS NOT NULL THEN va0 END AS va, CASE WHEN gap_pct IS NOT NULL THEN bd0 END AS bd, CASE WHEN volume_z IS NOT NULL OR gap_pct IS NOT NULL THEN greatest(CASE WHEN volume_z IS NOT NULL THEN ls0 END, gap_pct) END AS ls, CASE WHEN ret1 IS NOT NULL THEN mi0 END AS mi FROM k),
s AS (SELECT *, 0.18 * tb + 0.16 * va + 0.16 * bd + 0.14 * rv_pct + 0.12 * range_pct + 0.10 * ls + 0.06 * me + 0.08 * mi AS score FROM c)
SELECT series_id, session, round(score, 5) AS score, CASE WHEN score IS NULL THEN 'insufficient_data' WHEN score < 0.35 THEN 'stable' WHEN score < 0.55 THEN 'weakening' WHEN score < 0.75 THEN 'transition_warning' ELSE 'high_transition_risk' END AS band FROM s"""


@query("j03_transition_score", _SCORE)
def j03(spark, sf):
    return _pressure(spark, sf).select("series_id", "session", F.round("score", 5).alias("score"), "band")


_PAINT = f"""{ctes('sessions', 'cal')}, w AS (SELECT * FROM (VALUES {', '.join(f"('{t}', '{l}', {calendar.WINDOWS[l][0]}, {calendar.WINDOWS[l][1]})" for t, l in calendar.LABELS.items())}) v(type, label, a, b)),
painted AS (SELECT DISTINCT s.session, w.label FROM cal JOIN w USING (type) JOIN sessions e ON e.session = cal.date JOIN sessions s ON s.pos BETWEEN e.pos + a AND e.pos + b WHERE s.session >= cal.publication_date)"""


@query("g02_event_windows", f"{_PAINT} SELECT session, label FROM painted")
def g02(spark, sf):
    return calendar.painted(calendar.normalised(panel.events_calendar(spark, sf)), _event_sessions(spark, sf))


def _event_sessions(spark, sf):
    return panel.sessions(spark, sf)


@query("g05_just_passed", f"{_PAINT} SELECT DISTINCT s.session FROM cal JOIN w USING (type) JOIN sessions e ON e.session = cal.date JOIN sessions s ON s.pos BETWEEN e.pos + b + 1 AND e.pos + b + 3 WHERE type IN ('FOMC', 'CPI', 'NFP') AND s.session >= publication_date")
def g05(spark, sf):
    return calendar.just_passed(calendar.normalised(panel.events_calendar(spark, sf)), panel.sessions(spark, sf))


_EXPIRY = f"""{ctes('sessions')}, m AS (SELECT DISTINCT CAST(date_trunc('month', session) AS DATE) AS m FROM sessions), d AS (SELECT CAST(m + ((12 - isodow(m)) % 7 + 14) * INTERVAL 1 DAY AS DATE) AS friday FROM m),
p AS (SELECT friday, max(pos) AS p FROM d JOIN sessions ON session <= friday AND session > friday - 7 GROUP BY 1) SELECT DISTINCT s.session, 'expiry_week' AS label FROM p JOIN sessions s ON s.pos BETWEEN p - 2 AND p"""


@query("g03_expiry_weeks", _EXPIRY)
def g03(spark, sf):
    return calendar.expiry_weeks(panel.sessions(spark, sf))


@query("g04_earnings_seasons", f"""{ctes('sessions')}, q AS (SELECT DISTINCT unnest([CAST(date_trunc('quarter', session) AS DATE), CAST(date_trunc('quarter', session) - INTERVAL 3 MONTH AS DATE)]) AS q FROM sessions), m AS (SELECT CAST(q + ((8 - isodow(q)) % 7 + 7) * INTERVAL 1 DAY AS DATE) AS monday FROM q)
SELECT DISTINCT session, 'earnings_season' AS label FROM sessions JOIN m ON session BETWEEN monday AND monday + 35""")
def g04(spark, sf):
    return calendar.earnings_seasons(panel.sessions(spark, sf))


@query("g06_primary_label", f"""{_PAINT}, r AS (SELECT session, label, list_position({list(calendar.PRECEDENCE)}, label) AS rank FROM painted)
SELECT s.session, coalesce(arg_min(r.label, r.rank), 'normal_calendar') AS label, coalesce(array_to_string(list(r.label ORDER BY r.rank), ','), 'normal_calendar') AS matching FROM sessions s LEFT JOIN r USING (session) GROUP BY 1""")
def g06(spark, sf):
    s = panel.sessions(spark, sf)
    return calendar.labels(s, calendar.painted(calendar.normalised(panel.events_calendar(spark, sf)), s))


@query("g08_elections", "SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year, CAST(make_date(CAST(year(o_orderdate) AS INT), 11, 1) + ((8 - isodow(make_date(CAST(year(o_orderdate) AS INT), 11, 1))) % 7 + 1) * INTERVAL 1 DAY AS DATE) AS election FROM orders WHERE year(o_orderdate) % 2 = 0")
def g08(spark, sf):
    return calendar.elections(table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct())


@query("g11_triangulation", """WITH c AS (SELECT event_type AS type, CAST(ts AS DATE) AS date, 's' || (user_id % 3) AS source, CASE user_id % 5 WHEN 0 THEN 'contradict' WHEN 1 THEN 'confirm' ELSE 'unknown' END AS verdict FROM events),
g AS (SELECT type, date, list_sort(list_distinct(list(source))) AS sources, count(*) FILTER (verdict = 'confirm') AS confirms, count(*) FILTER (verdict = 'contradict') AS contradicts FROM c GROUP BY 1, 2)
SELECT type, date, CAST(len(sources) AS INT) AS n_sources, confirms, contradicts, CASE WHEN contradicts > 0 THEN 'quarantined' WHEN len(sources) >= 2 AND confirms > 0 THEN 'promoted' ELSE 'review' END AS decision, substr(sha256(type || '|' || CAST(date AS VARCHAR) || '|' || array_to_string(sources, '|')), 1, 16) AS candidate_id FROM g""")
def g11(spark, sf):
    user = C("user_id")
    verdict = F.when(user % 5 == 0, "contradict").when(user % 5 == 1, "confirm").otherwise("unknown")
    rows = table(spark, sf, "events").select(C("event_type").alias("type"), F.to_date("ts").alias("date"), F.concat(F.lit("s"), (user % 3).cast("string")).alias("source"), verdict.alias("verdict"))
    return calendar.triangulated(rows)


_N = _labels(rules.VOLATILITY)


@query("n01_distribution", f"{_N} SELECT series_id, label, count(*) AS sessions, round(count(*) / sum(count(*)) OVER (PARTITION BY series_id), 6) AS share FROM l GROUP BY 1, 2")
def n01(spark, sf):
    return evaluate.distribution(labels(spark, sf, rules.VOLATILITY)).withColumn("share", F.round("share", 6))


@query("n02_longest_runs", f"{_N}, g AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY pos) - row_number() OVER (PARTITION BY series_id, label ORDER BY pos) AS k FROM l) SELECT series_id, label, max(n) AS longest FROM (SELECT series_id, label, k, count(*) AS n FROM g GROUP BY 1, 2, 3) GROUP BY 1, 2")
def n02(spark, sf):
    return evaluate.longest_runs(labels(spark, sf, rules.VOLATILITY))


@query("n04_switches", f"{_N}, s AS (SELECT *, lag(label) OVER w AS b, lag(1) OVER w IS NOT NULL AND label IS DISTINCT FROM lag(label) OVER w AS s, list(label) OVER (PARTITION BY series_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING) AS ahead FROM l WINDOW w AS (PARTITION BY series_id ORDER BY pos)) SELECT series_id, count(*) FILTER (s) AS switches, count(*) FILTER (s AND list_contains(ahead, b)) AS false_switches FROM s GROUP BY 1")
def n04(spark, sf):
    return evaluate.switches(labels(spark, sf, rules.VOLATILITY))


@query("n07_null_scan", f"{FEATURES_SQL} SELECT field, count(*) AS rows, count(*) FILTER (value IS NULL) AS nulls FROM (SELECT 'ret63' AS field, ret63 AS value FROM f UNION ALL SELECT 'rv_pct', rv_pct FROM f UNION ALL SELECT 'volume_z', volume_z FROM f) GROUP BY 1")
def n07(spark, sf):
    return evaluate.nulls(features(spark, sf), ["ret63", "rv_pct", "volume_z"])


@query("n08_red_flags", f"{_N}, d AS (SELECT series_id, label, count(*) / sum(count(*)) OVER (PARTITION BY series_id) AS share FROM l GROUP BY 1, 2), g AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY pos) - row_number() OVER (PARTITION BY series_id, label ORDER BY pos) AS k FROM l) SELECT DISTINCT series_id, 'dominant_label' AS flag FROM d WHERE share > 0.3 UNION SELECT DISTINCT series_id, 'long_unknown' FROM (SELECT series_id, k, count(*) AS n FROM g WHERE label = 'unknown' GROUP BY 1, 2) WHERE n > 20")
def n08(spark, sf):
    return evaluate.red_flags(labels(spark, sf, rules.VOLATILITY), most=0.3, unknown=20, flips=10**9)


@query("n11_version_difference", f"{FEATURES_SQL}, l AS (SELECT series_id, session, {rules.case(rules.TREND)} AS label FROM f), v AS (SELECT * FROM l), w AS (SELECT series_id, session, CASE WHEN label = 'bear' THEN 'bull' ELSE label END AS label FROM l WHERE session > DATE '1995-06-01') SELECT v.series_id, count(w.session) AS common, count(*) FILTER (w.session IS NOT NULL AND v.label IS DISTINCT FROM w.label) AS differ, count(*) FILTER (w.session IS NULL) AS misaligned FROM v LEFT JOIN w USING (series_id, session) GROUP BY 1")
def n11(spark, sf):
    a = labels(spark, sf)
    return evaluate.difference(a, a.where("session > DATE '1995-06-01'").withColumn("label", F.when(C("label") == "bear", "bull").otherwise(C("label"))))


@query("n22_disagreements", f"{_labels(rules.TREND)}, d AS (SELECT series_id, session, label AS before, 'bull' AS after, row_number() OVER (PARTITION BY series_id ORDER BY session DESC) AS k FROM l WHERE label = 'bear') SELECT series_id, session, before, after FROM d WHERE k <= 5")
def n22(spark, sf):
    a = labels(spark, sf)
    return evaluate.disagreements(a, a.withColumn("label", F.when(C("label") == "bear", "bull").otherwise(C("label")))).select("series_id", "session", "before", "after")


_EQUITY = f"{FEATURES_SQL}, e AS (SELECT series_id, pos, session, coalesce(lag(CASE WHEN close > sma50 THEN 0.01 ELSE 0.0 END) OVER {_H} * ret1, 0) AS gain FROM f), q AS (SELECT *, exp(sum(ln(1 + gain)) OVER {_H[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS equity FROM e)"


def _curve(spark, sf):
    f = features(spark, sf).withColumn("exposure", F.when(C("close") > C("sma50"), 0.01).otherwise(0.0)).withColumn("ret", C("ret1"))
    return evaluate.equity(f)


@query("n13_equity_curve", f"{_EQUITY} SELECT series_id, session, round(equity, 6) AS equity FROM q")
def n13(spark, sf):
    return _curve(spark, sf).select("series_id", "session", F.round("equity", 6).alias("equity"))


@query("n14_performance", f"{_EQUITY}, p AS (SELECT *, equity / greatest(1.0, max(equity) OVER {_H[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) - 1 AS fall FROM q) SELECT series_id, round(arg_max(equity, pos) - 1, 5) AS total, round(least(0, min(fall)), 5) AS drawdown, round(CASE WHEN stddev_samp(gain) > 0 THEN avg(gain) / stddev_samp(gain) * sqrt(252) ELSE 0 END, 5) AS sharpe FROM p GROUP BY 1")
def n14(spark, sf):
    return evaluate.performance(_curve(spark, sf)).select("series_id", *(F.round(c, 5).alias(c) for c in ("total", "drawdown", "sharpe")))


@query("n17_detection_lag", f"{FEATURES_SQL}, l AS (SELECT series_id, session, pos, {rules.case(rules.TREND)} AS label FROM f), w AS (SELECT r_name AS name, DATE '1996-01-01' + r_regionkey * 200 AS start, DATE '1996-01-01' + r_regionkey * 200 + 90 AS \"end\" FROM region), i AS (SELECT l.*, name, row_number() OVER (PARTITION BY series_id, name ORDER BY pos) - 1 AS k FROM l JOIN w ON session BETWEEN start AND \"end\") SELECT series_id, name, coalesce(min(k) FILTER (label = 'bear'), count(*)) AS lag, count(*) FILTER (label = 'bear') AS flat_sessions FROM i GROUP BY 1, 2")
def n17(spark, sf):
    first = F.lit("1996-01-01").cast("date")
    windows = table(spark, sf, "region").select(C("r_name").alias("name"), F.date_add(first, C("r_regionkey") * 200).alias("start"), F.date_add(first, C("r_regionkey") * 200 + 90).alias("end"))
    return evaluate.detection_lag(labels(spark, sf), windows, C("label") == "bear")


@query("n19_clean_window", f"{ctes('bars', 'sessions')}, b AS (SELECT s.session, s.pos, coalesce(r.volume < 150, false) AS good FROM sessions s LEFT JOIN (SELECT session, volume FROM bars WHERE series_id = 'R') r USING (session)) SELECT CAST(max(pos) - coalesce(max(pos) FILTER (NOT good), 0) AS BIGINT) AS clean, max(session) FILTER (NOT good) AS last_bad FROM b")
def n19(spark, sf):
    runs = panel.bars_anchor(spark, sf).where("series_id = 'R'").withColumn("good", C("volume") < 150)
    return evaluate.clean_window(panel.sessions(spark, sf), runs)


@query("n24_metric_summaries", f"{FEATURES_SQL}, x AS (SELECT series_id, session, 'ret21' AS field, ret21 AS value FROM f UNION ALL SELECT series_id, session, 'rv63', rv63 FROM f) SELECT series_id, field, count(*) AS rows, count(value) AS known, min(session) FILTER (value IS NOT NULL) AS first, max(session) FILTER (value IS NOT NULL) AS last, round(arg_min(value, session) FILTER (value IS NOT NULL), 5) AS first_value, round(arg_max(value, session) FILTER (value IS NOT NULL), 5) AS last_value FROM x GROUP BY 1, 2")
def n24(spark, sf):
    out = evaluate.summaries(features(spark, sf), ["ret21", "rv63"])
    return out.withColumns({c: F.round(c, 5) for c in ("first_value", "last_value")})


@query("m01_lexicon_scores", r"""WITH s AS (SELECT doc_id, len(regexp_extract_all(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', 'x', 'g'), '%s')) AS hawkish_count, len(regexp_extract_all(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]', 'x', 'g'), '%s')) AS dovish_count, len(regexp_extract_all(coalesce(text, ''), '\S+')) AS total_tokens FROM documents) SELECT *, (hawkish_count - dovish_count) / nullif(hawkish_count + dovish_count, 0) AS net_score FROM s""" % (text.pattern(("the", "that", "with")), text.pattern(("and", "und", "le", "of the"))))
def m01(spark, sf):
    out = text.lexicon_scores(table(spark, sf, "documents"), up=("the", "that", "with"), down=("and", "und", "le", "of the"))
    return out.select("doc_id", "hawkish_count", "dovish_count", "total_tokens", "net_score")


@query("m03_one_a_date", "WITH s AS (SELECT DATE '1970-01-01' + CAST(doc_id % 100 AS INT) AS release_date, n_chars AS total_tokens, doc_id % 7 / 7.0 AS net_score FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY release_date ORDER BY total_tokens DESC, net_score DESC) AS k FROM s) SELECT release_date, round(net_score, 6) AS net_score, total_tokens FROM r WHERE k = 1")
def m03(spark, sf):
    rows = table(spark, sf, "documents").select(F.date_add(F.lit("1970-01-01").cast("date"), (C("doc_id") % 100).cast("int")).alias("release_date"), C("n_chars").alias("total_tokens"), ((C("doc_id") % 7) / 7.0).alias("net_score"))
    return text.one_a_date(rows).withColumn("net_score", F.round("net_score", 6))


@query("m05_lexicon_validation", "WITH s AS (SELECT lang AS t, CASE WHEN text LIKE '%the%' THEN 'en' WHEN text LIKE '%und%' THEN 'de' ELSE 'fr' END AS g FROM documents), c AS (SELECT DISTINCT t AS label FROM s UNION SELECT DISTINCT g FROM s), a AS (SELECT label, count(*) FILTER (t = label AND g = label) AS right, count(*) FILTER (t = label) AS of_class, count(*) FILTER (g = label) AS guessed FROM c, s GROUP BY 1) SELECT *, round(right / nullif(guessed, 0), 6) AS precision, round(right / nullif(of_class, 0), 6) AS recall FROM a".replace("right", '"right"'))
def m05(spark, sf):
    t = C("text")
    guess = F.when(t.contains("the"), "en").when(t.contains("und"), "de").otherwise("fr")
    out = evaluate.confusion(table(spark, sf, "documents").withColumn("guess", guess), "lang", "guess").drop("f1")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query("m07_html_text", r"""SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<sup\b.*?</sup>', ' ', 'g'), '(?i)<br\s*/?>|</p>', chr(10), 'g'), '(?s)<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g')) AS body FROM pages""")
def m07(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.cleaned_html(C("html")).alias("body"))
