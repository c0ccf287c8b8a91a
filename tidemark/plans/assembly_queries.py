"""Queries of assembled axes, staleness clocks and strategy responses, each with SQL written by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import align, assembly, evaluate, rules, strategy, transition
from tidemark.plans.label_queries import _H, _SCORE, FEATURES_SQL, _hysteresis_sql, _pressure, features
from tidemark.plans.rolling_queries import _frame, _lag
from tidemark.sources import panel
from tidemark.sources.panel import ctes

QUERIES, ORACLE = {}, {}
C = F.col


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


CLOCKS = {"1-URGENT": "calendar", "2-HIGH": "trading", "3-MEDIUM": "calendar", "4-NOT SPECIFIED": "trading", "5-LOW": "calendar"}
PAIRS = [("1-URGENT", "2-HIGH"), ("3-MEDIUM", "4-NOT SPECIFIED")]


def _stale_sql(clocks: dict[str, str]) -> str:
    return f"""{ctes('sessions', 'macro')}, src AS (SELECT * FROM (VALUES {', '.join(f"('{s}', '{c}')" for s, c in clocks.items())}) v(source, clock)),
r AS (SELECT DISTINCT series_id AS source, published AS date FROM macro WHERE vintage = 0 AND value IS NOT NULL), grid AS (SELECT session, pos, source, clock FROM sessions, src),
by_day AS (SELECT g.session, g.pos, g.source, coalesce(g.session - r.date, 1000000000) AS days FROM grid g ASOF LEFT JOIN r ON g.source = r.source AND g.session >= r.date WHERE g.clock = 'calendar'),
by_session AS (SELECT g.session, g.pos, g.source, g.pos - coalesce(max(CASE WHEN r.date IS NOT NULL THEN g.pos END) OVER (PARTITION BY g.source ORDER BY g.pos), -1000000000) AS days FROM grid g LEFT JOIN r ON g.source = r.source AND g.session = r.date WHERE g.clock = 'trading'),
stale AS (SELECT session, pos, source, CAST(days AS BIGINT) AS days FROM by_day UNION ALL SELECT session, pos, source, CAST(days AS BIGINT) FROM by_session)"""


def _stale(spark, sf, clocks: dict[str, str]):
    readings = panel.macro(spark, sf).where("vintage = 0").select(C("series_id").alias("source"), C("published").alias("date"), "value")
    return assembly.staleness(panel.sessions(spark, sf), readings, clocks)


@query("i04_session_staleness", f"{_stale_sql(dict.fromkeys(CLOCKS, 'trading'))} SELECT session, source, days FROM stale")
def i04(spark, sf):
    return _stale(spark, sf, dict.fromkeys(CLOCKS, "trading")).select("session", "source", "days")


@query("i05_staleness_clock", f"{_stale_sql(CLOCKS)} SELECT session, source, days FROM stale")
def i05(spark, sf):
    return _stale(spark, sf, CLOCKS).select("session", "source", "days")


@query("i06_paired_staleness", f"""{_stale_sql(CLOCKS)}, w AS (SELECT session, max(days) FILTER (source = '1-URGENT') AS a, max(days) FILTER (source = '2-HIGH') AS b, max(days) FILTER (source = '3-MEDIUM') AS c, max(days) FILTER (source = '4-NOT SPECIFIED') AS d FROM stale GROUP BY session)
SELECT session, CASE WHEN greatest(a, b) < greatest(c, d) THEN greatest(a, b) ELSE greatest(c, d) END AS days FROM w""")
def i06(spark, sf):
    wide = _stale(spark, sf, CLOCKS).groupBy("session").pivot("source", list(CLOCKS)).agg(F.max("days"))
    return wide.select("session", assembly.paired([(f"`{a}`", f"`{b}`") for a, b in PAIRS]).alias("days"))


# Axes of trend and volatility: quality over the inputs' last 60 rows, hysteresis, forced labels, status.
AXES = {"trend": (rules.TREND, ["ret63", "volume_z"], ["sma50", "sma200", "ret63"]), "volatility": (rules.VOLATILITY, ["rv21", "ret1"], ["ret1", "ret5", "ret21", "rv_pct"])}


def _axis_sql(axis: str) -> str:
    ladder, inputs, used = AXES[axis]
    share = ", ".join(f"count({c}) {_frame(60)} / 60.0" for c in inputs)
    age = ", ".join(f"pos - coalesce(max(CASE WHEN {c} IS NOT NULL THEN pos END) {_frame(60)}, pos - 60)" for c in inputs)
    label = f"{FEATURES_SQL}, l AS MATERIALIZED (SELECT *, {rules.case(ladder)} AS label, {_lag('0', 59)} IS NULL AS short, least({share}) AS share, greatest({age}) AS age FROM f)"
    head, tail = _hysteresis_sql(axis, label).rsplit("\nSELECT ", 1)
    gone = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in sorted(used))
    return f"""{head}, x AS (SELECT {tail}),
q AS (SELECT *, CASE WHEN short THEN 'insufficient_history' WHEN age > 3 THEN 'stale_data' WHEN share < 0.7 THEN 'insufficient_data' WHEN label = 'unknown' THEN 'insufficient_history' WHEN share < 0.9 THEN 'degraded' ELSE 'ok' END AS status,
  list_filter([{gone}], lambda y: y IS NOT NULL) AS gone FROM l),
y AS (SELECT q.series_id, q.session, q.status, q.gone, status IN ('insufficient_history', 'stale_data', 'insufficient_data') AS forced, q.label, x.stable_label AS s, x.active_label AS a FROM q JOIN x USING (series_id, session)),
axis AS (SELECT series_id, session, status, gone, CASE WHEN forced THEN 'unknown' ELSE label END AS raw_label, CASE WHEN forced THEN 'unknown' ELSE s END AS stable_label, CASE WHEN forced THEN 'unknown' ELSE a END AS active_label FROM y)"""


def _axis(spark, sf, axis: str):
    ladder, inputs, _ = AXES[axis]
    return assembly.assembled(rules.labelled(features(spark, sf), ladder), inputs, 60, 3, 0.9, rules.RANKS[axis], rules.LEAVE[axis])


_SHOWN = ("series_id", "session", "status", "raw_label", "stable_label", "active_label")


@query("i09_axis_trend", f"{_axis_sql('trend')} SELECT {', '.join(_SHOWN)} FROM axis")
def i09_trend(spark, sf):
    return _axis(spark, sf, "trend").select(*_SHOWN)


@query("i09_axis_volatility", f"{_axis_sql('volatility')} SELECT {', '.join(_SHOWN)} FROM axis")
def i09_volatility(spark, sf):
    return _axis(spark, sf, "volatility").select(*_SHOWN)


@query("i02_forced_unknown", f"{_axis_sql('volatility')} SELECT series_id, session, raw_label AS label FROM axis WHERE status IN ('insufficient_history', 'stale_data', 'insufficient_data')")
def i02(spark, sf):
    return _axis(spark, sf, "volatility").where(C("status").isin(*assembly.FORCING)).select("series_id", "session", C("raw_label").alias("label"))


@query("i10_classification_status", f"""{_axis_sql('volatility')} SELECT series_id, session,
  CASE status WHEN 'stale_data' THEN 'stale_data' WHEN 'insufficient_history' THEN 'insufficient_history' WHEN 'insufficient_data' THEN 'data_unavailable' ELSE
    CASE WHEN active_label <> 'unknown' THEN 'classified' WHEN raw_label <> 'unknown' OR stable_label <> 'unknown' THEN 'no_rule_fired_hysteresis' WHEN len(gone) > 0 THEN 'no_rule_fired_missing_feature' ELSE 'no_rule_fired' END END AS classification,
  CASE WHEN status IN ('stale_data', 'insufficient_history', 'insufficient_data') THEN status WHEN active_label <> 'unknown' THEN NULL WHEN raw_label <> 'unknown' OR stable_label <> 'unknown' THEN 'hysteresis_held_unknown'
    WHEN len(gone) = 1 THEN 'missing_rule_feature:' || gone[1] WHEN len(gone) > 1 THEN 'missing_rule_features:' || array_to_string(gone, ',') ELSE 'no_rule_fired' END AS reason FROM axis""")
def i10(spark, sf):
    return assembly.classified(_axis(spark, sf, "volatility"), AXES["volatility"][2]).select("series_id", "session", "classification", "reason")


# Labels and states that a response is made of.
_INPUTS = {
    "trend": rules.case(rules.TREND), "volatility": rules.case(rules.VOLATILITY),
    "character": f"CASE {rules.case(rules.TREND)} WHEN 'unknown' THEN 'unknown' WHEN 'sideways' THEN 'chop' WHEN 'transition' THEN 'transition' ELSE 'trending' END",
    "breadth": "CASE WHEN sma50 IS NULL OR ret21 IS NULL THEN 'unknown' WHEN close > sma50 AND ret21 >= 0 THEN 'healthy_breadth' ELSE 'weak_breadth' END",
    "state": f"CASE WHEN rv_pct IS NULL THEN 'insufficient_data' WHEN {rules.case(rules.VOLATILITY)} = 'crisis_vol' AND ret1 <= -0.5 THEN 'crisis' WHEN {rules.case(rules.TREND)} = 'bear' AND rv_pct >= 0.8 THEN 'bear_stress' WHEN {rules.case(rules.TREND)} = 'bull' AND gap_pct > 0.75 THEN 'fragile_bull' WHEN dd252 <= -0.15 AND ret63 > 0.5 THEN 'recovery_attempt' WHEN {rules.case(rules.TREND)} = 'sideways' AND rv_pct > 0.6 THEN 'watch' WHEN rv_pct < 0.35 THEN 'stable' WHEN rv_pct < 0.55 THEN 'weakening' WHEN rv_pct < 0.75 THEN 'transition_warning' ELSE 'high_transition_risk' END",
}
_RESPONSE = f"""{FEATURES_SQL.replace(ctes('bars'), ctes('bars', 'cal'))}, i AS (SELECT series_id, session, {', '.join(f'{e} AS {c}' for c, e in _INPUTS.items())} FROM f),
k AS (SELECT *, state = 'insufficient_data' OR trend = 'unknown' OR character = 'unknown' OR volatility = 'unknown' OR breadth = 'unknown' AS u, character = 'chop' AND volatility <> 'crisis_vol' AS chop,
  trend = 'bull' AND character IN ('trending', 'transition') AND volatility IN ('low_vol', 'normal_vol') AND breadth = 'healthy_breadth' AS healthy FROM i),
r AS (SELECT series_id, session,
  CASE WHEN u THEN 0.75 WHEN state = 'crisis' THEN 0.25 WHEN state IN ('bear_stress', 'watch', 'high_transition_risk', 'fragile_bull') THEN 0.5 WHEN chop THEN 0.75 WHEN state = 'recovery_attempt' THEN 0.5 WHEN state IN ('weakening', 'transition_warning') THEN 0.75 ELSE 1.0 END :: DOUBLE AS size,
  u OR NOT chop AS trend_following, true AS mean_reversion, NOT u AND state NOT IN ('recovery_attempt', 'high_transition_risk', 'bear_stress', 'crisis') AS leverage,
  u OR state NOT IN ('fragile_bull', 'high_transition_risk', 'bear_stress', 'crisis') AS buy_dip, u OR state <> 'watch' AS breakout, true AS shorts,
  u OR state IN ('fragile_bull', 'weakening', 'transition_warning', 'high_transition_risk', 'watch') AS confirm_longs, u OR state = 'bear_stress' AS confirm_shorts, u AS review,
  CASE WHEN NOT u AND state = 'crisis' THEN true END AS hard_loss, CASE WHEN NOT u AND state = 'crisis' THEN true END AS block_weak, CASE WHEN NOT u AND state IN ('crisis', 'high_transition_risk') THEN true END AS cash_or_hedges,
  CASE WHEN NOT u AND (chop OR state IN ('transition_warning', 'watch')) THEN true END AS faster_profit,
  CASE WHEN u THEN NULL WHEN state IN ('recovery_attempt', 'fragile_bull', 'weakening', 'transition_warning', 'high_transition_risk', 'watch') THEN false WHEN healthy THEN true END AS expand_leverage,
  CASE WHEN NOT u AND state = 'recovery_attempt' THEN true END AS confirm_breadth, CASE WHEN u THEN 'unknown_or_unmapped_regime' END AS reason,
  CASE WHEN u THEN '' ELSE concat_ws(',', CASE WHEN healthy THEN 'bull_healthy_low_vol' END, CASE WHEN state = 'recovery_attempt' THEN 'recovery_attempt' END, CASE WHEN chop THEN 'sideways_chop' END,
    CASE state WHEN 'fragile_bull' THEN 'bull_fragile' WHEN 'weakening' THEN 'transition_weakening' WHEN 'watch' THEN 'sideways_stress' WHEN 'transition_warning' THEN state WHEN 'high_transition_risk' THEN state WHEN 'bear_stress' THEN state WHEN 'crisis' THEN state END) END AS modifiers FROM k)"""
EVENT_RULES = [("fed_week", ("FOMC",), {"leverage": False, "expand_leverage": False}, 0.5), ("data_week", ("CPI", "NFP"), {"confirm_longs": True}, 0.75)]


def _responses(spark, sf):
    return strategy.response(features(spark, sf).select("series_id", "session", *(F.expr(e).alias(c) for c, e in _INPUTS.items())))


@query("k01_strategy_response", f"{_RESPONSE} SELECT * FROM r")
def k01(spark, sf):
    return _responses(spark, sf).select("series_id", "session", *strategy.FIELDS, "reason", F.array_join("modifiers", ",").alias("modifiers"))


@query("k02_event_modifiers", f"""{_RESPONSE}, e AS (SELECT date, bool_or(type = 'FOMC') AS fed, bool_or(type IN ('CPI', 'NFP')) AS prints FROM cal GROUP BY 1), z AS (SELECT r.*, coalesce(fed, false) AS fed, coalesce(prints, false) AS prints FROM r LEFT JOIN e ON e.date = r.session)
SELECT series_id, session, least(size, CASE WHEN fed THEN 0.5 WHEN prints THEN 0.75 ELSE 1.0 END) AS size, leverage AND NOT fed AS leverage, CASE WHEN fed THEN false ELSE expand_leverage END AS expand_leverage, confirm_longs OR prints AS confirm_longs,
  concat_ws(',', nullif(modifiers, ''), CASE WHEN fed THEN 'fed_week' END, CASE WHEN prints THEN 'data_week' END) AS modifiers FROM z""")
def k02(spark, sf):
    on = panel.events_calendar(spark, sf).groupBy(C("date").alias("session")).agg(F.collect_set("type").alias("events"))
    out = strategy.event_modified(_responses(spark, sf).join(on, "session", "left"), EVENT_RULES)
    return out.select("series_id", "session", "size", "leverage", "expand_leverage", "confirm_longs", F.array_join("modifiers", ",").alias("modifiers"))


@query("i11_label_source", f"{_axis_sql('volatility')} SELECT series_id, session, CASE WHEN active_label IS DISTINCT FROM raw_label THEN 'hysteresis_from_prior_state' WHEN active_label = 'high_vol' OR active_label = 'crisis_vol' THEN 'constituents' ELSE 'proxy' END AS source FROM axis")
def i11(spark, sf):
    return assembly.label_source(_axis(spark, sf, "volatility"), ("high_vol", "crisis_vol")).select("series_id", "session", "source")


# Two macro sources with their ages: a value that is too old is null, and named.
_AGED = f"""{_stale_sql({k: CLOCKS[k] for k in ('1-URGENT', '2-HIGH')})}, m AS (SELECT series_id, published, value FROM macro WHERE vintage = 0 AND value IS NOT NULL),
p AS (SELECT session, max(days) FILTER (source = '1-URGENT') AS d1, max(days) FILTER (source = '2-HIGH') AS d2 FROM stale GROUP BY 1),
v AS (SELECT p.*, a.value AS a, b.value AS b FROM p ASOF LEFT JOIN (SELECT * FROM m WHERE series_id = '1-URGENT') a ON p.session >= a.published ASOF LEFT JOIN (SELECT * FROM m WHERE series_id = '2-HIGH') b ON p.session >= b.published)"""


def _aged(spark, sf):
    names = {"1-URGENT": "nowcast", "2-HIGH": "eps"}
    ages = _stale(spark, sf, {k: CLOCKS[k] for k in names}).groupBy("session").pivot("source", list(names)).agg(F.max("days"))
    rows = ages.select("session", *(C(f"`{k}`").alias(f"{v}_age") for k, v in names.items()))
    for key, name in names.items():
        read = panel.macro(spark, sf).where("vintage = 0 AND value IS NOT NULL").where(C("series_id") == key).select("series_id", "published", C("value").alias(name))
        rows = align.as_of(rows.withColumn("series_id", F.lit(key)), read, "published", [name], ["series_id"]).drop("series_id", "published")
    return assembly.fresh(rows, {"nowcast": ("nowcast_age", 25), "eps": ("eps_age", 15)})


@query("h16_stale_reasons", f"{_AGED} SELECT session, concat_ws(',', CASE WHEN coalesce(d1 > 25, true) THEN 'nowcast_stale' END, CASE WHEN coalesce(d2 > 15, true) THEN 'eps_stale' END) AS reason FROM v")
def h16(spark, sf):
    return _aged(spark, sf).select("session", "reason")


@query("h17_stale_inputs_nulled", f"{_AGED} SELECT session, round(CASE WHEN d1 <= 25 THEN a END, 4) AS nowcast, round(CASE WHEN d2 <= 15 THEN b END, 4) AS eps FROM v")
def h17(spark, sf):
    return _aged(spark, sf).select("session", F.round("nowcast", 4).alias("nowcast"), F.round("eps", 4).alias("eps"))


_COMPONENTS = {"trend_break": "tb", "volatility_acceleration": "va", "breadth_deterioration": "bd", "liquidity_stress": "ls", "model_instability": "mi"}
_SCORED = _SCORE.rsplit("\nSELECT ", 1)[0]


@query("j02_component_scores", f"{_SCORED} SELECT series_id, session, {', '.join(f'round({v}, 5) AS {k}' for k, v in _COMPONENTS.items())} FROM c")
def j02(spark, sf):
    return _pressure(spark, sf).select("series_id", "session", *(F.round(c, 5).alias(c) for c in _COMPONENTS))


# Rule flags from the labels, the history of the trend label and the components.
_FLAG_COLUMNS = ("crisis", "bear_stress", "fragile_bull", "recovery_attempt", "sideways_stress", "event_watch", "cooldown", "insufficient")
_FLAGS = f"""{_SCORED}, i AS (SELECT series_id, session, pos, close, sma50, rv_pct AS corr, range_pct AS cred, tb, va, bd, ls, mi, me, score, {', '.join(f'{_INPUTS[c]} AS {c}' for c in ('trend', 'volatility', 'character', 'breadth'))} FROM s),
ch AS (SELECT *, CASE WHEN pos > 1 AND trend IS DISTINCT FROM lag(trend) OVER {_H} THEN 1 ELSE 0 END AS changed FROM i),
hi AS (SELECT *, pos - max(CASE WHEN changed = 1 THEN pos END) OVER {_H[:-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS gone, coalesce(max(CASE WHEN trend = 'bear' THEN 1 ELSE 0 END) OVER {_H[:-1]} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING), 0) = 1 AS bear FROM ch)
SELECT series_id, session, volatility = 'crisis_vol' AS crisis, trend = 'bear' AND volatility IN ('high_vol', 'crisis_vol') AND (breadth IN ('weak_breadth', 'unknown') OR coalesce(cred >= 0.70, false)) AS bear_stress,
  trend = 'bull' AND (coalesce(corr >= 0.70, false) OR coalesce(cred >= 0.70, false)) AS fragile_bull, bear AND coalesce(close > sma50, false) AND breadth = 'healthy_breadth' AS recovery_attempt,
  trend = 'sideways' AND volatility = 'high_vol' AND breadth = 'weak_breadth' AS sideways_stress,
  coalesce(me >= 1 AND score >= 0.35 AND me >= coalesce(greatest(tb, va, bd, corr, cred, ls, mi), 0), false) AS event_watch, coalesce(gone <= 5, false) AND volatility <> 'crisis_vol' AS cooldown,
  trend = 'unknown' OR character = 'unknown' OR volatility = 'unknown' OR breadth = 'unknown' AS insufficient FROM hi"""


def _flagged(spark, sf):
    rows = _pressure(spark, sf).withColumns({c: F.expr(_INPUTS[c]) for c in ("trend", "volatility", "character", "breadth")})
    return transition.rule_flags(evaluate.history(rows, "trend"))


@query("j05_rule_flags", _FLAGS)
def j05(spark, sf):
    return _flagged(spark, sf).select("series_id", "session", *_FLAG_COLUMNS)


@query("j06_state", f"""{_FLAGS.replace('SELECT series_id, session, volatility', 'SELECT series_id, session, score, volatility')}""")
def j06(spark, sf):
    return transition.state(_flagged(spark, sf)).select("series_id", "session", "state", "rules")


_BANDED = "CASE WHEN score IS NULL THEN 'insufficient_data' WHEN score < 0.35 THEN 'stable' WHEN score < 0.55 THEN 'weakening' WHEN score < 0.75 THEN 'transition_warning' ELSE 'high_transition_risk' END"
_HEAD, _TAIL = ORACLE["j06_state"].rsplit("\nSELECT ", 1)
ORACLE["j06_state"] = f"""{_HEAD}, fl AS (SELECT {_TAIL})
SELECT series_id, session, CASE WHEN crisis THEN 'crisis' WHEN bear_stress THEN 'bear_stress' WHEN fragile_bull THEN 'fragile_bull' WHEN recovery_attempt THEN 'recovery_attempt' WHEN sideways_stress OR event_watch THEN 'watch'
  WHEN cooldown AND {_BANDED} = 'stable' THEN 'watch' ELSE {_BANDED} END AS state,
  concat_ws(',', CASE WHEN crisis THEN 'crisis' END, CASE WHEN bear_stress THEN 'bear_stress' END, CASE WHEN fragile_bull THEN 'fragile_bull' END, CASE WHEN recovery_attempt THEN 'recovery_attempt' END, CASE WHEN sideways_stress THEN 'sideways_stress' END, CASE WHEN event_watch THEN 'event_watch' END, CASE WHEN cooldown THEN 'cooldown' END) AS rules FROM fl"""


_NAMED = {"trend_break": "tb", "volatility_acceleration": "va", "breadth_deterioration": "bd", "correlation_fragility": "corr", "credit_stress": "cred", "liquidity_stress": "ls", "macro_event": "me", "model_instability": "mi"}
_STATE_HEAD, _STATE_TAIL = ORACLE["j06_state"].rsplit("\nSELECT series_id, session, CASE WHEN crisis", 1)
_DRIVEN = ", ".join(f"{{'less': -{x}, 'k': {k}, 'name': '{n}'}}" for k, (n, x) in enumerate(_NAMED.items()))


@query("j07_drivers_and_state", f"""{_STATE_HEAD}, st AS (SELECT series_id, session, CASE WHEN crisis{_STATE_TAIL})
SELECT st.series_id, st.session, st.state, st.rules, array_to_string(list_transform(list_sort(list_filter([{_DRIVEN}], lambda x: x.less <= -0.35))[1:3], lambda x: x.name), ',') AS drivers,
  array_to_string(list_filter([{', '.join(f"CASE WHEN {x} IS NULL THEN '{n}' END" for n, x in _NAMED.items())}], lambda x: x IS NOT NULL), ',') AS missing,
  round({' + '.join(f"CASE WHEN {x} IS NOT NULL THEN {transition.WEIGHTS[n]} ELSE 0 END" for n, x in _NAMED.items())}, 6) AS coverage FROM st JOIN i ON st.series_id = i.series_id AND st.session = i.session""")
def j07(spark, sf):
    return transition.state(_flagged(spark, sf)).select("series_id", "session", "state", "rules", "drivers", "missing", F.round("coverage", 6).alias("coverage"))


@query("l02_complete_cases", f"{FEATURES_SQL} SELECT series_id, session, round(ret5, 5) AS ret5, round(rv21, 5) AS rv21, round(volume_z, 5) AS volume_z FROM f WHERE ret5 IS NOT NULL AND rv21 IS NOT NULL AND volume_z IS NOT NULL")
def l02(spark, sf):
    columns = ["ret5", "rv21", "volume_z"]
    return features(spark, sf).dropna(subset=columns).select("series_id", "session", *(F.round(c, 5).alias(c) for c in columns))
