"""Queries of model evidence, network percentiles and the transition score on the market panel; SQL where it can say the same.

The market panel has the series 'ALL' and one for each return flag. Prices, returns, volumes, members and events are those of the
given tables; the given tables have no yields and spreads, so the credit axis reads monthly order values by priority in their place.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import rolling as R
from tidemark.operators import align, assembly, breadth, calendar, evaluate, families, folds, models, network, rules, transition, walkforward
from tidemark.operators.order_statistics import ranked
from tidemark.plans.assembly_queries import _axis_sql
from tidemark.plans.folders import shared_folder
from tidemark.plans.label_queries import FEATURES_SQL, MARKET_SQL, features_of
from tidemark.plans.rolling_queries import _frame, _lag
from tidemark.sources import panel
from tidemark.sources.panel import ctes

QUERIES, ORACLE = {}, {}
C = F.col
KEY = ("series_id", "session")
#: States, training sessions, cadence and seeds of the models, their versions, and the labels of states.
WINDOW, CADENCE, STATES, SEEDS, CLUSTERS, CLUSTER_SEED = 1260, 21, 4, [42, 101, 202, 303, 404, 505, 606, 707, 808, 909], 8, 42
HIDDEN, MIXTURE = "hidden_4state_v1", "mixture_8cluster_v1"
STATE_LABELS = ("elevated_uncertainty", "high_vol_stress", "calm_trending", "transient_spike")
CLUSTER_LABELS = ("post_crisis_transition", "crisis_panic", "tariff_shock", "correction_chop", "volatile_recovery", "calm_trending_bull", "steady_bull", "high_vol_stress")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _features(spark, sf, bars=None):
    """The market panel's features with the 63-session drawdown and the directional index."""
    bars = panel.bars_market(spark, sf) if bars is None else bars
    adx = folds.adx(bars).select(*KEY, "adx")
    return features_of(bars).withColumn("dd63", R.drawdown(C("close"), 63)).join(adx, list(KEY))


def _member_returns(spark, sf):
    """Returns of the members from their last known closes: they have no bar in many sessions."""
    return network.returns(panel.bars_member(spark, sf), panel.market_sessions(spark, sf), carry=True)


def _structure(spark, sf):
    return network.structure(_member_returns(spark, sf))


def _market_breadth(spark, sf, sma: int = 50, members=None, sessions=None):
    """Breadth on the full windows, from members' last known bars."""
    sessions = panel.market_sessions(spark, sf) if sessions is None else sessions
    members = panel.bars_member(spark, sf) if members is None else members
    rows = align.exact(align.grid(members, sessions), members.select(*KEY, "close", "volume"))
    carried = rows.withColumn("close", R.carried(C("close"))).where("close IS NOT NULL").select(*KEY, "close", F.coalesce("volume", F.lit(0)).alias("volume"))
    return breadth.breadth(carried, sessions, panel.membership(spark, sf), sma=sma)


_SINCE = f"(PARTITION BY series_id ORDER BY session ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_FULL_BREADTH = f"""{ctes('members', 'market_sessions', 'membership')}, grid AS (SELECT series_id, session, s.pos FROM (SELECT DISTINCT series_id FROM members) CROSS JOIN market_sessions s),
f0 AS (SELECT series_id, session, pos, last_value(close IGNORE NULLS) OVER {_SINCE} AS close, coalesce(volume, 0) AS volume FROM (SELECT g.*, m.close, m.volume FROM grid g LEFT JOIN members m ON g.series_id = m.series_id AND g.session = m.session)),
f1 AS (SELECT *, close - {_lag('close', 1)} AS change, CASE WHEN count(close) {_frame(50)} = 50 THEN avg(close) {_frame(50)} END AS sma, CASE WHEN count(close) {_frame(252)} >= 126 THEN max(close) {_frame(252)} END AS top, CASE WHEN count(close) {_frame(252)} >= 126 THEN min(close) {_frame(252)} END AS bottom FROM f0),
inside AS (SELECT f1.* FROM f1 WHERE EXISTS (SELECT 1 FROM membership i WHERE i.series_id = f1.series_id AND f1.session >= i.start AND (i."end" IS NULL OR f1.session <= i."end"))),
d AS (SELECT session, pos, count(close) AS present, avg(CASE WHEN sma IS NOT NULL AND close IS NOT NULL THEN CASE WHEN close > sma THEN 1.0 ELSE 0.0 END END) AS pct_above, count(*) FILTER (change > 0) AS advances, count(*) FILTER (change < 0) AS declines,
  count(*) FILTER (close = top) AS highs, count(*) FILTER (close = bottom) AS lows, count(top) AS spans, sum(CASE WHEN change > 0 THEN volume ELSE 0 END) AS up_volume, sum(CASE WHEN change < 0 THEN volume ELSE 0 END) AS down_volume FROM inside GROUP BY 1, 2)"""


@query("e08_full_windows", f"{_FULL_BREADTH} SELECT session, present, round(pct_above, 6) AS pct_above, advances, declines, round(CASE WHEN spans > 0 THEN highs / greatest(highs + lows, 1) END, 6) AS high_low, round(up_volume / nullif(up_volume + down_volume, 0), 6) AS up_share FROM d")
def e08_full(spark, sf):
    """Breadth over 50 and 252 sessions, a member without a bar standing at its last close."""
    return _market_breadth(spark, sf).select("session", "present", F.round("pct_above", 6).alias("pct_above"), "advances", "declines", *(F.round(c, 6).alias(c) for c in ("high_low", "up_share")))


def _model_inputs(spark, sf):
    """Features, correlation and breadth of the market; the lines are read once, into the parts of bars, which are written in the shared folder."""
    shared_folder(spark)
    parts = panel.parts(spark, sf).checkpoint()
    bars, members, sessions = panel.market_of(parts), panel.members_of(parts), panel.market_sessions_of(parts)
    f, s, b = _features(spark, sf, bars), network.structure(network.returns(members, sessions, carry=True)), _market_breadth(spark, sf, members=members, sessions=sessions)
    return f.join(s.select("session", "mean_corr"), "session").join(b.select("session", "pct_above"), "session")


def _aligned(spark, fits):
    """Fits with aligned states; written in the shared folder first, as they are read twice."""
    shared_folder(spark)
    return walkforward.aligned(fits.checkpoint())


def _hidden(spark, sf):
    """Markov fits of daily return, volatility, drawdown, volume and correlation, states aligned over checkpoints."""
    columns = ["ret1", "rv21", "dd63", "volume_z", "mean_corr"]
    rows = walkforward.complete(_model_inputs(spark, sf), columns)
    return _aligned(spark, walkforward.fitted(rows, columns, STATES, SEEDS, WINDOW, CADENCE, hidden=True))


def _clusters(spark, sf):
    """Mixture fits of returns, volatility, drawdown, trend strength, correlation and breadth, components aligned over checkpoints."""
    columns = ["ret21", "ret63", "rv21", "dd63", "adx", "mean_corr", "pct_above"]
    rows = walkforward.complete(_model_inputs(spark, sf), columns)
    return _aligned(spark, walkforward.fitted(rows, columns, CLUSTERS, [CLUSTER_SEED], WINDOW, CADENCE, hidden=False))


def _evidence(fits):
    return walkforward.evidence(fits).select(*KEY, "checkpoint", "seed", "top", F.round("probability", 4).alias("probability"), F.round("distance", 4).alias("distance"))


@query("l04_mixture_evidence")
def l04(spark, sf):
    return _evidence(_clusters(spark, sf))


@query("l05_markov_evidence")
def l05(spark, sf):
    return _evidence(_hidden(spark, sf))


@query("l06_component_order")
def l06(spark, sf):
    columns = ["ret1", "rv21", "dd63", "volume_z"]
    rows = walkforward.complete(_features(spark, sf), columns)
    return walkforward.orders(walkforward.fitted(rows, columns, STATES, [CLUSTER_SEED], WINDOW, CADENCE, hidden=False))


@query("l07_parameter_drift")
def l07(spark, sf):
    out = walkforward.drifts(_hidden(spark, sf))
    return out.select("series_id", "checkpoint", F.round("mean_drift", 4).alias("mean_drift"), F.round("move_shift", 4).alias("move_shift"), "mean_alert", "move_review")


_RANKED = f"""{ctes('market')}, r AS (SELECT *, close / nullif({_lag('close', 1)}, 0) - 1 AS r1, (high - low) / close AS day_range FROM market), c AS (SELECT series_id, session, row_number() OVER (PARTITION BY series_id ORDER BY session) AS k FROM r WHERE r1 IS NOT NULL), e AS (SELECT series_id, max(k) AS n FROM c GROUP BY 1 HAVING max(k) >= 1260),
p AS (SELECT DISTINCT series_id, n, unnest(list_concat(range(1260, n + 1, 21), [n])) AS checkpoint FROM e)"""


@query("l01_walk_forward_schedule", f"{_RANKED} SELECT series_id, checkpoint, checkpoint - 1260 AS low, CASE WHEN checkpoint = n THEN n + 1 ELSE least(checkpoint + 21, n) END AS until FROM p")
def l01_schedule(spark, sf):
    bars = panel.bars_market(spark, sf).withColumn("r1", R.period_return(C("close"), 1))
    return walkforward.schedule(walkforward.complete(bars, ["r1"]), WINDOW, CADENCE)


def _labelled(spark, fits, model: str, labels: tuple[str, ...]):
    """Evidence with the label of its top state, where the map of labels holds for all states that the fits have."""
    label_map = spark.createDataFrame([(model, "v1", k, name) for k, name in enumerate(labels)], "model string, version string, state int, label string")
    of = (F.lit(model).alias("model"), F.lit("v1").alias("version"))
    states = fits.select(*of, F.explode(F.sequence(F.lit(0), F.size("means") - 1)).alias("state"))
    rows = walkforward.evidence(fits).select("*", *of)
    return walkforward.labelled_states(rows, label_map, walkforward.map_violations(states, label_map))


@query("l09_label_map")
def l09(spark, sf):
    return _labelled(spark, _clusters(spark, sf), MIXTURE, CLUSTER_LABELS).select(*KEY, "top", "mapped_label", "mapping")


#: Event types as states of a model, mapped by the labels of the calendar: what is not mapped, in both directions.
_MAP_SQL = "SELECT 'events' AS model, CASE WHEN user_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS version, CAST(event_id % 7 AS INT) AS state FROM events"


@query("l09_map_violations", f"""WITH s AS (SELECT DISTINCT * FROM ({_MAP_SQL})), m AS (SELECT 'events' AS model, 'v1' AS version, CAST(r_regionkey * 2 AS INT) AS state, r_name AS label FROM region UNION ALL SELECT 'events', 'v1', 0, 'again'),
k AS (SELECT state, count(*) AS n FROM m GROUP BY 1), v AS (SELECT * FROM s WHERE version = 'v1')
SELECT DISTINCT 'events' AS model, 'v2' AS version, CAST(NULL AS INT) AS state, 'version_mismatch' AS problem FROM s WHERE version = 'v2'
UNION ALL SELECT 'events', 'v1', coalesce(v.state, k.state), CASE WHEN k.n IS NULL THEN 'unmapped_state' WHEN v.state IS NULL THEN 'unknown_state' ELSE 'doubled_state' END FROM v FULL JOIN k ON v.state = k.state WHERE k.n IS NULL OR v.state IS NULL OR k.n > 1""")
def l09_violations(spark, sf):
    states = panel.table(spark, sf, "events").select(F.lit("events").alias("model"), F.when(C("user_id") % 2 == 0, "v1").otherwise("v2").alias("version"), (C("event_id") % 7).cast("int").alias("state"))
    named = panel.table(spark, sf, "region").select(F.lit("events").alias("model"), F.lit("v1").alias("version"), (C("r_regionkey") * 2).cast("int").alias("state"), C("r_name").alias("label"))
    again = named.where("state = 0").withColumn("label", F.lit("again"))
    return walkforward.map_violations(states, named.unionByName(again))


@query("l10_top_state")
def l10(spark, sf):
    """The most probable state of the Markov model with its label, its probability, and how many sessions it has lasted."""
    rows = _labelled(spark, _hidden(spark, sf), HIDDEN, STATE_LABELS)
    w = F.row_number().over(R.Window.partitionBy("series_id").orderBy("pos")) - F.row_number().over(R.Window.partitionBy("series_id", "top").orderBy("pos"))
    lasted = F.row_number().over(R.Window.partitionBy("series_id", "top", "_run").orderBy("pos")).cast("long")
    return rows.withColumn("_run", w).withColumn("days", lasted).select(*KEY, "top", "mapped_label", F.round("probability", 5).alias("probability"), "days")


def _network_ranks(spark, sf):
    returns = _member_returns(spark, sf)
    anchor = panel.bars_market(spark, sf).where("series_id = 'ALL'").withColumn("r", R.period_return(C("close"), 1)).select("session", "r")
    return network.percentiles(network.structure(returns), network.dispersion(returns, anchor))


_SIX = ("corr_pct", "eig_pct", "rank_pct", "dispersion_pct")


@query("f06_network_percentiles")
def f06(spark, sf):
    return _network_ranks(spark, sf).select("session", *(F.round(c, 6).alias(c) for c in _SIX))


# Members' closes carried over their gaps, and the dispersion of their returns.
_CARRIED = f"""{ctes('members', 'market', 'market_sessions')}, g AS (SELECT s.series_id, m.session, m.pos FROM (SELECT DISTINCT series_id FROM members) s CROSS JOIN market_sessions m),
x AS (SELECT g.*, last_value(members.close IGNORE NULLS) OVER (PARTITION BY g.series_id ORDER BY g.session ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close FROM g LEFT JOIN members ON g.series_id = members.series_id AND g.session = members.session),
y AS (SELECT *, close / nullif({_lag('close', 1)}, 0) - 1 AS r FROM x)"""
_DISPERSION = f"""{_CARRIED}, mv AS (SELECT session, CASE WHEN count(r) {_frame(21)} = 21 THEN stddev_samp(r) {_frame(21)} * sqrt(252) END AS v FROM y), mm AS (SELECT session, avg(v) AS v FROM mv GROUP BY 1),
a AS (SELECT series_id, session, close / nullif({_lag('close', 1)}, 0) - 1 AS r FROM market WHERE series_id = 'ALL'), av AS (SELECT session, CASE WHEN count(r) {_frame(21)} = 21 THEN stddev_samp(r) {_frame(21)} * sqrt(252) END AS v FROM a),
d AS (SELECT session, mm.v / CASE WHEN av.v IS NULL THEN 1e-6 ELSE greatest(av.v, 1e-6) END AS dispersion FROM mm JOIN av USING (session))"""


@query("f06_dispersion_percentile", f"""{_DISPERSION}, l AS (SELECT *, list(dispersion) OVER w AS xs, count(dispersion) OVER w AS n FROM d WINDOW w AS (ORDER BY session ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))
SELECT session, round(dispersion, 4) AS dispersion, round(CASE WHEN n = 252 THEN (len(list_filter(xs, lambda y: y < dispersion)) + (len(list_filter(xs, lambda y: y = dispersion)) + 1) / 2.0) / 252.0 END, 6) AS pct FROM l""")
def f06_dispersion(spark, sf):
    anchor = panel.bars_market(spark, sf).where("series_id = 'ALL'").withColumn("r", R.period_return(C("close"), 1)).select("session", "r")
    d = network.dispersion(_member_returns(spark, sf), anchor).withColumn("series_id", F.lit("m"))
    return ranked(d, {"pct": ("dispersion", network.SHORT)}).select("session", F.round("dispersion", 4).alias("dispersion"), F.round("pct", 6).alias("pct"))


@query("c08_long_window_ranks", f"""{ctes('market')}, l AS (SELECT series_id, session, close, volume, list(close) {_frame(504)} AS xs, list(volume) {_frame(504)} AS vs FROM market)
SELECT series_id, session, round(CASE WHEN len(xs) = 504 THEN (len(list_filter(xs, lambda y: y < close)) + (len(list_filter(xs, lambda y: y = close)) + 1) / 2.0) / 504.0 END, 6) AS close_pct,
  round(CASE WHEN len(vs) = 504 THEN (len(list_filter(vs, lambda y: y < volume)) + (len(list_filter(vs, lambda y: y = volume)) + 1) / 2.0) / 504.0 END, 6) AS volume_pct FROM l""")
def c08_long(spark, sf):
    out = ranked(panel.bars_market(spark, sf), {"close_pct": ("close", 504), "volume_pct": ("volume", 504)})
    return out.select(*KEY, F.round("close_pct", 6).alias("close_pct"), F.round("volume_pct", 6).alias("volume_pct"))


# The credit axis: order values by priority as of their publication stand for yields.
_SPREADS = {"hy": ("1-URGENT", "5-LOW"), "ig": ("2-HIGH", "5-LOW"), "funding": ("3-MEDIUM", "4-NOT SPECIFIED")}


def _spreads(spark, sf):
    """(session, pos, hy, ig, funding, usd): ratios of first-release readings as of each session, less one."""
    readings = panel.macro(spark, sf).where("vintage = 0 AND value IS NOT NULL")
    out = panel.market_sessions(spark, sf).withColumn("series_id", F.lit("m"))
    names = sorted({x for pair in _SPREADS.values() for x in pair})
    for k, name in enumerate(names):
        one = readings.where(C("series_id") == name).select(F.lit("m").alias("series_id"), "published", C("value").alias(f"v{k}"))
        out = align.as_of(out, one, "published", [f"v{k}"], ["series_id"])
    at = {name: C(f"v{k}") for k, name in enumerate(names)}
    ratio = {c: at[a] / F.nullif(at[b], F.lit(0.0)) - 1 for c, (a, b) in _SPREADS.items()}
    return out.withColumns(ratio | {"usd": at["4-NOT SPECIFIED"]}).select("series_id", "session", "pos", *ratio, "usd")


def _credit_inputs(spark, sf):
    """Inputs of the credit rules for each series of the market panel: spreads, their ranks and slopes, and its own returns and volatility."""
    s = ranked(_spreads(spark, sf), {"hy_pct": ("hy", network.LONG)})
    s = s.withColumns({"hy_slope": R.ols_slope(C("hy"), C("pos"), 21), "ig_slope": R.ols_slope(C("ig"), C("pos"), 21), "funding_slope": R.ols_slope(C("funding"), C("pos"), 21), "_c": C("usd") - R.lag(C("usd"), 63)})
    s = s.withColumn("z_usd", R.change_zscore(C("_c"), 252)).select("session", "hy_pct", "hy_slope", "ig_slope", "funding_slope", "z_usd")
    f = features_of(panel.bars_market(spark, sf)).select(*KEY, "pos", "ret21", "rv_pct", "rv21")
    bond = panel.bars_market(spark, sf).where("series_id = 'N'").withColumn("bond_ret21", R.period_return(C("close"), 21)).select("session", "bond_ret21")
    corr = _structure(spark, sf).select("session", C("mean_corr").alias("corr"))
    pct = _network_ranks(spark, sf).select("session", "corr_pct")
    out = f.join(s, "session", "left").join(bond, "session", "left").join(corr, "session", "left").join(pct, "session", "left")
    return rules.labelled(out, rules.CREDIT)


def _assembled(rows, axis: str, inputs: list[str], required: int = 60, max_fresh: int = 3):
    out = assembly.assembled(rows, inputs, required, max_fresh, 0.9, rules.RANKS[axis], rules.LEAVE[axis])
    return assembly.classified(out, inputs)


_AXIS = (*KEY, "status", "raw_label", "stable_label", "active_label", "classification", "reason")


@query("i09_axis_credit")
def i09_credit(spark, sf):
    return _assembled(_credit_inputs(spark, sf), "credit", ["hy_pct", "ret21"]).select(*_AXIS)


def _volume_axis(rows):
    return _assembled(rules.labelled(rows, rules.VOLUME), "volume", ["volume_z", "ret1", "gap_pct", "range_pct"])


def _axis_of(axis: str, ladder: list, inputs: list[str], market: str) -> str:
    """An assembled and classified axis over the market panel as SQL."""
    from tidemark.plans import assembly_queries as Q

    Q.AXES[axis] = (ladder, inputs, inputs)
    try:
        return _axis_sql(axis).replace(FEATURES_SQL, market)
    finally:
        del Q.AXES[axis]


_CLASSIFIED = """SELECT series_id, session, status, raw_label, stable_label, active_label,
  CASE status WHEN 'stale_data' THEN 'stale_data' WHEN 'insufficient_history' THEN 'insufficient_history' WHEN 'insufficient_data' THEN 'data_unavailable' ELSE
    CASE WHEN active_label <> 'unknown' THEN 'classified' WHEN raw_label <> 'unknown' OR stable_label <> 'unknown' THEN 'no_rule_fired_hysteresis' WHEN len(gone) > 0 THEN 'no_rule_fired_missing_feature' ELSE 'no_rule_fired' END END AS classification,
  CASE WHEN status IN ('stale_data', 'insufficient_history', 'insufficient_data') THEN status WHEN active_label <> 'unknown' THEN NULL WHEN raw_label <> 'unknown' OR stable_label <> 'unknown' THEN 'hysteresis_held_unknown'
    WHEN len(gone) = 1 THEN 'missing_rule_feature:' || gone[1] WHEN len(gone) > 1 THEN 'missing_rule_features:' || array_to_string(gone, ',') ELSE 'no_rule_fired' END AS reason FROM axis"""
_VOLUME_SQL = _axis_of("volume", rules.VOLUME, ["volume_z", "ret1", "gap_pct", "range_pct"], MARKET_SQL)


@query("i09_axis_volume", f"{_VOLUME_SQL} {_CLASSIFIED}")
def i09_volume(spark, sf):
    return _volume_axis(features_of(panel.bars_market(spark, sf))).select(*_AXIS)


# The monetary axis: monthly order values by priority as of their publication stand for yields and the currency.
_RATES = {"y2": "1-URGENT", "y10": "2-HIGH", "usd": "4-NOT SPECIFIED"}
_ZS = {"z2y": ("y2", 63), "z10y": ("y10", 63), "z_usd": ("usd", 63), "z2y_short": ("y2", 21), "z10y_short": ("y10", 21)}


def _monetary(spark, sf):
    out = panel.market_sessions(spark, sf).withColumn("series_id", F.lit("m"))
    readings = panel.macro(spark, sf).where("vintage = 0 AND value IS NOT NULL")
    for column, name in _RATES.items():
        one = readings.where(C("series_id") == name).select(F.lit("m").alias("series_id"), "published", C("value").alias(column))
        out = align.as_of(out, one, "published", [column], ["series_id"])
    return families.monetary_features(out, {c: c for c in _RATES})


_MONETARY_SQL = f"""{ctes('market_sessions', 'macro')}, {', '.join(f"{c} AS (SELECT s.session, s.pos, m.value AS v FROM market_sessions s ASOF LEFT JOIN (SELECT published, value FROM macro WHERE vintage = 0 AND value IS NOT NULL AND series_id = '{n}') m ON s.session >= m.published)" for c, n in _RATES.items())},
j AS (SELECT 'm' AS series_id, y2.session, y2.pos, {', '.join(f"{c}.v - lag({c}.v, {n}) OVER (ORDER BY y2.session) AS {z}" for z, (c, n) in _ZS.items())} FROM y2 JOIN y10 ON y2.session = y10.session JOIN usd ON y2.session = usd.session),
f AS (SELECT series_id, session, pos, {', '.join(f"({z} - CASE WHEN count({z}) {_frame(1260)} = 1260 THEN avg({z}) {_frame(1260)} END) / nullif(CASE WHEN count({z}) {_frame(1260)} = 1260 THEN stddev_samp({z}) {_frame(1260)} END, 0) AS {z}" for z in _ZS)} FROM j)"""


@query("d09_monetary_pressure", f"{_MONETARY_SQL} SELECT session, {', '.join(f'round({z}, 5) AS {z}' for z in _ZS)} FROM f")
def d09(spark, sf):
    return _monetary(spark, sf).select("session", *(F.round(z, 5).alias(z) for z in _ZS))


@query("i09_axis_monetary", f"{_axis_of('monetary', rules.MONETARY, list(_ZS), FEATURES_SQL).replace(FEATURES_SQL, _MONETARY_SQL)} {_CLASSIFIED}")
def i09_monetary(spark, sf):
    return _assembled(rules.labelled(_monetary(spark, sf), rules.MONETARY), "monetary", list(_ZS)).select(*_AXIS)


def _breadth_rows(spark, sf):
    """The market against the mean of its series as proxy, overlaid by members' breadth over 50 and 200 sessions."""
    bars = panel.bars_market(spark, sf)
    equal = bars.where("series_id <> 'ALL'").groupBy("session").agg(F.avg("close").alias("close"))
    proxy = families.proxy_breadth(bars.where("series_id = 'ALL'"), equal).withColumnsRenamed({"ratio_ret": "ratio_ret20"})
    base = proxy.withColumn("label", rules.label(rules.BREADTH)).withColumn("series_id", F.lit("ALL"))
    sessions = panel.market_sessions(spark, sf)
    b50 = _market_breadth(spark, sf).select("session", C("pct_above").alias("above50"), "high_low", "thrust", "ad_line")
    b200 = _market_breadth(spark, sf, 200).select("session", C("pct_above").alias("above200"))
    rows = base.join(sessions, "session").join(b50, "session", "left").join(b200, "session", "left")
    back = {f"{c}_5": R.lag(C(c), 5) for c in ("above50", "above200", "high_low")}
    rows = rows.withColumns(back | {"thrust_low": F.min("thrust").over(R.last(10, 1)), "ad_slope": R.ols_slope(C("ad_line"), C("pos"), 21)})
    return rows.withColumn("label", rules.label(rules.BREADTH_OVERLAY, "label"))


@query("i09_axis_breadth")
def i09_breadth(spark, sf):
    return _assembled(_breadth_rows(spark, sf), "breadth", ["ratio", "ratio_sma", "ratio_ret20", "from_high"]).select(*_AXIS)


@query("i09_axis_character")
def i09_character(spark, sf):
    rows = rules.labelled(families.character_features(panel.bars_market(spark, sf)), rules.CHARACTER)
    return _assembled(rows, "character", ["sma50", "ret10", "ret21", "dd63", "adx"]).select(*_AXIS)


def _network_inputs(spark, sf):
    f = features_of(panel.bars_market(spark, sf)).where("series_id = 'ALL'").select("session", "close", "rv21", "rv_pct", "vix_pct")
    b = _market_breadth(spark, sf)
    weak = F.when(C("pct_above") < 0.4, "weak_breadth").when(C("pct_above").isNotNull(), "neutral_breadth").otherwise("unknown")
    credit = _assembled(_credit_inputs(spark, sf).where("series_id = 'ALL'"), "credit", ["hy_pct", "ret21"]).where("classification = 'classified'")
    return network.rule_inputs(_network_ranks(spark, sf), f, b.select("session", weak.alias("label")), credit.select("session", C("active_label").alias("label")))


@query("f07_network_rule_inputs")
def f07(spark, sf):
    numbers = ("corr_pct", "eig_pct", "rank_pct", "dispersion_pct", "corr", "eig", "absorption", "corr_slope", "eig_slope", "rank_stability", "dd21", "rv21", "rv_pct", "vix_pct")
    return _network_inputs(spark, sf).select("session", *(F.round(c, 6).alias(c) for c in numbers), "breadth", "credit")


@query("i09_axis_network")
def i09_network(spark, sf):
    rows = rules.labelled(_network_inputs(spark, sf), rules.NETWORK).withColumn("series_id", F.lit("ALL")).join(panel.market_sessions(spark, sf), "session")
    return _assembled(rows, "network", ["corr_pct", "eig_pct", "dispersion_pct"]).select(*_AXIS)


def _events(spark, sf):
    sessions = panel.market_sessions(spark, sf)
    return calendar.painted(calendar.normalised(panel.events_calendar(spark, sf)), sessions)


_EVENTS = f"""w AS (SELECT * FROM (VALUES {', '.join(f"('{t}', '{l}', {calendar.WINDOWS[l][0]}, {calendar.WINDOWS[l][1]})" for t, l in calendar.LABELS.items())}) v(type, label, a, b)),
painted AS (SELECT DISTINCT s.session, w.label FROM cal JOIN w USING (type) JOIN market_sessions e ON e.session = cal.date JOIN market_sessions s ON s.pos BETWEEN e.pos + a AND e.pos + b WHERE s.session >= cal.publication_date),
ev AS (SELECT session, string_agg(label, ',' ORDER BY label) AS event_labels FROM painted GROUP BY 1)"""


def _observed(spark, sf):
    """Features of the market panel under the names of the score's inputs."""
    return features_of(panel.bars_market(spark, sf)).withColumns({"rv_short": C("rv10"), "rv_long": C("rv63")})


def _score_inputs(spark, sf):
    f = _observed(spark, sf)
    ranks = _network_ranks(spark, sf).select("session", "corr_pct", "eig_pct", "rank_pct", "top3_share")
    changes = models.change_points(f.select(*KEY, "pos", C("rv21").alias("x")), "x")
    hidden, clusters = walkforward.evidence(_hidden(spark, sf)), walkforward.evidence(_clusters(spark, sf))
    credit = _assembled(_credit_inputs(spark, sf), "credit", ["hy_pct", "ret21"])
    market = [ranks, _market_breadth(spark, sf).select("session", "pct_above")]
    return transition.score_inputs(f, market, hidden, clusters, changes, credit, _volume_axis(f), _events(spark, sf))


_INPUTS = ("rv_short", "rv_long", "pct_above", "corr_pct", "eig_pct", "rank_pct", "top3_share", "dd252", "close", "sma50", "volume_z", "gap_pct", "range_pct", "hidden_top", "hidden_before", "change_score")


@query("j09_score_inputs")
def j09(spark, sf):
    out = _score_inputs(spark, sf)
    return out.select(*KEY, *(F.round(c, 5).alias(c) for c in _INPUTS), F.array_join("event_labels", ",").alias("event_labels"), "credit_label", "volume_label", "cluster", "cluster_before")


_OBSERVED = ("rv10 AS rv_short", "rv63 AS rv_long", "dd252", "sma50", "volume_z", "gap_pct", "range_pct")


@query("j09_observed_inputs", f"""{_VOLUME_SQL.replace(ctes('market'), ctes('market', 'market_sessions', 'cal'))}, {_EVENTS}, cl AS ({_CLASSIFIED})
SELECT f.series_id, f.session, close, {', '.join(f'round({e.split(" AS ")[0]}, 5) AS {e.split(" AS ")[-1]}' for e in _OBSERVED)}, coalesce(ev.event_labels, '') AS event_labels, CASE WHEN cl.classification = 'classified' THEN cl.active_label END AS volume_label
FROM f LEFT JOIN ev ON f.session = ev.session LEFT JOIN cl ON f.series_id = cl.series_id AND f.session = cl.session""")
def j09_observed(spark, sf):
    """The inputs that need no model, as score_inputs joins them."""
    f = _observed(spark, sf)
    none = f.where(F.lit(False)).select(*KEY, F.lit(0.0).alias("probability"), F.lit(0).alias("top"), F.lit(0.0).alias("change_point"), F.lit("").alias("active_label"), F.lit("").alias("classification"))
    out = transition.score_inputs(f, [], none, none, none, none, _volume_axis(f), _events(spark, sf))
    names = [e.split(" AS ")[-1] for e in _OBSERVED]
    return out.select(*KEY, "close", *(F.round(c, 5).alias(c) for c in names), F.array_join("event_labels", ",").alias("event_labels"), "volume_label")


@query("j03_market_score")
def j03(spark, sf):
    out = transition.scored(transition.components_of(_score_inputs(spark, sf)))
    return out.select(*KEY, *(F.round(c, 5).alias(c) for c in transition.WEIGHTS), "missing", F.round("coverage", 6).alias("coverage"), F.round("score", 5).alias("score"), "band", "drivers")


@query("j07_market_state")
def j07_market(spark, sf):
    """State, rules that hold and drivers of each session, from the score on its real inputs and the four labels."""
    s = transition.scored(transition.components_of(_score_inputs(spark, sf)))
    character = rules.labelled(families.character_features(panel.bars_market(spark, sf)), rules.CHARACTER).select(*KEY, C("label").alias("character"))
    weak = F.when(C("pct_above") < 0.4, "weak_breadth").when(C("pct_above") >= 0.6, "healthy_breadth").when(C("pct_above").isNotNull(), "neutral_breadth").otherwise("unknown")
    rows = s.join(character, list(KEY)).withColumns({"trend": rules.label(rules.TREND), "volatility": rules.label(rules.VOLATILITY), "breadth": weak})
    out = transition.state(transition.rule_flags(evaluate.history(rows, "trend")))
    return out.select(*KEY, "state", "rules", "drivers", "missing", F.round("coverage", 6).alias("coverage"))
