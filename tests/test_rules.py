"""Rules at their boundaries, responses, clocks and folds on rows with labels written by hand."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import assembly, folds, rules, strategy, transition

D = datetime.date


def labels_of(spark, ladder, schema, rows, overlay=None):
    """The label of each row, in order."""
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + schema)
    return [r.label for r in rules.labelled(df, ladder, overlay).orderBy("k").select("label").collect()]


def test_trend_boundaries(spark):
    rows = [(11.0, 10.0, 9.0, 0.0), (9.0, 10.0, 11.0, 0.0), (10.0, 10.0, 10.0, 0.04), (10.0, 10.0, 10.0, 0.05), (9.5, 9.0, 10.0, 0.0), (9.49, 9.0, 10.0, 0.0), (10.0, 10.0, 9.0, 0.2), (None, 10.0, 9.0, 0.2), (10.0, 10.0, 9.0, None)]
    got = labels_of(spark, rules.TREND, "close double, sma50 double, sma200 double, ret63 double", rows)
    assert got == ["bull", "bear", "sideways", "transition", "sideways", "transition", "transition", "unknown", "unknown"]


def test_trend_overlay_boundaries(spark):
    schema = "label0 string, close double, sma50 double, sma200 double, ret126 double, rv21 double, rv21_5 double, sentiment double, dd252 double, ret63 double"
    rows = [
        ("bear", 11.0, 10.0, 12.0, 0.0, 0.1, 0.1, 0.0, -0.15, 0.11), ("bear", 11.0, 10.0, 12.0, 0.0, 0.1, 0.1, 0.0, -0.15, 0.10), ("bear", 11.0, 10.0, 12.0, 0.0, 0.1, 0.1, 0.0, -0.149, 0.11),
        ("bull", 11.0, 10.0, 12.0, 0.0, 0.1, 0.1, 0.0, -0.15, 0.11), ("bull", 13.0, 10.0, 12.0, 0.21, 0.2, 0.1, 20.0, 0.0, 0.0), ("bull", 13.0, 10.0, 12.0, 0.20, 0.2, 0.1, 20.0, 0.0, 0.0),
        ("bull", 13.0, 10.0, 12.0, 0.21, 0.1, 0.1, 20.0, 0.0, 0.0), ("bull", 13.0, 10.0, 12.0, 0.21, 0.2, 0.1, 19.9, 0.0, 0.0), ("bear", 10.0, 10.0, 12.0, 0.0, 0.1, 0.1, None, -0.15, 0.11),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + schema).withColumn("label", F.col("label0"))
    got = [r.label for r in df.withColumn("label", rules.label(rules.TREND_OVERLAY, "label")).orderBy("k").collect()]
    assert got == ["recovery", "bear", "bear", "bull", "euphoria", "bull", "bull", "bull", "bear"]


def test_volatility_boundaries(spark):
    rows = [(-0.05, 0.0, 0.0, 0.5, None), (-0.0499, 0.0, 0.0, 0.5, None), (0.0, -0.08, 0.0, 0.5, None), (0.0, 0.0, -0.05, 0.90, None), (0.0, 0.0, -0.05, 0.89, None), (0.0, 0.0, 0.0, 0.80, None), (0.0, 0.0, 0.0, 0.79, 0.80), (0.0, 0.0, 0.0, 0.5, 0.95), (0.0, 0.0, 0.0, 0.30, None), (0.0, 0.0, 0.0, 0.31, None), (None, 0.0, 0.0, 0.31, None)]
    got = labels_of(spark, rules.VOLATILITY, "ret1 double, ret5 double, ret21 double, rv_pct double, vix_pct double", rows)
    assert got == ["crisis_vol", "normal_vol", "crisis_vol", "crisis_vol", "high_vol", "high_vol", "high_vol", "crisis_vol", "low_vol", "normal_vol", "unknown"]


def test_volatility_overlay_boundaries(spark):
    schema = "label0 string, rv10 double, rv21 double, rv63 double, iv_change double, after_event boolean, atr_ratio double"
    rows = [("normal_vol", 0.7, 1.0, 1.0, -0.20, True, 1.0), ("normal_vol", 0.75, 1.0, 1.0, -0.20, True, 1.0), ("crisis_vol", 0.7, 1.0, 1.0, -0.20, True, 1.0), ("normal_vol", 0.7, 1.0, 1.0, -0.20, False, 1.0), ("low_vol", 1.26, 1.0, 1.0, 0.0, False, 1.16), ("low_vol", 1.25, 1.0, 1.0, 0.0, False, 1.16), ("low_vol", 1.26, 1.0, 1.0, 0.0, False, 1.15), ("high_vol", 1.26, 1.0, 1.0, 0.0, False, 1.16), ("unknown", 1.26, 1.0, 1.0, 0.0, False, 1.16)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, " + schema).withColumn("label", F.col("label0"))
    got = [r.label for r in df.withColumn("label", rules.label(rules.VOLATILITY_OVERLAY, "label")).orderBy("k").collect()]
    assert got == ["vol_crush", "normal_vol", "crisis_vol", "normal_vol", "rising_vol", "low_vol", "low_vol", "high_vol", "rising_vol"]


def test_volume_and_monetary_boundaries(spark):
    got = labels_of(spark, rules.VOLUME, "volume_z double, ret1 double, gap_pct double, range_pct double", [(2.01, -0.021, 0.0, 0.0), (2.0, -0.021, 0.0, 0.0), (2.01, -0.02, 0.0, 0.0), (0.0, 0.0, 0.76, 0.76), (0.0, 0.0, 0.75, 0.76), (None, 0.0, 0.1, 0.1)])
    assert got == ["panic_volume", "normal_volume", "normal_volume", "liquidity_gap_behavior", "normal_volume", "unknown"]
    got = labels_of(spark, rules.MONETARY, "z2y double, z10y double, z_usd double, z2y_short double, z10y_short double", [(0.0, 0.0, 0.0, 2.01, 0.0), (0.0, 0.0, 0.0, -2.0, 0.0), (1.51, 0.0, 0.0, 0.0, 0.0), (1.5, 0.0, 0.0, 0.0, 0.0), (0.0, -1.51, 0.0, 0.0, 0.0), (0.0, 0.0, -1.6, 0.0, 0.0), (None, 0.0, 0.0, 3.0, 0.0)])
    assert got == ["rate_shock", "neutral_monetary", "tightening_pressure", "neutral_monetary", "easing_pressure", "neutral_monetary", "unknown"]


RESPONSE_CASES = [
    (("bull", "trending", "low_vol", "healthy_breadth", "stable"), (1.0, True, True, None, True, "bull_healthy_low_vol")),
    (("bull", "chop", "normal_vol", "healthy_breadth", "recovery_attempt"), (0.75, False, True, True, False, "recovery_attempt,sideways_chop")),
    (("bull", "trending", "high_vol", "weak_breadth", "fragile_bull"), (0.5, True, False, None, False, "bull_fragile")),
    (("sideways", "chop", "normal_vol", "weak_breadth", "weakening"), (0.75, True, True, True, False, "sideways_chop,transition_weakening")),
    (("bear", "trending", "high_vol", "weak_breadth", "high_transition_risk"), (0.5, False, False, None, False, "high_transition_risk")),
    (("bear", "chop", "crisis_vol", "weak_breadth", "crisis"), (0.25, False, False, None, None, "crisis")),
    (("bear", "unknown", "high_vol", "weak_breadth", "stable"), (0.75, False, True, None, None, "")),
    (("bear", "trending", "high_vol", None, "stable"), (0.75, False, True, None, None, "")),
    (("bear", "trending", "high_vol", "weak_breadth", "insufficient_data"), (0.75, False, True, None, None, "")),
]


def test_responses(spark):
    df = spark.createDataFrame([(k, *c) for k, (c, _) in enumerate(RESPONSE_CASES)], "k int, trend string, character string, volatility string, breadth string, state string")
    for r in strategy.response(df).collect():
        assert (r["size"], r.leverage, r.buy_dip, r.faster_profit, r.expand_leverage, ",".join(r.modifiers)) == RESPONSE_CASES[r.k][1]
    on = df.withColumn("events", F.when(F.col("k") == 0, F.array(F.lit("CPI"), F.lit("FOMC"))))
    got = {r.k: r for r in strategy.event_modified(strategy.response(on), [("fed", ("FOMC",), {"leverage": False}, 0.5), ("print", ("CPI",), {"confirm_longs": True}, 0.75), ("never", ("x",), {"buy_dip": False}, 0.0)]).collect()}
    assert (got[0]["size"], got[0].leverage, got[0].confirm_longs, got[0].buy_dip, got[0].modifiers) == (0.5, False, True, True, ["bull_healthy_low_vol", "fed", "print"])
    assert got[1]["size"] == 0.75 and got[1].modifiers == ["recovery_attempt", "sideways_chop"]


def test_staleness_clocks(spark):
    sessions = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2), (D(2024, 1, 8), 3), (D(2024, 1, 9), 4)], "session date, pos long")
    readings = spark.createDataFrame([("a", D(2024, 1, 2), 1.0), ("b", D(2024, 1, 2), 1.0), ("a", D(2024, 1, 6), 1.0), ("b", D(2024, 1, 6), 1.0), ("a", D(2024, 1, 9), None)], "source string, date date, value double")
    got = {(r.source, r.pos): r.days for r in assembly.staleness(sessions, readings, {"a": "calendar", "b": "trading", "c": "calendar"}).collect()}
    never = assembly.NEVER
    assert got == {("a", 1): never, ("a", 2): 0, ("a", 3): 2, ("a", 4): 3, ("b", 1): never + 1, ("b", 2): 0, ("b", 3): 1, ("b", 4): 2, ("c", 1): never, ("c", 2): never, ("c", 3): never, ("c", 4): never}


def test_classification_statuses(spark):
    rows = [
        ("stale_data", "x", "x", "x", 1.0, 1.0), ("insufficient_history", "x", "x", "x", 1.0, 1.0), ("insufficient_data", "x", "x", "x", 1.0, 1.0), ("ok", "x", "x", "x", None, None), ("degraded", "bull", "unknown", "unknown", None, 1.0),
        ("ok", "unknown", "unknown", "unknown", None, 1.0), ("ok", "unknown", "unknown", "unknown", None, None), ("ok", "unknown", "unknown", "unknown", 1.0, 1.0),
    ]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, status string, raw_label string, stable_label string, active_label string, p double, q double")
    got = [(r.classification, r.reason) for r in assembly.classified(df, ["q", "p"]).orderBy("k").collect()]
    assert got == [
        ("stale_data", "stale_data"), ("insufficient_history", "insufficient_history"), ("data_unavailable", "insufficient_data"), ("classified", None), ("no_rule_fired_hysteresis", "hysteresis_held_unknown"),
        ("no_rule_fired_missing_feature", "missing_rule_feature:p"), ("no_rule_fired_missing_feature", "missing_rule_features:p,q"), ("no_rule_fired", "no_rule_fired"),
    ]
    assert assembly.classified(df, ["q", "p"], ("p",)).where("k = 5").collect()[0].classification == "no_rule_fired"


def test_debounce_and_states(spark):
    states = list("aabbabbbcab")
    rows = spark.createDataFrame([("s", D(2024, 1, 1) + datetime.timedelta(k), k + 1, x) for k, x in enumerate(states)], "series_id string, session date, pos long, label string")
    got = [(r.confirmed, r.pending) for r in folds.debounce(rows, {"b": 3, "c": 1}, "label").orderBy("pos").collect()]
    assert [g[0] for g in got] == list("aaaaaaabcaa") and [g[1] for g in got] == [False, False, True, True, False, True, True, False, False, False, True]
    flags = ["crisis", "bear_stress", "fragile_bull", "recovery_attempt", "sideways_stress", "event_watch", "cooldown"]
    cases = [("stable", ()), ("stable", ("cooldown",)), ("weakening", ("cooldown",)), ("stable", ("event_watch",)), ("weakening", ("fragile_bull", "bear_stress")), ("stable", ("recovery_attempt", "sideways_stress")), ("insufficient_data", ("crisis",))]
    df = spark.createDataFrame([(k, band, *(f in on for f in flags)) for k, (band, on) in enumerate(cases)], "k int, band string, " + ", ".join(f"{f} boolean" for f in flags))
    assert [r.state for r in transition.state(df).orderBy("k").collect()] == ["stable", "watch", "weakening", "watch", "bear_stress", "recovery_attempt", "crisis"]


def plain_adx(high, low, close, n):
    """The average directional index in plain loops: recursive averages that start with the first value and show from the n-th on."""

    def smooth(xs):
        out, last, seen = [], None, 0
        for x in xs:
            if x is not None:
                last, seen = x if last is None else last + (x - last) / n, seen + 1
            out.append(last if seen >= n else None)
        return out

    tr, plus, minus = [], [], []
    for t in range(len(close)):
        tr.append(high[t] - low[t] if t == 0 else max(high[t] - low[t], abs(high[t] - close[t - 1]), abs(low[t] - close[t - 1])))
        up, down = (0, 0) if t == 0 else (high[t] - high[t - 1], low[t - 1] - low[t])
        plus.append(up if up > down and up > 0 else 0.0)
        minus.append(down if down > up and down > 0 else 0.0)
    a, p, m = smooth(tr), smooth(plus), smooth(minus)
    dx = [100 * abs(x - y) / (x + y) if x is not None and y is not None and x + y else None for x, y in zip(p, m)]
    return smooth(dx)


def test_adx_equals_plain_loops(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    close = 100 + np.cumsum(rng.normal(size=120))
    high, low = close + rng.random(120), close - rng.random(120)
    rows = spark.createDataFrame([("s", D(2024, 1, 1) + datetime.timedelta(k), k + 1, float(h), float(x), float(c)) for k, (h, x, c) in enumerate(zip(high, low, close))], "series_id string, session date, pos long, high double, low double, close double")
    got = [r.adx for r in folds.adx(rows).orderBy("pos").collect()]
    want = plain_adx(high, low, close, 14)
    assert got[-60:] == pytest.approx(want[-60:], abs=1e-9)
