"""Sliding ranks, network rule inputs and the transition score against plain versions."""

import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import network, order_statistics, rules, transition


@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_sliding_ranks_equal_pandas(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 9, 200).astype(float)
    x[rng.random(200) < 0.04] = np.nan
    want = pd.Series(x).rolling(n).rank(pct=True)
    got = pd.Series(order_statistics.sliding_ranks(x.tolist(), n, True), dtype=float)
    assert np.allclose(got, want, equal_nan=True)
    most = pd.Series(x).rolling(n).apply(lambda w: (w <= w[-1]).mean(), raw=True)
    assert np.allclose(pd.Series(order_statistics.sliding_ranks(x.tolist(), n, False), dtype=float), most, equal_nan=True)


@pytest.mark.parametrize("chunk", [3, 50, 1000])
def test_ranks_cross_chunks(spark, chunk):
    """Chunks shorter than the window, and series of different lengths, give the same ranks as one pass."""
    rng = np.random.default_rng(1)
    rows = [(s, k, float(v) if v >= 0 else None, float(k % 5)) for s, n in (("a", 120), ("b", 9), ("c", 1)) for k, v in enumerate(rng.integers(-1, 30, n))]
    df = spark.createDataFrame(rows, "series_id string, session long, x double, y double")
    got = {(r["series_id"], r["session"]): (r["px"], r["py"]) for r in order_statistics.ranked(df, {"px": ("x", 10), "py": ("y", 4)}, chunk=chunk).collect()}
    assert len(got) == len(rows)
    for s in "abc":
        own = [r for r in rows if r[0] == s]
        for column, n, at in ((2, 10, 0), (3, 4, 1)):
            want = order_statistics.sliding_ranks([float("nan") if r[column] is None else r[column] for r in own], n, True)
            assert [got[s, r[1]][at] for r in own] == want


def day(k):
    return datetime.date(2020, 1, 1) + datetime.timedelta(k)


def test_network_rule_inputs_equal_pandas(spark):
    rng = np.random.default_rng(2)
    n = 60
    s = pd.DataFrame({"session": [day(k) for k in range(n)], "mean_corr": rng.random(n), "top_share": rng.random(n), "top3_share": rng.random(n), "effective_rank": 1 + rng.random(n), "close": 100 + rng.normal(0, 3, n)})
    ranks = spark.createDataFrame(s[["session", "mean_corr", "top_share", "top3_share", "effective_rank"]]).withColumns({c: F.lit(0.5) for c in ("corr_pct", "eig_pct", "rank_pct", "dispersion_pct")})
    anchor = spark.createDataFrame(s[["session", "close"]]).withColumns({c: F.lit(0.1) for c in ("rv21", "rv_pct", "vix_pct")})
    labels = spark.createDataFrame([(day(50), "weak_breadth")], "session date, label string")
    got = network.rule_inputs(ranks, anchor, labels, labels.where("false")).orderBy("session").toPandas()
    slope = lambda x: x.rolling(21).apply(lambda w: np.polyfit(np.arange(21), w, 1)[0], raw=True)
    assert np.allclose(got["corr_slope"], slope(s["mean_corr"]), equal_nan=True) and np.allclose(got["eig_slope"], slope(s["top_share"]), equal_nan=True)
    e = s["effective_rank"].rolling(21)
    assert np.allclose(got["rank_stability"], e.std(ddof=0) / e.mean(), equal_nan=True)
    assert np.allclose(got["dd21"], s["close"] / s["close"].rolling(21).max() - 1, equal_nan=True)
    assert got["breadth"].tolist()[50] == "weak_breadth" and got["breadth"].notna().sum() == 1 and got["credit"].isna().all()


NUMBERS = ("rv_short", "rv_long", "pct_above", "corr_pct", "eig_pct", "rank_pct", "top3_share", "dd252", "close", "sma50", "volume_z", "gap_pct", "range_pct", "hidden_top", "hidden_before", "change_score")


def plain_components(r):
    """The components of one session in plain steps; None where nothing is known."""
    clip = lambda x: None if x is None else min(1.0, max(0.0, x))
    most = lambda *x: max([y for y in x if y is not None], default=None)
    get = r.get
    trend = most(clip(-get("dd252") / 0.15) if get("dd252") is not None else None, clip((get("sma50") - get("close")) / get("sma50") / 0.05) if get("sma50") and get("close") is not None else None)
    vol = clip((get("rv_short") / get("rv_long") - 1) / 0.5) if get("rv_short") is not None and get("rv_long") else None
    breadth = clip((0.5 - get("pct_above")) / 0.3) if get("pct_above") is not None else None
    corr = most(get("corr_pct"), get("eig_pct"), None if get("rank_pct") is None else 1 - get("rank_pct"), clip((get("top3_share") - 0.7) / 0.25) if get("top3_share") is not None else None)
    credit = {"credit_calm": 0.0, "credit_stress": 0.75, "deleveraging": 1.0}.get(get("credit_label"))
    liquid = most({"normal_volume": 0.0, "panic_volume": 1.0}.get(get("volume_label")), clip((get("volume_z") - 1) / 2) if get("volume_z") is not None else None, get("gap_pct"), get("range_pct"))
    event = 1.0 if {"fed_week", "cpi_week"} & set(get("event_labels")) else 0.0
    five = [get(k) for k in ("hidden_top", "hidden_before", "change_score", "cluster", "cluster_before")]
    model = None if None in five else most(clip(abs(five[0] - five[1])), clip(five[2]), float(five[3] != five[4]))
    return {"trend_break": trend, "volatility_acceleration": vol, "breadth_deterioration": breadth, "correlation_fragility": corr, "credit_stress": credit, "liquidity_stress": liquid, "macro_event": event, "model_instability": model}


def test_components_and_score_equal_a_plain_version(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(300):
        r = {c: None if rng.random() < 0.1 else float(rng.normal(0.4, 0.6)) for c in NUMBERS}
        r |= {"dd252": -abs(r["dd252"]) if r["dd252"] is not None else None, "rv_long": 0.0 if k % 50 == 0 else r["rv_long"]}
        r |= {"event_labels": [["fed_week"], [], ["geopolitical_event"], ["cpi_week", "nfp_week"]][k % 4], "credit_label": [None, "credit_calm", "credit_stress", "deleveraging", "unknown"][k % 5], "volume_label": [None, "normal_volume", "panic_volume"][k % 3]}
        r |= {"cluster": None if k % 13 == 0 else k % 3, "cluster_before": k % 2, "session": day(k), "series_id": "a"}
        rows.append(r)
    schema = "series_id string, session date, event_labels array<string>, credit_label string, volume_label string, cluster int, cluster_before int, " + ", ".join(f"{c} double" for c in NUMBERS)
    names = [f.split(" ")[0] for f in schema.split(", ")]
    df = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schema)
    got = {r["session"]: r for r in transition.scored(transition.components_of(df)).collect()}
    for r in rows:
        want, g = plain_components(r), got[r["session"]]
        for c, v in want.items():
            assert (g[c] is None) == (v is None) and (v is None or g[c] == pytest.approx(v)), (c, r)
        gone = [c for c in transition.WEIGHTS if want[c] is None]
        assert g["missing"] == ",".join(gone)
        total = None if gone else min(1.0, max(0.0, sum(want[c] * w for c, w in transition.WEIGHTS.items()) / sum(transition.WEIGHTS.values())))
        assert (g["score"] is None) == (total is None) and (total is None or g["score"] == pytest.approx(total))
    assert any(r["score"] is not None for r in got.values())


def test_model_evidence_is_joined_across_checkpoints_and_labels_by_classification(spark):
    """Five sessions before is by session, whatever checkpoint scored it; sessions without evidence count as sessions."""
    rows = spark.createDataFrame([("a", day(k), k) for k in range(12)], "series_id string, session date, pos long")
    seen = [k for k in range(12) if k not in (3, 9)]
    hidden = spark.createDataFrame([("a", day(k), 1 if k < 6 else 2, k / 10) for k in seen], "series_id string, session date, checkpoint long, probability double")
    clusters = spark.createDataFrame([("a", day(k), k % 4) for k in seen], "series_id string, session date, top int")
    changes = spark.createDataFrame([("a", day(k), 0.9 if k == 2 else 0.1) for k in range(1, 12)], "series_id string, session date, change_point double")
    axis = spark.createDataFrame([("a", day(k), "credit_calm", "classified" if k % 2 else "no_rule_fired_hysteresis") for k in range(12)], "series_id string, session date, active_label string, classification string")
    events = spark.createDataFrame([(day(4), "fed_week"), (day(4), "cpi_week"), (day(4), "cpi_week")], "session date, label string")
    got = {r["pos"]: r for r in transition.score_inputs(rows, [rows.select("session", F.lit(0.3).alias("pct_above"))], hidden, clusters, changes, axis, axis, events).collect()}
    assert [got[k]["hidden_before"] for k in range(12)] == [None] * 5 + [0.0, 0.1, 0.2, None, 0.4, 0.5, 0.6]
    assert [got[k]["cluster_before"] for k in (5, 6, 8, 11)] == [0, 1, None, 2]
    assert [got[k]["change_score"] for k in (0, 1, 2, 6, 7)] == [None, 0.1, 0.9, 0.9, 0.1]
    assert [got[k]["credit_label"] for k in range(4)] == [None, "credit_calm", None, "credit_calm"]
    assert got[4]["event_labels"] == ["cpi_week", "fed_week"] and got[5]["event_labels"] == [] and got[0]["pct_above"] == 0.3


def label_of(spark, ladder, otherwise="NULL", **values):
    kinds = {k: "string" if isinstance(v, str) or k in ("credit", "breadth", "label") else "double" for k, v in values.items()}
    df = spark.createDataFrame([tuple(float(v) if kinds[k] == "double" and v is not None else v for k, v in values.items())], ", ".join(f"{k} {t}" for k, t in kinds.items()))
    return df.select(rules.label(ladder, otherwise)).first()[0]


CREDIT = dict(ret21=0, bond_ret21=0, z_usd=0, rv_pct=0.5, corr_pct=0.5, rv21=0.1, corr=0.2, funding_slope=0, hy_pct=0.4, hy_slope=0, ig_slope=0)
NETWORK = dict(corr_pct=0.5, eig_pct=0.5, rank_pct=0.5, dispersion_pct=0.5, corr=0.3, eig=0.3, absorption=0.5, corr_slope=0, eig_slope=0, rank_stability=0.01, dd21=0, rv21=0.1, rv_pct=0.5, vix_pct=0.5, breadth=None, credit=None)
CHARACTER = dict(close=100, sma50=90, ret10=0, ret21=0, ret63=0, dd63=0, adx=25, breakout=0, widening=0, heavy=None, follow=None, midpoint=0.2)


@pytest.mark.parametrize("ladder, base, changed, want", [
    (rules.CREDIT, CREDIT, dict(ret21=-0.0501, bond_ret21=-0.01, z_usd=0.1, rv_pct=0.76, corr_pct=0.76), "deleveraging"),
    (rules.CREDIT, CREDIT, dict(ret21=-0.0501, bond_ret21=-0.01, z_usd=0.1, rv_pct=0.75, corr_pct=0.76, hy_slope=0.1, ig_slope=0.1), "spread_widening"),
    (rules.CREDIT, CREDIT, dict(z_usd=1.51, funding_slope=0.1, ret21=-0.01), "funding_squeeze"),
    (rules.CREDIT, CREDIT, dict(z_usd=1.5, funding_slope=0.1, ret21=-0.01), "credit_calm"),
    (rules.CREDIT, CREDIT, dict(hy_pct=0.81, ret21=-0.051), "credit_stress"),
    (rules.CREDIT, CREDIT, dict(hy_pct=0.80, ret21=-0.051, hy_slope=-0.1), "credit_recovery"),
    (rules.CREDIT, CREDIT, dict(hy_slope=0.1, hy_pct=0.5), "spread_widening"),
    (rules.CREDIT, CREDIT, dict(hy_slope=0.1, hy_pct=0.49), "credit_divergence"),
    (rules.CREDIT, CREDIT, dict(hy_pct=None), "unknown"),
    (rules.NETWORK, NETWORK, dict(), "diversified_normal"),
    (rules.NETWORK, NETWORK, dict(corr_pct=0.76), "correlation_concentration"),
    (rules.NETWORK, NETWORK, dict(corr_pct=0.75, rank_stability=0.05), "rotation_watch"),
    (rules.NETWORK, NETWORK, dict(rank_pct=0.24), "correlation_concentration"),
    (rules.NETWORK, NETWORK, dict(absorption=0.91), "correlation_concentration"),
    (rules.NETWORK, NETWORK, dict(corr_slope=0.1, eig_slope=0.1), "rising_fragility"),
    (rules.NETWORK, NETWORK, dict(corr_pct=0.29, dispersion_pct=0.71), "stock_picker_dispersion"),
    (rules.NETWORK, NETWORK, dict(corr_pct=0.29, dispersion_pct=0.70), "decorrelated_calm"),
    (rules.NETWORK, NETWORK, dict(corr_pct=0.91, rv_pct=0.81, dd21=-0.01), "correlation_to_one"),
    (rules.NETWORK, NETWORK, dict(corr_pct=0.91, rv_pct=0.81, dd21=-0.01, vix_pct=0.81, breadth="weak_breadth"), "systemic_stress_unconfirmed"),
    (rules.NETWORK, NETWORK, dict(corr_pct=0.91, rv_pct=0.81, dd21=-0.01, vix_pct=0.81, breadth="weak_breadth", credit="credit_stress"), "systemic_stress"),
    (rules.NETWORK, NETWORK, dict(corr_pct=None, corr=0.9, eig=0.75, rv21=0.25, dd21=-0.01), "correlation_to_one"),
    (rules.NETWORK, NETWORK, dict(corr_pct=None), "unknown"),
    (rules.CHARACTER, CHARACTER, dict(adx=None), "unknown"),
    (rules.CHARACTER, CHARACTER, dict(breakout=1, widening=1, follow=0.6), "breakout_expansion"),
    (rules.CHARACTER, CHARACTER, dict(breakout=1, widening=1, follow=0.59), "mild_trend"),
    (rules.CHARACTER, CHARACTER, dict(breakout=1, widening=1, follow=0.6, heavy=0), "mild_trend"),
    (rules.CHARACTER, CHARACTER, dict(dd63=-0.10, ret10=0.05), "recovery_attempt"),
    (rules.CHARACTER, CHARACTER, dict(adx=20, ret21=0.05), "trending"),
    (rules.CHARACTER, CHARACTER, dict(adx=19.9, midpoint=0.05), "range_bound"),
    (rules.CHARACTER, CHARACTER, dict(adx=19.9, ret63=0.05), "chop"),
    (rules.CHARACTER, CHARACTER, dict(adx=19.9, ret10=0.03), "volatile_chop"),
])
def test_boundaries_of_rules(spark, ladder, base, changed, want):
    assert label_of(spark, ladder, **{**base, **changed}) == want


BREADTH = dict(thrust=0.5, thrust_low=0.5, label="neutral_breadth", above50=0.5, above50_5=0.5, above200=0.5, above200_5=0.5, high_low=0.5, high_low_5=0.5, ad_slope=0)


@pytest.mark.parametrize("changed, want", [
    (dict(thrust=0.616, thrust_low=0.39), "breadth_thrust"), (dict(thrust=0.615, thrust_low=0.39), "neutral_breadth"), (dict(thrust=0.616, thrust_low=0.40), "neutral_breadth"),
    (dict(above50=0.4, above200=0.4, high_low=0.39), "narrowing_breadth"), (dict(above50=0.4, above200=0.4, high_low=0.4, high_low_5=0.4), "neutral_breadth"),
    (dict(high_low=0.6), "recovery_breadth"), (dict(high_low=0.6, ad_slope=0.1), "broadening_breadth"), (dict(label="divergent_fragile", high_low=0.6), "divergent_fragile"),
])
def test_boundaries_of_the_breadth_overlay(spark, changed, want):
    assert label_of(spark, rules.BREADTH_OVERLAY, "label", **{**BREADTH, **changed}) == want
