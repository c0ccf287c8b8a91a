"""Hurst exponents, ATR ratios and correlation structure against plain loops; spike windows and limbs by hand."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import calendar, evaluate, families, folds, network

DAY = datetime.date(2020, 1, 1)


def bars_of(spark, n=120, seed=1, series=("a", "b")):
    rng = np.random.default_rng(seed)
    rows = []
    for s in series:
        close = 100 * np.exp(np.cumsum(rng.normal(0, 0.02, n)))
        for k, c in enumerate(close):
            high, low = c * (1 + abs(rng.normal(0, 0.01))), c * (1 - abs(rng.normal(0, 0.01)))
            rows.append((s, DAY + datetime.timedelta(k), k + 1, float(c), float(high), float(low), float(c), 10 + k % 7))
    return spark.createDataFrame(rows, "series_id string, session date, pos long, open double, high double, low double, close double, volume long")


def test_hurst_equals_a_plain_version(spark):
    bars = bars_of(spark, 70)
    got = {(r["series_id"], r["pos"]): r["hurst"] for r in families.hurst(bars, 30).collect()}
    rows = {}
    for r in bars.orderBy("pos").collect():
        rows.setdefault(r["series_id"], []).append(r["close"])
    for s, closes in rows.items():
        for k in range(len(closes)):
            if k < 29:
                assert got[s, k + 1] is None
                continue
            r = [np.log(b / a) for a, b in zip(closes[k - 29 : k], closes[k - 28 : k + 1])]
            mean, walk, walks = sum(r) / len(r), 0.0, []
            for x in r:
                walk += x - mean
                walks.append(walk)
            deviation = (sum((x - mean) ** 2 for x in r) / len(r)) ** 0.5
            assert got[s, k + 1] == pytest.approx(np.log((max(walks) - min(walks)) / deviation) / np.log(len(r)))


def test_atr_ratio_equals_a_plain_version(spark):
    bars = bars_of(spark, 90, 2, ("a",))
    plain = [r.asDict() for r in bars.orderBy("pos").collect()]
    ranges = [max(r["high"] - r["low"], *(abs(r[c] - plain[k - 1]["close"]) for c in ("high", "low"))) if k else r["high"] - r["low"] for k, r in enumerate(plain)]

    def atr(n):
        out, state = [], None
        for k, x in enumerate(ranges):
            state = sum(ranges[:n]) / n if k == n - 1 else None if k < n else (state * (n - 1) + x) / n
            out.append(state)
        return out

    from tidemark.functions import rolling as R

    with_range = bars.withColumn("tr", R.true_range(F.col("high"), F.col("low"), F.col("close")))
    for n in (14, 50):
        got = [r["atr"] for r in folds.atr(with_range, n).orderBy("pos").collect()]
        assert got == [None if x is None else pytest.approx(x) for x in atr(n)]


def test_structure_equals_a_plain_version(spark):
    """Windows over several chunks; a series that is mostly absent leaves, and rows with a gap in the others are left out."""
    rng = np.random.default_rng(5)
    n, names = 60, [f"s{k}" for k in range(6)]
    r = rng.normal(0, 1, (n, 6)) + rng.normal(0, 1, (n, 1))
    r[:, 5][rng.random(n) < 0.5] = np.nan
    r[30, 2] = np.nan
    r[0] = np.nan
    rows = [(s, DAY + datetime.timedelta(k), k + 1, None if np.isnan(r[k, j]) else float(r[k, j])) for k in range(n) for j, s in enumerate(names)]
    df = spark.createDataFrame(rows, "series_id string, session date, pos long, r double")
    got = {x["pos"]: x for x in network.structure(df, 20, 0.9, 3, chunk=25).collect()}
    assert sorted(got) == list(range(21, 61))
    for pos, x in got.items():
        w = r[pos - 20 : pos]
        kept = w[:, np.isfinite(w).mean(0) >= 0.9]
        whole = kept[np.isfinite(kept).all(1)]
        values = np.linalg.eigvalsh(np.corrcoef(whole, rowvar=False))[::-1]
        p = values / values.sum()
        corr = np.corrcoef(whole, rowvar=False)[np.triu_indices(kept.shape[1], 1)]
        assert (x["columns"], x["rows"]) == (kept.shape[1], len(whole))
        assert [x["mean_corr"], x["top_share"], x["top3_share"], x["effective_rank"]] == pytest.approx([corr.mean(), p[0], p[:3].sum(), np.exp(-(p * np.log(p)).sum())])


def test_spike_windows_and_limbs(spark):
    df = spark.createDataFrame([(["spike"],), (["spike", "persistent_7d"],), (["persistent_7d", "persistent_30d"],), ([],), (None,)], "c array<string>")
    assert [tuple(r["w"]) for r in df.select(families.spike_window("c").alias("w")).collect()] == [(0, 0), (-1, 3), (-2, 5), (0, 0), (0, 0)]
    rows = spark.createDataFrame([(0.03, 0.034, -0.1), (0.04, 0.05, 0.0), (None, 0.01, 0.2), (0.03, 0.0249, None)], "change6 double, change6_lag double, change6_slope double")
    got = [(r["drift_margin"] is None, r["benign_margin"] is None, r["limbs"]) for r in families.limb_evidence(rows).collect()]
    assert got == [(False, False, 3), (False, False, 1), (True, True, 0), (False, False, 1)]


def test_character_needs_63_sessions_for_its_drawdown(spark):
    got = [r["dd63"] for r in families.character_features(bars_of(spark, 80, 3, ("a",))).orderBy("pos").collect()]
    assert all(x is None for x in got[:62]) and all(x is not None and x <= 0 for x in got[62:])


def test_volume_features_hold_gaps_and_ranges(spark, sf):
    from tidemark.plans import registry

    got, table = (registry.QUERIES[q](spark, sf).select("series_id", "session", "gap_freq", "range_pct") for q in ("d08_volume_features", "d06_volatility_features"))
    assert got.columns == table.columns and got.where("range_pct IS NOT NULL").count() > 0 and sorted(got.collect(), key=repr) == sorted(table.collect(), key=repr)
    assert "volume_z" in registry.QUERIES["d08_volume_features"](spark, sf).columns


def test_a_candidate_wins_by_any_metric_and_nulls_win_nothing(spark):
    schema = "series_id string, drawdown double, sharpe double, lag double, switch_rate double"
    now = spark.createDataFrame([("a", -0.2, 1.0, 5.0, 0.1), ("b", -0.2, 1.0, None, 0.1), ("c", -0.2, 1.0, 5.0, 0.1)], schema)
    new = spark.createDataFrame([("a", -0.1, 1.0, 4.0, 0.1), ("b", -0.2, 1.0, 1.0, 0.1), ("c", -0.3, 1.1, 5.0, 0.05)], schema)
    got = {r["series_id"]: (r["passed"], r["winners"]) for r in evaluate.promotion_gate(now, new).collect()}
    assert got == {"a": (True, "lower_drawdown,earlier_crisis_detection"), "b": (False, ""), "c": (True, "higher_sharpe,lower_false_switch_rate")}


def test_event_labels_need_their_version_and_approval(spark):
    rows = spark.createDataFrame([("FOMC", None), ("ECB_decision", None), ("geopolitical_event", None), ("geopolitical_event", "geopolitical_event"), ("geopolitical_event", "fed_week"), ("other", None)], "type string, approved_label string")
    assert [r["label"] for r in calendar.labelled(rows).collect()] == ["fed_week", "global_rate_decision", "geopolitical_event"]
    assert [r["label"] for r in calendar.labelled(rows, later_types=False).collect()] == ["fed_week"]
    ids = spark.createDataFrame([(["b", "a", "b", None],), (["a", "b"],), (["a"],)], "s array<string>").withColumns({"t": F.lit("CPI"), "d": F.lit("2020-01-01").cast("date")})
    got = [r[0] for r in ids.select(calendar.candidate_id("t", "d", "s")).collect()]
    assert got[0] == got[1] != got[2] and all(len(x) == 16 for x in got)
