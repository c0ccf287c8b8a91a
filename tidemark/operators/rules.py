"""Labels by rules: for each axis an ordered list of (label, condition), the first that holds.

Conditions are SQL over columns of a wide feature table; a null in a condition makes it
false. A ladder that must be unknown on missing input says so in its first rule.
Fixed values: thresholds and orders of the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing(*columns: str) -> str:
    return " OR ".join(f"{c} IS NULL" for c in columns)


TREND = [
    ("unknown", missing("close", "sma50", "sma200", "ret63")),
    ("bull", "close > sma50 AND close > sma200 AND sma50 > sma200"),
    ("bear", "close < sma50 AND close < sma200 AND sma50 < sma200"),
    ("sideways", "abs(ret63) < 0.05 AND close >= sma200 * 0.95 AND close <= sma200 * 1.05"),
    ("transition", "true"),
]
#: Over the label of TREND, as column `label`.
TREND_OVERLAY = [
    ("euphoria", "close > sma200 AND ret126 > 0.20 AND rv21 > rv21_5 AND sentiment >= 20"),
    ("recovery", "label <> 'bull' AND dd252 <= -0.15 AND ret63 > 0.10 AND close > sma50"),
]
CHARACTER = [
    ("unknown", missing("close", "sma50", "ret10", "ret21", "dd63", "adx")),
    ("breakout_expansion", "breakout = 1 AND widening = 1 AND coalesce(heavy, 1) = 1 AND follow >= 0.60"),
    ("recovery_attempt", "dd63 <= -0.10 AND close > sma50 AND ret10 >= 0.05"),
    ("trending", "adx >= 20 AND abs(ret21) >= 0.05"),
    ("mild_trend", "adx >= 20 AND abs(ret21) < 0.05"),
    ("range_bound", "adx < 20 AND abs(ret63) < 0.05 AND midpoint <= 0.05"),
    ("chop", "adx < 20 AND abs(ret10) < 0.03 AND abs(ret21) < 0.05"),
    ("volatile_chop", "adx < 20"),
    ("transition", "true"),
]
VOLATILITY = [
    ("unknown", missing("ret1", "ret5", "ret21", "rv_pct")),
    ("crisis_vol", "ret1 <= -0.05 OR ret5 <= -0.08 OR (rv_pct >= 0.90 AND ret21 <= -0.05) OR vix_pct >= 0.95"),
    ("high_vol", "rv_pct >= 0.80 OR vix_pct >= 0.80"),
    ("low_vol", "rv_pct <= 0.30"),
    ("normal_vol", "true"),
]
VOLATILITY_OVERLAY = [
    ("vol_crush", "label <> 'crisis_vol' AND rv10 < rv21 * 0.75 AND iv_change <= -0.20 AND after_event"),
    ("rising_vol", "label IN ('low_vol', 'normal_vol', 'unknown') AND atr_ratio > 1.15 AND rv10 > rv63 * 1.25"),
]
BREADTH = [
    ("unknown", missing("ratio", "ratio_sma", "ratio_ret20", "from_high")),
    ("divergent_fragile", "from_high >= -0.05 AND ratio < ratio_sma AND ratio_ret20 <= -0.03"),
    ("weak_breadth", "ratio < ratio_sma AND ratio_ret20 < 0"),
    ("healthy_breadth", "ratio > ratio_sma AND ratio_ret20 >= 0"),
    ("neutral_breadth", "true"),
]
#: Over the label of BREADTH; *_5: the value five sessions before.
BREADTH_OVERLAY = [
    ("breadth_thrust", "thrust > 0.615 AND thrust_low < 0.40"),
    ("divergent_fragile", "label = 'divergent_fragile'"),
    ("narrowing_breadth", "above50 < above50_5 AND above200 < above200_5 AND high_low < 0.4"),
    ("recovery_breadth", "high_low > high_low_5 AND ad_slope <= 0"),
    ("broadening_breadth", "high_low > high_low_5 AND ad_slope > 0"),
]
CORRELATED = "((corr_pct > 0.90 AND rv_pct > 0.80 AND dd21 < 0) OR ((corr_pct IS NULL OR eig_pct IS NULL OR rv_pct IS NULL) AND corr >= 0.90 AND eig >= 0.75 AND rv21 >= 0.25 AND dd21 < 0))"
STRESSED = f"{CORRELATED} AND vix_pct > 0.80 AND breadth IN ('divergent_fragile', 'weak_breadth', 'narrowing_breadth')"
NETWORK = [
    ("systemic_stress", f"{STRESSED} AND credit IN ('spread_widening', 'credit_stress', 'funding_squeeze', 'deleveraging')"),
    ("systemic_stress_unconfirmed", f"{STRESSED} AND credit IS NULL"),
    ("correlation_to_one", CORRELATED),
    ("correlation_concentration", "corr_pct > 0.75 OR eig_pct > 0.75 OR rank_pct < 0.25 OR absorption > 0.90"),
    ("rising_fragility", "corr_slope > 0 AND eig_slope > 0"),
    ("stock_picker_dispersion", "corr_pct < 0.30 AND dispersion_pct > 0.70"),
    ("decorrelated_calm", "corr_pct < 0.30 AND dispersion_pct <= 0.70"),
    ("rotation_watch", "corr_pct > 0.60 AND corr_pct <= 0.75 AND rank_stability >= 0.05"),
    ("diversified_normal", "corr_pct BETWEEN 0 AND 0.75 AND (rank_stability < 0.05 OR corr_pct BETWEEN 0.30 AND 0.60)"),
    ("unknown", "true"),
]
VOLUME = [
    ("panic_volume", "volume_z > 2.0 AND ret1 < -0.02"),
    ("liquidity_gap_behavior", "gap_pct > 0.75 AND range_pct > 0.75"),
    ("normal_volume", "volume_z IS NOT NULL AND ret1 IS NOT NULL AND gap_pct IS NOT NULL AND range_pct IS NOT NULL"),
    ("unknown", "true"),
]
MONETARY = [
    ("unknown", missing("z2y", "z10y", "z_usd", "z2y_short", "z10y_short")),
    ("rate_shock", "abs(z2y_short) > 2.0 OR abs(z10y_short) > 2.0"),
    ("tightening_pressure", "z2y > 1.5 OR z10y > 1.5 OR z_usd > 1.5"),
    ("easing_pressure", "z2y < -1.5 OR z10y < -1.5"),
    ("neutral_monetary", "true"),
]
CREDIT = [
    ("deleveraging", "ret21 < -0.05 AND bond_ret21 < 0 AND z_usd > 0 AND ((rv_pct > 0.75 AND corr_pct > 0.75) OR ((rv_pct IS NULL OR corr_pct IS NULL) AND rv21 >= 0.25 AND corr >= 0.75))"),
    ("funding_squeeze", "z_usd > 1.5 AND funding_slope > 0 AND ret21 < 0"),
    ("credit_stress", "hy_pct > 0.80 AND ret21 < -0.05"),
    ("spread_widening", "hy_slope > 0 AND hy_pct IS NOT NULL AND (ig_slope > 0 OR hy_pct >= 0.50)"),
    ("credit_divergence", "hy_pct < 0.50 AND hy_slope > 0 AND ig_slope <= 0"),
    ("credit_recovery", "hy_pct >= 0.50 AND hy_slope < 0"),
    ("credit_calm", "hy_pct < 0.50 AND hy_slope <= 0"),
    ("unknown", "true"),
]
CALM = "(credit = 'credit_calm' OR credit IS NULL)"
TIGHT = "credit IN ('spread_widening', 'credit_stress')"
INFLATION = [
    ("inflation_shock", "surprise > 1.5 OR (commodity63 > 0.15 AND yield_slope > 0 AND ret21 < 0 AND bond_ret21 < 0) OR (cpi3 > 0.02 AND yield_slope > 0)"),
    ("recession_scare", f"yield_slope < 0 AND rotation < 0 AND (({TIGHT} AND ret21 < -0.05) OR (credit IS NULL AND ret21 < -0.07))"),
    ("risk_off_mild", f"{TIGHT} AND ret21 < 0 AND ret21 >= -0.05 AND (rotation < 0 OR yield_slope < 0 OR pmi < 50)"),
    ("goldilocks", f"{CALM} AND pmi > 50 AND ret21 > 0 AND (abs(cpi6 - cpi6_lag) < 0.005 OR cpi_slope < 0 OR cpi6 < 0.04)"),
    ("recovery_growth", f"{CALM} AND pmi_slope > 0 AND pmi > 50 AND rotation > 0"),
    ("recovery_growth_unconfirmed", f"cpi_slope <= 0 AND pmi_slope > 0 AND pmi > 50 AND rotation > 0 AND NOT {CALM}"),
    ("disinflation", "cpi_slope < 0 AND pmi > 45"),
    ("late_cycle_inflation_stress", f"cpi_slope >= 0 AND pmi > 50 AND (ret21 <= 0 OR {TIGHT})"),
    ("reflation", "cpi_slope > 0 AND pmi > 50 AND ret21 > 0 AND coalesce(credit NOT IN ('credit_stress', 'funding_squeeze', 'deleveraging'), true)"),
    ("stagflation_lite", "cpi_slope > 0 AND pmi <= 50"),
    ("earnings_contraction", "eps < -0.02"),
    ("earnings_expansion", "eps > 0.02"),
    ("contractionary_disinflation", "cpi_slope <= 0 AND pmi <= 45"),
    ("macro_neutral", "cpi_slope IS NOT NULL AND pmi IS NOT NULL AND ret21 IS NOT NULL"),
    ("unknown", "true"),
]
#: Risk ranks and days before a label is left, for hysteresis; labels that are not named leave at once.
RANKS = {
    "trend": {"bull": 0, "sideways": 1, "recovery": 1, "transition": 2, "unknown": 2, "bear": 3, "euphoria": 4},
    "character": {"trending": 0, "breakout_expansion": 0, "mild_trend": 0, "recovery_attempt": 1, "range_bound": 1, "chop": 1, "volatile_chop": 1, "transition": 2, "unknown": 2},
    "volatility": {"low_vol": 0, "normal_vol": 1, "high_vol": 2, "unknown": 2, "rising_vol": 2, "crisis_vol": 3, "vol_crush": 3},
    "breadth": {"breadth_thrust": 0, "healthy_breadth": 0, "broadening_breadth": 0, "neutral_breadth": 1, "recovery_breadth": 1, "weak_breadth": 2, "narrowing_breadth": 2, "unknown": 2, "divergent_fragile": 3},
    "network": {"diversified_normal": 0, "decorrelated_calm": 0, "stock_picker_dispersion": 1, "rotation_watch": 1, "rising_fragility": 2, "correlation_concentration": 2, "unknown": 2, "correlation_to_one": 3, "systemic_stress_unconfirmed": 3, "systemic_stress": 3},
    "volume": {"normal_volume": 0, "unknown": 1, "liquidity_gap_behavior": 2, "panic_volume": 3},
    "monetary": {"neutral_monetary": 0, "easing_pressure": 1, "unknown": 1, "tightening_pressure": 2, "rate_shock": 3},
    "credit": {"credit_calm": 0, "credit_recovery": 0, "credit_divergence": 1, "unknown": 1, "spread_widening": 1, "credit_stress": 2, "funding_squeeze": 3, "deleveraging": 4},
}
LEAVE = {
    "trend": {"bear": 5, "transition": 3, "recovery": 3, "sideways": 2, "euphoria": 3},
    "character": {"breakout_expansion": 3, "recovery_attempt": 3, "range_bound": 3, "transition": 2},
    "volatility": {"crisis_vol": 5, "vol_crush": 3, "high_vol": 3, "rising_vol": 2},
    "breadth": {"divergent_fragile": 5, "weak_breadth": 3, "narrowing_breadth": 3, "neutral_breadth": 2, "recovery_breadth": 2, "breadth_thrust": 2},
    "network": {"rising_fragility": 3, "correlation_concentration": 3, "correlation_to_one": 5, "systemic_stress_unconfirmed": 5, "systemic_stress": 5},
    "volume": {"panic_volume": 2, "liquidity_gap_behavior": 2},
    "monetary": {"rate_shock": 5, "tightening_pressure": 3, "easing_pressure": 2},
    "credit": {"deleveraging": 5, "funding_squeeze": 5, "credit_stress": 3, "spread_widening": 3},
}


def case(ladder: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    """The ladder as a SQL CASE."""
    return "CASE " + " ".join(f"WHEN {condition} THEN '{name}'" for name, condition in ladder) + f" ELSE {otherwise} END"


def label(ladder: list[tuple[str, str]], otherwise: str = "NULL") -> Column:
    return F.expr(case(ladder, otherwise))


def labelled(features: DataFrame, ladder: list, overlay: list | None = None) -> DataFrame:
    """`features` with the column `label`; an overlay's first rule that holds replaces it."""
    out = features.withColumn("label", label(ladder))
    return out.withColumn("label", label(overlay, "label")) if overlay else out


def effective_credit(own: Column, proxy: Column) -> Column:
    """Of two credit labels the riskier; where one is unknown or absent, the other."""
    rank = F.create_map(*(F.lit(x) for k, v in {"unknown": -1, "credit_calm": 0, "credit_recovery": 1, "credit_divergence": 1, "spread_widening": 2, "credit_stress": 3, "funding_squeeze": 4, "deleveraging": 5}.items() for x in (k, v)))
    a, b = F.coalesce(F.element_at(rank, own), F.lit(-2)), F.coalesce(F.element_at(rank, proxy), F.lit(-2))
    return F.when(a >= b, own).otherwise(proxy)
