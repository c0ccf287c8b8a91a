"""Transition pressure: component scores between 0 and 1, their weighted sum, and a state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Weights, bands, scales of the components, scores of labels.
WEIGHTS = {"trend_break": 0.18, "volatility_acceleration": 0.16, "breadth_deterioration": 0.16, "correlation_fragility": 0.14, "credit_stress": 0.12, "liquidity_stress": 0.10, "macro_event": 0.06, "model_instability": 0.08}
BANDS = (("stable", 0.35), ("weakening", 0.55), ("transition_warning", 0.75))
VOLATILITY_FULL, BREADTH_ZERO, BREADTH_RANGE, DRAWDOWN_FULL, AVERAGE_FULL, VOLUME_FLOOR, VOLUME_RANGE, DRIVER = 0.5, 0.5, 0.3, 0.15, 0.05, 1.0, 2.0, 0.35
CONFIRM = {"stable": 1, "watch": 1, "weakening": 2, "transition_warning": 2, "high_transition_risk": 2, "fragile_bull": 2, "recovery_attempt": 2, "bear_stress": 1, "crisis": 1, "insufficient_data": 1}
#: Flags in the order in which they decide the state.
STATES = (("crisis", "crisis"), ("bear_stress", "bear_stress"), ("fragile_bull", "fragile_bull"), ("recovery_attempt", "recovery_attempt"), ("sideways_stress", "watch"), ("event_watch", "watch"))


def clipped(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)) if x is not None else F.lit(None).cast("double")


def _clip(x: Column) -> Column:
    return F.when(x.isNotNull(), clipped(x))


def components(rows: DataFrame) -> DataFrame:
    """Adds a column for each component, null where its inputs are; greatest() skips nulls."""
    c = F.col
    trend = F.greatest(_clip(-c("dd252") / DRAWDOWN_FULL), _clip((c("sma50") - c("close")) / F.nullif(c("sma50"), F.lit(0.0)) / AVERAGE_FULL))
    return rows.withColumns({
        "trend_break": trend,
        "volatility_acceleration": _clip((c("rv_short") / F.nullif(c("rv_long"), F.lit(0.0)) - 1) / VOLATILITY_FULL),
        "breadth_deterioration": _clip((BREADTH_ZERO - c("pct_above")) / BREADTH_RANGE),
        "correlation_fragility": _clip(c("corr_pct")),
        "credit_stress": _clip(c("credit_score")),
        "liquidity_stress": F.greatest(_clip((c("volume_z") - VOLUME_FLOOR) / VOLUME_RANGE), _clip(c("gap_pct"))),
        "macro_event": F.when(c("event"), 1.0).otherwise(0.0),
        "model_instability": _clip(c("change_point")),
    })


#: Scores of credit and volume labels, where the share of three eigenvalues begins to count and its range, event labels that count.
CREDIT_SCORES = {"credit_calm": 0.0, "credit_recovery": 0.20, "credit_divergence": 0.25, "spread_widening": 0.45, "credit_stress": 0.75, "funding_squeeze": 0.90, "deleveraging": 1.0}
VOLUME_SCORES = {"normal_volume": 0.0, "liquidity_gap_behavior": 0.70, "panic_volume": 1.0}
ABSORPTION_FLOOR, ABSORPTION_RANGE = 0.70, 0.25
MACRO_EVENTS = ("fed_week", "cpi_week", "nfp_week", "budget_week", "election_window", "global_rate_decision")


def _score_of(label: str, scores: dict[str, float]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for pair in scores.items() for x in pair)), F.col(label))


def classified_label(axis: DataFrame, to: str) -> DataFrame:
    """(series_id, session, `to`): the active label of an axis where it was classified."""
    return axis.where((F.col("classification") == "classified") & F.col("active_label").isNotNull()).select("series_id", "session", F.col("active_label").alias(to))


def score_inputs(rows: DataFrame, market: list[DataFrame], hidden: DataFrame, clusters: DataFrame, changes: DataFrame, credit: DataFrame, volume: DataFrame, events: DataFrame, back: int = 5) -> DataFrame:
    """`rows` (series_id, session, pos, features; a row for every session) with all else that the score reads.

    market: tables by session alone, as breadth and network percentiles. hidden, clusters: evidence (series_id, session, probability and
    top) with states aligned over checkpoints; each comes with its value `back` sessions before (`*_before`), counted on the sessions of
    `rows`, whatever checkpoint gave it. changes: (series_id, session, change_point), of which the largest of `back` sessions counts.
    credit, volume: axes with classification; a label counts only where it was classified. events: (session, label).
    """
    key = ["series_id", "session"]
    out = rows
    for table in market:
        out = out.join(table, "session", "left")
    labels = events.groupBy("session").agg(F.array_sort(F.collect_set("label")).alias("event_labels"))
    out = out.join(labels, "session", "left")
    out = out.join(hidden.select(*key, F.col("probability").alias("hidden_top")), key, "left").join(clusters.select(*key, F.col("top").alias("cluster")), key, "left")
    out = out.join(changes.select(*key, F.col("change_point").alias("_change")), key, "left")
    out = out.join(classified_label(credit, "credit_label"), key, "left").join(classified_label(volume, "volume_label"), key, "left")
    order = Window.partitionBy("series_id").orderBy("pos")
    return out.withColumns({
        "event_labels": F.coalesce("event_labels", F.array().cast("array<string>")), "hidden_before": F.lag("hidden_top", back).over(order), "cluster_before": F.lag("cluster", back).over(order),
        "change_score": F.max("_change").over(order.rowsBetween(-(back - 1), 0)),
    }).drop("_change")


def components_of(inputs: DataFrame) -> DataFrame:
    """Adds a column for each component to the rows of score_inputs, the largest of those of its parts that are known.

    The instability of models is null unless all of its five inputs are known; a macro event counts 1, none 0.
    """
    c = F.col
    trend = F.greatest(_clip(-c("dd252") / DRAWDOWN_FULL), _clip((c("sma50") - c("close")) / F.nullif(c("sma50"), F.lit(0.0)) / AVERAGE_FULL))
    known = [c(x).isNotNull() for x in ("hidden_top", "hidden_before", "change_score", "cluster", "cluster_before")]
    instability = F.greatest(_clip(F.abs(c("hidden_top") - c("hidden_before"))), _clip(c("change_score")), (c("cluster") != c("cluster_before")).cast("double"))
    return inputs.withColumns({
        "trend_break": trend,
        "volatility_acceleration": _clip((c("rv_short") / F.nullif(c("rv_long"), F.lit(0.0)) - 1) / VOLATILITY_FULL),
        "breadth_deterioration": _clip((BREADTH_ZERO - c("pct_above")) / BREADTH_RANGE),
        "correlation_fragility": F.greatest(c("corr_pct"), c("eig_pct"), 1 - c("rank_pct"), _clip((c("top3_share") - ABSORPTION_FLOOR) / ABSORPTION_RANGE)),
        "credit_stress": _score_of("credit_label", CREDIT_SCORES),
        "liquidity_stress": F.greatest(_score_of("volume_label", VOLUME_SCORES), _clip((c("volume_z") - VOLUME_FLOOR) / VOLUME_RANGE), c("gap_pct"), c("range_pct")),
        "macro_event": F.when(F.arrays_overlap("event_labels", F.array(*map(F.lit, MACRO_EVENTS))), 1.0).otherwise(0.0),
        "model_instability": F.when(known[0] & known[1] & known[2] & known[3] & known[4], instability),
    })


def scored(rows: DataFrame) -> DataFrame:
    """Adds missing (component names), coverage, score (null if any is missing), band and up to three drivers."""
    names = list(WEIGHTS)
    gone = F.array_join(F.array_compact(F.array(*(F.when(F.col(n).isNull(), F.lit(n)) for n in names))), ",")
    present = sum((F.when(F.col(n).isNotNull(), F.lit(w)).otherwise(0.0) for n, w in WEIGHTS.items()), F.lit(0.0))
    total = sum((F.col(n) * w for n, w in WEIGHTS.items()), F.lit(0.0)) / sum(WEIGHTS.values())
    out = rows.withColumn("missing", gone).withColumn("coverage", present / sum(WEIGHTS.values())).withColumn("score", _clip(total))
    band = F.when(F.col("score").isNull(), "insufficient_data")
    for name, top in BANDS:
        band = band.when(F.col("score") < top, name)
    ranked = F.array_sort(F.filter(F.array(*(F.struct((-F.col(n)).alias("by"), F.lit(k).alias("k"), F.lit(n).alias("name")) for k, n in enumerate(names))), lambda x: x["by"] <= -DRIVER))
    return out.withColumn("band", band.otherwise("high_transition_risk")).withColumn("drivers", F.array_join(F.transform(F.slice(ranked, 1, 3), lambda x: x["name"]), ","))


#: Components from which credit, correlation, events and the score count as stressed, and labels of stressed breadth.
LIMITS = {"credit": 0.70, "correlation": 0.70, "event": 1.0, "score": 0.35}
STRESSED_BREADTH, RISING_BREADTH = ("weak_breadth", "narrowing_breadth", "divergent_fragile"), ("recovery_breadth", "healthy_breadth")


def rule_flags(rows: DataFrame, cooldown: int = 5, limits: dict[str, float] = LIMITS) -> DataFrame:
    """Adds the flags of STATES, `cooldown` and `insufficient` to rows with components, score, the labels trend, character,
    volatility and breadth, close, sma50, bad_before (a bear market in the last sessions) and since (sessions since a switch)."""
    c = F.col
    over = {name: F.coalesce(c(column) >= limits[name], F.lit(False)) for name, column in (("credit", "credit_stress"), ("correlation", "correlation_fragility"), ("event", "macro_event"), ("score", "score"))}
    others = F.greatest(*(n for n in WEIGHTS if n != "macro_event"))
    crisis, weak = c("volatility") == "crisis_vol", c("breadth").isin(*STRESSED_BREADTH)
    flags = {
        "crisis": crisis,
        "bear_stress": (c("trend") == "bear") & c("volatility").isin("high_vol", "crisis_vol") & (weak | (c("breadth") == "unknown") | over["credit"]),
        "fragile_bull": (c("trend") == "bull") & ((c("breadth") == "divergent_fragile") | over["correlation"] | over["credit"]),
        "recovery_attempt": (c("character") == "recovery_attempt") | (c("bad_before").cast("boolean") & (c("close") > c("sma50")) & c("breadth").isin(*RISING_BREADTH)),
        "sideways_stress": (c("trend") == "sideways") & (c("volatility") == "high_vol") & weak,
        "event_watch": over["event"] & over["score"] & (c("macro_event") >= F.coalesce(others, F.lit(0.0))),
        "cooldown": c("since").isNotNull() & (c("since") <= cooldown) & ~crisis,
        "insufficient": F.array_contains(F.array("trend", "character", "volatility", "breadth"), F.lit("unknown")),
    }
    return rows.withColumns({name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()})


def state(rows: DataFrame) -> DataFrame:
    """Adds `state` from flags, then the band; `cooldown` turns stable into watch; and `rules`, the flags that are on."""
    chosen = F.when(F.lit(False), "")
    for flag, name in STATES:
        chosen = chosen.when(F.col(flag), name)
    chosen = chosen.when(F.col("cooldown") & (F.col("band") == "stable"), "watch").otherwise(F.col("band"))
    flags = [f for f, _ in STATES] + ["cooldown"]
    return rows.withColumn("state", chosen).withColumn("rules", F.array_join(F.array_compact(F.array(*(F.when(F.col(f), F.lit(f)) for f in flags))), ","))
