"""Strategy constraints from states and labels: routing to cohorts, family tables, effective constraints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A cohort, the columns of which any must hold a value of a set, and those that all must.
ROUTES = (
    ("risk_off", [("trend", ("bear",)), ("volatility", ("high_vol",))], []),
    ("range_trading", [("character", ("range_bound", "chop"))], [("volatility", ("low_vol", "normal_vol"))]),
    ("trend_following", [], [("trend", ("bull",)), ("volatility", ("low_vol", "normal_vol"))]),
)


def routed(rows: DataFrame, axes: list[str], routes: tuple = ROUTES, crisis: str = "state = 'crisis'", default: str = "balanced") -> DataFrame:
    """Adds `cohort`: crisis, then outage (any axis unknown), then the first route that holds, then the default."""
    chosen = F.when(F.expr(crisis), "crisis").when(F.expr(" OR ".join(f"coalesce({a}, 'unknown') = 'unknown'" for a in axes)), "outage")
    for name, some, every in routes:
        parts = [f"({' OR '.join(_in(*s) for s in some)})"] * bool(some) + [_in(*e) for e in every]
        chosen = chosen.when(F.expr(" AND ".join(parts)), name)
    return rows.withColumn("cohort", chosen.otherwise(default))


def _in(column: str, values: tuple[str, ...]) -> str:
    return f"coalesce({column} IN ({', '.join(repr(v) for v in values)}), false)"


def family_constraints(cohorts: DataFrame, defaults: DataFrame, overrides: DataFrame) -> DataFrame:
    """(cohort, family, allowed, cap, reason): the family's default with the override's fields; a family allowed again has no reason."""
    names = cohorts.agg(F.collect_set("cohort").alias("cohort"))  # one row, with the cohorts of the rule table
    base = defaults.join(F.broadcast(names)).withColumn("cohort", F.explode("cohort"))
    o = overrides.select("cohort", "family", F.col("allowed").alias("o_allowed"), F.col("cap").alias("o_cap"), F.col("reason").alias("o_reason"))
    out = base.join(o, ["cohort", "family"], "left")
    allowed = F.coalesce("o_allowed", "allowed")
    return out.select("cohort", "family", allowed.alias("allowed"), F.coalesce("o_cap", "cap").alias("cap"), F.when(~allowed, F.coalesce("o_reason", "reason")).alias("reason"))


def effective(rows: DataFrame, families: DataFrame, events: DataFrame) -> DataFrame:
    """Per session and family the most restrictive of the cohort's constraint and the event's cap, with its sources."""
    own = rows.join(families, "cohort").select("session", "family", "allowed", "cap", F.lit("cohort").alias("source"))
    more = events.join(families.select("family").distinct()).select("session", "family", "allowed", "cap", F.lit("event").alias("source")) if events is not None else None
    both = own.unionByName(more) if more is not None else own
    return both.groupBy("session", "family").agg(F.bool_and("allowed").alias("allowed"), F.min("cap").alias("cap"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


#: A response's fields and what they are without a rule; what an unknown label or state makes of them;
#: the rules in order, each with its condition, the fields that it sets, and a cap of the size.
FIELDS = {
    "size": 1.0, "trend_following": True, "mean_reversion": True, "leverage": True, "buy_dip": True, "breakout": True, "shorts": True, "confirm_longs": False, "confirm_shorts": False, "review": False,
    "hard_loss": None, "block_weak": None, "cash_or_hedges": None, "faster_profit": None, "expand_leverage": None, "confirm_breadth": None,
}
UNKNOWN = {"size": 0.75, "leverage": False, "confirm_longs": True, "confirm_shorts": True, "review": True}
RESPONSES = (
    ("bull_healthy_low_vol", "trend = 'bull' AND character IN ('trending', 'transition') AND volatility IN ('low_vol', 'normal_vol') AND breadth = 'healthy_breadth'", {"size": 1.0, "trend_following": True, "buy_dip": True, "expand_leverage": True}, None),
    ("recovery_attempt", "state = 'recovery_attempt'", {"size": 0.5, "trend_following": True, "buy_dip": True, "leverage": False, "confirm_breadth": True, "expand_leverage": False}, None),
    ("sideways_chop", "character = 'chop' AND volatility <> 'crisis_vol'", {"size": 0.75, "trend_following": False, "mean_reversion": True, "faster_profit": True}, None),
    ("bull_fragile", "state = 'fragile_bull'", {"size": 0.5, "buy_dip": False, "expand_leverage": False, "confirm_longs": True}, None),
    ("transition_weakening", "state = 'weakening'", {"expand_leverage": False, "confirm_longs": True}, 0.75),
    ("transition_warning", "state = 'transition_warning'", {"expand_leverage": False, "confirm_longs": True, "faster_profit": True}, 0.75),
    ("high_transition_risk", "state = 'high_transition_risk'", {"leverage": False, "buy_dip": False, "expand_leverage": False, "confirm_longs": True, "cash_or_hedges": True}, 0.5),
    ("sideways_stress", "state = 'watch'", {"size": 0.5, "breakout": False, "expand_leverage": False, "faster_profit": True, "confirm_longs": True}, None),
    ("bear_stress", "state = 'bear_stress'", {"size": 0.5, "buy_dip": False, "leverage": False, "confirm_shorts": True}, None),
    ("crisis", "state = 'crisis'", {"size": 0.25, "leverage": False, "hard_loss": True, "block_weak": True, "cash_or_hedges": True, "buy_dip": False}, None),
)


def _typed(value: object) -> Column:
    return F.lit(value) if value is not None else F.lit(None).cast("boolean")


def _applied(rows: DataFrame, rules: list[tuple[str, Column, dict, float | None]]) -> DataFrame:
    """Applies rules in order over the fields of `rows`; the names of those that hold are appended to `modifiers`."""
    fields = {f: F.col(f) for f in FIELDS if f in rows.columns}
    names = []
    for name, holds, sets, cap in rules:
        holds = F.coalesce(holds, F.lit(False))
        for field, value in sets.items():
            fields[field] = F.when(holds, _typed(value)).otherwise(fields[field])
        if cap is not None:
            fields["size"] = F.when(holds, F.least(fields["size"], F.lit(cap))).otherwise(fields["size"])
        names.append(F.when(holds, F.lit(name)))
    return rows.withColumns(fields | {"modifiers": F.concat(F.col("modifiers"), F.array_compact(F.array(*names)))})


def response(rows: DataFrame) -> DataFrame:
    """Adds FIELDS, modifiers and reason to rows with trend, character, volatility, breadth and state."""
    gone = F.expr("state = 'insufficient_data' OR array_contains(array(trend, character, volatility, breadth), 'unknown')")
    gone = F.coalesce(gone, F.lit(True)) | F.expr("trend IS NULL OR character IS NULL OR volatility IS NULL OR breadth IS NULL")
    start = {f: F.when(gone, _typed(UNKNOWN.get(f, v))).otherwise(_typed(v)) for f, v in FIELDS.items()}
    reason = F.when(gone, "unknown_or_unmapped_regime")
    out = rows.withColumns(start | {"modifiers": F.array().cast("array<string>"), "reason": reason})
    return _applied(out, [(name, ~gone & F.expr(when), sets, cap) for name, when, sets, cap in RESPONSES])


def event_modified(rows: DataFrame, rules: list[tuple[str, tuple[str, ...], dict, float | None]], labels: str = "events") -> DataFrame:
    """Applies event rules (name, labels of which one must be on, fields, cap of the size) in order, after response()."""
    return _applied(rows, [(name, F.arrays_overlap(F.col(labels), F.array(*(F.lit(x) for x in on))), sets, cap) for name, on, sets, cap in rules])
