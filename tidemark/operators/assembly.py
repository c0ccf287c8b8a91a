"""From readings and labels to an axis: staleness by clock, forced labels, and the status of a classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators import folds, quality

#: Days of a reading that was never seen, and the quality states that force a label to unknown.
NEVER, FORCING = 10**9, ("insufficient_data", "insufficient_history", "stale_data")


def staleness(sessions: DataFrame, readings: DataFrame, clocks: dict[str, str]) -> DataFrame:
    """(session, pos, source, days): age of each source's last reading at each session.

    sessions: (session, pos); readings: (source, date, value), null values are none. A source of the
    clock `calendar` counts calendar days since its last date; one of `trading` counts sessions since
    the last session that is one of its dates. A reading never seen is NEVER days (and sessions) old.
    """
    names = F.array(*(F.lit(s) for s in clocks))
    clock = F.element_at(F.create_map(*(F.lit(x) for pair in clocks.items() for x in pair)), F.col("source"))
    seen = readings.where("value IS NOT NULL").select("source", F.col("date").alias("session"), F.lit(True).alias("read")).distinct()
    grid = sessions.select("session", "pos", F.explode(names).alias("source")).join(seen, ["source", "session"], "full")
    so_far = Window.partitionBy("source").orderBy("session").rowsBetween(Window.unboundedPreceding, 0)
    last_date = F.last(F.when(F.col("read"), F.col("session")), ignorenulls=True).over(so_far)
    last_pos = F.last(F.when(F.col("read"), F.col("pos")), ignorenulls=True).over(so_far)
    out = grid.select("session", "pos", "source", last_date.alias("date"), last_pos.alias("last")).where("pos IS NOT NULL")
    calendar = F.coalesce(F.datediff("session", "date"), F.lit(NEVER))
    days = F.when(clock == "calendar", calendar).when(clock == "trading", F.col("pos") - F.coalesce("last", F.lit(-NEVER)))
    return out.select("session", "pos", "source", days.cast("long").alias("days"))


def paired(pairs: list[tuple[str, str]]) -> Column:
    """The staleness of the better pair, a pair being as old as the older of its two columns."""
    ages = [F.greatest(a, b) for a, b in pairs]
    return F.least(*ages) if len(ages) > 1 else ages[0]


def assembled(rows: DataFrame, inputs: list[str], required: int, max_fresh: int, complete: float, ranks: dict, leave: dict, freeze: int = 0) -> DataFrame:
    """An axis from rows with a raw `label`: adds status, raw_label, stable_label, active_label, frozen.

    Quality first, then hysteresis over the raw labels; where quality forces it, the raw label is unknown,
    and the others too unless the last known label is still held.
    """
    out = folds.hysteresis(quality.assessed(rows, inputs, required, max_fresh, complete, F.col("label")), ranks, leave, freeze=freeze, status="status")
    forced = F.col("status").isin(*FORCING)
    kept = ~forced | F.col("frozen")
    return out.withColumns({"raw_label": F.when(forced, "unknown").otherwise(F.col("label")), **{c: F.when(kept, F.col(c)).otherwise("unknown") for c in ("stable_label", "active_label")}})


def classified(rows: DataFrame, features: list[str], not_binding: tuple[str, ...] = ()) -> DataFrame:
    """Adds classification and reason to an assembled axis: whether a label was given, and if not, why not.

    `features`: the inputs of the rules, whose nulls explain a missing label unless they bind none.
    """
    binding = sorted(f for f in features if f not in not_binding)
    gone = F.array_compact(F.array(*(F.when(F.col(f).isNull(), F.lit(f)) for f in binding)))
    held = (F.coalesce("raw_label", F.lit("unknown")) != "unknown") | (F.coalesce("stable_label", F.lit("unknown")) != "unknown")
    prefix = F.when(F.size(gone) == 1, "missing_rule_feature:").otherwise("missing_rule_features:")
    cases = [
        (F.col("status") == "stale_data", "stale_data", F.lit("stale_data")),
        (F.col("status") == "insufficient_history", "insufficient_history", F.lit("insufficient_history")),
        (F.col("status") == "insufficient_data", "data_unavailable", F.lit("insufficient_data")),
        (F.col("active_label") != "unknown", "classified", F.lit(None).cast("string")),
        (held, "no_rule_fired_hysteresis", F.lit("hysteresis_held_unknown")),
        (F.size(gone) > 0, "no_rule_fired_missing_feature", F.concat(prefix, F.array_join(gone, ","))),
    ]
    status, reason = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for when, name, why in cases:
        status, reason = status.when(when, name), reason.when(when, why)
    return rows.withColumns({"classification": status.otherwise("no_rule_fired"), "reason": reason.otherwise("no_rule_fired")})


def label_source(rows: DataFrame, own: tuple[str, ...], name: str = "constituents", other: str = "proxy") -> DataFrame:
    """Adds `source`: where an axis' active label comes from: held over by hysteresis, the rules over `name` (labels `own`), or those over `other`."""
    held = F.col("active_label") != F.col("raw_label")
    source = F.when(F.coalesce(F.col("frozen"), F.lit(False)), "data_quality_freeze").when(held, "hysteresis_from_prior_state").when(F.col("active_label").isin(*own), name).otherwise(other)
    return rows.withColumn("source", source)


def fresh(rows: DataFrame, limits: dict[str, tuple[str, int]]) -> DataFrame:
    """Nulls each column of `limits` (column: (its staleness, the most days)) where it is older, and adds `reason`, the names of those that are, joined."""
    stale = {c: F.coalesce(F.col(age) > most, F.lit(True)) for c, (age, most) in limits.items()}
    reason = F.concat_ws(",", *(F.when(old, F.lit(f"{c}_stale")) for c, old in stale.items()))
    return rows.withColumns({c: F.when(~old, F.col(c)) for c, old in stale.items()} | {"reason": reason})
