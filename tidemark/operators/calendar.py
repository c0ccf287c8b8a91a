"""Event calendars in sessions: windows around events, visible from their publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Labels of event types, sessions before and after, and the order of precedence.
LABELS = {"FOMC": "fed_week", "CPI": "cpi_week", "NFP": "nfp_week", "budget": "budget_week", "election": "election_window", "geopolitical_event": "geopolitical_event", "global_rate": "global_rate_decision", "global_rate_decision": "global_rate_decision", "ECB_decision": "global_rate_decision", "BOE_decision": "global_rate_decision", "BOJ_decision": "global_rate_decision"}
FIRST_TYPES, NEED_APPROVAL = ("FOMC", "CPI", "NFP"), "geopolitical_event"
WINDOWS = {"fed_week": (-2, 2), "cpi_week": (-1, 1), "nfp_week": (-1, 1), "budget_week": (0, 0), "election_window": (-5, 10), "geopolitical_event": (0, 0), "global_rate_decision": (0, 0)}
PRECEDENCE = ("geopolitical_event", "election_window", "fed_week", "global_rate_decision", "budget_week", "cpi_week", "nfp_week", "expiry_week", "earnings_season", "normal_calendar")
#: Types whose window that has just passed counts.
RELEASES = ("FOMC", "CPI", "NFP")


def _looked_up(values: dict, key: str):
    return F.element_at(F.create_map(*(F.lit(x) for pair in values.items() for x in pair)), F.col(key))


def normalised(events: DataFrame) -> DataFrame:
    """Known types with their label and window; a publication date where there is none: 90 days before, the date itself for unscheduled ones."""
    out = events.withColumn("label", _looked_up(LABELS, "type")).where("label IS NOT NULL")
    out = out.withColumn("before", _looked_up({k: v[0] for k, v in WINDOWS.items()}, "label")).withColumn("after", _looked_up({k: v[1] for k, v in WINDOWS.items()}, "label"))
    return out.withColumn("publication_date", F.coalesce("publication_date", F.when(F.col("type") == "geopolitical_event", F.col("date")).otherwise(F.date_sub("date", 90))))


def labelled(events: DataFrame, later_types: bool = True) -> DataFrame:
    """Events (type, approved_label, ...) with their `label`: types beyond the first ones only with `later_types`, and a geopolitical
    event only where it was approved as one. Other events go."""
    out = events.withColumn("label", _looked_up({k: v for k, v in LABELS.items() if later_types or k in FIRST_TYPES}, "type"))
    approved = (F.col("label") != NEED_APPROVAL) | F.coalesce(F.col("approved_label") == NEED_APPROVAL, F.lit(False))
    return out.where(F.col("label").isNotNull() & approved)


def candidate_id(type_: str, date: str, sources: str) -> Column:
    """An id that depends on the type, the date and the set of sources alone: 16 hex digits of a sha256, whatever their order and repeats."""
    names = F.array_join(F.array_sort(F.array_distinct(F.array_compact(sources))), "|")
    return F.substring(F.sha2(F.concat_ws("|", type_, F.col(date).cast("string"), names), 256), 1, 16)


def painted(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """(session, label) of every window that is on: an event on a session covers the sessions around it.

    The covered ordinals are generated, and joined to the calendar by equality.
    """
    at = events.join(sessions, F.col("date") == F.col("session")).select("label", "publication_date", F.explode(F.sequence(F.col("pos") + F.col("before"), F.col("pos") + F.col("after"))).alias("pos"))
    return at.join(sessions, "pos").where("session >= publication_date").select("session", "label").distinct()


def just_passed(events: DataFrame, sessions: DataFrame, trailing: int = 3) -> DataFrame:
    """Sessions 1 to `trailing` after the window of a release, published by then."""
    own = events.where(F.col("type").isin(*RELEASES)).join(sessions, F.col("date") == F.col("session"))
    at = own.select("publication_date", F.explode(F.sequence(F.col("pos") + F.col("after") + 1, F.col("pos") + F.col("after") + trailing)).alias("pos"))
    return at.join(sessions, "pos").where("session >= publication_date").select("session").distinct()


def expiry_weeks(sessions: DataFrame) -> DataFrame:
    """(session, label) of the two sessions before each month's third Friday and that day, or the session before it."""
    months = sessions.select(F.trunc("session", "MM").alias("month")).distinct()
    friday = F.date_add(F.next_day(F.date_sub("month", 1), "FRI"), 14)
    days = months.select(friday.alias("friday"))
    # A month has at most five sessions in the week up to its third Friday.
    spread = days.select("friday", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("k")).withColumn("session", F.expr("date_sub(friday, k)")).join(sessions, "session")
    last = spread.groupBy("friday").agg(F.max("pos").alias("p"))
    return last.select(F.explode(F.sequence(F.col("p") - 2, F.col("p"))).alias("pos")).join(sessions, "pos").select("session", F.lit("expiry_week").alias("label")).distinct()


def earnings_seasons(sessions: DataFrame) -> DataFrame:
    """(session, label) of the 35 days from the second Monday of January, April, July and October."""
    monday = F.date_add(F.next_day(F.date_sub(F.trunc("session", "quarter"), 1), "MON"), 7)
    last = F.date_add(F.next_day(F.date_sub(F.add_months(F.trunc("session", "quarter"), -3), 1), "MON"), 7)
    inside = lambda start: (F.col("session") >= start) & (F.col("session") <= F.date_add(start, 35))
    return sessions.where(inside(monday) | inside(last)).select("session", F.lit("earnings_season").alias("label"))


def labels(sessions: DataFrame, windows: DataFrame) -> DataFrame:
    """(session, label, matching): the first label by precedence, and all that are on in that order."""
    rank = F.array_position(F.array(*(F.lit(x) for x in PRECEDENCE)), F.col("label"))
    on = windows.groupBy("session").agg(F.array_sort(F.collect_set(F.struct(rank.alias("rank"), "label"))).alias("on"))
    out = sessions.join(on, "session", "left")
    names = F.transform("on", lambda x: x["label"])
    return out.select("session", F.coalesce(F.element_at(names, 1), F.lit("normal_calendar")).alias("label"), F.coalesce(F.array_join(names, ","), F.lit("normal_calendar")).alias("matching"))


def elections(years: DataFrame) -> DataFrame:
    """The Tuesday after the first Monday of November of each even year."""
    monday = F.next_day(F.make_date("year", F.lit(10), F.lit(31)), "MON")
    return years.where("year % 2 = 0").select("year", F.date_add(monday, 1).alias("election"))


def release_times(months: DataFrame, sessions: DataFrame, n: int, hour: int = 10, zone: str = "America/New_York") -> DataFrame:
    """For each month the n-th session of the next, at a local hour, as UTC."""
    order = Window.partitionBy(F.trunc("session", "MM")).orderBy("session")
    nth = sessions.withColumn("k", F.row_number().over(order)).where(F.col("k") == n).select(F.add_months(F.trunc("session", "MM"), -1).alias("month"), "session")
    return months.join(nth, "month").select("month", F.to_utc_timestamp(F.col("session").cast("timestamp") + F.expr(f"INTERVAL {hour} HOURS"), zone).alias("released"))


def triangulated(candidates: DataFrame, enough: int = 2) -> DataFrame:
    """Per (type, date): distinct sources, confirmations, contradictions, a decision and a stable id.

    verdict: confirm, contradict or anything else. A contradiction quarantines; enough sources
    and a confirmation promote; the rest is for review.
    """
    out = candidates.groupBy("type", "date").agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.count_if(F.col("verdict") == "confirm").alias("confirms"), F.count_if(F.col("verdict") == "contradict").alias("contradicts"),
    )
    decision = F.when(F.col("contradicts") > 0, "quarantined").when((F.size("sources") >= enough) & (F.col("confirms") > 0), "promoted").otherwise("review")
    return out.select("type", "date", F.size("sources").alias("n_sources"), "confirms", "contradicts", decision.alias("decision"), candidate_id("type", "date", "sources").alias("candidate_id"))


def candidates(events: DataFrame, least: float) -> DataFrame:
    """Events as candidates (event_id, date, type, bad): bad without a value of at least `least` or without a key in their properties."""
    bad = F.col("value").isNull() | (F.col("value") < least) | F.get_json_object("props", "$.k").isNull()
    return events.select("event_id", F.to_date("ts").alias("date"), F.col("event_type").alias("type"), bad.alias("bad"))


def quarantine_gate(rows: DataFrame, most: float = 0.01) -> DataFrame:
    """Per type: candidates, bad ones, and whether these are more than the share `most`."""
    out = rows.groupBy("type").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    return out.withColumn("fails", F.col("bad") > most * F.col("n"))


def candidate_report(rows: DataFrame) -> DataFrame:
    """Per type: candidates, quarantined (bad), promoted (the first good one of a date), and the others, for review."""
    order = Window.partitionBy("type", "date", "bad").orderBy("event_id")
    first = ~F.col("bad") & (F.row_number().over(order) == 1)
    out = rows.withColumn("_first", first).groupBy("type").agg(F.count("*").alias("candidates"), F.count_if("_first").alias("promoted"), F.count_if("bad").alias("quarantined"))
    return out.withColumn("review", F.col("candidates") - F.col("promoted") - F.col("quarantined"))
