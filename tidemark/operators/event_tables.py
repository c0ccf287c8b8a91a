"""Event candidates against documents, approvals and decisions, and tables whose headers vary.

Documents and overrides are reduced to one row for each key and date before any join, with partial
aggregates, so neither a date nor a type that holds most rows meets in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Issuers of decisions by event type, words of a decision's document, and words that rule one out.
ISSUERS = {"ECB_decision": ("european central bank", "ecb"), "BOE_decision": ("bank of england", "boe"), "BOJ_decision": ("bank of japan", "boj")}
DECISION_TERMS = ("decision", "monetary policy summary", "statement", "minutes")
OTHER_TERMS = ("speech", "interview", "remarks", "testimony")
#: Default theme of a volume table, aliases of its columns and of an index table's.
THEME = "geopolitical volume spike"
VOLUME_COLUMNS = {"date": ("date",), "event_count": ("event_count", "count"), "dominant_theme": ("dominant_theme",), "source_url": ("source_url",)}
INDEX_COLUMNS = {
    "date": ("date", "day"), "value": ("gpr", "gprd", "gpr_daily"), "act": ("gpr_act", "gprd_act"), "threat": ("gpr_threat", "gprd_threat"), "ma7": ("gpr_ma7", "gprd_ma7"),
    "ma30": ("gpr_ma30", "gprd_ma30"), "article_count": ("n10d", "article_count", "articles"), "event": ("event",),
}


def _any(text: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(t)) for t in terms), F.lit(False))


def decision_documents(documents: DataFrame, issuers: dict[str, tuple[str, ...]] = ISSUERS, yes: tuple[str, ...] = DECISION_TERMS, no: tuple[str, ...] = OTHER_TERMS) -> DataFrame:
    """(type, date, evidence): for each event type and date the first decision document, by id, of an issuer of that type.

    documents: (id, issuer, kind, title, date). Terms are found anywhere, in lower case; a null counts as empty, a null date as none.
    """
    kind = F.lower(F.concat_ws(" ", F.coalesce("kind", F.lit("")), F.coalesce("title", F.lit(""))))
    issuer = F.lower(F.coalesce("issuer", F.lit("")))
    kept = documents.where(F.col("date").isNotNull() & _any(kind, yes) & ~_any(kind, no))
    types = F.array_compact(F.array(*(F.when(_any(issuer, terms), F.lit(name)) for name, terms in issuers.items())))
    each = kept.select(F.explode(types).alias("type"), "date", F.struct("id", "title").alias("evidence"))
    return each.groupBy("type", "date").agg(F.min("evidence").alias("evidence"))


def corroborated(candidates: DataFrame, decisions: DataFrame, window: int = 1, types: tuple[str, ...] = tuple(ISSUERS)) -> DataFrame:
    """Candidates (type, date, ...) of the given types with `verdict` and the document behind it, evidence_id and evidence_title.

    A decision document of the same day confirms; one within `window` days contradicts (the first by id); else unknown. The days of
    a window are generated and joined by equality; of each (type, date) there is one document.
    """
    keys = candidates.where(F.col("type").isin(*types)).select("type", "date").distinct()
    near = keys.withColumn("day", F.explode(F.sequence(F.date_sub("date", window), F.date_add("date", window))))
    met = near.join(decisions.withColumnRenamed("date", "day"), ["type", "day"])
    rank = F.struct((F.col("day") == F.col("date")).alias("same"), (-F.col("evidence.id")).alias("first"))
    best = met.groupBy("type", "date").agg(F.max_by(F.struct("evidence", (F.col("day") == F.col("date")).alias("same")), rank).alias("b"))
    out = candidates.where(F.col("type").isin(*types)).join(best, ["type", "date"], "left")
    verdict = F.when(F.col("b.same"), "confirm").when(F.col("b").isNotNull(), "contradict").otherwise("unknown")
    return out.withColumns({"verdict": verdict, "evidence_id": F.col("b.evidence.id"), "evidence_title": F.col("b.evidence.title")}).drop("b")


def latest_by(rows: DataFrame, keys: list[str], at: str, tie: str) -> DataFrame:
    """One row for each key: the last by `at`, of several the one with the largest `tie`; a null time comes first."""
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(at).isNotNull(), at, tie)).alias("_last"))
    return last.select(*keys, *(F.col(f"_last.`{c}`").alias(c) for c in rest))


def promoted(candidates: DataFrame, decisions: DataFrame, approvals: DataFrame) -> DataFrame:
    """The events that stand: a candidate whose last decision is to promote it, with what its last approval overrides.

    candidates: (type, date, id, at, market, importance, source, window_days, release); decisions: (type, date, id, at, outcome); approvals:
    (type, date, id, at, importance, window_days, label). Of each key the last row by `at` supersedes the others. An approval's value
    overrides the candidate's unless it is null (or an empty importance). A release is local time, midnight of the date where
    there is none. The columns *_from say where importance and window come from.
    """
    keys = ["type", "date"]
    decided = latest_by(decisions, keys, "at", "id").where("outcome = 'promote'").select(*keys)
    own = latest_by(candidates, keys, "at", "id").join(decided, keys)
    given = latest_by(approvals, keys, "at", "id").select(*keys, F.nullif(F.col("importance"), F.lit("")).alias("_importance"), F.col("window_days").alias("_window"), F.col("label").alias("approved_label"))
    out = own.join(given, keys, "left")
    source = lambda c: F.when(F.col(c).isNotNull(), "approval").otherwise("candidate")
    return out.select(
        *keys, F.coalesce("release", F.col("date").cast("timestamp_ntz")).alias("release"), "market", F.coalesce("_importance", "importance").alias("importance"), "source",
        F.coalesce("_window", "window_days").alias("window_days"), "approved_label", source("_importance").alias("importance_from"), source("_window").alias("window_from"),
    )


def resolved(raw: DataFrame, columns: dict[str, tuple[str, ...]], required: tuple[str, ...]) -> DataFrame:
    """The columns of a table under the names that `columns` gives them, out: its aliases in order.

    Headers count without case and outer blanks; of doubled headers the last counts. A required column that is missing is an
    error that names it, another one is null.
    """
    plain = raw.toDF(*(f"c{k}" for k in range(len(raw.columns))))
    at = {name.strip().lower(): f"c{k}" for k, name in enumerate(raw.columns)}
    found = {out: next((at[a] for a in aliases if a in at), None) for out, aliases in columns.items()}
    if gone := [out for out in required if found[out] is None]:
        raise ValueError(f"the table has no column for {', '.join(gone)}; it has {', '.join(raw.columns)}")
    return plain.select(*(F.col(c).cast("string").alias(out) if c else F.lit(None).cast("string").alias(out) for out, c in found.items()))


def typed(rows: DataFrame, types: dict[str, str]) -> DataFrame:
    """Text columns of `rows` as the given types, null where a cell is no such value, and `bad`: the names of those columns, in order."""
    cast = {c: F.trim(c).try_cast(t) for c, t in types.items()}
    bad = F.array_compact(F.array(*(F.when(F.col(c).isNotNull() & (F.trim(c) != "") & cast[c].isNull(), F.lit(c)) for c in types)))
    return rows.withColumn("bad", bad).withColumns(cast)


def index_table(raw: DataFrame) -> DataFrame:
    """A daily index from a table with any of the known headers: INDEX_COLUMNS typed, a null event as empty text; rows without a value go."""
    numbers = {c: "double" for c in INDEX_COLUMNS if c not in ("date", "event")}
    rows = typed(resolved(raw, INDEX_COLUMNS, ("date", "value")), {"date": "date"} | numbers)
    return rows.withColumn("event", F.coalesce("event", F.lit(""))).where("value IS NOT NULL AND NOT isnan(value)")


def volume_table(raw: DataFrame) -> DataFrame:
    """Days with a positive count from a table with any of the known headers; without a theme column every theme is THEME."""
    has_theme = any(name.strip().lower() == "dominant_theme" for name in raw.columns)
    rows = typed(resolved(raw, VOLUME_COLUMNS, ("date", "event_count")), {"date": "date", "event_count": "long"})
    rows = rows if has_theme else rows.withColumn("dominant_theme", F.lit(THEME))
    return rows.where("event_count > 0")


def prefixed_long(raw: DataFrame, prefix: str, key: dict[str, tuple[str, ...]], order: str | None = None) -> DataFrame:
    """(month, place, code, value) for every positive cell of the columns that begin with `prefix`, in any case.

    key: the column of the month and its aliases. Of several rows of a month the last by `order` counts (by content without one). `place` is the
    column's number from the left; a table without such columns is an error.
    """
    names = [(k, c) for k, c in enumerate(raw.columns) if c.strip().upper().startswith(prefix.upper())]
    if not names:
        raise ValueError(f"the table has no column that begins with {prefix}")
    cells = F.array(*(F.struct(F.lit(k).alias("place"), F.lit(c.strip().upper()[len(prefix) :]).alias("code"), F.col(f"`{c}`").cast("string").try_cast("double").alias("value")) for k, c in names))
    month = F.trunc(F.coalesce(*(F.col(f"`{c}`").cast("string").try_cast("date") for c in raw.columns if c.strip().lower() in next(iter(key.values())))), "MM")
    rows = raw.select(month.alias("month"), cells.alias("cells"), (F.col(f"`{order}`") if order else F.lit(0)).alias("_at")).where("month IS NOT NULL")
    last = rows.groupBy("month").agg(F.max_by("cells", F.struct("_at", "cells")).alias("cells"))
    return last.select("month", F.explode("cells").alias("c")).select("month", "c.place", "c.code", "c.value").where("value > 0")


def monthly_context(dates: DataFrame, long: DataFrame, n: int = 3, name: str = "monthly_country_gpr") -> DataFrame:
    """(date, context) for dates whose month has a positive cell: 'name=CODE:value,...' of its n largest, columns further left first among equals."""
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("less"), "place", "code", "value"))), 1, n)
    top = long.groupBy("month").agg(ranked.alias("top"))
    text = F.concat(F.lit(f"{name}="), F.array_join(F.transform("top", lambda x: F.format_string("%s:%.2f", x["code"], x["value"])), ","))
    asked = dates.select("date").distinct().withColumn("month", F.trunc("date", "MM"))
    return asked.join(top.select("month", text.alias("context")), "month").select("date", "context")
