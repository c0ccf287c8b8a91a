"""Contracts of tables, as jobs that return violations, and merges by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def bar_contract(bars: DataFrame, sessions: DataFrame, anchor: str, as_of) -> DataFrame:
    """One row of counts: rows, null dates, dates that are no sessions, anchor rows on `as_of`."""
    checked = bars.join(sessions.select("session", F.lit(True).alias("_is")), "session", "left")
    return checked.agg(
        F.count("*").alias("rows"), F.count_if(F.col("session").isNull()).alias("null_dates"), F.count_if(F.col("session").isNotNull() & F.col("_is").isNull()).alias("off_calendar"),
        F.count_if((F.col("series_id") == anchor) & (F.col("session") == as_of)).alias("anchor_rows"),
    )


def series_contract(bars: DataFrame) -> DataFrame:
    """Rows, null dates and null closes of each series."""
    return bars.groupBy("series_id").agg(F.count("*").alias("rows"), F.count_if(F.col("session").isNull()).alias("null_dates"), F.count_if(F.col("close").isNull()).alias("null_closes"))


def partition_agreement(rows: DataFrame, partition: str, symbol: str) -> DataFrame:
    """Whether each partition holds exactly one symbol, its own, and no null."""
    out = rows.groupBy(F.col(partition).alias("partition")).agg(F.count_distinct(symbol).alias("symbols"), F.count_if(F.col(symbol).isNull()).alias("nulls"), F.min(symbol).alias("_one"))
    return out.select("partition", "symbols", "nulls", ((F.col("symbols") == 1) & (F.col("nulls") == 0) & (F.col("_one") == F.col("partition"))).alias("agrees"))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def gaps(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions between a series' first and last date on which it has no bar."""
    spans = bars.join(sessions, "session").groupBy("series_id").agg(F.min(sessions["pos"]).alias("a"), F.max(sessions["pos"]).alias("b"))
    expected = spans.select("series_id", F.explode(F.sequence("a", "b")).alias("pos")).join(sessions, "pos")
    return expected.join(bars.select("series_id", "session"), ["series_id", "session"], "left_anti").select("series_id", "session")


def gap_summary(bars: DataFrame, sessions: DataFrame, examples: int = 5) -> DataFrame:
    """The number of gaps of each series and the first few; no more of them are collected."""
    found = gaps(bars, sessions).withColumn("_k", F.row_number().over(Window.partitionBy("series_id").orderBy("session")))
    first = F.array_join(F.array_sort(F.collect_list(F.when(F.col("_k") <= examples, F.col("session").cast("string")))), ",")
    return found.groupBy("series_id").agg(F.count("*").alias("gaps"), first.alias("first_gaps"))


def expected_sessions(intervals: DataFrame, sessions: DataFrame) -> DataFrame:
    """Sessions that each series should have: start <= session < end (an open end without limit).

    Dates of bounds become ordinals by an as-of count, so the sessions are generated, not compared.
    """
    days = sessions.select("session", "pos")
    bounds = intervals.select("series_id", "start", "end")
    last = days.agg(F.max("pos").alias("n"))
    low = bounds.join(days, F.col("session") < F.col("start"), "left").groupBy("series_id", "start", "end").agg(F.count("session").alias("a"))
    both = low.join(days, F.col("session") < F.col("end"), "left").groupBy("series_id", "start", "end", "a").agg(F.count("session").alias("b")).join(F.broadcast(last))
    upto = F.when(F.col("end").isNull(), F.col("n")).otherwise(F.col("b"))
    return both.withColumn("n_sessions", upto - F.col("a")).groupBy("series_id").agg(F.sum(F.greatest(F.lit(0), "n_sessions")).cast("long").alias("sessions"))


def inventory(rows: DataFrame, by: str = "series_id", date: str = "session") -> DataFrame:
    """Rows, first and last date of each series: what a written tree should declare."""
    return rows.groupBy(by).agg(F.count("*").alias("rows"), F.min(date).alias("first"), F.max(date).alias("last"))


def inventory_mismatch(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """Series whose declared rows, first or last date differ from the actual ones, or that one side lacks."""
    a, b = declared.alias("a"), actual.alias("b")
    same = F.col("a.rows").eqNullSafe(F.col("b.rows")) & F.col("a.first").eqNullSafe(F.col("b.first")) & F.col("a.last").eqNullSafe(F.col("b.last"))
    return a.join(b, F.col("a.series_id") == F.col("b.series_id"), "full").where(~same).select(F.coalesce("a.series_id", "b.series_id").alias("series_id"), F.col("a.rows").alias("declared"), F.col("b.rows").alias("actual"))


def content_identity(df: DataFrame) -> DataFrame:
    """Order-insensitive identity of a table: rows, sum and xor of row hashes."""
    h = F.xxhash64(*df.columns)
    return df.agg(F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("sum"), F.bit_xor(h).alias("xor"))


def overlapping(intervals: DataFrame, start, end) -> DataFrame:
    """Distinct series with an interval that overlaps [start, end]."""
    return intervals.where((F.col("start") <= F.lit(end)) & (F.col("end").isNull() | (F.col("end") >= F.lit(start)))).select("series_id").distinct()


def missing(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(present.select(key), key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows by key, those of `new` before those of `old`."""
    both = old.withColumn("_turn", F.lit(0)).unionByName(new.withColumn("_turn", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.desc("_turn"))
    return both.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k", "_turn")


def common_end(bars: DataFrame) -> DataFrame:
    """Bars up to the earliest of the series' last dates."""
    end = bars.groupBy("series_id").agg(F.max("session").alias("e")).agg(F.min("e").alias("_end"))
    return bars.join(F.broadcast(end)).where("session <= _end").drop("_end")  # one row


def quarantined(rows: DataFrame, bad, most: float = 0.01) -> DataFrame:
    """One row: bad rows, their share, whether it is above `most`."""
    return rows.agg(F.count("*").alias("rows"), F.count_if(bad).alias("bad"), (F.avg(F.when(bad, 1.0).otherwise(0.0)) > most).alias("fails"))


def backfill(live: DataFrame, history: DataFrame, key: str, order: str) -> DataFrame:
    """`live` and, where it has no row of a key, the last of `history`."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    kept = history.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")
    return live.unionByName(kept.join(live.select(key), key, "left_anti"))
