"""Point-in-time alignment: what was known at each session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def grid(series: DataFrame, sessions: DataFrame) -> DataFrame:
    """Every session for every series: (series_id, session, pos).

    The ordinals are generated for each series and joined to the calendar by equality, so
    neither side is replicated as a whole.
    """
    n = sessions.agg(F.max("pos").alias("n"))
    ordinals = series.select("series_id").distinct().join(F.broadcast(n)).select("series_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("pos"))  # n: one row
    return ordinals.join(sessions, "pos").select("series_id", "session", "pos")


def exact(grid_rows: DataFrame, values: DataFrame) -> DataFrame:
    """Values on the grid; a session without one has nulls."""
    return grid_rows.join(values.drop("pos"), ["series_id", "session"], "left")


def as_of(sessions: DataFrame, readings: DataFrame, date: str, columns: list[str], by: list[str]) -> DataFrame:
    """For each row of `sessions` the latest reading with `date` <= session, of the same `by` keys.

    Both sides go through one sort by (keys, date): no join, no range condition, no skew but
    that of the keys. Columns: those of `sessions` and, null where nothing was known, `columns`.
    """
    left = sessions.select(*sessions.columns, F.col("session").alias("_at"), F.lit(1).alias("_row"), *(F.lit(None).alias(f"_{c}") for c in columns))
    kinds = {f.name: f.dataType for f in readings.schema.fields}
    left = left.withColumns({f"_{c}": F.lit(None).cast(kinds[c]) for c in columns})
    right = readings.select(*by, F.col(date).alias("_at"), F.lit(0).alias("_row"), *(F.col(c).alias(f"_{c}") for c in columns))
    w = Window.partitionBy(*by).orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.last(F.when(F.col("_row") == 0, F.struct(*(F.col(f"_{c}").alias(c) for c in columns))), ignorenulls=True).over(w)
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_known", latest)
    return both.where("_row = 1").select(*sessions.columns, *(F.col("_known")[c].alias(c) for c in columns))


def first_release(vintages: DataFrame) -> DataFrame:
    """The earliest vintage of each reference date, then of one release date the latest reference date."""
    one = Window.partitionBy("series_id", "obs_date").orderBy("published", "vintage")
    two = Window.partitionBy("series_id", "published").orderBy(F.desc("obs_date"))
    firsts = vintages.withColumn("_k", F.row_number().over(one)).where("_k = 1")
    return firsts.withColumn("_k", F.row_number().over(two)).where("_k = 1").drop("_k")


def latest_revision(vintages: DataFrame) -> DataFrame:
    """The last vintage of each reference date."""
    w = Window.partitionBy("series_id", "obs_date").orderBy(F.desc("published"), F.desc("vintage"))
    return vintages.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def splice(*sources: str):
    """The first of several columns that is not null."""
    return F.coalesce(*(F.col(c) for c in sources))


def recent(rows: DataFrame, n: int) -> DataFrame:
    """The last n rows of each series, by `pos`."""
    ends = rows.groupBy("series_id").agg(F.max("pos").alias("_end"))
    return rows.join(ends, "series_id").where(F.col("pos") > F.col("_end") - n).drop("_end")


def members_on(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows whose series is a member at their session: start <= session <= end, an open end without limit.

    An equality join by series carries the range condition; overlapping intervals count once.
    """
    i = intervals.select(F.col("series_id").alias("_id"), "start", "end")
    inside = (F.col("series_id") == F.col("_id")) & (F.col("session") >= F.col("start")) & (F.col("end").isNull() | (F.col("session") <= F.col("end")))
    return rows.join(i, inside, "left_semi")


def corrected_ends(intervals: DataFrame, corrections: DataFrame) -> DataFrame:
    """Open intervals with the end that `corrections` (series_id, corrected) gives."""
    return intervals.join(corrections, "series_id", "left").withColumn("end", F.coalesce("end", "corrected")).drop("corrected")


def survivorship_biased(intervals: DataFrame) -> DataFrame:
    """One row: whether no interval has ended, so that the universe holds survivors only."""
    return intervals.agg(F.count("*").alias("intervals"), F.count("end").alias("ended"), (F.count("end") == 0).alias("biased"))


def fallback(primary: DataFrame, other: DataFrame) -> DataFrame:
    """`primary` and, of series that it lacks altogether, the rows of `other`."""
    return primary.unionByName(other.join(primary.select("series_id").distinct(), "series_id", "left_anti"))


def near(rows: DataFrame, others: DataFrame, days: int, by: str = "type", date: str = "date") -> DataFrame:
    """Rows with another's date of the same kind at most `days` away: dates are spread, then joined by equality."""
    spread = others.select(by, F.explode(F.expr(f"transform(sequence(-{days}, {days}), k -> date_add({date}, k))")).alias(date)).distinct()
    return rows.join(spread, [by, date], "left_semi")


def neighbours(dates: DataFrame, sessions: DataFrame, date: str = "date") -> DataFrame:
    """The previous and the next session of each distinct date, strictly before and after."""
    both = dates.select(F.col(date).alias("at"), F.lit(None).cast("date").alias("session")).distinct().union(sessions.select(F.col("session").alias("at"), "session"))
    before = Window.partitionBy(F.lit(0)).orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(F.lit(0)).orderBy("at").rangeBetween(1, Window.unboundedFollowing)
    day = both.withColumn("at", F.datediff("at", F.lit("1970-01-01")))
    out = day.withColumn("previous", F.max("session").over(before)).withColumn("next", F.min("session").over(after))
    return out.where("session IS NULL").select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("at")).alias(date), "previous", "next")


def strict_lookup(wanted: DataFrame, values: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with values, misses): the misses as one row, their number and first five (null if there are none)."""
    gone = wanted.join(values, keys, "left_anti")
    listed = F.when(F.count("k") > 0, F.array_join(F.array_sort(F.collect_list("k")), ","))
    first = gone.select(F.concat_ws("|", *keys).alias("k")).distinct().orderBy("k").limit(5).agg(listed.alias("first_misses"))
    return wanted.join(values, keys), gone.agg(F.count("*").alias("misses")).join(first)  # one row each
