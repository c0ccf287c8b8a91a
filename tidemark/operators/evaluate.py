"""Evaluation of label timelines: (series_id, session, pos, label)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.quality import runs

BY = ("series_id",)


def _order():
    return Window.partitionBy("series_id").orderBy("pos")


def distribution(rows: DataFrame, label: str = "label") -> DataFrame:
    """Sessions of each label, null included, and their share of the series."""
    counts = rows.groupBy("series_id", F.col(label).alias("label")).agg(F.count("*").alias("sessions"))
    return counts.withColumn("share", F.col("sessions") / F.sum("sessions").over(Window.partitionBy("series_id")))


def longest_runs(rows: DataFrame, label: str = "label") -> DataFrame:
    return runs(rows, label).groupBy("series_id", F.col(label).alias("label")).agg(F.max("length").alias("longest"))


def switched(label: str = "label") -> Column:
    before = F.lag(label).over(_order())
    return F.lag(F.lit(1)).over(_order()).isNotNull() & ~F.col(label).eqNullSafe(before)


def switches(rows: DataFrame, horizon: int = 3, label: str = "label") -> DataFrame:
    """Switches of each series, and the false ones: back at the label before within `horizon` sessions."""
    before, w = F.lag(label).over(_order()), _order()
    ahead = F.collect_list(label).over(w.rowsBetween(1, horizon))
    false = F.col("_s") & F.array_contains("_ahead", F.coalesce("_before", F.lit("")))
    out = rows.withColumn("_s", switched(label)).withColumn("_before", before).withColumn("_ahead", ahead)
    return out.groupBy("series_id").agg(F.count_if("_s").alias("switches"), F.count_if(false).alias("false_switches"))


def false_switch_rate(rows: DataFrame, exposure: str = "exposure", horizon: int = 3) -> DataFrame:
    """The share of a series' changes of exposure that are taken back within `horizon` sessions, 0 without a change."""
    out = switches(rows.withColumn("_exposure", F.col(exposure).cast("string")), horizon, "_exposure")
    return out.select("series_id", F.coalesce(F.col("false_switches") / F.nullif(F.col("switches"), F.lit(0)), F.lit(0.0)).alias("rate"))


def history(rows: DataFrame, label: str = "label", window: int = 5, reach: int = 60, bad: str = "bear") -> DataFrame:
    """Per session: changed, changes in the last `window`, sessions since the last change (null beyond `reach`), `bad` in the `reach` sessions before."""
    w = _order()
    out = rows.withColumn("changed", switched(label).cast("int"))
    since = F.col("pos") - F.last(F.when(F.col("changed") == 1, F.col("pos")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    recent = F.max(F.when(F.col(label) == bad, 1).otherwise(0)).over(w.rowsBetween(-reach, -1))
    return out.withColumns({"changes": F.sum("changed").over(w.rowsBetween(-(window - 1), 0)), "since": F.when(since <= reach, since), "bad_before": F.coalesce(recent, F.lit(0))})


def difference(a: DataFrame, b: DataFrame, label: str = "label") -> DataFrame:
    """Per series: common sessions, those that differ, sessions of one timeline only."""
    x, y = (d.select("series_id", "session", F.col(label).alias(c), F.lit(True).alias(f"in_{c}")) for d, c in ((a, "x"), (b, "y")))
    both = x.join(y, ["series_id", "session"], "full")
    common = F.col("in_x").isNotNull() & F.col("in_y").isNotNull()
    return both.groupBy("series_id").agg(F.count_if(common).alias("common"), F.count_if(common & ~F.col("x").eqNullSafe(F.col("y"))).alias("differ"), F.count_if(~common).alias("misaligned"))


def disagreements(a: DataFrame, b: DataFrame, label: str = "label", examples: int = 5) -> DataFrame:
    """The last sessions of each series on which two timelines differ."""
    both = a.select("series_id", "session", F.col(label).alias("before")).join(b.select("series_id", "session", F.col(label).alias("after")), ["series_id", "session"])
    w = Window.partitionBy("series_id").orderBy(F.desc("session"))
    return both.where(~F.col("before").eqNullSafe(F.col("after"))).withColumn("k", F.row_number().over(w)).where(F.col("k") <= examples).drop("k")


def nulls(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls and NaN of each column."""
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in columns))).alias("x"))
    return long.groupBy("x.field").agg(F.count("*").alias("rows"), F.count_if(F.col("x.value").isNull() | F.isnan("x.value")).alias("nulls"))


def summaries(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Per series and column: values that are not null, of how many rows, the first and last with their dates."""
    long = rows.select("series_id", "session", F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in columns))).alias("x"))
    known = F.when(F.col("x.value").isNotNull(), F.col("session"))
    return long.groupBy("series_id", "x.field").agg(F.count("*").alias("rows"), F.count("x.value").alias("known"), F.min(known).alias("first"), F.max(known).alias("last"), F.min_by("x.value", known).alias("first_value"), F.max_by("x.value", known).alias("last_value"))


def equity(rows: DataFrame, exposure: str = "exposure", ret: str = "ret") -> DataFrame:
    """Adds gain (yesterday's exposure times today's return) and equity, from 1."""
    gain = F.coalesce(F.lag(exposure).over(_order()) * F.col(ret), F.lit(0.0))
    out = rows.withColumn("gain", gain)
    return out.withColumn("equity", F.exp(F.sum(F.log1p("gain")).over(_order().rowsBetween(Window.unboundedPreceding, 0))))


def performance(rows: DataFrame) -> DataFrame:
    """Per series of equity(): total return, deepest drawdown from a peak of at least 1, yearly Sharpe ratio."""
    peak = F.greatest(F.lit(1.0), F.max("equity").over(_order().rowsBetween(Window.unboundedPreceding, 0)))
    out = rows.withColumn("fall", F.col("equity") / peak - 1)
    sharpe = F.when(F.stddev_samp("gain") > 0, F.avg("gain") / F.stddev_samp("gain") * F.lit(252.0**0.5)).otherwise(0.0)
    return out.groupBy("series_id").agg((F.max_by("equity", "pos") - 1).alias("total"), F.least(F.lit(0.0), F.min("fall")).alias("drawdown"), sharpe.alias("sharpe"))


def detection_lag(rows: DataFrame, windows: DataFrame, flat: Column) -> DataFrame:
    """Per window (name, start, end): sessions from its start to the first flat one; all of them if none is."""
    inside = rows.join(windows, (F.col("session") >= F.col("start")) & (F.col("session") <= F.col("end")))
    out = inside.withColumn("k", F.row_number().over(Window.partitionBy("series_id", "name").orderBy("pos")) - 1)
    return out.groupBy("series_id", "name").agg(F.coalesce(F.min(F.when(flat, F.col("k"))), F.count("*")).cast("long").alias("lag"), F.count_if(flat).alias("flat_sessions"))


def trades_avoided(rows: DataFrame, exposure: str = "exposure", ret: str = "ret") -> DataFrame:
    """(series_id, avoided): sessions that fell while the exposure decided the session before was none."""
    out = rows.withColumn("_held", F.lag(exposure).over(_order()))
    return out.groupBy("series_id").agg(F.count_if((F.col("_held") == 0) & (F.col(ret) < 0)).alias("avoided"))


#: Metrics of a strategy, whether more of it is better, and the name of winning by it.
GATE = {"drawdown": (True, "lower_drawdown"), "sharpe": (True, "higher_sharpe"), "lag": (False, "earlier_crisis_detection"), "switch_rate": (False, "lower_false_switch_rate")}


def metrics(rows: DataFrame, windows: DataFrame, exposure: str = "exposure", ret: str = "ret", horizon: int = 3) -> DataFrame:
    """(series_id, drawdown, sharpe, lag, switch_rate) of a strategy's exposure: of its equity, the mean sessions until it is flat in each of the
    windows (name, start, end; null where a series has none), and the share of changes that are taken back."""
    curve = performance(equity(rows, exposure, ret)).select("series_id", "drawdown", "sharpe")
    lag = detection_lag(rows, windows, F.col(exposure) == 0).groupBy("series_id").agg(F.avg("lag").alias("lag"))
    rate = false_switch_rate(rows, exposure, horizon).select("series_id", F.col("rate").alias("switch_rate"))
    return curve.join(lag, "series_id", "left").join(rate, "series_id", "left")


def promotion_gate(now: DataFrame, candidate: DataFrame) -> DataFrame:
    """(series_id, passed, winners): the metrics by which the candidate is strictly better; it passes with one. A null on either side wins nothing."""
    both = now.alias("n").join(candidate.alias("c"), "series_id")
    better = [F.when(F.col(f"c.{m}") > F.col(f"n.{m}") if more else F.col(f"c.{m}") < F.col(f"n.{m}"), F.lit(name)) for m, (more, name) in GATE.items()]
    winners = F.array_join(F.array_compact(F.array(*better)), ",")
    return both.select("series_id", (winners != "").alias("passed"), winners.alias("winners"))


def clean_window(sessions: DataFrame, recorded: DataFrame) -> DataFrame:
    """One row: the last sessions in a row that were all recorded as good, and the last bad one."""
    out = sessions.join(recorded.select("session", "good"), "session", "left").withColumn("bad", ~F.coalesce("good", F.lit(False)))
    return out.agg(F.max("pos").alias("_n"), F.max(F.when(F.col("bad"), F.col("pos"))).alias("_p"), F.max_by("session", F.when(F.col("bad"), F.col("pos"))).alias("last_bad")).select((F.col("_n") - F.coalesce("_p", F.lit(0))).cast("long").alias("clean"), "last_bad")


def red_flags(rows: DataFrame, label: str = "label", most: float = 0.6, unknown: int = 20, flips: int = 50) -> DataFrame:
    """(series_id, flag) for one label that dominates, a long unknown stretch, too many false switches."""
    parts = [
        distribution(rows, label).where(F.col("share") > most).select("series_id", F.lit("dominant_label").alias("flag")),
        longest_runs(rows, label).where((F.col("label") == "unknown") & (F.col("longest") > unknown)).select("series_id", F.lit("long_unknown").alias("flag")),
        switches(rows, 3, label).where(F.col("false_switches") > flips).select("series_id", F.lit("flip_flops").alias("flag")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def confusion(rows: DataFrame, truth: str, guess: str) -> DataFrame:
    """Per true class: rows, right ones, precision, recall and F1."""
    pairs = rows.groupBy(F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count("*").alias("n"))
    classes = pairs.select(F.explode(F.array("t", "g")).alias("c"), "t", "g", "n").distinct()
    out = classes.groupBy(F.col("c").alias("label")).agg(
        F.coalesce(F.sum(F.when((F.col("t") == F.col("c")) & (F.col("g") == F.col("c")), F.col("n"))), F.lit(0)).alias("right"),
        F.coalesce(F.sum(F.when(F.col("t") == F.col("c"), F.col("n"))), F.lit(0)).alias("of_class"), F.coalesce(F.sum(F.when(F.col("g") == F.col("c"), F.col("n"))), F.lit(0)).alias("guessed"),
    )
    p, r = F.col("right") / F.nullif(F.col("guessed"), F.lit(0)), F.col("right") / F.nullif(F.col("of_class"), F.lit(0))
    return out.select("label", "right", "of_class", "guessed", p.alias("precision"), r.alias("recall"), (2 * p * r / F.nullif(p + r, F.lit(0.0))).alias("f1"))
