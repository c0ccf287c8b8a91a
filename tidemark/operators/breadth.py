"""Breadth over the members of a universe, session by session.

One shuffle by series for the windows, one by session for the aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rolling as R
from tidemark.operators.align import exact, grid, members_on


def member_features(bars: DataFrame, sessions: DataFrame, sma: int, span: int) -> DataFrame:
    """What each series shows at each session of the grid: absent bars are nulls before any lag."""
    rows = exact(grid(bars, sessions), bars.select("series_id", "session", "close", "volume"))
    close, change = F.col("close"), F.col("change")
    rows = rows.withColumn("change", close - R.lag(close, 1)).withColumn("sma", R.sma(close, sma))
    return rows.withColumn("top", R.full(F.max("close"), close, span, least=max(2, span // 2))).withColumn("bottom", R.full(F.min("close"), close, span, least=max(2, span // 2))).withColumn("up", change > 0).withColumn("down", change < 0)


def breadth(bars: DataFrame, sessions: DataFrame, intervals: DataFrame, sma: int = 50, span: int = 252, thrust: int = 10) -> DataFrame:
    """Per session: share above the average, advances less declines and their line, highs over lows, up volume, thrust."""
    inside = members_on(member_features(bars, sessions, sma, span), intervals)
    day = inside.groupBy("session", "pos").agg(
        F.count("close").alias("present"), F.avg(F.when(F.col("sma").isNotNull() & F.col("close").isNotNull(), F.when(F.col("close") > F.col("sma"), 1.0).otherwise(0.0))).alias("pct_above"),
        F.count_if("up").alias("advances"), F.count_if("down").alias("declines"), F.count_if(F.col("change") == 0).alias("unchanged"),
        F.count_if(F.col("close") == F.col("top")).alias("highs"), F.count_if(F.col("close") == F.col("bottom")).alias("lows"), F.count("top").alias("spans"),
        F.sum(F.when(F.col("up"), F.col("volume")).otherwise(0)).alias("up_volume"), F.sum(F.when(F.col("down"), F.col("volume")).otherwise(0)).alias("down_volume"),
    )
    # One row a session: a market-level table of a few thousand rows, the only unpartitioned window.
    order = Window.orderBy("pos")
    net = F.col("advances") - F.col("declines")
    line = F.sum(F.when(F.col("pos") == 1, 0).otherwise(net)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    moved = F.greatest(F.col("advances") + F.col("declines") + F.col("unchanged"), F.lit(1))
    share = F.avg(F.col("advances") / moved).over(order.rowsBetween(-(thrust - 1), 0))
    return day.select(
        "session", "present", "pct_above", "advances", "declines", line.alias("ad_line"),
        F.when(F.col("spans") > 0, F.col("highs") / F.greatest(F.col("highs") + F.col("lows"), F.lit(1))).alias("high_low"),
        (F.col("up_volume") / F.nullif(F.col("up_volume") + F.col("down_volume"), F.lit(0))).alias("up_share"),
        F.when(F.count("*").over(order.rowsBetween(-(thrust - 1), 0)) == thrust, share).alias("thrust"),
    )


def sector_breadth(bars: DataFrame, sessions: DataFrame, n: int = 21) -> DataFrame:
    """Per session: share of the fixed universe with a positive n-session return, null if any is missing; and among those available."""
    rows = exact(grid(bars, sessions), bars.select("series_id", "session", "close")).withColumn("r", R.period_return(F.col("close"), n))
    out = rows.groupBy("session").agg(F.count("*").alias("universe"), F.count("r").alias("available"), F.count_if(F.col("r") > 0).alias("positive"), F.array_join(F.array_sort(F.collect_list(F.when(F.col("r").isNull(), F.col("series_id")))), ",").alias("missing"))
    share = F.col("positive") / F.nullif(F.col("available"), F.lit(0))
    return out.select("session", F.when(F.col("available") == F.col("universe"), share).alias("strict"), share.alias("available_share"), "available", (F.col("universe") - F.col("available")).alias("n_missing"), "missing")


def dispersion(bars: DataFrame, anchor: DataFrame, n: int = 21, floor: float = 1e-6) -> DataFrame:
    """Mean volatility of the members over that of the anchor, per session."""
    vol = lambda b: b.withColumn("r", R.period_return(F.col("close"), 1)).withColumn("vol", R.realized_vol(F.col("r"), n))
    members = vol(bars).groupBy("session").agg(F.avg("vol").alias("mean_vol"))
    return members.join(vol(anchor).select("session", F.col("vol").alias("anchor_vol")), "session").select("session", (F.col("mean_vol") / F.greatest(F.col("anchor_vol"), F.lit(floor))).alias("dispersion"))
