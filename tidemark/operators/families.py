"""Feature families beyond single rolling statistics, and small table jobs around them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rolling as R
from tidemark.operators.align import as_of


def follow_through(bars: DataFrame, hold: int = 5, last: int = 20, within: int = 504) -> DataFrame:
    """Share of the last breakouts, resolved by now, that held above their level for `hold` sessions, as `rate`.

    A breakout at pos is known at pos + hold. The level is the 20-row high before it, where the
    close is above that, else the 50-row one. Null until `last` of them lie within `within` sessions.
    """
    close, order = F.col("close"), Window.partitionBy("series_id").orderBy("pos")
    ahead = order.rowsBetween(1, hold)
    top20, top50 = R.full(F.max(close), close, 20, 1), R.full(F.max(close), close, 50, 1)
    rows = bars.withColumns({"top20": top20, "top50": top50, "low": F.min("close").over(ahead), "n_ahead": F.count("close").over(ahead)})
    level = F.when(close > F.col("top20"), F.col("top20")).otherwise(F.col("top50"))
    broke = rows.where((F.col("n_ahead") == hold) & ((close > F.col("top20")) | (close > F.col("top50"))))
    held = broke.select("series_id", (F.col("pos") + hold).alias("resolved"), F.when(F.col("low") > level, 1.0).otherwise(0.0).alias("held"))
    w = Window.partitionBy("series_id").orderBy("resolved").rowsBetween(-(last - 1), 0)
    state = held.select("series_id", "resolved", F.struct(F.sum("held").over(w).alias("held"), F.count("*").over(w).alias("n"), F.min("resolved").over(w).alias("oldest")).alias("s"))
    at = bars.select("series_id", "session", "pos").withColumn("_d", F.col("session")).withColumn("session", F.col("pos"))
    known = as_of(at, state, "resolved", ["s"], ["series_id"])
    good = (F.col("s.n") == last) & (F.col("pos") - F.col("s.oldest") < within)
    return known.select("series_id", F.col("_d").alias("session"), "pos", F.when(good, F.col("s.held") / last).alias("rate"))


def hurst(bars: DataFrame, n: int = 250) -> DataFrame:
    """Rescaled-range exponent of the log returns in windows of n closes: log(R/S) over log(n - 1)."""
    from tidemark.operators.folds import fold

    def step(df: pd.DataFrame) -> pd.DataFrame:
        r = np.diff(np.log(df["close"].to_numpy(float)))
        out = np.full(len(df), np.nan)
        if len(r) >= n - 1:
            windows = np.lib.stride_tricks.sliding_window_view(r, n - 1)
            walks = np.cumsum(windows - windows.mean(1, keepdims=True), 1)
            spread, deviation = walks.max(1) - walks.min(1), windows.std(1)
            good = (deviation > 0) & (spread > 0)
            out[n - 1 :][good] = np.log(spread[good] / deviation[good]) / np.log(n - 1)
        return df.assign(hurst=pd.Series(out).astype(object).where(~np.isnan(out), None))

    return fold(bars.select("series_id", "session", "pos", "close"), step, "hurst double")


def concordance(a: Column, b: Column) -> Column:
    """1 where two signals have one sign, -1 where opposite ones, 0 where one is zero, null without both."""
    return F.when(a.isNotNull() & b.isNotNull(), (F.sign(a) * F.sign(b)).cast("int"))


#: Windows of the trend tables.
ER, HURST, SLOPE, SHORT, LONG, DRAWDOWN = 20, 250, 20, 50, 200, 252


def trend_features(bars: DataFrame, sentiment: DataFrame, news: DataFrame) -> DataFrame:
    """Trend direction of each series and session: efficiency ratio, Hurst exponent, averages with their slopes, returns, drawdown,
    volatility, and the sentiment and news scores (session, score) of the session with the concordance of their signs.
    """
    close = F.col("close")
    rows = bars.withColumns({"ret1": R.period_return(close, 1), "step": F.abs(close - R.lag(close, 1))})
    rows = rows.withColumns({"sma50": R.sma(close, SHORT), "sma200": R.sma(close, LONG)})
    rows = rows.withColumns({
        "er20": R.efficiency_ratio(close, F.col("step"), ER), "slope_sma50": R.relative_slope(F.col("sma50"), SLOPE), "slope_sma200": R.relative_slope(F.col("sma200"), SLOPE),
        "ret63": R.period_return(close, 63), "ret126": R.period_return(close, 126), "dd252": R.drawdown(close, DRAWDOWN), "rv21": R.realized_vol(F.col("ret1"), 21),
    })
    rows = rows.join(hurst(bars, HURST).select("series_id", "session", F.col("hurst").alias("hurst250")), ["series_id", "session"], "left")
    for name, scores in (("sentiment", sentiment), ("news", news)):
        rows = rows.join(scores.select("session", F.col("score").alias(name)), "session", "left")
    rows = rows.withColumn("sentiment_concordance", concordance(F.col("sentiment"), F.col("news")))
    names = ("er20", "hurst250", "slope_sma50", "slope_sma200", "ret63", "ret126", "dd252", "sma50", "sma200", "rv21", "sentiment", "news", "sentiment_concordance")
    return rows.select("series_id", "session", "pos", *names)


def character_features(bars: DataFrame) -> DataFrame:
    """What the rules of trend character read: average, returns, drawdown from the 63-session high, directional index, midpoint excursion,
    breakout, whether bands widen and volume is above its average, and the follow-through of breakouts (`follow`)."""
    from tidemark.operators.folds import adx

    close, key = F.col("close"), ["series_id", "session"]
    rows = bars.withColumn("width", R.band_width(close, 20))
    rows = rows.withColumns({
        "sma50": R.sma(close, 50), "ret10": R.period_return(close, 10), "ret21": R.period_return(close, 21), "ret63": R.period_return(close, 63), "dd63": close / R.full(F.max("close"), close, 63) - 1,
        "midpoint": R.midpoint_excursion(close, F.col("high"), F.col("low"), 20), "breakout": R.breakout(close).cast("int"), "widening": (F.col("width") > R.lag(F.col("width"), 5)).cast("int"),
        "heavy": R.above_average_before(F.col("volume"), 20).cast("int"),
    })
    out = rows.join(adx(bars).select(*key, "adx"), key).join(follow_through(bars).select(*key, F.col("rate").alias("follow")), key, "left")
    return out.select(*key, "pos", "close", "sma50", "ret10", "ret21", "ret63", "dd63", "adx", "midpoint", "breakout", "widening", "heavy", "follow")


def spike_window(components: str) -> Column:
    """Sessions before and after a spike as a struct, by its components: those that lasted have a wider window."""
    has = lambda name: F.coalesce(F.array_contains(components, name), F.lit(False))
    window = lambda a, b: F.struct(F.lit(a).alias("before"), F.lit(b).alias("after"))
    return F.when(has("persistent_30d"), window(-2, 5)).when(has("persistent_7d"), window(-1, 3)).otherwise(window(0, 0))


def spike_components(readings: DataFrame, column: str = "value", k: float = 2.0) -> DataFrame:
    """(series_id, session, pos, components): 'spike' where a value is above its mean and k deviations of the 60 before, persistent_7d and
    persistent_30d where the means over 7 and 30 are above those of the 60 values before them."""
    x, before = F.col(column), R.full(F.avg(column), F.col(column), 60, 1)
    spike = R.spike(x, 60, k)
    long = {n: F.coalesce(R.full(F.avg(column), x, n) > R.full(F.avg(column), x, 60, n), F.lit(False)) for n in (7, 30)}
    rows = readings.withColumns({"_spike": spike, "_7": spike & long[7], "_30": spike & long[30], "_before": before})
    parts = F.array_compact(F.array(F.when(F.col("_spike"), F.lit("spike")), F.when(F.col("_7"), F.lit("persistent_7d")), F.when(F.col("_30"), F.lit("persistent_30d"))))
    return rows.select("series_id", "session", "pos", parts.alias("components"))


#: Drift of the six-month change that counts as none, and the change below which inflation is benign.
DRIFT, BENIGN = 0.005, 0.04


def limb_evidence(rows: DataFrame, change: str = "change6", lag: str = "change6_lag", slope: str = "change6_slope") -> DataFrame:
    """Adds the margins of the three ways in which inflation may be benign (drift, slope, level), null where an input is, and `limbs`, how many hold."""
    c = F.col
    margins = {"drift_margin": DRIFT - F.abs(c(change) - c(lag)), "slope_margin": 0.0 - c(slope), "benign_margin": BENIGN - c(change)}
    out = rows.withColumns(margins)
    holds = [F.coalesce(F.col(m) >= 0 if m != "benign_margin" else F.col(m) > 0, F.lit(False)).cast("int") for m in margins]
    return out.withColumn("limbs", holds[0] + holds[1] + holds[2])


def proxy_breadth(market: DataFrame, equal: DataFrame, sma: int = 50, back: int = 20, high: int = 63, least: int = 50) -> DataFrame:
    """Ratio of two series with its average and return, and the distance of the market from its high."""
    both = market.select("series_id", "session", "close").join(equal.select("session", F.col("close").alias("other")), "session").withColumn("ratio", F.col("close") / F.col("other"))
    return both.select("session", "ratio", R.sma(F.col("ratio"), sma).alias("ratio_sma"), R.period_return(F.col("ratio"), back).alias("ratio_ret"), (F.col("close") / R.full(F.max("close"), F.col("close"), high, least=least) - 1).alias("from_high"))


def pressure(rows: DataFrame, column: str, change: int, n: int) -> DataFrame:
    """`z`: the score of an n-session change of a series that is carried forward over its gaps."""
    out = rows.withColumn("_x", R.carried(F.col(column))).withColumn("_c", F.col("_x") - R.lag(F.col("_x"), change))
    return out.withColumn("z", R.change_zscore(F.col("_c"), n)).drop("_x", "_c")


def monetary_features(rows: DataFrame, columns: dict[str, str], long: int = 63, short: int = 21, n: int = 1260) -> DataFrame:
    """Scores of changes over `long` sessions of two yields and a currency (z2y, z10y, z_usd) and over `short` of the yields, each against its
    own `n` sessions; readings are carried forward. columns: the column of y2, y10 and usd."""
    wanted = {"z2y": ("y2", long), "z10y": ("y10", long), "z_usd": ("usd", long), "z2y_short": ("y2", short), "z10y_short": ("y10", short)}
    out = rows
    for name, (source, change) in wanted.items():
        out = pressure(out, columns[source], change, n).withColumnRenamed("z", name)
    return out


def surprise(rows: DataFrame, realised: str, expected: str, n: int) -> DataFrame:
    """`z`: realised less expected over the deviation of that difference, without its mean."""
    out = rows.withColumn("_d", F.col(realised) - F.col(expected))
    return out.withColumn("z", F.col("_d") / F.nullif(R.full(F.stddev_samp("_d"), F.col("_d"), n), F.lit(0.0))).drop("_d")


def weekly_to_sessions(sessions: DataFrame, readings: DataFrame, column: str, least: int, max_days: int) -> DataFrame:
    """The latest published reading at each session; null before `least` readings and when older than `max_days`."""
    k = F.row_number().over(Window.orderBy("publication_date"))  # a weekly market-level table
    r = readings.withColumn("_k", k).withColumn("_seen", F.col("publication_date")).withColumn("series_id", F.lit("m"))
    rows = as_of(sessions.withColumn("series_id", F.lit("m")), r, "publication_date", [column, "_k", "_seen"], ["series_id"])
    fresh = (F.col("_k") >= least) & (F.datediff("session", "_seen") <= max_days)
    return rows.select("session", F.when(fresh, F.col(column)).alias(column))


def availability(wanted: DataFrame, present: DataFrame) -> DataFrame:
    """(feature, available, missing): whether all inputs of each feature are there, and those that are not."""
    here = present.select("input").distinct().withColumn("_in", F.lit(True))
    out = wanted.join(here, "input", "left").groupBy("feature").agg(F.bool_and(F.coalesce("_in", F.lit(False))).alias("available"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("_in").isNull(), F.col("input").cast("string")))), ",").alias("missing"))
    return out


def top_columns(rows: DataFrame, key: str, columns: list[str], n: int) -> DataFrame:
    """The names of the n largest positive columns of each row, as `top`."""
    ranked = F.array_sort(F.filter(F.array(*(F.struct((-F.col(c)).alias("by"), F.lit(c).alias("name")) for c in columns)), lambda x: x["by"] < 0))
    return rows.select(key, F.array_join(F.transform(F.slice(ranked, 1, n), lambda x: x["name"]), ",").alias("top")).where("top != ''")


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key, the last by `order`."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return rows.withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def field_differences(a: DataFrame, b: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(keys, field) of every field that differs between two tables, or that one side lacks."""
    long = lambda d, v: d.select(*keys, F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("v")) for c in fields))).alias("x")).select(*keys, "x.field", F.col("x.v").alias(v))
    both = long(a, "_a").join(long(b, "_b"), [*keys, "field"], "full")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys, "field")


def nearest_match(intents: DataFrame, matching: DataFrame, reach: int) -> DataFrame:
    """(series_id, intent, matched): the first matching session within `reach` of each intent; ordinals are spread and joined by equality."""
    spread = intents.select("series_id", "intent", F.explode(F.sequence(F.col("intent") - reach, F.col("intent") + reach)).alias("pos"))
    return spread.join(matching.select("series_id", "pos"), ["series_id", "pos"]).groupBy("series_id", "intent").agg(F.min("pos").alias("matched"))


def append_new(old: DataFrame, fresh: DataFrame, order: str) -> DataFrame:
    """`old` and the rows of `fresh` beyond its last one."""
    last = old.agg(F.max(order).alias("_last"))
    return old.unionByName(fresh.join(F.broadcast(last)).where(F.col("_last").isNull() | (F.col(order) > F.col("_last"))).drop("_last"))  # one row


def consolidated(stores: dict[str, DataFrame]) -> DataFrame:
    """Rows of several stores with their source; a column that a store lacks is null."""
    out = None
    for name, df in stores.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
