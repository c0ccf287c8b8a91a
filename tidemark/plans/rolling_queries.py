"""Queries of the rolling functions over the anchor panel, each with the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import rolling as R
from tidemark.sources.panel import bars_anchor, ctes

C = F.col
W = "PARTITION BY series_id ORDER BY session"


def _frame(n: int, offset: int = 0) -> str:
    return f"OVER ({W} ROWS BETWEEN {n - 1 + offset} PRECEDING AND {f'{offset} PRECEDING' if offset else 'CURRENT ROW'})"


def _full(f: str, n: int, x: str = "x", offset: int = 0, least: int | None = None) -> str:
    return f"CASE WHEN count({x}) {_frame(n, offset)} >= {least or n} THEN {f} {_frame(n, offset)} END"


def _lag(x: str, n: int) -> str:
    return f"lag({x}, {n}) OVER ({W})"


#: name: (a column x made first, and its SQL; the value from x, and its SQL).
SPECS = {
    "c01_sma": (lambda: C("close"), "close", lambda x: R.sma(x, 50), _full("avg(x)", 50)),
    "c02_period_return": (lambda: C("close"), "close", lambda x: R.period_return(x, 63), f"x / nullif({_lag('x', 63)}, 0) - 1"),
    "c03_change_zscore": (lambda: C("close") - R.lag(C("close"), 21), f"close - {_lag('close', 21)}", lambda x: R.change_zscore(x, 252), f"(x - {_full('avg(x)', 252)}) / nullif({_full('stddev_samp(x)', 252)}, 0)"),
    "c04_ols_slope": (lambda: C("close"), "close", lambda x: R.ols_slope(x, C("pos"), 63), _full("regr_slope(x, pos)", 63)),
    "c05_variation": (lambda: C("close"), "close", lambda x: R.variation(x, 21), f"{_full('stddev_pop(x)', 21)} / nullif({_full('avg(x)', 21)}, 0)"),
    "c06_drawdown": (lambda: C("close"), "close", lambda x: R.drawdown(x, 252), f"x / {_full('max(x)', 252)} - 1"),
    "c09_realized_vol": (lambda: R.period_return(C("close"), 1), f"close / {_lag('close', 1)} - 1", lambda x: R.realized_vol(x, 21), f"{_full('stddev_samp(x)', 21)} * sqrt(252)"),
    "c10_true_range": (lambda: R.true_range(C("high"), C("low"), C("close")), f"greatest(high - low, abs(high - {_lag('close', 1)}), abs(low - {_lag('close', 1)}))", lambda x: x / 1.4142135, "x / CAST(1.4142135 AS DOUBLE)"),
    "c14_efficiency_ratio": (lambda: F.abs(C("close") - R.lag(C("close"), 1)), f"abs(close - {_lag('close', 1)})", lambda x: R.efficiency_ratio(C("close"), x, 20), f"abs(close - {_lag('close', 20)}) / nullif({_full('sum(x)', 20)}, 0)"),
    "c16_relative_slope": (lambda: R.sma(C("close"), 50), _full("avg(close)", 50, "close"), lambda x: R.relative_slope(x, 20), f"(x - {_lag('x', 20)}) / nullif({_lag('x', 20)}, 0)"),
    "c17_volume_zscore": (lambda: C("volume").cast("double"), "CAST(volume AS DOUBLE)", lambda x: R.zscore(x, 20), f"(x - {_full('avg(x)', 20)}) / nullif({_full('stddev_samp(x)', 20)}, 0)"),
    "c18_gap_frequency": (lambda: F.abs(C("open") / R.lag(C("close"), 1) - 1), f"abs(open / {_lag('close', 1)} - 1)", lambda x: R.gap_frequency(x, 20, 0.5), _full("avg(CASE WHEN x > 0.5 THEN 1.0 ELSE 0.0 END)", 20)),
    "c19_intraday_range": (lambda: (C("high") - C("low")) / C("close"), "(high - low) / close", lambda x: x, "x"),
    "c20_midpoint_excursion": (lambda: C("close"), "close", lambda x: R.midpoint_excursion(x, C("high"), C("low"), 20), f"({_full('max(x)', 20)} - {_full('min(x)', 20)}) / nullif({_full('max(x)', 20)} + {_full('min(x)', 20)}, 0)"),
    "c21_breakout": (lambda: C("close"), "close", lambda x: R.breakout(x).cast("double"), f"CAST(coalesce(x > {_full('max(x)', 20, offset=1)}, false) OR coalesce(x > {_full('max(x)', 50, offset=1)}, false) AS DOUBLE)"),
    "c22_band_width_expanding": (lambda: R.band_width(C("close"), 20), f"4 * {_full('stddev_pop(close)', 20, 'close')}", lambda x: (x > R.lag(x, 5)).cast("double"), f"CAST(x > {_lag('x', 5)} AS DOUBLE)"),
    "c23_volume_above_average": (lambda: C("volume").cast("double"), "CAST(volume AS DOUBLE)", lambda x: R.above_average_before(x, 20).cast("double"), f"CAST(x > {_full('avg(x)', 20, offset=1)} AS DOUBLE)"),
    "c25_relative_change": (lambda: C("close"), "close", lambda x: R.relative_slope(x, 5), f"(x - {_lag('x', 5)}) / nullif({_lag('x', 5)}, 0)"),
    "c26_rolling_max": (lambda: C("close"), "close", lambda x: F.max(x).over(R.last(5)), f"max(x) {_frame(5)}"),
    "c27_rows_since_flag": (lambda: C("close"), "close", lambda x: R.rows_since(x > 2000, C("pos")).cast("double"), f"CAST(pos - last_value(CASE WHEN x > 2000 THEN pos END IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)"),
    "c29_mean_of_eight": (lambda: C("close"), "close", lambda x: F.avg(x).over(R.last(8)), f"avg(x) {_frame(8)}"),
    "c30_revision_direction": (lambda: C("close"), "close", lambda x: F.sign(x - R.lag(x, 4)), f"CAST(sign(x - {_lag('x', 4)}) AS DOUBLE)"),
    "c31_spike": (lambda: C("close"), "close", lambda x: R.spike(x, 20, 1.5).cast("double"), f"CAST(coalesce(x > {_full('avg(x)', 20, offset=1)} + 1.5 * {_full('stddev_pop(x)', 20, offset=1)}, false) AS DOUBLE)"),
    "b05_carried": (lambda: F.when(C("close") > 1500, C("close") / 1.4142135), "CASE WHEN close > 1500 THEN close / CAST(1.4142135 AS DOUBLE) END", lambda x: R.carried(x), f"last_value(x IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
}


def _query(first, value):
    def run(spark, sf_dir):
        made = bars_anchor(spark, sf_dir).withColumn("x", first())
        return made.select("series_id", "session", F.round(value(C("x")), 6).alias("value"))

    return run


QUERIES = {name: _query(first, value) for name, (first, _, value, _) in SPECS.items()}
ORACLE = {name: f"{ctes('bars')}, made AS (SELECT *, {first} AS x FROM bars) SELECT series_id, session, round({value}, 6) AS value FROM made" for name, (_, first, _, value) in SPECS.items()}


def _percentile(n, of):
    def run(spark, sf_dir):
        return bars_anchor(spark, sf_dir).select("series_id", "session", F.round(of(C("close"), n), 6).alias("value"))

    return run


_LISTS = f"{ctes('bars')}, made AS (SELECT *, list(close) {_frame(60)} AS xs FROM bars) SELECT series_id, session, round(CASE WHEN len(xs) = 60 THEN "
QUERIES |= {"c07_percentile_max_rank": _percentile(60, R.percentile_max_rank), "c08_percentile_average_rank": _percentile(60, R.percentile_average_rank)}
ORACLE |= {
    "c07_percentile_max_rank": _LISTS + "len(list_filter(xs, lambda y: y <= close)) / 60.0 END, 6) AS value FROM made",
    "c08_percentile_average_rank": _LISTS + "(len(list_filter(xs, lambda y: y < close)) + (len(list_filter(xs, lambda y: y = close)) + 1) / 2.0) / 60.0 END, 6) AS value FROM made",
}
