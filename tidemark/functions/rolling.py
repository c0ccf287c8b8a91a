"""Rolling statistics of a series as Column expressions over (series_id, session) panels.

A frame that is not full, or holds a null, gives null: `full` guards every aggregate with
a count. All windows with one frame share one sort by (series_id, session).
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def by() -> WindowSpec:
    return Window.partitionBy("series_id").orderBy("session")


def last(n: int, offset: int = 0) -> WindowSpec:
    """The frame of n rows that ends `offset` rows before the current one."""
    return by().rowsBetween(-(n - 1) - offset, -offset)


def full(value: Column, over: Column, n: int, offset: int = 0, least: int | None = None) -> Column:
    """`value` over the last n rows, null unless `over` has n (or `least`) values there."""
    w = last(n, offset)
    return F.when(F.count(over).over(w) >= (n if least is None else least), value.over(w))


def lag(x: Column, n: int) -> Column:
    return F.lag(x, n).over(by())


def sma(x: Column, n: int) -> Column:
    return full(F.avg(x), x, n)


def period_return(x: Column, n: int) -> Column:
    return x / F.nullif(lag(x, n), F.lit(0.0)) - 1


def change_zscore(change: Column, n: int) -> Column:
    """(change - mean) / sample deviation over n rows; a deviation of 0 gives null. `change`: a column made before."""
    return (change - full(F.avg(change), change, n)) / F.nullif(full(F.stddev_samp(change), change, n), F.lit(0.0))


def ols_slope(x: Column, pos: Column, n: int) -> Column:
    return full(F.regr_slope(x, pos), x, n)


def variation(x: Column, n: int) -> Column:
    """Population deviation over mean; a mean of 0 gives null."""
    return full(F.stddev_pop(x), x, n) / F.nullif(full(F.avg(x), x, n), F.lit(0.0))


def drawdown(x: Column, n: int) -> Column:
    peak = full(F.max(x), x, n)
    return F.when(peak > 0, x / peak - 1)


def percentile_max_rank(x: Column, n: int) -> Column:
    """Share of the window at or below the current value."""
    return F.when(F.count(x).over(last(n)) == n, F.size(F.filter(F.collect_list(x).over(last(n)), lambda y: y <= x)) / F.lit(n))


def percentile_average_rank(x: Column, n: int) -> Column:
    """Average rank of the current value in the window, over its size."""
    values = F.collect_list(x).over(last(n))
    return F.when(F.count(x).over(last(n)) == n, (F.size(F.filter(values, lambda y: y < x)) + (F.size(F.filter(values, lambda y: y == x)) + 1) / 2) / F.lit(n))


def realized_vol(daily_return: Column, n: int) -> Column:
    return full(F.stddev_samp(daily_return), daily_return, n) * F.lit(252.0**0.5)


def true_range(high: Column, low: Column, close: Column) -> Column:
    """The greatest of three; the first row has high less low, as greatest() skips nulls."""
    before = lag(close, 1)
    return F.greatest(high - low, F.abs(high - before), F.abs(low - before))


def efficiency_ratio(x: Column, step: Column, n: int) -> Column:
    """Net move over the path; `step`: the absolute daily change."""
    return F.abs(x - lag(x, n)) / F.nullif(full(F.sum(step), step, n), F.lit(0.0))


def relative_slope(x: Column, n: int) -> Column:
    return (x - lag(x, n)) / F.nullif(lag(x, n), F.lit(0.0))


def zscore(x: Column, n: int) -> Column:
    return change_zscore(x, n)


def gap_frequency(gap: Column, n: int, threshold: float) -> Column:
    return full(F.avg(F.when(gap > threshold, 1.0).otherwise(0.0)), gap, n)


def midpoint_excursion(close: Column, high: Column, low: Column, n: int) -> Column:
    """Greatest distance from the middle of the range of n closes, over the middle."""
    top, bottom = full(F.max(close), close, n), full(F.min(close), close, n)
    return (top - bottom) / F.nullif(top + bottom, F.lit(0.0))


def breakout(close: Column, short: int = 20, long: int = 50) -> Column:
    """Whether the close is above the highest of the rows before; false where both windows are short."""
    above = [F.coalesce(close > full(F.max(close), close, n, 1), F.lit(False)) for n in (short, long)]
    return above[0] | above[1]


def band_width(close: Column, n: int, k: float = 2.0) -> Column:
    return 2 * k * full(F.stddev_pop(close), close, n)


def above_average_before(x: Column, n: int) -> Column:
    return x > full(F.avg(x), x, n, 1)


def rows_since(flag: Column, pos: Column) -> Column:
    """Rows since the flag was last true; null before."""
    return pos - F.last(F.when(flag, pos), ignorenulls=True).over(by().rowsBetween(Window.unboundedPreceding, 0))


def spike(x: Column, n: int, k: float) -> Column:
    """Whether x is above mean + k population deviations of the n rows before it."""
    return F.coalesce(x > full(F.avg(x), x, n, 1) + k * full(F.stddev_pop(x), x, n, 1), F.lit(False))


def carried(x: Column) -> Column:
    """The last value that is not null, up to the current row."""
    return F.last(x, ignorenulls=True).over(by().rowsBetween(Window.unboundedPreceding, 0))
