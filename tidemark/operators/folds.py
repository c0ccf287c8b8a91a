"""Ordered passes over one series: recursions and label state machines.

A series' rows are brought together and sorted by `pos`; different series run in parallel. A
series is a few thousand sessions, so it fits a task; `batches` of a longer one would need
the state of the streaming form (tidemark.streaming.labels), which uses the same steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

FORCING = ("insufficient_data", "insufficient_history", "stale_data")


def fold(rows: DataFrame, step: Callable[[pd.DataFrame], pd.DataFrame], more: str, by: str = "series_id", order: str = "pos") -> DataFrame:
    """`rows` with the columns of the DDL `more` that `step` adds to each series, sorted by `order`."""
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(more).fields])
    names = schema.names
    return rows.groupBy(by).applyInPandas(lambda df: step(df.sort_values(order).reset_index(drop=True))[names], schema)


def wilder(values: Iterable[float], n: int, seeded: bool) -> list[float | None]:
    """Wilder's average: seeded with the mean of the first n values, or with the first value and shown from the n-th."""
    out: list[float | None] = []
    state, seen, total = None, 0, 0.0
    for x in values:
        if x is None or x != x:
            out.append(None if state is None or seen < n else state)
            continue
        seen += 1
        if seeded:
            total += x
            if seen == n:
                state = total / n
            elif seen > n:
                state = (state * (n - 1) + x) / n
        else:
            state = x if state is None else state + (x - state) / n
        out.append(state if seen >= n else None)
    return out


def atr(bars: DataFrame, n: int = 14) -> DataFrame:
    """Average true range, mean-seeded, as `atr`; needs `tr`."""
    return fold(bars, lambda df: df.assign(atr=pd.Series(wilder(df["tr"], n, True), dtype="float64")), "atr double")


def ewm(bars: DataFrame, n: int = 14) -> DataFrame:
    """Wilder's average of `tr`, seeded with the first value, as `ewm`."""
    return fold(bars, lambda df: df.assign(ewm=pd.Series(wilder(df["tr"], n, False), dtype="float64")), "ewm double")


def adx(bars: DataFrame, n: int = 14) -> DataFrame:
    """Average directional index as `adx`: three of Wilder's averages; a zero denominator gives null."""

    def step(df: pd.DataFrame) -> pd.DataFrame:
        high, low, close = df["high"], df["low"], df["close"]
        up, down = high.diff(), -low.diff()
        plus, minus = up.where((up > down) & (up > 0), 0.0), down.where((down > up) & (down > 0), 0.0)
        tr = pd.concat([high - low, (high - close.shift()).abs(), (low - close.shift()).abs()], axis=1).max(axis=1)
        smooth = [pd.Series(wilder(x, n, False), dtype="float64") for x in (tr, plus, minus)]
        di = [100 * s / smooth[0].where(smooth[0] != 0) for s in smooth[1:]]
        total = di[0] + di[1]
        dx = 100 * (di[0] - di[1]).abs() / total.where(total != 0)
        return df.assign(adx=pd.Series(wilder(dx, n, False), dtype="float64"))

    return fold(bars, step, "adx double")


class Hysteresis:
    """The state of one series: a riskier label enters after its days, another after the days of the one left."""

    def __init__(self, ranks: dict[str, int], leave: dict[str, int], enter: dict[str, int] | None = None, freeze: int = 0, state: tuple | None = None) -> None:
        self.ranks, self.leave, self.enter, self.freeze = ranks, leave, enter or {}, freeze
        self.stable, self.pending, self.count, self.gap, self.known, self.active = state or (None, None, 0, 0, None, None)

    @property
    def state(self) -> tuple:
        return self.stable, self.pending, self.count, self.gap, self.known, self.active

    def _change(self, raw: str, days: int) -> None:
        self.count = self.count + 1 if self.pending == raw else 1
        self.pending = raw
        if self.count >= days:
            self.stable, self.pending, self.count = raw, None, 0

    def step(self, raw: str, forced: bool = False) -> tuple[str, str, bool]:
        """(stable, active, frozen) after one session. forced: its data give no label."""
        if forced and self.freeze:
            self.gap += 1
            if self.known is not None and self.gap <= max(self.freeze, self.leave.get(self.known, 0) - 1):
                return self.known, self.active, True
            self.stable, self.pending, self.count, self.known, self.active = "unknown", None, 0, None, None
            return "unknown", "unknown", False
        self.gap = 0
        if self.stable is None:
            self.stable = raw
        elif raw == self.stable:
            self.pending, self.count = None, 0
        elif self.ranks[raw] > self.ranks[self.stable]:
            self._change(raw, self.enter.get(raw, 1))
        else:
            self._change(raw, max(1, self.leave.get(self.stable, 0)))
        active = raw if self.ranks[raw] > self.ranks[self.stable] else self.stable
        if raw != "unknown" and self.stable != "unknown":
            self.known, self.active = self.stable, active
        return self.stable, active, False


def hysteresis(rows: DataFrame, ranks: dict[str, int], leave: dict[str, int], freeze: int = 0, status: str | None = None) -> DataFrame:
    """Adds stable_label, active_label and frozen to rows with `label`; `status`: a column of quality states."""

    def step(df: pd.DataFrame) -> pd.DataFrame:
        machine = Hysteresis(ranks, leave, freeze=freeze)
        forced = df[status].isin(FORCING) if status else [False] * len(df)
        got = [machine.step(raw, bool(f)) for raw, f in zip(df["label"], forced)]
        return df.assign(stable_label=[g[0] for g in got], active_label=[g[1] for g in got], frozen=[g[2] for g in got])

    return fold(rows, step, "stable_label string, active_label string, frozen boolean")


def debounce(rows: DataFrame, days: dict[str, int], state: str = "state") -> DataFrame:
    """A new state must stand for its days; until then the old one stays and `pending` is true."""

    def step(df: pd.DataFrame) -> pd.DataFrame:
        now, wanted, count, out = None, None, 0, []
        for s in df[state]:
            if now is None or s == now:
                now, wanted, count = s, None, 0
            else:
                count = count + 1 if s == wanted else 1
                wanted = s
                if count >= days.get(s, 1):
                    now, wanted, count = s, None, 0
            out.append((now, wanted is not None))
        return df.assign(confirmed=[o[0] for o in out], pending=[o[1] for o in out])

    return fold(rows, step, "confirmed string, pending boolean")
