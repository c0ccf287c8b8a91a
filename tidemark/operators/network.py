"""Correlation structure of a universe over rolling windows.

Windows are computed in chunks of sessions that carry the window - 1 sessions before (a halo), so
chunks are independent tasks; inside, numpy works on one window's matrix at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rolling as R
from tidemark.operators.align import exact, grid
from tidemark.operators.order_statistics import ranked

STRUCTURE = "session date, pos long, columns int, rows int, mean_corr double, top_share double, top3_share double, effective_rank double"


def returns(bars: DataFrame, sessions: DataFrame, carry: bool = False) -> DataFrame:
    """(series_id, session, pos, r): daily returns on the grid, null where either bar is absent; `carry`: from the last known close."""
    rows = exact(grid(bars, sessions), bars.select("series_id", "session", "close"))
    rows = rows.withColumn("close", R.carried(F.col("close"))) if carry else rows
    return rows.select("series_id", "session", "pos", R.period_return(F.col("close"), 1).alias("r"))


def _structure(window: int, complete: float, least: int, chunk: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(df: pd.DataFrame) -> pd.DataFrame:
        own = int(df["chunk"].iloc[0])
        matrix = df.pivot(index="pos", columns="series_id", values="r").sort_index()
        days = df.drop_duplicates("pos").set_index("pos")["session"]
        positions, values, out = matrix.index.to_numpy(), matrix.to_numpy(float), []
        for pos in positions[(positions - 1) // chunk == own]:
            if pos <= window:  # the first return is null
                continue
            x = values[(positions > pos - window) & (positions <= pos)]
            kept = x[:, np.isfinite(x).mean(0) >= complete] if len(x) == window else x[:, :0]
            whole = kept[np.isfinite(kept).all(1)] if kept.shape[1] else kept
            row = [days[pos], int(pos), kept.shape[1], len(whole) if kept.shape[1] else 0, None, None, None, None]
            if kept.shape[1] >= least and len(whole) > 2 and (whole.std(0) > 0).all():
                corr = np.corrcoef(whole, rowvar=False)
                n = len(corr)
                values_ = np.clip(np.linalg.eigvalsh(corr)[::-1], 0, None)
                share = values_ / values_.sum()
                p = share[share > 0]
                row[4:] = [(corr.sum() - n) / (n * (n - 1)), share[0], share[:3].sum(), float(np.exp(-(p * np.log(p)).sum()))]
            out.append(row)
        return pd.DataFrame(out, columns=["session", "pos", "columns", "rows", "mean_corr", "top_share", "top3_share", "effective_rank"])

    return run


def structure(rows: DataFrame, window: int = 63, complete: float = 0.9, least: int = 20, chunk: int = 250) -> DataFrame:
    """Per session: surviving columns and complete rows, mean pairwise correlation, shares of the first and first three eigenvalues, effective rank."""
    first, last = F.floor((F.col("pos") - 1) / chunk), F.floor((F.col("pos") - 1 + window - 1) / chunk)
    halo = rows.withColumn("chunk", F.explode(F.sequence(first, last)))
    return halo.groupBy("chunk").applyInPandas(_structure(window, complete, least, chunk), STRUCTURE)


def pairwise(rows: DataFrame, window: int = 63) -> DataFrame:
    """Mean rolling correlation over all pairs of series, in SQL: the pairs of one session's universe, a bounded set."""
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b, (F.col("a.session") == F.col("b.session")) & (F.col("a.series_id") < F.col("b.series_id"))).select(F.col("a.series_id").alias("i"), F.col("b.series_id").alias("j"), "a.session", F.col("a.r").alias("x"), F.col("b.r").alias("y"))
    w = Window.partitionBy("i", "j").orderBy("session").rowsBetween(-(window - 1), 0)
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    rolled = pairs.withColumn("c", F.when(F.count(F.when(both, 1)).over(w) == window, F.corr("x", "y").over(w)))
    return rolled.groupBy("session").agg(F.avg("c").alias("mean_corr"), F.count("c").alias("pairs"))


def dispersion(rows: DataFrame, anchor: DataFrame, n: int = 21, floor: float = 1e-6) -> DataFrame:
    """(session, dispersion): mean volatility of members (series_id, session, r) over that of the anchor (session, r)."""
    vol = lambda x: x.withColumn("vol", R.realized_vol(F.col("r"), n))
    members = vol(rows).groupBy("session").agg(F.avg("vol").alias("mean_vol"))
    own = vol(anchor.withColumn("series_id", F.lit("m"))).select("session", F.col("vol").alias("anchor_vol"))
    return members.join(own, "session").select("session", (F.col("mean_vol") / F.greatest("anchor_vol", F.lit(floor))).alias("dispersion"))


#: Windows of the percentiles and of the rule inputs.
LONG, SHORT, RULE = 504, 252, 21


def percentiles(structure_: DataFrame, dispersion_: DataFrame, long: int = LONG, short: int = SHORT) -> DataFrame:
    """The structure of each session with its dispersion, and the average ranks of mean correlation, top share and effective
    rank over `long` sessions and of dispersion over `short`: corr_pct, eig_pct, rank_pct, dispersion_pct; null until a window is whole.

    One row a session, the whole market being one series.
    """
    rows = structure_.join(dispersion_, "session", "left").withColumn("series_id", F.lit("m"))
    made = {"corr_pct": ("mean_corr", long), "eig_pct": ("top_share", long), "rank_pct": ("effective_rank", long), "dispersion_pct": ("dispersion", short)}
    return ranked(rows, made).drop("series_id")


def rule_inputs(ranks: DataFrame, anchor: DataFrame, breadth: DataFrame, credit: DataFrame, n: int = RULE) -> DataFrame:
    """What the rules of the network axis read, by session: percentiles, levels (corr, eig, absorption), slopes of correlation and
    top share, stability of the effective rank (its deviation over its mean), the anchor's drawdown and percentiles, and the labels
    of breadth and credit (session, label) of the same session, null where there is none.

    anchor: (session, close, rv21, rv_pct, vix_pct).
    """
    order = "row_number() OVER (PARTITION BY series_id ORDER BY session)"
    rows = ranks.withColumn("series_id", F.lit("m")).join(anchor, "session", "left").withColumn("k", F.expr(order))
    k, c = F.col("k"), F.col
    out = rows.withColumns({
        "corr": c("mean_corr"), "eig": c("top_share"), "absorption": c("top3_share"), "corr_slope": R.ols_slope(c("mean_corr"), k, n), "eig_slope": R.ols_slope(c("top_share"), k, n),
        "rank_stability": R.variation(c("effective_rank"), n), "dd21": R.drawdown(c("close"), n),
    })
    labels = [d.select("session", F.col("label").alias(name)) for name, d in (("breadth", breadth), ("credit", credit))]
    for d in labels:
        out = out.join(d, "session", "left")
    return out.select("session", "corr_pct", "eig_pct", "rank_pct", "dispersion_pct", "corr", "eig", "absorption", "corr_slope", "eig_slope", "rank_stability", "dd21", "rv21", "rv_pct", "vix_pct", "breadth", "credit")
