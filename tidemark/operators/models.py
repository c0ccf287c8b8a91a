"""Walk-forward checkpoints with their training rows, and online change points; the model fits are in walkforward."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def checkpoints(rows: DataFrame, window: int, cadence: int) -> DataFrame:
    """(series_id, checkpoint, low, high): train on pos in (low, checkpoint], score (checkpoint, high]."""
    ends = rows.groupBy("series_id").agg(F.max("pos").alias("n")).where(F.col("n") >= window)
    at = ends.select("series_id", "n", F.explode(F.sequence(F.lit(window), F.col("n"), F.lit(cadence))).alias("checkpoint"))
    return at.select("series_id", F.col("checkpoint").cast("long").alias("checkpoint"), (F.col("checkpoint") - window).cast("long").alias("low"), F.least(F.col("checkpoint") + cadence, "n").cast("long").alias("high"))


def training_rows(rows: DataFrame, points: DataFrame) -> DataFrame:
    """Rows of each checkpoint's training and scoring ranges, with `part`: an equality join by series and a range."""
    p = points.withColumnRenamed("series_id", "_id")
    out = rows.join(p, (F.col("series_id") == F.col("_id")) & (F.col("pos") > F.col("low")) & (F.col("pos") <= F.col("high"))).drop("_id")
    return out.withColumn("part", F.when(F.col("pos") <= F.col("checkpoint"), "train").otherwise("score"))


def standardised(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Columns less the mean over the population deviation of their checkpoint's training rows; a deviation of 0 counts as 1."""
    by = Window.partitionBy("series_id", "checkpoint")
    train = F.col("part") == "train"
    make = lambda c: (F.col(c) - F.avg(F.when(train, F.col(c))).over(by)) / F.coalesce(F.nullif(F.stddev_pop(F.when(train, F.col(c))).over(by), F.lit(0.0)), F.lit(1.0))
    return rows.withColumns({c: make(c) for c in columns})


#: The prior of a run's mean (mean, kappa) and precision (alpha, beta), and the hazard.
PRIOR, HAZARD = (0.0, 1.0, 0.1, 0.01), 1 / 250


class ChangePoint:
    """Online change-point posterior: run lengths up to `longest`, constant hazard, Student-t predictive; prior: mean, kappa, alpha, beta."""

    def __init__(self, hazard: float = HAZARD, longest: int = 300, recent: int = 21, state: tuple | None = None, prior: tuple = PRIOR) -> None:
        self.hazard, self.longest, self.recent, self.prior = hazard, longest, recent, prior
        self.p, self.mean, self.kappa, self.alpha, self.beta = (np.array(v, float) for v in state) if state else (np.array([float(v)]) for v in (1, *prior))

    @property
    def state(self) -> tuple:
        return tuple(v.tolist() for v in (self.p, self.mean, self.kappa, self.alpha, self.beta))

    def step(self, x: float) -> float:
        """The probability of a change within the last `recent` rows."""
        from math import lgamma

        scale = self.beta * (self.kappa + 1) / (self.alpha * self.kappa)
        gammas = np.array([lgamma(a + 0.5) - lgamma(a) for a in self.alpha])
        density = np.exp(gammas - 0.5 * np.log(2 * np.pi * self.alpha * scale) - (self.alpha + 0.5) * np.log1p((x - self.mean) ** 2 / (2 * self.alpha * scale)))
        joint = self.p * density
        p = np.concatenate([[joint.sum() * self.hazard], joint * (1 - self.hazard)])[: self.longest]
        mean = np.concatenate([[self.prior[0]], (self.kappa * self.mean + x) / (self.kappa + 1)])[: self.longest]
        beta = np.concatenate([[self.prior[3]], self.beta + self.kappa * (x - self.mean) ** 2 / (2 * (self.kappa + 1))])[: self.longest]
        self.kappa = np.concatenate([[self.prior[1]], self.kappa + 1])[: self.longest]
        self.alpha = np.concatenate([[self.prior[2]], self.alpha + 0.5])[: self.longest]
        self.p, self.mean, self.beta = p / p.sum(), mean, beta
        return float(self.p[1 : self.recent + 1].sum())


def change_points(rows: DataFrame, column: str) -> DataFrame:
    """Adds `change_point` to rows of series in order; a null leaves the state as it is."""
    from tidemark.operators.folds import fold

    def step(df: pd.DataFrame) -> pd.DataFrame:
        model = ChangePoint()
        return df.assign(change_point=pd.Series([model.step(round(float(x), 12)) if x == x and x is not None else None for x in df[column]], dtype="float64"))

    return fold(rows, step, "change_point double")
