"""Quality of a feature's input at each session: history, freshness, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import rolling as R

#: Completeness below which data are insufficient, whatever an axis asks.
FLOOR = 0.70


def assessed(rows: DataFrame, inputs: list[str], required: int, max_fresh: int, complete: float, label: Column | None = None) -> DataFrame:
    """Adds status, freshness_days and completeness: the worst of `inputs` over the last `required` rows.

    In this order: too few rows, stale, insufficient, an unknown label, degraded, ok.
    """
    w = R.last(required)
    size = F.count(F.lit(1)).over(w)
    shares = [F.count(c).over(w) / size for c in inputs]
    ages = [F.coalesce(F.col("pos") - F.last(F.when(F.col(c).isNotNull(), F.col("pos")), ignorenulls=True).over(w), F.lit(required)) for c in inputs]
    share = F.least(*shares) if len(shares) > 1 else shares[0]
    age = F.greatest(*ages) if len(ages) > 1 else ages[0]
    out = rows.withColumn("_n", size).withColumn("_age", age).withColumn("_share", share)
    unknown = (label == "unknown") if label is not None else F.lit(False)
    status = (
        F.when(F.col("_n") < required, "insufficient_history").when(F.col("_age") > max_fresh, "stale_data").when(F.col("_share") < FLOOR, "insufficient_data")
        .when(unknown, "insufficient_history").when(F.col("_share") < complete, "degraded").otherwise("ok")
    )
    known = F.col("status") != "insufficient_history"
    out = out.withColumn("status", status)
    return out.withColumn("freshness_days", F.when(known, F.col("_age"))).withColumn("completeness", F.when(known, F.col("_share"))).drop("_n", "_age", "_share")


def runs(rows: DataFrame, value: str) -> DataFrame:
    """Rows with `run`, the number of the run of equal values in its series, and `length`, rows of the run so far."""
    order = Window.partitionBy("series_id").orderBy("pos")
    changed = F.when(F.col(value).eqNullSafe(F.lag(value).over(order)), 0).otherwise(1)
    out = rows.withColumn("_new", changed).withColumn("run", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")
    return out.withColumn("length", F.row_number().over(Window.partitionBy("series_id", "run").orderBy("pos")).cast("long"))
