"""Ranks of values in sliding windows of their series, from a sorted window that values enter and leave.

A window expression that gathers the whole window costs its length for every row. Here a row costs two
searches. A long series is cut into chunks that carry the n - 1 rows before them, so that no task
needs a whole series.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def sliding_ranks(values: list[float], n: int, average: bool) -> list[float | None]:
    """The rank of each value among the last n over n; null where one of those is null (nan). Ties: the average rank, or the largest."""
    window: list[float] = []
    out: list[float | None] = []
    for i, x in enumerate(values):
        if i >= n and (old := values[i - n]) == old:
            del window[bisect_left(window, old)]
        if x == x:
            insort(window, x)
        if len(window) < n:
            out.append(None)
            continue
        high = bisect_right(window, x)
        out.append(((bisect_left(window, x) + high + 1) / 2 if average else high) / n)
    return out


def ranked(rows: DataFrame, made: dict[str, tuple[str, int]], average: bool = True, by: str = "series_id", order: str = "session", chunk: int = 2_000) -> DataFrame:
    """`rows` with a column for each of `made`, out: (column, n), its rank in the last n rows of its series over n."""
    reach = max(n for _, n in made.values()) - 1
    names = ["_rank_k", "_rank_chunk"]
    numbered = rows.withColumn(names[0], F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1)
    first, last = F.floor(F.col(names[0]) / chunk), F.floor((F.col(names[0]) + reach) / chunk)
    spread = numbered.withColumn(names[1], F.explode(F.sequence(first, last)))
    schema = T.StructType([*rows.schema.fields, *(T.StructField(c, T.DoubleType()) for c in made)])

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(names[0])
        own = (df[names[0]] // chunk == df[names[1]]).to_numpy()
        found = {c: pd.Series(sliding_ranks(df[x].astype(float).tolist(), n, average), dtype="float64", index=df.index) for c, (x, n) in made.items()}
        return df.assign(**found)[own][schema.names]

    return spread.groupBy(by, names[1]).applyInPandas(run, schema)
