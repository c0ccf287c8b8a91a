"""Lookups of many keys in a large table: a bounded head of the heaviest keys is sent to the tasks, the rest is joined.

Keys such as words are as skewed as text is: a bounded number of them makes up most of all
occurrences. Those are looked up in sorted arrays inside the tasks; what is left is spread over
very many light keys, which a shuffled join takes well. Both give the same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import checkpoint_folder, extended, shared

#: Keys of a head at most: 16 bytes each in a task.
HEAD = 1 << 19


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` as Parquet in the session's shared checkpoint folder, its lineage cut; smaller than a checkpoint."""
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def heaviest(stats: DataFrame, weight: str, limit: int = HEAD) -> DataFrame:
    """The rows of `stats` (already written) with the greatest `weight`, at most `limit`, whatever ties there are.

    Weights fall into bins of a sixteenth of a doubling; whole bins are taken from the top, so one pass
    of counts finds the bound and no row of equal weight is treated unlike another.
    """
    binned = F.floor(F.log2(F.col(weight).cast("double")) * 16)
    total, bound = 0, None
    for b, n in sorted(((r[0], r[1]) for r in stats.groupBy(binned.alias("b")).count().collect() if r[0] is not None), reverse=True):
        total += n
        if total > limit:
            break
        bound = b
    return stats.where(binned >= bound) if bound is not None else stats.where(F.lit(False))


def arrays(df: DataFrame, *columns: str) -> list[np.ndarray]:
    """Columns of a bounded table as arrays, sorted by the first."""
    got = df.select(*columns).toArrow()
    found = [got.column(c).to_numpy() for c in columns]
    order = np.argsort(found[0], kind="stable")
    return [x[order] for x in found]


def found_at(keys: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each of `asked` stands in the sorted `keys`; -1 where it does not."""
    if not len(keys):
        return np.full(len(asked), -1)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[at] == asked, at, -1)


def joined_sums(rows: DataFrame, row: str, keys: str, times: str, stats: DataFrame, key: str, values: dict[str, Column]) -> DataFrame:
    """(row, values) for the rows with any of the array `keys`: for each of `values` the sum over the keys of times x value,
    the value from the row of `stats` with that key.

    `row` numbers the rows (stored, as they are read apart); a value sees nulls where `stats` lacks the key.
    """
    each = rows.where(F.size(keys) > 0).select(row, F.explode(F.arrays_zip(F.col(keys).alias("k"), F.col(times).alias("t"))).alias("e"))
    each = each.select(row, F.col("e.k").alias(key), F.col("e.t").alias("_times"))
    return each.join(stats, key, "left").groupBy(row).agg(*(F.sum(F.col("_times") * v).alias(name) for name, v in values.items()))


def with_sums(rows: DataFrame, sums: DataFrame, row: str) -> DataFrame:
    """`rows` with the columns of `sums`, 0 where it lacks the row."""
    return rows.join(sums, row, "left").na.fill(0, [c for c in sums.columns if c != row])


def head_sums(rows: DataFrame, keys: str, times: str, head: list[np.ndarray], names: list[str]) -> DataFrame:
    """`rows` with a long column for each of `names`, the sum over the row's keys in the head of times x value,
    and with `keys` and `times` cut down to the keys outside the head.

    `head`: sorted keys and an integer array for each of `names`. Null lists count as empty.
    """
    others = [c for c in rows.columns if c not in (keys, times)]
    rows = rows.select(*others, keys, times)
    n, held = len(others), shared(rows.sparkSession, head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, *values = held()
        for batch in batches:
            lists = batch.column(n)
            sizes = np.array([0 if x is None else x for x in pa.compute.list_value_length(lists).to_pylist()], np.int64)
            k, t = lists.flatten().to_numpy(), batch.column(n + 1).flatten().to_numpy()
            at, of = found_at(known, k), np.repeat(np.arange(len(sizes)), sizes)
            hit = at >= 0
            sums = []
            for v in values:
                total = np.zeros(len(sizes), np.int64)
                np.add.at(total, of[hit], t[hit].astype(np.int64) * v[at[hit]])
                sums.append(pa.array(total))
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(of[~hit], minlength=len(sizes)))]).astype(np.int32))
            left = [pa.ListArray.from_arrays(offsets, pa.array(x[~hit])) for x in (k, t)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *left, *sums], names=[*batch.schema.names, *names])

    return rows.mapInArrow(run, extended(rows, ", ".join(f"`{x}` long" for x in names)))
