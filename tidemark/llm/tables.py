"""What the operators share: table access, size checks, checkpoints and null-safe keys."""

from __future__ import annotations

import pickle
import tempfile
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows up to which a table of ids is broadcast; beyond it the join is shuffled.
BROADCAST_IDS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; where ``spark.checkpoint.dir`` is unset, a temporary one on a
    local master, and an error on a cluster, whose machines share no temporary folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """`df` as files in the session's shared checkpoint folder, its lineage cut."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """`df` (already written) with a broadcast hint if it has at most `limit` rows, else unchanged."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


#: A key is hot with more than one of so many rows; so there are at most as many hot keys.
HOT = 2_000
#: Tasks over which the rows of a hot key are dealt.
SALTS = 64


def hot_keys(counts: DataFrame, on: list[str], total: int) -> DataFrame:
    """The hot keys (not null) of a table of `total` rows from `counts`, its rows for each key in `n_rows`."""
    return counts.where(F.col("n_rows") > total / HOT).select(*on)


def spread_join(rows: DataFrame, groups: DataFrame, on: list[str], by: str, hot: DataFrame) -> DataFrame:
    """`rows` joined with `groups`, which has one row for each key.

    The rows of the keys `hot` (of hot_keys, so HOT at most, and broadcast) are dealt over SALTS tasks by
    the hash of column `by`, and their row of `groups` goes to each of these tasks.
    """
    hot = F.broadcast(hot.select(*on, F.lit(True).alias("_hot")))
    dealt = rows.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(groups.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_hot"), [*on, "_salt"]).drop("_salt")


def fold(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; -1 for a null id, so such a row is in no held-out fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of, F.lit(-1))


def sampled(df: DataFrame, label: str, key: str, per_label: int, least: int = 0) -> DataFrame:
    """About `per_label` rows of each label value at most, chosen by the hash of `key`.

    One pass counts every label over all rows; the share of the hash range that is kept
    follows from the counts, so the sample's expected size is bounded at any input size.
    Labels with at most `least` rows are left out.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("_n")).where(F.col("_n") > least)
    unit = (F.xxhash64(F.col(key).cast("string"), F.lit(17)).cast("double") / F.lit(2.0**64)) + 0.5
    return df.join(F.broadcast(counts), label).where(unit * F.col("_n") < per_label).drop("_n")


def place(df: DataFrame, column: str) -> int:
    """Where a column stands, however its name is cased, as in Spark."""
    return [c.lower() for c in df.columns].index(column.lower())


def boxed(df: DataFrame, *without: str) -> DataFrame:
    """Each row of `df` as one struct `row`, without the named columns: whatever its columns are called, no name clashes."""
    return df.drop(*without).select(F.struct("*").alias("row"))


def unboxed(rows: DataFrame, *more: str) -> DataFrame:
    """The columns of `row` and then the columns `more`."""
    return rows.select(*(F.col(f"row.`{c}`").alias(c) for c in rows.schema["row"].dataType.names), *more)


def extended(df: DataFrame, more: str) -> T.StructType:
    """The schema of `df` with the columns of the DDL string `more` after its own."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """A function that gives `value` inside tasks: broadcast once, pickled by value as functions are."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)
