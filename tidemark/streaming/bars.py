"""Streams: events to bars, and label state machines that equal the batch folds."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.operators.folds import Hysteresis
from tidemark.operators.models import ChangePoint


def session_bars(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Daily bars of a stream (series_id, ts, value): open and close by time, and complete once the watermark has passed."""
    w = F.window("ts", "1 day")
    order = F.struct("ts", "event_id")
    out = events.withWatermark("ts", late).groupBy("series_id", w).agg(F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("volume"))
    return out.select("series_id", F.to_date("window.start").alias("session"), "open", "high", "low", "close", "volume")


def sliding_counts(events: DataFrame, length: str = "7 days", slide: str = "1 day", late: str = "1 day") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy("series_id", F.window("ts", length, slide)).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select("series_id", F.col("window.end").alias("until"), "n", "total")


def last_written(events: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """A stream without the repeats of a key inside the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


STABLE = "series_id string, pos long, label string, stable_label string, active_label string"
_STATE = "stable string, pending string, count long, gap long, known string, active string"


def stable_labels(labels: DataFrame, ranks: dict[str, int], leave: dict[str, int]) -> DataFrame:
    """Hysteresis over a stream (series_id, pos, label): the same steps as the batch form, its state kept by series.

    Rows of one batch are sorted by `pos`; a series' later batches must not be older.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        machine = Hysteresis(ranks, leave, state=tuple(state.get) if state.exists else None)
        df = pd.concat(list(frames)).sort_values("pos")
        got = [machine.step(x) for x in df["label"]]
        state.update(machine.state)
        yield pd.DataFrame({"series_id": key[0], "pos": df["pos"], "label": df["label"], "stable_label": [g[0] for g in got], "active_label": [g[1] for g in got]})

    return labels.groupBy("series_id").applyInPandasWithState(step, STABLE, _STATE, "append", GroupStateTimeout.NoTimeout)


COUNTS = "series_id string, pos long, flag boolean, since long, flags long"


def rows_since_flag(rows: DataFrame) -> DataFrame:
    """Rows since the last flag and the number of flags so far, over a stream (series_id, pos, flag)."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (None, 0)
        df, out = pd.concat(list(frames)).sort_values("pos"), []
        for pos, flag in zip(df["pos"], df["flag"]):
            last, n = (int(pos), n + 1) if flag else (last, n)
            out.append((key[0], int(pos), bool(flag), None if last is None else int(pos) - last, n))
        state.update((last, n))
        yield pd.DataFrame(out, columns=["series_id", "pos", "flag", "since", "flags"]).astype({"since": "Int64"})

    return rows.groupBy("series_id").applyInPandasWithState(step, COUNTS, "last long, n long", "append", GroupStateTimeout.NoTimeout)


CHANGES = "series_id string, pos long, change_point double"


def change_points(rows: DataFrame) -> DataFrame:
    """The online change-point posterior over a stream (series_id, pos, x); the state is the truncated run-length vector."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        model = ChangePoint(state=tuple(state.get) if state.exists else None)
        df = pd.concat(list(frames)).sort_values("pos")
        got = [model.step(round(float(x), 12)) for x in df["x"]]
        state.update(model.state)
        yield pd.DataFrame({"series_id": key[0], "pos": df["pos"], "change_point": got})

    kept = ", ".join(f"{c} array<double>" for c in ("p", "mean", "kappa", "alpha", "beta"))
    return rows.groupBy("series_id").applyInPandasWithState(step, CHANGES, kept, "append", GroupStateTimeout.NoTimeout)


GATED = "series_id string, session date, published date, value double"


def published_only(rows: DataFrame) -> DataFrame:
    """The last published reading at each session, over one stream of both: (series_id, at, value, is_session).

    A reading comes at its publication date and counts for the sessions from that date on, for those that
    come later in the stream; sessions before the first have nulls. The state is the last reading.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, value = state.get if state.exists else (None, None)
        df, out = pd.concat(list(frames)).sort_values(["at", "is_session"], kind="stable"), []
        for day, x, is_session in zip(df["at"], df["value"], df["is_session"]):
            if is_session:
                out.append((key[0], day, at, value))
            elif at is None or day >= at:
                at, value = day, float(x)
        state.update((at, value))
        yield pd.DataFrame(out, columns=["series_id", "session", "published", "value"])

    return rows.groupBy("series_id").applyInPandasWithState(step, GATED, "at date, value double", "append", GroupStateTimeout.NoTimeout)


CORRECTED = "series_id string, session date, version long, value double, op string"
_DAY = 86_400_000


def corrected(rows: DataFrame, late: str = "2 days", keep_days: int = 2) -> DataFrame:
    """Changes of a table of the newest version of each (series_id, session), over a stream (series_id, session, ts, version, value).

    A newer version gives a retraction of the row that it supersedes and an insert; an older or repeated one gives nothing. Versions of one
    batch show only their newest. Rows whose `ts` is more than `late` behind the stream come too late and count no more; a session's state
    goes `keep_days` days after its end on the stream's clock, so that the state holds recent sessions only.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(frames))
        rows = rows[rows["_ms"] >= state.getCurrentWatermarkMs()].sort_values("version")  # Spark itself drops late rows a batch later
        before = state.get if state.exists else None
        if rows.empty and before is None:
            return
        newest = rows.iloc[-1] if len(rows) else None
        if newest is None:
            pass
        elif before is None or newest["version"] > before[0]:
            now = (int(newest["version"]), float(newest["value"]))
            state.update(now)
            out = [(*key, *before, "retract")] if before else []
            yield pd.DataFrame([*out, (*key, *now, "insert")], columns=["series_id", "session", "version", "value", "op"])
        until = int(pd.Timestamp(key[1]).timestamp() * 1000) + (1 + keep_days) * _DAY
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))

    timed = rows.withWatermark("ts", late).withColumn("_ms", F.unix_millis("ts"))
    return timed.groupBy("series_id", "session").applyInPandasWithState(step, CORRECTED, "version long, value double", "append", GroupStateTimeout.EventTimeTimeout)


def standing(changes: DataFrame) -> DataFrame:
    """(series_id, session, version, value): what is left of inserts when every retraction takes its row away."""
    sign = F.when(F.col("op") == "insert", 1).otherwise(-1)
    left = changes.groupBy("series_id", "session", "version", "value").agg(F.sum(sign).alias("n"))
    return left.where("n > 0").drop("n")


def run_available(stream: DataFrame, folder: str, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Runs a stream over what is there and returns its rows, read from Parquet files in `folder`, a new one that all machines share.

    Tasks write the files, a folder a batch, so no rows pass through the driver; a batch that is run again replaces its own. In update mode
    a group comes out again with every batch that adds to it: `keys` name the group, of which the row of the last batch stands.
    """
    spark = stream.sparkSession
    spark.createDataFrame([], stream.schema).withColumn("_batch", F.lit(0).cast("long")).write.parquet(f"{folder}/rows/none")

    def write(rows: DataFrame, k: int) -> None:
        rows.withColumn("_batch", F.lit(k).cast("long")).write.mode("overwrite").parquet(f"{folder}/rows/{k}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/rows")
    if mode != "update" or not keys:
        return rows.drop("_batch")
    rest = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_last"))
    return last.select(*keys, *(F.col(f"_last.{c}").alias(c) for c in rest)).select(*stream.columns)
