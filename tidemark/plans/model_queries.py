"""Queries of networks, models, strategy tables and streams; SQL where it can say the same."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import models, network, rules, strategy
from tidemark.plans import label_queries
from tidemark.plans.label_queries import FEATURES_SQL, features, labels
from tidemark.sources import panel
from tidemark.sources.panel import ctes, table
from tidemark.streaming import bars as streams

QUERIES, ORACLE = {}, {}
C = F.col


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def _returns(spark, sf):
    return network.returns(panel.bars_member(spark, sf), panel.sessions(spark, sf))


@query("f02_correlation_structure")
def f02(spark, sf):
    out = network.structure(_returns(spark, sf), window=63, complete=0.5, least=5)
    return out.select("session", "columns", "rows", *(F.round(c, 6).alias(c) for c in ("mean_corr", "top_share", "top3_share", "effective_rank")))


_GRID = "g AS (SELECT series_id, session, s.pos FROM (SELECT DISTINCT series_id FROM members) CROSS JOIN sessions s), r AS (SELECT g.series_id, g.session, m.close / nullif(lag(m.close) OVER (PARTITION BY g.series_id ORDER BY g.session), 0) - 1 AS r FROM g LEFT JOIN members m ON g.series_id = m.series_id AND g.session = m.session)"


@query("f08_pairwise_correlation", f"""{ctes('members', 'sessions')}, {_GRID}, p AS (SELECT a.series_id AS i, b.series_id AS j, a.session, a.r AS x, b.r AS y FROM r a JOIN r b ON a.session = b.session AND a.series_id < b.series_id),
c AS (SELECT session, CASE WHEN count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) OVER w = 21 THEN corr(x, y) OVER w END AS c FROM p WINDOW w AS (PARTITION BY i, j ORDER BY session ROWS BETWEEN 20 PRECEDING AND CURRENT ROW)) SELECT session, round(avg(c), 5) AS mean_corr, count(c) AS pairs FROM c GROUP BY 1""")
def f08(spark, sf):
    out = network.pairwise(_returns(spark, sf), 21)
    return out.withColumn("mean_corr", F.round("mean_corr", 5))


@query("l01_checkpoints", f"{ctes('bars')}, e AS (SELECT series_id, max(pos) AS n FROM bars GROUP BY 1 HAVING max(pos) >= 252), c AS (SELECT series_id, n, unnest(range(252, n + 1, 63)) AS checkpoint FROM e) SELECT series_id, checkpoint, checkpoint - 252 AS low, least(checkpoint + 63, n) AS high FROM c")
def l01(spark, sf):
    return models.checkpoints(panel.bars_anchor(spark, sf), 252, 63)


_INPUTS = ["ret5", "rv21"]


def _rows(spark, sf, window=252, cadence=126):
    f = features(spark, sf).select("series_id", "session", "pos", *(F.log1p(F.abs(c)).alias(c) for c in _INPUTS)).na.drop()
    return models.standardised(models.training_rows(f, models.checkpoints(f, window, cadence)), _INPUTS)


@query("l03_standardised", f"""{FEATURES_SQL}, x AS (SELECT series_id, session, pos, ln(1 + abs(ret5)) AS v FROM f WHERE ret5 IS NOT NULL AND rv21 IS NOT NULL), e AS (SELECT series_id, max(pos) AS n FROM x GROUP BY 1 HAVING max(pos) >= 252), c AS (SELECT series_id, n, unnest(range(252, n + 1, 126)) AS checkpoint FROM e),
t AS (SELECT x.*, checkpoint, x.pos <= checkpoint AS train FROM x JOIN c ON x.series_id = c.series_id AND x.pos > checkpoint - 252 AND x.pos <= least(checkpoint + 126, n))
SELECT series_id, session, checkpoint, CASE WHEN train THEN 'train' ELSE 'score' END AS part, round((v - avg(v) FILTER (train) OVER w) / coalesce(nullif(stddev_pop(v) FILTER (train) OVER w, 0), 1), 5) AS value FROM t WINDOW w AS (PARTITION BY series_id, checkpoint)""")
def l03(spark, sf):
    return _rows(spark, sf).select("series_id", "session", "checkpoint", "part", F.round("ret5", 5).alias("value"))


@query("l08_change_points")
def l08(spark, sf):
    rows = features(spark, sf).select("series_id", "session", "pos", F.log1p(F.abs("ret1")).alias("x"))
    return models.change_points(rows, "x").select("series_id", "session", F.round("change_point", 6).alias("change_point"))


def _routed(spark, sf):
    f = features(spark, sf).withColumns({"trend": rules.label(rules.TREND), "volatility": rules.label(rules.VOLATILITY), "state": F.lit("stable"), "character": F.when(C("gap_pct") > 0.5, "chop").otherwise("trending")})
    return strategy.routed(f, ["trend", "volatility"])


@query("k03_cohorts", f"""{FEATURES_SQL}, l AS (SELECT *, {rules.case(rules.TREND)} AS trend, {rules.case(rules.VOLATILITY)} AS volatility, CASE WHEN gap_pct > 0.5 THEN 'chop' ELSE 'trending' END AS character FROM f)
SELECT series_id, session, CASE WHEN trend = 'unknown' OR volatility = 'unknown' THEN 'outage' WHEN trend = 'bear' OR volatility = 'high_vol' THEN 'risk_off' WHEN character = 'chop' AND volatility IN ('low_vol', 'normal_vol') THEN 'range_trading' WHEN trend = 'bull' AND volatility IN ('low_vol', 'normal_vol') THEN 'trend_following' ELSE 'balanced' END AS cohort FROM l""")
def k03(spark, sf):
    return _routed(spark, sf).select("series_id", "session", "cohort")


def _families(spark, sf, cohorts):
    defaults = table(spark, sf, "region").select(C("r_name").alias("family"), (C("r_regionkey") % 2 == 0).alias("allowed"), (C("r_regionkey") / 10.0).alias("cap"), F.lit("default").alias("reason"))
    over = table(spark, sf, "region").where("r_regionkey < 2").select(F.lit("risk_off").alias("cohort"), C("r_name").alias("family"), F.lit(False).alias("allowed"), F.lit(0.0).alias("cap"), F.lit("risk").alias("reason"))
    return strategy.family_constraints(cohorts, defaults, over)


_FAMILIES = "d AS (SELECT r_name AS family, r_regionkey % 2 = 0 AS allowed, r_regionkey / 10.0 AS cap, r_regionkey AS k FROM region), fam AS (SELECT cohort, family, CASE WHEN cohort = 'risk_off' AND k < 2 THEN false ELSE allowed END AS allowed, CASE WHEN cohort = 'risk_off' AND k < 2 THEN 0.0 ELSE cap END AS cap, CASE WHEN cohort = 'risk_off' AND k < 2 THEN 'risk' WHEN NOT allowed THEN 'default' END AS reason FROM (SELECT DISTINCT cohort FROM co) CROSS JOIN d)"
_COHORTS = ORACLE["k03_cohorts"].replace("SELECT series_id, session, CASE WHEN trend", ", co AS (SELECT series_id, session, CASE WHEN trend") + ")"


@query("k04_family_constraints", f"{_COHORTS}, {_FAMILIES} SELECT * FROM fam")
def k04(spark, sf):
    return _families(spark, sf, _routed(spark, sf))


@query("k05_effective_constraints", f"{_COHORTS}, {_FAMILIES} SELECT session, family, bool_and(allowed) AS allowed, min(cap) AS cap, 'cohort' AS sources FROM co JOIN fam USING (cohort) GROUP BY session, family")
def k05(spark, sf):
    rows = _routed(spark, sf)
    return strategy.effective(rows.select("session", "cohort"), _families(spark, sf, rows), None)


def _stream(spark, df, order: str | None = None, parts: int = 4):
    """`df` as a stream: written to the shared folder once and read from there, so that it grows with the table.

    With `order` it comes in `parts` batches, cut at quantiles of that column and written one after the other.
    """
    from tidemark.plans.folders import shared_folder

    path = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    if order is None:
        df.write.parquet(path)
        return spark.readStream.schema(df.schema).parquet(path)
    seconds = F.unix_micros(order) if dict(df.dtypes)[order] == "timestamp" else C(order)
    cuts = df.select(F.percentile_approx(seconds, [k / parts for k in range(1, parts)])).first()[0] or []
    part = sum((F.when(seconds > c, 1).otherwise(0) for c in cuts), F.lit(0))
    for k in range(parts):
        df.where(part == k).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _ran(stream, mode="append", keys=None):
    from tidemark.plans.folders import shared_folder

    return streams.run_available(stream, f"{shared_folder(stream.sparkSession)}/streamed-{uuid.uuid4().hex}", mode, keys)


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", C("event_type").alias("series_id"), C("ts").cast("timestamp").alias("ts"), "value")


@query("p01_session_bars", "SELECT event_type AS series_id, CAST(ts AS DATE) AS session, arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close, count(*) AS volume FROM events GROUP BY 1, 2")
def p01(spark, sf):
    return _ran(streams.session_bars(_stream(spark, _events(spark, sf), "ts")), "update", ["series_id", "session"])


@query("p02_stream_hysteresis", label_queries.ORACLE["trend_axis"].replace("SELECT series_id, session, label, stable AS", "SELECT series_id, pos, label, stable AS"))
def p02(spark, sf):
    rows = labels(spark, sf).select("series_id", "pos", "label")
    return _ran(streams.stable_labels(_stream(spark, rows), rules.RANKS["trend"], rules.LEAVE["trend"]))


@query("p03_stream_rows_since")
def p03(spark, sf):
    rows = panel.bars_anchor(spark, sf).select("series_id", "pos", (C("close") > 2000).alias("flag"))
    return _ran(streams.rows_since_flag(_stream(spark, rows)))


@query("p04_stream_change_points")
def p04(spark, sf):
    rows = features(spark, sf).where("ret1 IS NOT NULL").select("series_id", "pos", F.log1p(F.abs("ret1")).alias("x"))
    return _ran(streams.change_points(_stream(spark, rows))).withColumn("change_point", F.round("change_point", 6))


@query("p05_stream_deduplicated", "SELECT user_id, event_type AS series_id, CAST(ts AS DATE) AS session FROM events GROUP BY 1, 2, 3")
def p05(spark, sf):
    rows = table(spark, sf, "events").select("user_id", C("event_type").alias("series_id"), F.to_date("ts").alias("session"), C("ts").cast("timestamp").alias("ts"))
    return _ran(streams.last_written(_stream(spark, rows, "ts"), ["user_id", "series_id", "session"], "1 day")).select("user_id", "series_id", "session")


@query("p05_corrected_bars", "SELECT event_type AS series_id, CAST(ts AS DATE) AS session, max(event_id) AS version, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2")
def p05_corrected(spark, sf):
    rows = table(spark, sf, "events").select(C("event_type").alias("series_id"), F.to_date("ts").alias("session"), C("ts").cast("timestamp").alias("ts"), C("event_id").alias("version"), "value")
    return streams.standing(_ran(streams.corrected(_stream(spark, rows, "ts"))))


@query("p06_stream_publication_gate", f"{ctes('sessions', 'macro')}, m AS (SELECT series_id, published, value FROM macro WHERE vintage = 0 AND value IS NOT NULL), g AS (SELECT s.session, n.series_id FROM sessions s, (SELECT DISTINCT series_id FROM m) n) SELECT g.series_id, g.session, m.published, m.value FROM g ASOF LEFT JOIN m ON g.series_id = m.series_id AND g.session >= m.published")
def p06(spark, sf):
    readings = panel.macro(spark, sf).where("vintage = 0 AND value IS NOT NULL").select("series_id", C("published").alias("at"), "value", F.lit(False).alias("is_session"))
    days = panel.sessions(spark, sf).agg(F.collect_list("session").alias("days"))  # one row: a calendar has a few thousand sessions
    clock = readings.select("series_id").distinct().join(F.broadcast(days)).select("series_id", F.explode("days").alias("at"), F.lit(None).cast("double").alias("value"), F.lit(True).alias("is_session"))
    return _ran(streams.published_only(_stream(spark, readings.union(clock))))


ORACLE["p03_stream_rows_since"] = f"{ctes('bars')} SELECT series_id, pos, close > 2000 AS flag, pos - max(CASE WHEN close > 2000 THEN pos END) OVER w AS since, count(*) FILTER (close > 2000) OVER w AS flags FROM bars WINDOW w AS (PARTITION BY series_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
