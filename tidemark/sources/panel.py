"""Panels of daily series from order, line item and event tables.

Each function reads only the columns it needs; SQL gives the same tables for DuckDB, as common
table expressions to be prefixed to a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bars(lines: DataFrame) -> DataFrame:
    """Daily bars by series_id: one shuffle, partial aggregates before it."""
    price, order = F.col("l_extendedprice") / F.col("l_quantity"), F.struct(*ORDER)
    lines = lines.withColumn("session", F.to_date("l_shipdate")).where(F.weekday("session") < 5)
    return lines.groupBy("series_id", "session").agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.sum("l_quantity").cast("long").alias("volume"),
    )


def bars_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of one series for each return flag, with `pos`, the row number in the series."""
    bars = _bars(table(spark, sf_dir, "lineitem").withColumn("series_id", F.col("l_returnflag")))
    return bars.withColumn("pos", F.row_number().over(Window.partitionBy("series_id").orderBy("session")).cast("long"))


def bars_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the whole market, series 'ALL', and of each return flag, with `pos`; each line counts for two series."""
    lines = table(spark, sf_dir, "lineitem").withColumn("series_id", F.explode(F.array(F.lit("ALL"), "l_returnflag")))
    return _bars(lines).withColumn("pos", F.row_number().over(Window.partitionBy("series_id").orderBy("session")).cast("long"))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What market, member and session tables have in common, from one reading of the lines: (flag, nations, session) with the
    first and last line, extremes and volume. Its size follows the calendar, not the lines. `nations`: those of the line's supplier,
    once for each of its rows; null without one."""
    nation = F.sort_array(F.collect_list(F.struct(F.col("s_nationkey").cast("string").alias("nation"))))
    nations = table(spark, sf_dir, "supplier").where("s_suppkey IS NOT NULL").groupBy(F.col("s_suppkey").alias("l_suppkey")).agg(nation.alias("nations"))
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, sf_dir, "lineitem").withColumn("session", F.to_date("l_shipdate")).where(F.weekday("session") < 5)
    line = F.struct(*ORDER, price.alias("price"))
    return lines.join(nations, "l_suppkey", "left").groupBy(F.col("l_returnflag").alias("flag"), "nations", "session").agg(
        F.min(line).alias("first"), F.max(price).alias("high"), F.min(price).alias("low"), F.max(line).alias("last"), F.sum("l_quantity").alias("volume"),
    )


def _merged(rows: DataFrame) -> DataFrame:
    """Daily bars by series_id from `parts`."""
    return rows.groupBy("series_id", "session").agg(
        F.min("first")["price"].alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max("last")["price"].alias("close"), F.sum("volume").cast("long").alias("volume"),
    )


def market_of(parts: DataFrame) -> DataFrame:
    """`bars_market` from `parts`."""
    bars = _merged(parts.withColumn("series_id", F.explode(F.array(F.lit("ALL"), "flag"))))
    return bars.withColumn("pos", F.row_number().over(Window.partitionBy("series_id").orderBy("session")).cast("long"))


def members_of(parts: DataFrame) -> DataFrame:
    """`bars_member` from `parts`."""
    return _merged(parts.withColumn("series_id", F.explode("nations.nation")))


def market_sessions_of(parts: DataFrame) -> DataFrame:
    """`market_sessions` from `parts`."""
    return parts.select("session").distinct().withColumn("pos", F.row_number().over(Window.orderBy("session")).cast("long"))


def market_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekdays of all lines with their ordinal; a market-level table of a few thousand rows."""
    days = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("session")).where(F.weekday("session") < 5).distinct()
    return days.withColumn("pos", F.row_number().over(Window.orderBy("session")).cast("long"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dates of series 'A' with their ordinal; a market-level table of a few thousand rows."""
    days = table(spark, sf_dir, "lineitem").where("l_returnflag = 'A'").select(F.to_date("l_shipdate").alias("session")).where(F.weekday("session") < 5).distinct()
    return days.withColumn("pos", F.row_number().over(Window.orderBy("session")).cast("long"))


def bars_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of one series for each supplier nation."""
    nations = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("string").alias("series_id"))
    return _bars(table(spark, sf_dir, "lineitem").join(nations, "l_suppkey"))


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(series_id, start, end) for each nation; a null end is open."""
    first = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey").agg(F.min(F.to_date("o_orderdate")).alias("first"))
    start = F.date_add("first", F.col("c_nationkey") * 20)
    return first.select(F.col("c_nationkey").cast("string").alias("series_id"), start.alias("start"), F.when(F.col("c_nationkey") % 3 != 0, F.date_add(start, 1500)).alias("end"))


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly mean order values by priority, in two vintages: (series_id, obs_date, value, published, vintage)."""
    month, half = F.trunc("o_orderdate", "MM"), (F.col("o_orderkey") % 2).cast("long")
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("series_id"), month.alias("obs_date"), half.alias("vintage")).agg(F.round(F.avg("o_totalprice"), 6).alias("value"))
    return rows.withColumn("published", F.date_add(F.add_months("obs_date", 1), (F.lit(9) + F.col("vintage") * 30).cast("int")))


def events_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event for each date and type, published 90 days before: (date, type, publication_date)."""
    kinds = F.create_map(*(F.lit(x) for pair in EVENT_TYPES.items() for x in pair))
    rows = table(spark, sf_dir, "events").select(F.date_add(F.lit("1996-01-01").cast("date"), (F.col("event_id") % 1500).cast("int")).alias("date"), F.element_at(kinds, F.col("event_type")).alias("type")).where("type IS NOT NULL").distinct()
    return rows.withColumn("publication_date", F.date_sub("date", 90))


EVENT_TYPES = {"signup": "FOMC", "purchase": "CPI", "view": "NFP", "click": "election", "error": "geopolitical_event"}

_KEY = "row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"


def _bars_sql(name: str, series: str, source: str) -> str:
    return f"""{name}_raw AS (
  SELECT {series} AS series_id, CAST(l_shipdate AS DATE) AS session, arg_min(l_extendedprice / l_quantity, {_KEY}) AS open, max(l_extendedprice / l_quantity) AS high,
    min(l_extendedprice / l_quantity) AS low, arg_max(l_extendedprice / l_quantity, {_KEY}) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM {source} WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5 GROUP BY 1, 2),
{name} AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY session) AS pos FROM {name}_raw)"""


SQL = {
    "bars": _bars_sql("bars", "l_returnflag", "lineitem"),
    "market": _bars_sql("market", "series", "(SELECT *, unnest(['ALL', l_returnflag]) AS series FROM lineitem)"),
    "market_sessions": "market_sessions AS (SELECT session, row_number() OVER (ORDER BY session) AS pos FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS session FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5))",
    "members": _bars_sql("members", "CAST(s_nationkey AS VARCHAR)", "lineitem JOIN supplier ON l_suppkey = s_suppkey"),
    "sessions": "sessions AS (SELECT session, row_number() OVER (ORDER BY session) AS pos FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS session FROM lineitem WHERE l_returnflag = 'A' AND dayofweek(l_shipdate) BETWEEN 1 AND 5))",
    "membership": """membership AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS series_id, CAST(first + c_nationkey * 20 AS DATE) AS start, CASE WHEN c_nationkey % 3 <> 0 THEN CAST(first + c_nationkey * 20 + 1500 AS DATE) END AS "end"
  FROM (SELECT c_nationkey, min(CAST(o_orderdate AS DATE)) AS first FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1))""",
    "macro": """macro AS (
  SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS obs_date, CAST(o_orderkey % 2 AS BIGINT) AS vintage, round(avg(o_totalprice), 6) AS value,
    CAST(CAST(date_trunc('month', o_orderdate) AS DATE) + INTERVAL 1 MONTH AS DATE) + CAST(9 + (o_orderkey % 2) * 30 AS INT) AS published
  FROM orders GROUP BY 1, 2, 3, 5)""",
    "cal": f"""cal AS (
  SELECT DISTINCT DATE '1996-01-01' + CAST(event_id % 1500 AS INT) AS date, CASE event_type {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in EVENT_TYPES.items())} END AS type, DATE '1996-01-01' + CAST(event_id % 1500 AS INT) - 90 AS publication_date
  FROM events WHERE event_type IN ({', '.join(f"'{a}'" for a in EVENT_TYPES)}))""",
}


def ctes(*names: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(SQL[n] for n in names)
