"""Readers and writers of panels: typed, with NaN as null."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BARS = "series_id string, session date, open double, high double, low double, close double, volume bigint"


def read_table(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None) -> DataFrame:
    """A Parquet, ORC, CSV or JSON table; NaN becomes null in every double or float column."""
    reader = spark.read.format(kind)
    if schema:
        reader = reader.schema(schema)
    if kind == "csv":
        reader = reader.option("header", "true")
    df = reader.load(path)
    floats = [name for name, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_bars(spark: SparkSession, path: str, series: list[str] | None = None) -> DataFrame:
    """Bars of a tree partitioned by series_id; a subset prunes partitions."""
    df = read_table(spark, path)
    return df.where(F.col("series_id").isin(series)) if series else df


def read_members(spark: SparkSession, path: str, series: DataFrame) -> DataFrame:
    """Bars of a tree partitioned by series_id for the names in `series` (series_id): only their folders are read, found as the query runs."""
    return read_table(spark, path, schema=BARS).join(series.select("series_id").distinct(), "series_id", "left_semi")


def write_bars(bars: DataFrame, path: str) -> None:
    """One folder for each series, one file for each: rows of a series are brought together first."""
    bars.repartition("series_id").sortWithinPartitions("session").write.mode("overwrite").partitionBy("series_id").parquet(path)


def macro_long(rows: DataFrame) -> DataFrame:
    """Long macro rows under their logical name where there is one; values that are no numbers are null.

    Volatility quoted in percent is brought to a fraction.
    """
    value = F.expr("try_cast(value AS double)")
    name = F.coalesce("logical_name", "series_id")
    return rows.withColumn("name", name).withColumn("value", F.when(name == "implied_vol_30d", value / 100).otherwise(value))


def vendor_bars(rows: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """Vendor bars under our names: timestamps to dates, adjusted_close from close where it is absent."""
    df = rows.withColumnsRenamed(renamed)
    if "adjusted_close" not in df.columns:
        df = df.withColumn("adjusted_close", F.col("close"))
    return df.withColumn("session", F.to_date("session"))


def two_columns(rows: DataFrame, date: str, value: str, source: str) -> DataFrame:
    """A dated index with provenance: rows without a date or number are dropped."""
    out = rows.select(F.expr(f"try_cast({date} AS date)").alias("date"), F.expr(f"try_cast({value} AS double)").alias("value"))
    return out.na.drop().withColumn("source", F.lit(source))
