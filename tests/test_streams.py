"""Results of streams, and aggregates over users, stay off the driver and out of one task."""

from tidemark.plans import registry


def test_stream_rows_are_read_from_files(spark, sf):
    rows = registry.QUERIES["p05_stream_deduplicated"](spark, sf)
    want = spark.read.parquet(f"{sf}/events.parquet").selectExpr("user_id", "event_type", "to_date(ts)").distinct()
    assert rows.inputFiles() and rows.count() == want.count()
    assert rows.exceptAll(want).count() == 0


def test_last_points_are_aggregated_partially(spark, sf):
    plan = registry.QUERIES["o07_nested_points"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_max_by" in plan
