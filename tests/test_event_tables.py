"""Corroboration, promotion, tables with odd headers, corrected streams and the pruned tree, by hand-made cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import event_tables as E
from tidemark.streaming import bars as streams

D = datetime.date


def documents(spark, rows):
    return spark.createDataFrame(rows, "id long, issuer string, kind string, title string, date date")


def test_verdicts_follow_the_nearest_decision(spark):
    docs = documents(spark, [
        (5, "The European Central Bank", None, "Monetary policy DECISION", D(2020, 3, 12)), (2, "ECB", "statement", "b", D(2020, 3, 12)), (9, "ecb", "speech", "on the decision", D(2020, 5, 1)),
        (7, "Bank of England", "minutes", None, D(2020, 6, 2)), (8, None, "decision", "none", D(2020, 6, 1)), (3, "ecb", "decision", "undated", None),
    ])
    candidates = spark.createDataFrame([("ECB_decision", D(2020, 3, 12)), ("ECB_decision", D(2020, 3, 13)), ("ECB_decision", D(2020, 3, 14)), ("ECB_decision", D(2020, 5, 1)), ("BOE_decision", D(2020, 6, 1)), ("CPI", D(2020, 6, 1))], "type string, date date")
    got = {(r["type"], r["date"]): (r["verdict"], r["evidence_id"]) for r in E.corroborated(candidates, E.decision_documents(docs)).collect()}
    assert got == {
        ("ECB_decision", D(2020, 3, 12)): ("confirm", 2), ("ECB_decision", D(2020, 3, 13)): ("contradict", 2), ("ECB_decision", D(2020, 3, 14)): ("unknown", None),
        ("ECB_decision", D(2020, 5, 1)): ("unknown", None), ("BOE_decision", D(2020, 6, 1)): ("contradict", 7),
    }


def test_a_day_with_most_documents_is_one_row_before_the_join(spark):
    docs = documents(spark, [(k, "ecb", "decision", f"t{k}", D(2020, 3, 12)) for k in range(3000)])
    found = E.decision_documents(docs)
    assert [tuple(r) for r in found.collect()] == [("ECB_decision", D(2020, 3, 12), (0, "t0"))]
    candidates = spark.createDataFrame([("ECB_decision", D(2020, 3, 12))] * 2000, "type string, date date")
    assert E.corroborated(candidates, found).where("verdict = 'confirm' AND evidence_id = 0").count() == 2000


def test_conflicting_approvals_supersede_by_time(spark):
    when = datetime.datetime(2020, 1, 8, 8, 30)
    candidates = spark.createDataFrame([("CPI", D(2020, 1, 8), 1, 1, "US", "high", "old", 1, when), ("CPI", D(2020, 1, 8), 2, 2, "US", "medium", "new", 2, None), ("NFP", D(2020, 1, 9), 3, 1, "US", "high", "s", 0, when), ("FOMC", D(2020, 1, 10), 4, 1, "US", "high", "s", 0, when)], "type string, date date, id long, at long, market string, importance string, source string, window_days long, release timestamp_ntz")
    decisions = spark.createDataFrame([("CPI", D(2020, 1, 8), 1, 1, "quarantine"), ("CPI", D(2020, 1, 8), 2, 2, "promote"), ("NFP", D(2020, 1, 9), 3, 1, "promote"), ("NFP", D(2020, 1, 9), 4, 1, "quarantine"), ("FOMC", D(2020, 1, 10), 5, 1, "promote"), ("GDP", D(2020, 1, 10), 6, 1, "promote")], "type string, date date, id long, at long, outcome string")
    approvals = spark.createDataFrame([("CPI", D(2020, 1, 8), 1, 5, "critical", 9, "old_label"), ("CPI", D(2020, 1, 8), 2, 6, "", 0, "label"), ("CPI", D(2020, 1, 8), 3, None, "low", 4, "never")], "type string, date date, id long, at long, importance string, window_days long, label string")
    got = {r["type"]: tuple(r)[2:] for r in E.promoted(candidates, decisions, approvals).collect()}
    assert got == {
        "CPI": (datetime.datetime(2020, 1, 8), "US", "medium", "new", 0, "label", "candidate", "approval"),
        "FOMC": (when, "US", "high", "s", 0, None, "candidate", "candidate"),
    }


def test_headers_in_any_case_doubled_and_missing(spark):
    raw = spark.createDataFrame([("2020-01-01", "1.5", "7", "x"), ("bad", "nan?", "8", None), ("2020-01-03", " 2 ", "9", "y")], "` DATE ` string, GPRD string, gpr_Threat string, Event string")
    rows = E.index_table(raw).orderBy("value").collect()
    assert [(r["date"], r["value"], r["threat"], r["act"], r["event"], r["bad"]) for r in rows] == [(D(2020, 1, 1), 1.5, 7.0, None, "x", []), (D(2020, 1, 3), 2.0, 9.0, None, "y", [])]
    doubled = spark.createDataFrame([("2020-01-01", "1", "2")], "day string, gpr string, value string").toDF("day", "GPR", "gpr")
    assert E.index_table(doubled).first()["value"] == 2.0
    with pytest.raises(ValueError, match="value"):
        E.index_table(raw.drop("GPRD"))
    bad = E.typed(E.resolved(raw, E.INDEX_COLUMNS, ()), {"date": "date", "value": "double"}).select("bad").collect()
    assert [r["bad"] for r in bad] == [[], ["date", "value"], []]
    counts = spark.createDataFrame([("2020-01-01", "3", None), ("2020-01-02", "0", "t"), ("2020-01-03", "-1", "t"), ("2020-01-04", None, "t")], "Date string, COUNT string, Dominant_Theme string")
    assert [(r["event_count"], r["dominant_theme"]) for r in E.volume_table(counts).collect()] == [(3, None)]
    assert E.volume_table(counts.drop("Dominant_Theme")).first()["dominant_theme"] == E.THEME
    assert E.index_table(raw.where("false")).count() == 0


def test_monthly_context_takes_the_largest_positive_cells(spark):
    wide = spark.createDataFrame([("2020-01-05", 1.0, 3.0, None, 3.0, 9.0, 1), ("2020-01-20", 2.0, 5.005, -4.0, 5.005, 9.0, 2), ("2020-02-01", -1.0, None, 0.0, None, 9.0, 3), ("x", 1.0, 1.0, 1.0, 1.0, 1.0, 4)], "Month string, gprc_usa double, GPRC_CHN double, GPRC_DEU double, `GPRC_A.B` double, GPRHC_USA double, at int")
    long = E.prefixed_long(wide, "GPRC_", {"month": ("month", "date")}, order="at")
    dates = spark.createDataFrame([(D(2020, 1, 1),), (D(2020, 1, 31),), (D(2020, 2, 2),), (None,)], "date date")
    got = {r["date"]: r["context"] for r in E.monthly_context(dates, long, 2).collect()}
    assert got == {d: "monthly_country_gpr=CHN:5.01,A.B:5.01" for d in (D(2020, 1, 1), D(2020, 1, 31))}
    with pytest.raises(ValueError, match="OTHER_"):
        E.prefixed_long(wide, "OTHER_", {"month": ("month",)})


CORRECTIONS = "series_id string, session date, ts timestamp, version long, value double"


def test_corrected_rows_retract_what_they_supersede_and_late_ones_are_dropped(spark, tmp_path):
    at = lambda d, h: datetime.datetime(2020, 1, d, h)
    batches = [
        [("a", D(2020, 1, 1), at(1, 9), 1, 10.0), ("a", D(2020, 1, 1), at(1, 10), 2, 11.0), ("b", D(2020, 1, 1), at(1, 9), 1, 5.0)],
        [("a", D(2020, 1, 1), at(2, 9), 2, 99.0), ("a", D(2020, 1, 1), at(2, 10), 3, 12.0), ("b", D(2020, 1, 2), at(2, 9), 1, 6.0)],
        [("b", D(2020, 1, 9), at(9, 9), 1, 7.0)],
        [("a", D(2020, 1, 1), at(1, 11), 4, 13.0), ("b", D(2020, 1, 9), at(9, 10), 2, 8.0)],
        [("b", D(2020, 1, 20), at(20, 9), 1, 1.0)],
    ]
    source = str(tmp_path / "rows")
    for rows in batches:
        spark.createDataFrame(rows, CORRECTIONS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(CORRECTIONS).option("maxFilesPerTrigger", 1).parquet(source)
    changes = streams.run_available(streams.corrected(stream), str(tmp_path / "out"))
    got = sorted((r["series_id"], str(r["session"]), r["version"], r["value"], r["op"]) for r in changes.collect())
    assert got == [
        ("a", "2020-01-01", 2, 11.0, "insert"), ("a", "2020-01-01", 2, 11.0, "retract"), ("a", "2020-01-01", 3, 12.0, "insert"), ("b", "2020-01-01", 1, 5.0, "insert"), ("b", "2020-01-02", 1, 6.0, "insert"),
        ("b", "2020-01-09", 1, 7.0, "insert"), ("b", "2020-01-09", 1, 7.0, "retract"), ("b", "2020-01-09", 2, 8.0, "insert"), ("b", "2020-01-20", 1, 1.0, "insert"),
    ]
    assert sorted((r["series_id"], r["version"]) for r in streams.standing(changes).collect()) == [("a", 3), ("b", 1), ("b", 1), ("b", 1), ("b", 2)]


def test_a_window_of_two_batches_gives_one_bar(spark, tmp_path):
    at = lambda h: datetime.datetime(2020, 1, 1, h)
    schema = "event_id long, series_id string, ts timestamp, value double"
    source = str(tmp_path / "events")
    for rows in ([(1, "a", at(9), 10.0), (2, "a", at(10), 14.0)], [(3, "a", at(11), 8.0), (4, "b", at(11), 1.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    got = streams.run_available(streams.session_bars(stream), str(tmp_path / "out"), "update", ["series_id", "session"])
    assert sorted(tuple(r)[0:1] + tuple(r)[2:] for r in got.collect()) == [("a", 10.0, 14.0, 8.0, 8.0, 3), ("b", 1.0, 1.0, 1.0, 1.0, 1)]


def test_the_tree_is_pruned_as_the_query_runs(spark, tmp_path):
    from tidemark.sources import readers

    rows = [(f"s{k}", D(2020, 1, 1 + d), 1.0, 2.0, 0.5, 1.5, 10) for k in range(8) for d in range(5)]
    path = str(tmp_path / "bars")
    readers.write_bars(spark.createDataFrame(rows, readers.BARS), path)
    wanted = spark.createDataFrame([("s1", 1), ("s6", 1), ("s2", 0)], "series_id string, use int")
    wanted.write.parquet(str(tmp_path / "wanted"))
    chosen = spark.read.parquet(str(tmp_path / "wanted")).where("use = 1")
    got = readers.read_members(spark, path, F.broadcast(chosen))
    plan = got._jdf.queryExecution().executedPlan()
    assert got.count() == 10 and "dynamicpruning" in plan.toString().lower()
