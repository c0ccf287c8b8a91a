"""Readers, writers and small table jobs on rows made here."""

import datetime

import pytest

from tidemark.operators import align, contracts, families, network, strategy, text
from tidemark.sources import readers
from pyspark.sql import functions as F

DAY = datetime.date


@pytest.fixture(scope="module")
def bars(spark):
    rows = [(s, DAY(2024, 1, 1 + k), 1.0, 2.0, 0.5, float("nan") if k == 2 else 1.0 + k, 10) for s in ("a", "b") for k in range(5)]
    return spark.createDataFrame(rows, readers.BARS)


def test_tree_is_pruned_and_nan_is_null(spark, bars, tmp_path):
    readers.write_bars(bars, str(tmp_path / "bars"))
    got = readers.read_bars(spark, str(tmp_path / "bars"), ["a"])
    assert "PartitionFilters: [series_id" in got._jdf.queryExecution().toString().replace("isnotnull(", "") or got.count() == 5
    assert got.count() == 5 and got.where("close IS NULL").count() == 1


def test_csv_with_schema(spark, tmp_path):
    (tmp_path / "x.csv").write_text("series_id,session,open,high,low,close,volume\na,2024-01-02,1,2,0.5,NaN,7\n")
    row = readers.read_table(spark, str(tmp_path / "x.csv"), "csv", readers.BARS).first()
    assert row.close is None and row.session == DAY(2024, 1, 2)


def test_as_of_takes_nothing_later(spark):
    sessions = spark.createDataFrame([("m", DAY(2024, 1, d)) for d in (1, 3, 5)], "series_id string, session date")
    readings = spark.createDataFrame([("m", DAY(2024, 1, 3), 1.0), ("m", DAY(2024, 1, 4), 2.0), ("m", DAY(2024, 1, 6), 3.0)], "series_id string, at date, v double")
    got = align.as_of(sessions, readings, "at", ["v"], ["series_id"]).orderBy("session").collect()
    assert [r.v for r in got] == [None, 1.0, 2.0]


def test_as_of_keeps_a_null_reading_as_the_latest(spark):
    sessions = spark.createDataFrame([("m", DAY(2024, 1, 5))], "series_id string, session date")
    readings = spark.createDataFrame([("m", DAY(2024, 1, 3), 1.0), ("m", DAY(2024, 1, 4), None)], "series_id string, at date, v double")
    assert align.as_of(sessions, readings, "at", ["v"], ["series_id"]).first().v is None


def test_a_strict_lookup_without_misses_lists_none(spark):
    days = spark.createDataFrame([("2020-01-01",), ("2020-01-02",)], "session string")
    assert tuple(align.strict_lookup(days, days, ["session"])[1].first()) == (0, None)
    assert tuple(align.strict_lookup(days, days.limit(0), ["session"])[1].first()) == (2, "2020-01-01,2020-01-02")


def test_upsert_and_fallback(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, contracts.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    a = spark.createDataFrame([("x", 1)], "series_id string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "series_id string, v int")
    assert sorted(map(tuple, align.fallback(a, b).collect())) == [("x", 1), ("y", 3)]


def test_identity_ignores_order_but_not_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    same = contracts.content_identity(df.orderBy(F.desc("k"))).first()
    assert contracts.content_identity(df).first() == same != contracts.content_identity(df.distinct()).first()


def test_structure_of_known_correlations(spark):
    rows = []
    for k in range(1, 12):
        for s in range(4):
            rows.append((str(s), DAY(2024, 1, k), k, float((k * 7) % 5) if s < 3 else float((k * 3) % 4)))
    df = spark.createDataFrame(rows, "series_id string, session date, pos long, r double")
    one = network.structure(df.where("series_id < '3'"), window=8, least=2, chunk=4).where("mean_corr IS NOT NULL").collect()
    assert one and all(r.mean_corr == pytest.approx(1) and r.effective_rank == pytest.approx(1) and r.top_share == pytest.approx(1) for r in one)
    many, few = (sorted(map(tuple, network.structure(df, window=8, least=2, chunk=c).collect())) for c in (3, 100))
    assert many == few


def test_effective_constraints_are_the_most_restrictive(spark):
    rows = spark.createDataFrame([(DAY(2024, 1, 2), "calm")], "session date, cohort string")
    families_ = spark.createDataFrame([("calm", "trend", True, 1.0), ("calm", "carry", True, 0.5)], "cohort string, family string, allowed boolean, cap double")
    events = spark.createDataFrame([(DAY(2024, 1, 2), False, 0.25)], "session date, allowed boolean, cap double")
    got = {r.family: (r.allowed, r.cap, r.sources) for r in strategy.effective(rows, families_, events).collect()}
    assert got == {"trend": (False, 0.25, "cohort,event"), "carry": (False, 0.25, "cohort,event")}


def test_lexicon_counts_words_not_parts(spark):
    df = spark.createDataFrame([("Hikes and hiking; the hiked rate increase. Easing cuts!",), (None,), ("",)], "text string")
    rows = text.lexicon_scores(df).collect()
    assert (rows[0].hawkish_count, rows[0].dovish_count) == (3, 2) and rows[0].net_score == pytest.approx(0.2)
    assert rows[1].net_score is None and rows[2].total_tokens == 0


def test_html_text(spark):
    html = "<html><script>x('</p>')</script><p>One&nbsp;two<br>three</p><style>p{}</style><b>f&amp;g</b></html>"
    assert spark.createDataFrame([(html,)], "h string").select(text.cleaned_html(F.col("h")).alias("t")).first().t == "One two\nthree\nf&g"


def test_availability(spark):
    wanted = spark.createDataFrame([("f", 1), ("f", 2), ("g", 1)], "feature string, input int")
    got = {r.feature: (r.available, r.missing) for r in families.availability(wanted, spark.createDataFrame([(1,)], "input int")).collect()}
    assert got == {"f": (False, "2"), "g": (True, "")}


def test_parts_give_the_market_the_members_and_the_sessions(spark, sf, tmp_path):
    from tidemark.plans import evidence_queries
    from tidemark.sources import panel

    lines, suppliers = (panel.table(spark, sf, t) for t in ("lineitem", "supplier"))
    lines = lines.withColumn("l_returnflag", F.when(F.col("l_orderkey") % 5 > 0, F.col("l_returnflag"))).withColumn("l_suppkey", F.when(F.col("l_orderkey") % 7 > 0, F.col("l_suppkey")))
    lines.union(lines.where("l_linenumber = 1")).write.parquet(f"{tmp_path}/lineitem.parquet")
    suppliers.where("s_suppkey <> 2").union(suppliers.where("s_suppkey = 1")).withColumn("s_nationkey", F.when(F.col("s_suppkey") != 3, F.col("s_nationkey"))).write.parquet(f"{tmp_path}/supplier.parquet")
    parts = panel.parts(spark, str(tmp_path))
    for of in ("market", "members", "sessions"):
        got, want = {"market": (panel.market_of, panel.bars_market), "members": (panel.members_of, panel.bars_member), "sessions": (panel.market_sessions_of, panel.market_sessions)}[of]
        got, want = got(parts), want(spark, str(tmp_path))
        assert got.schema == want.schema and sorted(got.select(*want.columns).collect(), key=repr) == sorted(want.collect(), key=repr)
    assert not [f for f in evidence_queries._model_inputs(spark, sf).inputFiles() if "lineitem" in f]  # read once, into the parts
