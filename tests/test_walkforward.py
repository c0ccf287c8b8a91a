"""Walk-forward models: planted parameters, likelihoods, rejection, assignments, blocks against single fits, maps of labels."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import walkforward as W

MEANS = np.array([[0, 0, 0, 0, 0], [3, 0, 1, 0, 0], [0, 3, 0, 2, 0], [-3, 0, 0, 0, 3.0]])


def planted(n, seed, stay=0.94):
    """A path of four states and noisy observations with correlated inputs."""
    rng = np.random.default_rng(seed)
    moves = np.full((4, 4), (1 - stay) / 3) + np.eye(4) * (stay - (1 - stay) / 3)
    path = [0]
    for _ in range(n - 1):
        path.append(int(rng.choice(4, p=moves[path[-1]])))
    mix = np.eye(5) + 0.4 * np.eye(5, k=1)
    return MEANS[path] + rng.normal(0, 0.7, (n, 5)) @ mix, np.array(path)


def test_markov_finds_planted_means_moves_and_covariance():
    x, path = planted(1260, 1)
    fit = W.markov(x[None], 4, list(range(10)), of=np.zeros(10, int))
    alone = W.markov(np.stack([x] * 10), 4, list(range(10)))
    assert np.allclose(fit.likelihood, alone.likelihood)
    best = int(np.argmax(np.where(fit.rejected, -np.inf, fit.likelihood)))
    order = W.assignment(np.sqrt(((MEANS[:, None] - fit.means[best][None]) ** 2).sum(2)))
    assert np.abs(fit.means[best][order] - MEANS).max() < 0.3
    assert np.abs(np.diag(fit.moves[best])[order] - 0.94).max() < 0.04
    mix = 0.7 * (np.eye(5) + 0.4 * np.eye(5, k=1))
    assert np.abs(fit.covariances[best][order] - mix.T @ mix).max() < 0.3
    states = W.posteriors(x[None], fit.only(np.array([best])))[0].argmax(1)
    assert (np.argsort(order)[states] == path).mean() > 0.95


def plain_log_likelihood(x, weights, means, covariances, moves):
    """The forward recursion row by row in logs, from the definition of the density."""
    total = None
    for t, row in enumerate(x):
        dense = np.array([-0.5 * ((row - m) @ np.linalg.inv(c) @ (row - m) + np.log(np.linalg.det(2 * np.pi * c))) for m, c in zip(means, covariances)])
        total = np.log(weights) + dense if t == 0 else np.array([np.logaddexp.reduce(total + np.log(moves[:, j])) for j in range(len(means))]) + dense
    return np.logaddexp.reduce(total)


def test_likelihood_and_distances_equal_plain_versions():
    x, _ = planted(80, 3)
    fit = W.markov(x[None], 4, [5], rounds=3)
    dense, tops = W.scaled_densities(x[None], np.zeros(1, int), fit)
    _, scales = W.forward(dense, fit.weights, fit.moves)
    assert (np.log(scales) + tops).sum() == pytest.approx(plain_log_likelihood(x, fit.weights[0], fit.means[0], fit.covariances[0], fit.moves[0]), rel=1e-9)
    got = W.distances(x[None], np.zeros(1, int), fit.means, fit.covariances)[0][0].T
    want = np.array([[(r - m) @ np.linalg.inv(c) @ (r - m) for m, c in zip(fit.means[0], fit.covariances[0])] for r in x])
    assert np.allclose(got, want)


def test_likelihoods_never_fall():
    x = np.stack([planted(300, s)[0] for s in range(6)])
    for make in (lambda r: W.markov(x, 4, [1] * 6, r, gain=-np.inf), lambda r: W.mixture(x, 3, [1] * 6, r)):
        short, long = make(8), make(20)
        assert not short.rejected.any() and (long.likelihood >= short.likelihood - 1e-6 * np.abs(short.likelihood)).all()


def test_a_falling_seed_is_rejected_and_others_stay(monkeypatch):
    """One member of the batch gets wrong moments in a later round: it alone is rejected."""
    x = np.stack([planted(200, 1)[0]] * 3)
    right, calls = W.moments, []

    def wrong(wide, of, r):
        n, means, covariances = right(wide, of, r)
        calls.append(1)
        if len(calls) == 3:
            means[1] += 5
        return n, means, covariances

    monkeypatch.setattr(W, "moments", wrong)
    fit = W.markov(x, 4, [1, 2, 3], rounds=10, gain=-np.inf)
    assert fit.rejected.tolist() == [False, True, False]


def test_an_empty_component_starts_anew():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 0.1, (60, 2)), rng.normal(5, 0.1, (3, 2))])[None]
    fit = W.mixture(x, 4, [0])
    assert np.isfinite(fit.likelihood).all() and (fit.weights > 0).all() and np.isfinite(fit.means).all()


def test_filtered_probabilities_read_nothing_later():
    x, _ = planted(120, 2)
    fit = W.markov(x[None], 4, [1], rounds=5)
    assert np.allclose(W.posteriors(x[None], fit)[0, :70], W.posteriors(x[None, :70], fit)[0])


def test_assignment_is_the_cheapest_of_all_orders():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = int(rng.integers(1, 7))
        cost = rng.integers(0, 5, (n, n)).astype(float) if rng.random() < 0.5 else rng.random((n, n))
        got = W.assignment(cost)
        assert sorted(got) == list(range(n))
        assert sum(cost[i, j] for i, j in enumerate(got)) == pytest.approx(min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(n))))


@pytest.fixture(scope="module")
def panel(spark):
    """Two series of four states; a third is too short, and has nulls and values that are not finite."""
    rows = []
    for name, seed, n in (("a", 1, 150), ("b", 2, 131), ("c", 3, 70)):
        for k, v in enumerate(planted(n, seed)[0]):
            v = [None if name == "c" and k % 9 == 0 else float("nan") if name == "c" and k % 9 == 1 else float(y) for y in v]
            rows.append((name, k, *v))
    df = spark.createDataFrame(rows, "series_id string, pos long, v0 double, v1 double, v2 double, v3 double, v4 double")
    return df.withColumn("session", F.date_add(F.lit("2020-01-01").cast("date"), F.col("pos").cast("int")))


COLUMNS = ["v0", "v1", "v2", "v3", "v4"]


def test_complete_cases_are_numbered(panel):
    rows = W.complete(panel, COLUMNS)
    got = {r["series_id"]: (r["n"], r["low"], r["high"]) for r in rows.groupBy("series_id").agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).collect()}
    assert got == {"a": (150, 1, 150), "b": (131, 1, 131), "c": (54, 1, 54)}


@pytest.mark.parametrize("block", [1, 3])
def test_blocks_have_the_rows_of_their_checkpoints_and_score_each_session_once(panel, block):
    rows = W.complete(panel, COLUMNS)
    want = {(r["series_id"], r["checkpoint"]): (r["checkpoint"], r["until"]) for r in W.schedule(rows, 60, 20).collect()}
    fits = W.fitted(rows, COLUMNS, 3, [1, 2], 60, 20, hidden=True, block=block, rounds=15).collect()
    assert {(r["series_id"], r["checkpoint"]) for r in fits} == set(want)
    days = {(r["series_id"], r["k"]): r["session"] for r in rows.collect()}
    for r in fits:
        low, until = want[r["series_id"], r["checkpoint"]]
        assert r["session"] == [days[r["series_id"], k] for k in range(low, until)]
        assert np.allclose(np.array(r["posterior"]).sum(1), 1)
    for name, n in (("a", 150), ("b", 131)):
        scored = sorted(d for r in fits if r["series_id"] == name for d in r["session"])
        assert scored == [days[name, k] for k in range(60, n + 1)]


def test_blocks_give_the_fits_of_single_checkpoints(panel):
    rows = W.complete(panel, COLUMNS).where("series_id = 'a'")
    key = lambda fits: {r["checkpoint"]: (r["seed"], round(r["likelihood"], 6), np.round(r["means"], 6).tolist(), np.round(r["posterior"], 6).tolist()) for r in fits.collect()}
    many, one = (key(W.fitted(rows, COLUMNS, 3, [1, 2], 60, 20, True, block, 15)) for block in (4, 1))
    assert many == one
    x = np.array([[r[c] for c in COLUMNS] for r in rows.orderBy("k").collect()])[40:100]
    z = (x - x.mean(0)) / x.std(0)
    alone = W.markov(np.stack([z, z]), 3, [1, 2], 15)
    assert many[100][1] == pytest.approx(alone.likelihood.max(), rel=1e-6)


def test_states_keep_their_number_when_fits_swap_them(spark):
    rows = [("s", 1, [[0.0, 0.0], [5.0, 5.0], [9.0, 0.0]]), ("s", 2, [[9.1, 0.0], [0.2, 0.0], [5.0, 5.2]]), ("s", 3, [[5.1, 5.0], [9.2, 0.1], [0.1, 0.1]])]
    fits = spark.createDataFrame(rows, "series_id string, checkpoint long, means array<array<double>>")
    fits = fits.withColumns({"posterior": F.expr("array(transform(means, m -> m[0]))"), "distance": F.expr("array(transform(means, m -> m[1]))"), "moves": F.expr("array(array(1D, 2D, 3D), array(4D, 5D, 6D), array(7D, 8D, 9D))"), "seed": F.lit(1), "session": F.array(F.current_date()), "pos": F.expr("array(1L)")})
    orders = {r["checkpoint"]: r["order"] for r in W.orders(fits).collect()}
    assert orders == {1: [0, 1, 2], 2: [1, 2, 0], 3: [2, 0, 1]}
    got = {r["checkpoint"]: r for r in W.aligned(fits).collect()}
    assert [m[0] for m in got[3]["means"]] == [0.1, 5.1, 9.2] and got[3]["posterior"] == [[0.1, 5.1, 9.2]]
    assert got[2]["moves"] == [[5, 6, 4], [8, 9, 7], [2, 3, 1]]
    drift = {r["checkpoint"]: r for r in W.drifts(W.aligned(fits)).collect()}
    assert sorted(drift) == [2, 3] and drift[3]["mean_alert"] and drift[2]["move_review"]
    top = {r["checkpoint"]: r["top"] for r in W.evidence(W.aligned(fits)).collect()}
    assert top == {1: 2, 2: 2, 3: 2}


def test_drift_thresholds(spark):
    rows = [("s", 1, [[1.0], [10.0]], [[0.9, 0.1], [0.5, 0.5]]), ("s", 2, [[1.2], [10.0]], [[0.6, 0.4], [0.5, 0.5]]), ("s", 3, [[1.5], [10.0]], [[0.25, 0.75], [0.5, 0.5]])]
    fits = spark.createDataFrame(rows, "series_id string, checkpoint long, means array<array<double>>, moves array<array<double>>")
    got = {r["checkpoint"]: (round(r["mean_drift"], 6), round(r["move_shift"], 6), r["mean_alert"], r["move_review"]) for r in W.drifts(fits).collect()}
    assert got == {2: (0.2, 0.3, False, got[2][3]), 3: (0.25, 0.35, True, True)}


def test_label_maps_are_checked_both_ways(spark):
    states = spark.createDataFrame([("m", "v1", 0), ("m", "v1", 1), ("m", "v1", 2), ("n", "v1", 0), ("o", "v2", 0)], "model string, version string, state int")
    labels = spark.createDataFrame([("m", "v1", 0, "calm"), ("m", "v1", 1, "high"), ("m", "v1", 1, "low"), ("m", "v1", 5, "none"), ("o", "v1", 0, "old")], "model string, version string, state int, label string")
    found = W.map_violations(states, labels)
    assert {tuple(r) for r in found.collect()} == {("m", "v1", 1, "doubled_state"), ("m", "v1", 2, "unmapped_state"), ("m", "v1", 5, "unknown_state"), ("n", "v1", None, "map_absent"), ("o", "v2", None, "version_mismatch")}
    rows = spark.createDataFrame([("m", "v1", 0), ("n", "v1", 0)], "model string, version string, top int")
    assert {(r["model"], r["mapped_label"], r["mapping"]) for r in W.labelled_states(rows, labels, found).collect()} == {("m", None, "doubled_state"), ("n", None, "map_absent")}
    good = labels.where("model = 'm' AND label IN ('calm', 'high')").union(spark.createDataFrame([("m", "v1", 2, "low")], labels.schema))
    fine = W.map_violations(states.where("model = 'm'"), good)
    assert fine.count() == 0
    assert [(r["mapped_label"], r["mapping"]) for r in W.labelled_states(rows.where("model = 'm'"), good, fine).collect()] == [("calm", "mapped")]


def test_an_empty_panel_has_no_fits(panel):
    rows = W.complete(panel.where("false"), COLUMNS)
    assert W.evidence(W.aligned(W.fitted(rows, COLUMNS, 3, [1], 60, 20, True))).count() == 0
