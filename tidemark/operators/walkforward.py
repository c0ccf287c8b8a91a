"""Walk-forward mixture and hidden Markov models with full covariances.

Sessions with all inputs are numbered by `k` in each series. Checkpoint c trains on the `window`
sessions up to c and scores the sessions from c to the one before the next checkpoint; the last
session is a checkpoint too. Several neighbouring checkpoints of one series make a block: a task
gets the block's rows once and fits all its checkpoints and seeds together, as batches of arrays
(batch, time, state). So a row is copied about (window + block) / block times in place of once
for each checkpoint and seed, and the loops over time run once for the whole batch.

Posteriors are filtered: what is known at a session, nothing after it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Floor of covariances' eigenvalues, fall of a likelihood from which a seed is rejected, gain below which it has converged.
FLOOR, FALL, GAIN = 1e-3, 1e-6, 1e-2
#: Tasks that the blocks of a fit are dealt over.
TASKS = 200
#: Changes of a mean (relative) and of a move's probability (absolute) that call for review.
MEAN_ALERT, MOVE_REVIEW = 0.20, 0.30


def complete(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(series_id, session, pos, k, columns) of the rows in which no column is null or not finite, numbered from 1 in each series."""
    finite = [F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf")) for c in columns]
    kept = rows.select("series_id", "session", "pos", *(F.col(c).cast("double").alias(c) for c in columns))
    for condition in finite:
        kept = kept.where(condition)
    return kept.withColumn("k", F.row_number().over(Window.partitionBy("series_id").orderBy("pos")).cast("long"))


def schedule(numbered: DataFrame, window: int, cadence: int) -> DataFrame:
    """(series_id, checkpoint, low, until): train on k in (low, checkpoint], score k in [checkpoint, until)."""
    ends = numbered.groupBy("series_id").agg(F.max("k").alias("n")).where(F.col("n") >= window)
    regular = F.sequence(F.lit(window).cast("long"), F.col("n"), F.lit(cadence).cast("long"))
    at = ends.select("series_id", "n", F.explode(F.array_distinct(F.concat(regular, F.array("n")))).alias("checkpoint"))
    return at.select("series_id", "checkpoint", (F.col("checkpoint") - window).alias("low"), F.when(F.col("checkpoint") == F.col("n"), F.col("n") + 1).otherwise(F.least(F.col("checkpoint") + cadence, F.col("n"))).alias("until"))


def blocks(numbered: DataFrame, window: int, cadence: int, size: int) -> DataFrame:
    """`numbered` with n (rows of the series) and block: a row for each block of `size` checkpoints that trains on it or scores it."""
    n = F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    of = lambda k: F.floor((k - window) / (cadence * size))  # noqa: E731  the block of the last regular checkpoint at or before k
    first, last = F.greatest(F.lit(0), of(F.col("k"))), F.least(of(F.col("k") + window - 1), of(F.col("n")))
    return numbered.withColumn("n", n).where(F.col("n") >= window).withColumn("block", F.explode(F.sequence(first, last)))


@dataclass
class Fit:
    """Batches of models: weights (b, k), means (b, k, d), covariances (b, k, d, d), moves (b, k, k) or none, likelihoods (b), rejected (b)."""

    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    moves: np.ndarray | None
    likelihood: np.ndarray
    rejected: np.ndarray

    def only(self, at: np.ndarray) -> Fit:
        return Fit(self.weights[at], self.means[at], self.covariances[at], None if self.moves is None else self.moves[at], self.likelihood[at], self.rejected[at])


def _own(of: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(rows, the members that have them) of a batch: seeds of one checkpoint share its rows, which are read once for all."""
    return [(c, np.flatnonzero(of == c)) for c in np.unique(of).tolist()]


def distances(x: np.ndarray, of: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared Mahalanobis distances (b, k, t) of rows x[of[b]] by Cholesky factors, and log determinants (b, k, 1)."""
    roots = np.linalg.inv(np.linalg.cholesky(covariances))
    middle = np.matmul(roots, means[..., None])[..., 0]
    out = np.empty((*means.shape[:2], x.shape[1]))
    for c, own in _own(of):
        away = x[c] @ roots[own].reshape(-1, x.shape[2]).T
        away -= middle[own].ravel()
        away = away.reshape(x.shape[1], -1, x.shape[2])
        out[own] = np.einsum("tmd,tmd->mt", away, away).reshape(len(own), -1, x.shape[1])
    return out, -2 * np.log(np.diagonal(roots, axis1=2, axis2=3)).sum(2)[..., None]


def log_densities(x: np.ndarray, of: np.ndarray, means: np.ndarray, covariances: np.ndarray) -> np.ndarray:
    """(b, k, t) of rows x[of[b]] under each state."""
    squares, determinants = distances(x, of, means, covariances)
    squares += determinants + x.shape[2] * np.log(2 * np.pi)
    squares *= -0.5
    return squares


def floored(covariances: np.ndarray, floor: float = FLOOR) -> np.ndarray:
    """Covariances with no eigenvalue below the floor: the likeliest ones under that bound, so likelihoods still never fall."""
    values, vectors = np.linalg.eigh(covariances)
    return np.matmul(vectors * np.maximum(values, floor)[..., None, :], vectors.swapaxes(-1, -2))


def with_products(x: np.ndarray) -> np.ndarray:
    """The inputs of each row and all products of two of them (c, t, d + d * d), for `moments`."""
    return np.concatenate([x, (x[..., :, None] * x[..., None, :]).reshape(*x.shape[:2], -1)], 2)


def moments(wide: np.ndarray, of: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts (b, k), means and floored covariances of rows weighted by r (b, k, t); wide: with_products(x), of centred x."""
    d = int((wide.shape[2] + 0.25) ** 0.5)
    n = r.sum(2) + 1e-12
    sums = np.empty((*n.shape, wide.shape[2]))
    for c, own in _own(of):
        sums[own] = (r[own].reshape(-1, r.shape[2]) @ wide[c]).reshape(len(own), -1, wide.shape[2])
    sums /= n[..., None]
    means = sums[..., :d]
    covariances = sums[..., d:].reshape(*n.shape, d, d) - means[..., :, None] * means[..., None, :]
    return n, means, floored(covariances)


def spread_rows(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows of x as first means: one by chance, each next one with a chance in proportion to its squared distance from those."""
    rng = np.random.default_rng(seed)
    chosen = [int(rng.integers(len(x)))]
    away = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k:
        p = away / away.sum() if away.sum() > 0 else np.full(len(x), 1 / len(x))
        chosen.append(int(rng.choice(len(x), p=p)))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def started(x: np.ndarray, of: np.ndarray, k: int, seeds: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """First means of each batch member, and everybody's covariance, after a few rounds of nearest means."""
    means = np.stack([spread_rows(x[c], k, seed) for c, seed in zip(of, seeds)])
    away = x - x.mean(1, keepdims=True)
    every = floored(np.matmul(away.swapaxes(1, 2), away) / x.shape[1])
    for _ in range(5):
        for c, own in _own(of):
            m = means[own].reshape(-1, x.shape[2])
            near = ((m**2).sum(1) - 2 * x[c] @ m.T).reshape(x.shape[1], len(own), k).argmin(2)
            r = (near.T[:, None] == np.arange(k)[:, None]).astype(float)
            n = r.sum(2)[..., None]
            means[own] = np.where(n > 0, (r.reshape(-1, x.shape[1]) @ x[c]).reshape(len(own), k, -1) / np.maximum(n, 1), means[own])
    return means, np.repeat(every[of][:, None], k, 1)


def mixture(x: np.ndarray, k: int, seeds: list[int], rounds: int = 100, of: np.ndarray | None = None) -> Fit:
    """Gaussian mixtures of k components, one for each seed, on the rows x[of[b]] (b-th rows without `of`), by expectation-maximisation.

    In the first quarter of the rounds a component that holds less than half a row moves to the row that fits worst.
    """
    b, t, of = len(seeds), x.shape[1], np.arange(len(x)) if of is None else of
    middle = x.mean(1, keepdims=True)
    x = x - middle
    means, covariances = started(x, of, k, seeds)
    fit = Fit(np.full((b, k), 1 / k), means, covariances, None, np.full(b, -np.inf), np.zeros(b, bool))
    every, live, wide = covariances[:, 0], np.arange(b), with_products(x)
    for step in range(rounds):
        now = fit.only(live)
        logs = log_densities(x, of[live], now.means, now.covariances) + np.log(now.weights + 1e-300)[..., None]
        top = logs.max(1, keepdims=True)
        r = np.exp(logs - top)
        total = r.sum(1, keepdims=True)
        r /= total
        rows = (np.log(total) + top)[:, 0]
        likelihood = rows.sum(1)
        n, means, covariances = moments(wide, of[live], r)
        empty = n < 0.5
        if empty.any() and step < rounds // 4:
            for i, j in zip(*np.nonzero(empty)):
                means[i, j], covariances[i, j], n[i, j] = x[of[live[i]], rows[i].argmin()], every[live[i]], 1.0
            likelihood = np.where(empty.any(1), -np.inf, likelihood)
        gain = likelihood - fit.likelihood[live]
        fit.likelihood[live] = likelihood
        going = ~(np.isfinite(gain) & (gain < GAIN * 1e-2 * t))
        live = live[going]
        fit.weights[live], fit.means[live], fit.covariances[live] = (n / n.sum(1, keepdims=True))[going], means[going], covariances[going]
        if not len(live):
            break
    fit.means += middle[of]
    return fit


def forward(densities: np.ndarray, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filtered probabilities (t, k, b) from densities (t, k, b) scaled by row, and each row's scale (t, b); members lie side by side,
    so that every step is a few operations over all of them."""
    out, scales = np.empty_like(densities), np.empty((len(densities), densities.shape[2]))
    onward, both = np.ascontiguousarray(moves.transpose(1, 2, 0)), np.empty((*moves.shape[1:], len(moves)))
    state = weights.T * densities[0]
    for t in range(len(densities)):
        if t:
            np.multiply(onward, out[t - 1][:, None], out=both)
            np.add.reduce(both, 0, out=state)
            state *= densities[t]
        np.add.reduce(state, 0, out=scales[t])
        np.divide(state, scales[t], out=out[t])
    return out, scales


def backward(weighted: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The scaled backward pass (t, k, b) from densities over their rows' scales."""
    out = np.ones_like(weighted)
    onward, both = np.ascontiguousarray(moves.transpose(1, 2, 0)), np.empty((*moves.shape[1:], len(moves)))
    for t in range(len(weighted) - 2, -1, -1):
        np.multiply(onward, weighted[t + 1] * out[t + 1], out=both)
        np.add.reduce(both, 1, out=out[t])
    return out


def scaled_densities(x: np.ndarray, of: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Densities (t, k, b) over the largest of each row, floored so that no row is impossible, and the logs of those (t, b)."""
    logs = np.ascontiguousarray(log_densities(x, of, fit.means, fit.covariances).transpose(2, 1, 0))
    top = logs.max(1, keepdims=True)
    logs -= top
    return np.maximum(np.exp(logs, out=logs), 1e-200, out=logs), top[:, 0]


def markov(x: np.ndarray, k: int, seeds: list[int], rounds: int = 200, gain: float = GAIN, fall: float = FALL, of: np.ndarray | None = None) -> Fit:
    """Gaussian hidden Markov models of k states, one for each seed, on the rows x[of[b]] (b-th rows without `of`), by Baum and Welch in
    one pass over time for all.

    A member whose likelihood falls by more than `fall` of its size is rejected at once.
    """
    b, of = len(seeds), np.arange(len(x)) if of is None else of
    middle = x.mean(1, keepdims=True)
    x = x - middle
    means, covariances = started(x, of, k, seeds)
    moves = np.full((b, k, k), 0.1 / max(1, k - 1))
    moves[:, range(k), range(k)] = 0.9 if k > 1 else 1.0
    fit = Fit(np.full((b, k), 1 / k), means, covariances, moves, np.full(b, -np.inf), np.zeros(b, bool))
    live, wide = np.arange(b), with_products(x)
    for _ in range(rounds):
        now = fit.only(live)
        densities, tops = scaled_densities(x, of[live], now)
        ahead, scales = forward(densities, now.weights, now.moves)
        likelihood = (np.log(scales) + tops).sum(0)
        up = likelihood - fit.likelihood[live]
        fell = up < -fall * np.abs(likelihood)
        fit.rejected[live[fell]] = True
        fit.likelihood[live] = likelihood
        going = ~fell & ~(up < gain)
        live = live[going]
        if not len(live):
            break
        if not going.all():
            now = now.only(going)
            ahead, densities, scales = ahead[..., going], densities[..., going], scales[:, going]
        densities /= scales[:, None]
        back = backward(densities, now.moves)
        densities *= back
        pairs = now.moves * np.matmul(ahead[:-1].transpose(2, 1, 0), densities[1:].transpose(2, 0, 1)) + 1e-12
        back *= ahead
        back /= back.sum(1, keepdims=True)
        r = np.ascontiguousarray(back.transpose(2, 1, 0))
        _, fit.means[live], fit.covariances[live] = moments(wide, of[live], r)
        fit.moves[live] = pairs / pairs.sum(2, keepdims=True)
        fit.weights[live] = (r[..., 0] + 1e-12) / (r[..., 0] + 1e-12).sum(1, keepdims=True)
    fit.means += middle[of]
    return fit


def posteriors(x: np.ndarray, fit: Fit) -> np.ndarray:
    """(b, t, k): a mixture's posteriors, or a Markov model's filtered probabilities from the first row of x on."""
    of = np.arange(len(x))
    if fit.moves is None:
        logs = log_densities(x, of, fit.means, fit.covariances) + np.log(fit.weights + 1e-300)[..., None]
        r = np.exp(logs - logs.max(1, keepdims=True))
        return (r / r.sum(1, keepdims=True)).swapaxes(1, 2)
    return forward(scaled_densities(x, of, fit)[0], fit.weights, fit.moves)[0].transpose(2, 0, 1)


def assignment(cost: np.ndarray) -> list[int]:
    """The column of each row in the assignment of least total cost, by shortest augmenting paths (cubic, not all orders)."""
    n = len(cost)
    rows, columns = np.zeros(n + 1), np.zeros(n + 1)
    owner = np.zeros(n + 1, int)  # the row, from 1, of each column; column 0 stands for the row that is placed
    for i in range(1, n + 1):
        owner[0], at = i, 0
        least, came, done = np.full(n + 1, np.inf), np.zeros(n + 1, int), np.zeros(n + 1, bool)
        while owner[at]:
            done[at] = True
            slack = cost[owner[at] - 1] - rows[owner[at]] - columns[1:]
            better = ~done[1:] & (slack < least[1:])
            least[1:][better], came[1:][better] = slack[better], at
            open_ = np.where(done, np.inf, least)
            open_[0] = np.inf
            to = int(open_.argmin())
            delta = open_[to]
            rows[owner[done]] += delta
            columns[done] -= delta
            least[~done] -= delta
            at = to
        while at:
            owner[at] = owner[came[at]]
            at = came[at]
    out = [0] * n
    for j in range(1, n + 1):
        out[owner[j] - 1] = j - 1
    return out


FITS = "series_id string, checkpoint long, seed long, likelihood double, rejected array<long>, means array<array<double>>, moves array<array<double>>, session array<date>, pos array<long>, posterior array<array<double>>, distance array<array<double>>"


def fitted(numbered: DataFrame, columns: list[str], k: int, seeds: list[int], window: int, cadence: int, hidden: bool, block: int = 8, rounds: int = 100) -> DataFrame:
    """One row for each (series, checkpoint): the likeliest seed that was not rejected, its means in the inputs' own units, moves
    between states (null for a mixture), and for each scored session the posterior and the Mahalanobis distance of every state.

    `hidden`: a Markov model on inputs standardised over the training window, else a mixture on the inputs as they are.
    A checkpoint whose window has fewer distinct rows than states, or no seed left, has no row.
    """

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("k")
        ks, rows, last = df["k"].to_numpy(), df[columns].to_numpy(float), int(df["n"].iloc[0])
        low = window + int(df["block"].iloc[0]) * cadence * block
        regular = [c for c in range(low, min(low + cadence * block, last + 1), cadence)]
        points = regular if not regular or regular[-1] + cadence <= last or regular[-1] == last else [*regular, last]
        offset, tasks = int(ks[0]), []
        for c in points:
            train = rows[c - window + 1 - offset : c + 1 - offset]
            if len(np.unique(train, axis=0)) < k:
                continue
            middle, scale = (train.mean(0), np.where(train.std(0) > 0, train.std(0), 1.0)) if hidden else (np.zeros(len(columns)), np.ones(len(columns)))
            until = last + 1 if c == last else min([p for p in points if p > c] or [min(c + cadence, last)])
            tasks.append((c, (train - middle) / scale, middle, scale, until))
        out = []
        if tasks:
            x, of = np.stack([t[1] for t in tasks]), np.repeat(np.arange(len(tasks)), len(seeds))
            fit = (markov if hidden else mixture)(x, k, seeds * len(tasks), rounds, of=of)
            for i, (c, train, middle, scale, until) in enumerate(tasks):
                own = np.arange(i * len(seeds), (i + 1) * len(seeds))
                good = [j for j in own if not fit.rejected[j] and np.isfinite(fit.likelihood[j])]
                if not good:
                    continue
                best = fit.only(np.array([max(good, key=lambda j: (fit.likelihood[j], -j))]))
                scored = rows[c - offset : until - offset]
                every = np.concatenate([train[:-1], (scored - middle) / scale])[None]
                posterior = posteriors(every, best)[0, window - 1 :]
                away = np.sqrt(distances(every[:, window - 1 :], np.zeros(1, int), best.means, best.covariances)[0][0].T)
                at = slice(c - offset, until - offset)
                out.append({
                    "series_id": df["series_id"].iloc[0], "checkpoint": c, "seed": seeds[max(good, key=lambda j: (fit.likelihood[j], -j)) - own[0]], "likelihood": float(best.likelihood[0]),
                    "rejected": [seeds[j - own[0]] for j in own if fit.rejected[j]], "means": (best.means[0] * scale + middle).tolist(), "moves": None if best.moves is None else best.moves[0].tolist(),
                    "session": df["session"].iloc[at].tolist(), "pos": df["pos"].iloc[at].tolist(), "posterior": posterior.tolist(), "distance": away.tolist(),
                })
        return pd.DataFrame(out, columns=[f.split(" ")[0] for f in FITS.split(", ")])

    # A number of tasks of their own: blocks are few and small, and by their size they would be put together in a few tasks.
    return blocks(numbered, window, cadence, block).repartition(TASKS, "series_id", "block").groupBy("series_id", "block").applyInPandas(run, FITS)


def orders(fits: DataFrame) -> DataFrame:
    """(series_id, checkpoint, order): which state of a checkpoint is the one that the checkpoints before call 0, 1, ...

    The first checkpoint of a series keeps its order; each next one takes the assignment of least total distance of
    means to the one before. Only means come together, some numbers for each checkpoint of one series.
    """

    def run(df: pd.DataFrame) -> pd.DataFrame:
        df, before, out = df.sort_values("checkpoint"), None, []
        for value in df["means"]:
            means = np.array([list(m) for m in value], float)
            order = list(range(len(means))) if before is None else assignment(np.sqrt(((before[:, None] - means[None]) ** 2).sum(2)))
            before = means[order]
            out.append(order)
        return pd.DataFrame({"series_id": df["series_id"], "checkpoint": df["checkpoint"], "order": out})

    return fits.select("series_id", "checkpoint", "means").groupBy("series_id").applyInPandas(run, "series_id string, checkpoint long, order array<int>")


def _by_order(values: Column, order: Column) -> Column:
    return F.transform(order, lambda i: values[i])


def aligned(fits: DataFrame) -> DataFrame:
    """`fits` with all states in the order of `orders`, so that a state keeps its number from checkpoint to checkpoint.

    Fits are read twice: give them written (checkpointed), or they are fitted twice.
    """
    out = fits.join(orders(fits), ["series_id", "checkpoint"])
    order = F.col("order")
    moves = F.transform(order, lambda i: F.transform(order, lambda j: F.col("moves")[i][j]))
    each = lambda c: F.transform(c, lambda row: F.transform(F.col("order"), lambda i: row[i]))
    return out.withColumns({"means": _by_order(F.col("means"), order), "moves": F.when(F.col("moves").isNotNull(), moves), "posterior": each("posterior"), "distance": each("distance")}).drop("order")


def evidence(fits: DataFrame) -> DataFrame:
    """A row for each scored session: checkpoint, seed, probabilities of all states, the top one (the first of several), its probability and distance."""
    rows = fits.select("series_id", "checkpoint", "seed", F.explode(F.arrays_zip("session", "pos", F.col("posterior").alias("probabilities"), "distance")).alias("z"))
    rows = rows.select("series_id", "checkpoint", "seed", "z.session", "z.pos", "z.probabilities", F.col("z.distance").alias("distances"))
    return top_state(rows).withColumn("distance", F.col("distances")[F.col("top")]).drop("distances")


def top_state(rows: DataFrame, probabilities: str = "probabilities") -> DataFrame:
    """Adds `top`, the number of the most probable state (the first of several), and its `probability`."""
    p = F.col(probabilities)
    return rows.withColumns({"top": (F.array_position(p, F.array_max(p)) - 1).cast("int"), "probability": F.array_max(p)})


def drifts(fits: DataFrame) -> DataFrame:
    """Aligned fits' change since the checkpoint before: the largest relative change of a mean, and the largest change of a move's
    probability (null for mixtures), with whether they call for review. The first checkpoint of a series has none."""
    w = Window.partitionBy("series_id").orderBy("checkpoint")
    apart = lambda a, b, f: F.array_max(F.flatten(F.zip_with(a, b, lambda x, y: F.zip_with(x, y, f))))
    rows = fits.withColumns({"_m": F.lag("means").over(w), "_t": F.lag("moves").over(w)}).where("_m IS NOT NULL")
    mean = apart(F.col("means"), F.col("_m"), lambda x, y: F.abs(x - y) / F.greatest(F.abs(y), F.lit(1e-9)))
    move = apart(F.col("moves"), F.col("_t"), lambda x, y: F.abs(x - y))
    out = rows.select("series_id", "checkpoint", mean.alias("mean_drift"), move.alias("move_shift"))
    return out.withColumns({"mean_alert": F.col("mean_drift") > MEAN_ALERT, "move_review": F.coalesce(F.col("move_shift") > MOVE_REVIEW, F.lit(False))})


def map_violations(states: DataFrame, label_map: DataFrame) -> DataFrame:
    """(model, version, state, problem) for all that keeps a label map from holding, in both directions.

    states: (model, version, state), those that fitted models can give; label_map: (model, version, state, label). A model without
    any mapping is `map_absent`; one mapped under other versions only is `version_mismatch`; of one with a map of its version, states
    without a label are `unmapped_state`, labels for states that it has not `unknown_state`, and states with several `doubled_state`.
    """
    have, named = states.select("model", "version", "state").distinct(), label_map.groupBy("model", "version", "state").agg(F.count("*").alias("n"))
    mapped, versions = named.select("model").distinct().withColumn("_any", F.lit(True)), named.select("model", "version").distinct().withColumn("_same", F.lit(True))
    models = have.select("model", "version").distinct().join(mapped, "model", "left").join(versions, ["model", "version"], "left")
    whole = models.where("_same IS NULL").select("model", "version", F.lit(None).cast("int").alias("state"), F.when(F.col("_any"), "version_mismatch").otherwise("map_absent").alias("problem"))
    same = models.where("_same").select("model", "version")
    both = have.withColumn("_have", F.lit(True)).join(named, ["model", "version", "state"], "full").join(same, ["model", "version"], "left_semi")
    problem = F.when(F.col("n").isNull(), "unmapped_state").when(F.col("_have").isNull(), "unknown_state").when(F.col("n") > 1, "doubled_state")
    each = both.select("model", "version", F.col("state").cast("int").alias("state"), problem.alias("problem")).where("problem IS NOT NULL")
    return whole.unionByName(each)


def labelled_states(rows: DataFrame, label_map: DataFrame, violations: DataFrame) -> DataFrame:
    """Rows (model, version, top) with `mapped_label` and `mapping`: mapped where the model's map holds, else the first problem by name and no label."""
    broken = violations.groupBy("model", "version").agg(F.min("problem").alias("_problem"))
    names = label_map.select("model", "version", F.col("state").cast("int").alias("top"), F.col("label").alias("_label")).dropDuplicates(["model", "version", "top"])
    out = rows.join(names, ["model", "version", "top"], "left").join(broken, ["model", "version"], "left")
    return out.withColumns({"mapped_label": F.when(F.col("_problem").isNull(), F.col("_label")), "mapping": F.coalesce("_problem", F.lit("mapped"))}).drop("_label", "_problem")
