"""Approximate nearest neighbours by cosine, with stable projections and a kd-tree.

Unit vectors are projected on a few random normal directions. For two of them at distance d
the squared distance of their projections is d * d times a chi-square variable, so once all
vectors within projected distance r of a query have been seen and the k-th best is at d, a
nearer one has been missed with the probability that chi-square exceeds (r / d) ** 2. A query's
projected neighbours are verified in the order of their projected distance until that is small.

The upper kd-tree is fitted on a bounded sample of projections; every vector is assigned to one of its
cells, and the cells are cut into blocks of bounded size, by the hash of the id where copies of one
vector cannot be cut apart. Every block has a kd-tree of its own. A query first searches the cells
nearest to it; what it finds there tells which other cells and leaves the stopping test leaves.

A block's vectors are shuffled once (and once more for every QUERIES queries that are sent to it), to a
task that holds one block at a time and reads the block's queries as a stream.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import shared, table, written
from .word_hashes import give_back

#: Directions (an even number), neighbours, probability of the stopping test.
DIRECTIONS, NEAREST, SURE = 32, 5, 0.85
#: Rows that fit the upper tree, cells at most, rows of a block, rows of a leaf, cells that a query searches first.
SAMPLE, CELLS, BLOCK, LEAF, FIRST = 50_000, 1024, 4_096, 128, 4
#: Queries of a block that one task takes, and tasks of a search at most.
QUERIES, TASKS = 500_000, 10_000
EMPTY = 1e-12


def chi_square_below(x: float, n: int = DIRECTIONS) -> float:
    """The chi-square distribution function for an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, n // 2):
        term *= x / 2 / i
        total += term
    return 1 - exp(-x / 2) * total


def limit(sure: float = SURE, n: int = DIRECTIONS) -> float:
    """The squared ratio of projected to true distance from which the test holds."""
    low, high = 0.0, 1e3
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_below(mid, n) < sure else (low, mid)
    return high


def directions(dim: int, n: int = DIRECTIONS, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dim, n))


def split(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of kd-tree leaves of at most `size` points, cut at medians of the widest side."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            leaves.append(rows)
            continue
        side = int(np.ptp(points[rows], 0).argmax())
        order = rows[np.argsort(points[rows, side], kind="stable")]
        todo += [order[: len(order) // 2], order[len(order) // 2 :]]
    return leaves


class Cells:
    """The upper kd-tree: planes (side, value) with children, from a sample of projections, and the boxes of its cells."""

    def __init__(self, points: np.ndarray, cells: int) -> None:
        self.nodes: list[tuple] = []
        self.boxes: list[tuple[np.ndarray, np.ndarray]] = []
        side = np.full(points.shape[1], inf)
        self._grow(points, max(1, cells), -side, side)
        self.low, self.high = (np.stack(b) for b in zip(*self.boxes))

    def _grow(self, points: np.ndarray, cells: int, low: np.ndarray, high: np.ndarray) -> int:
        at = len(self.nodes)
        side = int(np.ptp(points, 0).argmax()) if len(points) else 0
        value = float(np.median(points[:, side])) if len(points) else 0.0
        left = points[:, side] < value
        if cells < 2 or len(points) < 4 or not left.any() or left.all():
            self.nodes.append((-1, 0.0, len(self.boxes), 0))
            self.boxes.append((low, high))
            return at
        self.nodes.append(())
        below, above = high.copy(), low.copy()
        below[side] = above[side] = value
        a, b = self._grow(points[left], cells // 2, low, below), self._grow(points[~left], cells - cells // 2, above, high)
        self.nodes[at] = (side, value, a, b)
        return at

    def of(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)
        todo = [(0, np.arange(len(points)))]
        while todo:
            at, rows = todo.pop()
            side, value, a, b = self.nodes[at]
            if side < 0:
                out[rows] = a
            elif len(rows):
                left = points[rows, side] < value
                todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def gaps(self, point: np.ndarray) -> np.ndarray:
        """The squared distance of a point from each cell."""
        return (np.maximum(0, np.maximum(self.low - point, point - self.high)) ** 2).sum(1)


def _matrix(values: pa.Array) -> np.ndarray:
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(values), -1) if len(values) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows with one vector, each summed alone, so that equal rows have equal values."""
    return (x * q).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((q * q).sum()))


class Block:
    """The vectors of a block, their projections, and the boxes of a kd-tree's leaves over these."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        units = _unit(x)
        self.rotate = directions(x.shape[1])
        points = units @ self.rotate
        leaves = split(points, LEAF)
        order = np.concatenate(leaves)
        self.ids, self.x, self.units, self.points = ids[order], x[order], units[order], points[order]
        self.squares = (self.points**2).sum(1)
        begins = np.cumsum([0, *map(len, leaves)])[:-1]
        self.low, self.high = np.minimum.reduceat(self.points, begins), np.maximum.reduceat(self.points, begins)
        self.leaf = np.repeat(np.arange(len(leaves)), [len(r) for r in leaves])
        self.verified = 0

    def search(self, query: int, q: np.ndarray, within: float, nearest: int, test: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the best for a query; within: a squared distance that its k-th best does not exceed.

        Points are verified by growing steps in the order of their projected distance, until the
        next one is beyond the test at the k-th best so far.
        """
        u = _unit(q[None])[0]
        p = u @ self.rotate
        near = (np.maximum(0, np.maximum(self.low - p, p - self.high)) ** 2).sum(1) <= test * within + EMPTY
        rows = np.flatnonzero(near[self.leaf] & (self.ids != query))
        far = np.maximum(0, self.squares[rows] - 2 * (self.points[rows] @ p) + p @ p)
        if within < inf:
            close = far <= test * within + EMPTY
            rows, far = rows[close], far[close]
        order = np.argsort(far, kind="stable")
        rows, far = rows[order], far[order]
        best_score, best_id, at, step = np.zeros(0), np.zeros(0, np.int64), 0, 4 * nearest
        while at < len(rows) and far[at] <= test * within + EMPTY:
            some = rows[at : at + step]
            at, step = at + step, 2 * step
            self.verified += len(some)
            if len(best_score) == nearest:
                some = some[self.units[some] @ u >= best_score[-1] - 1e-9]
            score = np.concatenate([best_score, cosines(self.x[some], q)])
            who = np.concatenate([best_id, self.ids[some]])
            first = np.lexsort((who, -score))[:nearest]
            best_score, best_id = score[first], who[first]
            if len(best_score) == nearest:
                within = min(within, max(0.0, 2 - 2 * best_score[-1]))
        return best_id, best_score


FOUND = "query_id long, vec_id long, score double"


def _searched(nearest: int, test: float):
    """Searches blocks, each with its vectors first and its queries after them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)], 1)
            edges = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(1)]) if len(keys) else np.zeros(0, bool))
            out: list[tuple] = []
            for a, b in zip(edges, [*edges[1:], len(keys)]):
                part = batch.slice(a, b - a)
                if at != tuple(keys[a, :3]):
                    at, held, block = tuple(keys[a, :3]), [], None
                if not keys[a, 3]:
                    held.append(part)
                    continue
                if block is None and held:
                    block = Block(np.concatenate([h.column(4).to_numpy() for h in held]), np.concatenate([_matrix(h.column(5)) for h in held]))
                    held = []
                if block:
                    for query, q, known in zip(part.column(4).to_pylist(), _matrix(part.column(5)), part.column(6).to_pylist()):
                        ids, scores = block.search(query, q, inf if known is None else known, nearest, test)
                        out += [(query, int(i), float(s)) for i, s in zip(ids, scores)]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])
        del held, block
        give_back()

    return run


def nearest(vectors: DataFrame, every: int = 50, key: str = "vec_id", vector: str = "embedding", k: int = NEAREST, sure: float = SURE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row whose id `every` divides.

    All other rows are candidates. Null ids and vectors that are null, empty, zero or hold null
    or non-finite components take no part, nor do those of another length than the commonest
    (of equally common ones the longest). Of rows that share an id one counts, the greatest.
    """
    x = F.col(vector).cast("array<double>")
    sound = vectors.where(F.col(key).isNotNull() & x.isNotNull() & ~F.coalesce(F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == inf)), F.lit(True)) & F.exists(x, lambda v: v != 0))
    rows = sound.select(F.col(key).cast("long").alias("vec_id"), x.alias("x"))
    sizes = rows.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim, n = (sizes[0].dim, sizes[0].n) if sizes else (1, 0)
    rows = rows.where(F.size("x") == dim).groupBy("vec_id").agg(F.max("x").alias("x"))
    rotate = directions(dim)

    def project(batches):
        for batch in batches:
            points = _unit(_matrix(batch.column(0))) @ rotate if batch.num_rows else np.zeros((0, DIRECTIONS))
            yield pa.RecordBatch.from_arrays([pa.array(points.tolist(), pa.list_(pa.float64()))], names=["p"])

    unit = F.xxhash64("vec_id").cast("double") / F.lit(2.0**64) + 0.5
    sample = rows.where(unit * n < SAMPLE).select("x").mapInArrow(project, "p array<double>").toArrow().column("p").combine_chunks()
    cells = Cells(_matrix(sample) if len(sample) else np.zeros((0, DIRECTIONS)), min(CELLS, -(-n // (BLOCK // 2))))
    held, test, spark = shared(vectors.sparkSession, cells), limit(sure), vectors.sparkSession

    def assign(batches):
        cells = held()
        for batch in batches:
            points = _unit(_matrix(batch.column(1))) @ rotate if batch.num_rows else np.zeros((0, DIRECTIONS))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.of(points), pa.int32())], names=["vec_id", "x", "cell"])

    placed = written(rows.mapInArrow(assign, "vec_id long, x array<double>, cell int"))
    full = placed.groupBy("cell").agg(F.count("*").alias("rows"))  # at most CELLS rows
    cuts = written(full.select("cell", F.ceil(F.col("rows") / BLOCK).cast("int").alias("parts")))
    blocks = placed.join(F.broadcast(cuts), "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    queries = placed.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "x", F.lit(None).cast("double").alias("within"))

    def visits(asked: DataFrame, first: bool) -> DataFrame:
        """Queries with each cell of their FIRST nearest, or with each other cell that the test leaves."""

        def run(batches):
            cells = held()
            for batch in batches:
                points = _unit(_matrix(batch.column(1))) @ rotate if batch.num_rows else np.zeros((0, DIRECTIONS))
                rows: list[tuple[int, int]] = []
                for r, (p, w) in enumerate(zip(points, batch.column(2).to_pylist())):
                    gaps = cells.gaps(p)
                    order = np.argsort(gaps, kind="stable")
                    if not first:
                        order = order[FIRST:][gaps[order[FIRST:]] <= (inf if w is None else test * w + EMPTY)]
                    rows += [(r, int(c)) for c in (order[:FIRST] if first else order)]
                taken = batch.take(pa.array([r for r, _ in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), pa.array([c for _, c in rows], pa.int32()), taken.column(2)], names=["query_id", "x", "cell", "within"])

        return asked.mapInArrow(run, "query_id long, x array<double>, cell int, within double")

    def searched(sent: DataFrame) -> DataFrame:
        """The k best of each query in each block of the cells that it is sent to."""
        salts = written(sent.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("salts")).join(F.broadcast(cuts), "cell"))
        salt = F.pmod(F.xxhash64("query_id"), F.col("salts")).cast("int")
        asked = sent.join(F.broadcast(salts), "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), salt.alias("salt"), F.lit(1).alias("asks"), F.col("query_id").alias("id"), "x", "within")
        data = blocks.drop("parts").join(F.broadcast(salts), "cell").select("cell", "part", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("asks"), F.col("vec_id").alias("id"), "x", F.lit(None).cast("double").alias("within"))
        tasks = min(TASKS, salts.agg(F.sum(F.col("parts") * F.col("salts"))).first()[0] or 1)
        dealt = data.union(asked).repartition(int(tasks), "cell", "part", "salt").sortWithinPartitions("cell", "part", "salt", "asks")
        return dealt.mapInArrow(_searched(k, test), FOUND)

    own = written(searched(written(visits(queries, True))))
    kth = own.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list("score"), lambda a, b: F.when(a > b, -1).when(a < b, 1).otherwise(0)), 1, k).alias("s"))
    within = kth.select("query_id", F.when(F.size("s") >= k, F.greatest(F.lit(0.0), 2 - 2 * F.element_at("s", k))).alias("within"))
    others = queries.drop("within").join(within, "query_id", "left").select("query_id", "x", "within")
    found = own.union(searched(written(visits(others, False))))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of each query: query_id, rank, vec_id, score."""
    return nearest(table(spark, sf_dir, "embeddings"))
