"""Log-probabilities of texts under a log-bilinear neural language model trained on the corpus.

Counts of all training words are gathered first. The most frequent words are units of the model, one
each; every other word, known or not, belongs to a class by its last two bytes, and the classes are
units too. A context's vector is the sum of the vectors of the words before, each weighted by its
place; its product with a unit's own vector, plus a bias, is the unit's score. Within a class
a word has its smoothed share of the class's count, and all unknown words together have one, so the
probabilities of all words and the unknown ones of each class add up to one.

Training is noise-contrastive estimation in numpy: every unit that follows is told from units drawn by
their frequency, so no sum over all units is needed. Each task passes once over its own texts and
the vectors are averaged over tasks, weighted by how often each was used; a round takes the next
part of all training texts, and the rounds together all of them. Scoring does sum: products of a block of
contexts with all units give normalised probabilities.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .heads import HEAD, arrays, found_at, heaviest, joined_sums, stored, with_sums
from .tables import extended, fold, shared, table, written
from .word_hashes import NOT_BLANK, Hasher, chunks, give_back

#: Words with a unit of their own, classes of all others, numbers of a vector, words of a context.
WORDS, CLASSES, DIM, CONTEXT = 255, 128, 16, 3
#: Parts of the training texts, one a round; positions of a step; noise units of a step; rate of the first round (it falls to nothing).
ROUNDS, BATCH, NOISE, RATE = 4, 1024, 128, 0.04
#: Positions held while training, and scored at a time; distinct words counted in a task before they are dealt out.
HELD, BLOCK, FLUSH = 200_000, 2_048, 400_000
#: What stands for the end of a text among word hashes, and its unit.
END, END_UNIT = 0, 0


@dataclass
class Tokens:
    """Words of texts in order: hashes, classes, and bounds of each text."""

    hashes: np.ndarray
    classes: np.ndarray
    bounds: np.ndarray


def tokens(texts: pa.Array, hasher: Hasher) -> Tokens:
    """The words of an array of strings, A-Z lower-cased; a null counts as empty."""
    words = hasher(texts)
    joined = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets - offsets[0]] = True
    inside = np.concatenate([hasher.word_bytes[data], [False]])
    last = np.flatnonzero(inside[:-1] & (~inside[1:] | edge[1:]))
    low = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.int64)
    before = np.where((last > 0) & inside[last - 1] & ~edge[last], low[last - 1], 0)
    return Tokens(words.hashes.astype(np.int64), (before * 31 + low[last] * 7) % CLASSES, words.bounds)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, class, n) for the words of all texts, by hash, and the row END for the texts' ends. Written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held, n_held, texts = Hasher(NOT_BLANK), [], 0, 0

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            word, kind, n = (np.concatenate(x) for x in zip(*held))
            word, first, inverse = np.unique(word, return_index=True, return_inverse=True)
            return word, kind[first], np.bincount(inverse, n, len(word)).astype(np.int64)

        def out(rows: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1].astype(np.int32)), pa.array(rows[2])], names=["word", "class", "n"])

        for batch in batches:
            texts += batch.num_rows
            for _, part in chunks(batch.column(0)):
                t = tokens(part, hasher)
                held.append((t.hashes, t.classes, np.ones(len(t.hashes), np.int64)))
                n_held += len(t.hashes)
                if n_held > FLUSH:
                    held = [merged()]
                    n_held = len(held[0][0])
                    if n_held > FLUSH // 2:
                        yield out(held[0])
                        held, n_held = [], 0
        if held:
            yield out(merged())
        if texts:
            yield out((np.array([END]), np.array([-1]), np.array([texts])))
        give_back()

    each = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "word long, class int, n long")
    return written(each.groupBy("word").agg(F.min("class").alias("class"), F.sum("n").alias("n")))


@dataclass
class Statistics:
    """What the counts fix before any training.

    words, counts, units: the most frequent words, sorted by hash; class_log: log10 of each class's total with
    its smoothing; total, distinct: of all tokens; ends: training texts; prior: each unit's share of all tokens.
    """

    words: np.ndarray
    counts: np.ndarray
    units: np.ndarray
    class_log: np.ndarray
    total: int
    distinct: int
    ends: int
    prior: np.ndarray
    first_class: int


def statistics(counts: DataFrame, words: int = WORDS, limit: int = HEAD) -> Statistics:
    """Statistics of written counts: sums over all of them, and the `limit` most frequent words."""
    hashes, n, kind = arrays(heaviest(counts.where(F.col("word") != END), "n", limit), "word", "n", "class")
    ends = counts.where(F.col("word") == END).first()
    ends = ends["n"] if ends else 0
    top = np.lexsort([hashes, -n])[:words]
    units = 1 + len(top) + kind.astype(np.int64)
    units[top] = 1 + np.arange(len(top))
    totals, distinct = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in counts.where("class >= 0").groupBy("class").agg(F.sum("n"), F.count("*")).collect():
        totals[row[0]], distinct[row[0]] = row[1], row[2]
    total, different = int(totals.sum()) + ends, int(distinct.sum()) + (ends > 0)
    np.subtract.at(totals, kind[top], n[top])
    np.subtract.at(distinct, kind[top], 1)
    in_class = totals + 0.5 * (distinct + 1)
    prior = np.concatenate([[ends + 0.5], n[top] + 0.5, in_class])
    return Statistics(hashes, n, units, np.log10(in_class), total, different, ends, prior / prior.sum(), 1 + len(top))


def encoded(docs: DataFrame, known: Statistics, learned: str, text: str = "text") -> DataFrame:
    """The columns of `docs` in a struct `row`, with row_id, `learned`, units (two bytes each, the end last), n_tokens, and over the tokens
    that `known` lists: n_head of known ones, log_count and class_log, sums of log10(count + 0.5) of all and of those in classes,
    class_total, the sum of log10 of class totals over all tokens in classes; keys and times of the words it does not list. Stored."""
    held = shared(docs.sparkSession, known)
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"), F.coalesce(F.expr(learned), F.lit(False)).alias("learned"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, k = Hasher(NOT_BLANK), held()
        log_of, end_log = np.log10(k.counts + 0.5), np.log10(k.ends + 0.5)
        for batch in batches:
            for first, part in chunks(batch.column(1)):
                t = tokens(part, hasher)
                size, n = np.diff(t.bounds), len(part)
                text_of = np.repeat(np.arange(n), size)
                at = found_at(k.words, t.hashes)
                hit = at >= 0
                unit = np.where(hit, k.units[at] if len(k.units) else 0, k.first_class + t.classes)
                logs = np.where(hit, log_of[at] if len(log_of) else 0.0, 0.0)
                classed = unit >= k.first_class
                sums = [np.bincount(text_of, x, n).astype(float) for x in (hit, logs, logs * classed, np.where(classed, k.class_log[np.maximum(unit - k.first_class, 0)], 0.0))]
                raw, cuts = unit.astype("<u2").tobytes(), (2 * t.bounds).tolist()
                units = [raw[a:b] + b"\0\0" for a, b in zip(cuts, cuts[1:])]
                rest, rest_of = t.hashes[~hit], text_of[~hit]
                order = np.lexsort([rest, rest_of])
                rest, rest_of = rest[order], rest_of[order]
                new = np.flatnonzero(np.concatenate([[True], (rest[1:] != rest[:-1]) | (rest_of[1:] != rest_of[:-1])])[: len(rest)])
                offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(rest_of[new], minlength=n))]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (rest[new], np.diff([*new, len(rest)]).astype(np.int32))]
                columns = [pa.array(units, pa.binary()), pa.array(size + 1), pa.array(sums[0].astype(np.int64) + (k.ends > 0)), pa.array(sums[1] + end_log), pa.array(sums[2]), pa.array(sums[3]), *lists]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(2).slice(first, n), *columns], names=["row", "learned", "units", "n_tokens", "n_head", "log_count", "class_log", "class_total", "keys", "times"])
        give_back()

    out = rows.mapInArrow(run, extended(rows.select("row", "learned"), "units binary, n_tokens long, n_head long, log_count double, class_log double, class_total double, keys array<long>, times array<int>"))
    return stored(out.withColumn("row_id", F.monotonically_increasing_id()), "lm-encoded")


@dataclass
class Model:
    """Vectors of units as context (one more for the place before a text), their own with a bias, weights of places, noise shares."""

    inner: np.ndarray
    outer: np.ndarray
    places: np.ndarray
    prior: np.ndarray

    @staticmethod
    def start(prior: np.ndarray, dim: int = DIM, context: int = CONTEXT, seed: int = 7) -> Model:
        """Small random vectors; biases make the scores the units' shares."""
        rng, n = np.random.default_rng(seed), len(prior)
        outer = np.concatenate([rng.normal(0, 0.1, (n, dim)), np.log(prior)[:, None]], 1)
        return Model(rng.normal(0, 0.3, (n + 1, dim)).astype(np.float32), outer.astype(np.float32), np.full((context, dim), 1 / context, np.float32), prior)

    def contexts(self, units: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The units before each position, nearest first; len(prior) where the text had not begun."""
        n, out = len(units), np.empty((len(self.places), len(units)), np.uint16)
        since = np.arange(n) - np.repeat(begins, np.diff([*begins, n]))
        for j in range(len(self.places)):
            out[j] = np.where(since > j, np.roll(units, j + 1), len(self.prior))
        return out

    def read(self, contexts: np.ndarray) -> np.ndarray:
        """The vector of each context."""
        total = np.zeros((contexts.shape[1], self.places.shape[1]), np.float32)
        for place, units in zip(self.places, contexts):
            total += self.inner[units] * place
        return total

    def log_probabilities(self, units: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """The natural log of each position's normalised probability; texts begin at `begins`."""
        contexts, out, one = self.contexts(units, begins), np.empty(len(units)), np.ones((BLOCK, 1), np.float32)
        outer, scores = np.ascontiguousarray(self.outer.T), np.empty((BLOCK, len(self.outer)), np.float32)
        for k in range(0, len(units), BLOCK):
            at = units[k : k + BLOCK]
            block = np.matmul(np.concatenate([self.read(contexts[:, k : k + BLOCK]), one[: len(at)]], 1), outer, out=scores[: len(at)])
            own = block[np.arange(len(at)), at].astype(np.float64)
            if block.max() > 80:  # beyond what the exponential of a 32-bit number holds
                block -= (shift := block.max(1, keepdims=True))
                own -= shift[:, 0]
            out[k : k + BLOCK] = own - np.log(np.exp(block, out=block) @ np.ones(len(self.outer), np.float32))
        return out


def _add_rows(n: int, index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct indices, sums of their rows, how many) of rows with repeated indices below n; short integers sort by digits."""
    index = index.astype(np.uint16 if n < 1 << 16 else np.int64, copy=False)
    order = np.argsort(index, kind="stable")
    index = index[order]
    begins = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
    return index[begins], np.add.reduceat(rows[order], begins, 0), np.diff([*begins, len(index)])


class Trainer:
    """One pass of noise-contrastive estimation over a task's texts, steps scaled by each row's past gradients."""

    def __init__(self, model: Model, seed: int, rate: float = RATE) -> None:
        self.model, self.rate, self.rng = model, rate, np.random.default_rng(seed)
        self.begun = [model.inner.copy(), model.outer.copy(), model.places.copy()]
        self.past = [np.full(len(x), 1e-2, np.float32) for x in self.begun]
        self.used = [np.zeros(len(x)) for x in self.begun]
        self.cumulative = np.cumsum(model.prior)
        self.noise_log = np.log(NOISE * model.prior).astype(np.float32)

    def _step(self, which: int, matrix: np.ndarray, rows: np.ndarray, gradient: np.ndarray, count: np.ndarray) -> None:
        self.past[which][rows] += (gradient * gradient).mean(1)
        matrix[rows] += self.rate * gradient / np.sqrt(self.past[which][rows])[:, None]
        self.used[which][rows] += count

    def batch(self, contexts: np.ndarray, targets: np.ndarray) -> None:
        """A step up the gradient for positions with these contexts and targets."""
        m, n = self.model, len(targets)
        q = m.read(contexts)
        q1 = np.concatenate([q, np.ones((n, 1), np.float32)], 1)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(NOISE)), len(m.prior) - 1)
        own, drawn = m.outer[targets], m.outer[noise]
        good = 1 / (1 + np.exp(np.einsum("ij,ij->i", q1, own) - self.noise_log[targets]))  # 1 - the chance that it is no noise
        bad = q1 @ np.concatenate([-drawn[:, :-1], (self.noise_log[noise] - drawn[:, -1])[:, None]], 1).T
        np.exp(bad, out=bad)
        bad += 1
        np.divide(np.float32(-1), bad, out=bad)  # less the chance that it is
        at_q = bad @ drawn[:, :-1]
        at_q += good[:, None] * own[:, :-1]
        index = np.concatenate([targets, noise])
        rows, gradient, count = _add_rows(len(m.prior), index, np.concatenate([good[:, None] * q1, bad.T @ q1]))
        seen = [m.inner[c] for c in contexts]
        inner = _add_rows(len(m.prior) + 1, contexts.ravel(), (m.places[:, None, :] * at_q).reshape(-1, at_q.shape[1]))
        places = np.stack([(at_q * s).sum(0) for s in seen])
        self._step(1, m.outer, rows, gradient, count)
        self._step(0, m.inner, inner[0], inner[1], inner[2])
        self._step(2, m.places, np.arange(len(places)), places, np.full(len(places), n))

    def texts(self, units: np.ndarray, begins: np.ndarray) -> None:
        contexts, order = self.model.contexts(units, begins), self.rng.permutation(len(units))
        for k in range(0, len(order), BATCH):
            at = order[k : k + BATCH]
            self.batch(contexts[:, at], units[at])

    def moved(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, uses, uses x move) of all three matrices, rows numbered through, for rows that were used."""
        now = [self.model.inner, self.model.outer, self.model.places]
        width = self.begun[1].shape[1]
        moves = np.concatenate([np.pad((a - b).astype(np.float64), ((0, 0), (0, width - a.shape[1]))) for a, b in zip(now, self.begun)])
        used = np.concatenate(self.used)
        rows = np.flatnonzero(used)
        return rows, used[rows], moves[rows] * used[rows, None]


def flat_units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Units of all texts of a column of packed units, and where each text begins."""
    values = column.to_pylist()
    sizes = np.array([len(v) // 2 for v in values], np.int64)
    return np.frombuffer(b"".join(values), "<u2"), np.cumsum(sizes) - sizes


def train(texts: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """`model` after one pass over `texts` (row_id, units; stored), a part of them in each round.

    A round sends the vectors to all tasks and sums up the moves of each row of them in Spark: a bounded
    number of rows comes back, however many tasks there are. Rows no task used stay.
    """
    width = model.outer.shape[1]
    names = [f"v{k}" for k in range(width)]
    for r in range(rounds):
        held = shared(texts.sparkSession, model)

        def run(batches: Iterator[pa.RecordBatch], held=held, r=r) -> Iterator[pa.RecordBatch]:
            trainer, waiting, n = None, [], 0
            for batch in batches:
                for value in batch.column(0).to_pylist():
                    trainer = trainer or Trainer(held(), r + zlib.crc32(value), RATE * (1 - r / rounds))
                    waiting.append(value)
                    n += len(value) // 2
                    if n > HELD:
                        trainer.texts(*flat_units(pa.array(waiting, pa.binary())))
                        waiting, n = [], 0
            if waiting:
                trainer.texts(*flat_units(pa.array(waiting, pa.binary())))
            if trainer:
                rows, used, moves = trainer.moved()
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(used), *(pa.array(np.ascontiguousarray(moves[:, k])) for k in range(width))], names=["at", "used", *names])
            give_back()

        part = texts.where(F.pmod(F.xxhash64("row_id"), F.lit(rounds)) == r).select("units")
        moved = part.mapInArrow(run, "at long, used double, " + ", ".join(f"{x} double" for x in names))
        got = moved.groupBy("at").agg(F.sum("used").alias("used"), *(F.sum(x).alias(x) for x in names)).toArrow()
        at, used = got.column("at").to_numpy(), got.column("used").to_numpy()
        step = np.zeros((len(model.inner) + len(model.outer) + len(model.places), width))
        step[at] = np.stack([got.column(x).to_numpy() for x in names], 1) / used[:, None]
        a, b = len(model.inner), len(model.inner) + len(model.outer)
        model = Model(model.inner + step[:a, :-1].astype(np.float32), model.outer + step[a:b].astype(np.float32), model.places + step[b:, :-1].astype(np.float32), model.prior)
    return model


def score(docs: DataFrame, learned: str, text: str = "text") -> DataFrame:
    """The columns of `docs` in a struct `row`, with n_tokens, n_known, train_tokens, base_score and score (both log10).

    The model learns from the rows for which the SQL condition `learned` over the columns of `docs` is true. Null texts
    count as empty, and an empty text has its end alone. Repeated rows count as often as they stand, and have one score.
    Without any row to learn from every word is unknown. Columns of `docs` may have any names.
    """
    counts = word_counts(docs.where(F.expr(learned)), text)
    known = statistics(counts)
    found = encoded(docs, known, learned, text)
    model = train(found.where("learned"), Model.start(known.prior))
    held, base = shared(docs.sparkSession, model), float(np.log10(known.total + 0.5 * (known.distinct + 1)))
    kept = found.select("row", "row_id", "n_tokens", "n_head", "log_count", "class_log", "class_total", "units")
    last = len(kept.columns) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held()
        for batch in batches:
            totals, values, begin = [], batch.column(last), 0
            sizes = np.cumsum([0, *(x // 2 for x in pa.compute.binary_length(values).to_pylist())])
            while begin < batch.num_rows:  # a longer text is taken alone
                end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + HELD, "right")) - 1)
                units, begins = flat_units(values.slice(begin, end - begin))
                totals.append(np.add.reduceat(model.log_probabilities(units, begins), begins))
                begin = end
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(np.concatenate([np.zeros(0), *totals]) / np.log(10))], names=[*batch.schema.names[:last], "unit_log"])
        give_back()

    scored = kept.mapInArrow(run, extended(kept.drop("units"), "unit_log double"))
    values = {"rest_log": F.log10(F.coalesce("n", F.lit(0)) + 0.5), "rest_known": F.col("n").isNotNull().cast("long")}
    out = with_sums(scored, joined_sums(found, "row_id", "keys", "times", counts.select("word", "n"), "word", values), "row_id")
    return out.select(
        "row", "n_tokens", (F.col("n_head") + F.col("rest_known")).alias("n_known"), F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("log_count") + F.col("rest_log") - F.col("n_tokens") * base).alias("base_score"), (F.col("unit_log") + F.col("class_log") + F.col("rest_log") - F.col("class_total")).alias("score"),
    )


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. A row without an id learns."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", 5) == 1)
    return score(docs, "NOT held_out").select("row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
