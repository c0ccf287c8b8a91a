"""Text quality from weak labels.

Heuristic labellers vote good, bad or nothing on every text. Expectation-maximisation over the
counts of all vote patterns estimates how accurate each is, and gives each pattern a
posterior; the posteriors of a bounded sample train a hashed linear scorer, which reads words
as well as the labellers' measures, and scores every text. No labels are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import boxed, extended, place, shared, table, unboxed
from .word_hashes import WORDLIKE, Hasher, byte_class, chunks

#: Function words of the languages at hand.
FUNCTION_WORDS = (
    "the of and to in is it that for with as was on are be this by an or at from a not "
    "der die das und ist ein eine zu den dem mit von im auf nicht sich für auch "
    "le la les de des et un une est dans que qui pour en du au avec sur ce "
    "el los las del y es un una en por con para se no lo su"
).split()
MEASURES = ("log_words", "upper", "symbols", "digits", "exclaims", "bars", "distinct_words", "function_words", "word_length", "distinct_lines")
#: For each measure the values from which it votes bad (low, high) and the range that it votes good for; None: no such vote.
LABELLERS = {
    "log_words": ((1.7, None), (3.5, 9.0)),
    "upper": ((None, 0.4), (0.0, 0.15)),
    "symbols": ((None, 0.06), (0.0, 0.03)),
    "digits": ((None, 0.2), (0.0, 0.05)),
    "exclaims": ((None, 0.03), None),
    "bars": ((None, 0.02), None),
    "distinct_words": ((0.3, None), (0.45, 1.0)),
    "function_words": ((0.02, None), (0.1, 0.9)),
    "word_length": ((2.0, 12.0), (3.0, 9.0)),
    "distinct_lines": ((0.5, None), None),
}
#: Slots of the scorer, texts that train it, passes over them, first rate.
SLOTS, SAMPLE, EPOCHS, RATE, ROUNDS = 1 << 16, 2000, 30, 0.5, 60
#: Characters of the longest text that may train.
SAMPLE_CHARS = 200_000
#: How often at most a labeller finds good text bad; its thresholds are set that wide.
FALSE_ALARM = 0.002
LINES = ~byte_class((0x0A, 0x0A))


class Measurer:
    """Measures of texts, and their words' slots."""

    def __init__(self) -> None:
        self.words, self.lines = Hasher(WORDLIKE), Hasher(LINES)
        self.function = np.sort(self.words(pa.array([" ".join(FUNCTION_WORDS)])).hashes)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(measures by text, slots of all words, where each text's words begin and end)."""
        texts = texts.fill_null("").cast(pa.large_string())
        w, lines = self.words(texts), self.lines(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        size = np.diff(offsets)
        chars = np.maximum(size, 1)

        def share(*ranges: tuple[int, int]) -> np.ndarray:
            sums = np.concatenate([[0], np.cumsum(byte_class(*ranges)[data])])
            return np.diff(sums[offsets - offsets[0]]) / chars

        n = np.diff(w.bounds)
        at = np.minimum(np.searchsorted(self.function, w.hashes), len(self.function) - 1)
        common = np.diff(np.concatenate([[0], np.cumsum(self.function[at] == w.hashes)])[w.bounds])
        spans = list(zip(w.bounds.tolist(), w.bounds.tolist()[1:]))
        distinct = np.array([len(np.unique(w.hashes[a:b])) for a, b in spans], float)
        n_lines = np.diff(lines.bounds)
        distinct_lines = np.array([len(np.unique(lines.hashes[a:b])) for a, b in zip(lines.bounds.tolist(), lines.bounds.tolist()[1:])], float)
        letters = np.maximum(share((0x41, 0x5A), (0x61, 0x7A)), 1e-9)
        many = np.maximum(n, 1)
        word_share = share((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
        measures = [
            np.log1p(n), share((0x41, 0x5A)) / letters * (n > 0), share((0x23, 0x26), (0x2A, 0x2B), (0x3C, 0x40), (0x5B, 0x60), (0x7B, 0x7B), (0x7D, 0x7E)), share((0x30, 0x39)), share((0x21, 0x21)), share((0x7C, 0x7C)),
            np.where(n > 0, distinct / many * np.maximum(1, np.sqrt(n / 200)), 1.0), common / many, word_share * size / many, np.where(n_lines > 0, distinct_lines / np.maximum(n_lines, 1), 1.0),
        ]
        return np.stack(measures, 1), (w.hashes >> np.uint64(48)).astype(np.int32), w.bounds


def votes(measures: np.ndarray) -> np.ndarray:
    """1 good, -1 bad, 0 neither, by text and labeller."""
    out = np.zeros(measures.shape, np.int8)
    for k, name in enumerate(MEASURES):
        (low, high), good = LABELLERS[name]
        x = measures[:, k]
        if good:
            out[(x >= good[0]) & (x <= good[1]), k] = 1
        if low is not None:
            out[x < low, k] = -1
        if high is not None:
            out[x > high, k] = -1
    return out


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The probability of good for each vote pattern, by expectation-maximisation over their counts.

    A labeller has a distribution over its votes given either truth, with at most FALSE_ALARM for
    finding good text bad (without that bound, rare kinds of bad text are taken for good ones
    with an odd vote), smoothed by votes that
    are right; it starts from a doubt in every text that anyone finds bad.
    """
    p = np.where((patterns == -1).any(1), 0.1, np.where((patterns == 1).any(1), 0.9, 0.5))
    for _ in range(rounds):
        odds = np.full(len(patterns), np.log((counts @ p + 1) / (counts @ (1 - p) + 1)))
        for k in range(patterns.shape[1]):
            tables = []
            for q, right in ((p, 1), (1 - p, -1)):
                total = np.array([(counts * q)[patterns[:, k] == v].sum() + 1.0 + 0.01 * counts.sum() * (v == right) for v in (-1, 0, 1)])
                total /= total.sum()
                if right > 0:
                    total[0] = min(total[0], FALSE_ALARM)
                tables.append(np.log(total))
            odds += (tables[0] - tables[1])[patterns[:, k] + 1]
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return p


class Scorer:
    """A weight for each measure and slot, with the measures' scales."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, dense: np.ndarray, slots: np.ndarray, bias: float) -> None:
        self.mean, self.scale, self.dense, self.slots, self.bias = mean, scale, dense, slots, bias

    def __call__(self, measures: np.ndarray, slots: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.slots[slots])])
        words = np.diff(sums[bounds]) / np.maximum(np.diff(bounds), 1)
        odds = np.clip((measures - self.mean) / self.scale, -4, 4) @ self.dense + words + self.bias
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def train(texts: list[str | None], good: np.ndarray, measurer: Measurer, seed: int = 3) -> Scorer:
    """Logistic regression on soft labels, by averaged stochastic gradient descent."""
    measures, slots, bounds = measurer(pa.array(texts, pa.large_string()))
    mean, scale = measures.mean(0), measures.std(0) + 1e-6
    model = Scorer(mean, scale, np.zeros(len(MEASURES)), np.zeros(SLOTS), 0.0)
    x = np.clip((measures - mean) / scale, -4, 4)
    rng = np.random.default_rng(seed)
    for epoch in range(EPOCHS):
        rate = RATE / (1 + epoch / 5)
        for at in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 32)):
            rows = [slots[bounds[t] : bounds[t + 1]] for t in at]
            n = np.array([max(1, len(r)) for r in rows])
            words = np.array([model.slots[r].sum() for r in rows]) / n
            d = 1 / (1 + np.exp(-(x[at] @ model.dense + words + model.bias))) - good[at]
            model.dense -= rate * (x[at].T @ d / len(at) + 1e-3 * model.dense)
            model.bias -= rate * d.mean()
            model.slots -= rate * 20 * np.bincount(np.concatenate(rows), np.repeat(d / n, [len(r) for r in rows]), SLOTS) / len(at)
    return model


def learn(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = SAMPLE, longest: int = SAMPLE_CHARS) -> Scorer | None:
    """Counts the vote patterns of all texts, then trains on about `sample` of them, by the hash of `key`.

    The counts that reach the driver are bounded by the patterns there can be (three votes to the
    power of the labellers), the sample by its rows and by `longest`, the characters of a text that
    may train (longer ones are counted, and scored, but do not train). The sample is put in the order
    of hash, key and text, so that neither files nor partitions change a score. None for an empty table.
    """
    docs = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measurer = Measurer()
        for batch in batches:
            got = [bytes((row + 1).tolist()) for _, part in chunks(batch.column(0)) for row in votes(measurer(part)[0])]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.binary())], names=["votes"])

    rows = sorted(docs.select("text").mapInArrow(run, "votes binary").groupBy("votes").count().collect(), key=lambda r: bytes(r.votes))
    if not rows:
        return None
    patterns = np.array([np.frombuffer(bytes(r.votes), np.uint8) for r in rows]).astype(np.int8) - 1
    counts = np.array([r["count"] for r in rows], float)
    known = {bytes(r.votes): p for r, p in zip(rows, posteriors(patterns, counts))}
    unit = F.xxhash64(F.col("key").cast("string"), F.lit(23)).cast("double") / F.lit(2.0**64) + 0.5
    fits = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= longest).select(unit.alias("unit"), F.col("key").cast("string").alias("key"), "text")
    picked = fits.where(F.col("unit") * float(counts.sum()) < sample).collect() or fits.orderBy("unit", "key", "text").limit(1).collect()
    texts = [r.text for r in sorted(picked, key=lambda r: (r.unit, r.key or "", r.text or ""))]
    if not texts:
        return None
    measurer = Measurer()
    good = np.array([known.get(bytes((v + 1).tolist()), 0.5) for v in votes(measurer(pa.array(texts, pa.large_string()))[0])])
    return train(texts, good, measurer)


def score(docs: DataFrame, model: Scorer | None, text: str = "text", to: str = "quality") -> DataFrame:
    """`docs` with a score between 0 and 1 (1: good) for each whole text; a column `to` is replaced.

    A null text scores as an empty one; without a model every score is null. Repeated rows stay; other columns may have any names.
    """
    docs = docs.drop(to)
    at, held, rows = place(docs, text), shared(docs.sparkSession, model), boxed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, measurer = held(), Measurer()
        for batch in batches:
            got = [model(*measurer(part)) for _, part in chunks(batch.column(0).field(at))] if model else []
            scores = pa.array(np.concatenate([np.zeros(0), *got])) if model else pa.nulls(batch.num_rows, pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, to])

    return unboxed(rows.mapInArrow(run, extended(rows, f"`{to}` double")), f"`{to}`")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, score, keep (score of at least one half)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, learn(docs)).select("doc_id", F.col("quality").alias("score"), (F.col("quality") >= 0.5).alias("keep"))
