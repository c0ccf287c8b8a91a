"""Toxicity by subword-bag embeddings.

A word is the mean of the vectors of its character n-grams and of itself, all in one hashed
table; a linear softmax over two classes reads it (of two classes, one difference of weights).
Vectors and weights are trained jointly in numpy, from a start at the n-grams' log-odds: from a
random one all words of a text weigh the same, and insults may never stand out of the frequent words'
noise. A text's log-odds are the soft mean of its
words' (the log of the mean of exponentials, at a temperature): in the plain mean a few insults
in a long text vanish, and in a sum of exponentials clean texts would grow toxic by length. A
text that is repeated keeps its score. The whole text is read.
Since everything above the table is linear, a trained word is one number, kept per task.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import boxed, extended, fold, place, sampled, shared, small, table, unboxed, written
from .word_hashes import chunks

#: Slots of the table, numbers of a vector, n-gram lengths.
SLOTS, DIM, GRAMS = 1 << 16, 4, (3, 4, 5)
#: Labelled texts sampled for training, of each class, and characters of the longest that may train;
#: texts of a step; steps; first rate; temperature of the soft mean.
SAMPLE, SAMPLE_CHARS, BATCH, STEPS, RATE, SOFT = 1500, 200_000, 128, 400, 0.4, 0.5
#: The start: share of texts added to both classes' shares in a log-odds, and its multiple that a slot begins with.
START_SHARE, START = 0.05, 3.0
#: Distinct words kept per task before the cache starts anew.
CACHE_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]+")


def grams(word: str) -> list[int]:
    """Table slots of a word: itself and its n-grams between marks."""
    raw = f"<{word}>".encode()
    text = f"<{word}>"
    found = [zlib.crc32(raw) % SLOTS]
    for n in GRAMS:
        found += [zlib.crc32(text[k : k + n].encode()) % SLOTS for k in range(len(text) - n + 1)]
    return found


def _bags(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slots of all words, where each word's slots begin)."""
    lists = [grams(w) for w in words]
    return np.fromiter((g for x in lists for g in x), np.int32), np.cumsum([0, *map(len, lists)])[:-1]


def _sums(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, values[:, d], n) for d in range(values.shape[1])], 1)


class Model:
    """Vectors, class weights, a bias."""

    def __init__(self, vectors: np.ndarray, weights: np.ndarray, bias: float) -> None:
        self.vectors, self.weights, self.bias = vectors, weights, bias
        self.slot_score = (vectors @ weights).astype(np.float64)

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        slots, first = _bags(words)
        return np.add.reduceat(self.slot_score[slots], first) / np.diff([*first, len(slots)])

    def score(self, scores: list[float]) -> float:
        """The probability for a text from its words' scores; a text without words has the bias alone."""
        if not scores:
            return float(1 / (1 + np.exp(-self.bias)))
        odds = np.array(scores)
        top = odds.max()
        z = top + SOFT * np.log(np.exp((odds - top) / SOFT).mean()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class _Batch:
    """Index arrays of some texts: n-gram slots of their distinct words, words of texts."""

    def __init__(self, texts: list[str]) -> None:
        words: dict[str, int] = {}
        lists = [[words.setdefault(w, len(words)) for w in WORD.findall(text.lower())] or [words.setdefault("", len(words))] for text in texts]
        self.slots, self.first = _bags(list(words))
        self.count = np.diff([*self.first, len(self.slots)]).astype(np.float32)
        self.word_of = np.repeat(np.arange(len(words)), self.count.astype(int))
        self.ids = np.fromiter((w for x in lists for w in x), np.int64)
        self.size = np.array([len(x) for x in lists])
        self.begins, self.text_of = np.cumsum(self.size) - self.size, np.repeat(np.arange(len(texts)), self.size)

    def gradients(self, vectors: np.ndarray, w: np.ndarray, b: float, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        word = np.add.reduceat(vectors[self.slots], self.first, 0) / self.count[:, None]
        odds = (word @ w)[self.ids]
        top = np.maximum.reduceat(odds, self.begins)
        e = np.exp((odds - top[self.text_of]) / SOFT)
        total = np.add.reduceat(e, self.begins)
        p = 1 / (1 + np.exp(-(top + SOFT * np.log(total / self.size) + b)))
        d = (p - y) * weight
        d_odds = np.bincount(self.ids, d[self.text_of] * e / total[self.text_of], len(self.count))
        d_word = d_odds[:, None] * w / self.count[:, None]
        return _sums(self.slots, d_word[self.word_of], SLOTS), word.T @ d_odds, d.sum()


def _log_odds(batches: list[tuple[_Batch, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Per slot: the log of the share of texts with label 1 that hold it over that of the others."""
    held, n = np.zeros((2, SLOTS)), np.zeros(2)
    for batch, y, _ in batches:
        text, word = np.divmod(np.unique(batch.text_of * len(batch.count) + batch.ids), len(batch.count))
        size = batch.count[word].astype(np.int64)
        at = np.repeat(batch.first[word] - np.cumsum(size) + size, size) + np.arange(size.sum())
        text, slot = np.divmod(np.unique(np.repeat(text, size) * SLOTS + batch.slots[at]), SLOTS)
        for label in (0, 1):
            held[label] += np.bincount(slot[y[text] == label], minlength=SLOTS)
            n[label] += (y == label).sum()
    share = held / np.maximum(n, 1)[:, None] + START_SHARE
    return np.log(share[1] / share[0])


def train(texts: list[str], labels: list[int], prior: float, seed: int = 5) -> Model:
    """Stochastic gradient descent with momentum, both classes weighing the same; texts are shuffled once.

    A slot's step is in proportion to its gradient, so n-grams seen in few texts hardly move. `prior`:
    the share of label 1 among all labelled rows; the bias is moved half the way back to it.
    """
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    y = np.array(labels, np.float32)
    weight = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    batches = [(_Batch([texts[i] for i in at]), y[at], weight[at] / len(at)) for at in (order[k : k + BATCH] for k in range(0, len(order), BATCH))]
    vectors, w, b = rng.normal(0, 0.05, (SLOTS, DIM)), rng.normal(0, 1.0, DIM), -1.0
    vectors = (vectors + START * _log_odds(batches)[:, None] * w / (w @ w)).astype(np.float32)
    speed, speed_w, speed_b, scale = np.zeros_like(vectors), np.zeros(DIM), 0.0, 0.0
    steps = max(1, -(-STEPS // len(batches))) * len(batches)
    for step in range(steps):
        batch, own, own_weight = batches[step % len(batches)]
        g, g_w, g_b = batch.gradients(vectors, w, b, own, own_weight)
        scale = max(0.95 * scale, float(np.abs(g).max()))
        rate = RATE * (1 - step / steps)
        speed = 0.8 * speed - rate * g.astype(np.float32) / (scale + 1e-12)
        speed_w, speed_b = 0.8 * speed_w - 0.3 * rate * g_w, 0.8 * speed_b - 0.3 * rate * g_b
        vectors += speed
        w, b = w + speed_w, b + speed_b
    return Model(vectors, w, float(b + 0.5 * np.log(max(prior, 1e-3) / max(1 - prior, 1e-3))))


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", sample: int = SAMPLE, longest: int = SAMPLE_CHARS) -> Model | None:
    """Trains on a bounded sample of labelled texts: about `sample` of each class, by the hash of the id.

    Counts of the classes are over all labelled rows. Rows with a null label, id or text, and texts of
    more than `longest` characters, teach nothing; None if not both classes are there.
    """
    known = labels.select(F.col(f"`{key}`").alias("key"), (F.col(f"`{label}`") > 0).cast("int").alias("label")).where("key IS NOT NULL AND label IS NOT NULL")
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return None
    picked = small(written(sampled(known, "label", "key", sample)))
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where(F.length("text") <= longest)
    rows = texts.join(picked, "key").select("key", "label", "text").collect()
    rows = sorted(rows)
    return train([r[2] for r in rows], [r[1] for r in rows], counts[1] / (counts[0] + counts[1])) if len({r[1] for r in rows}) == 2 else None


def score(docs: DataFrame, model: Model | None, text: str = "text", to: str = "toxicity") -> DataFrame:
    """`docs` with a probability for each text (a column `to` is replaced); null texts score as empty, 0 without a model. Other columns may have any names."""
    docs = docs.drop(to)
    at, held, rows = place(docs, text), shared(docs.sparkSession, model), boxed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = held(), {}
        for batch in batches:
            got: list[float] = []
            for _, part in chunks(batch.column(0).field(at)):
                lists = [WORD.findall((t or "").lower()) for t in part.to_pylist()]
                if len(known) > CACHE_WORDS:
                    known.clear()
                new = sorted(set().union(*lists) - known.keys()) if model else []
                known.update(zip(new, model.word_scores(new).tolist() if model else []))
                got += [model.score([known[w] for w in words]) if model else 0.0 for words in lists]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*batch.schema.names, to])

    return unboxed(rows.mapInArrow(run, extended(rows, f"`{to}` double")), f"`{to}`")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Labels of the held-out fifth are never read."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = learn(docs, labels.where(fold("doc_id", 5) != 0))
    out = score(docs.select("doc_id", "text"), model)
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))
