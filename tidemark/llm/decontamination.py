"""Benchmark decontamination by spaced seeds.

Fixed masks select some of the word positions of a window, so that a seed survives
substitutions at the others. Seeds of the benchmark's items are looked up among the seeds
at every position of every text; around each hit, on its diagonal, the item and the text
are compared word by word, and overlaps that tolerate substitutions are measured.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import boxed, extended, place, shared, table, unboxed
from .word_hashes import WORDLIKE, Hasher, chunks, give_back

#: Word offsets that count, for each mask: six words within at most eleven. The first is a plain run.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 4, 6, 7), (0, 2, 3, 5, 8, 9), (0, 1, 4, 6, 9, 10))
#: Words of an overlap that make a leak, the cost of a substitution in matching words, the
#: share of an item that its overlaps of at least SEED_WORDS must cover otherwise.
LONG, PENALTY, COVERED, SEED_WORDS = 13, 3, 0.6, 6
#: Words of benchmark searched in one pass; a larger one is searched in blocks of items.
BLOCK_WORDS = 2_000_000
HIT = "array<struct<item_id bigint, start bigint, matched bigint, longest bigint, coverage double>>"


def seeds(words: np.ndarray, mask: tuple[int, ...], which: int) -> np.ndarray:
    """The mask's hash at each position where it fits."""
    n = max(0, len(words) - mask[-1])
    total = np.full(n, which + 1, np.uint64)
    for k, at in enumerate(mask):
        total += words[at : at + n] * np.uint64(0xA0761D6478BD642F * (2 * k + 1) % (1 << 64) | 1)
    return total


class Index:
    """Seeds of a block of items, as sorted arrays behind a table of bits."""

    BITS = 22

    def __init__(self, items: list[tuple[int, np.ndarray]]) -> None:
        self.ids, self.words = [i for i, _ in items], [w for _, w in items]
        self.tables = []
        for which, mask in enumerate(MASKS):
            got = [seeds(w, mask, which) for w in self.words]
            hashes = np.concatenate([np.zeros(0, np.uint64), *got])
            item = np.repeat(np.arange(len(got)), [len(g) for g in got])
            at = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(g)) for g in got)])
            order = np.argsort(hashes, kind="stable")
            bits = np.zeros(1 << self.BITS, bool)
            bits[self._slot(hashes)] = True
            self.tables.append((mask, hashes[order], item[order], at[order], bits))

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)

    def diagonals(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Distinct rows (text, item, text position - item position) that share a seed."""
        found = [np.zeros((0, 3), np.int64)]
        for which, (mask, hashes, item, at, bits) in enumerate(self.tables):
            own = seeds(words, mask, which)
            near = np.flatnonzero(bits[self._slot(own)])
            low, high = np.searchsorted(hashes, own[near]), np.searchsorted(hashes, own[near], "right")
            near, low, n = near[high > low], low[high > low], (high - low)[high > low]
            text = np.searchsorted(bounds, near, "right") - 1
            fits = near + mask[-1] < bounds[text + 1]
            near, low, n, text = near[fits], low[fits], n[fits], text[fits]
            k = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            near, text = np.repeat(near, n), np.repeat(text, n)
            found.append(np.unique(np.stack([text, item[k], near - bounds[text] - at[k]], 1), axis=0))
        return np.unique(np.concatenate(found), axis=0)

    def overlaps(self, words: np.ndarray, item: int, shift: int) -> list[tuple[int, int, int, np.ndarray]]:
        """(text position, words, matching words, item positions) of each overlap on a diagonal.

        An overlap's gain is its matching words less PENALTY for each other word. The diagonal is cut
        where the running gain falls below zero, and each part has its overlap of the greatest gain, so
        at least PENALTY / (PENALTY + 1) of its words match, and it starts and ends with a match. What
        follows a part's overlap is searched again, for the part may hold more than one.
        """
        own = self.words[item]
        first, last = max(0, -shift), min(len(own), len(words) - shift)
        same = own[first:last] == words[first + shift : last + shift]
        sums = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
        hits, cuts = np.flatnonzero(same), np.flatnonzero(sums[1:] < np.minimum.accumulate(sums[:-1])) + 1
        found, at = [], 0
        while (k := int(np.searchsorted(hits, at))) < len(hits):
            begin, after = int(hits[k]), int(np.searchsorted(cuts, hits[k], "right"))
            gain = sums[begin + 1 : (cuts[after] if after < len(cuts) else len(same)) + 1] - sums[begin]
            below = np.flatnonzero(gain < 0)
            at = begin + 1 + int(gain[: below[0] if len(below) else len(gain)].argmax())
            found.append((first + shift + begin, at - begin, int(same[begin:at].sum()), first + begin + np.flatnonzero(same[begin:at])))
        return found

    def leaks(self, words: np.ndarray, rows: list[tuple[int, int]]) -> list[dict]:
        """The items of (item, shift) rows that leak into one text."""
        found = []
        for item in sorted({i for i, _ in rows}, key=lambda i: self.ids[i]):
            got = [o for i, shift in rows if i == item for o in self.overlaps(words, item, shift) if o[2] >= SEED_WORDS - 1]
            if not got:
                continue
            size = len(self.words[item])
            covered = np.unique(np.concatenate([o[3] for o in got])).size
            longest = max(o[1] for o in got)
            if longest >= min(LONG, size) or covered >= COVERED * size:
                found.append({"item_id": self.ids[item], "start": min(o[0] for o in got), "matched": covered, "longest": longest, "coverage": covered / size})
        return found


def indexes(benchmark: DataFrame, item: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> Iterator[Index]:
    """An index for each block of items; a block's items alone are on the driver at a time.

    Null ids or texts and items too short for any mask have no seeds. Of repeated ids each row counts.
    """
    rows = benchmark.where(F.col(item).isNotNull() & F.col(text).isNotNull()).select(F.col(item).cast("long").alias("item"), F.col(text).alias("text"))
    words = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-words // (6 * block_words)) or 1
    hasher = Hasher(WORDLIKE)
    for k in range(blocks):
        got = sorted(rows.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).collect())
        yield Index([(r.item, hasher(pa.array([r.text.lower()])).hashes) for r in got])


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", to: str = "leaks", item: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """`docs` with an array of the items that leak into each whole text (empty where clean; a column `to` is replaced).

    An item leaks if on some diagonal an overlap of LONG words (or of the whole item, where
    that is shorter) has three of four words equal, or if all overlaps on all diagonals together
    cover COVERED of its words. Null and empty texts are clean. Repeated rows stay; other columns may have any names.
    """
    docs = docs.drop(to)
    at, out, parts = place(docs, text), boxed(docs), []
    for k, index in enumerate(indexes(benchmark, item, item_text, block_words)):
        held, column = shared(docs.sparkSession, index), f"leaks_{k}"

        def run(batches: Iterator[pa.RecordBatch], held=held, column=column) -> Iterator[pa.RecordBatch]:
            index, hasher = held(), Hasher(WORDLIKE)
            for batch in batches:
                leaks: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                for first, part in chunks(batch.column(0).field(at)):
                    w = hasher(pa.compute.utf8_lower(part))
                    rows = index.diagonals(w.hashes, w.bounds).tolist()
                    by_text: dict[int, list] = {}
                    for t, i, shift in rows:
                        by_text.setdefault(t, []).append((i, shift))
                    for t, got in by_text.items():
                        leaks[first + t] = index.leaks(w.hashes[w.bounds[t] : w.bounds[t + 1]], got)
                kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int64()), ("matched", pa.int64()), ("longest", pa.int64()), ("coverage", pa.float64())]))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaks, kind)], names=[*batch.schema.names, column])
            give_back()

        out, parts = out.mapInArrow(run, extended(out, f"{column} {HIT}")), [*parts, column]
    return unboxed(out.select("row", F.concat(*parts).alias(to)), f"`{to}`")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each leak: doc_id, item_id, the overlap's first word, matching words, longest overlap, share of the item."""
    out = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
