"""SentencePiece encoding and decoding with a public model file, each distinct word segmented once.

A text becomes marked words (spaces as U+2581, which opens a word). The distinct words of a
chunk are sorted, so that they form a trie in depth-first order, and the forward pass of the
segmentation keeps its states for the prefix that a word shares with the one before it.

For a unigram model the forward state of a position is the best score up to it and the piece
that gives it (Viterbi). For a BPE model a sum of scores does not give the merges' result, so
there the state is the last piece of the prefix's one BPE segmentation: the piece that may
follow, under the merge order, the last piece of the text before it. Either way the state
depends on the prefix alone, and the ids equal those of the model's own merges.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import boxed, extended, place, shared, table, unboxed
from .word_hashes import chunks, give_back

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
ONE = (1,)
#: Bytes of text taken at a time, distinct words and pairs of pieces kept per task before a cache starts anew.
CHUNK_BYTES, CACHE_WORDS, CACHE_PAIRS = 500_000, 120_000, 150_000


class Codec:
    """Pieces and scores of a model, and the forward pass over sorted words."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str], model: str, dummy_prefix: bool) -> None:
        self.model, self.dummy_prefix, self.scores = model, dummy_prefix, scores
        self.ids = {p: i for i, p in enumerate(pieces) if kinds[i] == "normal"}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(pieces) if kinds[i] == "byte"}
        self.unknown = kinds.index("unknown")
        byte_of = {i: b for b, i in self.byte_ids.items()}
        self.out = [bytes([byte_of[i]]) if i in byte_of else b"" if kinds[i] == "control" else " ⁇ ".encode() if kinds[i] == "unknown" else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        # A word ends where no piece runs across: before a mark and, after letters, before the characters that follow none in a piece.
        pairs = {p[j - 1 : j + 1] for p in self.ids for j in range(1, len(p))}
        after_letter = {b for a, b in pairs if a.isalpha()}
        ends = "".join(re.escape(c) for c in map(chr, range(128)) if c not in after_letter and not c.isalnum())
        free = f"{MARK}*[^\\W\\d_]+(?=[{ends}{MARK}]|$)|{MARK}*[^{MARK}]+|{MARK}+"
        self.words = re.compile(free if not any(b == MARK != a for a, b in pairs) else r"(?s).+")
        self.pieces, self.raw = pieces, [i.to_bytes(4, sys.byteorder) for i in range(len(pieces))]
        if model == "bpe":
            self._merge_order()
        # Lengths of the pieces that end with up to three given characters, longest first.
        ending: dict[str, set[int]] = {}
        for p in self.ids:
            ending.setdefault(p[-3:], set()).add(len(p))
        self.widths = {end: tuple(sorted(n | {k for k in (1, 2) if end[-k:] in self.ids}, reverse=True)) for end, n in ending.items()}
        self.pairs: dict[int, bool] = {}

    @staticmethod
    def load(path: str = MODEL) -> Codec:
        """Reads the model file (on the driver); unused pieces never appear."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(sp.get_piece_size())
        kinds = ["unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) else "byte" if sp.is_byte(i) else "unused" if sp.is_unused(i) else "normal" for i in n]
        from sentencepiece import sentencepiece_model_pb2

        spec = sentencepiece_model_pb2.ModelProto()
        spec.ParseFromString(sp.serialized_model_proto())
        if spec.normalizer_spec.name != "identity" or spec.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave the text as it is are supported")
        return Codec([sp.id_to_piece(i) for i in n], [sp.get_score(i) for i in n], kinds, {1: "unigram", 2: "bpe"}[spec.trainer_spec.model_type], spec.normalizer_spec.add_dummy_prefix)

    def _merge_order(self) -> None:
        """For a BPE model: when each piece is made (-1: a character), and of which two pieces last; `ids` keeps those that merges reach."""
        by_score = sorted((i for p, i in self.ids.items() if len(p) > 1), key=lambda i: (-self.scores[i], i))
        self.rank = [-1] * len(self.pieces)
        for k, i in enumerate(by_score):
            self.rank[i] = k
        self.left, self.right = list(range(len(self.pieces))), list(range(len(self.pieces)))
        reached = {p: i for p, i in self.ids.items() if len(p) == 1}
        for i in by_score:
            parts = [self.ids.get(c, -1) for c in self.pieces[i]]
            while -1 not in parts and len(parts) > 1:
                merges = [(self.rank[m], k, m) for k in range(len(parts) - 1) if (m := self.ids.get(self.pieces[parts[k]] + self.pieces[parts[k + 1]])) is not None]
                if not merges:
                    break
                _, k, made = min(merges)
                if len(parts) == 2:
                    self.left[i], self.right[i] = parts
                    reached[self.pieces[i]] = i
                parts[k : k + 2] = [made]
        self.merged, self.ids = self.ids, reached

    def follows(self, left: int, right: int) -> bool:
        """Whether the merges leave two pieces side by side.

        Going back in time from both pieces, the later made of the two at the seam is undone;
        the seam holds unless what then stands there would have merged before.
        """
        x, y, until, rank, pieces = left, right, len(self.rank), self.rank, self.pieces
        while True:
            across = self.merged.get(pieces[x] + pieces[y])
            if across is not None and rank[across] < until:
                return False
            if rank[x] > rank[y]:
                until, x = rank[x], self.right[x]
            elif rank[y] >= 0:
                until, y = rank[y] + 1, self.left[y]
            else:
                return True

    def _best(self, word: str, end: int, widths: tuple, best: list[float]) -> tuple[int, int]:
        """The piece that ends at `end` on the way of the best score, and its length; 0 for a character outside the vocabulary."""
        found, length, score = -1, 0, float("-inf")
        for width in widths:
            if width <= end and (i := self.ids.get(word[end - width : end])) is not None and best[end - width] + self.scores[i] > score:
                found, length, score = i, width, best[end - width] + self.scores[i]
        best.append(score if length else best[end - 1] - 1e6)
        return found, length

    def _last(self, word: str, end: int, widths: tuple, last: list[int]) -> tuple[int, int]:
        """The piece that ends at `end` in the merges' segmentation, and its length; 0 for a character outside the vocabulary."""
        ids, pairs = self.ids, self.pairs
        for width in widths:
            if width <= end and (i := ids.get(word[end - width : end])) is not None:
                if (before := last[end - width]) < 0:
                    return i, width
                seam = before << 32 | i
                if (fits := pairs.get(seam)) is None:
                    fits = pairs[seam] = self.follows(before, i)
                if fits:
                    return i, width
        return -1, 0

    def paths(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """(word, ids as 32-bit numbers) for sorted distinct words, sharing forward states along common prefixes.

        The state of a position: its last piece (-1: none), the ids up to it, for a unigram model its score.
        """
        before, last, path, best, widths_of, raw = "", [-1], [b""], [0.0], self.widths, self.raw
        state, seen = (self._last, last) if self.model == "bpe" else (self._best, best)
        for word in words:
            common = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                common += 1
            del last[common + 1 :], path[common + 1 :], best[common + 1 :]
            for end in range(common + 1, len(word) + 1):
                tail = word[end - 3 if end > 3 else 0 : end]
                found, width = state(word, end, widths_of.get(tail) or widths_of.get(tail[-2:]) or ONE, seen)
                last.append(found)
                path.append(path[end - width] + raw[found] if width else path[end - 1] + b"".join([raw[i] for i in self._spelled(word[end - 1])]))
            before = word
            yield word, path[-1]

    def _spelled(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode("utf-8", "replace")] if self.byte_ids else [self.unknown]

    def segment(self, words: list[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) for sorted distinct words."""
        return ((word, np.frombuffer(ids, np.int32).tolist()) for word, ids in self.paths(words))

    def spelled(self, ids: bytes) -> bytes:
        """The bytes of a word from its ids."""
        return b"".join([self.out[i] for i in np.frombuffer(ids, np.int32).tolist()])

    def split(self, text: str) -> list[str]:
        """The marked words of a text; none for an empty one."""
        return self.words.findall((MARK if self.dummy_prefix else "") + text.replace(" ", MARK)) if text else []

    def join(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become U+FFFD."""
        out = self.out
        text = b"".join([out[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


def encode(docs: DataFrame, codec: Codec, text: str = "text") -> DataFrame:
    """`docs` with piece_ids array<int> and round_trip boolean added (columns of those names are replaced).

    round_trip says whether the ids decode to the very text: each distinct word is decoded once and
    compared, and a text's bytes are those of its words. It is false where a text holds U+2581, which
    decodes to a space, as with any decoder of the model, and where a model without bytes lacks a
    character. A null text has nulls, an empty text no ids. Repeated rows stay; other
    columns may have any names.
    """
    docs = docs.drop("piece_ids", "round_trip")
    at, held, rows = place(docs, text), shared(docs.sparkSession, codec), boxed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, known, other = held(), {}, set()
        for batch in batches:
            lists, same = [], []
            for _, part in chunks(batch.column(0).field(at), CHUNK_BYTES):
                split = [t if t is None else codec.split(t) for t in part.to_pylist()]
                if len(known) > CACHE_WORDS:
                    known.clear()
                    other.clear()
                if len(codec.pairs) > CACHE_PAIRS:
                    codec.pairs.clear()
                new = sorted(set().union(*(w for w in split if w)) - known.keys())
                known.update(codec.paths(new))
                other.update(w for w in new if codec.spelled(known[w]) != w.replace(MARK, " ").encode())
                got = [None if words is None else np.frombuffer(b"".join([known[w] for w in words]), np.int32) for words in split]
                flat = np.concatenate([np.zeros(0, np.int32), *(g for g in got if g is not None)])
                offsets = np.cumsum([0, *(0 if g is None else len(g) for g in got)], dtype=np.int32)
                lists.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pa.array([g is None for g in got]) if got else None))
                marked = pa.compute.match_substring(part, MARK).to_pylist()
                same += [None if words is None else not has and other.isdisjoint(words) if other else not has for words, has in zip(split, marked)]
            ids = pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *lists])
            yield pa.RecordBatch.from_arrays([*batch.columns, ids, pa.array(same, pa.bool_())], names=[*batch.schema.names, "piece_ids", "round_trip"])
        del codec, known
        give_back()

    return unboxed(rows.mapInArrow(run, extended(rows, "piece_ids array<int>, round_trip boolean")), "piece_ids", "round_trip")


def decode(rows: DataFrame, codec: Codec, ids: str = "piece_ids", to: str = "decoded") -> DataFrame:
    """`rows` with the text of `ids` in the column `to`; null ids give null, ids outside the model fail."""
    rows = rows.drop(to)
    at, held, rows = place(rows, ids), shared(rows.sparkSession, codec), boxed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held()
        for batch in batches:
            texts = [None if x.as_py() is None else codec.join(x.as_py()) for x in batch.column(0).field(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, to])

    return unboxed(rows.mapInArrow(run, extended(rows, f"`{to}` string")), f"`{to}`")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_pieces (null for a null text), piece_ids, round_trip."""
    out = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), Codec.load())
    return out.select("doc_id", F.when(F.col("piece_ids").isNotNull(), F.size("piece_ids")).cast("long").alias("n_pieces"), "piece_ids", "round_trip")
