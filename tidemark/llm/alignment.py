"""Alignment of two tokenizers on the same text by products of token-byte incidence matrices.

Each tokenizer cuts a text's bytes into tokens: an incidence matrix with a row for each token and
a column for each byte. The row products A x B^T (Gustavson's order: for each entry of a row of A
the row of B^T that it points at, summed up) have an entry for each two tokens that share bytes,
and the number of bytes as its value. Bytes at which tokens of both end cut the tokens into
groups; with the tokens' group incidence in place of bytes the product links tokens of one group.

Before a blank between a character and a letter, and between a letter and punctuation that no piece
of the model has after one, neither tokenizer has a token that runs across, and the tokens of both
sides do not depend on each other. Texts are cut there; each distinct part of a task's texts is
encoded and multiplied once, all new parts of a chunk as one block-diagonal matrix.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .heads import HEAD, arrays, head_sums, heaviest, joined_sums, stored, with_sums
from .tables import extended, shared, table, written
from .word_hashes import chunks, give_back

BYTE_MODEL, PIECE_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Letters of Latin scripts, and texts whose characters both libraries of the byte-level model class alike.
LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[ -~{LATIN}]*")
#: Bytes of text taken at a time; distinct parts, and links of them, kept per task before the cache starts anew.
CHUNK_BYTES, CACHE_PARTS, CACHE_LINKS = 500_000, 200_000, 4_000_000
#: Entries that a product expands at a time.
BLOCK = 2_000_000


@dataclass
class Csr:
    """A sparse matrix by rows: row i has the columns indices[indptr[i]:indptr[i + 1]] with the values data."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @staticmethod
    def intervals(ends: np.ndarray) -> Csr:
        """Rows of ones over consecutive columns: row i from the end of row i - 1 to ends[i]."""
        n = int(ends[-1]) if len(ends) else 0
        return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(n), np.ones(n, np.int64), n)

    @staticmethod
    def single(column_of: np.ndarray, columns: int) -> Csr:
        """One entry, a one, in each row."""
        return Csr(np.arange(len(column_of) + 1), column_of, np.ones(len(column_of), np.int64), columns)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.columns))])
        return Csr(indptr, self.rows()[order], self.data[order], len(self.indptr) - 1)

    def products(self, other: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, columns, values) of self x other in row order, some rows at a time.

        Every entry (i, k) takes the whole row k of `other`, times its value; equal columns of a row add up.
        Rows are taken together while they expand to at most BLOCK entries.
        """
        width = np.diff(other.indptr)[self.indices]
        reach = np.concatenate([[0], np.cumsum(width)])[self.indptr]
        row_of, begin, n = self.rows(), 0, len(self.indptr) - 1
        while begin < n:
            end = max(begin + 1, int(np.searchsorted(reach, reach[begin] + BLOCK, "right")) - 1)
            at = slice(self.indptr[begin], self.indptr[end])
            w = width[at]
            entry = np.repeat(np.arange(len(w)), w)
            source = np.arange(len(entry)) - np.repeat(np.cumsum(w) - w, w) + np.repeat(other.indptr[self.indices[at]], w)
            key = row_of[at][entry] * max(1, other.columns) + other.indices[source]
            value = self.data[at][entry] * other.data[source]
            if len(key) and (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
            key = key[first]
            yield key // max(1, other.columns), key % max(1, other.columns), np.add.reduceat(value, first) if len(first) else value
            begin = end

    def times(self, other: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All of `products` at once."""
        parts = list(self.products(other)) or [(np.zeros(0, np.int64),) * 3]
        return tuple(np.concatenate(x) for x in zip(*parts))


@dataclass
class Aligned:
    """A and B tokens of texts in order, with the groups and links between them.

    a_ids, b_ids; group_a, group_b: the group of each token; links: (A token, B token, shared bytes), and for
    each group the number of its links, one for each A and B token in it.
    """

    a_ids: np.ndarray
    b_ids: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    links: tuple[np.ndarray, np.ndarray, np.ndarray]
    shared: np.ndarray


def align_tokens(a_ids: np.ndarray, a_ends: np.ndarray, b_ids: np.ndarray, b_ends: np.ndarray) -> Aligned:
    """Alignment of two sequences of tokens by the bytes at which they end."""
    ends = np.zeros((2, int(max([0, *a_ends[-1:], *b_ends[-1:]])) + 1), bool)
    ends[0, a_ends], ends[1, b_ends] = True, True
    cut = ends.all(0)
    both, group = np.flatnonzero(cut), np.cumsum(cut)
    group_a, group_b = group[a_ends - 1], group[b_ends - 1]  # cuts before a token's last byte
    links = Csr.intervals(a_ends).times(Csr.intervals(b_ends).transposed())
    # In a group's row of the product of counts stands how many pairs of its tokens share it.
    of_a, of_b = Csr.single(group_a, len(both)).transposed(), Csr.single(group_b, len(both)).transposed()
    ones_a, ones_b = Csr.single(np.zeros(len(a_ids), np.int64), 1), Csr.single(np.zeros(len(b_ids), np.int64), 1)
    (_, _, n_a), (_, _, n_b) = of_a.times(ones_a), of_b.times(ones_b)
    return Aligned(a_ids, b_ids, group_a, group_b, links, n_a * n_b)


def shared_group_links(aligned: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(A token, B token) of one group, from the product of the group incidences, some rows at a time."""
    n = len(aligned.shared)
    for a, b, _ in Csr.single(aligned.group_a, n).products(Csr.single(aligned.group_b, n).transposed()):
        yield a, b


def byte_letters() -> dict[str, int]:
    """The byte for each letter of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


@dataclass
class Files:
    """Both models' files as read on the driver, so that executors need none."""

    byte_model: str
    piece_model: bytes

    @staticmethod
    def load(byte_model: str = BYTE_MODEL, piece_model: str = PIECE_MODEL) -> Files:
        with open(byte_model, encoding="utf-8") as a, open(piece_model, "rb") as b:
            return Files(a.read(), b.read())


class Encoders:
    """Both tokenizers with the bytes of each id."""

    def __init__(self, files: Files) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(files.byte_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.piece_model)
        letters, n = byte_letters(), self.a.get_vocab_size(with_added_tokens=True)
        entries = (self.a.id_to_token(i) or "" for i in range(n))
        self.a_bytes = [bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode() for entry in entries]
        m = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(m)]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("only models whose pieces have blanks at the front alone are supported")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.sizes = np.array([len(x) for x in self.a_bytes]), np.array([len(x) for x in self.b_bytes])
        self.names = [str(i) for i in range(max(n, m))]
        after = {b for p in pieces for a, b in zip(p, p[1:]) if re.match(f"[{LATIN}]", a)}
        seams = "".join(re.escape(c) for c in map(chr, range(33, 127)) if not c.isalnum() and c not in after) if len(self.b.encode("a")) == 1 else ""
        self.parts = re.compile(f"(?<=[!-~{LATIN}])(?= [{LATIN}])" + (f"|(?<=[{LATIN}])(?=[{seams}])" if seams else ""))
        self.ranks = self._ranks(json.loads(files.byte_model)["model"])

    def _ranks(self, model: dict):
        """An encoder by ranks of the same vocabulary, several times as fast; none if ids are not in the order of the merges."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocabulary = {self.a_bytes[i]: i for entry, i in model["vocab"].items()}
        single = sorted(i for b, i in vocabulary.items() if len(b) == 1)
        if len(single) != 256 or [model["vocab"].get(x + y) for x, y in merges] != list(range(256, 256 + len(merges))) or single != list(range(256)) or len(vocabulary) != 256 + len(merges):
            return None
        import tiktoken

        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})

    def split(self, text: str | None) -> list[str]:
        """The parts of a blank and the text; none without text."""
        return self.parts.split(" " + text) if text else []

    def __call__(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for parts of texts. B adds a blank itself; where a part has none, it follows a letter, which is one piece."""
        encode = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        plain = [self.ranks is not None and PLAIN.fullmatch(p) is not None for p in parts]
        rest = iter([x.ids for x in encode([p for p, ok in zip(parts, plain) if not ok], add_special_tokens=False)])
        ordinary = self.ranks.encode_ordinary if self.ranks else None
        a = [ordinary(p) if ok else next(rest) for p, ok in zip(parts, plain)]
        b = self.b.encode([p[1:] if p[0] == " " else "a" + p for p in parts], num_threads=1)
        return a, [ids if p[0] == " " else ids[1:] for p, ids in zip(parts, b)]


#: Columns that align() can add: how each is made from a text's parts, and its type.
OUTPUTS = {
    "n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_group_links": "long", "a_ids": "array<int>", "b_ids": "array<int>", "groups": "string",
    "pairs": "array<long>", "times": "array<int>", "links": "array<struct<a:int,b:int,bytes:int>>",
}


def ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all ranges one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(begins - (np.cumsum(sizes) - sizes), sizes)


class Parts:
    """Distinct parts of texts with their alignments, in arrays by the number of the part.

    Of a part: its tokens of A and of B, links (A token, B token, bytes; tokens from its first), the pair of each link as
    a * (size of B's vocabulary) + b, groups and pairs of tokens in one group as numbers, and the groups as text. `good` says
    whether both tokenizers keep its bytes; other parts have nothing.
    """

    COUNTS = ("n_a", "n_b", "n_links", "n_groups", "n_group_links")

    def __init__(self, encoders: Encoders) -> None:
        self.encoders = encoders
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.texts: list[str] = []
        self.counts = np.zeros((5, 0), np.int64)
        self.good = np.zeros(0, bool)
        self.a_ids, self.b_ids, self.links, self.pairs = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros((0, 3), np.int32), np.zeros(0, np.int64)
        self.begins = np.zeros((3, 0), np.int64)

    def full(self) -> bool:
        return len(self.known) > CACHE_PARTS or len(self.pairs) > CACHE_LINKS

    def add(self, parts: list[str]) -> None:
        """Encodes new parts and multiplies them all together, as one block-diagonal matrix."""
        lists = self.encoders(parts)
        sizes, names = self.encoders.sizes, (self.encoders.a_bytes, self.encoders.b_bytes)
        want = [p.encode() for p in parts]
        flat = [np.fromiter(chain.from_iterable(ids), np.int64) for ids in lists]
        n = np.array([list(map(len, ids)) for ids in lists], np.int64).reshape(2, len(parts))
        good = np.ones(len(parts), bool)
        for ids, own, count, size in zip(flat, names, n, sizes):
            ends = np.concatenate([[0], np.cumsum(size[ids])])[np.cumsum(count)]
            if b"".join([own[i] for i in ids.tolist()]) != b"".join(want) or (ends != np.cumsum([len(w) for w in want])).any():
                cuts = np.cumsum([0, *count]).tolist()
                good &= np.array([b"".join([own[i] for i in ids[x:y].tolist()]) == w for x, y, w in zip(cuts, cuts[1:], want)])
        flat = [ids[np.repeat(good, count)] for ids, count in zip(flat, n)]
        n = n * good
        al = align_tokens(flat[0], np.cumsum(sizes[0][flat[0]]), flat[1], np.cumsum(sizes[1][flat[1]]))
        first_a, first_b = np.cumsum(n[0]) - n[0], np.cumsum(n[1]) - n[1]
        part_of = np.repeat(np.arange(len(parts)), n[0])
        link_a, link_b, size = al.links
        link_part = part_of[link_a]
        n_links = np.bincount(link_part, minlength=len(parts))
        ends = [np.searchsorted(g, np.arange(len(al.shared)), "right") for g in (al.group_a, al.group_b)]
        group_part = part_of[ends[0] - 1]
        n_groups = np.bincount(group_part, minlength=len(parts))
        self.texts += self._texts(flat, ends, n_groups)
        before = len(self.known)
        self.known.update(zip(parts, range(before, before + len(parts))))
        self.begins = np.concatenate([self.begins, np.stack([first_a + len(self.a_ids), first_b + len(self.b_ids), np.cumsum(n_links) - n_links + len(self.pairs)])], 1)
        self.counts = np.concatenate([self.counts, np.stack([n[0], n[1], n_links, n_groups, np.bincount(group_part, al.shared, len(parts)).astype(np.int64)])], 1)
        self.good = np.concatenate([self.good, good])
        self.a_ids, self.b_ids = np.concatenate([self.a_ids, flat[0].astype(np.int32)]), np.concatenate([self.b_ids, flat[1].astype(np.int32)])
        self.links = np.concatenate([self.links, np.stack([link_a - first_a[link_part], link_b - first_b[link_part], size], 1).astype(np.int32)])
        self.pairs = np.concatenate([self.pairs, flat[0][link_a] * len(names[1]) + flat[1][link_b]])

    def _texts(self, flat: list[np.ndarray], ends: list[np.ndarray], n_groups: np.ndarray) -> list[str]:
        """The groups of each part as text."""
        a, b = (list(map(self.encoders.names.__getitem__, ids.tolist())) for ids in flat)
        groups, i, k = [], 0, 0
        for j, m in zip(ends[0].tolist(), ends[1].tolist()):
            groups.append(f"{a[i]}|{b[k]}" if j == i + 1 and m == k + 1 else f"{','.join(a[i:j])}|{','.join(b[k:m])}")
            i, k = j, m
        cuts = np.cumsum([0, *n_groups]).tolist()
        return [groups[x] if y == x + 1 else ";".join(groups[x:y]) for x, y in zip(cuts, cuts[1:])]

    def columns(self, split: list[list[str]], outputs: tuple[str, ...]) -> list[pa.Array]:
        """The columns `outputs` of texts given as lists of parts that are known."""
        ids = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64)
        text_of = np.repeat(np.arange(len(split)), [len(x) for x in split])
        bad = np.zeros(len(split), bool)
        bad[text_of[~self.good[ids]]] = True
        keep = ~bad[text_of]
        ids, text_of = ids[keep], text_of[keep]
        made: dict[str, pa.Array] = {}
        for name, counts in zip(self.COUNTS, self.counts):
            if name in outputs:
                made[name] = pa.array(np.bincount(text_of, counts[ids], len(split)).astype(np.int64))
        if "groups" in outputs:
            texts, cuts = self.texts, np.searchsorted(text_of, np.arange(len(split) + 1)).tolist()
            each = ids.tolist()
            made["groups"] = pa.array([";".join([texts[i] for i in each[x:y]]) for x, y in zip(cuts, cuts[1:])], pa.string())
        for name, values, row in (("a_ids", self.a_ids, 0), ("b_ids", self.b_ids, 1)):
            if name in outputs:
                made[name] = _lists(values[ranges(self.begins[row][ids], self.counts[row][ids])], np.bincount(text_of, self.counts[row][ids], len(split)))
        if {"pairs", "times", "links"} & set(outputs):
            sizes = self.counts[2][ids]
            at, of = ranges(self.begins[2][ids], sizes), np.repeat(text_of, sizes)
            if "links" in outputs:  # tokens are numbered on from part to part
                first = [self.counts[row][ids] for row in (0, 1)]
                shift = [np.cumsum(f) - f for f in first]
                shift = [x - x[np.searchsorted(text_of, text_of)] for x in shift] if len(ids) else shift
                links = self.links[at] + np.stack([np.repeat(shift[0], sizes), np.repeat(shift[1], sizes), np.zeros(len(at), np.int64)], 1)
                made["links"] = _lists(pa.StructArray.from_arrays([pa.array(links[:, c].astype(np.int32)) for c in range(3)], ["a", "b", "bytes"]), np.bincount(of, minlength=len(split)))
            order = np.lexsort([self.pairs[at], of])
            pair, of = self.pairs[at][order], of[order]
            new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (of[1:] != of[:-1])])[: len(pair)])
            per_text = np.bincount(of[new], minlength=len(split))
            made["pairs"], made["times"] = _lists(pair[new], per_text), _lists(np.diff([*new, len(pair)]).astype(np.int32), per_text)
        return [made[name] for name in outputs]


def _lists(values: np.ndarray | pa.Array, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values if isinstance(values, pa.Array) else pa.array(values))


def align(docs: DataFrame, files: Files, outputs: tuple[str, ...] = ("n_a", "n_b", "n_groups", "n_links", "groups", "links"), text: str = "text") -> DataFrame:
    """The columns of `docs` in a struct `row`, with the columns `outputs` (of OUTPUTS) of its alignment.

    A is the byte-level model on a blank and the text, B the piece model on the text, without special
    tokens. n_group_links counts pairs of tokens of one group; `groups` is 'a1,a2|b1;a3|b2,b3'; `pairs` are the
    distinct pairs of linked ids, as a * (size of B's vocabulary) + b, and `times` how often each is linked; `links` are
    tokens by their places from 0, and the bytes they share. Null and empty texts, and texts whose bytes a tokenizer
    does not keep (as those with U+2581), have no tokens: zeros, empty lists and an empty string. Repeated rows stay;
    columns of `docs` may have any names.
    """
    held = shared(docs.sparkSession, files)
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Parts(Encoders(held()))
        for batch in batches:
            for first, part in chunks(batch.column(1), CHUNK_BYTES):
                split = list(map(known.encoders.split, part.to_pylist()))
                if known.full():
                    known.clear()
                if new := list(set().union(*split) - known.known.keys()):
                    known.add(new)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), *known.columns(split, outputs)], names=["row", *outputs])
        del known
        give_back()

    return rows.mapInArrow(run, extended(rows.select("row"), ", ".join(f"{c} {OUTPUTS[c]}" for c in outputs)))


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, n, best): in how many rows each pair of ids is linked, and 1 if that is the most for its A id, else 0.

    Counts combine before the shuffle. One row for each A id at most goes into the second join: the
    size of a vocabulary.
    """
    counts = written(aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    a_id = F.expr(f"pair DIV {b_size}")
    most = counts.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))
    return written(counts.withColumn("a_id", a_id).join(most, "a_id").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best")))


def scored(aligned: DataFrame, counts: DataFrame, limit: int = HEAD) -> DataFrame:
    """`aligned` (numbered by row_id, with pairs and times) with n_best and count_sum in their place.

    The most frequent pairs, `limit` at most, are looked up in the tasks, all others by a join.
    """
    head = arrays(heaviest(counts, "n", limit), "pair", "n", "best")
    names = ["_head_n", "_head_best"]
    found = head_sums(aligned, "pairs", "times", head, names)
    out = with_sums(found.drop("pairs", "times"), joined_sums(found, "row_id", "pairs", "times", counts, "pair", {"_tail_n": F.col("n"), "_tail_best": F.col("best")}), "row_id")
    return out.withColumns({"n_best": F.col("_head_best") + F.col("_tail_best"), "count_sum": F.col("_head_n") + F.col("_tail_n")}).drop(*names, "_tail_n", "_tail_best")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links. A document's alignment is written once and read for counts and sums."""
    files = Files.load()
    found = align(table(spark, sf_dir, "documents").select("doc_id", "text"), files, ("n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups", "pairs", "times"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    found = stored(found.select(F.col("row.doc_id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", digest, "n_group_links", "pairs", "times", F.monotonically_increasing_id().alias("row_id")), "alignment")
    counts = pair_counts(found, _vocabulary_size(files))
    return scored(found, counts).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links")


def _vocabulary_size(files: Files) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=files.piece_model).get_piece_size()
