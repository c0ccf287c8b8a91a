"""Exact self-join of documents on the Jaccard similarity of their word 5-gram sets.

Each set becomes a parity sketch: every shingle's hash is XORed into one of K cells, K being
fixed for a band of set sizes. A shingle in one set only changes one cell, so the number of
cells in which two sketches differ is at most the symmetric difference, and two sets of at
least three quarters similarity have a symmetric difference of at most D = (|A| + |B|) / 7.
By the pigeonhole principle, of a set's non-empty cells any D + 1 have one in common with
every partner; with the rarest cells first, almost every document has D + 1 cells that no
other document has, and drops out. The rest are paired by their rarest cells and verified.

Stages:

1. every document's set size and set hash; exact copies of a set are folded into one;
2. cells are dealt by value, as packed arrays, and get the number of sets that have them;
3. cells that several sets have go back to their sets, which pick their rarest;
4. each set is compared with the one hub (the smallest set of a cell's group) that it shares most
   cells with, and connected; in groups that still hold several components, pairs across them
   are compared by a parity sketch of BITS bits and verified where that allows a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import hot_keys, small, spread_join, table, written
from .word_hashes import NOT_BLANK, Hasher, chunks, give_back, mix

#: Words of a shingle.
WORDS = 5
#: Cells that a task holds before it deals them out, and cells of a group at stage 2.
FLUSH, GROUP = 500_000, 500_000
#: Sets below 2**TOKENS shingles have a cell for each shingle.
TOKENS = 8
#: Sets with a cell from which on it counts as frequent, whatever the number.
FREQUENT = 64
LOW = np.uint64((1 << 40) - 1)


def shingle_sets(texts: pa.Array, hasher: Hasher, words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words are one shingle, no words none."""
    w = hasher(texts)
    n = max(0, len(w.hashes) - words + 1)
    total = np.zeros(n, np.uint64)
    factors = [np.uint64(0x8CB92BA72F3D8DD7 * (2 * k + 3) % (1 << 64) | 1) for k in range(words)]
    for k in range(words):
        total += w.hashes[k : k + n] * factors[k]
    total = mix(total)
    for begin, end in zip(w.bounds.tolist(), w.bounds.tolist()[1:]):
        if end - begin >= words:
            yield np.unique(total[begin : end - words + 1])
        elif end > begin:
            one = np.zeros(1, np.uint64)
            for k in range(end - begin):
                one += w.hashes[begin + k : begin + k + 1] * factors[k]
            yield mix(one + np.uint64(end - begin))
        else:
            yield np.zeros(0, np.uint64)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(NOT_BLANK)
    for batch in batches:
        n, h1, h2 = [], [], []
        for _, part in chunks(batch.column(1)):
            for s in shingle_sets(part, hasher):
                n.append(len(s))
                h1.append(int(mix(s).sum(dtype=np.uint64).astype(np.int64)))
                h2.append(int(mix(s ^ LOW).sum(dtype=np.uint64).astype(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], names=["doc_id", "n_shingles", "h1", "h2"])
    give_back()


def bands(n: int) -> list[tuple[int, int]]:
    """(band, D) for each band in which a set of n shingles meets partners.

    Band b holds the sets of 2**b to 2**(b+1) - 1 shingles and the smaller ones that may pair
    with those; D is the largest symmetric difference from a partner in the band.
    """
    own = n.bit_length() - 1
    found = [(own, (n + min(4 * n // 3, (2 << own) - 1)) // 7)]
    if 4 * n // 3 >= 2 << own:
        found.append((own + 1, (n + 4 * n // 3) // 7))
    return found


def cells(shingles: np.ndarray, band: int) -> np.ndarray:
    """Hashes of the non-empty cells of the sketch, each with its place and the band."""
    salt = np.uint64(0x9E3779B97F4A7C15 * (2 * band + 1) % (1 << 64))
    if band < TOKENS:
        return mix(shingles ^ salt)
    place = (shingles & np.uint64((1 << band) - 1)).astype(np.int64)
    order = np.argsort(place, kind="stable")
    place = place[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    value = np.bitwise_xor.reduceat(mix(shingles)[order], first)
    return mix(value ^ salt ^ (place[first].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))


def _packed(values: np.ndarray, width: int) -> bytes:
    """The low `width` bytes of 64-bit values, by byte place: high bytes that repeat compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.view(np.uint64).reshape(-1)


#: A packed row: the group; sets (documents, of any 64-bit id) with their sizes and how many cells follow
#: for each; the cells; the sets that have each. A size is shingles << 32 | cells << 1 | whether the set is
#: in the band above its own, so document and size name a set; size 0 marks a frequent cell.
BLOCK = "part int, keys binary, sizes binary, n binary, cells binary, df binary"


def _firsts(key: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Where sets begin in rows that are ordered by set."""
    return np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (size[1:] != size[:-1])])) if len(key) else np.zeros(0, np.int64)


def _blocks(part: np.ndarray, key: np.ndarray, size: np.ndarray, cell: np.ndarray, df: np.ndarray) -> pa.RecordBatch:
    """Packed rows, one a group; rows of one set follow one another in the input."""
    order = np.argsort(part, kind="stable")
    part, key, size, cell, df = (x[order] for x in (part, key, size, cell, df))
    edges = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else np.zeros(1, np.int64)
    columns: list[list] = [[] for _ in range(6)]
    for a, b in zip(edges, edges[1:]):
        first = a + _firsts(key[a:b], size[a:b])
        n = np.diff(np.concatenate([first, [b]])).astype(np.int32)
        for column, value in zip(columns, (int(part[a]), _packed(key[first], 8), _packed(size[first], 8), n.tobytes(), _packed(cell[a:b], 8 if df[a] else 5), df[a:b].astype(np.uint8).tobytes() if df[a] else b"")):
            column.append(value)
    kinds = [pa.int32()] + [pa.binary()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "keys", "sizes", "n", "cells", "df"])


def _read(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """key, size, cell, df of each cell in packed rows; df 0 in rows that come without."""
    got: list[list] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]]
    for part, keys, size, n, cell, df in zip(*(rows.column(c).to_pylist() for c in ("part", "keys", "sizes", "n", "cells", "df"))):
        n = np.frombuffer(n, np.int32)
        got[0].append(np.repeat(_unpacked(keys, 8).view(np.int64), n))
        got[1].append(np.repeat(_unpacked(size, 8).view(np.int64), n))
        got[2].append(_unpacked(cell, 8) if df else _unpacked(cell, 5) | np.uint64(part << 40))
        got[3].append(np.frombuffer(df, np.uint8) if df else np.zeros(n.sum(), np.uint8))
    return tuple(np.concatenate(g) for g in got)


def _deal(parts: int, flush: int = FLUSH):
    """Stage 2, before the shuffle. A cell that FREQUENT sets of one flush have is not sent set by
    set: its group gets one row that marks it, and the sets keep it, by way of any group."""

    def out(keys: list, sizes: list, found: list, turn: int) -> Iterator[pa.RecordBatch]:
        n = [len(c) for c in found]
        key, size, cell = np.repeat(np.array(keys, np.int64), n), np.repeat(np.array(sizes, np.int64), n), np.concatenate(found)
        part = ((cell >> np.uint64(40)) % np.uint64(parts)).astype(np.int32)
        full = (part.astype(np.uint64) << np.uint64(40)) | (cell & LOW)
        values, counts = np.unique(full, return_counts=True)
        often = values[counts >= FREQUENT]
        held = np.isin(full, often) if len(often) else np.zeros(len(full), bool)
        yield _blocks(part[~held], key[~held], size[~held], full[~held], np.zeros((~held).sum(), np.uint8))
        if len(often):
            yield _blocks((often >> np.uint64(40)).astype(np.int32), np.zeros(len(often), np.int64), np.zeros(len(often), np.int64), often, np.full(len(often), FREQUENT, np.uint8))
            key, size, full = key[held], size[held], full[held]
            yield _blocks(((key + turn) % parts).astype(np.int32), key, size, full, np.full(len(full), FREQUENT, np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, keys, sizes, found, held, turn = Hasher(NOT_BLANK), [], [], [], 0, 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, part in chunks(batch.column(1)):
                for k, s in enumerate(shingle_sets(part, hasher), first):
                    for up, (band, _) in enumerate(bands(len(s)) if len(s) else ()):
                        c = cells(s, band)
                        keys.append(ids[k])
                        sizes.append(len(s) << 32 | len(c) << 1 | up)
                        found.append(c)
                        held += len(c)
                if held >= flush:
                    yield from out(keys, sizes, found, turn)
                    keys, sizes, found, held, turn = [], [], [], 0, turn + 1
        if found:
            yield from out(keys, sizes, found, turn)
        del keys, sizes, found
        give_back()

    return run


def _count(parts: int):
    """Stage 2, after the shuffle: cells that several sets have go on, to the groups of their sets."""

    def run(rows: pa.Table) -> pa.Table:
        key, size, cell, df = _read(rows)
        passing = (df > 0) & (size > 0)
        own = np.flatnonzero(~passing)
        order = own[np.argsort(cell[own], kind="stable")]
        first = np.flatnonzero(np.concatenate([[True], cell[order][1:] != cell[order][:-1]])) if len(order) else np.zeros(0, np.int64)
        weight = np.add.reduceat(np.where(size[order] == 0, FREQUENT, 1), first) if len(order) else np.zeros(0, np.int64)
        df[order] = np.minimum(np.repeat(weight, np.diff(np.concatenate([first, [len(order)]]))), FREQUENT)
        keep = np.flatnonzero((df >= 2) & (size > 0))
        keep = keep[np.lexsort((size[keep], key[keep]))]
        key, size, cell, df = key[keep], size[keep], cell[keep], df[keep]
        to = (mix(key.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        out = _blocks(to, key, size, cell, df)
        del key, size, cell, df, order, own
        give_back()
        return pa.Table.from_batches([out])

    return run


#: A cell that a set picked: the set, its shingles, how many of its cells are rarer, whether every
#: shingle has a cell of its own, whether the rarer ones are at most a seventh of the shingles: with a partner
#: in which they are more, as in documents that share a common passage and little else, the partner's are fewer.
PICKED = "cell long, doc_id long, n int, rarer int, single boolean, low boolean"


def _pick(rows: pa.Table) -> pa.Table:
    """Stage 3: the sets that may have partners, with the rarest of their cells.

    Of a set's D + 1 rarest cells the first are those that no other set has, and then those that
    came back, by the number of sets and then by value, the same order for every set.
    """
    key, size, cell, df = _read(rows)
    order = np.lexsort((cell, df, size, key))
    key, size, cell = key[order], size[order], cell[order]
    first = _firsts(key, size)
    came = np.diff(np.concatenate([first, [len(key)]]))
    shingles, n_cells = size[first] >> 32, (size[first] & 0xFFFFFFFF) >> 1
    by_band = [bands(int(n))[up] for n, up in zip(shingles, size[first] & 1)]
    band, most = (np.array([b[j] for b in by_band], np.int64) for j in (0, 1))
    rarer = np.repeat(n_cells - came - first, came) + np.arange(len(key))
    most, single = np.repeat(most, came), np.repeat(band < TOKENS, came)
    keep = rarer <= most
    low = ~single | (7 * rarer <= np.repeat(shingles, came))
    columns = (cell.astype(np.int64), key, (size >> 32).astype(np.int32), rarer.astype(np.int32), single, low)
    return pa.table({name: pa.array(c[keep]) for name, c in zip(("cell", "doc_id", "n", "rarer", "single", "low"), columns)})


#: SQL: whether rows x and y of one cell can be the first that a linked pair has in common. All rarer cells
#: of either set then differ, and these are shingles of either alone if each shingle has its own cell.
FEASIBLE = "100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) AND IF(x.single, x.rarer + y.rarer, greatest(x.rarer, y.rarer)) <= (x.n + y.n) DIV 7"


#: Bits of the parity sketch of a whole set that is compared before a pair is made, as 64-bit columns.
BITS = 1024
SKETCH = [f"s{k}" for k in range(BITS // 64)]


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """BITS bits, each the parity of the shingles that fall on it: two sketches differ in at most the symmetric difference."""
    odd = np.bincount((shingles >> np.uint64(7)).astype(np.int64) & (BITS - 1), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = Hasher(NOT_BLANK)
    for batch in batches:
        sets = [s for _, part in chunks(batch.column(1)) for s in shingle_sets(part, hasher)]
        bits = np.array([parity_sketch(s) for s in sets], np.int64).reshape(-1, len(SKETCH))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_packed(s >> np.uint64(16), 6) for s in sets], pa.binary()), *(pa.array(c) for c in bits.T)], names=["doc_id", "shingles", *SKETCH])
    give_back()


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = _unpacked(x.as_py(), 6), _unpacked(y.as_py(), 6)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def one_row_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row for each id that is not null, that of the greatest text; rows without an id stay as they are."""
    if not docs.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1).count():
        return docs
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (key.lower(), text.lower())]
    one = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(F.struct(text, *rest)).alias("row"))
    return one.select(*((F.col("key") if c.lower() == key.lower() else F.col(f"row.`{c}`")).alias(c) for c in docs.columns)).union(docs.where(F.col(key).isNull()))


def join(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id of each document; percent: at least 75, the similarity that links.

    Rows that share an id are one document, with the greatest of their texts. A null or empty
    text, or one of blanks, has no shingles and links with nothing, and so does each row with a null id,
    whose component is null. Shingles are compared by 64-bit hashes, verified pairs by 48 bits of them.
    """
    if percent < 75:
        raise ValueError("the sketches are laid out for at least 75 percent")
    docs = one_row_each(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")))
    sizes = written(docs.mapInArrow(_sizes, "doc_id long, n_shingles long, h1 long, h2 long"))
    full, of = sizes.where("n_shingles > 0 and doc_id is not null"), ["n_shingles", "h1", "h2"]
    same = written(full.groupBy(*of).agg(F.min("doc_id").alias("first"), F.count("*").alias("n_rows")).where("n_rows > 1"))
    copies = spread_join(full, same.drop("n_rows"), of, "doc_id", hot_keys(same, of, sizes.count()))
    copies = written(copies.where("doc_id != first").select("doc_id", "first"))
    single = docs.where("doc_id is not null").join(small(copies.select("doc_id")), "doc_id", "left_anti")

    total = full.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(1, round(total / GROUP))
    shared = single.mapInArrow(_deal(parts), BLOCK).groupBy("part").applyInArrow(_count(parts), BLOCK)
    picked = written(shared.groupBy("part").applyInArrow(_pick, PICKED).distinct())

    # A linked pair has a low row at its first common cell, for else more would differ than may.
    hub = F.min(F.when(F.col("low"), F.struct("doc_id", "n", "rarer")))
    groups = written(picked.groupBy("cell").agg(hub.alias("hub"), F.count("*").alias("n_rows")).where("n_rows > 1 AND hub IS NOT NULL"))
    members = written(spread_join(picked, groups.drop("n_rows"), ["cell"], "doc_id", hot_keys(groups, ["cell"], picked.count())))
    feasible = FEASIBLE.format(percent=percent)
    spokes = members.alias("x").where("x.doc_id != x.hub.doc_id").where(feasible.replace("y.", "x.hub."))
    star = written(spokes.groupBy(F.col("hub.doc_id").alias("a"), F.col("doc_id").alias("b")).agg(F.count("*").alias("common")))
    ids = written(members.select("doc_id").distinct())
    sets = written(docs.join(small(ids), "doc_id", "left_semi").mapInArrow(_sets, "doc_id long, shingles binary, " + ", ".join(f"{c} long" for c in SKETCH)))

    def linked(pairs: DataFrame) -> DataFrame:
        """The pairs that link; a document of very many pairs has them dealt over several tasks."""
        pairs = written(pairs.select("a", "b"))
        n, out = pairs.count(), pairs
        for c, other in (("b", "a"), ("a", "b")):
            hot = written(hot_keys(pairs.groupBy(c).agg(F.count("*").alias("n_rows")), [c], n))
            out = spread_join(out, sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"set_{c}")), [c], other, hot)
        return out.select("a", "b", "set_a", "set_b").mapInArrow(_verify(percent), "a long, b long")

    best = written(star.groupBy("b").agg(F.min_by("a", F.struct(-F.col("common"), "a")).alias("a")))
    links = written(linked(best))
    labels = written(components(links))

    # What is left: pairs within one cell's group, across its components. The largest component's own pairs need
    # no look, and of the others those alone whose sketches differ in no more bits than their sets may.
    at = members.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    counted = at.groupBy("cell", "component").agg(F.count("*").alias("n"))
    split = counted.groupBy("cell").agg(F.min_by("component", F.struct(-F.col("n"), "component")).alias("main"), F.count("*").alias("k")).where("k > 1")
    at = at.drop("hub").join(split.select("cell", "main"), "cell")
    at = written(at.join(sets.select("doc_id", *SKETCH), "doc_id"))
    differing = " + ".join(f"bit_count(x.{c} ^ y.{c})" for c in SKETCH)
    possible = f"x.cell = y.cell AND {feasible} AND {differing} <= (x.n + y.n) DIV 7"
    y = at.alias("y")
    low = at.where("component != main AND low").alias("x").join(y, F.expr(f"{possible} AND x.component != y.component"))
    high = at.where("component != main AND NOT low").alias("x").join(y.where("component = main AND low"), F.expr(possible))
    rest = low.select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
    rest = rest.union(high.select(F.least("x.doc_id", "y.doc_id"), F.greatest("x.doc_id", "y.doc_id"))).distinct()
    rest = rest.join(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    # Links across components join components, of which each is one node; copies follow their first document.
    across = linked(rest)
    for c in "ab":
        across = across.join(labels.select(F.col("node").alias(c), F.col("component").alias(f"to_{c}")), c, "left").withColumn(c, F.coalesce(f"to_{c}", c)).drop(f"to_{c}")
    wider = written(components(across)).select(F.col("node").alias("component"), F.col("component").alias("wider"))
    met = labels.join(wider, "component", "left").select("node", F.coalesce("wider", "component").alias("component"))
    met = written(met.union(wider.join(labels.select(F.col("node").alias("component")), "component", "left_anti")))
    groups = same.select("first").distinct().join(met.withColumnRenamed("node", "first"), "first", "left").select("first", F.coalesce("component", "first").alias("component"))
    followed = spread_join(copies, groups, ["first"], "doc_id", hot_keys(same, ["first"], sizes.count()))
    found = met.withColumnRenamed("node", "doc_id").union(followed.select("doc_id", "component"))
    return sizes.join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return join(table(spark, sf_dir, "documents"))
