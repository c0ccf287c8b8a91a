"""The ten operators against brute force, libraries and round trips, and on odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import components, decontamination, language_id, licenses, line_dedup, neighbours, ngram_jaccard, pii, quality, sentencepiece_codec, toxicity
from tidemark.llm import queries as Q

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaks string, pii string, quality string, n_lines string, piece_ids string, lang_pred string"


def docs_of(spark, texts, sources=None):
    rows = [(i, t, "en" if (i or 0) % 2 else None, (sources or {}).get(i, "s"), None if t is None else len(t), "x", "x", "x", "x", "x", "x") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    long = "wort " * 20_000
    return docs_of(spark, [(1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (4, "one two"), (None, "no id at all, but words to read here"), (5, long), (6, "\U0001f600 é ﬁ ▁ x"), (7, "ab" * 60_000), (8, "1 2 3 4 5")])


def ascii_lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute_components(texts):
    """doc_id: (set size, smallest linked id), by comparing every pair of sets that share a shingle."""
    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))
        sets[k] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    at = collections.defaultdict(list)
    for k, s in sets.items():
        for x in s:
            at[x].append(k)
    common = collections.Counter((a, b) for ks in at.values() for i, a in enumerate(sorted(ks)) for b in sorted(ks)[i + 1 :])
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: (len(s), find(k)) for k, s in sets.items()}


def near_copies(seed=1):
    """Groups of copies with a few words changed, around the similarity that links, short and long, and a shared passage."""
    rng = np.random.default_rng(seed)
    words, out = [f"w{k}" for k in range(3000)], {}
    passage = list(rng.choice(words, 60))
    for group in range(40):
        base = list(rng.choice(words, int(rng.choice([3, 5, 8, 20, 60, 130, 300, 700]))))
        for _ in range(int(rng.integers(1, 9))):
            copy = list(base)
            for k in rng.integers(0, len(copy), int(rng.integers(0, max(2, len(copy) // 18)))):
                copy[k] = str(rng.choice(words))
            if rng.random() < 0.3:
                copy = copy[: int(len(copy) * rng.uniform(0.7, 1))] or copy
            out[len(out)] = " ".join(copy)
    for _ in range(150):
        out[len(out)] = " ".join(passage + list(rng.choice(words, int(rng.integers(5, 60)))))
    return out


@pytest.mark.parametrize("frequent", [64, 4])
def test_jaccard_equals_brute_force(spark, monkeypatch, frequent):
    texts = near_copies()
    monkeypatch.setattr(ngram_jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_jaccard, "GROUP", 5_000)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.join(docs_of(spark, texts.items())).collect()}
    assert got == brute_components(texts)


@pytest.mark.parametrize("frequent", [64, 4])
def test_jaccard_takes_any_id(spark, monkeypatch, frequent):
    texts, rng = near_copies(), np.random.default_rng(4)
    ends = [-(2**63), 2**63 - 1, -1, 2**62, -(2**62) - 1, 0]
    ids = [*ends, *(int(i) for i in rng.choice(np.arange(-5000, 5000) * 2**50 + 7, len(texts) - len(ends), replace=False))]
    texts = dict(zip((ids[k] for k in rng.permutation(len(ids))), texts.values()))
    monkeypatch.setattr(ngram_jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_jaccard, "GROUP", 5_000)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.join(docs_of(spark, texts.items())).collect()}
    assert got == brute_components(texts)


def test_jaccard_on_documents(spark, sf, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in Q.QUERIES["op1_ngram_jaccard"](spark, sf).collect()}
    assert got == brute_components({r.doc_id: r.text for r in documents.collect()})


def test_jaccard_odd_rows(odd):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard.join(odd).collect()}
    assert got[1] == (0, 1) and got[2] == (0, 2) and got[3] == (0, 3) and got[4] == (1, 4) and got[5] == (1, 5) and got[None][1] is None


def test_cells_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (10, 300, 900):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[n // 10 :], rng.integers(0, 2**63, n // 12).astype(np.uint64)]))
        apart = len(np.setxor1d(a, b))
        band = len(a).bit_length() - 1
        x, y = ngram_jaccard.cells(a, band), ngram_jaccard.cells(b, band)
        assert len(np.setdiff1d(x, y)) <= apart
        bits = np.bitwise_count((ngram_jaccard.parity_sketch(a) ^ ngram_jaccard.parity_sketch(b)).view(np.uint64)).sum()
        assert bits <= apart


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(10, 60)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 10 for k in range(10, 61)} | {k: 100 for k in range(100, 140)}


def test_lines_by_hand(spark):
    texts = [(k, f"Menu\n own line {k} \n\nfoot {k % 2}") for k in range(10)] + [(10, None), (11, "Menu")]
    rows = {r.doc_id: r for r in line_dedup.drop_lines(docs_of(spark, texts, {11: None})).collect()}
    assert rows[0].text == " own line 0 \n" and (rows[0].n_lines, rows[0].n_dropped) == (3, 2)
    assert rows[10].text is None and rows[10].n_lines is None
    assert rows[11].text == "Menu" and rows[11].n_dropped == 0


def test_lines_that_go_leave_an_empty_text(spark):
    got = line_dedup.drop_lines(docs_of(spark, [(k, "Menu") for k in range(5)])).collect()
    assert [r.text for r in got] == [""] * 5


def brute_pii(t):
    t = t or ""

    def luhn(m):
        d = [int(c) for c in m if c.isdigit()][::-1]
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0

    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", luhn), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m) <= 15),
    )
    found = sorted((m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, ok) in enumerate(kinds) for m in re.finditer(p, t) if ok(m[0]))
    return [f[2] for f in found]


PII_CASES = [
    "a@b.co_x@y.com z@q", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 0000255.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1111", "+49 (30) 1234567 +1 2 +123456789012345678",
    None, "", "é\U0001f600 mail me@x.de, x", "4111111111111111 " * 30, "Dr. Maria Smith call 555-123-4567 key sk_live_abcd1234efgh5678ij", "+1234567890 5.5.5.5@x.y", " - 12 34-56 7890 1234 5678-9 ", "9" * 30_000, "a" * 60_000,
]


def test_pii_base_equals_brute_force(spark, documents, monkeypatch):
    rows = documents.select("doc_id", "text").union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(PII_CASES)], "doc_id long, text string"))
    monkeypatch.setattr(pii, "table", lambda *a: rows)
    got = {r.doc_id: r for r in pii.op3_pii(spark, "").collect()}
    for r in rows.collect():
        want = brute_pii(r.text)
        own = got[r.doc_id]
        assert own.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r.text
        assert [s for s in own.spans.split(",") if s.split(":")[0] in pii.KINDS] == want
        assert (own.n_email, own.n_ip, own.n_card, own.n_phone) == tuple(sum(w.startswith(k) for w in want) for k in pii.KINDS)


def test_pii_labelers_agree_on_good_spans():
    patterns = {("key", (1, 1, 1)): 50, ("key", (1, 0, 1)): 80, ("key", (-1, 0, -1)): 60, ("key", (0, 0, 0)): 30, ("key", (0, -1, -1)): 20}
    p, _ = pii.reliabilities(patterns)
    assert p["key", (1, 0, 1)] > 0.9 and p["key", (-1, 0, -1)] < 0.1


def test_leaks_exact_substituted_and_clean(spark):
    rng = np.random.default_rng(5)
    words = [f"q{k}" for k in range(4000)]
    item = list(rng.choice(words, 40))
    swapped = [w if k % 7 else "other" for k, w in enumerate(item)]
    noise = lambda n: list(rng.choice(words, n))
    texts = [(1, " ".join(noise(50) + item + noise(50))), (2, " ".join(noise(9) + swapped + noise(30)).upper()), (3, " ".join(noise(400))), (4, " ".join(item[:20] + noise(3) + item[20:])), (5, " ".join(noise(20) + item[5:12] + noise(20))), (6, None), (7, "")]
    bench = spark.createDataFrame([(9, " ".join(item)), (10, None), (None, "x y"), (11, "short one")], "item_id long, text string")
    for block in (decontamination.BLOCK_WORDS, 20):
        got = {r.doc_id: [x.item_id for x in r.leaks] for r in decontamination.scan(docs_of(spark, texts), bench, block_words=block).collect()}
        assert got == {1: [9], 2: [9], 3: [], 4: [9], 5: [], 6: [], 7: []}


def test_leaks_add_up_all_overlaps_of_a_diagonal(spark):
    rng = np.random.default_rng(6)
    words = [f"q{k}" for k in range(4000)]
    item, other = list(rng.choice(words, 30, replace=False)), [f"o{k}" for k in range(60)]
    middle = lambda n: " ".join(other[:20] + item[:11] + other[20 : 20 + n] + item[21:] + other[40:])
    texts = [(n, middle(n)) for n in (9, 10, 11)] + [(1, " ".join(other[:20] + item[:11] + other[20:60])), (2, " ".join(item[:8] + other[:12] + item[20:26] + other[12:])), (3, " ".join(other[:20] + item[:3] + other[20:21] + item[4:16] + other[21:]))]
    got = {r.doc_id: [(x.item_id, x.start, x.matched, x.longest) for x in r.leaks] for r in decontamination.scan(docs_of(spark, texts), spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")).collect()}
    assert got == {n: [(9, 20, 20, 11)] for n in (9, 10, 11)} | {1: [], 2: [], 3: [(9, 20, 15, 16)]}


def test_leak_overlaps_equal_brute_force():
    rng = np.random.default_rng(8)
    for _ in range(300):
        own = rng.integers(0, 2**62, 60).astype(np.uint64)
        same = rng.random(60) < rng.choice([0.5, 0.75, 0.9])
        index = decontamination.Index([(1, own)])
        got = [(o[0], o[1], o[2], o[3].tolist()) for o in index.overlaps(np.where(same, own, np.uint64(1)), 0, 0)]
        want, at = [], 0
        while at < 60:
            gain, best, begin, k = 0, 0, None, at
            while k < 60:
                gain += 1 if same[k] else -decontamination.PENALTY
                if gain < 0:
                    if begin is not None:
                        break
                    gain = 0
                else:
                    begin = k if begin is None else begin
                    if gain > best:
                        best, end = gain, k
                k += 1
            if begin is None:
                break
            own_words = [j for j in range(begin, end + 1) if same[j]]
            want.append((begin, end + 1 - begin, len(own_words), own_words))
            at = end + 1
        assert got == want


def test_leaks_hold_every_exact_item(spark, sf):
    norm = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())) + " "
    docs, items = spark.read.parquet(f"{sf}/documents.parquet").collect(), spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if norm(i.text) in norm(d.text)}
    got = {(r.doc_id, r.item_id) for r in Q.QUERIES["op4_decontamination"](spark, sf).collect()}
    assert exact <= got and len(got) <= len(exact) + 3


def test_quality_ranks_labelled_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.QUERIES["op5_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = [r.score for r in rows if r.quality == 1], [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert np.mean([r.keep for r in rows if r.quality == 1]) > 0.97


def test_pieces_equal_the_library(spark, documents):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    cases = ["", " ", "  ", "a  b   c\n\n d\te", "日本語 text 😀 ﬁ", "x" * 300, "Hello, world! supercalifragilistic (internationalization)... don't", "def f(x):\n    return x\n\t\tif", None, "\n" * 20]
    rows = documents.select("doc_id", "text").union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(cases)], "doc_id long, text string"))
    codec = sentencepiece_codec.Codec.load()
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(rows, codec), codec).collect()
    for r in out:
        assert r.piece_ids == (None if r.text is None else sp.encode(r.text))
        assert r.decoded == r.text and r.round_trip is (None if r.text is None else True)


def test_unigram_pieces_have_the_best_score():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    codec = sentencepiece_codec.Codec(pieces, [0, -2.0, -3.0, -3.0, -1.5, -2.0, -1.0, -6.0], ["unknown"] + ["normal"] * 7, "unigram", True)
    for word, ids in codec.segment(["▁ab", "▁aba", "▁abab", "▁z"]):
        if "z" in word:
            assert ids == [1, 0]
            continue

        def ways(rest):
            if not rest:
                yield 0.0, []
            for i, p in enumerate(pieces[1:], 1):
                if rest.startswith(p):
                    yield from ((s + codec.scores[i], [i, *ids]) for s, ids in ways(rest[len(p) :]))

        assert sum(codec.scores[i] for i in ids) == pytest.approx(max(s for s, _ in ways(word)))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.QUERIES["op7_toxicity"](spark, sf).join(labels, "doc_id").join(docs.select("doc_id", "text"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    pos, neg = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert np.mean([p > n for p in pos for n in neg]) > 0.93
    assert np.mean([n >= 0.5 for n in neg]) < 0.03


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.QUERIES["op8_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.96


def brute_licenses(t):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t))
    hits = [(i, name) for p, name in licenses.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(hits), min((h[0] for h in hits), default=None), max((h[0] for h in hits), default=None), ",".join(sorted({h[1] for h in hits}))


def test_licenses_equal_brute_force(spark, documents):
    cases = [(1, "Permission is hereby granted, free of charge, to any person obtaining big copy of this software and associated documentation files (the Software), to deal in the Software without restriction"), (2, None), (3, ""), (None, "Under the MIT license under the mit  license"), (4, "cc by nc cc-by-nc"), (4, "cc by nc cc-by-nc"), (5, "under the mit"), (6, "UNDER THE MİT LICENSE é")]
    rows = documents.select("doc_id", "text").union(spark.createDataFrame([(None if i is None else 10**6 + i, t) for i, t in cases], "doc_id long, text string"))
    got = licenses.label(rows).collect()
    want = collections.Counter((r.doc_id, *brute_licenses(r.text)) for r in rows.collect())
    assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert [(r.labels, r.n_base) for r in got if r.doc_id == 10**6 + 1] == [("mit", 0)]


def test_nearest_recall_and_scores(spark, sf):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 3000)] + 0.3 * rng.normal(size=(3000, 16))
    x[500:900] = x[500]
    odd = [(9000, None), (9001, [0.0] * 16), (9002, [math.nan] + [1.0] * 15), (9050, [None] + [1.0] * 15), (9100, [1.0] * 3), (None, [1.0] * 16), (9150, [])]
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + odd, "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(rows).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    norm, hits = np.sqrt((x * x).sum(1)), 0
    for q in range(0, 3000, 50):
        s = (x * x[q]).sum(1) / (norm * norm[q])
        s[q] = -2
        best = np.lexsort((np.arange(3000), -s))[:5]
        hits += len({i for i, _ in got[q]} & set(best))
        assert all(abs(s[i] - v) < 1e-12 for i, v in got[q]) and len(got[q]) == 5
    assert set(got) == set(range(0, 3000, 50)) and hits / 300 >= 0.95
    assert [i for i, _ in got[600]] == [500, 501, 502, 503, 504]


def test_chi_square():
    assert neighbours.chi_square_below(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert neighbours.limit(0.95, 8) == pytest.approx(15.507, abs=1e-3)


def test_odd_rows_everywhere(spark, odd):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen")], "item_id long, text string")
    n = odd.count()
    codec = sentencepiece_codec.Codec.load()
    outs = [
        line_dedup.drop_lines(odd), pii.find(odd), decontamination.scan(odd, bench), quality.score(odd, quality.learn(odd)), sentencepiece_codec.encode(odd, codec),
        toxicity.score(odd, toxicity.train(["bad thing", "good thing"] * 3, [1, 0] * 3, 0.5)), language_id.identify(odd, {"en": b"one two three", "de": b"eins zwei wort"}), licenses.label(odd),
    ]
    for out in outs:
        assert out.count() == n
    assert {r.lang_pred for r in outs[6].where("doc_id IN (1, 2, 3, 8)").collect()} == {"und"}
    assert outs[3].where("quality IS NULL").count() == 0


def test_empty_tables(spark, odd):
    none = odd.limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    codec = sentencepiece_codec.Codec.load()
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for out in (
        ngram_jaccard.join(none), line_dedup.drop_lines(none), pii.find(none), decontamination.scan(none, bench), quality.score(none, quality.learn(none)), sentencepiece_codec.encode(none, codec),
        toxicity.score(none, toxicity.learn(none, labels)), language_id.identify(none, language_id.learn(none)), licenses.label(none), neighbours.nearest(vectors),
    ):
        assert out.count() == 0
    assert decontamination.scan(odd, bench).where(F.size("leaks") > 0).count() == 0


def test_sql_and_queries_agree_on_lines(spark, sf):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(Q.ORACLE["op2_line_dedup"])
    names = want.columns
    got = Q.QUERIES["op2_line_dedup"](spark, sf).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_jaccard_keeps_rows_without_an_id_apart(spark):
    same = " ".join(f"w{k}" for k in range(40))
    rows = [(None, same), (None, "other words that stand alone here"), (3, same), (4, same), (4, "zz " + same), (None, None)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard.join(docs_of(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 36, None), (None, 2, None), (None, 0, None), (3, 36, 3), (4, 37, 3)], key=str)


def test_lines_of_a_large_host(spark):
    passage = " ".join(f"p{k}" for k in range(55))
    texts = [(k, "\n".join([f"own line {k}", *(["Menu"] * (k % 50 == 0)), *([passage] * (k % 40 == 0)), *(["twice"] * (k < 4))])) for k in range(1000)]
    rows = {r.doc_id: r for r in line_dedup.drop_lines(docs_of(spark, texts)).collect()}
    assert rows[0].text == "own line 0\ntwice" and rows[40].text == "own line 40" and rows[50].text == "own line 50" and rows[3].text == "own line 3\ntwice"
    assert sum(r.n_dropped for r in rows.values()) == 20 + 25


def test_names_may_clash(spark):
    rows = spark.createDataFrame([(1, "mail a@b.co, Dr. Maria Smith", 7, 8, 9, 10, "u", "s")], "doc_id long, text string, more int, base int, every int, row int, email string, source string")
    found = pii.find(rows).collect()[0]
    assert (found.more, found.base, found.every, found.row, found.email) == (7, 8, 9, 10, "u") and found.pii[0].kind == "email"
    kept = line_dedup.drop_lines(rows.withColumn("lines", F.lit(3)).withColumn("kept", F.lit(4))).collect()[0]
    assert (kept.lines, kept.kept, kept.every, kept.row) == (3, 4, 9, 10)
    assert pii.find(rows.withColumn("PII", F.lit(1))).columns.count("pii") == 1
    assert "N_LINES" not in line_dedup.drop_lines(rows.withColumn("N_LINES", F.lit(1))).columns


def test_pii_is_linear_in_matches(spark):
    n = 3000
    got = pii.find(spark.createDataFrame([(1, " ".join(f"a{k}@b.co" for k in range(n)))], "doc_id long, text string")).selectExpr("size(pii) n", "element_at(pii, -1) last").collect()[0]
    text = " ".join(f"a{k}@b.co" for k in range(n))
    assert got.n == n and (got.last.s, got.last.e) == (text.rindex(" ") + 1, len(text))


def test_pii_finds_planted_spans(spark):
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 6))
    rows, planted = [], {}
    for k in range(400):
        around = [" ".join(word() for _ in range(8)) for _ in range(2)]
        digits = "".join(rng.choice(list("0123456789"), 10))
        what = [f"call {digits[:3]}-{digits[3:6]}-{digits[6:]}", "signed Dr. Maria Smith", "secret key: sk_live_" + "".join(rng.choice(list("abcdef0123456789"), 20)), "version 2020-10-12"][k % 4]
        rows.append((k, f"{around[0]} {what} {around[1]}"))
        planted[k] = ["number", "person", "key", None][k % 4]
    got = {r.doc_id: {x.kind for x in r.pii} for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hits = [planted[k] in got[k] for k in planted if planted[k]]
    clean = [not got[k] for k in planted if not planted[k]]
    assert np.mean(hits) >= 0.9 and np.mean(clean) >= 0.9


def test_quality_equals_a_plain_version_at_any_layout(spark, documents):
    rows = documents.select("doc_id", "text")
    model = quality.learn(rows)
    again = quality.learn(rows.repartition(5, "text"))
    assert np.array_equal(model.slots, again.slots) and np.array_equal(model.dense, again.dense) and model.bias == again.bias
    got = {r.doc_id: r.quality for r in quality.score(rows, model).collect()}
    measurer = quality.Measurer()
    for r in rows.limit(60).collect():
        measures, slots, _ = (x for x in measurer(__import__("pyarrow").array([r.text or ""])))
        z = sum(float(np.clip((m - a) / b, -4, 4)) * w for m, a, b, w in zip(measures[0], model.mean, model.scale, model.dense)) + sum(model.slots[s] for s in slots) / max(1, len(slots)) + model.bias
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)


def test_toxicity_learns_from_few_texts(spark):
    sf = "/root/testdata/sf0.01"
    rows = Q.op7_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    found = [r.predicted for r in rows if r.toxic]
    assert len(found) >= 5 and sum(found) >= 0.5 * len(found) and sum(r.predicted for r in rows if r.toxic == 0) < 0.1 * len(rows)


def test_toxicity_equals_a_plain_version_and_forgets_length(spark):
    model = toxicity.train(["you idiot go away", "have a nice day", "what an idiott", "the weather is fine"] * 8, [1, 0, 1, 0] * 8, 0.5)

    def plain(text):
        odds = []
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            g = toxicity.grams(w)
            odds.append(sum(float(model.vectors[s] @ model.weights) for s in g) / len(g))
        z = model.bias + (toxicity.SOFT * math.log(sum(math.exp(o / toxicity.SOFT) for o in odds) / len(odds)) if odds else 0)
        return 1 / (1 + math.exp(-z))

    texts = ["you idiot", "a nice fine day", "idiots all", "", "1 2 3", "the weather is an idiot"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, *(f"{t} " * 500 for t in texts)])], "doc_id long, text string")
    got = {r.doc_id: r.toxicity for r in toxicity.score(rows, model).collect()}
    for k, t in enumerate(texts):
        assert got[k] == pytest.approx(plain(t), abs=1e-5) and got[k + len(texts)] == pytest.approx(got[k], abs=1e-6)


def test_language_equals_a_plain_version(spark, documents):
    import zstandard

    books = language_id.learn(documents)
    rows = documents.select("doc_id", "text").union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(["² ½ Ⅷ ①", "12 34", "é", "", None])], "doc_id long, text string"))
    got = {r.doc_id: r.lang_pred for r in language_id.identify(rows, books).collect()}
    assert [got[10**6 + k] == "und" for k in range(5)] == [True, True, False, True, True]
    for r in rows.where("doc_id < 1000000 AND text IS NOT NULL").limit(40).collect():
        raw = re.sub(r"[\W\d_]+", " ", r.text.lower()).encode()
        sizes = {}
        for name, book in books.items():
            d = zstandard.ZstdCompressionDict(book, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            z = zstandard.ZstdCompressor(level=language_id.LEVEL, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[name] = sum(len(z.compress(raw[o : o + language_id.CHUNK])) for o in range(0, len(raw), language_id.CHUNK))
        if any(c.isalpha() for c in r.text):
            assert got[r.doc_id] == min(sorted(sizes), key=sizes.get)


@pytest.mark.parametrize("given", [True, False])
def test_nearest_recall_in_many_dimensions(spark, given):
    if given:
        rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
        x = {r.vec_id: np.array(r.embedding, float) for r in rows.where("embedding IS NOT NULL").collect()}
    else:
        x = dict(enumerate(np.random.default_rng(5).normal(size=(4000, 64))))
        rows = spark.createDataFrame([(k, v.tolist()) for k, v in x.items()], "vec_id long, embedding array<double>")
    x = {k: v for k, v in x.items() if len(v) == 64 and np.isfinite(v).all() and v.any()}
    ids, m = np.array(list(x)), np.stack(list(x.values()))
    got = collections.defaultdict(set)
    for r in neighbours.nearest(rows).collect():
        got[r.query_id].add(r.vec_id)
    units, hits, total = m / np.linalg.norm(m, axis=1, keepdims=True), 0, 0
    for q in (k for k in x if k % 50 == 0):
        s = units @ (x[q] / np.linalg.norm(x[q]))
        s[ids == q] = -2
        hits, total = hits + len(got[q] & set(ids[np.lexsort((ids, -s))[:5]].tolist())), total + 5
    assert hits / total >= 0.9


def test_nearest_verifies_well_under_half(spark):
    x = np.random.default_rng(6).normal(size=(4096, 64))
    block = neighbours.Block(np.arange(len(x)), x)
    for q in range(0, len(x), 64):
        block.search(q, x[q], np.inf, 5, neighbours.limit())
    assert block.verified / 64 / len(x) < 0.45


def test_licenses_find_altered_openings(spark):
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for k, (name, opening) in enumerate(licenses.TEMPLATES * 4):
        words = opening.split()
        if k >= len(licenses.TEMPLATES) and len(words) > 15:
            words.insert(len(words) // 2, "really")
        rows.append((k, " ".join([*rng.choice(["lorem", "ipsum", "dolor"], 30), *words, "sit", "amet"])))
        want[k] = name
    rows += [(1000 + k, " ".join(rng.choice(["lorem", "ipsum", "software", "license", "this"], 60))) for k in range(50)]
    got = {r.doc_id: r.labels.split(",") for r in licenses.label(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert np.mean([want[k] in got[k] for k in want]) >= 0.95 and all(got[1000 + k] == [""] for k in range(50))


def test_leaks_equal_the_rule_over_all_seeded_diagonals(spark):
    rng = np.random.default_rng(12)
    words = [f"q{k}" for k in range(300)]
    items = [list(rng.choice(words, int(rng.integers(8, 40)))) for _ in range(12)]
    texts = []
    for _ in range(60):
        item = items[int(rng.integers(0, 12))]
        part = [w if rng.random() < rng.choice([0.7, 0.85, 1.0]) else str(rng.choice(words)) for w in item[: int(rng.integers(5, len(item) + 1))]]
        texts.append(list(rng.choice(words, 30)) + part + list(rng.choice(words, 20)))
    want = set()
    for t, text in enumerate(texts):
        for i, item in enumerate(items):
            spans, covered = [], set()
            for shift in range(-len(item), len(text)):
                same = [0 <= j + shift < len(text) and item[j] == text[j + shift] for j in range(len(item))]
                if not any(all(j + m < len(item) and 0 <= j + m + shift < len(text) and same[j + m] for m in mask) for mask in decontamination.MASKS for j in range(len(item))):
                    continue
                at = max(0, -shift)
                stop = min(len(item), len(text) - shift)
                while at < stop:
                    while at < stop and not same[at]:
                        at += 1
                    gain = best = 0
                    end = at
                    for k in range(at, stop):
                        gain += 1 if same[k] else -decontamination.PENALTY
                        if gain < 0:
                            break
                        if gain > best:
                            best, end = gain, k + 1
                    if end == at:
                        break
                    own = [j for j in range(at, end) if same[j]]
                    if len(own) >= decontamination.SEED_WORDS - 1:
                        spans.append(end - at)
                        covered |= set(own)
                    at = end
            if spans and (max(spans) >= min(decontamination.LONG, len(item)) or len(covered) >= decontamination.COVERED * len(item)):
                want.add((t, i))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, x.item_id) for r in decontamination.scan(docs_of(spark, [(k, " ".join(w)) for k, w in enumerate(texts)]), bench).collect() for x in r.leaks}
    assert got == want and len(want) > 20
