"""Spelling variants, tokenizer alignment and language-model scores against brute force, and on odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, heads, lm_scoring, spelling
from tidemark.llm import queries as Q

LONG = "wort " * 20_000 + "ab" * 20_000
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (4, "one two"), (None, "no id at all, but words to read here"), (5, LONG), (6, "\U0001f600 é ﬁ ▁ x"), (7, "<|endoftext|> </s> it's  we'll\r\n日本語"), (8, "1 2 3 4 5")]


def table_of(spark, rows):
    """The rows with columns whose names the operators use themselves, dotted ones and ones in another case."""
    extra = ("row", "learned", "row_id", "n", "word", "a.b", "N_A", "units")
    return spark.createDataFrame([(*r, *("x" * len(extra))) for r in rows], "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in extra))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus with odd rows, as a table of its own."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeé"), 7)) for _ in range(60)]
    near = [w[:3] + "x" + w[4:] for w in words[:30]] + [w[:-1] for w in words[30:50]]
    texts = [(k, " ".join(rng.choice(words, 40)) + " " + " ".join(rng.choice(near, 3)) + ". It's Said, " * (k % 3)) for k in range(100, 300)]
    path = str(tmp_path_factory.mktemp("corpus"))
    table_of(spark, ODD + texts).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path, ODD + texts


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    table_of(spark, []).write.parquet(f"{path}/documents.parquet")
    return path


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_spelling(rows):
    n = collections.Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: sorted((v for v in n if one_edit(w, v)), key=lambda v: (-n[v], v)) for w in n}
    form = {w: near[w][0] if near[w] and n[near[w][0]] >= 5 * n[w] else None for w in n}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def test_spelling_equals_brute_force(spark, folder, sf):
    got = {r["word"]: tuple(r)[1:] for r in Q.op11_spelling(spark, folder[0]).collect()}
    assert got == brute_spelling(folder[1]) and any(v[0] for v in got.values())


def test_spelling_follows_chains_to_their_end(spark):
    words = spark.createDataFrame([("abcdef", 1), ("abcdeg", 5), ("abcdhg", 25), ("abckhg", 125), ("zzzzzz", 9), ("abcdeé", 1)], "word string, n long")
    got = {r["word"]: (r["form"], r["root"], r["n_near"]) for r in spelling.variants(words).collect()}
    assert got == {
        "abcdef": ("abcdeg", "abckhg", 2), "abcdeg": ("abcdhg", "abckhg", 3), "abcdhg": ("abckhg", "abckhg", 2), "abckhg": (None, "abckhg", 1),
        "zzzzzz": (None, "zzzzzz", 0), "abcdeé": ("abcdeg", "abckhg", 2),
    }


def test_reduced_neighbourhoods_lose_no_pair(spark):
    """Every word one random edit away is found, whatever letters fall on one symbol."""
    rng = np.random.default_rng(5)
    letters, pairs = list(spelling.LETTERS), []
    for _ in range(300):
        w = "".join(rng.choice(letters, int(rng.integers(1, 9))))
        k, c = int(rng.integers(0, len(w))), str(rng.choice(letters))
        pairs += [(w, w[:k] + w[k + 1 :]), (w, w[:k] + c + w[k + 1 :]), (w, w[:k] + c + w[k:])]
    df = spark.createDataFrame(pairs, "a string, b string").where("b != ''")
    assert df.where(~F.array_contains(spelling.neighbourhood(spelling.reduced("a")), spelling.reduced("b"))).count() == 0


def brute_alignment(encoders, text):
    """(a ids, b ids, groups, links with shared bytes) from whole texts, or None."""
    if not text:
        return None
    a, b = encoders.a.encode(" " + text, add_special_tokens=False).ids, encoders.b.encode(text)
    spans = []
    for ids, names in ((a, encoders.a_bytes), (b, encoders.b_bytes)):
        if b"".join(names[i] for i in ids) != (" " + text).encode():
            return None
        ends = np.cumsum([len(names[i]) for i in ids])
        spans.append((ends - [len(names[i]) for i in ids], ends))
    links, k = [], 0
    for i, (s, e) in enumerate(zip(*spans[0])):
        while spans[1][1][k] <= s:
            k += 1
        j = k
        while j < len(b) and spans[1][0][j] < e:
            links.append((i, j, int(min(e, spans[1][1][j]) - max(s, spans[1][0][j]))))
            j += 1
    groups, i, j = [], 0, 0
    for cut in sorted(set(spans[0][1]) & set(spans[1][1])):
        i2, j2 = int(np.searchsorted(spans[0][1], cut, "right")), int(np.searchsorted(spans[1][1], cut, "right"))
        groups.append((a[i:i2], b[j:j2]))
        i, j = i2, j2
    return a, b, groups, links


def test_alignment_equals_brute_force(spark, folder):
    encoders = alignment.Encoders(alignment.Files.load())
    want = [(key, text, brute_alignment(encoders, text)) for key, text in folder[1]]
    held = collections.Counter()
    for _, _, x in want:
        held.update({(x[0][i], x[1][j]) for i, j, _ in x[3]} if x else ())
    most = collections.defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    rows = []
    for key, _, x in want:
        if x is None:
            rows.append((key, 0, 0, 0, 0, 0, 0, "", 0))
            continue
        a, b, groups, links = x
        counts = [(a[i], held[a[i], b[j]]) for i, j, _ in links]
        digest = hashlib.sha256(";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups).encode()).hexdigest()
        rows.append((key, len(a), len(b), len(groups), len(links), sum(n == most[i] for i, n in counts), sum(n for _, n in counts), digest, sum(len(p) * len(q) for p, q in groups)))
    got = [tuple(r) for r in Q.op12_alignment(spark, folder[0]).collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr)


def test_alignment_gives_links_and_groups(spark):
    encoders = alignment.Encoders(alignment.Files.load())
    docs = table_of(spark, ODD)
    out = alignment.align(docs, alignment.Files.load(), ("a_ids", "b_ids", "groups", "links"))
    for r in out.collect():
        want = brute_alignment(encoders, r["row"]["text"])
        if want is None:
            assert (r["a_ids"], r["b_ids"], r["groups"], r["links"]) == ([], [], "", [])
        else:
            assert r["a_ids"] == want[0] and r["b_ids"] == want[1] and [tuple(x) for x in r["links"]] == want[3]
    assert out.select("row.*").columns == docs.columns


def test_products_of_sparse_matrices(monkeypatch):
    """Row products equal dense ones, in blocks of any size; groups link every two of their tokens."""
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (30, 20)), rng.integers(0, 3, (20, 25))

    def csr(m):
        rows, columns = np.nonzero(m)
        return alignment.Csr(np.concatenate([[0], np.cumsum((m != 0).sum(1))]), columns, m[rows, columns], m.shape[1])

    for block in (1, 50, 1_000_000):
        monkeypatch.setattr(alignment, "BLOCK", block)
        rows, columns, values = csr(x).times(csr(y))
        dense = np.zeros((30, 25), int)
        dense[rows, columns] = values
        assert (dense == x @ y).all()
        assert (csr(x).transposed().indptr == csr(x.T).indptr).all() and (csr(x).transposed().data == csr(x.T).data).all()
        al = alignment.align_tokens(np.arange(4), np.array([2, 3, 6, 9]), np.arange(3), np.array([1, 6, 9]))
        assert list(zip(*al.links)) == [(0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 1, 3), (3, 2, 3)] and al.shared.tolist() == [6, 1]
        assert [p for a, b in alignment.shared_group_links(al) for p in zip(a, b)] == [(i, j) for i in range(3) for j in range(2)] + [(3, 2)]


def test_joined_keys_have_the_values_of_the_head(spark, folder):
    """A head of any size gives the same sums, and no more keys than the limit."""
    files = alignment.Files.load()
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    found = heads.stored(alignment.align(docs.select("doc_id", "text"), files, ("n_a", "pairs", "times")).withColumn("row_id", F.monotonically_increasing_id()), "test")
    counts = alignment.pair_counts(found, 32_000)
    results = [sorted(map(tuple, alignment.scored(found, counts, limit).select("row_id", "n_best", "count_sum").collect())) for limit in (0, 100, 1 << 19)]
    assert results[0] == results[1] == results[2] and len(results[0]) == len(folder[1])
    assert 0 < heads.heaviest(counts, "n", 100).count() <= 100 and heads.heaviest(counts, "n", 0).count() == 0


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def test_lm_base_equals_brute_force(spark, folder):
    held = {key: key is not None and zlib.crc32(str(key).encode()) % 5 == 1 for key, _ in folder[1]}
    counts = collections.Counter(w for key, t in folder[1] if not held[key] for w in [*words_of(t), ""])
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for key, t in folder[1]:
        own = [counts[w] for w in [*words_of(t), ""]]
        want.append((key, held[key], len(own), sum(c > 0 for c in own), total, round(sum(math.log10((c + 0.5) / (total + 0.5 * (distinct + 1))) for c in own), 6)))
    got = Q.op13_lm_scoring(spark, folder[0]).collect()
    assert sorted((tuple(r)[:5] + (round(r["base_score"], 6),) for r in got), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    twice = [r["score"] for r in got if r["doc_id"] == 4]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_lm_probabilities_add_up_to_one(spark, folder):
    """Over all known words and an unknown one of each class, after any context."""
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    counts = lm_scoring.word_counts(docs)
    known = lm_scoring.statistics(counts, words=20, limit=50)
    found = lm_scoring.encoded(docs, known, "true")
    model = lm_scoring.train(found, lm_scoring.Model.start(known.prior))
    n = len(known.prior)
    context = np.concatenate([[3, 5, u] for u in range(n)])
    p = np.exp(model.log_probabilities(context, np.arange(0, 3 * n, 3))[2::3])
    assert abs(p.sum() - 1) < 1e-5
    own = {r["word"]: r for r in counts.collect()}
    top = set(known.words[known.units < known.first_class].tolist())
    shares = collections.defaultdict(lambda: 0.5)
    for w, r in own.items():
        if w not in top and w != lm_scoring.END:
            shares[r["class"]] += r["n"] + 0.5
    assert all(abs(s / 10 ** known.class_log[c] - 1) < 1e-9 for c, s in shares.items()) and len(top) == 20


def test_lm_beats_base_on_held_out_texts(spark, sf):
    rows = Q.op13_lm_scoring(spark, sf).where("held_out").collect()
    tokens, score, base = (sum(r[c] for r in rows) for c in ("n_tokens", "score", "base_score"))
    assert score / tokens > base / tokens + 0.05


def test_lm_learns_order():
    """A sequence in which each unit decides the next is told from its shuffled form."""
    rng = np.random.default_rng(1)
    n = 12
    nxt = rng.permutation(n)
    texts = []
    for _ in range(400):
        x = [int(rng.integers(n))]
        while len(x) < 30:
            x.append(int(nxt[x[-1]]) if rng.random() < 0.9 else int(rng.integers(n)))
        texts.append(x)
    flat, begins = np.concatenate(texts), np.arange(0, 30 * 400, 30)
    model = lm_scoring.Model.start(np.full(n, 1 / n))
    trainer = lm_scoring.Trainer(model, 1)
    for _ in range(6):
        trainer.texts(flat, begins)
    mean = model.log_probabilities(flat, begins).mean()
    shuffled = model.log_probabilities(rng.permutation(flat), begins).mean()
    assert mean > -1.2 and shuffled < mean - 1


def test_tokens_agree_with_the_words_and_their_last_bytes():
    import pyarrow as pa

    hasher = lm_scoring.Hasher(lm_scoring.NOT_BLANK)
    texts = ["The tHe", None, "", "x", "ab\tAb é\x0bÀ.", " y "]
    t = lm_scoring.tokens(pa.array(texts), hasher)
    words = [words_of(x) for x in texts]
    assert np.diff(t.bounds).tolist() == [len(w) for w in words]
    flat = [w for x in words for w in x]
    assert len(set(t.hashes.tolist())) == len(set(flat))
    want = [((w.encode()[-2] if len(w.encode()) > 1 else 0) * 31 + w.encode()[-1] * 7) % lm_scoring.CLASSES for w in flat]
    assert t.classes.tolist() == want


@pytest.mark.parametrize("name", ["op11_spelling", "op12_alignment", "op13_lm_scoring"])
def test_empty_table(spark, empty, name):
    assert Q.QUERIES[name](spark, empty).collect() == []


def test_one_class_of_documents_alone(spark):
    """Nothing to learn from: every word is unknown, and scores are defined."""
    docs = table_of(spark, ODD)
    out = lm_scoring.score(docs, "false").collect()
    assert len(out) == len(ODD) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in out)
    assert lm_scoring.score(docs, "doc_id = 4").where("row.doc_id = 4").first()["n_known"] == 3


NAMES = ("leaks_0", "_leaks_0", "row", "a.b", "key", "label", "_key", "_label", "N", "component", "node", "lines", "every", "of", "Leaks", "unit", "n_rows")


@pytest.fixture(scope="module")
def clashing(spark):
    """Rows whose columns are called as operators call their own, with a dot and in another case."""
    schema = "doc_id long, `Text` string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in NAMES)
    rows = [(k, t, "en" if k % 2 else "de", "s", 1, *("x" * len(NAMES))) for k, t in enumerate(["one two three four five six", "", None, "der die das und nicht ein", "one two three four five six"])]
    return spark.createDataFrame(rows, schema)


def test_any_column_names(spark, clashing):
    """Every operator on whole rows keeps columns of any name, and finds `text` however it is cased."""
    from tidemark.llm import decontamination, language_id, line_dedup, ngram_jaccard, pii, quality, sentencepiece_codec, toxicity

    codec, benchmark = sentencepiece_codec.Codec.load(), spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1, "x"), (1, 0, "x"), (3, 0, "x"), (4, 1, "x")], "doc_id long, toxic int, `_key` string")
    made = {
        "leaks": decontamination.scan(clashing, benchmark),
        "quality": quality.score(clashing, quality.learn(clashing)),
        "toxicity": toxicity.score(clashing, toxicity.learn(clashing, labels)),
        "lang_pred": language_id.identify(clashing, language_id.learn(clashing)),
        "decoded": sentencepiece_codec.decode(sentencepiece_codec.encode(clashing, codec), codec),
        "n_lines": line_dedup.drop_lines(clashing),
    }
    kept = [c for c in clashing.columns if c != "Leaks"]
    for name, df in made.items():
        rows = df.collect()
        assert len(rows) == 5 and name in df.columns and set(kept) <= set(df.columns), name
        assert all(r["a.b"] == "x" and r["row"] == "x" for r in rows)
    assert ngram_jaccard.join(clashing).count() == 5 and ngram_jaccard.one_row_each(clashing.union(clashing), text="Text").count() == 5
    assert lm_scoring.score(clashing, "true", "Text").count() == 5 and alignment.align(clashing, alignment.Files.load(), text="text").count() == 5
    assert spelling.occurrences(clashing).count() > 0
    assert pii.find(clashing).count() == 5 if hasattr(pii, "find") else True
