"""Spelling variants: words of a corpus that differ by one letter from a word that is far more frequent.

Letters are reduced to a few symbols by a hash. Every word generates the whole one-edit
neighbourhood of its reduced form (itself, deletions, replacements, insertions, in the small
alphabet) and is joined with the words whose reduced form is in it: one edit between two words is
one edit or none between their reduced forms, so no pair is lost, and a small alphabet keeps the
neighbourhood short. Candidates are verified on the words themselves. Each word follows its most
frequent near word, if that is frequent enough; chains are resolved by pointer jumping.

Everything is DataFrame operations. A pair meets once, since a word has one reduced form and a
neighbourhood no repeats; a reduced form that very many words share is split by adaptive execution.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table, written

#: Letters of a word (lower-cased A-Z; two signs among the accented ones belong to the contract's range).
PLAIN, ACCENTED = "abcdefghijklmnopqrstuvwxyz", "".join(map(chr, range(0xC0, 0x100)))
LETTERS = PLAIN + ACCENTED
#: Symbols of the reduced alphabet.
SYMBOLS = "01234567"
#: Of so many runs one loses a letter; code points and occurrences of a word; times a form is as frequent as its variant.
ONE_IN, LEAST_LENGTH, LEAST_COUNT, TIMES = 199, 6, 5, 5


def occurrences(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """`word` for every run of letters in every text, in no order.

    A null text has none; a null key counts as an empty one. A run whose crc32 with the key is a
    multiple of ONE_IN loses one letter, the same one wherever the run stands in the document.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kept = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").alias("body"))
    runs = kept.select("id", F.explode(F.regexp_extract_all(F.translate("body", upper, PLAIN), F.lit(f"([a-z{ACCENTED[0]}-{ACCENTED[-1]}]+)"))).alias("run"))
    h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
    at = (h % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(h % ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, length: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words with at least `length` code points and `count` occurrences."""
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= count)


def reduced(word: str | Column) -> Column:
    """A word in the small alphabet."""
    return F.translate(word, LETTERS, "".join(SYMBOLS[zlib.crc32(c.encode()) % len(SYMBOLS)] for c in LETTERS))


def neighbourhood(form: str | Column) -> Column:
    """The distinct strings at most one edit from a reduced form, in the small alphabet."""
    form = F.col(form) if isinstance(form, str) else form
    size, symbols = F.length(form), F.array(*map(F.lit, SYMBOLS))

    def head(i: Column) -> Column:
        return F.substring(form, F.lit(1), i)

    def tail(i: Column) -> Column:
        return F.substring(form, i + 1, size)

    places, gaps = F.sequence(F.lit(1), size), F.sequence(F.lit(0), size)
    deleted = F.transform(places, lambda i: F.concat(head(i - 1), tail(i)))
    replaced = F.flatten(F.transform(places, lambda i: F.transform(symbols, lambda c: F.concat(head(i - 1), c, tail(i)))))
    inserted = F.flatten(F.transform(gaps, lambda i: F.transform(symbols, lambda c: F.concat(head(i), c, tail(i)))))
    return F.array_distinct(F.concat(F.array(form), deleted, replaced, inserted))


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, n) for every two words (distinct, with `n`) exactly one edit apart, in both directions; n is that of `near`."""
    forms = words.select("word", "n", reduced("word").alias("form"))
    asked = forms.select("word", F.explode(neighbourhood("form")).alias("form"))
    pairs = asked.join(forms.select(F.col("word").alias("near"), "n", "form"), "form")
    return pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "near", "n")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """`words` (word, n) with form, root, n_near and form_n.

    The form is the near word of the largest n, the first in code-point order of several; it is null if
    that n is under `times` (2 or more) the word's. The root follows forms to the last. Words come out
    once each; an empty table gives an empty one.
    """
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best"))
    told = words.join(best, "word", "left")
    good = -F.col("best.less") >= times * F.col("n")
    told = written(told.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")))
    up = told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # a form is at least twice as frequent, so chains are short; their length halves each time
        further = up.select(F.col("word").alias("root"), F.col("root").alias("top"))
        up = written(up.join(further, "root", "left").select("word", F.coalesce("top", "root").alias("root"), F.col("top").isNotNull().alias("moved")))
        if not up.where("moved").limit(1).count():
            break
        up = up.drop("moved")
    return told.join(up.select("word", "root"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n. Other columns of `documents` play no part."""
    return variants(written(vocabulary(occurrences(table(spark, sf_dir, "documents")))))


#: The same in DuckDB: crc32 from its polynomial, near words by the letter that is replaced or missing, roots by recursion.
OP11_SQL = """
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_concat([b::BIGINT], range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v FROM range(256) r(b))),
found AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT run, k, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c) - 64] END)) AS data FROM found),
hashed AS (
  SELECT run, k, xor(list_reduce(list_concat([4294967295::BIGINT], data), lambda x, c: xor(x >> 8, t.crc[(xor(x, c) & 255) + 1])), 4294967295) AS h FROM coded, crc_table t),
words AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
holes AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i::INT - 1) AS a, substr(word, i::INT + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT x.word, y.word AS other, y.n FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT x.word, y.word, y.n FROM holes x JOIN words y ON y.word = x.a || x.b
  UNION SELECT y.word, x.word, x.n FROM holes x JOIN words y ON y.word = x.a || x.b),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, encode(other)) AS other, max(n) AS other_n FROM near GROUP BY word),
told AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form, CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, 0 AS depth FROM told
  UNION ALL SELECT c.word, t.form, c.depth + 1 FROM chain c JOIN told t ON t.word = c.root WHERE t.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM told JOIN (SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word) USING (word)
"""
