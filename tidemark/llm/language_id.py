"""Language identification by compression.

Each language has a raw-content zstandard dictionary cut from texts in that language. A
text is compressed, chunk by chunk and in full, with each dictionary; the language whose
dictionary gives the fewest bytes wins. The classification is rejected when the runner-up
needs only slightly more bytes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import boxed, extended, fold, place, sampled, table, unboxed
from .word_hashes import give_back

#: Bytes of dictionary for each language, documents sampled per language to fill it, bytes of text compressed at a time.
DICT_BYTES, SAMPLE_DOCS, CHUNK = 32_768, 120, 2_048
#: zstandard's level for texts of every length: the lowest at which matches of three bytes count, which short texts need.
LEVEL = 12
#: Relative gap to the runner-up below which a text is rejected, and the code for no language.
MARGIN, UNKNOWN = 0.004, "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample_docs: int = SAMPLE_DOCS, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """A dictionary for each language from a bounded sample of labelled rows.

    About `sample_docs` texts a language are sampled by the hash of `key`; whole texts are
    taken in hash order while they fit `dict_bytes`, and from a first text that is longer,
    its start (a bound of the dictionary; identify() reads whole texts). Rows with a null text or
    language teach nothing.
    """
    rows = docs.select(*(F.col(f"`{c}`").alias(name) for name, c in (("lang", lang), ("text", text), ("key", key)))).where("lang IS NOT NULL AND text IS NOT NULL")
    picked = sampled(rows, "lang", "key", sample_docs).select("lang", F.expr(f"left(text, {dict_bytes})").alias("text"), F.length("text").alias("n"), F.xxhash64(F.col("key").cast("string"), F.lit(17)).alias("h"))
    found: dict[str, bytes] = {}
    for r in sorted(picked.collect(), key=lambda r: (r.lang, r.h, r.text)):
        raw = letters(r.text).encode()
        have = found.setdefault(r.lang, b"")
        if not have or (r.n <= dict_bytes and len(have) + len(raw) < dict_bytes):
            found[r.lang] = have + raw[:dict_bytes] + b"\n"
    return found


def letters(text: str) -> str:
    """The text in lower case with a space for each run of blanks, signs and decimal digits."""
    return NOT_LETTERS.sub(" ", text.lower())


def _coders(dictionaries: dict[str, bytes], level: int = LEVEL) -> list[tuple[str, zstandard.ZstdCompressor]]:
    coders = []
    for name in sorted(dictionaries):
        d = zstandard.ZstdCompressionDict(dictionaries[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        coders.append((name, zstandard.ZstdCompressor(level=level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False)))
    return coders


def decide(text: str | None, coders: list, chunk: int = CHUNK) -> tuple[str, float, float]:
    """(language, score, relative margin) of one text; ties go to the first language by name.

    The score is 1/2 for a tie and nears 1 as the runner-up needs more bytes. Null texts and
    texts without a letter (digits, fractions and numerals of any script are none), and any
    text when no language was learned, are `und` with 0.
    """
    if text is None or not coders or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, 0.0
    raw = letters(text).encode("utf-8", "replace")
    parts = [raw[o : o + chunk] for o in range(0, len(raw), chunk)]
    sizes = sorted((sum(len(c.compress(p)) for p in parts), name) for name, c in coders)
    if len(sizes) == 1:
        return sizes[0][1], 1.0, 1.0
    gap = sizes[1][0] - sizes[0][0]
    return sizes[0][1], 1.0 / (1.0 + math.exp(-gap / 8.0)) if gap < 300 else 1.0, gap / sizes[0][0]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text") -> DataFrame:
    """`docs` with lang_pred string, lang_score double and lang_margin double added.

    Every row stays, repeated ones too; columns of those names are replaced, others may have any names.
    """
    docs = docs.drop("lang_pred", "lang_score", "lang_margin")
    at, rows = place(docs, text), boxed(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders = _coders(dictionaries)
        for batch in batches:
            got = [decide(t.as_py(), coders) for t in batch.column(0).field(at)]
            more = [pa.array([g[i] for g in got], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "lang_pred", "lang_score", "lang_margin"])
        give_back()

    return unboxed(rows.mapInArrow(run, extended(rows, "lang_pred string, lang_score double, lang_margin double")), "lang_pred", "lang_score", "lang_margin")


def accepted(docs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Rows of identify() that have a language and beat the runner-up by more than `margin` of the bytes."""
    return docs.where((F.col("lang_pred") != UNKNOWN) & (F.col("lang_margin") > margin))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score. Learns from documents outside the held-out quarter only."""
    docs = table(spark, sf_dir, "documents")
    dictionaries = learn(docs.where(fold("doc_id", 4) != 2))
    out = identify(docs.select("doc_id", "text"), dictionaries)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
