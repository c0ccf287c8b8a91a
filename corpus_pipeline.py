"""Corpus preparation in five stages, each written as Parquet and read again.

Language identification, line deduplication, n-gram Jaccard join, benchmark decontamination,
SentencePiece encoding. Every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, language_id, line_dedup, ngram_jaccard, sentencepiece_codec
from tidemark.llm.tables import checkpoint_folder, small, table, written


def _identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart clearly; a null `lang` becomes the one found."""
    found = language_id.accepted(language_id.identify(docs, language_id.learn(docs)))
    return found.select(*(F.coalesce("lang", "lang_pred").alias("lang") if c == "lang" else F.col(f"`{c}`") for c in docs.columns))


def _drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines, with n_chars of what is left."""
    kept = line_dedup.drop_lines(docs)
    return kept.select(*(F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def _drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of linked documents, and rows without an id.

    Of rows that share an id the one with the greatest text stays, if any.
    """
    docs = ngram_jaccard.one_row_each(docs)
    groups = ngram_jaccard.join(docs)
    copies = written(groups.where("doc_id != component_id").select("doc_id"))
    return docs.join(small(copies), "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def _decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontamination.scan(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).drop("leaks")


def _encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_pieces and piece_ids of each document."""
    out = sentencepiece_codec.encode(docs, sentencepiece_codec.Codec.load())
    return out.select("doc_id", "lang", "source", F.when(F.col("piece_ids").isNotNull(), F.size("piece_ids")).cast("long").alias("n_pieces"), "piece_ids")


STAGES = [
    ("language_id", _identify_language),
    ("line_dedup", _drop_lines),
    ("ngram_jaccard", _drop_near_copies),
    ("decontamination", _decontaminate),
    ("sentencepiece", _encode),
]
#: Compression with dictionaries and the model's merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared checkpoint folder and read again."""
    folder, docs = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}", table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
