"""License scan by voting on diagonals.

Every run of three words of every text is joined, by its hash and its words, to the places
where templates have it. A place in the text less the place in the template is a diagonal; a
template that stands in a text gathers votes on one diagonal, or on neighbouring ones where
words were put in or left out. Diagonals are merged, and the spans verified by the share of
the template's runs that they hold. Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import table

#: Phrases of the contract, and openings of public license texts.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
)
#: Words of a run, how far apart diagonals may be that are merged, the share of a template's runs that verifies a span.
RUN, NEAR, SHARE = 3, 3, 0.6


def words(text: Column) -> Column:
    """The words of a text in lower case: digits, letters and all beyond ASCII.

    lower() also changes letters beyond ASCII; no word begins, ends or becomes a template's by that.
    """
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def template_runs(spark: SparkSession, templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> DataFrame:
    """A row for each run of each template: (template, label, base, runs, at, w0, w1, w2)."""
    rows = []
    for k, (label, text, base) in enumerate([*((label, text, True) for text, label in phrases), *((label, text, False) for label, text in templates)]):
        w = text.split()
        rows += [(k, label, base, len(w) - RUN + 1, i, *w[i : i + RUN]) for i in range(len(w) - RUN + 1)]
    values = ", ".join(f"({k}, '{label}', {str(base).lower()}, {n}, {i}, '{a}', '{b}', '{c}')" for k, label, base, n, i, a, b, c in rows)
    return spark.sql(f"SELECT *, xxhash64(w0, w1, w2) AS run FROM VALUES {values} AS t(template, label, base, runs, at, w0, w1, w2)")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: tuple = TEMPLATES) -> DataFrame:
    """A row for each verified span: `key`, text_hash, label, base, first and last word, share of the template's runs.

    Base rows are exact places of a phrase. A phrase counts once for each place, and rows that
    repeat both key and text give their spans once. Templates are in the code and few, so they are broadcast.
    """
    runs = F.broadcast(template_runs(docs.sparkSession, templates))
    own = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("w")).where(F.size("w") >= RUN)
    own = own.select("doc_id", "text_hash", *(F.expr(f"slice(w, {k}, size(w) - 2)").alias(c) for k, c in enumerate("abc", 1)))
    own = own.select("doc_id", "text_hash", F.expr("posexplode(arrays_zip(a, b, c)) AS (pos, r)"))
    own = own.select("doc_id", "text_hash", "pos", "r", F.xxhash64("r.a", "r.b", "r.c").alias("run"))
    hits = own.join(runs, "run").where("r.a = w0 AND r.b = w1 AND r.c = w2")
    votes = hits.groupBy("doc_id", "text_hash", "template", "label", "base", "runs", (F.col("pos") - F.col("at")).alias("diagonal"))
    votes = votes.agg(F.collect_set("at").alias("at"), F.min("pos").alias("first"), F.max("pos").alias("last"))
    exact = votes.where("base AND size(at) = runs").select("doc_id", "text_hash", "label", "base", "first", (F.col("last") + RUN - 1).alias("last"), F.lit(1.0).alias("share"))

    order = Window.partitionBy("doc_id", "text_hash", "template").orderBy("diagonal")
    near = votes.where("NOT base").withColumn("_new", F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > NEAR, F.lit(True)).cast("int"))
    near = near.withColumn("island", F.sum("_new").over(order)).groupBy("doc_id", "text_hash", "template", "label", "base", "runs", "island")
    near = near.agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"), F.min("first").alias("first"), (F.max("last") + RUN - 1).alias("last"))
    near = near.withColumn("share", F.size("at") / F.col("runs")).where(F.col("share") >= SHARE)
    return exact.unionByName(near.select(*exact.columns))


def label(docs: DataFrame, text: str = "text", key: str = "doc_id", templates: tuple = TEMPLATES) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A null text counts as empty: no words, no labels, score 0. The score is the largest share
    of a template found, 1 for a base phrase. Rows with a null key and repeated rows stay.
    """
    found = scan(docs, text, key, templates).groupBy("doc_id", "text_hash").agg(
        F.count_if("base").alias("n_base"), F.min(F.when(F.col("base"), F.col("first"))).cast("long").alias("first_word"), F.max(F.when(F.col("base"), F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("base"), F.col("label")))), ",").alias("base_labels"), F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
    )
    rows = docs.select(F.col(key).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.size(words(F.col(text))).cast("long").alias("n_words")).alias("r")
    joined = rows.join(found.alias("f"), F.col("r.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("r.text_hash") == F.col("f.text_hash")), "left")
    return joined.select("r.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word", F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    return label(table(spark, sf_dir, "documents").select("doc_id", "text"))
