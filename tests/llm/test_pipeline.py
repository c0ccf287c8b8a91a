"""The pipeline's stages, each against a brute-force version of its decision on the stage's own input."""

import re

import duckdb

import corpus_pipeline
from tidemark.llm import language_id, line_dedup, sentencepiece_codec

from .test_llm import brute_components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_pipeline_stage_by_stage(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        given = docs
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and (k == 4 or docs.columns == COLUMNS)
        if name == "language_id":
            coders = language_id._coders(language_id.learn(given))
            told = {i: language_id.decide(r.text, coders) for i, r in before.items()}
            assert set(after) == {i for i, (lang, _, margin) in told.items() if lang != "und" and margin > language_id.MARGIN}
            assert len(after) > 0.97 * len(before)
        elif name == "line_dedup":
            con = duckdb.connect()
            documents = given.toPandas()  # noqa: F841
            want = dict(con.sql(line_dedup.OP2_SQL).project("doc_id, text").fetchall())
            assert {i: r.text for i, r in after.items()} == want
            assert all(r.n_chars == len(r.text) for r in after.values())
        elif name == "ngram_jaccard":
            groups = brute_components({i: r.text for i, r in before.items()})
            assert set(after) == {i for i, (_, c) in groups.items() if c == i}
        elif name == "decontamination":
            norm = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())) + " "
            items = [norm(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            leaked = {i for i, r in before.items() if any(x in norm(r.text) for x in items)}
            assert not leaked & set(after) and len(before) - len(after) <= len(leaked) + 2
        else:
            codec = sentencepiece_codec.Codec.load()
            assert set(after) == set(before) and all(codec.join(after[i].piece_ids) == before[i].text for i in after)
        seen.append(name)
    assert seen == ["language_id", "line_dedup", "ngram_jaccard", "decontamination", "sentencepiece"]


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "lang", "source", "n_pieces", "piece_ids"] and out.count() > 0
