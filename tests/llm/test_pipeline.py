"""The pipeline's stages: one run over the small tables, and each stage on odd rows."""

import pytest

import corpus_pipeline
from trailmark.llm import registry, stages, toxicity

ODD = [
    (1, None, "en", "a", 0, 1), (2, "", "en", "a", 0, 2), (3, " \t", None, None, 0, 3), (4, "one two", "en", "b", 7, 4),
    (4, "one two", "de", "b", 7, 5), (4, "one two", "de", "b", 7, 5), (None, "one  two", "en", "b", 7, 6), (None, "three four", "en", None, 9, 7),
    (5, "word " * 30_000, "en", "a", 150_000, 8), (6, " ".join(f"w{k}" for k in range(200)), "en", "c", 0, 9),
    (7, " ".join(f"w{k}" for k in range(201)), "en", "c", 0, 10),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, Toxic int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def test_run(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = stages.drop_toxic(spark, docs, small)
    assert first.columns == docs.columns
    out = corpus_pipeline.run(spark, small).collect()
    assert out and all(r.n_tokens == len(r.ids) for r in out)
    assert corpus_pipeline.STAGES is stages.STAGES and registry.queries()["pipeline"] is stages.run


@pytest.mark.parametrize("name,stage", stages.STAGES)
def test_empty_tables(spark, small, odd, name, stage):
    got = stage(spark, odd.limit(0), small)
    assert got.collect() == []
    assert name == "byte-level BPE" or got.columns == odd.columns


def test_toxicity_keeps_odd_rows(spark, small, odd):
    got = stages.drop_toxic(spark, odd, small)
    assert got.columns == odd.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, odd.collect()))


def test_clean_is_score(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = toxicity.trained(docs, spark.read.parquet(f"{small}/labels.parquet"))
    kept = {r.doc_id for r in toxicity.clean(docs, model).collect()}
    assert kept == {r.doc_id for r in toxicity.score(docs, model).where("NOT toxic").collect()}


def test_copies_of_odd_rows(spark, small, odd):
    got = stages.drop_copies(spark, odd, small).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "3", "4", "5", "6", "7", "None"]
    near = stages.drop_near_copies(spark, odd, small).collect()
    assert sorted(str(r.doc_id) for r in near) == ["1", "4", "5", "6", "None"]
    assert {r.Toxic for r in near} <= {r[5] for r in ODD}


def test_mix_and_tokens_of_odd_rows(spark, small, odd):
    got = stages.mix_sources(spark, odd, small)
    assert set(map(repr, got.collect())) <= set(map(repr, odd.collect()))
    tokens = stages.tokenise(spark, odd, small).collect()
    assert len(tokens) == len(ODD)
    assert sorted(r.n_tokens for r in tokens)[:2] == [0, 0]
