"""The pipeline, stage by stage."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.stored(stage(spark, docs, SF))
        assert out.columns == docs.columns, name
        assert dict(out.dtypes) == dict(docs.dtypes), name
        sizes.append(out.count())
        docs = out
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] >= sizes[4] > 0
    assert docs.where("n_chars <> char_length(text)").count() == 0
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len(rows) == sizes[4]
    assert all(r.token_ids[-1] == 2 and len(r.token_ids) == r.n_tokens for r in rows)


def test_stages_take_awkward_rows(spark, awkward):
    docs = awkward
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
    assert docs.count() > 0


def test_stages_take_an_empty_table(spark, empty):
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF))
    assert docs.count() == 0

