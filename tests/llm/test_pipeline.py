"""The pipeline's stages, each on its own input."""

import pytest

import corpus_pipeline


@pytest.mark.parametrize("kind", ["edges", "empty"])
def test_stages_take_odd_and_empty_tables(spark, edge_dir, empty_dir, kind):
    folder = edge_dir if kind == "edges" else empty_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
        assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()


def test_run(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = corpus_pipeline.run(spark, sf)
    kept = pieces.select("doc_id").distinct()
    assert 0 < kept.count() < docs.count()
    assert kept.join(docs, "doc_id", "left_anti").isEmpty()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_emptied_documents_go_and_lengths_follow(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    rows = corpus_pipeline.line_dedup(spark, docs, edge_dir).collect()
    assert all(r["n_chars"] == len(r["text"] or "") for r in rows)
    thirteen = next(r for r in rows if r["doc_id"] == 13)
    assert thirteen["text"] == "first\r\n\nlast"
