"""The pipeline's stages against plain versions, each on what the stage before kept."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import edge_documents, empty_documents, stored_documents
from tests.llm.test_table_operators import bare, check_packing, plain_components, plain_sets
from tests.llm.test_text_operators import plain_spans
from tillcast.llm.frames import materialise


def test_stages_against_plain_versions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    odd = edge_documents(spark).select(docs.columns).withColumn("doc_id", F.col("doc_id") + 10**6)
    docs = materialise(docs.unionByName(odd), "pipeline-test")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "secret_scan", "packing"]

    kept = materialise(stages["language_id"](spark, docs, small), "p1")
    assert kept.columns == columns
    gone = docs.exceptAll(kept).collect()
    assert {r.doc_id for r in gone} >= {10**6 + i for i in (1, 2, 3, 16)}
    assert not any(r.doc_id is not None and r.doc_id < 10**6 for r in gone)

    before, kept = kept, materialise(stages["exact_dedup"](spark, kept, small), "p2")
    best = {}
    for r in before.collect():
        rank = (-len(r.text), r.doc_id is None, r.doc_id)
        best[bare(r.text)] = min(best.get(bare(r.text), rank), rank)
    assert kept.columns == columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(b[2]) for b in best.values())

    before, kept = kept.collect(), materialise(stages["near_dedup"](spark, kept, small), "p3")
    sets = plain_sets([r.text for r in before], 5)
    components = plain_components([r.doc_id for r in before], sets, 80)
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, set(components)))

    before = {r.doc_id: r for r in kept.collect()}
    kept = materialise(stages["secret_scan"](spark, kept, small), "p4")
    assert kept.columns == columns and kept.count() == len(before)
    for r in kept.collect():
        spans = plain_spans(before[r.doc_id].text)
        if spans:
            assert r.text != before[r.doc_id].text and not plain_spans(r.text)
            assert r.n_chars == len(r.text)
        elif "[random]" not in r.text:
            assert r == before[r.doc_id]

    placed = stages["packing"](spark, kept, small)
    rows = placed.withColumns({"row": F.col("doc_id"), "id": F.col("doc_id"), "crc": F.col("ids_crc32")})
    used, total = check_packing(rows.collect(), [(r.doc_id, r.text) for r in kept.collect()], 1024)
    assert used <= -(-total // 1024) * 1.05 + 1
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_empty_table_and_unknown_columns(spark, small):
    docs = materialise(empty_documents(spark), "none")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, small), f"empty-{name}")
        assert docs.count() == 0
    docs = stored_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, docs, small), f"edge-{name}")
        assert out.columns == docs.columns
        docs = out
    assert 0 < docs.count() < edge_documents(spark).count()
