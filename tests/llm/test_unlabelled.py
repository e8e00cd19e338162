"""The first stage of the pipeline where no row has a language to learn from."""

import corpus_pipeline
from tests.llm.cases import stored_documents
from tillcast.llm.frames import materialise


def test_documents_without_labels_stay(spark):
    docs = stored_documents(spark)
    bare = docs.selectExpr(*[f"CAST(NULL AS string) AS {c}" if c == "lang" else c for c in docs.columns])
    bare, stage = materialise(bare, "unlabelled"), dict(corpus_pipeline.STAGES)["language_id"]
    kept = sorted(str(r.doc_id) for r in stage(spark, bare, "").collect())
    assert kept == sorted(str(r.doc_id) for r in stage(spark, docs, "").collect())
    assert 0 < len(kept) < docs.count()
