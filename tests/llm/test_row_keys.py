"""Row keys where every scan of the input is split in another way."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import sentence
from tests.llm.test_table_operators import plain_components, plain_sets
from tillcast.llm import exact_dedup, frames, jaccard_join, language_id, secret_scan, warc
from tillcast.llm.frames import materialise, numbered, place_key
from tillcast.sources.shared import new_path

COST, LEAST = "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"


@pytest.fixture
def resplit(spark, monkeypatch):
    """Each table written packs the files of later scans in another way."""
    least = itertools.count(2)

    def write(df, name, *more):
        out = materialise(df, name, *more)
        spark.conf.set(LEAST, str(next(least)))
        return out

    for module in (corpus_pipeline, exact_dedup, frames, jaccard_join, language_id, secret_scan, warc):
        if hasattr(module, "materialise"):
            monkeypatch.setattr(module, "materialise", write)
    spark.conf.set(COST, "0")
    spark.conf.set(LEAST, "1")
    yield
    spark.conf.unset(COST)
    spark.conf.unset(LEAST)


def documents(spark):
    rng = random.Random(5)
    texts = [sentence(rng, rng.randint(30, 120)) for _ in range(60)]
    texts += texts[:20] + [t + " more" for t in texts[20:40]]
    texts = [f'{t} token = "{rng.randbytes(20).hex()}"' if k % 7 == 0 else t for k, t in enumerate(texts)]
    data = [(i, t, "en", "src", len(t)) for i, t in enumerate(texts)]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return materialise(spark.createDataFrame(data, kind).repartition(9), "resplit"), dict(enumerate(texts))


def test_place_keys(spark):
    docs, texts = documents(spark)
    keys = []
    spark.conf.set(COST, "0")
    for least in ("1", "9"):
        spark.conf.set(LEAST, least)
        keys.append({r.key: r.doc_id for r in place_key(docs, "key").collect()})
    spark.conf.unset(COST)
    spark.conf.unset(LEAST)
    assert keys[0] == keys[1] and sorted(keys[0].values()) == sorted(texts)
    files = docs.inputFiles()
    twice = spark.read.parquet(*files, *files)
    for other in (docs.union(docs), docs.join(docs.select("doc_id"), "doc_id"), twice,
                  docs.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2)))),
                  spark.createDataFrame([(1,)], "a int")):
        assert place_key(other, "key") is None
        keyed = numbered(other, "key", stored=True)
        assert keyed.select("key").distinct().count() == other.count()
        assert keyed.columns == [*other.columns, "key"]


def test_archives(spark, resplit):
    docs, texts = documents(spark)
    pages = docs.selectExpr("doc_id AS page_id", "source AS url", "text AS html")
    path = new_path(spark, "warc-resplit")
    warc.write_archives(pages, path, stored=True)
    full = warc.resolved(warc.read_archives(spark, path)).collect()
    assert {r.page_id: r.payload.decode() for r in full} == texts and len(full) == len(texts)


def test_near_copies(spark, resplit):
    docs, texts = documents(spark)
    found = jaccard_join.similar_components(docs, words=4, percent=85, stored=True).collect()
    expected = plain_components(list(texts), plain_sets(texts.values(), 4), 85)
    assert {r.id: r.component_id for r in found} == dict(zip(texts, expected))


@pytest.mark.parametrize("stage", ["exact_dedup", "near_dedup", "secret_scan"])
def test_stages(spark, resplit, stage):
    docs, texts = documents(spark)
    kept = {r.doc_id: r.text for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, "").collect()}
    if stage == "exact_dedup":
        expected = sorted(dict(zip(reversed(texts.values()), reversed(texts))).values())
    elif stage == "near_dedup":
        expected = sorted(set(plain_components(list(texts), plain_sets(texts.values(), 5), 80)))
    else:
        assert all(("[assign]" in t) == ("token =" in texts[i]) for i, t in kept.items())
        assert {i: t.split(" token")[0].split(" [")[0] for i, t in kept.items()} == {
            i: t.split(" token")[0] for i, t in texts.items()
        }
        expected = sorted(texts)
    assert sorted(kept) == expected
