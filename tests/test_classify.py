"""The classification model against the same model on wide vectors."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from tillcast.operators import classify, lbfgs, softmax


def _rows(spark, n):
    """Five labels of unequal size; some rows without category, event, price or store."""
    return spark.range(n, numPartitions=1).selectExpr(
        "cast(if(id % 17 = 0, null, 1 + pmod(hash(id, 1), 900) / 100) as decimal(10,2)) as sell_price",
        "if(id % 29 = 0, null, concat('c', pmod(hash(id, 2), 4))) as category",
        "concat('d', pmod(hash(id, 3), 6)) as department",
        "concat('r', pmod(hash(id, 4), 3)) as region",
        "if(id % 5 = 0, 'fair', null) as event",
        "199501 + pmod(hash(id, 5), 52) as yearweek",
        "date_add(date'1995-01-01', pmod(hash(id, 6), 365)) as date",
        "if(id % 31 = 0, null, cast(pmod(hash(id, 7), 40) as string)) as store_code",
        "cast(1 + (id + pmod(hash(id, 2), 4)) % 7 % 5 as bigint) as sales",
    )


def _wide(rows, iterations):
    names = classify.CATEGORIES
    indexed, encoded = [f"_i_{c}" for c in names], [f"_o_{c}" for c in names]
    label = StringIndexer(inputCol="label", outputCol="_label", handleInvalid="skip")
    stages = [
        label,
        StringIndexer(inputCols=names, outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        FeatureHasher(inputCols=["store_code"], outputCol="_stores", numFeatures=1024),
        VectorAssembler(inputCols=[*classify.NUMBERS, *encoded, "_stores"], outputCol="_x"),
        LogisticRegression(
            featuresCol="_x", labelCol="_label", predictionCol="_p", maxIter=iterations, family="multinomial"
        ),
    ]
    labelled = classify.prepare(rows).withColumn("label", F.col("sales").cast("string"))
    model = Pipeline(stages=stages).fit(labelled)
    named = IndexToString(inputCol="_p", outputCol="_name", labels=model.stages[0].labels)
    return model.stages[-1], named.transform(model.transform(labelled)).select(F.col("_name").cast("bigint"))


def test_same_model_as_on_wide_vectors(spark):
    rows = _rows(spark, 3000)
    wide, expected = _wide(rows, 12)
    model = classify.train(rows, 12)
    found = np.concatenate([model.weights.numbers, model.weights.codes[:-1]])
    found = found - found.mean(axis=1, keepdims=True)
    assert np.allclose(found, wide.coefficientMatrix.toArray().T, atol=1e-7)
    assert not model.weights.codes[-1].any()
    predicted = classify.predict(model, rows)
    assert predicted.columns == [*rows.columns, "predicted_sales"]
    assert [r[0] for r in predicted.select("predicted_sales").collect()] == [r[0] for r in expected.collect()]


def test_unknown_values_are_scored(spark):
    model = classify.train(_rows(spark, 300), 3)
    new = _rows(spark, 20).drop("sales").withColumns({"region": F.lit("new"), "store_code": F.lit("new")})
    assert classify.predict(model, new).where("predicted_sales between 1 and 5").count() == 20
    assert classify.predict(model, new.limit(0)).count() == 0


def test_passes_are_spread_over_all_cores(spark, monkeypatch):
    """One part of input, but no pass of the optimiser in one task."""
    parts = []
    add_up = softmax._add_up

    def watched(blocks, of_block):
        parts.append(blocks.getNumPartitions())
        return add_up(blocks, of_block)

    monkeypatch.setattr(softmax, "_add_up", watched)
    classify.train(_rows(spark, 200), 2)
    assert set(parts) == {2 * spark.sparkContext.defaultParallelism}


def test_minimum_of_a_curved_valley():
    def valley(x):
        a, b = 1 - x[0], x[1] - x[0] ** 2
        return a * a + 100 * b * b, np.array([-2 * a - 400 * x[0] * b, 200 * b])

    assert np.allclose(lbfgs.minimise(valley, np.array([-1.2, 1.0]), 100), [1.0, 1.0], atol=1e-3)
