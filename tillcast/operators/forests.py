"""Pooled tree models: a forest over daily features, and sale / amount in two steps."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.scalars import safe_divide

SEED = 42


def forest_forecast(train: DataFrame, test: DataFrame, features: list[str], trees: int = 100):
    """Add ``yhat`` to ``test`` from a random forest fitted on ``train``."""
    assembler = VectorAssembler(inputCols=features, outputCol="_x")
    forest = RandomForestRegressor(
        featuresCol="_x", labelCol="y", predictionCol="yhat", numTrees=trees, seed=SEED
    )
    model = forest.fit(assembler.transform(train).select("_x", "y"))
    return model.transform(assembler.transform(test)).drop("_x")


def two_step_forecast(
    train: DataFrame, test: DataFrame, keys: list[str], features: list[str], trees: int = 100
) -> DataFrame:
    """Forecast for series that are mostly zero: will there be a sale, and how large.

    ``yhat`` is the predicted class times the predicted amount; the actual class of a test row
    is not used. Amounts are pooled over series as a ratio to the series' mean sale. The
    features are a few calendar values, so both forests train on one weighted row per feature
    combination, however many rows there are. A combination stands for many rows, all of which
    would hardly ever miss a bootstrap sample, so the trees differ by feature subsets only.
    """
    is_sale = (F.col("y") > 0).cast("double")
    sizes = train.groupBy(*keys).agg(F.avg(F.when(F.col("y") > 0, F.col("y"))).alias("_size"))
    cells = train.groupBy(*features, is_sale.alias("_sale")).agg(F.count("*").cast("double").alias("_w"))
    ratio = safe_divide(F.col("y"), F.col("_size"))
    amounts = (
        train.where(F.col("y") > 0)
        .join(sizes, keys)
        .groupBy(*features)
        .agg(F.avg(ratio).alias("_ratio"), F.count("*").cast("double").alias("_w"))
    )
    assembler = VectorAssembler(inputCols=features, outputCol="_x")
    classifier = RandomForestClassifier(
        featuresCol="_x", labelCol="_sale", weightCol="_w", predictionCol="predicted_sale",
        probabilityCol="_prob", rawPredictionCol="_raw", numTrees=trees, seed=SEED,
        bootstrap=False,
    ).fit(assembler.transform(cells))
    regressor = RandomForestRegressor(
        featuresCol="_x", labelCol="_ratio", weightCol="_w", predictionCol="_amount",
        numTrees=trees, seed=SEED, bootstrap=False,
    ).fit(assembler.transform(amounts))
    scored = regressor.transform(classifier.transform(assembler.transform(test)))
    sized = scored.join(sizes, keys, "left")
    yhat = F.col("predicted_sale") * F.col("_amount") * F.coalesce("_size", F.lit(0.0))
    return sized.withColumn("yhat", yhat).drop("_x", "_prob", "_raw", "_amount", "_size")
