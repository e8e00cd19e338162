"""Standardised features and k-means segments."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 42


def scale(df: DataFrame, features: list[str]) -> DataFrame:
    """Replace features by (x - mean) / population std; a constant feature becomes 0.

    The two statistics per feature are fetched once and used as constants.
    """
    stats = []
    for f in features:
        stats += [F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}")]
    known = df.agg(*stats).first()
    scaled = {}
    for f in features:
        mean, std = known[f"m_{f}"], known[f"s_{f}"]
        scaled[f] = (F.col(f) - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)
    return df.withColumns(scaled)


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    scaled = {f"_z_{f}": F.col(f).cast("double") for f in features}
    renamed = scale(df.withColumns(scaled), list(scaled))
    return VectorAssembler(inputCols=list(scaled), outputCol="_x").transform(renamed)


def segment(df: DataFrame, features: list[str], k: int) -> DataFrame:
    """``df`` with a ``cluster`` column from k-means over standardised features.

    Clusters are numbered by the ascending centre of the first feature. ``df`` is read once per
    iteration, so pass a written table.
    """
    vectors = _vectors(df, features)
    model = KMeans(k=k, seed=SEED, featuresCol="_x", predictionCol="_p").fit(vectors)
    centres = [c[0] for c in model.clusterCenters()]
    rank = {old: new for new, old in enumerate(sorted(range(len(centres)), key=centres.__getitem__))}
    numbers = F.array(*[F.lit(rank[i]) for i in range(len(centres))])
    labelled = model.transform(vectors).withColumn("cluster", numbers[F.col("_p")])
    return labelled.select(*df.columns, "cluster")


def elbow(df: DataFrame, features: list[str], ks: range = range(1, 11)) -> DataFrame:
    """Sum of squared distances to the centres for each ``k``."""
    vectors = _vectors(df, features)
    total = sum((F.col(f"_z_{f}") * F.col(f"_z_{f}") for f in features), F.lit(0.0))
    rows = []
    for k in ks:
        if k == 1:
            cost = vectors.agg(F.sum(total)).first()[0]
        else:
            model = KMeans(k=k, seed=SEED, featuresCol="_x", predictionCol="_p").fit(vectors)
            cost = model.summary.trainingCost
        rows.append((k, float(cost)))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def silhouette(labelled: DataFrame, features: list[str]) -> DataFrame:
    """Mean silhouette (squared Euclidean distance) of a segmentation."""
    vectors = _vectors(labelled, features)
    evaluator = ClusteringEvaluator(featuresCol="_x", predictionCol="cluster")
    value = evaluator.evaluate(vectors)
    return labelled.sparkSession.createDataFrame([(float(value),)], "silhouette double")
