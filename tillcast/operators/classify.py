"""Multinomial logistic model of units sold."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import softmax

CATEGORIES = ["category", "department", "region", "event"]
NUMBERS = ["sell_price", "yearweek", "day"]
N_LABELS = 50
N_STORES = 1024

FEATURES = [*NUMBERS, *[f"_i_{c}" for c in CATEGORIES], "_stores"]


@dataclass
class Model:
    indexes: PipelineModel
    starts: list[int]  # first code of each attribute, of the stores, and of a missing store
    labels: list[int]
    weights: softmax.Weights


def prepare(rows: DataFrame) -> DataFrame:
    """Features as numbers and strings: a missing event is a value, ``day`` counts days."""
    return rows.withColumns(
        {
            "event": F.coalesce("event", F.lit("none")),
            "sell_price": F.coalesce(F.col("sell_price").cast("double"), F.lit(0.0)),
            "yearweek": F.col("yearweek").cast("double"),
            "day": F.datediff("date", F.lit("1970-01-01").cast("date")).cast("double"),
        }
    )


def _features(columns: list[pa.Array], starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and codes of :data:`FEATURES`; of a hashed store the place of its one entry counts."""
    *plain, stores = columns
    values = [column.to_numpy(zero_copy_only=False) for column in plain]
    numbers = np.array(values[: len(NUMBERS)], np.float64)
    if np.isnan(numbers).any():
        raise ValueError(f"a row without one of {NUMBERS}")
    places = stores.field("indices")
    hashed = np.full(len(places), starts[-1], np.int32)
    hashed[places.value_lengths().to_numpy(zero_copy_only=False) > 0] = places.flatten().to_numpy() + starts[-2]
    codes = [value.astype(np.int32) + start for value, start in zip(values[len(NUMBERS) :], starts)]
    return numbers, np.array([*codes, hashed], np.int32)


def _pack(batches: Iterator[pa.RecordBatch], starts: list[int]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, softmax.BLOCK_ROWS):
            batch = whole.slice(at, softmax.BLOCK_ROWS)
            numbers, codes = _features([batch.column(c) for c in FEATURES], starts)
            labels = batch.column("_label").to_numpy().astype(np.int32)
            parts = {"numbers": numbers, "codes": codes, "labels": labels}
            yield pa.record_batch({name: pa.array([part.tobytes()], pa.binary()) for name, part in parts.items()})


def train(rows: DataFrame, iterations: int = 20) -> Model:
    """``rows`` holds the features and the label ``sales``, limited to its frequent values.

    Attributes with few values have a coefficient for each. Store codes grow with the data and are
    hashed to a fixed width.
    """
    label = StringIndexer(inputCol="label", outputCol="_label", handleInvalid="skip")
    index = StringIndexer(inputCols=CATEGORIES, outputCols=[f"_i_{c}" for c in CATEGORIES], handleInvalid="keep")
    hashed = FeatureHasher(inputCols=["store_code"], outputCol="_stores", numFeatures=N_STORES)
    labelled = prepare(rows).withColumn("label", F.col("sales").cast("string"))
    stages = Pipeline(stages=[label, index, hashed]).fit(labelled)
    labels = [int(name) for name in stages.stages[0].labels]
    sizes = [len(values) + 1 for values in stages.stages[1].labelsArray]
    starts = np.cumsum([0, *sizes, N_STORES]).tolist()
    indexed = stages.transform(labelled).select(*FEATURES, "_label")
    packed = indexed.mapInArrow(lambda batches: _pack(batches, starts), softmax.SCHEMA)
    learned = starts[-1]
    weights = softmax.fit(packed, len(NUMBERS), learned + 1, len(labels), learned, iterations)
    return Model(PipelineModel(stages=stages.stages[1:]), starts, labels, weights)


def predict(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` with ``predicted_sales``."""
    starts, labels, weights = model.starts, np.array(model.labels, np.int64), model.weights

    @F.arrow_udf("bigint")
    def likeliest(*columns: pa.Array) -> pa.Array:
        found = np.empty(len(columns[0]), np.int64)
        for part, margins in weights.margins(softmax.Block.of(*_features(columns, starts))):
            found[part] = labels[margins.argmax(axis=1)]
        return pa.array(found)

    scored = model.indexes.transform(prepare(rows))
    return scored.select(*rows.columns, likeliest(*FEATURES).alias("predicted_sales"))
