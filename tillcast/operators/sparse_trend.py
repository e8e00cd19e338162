"""Sparse trend changes: a Laplace prior on the changes, as an exact penalised fit.

Changes of the trend are few, so their prior is a Laplace one: the sum of their sizes is held
back, and most become 0. All other columns are eliminated from the stored column products; what
is left is a small problem in the changes alone, solved by coordinate descent with a soft
threshold for all series of a batch at once. No pass over the days is needed. ``violation`` is
how far the solution is from the conditions that an optimum meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import normal_equations as ne
from tillcast.operators.decomposable import (
    NOISE_VARIANCE,
    Config,
    Design,
    _active_and_penalty,
    series_scaling,
    training_frame,
)
from tillcast.operators.series import changepoints

SWEEPS = 5000
TOLERANCE = 1e-10


def soft(x: np.ndarray, threshold: float) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - threshold, 0.0)


def descended(gram: np.ndarray, rhs: np.ndarray, threshold: float) -> np.ndarray:
    """Least squares in few variables with a penalty of ``threshold`` times their absolute sum, for
    every series of the stack."""
    beta = np.zeros_like(rhs)
    diagonal = np.maximum(np.einsum("sii->si", gram), 1e-12)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(rhs.shape[1]):
            rest = rhs[:, j] - np.einsum("si,si->s", gram[:, j], beta) + diagonal[:, j] * beta[:, j]
            new = soft(rest, threshold) / diagonal[:, j]
            moved = max(moved, float(np.max(np.abs(new - beta[:, j]), initial=0.0)))
            beta[:, j] = new
        if moved < TOLERANCE:
            break
    return beta


def violation(gram: np.ndarray, rhs: np.ndarray, beta: np.ndarray, sparse: np.ndarray, threshold: float) -> np.ndarray:
    """Largest failure of the optimality conditions per series: the gradient is 0, at changes the
    threshold against their sign, and within the threshold where a change is 0."""
    gradient = rhs - np.einsum("sij,sj->si", gram, beta)
    at_zero = np.maximum(np.abs(gradient) - threshold, 0.0)
    moved = np.abs(gradient - threshold * np.sign(beta))
    failing = np.where(sparse, np.where(beta == 0, at_zero, moved), np.abs(gradient))
    return failing.max(axis=1)


def _solving(keys: list[str], design: Design, config: Config):
    active, penalty = _active_and_penalty(design, config)
    sparse = np.zeros(design.width(), bool)
    sparse[2 : 2 + design.changepoints] = True
    penalty = np.where(sparse, 0.0, penalty)
    kept, few = np.flatnonzero(active & ~sparse), np.flatnonzero(active & sparse)
    threshold = NOISE_VARIANCE / config.changepoint_prior_scale

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            gram, rhs, _, _ = ne.stacked(batch)
            # An empty column keeps no coefficient.
            empty = np.einsum("sii->si", gram) <= 0
            gram = gram + np.eye(design.width()) * np.where(empty, 1.0, penalty)[:, None, :]
            beta = np.zeros_like(rhs)
            both = gram[:, kept][:, :, few]
            solved = np.linalg.solve(gram[:, kept][:, :, kept], np.concatenate([rhs[:, kept, None], both], axis=2))
            left = gram[:, few][:, :, few] - np.einsum("ski,skj->sij", both, solved[:, :, 1:])
            beta[:, few] = descended(left, rhs[:, few] - np.einsum("ski,sk->si", both, solved[:, :, 0]), threshold)
            beta[:, kept] = solved[:, :, 0] - np.einsum("skj,sj->sk", solved[:, :, 1:], beta[:, few])
            worst = violation(gram[:, active][:, :, active], rhs[:, active], beta[:, active], sparse[active], threshold)
            out = batch[keys].copy()
            out["config"], out["mode"] = 0, "additive"
            out["coefficients"], out["violation"] = list(beta), worst
            yield out

    return run


def fit(train: DataFrame, keys: list[str], design: Design, config: Config | None = None) -> DataFrame:
    """Model rows like those of ``decomposable.fit``, and ``violation`` and ``changes``: the number
    of trend changes that are not 0. ``config.changepoint_prior_scale`` is the prior's scale; the smaller, the
    fewer changes. For additive models."""
    config = config or Config()
    framed = training_frame(train, keys)
    sums = ne.product_sums(framed, keys, design.columns(), F.col("y") / F.col("cap"))
    schema = (
        f"{ne.key_types(train, keys)}, config int, mode string, coefficients array<double>, violation double"
    )
    solved = sums.mapInPandas(_solving(keys, design, config), schema)
    changes = F.slice("coefficients", 3, max(design.changepoints, 1))
    models = series_scaling(train, keys).join(solved, keys)
    number = F.size(F.filter(changes, lambda c: c != 0)) if design.changepoints else F.lit(0)
    return models.withColumn("changes", number)


def trend_changes(models: DataFrame, keys: list[str], design: Design) -> DataFrame:
    """``keys, ds, effect``: the days on which the trend changes and by how much a day, in units of
    ``y``."""
    listed = models.select(
        *keys, "t0", "span", "cap",
        F.posexplode(F.slice("coefficients", 3, design.changepoints)).alias("_j", "_effect"),
    ).where(F.col("_effect") != 0)
    shares = F.array(*[F.lit(c) for c in changepoints(design.changepoints)])
    day = F.date_add("t0", F.round(shares[F.col("_j")] * F.col("span")).cast("int"))
    return listed.select(*keys, day.alias("ds"), (F.col("_effect") * F.col("cap") / F.col("span")).alias("effect"))
