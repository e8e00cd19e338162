"""Partial pooling: each series' coefficients drawn towards those of all series.

The global model is the fit of all scaled series together. How far the local coefficients lie
around it, beyond what their own uncertainty explains, is the variance between series, by
coefficient. A series then gets the coefficients that its own days and a normal prior with that
variance around the global ones make most likely: short or noisy series lean on the others, and
long ones keep to their own. All of it comes from one sum of column products for each series.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators import normal_equations as ne
from tillcast.operators.decomposable import Config, Design, _active_and_penalty, series_scaling, training_frame
from tillcast.sources.shared import materialise


def _added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row for the batches of a task."""
    total = None
    for batch in batches:
        if len(batch):
            sums = (
                int(batch["n"].sum()), np.sum(np.stack(batch["gram"].to_numpy()), axis=0),
                np.sum(np.stack(batch["rhs"].to_numpy()), axis=0), float(batch["yy"].sum()),
            )
            total = sums if total is None else tuple(a + b for a, b in zip(total, sums))
    if total is not None:
        yield pd.DataFrame([total], columns=["n", "gram", "rhs", "yy"])


_SCHEMA = "n long, gram array<double>, rhs array<double>, yy double"


def pooled(sums: DataFrame) -> DataFrame:
    """One row with the sums of all groups: those of each task are one row, and these are added up."""
    return sums.select("n", "gram", "rhs", "yy").mapInPandas(_added, _SCHEMA).repartition(1).mapInPandas(_added, _SCHEMA)


def _local(keys: list[str], penalty: np.ndarray):
    """Coefficients, their own variances and the noise variance of each series."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            gram, rhs, yy, n = ne.stacked(batch)
            held = gram + np.diag(penalty)
            beta = np.linalg.solve(held, rhs[..., None])[..., 0]
            inverse = np.linalg.inv(held)
            # As many days go into the fit as coefficients that the data, not the prior, decide.
            used = np.einsum("sij,sji->s", inverse, gram)
            noise = ne.residual_squares(gram, rhs, yy, beta) / np.maximum(n - used, 1.0)
            out = batch[keys].copy()
            out["local"] = list(beta)
            out["own"] = list(noise[:, None] * np.einsum("sii->si", inverse))
            out["noise"] = np.maximum(noise, 1e-12)
            yield out

    return run


def _drawn(keys: list[str], penalty: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            gram, rhs, _, _ = ne.stacked(batch)
            centre = np.stack(batch["centre"].to_numpy())
            between = np.stack(batch["between"].to_numpy())
            # In units of the noise: a prior of noise / variance around the centre. No variance is
            # the centre itself, an infinite one is no prior.
            weight = np.zeros_like(between)
            some = (between > 0) & np.isfinite(between)
            noise = np.broadcast_to(batch["noise"].to_numpy()[:, None], between.shape)
            weight[some] = noise[some] / between[some]
            weight[between <= 0] = 1e12
            left = gram + np.eye(rhs.shape[1]) * (penalty + weight)[:, None, :]
            # Solved for the distance from the centre, which stays exact under heavy weights.
            right = rhs - np.einsum("sij,sj->si", gram, centre) - penalty * centre
            out = batch[keys].copy()
            out["config"], out["mode"] = 0, "additive"
            out["coefficients"] = list(centre + np.linalg.solve(left, right[..., None])[..., 0])
            yield out

    return run


def fit(
    train: DataFrame,
    keys: list[str],
    design: Design,
    config: Config | None = None,
    between: float | None = None,
) -> DataFrame:
    """Model rows like those of ``decomposable.fit``, for additive models.

    ``between`` replaces the estimated variance between series: 0 gives the global model, infinity the
    local ones. With one series, or none that differ, the variance is 0.
    """
    config = config or Config()
    _, penalty = _active_and_penalty(design, config)
    framed = training_frame(train, keys)
    sums = ne.product_sums(framed, keys, design.columns(), F.col("y") / F.col("cap"))
    sums = materialise(sums, "series-sums")
    types = ne.key_types(train, keys)
    local = materialise(
        sums.mapInPandas(_local(keys, penalty), f"{types}, local array<double>, own array<double>, noise double"),
        "local-fits",
    )
    centre = pooled(sums).mapInPandas(
        lambda batches: (
            pd.DataFrame({"centre": list(np.linalg.solve(g + np.diag(penalty), r[..., None])[..., 0])})
            for g, r, _, _ in (ne.stacked(b) for b in batches if len(b))
        ),
        "centre array<double>",
    )
    # Moments by coefficient: as many rows as the design has columns.
    moments = local.select(F.posexplode(F.arrays_zip("local", "own")).alias("j", "_c")).groupBy("j").agg(
        F.var_samp("_c.local").alias("spread"), F.avg("_c.own").alias("own")
    )
    if between is None:
        variance = F.greatest(F.coalesce(F.col("spread") - F.col("own"), F.lit(0.0)), F.lit(0.0))
    else:
        variance = F.lit(float(between))
    listed = moments.agg(F.sort_array(F.collect_list(F.struct("j", variance.alias("v")))).alias("_v"))
    shared = materialise(listed.select(F.col("_v.v").alias("between")).join(centre), "shared-model")
    rows = sums.join(local.select(*keys, "noise"), keys).join(F.broadcast(shared))
    solved = rows.mapInPandas(
        _drawn(keys, penalty), f"{types}, config int, mode string, coefficients array<double>"
    )
    return series_scaling(train, keys).join(solved, keys)
