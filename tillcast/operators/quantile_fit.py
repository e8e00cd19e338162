"""Quantile regression of the decomposable design: one model for each wanted quantile.

The pinball loss is minimised by repeatedly reweighted least squares (majorise and minimise).
A series is one group, as long as the calendar. Afterwards the constant is set so that the wanted
share of the training days lies below, and forecasts of a day are put in order, so that the
quantiles never cross.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.decomposable import Config, Design, _active_and_penalty, training_frame
from tillcast.operators.normal_equations import dot, key_types

MOST_ROUNDS = 200
#: Relative change of the loss that counts as none, and the smallest residual, both of scaled values.
SMALL_CHANGE = 1e-7
SMALL_RESIDUAL = 1e-4


def _pinball(rest: np.ndarray, q: float) -> float:
    return float(np.mean(np.maximum(q * rest, (q - 1) * rest)))


def reweighted(x: np.ndarray, y: np.ndarray, q: float, penalty: np.ndarray):
    """Coefficients, rounds, whether the loss stopped falling, and the loss.

    Around residuals r the loss is at most the square of the new ones over 4 |r|, plus (q - 1/2) times
    them, which a weighted least-squares fit minimises.
    """
    held, tilt = np.diag(penalty), (2 * q - 1) * x.sum(axis=0)
    beta = np.linalg.solve(x.T @ x + held, x.T @ y)
    loss, rounds, settled = np.inf, 0, False
    while rounds < MOST_ROUNDS and not settled:
        weighted = x / (np.abs(y - x @ beta) + SMALL_RESIDUAL)[:, None]
        beta = np.linalg.solve(weighted.T @ x + held, weighted.T @ y + tilt)
        before, loss = loss, _pinball(y - x @ beta, q)
        rounds, settled = rounds + 1, bool(abs(before - loss) <= SMALL_CHANGE * max(loss, SMALL_RESIDUAL))
    beta[0] += np.quantile(y - x @ beta, q)
    return beta, rounds, settled, _pinball(y - x @ beta, q)


def fit(train: DataFrame, keys: list[str], design: Design, probs: dict[str, float], config: Config | None = None) -> DataFrame:
    """Per series: scaling, and arrays in the order of ``probs`` of ``quantile_coefficients``,
    ``rounds``, ``converged`` and ``loss`` (pinball, in units of ``y``)."""
    _, penalty = _active_and_penalty(design, config or Config())

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(rows["x"].to_numpy()), rows["y_scaled"].to_numpy(float)
        fits = [reweighted(x, y, q, penalty) for q in probs.values()]
        out = rows[[*keys, "t0", "span", "cap"]].iloc[:1].copy()
        out["quantile_coefficients"] = [[list(b) for b, *_ in fits]]
        out["rounds"] = [[n for _, n, _, _ in fits]]
        out["converged"] = [[c for _, _, c, _ in fits]]
        out["loss"] = [[v * float(out["cap"].iloc[0]) for *_, v in fits]]
        return out

    framed = training_frame(train, keys)
    rows = framed.where(F.col("y").isNotNull()).select(
        *keys, "t0", "span", "cap", F.array(*design.columns()).alias("x"), (F.col("y") / F.col("cap")).alias("y_scaled")
    )
    schema = (
        f"{key_types(train, keys)}, t0 date, span double, cap double, quantile_coefficients array<array<double>>, "
        "rounds array<int>, converged array<boolean>, loss array<double>"
    )
    return rows.groupBy(*keys).applyInPandas(run, schema)


def score(frame: DataFrame, models: DataFrame, keys: list[str], design: Design, probs: dict[str, float]) -> DataFrame:
    """``frame`` with a column for each quantile, by ascending share; none is above the next."""
    joined = frame.join(models.select(*keys, "t0", "span", "cap", "quantile_coefficients"), keys)
    columns = design.columns()
    values = [
        dot(F.col("quantile_coefficients")[i], columns) * F.col("cap") for i in range(len(probs))
    ]
    ordered = joined.withColumn("_q", F.array_sort(F.array(*values)))
    names = sorted(probs, key=probs.get)
    return ordered.withColumns({n: F.col("_q")[i] for i, n in enumerate(names)}).drop(
        "_q", "t0", "span", "cap", "quantile_coefficients"
    )
