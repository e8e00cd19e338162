"""Additive and multiplicative terms in one model: trend * (1 + multiplicative) + additive.

Every season and every regressor is of one kind or the other. With the trend held the rest is linear, and
with the multiplicative terms held the trend and the additive ones are, so two least-squares
fits take turns; neither can raise the penalised loss. A series is one group, as long as the
calendar.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.decomposable import Config, Design, _active_and_penalty, training_frame
from tillcast.operators.normal_equations import dot, key_types

MOST_ROUNDS = 100
#: Relative fall of the loss that ends the rounds.
SMALL_CHANGE = 1e-8


def multiplicative_columns(design: Design, multiplicative: set[str]) -> np.ndarray:
    """Which model columns are multiplicative; ``multiplicative`` names seasons (``yearly``, ``weekly``,
    ``extra``, ``conditional``) and regressors."""
    mask: list[bool] = []
    for name, n in design.groups().items():
        if name == "regressors":
            mask += [r in multiplicative for r in design.regressors]
        else:
            mask += [name in multiplicative and name != "trend"] * n
    unknown = multiplicative - set(design.groups()) - set(design.regressors) | (multiplicative & {"trend"})
    if unknown:
        raise ValueError(f"not terms of the design: {sorted(unknown)}")
    return np.array(mask)


def alternated(x: np.ndarray, y: np.ndarray, trend: np.ndarray, times: np.ndarray, penalty: np.ndarray):
    """Coefficients and the penalised loss after every round. ``trend`` and ``times`` mark columns."""
    plus = ~trend & ~times
    beta = np.zeros(x.shape[1])
    ridge = lambda z, target, p: np.linalg.solve(z.T @ z + np.diag(p), z.T @ target)
    losses: list[float] = []
    base, added = np.flatnonzero(trend | plus), np.flatnonzero(plus)
    scaled = np.flatnonzero(times)
    while len(losses) < MOST_ROUNDS:
        factor = 1.0 + x[:, times] @ beta[times]
        columns = x[:, base] * np.where(trend[base], factor[:, None], 1.0)
        beta[base] = ridge(columns, y, penalty[base])
        level = x[:, trend] @ beta[trend]
        both = np.concatenate([added, scaled])
        columns = np.hstack([x[:, added], level[:, None] * x[:, scaled]])
        if len(both):
            beta[both] = ridge(columns, y - level, penalty[both])
        rest = y - level * (1.0 + x[:, times] @ beta[times]) - x[:, plus] @ beta[plus]
        losses.append(float(rest @ rest + penalty @ (beta * beta)))
        if len(losses) > 1 and losses[-2] - losses[-1] <= SMALL_CHANGE * max(losses[-2], 1e-12):
            break
    return beta, losses


def fit(
    train: DataFrame, keys: list[str], design: Design, multiplicative: set[str], config: Config | None = None
) -> DataFrame:
    """Per series: scaling, ``coefficients``, and ``losses`` after every round."""
    _, penalty = _active_and_penalty(design, config or Config())
    times = multiplicative_columns(design, multiplicative)
    trend = np.arange(design.width()) < design.groups()["trend"]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        x, y = np.stack(rows["x"].to_numpy()), rows["y_scaled"].to_numpy(float)
        beta, losses = alternated(x, y, trend, times, penalty)
        out = rows[[*keys, "t0", "span", "cap"]].iloc[:1].copy()
        out["coefficients"], out["losses"] = [list(beta)], [losses]
        return out

    framed = training_frame(train, keys).where(F.col("y").isNotNull())
    rows = framed.select(
        *keys, "t0", "span", "cap", F.array(*design.columns()).alias("x"), (F.col("y") / F.col("cap")).alias("y_scaled")
    )
    schema = (
        f"{key_types(train, keys)}, t0 date, span double, cap double, coefficients array<double>, losses array<double>"
    )
    return rows.groupBy(*keys).applyInPandas(run, schema)


def score(frame: DataFrame, models: DataFrame, keys: list[str], design: Design, multiplicative: set[str]) -> DataFrame:
    """``frame`` with ``trend`` and ``additive`` in units of ``y``, ``multiplicative`` as a share of the
    trend, and ``yhat`` = trend * (1 + multiplicative) + additive, not clamped."""
    times = multiplicative_columns(design, multiplicative)
    trend = design.groups()["trend"]
    joined = frame.join(models.select(*keys, "t0", "span", "cap", "coefficients"), keys)
    columns, c = design.columns(), F.col("coefficients")
    chosen = lambda keep: [i for i in range(trend, design.width()) if times[i] == keep]
    total = lambda at: sum((c[i] * columns[i] for i in at), F.lit(0.0))
    scored = joined.withColumns(
        {
            "trend": dot(c, columns[:trend]) * F.col("cap"),
            "multiplicative": total(chosen(True)),
            "additive": total(chosen(False)) * F.col("cap"),
        }
    )
    yhat = F.col("trend") * (1 + F.col("multiplicative")) + F.col("additive")
    return scored.withColumn("yhat", yhat).drop("t0", "span", "cap", "coefficients")
