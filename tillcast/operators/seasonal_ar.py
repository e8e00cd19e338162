"""Seasonal autoregression for every series: differencing, a small order search, recursion.

Each series is one group of a grouped pandas function, as long as the calendar. The search fits
an ordinary regression of the differenced series on its last values, on values whole seasons
back and on the calendar regressors, and keeps the order with the lowest AIC. There are no
moving-average terms; that is the difference to a full seasonal ARIMA model.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.dates import FLAG_COLUMNS

DEFAULT_ORDERS = tuple(product((0, 1, 2, 3), (0, 1, 2)))


def _difference(v: np.ndarray, d: int, seasonal_d: int, m: int) -> np.ndarray:
    for _ in range(d):
        v = v[1:] - v[:-1]
    for _ in range(seasonal_d):
        v = v[m:] - v[:-m]
    return v


def _regressors(w: np.ndarray, x: np.ndarray, p: int, seasonal_p: int, m: int, start: int) -> np.ndarray:
    """Rows from ``start``: constant, lags 1..p, seasonal lags m, 2m, .., regressors."""
    n = len(w)
    columns = [np.ones(n - start)]
    columns += [w[start - k : n - k] for k in range(1, p + 1)]
    columns += [w[start - k * m : n - k * m] for k in range(1, seasonal_p + 1)]
    return np.column_stack([*columns, x[start:]])


def _fit_best(w: np.ndarray, x: np.ndarray, orders, m: int):
    """Order, coefficients and AIC of the best candidate, all judged on the same rows."""
    start = max(max(p, sp * m) for p, sp in orders)
    rows = len(w) - start
    best = None
    for p, sp in orders:
        design = _regressors(w, x, p, sp, m, start)
        if rows <= design.shape[1] + 1:
            continue
        beta, *_ = np.linalg.lstsq(design, w[start:], rcond=None)
        rss = float(np.sum((w[start:] - design @ beta) ** 2))
        aic = rows * np.log(max(rss / rows, 1e-12)) + 2 * (design.shape[1] + 1)
        if best is None or aic < best[2]:
            best = ((p, sp), beta, aic)
    return best


def _forecast(y, x_train, x_future, order, beta, d, seasonal_d, m) -> np.ndarray:
    """Extend the series one day at a time; each step uses the values before it."""
    p, sp = order
    values = list(y)
    w = list(_difference(np.asarray(y, float), d, seasonal_d, m))
    for x in x_future:
        lags = [w[-k] for k in range(1, p + 1)] + [w[-k * m] for k in range(1, sp + 1)]
        step = float(np.dot(beta, [1.0, *lags, *x]))
        w.append(step)
        # Undo the differences with the values already known.
        if seasonal_d and d:
            value = step + values[-1] + values[-m] - values[-m - 1]
        elif seasonal_d:
            value = step + values[-m]
        elif d:
            value = step + values[-1]
        else:
            value = step
        values.append(value)
    return np.maximum(np.asarray(values[len(y) :]), 0.0)


def _series_function(keys, regressors, orders, d, seasonal_d, m):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ds")
        train, future = rows[rows["split"] == "train"], rows[rows["split"] != "train"]
        y = train["y"].to_numpy(float)
        w = _difference(y, d, seasonal_d, m) if len(y) > d + seasonal_d * m else np.empty(0)
        x_train = train[regressors].to_numpy(float)[len(y) - len(w) :] if len(w) else np.empty((0, len(regressors)))
        best = _fit_best(w, x_train, orders, m) if len(w) > 2 else None
        out = future[[*keys, "ds"]].copy()
        if best is None:
            out["yhat"], out["status"], out["ar_order"] = np.nan, "too short", [[] for _ in range(len(out))]
            return out
        order, beta, _ = best
        x_future = future[regressors].to_numpy(float)
        out["yhat"] = _forecast(y, x_train, x_future, order, beta, d, seasonal_d, m)
        out["status"] = "ok"
        out["ar_order"] = [[order[0], d, order[1], seasonal_d, m] for _ in range(len(out))]
        return out

    return run


def forecast(
    frame: DataFrame,
    keys: list[str],
    regressors: list[str] | None = None,
    orders=DEFAULT_ORDERS,
    d: int = 0,
    seasonal_d: int = 1,
    m: int = 7,
) -> DataFrame:
    """Forecast the rows whose ``split`` is not ``train``.

    ``frame`` has ``ds, y, split`` and the regressors on all rows. The result has ``yhat``,
    ``status`` and ``ar_order`` = (lags, d, seasonal lags, seasonal d, m). ``m=12`` with monthly
    rows and ``orders`` without seasonal lags give the monthly and non-seasonal variants.
    """
    regressors = FLAG_COLUMNS if regressors is None else regressors
    used = frame.select(*keys, "ds", F.col("y").cast("double").alias("y"), "split", *regressors)
    types = {f.name: f.dataType.simpleString() for f in used.schema}
    ddl = ", ".join(f"{k} {types[k]}" for k in [*keys, "ds"])
    schema = f"{ddl}, yhat double, status string, ar_order array<int>"
    return used.groupBy(*keys).applyInPandas(
        _series_function(keys, regressors, orders, d, seasonal_d, m), schema
    )
