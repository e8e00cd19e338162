"""Seasonal ARIMA models of all series at once, by regressions on lags and innovations.

The method is that of Hannan and Rissanen: a long autoregression gives innovations, and a second
regression has their lags beside those of the series. Both are least squares over sums of column
products, so a series is read twice whatever number of orders is tried; each order is a subset
of the second regression's columns. Differences are chosen first: a seasonal one where the season
explains most of the detrended variance, an ordinary one where a Dickey-Fuller test keeps the
unit root. A season of order P or Q adds its lags and, next to lags of order p or q, the lag
after each season; these have coefficients of their own, which a product of polynomials would
tie together.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import FLAG_COLUMNS
from tillcast.operators import normal_equations as ne
from tillcast.operators import whole_series
from tillcast.operators.recursion import extended, in_order
from tillcast.operators.stats import DICKEY_FULLER_5PCT, stationarity
from tillcast.sources.shared import materialise

#: (p, q, P, Q) of the search and of series that are too short for it.
SEARCHED = tuple(product(range(4), range(3), range(3), range(2)))
FIXED = (1, 1, 1, 1)
# Fixed value: share of the detrended variance from which a season is differenced.
STRONG_SEASON = 0.64


def _lags(order: int, seasonal: int, m: int) -> list[int]:
    """Lags of ``order`` steps and ``seasonal`` seasons, and those a step after a season."""
    seasons = [m * k for k in range(1, seasonal + 1)] if m > 1 else []
    after = [s + 1 for s in seasons] if order else []
    return sorted({*range(1, order + 1), *seasons, *after})


def differencing(train: DataFrame, keys: list[str], m: int = 7) -> DataFrame:
    """``d`` and ``seasonal_d``, 0 or 1, per series of ``ds, y``. Without a season (``m`` 1), in
    series without two of them and in constant ones the second is 0."""
    order = Window.partitionBy(*keys).orderBy("ds")
    whole = Window.partitionBy(*keys)
    if m > 1:
        around = order.rowsBetween(-(m // 2), m // 2 if m % 2 else m // 2 - 1)
        placed = train.select(*keys, "ds", "y", F.row_number().over(order).alias("_row")).withColumn(
            "_rest", F.col("y") - F.avg("y").over(around)
        )
        season = F.avg("_rest").over(Window.partitionBy(*keys, F.col("_row") % m))
        # Within a position of the season first; the sums over positions are few rows.
        shares = (
            placed.withColumn("_noise", F.col("_rest") - season)
            .groupBy(*keys)
            .agg(
                F.var_pop("_noise").alias("_noise"),
                F.var_pop("_rest").alias("_all"),
                F.count("y").alias("_n"),
            )
        )
        strength = 1 - F.col("_noise") / F.nullif(F.col("_all"), F.lit(0.0))
        strong = (F.coalesce(strength, F.lit(0.0)) > STRONG_SEASON) & (F.col("_n") > 2 * m)
        seasonal = shares.select(*keys, strong.cast("int").alias("seasonal_d"))
    else:
        seasonal = train.select(*keys, F.lit(0).alias("seasonal_d")).distinct()
    joined = train.select(*keys, "ds", "y").join(seasonal, keys)
    before = F.when(F.col("seasonal_d") == 1, F.lag("y", m).over(order)).otherwise(0.0)
    seasonless = joined.withColumn("y", F.col("y") - before).where(F.col("y").isNotNull())
    tested = stationarity(seasonless, keys).select(*keys, F.col("suggested_d").alias("d"))
    return seasonal.join(tested, keys, "left").select(
        *keys, F.coalesce("d", F.lit(0)).cast("int").alias("d"), "seasonal_d"
    )


def _differenced(frame: DataFrame, keys: list[str], m: int) -> DataFrame:
    """``frame`` with its differences ``w``, NULL where a value before is missing."""
    order = Window.partitionBy(*keys).orderBy("ds")
    lag = lambda k: F.lag("y", k).over(order)
    d, seasonal_d = F.col("d"), F.col("seasonal_d")
    w = F.col("y") - F.when(d == 1, lag(1)).otherwise(0.0)
    w = w - F.when(seasonal_d == 1, lag(m)).otherwise(0.0)
    w = w + F.when((d == 1) & (seasonal_d == 1), lag(m + 1)).otherwise(0.0)
    return frame.withColumn("w", w)


def _stable(beta: np.ndarray, lags: list[int]) -> bool:
    """Whether values that follow the lags' coefficients die away."""
    if not lags or not len(beta):
        return True
    polynomial = np.zeros(max(lags) + 1)
    polynomial[0] = 1.0
    polynomial[lags] = -beta
    return bool(np.all(np.abs(np.roots(polynomial)) < 1.0))


def _chooser(orders, m: int, w_lags: list[int], e_lags: list[int], others: int):
    """Of stacked sums, for each series the stable order with the least corrected AIC: its number,
    coefficients and criterion, or None. All orders are judged on the same rows."""
    always = [0, *range(1 + len(w_lags) + len(e_lags), 1 + len(w_lags) + len(e_lags) + others)]
    columns = []
    for p, q, sp, sq in orders:
        own, errors = _lags(p, sp, m), _lags(q, sq, m)
        at = [1 + w_lags.index(k) for k in own] + [1 + len(w_lags) + e_lags.index(k) for k in errors]
        columns.append((own, errors, np.array(sorted([*always, *at]))))

    def choose(gram: np.ndarray, rhs: np.ndarray, yy: np.ndarray, n: np.ndarray) -> list:
        scores, betas = np.full((len(orders), len(n)), np.inf), []
        for i, (_, _, at) in enumerate(columns):
            some, right = gram[:, at][:, :, at], rhs[:, at]
            beta = ne.solved(some, right)
            betas.append(beta)
            k = len(at) + 1
            mean = np.maximum(ne.residual_squares(some, right, yy, beta) / n, 1e-12)
            corrected = n * np.log(mean) + 2 * k + 2 * k * (k + 1) / np.maximum(n - k - 1, 1)
            # Series with fewer than two rows for each column of the search have none.
            scores[i] = np.where(n >= 2 * rhs.shape[1], corrected, np.inf)
        found = []
        for s in range(len(n)):
            found.append(None)
            for i in np.argsort(scores[:, s], kind="stable"):
                own, errors, at = columns[i]
                if not np.isfinite(scores[i, s]):
                    break
                full = np.zeros(rhs.shape[1])
                full[at] = betas[i][s]
                lagged = [1 + w_lags.index(k) for k in own]
                moved = [1 + len(w_lags) + e_lags.index(k) for k in errors]
                if _stable(full[lagged], own) and _stable(-full[moved], errors):
                    found[s] = (int(i), full, scores[i, s])
                    break
        return found

    return choose


def _searching(keys: list[str], orders, m: int, w_lags: list[int], e_lags: list[int], others: int):
    """Rows of the chosen orders from rows of sums."""
    choose = _chooser(orders, m, w_lags, e_lags, others)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            named = batch[keys].itertuples(index=False, name=None)
            records = [
                (*key, list(map(int, orders[found[0]])), *found[1:])
                for key, found in zip(named, choose(*ne.stacked(batch)))
                if found
            ]
            yield pd.DataFrame(records, columns=[*keys, "chosen", "coefficients", "aicc"])

    return run


def _fit(frame: DataFrame, keys: list[str], regressors: list[str], orders, m: int, long_lags: int):
    """Model rows ``keys, d, seasonal_d, chosen, coefficients, aicc`` of the series that have rows
    enough, and the frame with differences and innovations. ``frame`` has ``d`` and
    ``seasonal_d``."""
    order = Window.partitionBy(*keys).orderBy("ds")
    w_lags = sorted({k for p, _, sp, _ in orders for k in _lags(p, sp, m)})
    e_lags = sorted({k for _, q, _, sq in orders for k in _lags(q, sq, m)})
    x = [F.col(r).cast("double") for r in regressors]
    is_train = F.col("split") == "train"
    differenced = materialise(_differenced(frame, keys, m).where(is_train).drop("split"), "differences")
    lags = lambda column, ks: [F.lag(column, k).over(order) for k in ks]
    # Innovations: what a long autoregression leaves.
    first = differenced.withColumn("_x", F.array(*lags("w", range(1, long_lags + 1))))
    design = [F.lit(1.0), *[F.col("_x")[k] for k in range(long_lags)], *x]
    long = ne.coefficients(ne.product_sums(first, keys, design, F.col("w")), keys)
    left = first.join(long, keys).withColumn("e", F.col("w") - ne.dot(F.col("coefficients"), design))
    left = materialise(left.drop("_x", "coefficients"), "innovations")
    second = left.withColumns(
        {"_w": F.array(*lags("w", w_lags)), "_e": F.array(*lags("e", e_lags))}
    )
    design = [
        F.lit(1.0),
        *[F.col("_w")[k] for k in range(len(w_lags))],
        *[F.col("_e")[k] for k in range(len(e_lags))],
        *x,
    ]
    # All orders are judged on the rows that have every lag.
    sums = ne.product_sums(second, keys, design, F.col("w"))
    schema = f"{ne.key_types(frame, keys)}, chosen array<int>, coefficients array<double>, aicc double"
    models = sums.mapInPandas(_searching(keys, orders, m, w_lags, e_lags, len(x)), schema)
    return models, left, w_lags, e_lags


def _ahead(frame, keys, regressors, orders, m, long_lags) -> DataFrame:
    models, left, w_lags, e_lags = _fit(frame, keys, regressors, orders, m, long_lags)
    models = materialise(models, "orders")
    back = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    longest = max([m + 1, *w_lags, *e_lags])
    recent = left.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= longest)
    history = in_order(recent, keys, "ds", w=F.col("w"), e=F.coalesce("e", F.lit(0.0)), y=F.col("y"))
    beta = F.col("coefficients")
    start = 1 + len(w_lags) + len(e_lags)
    x = [F.col(r).cast("double") for r in regressors]
    future = frame.where(F.col("split") != "train").join(models, keys)
    future = in_order(future, keys, "ds", drive=beta[0] + ne.dot(beta, x, start))
    orders_of = frame.select(*keys, "d", "seasonal_d").distinct()
    joined = future.join(models, keys).join(history.drop("ds"), keys).join(orders_of, keys)
    values = extended(
        F.col("drive"),
        F.col("w"),
        {k: beta[1 + i] for i, k in enumerate(w_lags)},
        F.col("e"),
        {k: beta[1 + len(w_lags) + i] for i, k in enumerate(e_lags)},
        F.col("y"),
        F.col("d"),
        F.col("seasonal_d"),
        m,
    )
    c = F.col("chosen")
    season = F.when(F.lit(m > 1), F.col("seasonal_d")).otherwise(0)
    named = F.array(c[0], F.col("d"), c[1], c[2], season, c[3], F.lit(m))
    entries = F.inline(F.arrays_zip(F.col("ds"), values.alias("yhat")))
    return joined.select(*keys, named.alias("order"), entries).withColumn(
        "yhat", F.greatest("yhat", F.lit(0.0))
    )


def forecast(
    frame: DataFrame,
    keys: list[str],
    regressors: list[str] | None = None,
    orders=SEARCHED,
    m: int = 7,
    long_lags: int | None = None,
    differences: DataFrame | None = None,
) -> DataFrame:
    """Forecast the rows whose ``split`` is not ``train``: ``keys, ds, yhat, status, order``.

    ``frame`` has ``ds, y, split`` and the regressors on all rows, days without gaps. ``order`` is
    (p, d, q, P, D, Q, m) and ``yhat`` at least 0. ``differences`` fixes ``d`` and ``seasonal_d`` by key,
    else they are tested. ``m`` 1 is a model without a season.

    A series that is too short for the search, or without a stable order, gets the fixed order
    (1, 1, 1)(1, 1, 1, m), status ``fixed order``; one too short for that has NaN and ``too short``.
    """
    regressors = FLAG_COLUMNS if regressors is None else regressors
    used = frame.select(*keys, "ds", F.col("y").cast("double").alias("y"), "split", *regressors)
    used = materialise(used, "series")
    train = used.where(F.col("split") == "train")
    chosen = materialise(differencing(train, keys, m) if differences is None else differences, "differencing")
    long_lags = long_lags or (3 * m if m > 1 else 10)
    searched = materialise(_ahead(used.join(chosen, keys), keys, regressors, orders, m, long_lags), "searched")
    found = [searched.withColumn("status", F.lit("ok"))]
    rest = materialise(used.join(searched.select(*keys).distinct(), keys, "left_anti"), "short-series")
    if not rest.isEmpty():
        seasonal = int(m > 1)
        fixed = rest.withColumns({"d": F.lit(1), "seasonal_d": F.lit(seasonal)})
        order = FIXED if seasonal else (*FIXED[:2], 0, 0)
        plain = materialise(_ahead(fixed, keys, [], (order,), m, m + 1), "fixed-order")
        found.append(plain.withColumn("status", F.lit("fixed order")))
        none = rest.where(F.col("split") != "train").join(
            plain.select(*keys).distinct(), keys, "left_anti"
        )
        found.append(
            none.select(
                *keys, F.array().cast("array<int>").alias("order"), "ds",
                F.lit(float("nan")).alias("yhat"), F.lit("too short").alias("status"),
            )
        )
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(*keys, "ds", "yhat", "status", "order")


# --- whole series ----------------------------------------------------------------------------


def _differencing_of(y: np.ndarray, m: int) -> tuple[int, int]:
    """``d`` and ``seasonal_d`` of one series, as :func:`differencing` finds them."""
    n, seasonal = len(y), 0
    if m > 1:
        ones = np.ones(m)
        # Sums over the days around, fewer at the ends.
        begin = m - 1 - m // 2 if m % 2 else m // 2 - 1
        near = [np.convolve(v, ones)[begin : begin + n] for v in (y, np.ones(n))]
        rest = y - near[0] / near[1]
        place = np.arange(1, n + 1) % m
        counts = np.maximum(np.bincount(place, minlength=m), 1)
        noise = rest - (np.bincount(place, weights=rest, minlength=m) / counts)[place]
        spread = rest.var()
        seasonal = int(n > 2 * m and spread > 0 and 1 - noise.var() / spread > STRONG_SEASON)
    z = y[m:] - y[:-m] if seasonal else y
    if len(z) < 2:
        return 0, seasonal
    x, change = z[:-1], np.diff(z)
    x, dy = x - x.mean(), change - change.mean()
    sxx, syy, sxy = x @ x, dy @ dy, x @ dy
    if sxx == 0 or len(x) == 2:
        return 1, seasonal
    slope = sxy / sxx
    error = np.sqrt(max((syy - slope * sxy) / (len(x) - 2), 0.0) / sxx)
    return int(not (error > 0 and slope / error < DICKEY_FULLER_5PCT)), seasonal


def _lagged(values: np.ndarray, lags: list[int], start: int) -> list[np.ndarray]:
    return [values[start - k : len(values) - k] for k in lags]


class _WholeSums:
    """Differences and innovations of one series, and the sums of its second regression; ``n`` is 0
    where it has no row with every lag."""

    def __init__(self, y, x, d: int, seasonal_d: int, m: int, long_lags: int, w_lags, e_lags):
        self.y, self.d, self.seasonal_d, self.n = y, d, seasonal_d, 0
        w = np.diff(y) if d else y
        # Without the first days, which have no differences.
        self.w = w = w[m:] - w[:-m] if seasonal_d and len(w) > m else w[: 0 if seasonal_d else None]
        x = x[len(y) - len(w) : len(y)]
        start = long_lags
        if len(w) <= start:
            return
        first = np.stack([np.ones(len(w) - start), *_lagged(w, range(1, start + 1), start), *x[start:].T], axis=1)
        beta = ne.solved((first.T @ first)[None], (first.T @ w[start:])[None])[0]
        e = np.zeros(len(w))
        e[start:] = w[start:] - first @ beta
        self.e = e
        at = max([start + max(e_lags, default=0), *w_lags])
        if len(w) <= at:
            return
        second = np.stack([np.ones(len(w) - at), *_lagged(w, w_lags, at), *_lagged(e, e_lags, at), *x[at:].T], axis=1)
        self.n, self.gram, self.rhs = len(second), second.T @ second, second.T @ w[at:]
        self.yy = float(w[at:] @ w[at:])

    def ahead(self, beta: np.ndarray, x: np.ndarray, m: int, w_lags: list[int], e_lags: list[int]) -> np.ndarray:
        """The levels of the days of ``x``, at least 0; innovations to come are 0."""
        start = 1 + len(w_lags) + len(e_lags)
        w, e, y = (list(v[-(max([m + 1, *w_lags, *e_lags])) :]) for v in (self.w, self.e, self.y))
        n = len(y)
        for drive in beta[0] + x @ beta[start:]:
            value = drive + sum(b * w[-k] for k, b in zip(w_lags, beta[1:]))
            value += sum(b * e[-k] for k, b in zip(e_lags, beta[1 + len(w_lags) :]))
            level = value
            if self.d:
                level += y[-1]
            if self.seasonal_d:
                level += y[-m] - (y[-m - 1] if self.d else 0.0)
            w.append(value)
            e.append(0.0)
            y.append(level)
        return np.maximum(np.array(y[n:]), 0.0)


def forecast_whole(
    train: DataFrame,
    keys: list[str],
    days: int,
    orders=SEARCHED,
    m: int = 7,
    long_lags: int | None = None,
    actual: str | None = None,
) -> DataFrame:
    """:func:`forecast` with the calendar flags, for the ``days`` days after each of whole series (see
    ``whole_series``), without an exchange. Rows of a batch are searched together. ``actual`` names a
    column with those days' values, which become ``y``."""
    carried = [*keys, actual] if actual else keys
    long_lags = long_lags or (3 * m if m > 1 else 10)
    seasonal = int(m > 1)
    fixed = (FIXED if seasonal else (*FIXED[:2], 0, 0),)

    def lags_of(orders) -> tuple[list[int], list[int]]:
        return (
            sorted({k for p, _, sp, _ in orders for k in _lags(p, sp, m)}),
            sorted({k for _, q, _, sq in orders for k in _lags(q, sq, m)}),
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calendar = whole_series.Calendar(lambda d: [whole_series.flags(d)[c] for c in FLAG_COLUMNS])
        nothing = whole_series.Calendar(lambda d: [])

        def found(batch, at: list[int], values: dict, orders, differences, columns, longest: int, status: str):
            """Of the series at these places, those that get an order: place, status, order, values."""
            w_lags, e_lags = lags_of(orders)
            sums = {}
            for i in at:
                first, last = batch["first"].iloc[i], batch["last"].iloc[i]
                d, season = differences(values[i])
                made = _WholeSums(values[i], columns(first, last), d, season, m, longest, w_lags, e_lags)
                if made.n:
                    sums[i] = made
            if not sums:
                return
            choose = _chooser(orders, m, w_lags, e_lags, columns(0, 0).shape[1])
            stacked = [np.stack([getattr(s, c) for s in sums.values()]) for c in ("gram", "rhs", "yy", "n")]
            for (i, s), best in zip(sums.items(), choose(*stacked)):
                if best:
                    p, q, sp, sq = orders[best[0]]
                    last = batch["last"].iloc[i]
                    yhat = s.ahead(best[1], columns(last + 1, last + days), m, w_lags, e_lags)
                    yield i, status, [p, s.d, q, sp, s.seasonal_d if seasonal else 0, sq, m], yhat

        for batch in whole_series.chunks(batches):
            values = {
                i: whole_series.dense(*row)
                for i, row in enumerate(batch[["first", "last", "days", "sold"]].itertuples(index=False, name=None))
            }
            every = list(values)
            test = lambda y: _differencing_of(y, m)
            done = list(found(batch, every, values, orders, test, calendar, long_lags, "ok"))
            rest = sorted(set(every) - {i for i, *_ in done})
            done += found(batch, rest, values, fixed, lambda y: (1, seasonal), nothing, m + 1, "fixed order")
            short = sorted(set(rest) - {i for i, *_ in done})
            done += [(i, "too short", [], np.full(days, np.nan)) for i in short]
            out = batch[carried].iloc[[i for i, *_ in done]].reset_index(drop=True)
            out["after"] = batch["last"].iloc[[i for i, *_ in done]].to_numpy()
            for at, name in enumerate(("status", "order", "yhat"), 1):
                out[name] = pd.Series([row[at] for row in done], dtype=object)
            yield out

    schema = f"{ne.key_types(train, carried)}, after int, status string, order array<int>, yhat array<double>"
    listed = train.mapInPandas(run, schema)
    entries = F.arrays_zip("yhat", F.col(actual).alias("y")) if actual else F.arrays_zip("yhat")
    long = listed.select(*keys, "after", "status", "order", F.posexplode(entries).alias("_i", "_e"))
    day = whole_series.as_date(F.col("after") + F.col("_i") + 1)
    # A NaN in an array leaves a task as NULL.
    yhat = F.coalesce(F.col("_e")["yhat"], F.lit(float("nan"))).alias("yhat")
    values = [F.col("_e")["y"].alias("y"), yhat] if actual else [yhat]
    return long.select(*keys, day.alias("ds"), *values, "status", "order")
