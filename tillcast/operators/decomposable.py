"""Decomposable forecasts: piecewise-linear trend, Fourier seasons, regressors.

The model is linear in its columns, so a fit needs the data only through the matrix of column
products. Those are summed per series in the tasks that hold the rows (bounded state, whatever
the series length), merged by key, and solved once per configuration: trying 32 configurations
costs 32 small solves, not 32 passes over the data. A fitted model is a row of coefficients and
scoring is a column expression.

Differences from the usual Bayesian fit of such models: changepoint effects have a normal
instead of a Laplace prior (ridge); saturating growth is a linear trend clamped to [floor, cap];
multiplicative mode is an additive fit of log(1 + y). A daily season has no effect on daily data
and is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.dates import FLAG_COLUMNS
from tillcast.operators import series as ts
from tillcast.operators import whole_series
from tillcast.operators.normal_equations import key_types
from tillcast.operators.recursion import extended, in_order

# Prior scales: assumed noise variance of the scaled series and of season and regressor effects.
NOISE_VARIANCE = 0.05
SEASON_SCALE = 10.0


@dataclass(frozen=True)
class Design:
    """Columns of the model. Season orders of 0 switch a season off.

    ``lags`` last values of ``y`` and, by name, so many of other columns take part as well; the
    frame then has them as ``series.lag_matrix`` names them. A conditional season has a period, an
    order and a 0/1 column that switches it on; events are regressors (``joins.event_flags``).
    """

    changepoints: int = 10
    yearly_order: int = 6
    weekly_order: int = 3
    extra_seasons: tuple[tuple[float, int], ...] = ()
    regressors: tuple[str, ...] = tuple(FLAG_COLUMNS)
    lags: int = 0
    lagged_regressors: tuple[tuple[str, int], ...] = ()
    conditional_seasons: tuple[tuple[float, int, str], ...] = ()

    def groups(self) -> dict[str, int]:
        """Number of columns per component, in column order."""
        sizes = {
            "trend": 2 + self.changepoints,
            "yearly": 2 * self.yearly_order,
            "weekly": 2 * self.weekly_order,
            "extra": 2 * sum(order for _, order in self.extra_seasons),
            "conditional": 2 * sum(order for _, order, _ in self.conditional_seasons),
            "regressors": len(self.regressors),
            "lagged": sum(n for _, n in self.lagged_regressors),
            "autoregression": self.lags,
        }
        return {name: n for name, n in sizes.items() if n}

    def width(self) -> int:
        return sum(self.groups().values())

    def columns(self) -> list[Column]:
        """All model columns from ``ds``, ``t0``, ``span`` and the regressors."""
        t = F.datediff(F.col("ds"), F.col("t0")) / F.col("span")
        ds = F.col("ds")
        parts = [F.lit(1.0), t, *ts.trend_basis(t, self.changepoints)]
        parts += ts.fourier(ds, 365.25, self.yearly_order)
        parts += ts.fourier(ds, 7.0, self.weekly_order)
        for period, order in self.extra_seasons:
            parts += ts.fourier(ds, period, order)
        for period, order, condition in self.conditional_seasons:
            parts += ts.fourier(ds, period, order, F.col(condition))
        parts += [F.col(r) for r in self.regressors]
        parts += [F.col(f"{r}_lag_{k}") for r, n in self.lagged_regressors for k in range(1, n + 1)]
        # In units of the target, which is divided by the cap.
        parts += [F.col(f"y_lag_{k}") / F.col("cap") for k in range(1, self.lags + 1)]
        return [p.cast("double") for p in parts]

    def calendar_columns(self, days: np.ndarray) -> list[np.ndarray]:
        """In tasks: the columns after the trend, of days since 1970, where those follow from the day."""
        seasons = [(365.25, self.yearly_order), (7.0, self.weekly_order), *self.extra_seasons]
        angles = [days * (2.0 * math.pi * k / period) for period, order in seasons for k in range(1, order + 1)]
        known = whole_series.flags(days)
        return [f(a) for a in angles for f in (np.sin, np.cos)] + [known[r] for r in self.regressors]

    def filled(self, t: np.ndarray, calendar: np.ndarray) -> np.ndarray:
        """In tasks: all columns from scaled time and the columns that follow from the day."""
        x = np.empty((len(t), self.width()))
        x[:, 0], x[:, 1] = 1.0, t
        trend = 2 + self.changepoints
        np.maximum(0.0, t[:, None] - np.array(ts.changepoints(self.changepoints)), out=x[:, 2:trend])
        x[:, trend:] = calendar
        return x


@dataclass(frozen=True)
class Config:
    """One way to fit a design: prior scale of trend changes, mode, seasons that take part, and
    whether the trend is more than a constant."""

    changepoint_prior_scale: float = 0.1
    mode: str = "additive"
    yearly: bool = True
    weekly: bool = True
    slope: bool = True

    def params(self) -> dict[str, str]:
        return {
            "changepoint_prior_scale": str(self.changepoint_prior_scale),
            "seasonality_mode": self.mode,
            "yearly_seasonality": str(self.yearly).lower(),
            "weekly_seasonality": str(self.weekly).lower(),
        }


def search_grid() -> list[Config]:
    """The fixed grid that stands for a random search over the same four options."""
    scales = (0.001, 0.01, 0.1, 1.0)
    modes = ("additive", "multiplicative")
    on_off = (True, False)
    return [Config(*c) for c in product(scales, modes, on_off, on_off)]


# --- fitting ---------------------------------------------------------------------------------


def training_frame(train: DataFrame, keys: list[str]) -> DataFrame:
    """Add per-series scaling: first day, time span and cap (largest value, at least 1)."""
    w = Window.partitionBy(*keys)
    return train.withColumns(
        {
            "t0": F.min("ds").over(w),
            "span": F.greatest(F.datediff(F.max("ds").over(w), F.min("ds").over(w)), F.lit(1)).cast("double"),
            "cap": F.greatest(F.max("y").over(w), F.lit(1.0)).cast("double"),
            "last_date": F.max("ds").over(w),
        }
    )


_SUMS = "n long, gram array<double>, rhs array<double>, rhs_log array<double>"
_HELD_KEYS = 256


def _partial_sums(width: int, keys: list[str]):
    """Sum column products per key over the batches of a task.

    At most ``_HELD_KEYS`` keys are held; beyond that all are emitted, and merging by key later
    makes the result independent of where that happened.
    """

    def emit(held: dict) -> pd.DataFrame:
        records = [(*k, n, g.ravel(), r, rl) for k, (n, g, r, rl) in held.items()]
        return pd.DataFrame(records, columns=[*keys, "n", "gram", "rhs", "rhs_log"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False, sort=False):
                x = np.stack(rows["x"].to_numpy())
                y, y_log = rows["y_scaled"].to_numpy(), rows["y_log"].to_numpy()
                sums = (len(rows), x.T @ x, x.T @ y, x.T @ y_log)
                if key in held:
                    sums = tuple(a + b for a, b in zip(held[key], sums))
                elif len(held) >= _HELD_KEYS:
                    yield emit(held)
                    held = {}
                held[key] = sums
        if held:
            yield emit(held)

    return run


def _merge_sums(keys: list[str]):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        out = {k: rows[k].iloc[0] for k in keys} | {"n": int(rows["n"].sum())}
        for c in ("gram", "rhs", "rhs_log"):
            out[c] = np.sum(np.stack(rows[c].to_numpy()), axis=0)
        return pd.DataFrame([out])

    return merge


def column_products(
    train: DataFrame, keys: list[str], design: Design, spread: bool = False
) -> DataFrame:
    """Per key: row count, column products and products with both targets.

    ``train`` comes from :func:`training_frame`, where a series lies in one task. With
    ``spread`` a key has rows in many tasks (one model for all series), and its partial sums are
    merged in two steps.
    """
    scaled = train.select(
        *keys,
        F.array(*design.columns()).alias("x"),
        (F.col("y") / F.col("cap")).alias("y_scaled"),
        (F.log1p(F.greatest("y", F.lit(0.0))) / F.log1p("cap")).alias("y_log"),
    )
    types = {f.name: f.dataType.simpleString() for f in train.schema}
    key_ddl = ", ".join(f"{k} {types[k]}" for k in keys)
    partial = scaled.mapInPandas(_partial_sums(design.width(), keys), f"{key_ddl}, {_SUMS}")
    if spread:
        salted = partial.withColumn("salt", F.spark_partition_id() % 64)
        merged = salted.groupBy(*keys, "salt").applyInPandas(
            _merge_sums([*keys, "salt"]), f"{key_ddl}, salt int, {_SUMS}"
        )
        partial = merged.drop("salt")
    return partial.groupBy(*keys).applyInPandas(_merge_sums(keys), f"{key_ddl}, {_SUMS}")


def _active_and_penalty(design: Design, config: Config) -> tuple[np.ndarray, np.ndarray]:
    active, penalty = [], []
    season = NOISE_VARIANCE / SEASON_SCALE**2
    switched_off = {"yearly": not config.yearly, "weekly": not config.weekly}
    for name, n in design.groups().items():
        active += [not switched_off.get(name, False)] * n
        if name == "trend":
            active[1:] = [config.slope] * (n - 1)
            hinge = NOISE_VARIANCE / config.changepoint_prior_scale**2
            penalty += [1e-8, 1e-8] + [hinge] * (n - 2)
        elif name in ("autoregression", "lagged"):
            penalty += [1e-8] * n
        else:
            penalty += [season] * n
    return np.array(active), np.array(penalty)


def _solution(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(left, right)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(left, right, rcond=None)[0]


def _solve(design: Design, configs: list[Config], keys: list[str]):
    prepared = [(_active_and_penalty(design, c), c.mode) for c in configs]
    width = design.width()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            records = []
            for row in batch.to_dict("records"):
                gram = np.asarray(row["gram"]).reshape(width, width)
                chosen = row.get("config")
                ids = range(len(prepared)) if chosen is None else [int(chosen)]
                for i in ids:
                    (active, penalty), mode = prepared[i]
                    rhs = np.asarray(row["rhs"] if mode == "additive" else row["rhs_log"])
                    left = gram[np.ix_(active, active)] + np.diag(penalty[active])
                    beta = np.zeros(width)
                    beta[active] = _solution(left, rhs[active])
                    records.append((*[row[k] for k in keys], i, mode, beta))
            yield pd.DataFrame(records, columns=[*keys, "config", "mode", "coefficients"])

    return run


def solve(products: DataFrame, keys: list[str], design: Design, configs: list[Config]) -> DataFrame:
    """Coefficients per key and configuration; with a ``config`` column only of that one."""
    types = {f.name: f.dataType.simpleString() for f in products.schema}
    ddl = ", ".join(f"{k} {types[k]}" for k in keys)
    return products.mapInPandas(
        _solve(design, configs, keys), f"{ddl}, config int, mode string, coefficients array<double>"
    )


def series_scaling(train: DataFrame, keys: list[str]) -> DataFrame:
    """Per series: ``t0``, ``span``, ``cap`` and ``last_date``."""
    return train.groupBy(*keys).agg(
        F.min("ds").alias("t0"),
        F.greatest(F.datediff(F.max("ds"), F.min("ds")), F.lit(1)).cast("double").alias("span"),
        F.greatest(F.max("y"), F.lit(1.0)).cast("double").alias("cap"),
        F.max("ds").alias("last_date"),
    )


def _config_params(configs: list[Config], column: Column) -> Column:
    maps = []
    for c in configs:
        entries = [F.lit(v) for pair in c.params().items() for v in pair]
        maps.append(F.create_map(*entries))
    return F.array(*maps)[column]


def fit(
    train: DataFrame, keys: list[str], design: Design, config: Config | None = None, scope: str = "local"
) -> DataFrame:
    """Model rows for every series: scaling, configuration and coefficients.

    ``scope="global"`` fits one set of coefficients for all series (each scaled by its cap).
    """
    config = config or Config()
    framed = training_frame(train, keys)
    scaling = series_scaling(train, keys)
    if scope == "global":
        pooled = framed.withColumn("_pool", F.lit("all"))
        products = column_products(pooled, ["_pool"], design, spread=True)
        shared = solve(products, ["_pool"], design, [config])
        scaling = scaling.withColumn("_pool", F.lit("all"))
        models = scaling.join(shared, "_pool").drop("_pool")
    else:
        solved = solve(column_products(framed, keys, design), keys, design, [config])
        models = scaling.join(solved, keys)
    return models.withColumn("params", _config_params([config], F.col("config")))


def fit_global_season(train: DataFrame, keys: list[str], design: Design, config: Config | None = None):
    """Seasons and regressors shared by all series, a trend of its own for each.

    The shared fit is subtracted without its trend, and the rest is fitted with trend columns
    only. Both parts come back in one coefficient row per series.
    """
    config = replace(config or Config(), mode="additive")
    shared = fit(train, keys, design, config, scope="global")
    n_trend = design.groups()["trend"]
    scored = score(train, shared, keys, design, clamp=False)
    rest = scored.withColumn("y", F.col("y") - (F.col("yhat") - F.col("trend")))
    trend_only = Design(design.changepoints, 0, 0, (), ())
    framed = training_frame(train, keys).select(*keys, "ds", "t0", "span", "cap", "last_date")
    local_train = framed.join(rest.select(*keys, "ds", "y"), [*keys, "ds"])
    solved = solve(column_products(local_train, keys, trend_only), keys, trend_only, [config])
    local = solved.select(*keys, F.col("coefficients").alias("_trend"))
    seasons = F.slice("coefficients", n_trend + 1, design.width() - n_trend)
    return shared.join(local, keys).withColumn("coefficients", F.concat("_trend", seasons)).drop("_trend")


# --- scoring ---------------------------------------------------------------------------------


_MODEL_COLUMNS = ["t0", "span", "cap", "mode", "coefficients"]


def score(
    frame: DataFrame, models: DataFrame | None, keys: list[str], design: Design, clamp: bool = True
) -> DataFrame:
    """Add ``yhat`` and one column per component to the dates of ``frame``, which carries the
    model columns itself when ``models`` is None.

    Components are in units of ``y`` for additive models and in log units for multiplicative
    ones. ``clamp`` keeps the forecast in [0, cap].
    """
    joined = frame if models is None else frame.join(models, keys)
    scale = F.when(F.col("mode") == "additive", F.col("cap")).otherwise(F.log1p("cap"))
    columns, components, start = design.columns(), {}, 0
    for name, n in design.groups().items():
        terms = [F.col("coefficients")[i] * columns[i] for i in range(start, start + n)]
        components[name] = sum(terms[1:], terms[0]) * scale
        start += n
    scored = joined.withColumns(components)
    total = sum((F.col(c) for c in components), F.lit(0.0))
    yhat = F.when(F.col("mode") == "additive", total).otherwise(F.expm1(total))
    if clamp:
        yhat = clamp_to_cap(yhat, F.col("cap"))
    return scored.withColumn("yhat", yhat).drop(*_MODEL_COLUMNS)


def clamp_to_cap(yhat: Column, cap: Column, floor: float = 0.0) -> Column:
    """Saturating growth as a clamp: no forecast below the floor or above the cap."""
    return F.greatest(F.lit(floor), F.least(yhat, cap))


# --- lags ------------------------------------------------------------------------------------


def fit_lagged(train: DataFrame, keys: list[str], design: Design, config: Config | None = None, scope: str = "local"):
    """Model rows of a design with lags, fitted on the days that have all of them."""
    return fit(ts.lag_matrix(train, keys, design.lags, dict(design.lagged_regressors)), keys, design, config, scope)


def score_recursive(
    train: DataFrame, future: DataFrame, models: DataFrame, keys: list[str], design: Design
) -> DataFrame:
    """``keys, ds, yhat`` of the days of ``future``, which follow those of ``train``.

    The forecast of a day is a lag of the days after it. Of lagged regressors nothing is known after
    the last training day, whose value stays. For additive models; forecasts are not clamped.
    A series with fewer days than lags has no forecast.
    """
    names = [name for name, _ in design.lagged_regressors]
    deepest = max([design.lags, *[n for _, n in design.lagged_regressors]])
    order = Window.partitionBy(*keys).orderBy("ds")
    back = Window.partitionBy(*keys).orderBy(F.desc("ds"))
    recent = train.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= deepest)
    history = in_order(recent, keys, "ds", past=F.col("y")).drop("ds")
    conditions = [c for _, _, c in design.conditional_seasons]
    days = future.select(*keys, "ds", *design.regressors, *conditions).withColumn("_future", F.lit(True))
    if names:
        # The known days come along for the lags of the first future ones.
        both = recent.select(*keys, "ds", *names).unionByName(days, allowMissingColumns=True)
        kept = {n: F.last(n, ignorenulls=True).over(order) for n in names}
        lagged = {
            f"{n}_lag_{k}": F.lag(n, k).over(order)
            for n, count in design.lagged_regressors
            for k in range(1, count + 1)
        }
        days = both.withColumns(kept).withColumns(lagged).where("_future")
    joined = days.join(models, keys)
    known = replace(design, lags=0)
    drive = sum(
        (F.col("coefficients")[i] * c for i, c in enumerate(known.columns())), F.lit(0.0)
    )
    ahead = in_order(joined, keys, "ds", drive=drive * F.col("cap"))
    ahead = ahead.join(models.select(*keys, "coefficients"), keys).join(history, keys)
    ahead = ahead.where(F.size("past") >= design.lags)
    terms = {k: F.col("coefficients")[known.width() + k - 1] for k in range(1, design.lags + 1)}
    values = extended(F.col("drive"), F.col("past"), terms)
    return ahead.select(*keys, F.inline(F.arrays_zip(F.col("ds"), values.alias("yhat"))))


# --- cross-validation ------------------------------------------------------------------------


def cross_validate(
    series: DataFrame, keys: list[str], design: Design, config: Config | None = None, k: int = 5
) -> DataFrame:
    """The test days of ``k`` folds with growing training parts (see ``series.folds_expanding``):
    ``keys, fold, ds, y, yhat``, each predicted by the model of its fold.

    The training part of a fold is that of the one before and a block more. Column products are
    summed once, by block, and a fold's are the sum of its blocks: one pass and ``k`` small
    solves, equal to ``k`` separate fits. Time and size are scaled by the whole series, in all
    folds alike; trend changes after a training part have no effect in it.
    """
    config = config or Config()
    framed = training_frame(series, keys)
    placed = ts.numbered(framed, keys)
    size = F.floor(F.col("_rows") / (k + 1))
    first = F.col("_rows") - size * k  # rows of the first training part
    behind = F.greatest(F.col("_row") - first, F.lit(0))
    # 0 for the first training part, i for the test part of fold i.
    block = F.when(size > 0, F.ceil(behind / F.nullif(size, F.lit(0)))).otherwise(0).cast("int")
    placed = placed.withColumn("block", block).drop("_row", "_rows")
    blocks = column_products(placed.where(F.col("block") < k), [*keys, "block"], design)
    by_fold = [*keys, "fold"]
    folds = blocks.withColumn("fold", F.explode(F.sequence(F.col("block") + 1, F.lit(k)))).drop("block")
    types = key_types(folds, by_fold)
    sums = folds.groupBy(*by_fold).applyInPandas(_merge_sums(by_fold), f"{types}, {_SUMS}")
    solved = solve(sums, by_fold, design, [config])
    test = placed.where(F.col("block") > 0).withColumnRenamed("block", "fold")
    models = solved.select(*by_fold, "mode", "coefficients")
    scored = score(test.join(models, by_fold), None, by_fold, design, clamp=False)
    return scored.select(*by_fold, "ds", "y", "yhat")


# --- search ----------------------------------------------------------------------------------


def tune(
    train: DataFrame, keys: list[str], design: Design, validation_days: int = 28, configs=None
) -> DataFrame:
    """Best configuration per series by its error on the last days of the training part.

    The error is the percentage error over days with sales, or the absolute error where there
    are none. The test window takes no part.
    """
    configs = configs or search_grid()
    split = ts.split_tail_days(train, keys, validation_days)
    fit_part = split.where(F.col("split") == "train").drop("split")
    valid = split.where(F.col("split") == "test").drop("split")
    solved = solve(column_products(training_frame(fit_part, keys), keys, design), keys, design, configs)
    models = series_scaling(fit_part, keys).join(solved, keys)
    scored = score(valid, models, keys, design)
    error = F.abs(F.col("y") - F.col("yhat"))
    by_config = scored.groupBy(*keys, "config").agg(
        (F.avg(error / F.nullif(F.col("y"), F.lit(0.0))) * 100).alias("_mape"),
        F.avg(error).alias("_mae"),
    )
    loss = F.coalesce("_mape", "_mae", F.lit(float("inf")))
    ranked = by_config.withColumn("loss", loss)
    return ranked.groupBy(*keys).agg(
        F.min_by("config", F.struct("loss", "config")).alias("config"), F.min("loss").alias("loss")
    )


def fit_tuned(
    train: DataFrame, keys: list[str], design: Design, validation_days: int = 28, configs=None
) -> DataFrame:
    """Model rows fitted on the whole training part with each series' best configuration."""
    configs = configs or search_grid()
    best = tune(train, keys, design, validation_days, configs)
    products = column_products(training_frame(train, keys), keys, design).join(best, keys)
    solved = solve(products, keys, design, configs)
    models = series_scaling(train, keys).join(solved, keys)
    return models.withColumn("params", _config_params(configs, F.col("config")))


def _alike(design: Design, configs: list[Config], at: list[int]) -> list:
    """The configurations ``at`` these places by their columns: places in ``at``, modes, columns, and penalties
    as diagonal matrices."""
    groups: dict = {}
    for place, i in enumerate(at):
        active, penalty = _active_and_penalty(design, configs[i])
        groups.setdefault(active.tobytes(), []).append((place, configs[i].mode, active, np.diag(penalty[active])))
    merged = [list(zip(*group)) for group in groups.values()]
    return [(list(p), m, np.flatnonzero(active[0]), np.stack(d)) for p, m, active, d in merged]


class _WholeFit:
    """Column products of one whole series up to a day, scaled as by :func:`training_frame`."""

    def __init__(self, design: Design, calendar: whole_series.Calendar, first: int, y: np.ndarray):
        self.design, self.calendar, self.first = design, calendar, first
        self.span = float(max(len(y) - 1, 1))
        self.cap = float(max(y.max(), 1.0))
        x = self.columns(0, len(y) - 1)
        self.gram = x.T @ x
        logs = np.log1p(np.maximum(y, 0.0)) / np.log1p(self.cap)
        self.rhs = {"additive": x.T @ (y / self.cap), "multiplicative": x.T @ logs}

    def columns(self, begin: int, end: int) -> np.ndarray:
        days = self.calendar(self.first + begin, self.first + end)
        return self.design.filled(np.arange(begin, end + 1) / self.span, days)

    def solved(self, groups: list, n: int) -> np.ndarray:
        """A row of coefficients for each of ``n`` configurations, grouped by :func:`_alike`."""
        betas = np.zeros((n, len(self.gram)))
        for at, modes, active, penalties in groups:
            left = self.gram[np.ix_(active, active)] + penalties
            right = np.stack([self.rhs[mode][active] for mode in modes])
            try:
                found = np.linalg.solve(left, right[..., None])[..., 0]
            except np.linalg.LinAlgError:
                found = [_solution(a, b) for a, b in zip(left, right)]
            betas[np.ix_(at, active)] = found
        return betas

    def loss(self, begin: int, y: np.ndarray, betas: np.ndarray, modes: np.ndarray) -> np.ndarray:
        """Of each configuration, its error on the days from ``begin``, as in :func:`tune`."""
        total = self.columns(begin, begin + len(y) - 1) @ betas.T
        with np.errstate(over="ignore", invalid="ignore"):
            plain, logs = total * self.cap, np.expm1(total * np.log1p(self.cap))
            yhat = np.maximum(0.0, np.fmin(np.where(modes == "additive", plain, logs), self.cap))
        error = np.abs(y[:, None] - yhat)
        sold = y != 0
        return (error[sold] / y[sold, None]).mean(axis=0) * 100 if sold.any() else error.mean(axis=0)


def fit_tuned_whole(
    train: DataFrame, keys: list[str], design: Design, validation_days: int = 28, configs=None
) -> DataFrame:
    """The model rows of :func:`fit_tuned`, of whole series (see ``whole_series``) and without an exchange.

    For designs whose columns follow from the day. A series that is no longer than the validation has
    no model.
    """
    configs = configs or search_grid()
    every = _alike(design, configs, list(range(len(configs))))
    single = [_alike(design, configs, [i]) for i in range(len(configs))]
    modes = np.array([c.mode for c in configs])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        calendar = whole_series.Calendar(design.calendar_columns)
        for batch in whole_series.chunks(batches):
            records = []
            for *key, first, last, days, sold in batch[[*keys, "first", "last", "days", "sold"]].itertuples(index=False):
                y = whole_series.dense(first, last, days, sold)
                n = len(y) - validation_days
                if n < 1:
                    continue
                part = _WholeFit(design, calendar, first, y[:n])
                losses = part.loss(n, y[n:], part.solved(every, len(configs)), modes)
                i = int(np.argmin(np.where(np.isnan(losses), np.inf, losses)))
                whole = _WholeFit(design, calendar, first, y)
                beta = whole.solved(single[i], 1)[0]
                records.append((*key, first, whole.span, whole.cap, last, i, modes[i], beta))
            columns = [*keys, "t0", "span", "cap", "last_date", "config", "mode", "coefficients"]
            yield pd.DataFrame(records, columns=columns)

    schema = "t0 int, span double, cap double, last_date int, config int, mode string, coefficients array<double>"
    models = train.mapInPandas(run, f"{key_types(train, keys)}, {schema}")
    dated = {c: whole_series.as_date(F.col(c)) for c in ("t0", "last_date")}
    return models.withColumns(dated).withColumn("params", _config_params(configs, F.col("config")))
