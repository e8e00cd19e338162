"""Least squares for many groups at once, from sums of column products.

A task sums the products of the rows that it holds, for a bounded number of groups; the sums are
merged by group, so that neither the length of a group nor its spread over tasks matters. Every
subset of the columns can be fitted from the same sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SUMS = "n long, gram array<double>, rhs array<double>, yy double"
_HELD_GROUPS = 256


def key_types(df: DataFrame, keys: list[str]) -> str:
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    return ", ".join(f"`{k}` {types[k]}" for k in keys)


def _summed(keys: list[str]):
    def emitted(held: dict) -> pd.DataFrame:
        rows = [(*k, n, g.ravel(), r, yy) for k, (n, g, r, yy) in held.items()]
        return pd.DataFrame(rows, columns=[*keys, "n", "gram", "rhs", "yy"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for key, rows in batch.groupby(keys, dropna=False, sort=False):
                x = np.stack(rows["x"].to_numpy())
                y = rows["y"].to_numpy()
                sums = (len(rows), x.T @ x, x.T @ y, float(y @ y))
                if key in held:
                    sums = tuple(a + b for a, b in zip(held[key], sums))
                elif len(held) >= _HELD_GROUPS:
                    yield emitted(held)
                    held = {}
                held[key] = sums
        if held:
            yield emitted(held)

    return run


def _merged(keys: list[str]):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        out = {k: rows[k].iloc[0] for k in keys}
        out |= {"n": int(rows["n"].sum()), "yy": float(rows["yy"].sum())}
        for c in ("gram", "rhs"):
            out[c] = np.sum(np.stack(rows[c].to_numpy()), axis=0)
        return pd.DataFrame([out])[[*keys, "n", "gram", "rhs", "yy"]]

    return merge


def product_sums(rows: DataFrame, keys: list[str], columns: list[Column], target: Column) -> DataFrame:
    """Per group: ``n``, products of the columns with each other (``gram``) and with the target
    (``rhs``), and the target's squares (``yy``). Rows with a NULL in any of them take no part."""
    known = [c.cast("double") for c in columns]
    used = rows.select(*keys, F.array(*known).alias("x"), target.cast("double").alias("y"))
    used = used.where(F.col("y").isNotNull() & ~F.exists("x", F.isnull))
    schema = f"{key_types(rows, keys)}, {_SUMS}"
    return used.mapInPandas(_summed(keys), schema).groupBy(*keys).applyInPandas(_merged(keys), schema)


def stacked(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Products, right sides, squares and row counts of a batch of groups as arrays."""
    rhs = np.stack(batch["rhs"].to_numpy())
    gram = np.stack(batch["gram"].to_numpy()).reshape(len(batch), rhs.shape[1], rhs.shape[1])
    return gram, rhs, batch["yy"].to_numpy(float), batch["n"].to_numpy(float)


def solved(gram: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Coefficients of all groups at once. A column that says nothing new gets none: each is
    held back by a billionth of its own square, an empty one by 1."""
    diagonal = np.einsum("sii->si", gram)
    held = gram + np.eye(rhs.shape[1]) * np.where(diagonal > 0, 1e-9 * diagonal, 1.0)[:, None, :]
    return np.linalg.solve(held, rhs[..., None])[..., 0]


def residual_squares(gram, rhs, yy, beta) -> np.ndarray:
    fitted = np.einsum("si,sij,sj->s", beta, gram, beta)
    return np.maximum(yy - 2 * np.einsum("si,si->s", beta, rhs) + fitted, 0.0)


def _coefficients(keys: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                gram, rhs, _, _ = stacked(batch)
                out = batch[keys].copy()
                out["coefficients"] = list(solved(gram, rhs))
                yield out

    return run


def coefficients(sums: DataFrame, keys: list[str]) -> DataFrame:
    """``coefficients`` of all columns per group."""
    schema = f"{key_types(sums, keys)}, coefficients array<double>"
    return sums.mapInPandas(_coefficients(keys), schema)


def dot(coefficients: Column, columns: list[Column], start: int = 0) -> Column:
    """Sum of columns times their coefficients, the first one at ``start``."""
    terms = [coefficients[start + i] * c for i, c in enumerate(columns)]
    return sum(terms[1:], terms[0]) if terms else F.lit(0.0)
