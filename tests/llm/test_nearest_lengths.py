"""Nearest vectors where lengths differ."""

import numpy as np
import pandas as pd
import pytest

from tillcast.llm import nearest
from tillcast.sources.shared import materialise


@pytest.mark.parametrize("case", ["one long", "spread", "tiny and huge"])
def test_recall_with_other_lengths(spark, case):
    n, every = (2_000 if case == "tiny and huge" else 51_282), 200
    rng = np.random.default_rng(1)
    w = rng.normal(size=(n, 64))
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    if case == "one long":
        w[5] *= 3
    elif case == "spread":
        w *= np.exp(rng.normal(size=(n, 1)) / 2)
    else:
        w[5] *= 1e-200
        w[6] *= 1e200
    frame = pd.DataFrame({"vec_id": np.arange(n), "embedding": list(w)})
    table = materialise(spark.createDataFrame(frame, "vec_id bigint, embedding array<double>"), "lengths")
    got = {}
    for r in nearest.nearest(table, every=every).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    asking = np.arange(0, n, every)
    products = w[asking] @ w.T
    products[np.arange(len(asking)), asking] = -np.inf
    best = np.argpartition(-products, 20, axis=1)[:, :20]
    hits = [len(got[q] & set(b)) for q, b in zip(asking.tolist(), best.tolist())]
    assert all(len(g) == 20 for g in got.values())
    assert np.mean(hits) / 20 > 0.95
