"""Approximate largest inner products by shifted space-filling curves.

Vectors are lifted to the unit sphere, where the largest inner product is the smallest distance,
and projected to a few dimensions by random rotations. For each of several curves the projected,
shifted points are put on a grid and in the order of a Hilbert curve, by a range partitioning on
(curve, key). The orders are cut into cells of a fixed number of rows; a query is compared with
the vectors in its cell and in the cells next to it, as many as a share of all rows needs. What
the curves find is merged and ranked by the inner products of the original vectors.

Vectors are lifted in bands of like length, each with its own curves, and queries are asked in
every band: under the length of one long vector all others would be lifted to one point, far from
their queries. A band of few rows is compared with every query.

A share is needed because vectors without structure have no smaller neighbourhood that holds
their nearest ones. Cells and the queries sent to them are bounded whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.frames import materialise

#: Rows in a cell, and the number of cells whose queries meet a cell in one task.
CELL, SENT = 1024, 16
#: A band of at most so many cells' rows is compared with every query.
FEW = 4
_SAMPLE = 4096


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits``-bit coordinates (rows)."""
    x = grid.astype(np.uint32).T.copy()
    d, one = len(x), np.uint32(1)
    # Undo the rotations and reflections of each level, from the coarsest.
    for level in range(bits - 1, 0, -1):
        q = np.uint32(1 << level)
        low = q - one
        for i in range(d):
            inverted = (x[i] & q) != 0
            swap = np.where(inverted, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(inverted, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[d - 1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> np.uint32(level)) & one).astype(np.int64)
    return key


@dataclass
class Curves:
    """Rotations, ranges and shifts of the curves; plain arrays."""

    longest: float
    middle: float
    rotations: list[np.ndarray]
    low: list[np.ndarray]
    width: list[np.ndarray]
    shift: list[np.ndarray]
    bits: int

    @classmethod
    def fit(cls, sample: np.ndarray, longest: float, n: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        lifted = lift(sample, longest)
        full = lifted.shape[1]
        middle = float(np.median(np.linalg.norm(sample / longest, axis=1)))
        out = cls(longest, min(1.0, middle), [], [], [], [], bits)
        for _ in range(n):
            rotation = np.linalg.qr(rng.normal(size=(full, full)))[0][:, :dims]
            points = lifted @ rotation
            low, high = np.quantile(points, [0.005, 0.995], axis=0)
            out.rotations.append(rotation)
            out.low.append(low)
            out.width.append(np.maximum(high - low, 1e-9))
            out.shift.append(rng.random(rotation.shape[1]))
        return out

    def keys(self, lifted: np.ndarray, curve: int) -> np.ndarray:
        points = (lifted @ self.rotations[curve] - self.low[curve]) / self.width[curve]
        points = np.clip((points + self.shift[curve]) / 2, 0, 1 - 1e-9)
        return hilbert_keys((points * (1 << self.bits)).astype(np.uint32), self.bits)


def lift(vectors: np.ndarray, longest: float | None, middle: float = 1.0) -> np.ndarray:
    """Unit vectors with one more dimension, which takes up what a vector lacks in length.

    Queries (``longest`` is none) are scaled to the length ``middle``, as parts of the longest,
    of the vectors they are to meet, and lifted like these.
    """
    if longest is None:
        vectors = vectors / np.abs(vectors).max(1, keepdims=True)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.hstack([unit * middle, np.full((len(unit), 1), np.sqrt(1 - middle**2))])
    scaled = vectors / longest
    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(1, keepdims=True)))
    return np.hstack([scaled, rest])


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _keyed(batches: Iterator[pa.RecordBatch], shared, every: int) -> Iterator[pa.RecordBatch]:
    fitted = [(band, Curves(*values)) for band, values in shared.value]
    for batch in batches:
        if not batch.num_rows:
            continue
        row, ids = batch.column("row").to_numpy(), batch.column("id").to_numpy()
        bands = batch.column("band").to_numpy()
        vectors, asks = _matrix(batch.column("vector")), ids % every == 0
        for k, (band, curves) in enumerate(fitted):
            own = bands == band
            asked = lift(vectors[asks], None, curves.middle)
            points = np.vstack([lift(vectors[own], curves.longest), asked])
            rows = np.concatenate([row[own], row[asks]])
            is_query = np.concatenate([np.zeros(own.sum(), bool), np.ones(asks.sum(), bool)])
            n = len(curves.rotations)
            for curve in range(n):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(rows), k * n + curve, np.int32)),
                        pa.array(curves.keys(points, curve)),
                        pa.array(is_query),
                        pa.array(rows),
                    ],
                    ["curve", "key", "is_query", "row"],
                )


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(at, at + n)),
            ],
            [*batch.schema.names, "part", "at"],
        )
        at += n


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of rows of ``a`` and ``b``, summed in the order of the dimensions, so that equal vectors
    have equal products wherever they are met."""
    total = np.zeros(len(a))
    for i in range(a.shape[1]):
        total += a[:, i] * b[:, i]
    return total


def _best(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int
) -> tuple[list, list, list]:
    """The ``k`` best vectors of each query, not its own, with the exact product."""
    out: tuple[list, list, list] = ([], [], [])
    if not len(ids) or not len(query_ids):
        return out
    rough = queries @ vectors.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    keep = min(k, len(ids))
    edge = np.partition(rough, len(ids) - keep, axis=1)[:, len(ids) - keep]
    # Products of the same vectors differ by rounding between the two ways of summing.
    slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(edge), edge, 0)))
    q, c = np.nonzero((rough >= (edge - slack)[:, None]) & np.isfinite(rough))
    exact = inner_products(queries[q], vectors[c])
    order = np.lexsort((ids[c], -exact, q))
    q, c, exact = q[order], c[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    some = place < k
    return query_ids[q[some]], ids[c[some]], exact[some]


def _along_curves(
    base: DataFrame,
    large: list,
    asking: int,
    every: int,
    curves: int,
    share: float,
    dims: int,
    bits: int,
    seed: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows of large bands by cell, and the queries of every row that asks by the cells they meet."""
    spark = base.sparkSession
    want = max(256, min(_SAMPLE, 16 * _SAMPLE // len(large)))
    steps = [(b["band"], min(1 << 30, (want << 30) // b["n"] + 1)) for b in large]
    taken = spark.createDataFrame(steps, "band int, below bigint")
    sample = base.join(F.broadcast(taken), "band").where(f"pmod(xxhash64(id), {1 << 30}) < below")
    sample = sample.select("band", "vector").toArrow()
    at, points = sample.column("band").to_numpy(), _matrix(sample.column("vector"))
    fitted = []
    for b in large:
        own = Curves.fit(points[at == b["band"]], b["longest"], curves, dims, bits, seed)
        fitted.append((b["band"], tuple(vars(own).values())))
    shared = spark.sparkContext.broadcast(fitted)
    keyed = base.mapInArrow(
        lambda b: _keyed(b, shared, every), "curve int, key bigint, is_query boolean, row bigint"
    )
    order = ["curve", "key", "is_query", "row"]
    numbered = materialise(
        keyed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(
            _numbered,
            "curve int, key bigint, is_query boolean, row bigint, part int, at bigint",
        ),
        "curve-orders",
    )
    parts = numbered.groupBy("curve", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("least")
    )
    before = F.sum("rows").over(Window.partitionBy("curve").orderBy("part")) - F.col("rows")
    starts = parts.select("curve", "part", (before - F.col("least")).alias("start"))
    placed = materialise(
        numbered.join(F.broadcast(starts), ["curve", "part"]).select(
            "row", "is_query", "curve", F.expr(f"cast((start + at) div {CELL} AS int)").alias("cell")
        ),
        "curve-cells",
    ).join(base, "row")
    # Queries have places in the order too.
    reach = [-(-int((b["n"] + asking) * share + 1) // CELL) for b in large]
    reach = [(k, n, 2 * n // SENT + 1) for k, n in enumerate(x for x in reach for _ in range(curves))]
    reach = spark.createDataFrame(reach, "curve int, around int, shards int")
    placed = placed.join(F.broadcast(reach), "curve")
    candidates = placed.where("NOT is_query").select(
        "curve", "cell", F.expr("explode(sequence(0, shards - 1)) AS shard"), "id", "vector"
    )
    queries = (
        placed.where("is_query")
        .select("curve", "cell", "around", F.expr("explode(sequence(0, 2 * around)) AS step"), "id", "vector")
        .select(
            F.col("curve").alias("to_curve"),
            F.expr("cell + step - around").alias("to_cell"),
            F.expr(f"cast(step div {SENT} AS int)").alias("to_shard"),
            F.col("id").alias("query"),
            F.col("vector").alias("asked"),
        )
        .where("to_cell >= 0")
    )
    return candidates, queries


def nearest(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = 20,
    k: int = 20,
    curves: int = 16,
    share: float = 0.03,
    dims: int = 8,
    bits: int = 7,
    seed: int = 7,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` the
    ``k`` rows with the largest inner product found, its own left out.

    Rows without an id or a vector, with a null or non-finite component, of zero length or of
    another number of dimensions than most take no part. Rows with the same id count once. Ties
    go to the smaller id. Without a row the result is empty. A band has lengths within a factor
    of two, counted from the median. The ranges of its grid are fitted on a sample of about 4,096
    rows; all its rows are on each of its curves. ``share`` is the part of a band's rows on each
    side of a query that each curve looks at.
    """
    spark = vectors.sparkSession
    usable = (
        "id IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0 "
        "AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) <> double('inf')) "
        "AND exists(vector, x -> x <> 0)"
    )
    base = (
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        .where(usable)
        .dropDuplicates(["id"])
        .withColumn("row", F.monotonically_increasing_id())
    )
    base = materialise(base, "vectors")
    sizes = base.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    kind = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], kind)
    base = base.where(F.size("vector") == sizes["n"])
    # Over the largest component, so that no square is too large or too small.
    most = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("most")) ** 2)
    base = base.withColumn("most", most).withColumn("spread", F.sqrt(squares))
    base = base.withColumn("norm", F.col("most") * F.col("spread"))
    log = F.log2("most") + F.log2("spread")
    middle = base.agg(F.percentile_approx(log, 0.5)).first()[0]
    band = F.round(log - middle).cast("int")
    base = base.select("id", "vector", "row", "norm", band.alias("band"))
    # Lengths differ by a factor of 2 ** 2100 at most.
    bands = base.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("norm").alias("longest"),
        F.count_if(F.col("id") % every == 0).alias("asking"),
    )
    bands = sorted(bands.collect())
    asking = sum(b["asking"] for b in bands)
    large = [b for b in bands if b["n"] > FEW * CELL]
    n_few = sum(b["n"] for b in bands) - sum(b["n"] for b in large)
    base = base.drop("norm")
    few = base.where(~F.col("band").isin([b["band"] for b in large])).drop("band")

    # Rows of small bands meet every query, both in chunks.
    cells, chunks = -(-n_few // CELL), max(1, -(-asking // (4 * CELL)))
    candidates = few.select(
        F.lit(-1).alias("curve"),
        F.expr(f"cast(pmod(xxhash64(id), {max(1, cells)}) AS int)").alias("cell"),
        F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("shard"),
        "id",
        "vector",
    )
    to_few = base.where(F.col("id") % every == 0).where(F.lit(cells > 0))
    queries = to_few.select(
        F.lit(-1).alias("to_curve"),
        F.explode(F.sequence(F.lit(0), F.lit(max(0, cells - 1)))).alias("to_cell"),
        F.expr(f"cast(pmod(xxhash64(id), {chunks}) AS int)").alias("to_shard"),
        F.col("id").alias("query"),
        F.col("vector").alias("asked"),
    )
    if large:
        met, sent = _along_curves(base, large, asking, every, curves, share, dims, bits, seed)
        candidates, queries = candidates.unionByName(met), queries.unionByName(sent)

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            found = ([], [], [])
        else:
            found = _best(
                left.column("id").to_numpy(),
                _matrix(left.column("vector")),
                right.column("query").to_numpy(),
                _matrix(right.column("asked")),
                k,
            )
        types = (pa.int64(), pa.int64(), pa.float64())
        names = ("query_id", "vec_id", "score")
        return pa.table({n: pa.array(x, t) for n, x, t in zip(names, found, types)})

    found = (
        candidates.groupBy("curve", "cell", "shard")
        .cogroup(queries.groupBy("to_curve", "to_cell", "to_shard"))
        .applyInArrow(best, "query_id bigint, vec_id bigint, score double")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    )
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the pairs of ``exact`` that ``found`` has."""
    keys = ["query_id", "vec_id"]
    hits = exact.select(*keys).join(found.select(*keys), keys, "left_semi").count()
    return hits / max(1, exact.count())
