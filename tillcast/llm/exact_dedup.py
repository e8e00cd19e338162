"""Exact duplicates by deterministic block naming.

Each text, without its white space, is cut into blocks of a fixed number of bytes. All blocks are
sorted (by a digest and then by content) and every distinct one gets an integer name. Adjacent names of a text are paired and the
pairs named in the same way until each text has a single name. Equal names at the same level mean
equal texts and no others: names stand for content, not for a hash of it.

Sorting is a range partitioning on (block, row): a block that a third of all texts share is
spread over several partitions, and the ranks of neighbouring partitions are joined at their
edges. Only the first sort moves text, once; every later one moves integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.frames import keyed_texts, materialise

WHITE = b" \t\n\x0b\x0c\r"


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row = batch.column(0)
        points = pc.utf8_length(batch.column(2))
        for start in range(0, batch.num_rows, 1000):
            texts = batch.column(2).slice(start, 1000).cast(pa.binary()).to_pylist()
            at, pos, count, digest, mark, block = [], [], [], [], [], []
            for i, raw in enumerate(texts, start):
                bare = raw.translate(None, WHITE)
                parts = [bare[k : k + size] for k in range(0, len(bare), size)] or [b""]
                at += [i] * len(parts)
                pos += range(len(parts))
                count += [len(parts)] * len(parts)
                digest += [hashlib.sha256(bare).hexdigest()] + [None] * (len(parts) - 1)
                mark += [hashlib.md5(p).digest() for p in parts]
                block += parts
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    row.take(take),
                    batch.column(1).take(take),
                    pa.array(pos, pa.int32()),
                    pa.array(count, pa.int32()),
                    points.take(take).cast(pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(mark, pa.binary()),
                    pa.array(block, pa.binary()),
                ],
                ["row", "id", "pos", "n_blocks", "points", "digest", "mark", "block"],
            )


def _ranks(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rank of each row's key among the distinct keys of its sorted partition, from 0.

    Keys stay only in the partition's first and last row.
    """
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    last, rank, held = None, -1, None

    def out(batch: pa.RecordBatch, ranks: np.ndarray, first: bool, end: bool) -> pa.RecordBatch:
        edge = np.zeros(batch.num_rows, bool)
        edge[0], edge[-1] = first, end or (first and batch.num_rows == 1)
        edge = pa.array(edge)
        columns = {c: batch.column(c) for c in batch.schema.names if c not in keys}
        columns |= {c: pc.if_else(edge, batch.column(c), None) for c in keys}
        columns |= {
            "edge": edge,
            "part": pa.array(np.full(batch.num_rows, part, np.int32)),
            "rank": pa.array(ranks),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, np.int64)
        for c in keys:
            key = batch.column(c)
            new[1:] |= pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(False)
        head = tuple(batch.column(c)[0].as_py() for c in keys)
        new[0] = head != last
        ranks = rank + np.cumsum(new)
        rank, last = int(ranks[-1]), tuple(batch.column(c)[-1].as_py() for c in keys)
        if held is not None:
            yield out(*held, first, False)
            first = False
        held = (batch, ranks)
    if held is not None:
        yield out(*held, first, True)


def named(
    df: DataFrame, keys: list[str], tie: list[str], step: str, mark: str | None = None
) -> DataFrame:
    """``df`` without ``keys``, with ``name``: the rank of its keys among all distinct keys.

    ``mark`` is a short column that equal keys share and by which long keys are sorted first:
    the bounds of the partitions are then marks and not keys, which the driver has to hold.
    """
    first = [mark] if mark else keys
    schema = df.drop(mark).schema if mark else df.schema
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in keys]
    columns += [f"`{c}` {schema[c].dataType.simpleString()}" for c in keys]
    columns += ["edge boolean", "part int", "rank bigint"]
    ranked = materialise(
        df.repartitionByRange(*first, *tie)
        .sortWithinPartitions(*dict.fromkeys([*first, *keys, *tie]))
        .drop(*([mark] if mark else []))
        .mapInArrow(lambda b: _ranks(b, keys), ", ".join(columns)),
        step,
    )
    key = F.struct(*keys)
    # One row for each partition of the sort.
    edges = (
        ranked.where("edge")
        .groupBy("part")
        .agg(
            F.min_by(key, "rank").alias("low"),
            F.max_by(key, "rank").alias("high"),
            (F.max("rank") + 1).alias("distinct"),
        )
    )
    order = Window.orderBy("part")
    joined = F.coalesce((F.lag("high").over(order) == F.col("low")).cast("long"), F.lit(0))
    starts = (
        edges.withColumn("joined", joined)
        .withColumn("start", F.sum(F.col("distinct") - F.col("joined")).over(order))
        .select("part", (F.col("start") - F.col("distinct")).alias("start"))
    )
    return (
        ranked.join(F.broadcast(starts), "part")
        .withColumn("name", F.col("start") + F.col("rank"))
        .drop(*keys, "edge", "part", "rank", "start")
    )


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = 4096,
    row_col: str | None = None,
) -> DataFrame:
    """One row for each input row: its class of equal texts and whether it stays.

    Texts are compared without the characters of ``[ \\t-\\r]``. Of a class the row with the most
    code points stays, then the one with the smallest id, then (the same row given twice) the
    first. A null text is an empty one, null ids come last, an empty table gives no rows.
    ``row_col`` names a key of the rows if there is one; else they are numbered.

    Columns: ``row`` (key of the input row), ``id``, ``points``, ``digest`` (SHA-256 of the text
    compared), ``level`` and ``name`` (the identity), ``keep_id``, ``keep_row``, ``group_size``,
    ``kept``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"row bigint, id {kind}, pos int, n_blocks int, points bigint, digest string, "
        "mark binary, block binary"
    )
    blocks = keyed_texts(docs, id_col, text_col, row_col).mapInArrow(
        lambda b: _blocks(b, block_bytes), schema
    )
    base = materialise(named(blocks, ["block"], ["row", "pos"], "blocks", "mark"), "named-blocks")
    heads = base.where("pos = 0").select("row", "id", "n_blocks", "points", "digest", "name")
    most = base.agg(F.max("n_blocks")).first()[0] or 1
    identities = None
    current, level = base.where("n_blocks > 1").select("row", "pos", "n_blocks", "name"), 0
    while (1 << level) < most:
        level += 1
        even, side = F.col("pos") % 2 == 0, F.col("name")
        pairs = current.groupBy("row", F.expr("pos div 2").cast("int").alias("pos")).agg(
            F.max("n_blocks").alias("n_blocks"),
            F.max(F.when(even, side)).alias("left"),
            F.coalesce(F.max(F.when(~even, side)), F.lit(-1)).alias("right"),
        )
        current = materialise(
            named(pairs, ["left", "right"], ["row", "pos"], "pairs"), f"named-pairs-{level}"
        )
        done = (F.col("n_blocks") <= (1 << level)) & (F.col("n_blocks") > (1 << (level - 1)))
        ended = current.where(done).select("row", F.lit(level).alias("level"), "name")
        identities = ended if identities is None else identities.unionByName(ended)
        current = current.where(F.col("n_blocks") > (1 << level))
    single = heads.where("n_blocks = 1").select("*", F.lit(0).alias("level")).drop("n_blocks")
    classes = single
    if identities is not None:
        several = heads.where("n_blocks > 1").drop("name", "n_blocks").join(identities, "row")
        classes = single.unionByName(several)
    classes = materialise(classes, "classes")
    best = F.min(F.struct(-F.col("points"), F.col("id").isNull(), F.col("id"), F.col("row")))
    groups = classes.groupBy("level", "name").agg(
        best.alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    groups = groups.select(
        "level",
        "name",
        "group_size",
        F.col("best.id").alias("keep_id"),
        F.col("best.row").alias("keep_row"),
    )
    return classes.join(groups, ["level", "name"]).withColumn(
        "kept", F.col("row") == F.col("keep_row")
    )
