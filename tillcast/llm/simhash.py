"""Near duplicates by SimHash: fingerprints joined on the bit counts of their segments.

1. A text's fingerprint has a bit for every bit that more than half of its shingles' 64-bit
   hashes have. Rows with one fingerprint are one class; only the fingerprint goes on.
2. The fingerprint is cut into 32 segments of two bits and mapped to its segments' bit counts.
   The Manhattan distance of two such maps is never above the number of differing bits. A count
   is written in unary, so the whole map is one 64-bit number and the Manhattan distance of two
   maps is the number of bits in which these differ.
3. The axes are dealt into ``groups`` groups. Within a Manhattan distance of 3 all but 3 groups
   agree, so each choice of ``groups - 3`` of them is a grid whose cells hold every pair.
4. In each cell all fingerprints are compared with the cell's smallest, which links most near
   copies. Pairs that this does not decide are compared in small cells directly. Large cells
   that still hold several components are sorted by component and map and cut into nodes of
   bounded size; pairs of nodes are dropped by the Manhattan distance of their boxes or when both
   lie in one component, and the rest are compared in tasks of two nodes.
5. A pair is linked only by its differing bits, counted exactly.

A third of all rows in near copies of each other gives a link or so for each fingerprint and
choice, never all pairs. The result is the same for every ``groups`` and every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.frames import keyed_texts, materialise, sliced
from tillcast.llm.links import connected, looked_up

SEED = 42
MOST_BITS = 3
SEGMENTS = 32
#: Cells up to this many fingerprints are compared by a plain join.
SMALL_CELL = 64
NODE_ROWS = 512
#: Axes that a node's box spans: bit counts of bytes.
_BYTES = 8
_LOW = 0x5555555555555555


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that more than half of the hashes have, as a signed number."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.int64)[0])


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words joined by spaces, or of all words if there are fewer."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    size, digest = min(words, len(found)), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts.tolist(), ends[size - 1 :].tolist())
    return np.fromiter(
        (digest(joined[s:e], SEED) for s, e in spans), np.uint64, len(found) - size + 1
    )


def _fingerprinted(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 500):
        prints = []
        for text in pc.cast(batch.column(1), pa.binary()).to_pylist():
            hashes = shingle_hashes(text, words)
            prints.append(fingerprint(hashes) if len(hashes) else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(prints, pa.int64())], ["id", "fingerprint"]
        )


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3
) -> DataFrame:
    """``id, fingerprint`` of every row, the fingerprint as a signed 64-bit number.

    Words are what white space (``[ \\t-\\r]``) separates, A-Z in lower case; shingles count as
    often as they occur. A null text, or one without words, has fingerprint 0. Whole texts are
    read, however long. Null and repeated ids keep their rows; an empty table gives none.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = keyed_texts(docs, id_col, text_col).select("id", "text")
    return texts.mapInArrow(lambda b: _fingerprinted(b, words), f"id {kind}, fingerprint bigint")


def segment_counts(x: Column) -> Column:
    """Bit counts of two-bit segments, each in unary: 00, 01, 11."""
    low = F.lit(_LOW)
    shifted = F.shiftrightunsigned(x, 1)
    some, all_ = x.bitwiseOR(shifted).bitwiseAND(low), x.bitwiseAND(shifted).bitwiseAND(low)
    return some.bitwiseOR(F.shiftleft(all_, 1))


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def choices(groups: int, most: int = MOST_BITS) -> list[int]:
    """Masks of the axes of every ``groups - most`` of ``groups`` groups of axes."""
    masks = [0] * groups
    for axis in range(SEGMENTS):
        masks[axis % groups] |= 0b11 << (2 * axis)
    return [_signed(sum(chosen)) for chosen in combinations(masks, groups - most)]


def _near_pairs(prints: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found_a, found_b = [], []
    for at in range(0, len(prints), 256):
        differing = np.bitwise_count(prints[at : at + 256, None] ^ others[None, :])
        a, b = np.nonzero(differing <= MOST_BITS)
        found_a.append(a + at)
        found_b.append(b)
    return np.concatenate(found_a), np.concatenate(found_b)


def _joining_links(rows: pa.Table) -> pa.Table:
    """Links between rows of different components in two nodes (``side`` 0 and 1; a node with
    itself has side 2), enough to join the components."""
    side = rows.column("side").to_numpy()
    prints = rows.column("fingerprint").to_numpy()
    labels = rows.column("component").to_numpy()
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    a, b = _near_pairs(prints[left].view(np.uint64), prints[right].view(np.uint64))
    a, b = left[a], right[b]
    other = labels[a] != labels[b]
    low = np.minimum(labels[a[other]], labels[b[other]])
    high = np.maximum(labels[a[other]], labels[b[other]])
    pairs = np.unique(np.stack([low, high], axis=1), axis=0)
    return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})


def _numbered_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A node number, unique within the task, for every ``NODE_ROWS`` rows of one cell."""
    node, held, last = 0, 0, None
    for batch in batches:
        keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        numbers = np.empty(batch.num_rows, np.int64)
        for k, key in enumerate(keys):
            if key != last or held == NODE_ROWS:
                node, held, last = node + 1, 0, key
            held += 1
            numbers[k] = node
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(numbers)], [*batch.schema.names, "node"]
        )


def _byte_counts(x: Column) -> list[Column]:
    return [
        F.bit_count(F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255))) for k in range(_BYTES)
    ]


def _search_large_cells(postings: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Links ``a, b`` between components that share a large cell; None where no cell has two.

    ``postings`` are ``choice, cell, fingerprint`` of large cells, ``labels`` the components of
    the fingerprints that have a link.
    """
    known = labels.selectExpr("node AS fingerprint", "component")
    labelled = materialise(
        postings.join(known, "fingerprint", "left").select(
            "choice", "cell", "fingerprint",
            F.coalesce("component", "fingerprint").alias("component"),
        ),
        "labelled-cells",
    )
    cells = labelled.groupBy("choice", "cell").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_cells = materialise(
        cells.where("low <> high").select("choice", "cell"), "open-cells"
    )
    if open_cells.isEmpty():
        return None
    rows = labelled.join(open_cells, ["choice", "cell"], "left_semi")
    order = ["choice", "cell", "component", segment_counts(F.col("fingerprint")), "fingerprint"]
    schema = rows.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    nodes = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_numbered_nodes, f"{schema}, node bigint")
        .withColumn("node", F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("node"))
    )
    nodes = materialise(nodes, "cell-nodes")
    # Boxes of bit counts by byte, and the range of components.
    bounds = [
        f(c).cast("int").alias(f"{side}{k}")
        for k, c in enumerate(_byte_counts(F.col("fingerprint")))
        for side, f in (("lo", F.min), ("hi", F.max))
    ]
    boxes = materialise(
        nodes.groupBy("choice", "cell", "node").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), *bounds
        ),
        "cell-boxes",
    )
    x, y = boxes.alias("x"), boxes.alias("y")
    gap = sum(
        F.greatest(
            F.col(f"x.lo{k}") - F.col(f"y.hi{k}"), F.col(f"y.lo{k}") - F.col(f"x.hi{k}"), F.lit(0)
        )
        for k in range(_BYTES)
    )
    pairs = x.join(
        y,
        (F.col("x.choice") == F.col("y.choice"))
        & (F.col("x.cell") == F.col("y.cell"))
        & (F.col("x.node") <= F.col("y.node"))
        & (F.least("x.low", "y.low") != F.greatest("x.high", "y.high"))
        & (gap <= MOST_BITS),
    ).select(F.col("x.node").alias("first"), F.col("y.node").alias("second"))
    pairs = materialise(pairs, "node-pairs")
    sides = pairs.where("first <> second").select(
        "first", "second",
        F.inline(F.array(
            F.struct(F.col("first").alias("node"), F.lit(0).alias("side")),
            F.struct(F.col("second").alias("node"), F.lit(1).alias("side")),
        )),
    ).unionByName(
        pairs.where("first = second").select(
            "first", "second", F.col("first").alias("node"), F.lit(2).alias("side")
        )
    )
    members = sides.join(nodes.select("node", "fingerprint", "component"), "node")
    return materialise(
        members.groupBy("first", "second").applyInArrow(_joining_links, "a bigint, b bigint"),
        "node-links",
    )


def fingerprint_components(prints: DataFrame, groups: int = 6) -> DataFrame:
    """``node, component`` of the fingerprints that a link joins to another.

    ``prints`` is a written table of distinct values in ``fingerprint``; a link is a difference
    in 3 bits or fewer. More ``groups`` make smaller cells and more rows: 6 give 20 rows for
    each fingerprint and suit up to some hundred millions, 8 give 56.
    """
    masks = F.array(
        *[F.struct(F.lit(k).alias("choice"), F.lit(m).alias("mask")) for k, m in enumerate(choices(groups))]
    )
    counts = segment_counts(F.col("fingerprint"))
    postings = (
        prints.select("fingerprint", counts.alias("counts"), F.inline(masks))
        .select("choice", F.col("counts").bitwiseAND(F.col("mask")).alias("cell"), "fingerprint")
    )
    cells = materialise(
        postings.groupBy("choice", "cell")
        .agg(F.min("fingerprint").alias("head"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.struct("choice", "cell").alias("at"), "head", "n"),
        "cells",
    )
    placed = materialise(postings.select(F.struct("choice", "cell").alias("at"), "fingerprint"), "postings")
    shared = looked_up(placed, cells, "at")
    near = (
        _apart(segment_counts(F.col("fingerprint")), segment_counts(F.col("head"))) <= MOST_BITS
    ) & (_apart(F.col("fingerprint"), F.col("head")) <= MOST_BITS)
    shared = materialise(
        shared.select("at.choice", "at.cell", "fingerprint", "head", "n", near.alias("near")),
        "shared-cells",
    )
    links = shared.where("near AND fingerprint <> head").selectExpr("head AS a", "fingerprint AS b")
    # Small cells: pairs that the head does not join already.
    small = shared.where(F.col("n") <= SMALL_CELL).where("n > 2")
    x, y = small.alias("x"), small.alias("y")
    direct = x.join(
        y,
        (F.col("x.choice") == F.col("y.choice"))
        & (F.col("x.cell") == F.col("y.cell"))
        & (F.col("x.fingerprint") < F.col("y.fingerprint"))
        & ~(F.col("x.near") & F.col("y.near"))
        & (
            _apart(
                segment_counts(F.col("x.fingerprint")), segment_counts(F.col("y.fingerprint"))
            )
            <= MOST_BITS
        )
        & (_apart(F.col("x.fingerprint"), F.col("y.fingerprint")) <= MOST_BITS),
    ).select(F.col("x.fingerprint").alias("a"), F.col("y.fingerprint").alias("b"))
    links = materialise(links.unionByName(direct).distinct(), "near-links")
    labels = materialise(connected(links, "near"), "near-labels")
    large = shared.where(F.col("n") > SMALL_CELL).select("choice", "cell", "fingerprint")
    if large.isEmpty():
        return labels
    more = _search_large_cells(large, labels)
    if more is None:
        return labels
    # The new links are between components, a fingerprint without a link being its own.
    joined = materialise(connected(more, "joined"), "joined-labels")
    renamed = labels.selectExpr("node", "component AS old").join(
        joined.selectExpr("node AS old", "component AS new"), "old", "left"
    )
    found = renamed.select("node", F.coalesce("new", "old").alias("component"))
    alone = joined.join(labels.select("node"), "node", "left_anti")
    return materialise(found.unionByName(alone), "all-labels")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    groups: int = 6,
) -> DataFrame:
    """One row for each input row: ``id, fingerprint, component_id``.

    ``fingerprint`` is in 16 hexadecimal digits, ``component_id`` the smallest id that links
    reach, the row's own included. Texts without words have fingerprint 0 and link like others;
    so do rows given twice. Null ids count as larger than all others. See ``fingerprints``.
    """
    printed = materialise(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = materialise(
        printed.groupBy("fingerprint").agg(F.min("id").alias("least")), "distinct-fingerprints"
    )
    labels = fingerprint_components(distinct.select("fingerprint"), groups)
    named = distinct.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    named = materialise(
        named.select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")),
        "fingerprint-components",
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialise(looked_up(named, materialise(smallest, "components"), "component"), "named")
    found = looked_up(printed, named.select("fingerprint", "component_id"), "fingerprint")
    return found.select("id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
