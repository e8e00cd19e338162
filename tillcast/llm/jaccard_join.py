"""Exact join of documents on the Jaccard similarity of their word n-grams.

1. Rows with equal shingle sets are one class; only one row of each goes on.
2. Similar sets share a shingle among the first few of each, in any order common to all. The
   order puts the shingles that many documents have last, then goes by hash, so that passages
   that repeat across documents don't make large groups. Which shingles are frequent is an
   estimate; the result doesn't depend on it.
3. In the group of each shared shingle every row is compared with the group's first row. The
   links found (by bitmaps, then by the sets themselves) join most near copies.
4. What is left, groups with rows of several components, is searched by signature trees. A group
   is divided into nodes by bands of set size and shards of bounded size; nodes hold their rows'
   bitmaps combined by OR and their range of sizes. Pairs of nodes, then of subtrees, then of
   rows are dropped where the largest possible overlap is too small or both are one component.
   Rows that survive are compared by their sets in groups of two nodes.

A group of near copies that a third of all rows belong to gives a link for each row, not for each
pair, and no task holds more than two nodes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.frames import discard, fresh, keyed_texts, materialise, numbered, picked, sliced
from tillcast.llm.shingles import Shingler, bitmap, bitmap_width, folded, identity

#: Shingles at most that are known as frequent (2 MB, broadcast).
FREQUENT = 250_000
NODE_ROWS = 512
_FAN = 8


def least_overlap(sizes, percent: int):
    """Least intersection of two linked sets whose sizes have the given sum."""
    return -(-percent * sizes // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    """Linked sets share one of so many first shingles of either."""
    return size - -(-percent * size // 100) + 1


def band_of(size: int, percent: int) -> int:
    """Linked sets are in the same or neighbouring bands."""
    return int(math.log(size) / -math.log(percent / 100) + 1e-9)


def _counted(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    shingler = Shingler(size)
    for batch in sliced(batches, 2000):
        sets = shingler.sets(batch.column(2).to_pylist())
        tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
        tokens, counts = tokens[counts > 1], counts[counts > 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens.view(np.int64)), pa.array(counts)], ["token", "n"]
        )


def frequent_shingles(texts: DataFrame, size: int, least: int = 200) -> np.ndarray:
    """Shingles that more than ``least`` documents seem to have: sums of what repeats within
    slices of the input. The most frequent ``FREQUENT`` of them, by steps of a doubling."""
    counts = materialise(
        texts.mapInArrow(lambda b: _counted(b, size), "token bigint, n bigint")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least),
        "frequent-shingles",
    ).withColumn("step", F.floor(F.log2("n")).cast("int"))
    upto = F.sum("shingles").over(Window.orderBy(F.desc("step")))
    lowest = (
        counts.groupBy("step")
        .agg(F.count(F.lit(1)).alias("shingles"))
        .withColumn("upto", upto)
        .where(F.col("upto") <= FREQUENT)
        .agg(F.min("step"))
        .first()[0]
    )
    if lowest is None:
        return np.zeros(0, np.uint64)
    found = counts.where(F.col("step") >= lowest).select("token").toArrow().column(0)
    return np.sort(found.to_numpy().view(np.uint64))


class _Frequent:
    """Membership of many tokens in a sorted array: a table of low bits rules most of them out."""

    def __init__(self, tokens: np.ndarray):
        self._tokens, self._mask = tokens, np.uint64((1 << 23) - 1)
        self._table = np.zeros(1 << 23, bool)
        self._table[tokens & self._mask] = True

    def __call__(self, tokens: np.ndarray) -> np.ndarray:
        found = self._table[tokens & self._mask]
        some = np.flatnonzero(found)
        if len(some):
            at = np.searchsorted(self._tokens, tokens[some])
            at[at == len(self._tokens)] = 0
            found[some] = self._tokens[at] == tokens[some]
        return found


def _sets(
    batches: Iterator[pa.RecordBatch], size: int, percent: int, shared
) -> Iterator[pa.RecordBatch]:
    is_frequent, shingler = _Frequent(shared.value), Shingler(size)
    for batch in sliced(batches, 500):
        names, rare, frequent, bits, n = [], [], [], [], []
        for tokens in shingler.sets(batch.column(2).to_pylist()):
            n.append(len(tokens))
            if not len(tokens):
                names.append(None)
                rare.append([])
                frequent.append([])
                bits.append(None)
                continue
            k = prefix_length(len(tokens), percent)
            often = is_frequent(tokens)
            first = tokens[~often][:k]
            names.append(identity(tokens))
            rare.append(first.view(np.int64))
            frequent.append(tokens[often][: k - len(first)].view(np.int64))
            bits.append(bitmap(tokens).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(n, pa.int64()),
                pa.array(names, pa.binary()),
                pa.array(rare, pa.list_(pa.int64())),
                pa.array(frequent, pa.list_(pa.int64())),
                pa.array(bits, pa.binary()),
            ],
            ["row", "id", "n", "name", "rare", "frequent", "bits"],
        )


def _whole_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    shingler = Shingler(size)
    for batch in sliced(batches, 500):
        sets = [s.tobytes() for s in shingler.sets(batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sets, pa.binary())], ["row", "tokens"]
        )


def _array(column: pa.Array, dtype=np.uint64) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype) for x in column]


def _near_by_bits(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 2000):
        na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
        least, keep = least_overlap(na + nb, percent), np.zeros(len(na), bool)
        for i, (x, y) in enumerate(zip(_array(batch.column("bits_a")), _array(batch.column("bits_b")))):
            words = min(len(x), len(y))
            x, y = folded(x[None], words), folded(y[None], words)
            apart = int(np.bitwise_count(x ^ y).sum())
            keep[i] = na[i] + nb[i] - apart >= 2 * least[i]
        kept = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repetition."""
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    at[at == len(y)] = 0
    return int((y[at] == x).sum())


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = overlap(x, y)
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, 1000):
        sets = zip(_array(batch.column("tokens_a")), _array(batch.column("tokens_b")))
        keep = pa.array([linked(x, y, percent) for x, y in sets], pa.bool_())
        kept = batch.filter(keep)
        yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])


class Tree:
    """Signature tree over rows sorted by size: level 0 are the rows, ``_FAN`` to a node above."""

    def __init__(self, n: np.ndarray, component: np.ndarray, before: np.ndarray, bits: np.ndarray):
        order = np.lexsort((component, before, n))
        self.order = order
        n, component, before, bits = n[order], component[order], before[order], bits[order]
        slack = n - np.bitwise_count(bits).sum(1).astype(np.int64)
        self.levels = [(n, n, component, component, before, before, slack, bits)]
        while len(self.levels[-1][0]) > 1:
            low, high, least, most, first, last, slack, bits = self.levels[-1]
            at = np.arange(0, len(low), _FAN)
            self.levels.append(
                (
                    np.minimum.reduceat(low, at),
                    np.maximum.reduceat(high, at),
                    np.minimum.reduceat(least, at),
                    np.maximum.reduceat(most, at),
                    np.minimum.reduceat(first, at),
                    np.maximum.reduceat(last, at),
                    np.maximum.reduceat(slack, at),
                    np.bitwise_or.reduceat(bits, at, axis=0),
                )
            )

    def _possible(self, other: Tree, level: tuple[int, int], a, b, percent: int) -> np.ndarray:
        low, high, least, most, first, last, slack, bits = (x[a] for x in self.levels[level[0]])
        low2, high2, least2, most2, first2, last2, slack2, bits2 = (
            x[b] for x in other.levels[level[1]]
        )
        fits = (100 * high >= percent * low2) & (100 * high2 >= percent * low)
        # All of one component, or all met in the group before this one.
        fits &= ~((least == most) & (least2 == most2) & (least == least2))
        fits &= ~((first == last) & (first2 == last2) & (first == first2))
        need = least_overlap(low + low2, percent)
        common = np.bitwise_count(bits & bits2).sum(1).astype(np.int64)
        # A shared shingle has a shared bit, or shares its bit with another of the same set.
        fits &= common + np.minimum(slack, slack2) >= need
        if level == (0, 0):
            apart = np.bitwise_count(bits ^ bits2).sum(1).astype(np.int64)
            fits &= low + low2 - apart >= 2 * need
        return fits

    def pairs(self, other: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows (positions given at the start) that may be linked, by dual traversal.
        With itself, each pair once."""
        same = other is self
        stack = [((len(self.levels) - 1, len(other.levels) - 1), np.array([0]), np.array([0]))]
        while stack:
            level, a, b = stack.pop()
            if len(a) > 20_000:
                half = len(a) // 2
                stack += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            keep = self._possible(other, level, a, b, percent)
            if same:
                keep &= a <= b if level != (0, 0) else a < b
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            if level == (0, 0):
                yield self.order[a], other.order[b]
                continue
            below = tuple(max(0, x - 1) for x in level)
            fan_a, fan_b = (_FAN if x else 1 for x in level)
            a = (a[:, None] * fan_a + np.arange(fan_a)).repeat(fan_b, axis=1).ravel()
            b = np.tile(b[:, None] * fan_b + np.arange(fan_b), (1, fan_a)).ravel()
            inside = (a < len(self.levels[below[0]][0])) & (b < len(other.levels[below[1]][0]))
            stack.append((below, a[inside], b[inside]))


def _bit_rows(column: list[np.ndarray]) -> np.ndarray:
    words = min(map(len, column))
    return np.concatenate([folded(x[None], words) for x in column])


def _node(key: tuple, rows: pa.RecordBatch) -> tuple:
    bits = _bit_rows(_array(rows.column("bits")))
    n = rows.column("n").to_numpy()
    return (
        *key,
        int(n.min()),
        int(n.max()),
        rows.column("row").to_numpy().tobytes(),
        n.astype(np.int64).tobytes(),
        rows.column("component").to_numpy().tobytes(),
        rows.column("before").to_numpy().tobytes(),
        bits.tobytes(),
    )


def _nodes(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """A node for each run of rows with equal ``token, band, shard``; the input is sorted.

    A node that is its group's only one is searched at once, and only its active rows are given.
    """
    held: list[pa.RecordBatch] = []
    held_key, nodes, active = None, [], []

    def ended() -> None:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        if rows.column("nodes")[0].as_py() > 1:
            nodes.append(_node(held_key, rows))
        elif rows.num_rows > 1:
            row, n, component, before = (
                rows.column(c).to_numpy().astype(np.int64) for c in ("row", "n", "component", "before")
            )
            tree = Tree(n, component, before, _bit_rows(_array(rows.column("bits"))))
            found = _active_rows(tree, tree, row, row, component, component, percent)
            active.extend((held_key[0], *x) for x in found.items())

    def emitted() -> pa.RecordBatch:
        blank = pa.nulls
        columns = [pa.array([x[k] for x in nodes], f.type) for k, f in enumerate(_NODE_SCHEMA)]
        parts = [pa.array([x[k] for x in active], pa.int64()) for k in range(3)]
        columns = [pa.concat_arrays([c, blank(len(active), c.type)]) for c in columns]
        columns += [pa.concat_arrays([blank(len(nodes), pa.int64()), c]) for c in parts]
        nodes.clear()
        active.clear()
        return pa.RecordBatch.from_arrays(columns, [*_NODE_SCHEMA.names, "pair", "row", "component"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("token", "band", "shard")])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        starts = [0, *cuts.tolist()]
        for start, end in zip(starts, [*starts[1:], batch.num_rows]):
            key = tuple(keys[:, start].tolist())
            if held and key != held_key:
                ended()
                held.clear()
            held_key = key
            held.append(batch.slice(start, end - start))
            if len(nodes) >= 200 or len(active) >= 20_000:
                yield emitted()
    if held:
        ended()
    yield emitted()


def _active_rows(tree, other, left, right, component, component2, percent: int) -> dict[int, int]:
    """Rows of pairs that may be linked and are of two components, with their components."""
    found: dict[int, int] = {}
    for a, b in tree.pairs(other, percent):
        apart = component[a] != component2[b]
        found.update(zip(left[a[apart]].tolist(), component[a[apart]].tolist()))
        found.update(zip(right[b[apart]].tolist(), component2[b[apart]].tolist()))
    return found


_NODE = (
    "token bigint, band int, shard int, low bigint, high bigint, "
    "rows binary, sizes binary, components binary, befores binary, bits binary"
)
_NODE_SCHEMA = pa.schema(
    [("token", pa.int64()), ("band", pa.int32()), ("shard", pa.int32())]
    + [(c, pa.int64()) for c in ("low", "high")]
    + [(c, pa.binary()) for c in ("rows", "sizes", "components", "befores", "bits")]
)


def _node_rows(batch: pa.RecordBatch, i: int, side: str):
    rows, n, component, before = (
        np.frombuffer(batch.column(f"{side}_{c}")[i].as_buffer(), np.int64)
        for c in ("rows", "sizes", "components", "befores")
    )
    bits = np.frombuffer(batch.column(f"{side}_bits")[i].as_buffer(), np.uint64)
    return rows, n, component, before, bits.reshape(len(rows), -1)


def _active(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows of each pair of nodes that may have a link in it."""
    for batch in batches:
        pair, rows, components = [], [], []
        for i in range(batch.num_rows):
            left, n, component, before, bits = _node_rows(batch, i, "a")
            if batch.column("b_rows")[i].as_py() is None:
                tree = other = Tree(n, component, before, bits)
                right, component2 = left, component
            else:
                right, n2, component2, before2, bits2 = _node_rows(batch, i, "b")
                words = min(bits.shape[1], bits2.shape[1])
                bits, bits2 = folded(bits, words), folded(bits2, words)
                # The pair of nodes as such, before any subtree.
                signature = [np.bitwise_or.reduce(x) for x in (bits, bits2)]
                slack = min(
                    (m - np.bitwise_count(x).sum(1).astype(np.int64)).max()
                    for m, x in ((n, bits), (n2, bits2))
                )
                common = int(np.bitwise_count(signature[0] & signature[1]).sum())
                if common + slack < least_overlap(n.min() + n2.min(), percent):
                    continue
                tree = Tree(n, component, before, bits)
                other = Tree(n2, component2, before2, bits2)
            found = _active_rows(tree, other, left, right, component, component2, percent)
            pair += [batch.column("pair")[i].as_py()] * len(found)
            rows += list(found)
            components += list(found.values())
        yield pa.RecordBatch.from_arrays(
            [pa.array(pair, pa.int64()), pa.array(rows, pa.int64()), pa.array(components, pa.int64())],
            ["pair", "row", "component"],
        )


def spanning_links(
    rows: list[int], components: list[int], sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Links between rows, enough to connect all that links connect; none within a component."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    width = max(64, min(map(bitmap_width, map(len, sets))))
    n = np.array(list(map(len, sets)), np.int64)
    bits = np.array([bitmap(s, width) for s in sets])
    tree = Tree(n, np.array(components, np.int64), np.arange(len(n)), bits)
    links = []
    for some_a, some_b in tree.pairs(tree, percent):
        for a, b in zip(some_a.tolist(), some_b.tolist()):
            x, y = find(components[a]), find(components[b])
            if x != y and linked(sets[a], sets[b], percent):
                root[max(x, y)] = min(x, y)
                links.append((rows[a], rows[b]))
    return links


def _pair_links(table: pa.Table, percent: int) -> pa.Table:
    table = table.combine_chunks()
    links = spanning_links(
        table.column("row").to_pylist(),
        table.column("component").to_pylist(),
        _array(table.column("tokens").combine_chunks()),
        percent,
    )
    return pa.table(
        {
            "a": pa.array([x for x, _ in links], pa.int64()),
            "b": pa.array([y for _, y in links], pa.int64()),
        }
    )


def _followed(parents: DataFrame, name: str) -> DataFrame:
    """``u, parent`` with every parent replaced by the last one that parents lead to; the steps
    double, so a path of n of them takes log n."""
    while True:
        ahead = parents.selectExpr("u AS parent", "parent AS next")
        step = materialise(
            parents.join(ahead, "parent").select("u", "parent", "next"), f"{name}-parents"
        )
        if step.where("parent <> next").isEmpty():
            return parents
        parents = step.selectExpr("u", "next AS parent")


def components(links: DataFrame, name: str) -> DataFrame:
    """``row, component`` of every row with a link; the component is its smallest row.

    Every round merges each vertex into the smallest one it has a link to and keeps the links
    between what is left. The first round takes what most copies need, one step to a vertex that
    all share. From the second on the merges are followed to a vertex that is smaller than all it
    has links to, so that at least half of the vertices go, and the rounds grow with the
    logarithm of their number. At the end the merges are followed from the first round to the last.
    """
    edges = links.selectExpr("a AS u", "b AS v").where("u <> v")
    both = edges.unionByName(edges.selectExpr("v AS u", "u AS v")).distinct()
    both, rounds = materialise(both, f"{name}-edges"), []
    while both.limit(1).count():
        parents = both.groupBy("u").agg(F.min("v").alias("least"))
        parents = materialise(
            parents.select("u", F.least("u", "least").alias("parent")), f"{name}-parents"
        )
        if rounds:
            parents = _followed(parents, name)
        rounds.append(parents)
        other = parents.selectExpr("u AS v", "parent AS other")
        both = materialise(
            both.join(parents, "u")
            .join(other, "v")
            .select(F.col("parent").alias("u"), F.col("other").alias("v"))
            .where("u <> v")
            .distinct(),
            f"{name}-edges",
        )
    if not rounds:
        return both.selectExpr("u AS row", "v AS component")
    found = rounds[0].selectExpr("u AS row", "parent AS component")
    for parents in rounds[1:]:
        step = parents.selectExpr("u AS component", "parent AS next")
        found = found.join(step, "component", "left").select(
            "row", F.coalesce("next", "component").alias("component")
        )
    return materialise(found, f"{name}-components")


def similar_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    stored: bool = False,
    row_col: str | None = None,
) -> DataFrame:
    """One row for each input row: ``row, id, n, component_id, keep_row``.

    ``n`` is the number of distinct shingles, ``component_id`` the smallest id that links reach,
    its own included, and ``keep_row`` one row of the component (that of the smallest id). A text
    without words, or a null one, has ``n`` 0 and no link. Null ids count as larger than others;
    rows given twice are linked. An empty table gives no rows. ``stored`` spares writing the
    input where it comes straight from Parquet files; it is read several times. ``row_col`` names
    a key of the rows if there is one (see ``frames.numbered``).
    """
    spark = docs.sparkSession
    if row_col is None:
        docs = docs.select(id_col, text_col)
        row_col = fresh(docs, "text_row")
        docs = numbered(docs, row_col, stored)
    texts = keyed_texts(docs, id_col, text_col, row_col)
    kind = docs.schema[id_col].dataType.simpleString()
    shared = spark.sparkContext.broadcast(frequent_shingles(texts, words))
    prefixes = materialise(
        texts.mapInArrow(
            lambda b: _sets(b, words, percent, shared),
            f"row bigint, id {kind}, n bigint, name binary, rare array<bigint>, "
            "frequent array<bigint>, bits binary",
        ),
        "shingle-sets",
    )

    def whole_sets(rows: DataFrame, name: str) -> DataFrame:
        chosen = picked(texts, rows, "left_semi")
        return materialise(
            chosen.mapInArrow(lambda b: _whole_sets(b, words), "row bigint, tokens binary"), name
        )

    # The first shingles are the largest part and are needed for the groups only.
    sets = materialise(prefixes.drop("rare", "frequent"), "shingle-identities")

    # 1. One row of each class of equal sets.
    smallest = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("smallest")
    classes = materialise(
        sets.where("n > 0")
        .groupBy("name")
        .agg(F.min("row").alias("first"), smallest, F.count(F.lit(1)).alias("copies")),
        "shingle-classes",
    )
    copies = (
        sets.where("n > 0")
        .select("row", "name")
        .join(classes.where("copies > 1").select("name", "first"), "name")
        .where("row <> first")
        .select("row")
    )
    copies = materialise(copies, "shingle-copies")
    single = picked(prefixes.where("n > 0"), copies, "left_anti")

    # 2. and 3. Groups of a shared shingle, and their first rows. Rare shingles have small groups
    # and are dealt once; groups of frequent ones are counted before they are dealt, and the join
    # may split them.
    def grouped(postings: DataFrame) -> DataFrame:
        groups = (
            postings.groupBy("token")
            .agg(F.min("row").alias("a"), F.max("row").alias("last"))
            .where("a <> last")
            .select("token", "a")
        )
        return postings.join(groups, "token").select("token", "a", "row")

    rare = single.select(F.explode("rare").alias("token"), "row").repartition("token")
    frequent = single.select(F.explode("frequent").alias("token"), "row")
    members = materialise(grouped(rare).unionByName(grouped(frequent)), "shared-shingles")
    discard(prefixes)
    bits = sets.select("row", F.col("n").cast("int").alias("n"), "bits")
    size_fits = (100 * F.col("na") >= percent * F.col("nb")) & (
        100 * F.col("nb") >= percent * F.col("na")
    )
    sizes = sets.select("row", F.col("n").cast("int").alias("n"))
    near = materialise(
        members.where("row <> a")
        .select("a", F.col("row").alias("b"))
        .distinct()
        .join(sizes.selectExpr("row AS a", "n AS na"), "a")
        .join(bits.selectExpr("row AS b", "n AS nb", "bits AS bits_b"), "b")
        .where(size_fits)
        .join(bits.selectExpr("row AS a", "bits AS bits_a"), "a")
        .mapInArrow(lambda b: _near_by_bits(b, percent), "a bigint, b bigint"),
        "near-stars",
    )
    ends = near.select(F.col("a").alias("row")).union(near.select("b")).distinct()
    tokens = whole_sets(ends, "star-sets")

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        return materialise(
            pairs.join(tokens.selectExpr("row AS b", "tokens AS tokens_b"), "b")
            .join(tokens.selectExpr("row AS a", "tokens AS tokens_a"), "a")
            .mapInArrow(lambda b: _verified(b, percent), "a bigint, b bigint"),
            name,
        )

    # One pair for each row first; then those that would still join components.
    links = verified(near.groupBy("b").agg(F.min("a").alias("a")), "star-links")
    found = components(links, "stars")
    own = Window.partitionBy("b")
    open_pairs = materialise(
        near.withColumn("least", F.min("a").over(own))
        .where("a <> least")
        .join(found.selectExpr("row AS a", "component AS ca"), "a", "left")
        .join(found.selectExpr("row AS b", "component AS cb"), "b", "left")
        .where("coalesce(ca, a) <> coalesce(cb, b)")
        .select("a", "b"),
        "open-stars",
    )
    if open_pairs.limit(1).count():
        links = links.unionByName(verified(open_pairs, "open-links"))
        found = components(links, "open")

    discard(tokens)

    # 4. First rows are settled. So are two rows whose shared shingle before this one is the same:
    # they have met in its group. What is left are groups whose other rows are of several
    # components and come from several groups, one of each set of equal members.
    listed = Window.partitionBy("row").orderBy("token")
    labelled = materialise(
        members.withColumn("before", F.coalesce(F.lag("token").over(listed), F.xxhash64("row")))
        .where("row <> a")
        .select("token", "row", "before")
        .join(found, "row", "left")
        .withColumn("component", F.coalesce("component", "row")),
        "labelled",
    )
    mixed = (
        labelled.groupBy("token")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.min("before").alias("first"),
            F.max("before").alias("last"),
            F.count(F.lit(1)).alias("members"),
            # Two sums of 64-bit hashes stand for the set of members.
            F.sum(F.xxhash64("row").cast("decimal(20,0)")).alias("sum"),
            F.sum(F.xxhash64("row", F.lit(7)).cast("decimal(20,0)")).alias("sum2"),
        )
        .where("low <> high AND first <> last")
        .groupBy("members", "sum", "sum2")
        .agg(F.min("token").alias("token"))
        .select("token")
    )
    log = -math.log(percent / 100)
    banded = materialise(
        labelled.join(mixed, "token").join(sizes, "row").withColumn(
            "band", F.floor(F.log(F.col("n").cast("double")) / log + 1e-9).cast("int")
        ),
        "mixed-groups",
    )
    shards = banded.groupBy("token", "band").agg(
        F.ceil(F.count(F.lit(1)) / NODE_ROWS).cast("int").alias("shards")
    )
    place = ["token", "band", "shard"]
    whole = shards.groupBy("token").agg(F.sum("shards").cast("int").alias("nodes"))
    searched = materialise(
        banded.join(shards, ["token", "band"])
        .join(whole, "token")
        .withColumn("shard", F.expr("cast(pmod(xxhash64(row, 3), shards) AS int)"))
        .join(bits.select("row", "bits"), "row")
        .select(*place, "nodes", "row", "n", "component", "before", "bits")
        .repartition(*place)
        .sortWithinPartitions(*place)
        .mapInArrow(
            lambda b: _nodes(b, percent), _NODE + ", pair bigint, row bigint, component bigint"
        ),
        "tree-nodes",
    )
    nodes = searched.where("rows IS NOT NULL")
    packed = ("rows", "sizes", "components", "befores", "bits")
    a = nodes.select("token", "band", "shard", "high", *(F.col(c).alias(f"a_{c}") for c in packed))
    b = nodes.select(
        "token",
        F.col("band").alias("band_b"),
        F.col("shard").alias("shard_b"),
        F.col("low").alias("low_b"),
        *(F.col(c).alias(f"b_{c}") for c in packed),
    )
    later = F.expr("(band_b = band AND shard_b > shard) OR band_b = band + 1") & (
        100 * F.col("high") >= percent * F.col("low_b")
    )
    columns = [f"{side}_{c}" for side in "ab" for c in packed]
    within = nodes.where(F.length("rows") > 8).select(
        *(F.col(c).alias(f"a_{c}") for c in packed),
        *(F.lit(None).cast("binary").alias(f"b_{c}") for c in packed),
    )
    pairs = within.unionByName(a.join(b, "token").where(later).select(*columns))
    across = pairs.withColumn("pair", F.monotonically_increasing_id()).mapInArrow(
        lambda x: _active(x, percent), "pair bigint, row bigint, component bigint"
    )
    # Two groups under one number would only be searched together.
    alone = searched.where("pair IS NOT NULL").select("pair", "row", "component")
    active = materialise(alone.unionByName(across), "active-rows")
    discard(members, labelled, banded, searched)
    more = None
    rows = active.select("row").distinct()
    if active.limit(1).count():
        tokens = whole_sets(rows, "active-sets")
        # A row is active in many groups. Rows that groups connect are one cluster, and a row is
        # in one cluster only; a large cluster is searched as pairs of shards.
        edges = active.withColumn("a", F.min("row").over(Window.partitionBy("pair"))).selectExpr(
            "a", "row AS b"
        )
        clusters = components(edges, "active").withColumnRenamed("component", "cluster")
        shards = clusters.groupBy("cluster").agg(
            F.ceil(F.count(F.lit(1)) / NODE_ROWS).cast("int").alias("shards")
        )
        blocks = (
            clusters.join(shards, "cluster")
            .withColumn("shard", F.expr("cast(pmod(xxhash64(row, 5), shards) AS int)"))
            .withColumn("other", F.explode(F.expr("sequence(0, shards - 1)")))
            .select(
                F.xxhash64(
                    "cluster", F.least("shard", "other"), F.greatest("shard", "other")
                ).alias("pair"),
                "row",
            )
            .join(active.select("row", "component").distinct(), "row")
        )

        def pair_links(table: pa.Table) -> pa.Table:
            return _pair_links(table, percent)

        more = materialise(
            blocks.join(tokens, "row")
            .groupBy("pair")
            .applyInArrow(pair_links, "a bigint, b bigint"),
            "tree-links",
        )
    if more is not None and more.limit(1).count():
        found = components(links.unionByName(more), "all")

    # Components of rows as components of ids.
    reached = classes.join(
        found.withColumnRenamed("row", "first"), "first", "left"
    ).withColumn("component", F.coalesce("component", "first"))
    least = reached.groupBy("component").agg(F.min("smallest").alias("least"))
    labels = materialise(
        reached.join(least, "component").select(
            "name",
            F.col("least.id").alias("component_id"),
            F.col("least.row").alias("keep_row"),
        ),
        "component-ids",
    )
    return (
        sets.select("row", "id", "n", "name")
        .join(labels, "name", "left")
        .select(
            "row",
            "id",
            "n",
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
            F.coalesce("keep_row", "row").alias("keep_row"),
        )
    )
