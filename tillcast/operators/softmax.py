"""Multinomial logistic regression on blocks of rows that Spark keeps and adds up.

A row is a few numbers, one code for each attribute and a label. A code names a row of the
coefficients, so that attributes are looked up instead of multiplied as wide sparse vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame

from tillcast.operators import lbfgs

# Rows of a block, and of the parts of it whose margins stay in a core's cache.
BLOCK_ROWS = 8192
PART_ROWS = 512
SCHEMA = "numbers binary, codes binary, labels binary"


@dataclass
class Block:
    """The attributes but the last have few values: they are looked up once for each kind of row."""

    numbers: np.ndarray  # number x row
    kinds: np.ndarray  # attribute x kind
    kind: np.ndarray  # of each row
    last: np.ndarray  # code of each row
    labels: np.ndarray | None

    @classmethod
    def of(cls, numbers: np.ndarray, codes: np.ndarray, labels: np.ndarray | None = None) -> Block:
        sizes = codes[:-1].max(axis=1, initial=0) + 1
        keys = np.ravel_multi_index(tuple(codes[:-1]), tuple(sizes))
        _, first, kind = np.unique(keys, return_index=True, return_inverse=True)
        return cls(numbers, codes[:-1, first], kind, codes[-1], labels)


@dataclass
class Summary:
    rows: int
    mean: np.ndarray
    squares: np.ndarray  # of differences from the mean
    codes: np.ndarray  # rows of each code
    labels: np.ndarray  # rows of each label

    def merge(self, other: Summary) -> Summary:
        rows = self.rows + other.rows
        gap = other.mean - self.mean
        return Summary(
            rows,
            self.mean + gap * (other.rows / rows),
            self.squares + other.squares + gap * gap * (self.rows * other.rows / rows),
            self.codes + other.codes,
            self.labels + other.labels,
        )


@dataclass
class Weights:
    """Margins are ``offset + (a row's numbers - mean) @ numbers + the sum of codes[code]``."""

    mean: np.ndarray
    numbers: np.ndarray
    codes: np.ndarray
    offset: np.ndarray

    def margins(self, block: Block) -> Iterator[tuple[slice, np.ndarray]]:
        """Margins of a part of the rows after the other, in an array that the next part reuses."""
        by_kind = self.codes[block.kinds].sum(axis=0)
        centred = block.numbers - self.mean[:, None]
        found = np.empty((PART_ROWS, len(self.offset)))
        taken = np.empty_like(found)
        for start in range(0, len(block.last), PART_ROWS):
            part = slice(start, min(start + PART_ROWS, len(block.last)))
            n = part.stop - start
            np.matmul(centred[:, part].T, self.numbers, out=found[:n])
            found[:n] += self.offset
            for table, code in ((by_kind, block.kind), (self.codes, block.last)):
                found[:n] += np.take(table, code[part], axis=0, out=taken[:n], mode="clip")
            yield part, found[:n]


@dataclass
class Sums:
    loss: float
    numbers: np.ndarray
    codes: np.ndarray
    offset: np.ndarray

    def merge(self, other: Sums) -> Sums:
        return Sums(
            self.loss + other.loss, self.numbers + other.numbers, self.codes + other.codes, self.offset + other.offset
        )


def _by_code(block: Block, values: np.ndarray, n_codes: int) -> np.ndarray:
    """Sums of the rows' values (outcome x row) by code."""
    n_kinds = block.kinds.shape[1]
    found = np.empty((len(values), n_codes))
    for at, value in enumerate(values):
        found[at] = np.bincount(block.last, value, minlength=n_codes)
        by_kind = np.bincount(block.kind, value, minlength=n_kinds)
        for codes in block.kinds:
            added = np.bincount(codes, by_kind)
            found[at, : len(added)] += added
    return found


def _summary(block: Block, n_codes: int, n_labels: int) -> Summary:
    n = len(block.labels)
    mean = block.numbers.mean(axis=1)
    squares = ((block.numbers - mean[:, None]) ** 2).sum(axis=1)
    codes = _by_code(block, np.ones((1, n)), n_codes)[0]
    return Summary(n, mean, squares, codes, np.bincount(block.labels, minlength=n_labels))


def _sums(block: Block, weights: Weights) -> Sums:
    """Loss of a block and its gradient by margins, added up by code."""
    residuals = np.empty((len(weights.offset), len(block.labels)))
    loss = 0.0
    for part, margins in weights.margins(block):
        own = np.arange(len(margins)), block.labels[part]
        margins -= margins.max(axis=1, keepdims=True)
        loss -= margins[own].sum()
        np.exp(margins, out=margins)
        totals = margins.sum(axis=1)
        loss += np.log(totals).sum()
        margins /= totals[:, None]
        margins[own] -= 1.0
        residuals[:, part] = margins.T
    numbers = (block.numbers - weights.mean[:, None]) @ residuals.T
    return Sums(loss, numbers, _by_code(block, residuals, len(weights.codes)).T, residuals.sum(axis=1))


def _merged(parts: Iterator) -> Iterator:
    found = None
    for part in parts:
        found = part if found is None else found.merge(part)
    if found is not None:
        yield found


def _add_up(blocks: RDD, of_block):
    """Merges what ``of_block`` gives within each task, then over tasks in two steps."""
    return blocks.mapPartitions(lambda part: _merged(map(of_block, part))).treeReduce(lambda a, b: a.merge(b))


def _unpack(row, n_numbers: int) -> Block:
    labels = np.frombuffer(row.labels, np.int32)
    numbers = np.frombuffer(row.numbers, np.float64).reshape(n_numbers, -1)
    return Block.of(numbers, np.frombuffer(row.codes, np.int32).reshape(-1, len(labels)), labels)


def fit(packed: DataFrame, n_numbers: int, n_codes: int, n_labels: int, learned: int, iterations: int) -> Weights:
    """``packed`` holds blocks as in :data:`SCHEMA`. Codes from ``learned`` on have no coefficients.

    All columns have unit variance and mean zero in the fit, with each code as a column of zeros and
    ones. Blocks are dealt out evenly, as every pass waits for its slowest task.
    """
    context = packed.sparkSession.sparkContext
    dealt = packed.repartition(2 * context.defaultParallelism)
    blocks = dealt.rdd.map(lambda row: _unpack(row, n_numbers)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = _add_up(blocks, lambda block: _summary(block, n_codes, n_labels))
        n = found.rows
        share = found.codes / n
        spread = np.concatenate([found.squares, n * share * (1 - share)]) / max(n - 1, 1)
        scale = np.divide(1.0, np.sqrt(spread), out=np.zeros_like(spread), where=spread > 0)
        scale[n_numbers + learned :] = 0.0
        offset = np.log1p(found.labels)
        start = np.zeros((len(scale) + 1, n_labels))
        start[-1] = offset - offset.mean()

        def weights(x: np.ndarray) -> Weights:
            x = x.reshape(start.shape)
            scaled = x[:-1] * scale[:, None]
            codes = scaled[n_numbers:]
            return Weights(found.mean, scaled[:n_numbers], codes, x[-1] - share @ codes)

        def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
            sent = context.broadcast(weights(x))
            sums = _add_up(blocks, lambda block: _sums(block, sent.value))
            sent.destroy()
            centred = sums.codes - share[:, None] * sums.offset
            gradient = np.concatenate([np.concatenate([sums.numbers, centred]) * scale[:, None], [sums.offset]])
            return sums.loss / n, gradient.ravel() / n

        return weights(lbfgs.minimise(loss, start.ravel(), iterations))
    finally:
        blocks.unpersist()
