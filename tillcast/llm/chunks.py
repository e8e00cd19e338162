"""A table of distinct chunks and their token ids, filled as a task meets new chunks.

A text is cut where no token can cross. Each distinct chunk is encoded once and a text's ids are
gathered by position. The table belongs to one task and is emptied when it is full: corpora
keep bringing new words, so one table for all of them would have no bound, and joining the ids
back to each occurrence would shuffle several times the input.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa


class ChunkTable:
    """``encode`` gives the ids of each of a list of chunks; ``limit`` and ``most_characters`` bound
    the chunks kept from one call to the next."""

    def __init__(
        self,
        encode: Callable[[list[str]], list[list[int]]],
        limit: int = 300_000,
        most_characters: int = 16_000_000,
    ):
        self._encode, self._limit, self._most = encode, limit, most_characters
        self._clear()

    def _clear(self) -> None:
        self._held = 0
        self._index: dict[str, int] = {}
        self._flat = np.zeros(0, np.int32)
        self._start = np.zeros(0, np.int64)
        self._length = np.zeros(0, np.int64)

    def _add(self, chunks: list[str]) -> None:
        self._held += sum(map(len, chunks))
        ids = self._encode(chunks)
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))
        start = np.cumsum(length) - length + len(self._flat)
        self._index.update(zip(chunks, range(len(self._start), len(self._start) + len(chunks))))
        self._flat = np.concatenate([self._flat, flat])
        self._start = np.concatenate([self._start, start])
        self._length = np.concatenate([self._length, length])

    def ids(self, texts: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts given as lists of chunks: all ids one after another, and each text's end.

        Only the distinct chunks of the call are looked up one by one.
        """
        if len(self._index) > self._limit or self._held > self._most:
            self._clear()
        coded = texts.flatten().dictionary_encode()
        chunks, index = coded.dictionary.to_pylist(), self._index
        if new := [c for c in chunks if c not in index]:
            self._add(new)
        known = np.fromiter(map(index.__getitem__, chunks), np.int64, len(chunks))
        at = known[coded.indices.to_numpy()]
        length = self._length[at]
        ends = np.cumsum(length)
        where = np.repeat(self._start[at] - (ends - length), length)
        flat = self._flat[where + np.arange(len(where))]
        counts = texts.value_lengths().to_numpy()
        text_ends = np.concatenate([[0], ends])[np.cumsum(counts)]
        return flat, text_ends
