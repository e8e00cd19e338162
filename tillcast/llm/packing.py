"""Packing of documents into few sequences of a fixed number of tokens.

Tokenisation cuts a text before white space, encodes each distinct chunk once in a task and puts
the ids together by position. Documents longer than a sequence are cut into full pieces after a
first shorter one. Pieces of one length are alike, so the packing is planned on the number of
pieces of each length (at most one number for each length up to the capacity, whatever the
number of documents) and the pieces then take their places by their rank among the pieces of
their length, in parallel.

The plan is a bin completion: the largest length left gets the fillings around it that no other
filling dominates, each tried for as many sequences as there are pieces for. The search is cut
where the waste exceeds what a better plan may waste. The best-fit plan is the first incumbent,
and the search ends at the lower bound or after ``nodes`` steps with the best plan so far.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.chunks import ChunkTable
from tillcast.llm.frames import fresh, keyed_texts, materialise, place_key, sliced

Pattern = tuple[tuple[int, int], ...]
"""Lengths, largest first, and how often each occurs in the sequence."""

#: White space as the tokenizer's pre-tokenisation sees it.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PART = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Two of them in a row, or the mark of a cut, for Arrow.
_RUN = "[\t-\r \u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2}|\x00"


#: Fixed value: the pattern by which byte-level BPE splits a text before its merges.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Beyond these characters two libraries' tables of letters may differ.
_OTHER = re.compile("[^\x00-\u024f]")


def _ranks(path: str) -> dict[bytes, int] | None:
    """Byte strings and ids of a tokenizers file, if its ids are ranks of plain byte-level BPE."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    before = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
        return None
    vocab = spec["model"]["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    if any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    # The file writes each byte as a character: printable ones as they are, others from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
    special = {t["content"] for t in spec["added_tokens"]}
    return {bytes(byte[c] for c in t): i for t, i in vocab.items() if t not in special}


class ByteTokenizer:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    Chunks of Latin text are encoded by tiktoken from the same file's merges, which gives the
    same ids in a third of the time; all others by tokenizers itself.
    """

    def __init__(self, path: str, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._special = [t.content for t in self._model.get_added_tokens_decoder().values()]
        ranks = _ranks(path)
        self._fast = ranks and tiktoken.Encoding(
            "ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_ordinary
        self._table = ChunkTable(self._encode, limit)

    def _plain(self, chunk: str) -> bool:
        return not (_OTHER.search(chunk) or any(s in chunk for s in self._special))

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        if self._fast and self._plain("\n".join(chunks)):
            return list(map(self._fast, chunks))
        if self._fast:
            out = [self._fast(c) if self._plain(c) else None for c in chunks]
            rest = [k for k, ids in enumerate(out) if ids is None]
        else:
            out, rest = [None] * len(chunks), list(range(len(chunks)))
        found = self._model.encode_batch_fast([chunks[k] for k in rest], add_special_tokens=False)
        for k, encoding in zip(rest, found):
            out[k] = encoding.ids
        return out

    def _parts(self, text: str) -> list[str]:
        if any(s in text for s in self._special):
            return [text]
        return _PART.findall(text)

    def ids(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of each text."""
        # A space before anything but white space opens the next token, so a cut there divides none.
        odd = pc.match_substring_regex(texts, _RUN)
        for special in self._special:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        plain = texts.filter(pc.invert(odd))
        lists = pc.split_pattern(pc.replace_substring(plain, " ", "\x00 "), "\x00")
        rest = [self._parts(t) for t in texts.filter(odd).to_pylist()]
        if rest:
            lists = pa.concat_arrays([lists, pa.array(rest, lists.type)])
        flat, ends = self._table.ids(lists)
        found = np.split(flat, ends[:-1]) if len(ends) else []
        order = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")
        out: list = [None] * len(found)
        for place, ids in zip(order.tolist(), found):
            out[place] = ids
        return out


def token_ids(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int
) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of ``row, id, text`` batches with the ids of each text, ``end_id`` at the end."""
    tokenizer = ByteTokenizer(path)
    end = np.array([end_id], np.int32)
    for batch in sliced(batches, 500):
        yield batch, [np.concatenate([x, end]) for x in tokenizer.ids(batch.column(2))]


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: the first takes what full ones leave."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int
) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    for batch, all_ids in token_ids(batches, path, end_id):
        at, piece, start, length, crc, rank = [], [], [], [], [], []
        for i, ids in enumerate(all_ids):
            for k, (s, n) in enumerate(cuts(len(ids), capacity)):
                at.append(i)
                piece.append(k)
                start.append(s)
                length.append(n)
                crc.append(zlib.crc32(ids[s : s + n].astype("<u4").tobytes()))
                rank.append(seen[n])
                seen[n] += 1
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(take),
                batch.column(1).take(take),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(np.full(len(at), part, np.int32)),
                pa.array(rank, pa.int64()),
            ],
            ["row", "id", "piece", "start", "length", "crc", "part", "rank"],
        )


def lower_bound(counts: list[int]) -> int:
    """No plan needs fewer sequences: the best of the bounds by volume and by large pieces."""
    capacity = len(counts) - 1
    n = np.array(counts, dtype=object)
    below = np.concatenate([[0], np.cumsum(n)])  # pieces shorter than the index
    volume = np.concatenate([[0], np.cumsum(n * np.arange(capacity + 1))])
    best = -(-volume[-1] // capacity)
    half = capacity // 2
    for least in range(1, half + 1):
        alone = below[capacity + 1] - below[capacity - least + 1]
        paired = below[capacity - least + 1] - below[half + 1]
        room = paired * capacity - (volume[capacity - least + 1] - volume[half + 1])
        rest = volume[half + 1] - volume[least] - room
        best = max(best, alone + paired + max(0, -(-rest // capacity)))
    return int(best)


def best_fit(counts: list[int]) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing on counts: patterns and how many sequences follow each."""
    capacity = len(counts) - 1
    groups: dict[int, list[tuple[Pattern, int]]] = {capacity: []}
    done: list[tuple[Pattern, int]] = []
    for length in range(capacity, 0, -1):
        left = counts[length]
        while left:
            room = min((r for r, g in groups.items() if r >= length and g), default=None)
            pattern, times = groups[room].pop() if room is not None else ((), left)
            room = capacity if room is None else room
            each = min(room // length, left)
            use = min(times, left // each)
            if use < times and pattern:
                groups[room].append((pattern, times - use))
            left -= use * each
            rest = room - each * length
            grown = (*pattern, (length, each))
            if rest:
                groups.setdefault(rest, []).append((grown, use))
            else:
                done.append((grown, use))
    return done + [x for g in groups.values() for x in g]


def _largest_upto(counts: list[int]) -> list[int]:
    out, last = [0] * len(counts), 0
    for length in range(1, len(counts)):
        last = length if counts[length] else last
        out[length] = last
    return out


def fillings(counts: list[int], room: int, width: int = 6) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, least waste first: one or two pieces, then what fits."""
    upto = _largest_upto(counts)
    starts = []
    one = upto[room]
    if not one:
        return [()]
    if one == room:
        return [(one,)]
    first = one
    while first and len(starts) < 4 * width:
        starts.append((first,))
        second = upto[min(first, room - first)]
        if second == first and counts[first] < 2:
            second = upto[second - 1]
        if second:
            starts.append((first, second))
        first = upto[first - 1]
    found = {}
    for start in starts:
        filling, left = list(start), room - sum(start)
        while left and (x := upto[left]):
            while x and filling.count(x) >= counts[x]:
                x = upto[x - 1]
            if not x:
                break
            k = min(left // x, counts[x] - filling.count(x))
            filling += [x] * k
            left -= x * k
        filling = tuple(sorted(filling, reverse=True))
        if not _dominated(filling, left, counts, upto):
            found[filling] = (left, len(filling))
    return sorted(found, key=found.get)[:width] or [(one,)]


def _dominated(filling: tuple[int, ...], waste: int, counts: list[int], upto: list[int]) -> bool:
    """Whether a larger piece could take the place of one or two pieces of the filling."""
    parts = {(x, x + 1) for x in filling}
    if len(filling) <= 12:
        parts |= {(x + y, x + y) for i, x in enumerate(filling) for y in filling[i + 1 :]}
    for size, least in parts:
        x = upto[size + waste] if size + waste < len(upto) else 0
        if x >= least and counts[x] > filling.count(x):
            return True
    return False


def plan(counts: list[int], nodes: int = 20_000) -> list[tuple[Pattern, int]]:
    """Patterns and times that place all pieces; ``counts[n]`` pieces have length ``n``."""
    capacity = len(counts) - 1
    total = sum(n * c for n, c in enumerate(counts))
    best = best_fit(counts)
    bins, bound = sum(t for _, t in best), lower_bound(counts)
    left = list(counts)
    # Each frame: the pattern applied, how often, the waste before it, the fillings still to try.
    stack: list[list] = [[None, 0, 0, None]]
    while stack and bins > bound and nodes:
        nodes -= 1
        frame = stack[-1]
        if frame[0]:
            for length, k in frame[0]:
                left[length] += k * frame[1]
            frame[0] = None
        if frame[3] is None:
            largest = next((n for n in range(capacity, 0, -1) if left[n]), 0)
            if not largest:
                runs = [(f[0], f[1]) for f in stack[:-1]]
                if (used := sum(t for _, t in runs)) < bins:
                    best, bins = runs, used
                stack.pop()
                continue
            left[largest] -= 1
            around = fillings(left, capacity - largest)
            left[largest] += 1
            frame[3] = [(largest, *f) for f in reversed(around)]
        if not frame[3]:
            stack.pop()
            continue
        lengths = frame[3].pop()
        pattern = tuple((n, lengths.count(n)) for n in sorted(set(lengths), reverse=True))
        times = min(left[n] // k for n, k in pattern)
        waste = frame[2] + times * (capacity - sum(lengths))
        if waste > (bins - 1) * capacity - total:
            continue
        for length, k in pattern:
            left[length] -= k * times
        frame[0], frame[1] = pattern, times
        stack.append([None, 0, waste, None])
    return best


@dataclass
class Places:
    """Where the pieces of each length go, by rank; one row for each run of like sequences."""

    first: dict[int, list[int]] = field(default_factory=dict)
    base: dict[int, list[int]] = field(default_factory=dict)
    each: dict[int, list[int]] = field(default_factory=dict)
    offset: dict[int, list[int]] = field(default_factory=dict)

    @classmethod
    def of(cls, runs: list[tuple[Pattern, int]]) -> Places:
        out, used, base = cls(), {}, 0
        for pattern, times in runs:
            offset = 0
            for length, k in pattern:
                out.first.setdefault(length, []).append(used.get(length, 0))
                out.base.setdefault(length, []).append(base)
                out.each.setdefault(length, []).append(k)
                out.offset.setdefault(length, []).append(offset)
                used[length] = used.get(length, 0) + k * times
                offset += k * length
            base += times
        return out

    def find(self, length: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.array(self.first[length])
        run = np.searchsorted(first, rank, side="right") - 1
        each, within = np.array(self.each[length])[run], rank - first[run]
        sequence = np.array(self.base[length])[run] + within // each
        return sequence, np.array(self.offset[length])[run] + within % each * length


def _placed(batches: Iterator[pa.RecordBatch], places: Places) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        length = batch.column(names.index("length")).to_numpy()
        rank = batch.column(names.index("rank")).to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if len(some):
                sequence[some], offset[some] = places.find(int(length[some[0]]), rank[some])
        columns = {c: batch.column(c) for c in names if c != "rank"}
        columns |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``keyed_texts`` by places in files where the rows have them."""
    key = fresh(docs, "text_row")
    placed = place_key(docs.select(id_col, text_col), key)
    if placed is None:
        return keyed_texts(docs, id_col, text_col)
    return keyed_texts(placed, id_col, text_col, key)


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    capacity: int = 1024,
    nodes: int = 20_000,
) -> DataFrame:
    """Place of every piece of every document.

    A null or empty text is its end id alone. Rows given twice are packed twice. An empty table
    gives no rows.

    Columns: ``row`` (key of the input row), ``id``, ``piece``, ``start``, ``length``, ``crc``
    (CRC-32 of the piece's ids), ``sequence_id``, ``offset``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"row bigint, id {kind}, piece int, start bigint, length bigint, crc bigint, "
        "part int, rank bigint"
    )
    pieces = materialise(
        _texts(docs, id_col, text_col).mapInArrow(
            lambda b: _pieces(b, tokenizer, end_id, capacity), schema
        ),
        "pieces",
    )
    # A rank in its task becomes a rank among all pieces of the length.
    by_task = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("pieces"))
    before = Window.partitionBy("length").orderBy("part")
    firsts = materialise(
        by_task.withColumn("before", F.sum("pieces").over(before) - F.col("pieces")), "firsts"
    )
    counts = [0] * (capacity + 1)
    for length, n in firsts.groupBy("length").agg(F.sum("pieces")).collect():  # capacity rows
        counts[length] = n
    places = Places.of(plan(counts, nodes))
    ranked = pieces.join(firsts.select("part", "length", "before"), ["part", "length"]).select(
        "row",
        "id",
        "piece",
        "start",
        "length",
        "crc",
        (F.col("before") + F.col("rank")).alias("rank"),
    )
    out = (
        f"row bigint, id {kind}, piece int, start bigint, length bigint, crc bigint, "
        "sequence_id bigint, offset bigint"
    )
    return ranked.mapInArrow(lambda b: _placed(b, places), out)


def _ids(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    for batch, ids in token_ids(batches, path, end_id):
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["row", "ids"]
        )


def sequences(
    docs: DataFrame,
    placed: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids``. ``placed`` is written ``pack``
    of the same ``docs``, which come straight from Parquet files (see ``frames.place_key``)."""
    ids = _texts(docs, id_col, text_col).mapInArrow(
        lambda b: _ids(b, tokenizer, end_id), "row bigint, ids array<int>"
    )
    cut = F.expr("slice(ids, cast(start + 1 AS int), cast(length AS int))")
    parts = F.array_sort(F.collect_list(F.struct("offset", cut.alias("ids"))))
    return (
        placed.join(ids, "row")
        .groupBy("sequence_id")
        .agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    )
