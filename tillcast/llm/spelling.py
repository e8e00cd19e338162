"""Spelling variants: words one insertion, deletion or replacement apart, by pairs of trie nodes.

Words are counted and put into a trie, and reversed into a second one, whose nodes are numbered.
A place in a word is a pair of integers, the node of what stands before it and the reversed node
of what stands after it. Two words with the same pair for a skipped letter differ in that letter
alone; a word with a skipped letter and one without meet on the same pair if the letter is all
that one has more. So neighbours are found by one join of integer pairs, exactly, and a pair has
at most as many words as there are letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.frames import keyed_texts, materialise, sliced

_HELD_WORDS = 200_000
#: Numbers of nodes: the part of the sorted words, then the place in it.
_PART_BITS = 40


# --- words -----------------------------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch], least: int, drop_one_in: int):
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least)
    counts: Counter = Counter()

    def emitted() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            ["word", "n"],
        )

    for batch in sliced(batches, 500):
        ids = batch.column(0).to_pylist()
        texts = pc.ascii_lower(batch.column(1)).to_pylist()
        for doc_id, text in zip(ids, texts):
            start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in Counter(runs.findall(text)).items():
                if drop_one_in:
                    h = zlib.crc32(run.encode(), start)
                    if h % drop_one_in == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least:
                            continue
                counts[run] += n
            if len(counts) > _HELD_WORDS:
                yield emitted()
                counts.clear()
    if counts:
        yield emitted()


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_length: int = 5,
    least_count: int = 3,
    drop_one_in: int = 97,
) -> DataFrame:
    """``word, n`` of the words of all whole texts with the least length and count.

    Words are the longest runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case. Where
    ``drop_one_in`` divides the CRC-32 h of ``<id>:<word>``, the word loses its letter at h modulo
    its length; 0 drops none. Shorter words are left out, after that. A null text has none; a
    null id counts as the empty string there.
    """
    texts = keyed_texts(docs, id_col, text_col).select("id", "text")
    partial = texts.mapInArrow(
        lambda b: _counted(b, least_length, drop_one_in), "word string, n bigint"
    )
    counts = partial.groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


# --- tries -----------------------------------------------------------------------------------


def _common(a: str, b: str) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


def _inherited(bounds: list[tuple[int, str, str]]) -> dict[int, list[int]]:
    """For each part, by depth from 1, the part that first has that prefix of its first word,
    where an earlier one does.

    ``bounds`` are the parts in order, with their first and last words. A prefix that a part
    shares with the one before is a prefix of that one's last word; that one has it from further
    ahead if it inherits so much and its first word has it too.
    """
    owners: dict[int, list[int]] = {}
    before = None
    for part, first, last in bounds:
        own: list[int] = []
        if before is not None:
            previous, previous_first, previous_last = before
            passed_on = _common(previous_first, previous_last)
            passed = owners[previous][:passed_on]
            shared = _common(previous_last, first)
            own = (passed + [previous] * max(0, shared - len(passed)))[:shared]
        owners[part] = own
        before = (part, first, last)
    return owners


def _nodes(batches: Iterator[pa.RecordBatch], bounds) -> Iterator[pa.RecordBatch]:
    """Trie nodes along every word; rows come by part, sorted within it.

    A node on the path of a part's last word is numbered by its depth, as later parts need to
    know it; others are counted after these.
    """
    owners, lasts = _inherited(bounds), {part: last for part, _, last in bounds}
    current, word, path, counter, spine = None, "", np.zeros(1, np.int64), 0, 0
    for batch in batches:
        out = []
        words, parts = batch.column(2).to_pylist(), batch.column(1).to_pylist()
        for part, next_word in zip(parts, words):
            if part != current:
                current, last, base = part, lasts[part], part << _PART_BITS
                own = np.array(owners[part], np.int64)
                depths = np.arange(1, len(own) + 1)
                path = np.concatenate([[0], (own << _PART_BITS) + depths])
                word, counter = next_word[: len(own)], len(last)
            shared = _common(word, next_word)
            on_spine = _common(last, next_word)
            fresh_from = max(shared, on_spine)
            new = len(next_word) - fresh_from
            path = np.concatenate(
                [
                    path[: shared + 1],
                    base + np.arange(shared + 1, fresh_from + 1),
                    base + counter + 1 + np.arange(new),
                ]
            )
            counter += new
            word = next_word
            out.append(path)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["key", "nodes"]
        )


def trie_nodes(words: DataFrame, key: str, column: str) -> DataFrame:
    """``key, nodes``: for every word the trie node of each prefix, from the root (0) to the word.

    Words are distinct. They are sorted in parts; within one, a word shares the path of the word
    before it as far as both agree. Only the first and last word of each part reach the driver.
    """
    parts = (
        words.select(F.col(key).alias("key"), F.col(column).alias("word"))
        .repartitionByRange("word")
        .select("key", F.spark_partition_id().cast("long").alias("part"), "word")
    )
    parts = materialise(parts, "trie-parts")
    ends = parts.groupBy("part").agg(F.min("word").alias("first"), F.max("word").alias("last"))
    bounds = sorted((r.part, r.first, r.last) for r in ends.collect())
    ordered = parts.repartition("part").sortWithinPartitions("part", "word")
    kind = words.schema[key].dataType.simpleString()
    return ordered.mapInArrow(
        lambda b: _nodes(b, bounds), f"key {kind}, nodes array<bigint>"
    )


# --- neighbours ------------------------------------------------------------------------------


def _places(words: DataFrame) -> DataFrame:
    """``before, after, kind, id, n``: pairs of nodes around gaps (kind 0) and around skipped
    letters, the first of equal ones in a row (2) or not (1)."""
    forward = trie_nodes(words, "id", "word").withColumnRenamed("nodes", "pre")
    reversed_words = words.select("id", F.reverse("word").alias("word"))
    backward = trie_nodes(reversed_words, "id", "word").withColumnRenamed("nodes", "post")
    both = words.join(forward.withColumnRenamed("key", "id"), "id").join(
        backward.withColumnRenamed("key", "id"), "id"
    )
    both = both.select(
        "id", "n", "pre", "post", F.size("pre").alias("m"), F.split("word", "").alias("letters")
    )
    gaps = "transform(sequence(0, m - 1), i -> struct(pre[i] AS before, post[m - 1 - i] AS after, 0 AS kind))"
    skips = (
        "transform(sequence(0, m - 2), i -> struct(pre[i] AS before, post[m - 2 - i] AS after, "
        "CASE WHEN i > 0 AND letters[i] = letters[i - 1] THEN 1 ELSE 2 END AS kind))"
    )
    return both.selectExpr("id", "n", f"inline(concat({gaps}, {skips}))")


def near_words(words: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best``: how many words are one edit away and the most frequent one.

    ``words`` is a written table of ``id, word, n``: distinct, not empty, ids in the order of the
    words, which decides between equally frequent ones. Words without a near one are left out.
    """
    places = materialise(_places(words), "places")
    x, y = places.alias("x"), places.alias("y")
    replaced = (F.col("x.kind") > 0) & (F.col("y.kind") > 0) & (F.col("x.id") != F.col("y.id"))
    longer = (F.col("x.kind") == 2) & (F.col("y.kind") == 0)
    shorter = (F.col("x.kind") == 0) & (F.col("y.kind") == 2)
    # A pair of words meets once: a skipped letter counts as missing at the first of equal ones.
    pairs = x.join(
        y,
        (F.col("x.before") == F.col("y.before"))
        & (F.col("x.after") == F.col("y.after"))
        & (replaced | longer | shorter),
    )
    best = F.max(F.struct(F.col("y.n").alias("n"), (-F.col("y.id")).alias("back")))
    return (
        pairs.groupBy(F.col("x.id").alias("id"))
        .agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
        .selectExpr("id", "n_near", "best.n AS best_n", "-best.back AS best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``id, root`` from ``id, form`` (null at a root), doubling the steps in every round.

    A form is at least ``ratio`` times as frequent, so chains are short and without circles.
    """
    found = materialise(forms.selectExpr("id", "coalesce(form, id) AS root"), "roots")
    while True:
        step = found.selectExpr("id AS root", "root AS next")
        ahead = materialise(found.join(step, "root").select("id", "root", "next"), "roots")
        if ahead.where("root <> next").isEmpty():
            return found
        found = ahead.selectExpr("id", "next AS root")


def variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word, n``.

    The form of a word is its most frequent near word (of equally frequent ones the first by
    code points), if that is at least ``ratio`` times (2 or more) as frequent as the word; else null.
    The root follows forms to the last one. Words may be of any length; an empty table gives no
    rows.
    """
    sorted_words = counts.repartitionByRange("word").sortWithinPartitions("word")
    words = materialise(
        sorted_words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words"
    )
    near = words.join(near_words(words), "id", "left")
    frequent = F.col("best_n") >= ratio * F.col("n")
    forms = materialise(
        near.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, F.col("best")).alias("form"),
            F.when(frequent, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    names = words.select("id", "word")
    found = forms.join(_roots(forms.select("id", "form")), "id")
    found = found.join(names.selectExpr("id AS form", "word AS form_word"), "form", "left")
    found = found.join(names.selectExpr("id AS root", "word AS root_word"), "root")
    return found.selectExpr(
        "word", "form_word AS form", "root_word AS root", "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of all texts with their forms, see ``word_counts`` and ``variants``.

    Null texts have no words; rows given twice count twice.
    """
    return variants(materialise(word_counts(docs, id_col, text_col), "word-counts"))
