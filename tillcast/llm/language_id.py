"""Language identification by known words, backing off to shorter character n-grams.

Training counts every word of every labelled text by language. The most frequent words, up to a
documented number, are the known ones and are scored by their log frequency in each language. A
word that is not known is scored by its character n-grams of the greatest order of which the
model knows any; n-grams are counted over all distinct words, rare ones included. A text's score
is the sum over its words.

The model is bounded by its parameters, whatever the corpus, and is the only thing broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.frames import keyed_texts, materialise, sliced

UNDETERMINED = "und"
ORDERS = (4, 3, 2, 1)
_WORD = re.compile(r"[^\W\d_]+")
_FLUSH = 300_000


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams_of(word: str, order: int) -> list[str]:
    """Character n-grams of a word with its edges marked; single characters without edges."""
    if order == 1:
        return list(word)
    edged = f"<{word}>"
    return [edged[i : i + order] for i in range(len(edged) - order + 1)]


def held_out(id_: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))


def _flushed(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    for lang, counter in counts.items():
        if counter:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(counter), pa.string()),
                    pa.array(list(counter), pa.string()),
                    pa.array(list(counter.values()), pa.int64()),
                ],
                ["lang", "item", "n"],
            )
    counts.clear()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in sliced(batches, 200):
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.setdefault(lang, Counter()).update(words_of(text))
        if sum(map(len, counts.values())) > _FLUSH:
            yield from _flushed(counts)
    yield from _flushed(counts)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}
    for batch in sliced(batches, 5000):
        for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counter = counts.setdefault(lang, Counter())
            for order in ORDERS:
                counter.update(grams_of(word, order))
        if sum(map(len, counts.values())) > _FLUSH:
            yield from _flushed(counts)
    yield from _flushed(counts)


def _most_frequent(counts: DataFrame, share: int) -> DataFrame:
    """Counts, in all languages, of the ``share`` most frequent items of each; of equally frequent
    ones the first by code points.

    Counts are compared by their histogram, which has at most ``share`` steps for each language above
    the limit; only the step that is kept in part is ranked.
    """
    steps = counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("items"))
    upto = F.sum("items").over(Window.partitionBy("lang").orderBy(F.desc("n")))
    room = (F.lit(share) - (upto - F.col("items"))).alias("room")
    steps = materialise(steps.select("lang", "n", "items", room).where("room > 0"), "count-steps")
    placed = counts.join(F.broadcast(steps), ["lang", "n"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("item"))
    partly = placed.where("items > room").withColumn("rank", rank)
    partly = partly.where(F.col("rank") <= share).where("rank <= room")
    kept = placed.where("items <= room").select("item").unionByName(partly.select("item"))
    return counts.join(kept.distinct(), "item")


@dataclass
class LanguageModel:
    """Log frequencies by language of known words and n-grams; plain arrays, to be broadcast."""

    languages: list[str]
    words: list[str]
    word_scores: np.ndarray
    grams: list[str]
    gram_scores: np.ndarray

    @classmethod
    def of(
        cls,
        languages: list[str],
        words: Counter,
        grams: Counter,
        all_words: dict[str, int] | None = None,
        all_grams: dict[str, int] | None = None,
    ) -> LanguageModel:
        """From ``(language, item)`` counts of the known items, and the number of all items by
        language, known or not; without it the known ones are all."""
        at = {lang: k for k, lang in enumerate(languages)}

        def scores(counts: Counter, total: dict[str, int] | None) -> tuple[list[str], np.ndarray]:
            items = sorted({item for _, item in counts})
            index = {item: k for k, item in enumerate(items)}
            table = np.zeros((len(items), len(languages)))
            for (lang, item), n in counts.items():
                table[index[item], at[lang]] = n
            seen = table.sum(0)
            if total is not None:
                seen = np.array([total.get(lang, 0) for lang in languages], float)
            return items, np.log((table + 0.5) / (seen + 0.5 * max(len(items), 1))).astype(np.float32)

        return cls(languages, *scores(words, all_words), *scores(grams, all_grams))


class Identifier:
    """Scores texts; words met in a task are scored once, for at most ``limit`` words at a time."""

    def __init__(self, model: LanguageModel, limit: int = 300_000):
        self.languages, self._limit = model.languages, limit
        self._known = dict(zip(model.words, model.word_scores))
        self._grams = dict(zip(model.grams, model.gram_scores))
        self._clear()

    def _clear(self) -> None:
        self._index: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.languages)), np.float32)

    def word_scores(self, word: str) -> np.ndarray:
        if (known := self._known.get(word)) is not None:
            return known
        for order in ORDERS:
            found = [s for g in grams_of(word, order) if (s := self._grams.get(g)) is not None]
            if found:
                return np.mean(found, axis=0, dtype=np.float32)
        return np.zeros(len(self.languages), np.float32)

    def identify(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and score of each text; without a letter ``und`` and 0."""
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        if len(self._index) > self._limit:
            self._clear()
        words = [words_of(t) for t in texts]
        new = [w for w in dict.fromkeys(w for ws in words for w in ws) if w not in self._index]
        if new:
            start = len(self._index)
            self._index.update(zip(new, range(start, start + len(new))))
            self._scores = np.concatenate([self._scores, [self.word_scores(w) for w in new]])
        out = []
        for ws in words:
            if not any(any(map(str.isalpha, w)) for w in ws):
                out.append((UNDETERMINED, 0.0))
                continue
            at = np.fromiter(map(self._index.__getitem__, ws), np.int64, len(ws))
            total = self._scores[at].sum(0, dtype=np.float64) / math.sqrt(len(ws))
            share = np.exp(total - total.max())
            best = int(share.argmax())
            out.append((self.languages[best], float(1 / share.sum())))
        return out


def train(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    known_words: int = 200_000,
    known_grams: int = 100_000,
) -> LanguageModel:
    """A model of all rows that have a text and a language; none of them gives an empty model.

    ``known_words`` and ``known_grams`` bound the model, not what is counted, and each language has an
    equal part of them for its most frequent ones. With more than 40 languages they shrink in
    proportion, so that its tables keep their size. Frequencies are shares of all that was counted.
    """
    labelled = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(
        "lang IS NOT NULL AND text IS NOT NULL"
    )
    kind = "lang string, item string, n bigint"
    words = materialise(
        labelled.mapInArrow(_count_words, kind).groupBy("lang", "item").agg(F.sum("n").alias("n")),
        "word-counts",
    )
    grams = materialise(
        words.select("lang", "item")
        .mapInArrow(_count_grams, kind)
        .groupBy("lang", "item")
        .agg(F.sum("n").alias("n")),
        "gram-counts",
    )
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    shrink = max(1, len(languages) / 40)

    def bounded(counts: DataFrame, most: int) -> tuple[Counter, dict[str, int]]:
        share = max(1, int(most / shrink / max(1, len(languages))))
        rows = _most_frequent(counts, share).select("lang", "item", "n").toArrow()
        columns = [rows.column(c).to_pylist() for c in ("lang", "item", "n")]
        totals = counts.groupBy("lang").agg(F.sum("n")).collect()  # a row for each language
        return Counter({(lang, item): n for lang, item, n in zip(*columns)}), dict(map(tuple, totals))

    (some_words, all_words), (some_grams, all_grams) = bounded(words, known_words), bounded(grams, known_grams)
    return LanguageModel.of(languages, some_words, some_grams, all_words, all_grams)


def has_letter(text: str) -> bool:
    return any(any(map(str.isalpha, w)) for w in words_of(text))


def _predicted(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    identifier = Identifier(LanguageModel(*shared.value))
    for batch in sliced(batches, 500):
        texts = batch.column(2).to_pylist()
        found = identifier.identify(texts)
        lettered = [f[0] != UNDETERMINED or has_letter(t) for f, t in zip(found, texts)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64()),
                pa.array(lettered, pa.bool_()),
            ],
            ["row", "id", "lang_pred", "score", "lettered"],
        )


def predict(
    docs: DataFrame,
    model: LanguageModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
) -> DataFrame:
    """``row, id, lang_pred, score, lettered`` of every row, from its text alone.

    A text that is null, empty or without a letter is ``und`` with score 0; so is every text for
    an empty model; ``lettered`` tells the two apart. Ties go to the language that comes first in
    the alphabet. The score is the language's share of the likelihoods, with words counted as
    partly dependent. ``row_col`` names a key of the rows if there is one; else they are numbered.
    """
    plain = (model.languages, model.words, model.word_scores, model.grams, model.gram_scores)
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    kind = docs.schema[id_col].dataType.simpleString()
    return keyed_texts(docs, id_col, text_col, row_col).mapInArrow(
        lambda b: _predicted(b, shared),
        f"row bigint, id {kind}, lang_pred string, score double, lettered boolean",
    )


def labelled_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows to learn from: those not held out."""
    return docs.where(~held_out(F.col(id_col)))


def identify(docs: DataFrame, id_col: str = "doc_id", row_col: str | None = None) -> DataFrame:
    """Train on the rows not held out and predict every row, with ``held_out``."""
    found = predict(docs, train(labelled_rows(docs, id_col)), id_col, row_col=row_col)
    return found.withColumn("held_out", held_out(F.col("id")))
