"""Token counts under a unigram model, from a trie of distinct pre-tokens.

The distinct pre-tokens of a slice of texts are put in a trie. The forward scores of the unigram
model (the best score of any segmentation of a prefix, and its number of pieces) depend on the
prefix alone, so they are computed once for each node, on the way to its words, and each word's
count is kept at its terminal. A document's count is the sum over its pre-tokens.

Pieces and their ranks come from a public vocabulary; nothing is trained. A piece's score is the
logarithm of its share under Zipf's law, ``-log(rank + 1)``. Characters that the vocabulary lacks
count one token for each of their UTF-8 bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tillcast.llm.frames import keyed_texts, sliced

MARK = "▁"


class UnigramVocabulary:
    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte = 2 * min(scores.values(), default=-1.0)

    @classmethod
    def from_sentencepiece(cls, path: str) -> UnigramVocabulary:
        """Ordinary pieces of a sentencepiece model, ranked by its own scores."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        ]
        ids.sort(key=lambda i: (-model.get_score(i), i))
        return cls({model.id_to_piece(i): -math.log(k + 2) for k, i in enumerate(ids)})


class CountTrie:
    """Terminal counts of pre-tokens; a node is built and scored once and then shared."""

    def __init__(self, vocabulary: UnigramVocabulary):
        self._vocabulary = vocabulary
        self._counts: dict[str, int] = {"": 0}

    def __len__(self) -> int:
        return len(self._counts)

    def insert(self, words: Iterable[str]) -> None:
        """Add words. They are visited in order, which walks their trie depth first: the scores
        on the path to the last word stay, those below the fork are dropped."""
        scores, longest = self._vocabulary.scores, self._vocabulary.longest
        get, byte = scores.get, self._vocabulary.byte
        path, best, pieces = "", [0.0], [0]
        for word in sorted(words):
            depth, most = 0, min(len(path), len(word))
            while depth < most and path[depth] == word[depth]:
                depth += 1
            del best[depth + 1 :], pieces[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                n = len(word[end - 1].encode("utf-8", "surrogatepass"))
                top, count = best[end - 1] + n * byte, pieces[end - 1] + n
                for start in range(max(0, end - longest), end):
                    score = get(word[start:end])
                    if score is not None:
                        score += best[start]
                        if score > top or score == top and pieces[start] + 1 < count:
                            top, count = score, pieces[start] + 1
                best.append(top)
                pieces.append(count)
            path = word
            self._counts[word] = pieces[-1]

    def missing(self, words: Iterable[str]) -> list[str]:
        return [w for w in words if w not in self._counts]

    def count(self, word: str) -> int:
        return self._counts[word]


def pre_tokens(text: str) -> list[str]:
    """White-space separated words, each with the marker that stands for the space before it."""
    return [MARK + w for w in text.split()]


def _counted(
    batches: Iterator[pa.RecordBatch], path: str, limit: int
) -> Iterator[pa.RecordBatch]:
    vocabulary = UnigramVocabulary.from_sentencepiece(path)
    trie = CountTrie(vocabulary)
    for batch in sliced(batches):
        words = [pre_tokens(t) for t in batch.column(2).to_pylist()]
        if len(trie) > limit:
            trie = CountTrie(vocabulary)
        trie.insert(trie.missing(set().union(*words)))
        count = trie.count
        tokens = [sum(map(count, w)) for w in words]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(list(map(len, words)), pa.int64()),
                pa.array([len(set(w)) for w in words], pa.int64()),
                pa.array(tokens, pa.int64()),
            ],
            ["row", "id", "n_words", "n_distinct", "n_tokens"],
        )


def token_counts(
    docs: DataFrame,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 300_000,
) -> DataFrame:
    """``row, id, n_words, n_distinct, n_tokens`` of every row.

    A null or empty text has no words and no tokens. Rows given twice are counted twice; ids may
    be null. ``limit`` bounds the words a task keeps: past it the trie is begun anew, which
    changes no count.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return keyed_texts(docs, id_col, text_col).mapInArrow(
        lambda b: _counted(b, model, limit),
        f"row bigint, id {kind}, n_words bigint, n_distinct bigint, n_tokens bigint",
    )


def brute_force_count(word: str, vocabulary: UnigramVocabulary) -> int:
    """Pieces of the best segmentation of one word, by itself; what the trie must agree with."""
    states = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode("utf-8", "surrogatepass"))
        ways = [(states[end - 1][0] + n * vocabulary.byte, -states[end - 1][1] - n)]
        for start in range(end):
            if (s := vocabulary.scores.get(word[start:end])) is not None:
                ways.append((s + states[start][0], -states[start][1] - 1))
        top = max(ways)
        states.append((top[0], -top[1]))
    return states[-1][1]
