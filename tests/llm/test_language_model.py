"""The language model against a plain version, its bounds, and small languages."""

import math
from collections import Counter

import numpy as np
import pytest

from tests.llm.cases import edge_documents, rows
from tillcast.llm import language_id as lid


def plain_top(counts, share):
    """The first ``share`` items of each language by count, then by name."""
    kept = set()
    for lang in {lang for lang, _ in counts}:
        own = sorted((-n, item) for (x, item), n in counts.items() if x == lang)
        kept |= {item for _, item in own[:share]}
    return kept


def plain_model(data, words_kept, grams_kept):
    words = Counter((lang, w) for text, lang in data if text is not None and lang for w in lid.words_of(text))
    grams = Counter((lang, g) for lang, w in words for order in lid.ORDERS for g in lid.grams_of(w, order))
    langs = sorted({lang for lang, _ in words})

    def table(counts, kept):
        known = plain_top(counts, kept // len(langs))
        total = {x: sum(n for (lang, _), n in counts.items() if lang == x) for x in langs}
        return {
            i: [math.log((counts[x, i] + 0.5) / (total[x] + 0.5 * len(known))) for x in langs] for i in known
        }

    return langs, table(words, words_kept), table(grams, grams_kept)


def plain_prediction(text, langs, words, grams):
    found = lid.words_of(text or "")
    if not found:
        return "und", 0.0
    total = np.zeros(len(langs))
    for w in found:
        if w in words:
            total += words[w]
            continue
        for order in lid.ORDERS:
            known = [grams[g] for g in lid.grams_of(w, order) if g in grams]
            if known:
                total += np.mean(known, axis=0)
                break
    share = np.exp((total - total.max()) / math.sqrt(len(found)))
    best = int(share.argmax())
    return langs[best], 1 / share.sum()


@pytest.mark.parametrize("known_words,known_grams", [(200_000, 100_000), (40, 60), (3, 10)])
def test_predictions_against_a_plain_version(spark, known_words, known_grams):
    docs = edge_documents(spark)
    model = lid.train(docs, known_words=known_words, known_grams=known_grams)
    plain = plain_model([(r[1], r[2]) for r in rows()], known_words, known_grams)
    assert set(model.words) == set(plain[1]) and set(model.grams) == set(plain[2])
    found = lid.predict(docs, model).collect()
    expected = sorted((r[0] is None, r[0] or 0, *plain_prediction(r[1], *plain)) for r in rows())
    got = sorted((r.id is None, r.id or 0, r.lang_pred, r.score) for r in found)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-3)


def test_equally_frequent_words_fill_the_bound(spark):
    text = " ".join("".join(chr(97 + (k // 26**i) % 26) for i in range(4)) for k in range(1200))
    docs = spark.createDataFrame([(1, text, "en")], "doc_id int, text string, lang string")
    assert len(lid.train(docs, known_words=500).words) == 500


def test_a_small_language_keeps_its_part(spark):
    many = " ".join(f"{a}{b}{c}en" for a in "abcdefghij" for b in "abcdefghij" for c in "abcdefghij")
    few = " ".join(f"{a}{b}sv" for a in "abcdefghij" for b in "abcdefghij")
    data = [(i, many, "en") for i in range(30)] + [(100, few, "sv")]
    docs = spark.createDataFrame(data, "doc_id int, text string, lang string")
    model = lid.train(docs, known_words=100)
    assert sum(w.endswith("sv") for w in model.words) == 50
    assert sum(w.endswith("en") for w in model.words) == 50
