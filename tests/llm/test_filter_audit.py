"""The filter audit against a plain version, with colliding hashes, repeated ids and hot copies."""

import random
from collections import defaultdict
from itertools import permutations

from pyspark.sql import functions as F

from tests.llm.cases import edge_documents, empty_documents, rows, sentence
from tillcast.llm import filter_audit, links


def plain(data, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, _ in data:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = defaultdict(list)
    for i, text, lang in data:
        text = text or ""
        words = text
        for c in "\t\n\v\f\r":
            words = words.replace(c, " ")
        words = [w for w in words.split(" ") if w]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and least[text] < i,
        }
        docs[lang or ""].append(({k for k, v in fails.items() if v}, i in good, i in toxic))
    out, removed_by = {}, defaultdict(int)
    for part, members in docs.items():
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                left = [d for d in members if not d[0] & before]
                here = [d for d in left if letter in d[0]]
                redundant = sum(1 for d in members if d[0] & before and letter in d[0])
                removed_by[part, letter] += len(here)
                out[part, order, step] = [
                    len(left) - len(here), len(here), redundant,
                    sum(d[0] == {letter} for d in members),
                    sum(d[1] for d in here), sum(d[2] for d in here),
                ]
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def got(found):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in found.collect()}


LABELS = "doc_id bigint, quality int, toxic int, text string, id string"


def labels_of(ids):
    rng = random.Random(7)
    rows_ = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in ids if rng.random() < 0.7]
    return rows_ + rows_[:3] + [(11, 1, 1), (None, 1, 1), (987654, 1, 0)]


def test_edge_documents(spark):
    data = [(r[0], r[1], r[2]) for r in rows()]
    labels = labels_of([r[0] for r in rows()])
    frame = spark.createDataFrame([(*r, "x", "y") for r in labels], LABELS)
    found = filter_audit.audit(edge_documents(spark), frame)
    assert found.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    ]
    assert got(found) == plain(data, labels)
    assert found.count() == 600 * 3
    assert filter_audit.audit(empty_documents(spark), frame).count() == 0
    no_labels = spark.createDataFrame([], LABELS)
    assert got(filter_audit.audit(edge_documents(spark), no_labels)) == plain(data, [])


def hard_documents():
    rng = random.Random(5)
    pool = [sentence(rng, 230), sentence(rng, 230), sentence(rng, 10), "AB #1", "", "CD *2"]
    data = [(rng.randrange(400), rng.choice(pool), rng.choice(["en", "de", None])) for _ in range(500)]
    data += [(i, pool[0], "en") for i in range(1000, 1300)]
    return data + [(None, pool[0], "en"), (-3, None, "de"), (-3, "AB #1", ""), (-3, "CD *2", "")]


def test_colliding_hashes_and_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(links, "HOT_ROWS", 20)
    data = hard_documents()
    docs = spark.createDataFrame(data, "doc_id bigint, text string, lang string").repartition(4)
    labels = labels_of(range(0, 400, 3))
    frame = spark.createDataFrame([(*r, "x", "y") for r in labels], LABELS)
    expected = plain(data, labels)
    # All texts of one length, or all texts at all, have one hash.
    for hash_of in (F.xxhash64, lambda c: F.length(c).cast("long"), lambda c: F.lit(0).cast("long")):
        failing, parts = filter_audit.failures(docs, hash_of=hash_of)
        found = filter_audit.orders(filter_audit.combinations(failing, parts, frame))
        assert got(found) == expected
