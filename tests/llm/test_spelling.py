"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import edge_documents, empty_documents, rows
from tillcast.llm import spelling


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain_counts(data, drop=97):
    counts = Counter()
    for doc_id, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}


def plain_variants(counts):
    out, forms = {}, {}
    for w, n in counts.items():
        near = [v for v in counts if one_apart(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (n, len(near))
    def root(w):
        return w if forms[w] is None else root(forms[w])
    return {(w, forms[w], root(w), n, k, counts.get(forms[w])) for w, (n, k) in out.items()}


def vocabulary(seed, letters, stems, edits):
    """Stems and what a chain of edits makes of them."""
    rng, out = random.Random(seed), Counter()
    for _ in range(stems):
        word = "".join(rng.choice(letters) for _ in range(rng.randint(5, 12)))
        n = rng.choice([3, 8, 50, 1000])
        for _ in range(edits):
            out[word] += n
            at, letter = rng.randrange(len(word) + 1), rng.choice(letters)
            word = rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :]])
            n = max(3, n // rng.choice([1, 2, 3]))
    return {w: n for w, n in out.items() if w}


@pytest.mark.parametrize(
    "letters,stems,edits,parts",
    [("ab", 40, 20, 23), ("aaaab", 30, 10, 7), ("abcdefgÿÀ", 60, 8, 1), ("ab😀中", 30, 8, 23)],
)
def test_variants_against_all_pairs(spark, letters, stems, edits, parts):
    counts = vocabulary(len(letters) + stems, letters, stems, edits)
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
        found = [tuple(r) for r in spelling.variants(frame).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])
    assert len(found) == len(counts)
    assert set(found) == plain_variants(counts)


def test_nodes_are_the_prefixes(spark):
    words = sorted(vocabulary(3, "abc", 60, 12))
    frame = spark.createDataFrame(list(enumerate(words)), "id bigint, word string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = spelling.trie_nodes(frame.repartition(3), "id", "word").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    node_of = {}
    for r in found:
        word = words[r.key]
        assert len(r.nodes) == len(word) + 1
        for i, node in enumerate(r.nodes):
            assert node_of.setdefault(word[:i], node) == node
    assert len(set(node_of.values())) == len(node_of)


def test_texts(spark):
    rng = random.Random(9)
    base = ["weather", "letter", "garden", "Größe", "naïve", "mountain", "théâtre"]
    data = [(i, " ".join(rng.choice(base).replace(*rng.choice([("e", "e"), ("t", "tt"), ("a", "o")])) for _ in range(60))) for i in range(300)]
    data += [(7, data[7][1]), (None, data[3][1]), (400, None), (401, ""), (402, "x" * 3000 + " " + "X" * 2999)] * 3
    frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    found = [tuple(r) for r in spelling.spelling_variants(frame).collect()]
    assert set(found) == plain_variants(plain_counts(data)) and len(found) == len(set(found))
    assert any(r[1] for r in found) and any(r[2] != r[1] for r in found if r[1])


def test_edge_documents(spark):
    found = {tuple(r) for r in spelling.spelling_variants(edge_documents(spark)).collect()}
    assert found == plain_variants(plain_counts([(r[0], r[1]) for r in rows()]))
    assert spelling.spelling_variants(empty_documents(spark)).count() == 0


def test_chains_are_followed_to_the_root(spark):
    chain = [("aaaaa" + "b" * k, 3 * 2**k) for k in range(30)]
    frame = spark.createDataFrame(chain, "word string, n bigint")
    found = spelling.variants(frame)
    assert found.select(F.countDistinct("root")).first()[0] == 1
    assert found.where("form IS NULL").count() == 1
