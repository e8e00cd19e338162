"""SimHash near duplicates against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.cases import edge_documents, empty_documents, rows, sentence
from tillcast.llm import simhash
from tillcast.llm.links import connected
from tillcast.sources.shared import materialise


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    n = max(1, len(words) - 2) if words else 0
    votes = [0] * 64
    for i in range(n):
        h = xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest()
        for k in range(64):
            votes[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * votes[k] > n) if n else 0


def plain_labels(prints):
    """The smallest place that links reach, by all pairs."""
    x = np.array(prints, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    labels = np.arange(len(x))
    while True:
        least = np.where(near, labels[None, :], len(x)).min(axis=1)
        if (least == labels).all():
            return labels
        labels = least


def test_rows_against_a_plain_version(spark):
    key = lambda r: tuple((x is None, x or 0) for x in r)
    data = sorted({(r[0] is None, r[0] or 0, r[1] is None, r[1] or "") for r in rows()})
    expected = {}
    prints = [plain_fingerprint(r[3]) for r in data]
    labels = plain_labels(prints)
    for r, p, label in zip(data, prints, labels):
        smallest = data[label]
        expected[(None if r[0] else r[1], f"{p:016x}")] = None if smallest[0] else smallest[1]
    found = simhash.near_duplicates(edge_documents(spark)).collect()
    assert len(found) == len(rows())
    assert {(r.id, r.fingerprint): r.component_id for r in found} == expected
    sizes = sorted([(r[0], f"{plain_fingerprint(r[1]):016x}") for r in rows()], key=key)
    assert sizes == sorted([(r.id, r.fingerprint) for r in found], key=key)
    assert simhash.near_duplicates(empty_documents(spark)).count() == 0


def test_texts_of_white_space_only_link_with_empty_ones(spark):
    data = [(5, ""), (3, None), (9, " \n\x0b"), (7, "a word")]
    found = simhash.near_duplicates(spark.createDataFrame(data, "doc_id int, text string"))
    assert {(r.id, r.component_id) for r in found.collect()} == {(5, 3), (3, 3), (9, 3), (7, 7)}


def flipped(rng, x, n):
    for k in rng.sample(range(64), n):
        x ^= 1 << k
    return x


def clusters(seed, sizes, spread):
    """Fingerprints around some centres, a chain of them, and others at random."""
    rng, out = random.Random(seed), set()
    for n in sizes:
        centre = rng.getrandbits(64)
        out |= {flipped(rng, centre, rng.randint(0, spread)) for _ in range(n)}
    x = rng.getrandbits(64)
    for _ in range(150):
        out.add(x)
        x = flipped(rng, x, 3)
    return sorted(out | {rng.getrandbits(64) for _ in range(300)})


@pytest.mark.parametrize(
    "groups,small,node,spread", [(4, 64, 512, 4), (6, 64, 512, 9), (6, 2, 5, 9), (7, 8, 16, 14)]
)
def test_components_against_all_pairs(spark, monkeypatch, groups, small, node, spread):
    monkeypatch.setattr(simhash, "SMALL_CELL", small)
    monkeypatch.setattr(simhash, "NODE_ROWS", node)
    prints = clusters(spread, [400, 100, 30, 30, 5], spread)
    signed = [(simhash._signed(x),) for x in prints]
    frame = materialise(spark.createDataFrame(signed, "fingerprint bigint"), "prints")
    found = simhash.fingerprint_components(frame, groups).collect()
    got = {r.node: r.component for r in found}
    order = sorted(p for (p,) in signed)
    labels = plain_labels([p % (1 << 64) for p in order])
    assert len(got) == len(found)
    assert {p: got.get(p, p) for p in order} == {p: order[k] for p, k in zip(order, labels)}
    assert len(set(labels)) > 200


def test_manhattan_distance_is_a_lower_bound(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(63), rng.getrandbits(63)) for _ in range(200)]
    a, b = F.col("a"), F.col("b")
    found = spark.createDataFrame(pairs, "a bigint, b bigint").select(
        "a", "b", F.bit_count(simhash.segment_counts(a).bitwiseXOR(simhash.segment_counts(b))).alias("d")
    )
    for r in found.collect():
        counts = [[(x >> 2 * k & 3).bit_count() for k in range(32)] for x in (r.a, r.b)]
        assert r.d == sum(abs(p - q) for p, q in zip(*counts)) <= (r.a ^ r.b).bit_count()


@pytest.mark.parametrize("order", ["up", "down", "random"])
def test_long_chains_take_few_rounds(spark, monkeypatch, order):
    from tillcast.llm import links

    ids = list(range(1000))
    if order == "down":
        ids.reverse()
    elif order == "random":
        random.Random(2).shuffle(ids)
    rounds = []
    step = links._starred
    monkeypatch.setattr(links, "_starred", lambda *a: rounds.append(1) or step(*a))
    chain = spark.createDataFrame(list(zip(ids, ids[1:])) + [(2000, 2001), (2001, 2001), (2000, 2001)], "a int, b int")
    found = {r.node: r.component for r in connected(chain).collect()}
    assert found == dict.fromkeys(ids, 0) | {2000: 2000, 2001: 2000}
    assert len(rounds) < 40


def test_hot_keys_are_looked_up_alike(spark, monkeypatch):
    from tillcast.llm import links

    monkeypatch.setattr(links, "HOT_ROWS", 10)
    rows_ = materialise(spark.range(3000).selectExpr("id", "IF(id % 3 = 0, 7, id % 50) AS k"), "rows")
    lookup = materialise(spark.range(40).selectExpr("id AS k", "id * 2 AS double"), "lookup")
    for how in ("inner", "left"):
        found = links.looked_up(rows_, lookup, "k", how)
        plain = rows_.join(lookup, "k", how)
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
