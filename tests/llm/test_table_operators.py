"""Exact and near duplicates, packing, archives and nearest neighbours against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.cases import edge_documents, empty_documents, rows, sentence
from tillcast.llm import exact_dedup, jaccard_join, nearest, packing, warc
from tillcast.llm.shingles import Shingler
from tillcast.sources.shared import new_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def bare(text):
    return re.sub("[\x20\x09-\x0d]", "", text or "")


@pytest.mark.parametrize("block_bytes", [5, 4096])
def test_exact_classes(spark, block_bytes):
    found = exact_dedup.exact_classes(edge_documents(spark), block_bytes=block_bytes).collect()
    assert len(found) == len(rows())
    groups = defaultdict(list)
    for r in rows():
        groups[bare(r[1])].append((-len(r[1] or ""), r[0] is None, r[0]))
    best = {hashlib.sha256(k.encode()).hexdigest(): (min(v)[2], len(v)) for k, v in groups.items()}
    for r in found:
        assert (r.keep_id, r.group_size) == best[r.digest]
        assert r.kept == (r.row == r.keep_row)
    assert sum(r.kept for r in found) == len(groups)
    assert len({(r.level, r.name) for r in found}) == len(groups)
    assert exact_dedup.exact_classes(empty_documents(spark)).count() == 0


def test_names_across_partitions_of_one_block(spark):
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    more = spark.range(5000, 5100).select("id", F.concat(F.lit("same"), F.col("id")).alias("text"))
    found = exact_dedup.exact_classes(many.union(more).repartition(20), block_bytes=4)
    sizes = found.where("kept").groupBy("group_size").count().collect()
    assert {(r.group_size, r["count"]) for r in sizes} == {(5000, 1), (1, 100)}


def plain_sets(texts, words):
    out = []
    for t in texts:
        ws = (t or "").encode().lower().split()
        n = len(ws) - words + 1
        out.append({tuple(ws[i : i + words]) for i in range(max(n, 1))} if ws else set())
    return out


def plain_components(ids, sets, percent):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    pairs = {(a, b) for v in where.values() for i, a in enumerate(v) for b in v[i + 1 :]}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    least = defaultdict(list)
    for k in range(len(ids)):
        least[find(k)].append((ids[k] is None, ids[k]))
    return [min(least[find(k)], key=lambda p: (p[0], p[1] or 0))[1] for k in range(len(ids))]


def near_copies(seed, clusters, copies, edit):
    """Clusters in which copies are edited again and again: chains of links, and near misses."""
    rng, out = random.Random(seed), []
    passage = sentence(rng, 60)
    for _ in range(clusters):
        words = sentence(rng, rng.randint(40, 250)).split() + passage.split()
        for _ in range(copies):
            for _ in range(max(1, int(len(words) * edit * rng.choice([1, 2, 8])))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            out.append(" ".join(words))
    rng.shuffle(out)
    return [(i, t) for i, t in enumerate(out)]


@pytest.mark.parametrize("words,percent,edit", [(4, 85, 0.01), (5, 80, 0.02)])
def test_near_copies_against_all_pairs(spark, words, percent, edit, monkeypatch):
    monkeypatch.setattr(jaccard_join, "NODE_ROWS", 8)
    data = near_copies(4, 12, 25, edit)
    frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(4)
    found = jaccard_join.similar_components(frame, words=words, percent=percent).collect()
    sets = plain_sets([t for _, t in data], words)
    expected = plain_components([i for i, _ in data], sets, percent)
    got = {r.id: (r.n, r.component_id) for r in found}
    assert got == {i: (len(s), c) for (i, _), s, c in zip(data, sets, expected)}
    assert len({r.component_id for r in found}) > 12
    assert {r.keep_row for r in found if r.id == r.component_id} == {r.row for r in found if r.id == r.component_id}


def test_near_copies_edge_cases(spark):
    found = jaccard_join.similar_components(edge_documents(spark), words=4, percent=85).collect()
    data = [(r[0], r[1]) for r in rows()]
    sets = plain_sets([t for _, t in data], 4)
    expected = plain_components([i for i, _ in data], sets, 85)
    key = lambda r: tuple((x is None, x or 0) for x in r)
    got = sorted(((r.id, r.n, r.component_id) for r in found), key=key)
    assert got == sorted(((i, len(s), c) for (i, _), s, c in zip(data, sets, expected)), key=key)
    assert jaccard_join.similar_components(empty_documents(spark)).count() == 0


def test_tree_finds_what_all_pairs_find():
    data = near_copies(9, 15, 20, 0.01)
    sets = Shingler(4).sets([t for _, t in data])
    ids = list(range(len(sets)))
    links = jaccard_join.spanning_links(ids, ids, sets, 85)
    assert all(jaccard_join.linked(sets[a], sets[b], 85) for a, b in links)
    plain = plain_components(ids, plain_sets([t for _, t in data], 4), 85)
    assert len(links) == len(ids) - len(set(plain))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    links = spark.createDataFrame(chain, "a bigint, b bigint")
    got = {r.row: r.component for r in jaccard_join.components(links, "test").collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


@pytest.mark.parametrize("order", ["up", "random"])
def test_chains_take_few_rounds(spark, monkeypatch, order):
    ids = list(range(1000))
    if order == "random":
        random.Random(1).shuffle(ids)
    written, write = [], jaccard_join.materialise
    monkeypatch.setattr(jaccard_join, "materialise", lambda df, name: written.append(name) or write(df, name))
    links = spark.createDataFrame(list(zip(ids, ids[1:])), "a bigint, b bigint")
    got = {r.row: r.component for r in jaccard_join.components(links, "test").collect()}
    assert got == dict.fromkeys(ids, 0)
    assert written.count("test-edges") < 20


def check_packing(placed, texts, capacity):
    model = Tokenizer.from_file(TOKENIZER)
    by_row = defaultdict(list)
    by_sequence = defaultdict(list)
    for r in placed:
        by_row[r.row].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert len(by_row) == len(texts)
    got = []
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert all(p.length == capacity for p in pieces[1:])
        got.append((pieces[0].id or -1, sum(p.length for p in pieces), pieces[0].crc))
    expected = []
    for i, t in texts:
        ids = model.encode(t or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or min(len(ids), capacity)
        crc = zlib.crc32(np.array(ids[:first], "<u4").tobytes())
        expected.append((i or -1, len(ids), crc))
    assert sorted(got) == sorted(expected)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence), sum(r.length for r in placed)


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packing(spark, capacity):
    docs = edge_documents(spark)
    placed = packing.pack(docs, TOKENIZER, capacity=capacity).collect()
    used, total = check_packing(placed, [(r[0], r[1]) for r in rows()], capacity)
    assert used <= -(-total // capacity) * 1.25 + 1
    assert packing.pack(empty_documents(spark), TOKENIZER).count() == 0


def test_sequences_hold_the_tokens(spark):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(60)], "doc_id bigint, text string")
    docs = packing.materialise(docs, "words")
    placed = packing.materialise(packing.pack(docs, TOKENIZER, capacity=32), "placed")
    got = {r.sequence_id: r.ids for r in packing.sequences(docs, placed, TOKENIZER).collect()}
    for r in placed.collect():
        ids = np.array(got[r.sequence_id][r.offset : r.offset + r.length], "<u4")
        assert zlib.crc32(ids.tobytes()) == r.crc


def least_bins(lengths, capacity):
    """Optimal number of bins by exhaustive search."""
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= lengths[k]:
                rest = list(bins)
                rest[rest.index(room)] -= lengths[k]
                place(k + 1, rest)
        place(k + 1, [*bins, capacity - lengths[k]])

    place(0, [])
    return best


def test_plans_place_all_and_are_near_the_optimum():
    rng = random.Random(8)
    over = 0
    for _ in range(60):
        capacity = rng.choice([10, 20, 37])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 11))]
        counts = [lengths.count(n) for n in range(capacity + 1)]
        runs = packing.plan(counts)
        placed = [0] * (capacity + 1)
        for pattern, times in runs:
            assert sum(n * k for n, k in pattern) <= capacity
            for n, k in pattern:
                placed[n] += k * times
        assert placed == counts
        used, least = sum(t for _, t in runs), least_bins(lengths, capacity)
        assert packing.lower_bound(counts) <= least <= used
        over += used - least
    assert over <= 1
    assert packing.plan([0] * 11) == []


def pages(spark, data):
    schema = "page_id bigint, url string, html string, id string, digest string, bytes string"
    return spark.createDataFrame([(*r, None, None, None) for r in data], schema).repartition(3)


def plain_records(data, least):
    out, groups = [], defaultdict(list)
    for i, _, html in data:
        groups[html or ""].append(i)
    for html, ids in groups.items():
        best = max(ids, key=lambda i: (i is not None, i or 0))
        for k, i in enumerate(sorted(ids, key=lambda i: i != best)):
            visit = k > 0 and len(html.encode()) >= least
            digest = __import__("base64").b32encode(hashlib.sha1(html.encode()).digest()).decode()
            out.append((i or -1, len(html.encode()), digest, "revisit" if visit else "response", best if visit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_archives_round_trip(spark, least):
    html = "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>"
    data = [
        (1, "http://a/1", html),
        (2, "http://a/2", html),
        (3, None, "short"),
        (4, "bad\r\nurl: x", "short"),
        (5, "http://a/5", None),
        (6, "http://a/6", ""),
        (7, "http://a/7", "x" * 300_000),
        (7, "http://a/7", "x" * 300_000),
        (None, "http://a/8", html),
    ] + [(100 + i, f"http://b/{i}", f"copy {i % 3} of a page") for i in range(30)]
    path = new_path(spark, "warc-test")
    warc.write_archives(pages(spark, data), path, least_bytes=least, file_bytes=4000)
    read = warc.read_archives(spark, path)
    assert len(read.inputFiles()) > 1 or read.count() == len(data)
    full = warc.resolved(read).collect()
    got = [(r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in full]
    assert sorted(got, key=str) == plain_records(data, least)
    assert {bytes(r.payload) for r in full} == {(h or "").encode() for _, _, h in data}
    assert len({r.record_id for r in full}) == len(data)


def test_archives_of_nothing(spark):
    path = new_path(spark, "warc-empty")
    warc.write_archives(pages(spark, []), path)
    assert warc.resolved(warc.read_archives(spark, path)).count() == 0


def test_base32_digest(spark):
    import base64

    texts = ["", "a", "é" * 50]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in frame.select(warc.base32_sha1(F.col("t"))).collect()]
    assert got == [base64.b32encode(hashlib.sha1(t.encode()).digest()).decode() for t in texts]


def vectors(spark, data):
    return spark.createDataFrame(
        data, "vec_id bigint, embedding array<float>, id string, row string, key string, cell int"
    )


def test_nearest_on_few_rows_is_exact(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 6)).astype(np.float32) * rng.uniform(0.1, 3, size=(300, 1)).astype(np.float32)
    v[40] = v[41] = v[42]  # ties
    data = [(i, v[i].tolist(), None, None, None, None) for i in range(300)]
    bad = [None, [], [0.0] * 6, [float("nan")] * 6, [float("inf")] * 6, [None] * 6, [1.0] * 5]
    data += [(1000 + 20 * i, x, None, None, None, None) for i, x in enumerate(bad)]
    data += [(None, [1.0] * 6, None, None, None, None), data[7], data[20]]
    got = nearest.nearest(vectors(spark, data), k=5).collect()
    w = v.astype(float)
    expected = []
    for q in range(0, 300, 20):
        s = nearest.inner_products(np.repeat(w[q][None], 300, 0), w)
        order = [c for c in sorted(range(300), key=lambda c: (-s[c], c)) if c != q][:5]
        expected += [(q, k + 1, c, s[c]) for k, c in enumerate(order)]
    assert sorted(map(tuple, got)) == expected


def test_nearest_with_fewer_rows_than_asked(spark):
    data = [(i, [1.0, float(i)], None, None, None, None) for i in range(3)]
    got = nearest.nearest(vectors(spark, data)).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert nearest.nearest(vectors(spark, [])).count() == 0


def test_nearest_recall_with_narrow_windows(spark, small, monkeypatch):
    monkeypatch.setattr(nearest, "CELL", 32)
    table = spark.read.parquet(f"{small}/embeddings.parquet")
    found = nearest.nearest(table, share=0.06)
    rows_ = [(r.vec_id, r.embedding) for r in table.collect()]
    ids, v = np.array([r[0] for r in rows_]), np.array([r[1] for r in rows_], float)
    pairs = set()
    for q in np.flatnonzero(ids % 20 == 0):
        s = v @ v[q]
        s[q] = -np.inf
        pairs |= {(int(ids[q]), int(ids[c])) for c in np.argsort(-s, kind="stable")[:20]}
    got = {(r.query_id, r.vec_id) for r in found.collect()}
    assert len(got & pairs) / len(pairs) >= 0.9


def test_hilbert_curve_visits_neighbours():
    bits = 3
    grid = np.array([[a, b, c] for a in range(8) for b in range(8) for c in range(8)])
    keys = nearest.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(512))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()
