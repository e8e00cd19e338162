"""Secrets, licenses, pieces, token counts and languages against plain versions."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tests.llm.cases import edge_documents, empty_documents, rows, sentence
from tillcast.llm import language_id, license_scan, piece_encoding, secret_scan, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)


def plain_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [
        (m.start(), 1, m.end(), "access")
        for m in re.finditer("AKIA[A-Z0-9]+", text)
        if len(m[0]) >= 16
    ]
    spans += [
        (m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32
    ]
    return sorted(spans)


def test_secrets_with_a_pattern(spark):
    found = secret_scan.find_secrets(edge_documents(spark)).collect()
    assert len(found) == len(rows())
    texts = {}
    for r in rows():
        texts.setdefault(r[0], []).append(r[1])
    for r in found:
        expected = [plain_spans(t) for t in texts[r.id]]
        assert [tuple(s) for s in r.base] in expected
        assert set(r.base) <= set(r.spans)
    got = secret_scan.counts_and_digest(secret_scan.find_secrets(edge_documents(spark)))
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[12].n_assign == 1 and by_id[12].n_hex == 1
    assert by_id[13].n_access == 1 and by_id[13].n_assign == 1
    assert by_id[2].base_sha256 == hashlib.sha256(b"").hexdigest() and by_id[2].spans == ""
    assert secret_scan.find_secrets(empty_documents(spark)).count() == 0


def test_many_matches_and_overlaps_in_one_text(spark):
    rng = random.Random(5)
    parts = ["token=abcdefgh1", "secret: token: abcdefghi", "AKIA" + "A1" * 8, "ab" * 20, "é", "x"]
    text = " ".join(rng.choice(parts) for _ in range(1500))
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got = secret_scan.find_secrets(frame).first()
    assert [tuple(s) for s in got.base] == plain_spans(text)


def test_random_runs_are_found_and_words_are_left(spark):
    rng = random.Random(11)
    letters = secret_scan.ENCODINGS["base62"]
    keys = ["".join(rng.choice(letters) for _ in range(32)) for _ in range(20)]
    long_words = ["".join(sentence(rng, 6).split()) for _ in range(400)]
    data = [(i, f"see {k} here") for i, k in enumerate(keys)]
    data += [(1000 + i, f"ein {w} und /usr/lib/{w}") for i, w in enumerate(long_words)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string")
    found = {r.id: r.spans for r in secret_scan.find_secrets(frame).collect()}
    assert sum(bool(found[i]) for i in range(20)) >= 19
    assert not any(found[1000 + i] for i in range(len(long_words)))
    span = next(s for i in range(20) for s in found[i])
    assert span.kind == "random" and span.start == 4 and span.end == 36


def plain_randomness(token):
    symbols = re.sub("[^A-Za-z0-9]", "", token)
    alphabet = next(a for a in secret_scan.ENCODINGS.values() if set(symbols) <= set(a))
    n, k = len(symbols), len(alphabet)
    v = np.array([alphabet.index(c) + 1 for c in symbols], float)
    counts = np.array([symbols.count(c) for c in set(symbols)], float)
    uniform = (k / n * (counts**2).sum() - n - (k - 1) - n * 0.5) / np.sqrt(2 * (k - 1) + 2 * n)
    kinds = ["0" if c.isdigit() else "a" if c.islower() else "A" for c in symbols]
    moves = sum(a != b for a, b in zip(kinds, kinds[1:]))
    moved = (moves - (n - 1) * 0.15 - 0.5) / np.sqrt((n - 1) * 0.15 * 0.85)
    d = v - v.mean()
    spread = (d * d).sum()
    correlated = ((d[:-1] * d[1:]).sum() / spread if spread else 1.0) - 0.3
    correlated *= np.sqrt(n)
    sounds = ["0" if c.isdigit() else "v" if c.lower() in "aeiouy" else "c" for c in symbols]
    pairs = [(a, b) for a, b in zip(sounds, sounds[1:]) if "0" not in (a, b)]
    turns = sum(a != b for a, b in pairs)
    spoken = (0.6 * len(pairs) - turns - 0.5) / np.sqrt(0.24 * len(pairs)) if pairs else 0.0
    name = next(k for k, a in secret_scan.ENCODINGS.items() if set(symbols) <= set(a))
    if name == "decimal":
        return -np.inf
    if name in ("hex", "HEX"):
        return (moved - uniform - correlated) / np.sqrt(3)
    if name in ("lower", "upper"):
        return (spoken - uniform) / np.sqrt(2)
    if name in ("base32", "base36", "BASE36"):
        return (moved - uniform - correlated + spoken) / 2
    return (min(moved, 2) - uniform + min(-correlated, 2) + 1.5 * spoken) / np.sqrt(5.25)


def test_battery_against_plain_statistics(spark):
    from statistics import NormalDist

    tokens = ["0641917ea4e9feb9cda83477", "kQzLw2XpRt8VbNm6dfre", "a" * 20, "QWERTY-234567_abcdef"]
    tokens += ["QXZJKWVBNMPLFGHTRDSC", "theriverandthehouse", "ABCD2345EFGH6723WXYZ", "x1y2z3a4b5c6d7e8f9", "12345678901234567890"]
    frame = spark.createDataFrame([(t,) for t in tokens], "run string")
    got = {r.run: r.evidence for r in secret_scan.randomness(frame, "run").collect()}
    for t in tokens:
        z = plain_randomness(t)
        expected = 0.0 if z == -np.inf else -np.log10(NormalDist().cdf(-min(30, max(-8, z))))
        assert got[t] == pytest.approx(expected, abs=1e-3, rel=1e-2)


def test_random_runs_of_every_encoding_and_plain_ones(spark):
    rng = random.Random(5)
    data = [
        (name, "".join(rng.choice(letters) for _ in range(32)))
        for name, letters in secret_scan.ENCODINGS.items()
        for _ in range(300)
    ]
    words = "river stone light house paper cloud north letter winter garden people number water".split()
    shapes = {
        "joined": "".join, "path": "/".join, "snake": "_".join,
        "camel": lambda ws: "".join(w.title() for w in ws),
        "numbered": lambda ws: "".join(ws) + str(rng.randint(0, 9999)),
        "digits": lambda ws: "".join(str(rng.randint(0, 9)) for _ in range(30)),
    }
    data += [(name, shape(rng.choices(words, k=5))) for name, shape in shapes.items() for _ in range(300)]
    frame = spark.createDataFrame(data, "kind string, run string")
    sure = (F.col("evidence") >= 2).cast("double")
    share = {r.kind: r["share"] for r in secret_scan.randomness(frame, "run").groupBy("kind").agg(F.avg(sure).alias("share")).collect()}
    assert share["decimal"] == 0
    assert all(share[k] >= 0.9 for k in ("hex", "HEX", "base36", "BASE36"))
    assert all(share[k] >= 0.8 for k in ("base32", "base62"))
    assert all(share[k] >= 0.65 for k in ("lower", "upper"))
    assert all(share[k] <= 0.01 for k in shapes if k != "camel") and share["camel"] <= 0.03


def test_discoveries_against_a_plain_procedure(spark):
    rng = random.Random(6)
    rows_ = []
    for k in range(400):
        evidence = rng.choice([rng.random(), rng.random() * 8])
        one = (f"r{k}", rng.choice(["hex", "base62"]), rng.randint(20, 90), evidence)
        rows_ += [one] * rng.choice([1, 1, 1, 30])
    frame = spark.createDataFrame(rows_, "run string, encoding string, n int, evidence double").repartition(4)
    for rate in (0.01, 0.1):
        expected = []
        strata = {(e, n.bit_length()) for _, e, n, _ in rows_}
        for stratum in strata:
            tests = {r: int(v * 20) for r, e, n, v in rows_ if (e, n.bit_length()) == stratum}
            steps = sorted(tests.values(), reverse=True)
            good = [s for s in steps if 10 ** (-s / 20) <= rate * sum(x >= s for x in steps) / len(steps)]
            if good:
                expected += [r for r, e, n, v in rows_ if r in tests and tests[r] >= min(good)]
        got = [r.run for r in secret_scan.discoveries(frame, rate).collect()]
        assert sorted(got) == sorted(expected) and expected


def test_redaction_keeps_rows_and_columns(spark):
    docs = edge_documents(spark)
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    texts = {r.doc_id: r.text for r in out.where("doc_id IN (1, 2, 12, 13, 14)").collect()}
    assert texts[1] is None and texts[2] == ""
    assert texts[12] == 'x [assign]" y'
    assert texts[13] == "key [access] and password: short and [assign]"
    assert texts[14] == next(r[1] for r in rows() if r[0] == 14)


def plain_detections(lowered):
    found = []
    for order, rule in enumerate(license_scan.rules()):
        for m in re.finditer(rule.pattern, lowered):
            assert rule.keyword in m[0] or rule.keyword in lowered
            found.append((-rule.priority, -(m.end() - m.start()), m.start(), order, m.end(), rule))
    kept = []
    for f in sorted(found, key=lambda f: f[:4]):
        if not any(k[2] <= f[2] and f[4] <= k[4] for k in kept):
            kept.append(f)
    kept.sort(key=lambda f: (f[2], f[4], f[3]))
    return [(f[5].name, f[5].label, -f[0], f[2], f[4]) for f in kept]


def test_license_rules_against_all_rules_without_prefilter():
    assert len(license_scan.rules()) >= 300
    scanner = license_scan.Scanner()
    rng = random.Random(2)
    parts = [
        "licensed under the gnu general public license, version 3",
        "spdx-license-identifier: mpl-2.0",
        "the mit license",
        "http://www.apache.org/licenses/license-2.0",
        "apache license 2.0",
        "creative commons attribution-noncommercial-sharealike 4.0",
        "copyright (c) 2020 x, all rights reserved",
        "license: bsd-3-clause",
        "permission is hereby granted, free of charge",
        "plain words",
    ]
    for _ in range(60):
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert scanner.detections(text) == plain_detections(text)


def test_license_words_and_summary(spark):
    scanned = license_scan.scan(edge_documents(spark))
    assert scanned.count() == len(rows())
    out = {r.doc_id: r for r in license_scan.summary(scanned).collect()}
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    for i, text in [(r[0], r[1]) for r in rows() if r[0]]:
        words = word.findall(license_scan.lower_ascii(text or ""))
        places = [
            k
            for p in license_scan.PHRASES
            for k in range(len(words))
            if words[k : k + len(p.split())] == p.split()
        ]
        got = out[i]
        assert (got.n_words, got.n_base) == (len(words), len(places))
        assert got.first_word == (min(places) if places else None)
        assert got.last_word == (max(places) if places else None)
        assert 0 <= got.score <= 1
    assert out[14].base_labels == "cc-by,reserved" and "Apache-2.0" in out[14].labels
    assert license_scan.scan(empty_documents(spark)).count() == 0


def test_pieces_as_the_library_gives_them(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    alphabet = list("ab  \n\t.,é▁ß中\x00") + ["the ", "  ", "</s>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    flat, ends = piece_encoding.PieceEncoder(MODEL, limit=500).ids(pa.array(texts))
    assert [x.tolist() for x in np.split(flat, ends[:-1])] == [library.encode(t) for t in texts]
    coded = piece_encoding.decode(piece_encoding.encode(edge_documents(spark), MODEL), MODEL)
    got = sorted((r.id or -1, r.ids, r.decoded) for r in coded.collect())
    ids = [(r[0] or -1, library.encode(r[1] or "", add_eos=True)) for r in rows()]
    assert got == sorted((i, x, library.decode(x)) for i, x in ids)
    assert piece_encoding.encode(empty_documents(spark), MODEL).count() == 0


def test_token_counts_against_each_word_alone(spark):
    vocabulary = token_counts.UnigramVocabulary.from_sentencepiece(MODEL)
    got = token_counts.token_counts(edge_documents(spark), MODEL, limit=50).collect()
    assert len(got) == len(rows())
    known = {}

    def tokens(word):
        if word not in known:
            known[word] = token_counts.brute_force_count(word, vocabulary)
        return known[word]

    expected = []
    for r in rows():
        words = token_counts.pre_tokens(r[1] or "")
        expected.append((r[0] or -1, len(words), len(set(words)), sum(map(tokens, words))))
    found = [(r.id or -1, r.n_words, r.n_distinct, r.n_tokens) for r in got]
    assert sorted(found) == sorted(expected)
    assert token_counts.token_counts(empty_documents(spark), MODEL).count() == 0


def test_languages_of_held_out_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = language_id.identify(docs).join(docs, F.col("id") == F.col("doc_id"))
    held = found.where("held_out").select("lang", "lang_pred", "score").collect()
    assert len(held) > 20
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in held)


def test_languages_edge_cases(spark):
    docs = edge_documents(spark)
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows())
    by_id = {r.id: r for r in got}
    for i in (1, 2, 3, 16):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert by_id[8].lang_pred in ("en", "de")
    assert language_id.identify(empty_documents(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(unlabelled).collect()} == {"und"}


def test_unseen_words_back_off_to_shorter_grams():
    from collections import Counter

    words = Counter({("a", "known"): 5, ("b", "other"): 5})
    grams = Counter({("a", "<kn"): 3, ("a", "x"): 2, ("b", "y"): 4})
    model = language_id.LanguageModel.of(["a", "b"], words, grams)
    judge = language_id.Identifier(model)
    assert [x[0] for x in judge.identify(["known", "knot", "y", "zzz", ""])] == ["a", "a", "b", "a", "und"]
    assert judge.identify(["zzz"])[0][1] == 0.5
