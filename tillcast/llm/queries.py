"""The registered queries of the operators, each over its whole table, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from tillcast.llm import (
    exact_dedup,
    filter_audit,
    jaccard_join,
    language_id,
    license_scan,
    nearest,
    packing,
    piece_encoding,
    secret_scan,
    simhash,
    spelling,
    token_counts,
    warc,
)
from tillcast.llm.frames import table
from tillcast.sources.shared import new_path


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"))
    return secret_scan.counts_and_digest(found)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.summary(license_scan.scan(table(spark, sf_dir, "documents")))


def op3_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_encoding.encode(table(spark, sf_dir, "documents"), model)
    return piece_encoding.digests(piece_encoding.decode(encoded, model))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), model)
    return counted.selectExpr("id AS doc_id", "n_words", "n_distinct", "n_tokens")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    placed = packing.pack(table(spark, sf_dir, "documents"), tokenizer)
    return placed.selectExpr(
        "id AS doc_id", "piece", "start", "length", "crc AS ids_crc32", "sequence_id", "offset"
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(table(spark, sf_dir, "documents")).selectExpr(
        "id AS doc_id", "keep_id", "group_size", "kept", "digest AS text_sha256"
    )


OP7_SQL = r"""
WITH bare AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
  FROM documents
), ranked AS (
  SELECT doc_id, bare,
         row_number() OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS place,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM bare
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM ranked
"""


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path, stored=True)
    return warc.resolved(warc.read_archives(spark, path)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"))
    return found.selectExpr("id AS doc_id", "held_out", "lang_pred", "score")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = jaccard_join.similar_components(docs, words=4, percent=85, stored=True)
    return found.selectExpr("id AS doc_id", "n AS n_shingles", "component_id")


OP10_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS i
        FROM worded WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles,
       min(r.other) AS component_id
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id
GROUP BY r.doc_id
"""


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.selectExpr("id AS doc_id", "fingerprint", "component_id")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return filter_audit.audit(docs, labels, stored=True)


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents
), worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts
), least AS (
  SELECT text, min(doc_id) AS least FROM texts GROUP BY text
), failing AS (
  SELECT w.doc_id, w.part,
         len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * (length(w.text) - length(regexp_replace(w.text, '[A-Z]', '', 'g')))
           > 3 * length(w.text) AS c,
         regexp_matches(w.text, '[#$%&*|]') AS d,
         coalesce(least.least < w.doc_id, false) AS e
  FROM worded w JOIN least ON least.text = w.text
), lettered AS (
  SELECT *, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
    || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END)
    || (CASE WHEN e THEN 'E' ELSE '' END) AS fails
  FROM failing
), labelled AS (
  SELECT part, fails,
    coalesce((SELECT max(quality = 1) FROM labels l WHERE l.doc_id = x.doc_id), false) AS good,
    coalesce((SELECT max(toxic = 1) FROM labels l WHERE l.doc_id = x.doc_id), false) AS toxic
  FROM lettered x
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x)
    AND r.x NOT IN (s.x, t.x) AND s.x <> t.x
), counted AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good,
         count(*) FILTER (toxic) AS toxic
  FROM labelled GROUP BY part, fails
), placed AS (
  SELECT part, filter_order, step, fails, n, good, toxic,
         contains(fails, substr(filter_order, step, 1)) AS here,
         regexp_replace(left(filter_order, step - 1), '[^_' || fails || ']', '', 'g') <> '' AS before
  FROM counted, orders, (SELECT unnest(range(1, 6))::INTEGER AS step)
), stepped AS (
  SELECT part, filter_order, step,
    CAST(coalesce(sum(n) FILTER (NOT here AND NOT before), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (here AND NOT before), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (here AND before), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (here AND length(fails) = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(good) FILTER (here AND NOT before), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(toxic) FILTER (here AND NOT before), 0) AS BIGINT) AS toxic_lost
  FROM placed GROUP BY part, filter_order, step
), summed AS (
  SELECT part, substr(filter_order, step, 1) AS letter, CAST(sum(removed) AS BIGINT) AS shapley
  FROM stepped GROUP BY 1, 2
)
SELECT s.*, shapley
FROM stepped s JOIN summed t ON t.part = s.part AND t.letter = substr(filter_order, step, 1)
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def _base32(hexadecimal: str) -> str:
    """SQL for 40 hexadecimal digits in base32: 5 of them are 4 of the other."""
    digits = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    groups = []
    for at in range(1, 41, 5):
        value = f"CAST('0x' || substr({hexadecimal}, {at}, 5) AS BIGINT)"
        groups += [f"substr({digits}, ({value} // {32**k}) % 32 + 1, 1)" for k in (3, 2, 1, 0)]
    return " || ".join(groups)


OP8_SQL = f"""
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha
  FROM pages
), ranked AS (
  SELECT *, max(page_id) OVER (PARTITION BY sha, payload_bytes) AS original FROM hashed
)
SELECT page_id, payload_bytes, {_base32("sha")} AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM ranked
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_license_scan": op2_license_scan,
    "op3_piece_encoding": op3_piece_encoding,
    "op4_token_counts": op4_token_counts,
    "op5_packing": op5_packing,
    "op6_nearest": op6_nearest,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_warc": op8_warc,
    "op9_language_id": op9_language_id,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_simhash": op11_simhash,
    "op12_filter_audit": op12_filter_audit,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {
    "op7_exact_dedup": OP7_SQL,
    "op8_warc": OP8_SQL,
    "op10_jaccard_join": OP10_SQL,
    "op12_filter_audit": OP12_SQL,
}
