"""Documents to packed training sequences, in five stages.

Each stage gets the documents that the one before kept, written as Parquet and read again, and
returns them with the columns they came with; the last returns the packed pieces.

Every stage reads whole texts, however long, keeps columns it doesn't know whatever their names, and gives an
empty table for an empty one. What a null text or id, ties and repeated rows give is said below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tillcast.llm import exact_dedup, jaccard_join, language_id, packing, secret_scan
from tillcast.llm.frames import fresh, materialise, numbered, table, without


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language can be told: without a text or without a letter.

    A low score alone is no reason to drop: short clean documents have one too, and so have all
    where no row has a label to learn from. Null, empty and letterless texts go; rows without an id are
    judged by their text, and repeated rows alike.
    """
    key = fresh(docs, "row_key")
    docs = numbered(docs, key, stored=True)
    found = language_id.identify(docs, row_col=key)
    return without(docs, found.where("NOT lettered"), key)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of the documents whose texts are equal apart from white space.

    That is the one with the most code points, then the smallest id; a null id comes after all others,
    and of rows given twice one stays. A null text counts as empty.
    """
    key = fresh(docs, "row_key")
    docs = numbered(docs, key, stored=True)
    return without(docs, exact_dedup.exact_classes(docs, row_col=key).where("NOT kept"), key)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of each group that similar texts connect: five words, similarity of 0.8.

    That is the row of the group's smallest id; a null id comes after all others, and of rows given
    twice one stays. Texts without words, null ones too, are linked with nothing and all stay.
    """
    key = fresh(docs, "row_key")
    docs = numbered(docs, key, stored=True)
    found = jaccard_join.similar_components(docs, words=5, percent=80, row_col=key)
    return without(docs, found.where("row <> keep_row"), key)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by their kinds; drops nothing. ``n_chars`` follows.

    Null texts stay null. Of secrets that overlap the stretch that they cover is replaced once.
    Repeated rows and rows without an id are treated alike.
    """
    before = fresh(docs, "length_before")
    redacted = secret_scan.redact(docs.withColumn(before, F.length("text")), stored=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        length = F.length("text").cast(kind)
        changed = F.length("text") != F.col(before)
        redacted = redacted.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return redacted.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens.

    A null or empty text is its end id alone. Repeated rows are packed each, a null id stays null.
    """
    placed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return placed.selectExpr(
        "id AS doc_id", "piece", "start", "length", "crc AS ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Models, sets of n-grams and token ids are beyond SQL; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
