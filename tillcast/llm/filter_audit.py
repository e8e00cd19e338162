"""Audit of filters that are applied one after another: what each order removes, and why.

Every document gets one letter for each filter that it fails. Four filters are expressions of the
text; the fifth, a copy of a document with a smaller id, is an existential self-join: a left-semi
join on hash, exact text and smaller id. The ids of all failures are united and added up to one
combination for each document, the combinations are counted by part, and all orders of the
filters are read off these counts, of which there are at most 32 for each part.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.frames import fresh, keyed_texts, materialise, numbered, picked
from tillcast.llm.links import hot_keys, looked_up

FILTERS = "ABCDE"
COPY = FILTERS.index("E")
_SPACE = r"[\x20\x09-\x0D]+"


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails A (few words), B (repeated words), C (capitals), D (symbols)."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    points = F.length(text)
    capitals = points - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [
        n < 200,
        100 * distinct < 50 * n,
        100 * capitals > 3 * points,
        text.rlike(r"[#$%&*|]"),
    ]


def copies(texts: DataFrame, keys: DataFrame, hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``row`` of every text that some row with a smaller id has too.

    ``texts`` has ``row, id, text``, ``keys`` its ``row, id, hash`` in a written table. Rows with
    the smallest id of their hash are the right side of the semi-join, so that a hash brings as
    many texts there as rows share that id, however many copies there are. Rows of other texts
    with that hash are left over and are joined again, without those, until none is left: equal
    texts have equal hashes, so they stay together. Hot hashes are salted. Rows without an id
    have no smaller id and are none.
    """
    left, found = keys.where(F.col("id").isNotNull()), []
    while True:
        ranges = left.groupBy("hash").agg(F.min("id").alias("least"), F.max("id").alias("most"))
        repeated = materialise(ranges.where("least < most").select("hash", "least"), "hashes")
        members = materialise(looked_up(left, repeated, "hash"), "members")
        if members.isEmpty():
            break
        total = members.count()
        hot = hot_keys(members, "hash", total)
        holders = texts.select("row", "id", "text", hash_of(F.col("text")).alias("hash"))
        first = picked(holders, members.where("id = least").select("row"), "left_semi")
        rest = picked(holders, members.where("id > least").select("row"), "left_semi")
        salt = every = F.lit(0)
        if hot is not None:
            # One salt for each thousandth of the rows.
            share = hot.select("hash", F.ceil(F.col("n") * 1000 / total).cast("int").alias("salts"))
            share = F.broadcast(share)
            first = first.join(share, "hash", "left").fillna(1, ["salts"])
            rest = rest.join(share, "hash", "left").fillna(1, ["salts"])
            every = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
            salt = F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")
        first = first.select("hash", "text", "id", every.alias("salt"))
        first = first.groupBy("hash", "salt", "text").agg(F.min("id").alias("smaller"))
        rest = rest.select("row", "id", "hash", "text", salt.alias("salt"))
        marked = rest.join(
            first,
            (rest["hash"] == first["hash"])
            & (rest["salt"] == first["salt"])
            & (rest["text"] == first["text"])
            & (first["smaller"] < rest["id"]),
            "left_semi",
        ).select("row")
        marked = materialise(marked, "copies")
        found.append(marked)
        others = members.where("id > least").drop("least")
        if marked.count() == others.count():
            break
        left = materialise(others.join(marked, "row", "left_anti"), "left-over")
    if not found:
        return keys.select("row").limit(0)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def failures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    stored: bool = False,
    hash_of: Callable[[Column], Column] = F.xxhash64,
) -> tuple[DataFrame, DataFrame]:
    """Failing documents, ``row, id, part, failed`` (a letter's bit is 1 shifted by its place),
    and ``part, n`` of all documents, both written.

    Null texts count as empty, null parts as the empty string. See ``frames.numbered`` for
    ``stored``. Repeated rows are documents of their own; an empty table gives no rows.
    """
    docs = docs.select(id_col, text_col, part_col)
    key = fresh(docs, "text_row")
    docs = numbered(docs, key, stored)
    texts = keyed_texts(docs, id_col, text_col, key)
    part = F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = sum(F.when(c, F.lit(1 << k)).otherwise(0) for k, c in enumerate(text_failures(text)))
    marks = docs.select(
        F.col(key).alias("row"), F.col(id_col).alias("id"), part, hash_of(text).alias("hash"),
        bits.cast("int").alias("failed"),
    )
    marks = materialise(marks, "marks")
    copied = copies(texts, marks.select("row", "id", "hash"), hash_of)
    bad = marks.where("failed <> 0").select("row", "failed").unionByName(
        copied.select("row", F.lit(1 << COPY).alias("failed"))
    )
    bad = bad.groupBy("row").agg(F.sum("failed").cast("int").alias("failed"))
    failing = marks.drop("failed", "hash").join(bad, "row")
    return materialise(failing, "failing"), materialise(
        marks.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "parts"
    )


def combinations(failing: DataFrame, parts: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, failed, n, good, toxic``: documents by part and combination, none failing included.

    ``labels`` has ``doc_id, quality, toxic``; an id labelled more than once is good, or toxic, if
    any of its rows says so.
    """
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
    )
    # Counted before the join, so that an id with many rows is one row there.
    counted = failing.groupBy("id", "part", "failed").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.join(known, "id", "left").fillna(0, ["good", "toxic"])
    bad = counted.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )
    bad = materialise(bad, "combinations")
    clean = parts.join(
        bad.groupBy("part").agg(F.sum("n").alias("bad")), "part", "left"
    ).selectExpr("part", "0 AS failed", "n - coalesce(bad, 0) AS n", "0L AS good", "0L AS toxic")
    return bad.unionByName(clean)


def orders(counts: DataFrame) -> DataFrame:
    """Every order of the filters, step by step, from the counted combinations.

    One row for each ``part, filter_order, step``; see ``audit`` for the columns.
    """
    every = F.array(*[F.lit("".join(p)) for p in permutations(FILTERS)])
    flags = F.concat(
        *[F.when(F.col("failed").bitwiseAND(1 << k) != 0, "1").otherwise("0") for k in range(5)]
    )
    dealt = counts.withColumn("flags", flags).withColumn("filter_order", F.explode(every))
    # The flags in the order in which the filters come, and the first one that fails.
    placed = dealt.withColumn("ordered", F.expr(f"translate(filter_order, '{FILTERS}', flags)"))
    placed = placed.withColumns(
        {
            "removed_at": F.instr("ordered", "1"),
            "failing": F.length(F.translate("flags", "0", "")),
            "step": F.explode(F.sequence(F.lit(1), F.lit(5))),
        }
    )
    fails = F.expr("substring(ordered, step, 1) = '1'")
    here = F.col("removed_at") == F.col("step")
    earlier = F.col("removed_at") < F.col("step")
    among = lambda condition, column="n": F.sum(F.when(condition, F.col(column)).otherwise(0))
    share = F.expr(f"n * {len(list(permutations(FILTERS)))} div greatest(failing, 1)")
    return placed.groupBy("part", "filter_order", "step").agg(
        among((F.col("removed_at") == 0) | (F.col("removed_at") > F.col("step"))).alias("kept"),
        among(here).alias("removed"),
        among(fails & earlier).alias("redundant"),
        among(fails & (F.col("failing") == 1)).alias("unique_fails"),
        among(here, "good").alias("good_lost"),
        among(here, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).alias("shapley"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    stored: bool = False,
) -> DataFrame:
    """One row for each part, order of the five filters and step: ``part, filter_order, step,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``, all counts of
    documents of the part.

    ``kept`` are left after the step, ``removed`` go in it, ``redundant`` fail its filter but went
    before, ``unique_fails`` fail no other filter, ``good_lost`` and ``toxic_lost`` are labelled
    and removed here. ``shapley`` is what the filter removes summed over all 120 orders: of a
    document that fails k filters each is first in 120 / k.

    Null texts count as empty and null parts as the empty string; a null id is neither a copy nor
    the original of one. Whole texts are read, however long. Repeated rows count each, and as
    their ids are equal none is a copy of the other. An empty table gives no rows.
    """
    failing, parts = failures(docs, id_col, text_col, part_col, stored)
    return orders(combinations(failing, parts, labels))
