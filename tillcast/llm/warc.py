"""Web archives of pages: writing with repeated payloads as revisits, reading, and resolving.

Only headers (digest, size, id, address) are shuffled to find the pages with equal payloads.
Pages that repeat a payload become revisit records, which carry no payload, so payloads go from
the table to the archive without a shuffle.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.frames import fresh, materialise, numbered

#: Revisits up to this number (16 MB of keys) are broadcast to leave their pages out of the
#: responses; beyond it the same anti-join shuffles.
BROADCAST_ROWS = 1_000_000

_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in bare upper-case base32: 60 bits are 15 hexadecimal and 12 base32 digits."""
    sha = F.sha1(payload)

    def digits(at: int, n: int) -> Column:
        return F.lpad(F.conv(F.substring(sha, at, n), 16, 32), n * 4 // 5, "0")

    return F.translate(
        F.concat(digits(1, 15), digits(16, 15), digits(31, 10)),
        "0123456789ABCDEFGHIJKLMNOPQRSTUV",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    )


def _record_id(row: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws(":", row.cast("string"), digest))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value. Control characters would end the line early."""
    clean = F.regexp_replace(value.cast("string"), r"[\x00-\x1F\x7F]", " ")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")), F.lit(""))


def _record(kind: str, date: str, block: Column, more: list[Column]) -> Column:
    return F.concat(
        F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: {date}\r\n"),
        _line("WARC-Record-ID", _record_id(F.col("row"), F.col("digest"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("Page-ID", F.col("id")),
        *more,
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    file_bytes: int = 16 << 20,
    stored: bool = False,
) -> None:
    """Write one record for each row to the folder ``path``.

    Of rows with equal payloads of at least ``least_bytes`` bytes the one with the largest id is
    a response, the others revisit it; of a row given twice the first is the response. A null
    payload is an empty one, a null id or address leaves its header line out, an empty table
    gives no record. Files hold about ``file_bytes`` bytes. ``stored`` spares writing the input
    where it comes straight from Parquet files.
    """
    pages = pages.select(id_col, url_col, payload_col)
    key = fresh(pages, "page_row")
    source = numbered(pages, key, stored).select(
        F.col(key).alias("row"),
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    )
    described = source.select(
        "*",
        F.octet_length("payload").cast("long").alias("bytes"),
        base32_sha1(F.col("payload")).alias("digest"),
    )
    headers = materialise(described.drop("payload"), "warc-headers")
    groups = (
        headers.where(F.col("bytes") >= least_bytes)
        .groupBy("digest", "bytes")
        .agg(
            F.max(F.struct("id", (-F.col("row")).alias("first"), "url")).alias("original"),
            F.count(F.lit(1)).alias("copies"),
        )
        .where("copies > 1")
        .select(
            "digest",
            "bytes",
            (-F.col("original.first")).alias("original_row"),
            F.col("original.id").alias("original_id"),
            F.col("original.url").alias("original_url"),
        )
    )
    revisits = materialise(
        headers.join(groups, ["digest", "bytes"]).where("row <> original_row"), "warc-revisits"
    )
    sizes = headers.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    keys = revisits.select("row")
    if revisits.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    status = F.concat(F.lit(_HTTP), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    responses = described.join(keys, "row", "left_anti").select(
        _record("response", date, F.concat(status, F.col("payload")), []).alias("value")
    )
    references = revisits.select(
        _record(
            "revisit",
            date,
            status,
            [
                F.lit(f"WARC-Profile: {_PROFILE}\r\n"),
                _line("WARC-Refers-To", _record_id(F.col("original_row"), F.col("digest"))),
                _line("WARC-Refers-To-Target-URI", F.col("original_url")),
            ],
        ).alias("value")
    )
    mean = (sizes[1] or 0) / max(sizes[0], 1) + 1000
    # A record ends with two line ends: the separator of the text files.
    responses.unionByName(references).write.option("lineSep", "\r\n\r\n").option(
        "maxRecordsPerFile", max(1, int(file_bytes / mean))
    ).text(path)


RECORD = (
    "record_id string, record_type string, date string, url string, page_id bigint, "
    "payload_digest string, payload_bytes bigint, refers_to_record string, payload binary"
)


def _records(content: bytes) -> Iterator[tuple]:
    at = 0
    while at < len(content):
        head_end = content.index(b"\r\n\r\n", at)
        lines = content[at:head_end].decode().split("\r\n")[1:]
        head = dict(x.split(": ", 1) for x in lines)
        start = head_end + 4
        block = content[start : start + int(head["Content-Length"])]
        at = start + len(block) + 4
        response = head["WARC-Type"] == "response"
        payload = block[block.index(b"\r\n\r\n") + 4 :] if response else None
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if response:  # what was read, not what the header says
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        yield (
            head["WARC-Record-ID"],
            head["WARC-Type"],
            head["WARC-Date"],
            head.get("WARC-Target-URI"),
            int(head["Page-ID"]) if "Page-ID" in head else None,
            digest,
            len(payload) if response else None,
            head.get("WARC-Refers-To"),
            payload,
        )


def _parsed(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
        )

    for files in batches:
        for content in files.column(0):
            rows = []
            for record in _records(content.as_py()):
                rows.append(record)
                if len(rows) == 500:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives in ``path``; revisits have no payload yet."""
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, types[t]) for n, t in (c.split() for c in RECORD.split(", "))])
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(lambda b: _parsed(b, schema), RECORD)


def resolved(records: DataFrame) -> DataFrame:
    """Records with ``refers_to`` (page id of a revisit's response) and every full payload.

    Headers meet by digest and record id; a revisit whose response is missing keeps nulls.
    """
    originals = records.where("record_type = 'response'").select(
        "payload_digest",
        F.col("record_id").alias("refers_to_record"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("original_bytes"),
        F.col("payload").alias("original_payload"),
    )
    found = records.where("record_type = 'revisit'").join(
        originals, ["payload_digest", "refers_to_record"], "left"
    )
    revisits = found.withColumn("payload", F.col("original_payload")).withColumn(
        "payload_bytes", F.col("original_bytes")
    )
    responses = records.where("record_type = 'response'").withColumn(
        "refers_to", F.lit(None).cast("bigint")
    )
    return responses.unionByName(revisits.drop("original_payload", "original_bytes"))
