"""Helpers shared by the operators: row keys, input columns, written tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.sources.shared import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` already has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """A key of the input row, since ids may be null or repeated."""
    return df.withColumn(name, F.monotonically_increasing_id())


def discard(*written: DataFrame) -> None:
    """Delete tables that ``materialise`` wrote, once nothing that is still to run reads them."""
    for df in written:
        context = df.sparkSession.sparkContext
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


#: Bits of a key for the place of a row in its file; the others number the files.
_PLACE_BITS = 40
#: Logical plans that read one set of files and repeat no row.
_STRAIGHT = {"Project", "Filter", "SubqueryAlias", "LogicalRelation"}


def place_key(df: DataFrame, name: str) -> DataFrame | None:
    """``df`` with the key ``name``: the number of the row's file, by path, and its place there.

    The key depends on the files alone, not on how a scan is split. None where there is no such
    key: ``df`` is more than columns and filters over Parquet files, or reads a file twice.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.children().size() == 1 and plan.getClass().getSimpleName() in _STRAIGHT:
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    path, number = fresh(df, "file_path"), fresh(df, "file_number")
    try:
        place = df.metadataColumn("_metadata")
        placed = df.select("*", place["file_path"].alias(path), place["row_index"].alias(name))
    except AnalysisException:  # other formats do not number the rows of a file
        return None
    files = placed.groupBy(path).agg(F.count(F.lit(1)).alias("n"), F.max(name).alias("last"))
    files = sorted(files.collect())  # a row for each file, as many as the driver lists anyway
    if any(n > last + 1 for _, n, last in files):
        return None
    numbers = df.sparkSession.createDataFrame(
        [(f[0], k) for k, f in enumerate(files)], f"{path} string, {number} bigint"
    )
    key = F.shiftleft(number, _PLACE_BITS).bitwiseOR(F.col(name))
    return placed.join(F.broadcast(numbers), path).select(*df.columns, key.alias(name))


def numbered(df: DataFrame, name: str, stored: bool) -> DataFrame:
    """``df`` with a key ``name`` that is the same in every scan, for operators that read it more
    than once by row keys.

    ``stored`` spares writing ``df`` where it comes straight from Parquet files, whose rows have
    fixed places. Anything else is numbered once and written with its numbers: rows numbered as
    they are read get other numbers whenever a scan is split in another way.
    """
    keyed = place_key(df, name) if stored else None
    return materialise(with_row_key(df, name), "input") if keyed is None else keyed


def keyed_texts(
    docs: DataFrame, id_col: str, text_col: str, row_col: str | None = None
) -> DataFrame:
    """``row, id, text`` of every row; a null text counts as empty. Other columns are left out.

    ``row_col`` names a key of the rows, see ``numbered``; without it the rows are numbered as
    they are read, which is for one scan only.
    """
    return docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


#: Row keys up to this number (8 MB) are broadcast to pick their rows; beyond it a join does.
BROADCAST_ROWS = 1_000_000


def picked(df: DataFrame, rows: DataFrame, how: str, key: str = "row") -> DataFrame:
    """Semi- or anti-join of ``df`` on a row key; the written table ``rows`` has that column."""
    small = rows.count() <= BROADCAST_ROWS
    return df.join(F.broadcast(rows) if small else rows, key, how)


def without(docs: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """``docs`` without its column ``key`` (see ``numbered``) and without the rows of which the
    key is in the column ``row`` of ``dropped``."""
    rows = materialise(dropped.select(F.col("row").alias(key)), "dropped-rows")
    return picked(docs, rows, "left_anti", key).drop(key)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


__all__ = [
    "discard",
    "fresh",
    "keyed_texts",
    "materialise",
    "numbered",
    "picked",
    "place_key",
    "sliced",
    "table",
    "with_row_key",
    "without",
]
