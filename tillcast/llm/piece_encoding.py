"""SentencePiece encoding and decoding of whole texts.

No piece of the model has a white-space marker after another character, so no piece crosses the
place where a word meets the marker of the next. A text is cut there; a task segments each
distinct marked word once and joins the ids back by position (``chunks.ChunkTable``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.chunks import ChunkTable
from tillcast.llm.frames import keyed_texts, sliced

MARK = "▁"
_WORD = re.compile(" *[^ ]+")
_PROBE = " a  b c"


class PieceEncoder:
    """Ids of whole texts as the sentencepiece library gives them, without end ids.

    Where a cut isn't safe (a literal marker, a space at the end, a model whose pieces cross
    markers or which changes white space) the whole text is one chunk.
    """

    def __init__(self, path: str, limit: int = 300_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        marked = "".join(self.model.encode(_PROBE, out_type=str))
        self._cuts = not crossing and marked == MARK + _PROBE.replace(" ", MARK)
        self._table = ChunkTable(self._encode, limit)

    def _encode(self, chunks: list[str]) -> list[list[int]]:
        return self.model.encode(chunks, num_threads=1)

    def _words(self, text: str) -> list[str]:
        if not self._cuts or MARK in text or text[-1:] == " ":
            return [text]
        if "  " in text or text[:1] == " ":
            # The library puts one marker before what it encodes; the word's first space is it.
            return [w[1:] for w in _WORD.findall(" " + text)]
        return text.split(" ") if text else []

    def ids(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and where those of each text end."""
        odd = pc.or_(pc.match_substring_regex(texts, "^ |  | $|^$"), pc.match_substring(texts, MARK))
        if pc.any(odd).as_py() or not self._cuts:
            return self._table.ids(
                pa.array([self._words(t) for t in texts.to_pylist()], pa.list_(pa.string()))
            )
        return self._table.ids(pc.split_pattern(texts, " "))


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end: bool) -> Iterator[pa.RecordBatch]:
    encoder = PieceEncoder(path)
    for batch in sliced(batches):
        flat, ends = encoder.ids(batch.column(2))
        if end:
            flat = np.insert(flat, ends, encoder.model.eos_id())
            ends = ends + np.arange(1, len(ends) + 1)
        offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
        ids = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), ids], ["row", "id", "ids"]
        )


def encode(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", end: bool = True
) -> DataFrame:
    """``row, id, ids`` of every row; ``end`` adds the model's end id.

    A null or empty text has the end id alone. Rows given twice are encoded twice; ids may be
    null. An empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return keyed_texts(docs, id_col, text_col).mapInArrow(
        lambda b: _encoded(b, model, end), f"row bigint, id {kind}, ids array<int>"
    )


def _decoded(
    batches: Iterator[pa.RecordBatch], path: str, ids_at: int
) -> Iterator[pa.RecordBatch]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for batch in sliced(batches):
        ids = batch.column(ids_at).to_pylist()
        texts = [None if x is None else model.decode(x) for x in ids]
        columns = [*batch.columns, pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "decoded"])


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids; null ids have a null text."""
    at = encoded.columns.index(ids_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(lambda b: _decoded(b, model, at), f"{schema}, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """Counts and SHA-256 digests of what ``decode`` returns."""
    return decoded.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
