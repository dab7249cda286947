"""Packing by concatenate and cut.

First pass: every input partition encodes its documents and notes where each starts within the partition. Prefix sums
over the partition totals, one row each, turn these into global offsets. Second pass: fixed windows of the global
sequence cut documents into pieces, the boundary records. Only the last sequence is not full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, reachable
from .encode import encoder

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int | None = 0, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack the ids of all documents, with end_id after each, into sequences of size ids.

    Returns the pieces: doc_id, start (ids of its document before it), length, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers), doc_tokens, sequence_id, offset (its place there) and, with keep_ids, ids. Every id lies in
    one piece; each sequence is gapless and all but the last hold size ids. A null text counts as empty; without an
    end_id an empty document has no piece. Ids may be null or repeat. The order of documents is that of the
    partitions read. Encoded documents are written to the shared folder once. Other columns are not read.
    """
    reachable(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("d"), docs[text_col].cast("string").alias("t"), F.spark_partition_id().alias("p"))
    coded = pa.schema([("p", pa.int32()), ("d", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("w", pa.int32()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = encoder(tokenizer), 0
        w = enc.dtype.itemsize
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        for batch in batches:
            ids = [enc.encode(t.as_py() or "") + end for t in batch.column(1)]
            n = np.array([len(x) // w for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.record_batch([batch.column(2), batch.column(0), pa.array(starts), pa.array(n), pa.array(np.full(len(ids), w, np.int32)), pa.array(ids, pa.binary())], schema=coded)

    table = materialize(rows.mapInArrow(encode, "p int, d long, at long, n long, w int, ids binary"), "packing")
    totals = table.groupBy("p").agg(F.sum("n").alias("total"))
    before = totals.select(F.col("p").alias("q"), F.coalesce(F.sum("total").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    placed = table.join(F.broadcast(before), F.col("p") == F.col("q")).select("d", (F.col("at") + F.col("base")).alias("at"), "n", "w", "ids")
    more = [("ids", pa.binary())] if keep_ids else []
    schema = pa.schema([(x.split()[0], pa.int64()) for x in PIECE.split(", ")] + more)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for d, at, n, w, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, done = np.frombuffer(packed, f"<u{w}").astype("<u4"), 0
                while done < n:
                    sequence, offset = divmod(at + done, size)
                    length = min(n - done, size - offset)
                    piece = ids[done : done + length].tobytes()
                    for column, x in zip(out, (d, done, length, zlib.crc32(piece), n, sequence, offset, piece)):  # noqa: B905
                        column.append(x)
                    done += length
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return placed.mapInArrow(cut, PIECE + ", ids binary" * keep_ids).withColumnRenamed("doc_id", id_col)
