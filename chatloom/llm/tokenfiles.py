"""Token-id files: concatenated ids with Elias-Fano encoded document boundaries.

A file is a Parquet table of blocks in ascending order of documents. A block holds whole documents: their ids one
after another in two or four bytes each, and where each document ends. The ends of n documents over u ids are kept in
about n * (2 + log2(u / n)) bits: the low bits of every end in a packed array, the high bits as unary gaps in a bit
vector. select(i), the place of the i-th one in that vector, comes from a sample of places and a look at the few bytes
after it, and gives the i-th end without decoding the others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import reachable
from .encode import encoder

#: Ids in a block, unless one document has more; ones between two samples of select.
BLOCK_IDS, SAMPLE = 1 << 20, 64
BLOCK = "part int, block int, start long, n_ids long, n_docs int, doc_ids array<bigint>, width int, low_bits int, low binary, high binary, samples binary, ids binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("n_docs", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("width", pa.int32()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary()), ("ids", pa.binary())])


class EliasFano:
    """A non-decreasing list of integers from 0 to its last one."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = np.packbits(((values[:, None] >> np.arange(bits)) & 1).astype(np.uint8), bitorder="little") if bits else np.zeros(0, np.uint8)
        places = (values >> bits) + np.arange(n)
        high = np.zeros((int(places[-1]) + 8) // 8 * 8 if n else 0, np.uint8)
        high[places] = 1
        return cls(n, bits, low.tobytes(), np.packbits(high, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """Place of the i-th one of the high bits."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, skip = divmod(at, 8)
        left += int(np.bitwise_count(self.high[byte] & np.uint8((1 << skip) - 1)))
        while (ones := int(np.bitwise_count(self.high[byte]))) <= left:
            left -= ones
            byte += 1
        return byte * 8 + int(np.flatnonzero(np.unpackbits(self.high[byte : byte + 1], bitorder="little"))[left])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        b, value = self.low_bits, (self.select(i) - i) << self.low_bits
        first, last = i * b // 8, ((i + 1) * b + 7) // 8
        return value | ((int.from_bytes(self.low[first:last].tobytes(), "little") >> (i * b % 8)) & ((1 << b) - 1))

    def selected(self, i: np.ndarray) -> np.ndarray:
        """select() of many: each walks from the sample before it, over the bytes between."""
        at, left = self.samples[i // SAMPLE].astype(np.int64), i % SAMPLE
        byte, skip = at >> 3, at & 7
        ones = np.bitwise_count(self.high).astype(np.int64)
        left += np.bitwise_count(self.high[byte] & ((1 << skip) - 1).astype(np.uint8))
        walking = np.flatnonzero(ones[byte] <= left)
        while len(walking):
            left[walking] -= ones[byte[walking]]
            byte[walking] += 1
            walking = walking[ones[byte[walking]] <= left[walking]]
        bits = np.unpackbits(self.high[byte][:, None], axis=1, bitorder="little")
        return byte * 8 + (np.cumsum(bits, 1) * bits == left[:, None] + 1).argmax(1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at many places, each by select; only what is asked for is decoded."""
        i = np.asarray(i, np.int64)
        high = (self.selected(i) - i) << self.low_bits
        if not self.low_bits or not len(i):
            return high
        bit = i[:, None] * self.low_bits + np.arange(self.low_bits)
        low = (self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1
        return high | (low.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64)))

    def all(self) -> np.ndarray:
        b = self.low_bits
        high = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n] - np.arange(self.n)
        if not b:
            return high
        low = np.unpackbits(self.low, count=self.n * b, bitorder="little").reshape(self.n, b).astype(np.int64) @ (1 << np.arange(b, dtype=np.int64))
        return (high << b) | low


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text with the tokenizer file and write the ids to path, in ascending order of (id_col, text).

    end_id is appended to every document (None: nothing). A null text counts as empty: end_id alone. A null id comes
    first; ids may repeat. An empty table gives files without blocks. Other columns are not read.
    """
    reachable(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("d"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t")).repartitionByRange("d", "h").sortWithinPartitions("d", "h", "t").select("d", "t", F.spark_partition_id().alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = b"" if end_id is None else np.array([end_id], enc.dtype).tobytes()
        ids: list[bytes] = []
        docs: list[int | None] = []
        held = start = block = part = 0

        def made() -> pa.RecordBatch:
            ends = np.cumsum([len(x) // enc.dtype.itemsize for x in ids])
            ef = EliasFano.of(ends)
            values = [part, block, start, int(ends[-1]), len(docs), docs, enc.dtype.itemsize, ef.low_bits, ef.low.tobytes(), ef.high.tobytes(), ef.samples.tobytes(), b"".join(ids)]
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, _SCHEMA, strict=True)], schema=_SCHEMA)

        for batch in batches:
            if batch.num_rows:
                part = batch.column(2)[0].as_py()
            for d, t in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(enc.encode(t.as_py()) + end)
                docs.append(d.as_py())
                held += len(ids[-1]) // enc.dtype.itemsize
                if held >= BLOCK_IDS:
                    yield made()
                    start, block, held = start + held, block + 1, 0
                    ids, docs = [], []
        if docs:
            yield made()

    rows.mapInArrow(run, BLOCK).write.option("compression", "zstd").parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """Documents of token files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian uint32), ids_crc32.

    Starts come from sums over the partitions written, one row each, and the starts that blocks have within theirs.
    """
    reachable(spark)
    blocks = spark.read.schema(BLOCK).parquet(path)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select(F.col("part").alias("q"), F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    rows = blocks.join(F.broadcast(before), F.col("part") == F.col("q")).withColumn("start", F.col("start") + F.col("base"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends = EliasFano(r["n_docs"], r["low_bits"], r["low"], r["high"], r["samples"]).get(np.arange(r["n_docs"]))
                starts = np.concatenate([[0], ends[:-1]])
                ids = np.frombuffer(r["ids"], f"<u{r['width']}")
                wide = [ids[a:b].astype("<u4").tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                columns = [r["doc_ids"], starts + r["start"], ends - starts, [zlib.crc32(x) for x in wide], wide]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return rows.select("start", "n_docs", "doc_ids", "width", "low_bits", "low", "high", "samples", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
