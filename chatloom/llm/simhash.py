"""Near-duplicates by SimHash and an inverted index over byte positions.

A fingerprint of 64 bits is eight bytes at eight positions. Two fingerprints that differ in at most d bits share at
least 8 - d positional bytes: the guaranteed minimum. Postings for single bytes would hold a 256th of all documents
each, so the index takes several positions together: of four two-byte blocks at least 4 - d are whole, and a posting
is keyed by 4 - d of them. Every pair that meets in a posting gets its shared positional bytes tallied; pairs that reach
the minimum are verified bit by bit.

A posting with many members is not paired up. For d = 2 its members are dealt out once more, by what their other bits
are after at most one flip: those that meet there are all within two bits of each other, and two members within two
bits always meet. So one link from each to the smallest is enough, and no posting yields more than a bounded
number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, reachable
from .components import components

SEED = 42
#: Members up to which a posting is paired up.
LARGE = 32
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Hashes whose bits are counted at a time.
STEP = 1 << 16


def words_of(text: str) -> list[bytes]:
    """Words of a text with A-Z lower-cased: runs of bytes other than space and \\x09-\\x0D."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingles(words: list[bytes], k: int) -> list[bytes]:
    """Runs of k words, space-joined; all words if there are fewer; none if there are none."""
    if len(words) <= k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)), strict=False)))


def fingerprint(text: str, k: int = 3) -> int:
    """The 64-bit fingerprint, unsigned: a bit is 1 if set in over half the shingles' hashes, repeats included."""
    found = shingles(words_of(text), k)
    if not found:
        return 0
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(found), STEP):
        h = np.array([digest(s, SEED) for s in found[i : i + STEP]], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. A null text counts as empty: zero."""
    reachable(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py() or "", k) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.record_batch([batch.column(0), pa.array(made, pa.int64())], names=["doc_id", "fp"])

    return rows.mapInArrow(run, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shared_bytes(a: Column, b: Column) -> Column:
    """Positions at which two fingerprints have the same byte."""
    x = a.bitwiseXOR(b)
    return sum((F.when(F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0) for i in range(8)), F.lit(0))


def fingerprint_links(prints: DataFrame, bits: int = 2, large: int = LARGE) -> DataFrame:
    """Links (u, v) between reps of distinct fingerprints; prints has (fp, rep), each fp once; bits is at most 2.

    Where a posting has up to `large` members, all its pairs within `bits` are linked; in larger ones, links that
    connect the same fingerprints. The result connects exactly those that links of at most `bits` bits connect.
    """
    if not 0 <= bits <= 2:
        raise ValueError("bits must be 0, 1 or 2")
    block = [0xFFFF << (16 * i) for i in range(4)]
    masks = [sum(block[i] for i in c) for c in combinations(range(4), 2)]
    posted = prints.select("fp", "rep", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks))).alias("k", "key"))
    sizes = posted.groupBy("k", "key").agg(F.count("*").alias("n")).filter("n > 1")
    posted = posted.join(sizes, ["k", "key"])
    flips = F.array(*(F.array(F.lit(0).cast("long"), *(F.lit(_signed(1 << b)) for b in range(64) if not m >> b & 1)) for m in masks))
    near = F.when(F.col("n") > large, F.transform(flips[F.col("k")], lambda x: F.col("fp").bitwiseXOR(x))).otherwise(F.array(F.lit(0).cast("long")))
    dealt = posted.select("k", "key", F.struct("fp", "rep").alias("m"), (F.col("n") > large).alias("hot"), F.explode(near).alias("sub"))
    lists = dealt.groupBy("k", "key", "sub", "hot").agg(F.array_sort(F.collect_list("m")).alias("m")).filter("size(m) > 1")
    star = F.transform(F.slice("m", 2, F.size("m")), lambda y: F.struct(F.col("m")[0].alias("a"), y.alias("b")))
    pairs = F.flatten(F.transform("m", lambda x, i: F.transform(F.slice("m", i + 2, F.size("m")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    met = lists.select(F.explode(F.when(F.col("hot"), star).otherwise(pairs)).alias("p")).select("p.a.*", F.col("p.b.fp").alias("fp2"), F.col("p.b.rep").alias("rep2"))
    kept = met.filter(shared_bytes(F.col("fp"), F.col("fp2")) >= 8 - bits)
    return kept.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= bits).select(F.col("rep").alias("u"), F.col("rep2").alias("v"))


def simhash_groups(docs: DataFrame, k: int = 3, bits: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents whose fingerprints, over k-word shingles, are linked by at most `bits` differing bits.

    Returns doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable, itself included. Equal
    fingerprints are linked; texts without words, null ones too, all have fingerprint zero. Rows with a null id count
    as members but name no group: one of only such rows has a null component_id. Repeated rows are returned as often
    as they come. Other columns are not read.
    """
    prints = materialize(fingerprints(docs, k, id_col, text_col), "fingerprints")
    reps = prints.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    named = reps.filter("rep is not null")
    found = components(fingerprint_links(named, bits), "u", "v")
    moved = reps.join(found, F.col("rep") == F.col("node"), "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = prints.join(moved, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
    return out.withColumnRenamed("doc_id", id_col)
