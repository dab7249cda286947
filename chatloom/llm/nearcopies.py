"""Near copies at a given similarity: wide SimHash first, then an exact index over rare shingles for what it can't promise.

At a Jaccard similarity of 0.8, 64-bit fingerprints differ in about ten bits, so that no byte is sure to be shared. Here a
fingerprint has 128 bytes, over the distinct shingles of a text: similar texts share about a quarter of them, others one in
256. The index over byte positions has TABLES postings for a fingerprint, each keyed by the bytes at three positions; in a
posting each text meets the first one. The postings that two meet in are tallied, of each text the pair with most of them
goes on if it shares enough bytes, and is verified by the shingles themselves. This finds the bulk of the
groups; what it misses is a matter of chance, as no minimum of shared bytes is guaranteed.

So an exact index completes it. Shingles are put in one order for all texts, rare ones first. Two texts of n and m
shingles that are similar enough share one among the first n - ceil(s * n) + 1 of the one and the same of the other; and
at the first shingle that they share, the places before it count against them, as do the cells of a bitmap that they don't share, which leaves few pairs even where
a passage is in very many texts. These pairs are verified unless the groups found so far hold both. In the first round a
text meets the most central one of a posting only, which gathers the copies of one text; in the second all that differ in
group. The groups are those that all pairs of the given similarity make, whatever the number of partitions.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import starmap

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, reachable
from .components import components
from .simhash import SEED, words_of

BYTES, TABLES, WIDTH = 128, 24, 3
#: Shared bytes below which a pair isn't verified. Pairs of similarity 0.8 share 35 on average, others half a byte.
LEAST_BYTES = 10
#: Standard deviations beyond the bits expected at a similarity, from which the first round leaves a pair to the exact one.
BAND = 3.0
#: Hashes whose bytes are counted at a time; words whose hashes a task holds; cells of the counts of shingles, in blocks.
STEP, HELD, CELLS, BLOCK = 2048, 200_000, 1 << 18, 1 << 14
#: Times the usual count of a cell from which its postings are dealt out.
HOT = 4
#: Members of a posting up to which one task compares them all, and at a time; larger postings are dealt out over several.
LARGE, CHUNK = 4096, 256
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
_PLACE = (np.arange(BYTES) * 256).astype(np.int64)
_TURNS = np.random.default_rng(SEED).integers(1, 1 << 63, BYTES // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POSITIONS = np.stack([np.random.default_rng([SEED, t]).choice(BYTES, WIDTH, replace=False) for t in range(TABLES)])
_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes:
    """Distinct 64-bit hashes, sorted, of the runs of k words of a text: mixed from the hashes of the words, in order."""

    def __init__(self, k: int):
        self.k, self.known = k, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = words_of(text or "")
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.known) > HELD:
            self.known.clear()
        for w in set(words).difference(self.known):
            self.known[w] = xxhash.xxh64_intdigest(w, SEED)
        h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        n = min(self.k, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = (out ^ h[i : len(h) - n + 1 + i]) * _ODD
            out ^= out >> np.uint64(32)
        return np.unique(out)


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """BYTES bytes: a bit is 1 if set in over half of what the hashes of distinct shingles are turned into. Without any: zeros."""
    counts = np.zeros(BYTES * 256)
    for i in range(0, len(hashes), STEP):
        part = hashes[i : i + STEP, None] * _TURNS
        part ^= part >> np.uint64(32)
        part *= _ODD
        part ^= part >> np.uint64(29)
        counts += np.bincount((part.view(np.uint8).reshape(len(part), BYTES) + _PLACE).ravel(), minlength=BYTES * 256)
    ones = counts.reshape(BYTES, 256) @ _BITS
    return np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").tobytes()


def cell_bits(hashes: np.ndarray) -> bytes:
    """BYTES bytes with a bit for each cell of BYTES * 8 that a hash falls in."""
    bits = np.zeros(BYTES * 8, np.uint8)
    bits[(hashes >> np.uint64(40)).astype(np.int64) % (BYTES * 8)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def possible(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of n and m hashes can be that similar, by their cell_bits, rows of a and b as uint64.

    They share at most as many hashes as cells, and one more for each further hash of a cell, of the set with fewer such.
    """
    ones = lambda x: np.bitwise_count(x).sum(1, dtype=np.int64)
    most = ones(a & b) + np.minimum(n - ones(a), m - ones(b))
    return most >= similarity / (1 + similarity) * (n + m) - 1e-9


def most_bits(similarity: float) -> int:
    """Bits beyond which fingerprints hardly belong to texts of a similarity."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return int(BYTES * 8 * p + BAND * math.sqrt(BYTES * 8 * p * (1 - p)))


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def _sets(k: int):
    """(id, tx, set, n) of texts: set names their distinct shingles. Then rows (block, counts): in how many texts' shingles
    each cell occurs."""
    schema = pa.schema([("id", pa.int64()), ("tx", pa.int64()), ("set", pa.binary()), ("n", pa.int64()), ("block", pa.int32()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, cells = _Hashes(k), np.zeros(CELLS, np.int64)
        for batch in batches:
            names, sizes, at = [], [], [np.zeros(0, np.int64)]
            for t in batch.column("t"):
                h = hashes(t.as_py())
                names.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                sizes.append(len(h))
                at.append(_cell(h))
            cells += np.bincount(np.concatenate(at), minlength=CELLS)
            none = [pa.nulls(len(names), f.type) for f in (schema.field("block"), schema.field("counts"))]
            yield pa.record_batch([batch.column("id"), batch.column("tx"), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), *none], schema=schema)
        n = CELLS // BLOCK
        parts = [cells[i * BLOCK : (i + 1) * BLOCK].tobytes() for i in range(n)]
        yield pa.record_batch([*(pa.nulls(n, f.type) for f in list(schema)[:4]), pa.array(range(n), pa.int32()), pa.array(parts, pa.binary())], schema=schema)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, counts): the sums of the counts of each block."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
            total[block] = total.get(block, 0) + np.frombuffer(counts.as_py(), np.int64)
    yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["block", "counts"])


def prefix_size(n: np.ndarray | int, similarity: float):
    """Shingles of a text of n among which it shares one with any text of at least that similarity."""
    return n - np.ceil(similarity * n - 1e-9).astype(np.int64) + 1 if isinstance(n, np.ndarray) else n - math.ceil(similarity * n - 1e-9) + 1


def _indexed(k: int, similarity: float, cells: Broadcast):
    """(id, set, n, fp, bits, first): the wide fingerprint, cell_bits and the first shingles in the common order, rare ones first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = _Hashes(k), cells.value
        for batch in batches:
            columns: list[list] = [[], [], [], [], []]
            for t in batch.column("t"):
                h = hashes(t.as_py())
                order = np.lexsort((h, counts[_cell(h)]))
                first = h[order[: prefix_size(len(h), similarity) if len(h) else 0]]
                for column, x in zip(columns, (hashlib.blake2b(h.tobytes(), digest_size=16).digest(), len(h), wide_fingerprint(h), cell_bits(h), first.tobytes()), strict=True):
                    column.append(x)
            kinds = (pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.record_batch([batch.column("id"), *starmap(pa.array, zip(columns, kinds, strict=True))], names=["id", "set", "n", "fp", "bits", "first"])

    return run


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node): the postings of fingerprints, a row for each table."""
    for batch in batches:
        for part in pa.Table.from_batches([batch]).to_batches(max_chunksize=4096):
            fp = np.frombuffer(b"".join(part.column("fp").to_pylist()), np.uint8).reshape(-1, BYTES).astype(np.int64)
            key = fp[:, _POSITIONS] @ (256 ** np.arange(WIDTH)) + (np.arange(TABLES) << (8 * WIDTH))
            yield pa.record_batch([pa.array(key.ravel()), pa.array(np.repeat(part.column("node").to_numpy(), TABLES))], names=["key", "node"])


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of the first node of a posting, whose members come one after another, and each other one."""
    key, first = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, nodes = batch.column("key").to_numpy(), batch.column("node").to_numpy()
        new = np.concatenate([[keys[0] != key], keys[1:] != keys[:-1]])
        at = np.maximum.accumulate(np.where(new, np.arange(len(keys)), -1))
        firsts = np.where(at >= 0, nodes[at], first if first is not None else 0)
        key, first = keys[-1], firsts[-1]
        kept = ~new & (firsts != nodes)
        yield pa.record_batch([pa.array(firsts[kept]), pa.array(nodes[kept])], names=["u", "v"])


def _tallied(bits: int):
    """(u, v, bits) of pairs that share LEAST_BYTES bytes, each at its position, and differ in at most so many bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BYTES) for c in ("a", "b"))
            kept = np.flatnonzero((a == b).sum(1) >= LEAST_BYTES)
            differ = np.bitwise_count(a[kept] ^ b[kept]).sum(1, dtype=np.int64)
            kept, differ = kept[differ <= bits], differ[differ <= bits]
            yield pa.record_batch([*(batch.column(c).take(pa.array(kept)) for c in ("u", "v")), pa.array(differ)], names=["u", "v", "bits"])

    return run


def _placed(similarity: float, cells: Broadcast):
    """(h, salt, node, n_at): a row for each of the first shingles of a text, with the text's size and its place there.

    Shingles of cells with many times the usual count are dealt out by salts; 0 stands for all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = cells.value
        usual = HOT * max(1.0, float(counts.mean()))
        for batch in batches:
            for part in pa.Table.from_batches([batch]).to_batches(max_chunksize=2048):
                n = part.column("n").to_numpy()
                size = prefix_size(n, similarity)
                h = np.frombuffer(b"".join(part.column("first").to_pylist()), np.uint64)
                at = np.arange(len(h)) - np.repeat(np.cumsum(size) - size, size)
                node = np.repeat(part.column("node").to_numpy(), size)
                salts = (counts[_cell(h)] // usual).astype(np.int64)
                salt = np.where(salts > 0, 1 + node % np.maximum(salts, 1), 0)
                yield pa.record_batch([pa.array(h.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(node), pa.array(np.repeat(n, size) << 32 | at)], names=["h", "salt", "node", "n_at"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, node, n, at) of postings, whose rows come one after another, with more than one row; those dealt out are all kept."""

    def made(columns: list[np.ndarray]) -> pa.RecordBatch:
        h, node, n_at = columns
        return pa.record_batch([pa.array(h), pa.array(node), pa.array(n_at >> 32), pa.array(n_at & 0xFFFFFFFF)], names=["h", "node", "n", "at"])

    held, shared = None, False  # the last row so far, and whether it shares its posting with one before it
    for batch in batches:
        if not batch.num_rows:
            continue
        h, salt, node, n_at = (batch.column(c).to_numpy() for c in ("h", "salt", "node", "n_at"))
        if held is not None:
            h, salt, node, n_at = (np.append(x, y) for x, y in zip(held, (h, salt, node, n_at), strict=True))
        same = np.append(h[1:] == h[:-1], False)
        kept = same | np.append(shared, same[:-1]) | (salt > 0)
        held, shared = [x[-1:] for x in (h, salt, node, n_at)], bool(kept[-1])
        if (found := kept[:-1]).any():
            yield made([x[:-1][found] for x in (h, node, n_at)])
    if shared:
        yield made([held[0], held[2], held[3]])


def _pairs(similarity: float):
    """Pairs of a posting's homes, and of its guests with its homes, that may be similar enough and differ in group.

    Rows come by posting and salt, homes first, in their order of slack = at - c * n. A shared shingle at places i and j that
    is the first one shared leaves i + j shingles alone, of which similar texts have at most c * (n + m) in all.
    """
    c = (1 - similarity) / (1 + similarity)

    def met(a: list[np.ndarray], b: list[np.ndarray], same: bool = False) -> np.ndarray:
        """Pairs (2, k) of nodes of a and b, each (node, of, n, slack, bits)."""
        ok = (a[3][:, None] + b[3] <= 1e-9) & (a[1][:, None] != b[1])
        ok &= np.minimum(a[2][:, None], b[2]) >= similarity * np.maximum(a[2][:, None], b[2]) - 1e-9
        i, j = np.nonzero(np.triu(ok, 1) if same else ok)
        kept = [possible(a[4][x], b[4][y], a[2][x], b[2][y], similarity) for x, y in ((i[k : k + (1 << 16)], j[k : k + (1 << 16)]) for k in range(0, len(i), 1 << 16))]
        kept = np.concatenate(kept) if kept else np.zeros(0, bool)
        return np.stack([a[0][i[kept]], b[0][j[kept]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, homes = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, salt, guest, node, of, n, at = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("h", "salt", "guest", "node", "of", "n", "at"))
            rows = (node, of, n, at - c * n, np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(len(h), -1))
            cuts = np.flatnonzero((h[1:] != h[:-1]) | (salt[1:] != salt[:-1]) | (guest[1:] != guest[:-1])) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(h)], strict=True):
                if (h[s], salt[s]) != key:
                    key, homes = (h[s], salt[s]), None
                for x in range(s, e, CHUNK):
                    part = [r[x : min(e, x + CHUNK)] for r in rows]
                    found = [] if homes is None else [met(part, homes)]
                    if not guest[s]:
                        found += [met(part, part, True)] if len(part[0]) > 1 else []
                        homes = part if homes is None else [np.concatenate(p) for p in zip(homes, part, strict=True)]
                    if sum(f.shape[1] for f in found):
                        both = np.concatenate(found, 1)
                        yield pa.record_batch([pa.array(both.min(0)), pa.array(both.max(0))], names=["u", "v"])

    return run


def _likely(similarity: float):
    """Pairs that their cell_bits don't rule out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for c in ("a", "b"))
                kept = pa.array(possible(a, b, batch.column("n").to_numpy(), batch.column("m").to_numpy(), similarity))
                yield pa.record_batch([batch.column(c).filter(kept) for c in ("u", "v")], names=["u", "v"])

    return run


def _verified(k: int, similarity: float):
    """Pairs whose distinct shingles are as similar as asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(k)
        for batch in batches:
            kept = []
            for i, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"), strict=True)):
                x, y = hashes(a.as_py()), hashes(b.as_py())
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if shared >= similarity * (len(x) + len(y) - shared) - 1e-9:
                    kept.append(i)
            yield pa.record_batch([batch.column(c).take(pa.array(kept, pa.int64())) for c in ("u", "v")], names=["u", "v"])

    return run


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, tx, group, component_id) of each row: tx is the hash of its text, component_id the smallest id of its group.

    Rows are linked at a Jaccard similarity of their distinct shingles of `words` words (A-Z in lower case; fewer words: all
    of them) of at least `similarity`; groups are what links connect. Texts without words, null ones too, are copies of each
    other. Shingles are compared by 64-bit hashes. Rows of a null id take no part. Rows of one id are told apart by their
    texts. Repeated rows come back as often as they come. An empty table gives an empty one; other columns are not read.
    """
    spark = docs.sparkSession
    reachable(spark)
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("t")).filter("id is not null")
    rows = rows.select("id", F.xxhash64("t").alias("tx"), "t")
    made = materialize(rows.mapInArrow(_sets(words), "id long, tx long, set binary, n long, block int, counts binary"), "sets")
    # CELLS numbers, whatever the input
    blocks = made.filter("block is not null").select("block", "counts").repartition("block").mapInArrow(_added, "block int, counts binary").toArrow().sort_by("block")
    cells = spark.sparkContext.broadcast(np.frombuffer(b"".join(blocks.column("counts").to_pylist()), np.int64) if blocks.num_rows else np.zeros(CELLS, np.int64))
    sets = made.filter("block is null").select("id", "tx", "set", "n")

    # a node for each set of shingles, named by its smallest id or, where ids repeat, by a hash
    named = sets.groupBy("set").agg(F.min(F.struct("id", "tx")).alias("m")).select("set", "m.*")
    alone = F.count("*").over(Window.partitionBy("id")) == 1
    named = materialize(named.select("set", "id", "tx", F.when(alone, F.col("id")).otherwise(F.xxhash64("set")).alias("node")), "named")
    indexed = rows.select("id", "t").mapInArrow(_indexed(words, similarity, cells), "id long, set binary, n long, fp binary, bits binary, first binary")
    nodes = materialize(indexed.join(named, ["set", "id"]).select("node", "n", "fp", "bits", "first").filter("n > 0"), "nodes")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of some pairs of nodes whose texts are as similar as asked for."""
        both = pairs.join(texts.toDF("u", "a"), "u").join(texts.toDF("v", "b"), "v")
        return both.select("u", "v", "a", "b").mapInArrow(_verified(words, similarity), "u long, v long")

    def grown(found: DataFrame | None, links: DataFrame) -> DataFrame:
        """(node, of): the groups so far, joined by links between nodes."""
        if found is None:
            return materialize(components(links, "u", "v").select("node", F.col("component").alias("of")), "groups")
        of = lambda c: found.select(F.col("node").alias(c), F.col("of").alias(f"of_{c}"))
        lifted = links.join(of("u"), "u", "left").join(of("v"), "v", "left").select(F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v"))
        more = materialize(components(lifted, "u", "v").select("node", "component"), "lifted")
        old = found.join(more.toDF("of", "c"), "of", "left").select("node", F.coalesce("c", "of").alias("of"))
        new = more.join(found.select("node"), "node", "left_anti").select("node", F.col("component").alias("of"))
        return materialize(old.union(new), "groups")

    # by fingerprints
    dealt = nodes.select("node", "fp").mapInArrow(_postings, "key long, node long")
    dealt = dealt.repartitionByRange("key", F.xxhash64("node")).sortWithinPartitions("key", F.xxhash64("node"))
    # tally the postings that two meet in; of each node's pairs the one with most of them goes on
    hits = dealt.mapInArrow(_met, "u long, v long").groupBy("u", "v").agg(F.count("*").alias("n"))
    met = materialize(hits.groupBy("v").agg(F.max_by("u", F.struct("n", "u")).alias("u")), "met")
    prints = nodes.select("node", "fp")
    both = met.join(prints.toDF("u", "a"), "u").join(prints.toDF("v", "b"), "v")
    close = both.select("u", "v", "a", "b").mapInArrow(_tallied(most_bits(similarity)), "u long, v long, bits long")
    close = materialize(close.select("u", "v"), "close")
    # by rare shingles: the postings of more than one text
    posted = nodes.select("node", "n", "first").mapInArrow(_placed(similarity, cells), "h long, salt int, node long, n_at long")
    posted = posted.repartition("h", "salt").sortWithinPartitions("h").mapInArrow(_shared, "h long, node long, n long, at long")
    shared = materialize(posted, "postings")

    # the texts that may be looked at
    wanted = shared.select("node").union(close.select("u")).union(close.select("v")).distinct().join(named, "node").select("id", "tx", "node")
    texts = materialize(rows.join(wanted, ["id", "tx"]).groupBy("node").agg(F.min("t").alias("t")), "texts")
    groups = grown(None, materialize(verified(close.select("u", "v")), "links"))

    # first each node beside the most central one of a posting, then all that differ in group
    of = lambda rows: rows.join(groups, "node", "left").withColumn("of", F.coalesce("of", "node"))
    posted = of(shared)
    slack = F.col("at") - F.col("n") * ((1 - similarity) / (1 + similarity))
    centres = posted.groupBy("h").agg(F.min(F.struct(slack.alias("s"), "node", "of", "n")).alias("centre"))
    sized = F.least("n", "centre.n") >= similarity * F.greatest("n", "centre.n") - 1e-9
    pairs = posted.join(centres, "h").filter((F.col("of") != F.col("centre.of")) & (slack + F.col("centre.s") <= 1e-9) & sized)
    pairs = pairs.select(F.least("node", "centre.node").alias("u"), F.greatest("node", "centre.node").alias("v")).distinct()
    sketch = nodes.select("node", "n", "bits").distinct()
    pairs = pairs.join(sketch.toDF("u", "n", "a"), "u").join(sketch.toDF("v", "m", "b"), "v")
    pairs = materialize(pairs.select("u", "v", "n", "m", "a", "b").mapInArrow(_likely(similarity), "u long, v long"), "central")
    groups = grown(groups, materialize(verified(pairs), "links"))

    posted = of(shared)
    size = posted.groupBy("h").agg(F.count("*").alias("m"), F.min("of").alias("main"), F.max("of").alias("most")).filter("main <> most")
    size = size.select("h", F.ceil(F.col("m") / LARGE).cast("int").alias("salts"), "main", "most")
    # of a posting dealt out, the members of one group are homes only; those of others are guests of every part as well
    posted = posted.join(size, "h").withColumn("home", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int"))
    everywhere = (F.col("salts") > 1) & (F.col("of") != F.col("main"))
    posted = posted.withColumn("salt", F.explode(F.when(everywhere, F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array("home"))))
    posted = posted.select("h", "salt", (F.col("salt") != F.col("home")).alias("guest"), "node", "of", "n", "at")
    posted = posted.join(nodes.select("node", "bits"), "node")
    pairs = posted.repartition("h", "salt").sortWithinPartitions("h", "salt", "guest").mapInArrow(_pairs(similarity), "u long, v long")
    pairs = materialize(pairs.distinct(), "apart")
    groups = grown(groups, materialize(verified(pairs), "links"))

    named = of(named.select("set", "id", "node")).select("set", "id", "of")
    least = named.groupBy("of").agg(F.min("id").alias("component_id"))
    return sets.join(named.join(least, "of").select("set", "of", "component_id"), "set").select(F.col("id").alias(id_col), "tx", F.col("of").alias("group"), "component_id")


def keep_one(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near copies, the one of the smallest id and then hash of its text; all columns stay.

    Of repeated rows, of one id and text, one stays. Rows of a null id belong to no group and stay. An empty table gives an
    empty one.
    """
    groups = near_copies(docs, words, similarity, id_col, text_col).withColumnRenamed(id_col, "id")
    kept = groups.filter(F.col("id") == F.col("component_id")).groupBy("group").agg(F.min("id").alias("_chatloom_id"), F.min("tx").alias("_chatloom_tx")).drop("group")
    keyed = docs.withColumns({"_chatloom_id": docs[id_col].cast("long"), "_chatloom_tx": F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))})
    named = keyed.join(kept, ["_chatloom_id", "_chatloom_tx"], "left_semi").dropDuplicates(["_chatloom_id", "_chatloom_tx"])
    return named.unionByName(keyed.filter("_chatloom_id is null")).select(*docs.columns)
