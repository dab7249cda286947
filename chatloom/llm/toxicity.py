"""Toxicity by class-conditional Kneser-Ney models over expressions.

An expression is a word. Kneser-Ney counts it by its continuations: in how many different contexts, left neighbours, it
occurs, not how often; so what a few copied texts repeat counts once, and an insult that turns up anywhere counts fully.
Each class has such counts from the labelled texts. What is discounted from them goes to a shared model, of continuation
counts over all texts, which smooths rare expressions: a word that the labels show once or twice, or never, is judged by
what both classes share. A text scores the difference of its log-likelihoods in the toxic and the ordinary class over its
length, for the whole text and for the expressions in it that speak most for toxic, through a logistic function. Its
weights are fitted on all labelled rows, each judged by counts from the other half of them.

A context is one of 65,536 classes of left neighbours, and a word's distinct ones are passed on as two bytes each, so that
counting over all texts moves less than the texts. Numbers of contexts are those of classes, corrected for classes
that coincide.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import labelled, materialize, reachable

#: Labelled rows that are sent to all tasks, at most; more are joined.
SENT = 4_000_000
#: What is taken off counts of contexts. Words that no class has seen more often share one ratio, exactly, so they need not be kept.
CUT = 2.0
#: What is taken off shared counts; what is added to lengths; context classes; words of text that a task holds.
SHARED_CUT, PAD, CONTEXTS, HELD = 0.75, 2, 1 << 16, 2_000_000
_LETTER = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Kinds of counts: of all texts, and of toxic (t) and ordinary (o) labelled texts of either half (a, b).
ALL, TA, TB, OA, OB = range(5)
COUNTED = ("n", "ta", "tb", "oa", "ob", "t", "o")


def expressions(text: str | None) -> list[bytes]:
    """Words of a text in lower case, in order: runs of letters and other non-ASCII characters."""
    return (text or "").lower().encode("utf-8", "replace").translate(_LETTER).split()


def context(word: bytes) -> int:
    """The class of contexts that a left neighbour is in; 0 is the beginning of a text as well."""
    return zlib.crc32(word) % CONTEXTS


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, kind, contexts): distinct contexts of words of texts (text, kind), two bytes each."""
    ids: dict[bytes, int] = {}
    classes: list[int] = []
    keys: list[np.ndarray] = []

    def made() -> Iterator[pa.RecordBatch]:
        found = np.concatenate(keys)
        keys.clear()
        found.sort()
        found = found[np.append(True, found[1:] != found[:-1])]
        at = np.flatnonzero(np.append(True, found[1:] >> 16 != found[:-1] >> 16))
        of = found[at] >> 16
        names, ends = pa.array(list(ids), pa.binary()), np.append(at, len(found)).astype(np.int32) * 2
        lists = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends), pa.py_buffer((found & 0xFFFF).astype("<u2"))])
        whole = pa.record_batch([names.take(pa.array(of >> 3)), pa.array((of & 7).astype(np.int32)), lists], names=["word", "kind", "contexts"])
        for i in range(0, len(of), 50_000):
            yield whole.slice(i, 50_000)
        ids.clear()
        classes.clear()

    size = 0
    for batch in batches:
        for text, kind in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            words = expressions(text.as_py())
            if not words:
                continue
            for w in set(words).difference(ids):
                ids[w] = len(ids)
                classes.append(context(w))
            of = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
            left = np.zeros(len(of), np.int64)
            left[1:] = np.fromiter(map(classes.__getitem__, of[:-1].tolist()), np.int64, len(of) - 1)
            keys.append(of << 19 | left)
            if kind:
                keys.append(of << 19 | kind << 16 | left)
            size += len(of)
            if size > HELD:
                yield from made()
                size = 0
    if keys:
        yield from made()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, *COUNTED): numbers of distinct contexts of each word, whose rows come one after another."""

    def made(words: list[bytes], keys: np.ndarray) -> pa.RecordBatch:
        """Of the first len(words) words; keys are distinct (number of the word, kind, context)."""
        kind, of, m = keys >> 16 & 7, keys >> 19, len(words)
        counts = [np.bincount(of[kind == k], minlength=m)[:m] for k in range(5)]
        for two in ((TA, TB), (OA, OB)):
            both = np.unique(keys[np.isin(kind, two)] & ~np.int64(7 << 16))
            counts.append(np.bincount(both >> 19, minlength=m)[:m])
        exact = [-CONTEXTS * np.log1p(-np.minimum(c, CONTEXTS - 0.5) / CONTEXTS) for c in counts]
        return pa.record_batch([pa.array(words, pa.binary()), *map(pa.array, exact)], names=["word", *COUNTED])

    last, rest = None, np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        word, kinds = batch.column("word").to_pylist(), batch.column("kind").to_numpy()
        lists = batch.column("contexts").to_pylist()
        words: list[bytes] = [] if last is None else [last]
        of = np.empty(len(word), np.int64)
        for i, w in enumerate(word):
            if not words or words[-1] != w:
                words.append(w)
            of[i] = len(words) - 1
        sizes = np.fromiter(map(len, lists), np.int64, len(lists)) // 2
        keys = np.repeat(of << 19 | kinds.astype(np.int64) << 16, sizes) | np.frombuffer(b"".join(lists), "<u2")
        keys = np.unique(np.concatenate([rest, keys]))
        n = len(words) - 1
        cut = int(np.searchsorted(keys, n << 19))
        last, rest = words[-1], keys[cut:] - (n << 19)
        if n:
            yield made(words[:n], keys[:cut])
    if last is not None:
        yield made([last], rest)


def _ratio(t: str, o: str, sums: dict, cut: float) -> Column:
    """The logarithm of a word's probability in a toxic over that in an ordinary model with counts t and o."""
    size = max(1.0, sums["n"])
    # what is taken off shared counts is spread over the words seen, evenly: cut * words / size / words
    shared = (F.greatest(F.col("n") - SHARED_CUT, F.lit(0.0)) + SHARED_CUT) / size

    def p(c: str) -> Column:
        return (F.greatest(F.col(c) - cut, F.lit(0.0)) + shared * sums[f"cut_{c}"]) / sums[c]

    return F.log(p(t) / p(o))


@dataclass
class ToxicityModel:
    """Ratios of words that a class has seen more often than is taken off, that of all others, and weights of a text's features."""

    ratios: Broadcast | None = None
    other: float = 0.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def features(self, text: Column) -> Column:
        return _features(self.ratios, self.other)(text)


def summary(words: list[bytes], ratios: dict[bytes, float], other: float) -> list[float]:
    """Length-normalised ratio of the whole text, that of its most toxic word, and the mean of its three most toxic ones."""
    get = ratios.get
    whole = sum(get(w, other) for w in words) / (len(words) + PAD)
    top = heapq.nlargest(3, (get(w, other) / (1 + PAD) for w in set(words)))
    top += [0.0] * (3 - len(top))
    return [whole, top[0], sum(top) / 3]


def _features(ratios: Broadcast, other: float):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def features(texts: pd.Series) -> pd.Series:
        known = ratios.value
        return texts.map(lambda t: summary(expressions(t), known, other))

    return features


def _slopes(weights: np.ndarray):
    """Gradient and curvature of a logistic loss over rows (y, x), summed for a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, h = np.zeros(len(weights)), np.zeros((len(weights), len(weights)))
        for batch in batches:
            if batch.num_rows:
                x = np.c_[np.ones(batch.num_rows), batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)]
                p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
                g += x.T @ (p - batch.column("y").to_numpy())
                h += (x * (p * (1 - p))[:, None]).T @ x
        yield pa.record_batch([pa.array([g.tolist()]), pa.array([h.ravel().tolist()])], names=["g", "h"])

    return run


def _logistic(rows: DataFrame, n: int, decay: float = 1.0) -> tuple[float, ...]:
    """Weights of a logistic regression over all rows (y, x), n features each, by Newton's method; decay keeps separable data finite.
    Each step passes over the rows, of which one row a partition reaches the driver."""
    w = np.zeros(n + 1)
    for _ in range(50):
        sums = rows.select("y", "x").mapInArrow(_slopes(w), "g array<double>, h array<double>").collect()
        g = sum((np.array(r.g) for r in sums), np.zeros(n + 1)) + decay * 1e-2 * w
        h = sum((np.array(r.h).reshape(n + 1, -1) for r in sums), np.zeros((n + 1, n + 1))) + decay * 1e-2 * np.eye(n + 1)
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() <= 1e-10 * max(1.0, np.abs(w).max()):
            break
    return tuple(map(float, w))


def fit_toxicity(docs: DataFrame, labels: DataFrame, keep: Column | bool = True, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """A model from all labels (doc_id, toxic) with `keep` and all texts of docs.

    Where an id has several labels, the largest holds; where it has several texts, all are counted, and for the weights one
    stands for them. Without labels of both classes, every score is the share of toxic
    rows, or 0 without rows. Labels of ids that docs lack, and null ids or labels, take no part. A null text counts as empty.
    The words that a class has seen in more than CUT contexts reach the driver and the tasks, and up to SENT labels the tasks.
    """
    spark = docs.sparkSession
    reachable(spark)
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))
    sample = labelled(labels, "toxic", F.lit(True) if keep is True else keep)
    sample = materialize(sample.select(F.col("doc_id").cast("long").alias("_id"), "y", half.cast("int").alias("half")), "labelled")
    known = F.broadcast(sample) if sample.count() <= SENT else sample
    rows = docs.select(docs[id_col].cast("long").alias("_doc"), docs[text_col].cast("string").alias("_text"))
    kind = F.when(F.col("y") == 1, F.lit(TA)).when(F.col("y") == 0, F.lit(OA)) + F.col("half")
    joined = rows.join(known, F.col("_doc") == F.col("_id"), "left").select("_text", F.coalesce(kind, F.lit(ALL)).alias("kind"))
    seen = joined.mapInArrow(_contexts, "word binary, kind int, contexts binary")
    counts = seen.repartition("word").sortWithinPartitions("word").mapInArrow(_counted, "word binary, " + ", ".join(f"{c} double" for c in COUNTED))
    counts = materialize(counts, "words")
    most = F.greatest("t", "o")
    off = {"n": SHARED_CUT} | dict.fromkeys(COUNTED[1:], CUT)
    sums = counts.agg(*(F.sum(c).alias(c) for c in COUNTED), *(F.sum(F.least(c, F.lit(v))).alias(f"cut_{c}") for c, v in off.items())).first().asDict()
    sums = {k: v or 0.0 for k, v in sums.items()}

    model = ToxicityModel()
    if not sums["t"] or not sums["o"]:
        share = sample.agg(F.avg("y").alias("y")).first().y or 0.0
        model.ratios, model.weights = spark.sparkContext.broadcast({}), (60.0 if share == 1 else -60.0, 0.0, 0.0, 0.0)
        return model
    halves = [("t", "o"), ("tb", "ob"), ("ta", "oa")]  # rows of the first half are judged by counts of the second
    halves = [h if sums[h[0]] and sums[h[1]] else halves[0] for h in halves]
    found = counts.filter(most > CUT).select("word", *(_ratio(t, o, sums, CUT).alias(f"r{i}") for i, (t, o) in enumerate(halves))).toArrow()
    words = found.column("word").to_pylist()
    others = [float(np.log(sums[f"cut_{t}"] / sums[t] / (sums[f"cut_{o}"] / sums[o]))) for t, o in halves]
    models = [ToxicityModel(spark.sparkContext.broadcast(dict(zip(words, found.column(f"r{i}").to_pylist(), strict=True))), others[i]) for i in range(3)]
    picked = rows.join(known, F.col("_doc") == F.col("_id")).select("_doc", "_text", "y", "half")
    judged = [picked.filter(F.col("half") == i - 1).select("_doc", "y", models[i].features(F.col("_text")).alias("x")) for i in (1, 2)]
    judged = judged[0].union(judged[1]).groupBy("_doc").agg(F.min(F.struct("y", "x")).alias("r")).select("r.*")
    models[0].weights = _logistic(materialize(judged, "judged"), 3)
    for m in models[1:]:
        m.ratios.unpersist()
    return models[0]


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the column `name`: 0 to 1, higher for more toxic. A null or empty text gets the score of a text without
    words. Rows, and columns of other names, stay as they are; one that is called `name` is replaced."""
    reachable(docs.sparkSession)
    x = model.features(docs[text_col].cast("string"))
    made = docs.withColumn("_chatloom_features", x)
    at = F.lit(model.weights[0])
    for i, w in enumerate(model.weights[1:]):
        at = at + F.lit(w) * F.col("_chatloom_features")[i]
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-60.0), F.least(F.lit(60.0), at))))
    return made.withColumn(name, score).drop("_chatloom_features")
