"""Quality by a sparse rule ensemble.

Statistics of a text are the inputs. Small trees on resampled labelled rows give paths, each a conjunction of thresholds:
a rule. A logistic regression with an absolute penalty over the rules keeps few of them, and these are compiled into
Spark column expressions over the statistics.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import label_sample, reachable

#: Labelled rows that the rules are fitted on, at most.
MAX_ROWS = 20_000
TREES, DEPTH, BINS, LEAST, PENALTY, ROUNDS = 40, 3, 32, 10, 0.002, 400
STATISTICS = (
    "log_bytes", "upper", "lower", "digits", "marks", "stops", "symbols", "bangs", "bars", "blanks", "lines", "beyond_ascii",
    "log_words", "mean_word", "distinct_words", "repeated_next", "short_words", "long_words", "distinct_lines", "mean_line", "marked_words",
)
_CLASS = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b"-_()[]{}<>/\\'\"`~^+=@;:?", b".,", b"%$&*#", b"!", b"|", b" \t\r", b"\n", bytes(range(128, 256))), 1):
    _CLASS[list(_chars)] = _k
_END = (b"!", b"%", b"$", b"&", b"*", b"#")


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a text; zeros for a null or empty one. Shares are of bytes, words or lines."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    shares = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=12)[1:12] / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n = len(words) or 1
    sizes = list(map(len, words))
    return [
        float(np.log1p(len(raw))), *map(float, shares), float(np.log1p(len(words))), sum(sizes) / n, len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n, sum(s <= 3 for s in sizes) / n, sum(s >= 12 for s in sizes) / n,
        len(set(lines)) / len(lines), len(raw) / len(lines), sum(w.endswith(_END) for w in words) / n,
    ]


Rule = tuple[tuple[int, bool, float], ...]


def _tree(x: np.ndarray, cuts: list[np.ndarray], y: np.ndarray, rows: np.ndarray, features: np.ndarray, depth: int, path: Rule) -> list[Rule]:
    """Paths of a regression tree on binned columns: every node but the root is a rule of (column, above, threshold)."""
    out = [path] if path else []
    if depth == 0 or len(rows) < 2 * LEAST or y[rows].min() == y[rows].max():
        return out
    best, total, n = (0.0, None, None), y[rows].sum(), len(rows)
    for f in features:
        size = np.bincount(x[rows, f], minlength=BINS + 1)
        ones = np.bincount(x[rows, f], weights=y[rows], minlength=BINS + 1)
        left, left_n = np.cumsum(ones)[:-1], np.cumsum(size)[:-1]
        right_n = n - left_n
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left**2 / left_n + (total - left) ** 2 / right_n - total**2 / n
        gain = np.where((left_n >= LEAST) & (right_n >= LEAST), gain, 0.0)[: len(cuts[f])]
        if len(gain) and gain.max() > best[0] + 1e-9:
            best = (float(gain.max()), int(f), int(gain.argmax()))
    if best[1] is None:
        return out
    _, f, b = best
    above = x[rows, f] > b
    t = float(cuts[f][b])
    return out + _tree(x, cuts, y, rows[~above], features, depth - 1, (*path, (f, False, t))) + _tree(x, cuts, y, rows[above], features, depth - 1, (*path, (f, True, t)))


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, above, t in rule:
        out &= (x[:, f] > t) == above
    return out


@dataclass
class QualityModel:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def column(self, stats: Column) -> Column:
        """The score as a column expression over an array of STATISTICS."""
        total = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for f, above, t in rule:
                holds = holds & (stats[f] > t if above else stats[f] <= t)
            total = total + F.when(holds, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit_rules(x: np.ndarray, y: np.ndarray, seed: int = 7) -> QualityModel:
    """Rules and weights from statistics and 0/1 labels. With one class only, its share is every score."""
    if not len(y) or y.min() == y.max():
        return QualityModel([], [], 0.0 if not len(y) else 8.0 if y[0] else -8.0)
    draw = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        rows = draw.choice(len(y), min(len(y), 4000), p=weight / weight.sum())
        features = draw.choice(x.shape[1], max(2, x.shape[1] // 2), replace=False)
        found |= dict.fromkeys(_tree(binned, cuts, y.astype(float), rows, np.sort(features), DEPTH, ()))
    rules, seen = [], set()
    for rule in found:
        key = _holds(rule, x).tobytes()
        if key not in seen:
            seen.add(key)
            rules.append(rule)
    h = np.stack([_holds(r, x) for r in rules], 1).astype(float) if rules else np.zeros((len(y), 0))
    w, b, last, z, t = np.zeros(h.shape[1]), 0.0, np.zeros(h.shape[1]), np.zeros(h.shape[1]), 1.0
    step = 4 / max(1.0, np.linalg.norm(np.c_[h, np.ones(len(y))], 2) ** 2 / len(y))
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(h @ z + b, -40, 40)))
        w = z - step * (h.T @ (p - y)) / len(y)
        w = np.sign(w) * np.maximum(np.abs(w) - step * PENALTY, 0)
        b -= step * float((p - y).mean())
        t, t0 = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, last = w + (t0 - 1) / t * (w - last), w
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    return QualityModel([rules[i] for i in keep], [float(w[i]) for i in keep], float(b))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


def fit_quality(docs: DataFrame, labels: DataFrame, keep: Column | bool = True, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """A model from labels (doc_id, quality) with `keep`, at most max_rows of them, and their texts in docs.

    Labels of ids that docs lack, and null ids or labels, take no part. A null text counts as empty. The rows of the
    sample, STATISTICS and label, reach the driver, where the rules are fitted.
    """
    reachable(docs.sparkSession)
    sample = label_sample(labels, "quality", F.lit(True) if keep is True else keep, max_rows).select(F.col("doc_id").alias("_id"), "y")
    rows = docs.select(docs[id_col].cast("long").alias("_doc"), docs[text_col].cast("string").alias("_text"))
    seen = rows.join(F.broadcast(sample), F.col("_doc") == F.col("_id")).select("_doc", _statistics("_text").alias("x"), "y").toArrow().to_pylist()
    seen.sort(key=lambda r: (r["_doc"], r["x"]))
    x = np.array([r["x"] for r in seen]).reshape(len(seen), len(STATISTICS))
    return fit_rules(x, np.array([r["y"] for r in seen], int))


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", name: str = "score") -> DataFrame:
    """docs with the column `name`: 0 to 1, higher for better. A null text counts as empty. Rows, and columns of other
    names, stay as they are; one that is called `name` is replaced."""
    reachable(docs.sparkSession)
    made = docs.withColumn("_chatloom_statistics", _statistics(docs[text_col].cast("string")))
    return made.withColumn(name, model.column(F.col("_chatloom_statistics"))).drop("_chatloom_statistics")
