"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are complete binary trees of fixed depth, flattened into (tree, node) arrays of feature, threshold
and leaf value, so that a batch of documents walks all trees with a few numpy gathers a level.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes

FEATURES = (
    "log_bytes", "letters", "digits", "spaces", "upper", "high", "other", "symbols", "stops", "commas", "newlines", "pipes",
    "bangs", "mean_word", "long_words", "distinct_words", "distinct_lines", "top_word", "line_words", "ends_in_stop", "words_capital", "log_words", "short_words", "repeat_pairs",
)
#: Expected number of labelled rows that trees are fitted on: the bound of the training sample.
TRAIN_ROWS = 20_000
TREES, DEPTH, BINS, RATE, L2 = 80, 4, 64, 0.12, 2.0
PASS = 0.3
_SYMBOLS = np.frombuffer(b"#$%&*@^~<>{}[]\\=+|_`", np.uint8)


def features(text: bytes | None) -> list[float]:
    """Statistics of the whole UTF-8 text; all zero for null or empty."""
    if not text:
        return [0.0] * len(FEATURES)
    n = len(text)
    c = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower, digits, high = int(c[65:91].sum()), int(c[97:123].sum()), int(c[48:58].sum()), int(c[128:].sum())
    spaces = int(c[32] + c[9:14].sum())
    words = text.split()
    w = max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    distinct = Counter(words)
    lines = [x for x in text.split(b"\n") if x]
    top = max(distinct.values(), default=0)
    pairs = len(set(zip(words, words[1:], strict=False)))
    m = n - spaces or 1
    return [
        float(np.log1p(n)), (upper + lower) / m, digits / m, spaces / n, upper / max(upper + lower, 1), high / m, (m - upper - lower - digits - high) / m, float(c[_SYMBOLS].sum()) / m,
        int(c[46]) / w, int(c[44]) / w, int(c[10]) / w, int(c[124]) / w, int(c[33]) / w, float(sizes.mean()), float((sizes > 12).mean()), len(distinct) / w, len(set(lines)) / max(len(lines), 1),
        top / w, w / max(len(lines), 1), sum(x[-1:] in b".!?" for x in lines) / max(len(lines), 1), sum(x[:1].isupper() for x in lines) / max(len(lines), 1), float(np.log1p(len(words))), float((sizes < 4).mean()), 1 - pairs / max(len(words) - 1, 1),
    ]


@dataclass
class Trees:
    """``feature`` and ``threshold`` by (tree, inner node), ``value`` by (tree, leaf), in heap order."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``."""
        n, t = len(x), np.arange(len(self.value))
        total = np.full(n, self.base)
        for at in range(0, n, 4096):
            part = x[at : at + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(t)), np.int64)
            for _ in range(int(np.log2(self.value.shape[1])) if len(t) else 0):
                node = 2 * node + 1 + (part[rows, self.feature[t, node]] > self.threshold[t, node])
            if len(t):
                total[at : at + 4096] += self.value[t, node - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, l2: float = L2) -> Trees:
    """Logistic boosting on histograms: features binned at quantiles, a split by the largest gain in each node."""
    n_nodes, leaves = 2**depth - 1, 2**depth
    p = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(p / (1 - p)))
    if len(np.unique(y)) < 2:
        return Trees(base, np.zeros((0, n_nodes), np.int64), np.zeros((0, n_nodes)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    out = Trees(base, np.zeros((trees, n_nodes), np.int64), np.full((trees, n_nodes), np.inf), np.zeros((trees, leaves)))
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            local = node - first
            best = np.full(width, 1e-6)
            split = np.full((width, 2), -1)
            for f in range(x.shape[1]):
                if not len(edges[f]):
                    continue
                slot = local * bins + binned[:, f]
                gl = np.bincount(slot, g, width * bins).reshape(width, bins).cumsum(1)
                hl = np.bincount(slot, h, width * bins).reshape(width, bins).cumsum(1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain = np.where((hl < 1) | (ht - hl < 1), 0, gain)[:, : len(edges[f])]
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                split[better] = np.column_stack((np.full(width, f), k))[better]
            for w in range(width):
                if split[w, 0] >= 0:
                    out.feature[t, first + w] = split[w, 0]
                    out.threshold[t, first + w] = edges[split[w, 0]][split[w, 1]]
            own = split[local]
            right = (own[:, 0] >= 0) & (binned[np.arange(len(y)), np.maximum(own[:, 0], 0)] > own[:, 1])
            node = 2 * node + 1 + right
        leaf = node - n_nodes
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        out.value[t] = value
        margin += value[leaf]
    return out


def document_features(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns and ``x``, the array of statistics of each row's whole text; all zero for null and empty texts."""

    @F.pandas_udf("array<double>")
    def udf(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    return docs.select(*(F.col(f"`{c}`") for c in keep), udf(as_bytes(text_col)).alias("x"))


def train(docs: DataFrame, labels: DataFrame, where, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = TRAIN_ROWS) -> Trees:
    """Fit on the labelled rows for which ``where`` holds, drawn by the hash of their id to about ``rows``.

    Rows without a label or an id are left out, of several labels of one id the largest counts; without any row the
    score is one half for every text. Repeated rows count as often as they stand there. Only
    the statistics and labels of the sample reach the driver, in row order of the id.
    """
    y = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(where(F.col("id")))
    n = y.count()
    share = min(1.0, rows / max(n, 1))
    y = y.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30)).groupBy("id").agg(F.max("y").alias("y"))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    d = d.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1 << 30)) < share * (1 << 30)).where(where(F.col("id")))
    got = document_features(d, "text", ("id",)).join(F.broadcast(y), "id").select("id", "x", "y").toArrow()  # y: about ``rows`` rows
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    order = np.lexsort([*x.T, got["id"].to_numpy()])
    return fit(x[order], got["y"].to_numpy()[order].astype(float))


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text", threshold: float = PASS) -> DataFrame:
    """One row per input row: id, ``score`` and ``predicted`` (1 from ``threshold`` on).

    Null and empty texts have all statistics zero and are scored like any other; repeated rows alike; no rows give none.
    """
    kind = docs.select(F.col(id_col).alias("id")).schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = np.array([features(t) for t in part.column("text").to_pylist()]).reshape(-1, len(FEATURES))
                p = shared.value.score(x)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["id", "score", "predicted"])

    return docs.select(F.col(id_col).alias("id"), as_bytes(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)
