"""Text quality by histogram gradient-boosted trees over document statistics (operator 6).

Statistics of a whole text are counts of character classes, words and lines. Trees of fixed depth are grown
on histograms of quantile bins, and kept as flat arrays: node ``i`` has the children ``2i + 1`` and ``2i + 2``,
so a batch of texts walks down all trees at once in as many numpy steps as the trees are deep.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from nestloom.llm.samples import labelled_sample

STATISTICS = (
    "log_bytes log_words word_length letters upper digits spaces signs beyond_ascii sign_kinds distinct_words top_word "
    "repeated_next signed_ends lines line_length repeated_lines short_lines"
).split()


def _classes() -> np.ndarray:
    member = np.zeros((256, 6))
    for k, letters in enumerate((string.ascii_letters, string.ascii_uppercase, string.digits, string.whitespace, string.punctuation)):
        member[np.frombuffer(letters.encode(), np.uint8), k] = 1
    member[128:, 5] = 1
    return member


_CLASSES = _classes()
_SIGNS = np.frombuffer(string.punctuation.encode(), np.uint8)
_SIGN_SET = frozenset(string.punctuation)


def statistics(text: str | None) -> list[float]:
    """Values of ``STATISTICS``; null counts as empty, and an empty text has zeros."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.bincount(data, minlength=256)
    letters, upper, digits, spaces, signs, beyond = (counts @ _CLASSES / len(data)).tolist()
    words = text.split()
    n = len(words) or 1
    seen = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    rows = len(lines) or 1
    return [
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        letters,
        upper,
        digits,
        spaces,
        signs,
        beyond,
        float((counts[_SIGNS] > 0).sum()),
        len(seen) / n,
        max(seen.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        sum(w[-1] in _SIGN_SET for w in words) / n,
        rows / n,
        n / rows,
        1 - len(set(lines)) / rows if lines else 0.0,
        sum(len(line) < 30 for line in lines) / rows,
    ]


@dataclass
class Trees:
    """Flat arrays of shape (trees, nodes): split feature and threshold; (trees, leaves): value."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        trees, nodes = self.feature.shape if self.feature.size else (0, 0)
        total = np.full(len(x), self.start)
        if trees:
            node = np.zeros((len(x), trees), np.int64)
            which, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
            for _ in range(int(np.log2(nodes + 1))):
                node = 2 * node + 1 + (x[row, self.feature[which, node]] > self.threshold[which, node])
            total += self.value[which, node - nodes].sum(1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 2.0, least: float = 4.0) -> Trees:
    """Boosted trees for the logistic loss; a node without a useful split sends everything left."""
    positive = (y.sum() + 0.5) / (len(y) + 1.0)
    start = float(np.log(positive / (1 - positive)))
    nodes = 2**depth - 1
    feature, threshold = np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf)
    value = np.zeros((trees, nodes + 1))
    if len(y) == 0 or len(np.unique(y)) < 2:
        return Trees(feature[:0], threshold[:0], value[:0], start)
    f = x.shape[1]
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(f)]
    binned = np.stack([np.searchsorted(edges[k], x[:, k], "left") for k in range(f)], 1)  # bin b: value <= edges[b]
    margin = np.full(len(y), start)
    offsets = np.arange(f) * bins
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * f * bins + offsets + binned).ravel()
            gs = np.bincount(cell, np.repeat(g, f), width * f * bins).reshape(width, f, bins).cumsum(2)
            hs = np.bincount(cell, np.repeat(h, f), width * f * bins).reshape(width, f, bins).cumsum(2)
            ga, ha = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + ridge) + (ga - gs) ** 2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
            gain[(hs < least) | (ha - hs < least)] = -1
            for k in range(f):
                gain[:, k, len(edges[k]) :] = -1
            best = gain.reshape(width, -1).argmax(1)
            for i in range(width):
                k, b = divmod(int(best[i]), bins)
                if gain[i, k, b] > 1e-6:
                    feature[t, first + i], threshold[t, first + i] = k, edges[k][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - nodes
        gl, hl = np.bincount(leaf, g, nodes + 1), np.bincount(leaf, h, nodes + 1)
        value[t] = -rate * gl / (hl + ridge)
        margin += value[t, leaf]
    return Trees(feature, threshold, value, start)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 8000, label: str = "quality") -> Trees:
    """Trees from at most about ``per_class`` labelled texts of each class; without both classes, a constant."""
    sample = labelled_sample(docs, labels, label, learn, per_class)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array([statistics(t) for t in batch.column(0).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), rows], ["y", "x"])

    rows = sample.select("text", "y").mapInArrow(measured, "y int, x array<double>").toPandas()
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, len(STATISTICS)))
    order = np.lexsort(x.T) if len(x) else slice(None)  # the same trees however rows arrive
    return grow(x[order], rows["y"].to_numpy(float)[order])


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``score`` and ``predicted`` of every whole text; null counts as empty. Equal texts score equally."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(np.array([statistics(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["id", "score", "predicted"])

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(scored, "id bigint, score double, predicted int").withColumnRenamed("id", id_col)
