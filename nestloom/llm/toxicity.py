"""Toxicity by a subsequence string kernel and a support vector machine (operator 4).

The kernel of two words sums over their common subsequences of three characters, gaps included, each gap
costing a factor; so an insult with characters put in, left out or with another ending stays close to the
landmark it resembles. A word with signs inside is also read without them, and single characters in a row,
whatever signs or spaces stand between them, are also read as one word. Landmarks are words that toxic training texts have more often than others. A text's
features for a landmark are the largest kernel value of any of its words, above a floor, and the sum over
its distinct words, damped. The Nyström map (the
inverse root of the landmarks' own kernel matrix) turns these into vectors, on which a linear support vector
machine is trained, and a logistic curve turns its value into a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from nestloom.llm.common import materialize, released
from nestloom.llm.samples import labelled_sample

ORDER = 3  # characters in a common subsequence
DECAY = 0.6  # factor for each character that a subsequence spans
FLOOR, FULL = 0.4, 0.8  # normalised kernel values up to the first count as no likeness, from the second as full likeness
WIDTH = 24  # longer words are looked at in windows of this width, half overlapping
_COMMON = 0.5  # share of a landmark's pairs of characters that a word needs to be compared with it
_HITS, _MISSES = 20_000, 100_000  # words remembered by a task, with features and without: about 20 MB in all
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_SIGNS = re.compile(r"[\W_]+")
_SPELLED = re.compile(rf"(?<![^\W_])[^\W_](?:[\W_]+[^\W_]){{{ORDER - 1},}}(?![^\W_])")  # single characters in a row


def _codes(words: list[str]) -> np.ndarray:
    """Character codes, one row per word, padded with 0."""
    width = max(map(len, words), default=1)
    text = "".join([w.ljust(width, "\0") for w in words])
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32).reshape(len(words), width)


def _pairs(codes: np.ndarray, gap: int) -> np.ndarray:
    """Code of each pair of characters with ``gap`` others between them; -1 where there is none."""
    first, second = codes[:, : -1 - gap].astype(np.int64), codes[:, 1 + gap :].astype(np.int64)
    return np.where((first > 0) & (second > 0), (first << 21) | second, -1)


def subsequence_kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Kernel of each pair of rows of character codes (0 pads), by dynamic programming over prefixes."""
    n, a, b = len(left), left.shape[1], right.shape[1]
    same = (left[:, :, None] == right[:, None, :]) & (left[:, :, None] != 0)
    ends = np.where(same, np.float32(DECAY**2), np.float32(0))
    for _ in range(ORDER - 1):
        # weight of all shorter subsequences that end strictly before (i, j)
        before = np.zeros((n, a + 1, b + 1), np.float32)
        for i in range(a):
            row = np.zeros((n, b + 1), np.float32)
            for j in range(b):
                row[:, j + 1] = ends[:, i, j] + DECAY * row[:, j]
            before[:, i + 1] = row + DECAY * before[:, i]
        ends = np.where(same, np.float32(DECAY**2) * before[:, :-1, :-1], np.float32(0))
    return ends.sum((1, 2), dtype=np.float64)


def windows(word: str) -> list[str]:
    """The word without signs at its ends, as windows of at most ``WIDTH`` characters."""
    word = _EDGES.sub("", word)
    if len(word) <= WIDTH:
        return [word]
    return [word[i : i + WIDTH] for i in range(0, len(word) - WIDTH // 2, WIDTH // 2)]


def readings(word: str, lengths: list[int]) -> list[str]:
    """Windows of the word as given and, if it has signs inside, of the word without them.

    A word spelled in single characters has no known ends, so every stretch of one of ``lengths`` counts too.
    """
    found = windows(word)
    if not word.isalnum() and (bare := _SIGNS.sub("", word)) != _EDGES.sub("", word):
        found = found + windows(bare)
        if _SPELLED.fullmatch(_EDGES.sub("", word)):
            found += [bare[i : i + n] for n in lengths for i in range(len(bare) - n + 1)]
    return found


def word_set(text: str | None) -> set[str]:
    """Distinct words of a text in lower case, and the stretches of it that are spelled in single characters."""
    text = (text or "").lower()
    words, spelled = set(text.split()), set(_SPELLED.findall(text))
    # a word that is spelled as a whole counts once
    return words | (spelled - {_EDGES.sub("", w) for w in words}) if spelled else words


class WordFeatures:
    """Normalised kernel values of words with each landmark, above the floor and scaled to 0 to 1.

    Only words that have enough of a landmark's neighbouring pairs of characters are compared with it; in a
    word, one character may stand between the two. For all others the feature is 0 by definition.
    """

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self.lengths = sorted({len(w) for w in landmarks})
        self.codes = _codes(landmarks) if landmarks else np.zeros((0, 1), np.int32)
        self.own = np.sqrt(subsequence_kernel(self.codes, self.codes))
        pairs = [sorted(set(row[row >= 0].tolist())) for row in _pairs(self.codes, 0)]
        self.keys = np.array(sorted({p for row in pairs for p in row}), np.int64)
        self.member = np.zeros((len(self.keys), len(landmarks)), np.float32)
        for k, row in enumerate(pairs):
            self.member[np.searchsorted(self.keys, row), k] = 1
        self.enough = _COMMON * self.member.sum(0)

    def _close(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        has = np.zeros((len(codes), len(self.keys)), np.float32)
        for gap in (0, 1):
            pairs = _pairs(codes, gap)
            place = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
            row, column = np.nonzero(self.keys[place] == pairs)
            has[row, place[row, column]] = 1
        return np.nonzero(has @ self.member >= self.enough)

    def of(self, words: list[str]) -> dict[int, np.ndarray]:
        """Features of those words that have any, by their place."""
        users: dict[str, list[int]] = {}
        for i, w in enumerate(words):
            for piece in readings(w, self.lengths):
                if len(piece) >= ORDER:
                    users.setdefault(piece, []).append(i)
        found: dict[int, np.ndarray] = {}
        if not users or not self.landmarks:
            return found
        pieces = sorted(users, key=len)
        for at in range(0, len(pieces), 4096):
            codes = _codes(pieces[at : at + 4096])
            row, mark = self._close(codes)
            if not len(row):
                continue
            used, place = np.unique(row, return_inverse=True)
            own = np.sqrt(subsequence_kernel(codes[used], codes[used]))
            values = np.concatenate([subsequence_kernel(codes[row[k : k + 2048]], self.codes[mark[k : k + 2048]]) for k in range(0, len(row), 2048)])
            values = values / np.maximum(own[place] * self.own[mark], 1e-12)
            for k in np.flatnonzero(values > FLOOR).tolist():
                for i in users[pieces[at + int(row[k])]]:
                    vector = found.setdefault(i, np.zeros(len(self.landmarks)))
                    vector[mark[k]] = max(vector[mark[k]], min(1.0, (values[k] - FLOOR) / (FULL - FLOOR)))
        return found


class TextFeatures:
    """Features of whole texts; those of words are remembered, as most have none."""

    def __init__(self, landmarks: list[str]):
        self.words = WordFeatures(landmarks)
        self._hits: dict[str, np.ndarray] = {}
        self._misses: set[str] = set()

    def of(self, texts: list[str | None]) -> np.ndarray:
        bags = [word_set(t) for t in texts]
        for cache, most in ((self._hits, _HITS), (self._misses, _MISSES)):
            if len(cache) > most:
                cache.clear()
        new = list({w for bag in bags for w in bag if w not in self._hits and w not in self._misses})
        found = self.words.of(new)
        self._hits.update({new[i]: v.astype(np.float32) for i, v in found.items()})
        self._misses.update(w for i, w in enumerate(new) if i not in found)
        most, total = np.zeros((2, len(texts), len(self.words.landmarks)))
        for i, bag in enumerate(bags):
            for w in bag:
                v = self._hits.get(w)
                if v is not None:
                    np.maximum(most[i], v, out=most[i])
                    total[i] += v
        return np.concatenate([most, np.log1p(total)], 1)

    def each(self, column: pa.Array, block: int = 128) -> Iterator[np.ndarray]:
        """Features of a column's texts, some at a time."""
        for at in range(0, len(column), block):
            yield self.of(column.slice(at, block).to_pylist())


def _mapped(features: np.ndarray, nystroem: np.ndarray) -> np.ndarray:
    """Nyström vectors of both kinds of features: largest value and sum over words."""
    most, total = np.split(features, 2, 1)
    return np.concatenate([most @ nystroem, total @ nystroem], 1)


@dataclass
class ToxicityModel:
    landmarks: list[str]
    nystroem: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        value = _mapped(features, self.nystroem) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -30, 30)))


def choose_landmarks(sample: DataFrame, count: int, candidates: int = 600) -> list[str]:
    """Words typical of toxic texts, strongest first, each unlike those before it (bounded by ``count``)."""
    words = sample.select("y", F.explode(F.array_distinct(F.split(F.lower("text"), r"[\s\p{Punct}]+"))).alias("w")).where("length(w) between 3 and 24")
    totals = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return []
    seen = words.groupBy("w").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c")).where("t >= 3")
    p = (F.col("t") + F.col("c") + 1) / (toxic + clean + 2)
    z = (F.col("t") / toxic - F.col("c") / clean) / F.sqrt(p * (1 - p) * (1 / toxic + 1 / clean))
    ranked = [r["w"] for r in seen.select("w", z.alias("z")).where("z > 3").orderBy(F.desc("z"), "w").limit(candidates).collect()]
    chosen: list[str] = []
    for word in ranked:
        if len(chosen) == count:
            break
        if chosen:
            left = np.repeat(_codes([word]), len(chosen), 0)
            right = _codes(chosen)
            own = np.sqrt(subsequence_kernel(left[:1], left[:1])[0] * subsequence_kernel(right, right))
            if (subsequence_kernel(left, right) / np.maximum(own, 1e-12)).max() > 0.75:
                continue
        chosen.append(word)
    return chosen


def _support_vector(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4, rounds: int = 600) -> tuple[np.ndarray, float]:
    """Linear machine with weighted hinge loss by averaged subgradient steps over the bounded sample."""
    sign = 2.0 * y - 1
    w, b, mean_w, mean_b = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    for t in range(1, rounds + 1):
        wrong = weight * (sign * (x @ w + b) < 1)
        step = 2.0 / np.sqrt(t)
        w -= step * (penalty * w - x.T @ (wrong * sign) / weight.sum())
        b += step * float((wrong * sign).sum() / weight.sum())
        if t > rounds // 2:
            mean_w, mean_b = mean_w + w, mean_b + b
    return mean_w / (rounds - rounds // 2), mean_b / (rounds - rounds // 2)


def _logistic(value: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small penalty."""
    x, theta = np.stack([value, np.ones_like(value)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        theta -= np.linalg.solve(hess, x.T @ (p - y) + 1e-3 * theta)
    return max(float(theta[0]), 0.0), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = 6000, landmarks: int = 64, label: str = "toxic") -> ToxicityModel:
    """Model from at most about ``per_class`` labelled texts of each class; without both classes, a constant."""
    sample = materialize(labelled_sample(docs, labels, label, learn, per_class), "sample")  # bounded by ``per_class``
    chosen = choose_landmarks(sample, landmarks)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = TextFeatures(chosen)
        for batch in batches:
            found = np.concatenate([*features.each(batch.column(0)), np.zeros((0, 2 * len(chosen)))])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(1), lists], ["y", "x"])

    rows = sample.select("text", "y").mapInArrow(released(featurise), "y int, x array<double>").toPandas()
    y = rows["y"].to_numpy(float)
    if not chosen:
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        return ToxicityModel([], np.zeros((0, 0)), np.zeros(0), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    x = np.stack(rows["x"].to_list())
    own = WordFeatures(chosen)
    pair = [(i, j) for i in range(len(chosen)) for j in range(len(chosen))]
    left, right = zip(*pair, strict=True)
    kernel = subsequence_kernel(own.codes[list(left)], own.codes[list(right)]).reshape(len(chosen), -1) / np.outer(own.own, own.own)
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    nystroem = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T
    z = _mapped(x, nystroem)
    # the sample is balanced by class only where the classes are large; the curve is fitted on the sample itself
    w, b = _support_vector(z, y, np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1)))
    slope, shift = _logistic(z @ w + b, y)
    return ToxicityModel(chosen, nystroem, w, b, slope, shift)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``score`` and ``predicted`` of every whole text; null counts as empty. Equal texts score equally."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = TextFeatures(model.landmarks)
        for batch in batches:
            found = np.concatenate([np.empty(0), *map(model.scores, features.each(batch.column(1)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array((found >= 0.5).astype(np.int32))], ["id", "score", "predicted"])

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(released(scored), "id bigint, score double, predicted int").withColumnRenamed("id", id_col)


def reject(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns, whatever these are called."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = TextFeatures(model.landmarks)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield part.filter(pa.array(model.scores(features.of(part.column(place).to_pylist())) < threshold))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names may hold any sign
    return plain.mapInArrow(released(keep), plain.schema).toDF(*docs.columns)
