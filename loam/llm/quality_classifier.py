"""Quality classifier: histogram gradient-boosted trees over document statistics, flattened into arrays."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm import common
from loam.llm.quality_rules import duplicate_lines, repeated_words

#: Labelled rows that the trees are fitted on, about; they are chosen by a hash of doc_id from all labelled rows.
MAX_TRAIN_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3

_UPPER, _LOWER, _DIGIT = (np.array([i for i in range(256) if chr(i) in s]) for s in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"))
_SYMBOL, _STOP, _SPACE = (np.frombuffer(s, np.uint8) for s in (b"#*$%&|<>@^~=+\\{}[]_", b".,;:?", b" \t\n\x0b\f\r"))
_VOWEL = np.frombuffer(b"aeiouAEIOU", np.uint8)


def statistics(data: bytes) -> list[float]:
    """Numbers that describe a text's form, whatever its language; all 0 for an empty text."""
    size, ws = len(data), data.split()
    n = len(ws)
    if not n:
        return [0.0] * N_STATISTICS
    of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    marks = size - int(of[_SPACE].sum())
    letters = max(1, int(of[_UPPER].sum() + of[_LOWER].sum()))
    counts = Counter(ws)
    lengths = np.fromiter(map(len, ws), np.float64, n)
    numbers = {w: i for i, w in enumerate(counts)}
    ids = np.fromiter((numbers[w] for w in ws), np.int64, n)
    top = counts.most_common(3)
    ends = Counter(w[-1] for w in ws)
    same = int((ids[1:] == ids[:-1]).sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    line_words = np.fromiter((len(x.split()) for x in lines), np.float64, len(lines))
    packed = len(zlib.compress(data, 3))
    odd_ends = sum(v for k, v in ends.items() if 32 < k < 127 and not chr(k).isalnum() and k not in b".,;:?")
    return [
        math.log1p(n),
        math.log1p(size),
        lengths.mean(),
        lengths.std(),
        lengths.max(),
        len(counts) / n,
        len(counts) / n**0.8,
        top[0][1] / n,
        sum(x[1] for x in top) / n,
        same / n,
        repeated_words(ids, 5) / n,
        repeated_words(ids, 2) / n,
        int(of[_UPPER].sum()) / letters,
        int(of[_DIGIT].sum()) / marks,
        int(of[_SYMBOL].sum()) / marks,
        int(of[_STOP].sum()) / n,
        int(of[33]) / n,
        int(of[124]) / n,
        int(of[128:].sum()) / marks,
        int(of[_VOWEL].sum()) / letters,
        odd_ends / n,
        (ends[46] + ends[63] + ends[33]) / n,
        sum(w.isupper() and len(w) > 1 for w in counts) / len(counts),
        sum(w[:1].isupper() for w in counts) / len(counts),
        sum(map(len, counts)) / len(counts),
        math.log1p(len(lines)),
        line_words.mean(),
        line_words.std(),
        duplicate_lines(data) / max(1, len(lines)),
        sum(x.rstrip().endswith((b".", b"?", b"!")) for x in lines) / max(1, len(lines)),
        packed / size,
        (packed - 8) / size * math.log1p(size),
    ]


N_STATISTICS = 32


@dataclass
class Trees:
    """Complete binary trees as arrays: a node's children are 2 i + 1 and 2 i + 2; leaves have values only."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray  # go right if the feature is above it
    value: np.ndarray  # trees x leaves

    def raw(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), self.base)
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        while at[0, 0] < inner if len(x) else False:
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.limit[trees, at])
        return self.base + self.value[trees, at - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 100, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 2.0, min_weight: float = 4.0) -> Trees:
    """Boost logistic loss on binned features. With one class only, or no rows, the score is the share of label 1."""
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
    model = Trees(math.log(share / (1 - share)), np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if not len(y) or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    raw = np.full(len(y), model.base)
    features, limits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        feature, limit, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            node = at - first
            best, cut = np.full(width, 1e-6), np.full(width, -1)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                key, size = node * bins + binned[:, j], width * bins
                sums_g = np.bincount(key, g, size).reshape(width, bins).cumsum(axis=1)
                sums_h = np.bincount(key, h, size).reshape(width, bins).cumsum(axis=1)
                all_g, all_h = sums_g[:, -1:], sums_h[:, -1:]
                right_g, right_h = all_g - sums_g, all_h - sums_h
                gain = sums_g**2 / (sums_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
                gain = np.where((sums_h >= min_weight) & (right_h >= min_weight), gain, 0)[:, : len(e)]
                k = gain.argmax(axis=1)
                found = gain[np.arange(width), k]
                better = found > best
                best[better], cut[better], feature[first : first + width][better] = found[better], k[better], j
            for i in np.flatnonzero(cut >= 0):
                limit[first + i] = edges[feature[first + i]][cut[i]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
        leaf = at - inner
        value = rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        raw += value[leaf]
        features.append(feature), limits.append(limit), values.append(value)
    return Trees(model.base, np.array(features), np.array(limits), np.array(values))


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics((t or "").encode()) for t in texts], np.float64).reshape(len(texts), N_STATISTICS)


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Trees:
    """Fit the trees on labelled documents outside the held-out fold. Documents with several labels take the lowest, ids with
    several texts one of these, by hash; null ids and null labels don't train."""
    common.bounded_batches(docs.sparkSession)
    usable = labels.where(F.col("quality").isNotNull() & (common.remainder(F.col("doc_id"), FOLDS) != 0))
    share = max_rows / max(1, usable.count())
    sample = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(min(1, share) * (1 << 30)))
    sample = sample.groupBy("doc_id").agg(F.min("quality").alias("quality"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        for batch in batches:
            for part in common.slices(batch, "text"):
                x = _matrix(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    # the sample has about max_rows rows whatever the input, so it can be broadcast and its statistics collected
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"), F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = sorted(rows.mapInArrow(run, "doc_id long, quality int, x array<double>").collect())
    x, y = np.array([r.x for r in rows]).reshape(len(rows), N_STATISTICS), np.array([r.quality for r in rows], np.float64)
    return fit(x, y)


def score_quality(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text, in one pass without shuffle.

    Null texts score as empty ones. Null ids are not held out. Repeated rows score alike; other columns aren't read.
    """
    common.bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce(common.remainder(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        for batch in batches:
            for part in common.slices(batch, "text"):
                score = model.score(_matrix(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score_quality(docs, train(docs, common.table(spark, sf_dir, "labels")))
