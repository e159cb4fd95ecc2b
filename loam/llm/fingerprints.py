"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loam.llm import common

#: Samples of a signature, each kept as 16 bits.
SAMPLES = 64
#: Words whose random variables a task remembers.
WORD_CACHE = 40_000
#: Words of a text that are sampled at once.
SLICE_WORDS = 4_096
#: Longest length, in bytes, that adds to a word's weight.
LONGEST = 16

_GOLD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _MIX1
    z = (z ^ (z >> np.uint64(27))) * _MIX2
    return z ^ (z >> np.uint64(31))


def weights(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """A text's distinct words and their weights: more for repeated words, in logarithm, and for long ones, which are
    rarer. They depend on the text only."""
    counts = Counter((text or "").encode().split())
    ws = list(counts)
    times = np.fromiter(counts.values(), np.float64, len(ws))
    return ws, (1 + np.log(times)) * np.fromiter((min(len(w), LONGEST) for w in ws), np.float64, len(ws))


class Sampler:
    """Signatures whose rate of equal samples estimates the generalised Jaccard similarity of the weights.

    Each word has, for each sample, gamma(2, 1) variables r and c and a uniform b, made from a hash of the word. The
    weight is moved to a point of the word's own grid in ln weight, of step r, and the word whose variable c over the
    next point of the grid is least is the sample, with the point's number.
    """

    def __init__(self, samples: int = SAMPLES, cache: int = WORD_CACHE) -> None:
        self.samples, self.cache = samples, cache
        self.place: dict[bytes, int] = {}
        self.hash = np.zeros(0, np.uint64)
        self.table = np.zeros((3, 0, samples), np.float32)  # r, ln c, b
        self.used = 0

    def _places(self, ws: list[bytes]) -> np.ndarray:
        if self.used + len(ws) > self.cache:
            self.place.clear()
            self.used = 0
        new = [w for w in ws if w not in self.place]
        if new:
            need = self.used + len(new)
            if need > len(self.hash):
                size = max(need, min(self.cache, 2 * len(self.hash) + 1024))
                self.hash = np.concatenate([self.hash[: self.used], np.zeros(size - self.used, np.uint64)])
                self.table = np.concatenate([self.table[:, : self.used], np.zeros((3, size - self.used, self.samples), np.float32)], axis=1)
            h = np.array([xxhash.xxh64_intdigest(w) for w in new], np.uint64)
            steps = np.arange(1, 5 * self.samples + 1, dtype=np.uint64) * _GOLD
            u = ((_mixed(h[:, None] + steps) >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24)
            u = u.reshape(len(new), 5, self.samples)
            at = slice(self.used, need)
            self.hash[at] = h
            self.table[0, at] = -np.log(u[:, 0] * u[:, 1])
            self.table[1, at] = np.log(-np.log(u[:, 2] * u[:, 3]))
            self.table[2, at] = u[:, 4]
            self.place.update(zip(new, range(self.used, need), strict=True))
            self.used = need
        return np.fromiter((self.place[w] for w in ws), np.int64, len(ws))

    def signature(self, text: str | None) -> np.ndarray:
        """16-bit samples; none for a text without words. Words are taken in slices, of which the least values are kept, so
        that a text of many distinct words needs no more memory than its words."""
        ws, w = weights(text)
        if not ws:
            return np.zeros(0, np.uint16)
        k = np.arange(self.samples)
        least, hashes, points = np.full(self.samples, np.inf, np.float32), np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.uint64)
        for i in range(0, len(ws), SLICE_WORDS):
            at = self._places(ws[i : i + SLICE_WORDS])
            r, ln_c, b = (self.table[j][at] for j in range(3))
            point = np.floor(np.log(w[i : i + SLICE_WORDS]).astype(np.float32)[:, None] / r + b)
            value = ln_c - r * (point - b) - r
            first = value.argmin(axis=0)
            better = value[first, k] < least
            least = np.where(better, value[first, k], least)
            hashes = np.where(better, self.hash[at[first]], hashes)
            points = np.where(better, point[first, k].astype(np.int64).astype(np.uint64), points)
        return (_mixed(hashes + points * _GOLD) >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal samples; texts without words are like each other and nothing else."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    return float((a == b).mean())


def written(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


def edited(text: str, following: str) -> str:
    """text with its last half replaced by as many code points from the start of the following text, or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [f.split()[0] for f in SCHEMA.split(", ")]


def _row(sampler: Sampler, key, text: str, own: np.ndarray, following: str, other: np.ndarray) -> tuple:
    changed = edited(text, following)
    signature = sampler.signature(changed)
    return key, len(text), hashlib.sha256(changed.encode()).hexdigest(), written(own), written(signature), likeness(own, signature), likeness(own, other)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, fingerprint (hexadecimal, 4 digits a sample) of every text. One pass, no shuffle. Null texts are
    empty; texts without words have an empty fingerprint; equal texts have equal ones."""

    common.bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        sampler = Sampler()
        for batch in batches:
            rows = [(k, len(t or ""), written(sampler.signature(t))) for k, t in zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1)), strict=True)]
            yield _batch(rows, [pa.int64(), pa.int64(), pa.string()], ["doc_id", "n_chars", "fingerprint"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """SCHEMA for every document: its fingerprint, that of its text after an edit, and their likeness to each other and
    to the next document's, in ascending order of the key (null keys first, ties by text), the first after the last.

    Documents are dealt by ranges of the key and ordered there, so that all but a range's last have their next one
    beside them; the last ones meet the first ones of the following ranges in a table of two rows a range.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        part, sampler, before = TaskContext.get().partitionId(), Sampler(), None
        names, kinds = [*_NAMES, "part", "edge", "text"], [*_KINDS, pa.int32(), pa.string(), pa.string()]
        for batch in batches:
            out = []
            for k, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                t = t.as_py()
                own = sampler.signature(t)
                if before is None:
                    out.append((k, None, None, None, None, None, None, part, "first", t))
                else:
                    out.append((*_row(sampler, *before, t, own), part, None, None))
                before = k, t, own
            yield _batch(out, kinds, names)
        if before:
            yield _batch([(before[0], None, None, None, None, None, None, part, "last", before[1])], kinds, names)

    found = common.shared_table(ordered.mapInArrow(run, f"{SCHEMA}, part int, edge string, text string"), "fingerprints")
    # two rows a range, whatever the input; the numbers of the ranges that have rows go to the driver, their texts don't
    parts = sorted(r.part for r in found.where("edge = 'first'").select("part").collect())
    after = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next int")
    firsts = found.where("edge = 'first'").select(F.col("part").alias("next"), F.col("text").alias("following"))
    lasts = found.where("edge = 'last'").select("doc_id", "text", "part")
    pairs = lasts.join(F.broadcast(after), "part").join(firsts.hint("merge"), "next")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for batch in batches:
            rows = []
            for k, t, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                rows.append(_row(sampler, k, t, sampler.signature(t), following, sampler.signature(following)))
            yield _batch(rows, _KINDS, _NAMES)

    closed = pairs.select("doc_id", "text", "following").mapInArrow(close, SCHEMA)
    return found.where("edge is null").select(*_NAMES).unionByName(closed)


def op10_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(common.table(spark, sf_dir, "documents"))
