"""Quality rules by compression bands: zstandard ratios of whole texts and of fixed chunks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from loam.llm import common

SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits of the compression ratio (compressed / plain bytes) for texts of under `below` bytes."""

    below: float
    low: float
    high: float


#: Short texts compress less, so each band of lengths has its own limits.
BANDS = (
    Band(64, 0.62, 2.0),
    Band(256, 0.58, 1.4),
    Band(512, 0.555, 0.90),
    Band(1024, 0.492, 0.82),
    Band(2048, 0.458, 0.75),
    Band(4096, 0.442, 0.72),
    Band(8192, 0.422, 0.70),
    Band(16384, 0.405, 0.68),
    Band(65536, 0.385, 0.66),
    Band(262144, 0.36, 0.66),
    Band(float("inf"), 0.30, 0.66),
)


@dataclass(frozen=True)
class Rules:
    bands: Sequence[Band] = BANDS
    level: int = 3
    chunk_bytes: int = 1024
    chunk_low: float = 0.485
    chunk_high: float = 0.74
    #: Rejected if more than this share of the chunks lies outside the chunk limits.
    max_bad_chunks: float = 0.3
    min_words: int = 10
    max_repeat_percent: int = 20
    window: int = 5


OUTPUT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, n_chunks long, n_bad_chunks long, reason string, kept boolean"


def repeated_words(ids: np.ndarray, window: int) -> int:
    """Words inside windows of `window` words that the text has twice or more, the first one included."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    key = ids[:n].astype(np.int64)
    for j in range(1, window):
        # numbered densely at each step, so that the keys stay exact and small
        if j > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * (int(ids.max()) + 1) + ids[j : n + j]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    edges = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + window, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def duplicate_lines(data: bytes) -> int:
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def chunks(data: bytes, size: int) -> list[bytes]:
    """The whole chunks of a text and, where it goes on behind them, its last `size` bytes. A text that isn't longer than a
    chunk has none: the limits of whole texts judge it."""
    if len(data) <= size:
        return []
    out = [data[i : i + size] for i in range(0, len(data) - size + 1, size)]
    return out + [data[-size:]] if len(data) % size else out


def judge(data: bytes, rules: Rules, pack: zstandard.ZstdCompressor) -> tuple:
    """The values of OUTPUT for a text's UTF-8 bytes."""
    ws = data.split()  # bytes split at exactly the white space of common.SPACE
    n = len(ws)
    joined = b"".join(ws)
    word_chars = len(joined.decode("utf-8", "replace"))
    symbols = sum(joined.count(SYMBOLS[i : i + 1]) for i in range(len(SYMBOLS)))
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, n)
    repeats = repeated_words(ids, rules.window)
    failed = n < rules.min_words or 100 * repeats > rules.max_repeat_percent * n
    reason = "words" if n < rules.min_words else "repeats" if failed else None
    size = len(data)
    ratio = len(pack.compress(data)) / size if size else None
    parts = chunks(data, rules.chunk_bytes)
    bad = sum(not rules.chunk_low <= len(pack.compress(x)) / rules.chunk_bytes <= rules.chunk_high for x in parts)
    if reason is None and ratio is not None:
        band = next(b for b in rules.bands if size < b.below)
        if ratio < band.low:
            reason = "repetitive"
        elif ratio > band.high:
            reason = "incompressible"
        elif bad > rules.max_bad_chunks * len(parts):
            reason = "chunks"
    return n, word_chars, symbols, duplicate_lines(data), repeats, failed, ratio, len(parts), bad, reason, reason is None


def quality_rules(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, rules: Rules = Rules()) -> DataFrame:
    """Judge every whole text; adds the columns of OUTPUT to the columns `keep` (all by default).

    A text is rejected by the base rule, by its ratio, whose limits depend on its length, or by its chunks, the last one
    reaching back from the text's end; n_bad_chunks counts them whatever else a text fails. Null and empty texts have no words and so fail the base rule; their ratio is null. Repeated rows are judged
    alike. Columns of docs that share a name with one of OUTPUT are left out. One pass, no shuffle.
    """
    common.bounded_batches(docs.sparkSession)
    added = [f.split()[0] for f in OUTPUT.split(", ")]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    own = common.free_name("own_text", kept)
    source = docs.select(*kept, docs[text].alias(own))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + [OUTPUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.return_memory()
        pack = zstandard.ZstdCompressor(level=rules.level)
        for batch in batches:
            for part in common.slices(batch, own):
                rows = [judge((t or "").encode(), rules, pack) for t in part.column(own).to_pylist()]
                values = list(zip(*rows, strict=True)) if rows else [()] * len(added)
                kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(part.columns[:-1] + [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=kept + added)

    return source.mapInArrow(run, schema)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(common.table(spark, sf_dir, "documents"), keep=["doc_id"])
