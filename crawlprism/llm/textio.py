"""Texts of an Arrow batch as flat byte arrays, in pieces of bounded size, with vectorised word hashes.

A word is a maximal run of bytes other than space and 0x09-0x0D. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text worked on at once; a longer text is a piece of its own.
PIECE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_CODES = np.random.RandomState(7).randint(1, 1 << 62, 256).astype(np.uint64) | np.uint64(1)


# Rows of text that Spark hands to a task at once; its own default fits numbers.
BATCH_ROWS = 256


def small_batches(spark) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows in this session, unless it asks for fewer.

    Without that a task may have to hold ten thousand long texts, twice on either side.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges ``[starts, ends)``, which ascend and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        power, inverse = _powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_CODES[data[lo:hi]] * power[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string or binary array, end to end, and the offset of each (one more than there are texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = PIECE) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``size`` bytes of text each, with their bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = texts(batch.column(batch.schema.names.index(column)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (one more than there are texts)."""
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a value for each byte or word, for each text."""
    sums = np.zeros(len(values) + 1, values.dtype if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside one text, and for each text the index of its first run."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    begin = np.concatenate([[0], np.cumsum(counts)])
    total = max(0, len(hashes) - width + 1)
    out = np.zeros(total, np.uint64)
    for k in range(width):
        out = out * _BASE + hashes[k : k + total]
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], counts)
    return mix(out[at]), begin
