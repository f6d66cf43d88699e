"""Words of an Arrow text column as numpy arrays: bounds, 64-bit hashes, window hashes.

All functions work on the column's own bytes, about a MB of whole documents at a
time, so memory is bounded by the longest single document. Hashes are
polynomials modulo 2**64 over mixed values: equal sequences have equal hashes,
different ones differ but for a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
import functools
import re
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: ASCII white space: the bytes between words of [^\x20\x09-\x0D]+.
SPACES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes between words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z).
MARKS = np.isin(
    np.arange(256), [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
)
#: Lower case of A-Z, all other bytes unchanged.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_BYTES = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = {"byte": 0x9E3779B97F4A7C15, "word": 0xD1342543DE82EF95}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}
_SPAN = 1 << 20
#: Bytes of an Arrow batch.
BATCH = 8 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and those of its inverse; at least n of them."""
    if kind not in _POWERS or len(_POWERS[kind][0]) < n:
        base = _BASE[kind]
        size = max(n, _SPAN + 64)
        both = []
        for b in (base, pow(base, -1, 2**64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _POWERS[kind] = both[0], both[1]
    return _POWERS[kind]


def _sequences(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: str, table: np.ndarray | None = None) -> np.ndarray:
    """Hash of each values[start:end], looked up in table if given; starts and ends ascend, ranges are not empty."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + _SPAN, "right")))
        part = values[base : int(ends[to - 1])]
        part = part if table is None else table[part]
        power, inverse = _powers(kind, len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * power[: len(part)], out=total[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)
        at = to
    return mix(out)


class Words:
    """The words of a text column.

    bounds[i]:bounds[i + 1] are the words of row i; starts and ends are their
    places in data; hashes are made when first asked for.
    """

    def __init__(self, texts: pa.Array, between: np.ndarray = SPACES, lower: bool = False):
        self.data, self.offsets = text_bytes(texts)
        if lower:
            self.data = LOWER[self.data]
        n = len(self.data)
        inside = ~between[self.data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        cuts = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self._hashes: np.ndarray | None = None

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = spans(self.data, self.starts, self.ends)
        return self._hashes

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word (in the column) and row of every window of `size` words within a row."""
        n = np.maximum(self.counts - size + 1, 0)
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.bounds[:-1][row]
        if not len(at):
            return np.empty(0, np.uint64), at, row
        return _sequences(self.hashes, at, at + size, "word"), at, row

    def sequences(self, rows: np.ndarray) -> np.ndarray:
        """Hash of the whole word sequence of each of these rows, which have words."""
        return _sequences(self.hashes, self.bounds[rows], self.bounds[rows + 1], "word")


def sequences(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run values[start:end] of word hashes; starts ascend, runs are not empty."""
    return _sequences(values, starts, ends, "word")


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch data[start:end] of bytes; starts ascend, stretches are not empty."""
    return _sequences(data, starts, ends, "byte", _BYTES) if len(starts) else np.empty(0, np.uint64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the rows' offsets in them; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of flags over each offsets[i]:offsets[i + 1]."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n places lie in any starts[i]:starts[i] + size."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + size, -1)
    return np.cumsum(edge)[:n] > 0


def small_batches(spark: SparkSession) -> None:
    """Let Spark send rows to Python in batches of at most BATCH bytes, instead of 64 MB.

    A task then holds a few MB on either side. It is a setting of the session,
    and a smaller one stays.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?[0-9]+)([kmgtp]?)b?", spark.conf.get(name).strip().lower()).groups()
    if not 0 < int(number) << 10 * " kmgtp".index(unit or " ") <= BATCH:
        spark.conf.set(name, f"{BATCH}b")


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


#: Where a Python worker keeps what outlives a task.
WORKER = "kawaraban_worker"


def released(work: Work, keeps: bool = False) -> Work:
    """`work`, after which what a task has freed goes back to the system.

    Python workers outlive their tasks; without this, each keeps its largest
    task's memory. What earlier tasks left in the worker (`tokens.encoder`) is
    dropped first, unless this work uses it.
    """

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            sys.modules.pop(WORKER, None)
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of whole rows with at most `size` bytes of text, or one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        total = np.concatenate([[0], np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))])
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(total, total[at] + size, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
