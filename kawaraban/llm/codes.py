"""Vectors compressed to one codebook entry per part, exactly in integers.

Every component x becomes floor(SCALE * x). A vector is cut into consecutive
parts of equal width, each coded by the nearest entry of its position's codebook.
Codebooks start as the parts of the first vectors and are moved to the floor of
the mean of their parts in a fixed number of rounds.

Nearest entries are found in the Walsh-Hadamard domain. Parts and entries are
padded with zeros to a power of two P and transformed by additions alone; the
transform keeps squared distances but for the factor P. Squared differences are
added up in sequency order, slow changes first, where most of a distance tends to
lie; an entry is dropped as soon as its sum passes P times the distance of an entry
that looked nearest after the first few. All numbers are integers: 64 bits wide
where no sum can overflow, else Python's own.

A round is one pass: tasks add up parts per entry, Spark adds the tasks' sums, and
the driver gets one row per entry and 32-bit digit of the sums. Codebooks, the only
data sent to tasks, have `entries` vectors in all, whatever the table's size.

Defined results: vectors that are null or hold null or non-finite components are
left out. Rows are taken one by one, repeated ones too. First vectors: by vec_id
(null last), then by components. Vectors shorter than the longest, and lengths
that `parts` does not divide, are filled up with zeros. Fewer vectors than entries
make smaller codebooks. Errors beyond a long are null, sums over them leave them
out and are null beyond a long. An empty table gives empty codebooks and an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawaraban.llm.words import small_batches
from kawaraban.session import staged

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Pairs of part and entry looked at together.
_PAIRS = 1 << 16
#: Pairs are singled out when at most one in so many is open.
_FEW = 8
_DIGIT = 32

#: Per part: its entries by row, Python integers.
Codebooks = list[np.ndarray]


def _fits(most: int) -> bool:
    return most < 2**63


def _most(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of finite numbers."""
    if not values.size or np.abs(values).max() < 2.0**40:
        return np.floor(values * SCALE).astype(np.int64)
    # From 2**53 on, every double is a whole number.
    return np.array([int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in values.tolist()], object)


def sequency_order(size: int) -> np.ndarray:
    """Rows of the Hadamard matrix of this size (a power of two) by their number of sign changes."""
    s = np.arange(size)
    gray, out = s ^ (s >> 1), np.zeros(size, np.int64)
    for _ in range(size.bit_length() - 1):
        out = (out << 1) | (gray & 1)
        gray = gray >> 1
    return out


def walsh(rows: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, zero-padded to a power of two, in sequency order."""
    n, width = rows.shape
    size = 1 << max(0, width - 1).bit_length()
    out = np.zeros((n, size), rows.dtype)
    out[:, :width] = rows
    half = 1
    while half < size:
        both = out.reshape(n, size // (2 * half), 2, half)
        a, b = both[:, :, 0], both[:, :, 1]
        out = np.stack([a + b, a - b], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency_order(size)]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of every part (ties to the lower one) and the squared distance."""
    width = parts.shape[1]
    size = 1 << max(0, width - 1).bit_length()
    kind = np.int64 if _fits(size * max(1, width) * (_most(parts) + _most(book)) ** 2) else object
    entries = walsh(book.astype(kind))
    codes, distances = np.empty(len(parts), np.int64), np.empty(len(parts), kind)
    step = max(1, _PAIRS // len(book))
    for at in range(0, len(parts), step):
        rows = walsh(parts[at : at + step].astype(kind))
        codes[at : at + step], distances[at : at + step] = _nearest(rows, entries)
    return codes, distances // size


def _nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size, done = rows.shape[1], 0
    sums = np.zeros((len(rows), len(entries)), rows.dtype)
    bound = None
    # All pairs go on together while many are open, then the open ones alone.
    while True:
        for k in range(done, min(size, done + 4)):
            d = rows[:, k, None] - entries[None, :, k]
            d *= d
            sums += d
        done = min(size, done + 4)
        looks = ((rows - entries[np.argmin(sums, axis=1)]) ** 2).sum(axis=1)
        bound = looks if bound is None else np.minimum(bound, looks)
        open_ = sums <= bound[:, None]
        if done == size or _FEW * np.count_nonzero(open_) <= open_.size:
            break
    row, entry = np.nonzero(open_)
    total = sums[row, entry]
    while done < size:
        to = min(size, done + 8)
        total = total + ((rows[row, done:to] - entries[entry, done:to]) ** 2).sum(axis=1)
        left = np.flatnonzero(total <= bound[row])
        row, entry, total = row[left], entry[left], total[left]
        done = to
    each = np.arange(len(rows))
    least = np.minimum.reduceat(total, np.searchsorted(row, each))
    hits = np.flatnonzero(total == least[row])
    return entry[hits[np.searchsorted(row[hits], each)]], least


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles), label of the rows whose vector is whole."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return rows.filter(F.col("embedding").isNotNull() & ~F.exists("embedding", odd))


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    """The scaled vectors of a list column, one per row, filled up to this length."""
    flat = scaled(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    n = np.diff(column.offsets.to_numpy())
    if (n == length).all():
        return flat.reshape(len(n), length)
    out = np.zeros((len(n), length), flat.dtype)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(np.arange(len(n)), n), place] = flat
    return out


def _width(books: Codebooks) -> int:
    return books[0].shape[1]


def _split(column: pa.Array, books: Codebooks) -> list[np.ndarray]:
    width = _width(books)
    rows = _matrix(column, width * len(books))
    return [rows[:, p * width : (p + 1) * width] for p in range(len(books))]


def _digits(sums: np.ndarray) -> Iterator[list[list[int]]]:
    """Integers as digits of _DIGIT bits, low ones first; the last one has the sign."""
    more = True
    while more:
        last = all(-(1 << _DIGIT) <= x < 1 << _DIGIT for row in sums.tolist() for x in row)
        yield (sums if last else sums & ((1 << _DIGIT) - 1)).tolist()
        sums, more = sums >> _DIGIT, not last


def _moved(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """The codebooks after one round."""
    width = _width(books)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, object) for b in books]
        for batch in batches:
            for p, part in enumerate(_split(batch.column("embedding"), books)):
                if not len(part):
                    continue
                part = part if _fits(_most(part) * len(part)) else part.astype(object)
                codes, _ = nearest(part, books[p])
                order = np.argsort(codes, kind="stable")
                used, first = np.unique(codes[order], return_index=True)
                counts[p] += np.bincount(codes, minlength=len(books[p]))
                sums[p][used] += np.add.reduceat(part[order], first, axis=0).astype(object)
        for p, n in enumerate(counts):
            used = np.flatnonzero(n)
            for digit, values in enumerate(_digits(sums[p][used])):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p] * len(used), pa.int32()),
                        pa.array(used, pa.int32()),
                        pa.array([digit] * len(used), pa.int32()),
                        pa.array(n[used] if digit == 0 else np.zeros(len(used), np.int64)),
                        pa.array(values, pa.list_(pa.int64())),
                    ],
                    ["part", "entry", "digit", "n", "sums"],
                )

    told = vectors.select("embedding").mapInArrow(add_up, "part int, entry int, digit int, n long, sums array<long>")
    places = F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(width))).cast("array<long>")
    totals = told.groupBy("part", "entry", "digit").agg(F.sum("n").alias("n"), places.alias("sums"))
    # One row per entry and digit: bounded by the codebooks.
    counts, sums = [np.zeros(len(b), object) for b in books], [np.zeros(b.shape, object) for b in books]
    for r in totals.collect():
        counts[r["part"]][r["entry"]] += r["n"]
        if width:
            sums[r["part"]][r["entry"]] += np.array(r["sums"], object) << (_DIGIT * r["digit"])
    return [np.where(n[:, None] > 0, s // np.maximum(n, 1)[:, None], b) for n, s, b in zip(counts, sums, books, strict=True)]


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """The codebooks of the usable vectors after `rounds` rounds."""
    small_batches(vectors.sparkSession)
    rows = usable(vectors)
    length = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = -(-length // parts)
    first = rows.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries)
    start = [r["embedding"] for r in first.collect()]
    whole = _matrix(pa.array(start, pa.list_(pa.float64())), width * parts).astype(object)
    books = [whole[:, p * width : (p + 1) * width] for p in range(parts)]
    for _ in range(rounds if start else 0):
        books = _moved(rows, books)
    return books


def digest(books: Codebooks) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for row in b.tolist() for x in row).encode()).hexdigest()


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part, more beyond 256 entries), error of every usable vector."""
    small_batches(vectors.sparkSession)
    schema = vectors.select("vec_id", "label").schema
    digits = max(2, len(f"{max(0, len(books[0]) - 1):x}"))
    names = np.array([f"{i:0{digits}x}" for i in range(len(books[0]))], object)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text, error = np.full(batch.num_rows, "", object), np.zeros(batch.num_rows, object)
            for part, book in zip(_split(batch.column("embedding"), books), books, strict=True):
                codes, distances = nearest(part, book)
                text = text + names[codes]
                error = error + distances
            errors = pa.array([x if _fits(x) else None for x in error.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), errors], ["vec_id", "label", "code", "error"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return usable(vectors).mapInArrow(code, f"{kinds}, code string, error long")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """`coded` with label_error, the sum of the errors of all rows of the same label; nulls are one label.

    A label is one row of sums, whatever the number of its vectors: sums are made
    within tasks first, and rows join a table of known size.
    """
    coded = staged(coded, "codes")
    sums = staged(coded.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
