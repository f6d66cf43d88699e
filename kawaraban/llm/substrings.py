"""Word sequences that occur more than once, found by doubling their length level by level.

Level 1: which windows of WINDOW words also start elsewhere (`repeats.answered`
over all documents). Each further level doubles the length: a window of twice
the length is a candidate only if both its halves were found repeated one level
before, and only candidates are counted. The levels end when no candidate is
left. Words covered by a repeated window of level 1 are removed; the longest
level tells how long a repetition is.

Levels after the first work on the word hashes of the repeated runs alone, not
on texts. Windows are compared by 64-bit hash, of which level 1 sends 7 bytes and
the range of values (`repeats`), further levels all 8.

Defined results: null text has no words; texts of fewer than WINDOW words lose
none. A window that comes twice in one text, or in two equal rows, is repeated.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawaraban.llm import repeats
from kawaraban.llm.words import Words, covered, sequences
from kawaraban.session import staged

WINDOW = 35


def _runs(flags: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags; a run ends where a row does."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(flags & (edge[:-1] | ~np.concatenate([[False], flags[:-1]]))) if len(flags) else np.empty(0, np.int64)
    ends = np.flatnonzero(flags & (edge[1:] | ~np.concatenate([flags[1:], [False]]))) + 1 if len(flags) else np.empty(0, np.int64)
    return starts, ends


def _first_level(window: int):
    """The rows of a segment's answers as result rows: digests of what is left, and the repeated runs."""

    def keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(Words(part.column("text")).windows(window)[0], return_counts=True)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, classes, check in repeats.read(batches, ["doc_id", "text"]):
            words = Words(part.column("text"))
            hashes, at, _ = words.windows(window)
            found, place, times = np.unique(hashes, return_inverse=True, return_counts=True)
            again = (repeats.matched(found, classes, check) > 0)[place]
            gone = covered(len(words.starts), at[again], window)
            starts = np.zeros(len(words.starts), bool)
            starts[at[again]] = True
            first, last = _runs(starts, words.bounds)
            data, kept = words.data.tobytes(), []
            n_removed = np.zeros(len(words.counts), np.int64)
            for row, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True)):
                pieces = data[words.offsets[row] : words.offsets[row + 1]].split()
                drop = gone[a:b]
                n_removed[row] = drop.sum()
                if n_removed[row]:
                    pieces = [p for p, d in zip(pieces, drop.tolist(), strict=True) if not d]
                kept.append(b" ".join(pieces))
            owner = np.searchsorted(words.bounds, first, "right") - 1
            run = pa.struct([("start", pa.int64()), ("starts", pa.int64()), ("words", pa.binary())])
            flat = pa.StructArray.from_arrays(
                [
                    pa.array(first - words.bounds[owner], pa.int64()),
                    pa.array(last - first, pa.int64()),
                    pa.array([words.hashes[a : b + window - 1].tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
                ],
                fields=list(run),
            )
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(n_removed) + 1)), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string()), runs],
                ["doc_id", "n_words", "n_removed", "kept", "runs"],
            )

    return keys, remove


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of documents: doc_id, n_words, n_removed, kept (the words left, joined by one space), runs.

    runs: start (word), starts (number of repeated windows that begin there, one
    after the other), words (their words' hashes).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys, remove = _first_level(window)
    segments = repeats.answered(docs.select("doc_id", "text"), "text", keys)
    return segments.mapInArrow(
        remove, f"doc_id {kind}, n_words long, n_removed long, kept string, runs array<struct<start: long, starts: long, words: binary>>"
    )


def _next_level(length: int):
    """Of runs whose windows of `length` words are repeated: those whose windows of twice the length are."""

    def candidates(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        blobs = part.column("words").to_pylist()
        words = np.frombuffer(b"".join(blobs), np.uint64)
        bounds = np.concatenate([[0], np.cumsum([len(x) // 8 for x in blobs])]).astype(np.int64)
        # Both halves begin in the run, the second `length` words after the first.
        n = np.maximum(part.column("starts").to_numpy() - length, 0)
        row = np.repeat(np.arange(len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + bounds[:-1][row]
        return sequences(words, at, at + 2 * length), at, words, bounds

    def keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(candidates(part)[0], return_counts=True)

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, classes, check in repeats.read(batches, ["doc_id", "start", "starts", "words"]):
            hashes, at, words, bounds = candidates(part)
            found, place = np.unique(hashes, return_inverse=True)
            starts = np.zeros(len(words), bool)
            starts[at[(repeats.matched(found, classes, check) > 0)[place]]] = True
            first, last = _runs(starts, bounds)
            owner = np.searchsorted(bounds, first, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(owner)),
                    pa.array(part.column("start").to_numpy()[owner] + first - bounds[owner], pa.int64()),
                    pa.array(last - first, pa.int64()),
                    pa.array([words[a : b + 2 * length - 1].tobytes() for a, b in zip(first, last, strict=True)], pa.binary()),
                ],
                ["doc_id", "start", "starts", "words"],
            )

    return keys, extend


def longer_runs(runs: DataFrame, window: int = WINDOW) -> Iterator[tuple[int, DataFrame]]:
    """(length, runs) of the levels after the first, from the stored runs (doc_id, start, starts, words) of the first.

    doc_id is only handed on; give a row's own number to tell rows of one doc_id apart.
    """
    kind = runs.schema["doc_id"].dataType.simpleString()
    length = window
    while True:
        open_ = runs.filter(F.col("starts") > length)
        if open_.isEmpty():
            return
        keys, extend = _next_level(length)
        found = repeats.answered(staged(open_, "candidates"), "words", keys, width=8)
        runs = staged(found.mapInArrow(extend, f"doc_id {kind}, start long, starts long, words binary"), "runs")
        length *= 2
        yield length, runs
