"""Repeated runs of lines, found by winnowing, with all but the first one deleted.

Lines without a word are passed over. A window is the shortest run of lines from
a given line on that has at least WORDS words, or the shortest one up to a given
line. Each window selects the line of the smallest hash (the last among equals)
as fingerprint; equal windows have the same fingerprint in both places. So only
windows whose fingerprint is selected at two places or more are compared: each is
matched with the first window of equal lines, in the order of doc_id, then text,
then line, and the lines of the later window are deleted.

So exactly the lines of those runs of WORDS words or more go that have an equal
run at an earlier place: in such a run, the windows from its lines on reach to
the end of the last that fits, and the window up to its last line begins where
that one does. All of them lie in the run, so each has its equal in the earlier
one, whichever place is the first that holds it.

A deleted line has an equal line at an earlier place, so one copy of everything
stays. Lines are compared by 64-bit hash.

Defined results: null text stays null; texts of fewer than WORDS words lose
nothing, however often they occur. Rows with equal doc_id and text are one place
and lose the same lines. Documents of one doc_id follow each other by a hash of
their text. Empty tables give empty results; all other columns are kept as they
are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kawaraban.llm.words import SPACES, Words, pieces, released, sequences, small_batches
from kawaraban.session import staged

WORDS = 50

_LINE_ENDS = np.arange(256) == 0x0A


def place_key(docs: DataFrame) -> Column:
    """One value per doc_id and text."""
    return F.xxhash64(docs["doc_id"], docs["text"])


def windows_of(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, ...]:
    """The lines with words of a column, and their windows.

    (hashes, numbers, bounds) of the lines: numbers count from 0 in the text,
    bounds are the rows' places among the lines. (at, size, window, fingerprint,
    place, row) of the windows, by row: first line, lines, hashes of all lines and
    of the selected one, its place, row. A run that is the window of its first line
    and of its last one comes once.
    """
    lines = Words(texts, _LINE_ENDS)
    inside = ~SPACES[lines.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begun = np.concatenate([[0], np.cumsum(first)])
    many = begun[lines.ends] - begun[lines.starts] + (inside[lines.starts] & ~first[lines.starts] if len(lines.starts) else 0)
    ends = np.concatenate([[0], np.cumsum(lines.data == 0x0A)])
    row = np.repeat(np.arange(len(lines.counts)), lines.counts)
    keep = many > 0
    row, many = row[keep], many[keep]
    numbers = (ends[lines.starts] - ends[lines.offsets[:-1]][np.repeat(np.arange(len(lines.counts)), lines.counts)])[keep]
    hashes = lines.hashes[keep]
    bounds = np.searchsorted(row, np.arange(len(lines.counts) + 1))
    total = np.concatenate([[0], np.cumsum(many)])
    at = np.arange(len(hashes))
    end = np.searchsorted(total, total[:-1] + words)
    until = np.arange(1, len(hashes) + 1)
    since = np.searchsorted(total, total[1:] - words, "right") - 1
    ok = end <= bounds[1:][row] if len(row) else np.zeros(0, bool)
    back = since >= bounds[:-1][row] if len(row) else np.zeros(0, bool)
    back[back] = end[since[back]] != until[back]
    lists = [(at[ok], end[ok], row[ok]), (since[back], until[back], row[back])]
    whole = np.concatenate([sequences(hashes, a, e) for a, e, _ in lists])
    at, end, row = (np.concatenate(x) for x in zip(*lists, strict=True))
    order = np.argsort(row, kind="stable")
    at, end, row, whole = at[order], end[order], row[order], whole[order]
    if not len(at):
        nothing = np.empty(0, np.int64)
        return hashes, numbers, bounds, at, nothing, np.empty(0, np.uint64), np.empty(0, np.uint64), nothing, row
    ranges = np.column_stack([at, end]).ravel()
    least = np.minimum.reduceat(np.append(hashes, np.uint64(2**64 - 1)), ranges)[::2]
    place = np.array([e - 1 - int(np.argmin(hashes[a:e][::-1])) for a, e in zip(at, end, strict=True)], np.int64)
    return hashes, numbers, bounds, at, end - at, whole, least, place, row


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    window = pa.struct([("at", pa.int32()), ("size", pa.int32()), ("window", pa.int64()), ("fingerprint", pa.int64()), ("place", pa.int32())])
    for part in pieces(batches):
        _, numbers, bounds, at, size, whole, least, place, row = windows_of(part.column("text"))
        blob = lambda x, kind: pa.array([x[a:b].astype(kind).tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
        flat = pa.StructArray.from_arrays(
            [pa.array(at - bounds[row], pa.int32()), pa.array(size, pa.int32()), pa.array(whole.astype(np.int64)), pa.array(least.astype(np.int64)), pa.array(place - bounds[row], pa.int32())],
            fields=list(window),
        )
        found = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(bounds))), pa.int32()), flat)
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), part.column("key"), blob(numbers, np.int32), found],
            ["doc_id", "key", "numbers", "windows"],
        )


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Line numbers of the lines in any later window of a document."""
    for batch in batches:
        gone = []
        for numbers, found in zip(batch.column("numbers").to_pylist(), batch.column("later").to_pylist(), strict=True):
            numbers = np.frombuffer(numbers, np.int32)
            edge = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(edge, [w["at"] for w in found], 1)
            np.add.at(edge, [w["at"] + w["size"] for w in found], -1)
            gone.append(numbers[np.cumsum(edge)[:-1] > 0].tolist())
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(gone, pa.list_(pa.int32()))], ["key", "gone"])


def repeated_lines(docs: DataFrame) -> DataFrame:
    """key (of doc_id and text), gone (numbers of the lines to delete) of the documents that lose any."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", place_key(docs).alias("key"), "text").mapInArrow(
        released(_cut),
        f"doc_id {kind}, key long, numbers binary, windows array<struct<at: int, size: int, window: long, fingerprint: long, place: int>>",
    )
    rows = staged(rows, "lines")
    windows = rows.select("doc_id", "key", F.explode("windows").alias("w")).select("doc_id", "key", "w.*")
    place = F.struct("key", "place")
    twice = windows.groupBy("fingerprint").agg(F.min(place).alias("low"), F.max(place).alias("high")).filter("low != high")
    # Both sides of a join on content are tables of their own, so that Spark can split a hot key.
    twice = staged(twice.select("fingerprint"), "fingerprints")
    candidates = staged(windows.join(twice, "fingerprint", "left_semi"), "windows")
    order = F.struct("doc_id", "key", "at")
    first = candidates.groupBy("window").agg(F.min(order).alias("first"), F.max(order).alias("last")).filter("first != last").drop("last")
    later = candidates.join(staged(first, "first-windows"), "window").filter(order > F.col("first"))
    runs = later.groupBy("key").agg(F.collect_set(F.struct("at", "size")).alias("later"))
    lines = staged(rows.select("key", "numbers").dropDuplicates(["key"]), "line-numbers")
    both = staged(runs, "runs").join(lines, "key").select("key", "numbers", "later")
    return both.mapInArrow(released(_mark), "key long, gone array<int>")


def without_lines(docs: DataFrame, gone: DataFrame) -> tuple[DataFrame, str]:
    """docs with the lines gone from their texts, and the name of an added column with the number deleted."""
    name = "n_removed"
    while name in docs.columns:
        name += "_"
    found = gone.select(F.col("key").alias("_gone_key"), F.col("gone").alias("_gone"))
    joined = docs.join(found, place_key(docs) == found["_gone_key"], "left")
    joined = joined.select(*(docs[c] for c in docs.columns), found["_gone"].alias(name))
    text = docs.columns.index("text")

    def delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            lost = part.column(part.num_columns - 1).to_pylist()
            texts = part.column(text).to_pylist()
            for i, numbers in enumerate(lost):
                if numbers:
                    drop = set(numbers)
                    texts[i] = "\n".join(x for n, x in enumerate(texts[i].split("\n")) if n not in drop)
            columns = list(part.columns)
            columns[text] = pa.array(texts, part.schema.field(text).type)
            columns[-1] = pa.array([len(x or ()) for x in lost], pa.int64())
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(released(delete), f"{fields}, `{name}` long"), name
