"""How often 64-bit keys occur over all documents, told back to where they came from.

Documents are taken in segments, runs of a few MB as they are read. A segment
sends each of its distinct keys once, packed with all others of the same range of
key values, with the number of its rows that hold the key. The task that gets a
range adds the numbers up and answers every segment with one byte per key. So a
key that most documents hold is one entry per segment, not per document; nothing
is collected per key, and the answers are small.

The answer is the key's class: 0 if it occurs once, else 1 + floor(log2(total)),
where a segment counts for at most 255.

A segment is read twice, to send its keys and to get the answers, and both times
must hold the same rows: give tables as they are stored. Segments carry a check
sum of their keys, and a difference ends the job with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawaraban.llm.words import pieces, released, small_batches

#: Bytes of text in a segment; larger ones need fewer messages and more memory.
SEGMENT = 4 << 20
#: Bytes of a key that travel; its range of values tells the rest.
WIDTH = 7
#: Keys that are added up together.
SLICE = 1 << 18

Keys = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]


def _ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Which of `parts` equal ranges of 64-bit values each key lies in."""
    return (((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _check(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys, initial=np.uint64(0)).astype(np.int64))


def _segments(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    number = TaskContext.get().partitionId() << 24
    for part in pieces(batches, column, SEGMENT):
        yield number, part
        number += 1


def _classes(keys: pa.ChunkedArray, counts: pa.ChunkedArray, width: int) -> list[bytes]:
    """The classes of all keys of one range, message by message.

    Keys are added up a few at a time, by their lowest bits, so that only the
    keys and one byte of answer each are held for the whole range.
    """
    few = [np.frombuffer(x.as_buffer(), np.uint8) for x in _scalars(counts)]
    ends = np.cumsum([len(x) for x in few])
    few = np.concatenate(few)
    packed = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in _scalars(keys)]).reshape(-1, width)
    classes = np.empty(len(few), np.uint8)
    slices = 1 << min(8, max(0, (len(few) // SLICE).bit_length()))
    lowest = packed[:, 0] & np.uint8(slices - 1)
    for k in range(slices):
        at = np.flatnonzero(lowest == k) if slices > 1 else np.arange(len(few))
        if not len(at):
            continue
        wide = np.zeros((len(at), 8), np.uint8)
        wide[:, :width] = packed[at]
        values = wide.view(np.uint64).ravel()
        order = np.argsort(values, kind="stable")
        ordered = values[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        totals = np.add.reduceat(few[at[order]].astype(np.int64), first)
        kind = np.where(totals > 1, 1 + np.floor(np.log2(totals)), 0).astype(np.uint8)
        classes[at[order]] = np.repeat(kind, np.diff(np.append(first, len(at))))
    flat = classes.tobytes()
    return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _scalars(column: pa.ChunkedArray) -> Iterator[pa.Scalar]:
    for chunk in column.chunks:
        yield from chunk


def answered(docs: DataFrame, column: str, keys: Keys, width: int = WIDTH) -> DataFrame:
    """Rows of docs by segment with the classes of their keys: segment, rows, check, answers.

    `keys` gives a segment's distinct keys in ascending order and the number of
    its rows that hold each. `column` holds what segments are measured by.
    """
    spark = docs.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = docs.schema

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, part in _segments(batches, column):
            found, counts = keys(part)
            packed = found.view(np.uint8).reshape(-1, 8)[:, :width]
            few = np.minimum(counts, 255).astype(np.uint8)
            bounds = np.searchsorted(_ranges(found, parts), np.arange(parts + 1))
            some = np.flatnonzero(np.diff(bounds))
            slices = [(int(bounds[i]), int(bounds[i + 1])) for i in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int32()),
                    pa.array([segment] * len(some), pa.int64()),
                    pa.array([packed[a:b].tobytes() for a, b in slices], pa.binary()),
                    pa.array([few[a:b].tobytes() for a, b in slices], pa.binary()),
                ],
                ["part", "segment", "keys", "counts"],
            )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        messages = [batch for batch in batches if batch.num_rows]
        if not messages:
            return
        sent = pa.Table.from_batches(messages)
        del messages
        owners = pc.unique(sent.column("part")).to_pylist()
        for owner in owners:
            one = sent if len(owners) == 1 else sent.filter(pc.equal(sent.column("part"), owner))
            classes = _classes(one.column("keys"), one.column("counts"), width)
            for some in range(0, len(classes), 1000):
                segments, parts_ = (one.column(c).slice(some, 1000).combine_chunks() for c in ("segment", "part"))
                yield pa.RecordBatch.from_arrays([segments, parts_, pa.array(classes[some : some + 1000], pa.binary())], ["segment", "part", "classes"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, part in _segments(batches, column):
            found, _ = keys(part)
            columns = [pa.array([segment], pa.int64()), pa.array([_check(found)], pa.int64())]
            columns += [pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), _flat(c)) for c in part.columns]
            yield pa.RecordBatch.from_arrays(columns, ["segment", "check", *(f"row_{c}" for c in part.schema.names)])

    sent = docs.mapInArrow(released(send), "part int, segment long, keys binary, counts binary")
    told = sent.repartitionById(parts, "part").mapInArrow(released(add_up), "segment long, part int, classes binary")
    answers = told.groupBy("segment").agg(F.sort_array(F.collect_list(F.struct("part", "classes"))).alias("answers"))
    rows = ", ".join(f"`row_{f.name}` array<{f.dataType.simpleString()}>" for f in kinds)
    segments = docs.mapInArrow(released(gather), f"segment long, check long, {rows}")
    return segments.join(answers, "segment", "left")


def _flat(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def read(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, int]]:
    """The segments of `answered` in a task: their rows, the class of every key in ascending order, their check sum."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1)
            rows = pa.RecordBatch.from_arrays([one.column(f"row_{c}").flatten() for c in names], names)
            answers = one.column("answers")[0].as_py() or []
            yield rows, np.frombuffer(b"".join(a["classes"] for a in answers), np.uint8), one.column("check")[0].as_py()


def matched(found: np.ndarray, classes: np.ndarray, check: int) -> np.ndarray:
    """classes, if they are the answers to these keys."""
    if len(found) != len(classes) or _check(found) != check:
        raise RuntimeError("a segment's documents changed between two reads; store the documents first")
    return classes
