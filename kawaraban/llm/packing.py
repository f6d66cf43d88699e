"""Cost-balanced packing of documents into sequences of a fixed number of tokens.

Documents are tokenised where they are read and packed in pools of POOL
sequences of one partition; a worker holds one pool. Only the rest of a partition,
less than a sequence, is shuffled, to be packed with other rests.
In a pool, documents are taken in descending order of their estimated attention
cost (LINEAR * n + QUADRATIC * n * n for n tokens); each goes to the sequence of
the lowest cost so far with room for all of it. A document longer than a
sequence is cut at whole sequences first; one that fits nowhere is cut to fill
the cheapest sequences with room. What doesn't fill a sequence moves to the next
pool, so all sequences but the last one of the rests are full.

Defined results: null text is empty; every document, also an empty one, gets the
end id. Repeated rows are packed one by one, ties keep the order of the input,
an empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawaraban.llm.tokens import at_spaces, encoder
from kawaraban.llm.words import Work, pieces, released, small_batches
from kawaraban.session import staged

SIZE = 4096
END = 2
POOL = 256
LINEAR, QUADRATIC = 1.0, 1.0 / SIZE


def plan(lengths: list[int], n: int, size: int = SIZE, linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of the pieces of documents in n sequences.

    n * size may be less than all tokens: the documents' last ids then stay out.
    """
    used, cost = np.zeros(n, np.int64), np.zeros(n)
    out = []

    def put(doc: int, start: int, length: int, sequence: int) -> None:
        out.append((doc, start, length, sequence, int(used[sequence])))
        used[sequence] += length
        cost[sequence] += linear * length + quadratic * length * length

    for doc in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        start, left = 0, lengths[doc]
        while left:
            want = min(left, size)
            room = np.flatnonzero(used + want <= size)
            if not len(room):
                room = np.flatnonzero(used < size)
                if not len(room):
                    break
            best = int(room[np.argmin(cost[room])])
            length = min(want, size - int(used[best]))
            put(doc, start, length, best)
            start, left = start + length, left - length
    return out


#: doc_id, its tokens, ids before these, ids.
Waiting = tuple[object, int, int, bytes]


def _pool_by_pool(items: Iterator[list[Waiting]], kind: pa.DataType, first: int, size: int, pool: int, open_end: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of the items in sequences from number `first` on, planned `pool` full sequences at a time.

    What is left in the end fills no sequence; it goes to a part-filled one, or
    with `open_end` comes without a sequence.
    """
    types = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    sequence, held, waiting = first, 0, []

    def emit(n: int) -> pa.RecordBatch:
        nonlocal sequence, waiting
        found = plan([len(w[3]) // 4 for w in waiting], n, size)
        done = [0] * len(waiting)
        rows: list[tuple] = []
        for doc, start, length, at, offset in found:
            doc_id, total, before, ids = waiting[doc]
            rows.append((doc_id, before + start, length, ids[4 * start : 4 * (start + length)], total, sequence + at, offset))
            done[doc] = max(done[doc], start + length)
        sequence += n
        waiting = [(d, total, before + k, ids[4 * k :]) for (d, total, before, ids), k in zip(waiting, done, strict=True) if 4 * k < len(ids)]
        return batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for some in items:
        for item in some:
            waiting.append(item)
            held += len(item[3]) // 4
            if held >= size * pool:
                yield emit(held // size)
                held %= size
    if held >= size:
        yield emit(held // size)
        held %= size
    if held and open_end:
        yield batch([(d, before, len(ids) // 4, ids, total, None, None) for d, total, before, ids in waiting])
    elif held:
        yield emit(1)


def pack(docs: DataFrame, path: str, size: int = SIZE, pool: int = POOL) -> DataFrame:
    """The pieces of all documents (doc_id, text), tokenised with the file at `path`.

    Columns: doc_id, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    Partitions fill whole sequences; what is left of each, less than a sequence,
    is packed together, in one partition per `pool` sequences of such rests. So
    about one sequence in `pool`, and at least one, has padding.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Waiting]]:
        encode = encoder(path, at_spaces).encode_bytes
        for part in pieces(batches, size=2 << 20):
            yield [(d, len(ids) // 4 + 1, 0, ids + end) for d, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("text")), strict=True)]

    def rests(batches: Iterator[pa.RecordBatch]) -> Iterator[list[Waiting]]:
        for part in batches:
            yield list(zip(*(part.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "start", "ids")), strict=True))

    def fill(items: Callable[[Iterator[pa.RecordBatch]], Iterator[list[Waiting]]], last: bool) -> Work:
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ahead = iter(batches)
            head = next(ahead, None)
            if head is None:
                return
            first = (int(last) << 62) + (TaskContext.get().partitionId() << 33)
            yield from _pool_by_pool(items(chain([head], ahead)), head.schema.field("doc_id").type, first, size, pool, not last)

        return released(work, keeps=True)

    once = staged(docs.select("doc_id", "text").mapInArrow(fill(encoded, False), schema), "packed")
    rest = once.filter("sequence_id IS NULL")
    tokens = rest.agg(F.sum("length")).first()[0] or 0
    again = rest.repartition(max(1, tokens // (size * pool))).mapInArrow(fill(rests, True), schema)
    return once.filter("sequence_id IS NOT NULL").unionByName(again)
