"""Benchmark passages in training documents, found through a positional inverted index.

`build_index` stores, for segments of a few MB of whole documents, the sorted
positions of every word that occurs in the test set (other words are never
asked for). A segment is indexed where its documents are read, so nothing is
shuffled and no word's list is ever held in one place for the whole corpus.
`search` answers every test window (13 consecutive words of an item; an item of
fewer words is one window) in each segment: the list of the window's rarest
word there gives candidate starts, which are intersected with the
offset-adjusted lists of the other words from the rarest on. What remains are
exact phrase matches. Proximity matches are windows all of whose words lie
within NEAR words of a place of the rarest word, in any order.

The test set is cut into blocks of about BLOCK bytes of text; each block is sent
to the tasks in turn, whatever the size of the whole.

Defined results: null or empty texts have no words and no hits; items without
words are never found; equal items are all reported; repeated rows of documents
are answered one by one. An empty table gives an empty result, an empty test set
gives no hits. Other columns are not read. Words are compared by 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kawaraban.llm.words import MARKS, Words, covered, pieces, released, small_batches
from kawaraban.session import staged

WINDOW = 13
NEAR = 16
BLOCK = 1 << 20
#: Candidate starts looked at together in a task.
_AT_ONCE = 1 << 20


def _words(texts: pa.Array) -> Words:
    return Words(texts, MARKS, lower=True)


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0 .. counts[i] - 1 for each i in turn."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


class Block:
    """Distinct windows of some test items as rows of vocabulary numbers (-1 after the last word)."""

    def __init__(self, items: list[tuple[str | None, str]]):
        words = _words(pa.array([text for _, text in items], pa.string()))
        self.names = [name for name, _ in items]
        self.vocabulary, number = np.unique(words.hashes, return_inverse=True)
        n = words.counts
        many = np.maximum(n - WINDOW, 0) + (n > 0)
        item = np.repeat(np.arange(len(n)), many)
        start = words.bounds[:-1][item] + _ragged(many)
        length = np.minimum(n[item], WINDOW)
        place = start[:, None] + np.arange(WINDOW)
        inside = np.arange(WINDOW) < length[:, None]
        rows = np.where(inside, number[np.minimum(place, max(0, len(number) - 1))] if len(number) else 0, -1)
        self.windows, same = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows.reshape(0, WINDOW), np.empty(0, np.int64))
        self.lengths = (self.windows >= 0).sum(1)
        order = np.argsort(same, kind="stable")
        self.items = item[order]
        self.item_bounds = np.searchsorted(same[order], np.arange(len(self.windows) + 1))

    def items_of(self, windows: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
        """Distinct (row, item) of (row, window) pairs."""
        n = self.item_bounds[windows + 1] - self.item_bounds[windows]
        at = np.repeat(self.item_bounds[windows], n) + _ragged(n)
        return sorted(set(zip(np.repeat(rows, n).tolist(), self.items[at].tolist(), strict=True)))


class Segment:
    """Places of the test set's words in a run of documents."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, places: np.ndarray, bounds: np.ndarray, block: Block):
        self.bounds, self.block, self.size = bounds, block, int(bounds[-1])
        where = np.searchsorted(block.vocabulary, terms)
        where = np.minimum(where, max(0, len(block.vocabulary) - 1))
        known = block.vocabulary[where] == terms if len(block.vocabulary) else np.zeros(len(terms), bool)
        keep = np.repeat(known, counts)
        self.counts = np.zeros(len(block.vocabulary) + 1, np.int64)
        self.counts[where[known]] = counts[known]
        self.first = np.concatenate([[0], np.cumsum(self.counts[:-1])])
        self.places = places[keep].astype(np.int64)
        number = np.repeat(where[known], counts[known])
        self.at = np.full(self.size, -1, np.int32)
        self.at[self.places] = number
        self.keys = number * (self.size + 1) + self.places

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(window, its words' offsets from the rarest on, place of the rarest word), some at a time."""
        block = self.block
        inside = block.windows >= 0
        n = np.where(inside, self.counts[block.windows], np.iinfo(np.int64).max)
        alive = np.flatnonzero((n > 0).all(1))
        order = np.argsort(n[alive], axis=1, kind="stable")
        rarest = block.windows[alive, order[:, 0]] if len(alive) else np.empty(0, np.int64)
        total = np.cumsum(self.counts[rarest])
        at = 0
        while at < len(alive):
            done = int(total[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(total, done + _AT_ONCE, "right")))
            many = self.counts[rarest[at:to]]
            pick = np.repeat(np.arange(at, to), many)
            place = self.places[self.first[rarest[pick]] + _ragged(many)]
            yield alive[pick], order[pick], place
            at = to

    def phrases(self, window: np.ndarray, order: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, start, row) of the exact matches among the candidates."""
        block = self.block
        start = place - order[:, 0]
        row = np.searchsorted(self.bounds, place, "right") - 1
        ok = (start >= self.bounds[row]) & (start + block.lengths[window] <= self.bounds[row + 1])
        window, order, start, row = window[ok], order[ok], start[ok], row[ok]
        for j in range(1, WINDOW):
            offset = order[:, j]
            word = block.windows[window, offset]
            ok = (word < 0) | (self.at[np.minimum(start + offset, self.size - 1)] == word)
            window, order, start, row = window[ok], order[ok], start[ok], row[ok]
        return window, start, row

    def nearby(self, window: np.ndarray, order: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, row) of the proximity matches among the candidates."""
        row = np.searchsorted(self.bounds, place, "right") - 1
        for j in range(1, WINDOW):
            word = self.block.windows[window, order[:, j]]
            low = np.maximum(place - NEAR, self.bounds[row])
            high = np.minimum(place + NEAR, self.bounds[row + 1] - 1)
            base = word * np.int64(self.size + 1)
            found = np.searchsorted(self.keys, base + low)
            ok = (word < 0) | (self.keys[np.minimum(found, len(self.keys) - 1)] <= base + high) & (found < len(self.keys))
            window, order, place, row = window[ok], order[ok], place[ok], row[ok]
        return window, row


def item_blocks(items: DataFrame) -> Iterator[list[tuple[str | None, str]]]:
    """The test items (item_id, text) in blocks of about BLOCK bytes, at least one, read one block at a time."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text IS NOT NULL")
    n = max(1, math.ceil((items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / BLOCK))
    for i in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i)
        yield [(r["item_id"], r["text"]) for r in part.toLocalIterator()]


def build_index(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Stored postings: one row per segment and block of the test set's words.

    Columns: segment, doc_ids, keys (hash of doc_id and text), bounds (of the
    documents in the segment's words), terms, counts, places.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    tables = []
    for number, block in enumerate(item_blocks(items)):

        def index(batches: Iterator[pa.RecordBatch], block=block, number=number) -> Iterator[pa.RecordBatch]:
            vocabulary = Block(block).vocabulary
            made = TaskContext.get().partitionId() << 24
            for part in pieces(batches):
                words = _words(part.column("text"))
                where = np.minimum(np.searchsorted(vocabulary, words.hashes), max(0, len(vocabulary) - 1))
                places = np.flatnonzero(vocabulary[where] == words.hashes) if len(vocabulary) else np.empty(0, np.int64)
                places = places[np.argsort(where[places], kind="stable")]
                terms, counts = np.unique(where[places], return_counts=True)
                blob = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
                lists = [pa.array([part.column(c).to_pylist()], pa.list_(part.schema.field(c).type)) for c in ("doc_id", "key")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([made], pa.int64()), *lists, blob(words.bounds, np.uint32), blob(vocabulary[terms] if len(terms) else terms, np.uint64), blob(counts, np.uint32), blob(places, np.uint32)],
                    ["block", "segment", "doc_ids", "keys", "bounds", "terms", "counts", "places"],
                )
                made += 1

        # A job for each block, so that a segment has the same number in all of them.
        found = rows.mapInArrow(released(index), f"block int, segment long, doc_ids array<{kind}>, keys array<long>, bounds binary, terms binary, counts binary, places binary")
        tables.append(staged(found, "postings"))
    return reduce(DataFrame.unionByName, tables)


def search(index: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: doc_id, key, n_words, spans (of hit words, disjoint), items, near_items.

    Exact phrase matches give spans and items, proximity matches near_items
    (item ids as sorted strings, null last).
    """
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"segment long, row int, doc_id {kind}, key long, n_words long, spans array<struct<start: long, end: long>>, items array<string>, near_items array<string>"
    parts = []
    for number, block in enumerate(item_blocks(items)):

        def answer(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            yield from _answers(batches, Block(block))

        parts.append(index.filter(F.col("block") == number).mapInArrow(released(answer), schema))
    if len(parts) == 1:
        return parts[0].drop("segment", "row")
    merged = reduce(DataFrame.unionByName, parts).groupBy("segment", "row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("key").alias("key"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near_items")),
    )
    joined = F.expr(
        """aggregate(spans, cast(array() as array<struct<start: bigint, end: bigint>>), (done, s) ->
             if(size(done) > 0 and element_at(done, -1).end >= s.start,
                concat(slice(done, 1, size(done) - 1),
                       array(named_struct('start', element_at(done, -1).start, 'end', greatest(element_at(done, -1).end, s.end)))),
                concat(done, array(s))))"""
    )
    return merged.withColumn("spans", joined).drop("segment", "row")


def _names(found: list[str | None]) -> list[str | None]:
    return sorted(set(found), key=lambda name: (name is None, name or ""))


def _answers(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        for i in range(batch.num_rows):
            value = lambda c, i=i, batch=batch: batch.column(c)[i]
            array = lambda c, kind: np.frombuffer(value(c).as_py(), kind)
            bounds = array("bounds", np.uint32).astype(np.int64)
            segment = Segment(array("terms", np.uint64), array("counts", np.uint32), array("places", np.uint32), bounds, block)
            rows = len(bounds) - 1
            hit = np.zeros(segment.size, bool)
            exact: list[list[str | None]] = [[] for _ in range(rows)]
            near: list[list[str | None]] = [[] for _ in range(rows)]
            found, close = set(), set()
            for window, order, place in segment.candidates():
                w, start, row = segment.phrases(window, order, place)
                for length in np.unique(block.lengths[w]):
                    hit |= covered(segment.size, start[block.lengths[w] == length], int(length))
                found.update(block.items_of(w, row))
                w, row = segment.nearby(window, order, place)
                close.update(block.items_of(w, row))
            for into, pairs in ((exact, found), (near, close)):
                for row, item in pairs:
                    into[row].append(block.names[item])
            edge = np.zeros(segment.size + 1, bool)  # a span ends where the next document begins
            edge[bounds] = True
            starts = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]]))) if segment.size else np.empty(0, np.int64)
            ends = np.flatnonzero(hit & (edge[1:] | ~np.concatenate([hit[1:], [False]]))) + 1 if segment.size else np.empty(0, np.int64)
            owner = np.searchsorted(bounds, starts, "right") - 1
            flat = pa.StructArray.from_arrays([pa.array(starts - bounds[owner], pa.int64()), pa.array(ends - bounds[owner], pa.int64())], fields=list(span))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([value("segment").as_py()] * rows, pa.int64()),
                    pa.array(range(rows), pa.int32()),
                    value("doc_ids").values,
                    value("keys").values,
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32()), flat),
                    pa.array([_names(x) for x in exact], pa.list_(pa.string())),
                    pa.array([_names(x) for x in near], pa.list_(pa.string())),
                ],
                ["segment", "row", "doc_id", "key", "n_words", "spans", "items", "near_items"],
            )


def contaminated(answers: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated added to the answers of `search`."""
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return answers.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256)}).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs that the contamination rule leaves, all columns unchanged."""
    bad = contaminated(search(build_index(docs, items), items)).filter("contaminated").select("key").distinct()
    bad = staged(bad.withColumnRenamed("key", "contaminated_key"), "contaminated")
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["contaminated_key"], "left_anti")
