"""Stretches of consecutive words that repeat with a short period (runs), by maximal pairs.

Two equal stretches of L words that start p words apart, before which different
words stand and after which different words follow, are a maximal pair. If L is
at least (EXPONENT - 1) p, the two overlap or touch, and together they are a run
of period p and L + p words: nothing has to be extended. So runs are the maximal
pairs whose distance satisfies a length constraint.

Pairs come from the tree of LCP intervals of a text's suffixes, walked bottom-up.
An interval of value L holds the places whose next L words agree, in ascending
order, each in the class of its left word. When a child joins an interval, every
place of the smaller side looks up its nearest neighbours on the other side; a
neighbour of another class within L / (EXPONENT - 1) words makes a run. Farther
neighbours need no look: between the places of a run's pair lies no third one, as
a smaller period would follow.

Only places whose next few words occur twice in their text take part (EXPONENT
and LEAST say how many are needed), and of the groups of such places only those
with two that are near enough for their longest match. Suffixes are sorted by
doubling; the longest matches are found by comparing words where the left words
differ, and follow from the place before elsewhere. Memory grows with the longest
text, work with n log n.

Words are `[^\\x20\\x09-\\x0D]+` and are told apart by 64-bit hashes per text.

Defined results: null and empty texts have no words and no runs, and collapse to
an empty text. Runs of one text do not see other rows, so repeated rows and copies
are found one by one. Runs may overlap; a word goes if any run holds it after its
first period. Empty tables give empty results. Columns other than those named are
handed on untouched.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kawaraban.llm.words import Words, mix, pieces, small_batches

#: A run has at least EXPONENT periods and LEAST words.
EXPONENT, LEAST = 4, 6
_BLOCK = 1024
_CELLS = 1 << 20


class Places:
    """Places in ascending order, in blocks, so that an insertion costs little at any size."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, first: int):
        self.blocks, self.firsts, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def _block(self, place: int) -> int:
        return max(0, bisect_left(self.firsts, place) - 1) if len(self.firsts) > 1 else 0

    def around(self, place: int) -> tuple[int | None, int | None]:
        """The nearest places before and after one that is not held."""
        at = self._block(place)
        block = self.blocks[at]
        i = bisect_left(block, place)
        before = block[i - 1] if i else None
        if i < len(block):
            return before, block[i]
        return before, self.firsts[at + 1] if at + 1 < len(self.firsts) else None

    def add(self, place: int) -> None:
        at = self._block(place)
        block = self.blocks[at]
        insort(block, place)
        self.firsts[at] = block[0]
        self.size += 1
        if len(block) > 2 * _BLOCK:
            self.blocks[at : at + 1] = [block[:_BLOCK], block[_BLOCK:]]
            self.firsts[at : at + 1] = [block[0], block[_BLOCK]]


def _repeated(words: Words, size: int) -> np.ndarray:
    """The places whose next `size` words stand at another place of the same row, too."""
    keys, at, row = words.windows(size)
    keys = keys ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:]] = same
    again[order[:-1]] |= same
    return at[again]


def _sorted_suffixes(words: np.ndarray, end: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """`places` by the words that follow them, row by row; `end` is where each word's row ends.

    All places whose next `size` words are repeated must be given.
    """
    n = len(words)
    near = np.unique(np.concatenate([places, places + size]))
    near = near[near < n]
    # Rank by row and `size` words; a row's end comes before all words.
    columns = [np.where(near + k < end[near], words[np.minimum(near + k, n - 1)], 0) for k in reversed(range(size))]
    order = np.lexsort([*columns, end[near]])
    new = np.zeros(len(near), bool)
    for column in [*columns, end[near]]:
        new[1:] |= column[order][1:] != column[order][:-1]
    new[:1] = True
    slot = np.flatnonzero(new)
    rank = np.zeros(n + 1, np.int64)
    rank[near[order]] = np.repeat(slot, np.diff(np.append(slot, len(near)))) + 1
    active, step = places, size
    while len(active):
        # rank is 1 + the first slot of a group; refine groups of several by the next `step` words.
        after = np.where(active + step < end[active], rank[np.minimum(active + step, n)], 0)
        order = np.lexsort([after, rank[active]])
        active, after = active[order], after[order]
        old = rank[active]
        head = np.ones(len(active), bool)
        head[1:] = old[1:] != old[:-1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(active)), 0))
        new = head.copy()
        new[1:] |= after[1:] != after[:-1]
        start = np.flatnonzero(new)
        many = np.diff(np.append(start, len(active)))
        rank[active] = np.repeat(old[start] + start - first[start], many)
        active = active[np.repeat(many > 1, many)]
        step *= 2
    return places[np.argsort(rank[places])]


def _agreeing(words: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from a on equal those from b on, within their row."""
    out = np.zeros(len(a), np.int64)
    room = end[a] - np.maximum(a, b)
    open_, block = np.arange(len(a)), 16
    while len(open_):
        left = []
        step = max(1, _CELLS // block)
        for at in range(0, len(open_), step):
            some = open_[at : at + step]
            ahead = out[some, None] + np.arange(block)
            inside = ahead < room[some, None]
            last = len(words) - 1
            same = inside & (words[np.minimum(a[some, None] + ahead, last)] == words[np.minimum(b[some, None] + ahead, last)])
            agree = np.where(same.all(axis=1), block, np.argmin(same, axis=1))
            out[some] += agree
            left.append(some[agree == block])
        open_, block = np.concatenate(left), min(2 * block, 1 << 16)
    return out


def _matches(words: np.ndarray, end: np.ndarray, start: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """The number of words that each suffix shares with the one before it (0 in another row)."""
    found = np.zeros(len(suffixes), np.int64)
    if len(suffixes) < 2:
        return found
    place, other = suffixes[1:], suffixes[:-1]
    by_place = np.argsort(place)
    place, other = place[by_place], other[by_place]
    inner = end[place] == end[other]
    left = inner & (np.minimum(place, other) > start[place]) & (words[place - 1] == words[other - 1])
    # Where the left words agree, the match is that of the place before less one.
    plain = np.flatnonzero(~left | ~np.concatenate([[False], place[1:] == place[:-1] + 1]))
    shared = np.zeros(len(place), np.int64)
    asked = plain[inner[plain]]
    shared[asked] = _agreeing(words, end, place[asked], other[asked])
    from_ = np.zeros(len(place), np.int64)
    from_[plain] = plain
    from_ = np.maximum.accumulate(from_)
    shared = shared[from_] - (place - place[from_])
    found[1 + by_place] = shared
    return found


def _pairs(suffixes: list[int], shared: list[int], left: list[int], factor: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of the maximal pairs of one group of suffixes that make runs."""

    def joined(a: Places, b: Places, value: int) -> Places:
        small, large = (a, b) if a.size < b.size else (b, a)
        places = list(small)
        for place in places:
            before, after = large.around(place)
            if before is not None and factor * (place - before) <= value >= least - (place - before) and left[before] != left[place]:
                found.append((before, place + value, place - before))
            if after is not None and factor * (after - place) <= value >= least - (after - place) and left[after] != left[place]:
                found.append((place, after + value, after - place))
        for place in places:
            large.add(place)
        return large

    found: list[tuple[int, int, int]] = []
    stack: list[tuple[int, Places]] = []
    now = Places(suffixes[0])
    for place, value in zip([*suffixes[1:], -1], [*shared[1:], 0], strict=True):
        while stack and stack[-1][0] > value:
            top, held = stack.pop()
            now = joined(held, now, top)
        if place < 0:
            break
        if stack and stack[-1][0] == value:
            now = joined(stack.pop()[1], now, value)
        stack.append((value, now))
        now = Places(place)
    yield from found


def runs_of(words: Words, exponent: int = EXPONENT, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs, as places in the column, by start, then period."""
    empty = np.empty(0, np.int64)
    factor = exponent - 1
    # The shortest match that makes a run: of period p, max(least - p, factor * p) words.
    size = min(max(least - p, factor * p) for p in range(1, least + 1))
    hashes, bounds = words.hashes, words.bounds
    n = len(hashes)
    if not n:
        return empty, empty, empty
    places = _repeated(words, size)
    if not len(places):
        return empty, empty, empty
    many = np.diff(bounds)
    end, start = np.repeat(bounds[1:], many), np.repeat(bounds[:-1], many)
    suffixes = _sorted_suffixes(hashes, end, places, size)
    shared = _matches(hashes, end, start, suffixes)
    # Groups of places that share `size` words, and their longest match and smallest distance.
    group = np.cumsum(shared < size) - 1
    first = np.flatnonzero(shared < size)
    longest = np.maximum.reduceat(np.where(shared < size, 0, shared), first)
    by_place = np.lexsort([suffixes, group])
    ordered, owner = suffixes[by_place], group[by_place]
    gap = np.full(len(ordered), n, np.int64)
    gap[1:] = np.where(owner[1:] == owner[:-1], ordered[1:] - ordered[:-1], n)
    nearest = np.minimum.reduceat(gap, first)
    # Left words as numbers; the first word of a row has a left class of its own.
    classes = np.where(places > start[places], hashes[np.maximum(places - 1, 0)], 0)
    _, classes = np.unique(classes, return_inverse=True)
    classes = np.where(places > start[places], classes, -1 - places)
    left = dict(zip(places.tolist(), classes.tolist(), strict=True))
    smallest: dict[tuple[int, int], int] = {}
    last = np.append(first[1:], len(suffixes))
    for g in np.flatnonzero(factor * nearest <= longest):
        a, b = first[g], last[g]
        for s, e, p in _pairs(suffixes[a:b].tolist(), shared[a:b].tolist(), left, factor, least):
            smallest[s, e] = min(p, smallest.get((s, e), p))
    if not smallest:
        return empty, empty, empty
    found = np.array([(s, e, p) for (s, e), p in smallest.items()], np.int64)
    found = found[np.lexsort([found[:, 2], found[:, 0]])]
    return found[:, 0], found[:, 1], found[:, 2]


def _collapsed(words: Words, first: np.ndarray, last: np.ndarray) -> pa.Array:
    """Every row's words outside all first:last, joined by one space."""
    n = len(words.starts)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    kept = np.flatnonzero(np.cumsum(edge)[:n] == 0)
    bounds = np.searchsorted(kept, words.bounds)
    data = words.data.copy()
    take = np.zeros(len(data) + 1, np.int8)
    take[words.starts[kept]] += 1
    take[words.ends[kept]] -= 1
    take = np.cumsum(take[:-1], dtype=np.int8) > 0
    # The byte after a kept word becomes the space before the next one of its row.
    more = np.ones(len(kept), bool)
    more[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False
    spaces = words.ends[kept[more]]
    data[spaces], take[spaces] = 0x20, True
    sizes = np.concatenate([[0], np.cumsum(take)])[words.offsets]
    return pa.Array.from_buffers(pa.large_string(), len(words.counts), [None, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(data[take].tobytes())])


RUNS = "array<struct<start: long, length: long, period: long>>"


def collapse(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """Columns of docs but text, with n_words, runs (by start, then period) and collapsed (the words left, joined by one space).

    Columns of docs that bear these names are replaced.
    """
    small_batches(docs.sparkSession)
    others = [f for f in docs.schema if f.name not in ("text", "n_words", "runs", "collapsed")]
    names = [f.name for f in others]
    schema = T.StructType([*others, *T._parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            words = Words(part.column("text"))
            s, e, p = runs_of(words, exponent, least)
            row = np.searchsorted(words.bounds, s, "right") - 1
            flat = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (s - words.bounds[row], e - s, p)], ["start", "length", "period"])
            runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)), pa.int32()), flat)
            text = pc.cast(_collapsed(words, s + p, e), pa.string())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(words.counts, pa.int64()), runs, text], [*names, "n_words", "runs", "collapsed"])

    return docs.select(*names, "text").mapInArrow(work, schema)
