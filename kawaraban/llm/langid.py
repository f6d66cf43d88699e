"""Language identification by prediction by partial matching.

Every language has a tree of byte contexts up to ORDER bytes long with the
counts of the bytes that followed. The next byte is predicted from the longest
context that the tree knows; a byte never seen there costs the context's escape
probability (method C: distinct bytes / (occurrences + distinct bytes)) and is
then predicted from the next shorter context, at last evenly among 256. A text's
code length in a language is the sum over its bytes, under the frozen counts;
the shortest wins, ties by name, and the score is its posterior probability
under equal priors.

The trees are fitted on a sample of whole labelled texts per language: those of
the smallest hashes of doc_id and text, until SAMPLE bytes are reached, at least
one. Hashes are taken level by level, 64 levels for each doubling; so the sample
exceeds SAMPLE by about a hundredth, or by the texts of the last level where these
are longer, and a language of SAMPLE bytes or less is learned whole. So the counts
that travel to the driver and to the tasks are bounded, however large the corpus.
Texts are lower-cased first, and scored and counted in blocks of BLOCK bytes, so
that a long text takes some 3 bytes a byte beside them (157 MB for one of 27 MB, as
tracemalloc counts; Arrow's own copies of the text come on top).

Defined results: null text, and text without a letter, is `und` with score 0.
Rows without text or language are not learned from. If nothing can be learned,
every text is `und`. Repeated rows are predicted one by one. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kawaraban.llm.words import pieces, small_batches, text_bytes

ORDER = 3
SAMPLE = 2_000_000
#: Bytes of text that are scored or counted together.
BLOCK = 1 << 20
UNKNOWN = "und"


def held_out() -> Column:
    """Rows that are only predicted: crc32 of the doc_id's decimal text is divisible by 5; not those without doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def blocks(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most BLOCK bytes that hold rows whole, but for rows longer than that.

    Those are cut after every BLOCK bytes of their own, so what is added up for a
    row doesn't depend on the rows before it.
    """
    low = 0
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if end - low <= BLOCK:
            continue
        if start > low:
            yield low, start
            low = start
        while end - low > BLOCK:
            yield low, low + BLOCK
            low += BLOCK
    if low < offsets[-1]:
        yield low, int(offsets[-1])


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """The byte runs of a column, block by block: (rows, starts, within, runs).

    rows lie in the block and start there at starts; within is every byte's place
    in its row. runs has, for n = 1 to ORDER + 1, the codes of all n-byte runs within
    a row that end in the block, and where each ends.
    """
    data, offsets = text_bytes(pc.utf8_lower(texts))
    for low, high in blocks(offsets):
        first, last = np.searchsorted(offsets, low, "right") - 1, np.searchsorted(offsets, high, "left")
        cuts = np.clip(offsets[first : last + 1], low, high)
        within = np.arange(low, high) - np.repeat(offsets[first:last], np.diff(cuts))
        filled = np.flatnonzero(np.diff(cuts))
        # Runs that end in the block may begin before it.
        before = min(low, ORDER)
        part = data[low - before : high]
        code = np.zeros(len(part), np.uint32)
        runs = []
        for n in range(1, ORDER + 2):
            code[n - 1 :] |= part[: max(0, len(part) - n + 1)].astype(np.uint32) << np.uint32(8 * (n - 1))
            at = np.flatnonzero(within >= n - 1)
            runs.append((code[at + before], at))
        yield first + filled, (cuts - low)[filled], within, runs


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, n, code, count of the labelled texts' byte runs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            langs = np.array(part.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                texts = part.column("text").filter(pa.array(langs == lang))
                for n, codes in ((n, codes) for *_, runs in grams(texts) for n, (codes, _) in enumerate(runs, 1)):
                    found, times = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(found), pa.string()), pa.array(np.full(len(found), n), pa.int32()), pa.array(found.astype(np.int64)), pa.array(times.astype(np.int64))],
                        ["lang", "n", "code", "count"],
                    )

    found = docs.select("lang", "text").mapInArrow(count, "lang string, n int, code long, count long")
    return found.groupBy("lang", "n", "code").agg(F.sum("count").alias("count"))


class Trees:
    """Code lengths in bits of the last byte of every known run, per language (columns)."""

    def __init__(self, counts: pa.Table):
        langs = np.array(counts.column("lang").to_pylist(), object)
        n, code, count = (counts.column(c).to_numpy() for c in ("n", "code", "count"))
        self.langs = sorted(set(langs.tolist()))
        self.codes = [np.unique(code[n == k]).astype(np.uint32) for k in range(1, ORDER + 2)]
        self.codes[0] = np.arange(256, dtype=np.uint32)
        self.codes[1] = np.arange(1 << 16, dtype=np.uint32)
        self.bits = [np.zeros((len(c), len(self.langs))) for c in self.codes]
        #: Bits of the escape from a run as a context, for n = 0 to ORDER.
        self.escape = [np.zeros((1, len(self.langs))), *(np.zeros((max(1, len(c)), len(self.langs))) for c in self.codes[:-1])]
        for column, lang in enumerate(self.langs):
            mine = langs == lang
            for k in range(1, ORDER + 2):
                own = mine & (n == k)
                seen = np.zeros(len(self.codes[k - 1]))
                seen[np.searchsorted(self.codes[k - 1], code[own])] = count[own]
                context, known = self._place(self.codes[k - 1] >> np.uint32(8), k - 1)  # a known run's context is known
                total = np.bincount(context, seen, len(self.escape[k - 1]))
                kinds = np.bincount(context, seen > 0, len(self.escape[k - 1]))
                with np.errstate(divide="ignore", invalid="ignore"):
                    self.escape[k - 1][:, column] = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0)
                    bits = -np.log2(seen / (total + kinds)[context])
                shorter = self._bits(self.codes[k - 1], k - 1, column)
                self.bits[k - 1][:, column] = np.where(seen > 0, bits, self.escape[k - 1][context, column] + shorter)

    def _place(self, codes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of runs of n bytes, and which are known."""
        if n == 0:
            return np.zeros(len(codes), np.int64), np.ones(len(codes), bool)
        if n <= 2:
            return codes.astype(np.int64), np.ones(len(codes), bool)
        known = self.codes[n - 1]
        at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
        return at, known[at] == codes if len(known) else np.zeros(len(codes), bool)

    def _bits(self, codes: np.ndarray, n: int, column: int | slice) -> np.ndarray:
        """Bits of the last byte of any codes, predicted from at most n - 1 bytes before it."""
        if n == 0:
            return np.full((len(codes), len(self.langs))[: 1 if isinstance(column, int) else 2], 8.0)
        codes = codes & np.uint32((1 << 8 * n) - 1) if n < 4 else codes
        at, known = self._place(codes, n)
        if known.all():
            return self.bits[n - 1][at, column]
        out = np.empty((len(codes), *np.empty(len(self.langs))[column].shape))
        out[known] = self.bits[n - 1][at[known], column]
        rest = codes[~known]
        context, there = self._place(rest >> np.uint32(8), n - 1)
        escape = np.where(there.reshape(-1, *[1] * (out.ndim - 1)), self.escape[n - 1][np.where(there, context, 0), column], 0)
        out[~known] = escape + self._bits(rest, n - 1, column)
        return out


class Scorer:
    """Code lengths of texts; the longest runs are found in a hash table."""

    def __init__(self, trees: Trees):
        self.trees = trees
        codes = trees.codes[-1]
        self.shift = np.uint32(max(1, 32 - max(8, int(np.ceil(np.log2(8 * len(codes) + 1))))))
        slots = self._slot(codes)
        self.row = np.full(1 << (32 - int(self.shift)), -1, np.int32)
        self.row[slots] = np.arange(len(codes))
        self.code = np.zeros(len(self.row), np.uint32)
        self.code[self.row >= 0] = codes[self.row[self.row >= 0]]
        self.bits = [np.ascontiguousarray(trees.bits[-1][:, k]) for k in range(len(trees.langs))]

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(0x9E3779B1)) >> self.shift

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of every text in every language."""
        langs = len(self.trees.langs)
        total = np.zeros((len(texts), langs))
        for rows, starts, within, found in grams(texts):
            codes, at = found[-1]
            slot = self._slot(codes)
            hit = (self.code[slot] == codes) & (self.row[slot] >= 0)
            row = np.where(hit, self.row[slot], 0)
            rest, where = np.unique(codes[~hit], return_inverse=True)
            rare = self.trees._bits(rest, ORDER + 1, slice(None)) if len(rest) else np.zeros((0, langs))
            early = [(self.trees._bits(c[e], k, slice(None)), p[e]) for k, (c, p) in enumerate(found[:-1], 1) for e in [within[p] == k - 1]]
            for k in range(langs):
                bits = np.zeros(len(within))
                values = self.bits[k][row] if len(self.bits[k]) else np.zeros(len(row))
                values[~hit] = rare[where, k]
                bits[at] = values
                for b, p in early:
                    bits[p] = b[:, k]
                total[rows, k] += np.add.reduceat(bits, starts)
        return total


def fit(docs: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from a sample of whole texts (doc_id, lang, text), in the order of hashes until `sample` bytes per language."""
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    level = F.floor(64 * F.log2(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) + 1))
    sizes = labelled.groupBy("lang", level.alias("level")).agg(F.sum(F.octet_length("text")).alias("bytes"))
    smaller = Window.partitionBy("lang").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    # The first level of a language has nothing before it, so every language keeps a text.
    sizes = sizes.withColumn("before", F.coalesce(F.sum("bytes").over(smaller), F.lit(0)))
    last = {r["lang"]: r["last"] for r in sizes.filter(F.col("before") < max(1, sample)).groupBy("lang").agg(F.max("level").alias("last")).toLocalIterator()}
    if not last:
        return Trees(pa.table({"lang": pa.array([], pa.string()), "n": pa.array([], pa.int32()), "code": pa.array([], pa.int64()), "count": pa.array([], pa.int64())}))
    levels = F.create_map(*(F.lit(x) for pair in last.items() for x in pair))
    chosen = labelled.filter(level <= F.element_at(levels, F.col("lang")))
    return Trees(count_grams(chosen).toArrow())


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, lang_pred, score of every row of documents (doc_id, text)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(trees)
        for part in pieces(batches):
            texts = pc.fill_null(part.column("text"), "")
            readable = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            if not trees.langs:
                readable = np.zeros(len(texts), bool)
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if readable.any():
                bits = scorer.lengths(texts)
                best = bits.argmin(1)
                chance = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
                names = [trees.langs[b] if r else UNKNOWN for b, r in zip(best, readable, strict=True)]
                scores = np.where(readable, chance, 0.0)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")
