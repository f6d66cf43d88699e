"""Documents whose sets of 5-word shingles are similar (Jaccard at least 0.75), exactly, and their groups.

1. Shingles are counted over all documents (`repeats.answered`). A set with more
   than a quarter of its shingles in no other document can have no partner; the
   others (`similar_sets`) are kept once per distinct set, with the shared
   shingles in ascending order of frequency.
2. The first shingles of that order, of which similar sets must share one, make
   the inverted index (`postings`). Index lists are skipped in blocks: size and
   place of an entry tell which sizes its partner may have, and it is sent only to
   the blocks of its lists that hold such pairs (`_cells`).
3. In every list one set leads (the smallest id). All others are compared with
   the leaders of their lists only, so a list of n sets costs n comparisons.
4. What the leader's answers settle is not compared again: two sets of one group
   are connected already, and from the overlaps a, b with the leader, the overlap
   of sets x and y is at most min(|x| - a + b, |y| - b + a). Only pairs of
   different groups that this bound leaves open, and that are not known to differ
   too much (`_differ_little`), are compared themselves. This
   repeats, with other leaders first, then with all that is left, so no link
   between two groups is missed.

The result is exact for all links between groups: connected groups equal those
of the full join. Shingles are compared by 64-bit hash.

Defined results: null text and texts without words have an empty set, linked
with nothing; fewer than 5 words make one shingle. Rows with equal sets, also
repeated rows, belong to one group; ties go to the smaller id. Empty tables give
empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kawaraban.llm import repeats
from kawaraban.llm.lines import place_key
from kawaraban.llm.words import Words, mix, released
from kawaraban.session import staged

SHINGLE = 5
#: Similarity in percent.
LEAST = 75
#: Classes of tokens whose numbers are kept as odd or even, one bit each.
BITS = 256
_WORDS = tuple(f"b{i}" for i in range(BITS // 64))
#: Classes of set sizes to a doubling, by which index lists are cut into blocks.
CLASSES = 6


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of every row in ascending order: hashes, rows, and rows' bounds in them."""
    words = Words(texts, lower=True)
    hashes, _, rows = words.windows(size)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        hashes = np.concatenate([hashes, words.sequences(short)])
        rows = np.concatenate([rows, short])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[keep], rows[keep]
    return hashes, rows, np.searchsorted(rows, np.arange(len(words.counts) + 1))


def _keys(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(shingle_sets(part.column("text"))[0], return_counts=True)


def similar_sets(docs: DataFrame) -> DataFrame:
    """doc_id, key, n_shingles, set_id of every row; in one row per set and segment that may have a partner also its tokens.

    tokens are the shingles it shares with other documents, by frequency class,
    then hash. set_id is null for an empty set; key is one value per doc_id and text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, classes, check in repeats.read(batches, ["doc_id", "key", "text"]):
            hashes, rows, bounds = shingle_sets(part.column("text"))
            found, place = np.unique(hashes, return_inverse=True)
            order_class = repeats.matched(found, classes, check)[place]
            n = np.diff(bounds)
            total = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=total[1:])
            ids = mix((total[bounds[1:]] - total[bounds[:-1]]) + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.int64)
            shared = np.add.reduceat(np.append(order_class > 0, False).astype(np.int64), bounds[:-1]) * (n > 0) if len(n) else n
            may = (n > 0) & (100 * shared >= LEAST * n)
            once = np.zeros(len(n), bool)
            once[np.unique(ids, return_index=True)[1]] = True
            tokens: list[bytes | None] = [None] * len(n)
            for row in np.flatnonzero(may & once):
                a, b = bounds[row], bounds[row + 1]
                h, c = hashes[a:b], order_class[a:b]
                h, c = h[c > 0], c[c > 0]
                tokens[row] = h[np.argsort(c, kind="stable")].tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("key"), pa.array(n, pa.int64()), pa.array(ids, pa.int64(), mask=n == 0), pa.array(tokens, pa.binary())],
                ["doc_id", "key", "n_shingles", "set_id", "tokens"],
            )

    # Shingles that agree in the bytes sent are counted together, which only makes fewer sets stand out.
    segments = repeats.answered(docs.select("doc_id", place_key(docs).alias("key"), "text"), "text", _keys, width=5)
    return segments.mapInArrow(released(sets), f"doc_id {kind}, key long, n_shingles long, set_id long, tokens binary")


def needed(a: Column, b: Column) -> Column:
    """The overlap that sets of these sizes need: LEAST / 100 of the union."""
    return F.ceil((LEAST * (a + b)) / F.lit(100 + LEAST))


def postings(sets: DataFrame) -> DataFrame:
    """The index: token, set_id, n, pos, alone, bits for the tokens of which a similar set must share one.

    pos is the token's place in the set's order; shingles that no other document
    has, `alone` in number, stand before all tokens. bits has a bit for every
    class of tokens: whether the set has an odd number of them.
    """

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes = batch.column("set_id").to_numpy(), batch.column("n").to_numpy()
            tokens = [np.frombuffer(x, np.int64) for x in batch.column("tokens").to_pylist()]
            alone = sizes - np.array([len(t) for t in tokens], np.int64)
            last = sizes - -(-LEAST * sizes // 100) + 1
            kept = [t[: max(0, int(k))] for t, k in zip(tokens, last - alone, strict=True)]
            n = np.array([len(t) for t in kept])
            pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(alone, n)
            odd = np.zeros((len(tokens), BITS), np.uint8)
            for row, t in zip(odd, tokens, strict=True):
                row[:] = np.bincount(mix(t.view(np.uint64)) >> np.uint64(64 - BITS.bit_length() + 1), minlength=BITS) & 1
            words = np.packbits(odd, axis=1).view(np.int64).reshape(len(tokens), -1)
            each = np.repeat(np.arange(len(tokens)), n)
            columns = [pa.array(np.concatenate(kept) if kept else [], pa.int64()), *(pa.array(x[each]) for x in (ids, sizes)), pa.array(pos, pa.int64()), pa.array(alone[each])]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(words[each, k]) for k in range(BITS // 64))], ["token", "set_id", "n", "pos", "alone", *_WORDS])

    kinds = "token long, set_id long, n long, pos long, alone long, " + ", ".join(f"{w} long" for w in _WORDS)
    return sets.select("set_id", "n", "tokens").mapInArrow(released(prefix), kinds)


def _differ_little(a: str, b: str) -> Column:
    """Whether two entries' sets may have the overlap needed, by what is known to be in one of them only.

    These are the shingles that no other document has, and at least one token
    for every class of which one set has an odd number and the other one not.
    """
    odd = reduce(lambda x, y: x + y, (F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}"))) for w in _WORDS))
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    return 2 * needed(F.col(f"{a}.n"), F.col(f"{b}.n")) <= n - F.col(f"{a}.alone") - F.col(f"{b}.alone") - odd


def _room(a: str, b: str) -> Column:
    """Whether two entries of a list leave room for the overlap needed, by size and by place."""
    na, nb, pa_, pb = (F.col(f"{s}.{c}") for c in ("n", "pos") for s in (a, b))
    rest = F.least(na - pa_, nb - pb)
    return (100 * F.least(na, nb) >= LEAST * F.greatest(na, nb)) & (rest >= needed(na, nb))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Overlap of pairs (a, b) of sets: a, b, n_a, n_b, common, linked."""

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [[np.frombuffer(x, np.int64) for x in batch.column(c).to_pylist()] for c in ("tokens_a", "tokens_b")]
            common = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*tokens, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "n_a", "n_b")), pa.array(common, pa.int64())], ["a", "b", "n_a", "n_b", "common"])

    side = lambda s: sets.select(F.col("set_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("tokens").alias(f"tokens_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "tokens_a", "tokens_b")
    found = both.mapInArrow(released(intersect), "a long, b long, n_a long, n_b long, common long")
    return found.withColumn("linked", 100 * F.col("common") >= LEAST * (F.col("n_a") + F.col("n_b") - F.col("common")))


def components(links: DataFrame) -> DataFrame:
    """set_id, group (smallest id reachable) of all sets in links (a, b)."""
    links = links.select("a", "b")
    edges = staged(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    groups = staged(edges.groupBy(F.col("a").alias("set_id")).agg(F.least(F.min("b"), F.first("a")).alias("group")), "groups")
    while True:
        near = edges.join(groups, edges["b"] == groups["set_id"]).groupBy(F.col("a").alias("set_id")).agg(F.min("group").alias("near"))
        lower = groups.join(near, "set_id").select("set_id", F.col("group").alias("before"), F.least("group", "near").alias("via"))
        far = groups.select(F.col("set_id").alias("via"), F.col("group").alias("far"))
        step = lower.join(far, "via").select("set_id", F.least("via", "far").alias("group"), (F.least("via", "far") < F.col("before")).alias("moved"))
        step = staged(step, "groups")
        groups = step.select("set_id", "group")
        if step.filter("moved").isEmpty():
            return groups


def _grouped(entries: DataFrame, groups: DataFrame) -> DataFrame:
    found = groups.select(F.col("set_id").alias("_set"), "group")
    return entries.join(found, entries["set_id"] == found["_set"], "left").withColumn("group", F.coalesce("group", "set_id")).drop("_set")


def links_between_groups(sets: DataFrame, stars: int = 2) -> DataFrame:
    """Links (a, b) between sets (set_id, n, tokens) that connect all groups of the full join.

    `stars` rounds compare with list leaders only before what is left is compared pair by pair.
    """
    index = staged(postings(sets), "postings")
    # Both sides of a join on tokens are tables of their own, so that Spark can split a hot one.
    shared = staged(index.groupBy("token").agg(F.count("*").alias("sets")).filter("sets > 1").select("token"), "lists")
    index = staged(index.join(shared, "token", "left_semi"), "postings")
    entry = F.struct("set_id", "n", "pos", "group", "alone", *_WORDS)
    links = known = groups = None
    for turn in range(stars + 1):
        entries = index.withColumn("group", F.col("set_id")) if groups is None else _grouped(index, groups)
        mixed = entries
        if turn:
            bounds = entries.groupBy("token").agg(F.min("group").alias("low"), F.max("group").alias("high"))
            mixed = staged(entries.join(staged(bounds.filter("low < high").select("token"), "mixed-lists"), "token"), "mixed")
            if mixed.isEmpty():
                break
        if turn < stars:
            # All lists of a set agree on few leaders, so that few pairs are compared, but other ones each time.
            rank = F.col("set_id") if turn == 0 else F.xxhash64("set_id", F.pmod("token", F.lit(8)), F.lit(turn))
            leaders = staged(mixed.groupBy("token").agg(F.min_by(entry, rank).alias("lead")), "leaders")
            x = mixed.join(leaders, "token").select(entry.alias("x"), F.col("lead").alias("y"))
            sizes = 100 * F.least("x.n", "y.n") >= LEAST * F.greatest("x.n", "y.n")
            pairs = x.filter((F.col("x.group") != F.col("y.group")) & (_room("x", "y") if turn == 0 else sizes) & _differ_little("x", "y"))
        else:
            pairs = _open_pairs(mixed, known)
        pairs = pairs.select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct()
        if known is not None:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        compared = staged(overlaps(pairs, sets), "overlaps")
        new = compared.filter("linked").select("a", "b")
        links = new if links is None else links.unionByName(new)
        seen = compared.select("a", "b", "common")
        known = seen if known is None else known.unionByName(seen)
        if turn < stars:
            groups = components(links)
    return links


def _size_class(n: Column) -> Column:
    """Classes of sizes: single ones first, then CLASSES to a doubling."""
    return F.when(n < 2 * CLASSES, n).otherwise(2 * CLASSES + F.floor(CLASSES * F.log2(n / (2 * CLASSES)))).cast("long")


def _cells(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries of index lists in the blocks of the list that they may find a partner in: token, small, large, e.

    A block holds the pairs of one list whose smaller set is of class `small` and
    whose larger one of class `large`. An entry at place pos of a set of n leaves
    room for an overlap of n - pos, which tells the largest partner it can have:
    as the smaller set it goes to the blocks of its own class up to that one's, as
    the larger set to those from the smallest similar size's up to that one's or
    its own. Blocks that leave no room get no entry, so their pairs never meet.
    """
    n = F.col("e.n")
    widest = F.floor((n - F.col("e.pos")) * (100 + LEAST) / LEAST) - n
    lowest, top = F.ceil(LEAST * n / 100), F.least(n, widest)
    between = lambda a, b: F.explode(F.sequence(_size_class(a), _size_class(b)))
    small = entries.filter(widest >= n).select("token", "e", _size_class(n).alias("small"), between(n, widest).alias("large"))
    large = entries.filter(top >= lowest).select("token", "e", _size_class(n).alias("large"), between(lowest, top).alias("small"))
    return small, large


def _open_pairs(mixed: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs (x, y) of one list but different groups that neither block, place nor the leader's answers rule out.

    The overlap of x and y is bounded by their overlaps with the list's leader, its smallest set.
    """
    lead_of = staged(mixed.groupBy("token").agg(F.min("set_id").alias("lead")), "leaders")
    met = known.select("a", "b", "common")
    met = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"), "common"))
    met = met.select(F.col("a").alias("_lead"), F.col("b").alias("_set"), "common")
    entries = mixed.join(lead_of, "token")
    entries = entries.join(met, (entries["lead"] == met["_lead"]) & (entries["set_id"] == met["_set"]), "left")
    common = F.when(F.col("set_id") == F.col("lead"), F.col("n")).otherwise(F.col("common"))
    entries = staged(entries.select("token", F.struct("set_id", "n", "pos", "group", "alone", *_WORDS, common.alias("common")).alias("e")), "entries")
    small, large = _cells(entries)
    x, y = small.withColumnRenamed("e", "x"), large.withColumnRenamed("e", "y")
    most = F.least(F.col("x.n") - F.col("x.common") + F.col("y.common"), F.col("y.n") - F.col("y.common") + F.col("x.common"))
    return x.join(y, ["token", "small", "large"]).filter(
        (F.col("x.group") != F.col("y.group"))
        & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.set_id") < F.col("y.set_id"))))
        & _room("x", "y")
        & _differ_little("x", "y")
        & F.coalesce(most >= needed(F.col("x.n"), F.col("y.n")), F.lit(True))
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, key, n_shingles, set_id, component_id (smallest doc_id of its group), head (that row's key)."""
    rows = staged(similar_sets(docs), "sets")
    sets = rows.filter("tokens IS NOT NULL").dropDuplicates(["set_id"]).select("set_id", F.col("n_shingles").alias("n"), "tokens")
    sets = staged(sets, "similar-sets")
    groups = components(links_between_groups(sets))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    classes = rows.filter("set_id IS NOT NULL").groupBy("set_id").agg(F.min(place).alias("first"))
    classes = staged(_grouped(classes, groups), "classes")
    heads = classes.groupBy("group").agg(F.min("first").alias("first"))
    heads = classes.drop("first").join(heads, "group").select("set_id", F.col("first.doc_id").alias("component_id"), F.col("first.key").alias("head"))
    return rows.join(heads, "set_id", "left").select(
        "doc_id", "key", "n_shingles", "set_id", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("head", "key").alias("head")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of docs per group, all columns unchanged: the smallest doc_id's; of rows with equal doc_id and text, one."""
    heads = near_duplicates(docs).filter("key = head").select(F.col("head").alias("_head")).distinct()
    name = "key"
    while name in docs.columns:
        name += "_"
    keyed = docs.withColumn(name, place_key(docs))
    return keyed.join(heads, keyed[name] == heads["_head"], "left_semi").dropDuplicates([name]).drop(name)
