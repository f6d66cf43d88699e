"""Whole answers by the definition, where a first holder, a sample or a name may be missing."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_queries import check

from kawaraban.llm import contamination, jaccard, langid, lines, packing, repeats, substrings


def rows_of(texts):
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


def lines_by_definition(texts):
    """Every line of a run of WORDS words or more that equals a run at an earlier place; places in row order."""
    lists = [[(i, x) for i, x in enumerate(t.split("\n")) if x.split()] for t in texts]
    gone = [set() for _ in texts]
    for p, here in enumerate(lists):
        for q, there in enumerate(lists[: p + 1]):
            for shift in range(1 if p == q else 1 - len(here), len(there) if p != q else len(here)):
                # Line i here beside line i + shift of an earlier text, or line i - shift of this one.
                other = [i - shift if p == q else i + shift for i in range(len(here))]
                run = []
                for i in [*range(len(here)), None]:
                    if i is not None and 0 <= other[i] < len(there) and here[i][1] == there[other[i]][1]:
                        run.append(i)
                        continue
                    if sum(len(here[k][1].split()) for k in run) >= lines.WORDS:
                        gone[p].update(here[k][0] for k in run)
                    run = []
    return gone


def lines_gone(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left, removed = lines.without_lines(docs, lines.repeated_lines(docs))
    return {r["doc_id"]: (r["text"], r[removed]) for r in left.collect()}


def test_lines_after_a_passage_whose_first_holder_goes_on_differently(spark, tables):
    passage = " ".join(f"p{j}" for j in range(60))
    more = " ".join(f"b{j}" for j in range(10))
    texts = [f"{passage}\na", f"{passage}\n{more}\nx", f"{passage}\n{more}\ny"]
    assert lines_gone(spark, tables(documents=rows_of(texts))) == {0: (texts[0], 0), 1: (f"{more}\nx", 1), 2: ("y", 2)}


def test_lines_by_definition(spark, tables):
    rnd = random.Random(3)
    known = [" ".join(f"w{k}_{j}" for j in range(rnd.choice([1, 3, 7, 12, 20, 33, 49, 50, 60]))) for k in range(40)]
    stock = [[rnd.choice(known) for _ in range(30)] for _ in range(4)]
    texts = []
    for i in range(60):
        text = []
        while len(text) < rnd.randrange(5, 40):
            source = rnd.choice(stock)
            a = rnd.randrange(len(source))
            text += [*source[a : a + rnd.randrange(1, 9)], *([""] * rnd.randrange(2)), *([f"own {i} {len(text)}"] * rnd.randrange(2))]
        texts.append("\n".join(text))
    want = {}
    for i, (text, gone) in enumerate(zip(texts, lines_by_definition(texts), strict=True)):
        want[i] = ("\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone), len(gone))
    assert lines_gone(spark, tables(documents=rows_of(texts))) == want
    assert 100 < sum(n for _, n in want.values()) < sum(t.count("\n") + 1 for t in texts)


def test_op2_learns_a_language_of_few_long_texts(spark, monkeypatch):
    sample = 20_000
    rows = [(i, "few", f"{i} lorem ipsum dolor " * 100_000) for i in range(3)]
    rows += [(10 + i, "many", f"{i} the quick brown fox " * 4) for i in range(4000)]
    rows += [(5000, "one", "zyx wvu tsr qpo")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    sizes = {}
    count = langid.count_grams

    def counted(chosen):
        sizes.update({r["lang"]: (r["n"], r["b"]) for r in chosen.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("b")).collect()})
        return count(chosen)

    monkeypatch.setattr(langid, "count_grams", counted)
    trees = langid.fit(docs, sample)
    assert trees.langs == ["few", "many", "one"]
    assert sizes["few"][0] == 1 and sizes["one"] == (1, 15)
    assert sample <= sizes["many"][1] < 1.1 * sample
    asked = spark.createDataFrame([(1, "ipsum dolor lorem"), (2, "brown quick the fox"), (3, "tsr zyx")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in langid.predict(asked, trees).collect()} == {1: "few", 2: "many", 3: "one"}


@pytest.mark.parametrize("block", [3, 7, 40])
def test_op2_scores_long_texts_by_blocks(block, monkeypatch):
    """Runs over a block's edge count once, and a text's code length doesn't depend on the texts before it."""
    texts = ["", "the quick brown fox " * 5, "q", "", "été à la plage " * 9, "zz", ""]
    counts = Counter(("x", n, code) for *_, runs in langid.grams(pa.array(texts)) for n, (codes, _) in enumerate(runs, 1) for code in codes.tolist())
    counts.update({("y", 1, 113): 2, ("y", 2, 113 << 8 | 117): 1})
    table = pa.table({"lang": [k[0] for k in counts], "n": pa.array([k[1] for k in counts], pa.int32()), "code": [k[2] for k in counts], "count": list(counts.values())})
    scorer = langid.Scorer(langid.Trees(table))
    whole = scorer.lengths(pa.array(texts))
    monkeypatch.setattr(langid, "BLOCK", block)
    assert counts - Counter({("y", 1, 113): 2, ("y", 2, 113 << 8 | 117): 1}) == Counter(
        ("x", n, code) for *_, runs in langid.grams(pa.array(texts)) for n, (codes, _) in enumerate(runs, 1) for code in codes.tolist()
    )
    got = scorer.lengths(pa.array(texts))
    np.testing.assert_allclose(got, whole)
    for i, text in enumerate(texts):
        assert (scorer.lengths(pa.array([text]))[0] == got[i]).all()


def test_op2_takes_little_memory_for_a_long_text(monkeypatch):
    monkeypatch.setattr(langid, "BLOCK", 1 << 16)
    table = pa.table({"lang": ["x"], "n": pa.array([1], pa.int32()), "code": [97], "count": [5]})
    scorer = langid.Scorer(langid.Trees(table))
    text = pa.array(["the quick brown fox " * 400_000])
    tracemalloc.start()
    scorer.lengths(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * text.nbytes


def test_op2_learns_from_texts_shorter_than_a_context():
    trees = langid.Trees(pa.table({"lang": ["x", "y"], "n": pa.array([1, 1], pa.int32()), "code": [97, 98], "count": [5, 5]}))
    got = langid.Scorer(trees).lengths(pa.array(["aaaa", "bbbb"]))
    assert got[0].argmin() == 0 and got[1].argmin() == 1


def test_op5_items_without_id(spark, tables, monkeypatch):
    passage = [" ".join(f"q{k}_{j}" for j in range(15)) for k in range(4)]
    items = [(None, passage[0]), (None, passage[1]), (3, passage[2]), (None, passage[2]), (None, None), (None, "!")]
    texts = [f"x {passage[0]} y", f"{passage[0]} z {passage[1]}", f"{passage[2]} v", f"{passage[3]} v", "x y z"]
    folder = tables(documents=rows_of(texts), benchmark=items)
    docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    for size in (contamination.BLOCK, 60):
        monkeypatch.setattr(contamination, "BLOCK", size)
        check(spark, folder, "/*.parquet", "op5_contamination")
        found = contamination.contaminated(contamination.search(contamination.build_index(docs, bench), bench)).collect()
        assert {r["doc_id"]: (r["items"], r["near_items"], r["n_items"], r["contaminated"]) for r in found} == {
            0: ([None], [None], 1, True),
            1: ([None], [None], 1, True),
            2: (["3", None], ["3", None], 2, True),
            3: ([], [], 0, False),
            4: ([], [], 0, False),
        }
        assert {r["doc_id"] for r in contamination.drop_contaminated(docs, bench).collect()} == {3, 4}


def test_op4_levels_of_rows_that_share_an_id(spark, tables):
    long, short = (" ".join(f"{c}{j}" for j in range(n)) for c, n in (("l", 150), ("s", 40)))
    texts = [(1, f"a {long}"), (1, f"b {short}"), (1, "c"), (2, f"d {long}"), (3, f"e {short}"), (None, f"f {long}"), (None, f"g {short}")]
    check(spark, tables(documents=[(d, t, "en", "s", 0) for d, t in texts]), "/*.parquet", "op4_substrings")


def test_op4_sends_whole_hashes_of_longer_windows(spark, tables, monkeypatch):
    widths = []
    answered = repeats.answered
    monkeypatch.setattr(repeats, "answered", lambda *args, width=repeats.WIDTH: widths.append(width) or answered(*args, width=width))
    shared = " ".join(f"l{j}" for j in range(150))
    found = substrings.remove_repeated(spark.read.parquet(f"{tables(documents=rows_of([shared, shared]))}/documents.parquet"))
    runs = found.select("doc_id", F.explode("runs").alias("run")).select("doc_id", "run.*")
    assert [n for n, _ in substrings.longer_runs(runs)] == [70, 140]
    assert widths[1:] == [8, 8]


@pytest.mark.parametrize("partitions", [1, 64])
def test_op1_pads_one_sequence_in_any_number_of_partitions(spark, partitions):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(partitions)
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    row = pieces.agg(F.sum("length").alias("tokens"), F.countDistinct("sequence_id").alias("sequences"), F.sum(F.octet_length("ids")).alias("bytes")).first()
    assert row["sequences"] == -(-row["tokens"] // 4096) and row["bytes"] == 4 * row["tokens"]


def test_op8_a_common_opening_makes_no_pairs(spark):
    """A list of sets that share an opening and nothing else: no two entries meet in a block."""
    texts = [(i, f"a b c d e f g own{i}") for i in range(600)] + [(1000 + i, f"a b c d e f g w{i} x{i} y{i} z{i}") for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = jaccard.similar_sets(docs.repartition(3))
    sets = rows.filter("tokens IS NOT NULL").select("set_id", F.col("n_shingles").alias("n"), "tokens")
    index = jaccard.postings(sets)
    assert index.groupBy("token").count().agg(F.max("count")).first()[0] >= 600
    small, large = jaccard._cells(index.select("token", F.struct("set_id", "n", "pos").alias("e")))
    assert small.join(large.withColumnRenamed("e", "f"), ["token", "small", "large"]).isEmpty()
    assert jaccard.near_duplicates(docs).filter("component_id != doc_id").isEmpty()


def test_op8_blocks_keep_every_pair_with_room(spark):
    rnd = random.Random(4)
    entries = [(t, (i, n, rnd.randrange(max(1, n // 4)))) for i in range(200) for n in [rnd.choice([1, 2, 5, 12, 13, 40, 45, 50, 200, 230, 5000])] for t in rnd.sample(range(4), 2)]
    index = spark.createDataFrame(entries, "token long, e struct<set_id: long, n: long, pos: long>")
    small, large = jaccard._cells(index)
    met = small.join(large.withColumnRenamed("e", "f"), ["token", "small", "large"]).select("token", "e.*", F.col("f.set_id").alias("other"), F.col("f.n").alias("m"))
    met = Counter((r["token"], r["set_id"], r["other"]) for r in met.filter("n <= m AND set_id != other").collect())
    for t, (i, n, p) in entries:
        for u, (j, m, q) in entries:
            if t == u and i != j and n <= m and min(n - p, m - q) >= -(-75 * (n + m) // 175):
                assert met[t, i, j] == 1


def test_repeats_adds_up_the_same_in_slices(monkeypatch):
    rng = np.random.default_rng(3)
    keys = [np.unique(rng.integers(0, 900, 400)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(5)]
    counts = [rng.integers(1, 4, len(k)).astype(np.uint8) for k in keys]
    total = Counter()
    for k, c in zip(keys, counts):
        total.update(dict(zip(k.tolist(), c.tolist())))
    packed = pa.chunked_array([pa.array([k.view(np.uint8).reshape(-1, 8)[:, :7].tobytes() for k in keys], pa.binary())])
    few = pa.chunked_array([pa.array([c.tobytes() for c in counts], pa.binary())])
    for size in (1 << 18, 8):
        monkeypatch.setattr(repeats, "SLICE", size)
        found = repeats._classes(packed, few, 7)
        assert [list(x) for x in found] == [[0 if total[k] < 2 else total[k].bit_length() for k in key.tolist()] for key in keys]


def test_op8_bits_rule_out_no_link(spark):
    """Mutated copies around the threshold: groups equal those of all pairs, and few pairs are compared in vain."""
    rnd = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(160):
        words = list(base)
        for k in rnd.sample(range(150), rnd.randrange(8)):
            words[k] = f"x{i}_{k}"
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    group = list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == group
    assert 1 < len(set(group)) < len(texts)
    kept = jaccard.similar_sets(docs).filter("tokens IS NOT NULL").dropDuplicates(["set_id"])
    kept = kept.select("set_id", F.col("n_shingles").alias("n"), "tokens")
    rows = jaccard.postings(kept).dropDuplicates(["set_id"])
    x, y = (rows.select(F.struct(*rows.columns).alias(c)) for c in "xy")
    near = x.join(y, F.col("x.set_id") < F.col("y.set_id")).filter(jaccard._differ_little("x", "y"))
    pairs = near.select(F.col("x.set_id").alias("a"), F.col("y.set_id").alias("b"))
    found = jaccard.overlaps(pairs, kept).agg(F.count("*").alias("n"), F.count_if("linked").alias("linked")).first()
    distinct = list(set(map(frozenset, sets)))
    assert found["linked"] == sum(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(distinct) for b in distinct[:i])
    assert found["n"] < 2 * found["linked"]
