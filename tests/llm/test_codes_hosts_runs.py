"""Vector codes, host reputation and periodic runs against plain Python."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kawaraban.llm import codes, periodic, reputation
from kawaraban.llm.queries import QUERIES, URL_RULES
from kawaraban.llm.words import Words

# --- vector codes ---------------------------------------------------------------


def test_walsh_rows_are_in_sequency_order():
    matrix = np.array([[1]])
    for size in (1, 2, 4, 8, 16, 32):
        while len(matrix) < size:
            matrix = np.block([[matrix, matrix], [matrix, -matrix]])
        ordered = matrix[codes.sequency_order(size)]
        assert ((ordered[:, 1:] != ordered[:, :-1]).sum(axis=1) == np.arange(size)).all()
        rows = np.random.default_rng(1).integers(-9, 9, (5, size))
        assert (codes.walsh(rows) == rows @ ordered.T).all()


@pytest.mark.parametrize("width", [0, 1, 3, 16, 20])
@pytest.mark.parametrize("factor", [1, 600, 10**9, 10**25])
def test_nearest_is_exact_with_many_ties(width, factor):
    rng = np.random.default_rng(width)
    parts, book = (rng.integers(-3, 3, (n, width)).astype(object) * factor for n in (300, 50))
    found, distances = codes.nearest(parts if factor > 10**18 else parts.astype(np.int64), book)
    for part, code, distance in zip(parts, found, distances):
        every = [sum((x - y) ** 2 for x, y in zip(part.tolist(), entry.tolist())) for entry in book]
        assert (distance, code) == min((d, i) for i, d in enumerate(every))


VECTORS = (
    [(i, [random.Random(i).gauss(0, 0.2) for _ in range(10)], i % 3) for i in range(40)]
    + [(7, [0.5] * 10, None), (7, [0.5] * 10, None), (None, [0.25] * 10, 1), (50, [], 5), (51, [0.1, -0.1], 5)]
    + [(60, [1e30, -1e30, 3.0, -0.0001], 9), (61, [-1e300] * 10, 9)]
    + [(70, None, 1), (71, [0.1, None], 1), (72, [float("nan")], 1), (73, [float("-inf"), 1.0], None)]
)


def codes_by_definition(rows, n_parts, n_entries, rounds):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = -(-max(len(r[1]) for r in kept) // n_parts)
    whole = [[math.floor(x) * 1024 if abs(x) >= 2**53 else math.floor(x * 1024) for x in r[1]] + [0] * (width * n_parts - len(r[1])) for r in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(whole[i], p) for i in order[:n_entries]] for p in range(n_parts)]
    near = lambda v, book: min((sum((x - y) ** 2 for x, y in zip(v, e)), i) for i, e in enumerate(book))
    for _ in range(rounds):
        for p, book in enumerate(books):
            took = {}
            for v in whole:
                took.setdefault(near(cut(v, p), book)[1], []).append(cut(v, p))
            books[p] = [[sum(x) // len(took[i]) for x in zip(*took[i])] if i in took else e for i, e in enumerate(book)]
    out = []
    for r, v in zip(kept, whole):
        found = [near(cut(v, p), books[p]) for p in range(n_parts)]
        out.append((r[0], r[2], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    return out, books


def test_codes_by_definition(spark):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label int").withColumn("error", F.lit("x")).repartition(3)
    want, books = codes_by_definition(VECTORS, 4, 8, 3)
    found = codes.fit(df, entries=8, rounds=3)
    assert [b.tolist() for b in found] == books
    coded = codes.with_label_errors(codes.encode(df, found)).collect()
    cap = lambda x: x if x < 2**63 else None
    sums = {}
    for _, label, _, error in want:
        if cap(error) is not None:
            sums[label] = sums.get(label, 0) + error
    assert sorted(map(str, ((r["vec_id"], r["label"], r["code"], r["error"]) for r in coded))) == sorted(str((*w[:3], cap(w[3]))) for w in want)
    assert all(r["label_error"] == sums.get(r["label"]) for r in coded)
    assert codes.digest(found) == hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_codes_of_nothing(spark):
    df = spark.createDataFrame([(1, None, 1)], "vec_id long, embedding array<float>, label int")
    books = codes.fit(df)
    assert [b.shape for b in books] == [(0, 0)] * 4
    assert codes.with_label_errors(codes.encode(df, books)).collect() == []


def test_codes_do_not_depend_on_partitions(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    one, many = (codes.fit(df.repartition(n), entries=16, rounds=2) for n in (1, 7))
    assert codes.digest(one) == codes.digest(many)


# --- host reputation ------------------------------------------------------------

URLS = [
    (None, "", ""),
    ("", "", ""),
    ("no scheme.com/en/", "", ""),
    ("://", "", ""),
    ("http://A.ExamPLE.com/en/x?q=/en/#y", "a.example.com", "/en/x"),
    ("http://example.com", "example.com", ""),
    ("http://www.example.com/en/1#a://b", "www.example.com", "/en/1"),
    ("ftp://u:p@x.co.uk:80/es/?", "u:p@x.co.uk:80", "/es/"),
    ("x://ÄB.net/es/\nmore", "Äb.net", "/es/\nmore"),
    ("a?b#c://net/fr/", "net", "/fr/"),
    ("http://notexample.com/en/", "notexample.com", "/en/"),
    ("http://1.2.3.4:8/es/", "1.2.3.4:8", "/es/"),
]


def rule_by_definition(host, path):
    fits = [(len(h + p), h + p, says) for (h, p), says in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls_and_rules(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string")
    known = reputation.reputations(reputation.hosts_of(df.withColumn("bad", F.lit(None).cast("int"))))
    rows = {r["page_id"]: r for r in reputation.judge(df, known, URL_RULES).collect()}
    assert len(rows) == len(URLS)
    for i, (_, host, path) in enumerate(URLS):
        rule, says = rule_by_definition(host, path)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"], rows[i]["verdict"]) == (host, path, rule, says or "allow")
    assert rows[4]["rule"] == "example.com/en/" and rows[6]["rule"] == "www.example.com/en/" and rows[9]["rule"] == "net/fr/"


def test_longest_rule_wins_and_ties(spark):
    rules = [(("b.c", "/"), "allow"), (("c", "/aa"), "block"), (("a.b.c", ""), "block"), (("a.b.c", ""), "allow")]
    df = spark.createDataFrame([("a.b.c", "/aa")], "h string, p string")
    got = df.select(*reputation.fitting_rule(F.col("h"), F.col("p"), rules)).first()
    assert tuple(got) == ("a.b.c", "block")


@pytest.mark.parametrize(
    "host, domain, suffix",
    [("a.b.example.co.uk", "example.co.uk", "co.uk"), ("co.uk", "co.uk", "co.uk"), ("x.y.com", "y.com", "com"), ("com", "com", "com"),
     ("u@x.y.com.:80", "y.com", "com"), ("1.2.3.4:8", "1.2.3.4", "1.2.3.4"), ("", "", "")],
)
def test_domains(spark, host, domain, suffix):
    row = reputation.hosts_of(spark.createDataFrame([(f"x://{host}/", 1)], "url string, bad int")).first()
    assert (row["host"], row["domain"], row["suffix"], row["n"], row["bad"]) == (host, domain, suffix, 1, 1)


def test_shrinkage_by_definition(spark):
    rnd = random.Random(2)
    shares = {"spam.com": 0.95, "fine.com": 0.02, "mixed.org": 0.4}
    rows = [(f"http://{h}.{d}/{i}", int(rnd.random() < p)) for d, p in shares.items() for h in "abcdefgh" for i in range(rnd.randrange(1, 40))]
    rows += [("http://new.spam.com/1", None), ("http://new.fine.com/1", None), ("http://new.other.net/1", None)]
    found = {r["host"]: r for r in reputation.reputations(reputation.hosts_of(spark.createDataFrame(rows, "url string, bad int"))).collect()}
    counts = {}
    for url, bad in rows:
        host = url.split("/")[2]
        domain = host.split(".", 1)[1]
        for node in ((domain.split(".")[-1],), (domain.split(".")[-1], domain), (domain.split(".")[-1], domain, host)):
            n, b = counts.get(node, (0, 0))
            counts[node] = (n + (bad is not None), b + (bad or 0))
    labelled = [b for _, b in rows if b is not None]
    means = {(): (sum(labelled) + 1) / (len(labelled) + 2)}
    for depth in (1, 2, 3):
        level = {k: (*v, means[k[:-1]]) for k, v in counts.items() if len(k) == depth}
        top = sum((b - n * m) ** 2 - n * m * (1 - m) for n, b, m in level.values())
        low = sum(n * (n - 1) * m * (1 - m) for n, b, m in level.values())
        k = 1 / min(max(top / low, reputation.RANGE[0]), reputation.RANGE[1]) - 1
        means |= {node: (m * k + b) / (k + n) for node, (n, b, m) in level.items()}
    for node, (n, b) in counts.items():
        if len(node) == 3:
            mean = means[node]
            assert (found[node[2]]["n"], found[node[2]]["bad"]) == (n, b)
            assert found[node[2]]["mean"] == pytest.approx(mean)
            assert found[node[2]]["bound"] == pytest.approx(mean - reputation.Z * math.sqrt(mean * (1 - mean) / (k + n + 1)))
    # An unseen host is judged by its domain; one without evidence is not blocked.
    assert found["new.spam.com"]["mean"] > 0.8 > 0.2 > found["new.fine.com"]["mean"]
    assert found["new.other.net"]["bound"] < reputation.CUTOFF < found["a.spam.com"]["bound"]


# --- periodic runs --------------------------------------------------------------


def runs_by_definition(words, exponent=4, least=6):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, exponent * q) and i > start:
                found.setdefault((start, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def texts_with_runs(rnd):
    letters = "abcde"[: rnd.choice([1, 2, 3, 5])]
    words = [rnd.choice(letters) for _ in range(rnd.randrange(60))]
    return rnd.choice([
        words,
        (words[: rnd.randrange(1, 8)] * 30)[: rnd.randrange(1, 80)],
        words + words[:4] * 5 + words + ["a", "b"] * 7,
        (words[:5] * 5 + ["z"]) * 6,
        [],
    ])


@pytest.mark.parametrize("exponent, least", [(4, 6), (2, 2), (3, 5)])
def test_runs_by_definition(exponent, least):
    rnd = random.Random(exponent)
    for _ in range(300):
        texts = [texts_with_runs(rnd) for _ in range(rnd.randrange(1, 6))]
        words = Words(pa.array([" ".join(t) if t else rnd.choice([None, " \n "]) for t in texts], pa.string()))
        want = [(int(b) + s, n, q) for b, t in zip(words.bounds, texts) for s, n, q in runs_by_definition(t, exponent, least)]
        start, end, period = periodic.runs_of(words, exponent, least)
        assert list(zip(start.tolist(), (end - start).tolist(), period.tolist())) == sorted(want, key=lambda r: (r[0], r[2]))


def test_long_runs_take_little_time_and_memory():
    for unit in (["a"], [f"w{i}" for i in range(999)]):
        words = (unit * 200_000)[:200_000]
        start, end, period = periodic.runs_of(Words(pa.array([" ".join(words)])))
        assert (start.tolist(), end.tolist(), period.tolist()) == ([0], [200_000], [len(unit)])


def planted(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def test_op13(spark, sf, edge_dir):
    for folder in (sf, edge_dir):
        docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
        want = []
        for doc_id, text in docs:
            words = planted(doc_id, text)
            # The one test text too long for the definition is one run.
            runs = [(0, len(words), 1)] if len(words) > 15_000 and len(set(words)) == 1 else runs_by_definition(words)
            gone = {i for s, n, q in runs for i in range(s + q, s + n)}
            best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
            want.append((
                doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2]))).encode()).hexdigest(),
                hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest(),
            ))
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in QUERIES["op13_runs"](spark, folder).collect())
        assert sum(w[1] for w in want) > 3


def test_collapse_keeps_other_columns(spark):
    rows = [(1, "x x x x x x y", "a", "b"), (2, None, None, "c"), (2, None, None, "c")]
    df = spark.createDataFrame(rows, "id long, text string, runs string, place string")
    got = periodic.collapse(df).select("id", "place", "n_words", "collapsed", F.size("runs").alias("n")).collect()
    assert sorted(map(tuple, got)) == [(1, "b", 7, "x y", 1), (2, "c", 0, "", 0), (2, "c", 0, "", 0)]
