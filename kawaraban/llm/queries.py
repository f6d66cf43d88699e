"""The registered queries of the dealt operators and the DuckDB SQL that must agree."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawaraban.llm import chat, codes, contamination, jaccard, langid, lines, packing, periodic, pii, quality, reputation, substrings, tokenfiles
from kawaraban.session import scratch_path, staged

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    trees = langid.fit(docs.filter(~langid.held_out()))
    return langid.predict(docs, trees).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as seekable token files and read back."""
    docs = table(spark, sf_dir, "documents")
    manifest = tokenfiles.write(docs, public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "ids"))
    return tokenfiles.read(manifest, docs.schema["doc_id"].dataType.simpleString())


@query
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that start more than once, and its longest repeated level."""
    found = substrings.remove_repeated(table(spark, sf_dir, "documents"))
    digests = F.sha2("kept", 256).alias("kept_sha256")
    # Rows of one doc_id differ in their runs, so levels go by a number of the stored row.
    number = F.monotonically_increasing_id().alias("row")
    rows = staged(found.select(number, "doc_id", "n_words", "n_removed", digests, "runs"), "substrings")
    runs = rows.select(F.col("row").alias("doc_id"), F.explode("runs").alias("run")).select("doc_id", "run.*")
    levels = rows.filter("n_removed > 0").select("row", F.lit(substrings.WINDOW).cast("long").alias("longest"))
    for length, longer in substrings.longer_runs(runs):
        levels = levels.unionByName(longer.select(F.col("doc_id").alias("row"), F.lit(length).cast("long").alias("longest")))
    levels = levels.groupBy("row").agg(F.max("longest").alias("longest"))
    return rows.join(levels, "row", "left").select(
        "doc_id", "n_words", "n_removed", "kept_sha256", F.coalesce("longest", F.lit(0)).alias("longest")
    )


@query
def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later ones of repeated runs of lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left, removed = lines.without_lines(docs, lines.repeated_lines(docs))
    return left.select("doc_id", F.col(removed).alias("n_removed"), F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


@query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: the fixed patterns' matches and what boosted trees add."""
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [F.size(F.expr(f"filter(base, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined("base"), 256).alias("base_sha256"), pii.joined("spans").alias("spans"))


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and near-duplicate group of every document."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and learned verdict of every document."""
    measured = quality.staged(quality.measure(table(spark, sf_dir, "documents")), "quality")
    cutoffs = quality.fit(measured, table(spark, sf_dir, "labels"))
    return quality.judge(measured, cutoffs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op5_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside benchmark windows, and the contamination rule."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    answers = contamination.search(contamination.build_index(docs, items), items)
    return contamination.contaminated(answers).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP5_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
# Every window of a document and of an item as one string; a window of 13 words or, of a shorter item, all its words.
ORACLES["op5_contamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_OP5_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_OP5_WORDS} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.s, dw.n, iw.item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
hit AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(s, s + n)) AS p FROM m) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the made one formatted, and read back from the output."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    made = spark.sql(f"SELECT -7L AS conv_id, * FROM VALUES (0L, 'user', {_OP10_TEXT}), (1L, 'assistant', {_OP10_TEXT}) AS t(turn, role, text)")
    turns = staged(chat.format_turns(given.unionByName(made)), "chat")
    # An example repeats the one before it, which Zstandard stores as a reference.
    return chat.digests(turns, staged(chat.examples(turns), "chat-examples", compression="zstd"))


# A raw literal in Spark, whose plain ones read a backslash as an escape.
_OP10_TEXT = r"r'\### Assistant: </turn> ok'"
# Escaping adds one character per backslash, `<`, and in roles `>` and line end; the marks of a turn take 16.
_ADDED = "length({0}) - length(replace(replace({0}, '\\', ''), '<', ''))"
ORACLES["op10_chat"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', {_OP10_TEXT[1:]}
  UNION ALL SELECT -7, 1, 'assistant', {_OP10_TEXT[1:]}),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '') AS loss,
    sum(16 + length(role) + length(text) + {_ADDED.format("text")} + {_ADDED.format("role")}
        + length(role) - length(replace(replace(role, '>', ''), chr(10), ''))) AS formatted_chars,
    count(*) FILTER (role = 'assistant') AS n_examples
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars, n_examples
FROM g
"""
# Equal sets are joined as one; a group's label spreads along links until nothing changes.
ORACLES["op8_jaccard"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s FROM d),
sets AS (SELECT min(doc_id) AS id, s, len(s) AS n FROM sh WHERE len(s) > 0 GROUP BY s),
t AS (SELECT id, n, unnest(s) AS x FROM sets),
link AS (
  SELECT a.id AS a, b.id AS b FROM t a JOIN t b ON a.x = b.x AND a.id < b.id
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(a, b) AS (SELECT id, id FROM sets UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
comp AS (SELECT a AS id, min(b) AS c FROM reach GROUP BY a)
SELECT sh.doc_id, CAST(len(sh.s) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id
FROM sh LEFT JOIN sets USING (s) LEFT JOIN comp USING (id)
"""

# Windows as strings, per document; a window that starts twice or more marks its words. The longest level is
# found from windows of every doubled length as such.
_OP4_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
ORACLES["op4_substrings"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_OP4_WORDS} AS w FROM documents),
lens AS (SELECT unnest([35, 70, 140, 280, 560, 1120, 2240, 4480, 8960, 17920]) AS n),
win AS (
  SELECT r, n, s, md5(array_to_string(w[s:s + n - 1], ' ')) AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
again AS (SELECT r, n, s FROM win QUALIFY count(*) OVER (PARTITION BY n, win) > 1),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 35)) AS p FROM again WHERE n = 35),
g AS (SELECT r, list(p) AS ps, count(*) AS n_removed FROM gone GROUP BY r),
longest AS (SELECT r, max(n) AS longest FROM again GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE [w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(ps, i)] END, ' ')) AS kept_sha256,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM d LEFT JOIN g USING (r) LEFT JOIN longest USING (r)
"""


@query
def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as four codebook entries, and the codebooks' digest."""
    vectors = table(spark, sf_dir, "embeddings")
    books = codes.fit(vectors)
    coded = codes.with_label_errors(codes.encode(vectors, books))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(codes.digest(books)).alias("codebooks_sha256"))


_SQUARES = """
n{k} AS MATERIALIZED (
  SELECT r, p, min(struct_pack(d := d, e := e)) AS near
  FROM (SELECT r, p, e, sum((x - c) * (x - c)) AS d FROM x JOIN b{k} USING (p, j) GROUP BY r, p, e) GROUP BY r, p)"""
_MOVED = """
b{k} AS MATERIALIZED (
  SELECT p, e, j, coalesce((s - ((s % n) + n) % n) // n, c) AS c
  FROM b{before} LEFT JOIN (SELECT p, near.e AS e, j, sum(x) AS s, count(*) AS n FROM x JOIN n{before} USING (r, p) GROUP BY ALL) USING (p, e, j))"""
ORACLES["op11_codes"] = (
    """
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT r, (i - 1) // w AS p, (i - 1) % w AS j, CAST(floor(1024 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, len(embedding) // 4 AS w, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
b0 AS MATERIALIZED (SELECT p, r AS e, j, x AS c FROM x WHERE r < 256),"""
    + ",".join(_SQUARES.format(k=k) + "," + _MOVED.format(k=k + 1, before=k) for k in range(codes.ROUNDS))
    + ","
    + _SQUARES.format(k=codes.ROUNDS)
    + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', near.e), '' ORDER BY p) AS code, CAST(sum(near.d) AS BIGINT) AS error FROM n{codes.ROUNDS} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{codes.ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (r)
"""
)


#: The filter's fixed rules: host, path, verdict.
URL_RULES = [(("com", "/"), "allow"), (("example.com", "/en/"), "block"), (("www.example.com", "/en/"), "allow"), (("net", "/es/"), "block"), (("net", "/fr/"), "block")]
#: The document that a page shows, in its path.
_SHOWN = r"/([0-9]{1,18})(?:\.[a-z]+)?/?$"


@query
def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the fixed rules, else by its host's reputation; outcomes are the labels of the documents shown."""
    pages, labels = table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels")
    bad = F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0))
    graded = labels.groupBy("doc_id").agg(bad.alias("bad"))
    shown = F.regexp_extract(reputation.path(F.col("url")), _SHOWN, 1).try_cast("long")
    outcomes = pages.join(graded, shown == F.col("doc_id"), "left").select("url", "bad")
    known = reputation.reputations(reputation.hosts_of(outcomes))
    return reputation.judge(pages, known, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


_LEVEL = """
{level} AS MATERIALIZED (SELECT {keys}, any_value(m) AS m, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM {source} GROUP BY {keys}),
{level}_k AS (
  SELECT 1 / least(greatest(coalesce(sum((bad - n * m) * (bad - n * m) - n * (m * (1 - m))) / nullif(sum(n * (n - 1) * (m * (1 - m))), 0), {low}), {low}), {high}) - 1 AS k FROM {level}),
{level}_p AS MATERIALIZED (SELECT * EXCLUDE (m), (m * k + bad) / (k + n) AS mean, k FROM {level}, {level}_k)"""


def _op12_levels() -> str:
    out, keys, source = [], [], "(SELECT *, (SELECT CAST(coalesce(sum(bad), 0) + 1 AS DOUBLE) / (coalesce(sum(n), 0) + 2) FROM hosts) AS m FROM hosts)"
    for level in reputation.LEVELS:
        keys.append(level)
        low, high = reputation.RANGE
        out.append(_LEVEL.format(level=f"t_{level}", keys=", ".join(keys), source=source, low=low, high=high))
        source = f"(SELECT hosts.*, mean AS m FROM hosts JOIN t_{level}_p USING ({', '.join(keys)}))"
    return ",".join(out)


_OP12_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{{{n}}}'"
    for n, ((h, p), _) in sorted(enumerate(URL_RULES), key=lambda x: -len("".join(x[1][0])))
)
_SECOND = "|".join(reputation.SECOND)
ORACLES["op12_urls"] = f"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
graded AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY doc_id),
counted AS (
  SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', '') AS bare, count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM u LEFT JOIN graded ON TRY_CAST(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\\.[a-z]+)?/?$', 1), '') AS BIGINT) = doc_id GROUP BY host),
ended AS (
  SELECT *, CASE WHEN regexp_matches(bare, '^[0-9]+(\\.[0-9]+){{3}}$') THEN bare
    ELSE regexp_extract(bare, '(?:^|\\.)((?:(?:{_SECOND})\\.)?[a-z][a-z]|[^.]*)$', 1) END AS suffix FROM counted),
hosts AS MATERIALIZED (
  SELECT host, regexp_extract(left(bare, length(bare) - length(suffix)), '([^.]*\\.)?$') || suffix AS domain, suffix, n, bad FROM ended),
{_op12_levels()},
judged AS (
  SELECT host, CASE WHEN mean - {reputation.Z} * sqrt(mean * (1 - mean) / (k + n + 1)) > {reputation.CUTOFF} THEN 'block' ELSE 'allow' END AS learned FROM t_host_p),
ruled AS (SELECT u.*, CASE {_OP12_FITS.format(*("".join(r) for r, _ in URL_RULES))} END AS rule FROM u)
SELECT page_id, host, path, rule,
  CASE {" ".join(f"WHEN rule = '{''.join(r)}' THEN '{says}'" for r, says in URL_RULES)} ELSE learned END AS verdict
FROM ruled JOIN judged USING (host)
"""


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text of every document, where a tenth of the texts is made periodic from some word on."""
    key = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", F.when(key % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)).alias("w"), F.floor(key / 10).alias("g"))
    rows = rows.withColumn("n", F.nullif(F.size("w"), F.lit(0))).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    again = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    made = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    return rows.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


@query
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, and its words without the repetitions."""
    found = periodic.collapse(with_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period"))))
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")).alias("lines"), "collapsed")
    return found.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        (-F.col("best.l")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * -F.col("best.l") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
