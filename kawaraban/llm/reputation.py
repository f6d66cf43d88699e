"""URL filters: fixed rules by host and path, and an empirical-Bayes reputation of hosts.

The share of bad pages of a host is estimated from labelled outcomes of its
pages. Sites form a tree: all pages, public suffix, registered domain, host. At
every level the share p of a node has a beta prior around its parent's posterior
mean m: Beta(m k, (1 - m) k), which the node's n outcomes, b of them bad, turn
into Beta(m k + b, (1 - m) k + n - b). The strength k is the same for a level and
is estimated from all its nodes (empirical Bayes, by moments): outcomes of a
beta-binomial vary by n m (1 - m) (1 + (n - 1) r) with r = 1 / (k + 1), so
r = sum((b - n m)^2 - n m (1 - m)) / sum(n (n - 1) m (1 - m)), held within RANGE.
So a host with few outcomes is judged by its domain, a domain by its suffix.

A page is blocked when the posterior's lower bound, mean less Z standard
deviations, is above CUTOFF: a host must be bad with some certainty. A fixed rule
that fits goes before the reputation.

A rule is a host and a path, as in `example.com/en/`. It fits the host itself and
all its subdomains, where the URL's path starts with the rule's. The longest rule
wins; of equally long ones the one with the longer host, then the blocking one.

Only DataFrame functions are used. Outcomes are counted per host before any
shuffle; the tree's tables have one row per host at most, and the driver gets
three numbers per level.

Defined results: a null URL or one without `://` has an empty host and path, and
shares the reputation of the empty host. A port or user name is part of the host,
but not of its domain. An address of four numbers is a domain of its own. A page
without outcome counts nowhere. Repeated rows are pages of their own. Empty tables
give empty results, no outcomes block nothing. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kawaraban.session import staged

Rule = tuple[str, str]

#: A host's share of bad pages that must be exceeded, and by how many standard deviations.
CUTOFF, Z = 0.5, 1.645
#: Bounds of the correlation r of a level's outcomes; without evidence, its lower one.
RANGE = (0.001, 0.5)
#: Second labels that make a public suffix of two labels with a country's two letters.
SECOND = ("ac", "co", "com", "edu", "gov", "ne", "net", "or", "org")
LEVELS = ("suffix", "domain", "host")


def host(url: Column) -> Column:
    """What follows the first `://`, up to `/`, `?` or `#`, with A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host, up to `?` or `#`."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def bare(name: Column) -> Column:
    """A host without user name, port and final dot."""
    return F.regexp_replace(F.regexp_replace(name, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")


def suffix(name: Column) -> Column:
    """The public suffix of a bare host: its last label, or two such as co.uk; an address as a whole."""
    second = "|".join(SECOND)
    found = F.regexp_extract(name, rf"(?:^|\.)((?:(?:{second})\.)?[a-z][a-z]|[^.]*)$", 1)
    return F.when(name.rlike(r"^[0-9]+(\.[0-9]+){3}$"), name).otherwise(found)


def domain(name: Column, ending: Column) -> Column:
    """The registered domain of a bare host: its public suffix and the label before it."""
    rest = F.left(name, F.length(name) - F.length(ending))
    return F.concat(F.regexp_extract(rest, r"([^.]*\.)?$", 0), ending)


def fitting_rule(name: Column, at: Column, rules: Sequence[tuple[Rule, str]]) -> tuple[Column, Column]:
    """The rule that wins for a host and path, and what it says; both null where none fits."""
    order = sorted(rules, key=lambda r: (-len("".join(r[0])), -len(r[0][0]), r[1] != "block"))
    if not order:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    fits = [((name == h) | name.endswith("." + h)) & at.startswith(p) for (h, p), _ in order]
    first = lambda values: F.coalesce(*(F.when(f, F.lit(v)) for f, v in zip(fits, values, strict=True)))
    return first([h + p for (h, p), _ in order]), first([says for _, says in order])


def hosts_of(pages: DataFrame) -> DataFrame:
    """host, domain, suffix, n (outcomes), bad (bad ones) of every host of pages (url, bad).

    bad is 1 for a bad page, 0 for a good one and null without an outcome.
    """
    sites = pages.select(host(F.col("url")).alias("host"), F.col("bad").cast("long").alias("bad"))
    counted = sites.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    counted = counted.withColumn("_bare", bare(F.col("host"))).withColumn("suffix", suffix(F.col("_bare")))
    return counted.select("host", domain(F.col("_bare"), F.col("suffix")).alias("domain"), "suffix", "n", "bad")


def reputations(hosts: DataFrame) -> DataFrame:
    """host, domain, suffix, n, bad, mean, bound of every host of `hosts_of`.

    Nodes are named by all their ancestors, so equal domains of different suffixes stay apart.
    """
    hosts = staged(hosts, "hosts")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    parents, path_of = None, []
    for level in LEVELS:
        path_of.append(level)
        nodes = hosts.groupBy(*path_of).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if parents is None:
            nodes = nodes.withColumn("m", F.lit((total["bad"] + 1) / (total["n"] + 2)))
        else:
            nodes = nodes.join(parents, path_of[:-1])
        nodes = staged(nodes, f"sites-{level}")
        m, n, bad = F.col("m"), F.col("n"), F.col("bad")
        spread = m * (1 - m)
        extra = F.sum((bad - n * m) * (bad - n * m) - n * spread)
        r = nodes.agg((extra / F.nullif(F.sum(n * (n - 1) * spread), F.lit(0.0))).alias("r")).first()["r"]
        r = min(max(RANGE[0] if r is None else r, RANGE[0]), RANGE[1])
        k = 1 / r - 1
        nodes = nodes.withColumn("mean", (m * k + bad) / (k + n))
        parents = nodes.select(*path_of, F.col("mean").alias("m"))
    width = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (k + F.col("n") + 1))
    return staged(nodes.select("host", "domain", "suffix", "n", "bad", "mean", (F.col("mean") - Z * width).alias("bound")), "reputations")


def judge(pages: DataFrame, reputation: DataFrame, rules: Sequence[tuple[Rule, str]], cutoff: float = CUTOFF) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block), bound of every page; no page is lost.

    The reputation table is stored, so Spark broadcasts it below its limit and
    otherwise joins with skew handling.
    """
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    known = reputation.select(F.col("host").alias("_host"), "bound")
    learned = F.when(F.coalesce(F.col("bound") > cutoff, F.lit(False)), F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(known, F.col("host") == F.col("_host"), "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(says, learned).alias("verdict"), "bound")
