"""Registered queries against DuckDB, where SQL can express them."""

import duckdb
import pytest

from kawaraban.llm.queries import ORACLES, QUERIES

TABLES = ("documents", "benchmark", "labels", "conversations", "pages", "embeddings")


def check(spark, folder, files, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet{files}')")
    df = QUERIES[name](spark, folder)
    cols = sorted(df.columns)
    found = con.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in df.select(*cols).collect()) == order(tuple(r[i] for i in at) for r in found.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf, name):
    check(spark, sf, "", name)


@pytest.mark.parametrize("name", ["op4_substrings", "op5_contamination", "op8_jaccard", "op10_chat", "op12_urls"])
def test_query_on_odd_rows(spark, edge_dir, name):
    check(spark, edge_dir, "/*.parquet", name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_on_empty_tables(spark, empty_dir, name):
    rows = QUERIES[name](spark, empty_dir).collect()
    assert len(rows) == (1 if name == "op10_chat" else 0)


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
