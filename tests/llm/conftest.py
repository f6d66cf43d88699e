import os
import sys

import pytest
from edges import CONVERSATIONS, DOCUMENTS, ITEMS, LABELS, PAGES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
    "pages": "page_id long, url string, html string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}
#: Names that operators use for columns of their own.
CLASHES = ["key", "n_words", "gone", "segment", "row", "n_removed", "kept", "tokens", "score", "part", "_head", "spans", "n", "w", "host", "bad", "runs"]


@pytest.fixture
def sf():
    return SF


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """Writes tables (documents with columns of clashing names, two files each) and gives their folder."""

    def write(**rows):
        folder = tmp_path_factory.mktemp("tables")
        for name, schema in SCHEMAS.items():
            df = spark.createDataFrame(rows.get(name, []), schema)
            if name in ("documents", "pages"):
                df = df.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHES))
            df.repartition(2).write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write


@pytest.fixture(scope="session")
def edge_dir(tables):
    documents = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in DOCUMENTS]
    return tables(documents=documents, benchmark=ITEMS, labels=LABELS, conversations=CONVERSATIONS, pages=PAGES)


@pytest.fixture(scope="session")
def empty_dir(tables):
    return tables()
