"""Time the headline queries; prints one JSON line.

Every query is planned and run to the end with all of its columns (noop sink).
Derived page tables are written by the first run of a query and read by the
others, so they count in no time but that of a single run.  BENCH_SF_DIR, BENCH_CPUS and BENCH_REPEATS set the data, the cores and the runs
per query, of which the fastest counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from kawaraban import session
from kawaraban.queries import QUERIES

HEADLINE = [
    "article_body",
    "html_tokens",
    "article_paragraphs",
    "element_markup",
    "page_links",
    "strip_tags",
    "histogram_by_lang",
    "histogram_by_year",
    "dedup_articles",
    "days_to_refresh",
    "unseen_pair",
    "unseen_independent",
    "listing_detail",
    "link_expand",
    "roles_tuple",
    "daily_corpus",
    "headline_table",
    "archive_table",
    "incremental_table",
    "reanalyse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = session.build(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__driver__memory="12g",
        spark__checkpoint__dir=os.environ.get("BENCH_WORK_DIR", "/tmp/kawaraban-bench"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        runs = []
        for _ in range(repeats):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "article_pages_per_sec": round(pages / times["article_body"], 1) if "article_body" in times else None,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
