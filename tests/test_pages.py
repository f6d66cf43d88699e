"""Page tables kept in buckets of URLs."""

import glob
import os

from pyspark.sql import functions as F

from kawaraban.operators.joins import bucket_column, pages_behind, url_bucket
from kawaraban.session import staged
from kawaraban.sources.pages import latest_pages, page_source, read_pages, write_pages
from sorted_rows import rows


def stored(spark, tmp_path, n=200):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>") for i in range(n)], "page_id bigint, url string, html string")
    write_pages(pages, str(tmp_path / "pages"), 16)
    return page_source(spark, str(tmp_path / "pages"))


def wanted(spark, *urls):
    return staged(spark.createDataFrame([(u,) for u in urls], "url string"), "wanted")


def test_layout_and_look_up(spark, tmp_path):
    pages = stored(spark, tmp_path)
    assert bucket_column(pages) == ("bucket16", 16)
    assert pages.where(F.col("bucket16") != url_bucket(F.col("url"), 16)).isEmpty()
    assert len(glob.glob(str(tmp_path / "pages/bucket16=*"))) == 16
    urls = wanted(spark, "http://x/3", "http://x/3", "http://x/77", "gone", "", None)
    assert rows(pages_behind(pages, urls), "page_id", "html") == [(3, "<p>3</p>"), (77, "<p>77</p>")]
    assert pages_behind(pages, urls).columns == ["page_id", "url", "html"]
    found = read_pages(urls.where("url IS NOT NULL"), pages)
    assert rows(found) == [("", "", False), ("gone", "", False), ("http://x/3", "<p>3</p>", True), ("http://x/77", "<p>77</p>", True)]


def test_other_buckets_are_not_opened(spark, tmp_path):
    pages = stored(spark, tmp_path)
    urls = wanted(spark, "http://x/3", "http://x/77")
    kept = {r[0] for r in urls.select(url_bucket(F.col("url"), 16)).collect()}
    for file in glob.glob(str(tmp_path / "pages/bucket16=*/*.parquet")):
        if int(file.split("bucket16=")[1].split("/")[0]) not in kept:
            os.remove(os.path.join(os.path.dirname(file), f".{os.path.basename(file)}.crc"))
            with open(file, "wb") as f:
                f.write(b"not a table" * os.path.getsize(file))
    found = latest_pages(pages_behind(pages, urls))
    assert rows(found, "page_id", "html") == [(3, "<p>3</p>"), (77, "<p>77</p>")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("dynamicpruning") >= 2


def test_pages_added_later_and_plain_tables(spark, tmp_path):
    pages = stored(spark, tmp_path, 3)
    newer = spark.createDataFrame([(9, "http://x/1", "new")], "page_id bigint, url string, html string")
    write_pages(newer, str(tmp_path / "pages"), 16)
    pages = page_source(spark, str(tmp_path / "pages"))
    urls = wanted(spark, "http://x/1")
    assert rows(latest_pages(pages_behind(pages, urls)), "page_id", "html") == [(9, "new")]
    assert rows(pages_behind(newer, urls), "page_id", "html") == [(9, "new")]
    assert bucket_column(newer) is None
