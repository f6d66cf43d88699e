"""A corpus made ready for training: five stages over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written to
the work folder all executors share and read back as the next stage's documents.
All but the last keep the columns of the documents. Each stage works on the whole
of what the one before kept:

1. quality - documents that the quality rules reject go;
2. line_dedup - the later ones of repeated runs of lines go, and documents of
   which nothing is left (n_chars follows the text);
3. near_duplicates - one document of each group of similar ones stays;
4. decontamination - documents contaminated with benchmark passages go;
5. packing - the tokens of all documents in training sequences.

Nulls, empty texts and tables, repeated rows and other columns are treated as the
operators' docstrings say; no stage fails on them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kawaraban.llm import contamination, jaccard, lines, packing
from kawaraban.llm import quality as rules
from kawaraban.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    measured = staged(rules.measure(docs), "quality")
    cutoffs = rules.fit(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rules.keep_good(docs, cutoffs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left, removed = lines.without_lines(docs, lines.repeated_lines(docs))
    left = left.filter((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        counted = F.when(F.col(removed) == 0, F.col("n_chars")).otherwise(F.length("text"))
        left = left.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: The rows depend on a tokenizer and on exact binomial bounds, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
