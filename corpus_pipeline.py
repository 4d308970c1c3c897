"""The training corpus, from documents to packed windows, in stages that are each written.

A stage takes the documents that the one before has kept, and all stages but the last return
the columns of ``documents``. Each calls one operator of ``postmill.llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.llm.decontaminate import drop_leaks
from postmill.llm.line_dedup import EDIT_WORDS, dedup_lines
from postmill.llm.near_dup import drop_near_duplicates
from postmill.llm.ordinal_quality import keep_good
from postmill.llm.packing import pack_documents
from postmill.llm.queries import TOKENIZER, quality_model
from postmill.llm.staging import staged


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return keep_good(docs, quality_model(spark, docs, sf_dir))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated lines, ``n_chars`` counted anew. One that has lost lines
    and has no word left goes: others hold all that it said."""
    found = dedup_lines(
        docs, min_words=1, dropped_column="__pm_dropped", partner_words=EDIT_WORDS - 1
    )
    changed = F.col("__pm_dropped").isNotNull()
    found = found.where(~changed | F.col("text").rlike(r"[\p{L}\p{N}]"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        count = F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
        found = found.withColumn("n_chars", count.cast(kind))
    return found.drop("__pm_dropped")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold nothing of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' ids in windows: one row for each piece."""
    return pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_repeated_lines),
    ("near_dup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: The stages fit a model, compare hashed signatures and tokenize, which SQL cannot express;
#: the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
