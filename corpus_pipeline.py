"""Cleaning pipeline over ``documents``: quality rules, line dedup, n-gram
Jaccard join, benchmark decontamination, best-fit packing.

Each stage works on all rows that the one before it kept, written as Parquet
and read again; all but the last return the columns of ``documents``.  Null
and empty texts fail the quality rules; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventstar.llm.common import table
from eventstar.llm.decontam import remove_contaminated
from eventstar.llm.jaccard import keep_one
from eventstar.llm.linededup import remove_duplicate_lines
from eventstar.llm.packing import default_tokenizer, pack
from eventstar.llm.quality import filter_documents
from eventstar.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    return filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line resembles; those that
    consist of such lines only go."""
    return remove_duplicate_lines(docs, drop_emptied=True)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in sequences."""
    return pack(docs, default_tokenizer())


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup),
          ("ngram jaccard", ngram_jaccard), ("decontamination", decontamination),
          ("best-fit packing", best_fit_packing)]

#: Token ids cannot be expressed in SQL; tests compare with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
