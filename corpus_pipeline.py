"""From raw documents to packed sequences: five stages, each written as Parquet and read again by the next.

Documents that the quality classifier rejects go; repeated line chunks are cut, and documents of which nothing is
left go; of each group of near copies one document stays; documents with benchmark passages go; what
remains is packed into sequences. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm import decontaminate, line_chunks, packing, quality, set_join
from tripstrata.llm.queries import table, tokenizer
from tripstrata.sources.staging import stage_table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labelled ones among them, does not reject."""
    stats = stage_table(quality.statistics(docs), "statistics")
    model = quality.fit(stats, table(spark, sf_dir, "labels").filter(~quality.held_out("doc_id")))
    return quality.keep_good(docs, model)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks that an earlier document has; their lengths follow."""
    out = line_chunks.dedup_lines(docs).filter("n_removed = 0 or text <> ''")
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(
        F.col("n_chars")).cast("long")).select(docs.columns)


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return set_join.one_of_each(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer())


STAGES = [
    ("quality", good_documents), ("line_dedup", unique_lines), ("near_duplicates", unique_documents),
    ("decontamination", clean_documents), ("packing", packed),
]
#: Hashes of bytes, trained factors and a tokenizer are not SQL; tests/llm compares the rows with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
