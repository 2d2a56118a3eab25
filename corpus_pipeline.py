"""The corpus pipeline: quality rules, near duplicates, repeated passages, leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's documents. All but the last return the columns of documents.
Rows that repeat an id are one document and stay or go together. A text of which the third
stage leaves no word stays as an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm.decontaminate import drop_leaks
from tabularium.llm.jaccard import link_documents
from tabularium.llm.packing import pack
from tabularium.llm.quality import keep_good
from tabularium.llm.substrings import remove_repeats
from tabularium.session import new_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the smallest id."""
    linked = link_documents(docs, width=5, percent=80)
    stay = linked.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("stays"))
    return docs.join(stay, docs["doc_id"].eqNullSafe(stay["stays"]), "left_semi")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; ``n_chars`` follows the text."""
    kept = remove_repeats(docs, rewrite=True)
    size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text"))
    return kept.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an item of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document that is left."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None  # compression, latent retrieval and bucket planning are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; intermediate tables go to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
