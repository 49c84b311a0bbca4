"""From documents to packed token rows: score, deduplicate, decontaminate, mix, pack.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``. What a stage returns is
written as Parquet in the shared folder and read again before the next one. Defined results: stages carry extra columns
as they are, take empty tables, null ids and texts, and repeated rows, as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm import decontaminate, mixing, ngram_join, packing, quality
from vigil.llm.common import documents, materialize, ship, text_key

#: A document stays if label 1 is at least so likely.
LEAST_QUALITY = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.score(docs, labels, keep=True).where(F.col("score") >= LEAST_QUALITY).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id, null last (of several texts of that id, one);
    rows that repeat an id and text are one."""
    ship(spark)
    classes, _ = ngram_join.join_classes(docs)
    kept = classes.where("first").select(F.col("id").alias("kept_id"), F.col("sum").alias("kept_sum"))
    repeated = not kept.groupBy("kept_id", "kept_sum").count().where("count > 1").isEmpty()
    out = docs.join(kept.distinct(), docs["doc_id"].eqNullSafe(kept["kept_id"]) & (text_key(docs["text"]) == kept["kept_sum"]), "left_semi")
    return out.dropDuplicates(["doc_id", "text"]) if repeated else out


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(F.col("doc").alias("found_id"), F.col("sum").alias("found_sum"))
    return docs.join(found, docs["doc_id"].eqNullSafe(found["found_id"]) & (text_key(docs["text"]) == found["found_sum"]), "left_anti")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: each document as often as it is served, in serving order."""
    return mixing.serve(mixing.mix(docs)).select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token rows."""
    ship(spark)
    return packing.pack(docs)


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("decontaminate", without_benchmarks), ("mix", mixed), ("pack", packed)]

#: The classifier and the tokenizer are not SQL: tests/llm holds each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
