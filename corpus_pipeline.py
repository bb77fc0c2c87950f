"""The corpus pipeline: judge, drop repeated passages, near copies and benchmark leaks, pack.

STAGES names each stage and its function of (spark, docs, sf_dir); all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontam, linededup, packing, quality, simjoin
from cadenza.llm.common import fresh
from cadenza.session import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared passages stay in the first document; one that loses all its words to it goes.

    ``n_chars`` follows the text that is left.
    """
    added = fresh(docs, "n_deleted")
    done = linededup.dedup_lines(docs, deleted_column=added)
    cut = F.col(added) > 0
    done = done.where(~cut | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simjoin.one_of_each(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of what is left in their buckets and batches."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", keep_quality), ("line dedup", dedup_lines), ("n-gram Jaccard join", one_of_each),
    ("benchmark decontamination", without_leaks), ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each on the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
