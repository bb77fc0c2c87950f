"""Writers for tables, models and metrics."""

from __future__ import annotations

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import scalars as S


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated part files without header."""
    df.write.mode("overwrite").options(sep="\t", header=False).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_plays_parquet(plays: DataFrame, path: str) -> None:
    """Plays in one folder per month; Spark divides a busy month over as many tasks as its size asks for."""
    by_month = plays.withColumn("year_month", S.month_key("ts")).hint("rebalance", "year_month")
    by_month.write.mode("overwrite").partitionBy("year_month").parquet(path)


def write_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def preview(df: DataFrame, n: int = 10, truncate: bool = False) -> None:
    df.show(n, truncate=truncate)


def to_client(df: DataFrame, n: int):
    """The first ``n`` rows as a pandas frame."""
    return df.limit(n).toPandas()
