"""Ratings kept up to date by a stream of plays.

A micro-batch is summed per (user, track) and written as the increment of its id.  Sums only
add, so the ratings are a base and the increments behind it, and a batch costs what it holds, not
what the ratings hold.  Every ``COMPACTED_EVERY`` batches base and increments become a new base.

A batch that is run again writes its own increment anew; one that a base already holds is passed over.
A folder counts once its ``_SUCCESS`` is there, so a batch or a base that was cut off is as if it had not been.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from cadenza.operators.plays import implicit_ratings

COMPACTED_EVERY = 16
SCHEMA = "user_id bigint, track_id bigint, implicit_rating bigint"


def _done(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Finished folders of one kind by their number: at most ``COMPACTED_EVERY`` increments count, older ones are in a base."""
    jvm = spark._jvm.org.apache.hadoop.fs
    glob = jvm.Path(f"{path}/{kind}=*/_SUCCESS")
    found = glob.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(glob) or []
    folders = [str(f.getPath().getParent().toString()) for f in found]
    return {int(f.rsplit("=", 1)[1]): f for f in folders}


def _state(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """The last batch of the newest base (-1: none), and the folders that make up the ratings."""
    bases = _done(spark, path, "upto")
    newest = max(bases, default=-1)
    behind = [f for n, f in sorted(_done(spark, path, "batch").items()) if n > newest]
    return newest, ([bases[newest]] if bases else []) + behind


def current(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, track_id, implicit_rating) of all plays merged so far."""
    _, folders = _state(spark, path)
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(*folders).groupBy("user_id", "track_id").agg(F.sum("implicit_rating").alias("implicit_rating"))


def merge(plays: DataFrame, batch_id: int, path: str, compacted_every: int = COMPACTED_EVERY) -> None:
    """Add one batch of plays to the ratings under ``path``; adding it again changes nothing."""
    spark = plays.sparkSession
    newest, _ = _state(spark, path)
    if batch_id <= newest:
        return
    implicit_ratings(plays).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    if batch_id - newest >= compacted_every:
        current(spark, path).write.mode("overwrite").parquet(f"{path}/upto={batch_id}")


def upsert(plays: DataFrame, path: str, checkpoint: str, merge_batch: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Merge what the stream of plays holds, batch by batch."""
    return (
        plays.writeStream.foreachBatch(merge_batch or (lambda batch, batch_id: merge(batch, batch_id, path)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
