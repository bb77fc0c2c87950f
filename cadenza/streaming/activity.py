"""The play-count, activity and session measures on a stream of plays.

Results are of closed windows and sessions alone: a row leaves the state store once the watermark, the
latest play less the allowed lateness, has passed its end, and it leaves once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from cadenza.functions import scalars as S


def play_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of plays under ``path``; ``ts`` becomes a timestamp with zone for the watermark."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def play_counts_by_window(plays: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Completed plays per track and time window."""
    return (
        plays.where(S.is_completed())
        .withWatermark("ts", late)
        .groupBy(F.window("ts", window).alias("w"), "track_id")
        .agg(F.count(F.lit(1)).alias("play_count"))
        .select(F.col("w.start").alias("window_start"), "track_id", "play_count")
    )


def activity_by_hour(plays: DataFrame, late: str = "10 minutes") -> DataFrame:
    """All plays per clock hour with its hour of day and weekday."""
    start = F.col("w.start")
    return (
        plays.withWatermark("ts", late)
        .groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            start.alias("window_start"),
            S.hour_of_day(start).alias("hour_of_day"),
            S.day_of_week(start).alias("day_of_week"),
            S.day_name(S.day_of_week(start)).alias("day_name"),
            "event_count",
        )
    )


def sessions(plays: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Plays of a user with at most ``gap`` between each and the next, summed per session.

    The state store holds one row per open session: sums, never plays.  A session ends ``gap`` behind its last play.
    """
    return (
        plays.withWatermark("ts", late)
        .groupBy("user_id", F.session_window("ts", gap).alias("s"))
        .agg(
            F.count(F.lit(1)).alias("plays"),
            F.sum("skipped").cast("bigint").alias("skips"),
            F.sum("play_duration_ms").alias("listened_ms"),
        )
        .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "plays", "skips", "listened_ms")
    )


def closed(result: DataFrame, folder: str) -> DataFrame:
    """Run ``result`` over what its source holds and read back every row that has closed so far.

    Rows and checkpoint lie below ``folder``.  Called again, after new files or a failure, it goes on from
    the checkpoint: the sink's log names the files of each batch once, so no row is there twice.
    """
    query = append_to_parquet(result, f"{folder}/rows", f"{folder}/checkpoint")
    query.awaitTermination()
    return result.sparkSession.read.schema(result.schema).parquet(f"{folder}/rows")


def append_to_parquet(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and append finished windows to Parquet."""
    return (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
