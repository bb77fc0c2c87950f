"""Bind the plays / tracks / users tables onto the star-schema parquet files.

``events`` gives listening behaviour with real hours; ``lineitem`` gives volume
(its dates have no time of day).  Each function reads only the columns its
table needs, so the parquet scans stay narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.sources.schemas import AUDIO_FEATURES, EMBEDDED_FEATURES


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def _text(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), value.cast("string"))


def as_plays(events: DataFrame) -> DataFrame:
    """Rows of ``events``, read or streamed, as plays: the error events, about a fifth, are the skips."""
    return events.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("track_id"),
        "ts",
        F.round(F.col("value") * 1000).cast("bigint").alias("play_duration_ms"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("skipped"),
        F.hour("ts").alias("hour_of_day"),
        F.weekday("ts").alias("day_of_week"),
    )


def event_plays(spark: SparkSession, base: str) -> DataFrame:
    return as_plays(table(spark, base, "events"))


def event_play_stream(spark: SparkSession, base: str) -> DataFrame:
    """``event_plays`` as a stream; ``ts`` has a zone for the watermark."""
    kinds = table(spark, base, "events").schema
    # A pattern may name one file as well as a folder of files; a plain path of a stream must be a folder.
    events = spark.readStream.schema(kinds).parquet(f"{base}/events.parque[t]")
    return as_plays(events).withColumn("ts", F.col("ts").cast("timestamp"))


def embedding_tracks(spark: SparkSession, base: str) -> DataFrame:
    """Tracks from ``embeddings``: the first eight dimensions are the named features, all of them ``dim_1`` and so on."""
    dim = lambda i: F.element_at("embedding", i).cast("double")
    features = [dim(i + 1).alias(name) for i, name in enumerate(AUDIO_FEATURES)]
    return table(spark, base, "embeddings").select(
        F.col("vec_id").alias("track_id"),
        _text("Track ", F.col("vec_id")).alias("name"),
        _text("A", F.col("vec_id") % 50).alias("artist_id"),
        _text("Artist ", F.col("vec_id") % 50).alias("artist_name"),
        _text("G", F.col("label")).alias("genre"),
        (F.col("vec_id") % 101).cast("int").alias("popularity"),
        *features,
        (130 + 70 * dim(7)).alias("tempo"),
        (-20 + 20 * dim(8)).alias("loudness"),
        *[dim(i + 1).alias(name) for i, name in enumerate(EMBEDDED_FEATURES)],
    )


def customer_users(spark: SparkSession, base: str) -> DataFrame:
    nation = F.col("c_nationkey")
    return table(spark, base, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        (13 + F.col("c_custkey") % 58).cast("int").alias("age"),
        _text("C", nation).alias("country"),
        F.col("c_mktsegment").alias("subscription_type"),
        F.concat_ws("|", _text("G", nation % 10), _text("G", (nation + 3) % 10)).alias(
            "preferred_genres"
        ),
    )


def line_plays(spark: SparkSession, base: str, users: bool = True) -> DataFrame:
    """Plays from ``lineitem``; the order gives the listener.

    Every line has its order, so a measure that needs no listener passes
    ``users=False`` and skips that join.
    """
    lines = table(spark, base, "lineitem")
    plays = [
        F.col("l_partkey").alias("track_id"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_quantity") * 10000).cast("bigint").alias("play_duration_ms"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("skipped"),
    ]
    if not users:
        return lines.select(*plays)
    orders = table(spark, base, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id")
    )
    return lines.join(orders, "l_orderkey").select("user_id", *plays)


def part_tracks(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "part").select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_type").alias("genre"),
        F.col("p_size").alias("popularity"),
        F.col("p_retailprice").alias("price"),
    )
