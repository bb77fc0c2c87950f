"""Dense integer ids for string keys, without labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.operators.joins import lookup_join
from cadenza.session import stored


def dense_ids(df: DataFrame, key: str, index: str) -> DataFrame:
    """(``key``, ``index``) with ids 0, 1, … by falling row count, then key.

    The keys are range-sorted once and numbered inside their sort partition;
    only the partition sizes, one row each, are summed in order.
    """
    spark = df.sparkSession
    ordered = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), key)
        .select(key, F.monotonically_increasing_id().alias("m"))
    )
    numbered = stored(ordered).select(
        key,
        F.shiftright("m", 33).alias("part"),
        F.col("m").bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("size")).orderBy("part").collect()
    starts, total = [], 0
    for row in sizes:
        starts.append((row["part"], total))
        total += row["size"]
    if total > (1 << 31) - 1:
        raise ValueError(f"{total} values of {key} do not fit 32-bit ids")
    offsets = F.broadcast(spark.createDataFrame(starts, "part bigint, start bigint"))
    return numbered.join(offsets, "part").select(key, (F.col("start") + F.col("place")).cast("int").alias(index))


def encode(ratings: DataFrame, user_ids: DataFrame, track_ids: DataFrame) -> DataFrame:
    """Add user_idx and track_idx to rating pairs."""
    with_user = lookup_join(ratings, user_ids, "user_id", ["track_id"])
    return lookup_join(with_user, track_ids, "track_id", ["user_id"])


def hash_split(ratings: DataFrame, train_tenths: int = 8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test parts by a hash of the id pair; the same on every run and partitioning."""
    tenth = split_tenth(seed)
    return ratings.where(tenth < train_tenths), ratings.where(tenth >= train_tenths)


def stirred(x):
    """31 mixed bits of a whole number below 2^32 by multiply, fold and add; any engine can compute it."""
    # Two different odd factors below 2^31; the fold brings the high bits down.
    x = (x * 1103515245 + 12345) % (1 << 31)
    x = x.bitwiseXOR(F.shiftright(x, 15))
    x = (x * 1597334677) % (1 << 31)
    return x.bitwiseXOR(F.shiftright(x, 13))


def split_tenth(seed: int = 42):
    """0 to 9 by the mixed bits of both ids."""
    user, track = (F.col(c).cast("bigint") for c in ("user_idx", "track_idx"))
    mark = stirred((stirred(user + F.lit(seed).cast("bigint")) + track) % (1 << 31))
    return (mark % 10).cast("int")
