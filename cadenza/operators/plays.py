"""Measures over the plays table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators.joins import fits_broadcast, lookup_join

# A sketch of 2^14 slots errs by less than 2 % (three standard errors of 0.65 %).
SKETCH_PRECISION, SKETCH_ERROR = 14, 0.02


def completed(plays: DataFrame) -> DataFrame:
    return plays.where(S.is_completed())


def with_weight(plays: DataFrame, completed: float = 2, skipped: float = 1) -> DataFrame:
    return plays.withColumn("weight", S.play_weight(completed, skipped))


def with_outcome(plays: DataFrame) -> DataFrame:
    """Mark each play ``C`` (completed) or ``S`` (skipped)."""
    return plays.withColumn("outcome", F.when(S.is_completed(), "C").otherwise("S"))


def weighted_union(plays: DataFrame, completed_weight: int = 2, skipped_weight: int = 1) -> DataFrame:
    """Completed plays and skipped plays, each with its weight, one after the other."""
    done = completed(plays).withColumn("weight", F.lit(completed_weight))
    left = plays.where("skipped = 1").withColumn("weight", F.lit(skipped_weight))
    return done.unionByName(left)


def play_counts(plays: DataFrame) -> DataFrame:
    """Completed plays per track."""
    return completed(plays).groupBy("track_id").agg(F.count(F.lit(1)).alias("play_count"))


def play_counts_with_tracks(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Completed plays per known track with its metadata, most played first."""
    meta = tracks.select("track_id", "name", "artist_name", "genre", "popularity")
    return (
        lookup_join(play_counts(plays), meta, "track_id", ["track_id"])
        .select("track_id", "play_count", "name", "artist_name", "genre", "popularity")
        .orderBy(F.desc("play_count"), "track_id")
    )


def track_engagement(plays: DataFrame, completed_weight: int = 2, skipped_weight: int = 1) -> DataFrame:
    """Completed and skipped plays per track and their weighted score."""
    counts = plays.groupBy("track_id").agg(
        S.count_where(S.is_completed()).alias("completed"),
        S.count_where(~S.is_completed()).alias("skipped"),
    )
    score = F.col("completed") * completed_weight + F.col("skipped") * skipped_weight
    return counts.withColumn("score", score.cast("bigint"))


def engagement_with_tracks(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Engagement of known tracks with metadata, highest score first."""
    meta = tracks.select("track_id", "name", "artist_name", "genre", "popularity")
    return (
        lookup_join(track_engagement(plays), meta, "track_id", ["track_id"])
        .orderBy(F.desc("score"), "track_id")
    )


def per_pair(plays: DataFrame, dim: DataFrame) -> DataFrame:
    """Plays as (user_id, track_id, plays) for a join with ``dim``.

    With a broadcast dimension the join is free and each play counts 1.  With a
    shuffled one the plays are first summed per pair, so the shuffle carries
    pairs and not plays.
    """
    if fits_broadcast(dim):
        return plays.select("user_id", "track_id", F.lit(1).cast("bigint").alias("plays"))
    return plays.groupBy("user_id", "track_id").agg(F.count(F.lit(1)).alias("plays"))


def genre_counts(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Completed plays per user and genre.

    Plays of unknown tracks and of tracks without a genre are left out.
    """
    genres = tracks.where("genre <> ''").select("track_id", "genre")
    return (
        lookup_join(per_pair(completed(plays), genres), genres, "track_id", ["user_id"], keys=plays)
        .groupBy("user_id", "genre")
        .agg(F.sum("plays").alias("plays"))
    )


def genre_affinity(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Completed plays per user and genre, ranked within the user."""
    order = W.partitionBy("user_id").orderBy(F.desc("plays"), "genre")
    return genre_counts(plays, tracks).withColumn("genre_rank", F.row_number().over(order))


def hourly_activity(plays: DataFrame) -> DataFrame:
    """All plays per hour of day and weekday."""
    return (
        plays.groupBy("hour_of_day", "day_of_week")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .withColumn("day_name", S.day_name("day_of_week"))
    )


def top_tracks(plays: DataFrame, tracks: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` tracks with most completed plays, with their completion rate.

    Plays are summed per track before the metadata join.
    """
    counts = plays.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("total_plays"),
        S.count_where(F.col("skipped") == 0).alias("completed_plays"),
        S.count_where(F.col("skipped") == 1).alias("skipped_plays"),
    )
    meta = tracks.select(
        "track_id", F.col("name").alias("track_name"), "artist_name", "genre", "popularity"
    )
    rate = S.percent(F.col("completed_plays"), F.col("total_plays"), 1)
    return (
        lookup_join(counts, meta, "track_id", ["track_id"])
        .select(
            "track_id", "track_name", "artist_name", "genre", "popularity",
            "total_plays", "completed_plays", "skipped_plays",
            rate.alias("completion_rate_pct"),
        )
        .orderBy(F.desc("completed_plays"), "track_id")
        .limit(n)
    )


def monthly_trend(plays: DataFrame) -> DataFrame:
    return (
        plays.groupBy(S.month_key("ts").alias("year_month"))
        .agg(
            F.count(F.lit(1)).alias("total_plays"),
            F.countDistinct("user_id").alias("active_users"),
            F.round(S.milliseconds_to_hours(F.sum("play_duration_ms")), 1).alias("total_listen_hours"),
            F.round(S.ratio(F.sum("skipped"), F.count(F.lit(1))), 6).alias("skip_rate"),
        )
        .orderBy("year_month")
    )


def implicit_ratings(plays: DataFrame) -> DataFrame:
    """Summed play weights per (user, track)."""
    return plays.groupBy("user_id", "track_id").agg(
        F.sum(S.play_weight()).cast("bigint").alias("implicit_rating")
    )


def pair_counts(plays: DataFrame) -> DataFrame:
    """Completed plays and summed play weight per (user, track): all that recommendations need of the plays."""
    return plays.groupBy("user_id", "track_id").agg(
        S.count_where(S.is_completed()).alias("completed"),
        F.sum(S.play_weight()).cast("bigint").alias("implicit_rating"),
    )


def heard_pairs(plays: DataFrame) -> DataFrame:
    """Every (user, track) pair with a play, skipped ones included."""
    return plays.select("user_id", "track_id").distinct()


def known_track_coverage(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Plays and listeners per genre with plays of unknown tracks kept under null."""
    genres = tracks.select("track_id", "genre")
    pairs = lookup_join(per_pair(plays, genres), genres, "track_id", ["user_id"], how="left", keys=plays)
    per_user = pairs.groupBy("genre", "user_id").agg(F.sum("plays").alias("plays"))
    return per_user.groupBy("genre").agg(
        F.sum("plays").alias("total_plays"), F.count(F.lit(1)).alias("listeners")
    )


def most_active(plays: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` values of ``key`` with most plays; at most ``n`` rows."""
    return (
        plays.groupBy(key)
        .agg(F.count(F.lit(1)).alias("plays"))
        .orderBy(F.desc("plays"), key)
        .limit(n)
    )


def restricted_to(plays: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Keep plays whose ``key`` is in ``keys``, a top-n list."""
    return plays.join(F.broadcast(keys.select(key)), key, "left_semi")


def listener_sketches(plays: DataFrame, precision: int = SKETCH_PRECISION) -> DataFrame:
    """(year_month, listeners, sketch): the exact count of a month's listeners and a sketch that merges.

    Exact counts do not add up over months; the sketches, of ``2 ** precision`` slots each, do.
    """
    return plays.groupBy(S.month_key("ts").alias("year_month")).agg(
        F.countDistinct("user_id").alias("listeners"), F.hll_sketch_agg("user_id", precision).alias("sketch")
    )


def listeners_by_year(sketches: DataFrame) -> DataFrame:
    """(year, estimate) from stored ``listener_sketches``: plays are not read."""
    merged = sketches.groupBy(F.substring("year_month", 1, 4).alias("year")).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("year", F.hll_sketch_estimate("sketch").alias("estimate"))


def plays_of_user(plays: DataFrame, user_id) -> DataFrame:
    return plays.where(F.col("user_id") == F.lit(user_id))


def sample_users(plays: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """``n`` users drawn by a seeded digest; the same draw on any partitioning and in any engine."""
    users = plays.select("user_id").distinct()
    return users.orderBy(F.md5(F.concat_ws(":", F.lit(seed), "user_id").cast("binary")), "user_id").limit(n)
