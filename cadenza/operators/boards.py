"""Genre, artist and subscription measures.

Plays are read once, into stored sums per (user, track).  Listener counts come from distinct
(group, user) pairs of these and all other counts from their sums per track, so no step needs
several distinct counts over the raw plays and no reducer sees the plays of one hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators.joins import lookup_join, null_safe_join
from cadenza.operators.plays import completed
from cadenza.session import stored


def _pair_sums(plays: DataFrame) -> DataFrame:
    """(user_id, track_id, n, done): all plays and completed ones, from one scan."""
    return stored(plays.groupBy("user_id", "track_id").agg(
        F.count(F.lit(1)).alias("n"), S.count_where(S.is_completed()).alias("done")
    ))


def _track_totals(sums: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    by_track = sums.groupBy("track_id").agg(F.sum("n").alias("n"), F.sum("done").alias("done"))
    return (
        lookup_join(by_track, dim, "track_id", ["track_id"])
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("total_plays"),
            F.sum("done").alias("done"),
            F.count(F.lit(1)).alias("track_count"),
        )
    )


def _listeners(pairs: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (
        lookup_join(pairs.select("user_id", "track_id"), dim, "track_id", ["user_id"])
        .select(*keys, "user_id")
        .distinct()
        .groupBy(*keys)
        .agg(F.count("user_id").alias("unique_listeners"))
    )


def genre_popularity(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Plays, listeners, tracks, completion and share of all plays per genre."""
    dim = tracks.select("track_id", "genre")
    pairs = _pair_sums(plays)
    totals = _track_totals(pairs, dim, ["genre"])
    listeners = _listeners(pairs, dim, ["genre"])
    all_plays = pairs.agg(F.sum("n")).scalar()
    return (
        null_safe_join(totals, listeners, ["genre"])
        .select(
            "genre",
            "total_plays",
            "unique_listeners",
            F.col("track_count").alias("unique_tracks"),
            S.percent(F.col("done"), F.col("total_plays"), 1).alias("avg_completion_pct"),
            F.round(S.ratio(F.col("total_plays"), all_plays) * 100, 2).alias("play_share_pct"),
        )
        .orderBy(F.desc("total_plays"), "genre")
    )


def genre_skips(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Skip rate per genre; the share is of plays of known tracks."""
    dim = tracks.select("track_id", "genre")
    pairs = _pair_sums(plays)
    totals = _track_totals(pairs, dim, ["genre"])
    listeners = _listeners(pairs, dim, ["genre"])
    known = totals.agg(F.sum("total_plays")).scalar()
    skipped = F.col("total_plays") - F.col("done")
    return (
        null_safe_join(totals, listeners, ["genre"])
        .select(
            "genre",
            "total_plays",
            "unique_listeners",
            S.percent(skipped, F.col("total_plays"), 1).alias("skip_pct"),
            F.round(S.ratio(F.col("total_plays"), known) * 100, 1).alias("play_share"),
        )
        .orderBy(F.desc("total_plays"), "genre")
    )


def artist_leaderboard(plays: DataFrame, tracks: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` artists with most completed plays.

    The board is stored, ``n`` rows; listeners are then counted for the tracks of
    those ``n`` artists only.
    """
    keys = ["artist_id", "artist_name", "genre"]
    pairs = _pair_sums(completed(plays))
    dim = tracks.select("track_id", *keys)
    board = stored(
        _track_totals(pairs, dim, keys)
        .orderBy(F.desc("total_plays"), *keys)
        .limit(n)
    )
    on_board = null_safe_join(dim, F.broadcast(board), keys, "left_semi")
    listeners = _listeners(pairs, on_board, keys)
    return (
        null_safe_join(listeners, F.broadcast(board), keys)
        .select(*keys, "total_plays", "unique_listeners", "track_count")
        .orderBy(F.desc("total_plays"), *keys)
    )


def artist_names(plays: DataFrame, tracks: DataFrame, n: int = 15) -> DataFrame:
    """The ``n`` artist names with most completed plays; equal names count together."""
    dim = tracks.select("track_id", "artist_name")
    sums = completed(plays).groupBy("track_id").agg(F.count(F.lit(1)).alias("n")).withColumn("done", F.col("n"))
    return (
        _track_totals(sums, dim, ["artist_name"])
        .select("artist_name", F.col("total_plays").alias("plays"))
        .orderBy(F.desc("plays"), "artist_name")
        .limit(n)
    )


def _cohort_sums(plays: DataFrame, users: DataFrame) -> DataFrame:
    per_user = plays.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        S.count_where(F.col("skipped") == 1).alias("skips"),
        F.sum("play_duration_ms").alias("ms"),
        F.count("play_duration_ms").alias("timed"),
    )
    return (
        per_user.join(users.select("user_id", "subscription_type"), "user_id")
        .groupBy("subscription_type")
        .agg(
            F.sum("n").alias("total_plays"),
            F.count(F.lit(1)).alias("users"),
            F.sum("skips").alias("skips"),
            F.sum("ms").alias("ms"),
            F.sum("timed").alias("timed"),
        )
    )


def cohort_subscription(plays: DataFrame, users: DataFrame) -> DataFrame:
    """Listening behaviour per subscription type; ``users`` are the listeners."""
    total = F.col("total_plays")
    return _cohort_sums(plays, users).select(
        "subscription_type",
        "total_plays",
        "users",
        F.round(S.ratio(total, F.col("users")), 1).alias("avg_plays_per_user"),
        F.round(S.milliseconds_to_seconds(S.ratio(F.col("ms"), F.col("timed"))), 1).alias(
            "avg_listen_duration_sec"
        ),
        S.percent(F.col("skips"), total, 1).alias("skip_rate_pct"),
    )


def cohort_gap(
    plays: DataFrame, users: DataFrame, first: str = "premium", second: str = "free"
) -> DataFrame:
    """Plays per listener of two subscription types and the gap of their skip rates."""
    cohort = cohort_subscription(plays, users)

    def of(kind: str, column: str) -> Column:
        return F.max(F.when(F.col("subscription_type") == kind, F.col(column)))

    return cohort.agg(
        of(first, "avg_plays_per_user").alias("first_plays_per_user"),
        of(second, "avg_plays_per_user").alias("second_plays_per_user"),
        F.round(F.abs(of(first, "skip_rate_pct") - of(second, "skip_rate_pct")), 1).alias("skip_gap_pct"),
    )
