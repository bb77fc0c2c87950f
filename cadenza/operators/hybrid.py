"""Blend of popularity or collaborative scores with content similarity, and cold start."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators.content import with_metadata
from cadenza.operators.features import CONTENT_FEATURES, content_features, taste_profiles, unit_vectors
from cadenza.operators.joins import lookup_join
from cadenza.operators.plays import pair_counts, per_pair, play_counts
from cadenza.operators.topk import top_k_dot
from cadenza.session import stored

EPSILON = 1e-9
META = ["name", "artist_name", "genre", "popularity"]


def hybrid_recommendations(
    plays: DataFrame,
    tracks: DataFrame,
    k: int = 10,
    cf_weight: float = 0.4,
    content_weight: float = 0.6,
    features: Sequence[str] = CONTENT_FEATURES,
    factors: tuple[DataFrame, DataFrame] | None = None,
    digits: int = 6,
) -> DataFrame:
    """Best ``k`` unheard tracks by two signals, each scaled to [0, 1] per user.

    The first signal is the completed plays of a track, 0 where there are none.
    With ``factors`` (user_id, vector) and (track_id, vector) it is the inner
    product of the two vectors instead, 0 for a track or user without one.
    The second is the cosine of taste profile and track.

    Each signal's smallest and largest value over a user's unheard tracks is a
    best-of-one query; the blend is one more query over both signals' vectors.
    """
    ratings = stored(pair_counts(plays))
    vectors = content_features(tracks, features)
    profiles = unit_vectors(taste_profiles(ratings, vectors, features), "user_id", features)
    items = unit_vectors(vectors, "track_id", features)
    if factors is None:
        counts = stored(ratings.groupBy("track_id").agg(F.sum("completed").alias("play_count")))
        most = counts.agg(F.max("play_count")).first()[0] or 1
        signal = counts.select("track_id", F.array(F.col("play_count") / F.lit(float(most))).alias("signal"))
        users, width = profiles.withColumn("signal", F.array(F.lit(float(most)))), 1
    else:
        user_factors, track_factors = factors
        signal = track_factors.select("track_id", F.col("vector").alias("signal"))
        users = profiles.join(user_factors.select("user_id", F.col("vector").alias("signal")), "user_id", "left")
        width = signal.select(F.coalesce(F.max(F.size("signal")), F.lit(1))).first()[0]
    signal_or_none = F.coalesce("signal", F.array_repeat(F.lit(0.0), width))
    one = F.array(F.lit(1.0))
    items = lookup_join(items, signal, "track_id", ["track_id"], how="left").select(
        "track_id", F.concat("vector", signal_or_none, one).alias("vector")
    )
    parts = [len(features), width, 1]
    users = stored(users.select("user_id", F.col("vector").alias("content"), signal_or_none.alias("signal")))

    def blended(content, other, constant):
        """One vector over both signals and the constant."""
        return F.concat(
            F.transform("content", lambda x: x * content), F.transform("signal", lambda x: x * other), F.array(constant)
        )

    def probe(number: int, content: float, other: float):
        return F.struct(F.lit(number).alias("probe"), blended(F.lit(content), F.lit(other), F.lit(0.0)).alias("vector"))

    ends = F.array(probe(0, 1.0, 0.0), probe(1, -1.0, 0.0), probe(2, 0.0, 1.0), probe(3, 0.0, -1.0))
    end_queries = users.select("user_id", F.explode(ends).alias("q")).select("user_id", "q.*")
    extremes = top_k_dot(end_queries, items, 1, seen=ratings, digits=None, widths=parts, tied=False)
    value = lambda number: F.max(F.when(F.col("probe") == number, F.col("score")))
    scale = extremes.groupBy("user_id").agg(
        value(0).alias("high"), (-value(1)).alias("low"), value(2).alias("cf_high"), (-value(3)).alias("cf_low")
    )

    def factor(weight: float, high: str, low: str):
        width = F.col(high) - F.col(low)
        return F.when(width > 1e-15, F.lit(weight) / (width + F.lit(EPSILON))).otherwise(0.0)

    scale = scale.select(
        "user_id", "low", "cf_low",
        factor(content_weight, "high", "low").alias("a"), factor(cf_weight, "cf_high", "cf_low").alias("b"),
    )
    constant = -F.col("a") * F.col("low") - F.col("b") * F.col("cf_low")
    blend = users.join(scale, "user_id").select(
        "user_id", F.lit(0).alias("probe"), blended(F.col("a"), F.col("b"), constant).alias("vector")
    )
    best = top_k_dot(blend, items, k, seen=ratings, widths=parts)
    return with_metadata(best, tracks, META).select(
        "user_id", "rank", "track_id", *META, F.round("score", digits).alias("hybrid_score")
    )


def cold_users(users: DataFrame, plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Users without a play of a known track, who have no taste profile."""
    ids = tracks.select("track_id")
    known = lookup_join(per_pair(plays, ids), ids, "track_id", ["user_id"])
    return users.join(known.select("user_id").distinct(), "user_id", "left_anti")


def _popular(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    meta = tracks.select("track_id", *META)
    return lookup_join(play_counts(plays), meta, "track_id", ["track_id"])


def cold_start_recommendations(plays: DataFrame, tracks: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most completed tracks for every user without a taste profile.

    Such users have heard no known track, so all get the same list; it is a
    single value of ``k`` entries that each user row unfolds.
    """
    top = _popular(plays, tracks).orderBy(F.desc("play_count"), "track_id").limit(k)
    entry = F.struct((-F.col("play_count")).alias("o"), "track_id", *META, "play_count")
    listed = top.agg(F.sort_array(F.collect_list(entry)).alias("l")).scalar()
    return (
        cold_users(users, plays, tracks)
        .select("user_id", F.posexplode(listed).alias("place", "t"))
        .select("user_id", (F.col("place") + 1).alias("rank"), "t.track_id", *[f"t.{m}" for m in META], "t.play_count")
    )


def seed_genre_recommendations(plays: DataFrame, tracks: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most completed tracks in a new user's preferred genres.

    Only the best ``k`` tracks of a genre can be in a user's list, so a user
    meets ``k`` rows per preferred genre.
    """
    order = W.partitionBy("genre").orderBy(F.desc("play_count"), "track_id")
    best = (
        _popular(plays, tracks)
        .where("genre is not null")
        .withColumn("genre_place", F.row_number().over(order))
        .where(F.col("genre_place") <= k)
    )
    listed = best.groupBy("genre").agg(
        F.collect_list(F.struct("track_id", "name", "artist_name", "popularity", "play_count")).alias("tracks")
    )
    wanted = cold_users(users, plays, tracks).select(
        "user_id", F.explode(F.array_distinct(S.split_list("preferred_genres"))).alias("genre")
    )
    mine = W.partitionBy("user_id").orderBy(F.desc("play_count"), "track_id")
    return (
        lookup_join(wanted, listed, "genre", ["user_id"])
        .select("user_id", "genre", F.inline("tracks"))
        .withColumn("rank", F.row_number().over(mine))
        .where(F.col("rank") <= k)
        .select("user_id", "rank", "track_id", *META, "play_count")
    )


def recommendations_for_all(plays: DataFrame, tracks: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """Hybrid lists for users with a taste profile, the popular list for the rest."""
    warm = hybrid_recommendations(plays, tracks, k).select(
        "user_id", "rank", "track_id", F.lit("hybrid").alias("source")
    )
    cold = cold_start_recommendations(plays, tracks, users, k).select(
        "user_id", "rank", "track_id", F.lit("popularity").alias("source")
    )
    return warm.unionByName(cold)
