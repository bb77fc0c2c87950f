"""Content-based recommendations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.features import CONTENT_FEATURES, content_features, taste_profiles, unit_vectors
from cadenza.operators.joins import lookup_join
from cadenza.operators.plays import implicit_ratings
from cadenza.operators.topk import top_k_dot
from cadenza.session import stored


def with_metadata(recs: DataFrame, tracks: DataFrame, columns: Sequence[str] = ("name", "artist_name", "genre")) -> DataFrame:
    """Add track metadata; a track recommended to very many users does not skew.

    The lists are stored, as the join asks a sketch of them first and would make them twice.
    """
    return lookup_join(stored(recs), tracks.select("track_id", *columns), "track_id", ["user_id"])


def content_recommendations(
    plays: DataFrame,
    tracks: DataFrame,
    k: int = 10,
    features: Sequence[str] = CONTENT_FEATURES,
    users: DataFrame | None = None,
    digits: int = 6,
) -> DataFrame:
    """The ``k`` unheard tracks closest by cosine to each user's taste profile.

    ``users`` (user_id) limits who gets recommendations.  The plays are read
    once: profiles and heard tracks both come from the stored ratings.
    """
    if users is not None:
        plays = plays.join(users.select("user_id").distinct(), "user_id", "left_semi")
    ratings = stored(implicit_ratings(plays))
    vectors = content_features(tracks, features)
    profiles = unit_vectors(taste_profiles(ratings, vectors, features), "user_id", features)
    items = unit_vectors(vectors, "track_id", features)
    best = top_k_dot(profiles.withColumn("probe", F.lit(0)), items, k, seen=ratings)
    return with_metadata(best, tracks).select(
        "user_id", "rank", "track_id", "name", "artist_name", "genre",
        F.round("score", digits).alias("similarity_score"),
    )
