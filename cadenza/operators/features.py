"""Track feature scaling and user taste profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators.joins import lookup_join
from cadenza.sources.schemas import AUDIO_FEATURES

CONTENT_FEATURES = AUDIO_FEATURES + ["tempo_norm", "loudness_norm"]


def with_fixed_ranges(tracks: DataFrame) -> DataFrame:
    """Tempo and loudness scaled from their known ranges."""
    return tracks.withColumns({"tempo_norm": S.tempo_norm(), "loudness_norm": S.loudness_norm()})


def drop_incomplete(tracks: DataFrame, features: Sequence[str]) -> DataFrame:
    return tracks.na.drop(subset=list(features))


def minmax_scaled(tracks: DataFrame, features: Sequence[str], prefix: str = "") -> DataFrame:
    """Each feature to [0, 1]; a constant feature becomes 0.5.

    The limits are one row, found by one aggregate over the feature columns.
    """
    limits = tracks.agg(
        *[F.min(f).alias(f"min_{f}") for f in features], *[F.max(f).alias(f"max_{f}") for f in features]
    ).first()

    def scaled(f: str):
        low, high = limits[f"min_{f}"], limits[f"max_{f}"]
        if low is None or high == low:
            return F.when(F.col(f).isNotNull(), F.lit(0.5))
        return (F.col(f) - F.lit(low)) / (F.lit(high) - F.lit(low))

    return tracks.withColumns({prefix + f: scaled(f) for f in features})


def standardised(tracks: DataFrame, features: Sequence[str], prefix: str = "") -> DataFrame:
    """Zero mean and unit sample deviation; a constant feature becomes 0."""
    moments = tracks.agg(
        *[F.avg(f).alias(f"mean_{f}") for f in features], *[F.stddev_samp(f).alias(f"std_{f}") for f in features]
    ).first()

    def scaled(f: str):
        mean, std = moments[f"mean_{f}"], moments[f"std_{f}"]
        if not std:
            return F.when(F.col(f).isNotNull(), F.lit(0.0))
        return (F.col(f) - F.lit(mean)) / F.lit(std)

    return tracks.withColumns({prefix + f: scaled(f) for f in features})


def content_features(tracks: DataFrame, features: Sequence[str] = CONTENT_FEATURES) -> DataFrame:
    """(track_id, features…) for tracks with all features, min-max scaled."""
    usable = drop_incomplete(with_fixed_ranges(tracks), features).select("track_id", *features)
    return minmax_scaled(usable, features)


def taste_profiles(ratings: DataFrame, vectors: DataFrame, features: Sequence[str]) -> DataFrame:
    """Weighted mean of the features of a user's tracks, one column per feature.

    ``ratings`` has (user_id, track_id, implicit_rating), the summed play
    weights; tracks without a vector do not count.  Each task sums a user's
    tracks before the shuffle.
    """
    weight = F.col("implicit_rating").cast("double")
    sums = (
        lookup_join(ratings.select("user_id", "track_id", weight.alias("w")), vectors, "track_id", ["user_id"])
        .groupBy("user_id")
        .agg(F.sum("w").alias("w"), *[F.sum(F.col("w") * F.col(f)).alias(f) for f in features])
    )
    return sums.select("user_id", *[(F.col(f) / F.col("w")).alias(f) for f in features])


def unit_vectors(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """(``key``, vector): the features divided by their length; rows without length are dropped."""
    length = S.l2_norm([F.col(f) for f in features])
    return (
        df.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_features"), length.alias("_length"))
        .where("_length > 0")
        .select(key, F.transform("_features", lambda x: x / F.col("_length")).alias("vector"))
    )
