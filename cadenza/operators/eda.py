"""Summary tables: key figures, frequencies, histograms, correlations, pivots."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.functions import scalars as S
from cadenza.operators.joins import lookup_join
from cadenza.operators.plays import completed, genre_counts, restricted_to, track_engagement
from cadenza.session import stored


def kpis(plays: DataFrame, tracks: DataFrame, users: DataFrame, premium: str = "premium") -> DataFrame:
    """One row of headline figures; the plays are read once, for their sums per user, per track and per hour."""
    keys = ["user_id", "track_id", "hour_of_day"]
    sums = stored(plays.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("others"),
        F.count(F.lit(1)).alias("n"),
        F.sum("skipped").alias("skips"),
        F.sum("play_duration_ms").alias("ms"),
        F.count("play_duration_ms").alias("timed"),
    ))
    # The id has a bit for each key that a row is not grouped by.
    by_user, by_track, by_hour = (sums.where(F.col("others") == others) for others in (0b011, 0b101, 0b110))
    by_genre = (
        lookup_join(by_track.select("track_id", "n"), tracks.select("track_id", "genre"), "track_id", ["track_id"])
        .groupBy("genre")
        .agg(F.sum("n").alias("n"))
    )
    top = by_genre.orderBy(F.desc("n"), "genre").limit(1)
    peak = by_hour.orderBy(F.desc("n"), "hour_of_day").limit(1)
    share = users.agg(S.percent(S.count_where(F.col("subscription_type") == premium), F.count(F.lit(1)), 1))
    return by_user.agg(
        F.sum("n").alias("total_events"),
        F.count("user_id").alias("distinct_users"),
        F.sum("skips").alias("skips"),
        F.sum("ms").alias("ms"),
        F.sum("timed").alias("timed"),
    ).select(
        "total_events",
        "distinct_users",
        by_track.agg(F.count("track_id")).scalar().alias("distinct_tracks"),
        F.round(S.ratio(F.col("skips"), F.col("total_events")), 6).alias("skip_rate"),
        F.round(S.milliseconds_to_seconds(S.ratio(F.col("ms"), F.col("timed"))), 3).alias("avg_listen_sec"),
        peak.select("hour_of_day").scalar().alias("peak_hour"),
        share.scalar().alias("premium_pct"),
        top.select("genre").scalar().alias("top_genre"),
        F.round(
            S.ratio(top.select("n").scalar(), by_genre.agg(F.sum("n")).scalar()) * 100, 1
        ).alias("top_genre_share_pct"),
    )


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; ``n`` keeps the top of the list."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
    )
    return counts if n is None else counts.limit(n)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per equal-width bin, empty bins included, and the mean of the column.

    The last bin includes the maximum; a column of one value gets a range of 1
    around it.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v is not null and not isnan(v)")
    # One row of limits and the mean from one scan; the counts take the other.
    limits = values.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.round(F.avg("v"), 6).alias("mean")).first()
    flat = limits["low"] is not None and limits["low"] == limits["high"]
    low = F.lit(limits["low"] - 0.5 if flat else limits["low"]).cast("double")
    width = F.lit(1.0 if flat or limits["low"] is None else limits["high"] - limits["low"])
    place = F.floor((F.col("v") - low) / width * bins)
    counts = values.groupBy(F.least(place, F.lit(bins - 1)).cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    every_bin = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return every_bin.join(counts, "bin", "left").select(
        "bin",
        F.round(low + F.col("bin") * width / bins, 6).alias("bin_low"),
        F.round(low + (F.col("bin") + 1) * width / bins, 6).alias("bin_high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        F.lit(limits["mean"]).cast("double").alias("mean"),
    )


def correlations(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair of columns, one pass, long form."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.round(F.corr(a, b), digits).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"c{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*cells)))


def popularity_correlation(plays: DataFrame, tracks: DataFrame) -> DataFrame:
    """Pearson correlation of track popularity and engagement score."""
    scores = track_engagement(plays).select("track_id", "score")
    known = lookup_join(scores, tracks.select("track_id", "popularity"), "track_id", ["track_id"])
    return known.agg(
        F.count(F.lit(1)).alias("tracks"),
        F.round(F.corr(F.col("popularity").cast("double"), F.col("score").cast("double")), 6).alias("r"),
    )


def feature_means(tracks: DataFrame, features: Sequence[str], digits: int = 6) -> DataFrame:
    return tracks.agg(*[F.round(F.avg(f), digits).alias(f"avg_{f}") for f in features])


def pivot_hour_day(plays: DataFrame) -> DataFrame:
    """Seven weekday rows by 24 hour columns of play counts, 0 where there are none."""
    hours = list(range(24))
    counts = plays.groupBy("day_of_week").pivot("hour_of_day", hours).agg(F.count(F.lit(1)))
    days = plays.sparkSession.range(7).select(F.col("id").cast("int").alias("day_of_week"))
    return days.join(counts, "day_of_week", "left").select(
        "day_of_week",
        S.day_name("day_of_week", S.SHORT_DAY_NAMES).alias("day_name"),
        *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).cast("bigint").alias(f"h{h:02d}") for h in hours],
    )


def genres_of(tracks: DataFrame) -> list[str]:
    """Genre names for pivot columns; Spark's pivot limit guards their number."""
    limit = int(tracks.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    rows = tracks.where("genre <> ''").select("genre").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} genres: too many for one column each")
    return sorted(r["genre"] for r in rows)


def pivot_user_genre(
    plays: DataFrame, tracks: DataFrame, genres: Sequence[str] | None = None, n: int = 20
) -> DataFrame:
    """Completed plays of the ``n`` most active users, one column per genre."""
    genres = genres_of(tracks) if genres is None else list(genres)
    counts = genre_counts(plays, tracks)
    top = counts.groupBy("user_id").agg(F.sum("plays").alias("n")).orderBy(F.desc("n"), "user_id").limit(n)
    table = restricted_to(counts, top, "user_id").groupBy("user_id").pivot("genre", genres).agg(F.sum("plays"))
    return table.select("user_id", *[F.coalesce(F.col(f"`{g}`"), F.lit(0)).cast("bigint").alias(g) for g in genres])


def _day_hour_counts(plays: DataFrame) -> DataFrame:
    return plays.groupBy("day_of_week", "hour_of_day").agg(F.count(F.lit(1)).alias("event_count"))


def peak_hour_per_day(plays: DataFrame) -> DataFrame:
    """The busiest hour of each weekday; the earliest hour wins a tie."""
    order = W.partitionBy("day_of_week").orderBy(F.desc("event_count"), "hour_of_day")
    return (
        _day_hour_counts(plays)
        .withColumn("place", F.row_number().over(order))
        .where("place = 1")
        .select("day_of_week", S.day_name("day_of_week").alias("day_name"), "hour_of_day", "event_count")
    )


def peak_and_low(plays: DataFrame) -> DataFrame:
    """Busiest hour, quietest hour and most active weekday; the lowest wins a tie."""
    hours = plays.groupBy("hour_of_day").agg(F.count(F.lit(1)).alias("n"))
    days = plays.groupBy("day_of_week").agg(F.count(F.lit(1)).alias("n"))
    hour = F.col("hour_of_day")
    busiest_day = days.agg(F.max_by("day_of_week", F.struct("n", -F.col("day_of_week")))).scalar()
    return hours.agg(
        F.max_by(hour, F.struct("n", -hour)).alias("peak_hour"),
        F.max("n").alias("peak_hour_plays"),
        F.min_by(hour, F.struct(F.col("n"), hour)).alias("low_hour"),
        F.min("n").alias("low_hour_plays"),
    ).select("*", busiest_day.alias("most_active_day"))


def track_labels(plays: DataFrame, tracks: DataFrame, n: int = 20) -> DataFrame:
    """Labels of the ``n`` tracks with most completed plays; one row per track id."""
    counts = completed(plays).groupBy("track_id").agg(F.count(F.lit(1)).alias("play_count"))
    unique = tracks.groupBy("track_id").agg(F.min(F.struct("name", "artist_name")).alias("t"))
    return (
        lookup_join(counts, unique, "track_id", ["track_id"])
        .orderBy(F.desc("play_count"), "track_id")
        .limit(n)
        .select("track_id", S.track_label("t.name", "t.artist_name").alias("label"), "play_count")
    )
