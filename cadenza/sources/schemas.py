"""Column names, order and types of the three input tables."""

from pyspark.sql import types as T

# The 0-1 audio features, and all features with tempo and loudness.
AUDIO_FEATURES = [
    "energy", "danceability", "acousticness", "valence", "instrumentalness", "speechiness",
]
TRACK_FEATURES = AUDIO_FEATURES + ["tempo", "loudness"]
# All dimensions of a track's embedding, as features.
EMBEDDED_FEATURES = [f"dim_{i}" for i in range(1, 65)]

TRACKS = T.StructType([
    T.StructField("track_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("artist_id", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("genre", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("popularity", T.IntegerType()),
    T.StructField("release_year", T.IntegerType()),
    T.StructField("tempo", T.DoubleType()),
    T.StructField("energy", T.DoubleType()),
    T.StructField("danceability", T.DoubleType()),
    T.StructField("acousticness", T.DoubleType()),
    T.StructField("valence", T.DoubleType()),
    T.StructField("instrumentalness", T.DoubleType()),
    T.StructField("loudness", T.DoubleType()),
    T.StructField("speechiness", T.DoubleType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("subscription_type", T.StringType()),
    T.StructField("preferred_genres", T.StringType()),
    T.StructField("account_created_year", T.IntegerType()),
])

PLAYS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("track_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("play_duration_ms", T.LongType()),
    T.StructField("skipped", T.IntegerType()),
    T.StructField("hour_of_day", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
])

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
