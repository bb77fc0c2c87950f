"""CSV and Parquet readers with fixed schemas and a quarantine for bad rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.sources.schemas import PLAYS, TIMESTAMP_FORMAT, TRACKS, USERS

CORRUPT = "_corrupt_record"
_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
# Plays are read as text and cast here, so a row is bad for every query or for none,
# whichever columns a query keeps.
_PLAY_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in [*PLAYS.fields, T.StructField(CORRUPT, T.StringType())]])


@dataclass(frozen=True)
class Ingested:
    """Rows fit for use, and the others with the reason in ``problem``."""

    valid: DataFrame
    rejected: DataFrame


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with header; a missing path is an error."""
    return spark.read.options(header=True, timestampFormat=TIMESTAMP_FORMAT).schema(schema).csv(path)


def read_tracks(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, TRACKS)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, USERS)


def _typed(field: T.StructField) -> Column:
    text = F.nullif(F.trim(field.name), F.lit(""))
    if isinstance(field.dataType, T.TimestampType):
        return F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
    return text.try_cast(field.dataType)


def _checked(raw: DataFrame) -> Ingested:
    values = {f.name: _typed(f) for f in PLAYS.fields}
    unread = reduce(
        lambda a, b: a | b, [(F.trim(c) != "") & v.isNull() for c, v in values.items()], F.col(CORRUPT).isNotNull()
    )
    flag = values["skipped"]
    problem = (
        F.when(unread, "malformed line")
        .when(values["user_id"].isNull() | values["track_id"].isNull(), "missing key")
        .when(flag.isNull() | ~flag.isin(0, 1), "bad skip flag")
    )
    marked = raw.withColumn("problem", problem)
    valid = marked.where("problem is null").select(*[v.alias(c) for c, v in values.items()])
    return Ingested(valid.withColumnRenamed("timestamp", "ts"), marked.where("problem is not null"))


def read_plays(spark: SparkSession, path: str) -> Ingested:
    """Plays from CSV files with header; quoted fields may hold commas."""
    return _checked(spark.read.options(header=True, **_OPTIONS).schema(_PLAY_TEXT).csv(path))


def parse_play_lines(lines: DataFrame, column: str = "value") -> Ingested:
    """Plays from text lines; blank lines and header lines are dropped."""
    text = F.trim(F.col(column))
    kept = lines.where((text != "") & ~text.startswith("user_id"))
    parsed = F.from_csv(text, ", ".join(f"{f.name} string" for f in _PLAY_TEXT.fields), _OPTIONS)
    # Unfolding a one-entry array parses each line once; filters stay above it.
    return _checked(kept.select(F.inline(F.array(parsed))))


def read_play_lines(spark: SparkSession, path: str) -> Ingested:
    return parse_play_lines(spark.read.text(path))


def read_plays_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Plays written by month; a filter on ``year_month`` reads only its folders."""
    return spark.read.parquet(path)


def register_views(plays: DataFrame, tracks: DataFrame, users: DataFrame) -> None:
    """The three tables as SQL views ``history``, ``tracks`` and ``users``."""
    plays.withColumnRenamed("ts", "timestamp").createOrReplaceTempView("history")
    tracks.createOrReplaceTempView("tracks")
    users.createOrReplaceTempView("users")
