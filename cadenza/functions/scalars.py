"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names, 0 is Monday.
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
SHORT_DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def month_key(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column | str) -> Column:
    """0 is Monday, 6 is Sunday."""
    return F.weekday(ts)


def day_name(day: Column | str, names: Sequence[str] = DAY_NAMES) -> Column:
    """Name of a weekday number; ``Unknown`` outside 0..6 and for nulls."""
    d = F.col(day) if isinstance(day, str) else day
    inside = d.between(0, len(names) - 1)
    return F.when(inside, F.element_at(F.array(*map(F.lit, names)), (d + 1).cast("int"))).otherwise("Unknown")


def ratio(part: Column, whole: Column) -> Column:
    """Double division; null where the divisor is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(ratio(F.lit(100.0) * part, whole), digits)


def milliseconds_to_seconds(ms: Column) -> Column:
    return ms / 1000.0


def milliseconds_to_hours(ms: Column) -> Column:
    return ms / 3600000.0


def track_label(name: Column | str = "name", artist: Column | str = "artist_name") -> Column:
    return F.concat_ws(" — ", name, artist)


def split_list(text: Column | str, delimiter: str = "|") -> Column:
    """Delimited text to an array without empty parts."""
    return F.array_remove(F.split(text, "\\Q" + delimiter + "\\E"), "")


def int_or_null(text: Column) -> Column:
    return F.trim(text).try_cast("int")


def fixed_range(value: Column, low: float, high: float) -> Column:
    """Scale a known range [low, high] to [0, 1]."""
    return (value - low) / (high - low)


def tempo_norm(tempo: Column | str = "tempo") -> Column:
    return fixed_range(F.col(tempo) if isinstance(tempo, str) else tempo, 60.0, 200.0)


def loudness_norm(loudness: Column | str = "loudness") -> Column:
    return fixed_range(F.col(loudness) if isinstance(loudness, str) else loudness, -40.0, 0.0)


def dot(a: Sequence[Column], b: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for x, y in zip(a, b, strict=True):
        total = total + x * y
    return total


def l2_norm(a: Sequence[Column]) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Cosine similarity; null where a vector has no length."""
    return dot(a, b) / F.nullif(l2_norm(a) * l2_norm(b), F.lit(0.0))


def is_completed() -> Column:
    return F.col("skipped") == 0


def play_weight(completed: float = 2, skipped: float = 1) -> Column:
    return F.when(is_completed(), F.lit(completed)).otherwise(F.lit(skipped))


def count_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint")
