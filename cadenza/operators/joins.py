"""Lookup joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 << 20
# Parquet compresses: a file's bytes can be this many times as many in memory.
INFLATION = 4
SALTS = 32
# Keys the heavy-hitter sketch of a task keeps; its counts err by about a thousandth of the rows.
TRACKED = 1024


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate; aggregates and joins only make it larger."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return plan_bytes(df) * INFLATION <= limit


def hot_keys(facts: DataFrame, key: str, salts: int = SALTS) -> tuple[list, bool]:
    """The keys that hold more than one ``salts``-th of the rows, at most ``salts``, and whether null does.

    One scan of the key: each task keeps a heavy-hitter sketch of bounded size, and the sketches merge.
    """
    some = F.count(F.lit(1)).alias("rows"), F.count(key).alias("keyed")
    top = F.expr(f"approx_top_k(`{key}`, {2 * salts}, {TRACKED}) FILTER (WHERE `{key}` IS NOT NULL)")
    found = facts.agg(*some, top.alias("top")).first()
    least = max(found["rows"] / salts, 1)
    hot = [t["item"] for t in found["top"] or [] if t["count"] > least]
    return hot[:salts], found["rows"] - found["keyed"] > least


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread: Sequence[str],
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Join many ``facts`` rows to one ``dim`` row per ``key``.

    A dimension whose estimated size is within ``limit`` is broadcast.  A larger one is
    shuffled.  If the facts have one row per key already (``spread`` is the key itself), that is
    a plain join: no key can be hot.  Otherwise the hot keys are asked of a sketch of the facts, or of ``keys``, a
    cheaper frame with the same key column: their dimension rows alone are repeated once per salt, and
    their facts spread over the salts by ``spread``, columns that vary within a key.  All other rows join plainly.
    """
    if fits_broadcast(dim, limit):
        return facts.join(F.broadcast(dim), key, how)
    if list(spread) == [key]:
        return facts.join(dim, key, how)
    hot, hot_null = hot_keys(facts if keys is None else keys, key, salts)
    if not hot and not hot_null:
        return facts.join(dim, key, how)
    is_hot = F.col(key).isin(hot) if hot else F.lit(False)
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts).cast("bigint"))
    none = F.lit(0).cast("bigint")
    # Rows without a key match nothing, so they may lie anywhere.
    salted = facts.withColumn("_salt", F.when(F.col(key).isNull() | is_hot, salt).otherwise(none))
    copies = dim.withColumn(
        "_salt", F.explode(F.when(is_hot, F.sequence(none, F.lit(salts - 1).cast("bigint"))).otherwise(F.array(none)))
    )
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null, as in GROUP BY."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])
