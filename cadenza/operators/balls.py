"""Which blocks of items a query's best inner products can lie in, told before anything is sent.

Items are grouped around centres; a group is a ball of its centre and the largest distance from it.
By the ball, no item of a group scores above ``q.c + |q| r`` and none below ``q.c - |q| r``; by the longest item
neither above ``|q| n`` nor below ``-|q| n``.  The groups of largest lower bounds that hold ``k`` items together, and
as many more as the user has heard, give a score that the k-th unheard item reaches at least.  A query goes
to the groups whose upper bound reaches that, so results are exact, however well or badly the items cluster.

Centres are fitted to a bounded sample, ``SAMPLE`` items of smallest hash; every item is assigned and
counts in its ball.  What reaches the driver is the sample and one row per group, at most ``GROUPS``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators.joins import lookup_join
from cadenza.session import stored

GROUPS, SAMPLE, STEPS = 4096, 16_384, 4
ROWS_AT_ONCE = 1024
_VECTOR = T.ArrayType(T.DoubleType())

# Executors get the functions below with the task; they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Balls:
    """Per group: centre, radius, longest item, number of items, its first block and number of blocks."""

    centres: np.ndarray
    radius: np.ndarray
    longest: np.ndarray
    count: np.ndarray
    first: np.ndarray
    blocks: np.ndarray


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, but for rounding."""
    return (rows * rows).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(axis=1)


def fitted_centres(sample: np.ndarray, groups: int) -> np.ndarray:
    """Centres far apart, each then moved to the mean of its rows a few times."""
    chosen = [0]
    far = _distances(sample, sample[:1])[:, 0]
    while len(chosen) < groups and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(sample, sample[chosen[-1:]])[:, 0])
        far[chosen] = 0
    centres = sample[chosen].copy()
    for _ in range(STEPS):
        nearest = _distances(sample, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, sample)
        held = sizes > 0
        centres[held] = total[held] / sizes[held, None]
    return centres


def grouped(items: DataFrame, groups: int, block_items: int) -> tuple[DataFrame, Balls]:
    """``items`` (track_id, vector) with ``chunk``, their block, and the balls.

    A group of more than ``block_items`` is divided by hash, so that no block grows with a group.
    """
    taken = items.orderBy(F.xxhash64("track_id")).limit(SAMPLE).select("vector").collect()
    sample = np.array([r["vector"] for r in taken], dtype=float)
    sample = sample[np.isfinite(sample).all(axis=1)]
    if len(sample) == 0:
        sample = np.zeros((1, len(taken[0]["vector"])))
    centres = fitted_centres(sample, min(groups, GROUPS))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                rows = _matrix(part.column("vector"))
                nearest = _distances(rows, centres).argmin(axis=1)
                distance = np.linalg.norm(rows - centres[nearest], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("track_id"), part.column("vector"), pa.array(nearest.astype(np.int32)),
                     pa.array(distance), pa.array(np.linalg.norm(rows, axis=1))],
                    names=["track_id", "vector", "ball", "distance", "length"],
                )

    schema = T.StructType([
        items.schema["track_id"], T.StructField("vector", _VECTOR), T.StructField("ball", T.IntegerType()),
        T.StructField("distance", T.DoubleType()), T.StructField("length", T.DoubleType()),
    ])
    placed = stored(items.mapInArrow(assign, schema))
    sizes = placed.groupBy("ball").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius"), F.max("length").alias("longest"))
    rows = {r["ball"]: r for r in sizes.collect()}
    held = [rows.get(i) for i in range(len(centres))]
    count = np.array([r["n"] if r else 0 for r in held])
    blocks = np.array([ceil(n / block_items) for n in count])
    first = np.cumsum(blocks) - blocks
    # A length that is no number, of components that are not finite, bounds nothing.
    radius, longest = (
        np.nan_to_num(np.array([r[c] if r else 0.0 for r in held]), nan=np.inf, posinf=np.inf) for c in ("radius", "longest")
    )
    at = F.col("ball") + 1
    lowest, parts = (F.element_at(F.lit(values.tolist()), at) for values in (first, blocks))
    chunk = lowest + F.pmod(F.xxhash64("track_id"), parts.cast("bigint"))
    return placed.select("track_id", "vector", chunk.alias("chunk")), Balls(centres, radius, longest, count, first, blocks)


def _reached(queries: np.ndarray, wanted: np.ndarray, balls: Balls, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, group) where the group can hold one of the ``wanted`` best of the query."""
    endless = {"posinf": np.inf, "neginf": -np.inf}
    with np.errstate(invalid="ignore"):
        length = np.linalg.norm(queries, axis=1)[:, None]
        middle = queries @ balls.centres.T
        around, most = length * balls.radius, length * balls.longest
        upper = np.nan_to_num(np.minimum(middle + around, most), nan=np.inf, **endless)
        lower = np.nan_to_num(np.maximum(middle - around, -most), nan=-np.inf, **endless)
        # Scores are compared to some digits, and bounds carry rounding of their own.
        room = slack + 1e-9 * length * (np.linalg.norm(balls.centres, axis=1) + balls.radius)
        order = np.argsort(-lower, axis=1, kind="stable")
        enough = np.cumsum(balls.count[order], axis=1) >= wanted[:, None]
        # A query that wants more than there are reaches every group.
        at = order[np.arange(len(order)), enough.argmax(axis=1)]
        least = np.where(enough[:, -1], lower[np.arange(len(order)), at], -np.inf)
        # What is no number bounds nothing.
        out = upper + room < least[:, None]
    return np.nonzero(~out & (balls.count > 0))


def asked(queries: DataFrame, seen: DataFrame | None, balls: Balls, k: int, slack: float) -> DataFrame:
    """``queries`` (user_id, probe, vector) with ``chunk``: a row for each block that can hold one of the ``k`` best unheard items."""
    heard = F.lit(0).cast("bigint")
    if seen is not None:
        sizes = seen.where("user_id is not null").groupBy("user_id").agg(F.count(F.lit(1)).alias("heard"))
        queries, heard = queries.join(sizes, "user_id", "left"), F.coalesce("heard", heard)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                row, ball = _reached(_matrix(part.column("vector")), k + part.column("heard").to_numpy(), balls, slack)
                times = balls.blocks[ball]
                within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                sent = part.take(pa.array(np.repeat(row, times)))
                chunk = pa.array((np.repeat(balls.first[ball], times) + within).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [sent.column("user_id"), sent.column("probe"), sent.column("vector"), chunk], names=["user_id", "probe", "vector", "chunk"]
                )

    schema = T.StructType([
        queries.schema["user_id"], T.StructField("probe", T.IntegerType()), T.StructField("vector", _VECTOR), T.StructField("chunk", T.LongType()),
    ])
    return queries.select("user_id", "probe", "vector", heard.alias("heard")).mapInArrow(route, schema)


def known(seen: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, track_id, chunk) of the pairs whose item is there; an item that very many have heard does not skew."""
    pairs = seen.where("user_id is not null").select("user_id", "track_id")
    return lookup_join(pairs, items.select("track_id", "chunk"), "track_id", ["user_id"])
