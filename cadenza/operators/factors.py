"""Collaborative filtering: implicit ALS, truncated SVD, and new listeners without a refit."""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator
from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from cadenza.operators.content import with_metadata
from cadenza.operators.ids import dense_ids, encode, hash_split
from cadenza.operators.joins import lookup_join
from cadenza.operators.plays import implicit_ratings, most_active, restricted_to
from cadenza.operators.topk import top_k_dot
from cadenza.session import shared_folder, stored

RATINGS_PER_BLOCK, LEAST_RATINGS_PER_BLOCK, SMALL_BLOCKS = 500_000, 10_000, 8
OVERSAMPLED, MAX_STEPS, SETTLED, HELD_BLOCKS = 10, 40, 1e-7, 3
# Users or tracks of one cell of the ratings matrix; a task holds so many vectors of each.
CELL_ROWS, SUM_TASKS = 65_536, 16
# Ratings of one listener that one task sums at most.
PAIRS_PER_SUM = 100_000
# Stands for no vector: an Arrow list column of nulls takes Spark many times as long to hand to Python as empty lists.
NO_VECTOR = "CAST(array() AS array<double>)"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Factorisation:
    """User and track vectors with the ratings they were fitted and tested on."""

    users: DataFrame  # user_id, vector
    tracks: DataFrame  # track_id, vector
    train: DataFrame  # user_id, track_id, user_idx, track_idx, implicit_rating
    test: DataFrame
    predictions: DataFrame  # test rows with a prediction
    model: ALSModel | None = None
    singular_values: tuple[float, ...] = ()
    steps: int = 0
    settled: bool = True  # False: an SVD that ended at its last step


def _blocks(ratings: int) -> int:
    """ALS blocks by the ratings alone, as blocks seed the factors: the same data give the same lists on any cluster."""
    return max(ceil(ratings / RATINGS_PER_BLOCK), min(SMALL_BLOCKS, ceil(ratings / LEAST_RATINGS_PER_BLOCK)), 1)


def fit_als(
    plays: DataFrame,
    rank: int = 50,
    max_iter: int = 15,
    reg: float = 0.1,
    alpha: float = 40.0,
    seed: int = 42,
    blocks: int | None = None,
) -> Factorisation:
    """Implicit-feedback ALS on 80 % of the rating pairs; both factor frames are stored."""
    spark = plays.sparkSession
    shared_folder(spark)
    ratings = stored(implicit_ratings(plays))
    user_ids = dense_ids(ratings, "user_id", "user_idx")
    track_ids = dense_ids(ratings, "track_id", "track_idx")
    coded = stored(encode(ratings, user_ids, track_ids))
    train, test = hash_split(coded)
    blocks = blocks or _blocks(coded.count())
    als = ALS(
        rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True,
        userCol="user_idx", itemCol="track_idx", ratingCol="implicit_rating",
        coldStartStrategy="drop", seed=seed, numUserBlocks=blocks, numItemBlocks=blocks,
    )
    fitted = train.select("user_idx", "track_idx", F.col("implicit_rating").cast("float").alias("implicit_rating"))
    model = als.fit(fitted)
    vector = F.col("features").cast("array<double>").alias("vector")
    users = stored(model.userFactors.join(user_ids, F.col("id") == F.col("user_idx")).select("user_id", vector))
    tracks = stored(model.itemFactors.join(track_ids, F.col("id") == F.col("track_idx")).select("track_id", vector))
    return Factorisation(users, tracks, train, test, model.transform(test), model)


def _matrix(batch: pa.RecordBatch, column: str = "vector") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)


def _arrays(matrix: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of the outer products of all vectors: a matrix per task, summed by a few tasks, then on the driver."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((width, width))
        for batch in batches:
            if len(batch):
                x = _matrix(batch)
                held += x.T @ x
        slot = TaskContext.get().partitionId() % SUM_TASKS
        yield pa.RecordBatch.from_pydict({"slot": pa.array([slot], pa.int32()), "sums": pa.array([held.tobytes()], pa.binary())})

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(width * width)
        for batch in batches:
            for sums in batch.column("sums"):
                held += np.frombuffer(sums.as_py())
        yield pa.RecordBatch.from_pydict({"sums": pa.array([held.tobytes()], pa.binary())})

    sums = vectors.select("vector").mapInArrow(part, "slot int, sums binary").repartition("slot").mapInArrow(whole, "sums binary")
    return sum((np.frombuffer(r["sums"]) for r in sums.collect()), np.zeros(width * width)).reshape(width, width)


def _times(vectors: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    """Every vector times ``matrix``."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(key), _arrays(_matrix(batch) @ matrix)], names=[key, "vector"])

    kind = vectors.schema[key].dataType.simpleString()
    return vectors.select(key, "vector").mapInArrow(multiply, f"{key} {kind}, vector array<double>")


class _Sums:
    """Sums of weighted vectors by a dense place; only places that occur are given back."""

    def __init__(self, width: int) -> None:
        self.sums, self.met = np.zeros((0, width)), np.zeros(0, dtype=bool)

    def add(self, places: np.ndarray, vectors: np.ndarray) -> None:
        if not len(places):
            return
        order = np.argsort(places, kind="stable")
        places, edges = np.unique(places[order], return_index=True)
        if places[-1] >= len(self.sums):
            more = max(int(places[-1]) + 1, 2 * len(self.sums)) - len(self.sums)
            self.sums = np.concatenate([self.sums, np.zeros((more, self.sums.shape[1]))])
            self.met = np.concatenate([self.met, np.zeros(more, dtype=bool)])
        self.sums[places] += np.add.reduceat(vectors[order], edges)
        self.met[places] = True

    def rows(self, name: str, blocks: int, block: int) -> pa.RecordBatch:
        """Place p of this block is number p * blocks + block."""
        places = np.flatnonzero(self.met)
        keys = pa.array((places * blocks + block).astype(np.int32))
        return pa.RecordBatch.from_arrays([keys, _arrays(self.sums[places])], names=[name, "vector"])


def _runs(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, start, stop) of the runs of equal values."""
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    for start, stop in zip(edges[:-1], edges[1:], strict=True):
        if stop > start:
            yield int(values[start]), start, stop


def _array_sums(rows: DataFrame, key: str, blocks: int, width: int) -> DataFrame:
    """(``key``, vector): whole arrays summed by key, a block of keys at a time."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, None
        for batch in batches:
            if not len(batch):
                continue
            keys, vectors = batch.column(key).to_numpy(), _matrix(batch)
            for now, start, stop in _runs(keys % blocks):
                if now != block:
                    if held is not None:
                        yield held.rows(key, blocks, block)
                    block, held = now, _Sums(width)
                held.add(keys[start:stop] // blocks, vectors[start:stop])
        if held is not None:
            yield held.rows(key, blocks, block)

    block = F.col(key) % blocks
    dealt = rows.withColumn("block", block).repartition("block").sortWithinPartitions("block").drop("block")
    return dealt.mapInArrow(add, f"{key} int, vector array<double>")


def _product(ratings: DataFrame, vectors: DataFrame, by: str, to: str, sizes: dict[str, int], width: int) -> DataFrame:
    """(``to``, vector): the sum of rating times vector over each row's ratings.

    ``by`` and ``to`` are dense numbers and ``sizes`` how many there are.  The matrix of the ratings is cut into
    cells of ``CELL_ROWS`` by ``CELL_ROWS``, dealt by remainder so that the frequent rows are spread; a cell's task holds
    its vectors and its sums and streams its ratings, however many a hot row has.  A vector is sent once
    to each cell of its row, and the cells' sums, whole arrays, are added.
    """
    from_blocks, to_blocks = (max(1, ceil(sizes[c] / CELL_ROWS)) for c in (by, to))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, places, parts, held, sums = None, [], [], None, None
        for batch in batches:
            if not len(batch):
                continue
            for now, start, stop in _runs(batch.column("cell").to_numpy()):
                if now != cell:
                    if sums is not None:
                        yield sums.rows(to, to_blocks, cell // from_blocks)
                    cell, places, parts, held, sums = now, [], [], None, _Sums(width)
                rows = batch.slice(start, stop - start)
                sources = rows.column("source").to_numpy() // from_blocks
                given = rows.column("target").is_null().to_numpy(zero_copy_only=False)
                if given.any():  # vectors come before the cell's ratings
                    places.append(sources[given])
                    parts.append(_matrix(rows.filter(pa.array(given))))
                if not given.all():
                    if held is None:
                        held = np.zeros((max((int(p.max()) for p in places), default=-1) + 2, width))
                        for p, v in zip(places, parts, strict=True):
                            held[p] = v
                        places, parts = [], []
                    rated = rows.filter(pa.array(~given))
                    # The last row stands for what has no vector.
                    at = np.minimum(sources[~given], len(held) - 1)
                    weights = rated.column("w").to_numpy(zero_copy_only=False)
                    sums.add(rated.column("target").to_numpy(zero_copy_only=False).astype(np.int64) // to_blocks, held[at] * weights[:, None])
        if sums is not None:
            yield sums.rows(to, to_blocks, cell // from_blocks)

    dealt = _cells(ratings, vectors, by, to, from_blocks, to_blocks)
    parts = dealt.mapInArrow(multiply, f"{to} int, vector array<double>")
    return parts if from_blocks == 1 else _array_sums(parts, to, to_blocks, width)


def _cells(ratings: DataFrame, vectors: DataFrame, by: str, to: str, from_blocks: int, to_blocks: int) -> DataFrame:
    """Rows (cell, source, target, w, vector) by cell, a cell's vectors, without target, before its ratings."""
    source, target = F.col(by).cast("bigint"), F.col(to).cast("bigint")
    rated = ratings.select(
        (target % to_blocks * from_blocks + source % from_blocks).alias("cell"), source.alias("source"), target.alias("target"),
        F.col("implicit_rating").cast("double").alias("w"), F.expr(NO_VECTOR).alias("vector"),
    )
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(to_blocks - 1).cast("bigint")))
    sent = vectors.select(source.alias("source"), "vector", copies.alias("row")).select(
        (F.col("row") * from_blocks + F.col("source") % from_blocks).alias("cell"), "source", F.lit(None).cast("bigint").alias("target"),
        F.lit(None).cast("double").alias("w"), "vector",
    )
    return sent.unionByName(rated).repartition("cell").sortWithinPartitions("cell", F.col("target").isNotNull())


def _whitener(gram: np.ndarray, least: float = 1e-12) -> np.ndarray:
    """The matrix that makes vectors of this Gram matrix orthonormal; directions without length are dropped."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    some = values > least * max(values.max(initial=0.0), 1e-300)
    return vectors[:, some] / np.sqrt(values[some])


@dataclass(frozen=True)
class _Ritz:
    """What the Gram matrix of a basis Q and its image Z = A'A Q tells."""

    values: np.ndarray  # falling
    turn: np.ndarray  # Q times this are the orthonormal Ritz vectors
    residuals: np.ndarray  # length of A'A x - value x of each
    fresh: np.ndarray  # [Q Z] times this are new orthonormal directions, none: the space is whole


def _ritz(gram: np.ndarray, wanted: int, settled: float) -> _Ritz:
    k = len(gram) // 2
    basis = _whitener(gram[:k, :k])
    values, turn = np.linalg.eigh(basis.T @ (gram[:k, k:] + gram[k:, :k]) @ basis / 2)
    order = np.argsort(-values, kind="stable")
    values, turn = np.maximum(values[order], 0.0), basis @ turn[:, order]
    # A residual is [Q Z] times this column.
    rest = np.concatenate([-turn * values, turn])
    lengths = np.sqrt(np.maximum(np.einsum("ij,jk,ki->i", rest.T, gram, rest), 0.0))
    open_ones = np.flatnonzero(lengths[:wanted] > settled * max(values.max(initial=0.0), 1e-300))
    rest = rest[:, open_ones] / lengths[open_ones]
    for _ in range(2):  # what is left of Q in them by rounding goes, twice
        rest[:k] -= turn @ (np.concatenate([turn, np.zeros_like(turn)]).T @ gram @ rest)
    fresh = rest @ _whitener(rest.T @ gram @ rest, 1e-8) if len(open_ones) else rest
    return _Ritz(values, turn, lengths, fresh)


def truncated_svd(
    ratings: DataFrame, sizes: dict[str, int], rank: int, seed: int = 42, max_steps: int = MAX_STEPS, settled: float = SETTLED
) -> tuple[DataFrame, np.ndarray, int, bool]:
    """Right singular vectors (track_idx, vector), singular values, steps, and whether all are settled.

    Thick-restart block Lanczos on A'A.  A row of the frame holds a track's components of the basis Q
    and of its image Z; the Gram matrix of both, all that reaches the driver, gives the Ritz vectors and the
    lengths of their residuals.  The residuals of the wanted vectors that are longer than ``settled`` times the
    largest value are the next block; a basis of ``HELD_BLOCKS`` blocks is first cut to its best vectors.
    It ends when none is longer, or when the residuals add nothing to the space.
    """
    tracks = stored(ratings.select("track_idx").distinct())
    width = min(rank + OVERSAMPLED, tracks.count())
    rank = min(rank, width)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.random.default_rng([seed, i]).standard_normal(width) for i in batch.column("track_idx").to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column("track_idx"), _arrays(np.array(rows))], names=["track_idx", "vector"])

    frame = stored(tracks.mapInArrow(start, "track_idx int, vector array<double>"))
    fresh, kept, k = _whitener(_gram(frame, width)), np.zeros((0, 0)), 0
    ritz, step = _Ritz(np.zeros(0), np.zeros((0, 0)), np.zeros(0), fresh), 0
    while step < max_steps and fresh.shape[1]:
        step += 1
        added = fresh.shape[1]
        block = _times(frame, "track_idx", fresh)
        left = _product(ratings, block, "track_idx", "user_idx", sizes, added)
        image = _product(ratings, left, "user_idx", "track_idx", sizes, added)
        frame = stored(_extended(frame, image, fresh, kept, k))
        k = kept.shape[1] + added
        ritz = _ritz(_gram(frame, 2 * k), rank, settled)
        fresh = ritz.fresh
        # Room for the next block: as many vectors stay as were begun with.
        kept = np.eye(k) if k + fresh.shape[1] <= HELD_BLOCKS * width else ritz.turn[:, :width]
    done = bool((ritz.residuals[:rank] <= settled * ritz.values.max(initial=0.0)).all()) or not fresh.shape[1]
    turn = ritz.turn[:, :rank]
    vectors = stored(_times(frame, "track_idx", np.concatenate([turn, np.zeros((k, turn.shape[1]))])))
    return vectors, np.sqrt(ritz.values[:rank]), step, done


def _extended(frame: DataFrame, image: DataFrame, fresh: np.ndarray, kept: np.ndarray, k: int) -> DataFrame:
    """Rows [Q Z] with Q and Z turned by ``kept`` and the new block and its image behind them."""
    added = fresh.shape[1]

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                old = _matrix(batch)
                parts = [old[:, :k] @ kept, old @ fresh, old[:, k : 2 * k] @ kept, _matrix(batch, "image")] if k else [old @ fresh, _matrix(batch, "image")]
                yield pa.RecordBatch.from_arrays([batch.column("track_idx"), _arrays(np.concatenate(parts, axis=1))], names=["track_idx", "vector"])

    none = F.array_repeat(F.lit(0.0), added)
    both = frame.join(image.withColumnRenamed("vector", "image"), "track_idx", "left").withColumn("image", F.coalesce("image", none))
    return both.mapInArrow(extend, "track_idx int, vector array<double>")


def fit_svd(
    plays: DataFrame, rank: int = 50, most_active_users: int | None = None, most_played_tracks: int | None = None, seed: int = 42,
    max_steps: int = MAX_STEPS,
) -> Factorisation:
    """Truncated SVD of the ratings; both factors stay frames.

    All users and tracks take part; the two counts limit them to the most active and most played
    if given.  User vectors are the rating rows times the right singular vectors.  ``settled`` of the
    result is False, with a warning, if ``max_steps`` were not enough.
    """
    kept = plays
    if most_active_users is not None:
        kept = restricted_to(kept, most_active(plays, "user_id", most_active_users), "user_id")
    if most_played_tracks is not None:
        kept = restricted_to(kept, most_active(plays, "track_id", most_played_tracks), "track_id")
    ratings = stored(implicit_ratings(kept))
    user_ids = stored(dense_ids(ratings, "user_id", "user_idx"))
    track_ids = stored(dense_ids(ratings, "track_id", "track_idx"))
    coded = stored(encode(ratings, user_ids, track_ids))
    train, test = hash_split(coded)
    train = stored(train)
    sizes = {"user_idx": user_ids.count(), "track_idx": track_ids.count()}
    right, values, steps, settled = truncated_svd(train, sizes, rank, seed, max_steps)
    if not settled:
        warnings.warn(f"the SVD has not settled within {steps} steps", RuntimeWarning, stacklevel=2)
    tracks = stored(right.join(track_ids, "track_idx").select("track_id", "track_idx", "vector"))
    left = _product(train, right, "track_idx", "user_idx", sizes, len(values))
    users = stored(left.join(user_ids, "user_idx").select("user_id", "vector"))
    product = F.aggregate(F.zip_with("u", "vector", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    pairs = lookup_join(test, tracks.select("track_idx", "vector"), "track_idx", ["user_id"])
    mine = users.select("user_id", F.col("vector").alias("u"))
    predictions = lookup_join(pairs, mine, "user_id", ["track_id"], how="left").select(
        "user_id", "track_id", "implicit_rating", F.coalesce(product, F.lit(0.0)).alias("prediction")
    )
    return Factorisation(
        users, tracks.select("track_id", "vector"), train, test, predictions,
        singular_values=tuple(values.tolist()), steps=steps, settled=settled,
    )


def fold_in(
    tracks: DataFrame, ratings: DataFrame, reg: float = 0.1, alpha: float = 40.0, pairs_per_sum: int = PAIRS_PER_SUM
) -> DataFrame:
    """(user_id, vector) of listeners the ALS model was not fitted on, from their ratings of its tracks.

    Each vector solves the listener's normal equation against the Gram matrix of all track vectors, as
    a half-step of the implicit ALS does; the model stays as it is.  Ratings stream through in the order of the
    listener, whose sums are all a task holds; those of a listener with more than ``pairs_per_sum`` ratings
    are made by several tasks and added.  Ratings of other tracks are left out; a listener without
    any other rating has no row.
    """
    one = tracks.select("vector").first()
    rank = len(one["vector"]) if one else 0
    whole = _gram(tracks, rank)
    size = rank * rank + rank + 1

    def solved(held: np.ndarray) -> np.ndarray:
        normal, right, n = held[: rank * rank].reshape(rank, rank), held[rank * rank : -1], held[-1]
        return np.linalg.solve(whole + normal + reg * n * np.eye(rank), right)

    def grouped(batches: Iterator[pa.RecordBatch], addend) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """The summed addends per run of (user_id, part): user, parts of this user, and the sum."""
        last, held = None, None
        for batch in batches:
            if not len(batch):
                continue
            users, parts, sums = (batch.column(c).to_numpy() for c in ("user_id", "part", "parts"))
            changes = np.flatnonzero((users[1:] != users[:-1]) | (parts[1:] != parts[:-1])) + 1
            for start, stop in zip([0, *changes.tolist()], [*changes.tolist(), len(batch)], strict=True):
                key = (int(users[start]), int(parts[start]), int(sums[start]))
                if key != last:
                    if last is not None:
                        yield *last, held
                    last, held = key, np.zeros(size)
                held += addend(batch.slice(start, stop - start))
        if last is not None:
            yield *last, held

    def of_ratings(rows: pa.RecordBatch) -> np.ndarray:
        vectors, more = _matrix(rows), alpha * rows.column("w").to_numpy()
        return np.concatenate([((vectors * more[:, None]).T @ vectors).ravel(), (1 + more) @ vectors, [len(rows)]])

    def told(rows: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
        users, parts, values = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(users, pa.int64()), pa.array(parts, pa.int64()), pa.array([v.tolist() for v in values], pa.list_(pa.float64()))],
            names=["user_id", "parts", "vector"],
        )

    def stage(addend, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = []
            for user, _, parts, held in grouped(batches, addend):
                rows.append((user, parts, held if first and parts > 1 else solved(held)))
                if len(rows) * size > 1 << 20:
                    yield told(rows)
                    rows = []
            yield told(rows)

        return run

    kinds = "user_id bigint, parts bigint, vector array<double>"
    weight = F.col("implicit_rating").cast("double")
    rated = lookup_join(ratings.where(weight > 0).select("user_id", "track_id", weight.alias("w")), tracks.select("track_id", "vector"), "track_id", ["user_id"])
    # Only listeners with very many ratings are looked up: their number is bounded by the ratings.
    many = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > pairs_per_sum)
    many = many.select("user_id", F.ceil(F.col("n") / pairs_per_sum).cast("bigint").alias("parts"))
    dealt = rated.join(many, "user_id", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("bigint")))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("track_id"), F.col("parts")))
    order = ["user_id", "part"]
    summed = stored(dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(stage(of_ratings, True), kinds))
    alone = summed.where("parts = 1")
    shared = summed.where("parts > 1").withColumn("part", F.lit(0).cast("bigint")).repartition("user_id").sortWithinPartitions("user_id")
    added = shared.mapInArrow(stage(lambda rows: _matrix(rows).sum(axis=0), False), kinds)
    return alone.unionByName(added).select("user_id", "vector")


def factor_recommendations(
    fit: Factorisation, tracks: DataFrame, k: int = 10, exclude: DataFrame | None = None,
    digits: int = 6,
) -> DataFrame:
    """The ``k`` tracks of highest predicted score per user, with metadata.

    ``exclude`` (user_id, track_id) leaves out heard pairs.
    """
    queries = fit.users.withColumn("probe", F.lit(0))
    best = top_k_dot(queries, fit.tracks, k, seen=exclude)
    return with_metadata(best, tracks).select(
        "user_id", "rank", "track_id", "name", "artist_name", "genre",
        F.round("score", digits).alias("predicted_score"),
    )


def fold_in_recommendations(
    fit: Factorisation, ratings: DataFrame, tracks: DataFrame, k: int = 10, reg: float = 0.1, alpha: float = 40.0
) -> DataFrame:
    """Lists of unheard tracks for listeners absent from the fit of ``fit_als``, which is not repeated.

    ``reg`` and ``alpha`` are those of the fit.
    """
    folded = replace(fit, users=stored(fold_in(fit.tracks, ratings, reg, alpha)))
    return factor_recommendations(folded, tracks, k, exclude=ratings)
