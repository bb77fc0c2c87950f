"""Approximate nearest neighbours: a graph by NN-descent, searched greedily.

Every node keeps its ``DEGREE`` nearest nodes known so far.  The first lists come from random
tilings of the space.  Then, round by round, joins bring the neighbours of each node
together, forward and backward: the nodes near one node are compared with each other where at
least one of the two is new to it, and every node keeps the best of what it had and heard.
Nodes travel with the components as given, float or double, so that vectors of any mix of lengths
are told apart; distances are taken in double precision.

A query starts at its own node, or at sampled entries, and joins by joins expands the nearest
nodes not yet expanded until none of its ``BEAM`` best is left.

Equal vectors are one node, with its least ids beside it: a large group of copies costs one
place in each list and leaves room for others.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.llm.common import ship, whole_groups
from cadenza.session import stored

DEGREE, SAMPLE = 32, 16
TILINGS, CELL, PIVOTS, SPILL, LEAF, SLICE = 4, 192, 4096, 2, 512, 8192
ROUNDS, SETTLED = 8, 0.01
BEAM, HOPS, ENTRIES, RERANKED = 128, 12, 64, 2
_SEED = 0x5EED


def valid(vector: Column) -> Column:
    """Not null, not zero, and of finite components only."""
    doubles = vector.cast("array<double>")
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(doubles, lambda x: x != 0), F.lit(False))


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _nodes(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame, int]:
    """Distinct vectors (node, vector), the least ids of each (node, vec_id), and the dimension."""
    good = rows.where("vec_id is not null").where(valid(F.col("vector")))
    sizes = good.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
    dims = sizes["dims"] if sizes else 0
    marked = stored(
        good.where(F.size("vector") == dims).withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64("vector", F.lit(1))})
    )
    place = F.row_number().over(W.partitionBy("h1", "h2").orderBy("vec_id"))
    ids = marked.select("vec_id", "h1", "h2").distinct().withColumn("place", place).where(F.col("place") <= k + 1)
    heads = ids.where("place = 1").select("h1", "h2", F.col("vec_id").alias("first"))
    # Two vectors of one id are two nodes; the node's name is not the id.
    named = ids.join(heads, ["h1", "h2"]).select(F.xxhash64("first", "h1", "h2").alias("node"), "vec_id", "h1", "h2", "place", "first")
    named = stored(named)
    vectors = marked.join(named.where("place = 1").select("node", "h1", "h2", F.col("first").alias("vec_id")), ["h1", "h2", "vec_id"])
    return stored(vectors.select("node", "vector").dropDuplicates(["node"])), named.select("node", "vec_id"), dims


def _coded(nodes: DataFrame, dims: int) -> DataFrame:
    """(node, code): the bytes of the components, in the precision they are given in."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                codes = pa.array([row.tobytes() for row in _vectors(batch.column("vector"), dims)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("node"), codes], names=["node", "code"])

    return nodes.mapInArrow(code, "node bigint, code binary")


def _numbers(codes: list[bytes], dims: int) -> np.ndarray:
    """The components of ``codes``, which are of 4 or 8 bytes each."""
    kind = np.float64 if codes and len(codes[0]) == 8 * dims else np.float32
    return np.frombuffer(b"".join(codes), dtype=kind).reshape(len(codes), dims).astype(np.float64)


def _decoded(column: pa.Array, dims: int) -> np.ndarray:
    return _numbers(column.to_pylist(), dims)


def _squares(x: np.ndarray) -> np.ndarray:
    norms = (x * x).sum(axis=1)
    return np.maximum(norms[:, None] + norms[None, :] - 2 * (x @ x.T), 0)


def _first_lists(coded: DataFrame, dims: int, count: int, degree: int) -> DataFrame:
    """(node, nbr, dist) from ``TILINGS`` random tilings: nodes near the same pivots are compared.

    Pivots are sampled nodes, at most ``PIVOTS``.  Nodes are dealt out in order of their cell, so
    a cell of any size is divided over tasks; within a task one too large is split by planes.
    """
    wanted = int(min(PIVOTS, max(1, count // CELL)))
    parts = max(1, ceil(count * SPILL / SLICE))
    kept = max(1, degree // 2)

    def tiling(seed: int) -> DataFrame:
        drawn = coded.orderBy(F.xxhash64("node", F.lit(_SEED + seed)), "node").limit(wanted).collect()
        pivots = _numbers([bytes(r["code"]) for r in drawn], dims)
        spill = min(SPILL, len(drawn))

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            half = 0.5 * (pivots * pivots).sum(axis=1)
            for batch in batches:
                for start in range(0, len(batch), 1024):
                    part = batch.slice(start, 1024)
                    close = np.argpartition(half - _decoded(part.column("code"), dims) @ pivots.T, spill - 1, axis=1)[:, :spill]
                    rows = pa.array(np.repeat(np.arange(len(part)), spill))
                    yield pa.RecordBatch.from_arrays([part.column("node").take(rows), part.column("code").take(rows), pa.array(close.ravel().astype(np.int32))], names=["node", "code", "cell"])

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rng = np.random.default_rng([_SEED, seed])
            for block, edges in whole_groups(batches, "cell"):
                names, x = block.column("node").to_numpy(), _decoded(block.column("code"), dims)
                groups = [np.arange(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                while groups:
                    rows = groups.pop()
                    if len(rows) > LEAF:
                        a, b = x[rows[rng.choice(len(rows), 2, replace=False)]]
                        side = np.argsort(x[rows] @ (a - b), kind="stable")
                        groups += [rows[side[: len(rows) // 2]], rows[side[len(rows) // 2 :]]]
                        continue
                    k = min(kept, len(rows) - 1)
                    if k < 1:
                        continue
                    dist = _squares(x[rows])
                    np.fill_diagonal(dist, np.inf)
                    near = np.argpartition(dist, k - 1, axis=1)[:, :k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(names[rows], k)), pa.array(names[rows[near]].ravel()), pa.array(np.take_along_axis(dist, near, 1).ravel())],
                        names=["node", "nbr", "dist"],
                    )

        placed = coded.mapInArrow(assign, "node bigint, code binary, cell int")
        dealt = placed.repartitionByRange(parts, "cell", F.xxhash64("node")).sortWithinPartitions("cell", "node")
        return dealt.mapInArrow(compare, "node bigint, nbr bigint, dist double")

    found = tiling(0)
    for seed in range(1, TILINGS):
        found = found.unionByName(tiling(seed))
    return found


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest of each node; an edge heard twice is as old as its oldest."""
    merged = edges.groupBy("node", "nbr").agg(F.min("dist").alias("dist"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(W.partitionBy("node").orderBy("dist", "nbr"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= degree).drop("rank")


def _round(graph: DataFrame, coded: DataFrame, dims: int, degree: int, sample: int, seed: int) -> DataFrame:
    """One round of NN-descent; edges of the result are fresh (1) if not yet compared at their node."""
    rolled = F.xxhash64("node", "nbr", F.lit(seed))
    ranked = graph.withColumn("turn", F.row_number().over(W.partitionBy("node", "fresh").orderBy(rolled, "nbr")))
    ranked = stored(ranked.withColumn("drawn", F.col("turn") <= sample))
    drawn = ranked.where("drawn").select("node", "nbr", "fresh")
    # A node that is near to very many would be compared with all of them: as many are drawn as forward.
    back = drawn.withColumn("turn", F.row_number().over(W.partitionBy("nbr", "fresh").orderBy(rolled, "node")))
    back = back.where(F.col("turn") <= sample).select(F.col("nbr").alias("pivot"), F.col("node").alias("member"), "fresh")
    members = drawn.select(F.col("node").alias("pivot"), F.col("nbr").alias("member"), "fresh").unionByName(back)
    members = members.groupBy("pivot", "member").agg(F.max("fresh").alias("fresh"))
    reach = graph.groupBy("node").agg(F.max("dist").alias("reach"), F.count(F.lit(1)).alias("n"))
    known = coded.join(reach, "node", "left").select(
        F.col("node").alias("member"), "code", F.when(F.col("n") >= degree, F.col("reach")).otherwise(float("inf")).alias("reach")
    )
    rows = members.join(known, "member").select("pivot", "member", "fresh", "reach", "code")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, edges in whole_groups(batches, "pivot"):
            names, fresh = block.column("member").to_numpy(), block.column("fresh").to_numpy() > 0
            reach, x = block.column("reach").to_numpy(), _decoded(block.column("code"), dims)
            left, right, far = [], [], []
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if stop - start < 2 or not fresh[start:stop].any():
                    continue
                dist = _squares(x[start:stop])
                np.fill_diagonal(dist, np.inf)
                new = fresh[start:stop]
                i, j = np.nonzero((dist < reach[start:stop, None]) & (new[:, None] | new[None, :]))
                left.append(names[start + i])
                right.append(names[start + j])
                far.append(dist[i, j])
            if left:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(left)), pa.array(np.concatenate(right)), pa.array(np.concatenate(far))],
                    names=["node", "nbr", "dist"],
                )

    heard = rows.repartition("pivot").sortWithinPartitions("pivot", "member").mapInArrow(compare, "node bigint, nbr bigint, dist double")
    old = ranked.select("node", "nbr", "dist", F.when(F.col("drawn"), 0).otherwise(F.col("fresh")).alias("fresh"))
    return _best(old.unionByName(heard.select("node", "nbr", "dist", F.lit(1).alias("fresh"))), degree)


def build_graph(coded: DataFrame, dims: int, degree: int = DEGREE, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """(node, nbr, dist, fresh): the neighbour graph of ``coded`` (node, code)."""
    count = coded.count()
    first = _first_lists(coded, dims, count, degree).withColumn("fresh", F.lit(1))
    graph = stored(_best(first, degree))
    for seed in range(rounds):
        graph = stored(_round(graph, coded, dims, degree, sample, seed))
        if graph.where("fresh = 1").count() <= SETTLED * degree * count:
            break
    return graph


def _measured(pairs: DataFrame, coded: DataFrame, asked: DataFrame, dims: int) -> DataFrame:
    """(query_id, node, far): squared distances of pairs (query_id, node)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                gap = _decoded(batch.column("asked"), dims) - _decoded(batch.column("code"), dims)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id"), batch.column("node"), pa.array((gap * gap).sum(axis=1))], names=["query_id", "node", "far"]
                )

    rows = pairs.join(coded, "node").join(asked, "query_id").select("query_id", "node", "asked", "code")
    return rows.mapInArrow(measure, "query_id bigint, node bigint, far double")


def _scored(pairs: DataFrame, nodes: DataFrame, queries: DataFrame, dims: int) -> DataFrame:
    """(query_id, node, score): distances on the original vectors, in double precision."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                gap = _vectors(batch.column("query"), dims).astype(np.float64) - _vectors(batch.column("vector"), dims).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("query_id"), batch.column("node"), pa.array(np.sqrt((gap * gap).sum(axis=1)))], names=["query_id", "node", "score"]
                )

    rows = pairs.join(nodes, "node").join(queries, "query_id").select("query_id", "node", "query", "vector")
    return rows.mapInArrow(measure, "query_id bigint, node bigint, score double")


def search(coded: DataFrame, graph: DataFrame, asked: DataFrame, dims: int, starts: DataFrame | None = None, beam: int = BEAM, hops: int = HOPS) -> DataFrame:
    """(query_id, node, far): the nearest nodes that greedy search has seen, ``RERANKED`` times the beam and ties.

    ``asked`` has (query_id, asked) with the query's code, ``starts`` (query_id, node); every query
    also starts at the ``ENTRIES`` nodes of least hash.
    """
    near = F.row_number().over(W.partitionBy("node").orderBy("dist", "nbr"))
    back = graph.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "dist")
    links = stored(
        graph.select("node", "nbr").unionByName(back.withColumn("rank", near).where(F.col("rank") <= DEGREE).select("node", "nbr")).distinct()
    )
    entries = [r["node"] for r in coded.select("node").orderBy(F.xxhash64("node", F.lit(_SEED)), "node").limit(ENTRIES).collect()]
    # A fixed number of entries for each query: no cross join of tables.
    first = asked.select("query_id", F.explode(F.lit(entries or None).cast("array<bigint>")).alias("node"))
    if starts is not None:
        first = first.unionByName(starts.select("query_id", "node")).distinct()
    seen = stored(_measured(first, coded, asked, dims).withColumn("open", F.lit(True)))
    best = F.row_number().over(W.partitionBy("query_id").orderBy("far", "node"))
    for _ in range(hops):
        ranked = stored(seen.withColumn("rank", best))
        front = ranked.where((F.col("rank") <= beam) & F.col("open")).select("query_id", "node")
        if front.isEmpty():
            break
        heard = front.join(links, "node").select("query_id", F.col("nbr").alias("node")).distinct()
        new = heard.join(ranked.select("query_id", "node"), ["query_id", "node"], "left_anti")
        closed = ranked.withColumn("open", F.col("open") & (F.col("rank") > beam)).drop("rank")
        seen = closed.unionByName(_measured(new, coded, asked, dims).withColumn("open", F.lit(True)))
    tied = F.rank().over(W.partitionBy("query_id").orderBy("far"))
    return seen.withColumn("rank", tied).where(F.col("rank") <= RERANKED * beam).select("query_id", "node", "far")


def nearest(rows: DataFrame, queries: Column, k: int = 10, vector_column: str = "embedding", degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of every row that ``queries`` marks.

    Distance is Euclidean, ties go to the smaller vec_id.  Rows without id, with a vector that is
    null, zero, not finite or not of the usual length take no part, neither as query nor as
    candidate.  Rows of equal id and vector are one row; two vectors of one id are two candidates
    for others, not for each other.  An empty table gives no rows; other columns are not read.
    """
    picked = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector_column).alias("vector"))
    kind = picked.schema["vector"].dataType.simpleString()
    if kind != "array<float>":
        picked = picked.withColumn("vector", F.col("vector").cast("array<double>"))
    nodes, ids, dims = _nodes(picked, k)
    coded = stored(_coded(nodes, dims))
    graph = build_graph(coded, dims, degree)
    asking = picked.where(queries).where(valid(F.col("vector"))).where(F.size("vector") == dims)
    # A query is named by id and vector until the end: an id may occur with two vectors.
    named = stored(
        asking.select(
            F.xxhash64("vec_id", F.xxhash64("vector"), F.xxhash64("vector", F.lit(1))).alias("query_id"), F.col("vec_id").alias("own"),
            F.col("vector").alias("query"), F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(1)).alias("h2"),
        ).dropDuplicates(["query_id"])
    )
    # Its own node: the one of its vector, whichever id names it.
    vector_nodes = nodes.select("node", F.xxhash64("vector").alias("h1"), F.xxhash64("vector", F.lit(1)).alias("h2"))
    starts = stored(named.join(vector_nodes, ["h1", "h2"]).join(coded, "node").select("query_id", "node", F.col("code").alias("asked")))
    near = search(coded, graph, starts.select("query_id", "asked"), dims, starts.select("query_id", "node"), beam)
    found = stored(_scored(near.select("query_id", "node"), nodes, named.select("query_id", "query"), dims))
    # An id stands in as many nodes as it has vectors: so many nodes hold k others, with their ties.
    vectors_of_one = ids.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    tied = F.rank().over(W.partitionBy("query_id").orderBy("score"))
    close = found.withColumn("place", tied).where(F.col("place") <= (k + 1) * vectors_of_one).select("query_id", "node", "score")
    candidates = close.join(ids, "node").join(named.select("query_id", "own"), "query_id").where("vec_id != own")
    one = candidates.groupBy("query_id", "own", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return one.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("own").alias("query_id"), "rank", "vec_id", "score")


ship(__name__)
