"""The k items with the largest inner product for every query, exactly.

Items that fit one block of ``BLOCK_ITEMS`` lie in it; more are grouped around centres, and a query row is sent to the
blocks that can hold one of its best (``balls``).  A task holds one block as a matrix,
streams that block's queries past it and keeps only the best k unseen items of
each; pairs never leave a task.  Similar queries make a bundle (``bundles``), for which every item has a bound, so
they are multiplied with the most promising items first and with no item whose bound lies below the k-th score they
have.  The bound skips work, never results.

Seen pairs go to the block of their item, beside the queries of their user.  Where there are
fewer blocks than partitions, blocks are copied and users divided over the copies.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators import balls
from cadenza.operators.bundles import Bundles

BLOCK_ITEMS = 65_536
ITEMS_AT_ONCE, QUERIES_AT_ONCE, FIRST_ITEMS = 4096, 256, 512
# A row's place packs its block, salt and some bits of its user's hash, 0 for items.
SALT_BITS, USER_BITS = 14, 17
ITEM, SEEN, REQUEST = 0, 1, 2  # kinds of rows in a block, in their order

# Executors get the functions below with the task; they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def complete(vector: Column) -> Column:
    """Not null and without null or NaN in it; one column, however many dimensions."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x))


def top_k_dot(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    digits: int | None = 9,
    block_items: int = BLOCK_ITEMS,
    widths: Sequence[int] | None = None,
    tied: bool = True,
) -> DataFrame:
    """(user_id, probe, track_id, score, rank) of the best ``k`` items per query.

    ``queries`` has user_id, probe and ``vector``, an array of doubles; a user may have several
    probes.  ``items`` has track_id and ``vector``; rows with a null or NaN in the vector are
    left out.  So are the pairs in ``seen`` (user_id, track_id; each best given
    once).  Items rank by score rounded to ``digits``, then by track_id, so that
    floating-point noise does not order equal scores.

    ``widths`` tells the parts a vector is made of, if they are several; it changes the work only.  With
    ``tied`` False, of items whose scores differ by rounding alone any may be given, for callers that want scores.
    """
    spec = _Spec(k, digits, queries.schema["user_id"].dataType, items.schema["track_id"].dataType, tuple(widths or ()), tied)
    queries = queries.select("user_id", F.col("probe").cast("int").alias("probe"), "vector")
    queries = queries.where(F.col("user_id").isNotNull() & complete(F.col("vector")))
    items = items.select("track_id", "vector").where(complete(F.col("vector")))
    chunks = max(1, ceil(items.count() / block_items))
    if chunks > 1:
        items, groups = balls.grouped(items, chunks, block_items)
        queries = balls.asked(queries, seen, groups, k, spec.slack)
        seen = None if seen is None else balls.known(seen, items)
        chunks = int(groups.blocks.sum())
    partitions = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = max(1, min(partitions // chunks, 1 << SALT_BITS))
    return _ranked(_scored(queries, items, seen, spec, chunks, copies), spec)


@dataclass(frozen=True)
class _Spec:
    k: int
    digits: int | None
    user_type: T.DataType
    track_type: T.DataType
    widths: tuple[int, ...] = ()
    tied: bool = True

    @property
    def slack(self) -> float:
        """What rounding can move a score by."""
        return 0.0 if self.digits is None else 10.0 ** -self.digits


def _ranked(hits: DataFrame, spec: _Spec) -> DataFrame:
    score = F.col("score") if spec.digits is None else F.round("score", spec.digits)
    order = W.partitionBy("user_id", "probe").orderBy(score.desc(), "track_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= spec.k)


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _scored(queries: DataFrame, items: DataFrame, seen: DataFrame | None, spec: _Spec, chunks: int, copies: int) -> DataFrame:
    """Best k per request and block.

    In a block the items come first, then each user's seen items, then the
    user's requests.  Frames without ``chunk`` are dealt by the item's hash, queries to every block.
    """
    empty = {
        "track_id": F.lit(None).cast(spec.track_type), "user_id": F.lit(None).cast(spec.user_type),
        # Spark hands empty lists to Python many times as fast as null ones.
        "probe": F.lit(None).cast("int"), "vector": F.expr("CAST(array() AS array<double>)"),
    }
    chunk = F.pmod(F.xxhash64("track_id"), F.lit(chunks))
    salt = F.pmod(F.xxhash64("user_id"), F.lit(copies))
    user_bits = 1 + F.pmod(F.xxhash64("user_id", F.lit(1)), F.lit((1 << USER_BITS) - 1))

    def rows(frame: DataFrame, kind: int, low_bits: Column) -> DataFrame:
        present = set(frame.columns)
        block = F.shiftleft(F.col("chunk").cast("bigint"), SALT_BITS).bitwiseOR(F.col("salt").cast("bigint"))
        return frame.select(
            F.shiftleft(block, USER_BITS).bitwiseOR(low_bits.cast("bigint")).alias("place"), F.lit(kind).alias("kind"),
            *[F.col(c) if c in present else v.alias(c) for c, v in empty.items()],
        )

    def dealt(frame: DataFrame, place: Column) -> DataFrame:
        return frame if "chunk" in frame.columns else frame.withColumn("chunk", place)

    held = dealt(items, chunk).withColumn("salt", _each(copies))
    asked = dealt(queries, _each(chunks)).withColumn("salt", salt)
    everything = rows(held, ITEM, F.lit(0)).unionByName(rows(asked, REQUEST, user_bits))
    if seen is not None:
        known = dealt(seen.where("user_id is not null"), chunk).select("user_id", "track_id", "chunk")
        everything = everything.unionByName(rows(known.withColumn("salt", salt), SEEN, user_bits))
    schema = T.StructType([
        T.StructField("user_id", spec.user_type),
        T.StructField("probe", T.IntegerType()),
        T.StructField("track_id", spec.track_type),
        T.StructField("score", T.DoubleType()),
    ])
    return (
        everything.repartition(F.shiftright("place", USER_BITS))
        .sortWithinPartitions("place", "user_id", "kind", "track_id")
        .mapInArrow(_block_scorer(spec), schema)
    )


def _block_scorer(spec: _Spec):
    k, digits = spec.k, spec.digits
    slack = spec.slack

    def unpacked(rows_: pa.RecordBatch) -> np.ndarray:
        return rows_.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(len(rows_), -1)

    class Block:
        """The items of one block by track_id.  What all have in common moves every score of a query alike."""

        def __init__(self, ids: list[pa.Array], parts: list[np.ndarray]) -> None:
            self.ids, self.vectors = pa.concat_arrays(ids), np.concatenate(parts)
            self.longest = np.linalg.norm(self.vectors, axis=1).max()
            same = (self.vectors == self.vectors[0]).all(axis=0)
            self.common = np.where(same, self.vectors[0], 0.0)
            self.own = np.where(same, 0.0, self.vectors)
            self.varies = ~same

    def best(rows_: pa.RecordBatch, block: Block) -> pa.RecordBatch | None:
        """The best unseen items of one block for whole users, some requests and items at a time."""
        kind = rows_.column("kind").to_numpy()
        asked = np.flatnonzero(kind == REQUEST)
        if len(asked) == 0:
            return None
        run = rows_.take(pa.array(asked))
        queries = unpacked(run)
        n, own = len(block.ids), queries * block.varies
        size = np.linalg.norm(own, axis=1)
        size[~(np.isfinite(size) & (size > 0))] = 1.0
        bundles = Bundles(own / size[:, None], QUERIES_AT_ONCE, spec.widths)
        turn, turned = bundles.order, np.empty_like(bundles.order)
        turned[turn] = np.arange(len(turn))
        # Room for rounding; without regard to ties an item must promise more than rounding.
        reach = np.linalg.norm(queries, axis=1) * block.longest
        offset = queries @ block.common + np.nan_to_num(slack + 1e-9 * reach if spec.tied else -1e-12 * reach, nan=0.0)
        user = rows_.column("user_id").dictionary_encode().indices.to_numpy()
        seen = np.flatnonzero(kind == SEEN)
        places = pc.index_in(rows_.column("track_id").take(pa.array(seen)), value_set=block.ids)
        seen = seen[pc.is_valid(places).to_numpy(zero_copy_only=False)]
        columns = pc.drop_null(places).to_numpy()
        # A user's requests lie side by side; every one of them leaves out the user's seen items.
        first, last = (np.searchsorted(user[asked], user[seen], side=side) for side in ("left", "right"))
        times = last - first
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        seen_rows, seen_columns = turned[np.repeat(first, times) + within], np.repeat(columns, times)
        found_rows, found_columns, found_scores = [], [], []
        for bundle, (start, members) in enumerate(zip(bundles.starts.tolist(), bundles.sizes.tolist(), strict=True)):
            these = turn[start : start + members]
            part = queries[these]
            mine = (seen_rows >= start) & (seen_rows < start + len(part))
            hidden_rows, hidden_columns = seen_rows[mine] - start, seen_columns[mine]
            held = np.full((len(part), k), -np.inf)
            upper = bundles.upper(block.own, bundle)
            left, step, sorted_ = np.arange(n), min(FIRST_ITEMS, ITEMS_AT_ONCE), False
            rows, cols, kept = [], [], []
            while len(left):
                if not sorted_ and len(left) > step:
                    # The most promising items tell how few of the others need an order.
                    parted = left[np.argpartition(-upper[left], step)]
                    now, left = parted[:step], parted[step:]
                else:
                    now, left = left[:step], left[step:]
                needed = (held.min(axis=1) - offset[these]) / size[these]
                active = np.flatnonzero(~(needed > upper[now].max()))
                at_once = np.sort(now)
                scores = part[active] @ block.vectors[at_once].T
                column = np.minimum(np.searchsorted(at_once, hidden_columns), len(at_once) - 1)
                near = at_once[column] == hidden_columns
                at = np.searchsorted(active, hidden_rows[near])
                there = (at < len(active)) & (active[np.minimum(at, len(active) - 1)] == hidden_rows[near])
                scores[at[there], column[near][there]] = -np.inf
                # Most rows of a late step hold nothing that changes their best.
                better = np.flatnonzero((scores > held[active].min(axis=1)[:, None]).any(axis=1))
                if len(better):
                    top = np.concatenate([held[active[better]], scores[better]], axis=1)
                    held[active[better]] = np.partition(top, top.shape[1] - k, axis=1)[:, top.shape[1] - k :]
                floor = held[active].min(axis=1)
                row, col = np.nonzero((scores >= floor[:, None] - slack) & (scores > -np.inf))
                rows.append(active[row])
                cols.append(at_once[col])
                kept.append(scores[row, col])
                needed = ((held.min(axis=1) - offset[these]) / size[these]).min()
                left = left[~(upper[left] < needed)]
                if not sorted_ and needed > -np.inf:
                    left, sorted_ = left[np.argsort(-upper[left], kind="stable")], True
                step = min(2 * step, ITEMS_AT_ONCE)
            rows, cols, kept = (np.concatenate(x) if x else np.zeros(0, dtype=int) for x in (rows, cols, kept))
            order = np.lexsort((cols, -(kept if digits is None else np.round(kept, digits)), rows))
            rows = rows[order]
            chosen = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
            found_rows.append(turn[rows[chosen] + start])
            found_columns.append(cols[order[chosen]])
            found_scores.append(kept[order[chosen]].astype(float))
        rows = pa.array(np.concatenate(found_rows))
        return pa.RecordBatch.from_arrays(
            [run.column("user_id").take(rows), run.column("probe").take(rows),
             block.ids.take(pa.array(np.concatenate(found_columns))), pa.array(np.concatenate(found_scores))],
            names=["user_id", "probe", "track_id", "score"],
        )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, parts, block, waiting = None, [], [], None, []

        def flush(hold_last_user: bool) -> pa.RecordBatch | None:
            """Score the waiting rows; the last user may go on in the next batch."""
            nonlocal block, waiting
            if not waiting:
                return None
            rows_ = pa.concat_batches(waiting)
            cut = len(rows_)
            if hold_last_user:
                users = rows_.column("user_id").dictionary_encode().indices.to_numpy()
                cut = int(np.searchsorted(users, users[-1], side="left"))
            waiting = [rows_.slice(cut)] if cut < len(rows_) else []
            if not parts or cut == 0:
                return None
            if block is None:
                block = Block(ids, parts)
            return best(rows_.slice(0, cut), block)

        for batch in batches:
            blocks = batch.column("place").to_numpy() >> USER_BITS
            is_item = batch.column("kind").to_numpy() == ITEM
            edges = np.flatnonzero((blocks[1:] != blocks[:-1]) | (is_item[1:] != is_item[:-1])) + 1
            bounds = [0, *edges.tolist(), len(blocks)]
            for start, stop in zip(bounds[:-1], bounds[1:], strict=True):
                if start == stop:
                    continue
                if blocks[start] != place:
                    done = flush(hold_last_user=False)
                    if done is not None:
                        yield done
                    place, ids, parts, block, waiting = blocks[start], [], [], None, []
                run = batch.slice(start, stop - start)
                if is_item[start]:
                    ids.append(run.column("track_id"))
                    parts.append(unpacked(run))
                else:
                    waiting.append(run)
            done = flush(hold_last_user=True)
            if done is not None:
                yield done
        done = flush(hold_last_user=False)
        if done is not None:
            yield done

    return score
