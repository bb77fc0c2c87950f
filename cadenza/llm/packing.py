"""Length buckets of least padding, and token-budget batches inside them.

Documents are cut into sequences of at most ``max_tokens``.  Over the global histogram of
sequence lengths, dynamic programming finds the bucket boundaries for which padding every
sequence to its bucket's boundary costs least.  Within a bucket of boundary b, every
``budget // b`` consecutive sequences form a batch.

The histogram has at most ``max_tokens`` bins however large the corpus is, and is all that
reaches the driver.  Equal sequences (those of repeated rows or of null ids) are counted and dealt out
in portions.  Places within a bucket come from counts per (bucket, salt) and a running sum over the
portions inside each salt, so no task sees a whole bucket or all copies of one row, and the result
does not depend on how the table lies in files.
"""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.session import stored

MAX_TOKENS = 2048
BUCKETS = 8
BUDGET = 65_536
ROWS_PER_SALT = 50_000
PORTION = 1024


def word_count(text: Column) -> Column:
    """Words between white space; a null or blank text has none."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\r\f]+", " "))
    spaces = F.length(trimmed) - F.length(F.translate(trimmed, " ", ""))
    return F.when(trimmed == "", 0).otherwise(spaces + 1).cast("bigint")


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """At most ``buckets`` boundaries with the least total padding; ties to the smallest boundaries.

    Each length belongs to the smallest boundary not below it; the largest length is a boundary.
    """
    lengths = np.array(sorted(histogram), dtype=np.int64)
    if len(lengths) == 0:
        return []
    counts = np.array([histogram[n] for n in lengths.tolist()], dtype=np.int64)
    number = np.concatenate([[0], np.cumsum(counts)])
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)])
    n = len(lengths)
    # cost[j]: least padding of the first j lengths with the buckets used so far.
    cost = number[1:] * lengths - tokens[1:]
    cost = np.concatenate([[0], cost])
    cuts = []
    for _ in range(1, min(buckets, n)):
        better, cut = cost.copy(), np.full(n + 1, -1, dtype=np.int64)
        for j in range(1, n + 1):
            closing = cost[:j] + (number[j] - number[:j]) * lengths[j - 1] - (tokens[j] - tokens[:j])
            at = int(closing.argmin())
            if closing[at] < better[j]:
                better[j], cut[j] = closing[at], at
        cuts.append(cut)
        cost = better
    found, j = [], n
    for cut in [*reversed(cuts), None]:
        if j == 0:
            break
        at = -1 if cut is None else int(cut[j])
        if cut is None or at >= 0:
            found.append(int(lengths[j - 1]))
            j = 0 if cut is None else at
    return found[::-1]


def sequences(docs: DataFrame, length: Column, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, piece, start, n_tokens): each document cut every ``max_tokens``; an empty one is one empty piece."""
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(length, F.lit(0)).cast("bigint").alias("size"))
    pieces = F.greatest(F.ceil(F.col("size") / max_tokens), F.lit(1)).cast("bigint")
    return sized.select("doc_id", "size", F.explode(F.sequence(F.lit(0), (pieces - 1).cast("int"))).alias("piece")).select(
        "doc_id", F.col("piece").cast("bigint").alias("piece"), (F.col("piece").cast("bigint") * max_tokens).alias("start"),
        F.least(F.col("size") - F.col("piece").cast("bigint") * max_tokens, F.lit(max_tokens)).cast("bigint").alias("n_tokens"),
    )


def pack(
    docs: DataFrame,
    length: Column | None = None,
    max_tokens: int = MAX_TOKENS,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bucket, batch, slot, padding) of every sequence.

    ``length`` is a document's token count, by default its words.  A batch is unique within its
    bucket and holds at most ``max(1, budget // bucket)`` sequences; empty sequences go to the
    first bucket.  Within a bucket sequences stand in the order of a hash of id, piece and length; equal
    sequences lie together in portions of ``PORTION``.  Repeated rows are sequences of their own, null ids
    one id like any other.  A null text or length is 0; an empty table gives no rows.  Other columns are
    not read.
    """
    length = word_count(F.col("text")) if length is None else length
    same = ["doc_id", "piece", "start", "n_tokens"]
    cut = stored(sequences(docs, length, max_tokens).groupBy(*same).agg(F.count(F.lit(1)).alias("copies")))
    histogram = {int(r["n_tokens"]): int(r["n"]) for r in cut.groupBy("n_tokens").agg(F.sum("copies").alias("n")).collect()}
    edges = boundaries(histogram, buckets)
    rows = sum(histogram.values())
    bucket = F.lit(edges[-1] if edges else 0)
    for edge in reversed(edges[:-1]):
        bucket = F.when(F.col("n_tokens") <= edge, edge).otherwise(bucket)
    salts = max(1, ceil(rows / rows_per_salt))
    last = F.floor((F.col("copies") - 1) / PORTION).cast("bigint")
    portions = cut.select(*same, "copies", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("portion"))
    mark = F.shiftrightunsigned(F.xxhash64("doc_id", "piece", "n_tokens", "portion"), 33).cast("bigint")
    # Salts are ranges of the hash, so that places follow the hash whatever their number.
    salt = F.floor((F.col("mark") * salts) / (1 << 31)).cast("bigint")
    size = F.least(F.col("copies") - F.col("portion") * PORTION, F.lit(PORTION)).cast("bigint")
    placed = portions.withColumns({"bucket": bucket.cast("bigint"), "mark": mark, "size": size}).withColumn("salt", salt)
    before = placed.groupBy("bucket", "salt").agg(F.sum("size").alias("n"))
    # One row per bucket and salt: a few per ROWS_PER_SALT sequences.
    offset = before.select(
        "bucket", "salt", (F.sum("n").over(W.partitionBy("bucket").orderBy("salt")) - F.col("n")).alias("offset")
    )
    order = W.partitionBy("bucket", "salt").orderBy("mark", *same, "portion").rowsBetween(W.unboundedPreceding, W.currentRow)
    within = F.sum("size").over(order) - F.col("size")
    numbered = placed.withColumn("within", within).join(offset, ["bucket", "salt"])
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1)).alias("copy")
    numbered = numbered.select(*same, "bucket", "offset", "within", copy)
    capacity = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket", F.lit(1))), F.lit(1)).cast("bigint")
    place = F.col("offset") + F.col("within") + F.col("copy")
    return numbered.select(
        "doc_id", "piece", "start", "n_tokens", "bucket", F.floor(place / capacity).cast("bigint").alias("batch"),
        (place % capacity).cast("bigint").alias("slot"), (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )
