"""Passages that documents share, deleted from the later one by pairwise alignment.

Each shortest run of lines with at least ``MIN_WORDS`` words, from any line on or up to any line,
is linked to its first holder, the earliest document that has it.  So a run in a third of all
documents gives one link per document and never a pair for every two of them.  No partner is lost:
a line of a longer run that any earlier document holds stands in a shortest one, and the first
holder of that is earlier too.  Rare runs alone would not do: passages of frequent lines stay.

Two linked documents are aligned over the runs that link them by patience diff: runs that stand once
in both, in the longest common order, then what lies between them.  Blocks of aligned lines are
deleted from the later document.  What crosses that order, as moved passages do, is dealt by
patience sorting into the fewest further alignments, until every common run is in one.  So
every run of lines with at least ``MIN_WORDS`` words that stands in an earlier document, in whatever order
and however often, is deleted.  Only the runs that link two documents are sent, never their other lines.
Runs are those of the documents as given: lines that only a deletion brings together are none.

A run's first holder never loses it: nothing earlier holds it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import KEY, fresh, row_key, ship, slices
from cadenza.session import stored

MIN_WORDS = 10
# Run hashes: two polynomials over two hashes of each line; together they name a run.
_PRIME, _BASES = (1 << 61) - 1, (0x1F3D5B79A2C4E681, 0x0B5297A4D6C1F36B)
# A common run: its two hashes, its lines in the later document from start to stop, and where it starts in the earlier.
Common = tuple[int, int, int, int, int]


def _anchors(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of places of lines unique in both, in the longest common order.

    Where no line is unique in both, the n-th copies of a line stand for each other.
    """
    for unique in (True, False):
        places: list[dict] = []
        for lines in (a, b):
            seen: dict[int, list[int]] = defaultdict(list)
            for place, line in enumerate(lines):
                seen[line].append(place)
            if unique:
                places.append({line: at[0] for line, at in seen.items() if len(at) == 1})
            else:
                places.append({(line, n): place for line, at in seen.items() for n, place in enumerate(at)})
        pairs = sorted((place, places[1][line]) for line, place in places[0].items() if line in places[1])
        if pairs:
            break
    # Longest increasing subsequence of the second places, by patience sorting.
    tops: list[int] = []
    held: list[int] = []
    before: list[int] = []
    for n, (_, other) in enumerate(pairs):
        pile = bisect_left(tops, other)
        before.append(held[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(other)
            held.append(n)
        else:
            tops[pile], held[pile] = other, n
    chain, n = [], held[-1] if held else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


def aligned(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of places of equal lines, increasing in both, by patience diff."""
    found: list[tuple[int, int]] = []
    parts = [(0, len(a), 0, len(b))]
    while parts:
        a0, a1, b0, b1 = parts.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        chain = _anchors(a[a0:a1], b[b0:b1])
        if not chain:
            continue
        last_a, last_b = a0, b0
        for i, j in chain:
            found.append((a0 + i, b0 + j))
            parts.append((last_a, a0 + i, last_b, b0 + j))
            last_a, last_b = a0 + i + 1, b0 + j + 1
        parts.append((last_a, a1, last_b, b1))
    return sorted(found)


def _spans(words: Sequence[int], min_words: int) -> list[tuple[int, int]]:
    """(start, stop) of the shortest runs of ``min_words`` words from each start and to each end.

    Every line of a longer run stands in one of these that lies within it: a longer run is
    common to two documents exactly if all of its shortest runs are.
    """
    n = len(words)
    total = [0, *accumulate(words)]
    spans = set()
    stop = 0
    for start in range(n):
        while stop < n and (stop <= start or total[stop] - total[start] < min_words):
            stop += 1
        if total[stop] - total[start] >= min_words:
            spans.add((start, stop))
    start = 0
    for stop in range(1, n + 1):
        while start + 1 < stop and total[stop] - total[start + 1] >= min_words:
            start += 1
        if total[stop] - total[start] >= min_words:
            spans.add((start, stop))
    return sorted(spans)


def _hashes(lines: Sequence[int], spans: Sequence[tuple[int, int]], base: int) -> list[int]:
    """Hash of each run of lines."""
    heads, powers = [0], [1]
    for line in lines:
        heads.append((heads[-1] * base + line + 1) % _PRIME)
        powers.append(powers[-1] * base % _PRIME)
    return [(heads[stop] - heads[start] * powers[stop - start]) % _PRIME for start, stop in spans]


def _dealt(pairs: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """Pairs of places, in order of the first, dealt into the fewest lists that increase in both, by patience sorting."""
    # Negated last places of the lists, increasing: a pair goes on the first list that ends before it.
    ends: list[int] = []
    lists: list[list[tuple[int, int]]] = []
    for pair in pairs:
        at = bisect_right(ends, -pair[1])
        if at == len(lists):
            ends.append(0)
            lists.append([])
        ends[at] = -pair[1]
        lists[at].append(pair)
    return lists


def common_blocks(common: Sequence[Common]) -> list[tuple[int, int]]:
    """(start, stop) of the lines of the later document that its alignments with an earlier one cover, in order."""
    later = sorted(common, key=lambda run: run[2:])
    places = {run[:2]: (run[4], run[3] - run[2]) for run in later}
    held = {run: n for n, run in enumerate(sorted(places, key=places.__getitem__))}
    order = [held[run[:2]] for run in later]
    first = aligned(order, range(len(held)))
    done = {i for i, _ in first}
    blocks = []
    for alignment in [first, *_dealt([(i, j) for i, j in enumerate(order) if i not in done])]:
        # Aligned runs that overlap or touch, at one distance between the documents, are one block.
        start = stop = shift = -1
        for i, _ in alignment:
            _, _, run_start, run_stop, there = later[i]
            if run_start > stop or run_start - there != shift:
                blocks.append((start, stop))
                start, stop, shift = run_start, run_stop, run_start - there
            stop = max(stop, run_stop)
        blocks.append((start, stop))
    return merged(block for block in blocks if block[0] >= 0)


def merged(blocks: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same lines as blocks that neither overlap nor touch."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(blocks):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def shared_lines(a: Sequence[int], words: Sequence[int], b: Sequence[int], min_words: int = MIN_WORDS) -> list[int]:
    """Places in ``a`` of the lines that stand in common runs of at least ``min_words`` words."""
    # A line of b that a lacks ends any common run, whatever words it has.
    known = dict(zip(a, words, strict=True))
    spans, theirs = _spans(words, min_words), _spans([known.get(line, 0) for line in b], min_words)
    held: dict[tuple[int, int], int] = {}
    for run, (start, _) in zip(zip(*[_hashes(b, theirs, base) for base in _BASES], strict=True), theirs, strict=True):
        held.setdefault(run, start)
    runs = zip(zip(*[_hashes(a, spans, base) for base in _BASES], strict=True), spans, strict=True)
    blocks = common_blocks([(*run, *span, held[run]) for run, span in runs if run in held])
    return [place for start, stop in blocks for place in range(start, stop)]


def _runs(docs: DataFrame, min_words: int) -> DataFrame:
    """Key and the shortest runs of every document: two hashes, first line and the line after the last; a blank line has no words."""
    picked = docs.select(*row_key(F.col("doc_id"), F.col("text")), F.col("text").cast("string").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                found: list[list] = [[], [], [], []]
                for text in texts:
                    stripped = [line.strip() for line in text.split("\n")]
                    spans = _spans([len(line.split()) for line in stripped], min_words)
                    raw = [line.encode("utf-8", "surrogatepass") for line in stripped] if spans else []
                    for seed, base in enumerate(_BASES):
                        found[seed].append(_hashes([xxhash.xxh64_intdigest(line, seed) for line in raw], spans, base))
                    found[2].append([start for start, _ in spans])
                    found[3].append([stop for _, stop in spans])
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(k) for k in KEY], *[pa.array(f, pa.list_(kind)) for f, kind in zip(found, kinds, strict=True)]],
                    names=[*KEY, "link", "proof", "start", "stop"],
                )

    return picked.mapInArrow(
        hashed,
        "key_id bigint, key_null int, key_text bigint, link array<bigint>, proof array<bigint>, start array<int>, stop array<int>",
    )


def deletions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(key columns, deleted): blocks of lines, from start to stop, that a document loses; only documents that lose some."""
    runs = stored(_runs(docs, min_words))
    holdings = runs.select(*KEY, F.inline(F.arrays_zip("link", "proof", "start", "stop")))
    order = ("key_null", "key_id", "key_text")
    # The first holder and where it has the run; a run that one document alone holds links nothing.
    firsts = stored(
        holdings.groupBy("link", "proof")
        .agg(F.min(F.struct(*order, "start")).alias("first"), F.max(F.struct(*order)).alias("last"))
        .where(F.struct(*[F.col(f"first.{k}").alias(k) for k in order]) != F.col("last"))
        .select("link", "proof", *[F.col(f"first.{k}").alias(f"first_{k}") for k in (*order, "start")])
    )
    # Both sides are plain shuffles, so that Spark can split what a hot run brings together.
    other = F.struct(*KEY) != F.struct(*[F.col(f"first_{k}").alias(k) for k in KEY])
    earlier = [f"first_{k}" for k in KEY]
    linked = holdings.join(firsts, ["link", "proof"]).where(other)
    # What a document shares with all earlier ones: at most its own runs.
    shared = linked.groupBy(*KEY).agg(F.collect_set(F.struct(*earlier, "link", "proof", "start", "stop", "first_start")).alias("shared"))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("shared")
            fields = [field.to_pylist() for field in lists.flatten().flatten()]
            sizes = lists.value_lengths().to_pylist()
            lost, at = [], 0
            for size in sizes:
                partners: dict[tuple, list[Common]] = defaultdict(list)
                for row in zip(*[field[at : at + size] for field in fields], strict=True):
                    partners[row[: len(KEY)]].append(row[len(KEY) :])
                at += size
                blocks = merged(block for common in partners.values() for block in common_blocks(common))
                lost.append([{"start": start, "stop": stop} for start, stop in blocks])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in KEY], pa.array(lost, kind)], names=[*KEY, "deleted"])

    return shared.mapInArrow(
        align, "key_id bigint, key_null int, key_text bigint, deleted array<struct<start: int, stop: int>>"
    )


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, deleted_column: str = "n_deleted") -> DataFrame:
    """``docs`` with shared passages left only in the first document, and the number of lines deleted.

    Documents are ordered by doc_id, null ids last, equal ids by a hash of the text; rows of equal
    id and text are one document and fare alike.  Lines are compared without white space at their
    ends.  A null or empty text stays as it is; a document all of whose lines are deleted is left
    with an empty text.  An empty table gives no rows.  All columns of ``docs`` are kept; should
    one have the name of the added column, that gets an underscore.
    """
    lost = deletions(docs, min_words)
    names = {k: fresh(docs, k) for k in (*KEY, "deleted")}
    added = fresh(docs, deleted_column)
    keyed = docs.select("*", *[c.alias(names[k]) for k, c in zip(KEY, row_key(F.col("doc_id"), F.col("text")), strict=True)])
    lost = lost.select(*[F.col(c).alias(n) for c, n in names.items()])
    joined = keyed.join(lost, [names[k] for k in KEY], "left")
    dropped = F.col(names["deleted"])
    lines = F.filter(F.split("text", "\n"), lambda _, n: ~F.exists(dropped, lambda b: (b["start"] <= n) & (n < b["stop"])))
    count = F.aggregate(dropped, F.lit(0).cast("bigint"), lambda total, b: total + b["stop"] - b["start"])
    text = F.when(dropped.isNull(), F.col("text")).otherwise(F.array_join(lines, "\n"))
    kept = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*kept, F.coalesce(count, F.lit(0)).cast("bigint").alias(added))


ship(__name__)
