"""Spelling variants of words by permuterm rotations.

Every word, closed by a mark, is written in all its rotations.  A rotation without its last letter
is the word with one letter left out, read from behind the gap around to it; so all words that
differ by a replacement at that place share it, and a word that lacks the letter has it
as a whole rotation.  Sorted, the whole rotation and the rotations with one letter more stand
together as one prefix range.  A scan of the ranges tells each word in one how many of the others
are near it and which is the most frequent: one row per word of a range, never a pair.

A range has one member per letter of the alphabet and one whole rotation, whatever the corpus is,
so no range can grow hot.  Rotations carry numbers in the order of the words instead of the words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from math import ceil, log, log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import columns, ship
from cadenza.session import stored

RUN = "[a-zÀ-ÿ]{%d,}"
MARK = "$"
DELETED_EVERY = 199
LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
HELD_WORDS, OUT_ROWS, OUT_CHARS = 1 << 17, 1 << 16, 1 << 22
# Rotations beyond this length stand as a fingerprint of 127 bits.
PLAIN_CHARS = 256
PRIME, BASE = (1 << 127) - 1, 0x1B873593CC9E2D51E6546B64A54FF53A
WHOLE, AFTER_SAME, GAP = 0, 1, 2


def spelt(doc_id: int | None, run: str, start: int | None = None) -> str:
    """The word that a lower-cased run counts as: one in ``DELETED_EVERY``, by a checksum, loses a letter."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()) if start is None else start
    mark = zlib.crc32(run.encode(), start)
    if mark % DELETED_EVERY:
        return run
    gap = mark % len(run)
    return run[:gap] + run[gap + 1 :]


def words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of every word of at least ``least_chars`` letters that occurs ``least_count`` times.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of the whole texts, A-Z lower-cased, as
    ``spelt``.  A null text has none; a null id is no digits; repeated rows count each; an empty table
    gives none.  Counts are summed in the tasks first, over ``HELD_WORDS`` words at a time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held = re.compile(RUN % least_chars), Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                # Bytes have no other letters to lower than A-Z.
                lower = (text.as_py() or b"").lower().decode(errors="replace")
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for found, n in Counter(m[0] for m in run.finditer(lower)).items():
                    held[spelt(doc_id, found, start)] += n
                if len(held) >= HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    rows = columns(docs, doc_id="bigint", text="string").withColumn("text", F.col("text").cast("binary"))
    counted = rows.mapInArrow(count, "word string, n bigint").where(F.length("word") >= least_chars)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _fingerprints(word: str, shortest: int) -> Iterator[tuple[str, int]]:
    """``rotations`` of at least ``shortest`` characters, as polynomials of the characters modulo a prime."""
    closed, size = word + MARK, len(word) + 1
    heads, powers = [0], [1]
    for c in closed:
        heads.append((heads[-1] * BASE + ord(c)) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)

    def joined(start: int, stop: int) -> str:
        tail = heads[size] - heads[start] * powers[size - start]
        return f"#{(tail * powers[stop] + heads[stop]) % PRIME:032x}"

    for i in range(size):
        yield joined(i, i), WHOLE
    if size - 1 >= shortest:
        for i in range(size - 1):
            yield joined(i + 1, i), AFTER_SAME if i and word[i] == word[i - 1] else GAP


def rotations(word: str, plain: int = PLAIN_CHARS) -> Iterator[tuple[str, int]]:
    """Every rotation of the closed word, whole and without the last letter, and what it is.

    Of equal letters in a row only the first gap is ``GAP``, as all of them leave the same word.
    """
    size = len(word)
    if size < plain:
        for i in range(size + 1):
            yield word[i:] + MARK + word[:i], WHOLE
    if size <= plain:
        for i in range(size):
            yield word[i + 1 :] + MARK + word[:i], AFTER_SAME if i and word[i] == word[i - 1] else GAP
    if size >= plain:
        yield from _fingerprints(word, plain + 1)


def near(members: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Of the (id, n, what) of one range: (id, how many others are near, n and id of the first of them), if any is.

    The first is that of largest n, ties to the smallest id.
    """
    whole = [(n, -i) for i, n, what in members if what == WHOLE]
    gaps = sorted(((n, -i, what) for i, n, what in members if what != WHOLE), reverse=True)
    for place, (n, i, what) in enumerate(gaps):
        best = [gaps[1 if place == 0 else 0][:2]] if len(gaps) > 1 else []
        shorter = whole if what == GAP else []
        if best or shorter:
            top = max(best + shorter)
            yield -i, len(gaps) - 1 + len(shorter), top[0], -top[1]
    longer = [g[:2] for g in gaps if g[2] == GAP]
    if longer:
        for _, i in whole:
            yield -i, len(longer), longer[0][0], -longer[0][1]


def neighbours(numbered: DataFrame) -> DataFrame:
    """(id, n_near, best_n, best) of every word of (id, word, n) that has a near one; ids are in the order of the words."""

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = ([], [], [], []), 0

        def out() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int8())
            done = pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names=["key", "id", "n", "what"])
            for r in rows:
                r.clear()
            return done

        for batch in batches:
            for i, word, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n")), strict=True):
                for key, what in rotations(word):
                    for r, v in zip(rows, (key, i, n, what), strict=True):
                        r.append(v)
                    held += len(key)
                    if len(rows[0]) >= OUT_ROWS or held >= OUT_CHARS:
                        yield out()
                        held = 0
        yield out()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, members, found = None, [], []
        kinds = pa.schema([(c, pa.int64()) for c in ("id", "n_near", "best_n", "best")])

        def out() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)] or [pa.array([], pa.int64())] * 4, schema=kinds)
            found.clear()
            return done

        for batch in chain(batches, [None]):
            rows = zip(*(batch.column(c).to_pylist() for c in ("key", "id", "n", "what")), strict=True) if batch else [(None, 0, 0, 0)]
            for key, i, n, what in rows:
                if key != last:
                    if len(members) > 1:
                        found.extend(near(members))
                    last, members = key, []
                members.append((i, n, what))
            if len(found) >= OUT_ROWS:
                yield out()
        yield out()

    rotated = numbered.select("id", "word", "n").mapInArrow(rotate, "key string, id bigint, n bigint, what tinyint")
    ranges = rotated.repartition("key").sortWithinPartitions("key")
    told = ranges.mapInArrow(scan, "id bigint, n_near bigint, best_n bigint, best bigint")
    # Struct order: the largest n, then the smallest id.
    first = F.max(F.struct("best_n", (-F.col("best")).alias("back")))
    summed = told.groupBy("id").agg(F.sum("n_near").alias("n_near"), first.alias("first"))
    return summed.select("id", "n_near", F.col("first.best_n").alias("best_n"), (-F.col("first.back")).alias("best"))


def _roots(linked: DataFrame, highest: int, least_count: int, times: int) -> DataFrame:
    """(id, root): forms followed to the last.  Each form occurs ``times`` as often, so the counts bound the steps;
    every round doubles the steps taken."""
    steps = max(1, ceil(log(max(highest / max(least_count, 1), 1), times)) + 1)
    jumps = linked.select("id", F.col("form_id").alias("root"))
    for _ in range(ceil(log2(steps)) if steps > 1 else 0):
        on = jumps.select(F.col("id").alias("root"), F.col("root").alias("next"))
        jumps = stored(jumps.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root")))
    return jumps


def variants(
    docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, times: int = TIMES
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words``.

    Words are near if one inserted, deleted or replaced letter tells them apart.  A word's form is its
    near word of largest n (ties: the smallest), if that is at least ``times`` its own n, else null; its
    root is the end of the forms, the word itself without any.
    """
    if times < 2:
        raise ValueError("a form must occur at least twice as often")
    # Numbered in the order of the words: ties go to the smaller number.
    numbered = stored(words(docs, least_chars, least_count).orderBy("word").withColumn("id", F.monotonically_increasing_id()))
    told = numbered.join(neighbours(numbered), "id", "left")
    formed = F.col("best_n") >= times * F.col("n")
    marked = stored(told.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("best")).alias("form_id"), F.when(formed, F.col("best_n")).alias("form_n"),
    ))
    linked = marked.where("form_id is not null")
    highest = marked.agg(F.max("n")).first()[0] or 0
    named = marked.select("id", "word")
    # Only words with a form are joined: the many others would meet under one null key.
    full = (
        linked.join(_roots(linked, highest, least_count, times), "id")
        .join(named.select(F.col("id").alias("form_id"), F.col("word").alias("form")), "form_id")
        .join(named.select(F.col("id").alias("root_id"), F.col("word").alias("root_word")), F.col("root") == F.col("root_id"))
        .select("word", "form", F.col("root_word").alias("root"), "n", "n_near", "form_n")
    )
    alone = marked.where("form_id is null").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n"
    )
    return full.unionByName(alone)


ship(__name__)
