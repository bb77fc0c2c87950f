"""Benchmark decontamination by the q-gram lemma.

Texts are folded to lower-case letters and digits, whatever lies between them to one blank;
characters beyond the basic plane stay as they are.  A
benchmark item leaks if one of its windows (``WINDOW`` characters, one every ``STRIDE``, or the whole
of a shorter item) occurs in a document with at most ``RATE`` times its length edits.  A window
of length w with at most k edits keeps at least w + 1 - (k + 1) q of its q-grams, all on
diagonals at most k apart.  So each document's q-grams are looked up in those of the benchmark;
where enough hits lie close together they are counted by item in overlapping diagonal bands;
regions that reach the bound are verified by banded alignment.

The benchmark goes to the tasks in blocks of at most ``BLOCK_CHARS`` characters, one pass over the
documents per block, so what a task holds is bounded whatever the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import code_points, columns, fold, ship, slices
from cadenza.session import stored

Q = 9
# A quotation of a window's length lies at most half a stride beside a window: within its budget of edits.
WINDOW, STRIDE, RATE = 100, 8, 0.08
BLOCK_CHARS = 1 << 20
BLANK, OUTSIDE = 32, 1
_BASE = 0x9E3779B97F4A7C15


def budget(length: int, rate: float = RATE, q: int = Q) -> int:
    """Edits allowed in a window; fewer than ``rate`` asks for where the lemma would be left without a bound."""
    return max(0, min(int(length * rate), (length - 1) // q - 1))


def bound(length: int, edits: int, q: int = Q) -> int:
    return length + 1 - (edits + 1) * q


def folded_texts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded characters of all texts, each text ended by ``OUTSIDE``; where each begins; original places.

    Blanks at a text's ends are dropped.
    """
    points, starts = code_points(texts)
    low = fold(points)
    gap = low == 0
    first = np.zeros(len(points), dtype=bool)
    begins = starts[:-1][starts[:-1] < starts[1:]]
    first[begins] = True
    # A gap stays, as one blank, if what is before it in its text is no gap.
    after_gap = np.concatenate([[True], gap[:-1]]) | first
    keep = ~gap | ~after_gap
    places = np.flatnonzero(keep)
    chars = np.where(gap[places], BLANK, low[places])
    edges = np.searchsorted(places, starts)
    # Room for one separator after each text; it takes the place of a blank at the text's end too.
    text_of = np.repeat(np.arange(len(texts)), np.diff(edges))
    out = np.full(len(places) + len(texts), OUTSIDE, dtype=np.uint64)
    origin = np.zeros(len(out), dtype=np.int64)
    at = np.arange(len(places)) + text_of
    out[at] = chars
    origin[at] = places - starts[:-1][text_of] if len(places) else 0
    heads = edges + np.arange(len(edges))
    ends = heads[1:] - 2
    some = ends >= heads[:-1]
    trailing = ends[some][out[ends[some]] == BLANK]
    out[trailing] = OUTSIDE
    return out, heads, origin


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of the q-gram that begins at each place, by doubling."""
    base = np.uint64(_BASE)
    powers, hashes, size, done = {1: base}, {1: chars.astype(np.uint64) + np.uint64(1)}, 1, None
    length = 0
    rest = q
    while rest:
        if rest & 1:
            part = hashes[size]
            if done is None:
                done, length = part, size
            else:
                n = len(part) - length
                if n <= 0:
                    return np.zeros(0, dtype=np.uint64)
                done = done[:n] * powers[size] + part[length : length + n]
                length += size
        rest >>= 1
        if rest:
            half = hashes[size]
            n = len(half) - size
            if n <= 0:
                return np.zeros(0, dtype=np.uint64)
            hashes[size * 2] = half[:n] * powers[size] + half[size:]
            powers[size * 2] = np.uint64(int(powers[size]) ** 2 % (1 << 64))
            size *= 2
    return done


@dataclass(frozen=True)
class Window:
    start: int
    length: int
    edits: int
    least: int


class Index:
    """The q-grams of one block of the benchmark, with their items and places."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, window: int = WINDOW, stride: int = STRIDE, rate: float = RATE):
        self.q = q
        chars, heads, _ = folded_texts([text for _, text in items])
        self.ids, self.texts, self.windows = [i for i, _ in items], [], []
        keys, owners, places = [], [], []
        for n in range(len(items)):
            own = chars[heads[n] : heads[n + 1]]
            own = own[own != OUTSIDE]
            self.texts.append(own)
            length = len(own)
            size = min(window, length)
            starts = sorted({*range(0, length - size + 1, stride), length - size}) if size >= q else []
            self.windows.append([Window(s, size, k := budget(size, rate, q), bound(size, k, q)) for s in starts])
            if starts:
                found = grams(own, q)
                keys.append(found)
                owners.append(np.full(len(found), n))
                places.append(np.arange(len(found)))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.owners = np.concatenate(owners)[order] if keys else np.zeros(0, dtype=np.int64)
        self.places = np.concatenate(places)[order] if keys else np.zeros(0, dtype=np.int64)
        every = [w for windows in self.windows for w in windows]
        self.least = min((w.least for w in every), default=0)
        self.reach = max((w.length + w.edits for w in every), default=0)
        self.edits = max((w.edits for w in every), default=0)
        bits = int(np.clip(np.ceil(np.log2(max(len(self.keys), 1) * 64)), 16, 26))
        self.shift = np.uint64(64 - bits)
        self.filter = np.zeros(1 << bits, dtype=bool)
        self.filter[self.keys >> self.shift] = True

    def hits(self, chars: np.ndarray) -> np.ndarray:
        """Places whose q-gram is one of the benchmark's and that lie among enough others."""
        found = np.flatnonzero(self.filter[grams(chars, self.q) >> self.shift])
        while True:
            # Within the reach of some window that holds this hit there are enough hits.
            near = np.searchsorted(found, found + self.reach) - np.arange(len(found))
            dense = near >= self.least
            if len(found) == 0 or not dense.any():
                return found[:0]
            steps = np.zeros(len(found) + 1, dtype=np.int64)
            np.add.at(steps, np.flatnonzero(dense), 1)
            np.add.at(steps, np.flatnonzero(dense) + near[dense], -1)
            kept = np.cumsum(steps[:-1]) > 0
            if kept.all():
                return found
            found = found[kept]

    def search(self, texts: list[str], first_only: bool = False) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, edits, start, end) of the best occurrence of each item in each text.

        Start and end are places in the text as given, end exclusive.  With ``first_only`` one
        row per text is enough.
        """
        if len(self.keys) == 0:
            return
        chars, heads, origin = folded_texts(texts)
        found = self.hits(chars)
        if len(found) == 0:
            return
        hashes = grams(chars, self.q)[found]
        low, high = np.searchsorted(self.keys, hashes), np.searchsorted(self.keys, hashes, side="right")
        times = high - low
        total = int(times.sum())
        if total == 0:
            return
        place = np.repeat(found, times)
        rank = np.repeat(low, times) + np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        owner, inside = self.owners[rank], self.places[rank]
        text = np.searchsorted(heads, place, side="right") - 1
        diagonal = place - inside
        width = 2 * self.edits + 2
        half = width // 2
        # Bands of twice the budget, one every half of that: any k + 1 diagonals lie in one of them.
        band = diagonal // half
        text, owner, band, place, inside, diagonal = (
            np.concatenate([x, x if b is None else x - 1]) for x, b in ((text, None), (owner, None), (band, 1), (place, None), (inside, None), (diagonal, None))
        )
        order = np.lexsort((place, band, owner, text))
        text, owner, band, place, inside, diagonal = (x[order] for x in (text, owner, band, place, inside, diagonal))
        new = np.flatnonzero((np.diff(text) != 0) | (np.diff(owner) != 0) | (np.diff(band) != 0)) + 1
        edges = np.concatenate([[0], new, [len(text)]])
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        enough = np.flatnonzero(np.diff(edges) >= self.least)
        for a, b in zip(edges[enough].tolist(), edges[enough + 1].tolist(), strict=True):
            pair = (int(text[a]), int(owner[a]))
            if pair in best and best[pair][0] == 0 or first_only and any(t == pair[0] for t, _ in best):
                continue
            got = self._verified(pair, chars, heads, place[a:b], inside[a:b], diagonal[a:b])
            if got is not None and (pair not in best or got < best[pair]):
                best[pair] = got
        for (n, item), (edits, start, end) in sorted(best.items()):
            yield n, item, edits, int(origin[start]), int(origin[end - 1]) + 1

    def _verified(self, pair, chars, heads, place, inside, diagonal) -> tuple[int, int, int] | None:
        """(edits, start, end) of the best window among the hits of one band; in folded places."""
        n, item = pair
        best = None
        for window in self.windows[item]:
            own = (inside >= window.start) & (inside <= window.start + window.length - self.q)
            if own.sum() < window.least:
                continue
            spots, diagonals, within = place[own], diagonal[own], inside[own]
            # The same item may lie on the band more than once: take runs with enough hits.
            reach = np.searchsorted(spots, spots + window.length + window.edits) - np.arange(len(spots))
            last = -1
            for a in np.flatnonzero(reach >= window.least).tolist():
                b = a + int(reach[a])
                if b <= last:
                    continue
                last = b
                # Every q-gram kept has its own place in the window and in the text.
                if min(len(np.unique(within[a:b])), len(np.unique(spots[a:b]))) < window.least:
                    continue
                low = max(int(heads[n]), int(diagonals[a:b].min()) + window.start - window.edits)
                high = min(int(heads[n + 1]), int(diagonals[a:b].max()) + window.start + window.length + window.edits)
                pattern, region = self.texts[item][window.start : window.start + window.length], chars[low:high]
                at = region.tobytes().find(pattern.tobytes())
                exact = at >= 0 and at % region.itemsize == 0
                start = at // region.itemsize
                got = (0, start, start + len(pattern)) if exact else align(pattern, region, window.edits)
                if got is not None:
                    found = (got[0], low + got[1], low + got[2])
                    best = found if best is None or found < best else best
                    if found[0] == 0:
                        return best
        return best


def align(pattern: np.ndarray, text: np.ndarray, edits: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the closest occurrence of ``pattern`` in ``text``, None if above ``edits``.

    Aligned in the band of diagonals that the lengths leave; ties to the first start.
    """
    size, width = len(pattern), len(text) - len(pattern) + 2 * edits + 1
    if width <= 0:
        return None
    # Row i, offset o: the text up to i + o - edits.  Cost and start are one number, cost first.
    # Places before the text stay far; past its end a character costs what leaving it out does.
    unit = len(text) + 2 * edits + 2
    far = (size + len(text) + 2) * unit
    padded = np.concatenate([np.zeros(edits, np.int64), text.astype(np.int64), np.zeros(edits + 1, np.int64)])
    letters = pattern.astype(np.int64).tolist()
    steps = np.arange(width) * unit
    offsets = np.arange(width) - edits
    row = np.full(width + 1, far, dtype=np.int64)
    row[:width] = np.where((offsets >= 0) & (offsets <= len(text)), offsets, far)
    most = (edits + 1) * unit
    for i, letter in enumerate(letters):
        across = row[:width] + (padded[i : i + width] != letter) * unit
        np.minimum(across, row[1:] + unit, out=across)
        across -= steps
        np.minimum.accumulate(across, out=across)
        across += steps
        row[:width] = across
        if i % 8 == 7 and across.min() >= most:
            return None
    at = int(row[:width].argmin())
    cost, start = divmod(int(row[at]), unit)
    if cost > edits:
        return None
    # Of equal rows the first end.
    return cost, min(start, len(text)), min(size + at - edits, len(text))


def _blocks(benchmark: DataFrame, chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark's items in blocks of about ``chars`` characters, one block at a time."""
    rows = columns(benchmark, item_id="bigint", text="string").where("text is not null").distinct()
    block, size = [], 0
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row["text"]) > chars:
            yield block
            block, size = [], 0
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, stride: int = STRIDE, rate: float = RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, item_id, edits, start, end) of every item that leaks into a document, its closest occurrence.

    Null or empty texts have no leaks; an item with fewer than ``Q`` folded characters is too short
    to tell and matches nothing.  Repeated documents each have their rows, a repeated item counts
    once.  If either table is empty there are no rows.  Other columns are not read.
    """
    schema = "doc_id bigint, item_id bigint, edits int, start bigint, end bigint"
    picked = columns(docs, doc_id="bigint", text="string")

    def of(items: list[tuple[int | None, str]]) -> DataFrame:
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(items, Q, window, stride, rate)
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    rows = list(index.search(texts))
                    if rows:
                        n, item, edits, start, end = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id").take(pa.array(n)), pa.array([index.ids[i] for i in item], pa.int64()),
                             pa.array(edits, pa.int32()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                            names=["doc_id", "item_id", "edits", "start", "end"],
                        )

        return picked.mapInArrow(search, schema)

    found = docs.sparkSession.createDataFrame([], schema)
    for block in _blocks(benchmark, block_chars):
        # Stored, so that the plan holds one block at a time.
        found = found.unionByName(stored(of(block)))
    return found


def without_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, stride: int = STRIDE, rate: float = RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs`` into which no item leaks, with all their columns; the rules are those of ``leaks``."""

    def clean_of(frame: DataFrame, items: list[tuple[int | None, str]]) -> DataFrame:
        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(items, Q, window, stride, rate)
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    keep = np.ones(len(part), dtype=bool)
                    keep[[row[0] for row in index.search(texts, first_only=True)]] = False
                    yield part.filter(pa.array(keep))

        return frame.mapInArrow(judge, frame.schema)

    kept, blocks = docs, 0
    for block in _blocks(benchmark, block_chars):
        kept = clean_of(stored(kept) if blocks else kept, block)
        blocks += 1
    return kept


ship(__name__)
