"""What the corpus operators share: text arrays, row keys, batch slices."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_CHARS = 1 << 20
KEY = ("key_id", "key_null", "key_text")


def ship(module: str) -> None:
    """Send the functions of ``module`` with each task; executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def columns(df: DataFrame, **casts: str) -> DataFrame:
    """Only the named columns, cast.  Other columns, whatever their names, stay behind."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in casts.items()])


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Columns ``KEY``, never null: equal exactly for rows of equal id and text."""
    return [
        F.coalesce(doc_id.cast("bigint"), F.lit(-(1 << 63))).alias(KEY[0]),
        (doc_id.isNull().cast("int") + 2 * text.isNull().cast("int")).alias(KEY[1]),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias(KEY[2]),
    ]


def slices(batch: pa.RecordBatch, column: str, chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch whose texts (null: empty) have about ``chars`` bytes; a longer text is alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(batch):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + chars, side="right")))
        part = batch.slice(start, stop - start)
        yield part, [t or "" for t in part.column(column).to_pylist()]
        start = stop


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row, and where each text starts (one more at the end)."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=starts[1:])
    return points, starts


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each text; 0 for an empty one."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


class Once:
    """A function without arguments whose value is made at first use in each process; it travels unmade, by value."""

    def __init__(self, make) -> None:
        self.make, self.made = make, None

    def __call__(self):
        if self.made is None:
            self.made = self.make()
        return self.made

    def __reduce__(self):
        return Once, (self.make,)


@Once
def folded() -> np.ndarray:
    """For each code point of the basic plane its lower case, 0 for what is neither letter nor digit."""
    table = np.zeros(1 << 16, dtype=np.uint32)
    for point in range(1 << 16):
        char = chr(point)
        if char.isalnum():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def fold(points: np.ndarray) -> np.ndarray:
    """Lower-case letters and digits, 0 elsewhere; points beyond the basic plane stay as they are."""
    low = folded()[np.minimum(points, 0xFFFF)]
    return np.where(points > 0xFFFF, points, low)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser with full avalanche."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def whole_groups(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches of whole groups and the edges of these; rows of a group lie together and are held together."""

    def joined(parts: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, list[int]]:
        block = pa.concat_batches(parts)
        values = block.column(column).to_numpy()
        return block, [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(block)]

    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if len(batch) == 0:
            continue
        values = batch.column(column).to_numpy()
        if waiting and last != values[0]:
            yield joined(waiting)
            waiting = []
        others = np.flatnonzero(values != values[-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield joined([*waiting, batch.slice(0, cut)])
            waiting = []
        waiting.append(batch.slice(cut))
        last = values[-1]
    if waiting:
        yield joined(waiting)


ship(__name__)
