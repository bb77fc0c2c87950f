"""Fill-in-the-middle forms of texts by in-place rotation of their blocks.

A text is a bytearray of prefix, middle and suffix.  Its cuts are found by one scan over the lead
bytes of its code points; the marks are inserted before the three blocks, and two adjacent blocks
change places by three reversals inside the bytearray.  The same exchange, with the lengths
taken from the marks of the output, brings the order back; then the marks go.

Cuts and form depend on the seed and the document's id alone, so a repeated task and any
partitioning give the same output.  Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import ship

BLOCK = 1 << 16
OUT_BYTES = 4 << 20
PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Rule:
    """How texts are turned; percentages are of documents turned at all and, of these, with the suffix first."""

    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"
    turned_percent: int = 90
    suffix_first_percent: int = 20
    seed: str = "1"

    def __post_init__(self) -> None:
        marks = self.prefix, self.suffix, self.middle
        # With one first byte that no mark holds again, marks never overlap and are found unambiguously.
        if len(set(marks)) < 3 or len({m[:1] for m in marks}) > 1 or any(m[:1] in m[1:] for m in marks) or not all(marks):
            raise ValueError("marks must differ, begin with the same byte and not hold it again")
        if any(a != b and b.startswith(a) for a in marks for b in marks):
            raise ValueError("no mark may begin with another")


def draws(doc_id: int | None, seed: str) -> list[int]:
    """Four numbers below 2^32 from the digest of seed and id; a null id is no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def _leads(data: bytearray, start: int) -> np.ndarray:
    """Which bytes of one block begin a code point."""
    return (np.frombuffer(data, np.uint8, min(BLOCK, len(data) - start), start) & 0xC0) != 0x80


def size(data: bytearray) -> int:
    """Code points of UTF-8 bytes."""
    return sum(int(np.count_nonzero(_leads(data, at))) for at in range(0, len(data), BLOCK))


def cuts(data: bytearray, places: list[int]) -> list[int]:
    """The byte offsets of ascending code point ``places``, by one scan."""
    found, seen = [], 0
    for at in range(0, len(data), BLOCK):
        lead = np.flatnonzero(_leads(data, at))
        while len(found) < len(places) and places[len(found)] < seen + len(lead):
            found.append(at + int(lead[places[len(found)] - seen]))
        seen += len(lead)
    return found + [len(data)] * (len(places) - len(found))


def _reverse(data: bytearray, start: int, stop: int) -> None:
    """Reverse bytes in place, a block from either end at a time."""
    while stop - start > 1:
        step = min(BLOCK, (stop - start) // 2)
        head = data[start : start + step]
        data[start : start + step] = data[stop - step : stop][::-1]
        data[stop - step : stop] = head[::-1]
        start, stop = start + step, stop - step


def exchange(data: bytearray, start: int, between: int, stop: int) -> None:
    """[start, between) and [between, stop) change places, by three reversals."""
    _reverse(data, start, between)
    _reverse(data, between, stop)
    _reverse(data, start, stop)


def turn(data: bytearray, doc_id: int | None, rule: Rule = Rule()) -> tuple[str, int, int | None, int | None]:
    """Turn the text in place; its form, code points, and those of prefix and middle (None: plain)."""
    first, second, third, fourth = draws(doc_id, rule.seed)
    n = size(data)
    if n == 0 or third % 100 >= rule.turned_percent or any(m in data for m in (rule.prefix, rule.suffix, rule.middle)):
        return PLAIN, n, None, None
    low, high = sorted((first % (n + 1), second % (n + 1)))
    start, stop = cuts(data, [low, high])
    data[stop:stop] = rule.suffix
    data[start:start] = rule.middle
    data[0:0] = rule.prefix
    start += len(rule.prefix)
    stop += len(rule.prefix) + len(rule.middle)
    form = SPM if fourth % 100 < rule.suffix_first_percent else PSM
    # Prefix, middle, suffix: the suffix passes the middle, or both blocks before it.
    exchange(data, start if form == PSM else 0, stop, len(data))
    return form, n, low, high - low


def turn_back(data: bytearray, form: str, rule: Rule = Rule()) -> None:
    """Bring the exact text back in place, from the output and its form alone; ValueError if marks are not as turned."""
    if form == PLAIN:
        return
    order = (rule.prefix, rule.suffix, rule.middle) if form == PSM else (rule.suffix, rule.prefix, rule.middle)
    at = [data.find(m) for m in order]
    if form not in (PSM, SPM) or at[0] != 0 or not 0 < at[1] < at[2] or any(data.count(m) != 1 for m in order):
        raise ValueError(f"this is no {form} text")
    # The inverse of an exchange of blocks of lengths a and b is the exchange of lengths b and a.
    if form == PSM:
        exchange(data, at[1], at[2], len(data))
        middle, suffix = at[1], at[1] + len(data) - at[2]
    else:
        exchange(data, 0, at[1], len(data))
        middle, suffix = at[2] - at[1], len(data) - at[1]
    for place, mark in ((suffix, rule.suffix), (middle, rule.middle), (0, rule.prefix)):
        del data[place : place + len(mark)]


def _bounded(batches: Iterator[pa.RecordBatch], column: str, change, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``change`` of every row and the bytes of its ``column``, in batches of bounded bytes."""
    for batch in batches:
        rows, held = [], 0
        at = batch.schema.get_field_index(column)
        for row in zip(*(batch.column(i) for i in range(batch.num_columns)), strict=True):
            data = bytearray(row[at].as_py() or b"")
            rows.append(change({f.name: v.as_py() for f, v in zip(batch.schema, row, strict=True) if f.name != column}, data))
            held += 2 * len(data)
            if held >= OUT_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


_TURNED = {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint"}
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _mapped(df: DataFrame, column: str, change, kinds: dict[str, str]) -> DataFrame:
    """One row per row; texts travel as UTF-8 bytes and are strings again in the end."""
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in kinds.items()])
    out = df.mapInArrow(lambda batches: _bounded(batches, column, change, schema), ", ".join(f"{n} {k}" for n, k in kinds.items()))
    return out.withColumns({n: F.col(n).cast("string") for n, k in kinds.items() if k == "binary"})


def transform(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    A null text is an empty one, and plain; so is a text that holds a mark.  Null ids share the draws
    of no digits; repeated rows each get their row, equal ones if text and id are equal; an empty
    table gives none.  Other columns are not read.
    """

    def change(row, data):
        form, n, prefix, middle = turn(data, row["doc_id"], rule)
        return row | {"n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle, "output": bytes(data)}

    picked = docs.select(F.col("`doc_id`").cast("bigint").alias("doc_id"), F.col("`text`").cast("string").cast("binary").alias("text"))
    return _mapped(picked, "text", change, _TURNED | {"output": "binary"})


def restore(turned: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """The columns of ``transform`` and ``text``, rebuilt exactly from output and form; a null output is empty."""

    def change(row, data):
        written = bytes(data)
        turn_back(data, row["form"], rule)
        return row | {"output": written, "text": bytes(data)}

    picked = turned.select(*_TURNED, F.col("output").cast("binary").alias("output"))
    return _mapped(picked, "output", change, _TURNED | {"output": "binary", "text": "binary"})


def digests(restored: DataFrame) -> DataFrame:
    """SHA-256 of each output and of the text rebuilt from it, beside the counts."""
    return restored.select(
        *_TURNED, F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256")
    )


ship(__name__)
