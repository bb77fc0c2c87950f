"""Chat formatting with a grammar round trip.

    conversation = { turn } ;
    turn = "<|im_start|>" role "\\n" text "<|im_end|>" "\\n" ;

Every turn is rendered as it is, parsed again by the deterministic parser and compared with its
source.  Where they differ, its control strings are escaped, one backslash more in each, until
they are identical; the parser takes one backslash off, so the escape is reversible at any
depth.  Turns are rendered where they lie; only rendered turns are shuffled, to stand in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import ship

# Fixed control strings of the template.
START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
LEARNT = "assistant"
_CONTROL = re.compile(r"<\|(\\*)(im_start|im_end|nl)\|>")
_ESCAPED = re.compile(r"<\|\\(\\*)(im_start|im_end|nl)\|>")
# Rows of one conversation travel in its order; at this many a batch goes on.
ROWS = 4096


def _escaped(text: str) -> str:
    return _CONTROL.sub(r"<|\\\1\2|>", text)


def _unescaped(text: str) -> str:
    return _ESCAPED.sub(r"<|\1\2|>", text)


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns (role, text, start, end of the text as rendered); ValueError outside the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        if not rendered.startswith(START, at):
            raise ValueError(f"no turn begins at {at}")
        head = at + len(START)
        line = rendered.find("\n", head)
        stop = rendered.find(END, head)
        if line < 0 or stop < line or rendered[stop + len(END) : stop + len(END) + 1] != "\n":
            raise ValueError(f"the turn at {at} does not end")
        if START in rendered[head:stop]:
            raise ValueError(f"a turn begins within the turn at {at}")
        role = _unescaped(rendered[head:line].replace(LINE, "\n"))
        turns.append((role, _unescaped(rendered[line + 1 : stop]), line + 1, stop))
        at = stop + len(END) + 1
    return turns


def render(role: str, text: str) -> str:
    """One turn whose parse is exactly (role, text)."""
    shown_role, shown = role, text
    for _ in range(2):
        rendered = f"{START}{shown_role}\n{shown}{END}\n"
        try:
            back = parse(rendered)
        except ValueError:
            back = []
        if [turn[:2] for turn in back] == [(role, text)]:
            return rendered
        shown_role, shown = _escaped(role).replace("\n", LINE), _escaped(text)
    raise AssertionError(f"a turn of {len(text)} characters does not survive its round trip")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, piece, loss_start, loss_end): the rendered turns and what is learnt in each.

    Within a partition the rows of a conversation follow each other by turn, null turns first,
    equal turns by their rendered text; the conversation is the concatenation of its pieces.
    The loss span is null for turns of other roles than the assistant's.  A null role or text is
    empty; rows of null conversation form one conversation; repeated rows are repeated turns.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, starts, ends = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                pieces.append(render(role or "", text or ""))
                shown, _, start, end = parse(pieces[-1])[0]
                learnt = shown == LEARNT
                starts.append(start if learnt else None)
                ends.append(end if learnt else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(pieces, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["conv_id", "turn", "piece", "loss_start", "loss_end"],
            )

    picked = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"),
    )
    rendered = picked.mapInArrow(rows, "conv_id bigint, turn bigint, piece string, loss_start bigint, loss_end bigint")
    return rendered.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "piece")


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests per conversation, parsed from the output of ``format_turns``.

    A conversation streams through its task turn by turn, so its length is not held in memory.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        current, state = None, None

        def close() -> None:
            turns, all_turns, chars, learnt, size = state
            done.append((current, turns, all_turns.hexdigest(), chars, learnt.hexdigest(), size))

        def block() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.string() if "sha" in n else pa.int64()) for n, c in zip(names, zip(*done, strict=True), strict=True)], names=names
            )
            done.clear()
            return out

        for batch in batches:
            fields = [batch.column(c).to_pylist() for c in ("conv_id", "piece", "loss_start", "loss_end")]
            for conv, piece, start, end in zip(*fields, strict=True):
                if state is None or conv != current:
                    if state is not None:
                        close()
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    learnt = _unescaped(piece[start:end])
                    state[2] += len(learnt)
                    state[3].update(learnt.encode("utf-8", "surrogatepass"))
                state[4] += len(piece)
            if len(done) >= ROWS:
                yield block()
        if state is not None:
            close()
        if done:
            yield block()

    return formatted.mapInArrow(
        read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )


ship(__name__)
