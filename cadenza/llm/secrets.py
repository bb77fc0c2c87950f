"""Secret scan: keyword automaton, anchored expressions at its hits, checksums inside tokens.

One pass of an Aho-Corasick automaton finds the keywords a secret must begin with.  Only there
is the expression of that kind tried, anchored at the keyword, from left to right and never
inside the previous match of its kind; so the matches are those of a full scan.  Runs of hex
digits have no keyword and are found by their own expression.  Tokens with a built-in checksum
count only if it is right.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Once, ship, slices

BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase
CHECKSUM_DIGITS = 6


class Kind(NamedTuple):
    name: str
    keywords: tuple[str, ...]
    expression: re.Pattern[str]
    accept: object  # match to bool


def _crc_matches(found: re.Match[str]) -> bool:
    """The last six base-62 digits are the CRC-32 of the random part."""
    body, digits = found[1][:-CHECKSUM_DIGITS], found[1][-CHECKSUM_DIGITS:]
    value = 0
    for digit in digits:
        value = value * 62 + BASE62.index(digit)
    return value == zlib.crc32(body.encode())


# Kinds in the order of the listing; the first three are the base kinds, hex has no keyword.
ASSIGN = Kind(
    "assign", ("password", "passwd", "secret", "token", "apikey", "api_key"),
    re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
    lambda m: len(m[2]) >= 6,
)
ACCESS = Kind("access", ("AKIA",), re.compile(r"AKIA[A-Z0-9]+"), lambda m: m.end() - m.start() >= 20)
HEX = Kind("hex", (), re.compile(r"[0-9a-f]{24,}"), lambda m: True)
GITHUB = Kind(
    "github", tuple(f"gh{c}_" for c in "pousr"), re.compile(r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_matches
)
NPM = Kind("npm", ("npm_",), re.compile(r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), _crc_matches)
PEM = Kind(
    "pem", ("-----BEGIN ",),
    re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----"), lambda m: True,
)
KINDS = (ASSIGN, ACCESS, HEX, GITHUB, NPM, PEM)
BASE = 3


@Once
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    """One for words in either case, to be run on lower case, one for exact words."""
    either, exact = ahocorasick.Automaton(), ahocorasick.Automaton()
    for place, kind in enumerate(KINDS):
        for word in kind.keywords:
            (either if kind is ASSIGN else exact).add_word(word, (place, len(word)))
    either.make_automaton()
    exact.make_automaton()
    return either, exact


_LOWER_ASCII = {ord(c): c.lower() for c in string.ascii_uppercase}


def _lower(text: str) -> str:
    """Lower case with every code point at its place; only a dotted capital I would grow."""
    low = text.lower()
    return low if len(low) == len(text) else text.translate(_LOWER_ASCII)


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in ``KINDS``, end) of every secret, by start and kind; end exclusive."""
    either, exact = _automata()
    hits: list[list[int]] = [[] for _ in KINDS]
    for automaton, scanned in ((either, _lower(text)), (exact, text)):
        for last, (place, size) in automaton.iter(scanned):
            hits[place].append(last - size + 1)
    spans = [(m.start(), 2, m.end()) for m in HEX.expression.finditer(text)]
    for place, starts in enumerate(hits):
        free = 0
        for start in starts:
            if start >= free and (found := KINDS[place].expression.match(text, start)):
                free = found.end()
                if KINDS[place].accept(found):
                    spans.append((start, place, free))
    return sorted(spans)


def listing(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind].name}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans) of every row, spans an array of (kind, start, end) in code points, end exclusive.

    A null text is an empty one and has no spans; rows of null or equal id each get their row;
    an empty table gives none.  Other columns are not read.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = [
                    [{"kind": KINDS[kind].name, "start": start, "end": end} for start, kind, end in find(text)]
                    for text in texts
                ]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(span))], names=["doc_id", "spans"])

    picked = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(search, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and listing of all spans, per row of ``scan``."""

    def count(kind: Kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind.name)).cast("bigint").alias(f"n_{kind.name}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([k.name for k in KINDS[:BASE]]))
    return scanned.select(
        "doc_id", *[count(k) for k in KINDS[:BASE]], F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


ship(__name__)
