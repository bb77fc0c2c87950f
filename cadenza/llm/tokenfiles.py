"""Token-id files: one zstandard frame per document under a dictionary shared by all files.

Every whole text is encoded, the end id appended, and the ids of a document serialized as
little-endian integers of two or four bytes.  A zstandard dictionary is trained on the serialized
ids of a bounded sample of documents and stored once beside the files; each document is then
compressed by itself, so that a short one costs little and can be read alone.  Files hold the
documents in ascending order of id.

A file, all integers little-endian:

    header   magic (8), bytes per id (4), 0 (4), SHA-256 of the dictionary (32; of nothing: none is used)
    frames   one zstandard frame per document
    index    per document: id (8, signed), 1 if the id is null (8), offset of its frame (8), ids before it in the file (8)
    footer   offset of the index (8), documents (8), ids (8), magic (8)

Tasks write files under names of that attempt; the manifest lists those of attempts that succeeded.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext
from tokenizers import Tokenizer, pre_tokenizers

from cadenza.llm.common import columns, ship
from cadenza.session import shared_folder, stored

END_ID = 0
MAGIC = b"TOKIDS01"
HEADER, FOOTER = "<8sII32s", "<QQQ8s"
ENTRY = np.dtype([("id", "<i8"), ("null", "<u8"), ("offset", "<u8"), ("start", "<u8")])
HEADER_BYTES, FOOTER_BYTES = struct.calcsize(HEADER), struct.calcsize(FOOTER)
LEVEL = 3
DICTIONARY_BYTES = 112 << 10
# The dictionary is fitted on at most so many documents, and so many ids of each.
SAMPLE_DOCS, SAMPLE_IDS = 2048, 4096
FILE_BYTES = 256 << 20
OUT_BYTES = 8 << 20
CHUNK_CHARS = 1 << 14
KNOWN_WORDS = 1 << 19
LONG_BYTES, SLICE_BYTES = 4 << 20, 8 << 20

# The published split of byte-level BPE, spelt out for code points below U+0250 and common punctuation, whose
# classes are settled; texts with others go to the library's own splitter.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \x85\xa0"
_SPLIT = (
    f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
_UNSETTLED = "[^\x00-\u024f\u2010-\u2027\u2030-\u205e\u20ac]"
# Stands between words, as no settled text holds it.
BETWEEN = "\u2060"
# What keeps a text from being split at its spaces alone: such code points, rare spaces, a space behind another or at the end.
_IRREGULAR = r"[\t\x0b-\r\x{85}\x{a0}\x{250}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{20ab}\x{20ad}-\x{10ffff}]|[ \n] | \z"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next from U+0100."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printing]
    return {b: chr(b) for b in printing} | {b: chr(0x100 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts as bytes, equal to the library's, faster where words recur.

    A byte-level BPE splits a text into words and merges within each.  For such a tokenizer texts are
    split here, and the library merges each word once: those unknown so far, without its own splitter,
    in one call.  Other tokenizers, and chunks with code points whose class this module does not
    state, are encoded by the library whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallelism
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        self.library = Tokenizer.from_file(path)
        split, model, added = told.get("pre_tokenizer") or {}, told["model"], told.get("added_tokens") or []
        self.added = [t["content"] for t in added]
        self.by_words = (
            not told.get("normalizer") and split.get("type") == "ByteLevel" and not split["add_prefix_space"]
            and split.get("use_regex", True) and model.get("type") == "BPE" and not model.get("ignore_merges")
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
            and not any(t["normalized"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in added)
        )
        top = self.library.get_vocab_size(with_added_tokens=True) + len(added)
        self.kind = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.words, self.unsettled = re.compile(_SPLIT), re.compile(_UNSETTLED)
        self.irregular = "|".join([_IRREGULAR, *map(re.escape, self.added)])
        self.merger = Tokenizer.from_file(path)
        self.merger.pre_tokenizer = pre_tokenizers.Split(self._letters(BETWEEN), "removed")

    def _letters(self, text: str) -> str:
        return text.encode().decode("latin-1").translate(self.letters)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.kind).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Know these words of settled code points."""
        found = self.merger.encode(self._letters(BETWEEN.join(words)), add_special_tokens=False)
        data, of = self._packed(found.ids), np.array(found.word_ids)
        stops = (np.append(np.flatnonzero(of[1:] != of[:-1]) + 1, len(of)) * self.kind.itemsize).tolist()
        self.known.update(zip(words, map(data.__getitem__, map(slice, [0, *stops], stops)), strict=True))

    def _by_words(self, text: str) -> bytes:
        words = self.words.findall(text)
        if unknown := set(words).difference(self.known):
            self._learn(list(unknown))
        return b"".join(map(self.known.__getitem__, words))

    def _whole(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    def _chunk(self, text: str) -> bytes:
        if self.unsettled.search(text) or any(t in text for t in self.added):
            return self._whole(text)
        return self._by_words(text)

    def pack(self, text: str) -> bytes:
        """The serialized ids of a whole text."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        return b"".join(map(self._chunk, chunks(text, CHUNK_CHARS))) if self.by_words else self._whole(text)

    def _parts(self, parts: pa.Array) -> pa.Array:
        """The ids of each part with a space before it; none is empty or holds a space."""
        words = pa.array(self.words.findall(" " + " ".join(parts.to_numpy(zero_copy_only=False))), pa.string())
        coded = words.dictionary_encode()
        each = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if unknown := [w for w in each if w not in self.known]:
            self._learn(unknown)
        _, ends, data = pa.array(map(self.known.__getitem__, each), pa.large_binary()).take(coded.indices).buffers()
        # Exactly the first word of a part begins with a space.
        first = np.flatnonzero(pc.starts_with(words, " ").to_numpy(zero_copy_only=False))
        edges = np.frombuffer(ends, dtype=np.int64)[np.append(first, len(words))]
        return pa.Array.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(edges), data])

    def pack_all(self, texts: pa.Array) -> list[bytes]:
        """``pack`` of every text; a null one is empty.  Texts regular enough are split at spaces as one column, each part once."""
        texts = pc.fill_null(texts, "")
        regular = pc.and_(pc.invert(pc.match_substring_regex(texts, self.irregular)), pc.less(pc.binary_length(texts), LONG_BYTES))
        split = pc.split_pattern(texts.filter(regular), " ")
        tails = pc.list_slice(split, 1)
        coded = tails.flatten().dictionary_encode()
        if not self.by_words or not len(coded):
            return [self.pack(t.as_py()) for t in texts]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        _, ends, data = self._parts(coded.dictionary).take(coded.indices).buffers()
        edges = np.frombuffer(ends, dtype=np.int64)[tails.offsets.to_numpy() - tails.offsets[0].as_py()].tolist()
        # The first part of a text has no space before it.
        heads = pc.list_element(split, 0).to_pylist()
        packed = (self._by_words(head) + data[a:b].to_pybytes() for head, a, b in zip(heads, edges[:-1], edges[1:], strict=True))
        return [next(packed) if plain else self.pack(t.as_py()) for t, plain in zip(texts, regular.to_pylist(), strict=True)]


def chunks(text: str, size: int) -> Iterator[str]:
    """The text in pieces of ``size`` or a little more, each next one from a space after a letter or sign on: no word of a
    byte-level split holds a space behind such, so the pieces' ids are the text's."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at >= 0 and text[at - 1].isspace():
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:]


def serialized(encoder: Encoder, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batch of bounded bytes, with the ids of each text and the end id as bytes."""
    end = np.array([END_ID], dtype=encoder.kind).tobytes()
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(batch):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, side="right")))
        part = batch.slice(start, stop - start)
        yield part, [ids + end for ids in encoder.pack_all(part.column("text"))]
        start = stop


def train(docs: DataFrame, tokenizer: str, sample_docs: int = SAMPLE_DOCS, sample_ids: int = SAMPLE_IDS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary fitted on the first ``sample_ids`` ids of about ``sample_docs`` documents of smallest hash.

    The sample is one bounded task.  Where the library finds too little in it, the samples themselves, up to
    ``size`` bytes, are the dictionary; of an empty table it is empty.
    """
    rows = columns(docs, doc_id="bigint", text="string")
    # Hashes are even: below this share lie about twice as many rows as are wanted, however many there are.
    share = min(1.0, 2 * sample_docs / max(1, rows.count()))
    mark = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 33)
    heads = rows.select(mark.alias("mark"), F.substring("text", 1, 8 * sample_ids).alias("text")).where(F.col("mark") <= int(share * (1 << 31)))
    sample = heads.orderBy("mark", "text").limit(sample_docs).coalesce(1)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, samples = Encoder(tokenizer), []
        for batch in batches:
            for _, found in serialized(encoder, batch):
                samples.extend(ids[: sample_ids * encoder.kind.itemsize] for ids in found)
        try:
            found = zstandard.train_dictionary(size, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):
            found = b"".join(samples)[:size]
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([found], pa.binary())})

    found = [r["dictionary"] for r in sample.select("text").mapInArrow(fit, "dictionary binary").collect()]
    return bytes(max(found, key=len, default=b""))


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def frames(docs: DataFrame, tokenizer: str, dictionary: bytes, level: int = LEVEL) -> DataFrame:
    """(doc_id, mark, n_tokens, frame) of every row: its ids as one compressed frame; ``mark`` is a hash of the text."""

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        shared = _dictionary(dictionary)
        packer = zstandard.ZstdCompressor(level=level, dict_data=shared) if shared else zstandard.ZstdCompressor(level=level)
        for batch in batches:
            for part, found in serialized(encoder, batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("mark"), pa.array([len(ids) // encoder.kind.itemsize for ids in found], pa.int64()),
                        pa.array([packer.compress(ids) for ids in found], pa.binary()),
                    ],
                    names=["doc_id", "mark", "n_tokens", "frame"],
                )

    rows = columns(docs, doc_id="bigint", text="string").select("doc_id", F.xxhash64("text").alias("mark"), "text")
    return rows.mapInArrow(compress, "doc_id bigint, mark bigint, n_tokens bigint, frame binary")


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the ids of all documents as files; returns the stored manifest (path, dictionary, start, docs, ids).

    ``tokenizer`` is the path of a tokenizers file that the driver and every executor can read; ``start`` counts the ids of
    all files before.  Documents are in ascending order of id, null ids first; rows of one id by a hash of
    the text.  A null text is an empty one: it has the end id alone.  An empty table gives no file.
    Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/cadenza/{spark.sparkContext.applicationId}/ids-{uuid.uuid4().hex}"
    data = train(docs, tokenizer)
    digest = hashlib.sha256(data).digest()
    wide = Encoder(tokenizer).kind.itemsize
    # Encoded once: the range sort below reads its input twice.
    packed = stored(frames(docs, tokenizer, data).withColumn("row", F.monotonically_increasing_id()))
    # Hash and row split an id that many rows have.
    ordered = packed.repartitionByRange("doc_id", "mark", "row").sortWithinPartitions("doc_id", "mark", "row")
    named = f"{folder}/{digest.hex()}.dictionary"
    home, place = fs.FileSystem.from_uri(folder)
    home.create_dir(place, recursive=True)
    with home.open_output_stream(f"{place}/{digest.hex()}.dictionary", compression=None) as out:
        out.write(data)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        part, number, open_file = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for doc_id, n, frame in zip(batch.column("doc_id"), batch.column("n_tokens"), batch.column("frame"), strict=True):
                if open_file is None:
                    open_file = _File(system, f"{base}/{uuid.uuid4().hex}.ids", wide, digest)
                open_file.add(doc_id.as_py(), n.as_py(), frame.as_py())
                if open_file.size >= file_bytes:
                    yield open_file.closed(folder, part, number)
                    open_file, number = None, number + 1
        if open_file is not None:
            yield open_file.closed(folder, part, number)

    files = stored(ordered.mapInArrow(put, "path string, part bigint, number bigint, docs bigint, ids bigint"))
    # One row per file.
    before = F.sum("ids").over(W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1))
    return stored(files.select("path", F.lit(named).alias("dictionary"), F.coalesce(before, F.lit(0)).alias("start"), "docs", "ids"))


class _File:
    """A file being written; only its index is held."""

    def __init__(self, system: fs.FileSystem, path: str, wide: int, digest: bytes) -> None:
        self.name, self.out = path.rsplit("/", 1)[1], system.open_output_stream(path, compression=None)
        self.out.write(struct.pack(HEADER, MAGIC, wide, 0, digest))
        self.size, self.ids, self.index = HEADER_BYTES, 0, []

    def add(self, doc_id: int | None, n: int, frame: bytes) -> None:
        self.index.append((doc_id or 0, doc_id is None, self.size, self.ids))
        self.out.write(frame)
        self.size, self.ids = self.size + len(frame), self.ids + n

    def closed(self, folder: str, part: int, number: int) -> pa.RecordBatch:
        self.out.write(np.array(self.index, dtype=ENTRY).tobytes())
        self.out.write(struct.pack(FOOTER, self.size, len(self.index), self.ids, MAGIC))
        self.out.close()
        row = {"path": f"{folder}/{self.name}", "part": part, "number": number, "docs": len(self.index), "ids": self.ids}
        return pa.RecordBatch.from_pylist([row], pa.schema([("path", pa.string()), *((c, pa.int64()) for c in ("part", "number", "docs", "ids"))]))


class Reader:
    """An open file: any document by its place, or all in order.  ValueError where file or dictionary is not as written."""

    def __init__(self, path: str, dictionary: str) -> None:
        system, place = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        if size < HEADER_BYTES + FOOTER_BYTES:
            raise ValueError(f"{path} is too short")
        magic, wide, _, digest = struct.unpack(HEADER, self.file.read_at(HEADER_BYTES, 0))
        self.end, docs, self.ids, last = struct.unpack(FOOTER, self.file.read_at(FOOTER_BYTES, size - FOOTER_BYTES))
        if magic != MAGIC or last != MAGIC or self.end + docs * ENTRY.itemsize + FOOTER_BYTES != size:
            raise ValueError(f"{path} is no file of ids")
        system, place = fs.FileSystem.from_uri(dictionary)
        with system.open_input_stream(place, compression=None) as stream:
            data = stream.read()
        if hashlib.sha256(data).digest() != digest:
            raise ValueError(f"{path} was written with another dictionary")
        shared = _dictionary(data)
        self.unpacker = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
        self.kind = np.dtype(f"<u{wide}")
        self.index = np.frombuffer(self.file.read_at(docs * ENTRY.itemsize, self.end), dtype=ENTRY)

    def __len__(self) -> int:
        return len(self.index)

    def document(self, place: int) -> tuple[int | None, int, np.ndarray]:
        """Id, ids before it in this file, and the ids of the document at ``place``."""
        entry = self.index[place]
        last = place + 1 == len(self.index)
        stop, after = (self.end, self.ids) if last else (int(self.index[place + 1]["offset"]), int(self.index[place + 1]["start"]))
        frame = self.file.read_at(stop - int(entry["offset"]), int(entry["offset"]))
        ids = np.frombuffer(self.unpacker.decompress(frame), dtype=self.kind)
        if len(ids) != after - int(entry["start"]) or len(ids) == 0 or ids[-1] != END_ID:
            raise ValueError(f"document {place} is damaged")
        return None if entry["null"] else int(entry["id"]), int(entry["start"]), ids

    def __enter__(self) -> Reader:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def read(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32 and, if asked for, ids) of every document of the manifest's files."""
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if with_ids:
        fields, kinds = [*fields, ("ids", pa.list_(pa.int64()))], f"{kinds}, ids array<bigint>"
    schema = pa.schema(fields)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for given in batch.to_pylist():
                with Reader(given["path"], given["dictionary"]) as file:
                    rows, held = [], 0
                    for place in range(len(file)):
                        doc_id, before, ids = file.document(place)
                        row = {"doc_id": doc_id, "start": given["start"] + before, "n_tokens": len(ids), "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}
                        rows.append(row | ({"ids": ids.astype(np.int64)} if with_ids else {}))
                        held += 8 * len(ids) if with_ids else 64
                        if held >= OUT_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, manifest.count())
    return manifest.select("path", "dictionary", "start").repartition(files).mapInArrow(follow, kinds)


ship(__name__)
