import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cadenza.llm import queries, tokenfiles
from odd_tables import no_docs, odd_docs  # noqa: F401

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = tokenfiles.Encoder(PATH)


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def own_ids(text, encoder=ENCODER):
    return np.frombuffer(encoder.pack(text), dtype=encoder.kind).tolist()


PIECES = ["the", "Über", "naïve", "x", "'s", "'S", "'ll", "don't", "12", "3½", "²", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "\x85", "\x1c", " ",
          "—", "“q”", "€", ".", ",", "!?", "×", "ǅ", "名前", "\U0001f600", "é", "<|endoftext|>", "<|", "\x00", "ªº", " "]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=24).map("".join))
def test_ids_are_the_librarys(text):
    assert own_ids(text) == library_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=24).map("".join), max_size=9))
def test_texts_of_a_column(texts):
    got = [np.frombuffer(b, dtype=ENCODER.kind).tolist() for b in ENCODER.pack_all(pa.array([*texts, None], pa.string()).slice(0))]
    assert got == [*map(library_ids, texts), []]


def test_every_settled_code_point():
    settled = [chr(p) for p in range(0x2100) if not ENCODER.unsettled.search(chr(p))]
    assert len(settled) > 600
    for c in settled:
        for text in (c, f"a{c}b", f"a {c} 1{c}", f"{c}{c}\n{c}", f" {c}", f"{c} ", f"'{c}s"):
            assert own_ids(text) == library_ids(text), (hex(ord(c)), text)
    texts = [f"a{c} b {c}d {c} e" for c in map(chr, [*range(0xD800), *range(0xE000, 0x11000)])]
    for text, ids in zip(texts, ENCODER.pack_all(pa.array(texts)), strict=True):
        assert np.frombuffer(ids, dtype=ENCODER.kind).tolist() == library_ids(text), text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40).map("".join), st.integers(1, 12))
def test_chunks_join_to_the_text_and_to_its_ids(text, size):
    parts = list(tokenfiles.chunks(text, size))
    assert "".join(parts) == text
    assert [i for p in parts for i in library_ids(p)] == library_ids(text)


def test_other_tokenizers_are_left_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = tokenfiles.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_words
    text = "Some Words, and  more\nwords. " * 50
    assert own_ids(text, encoder) == library.encode(text, add_special_tokens=False).ids


def brute(rows):
    """(doc_id, start, n_tokens, crc) per row in ascending order of id; rows of one id in any order."""
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library_ids(text or ""), 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_the_library(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = queries.QUERIES["op12_token_files"](spark, small)
    assert dict(got.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(brute(map(tuple, docs)))


@pytest.mark.parametrize("parts", [1, 3])
def test_files_roll_over_and_ids_come_back(spark, tmp_path, parts):
    rows = [(3 * i - 50, f"text number {i} " * (i % 40)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
    manifest = tokenfiles.write(docs, PATH, str(tmp_path / "ids"), file_bytes=700)
    files = manifest.orderBy("start").collect()
    assert len(files) > 3 and sum(f["docs"] for f in files) == 150
    got = sorted(map(tuple, tokenfiles.read(spark, manifest, with_ids=True).collect()), key=lambda r: r[1])
    assert [r[:4] for r in got] == brute(rows)
    assert all(r[4] == [*library_ids(t), 0] for r, (_, t) in zip(got, sorted(rows), strict=True))
    # Any document alone, by its place.
    with tokenfiles.Reader(files[1]["path"], files[1]["dictionary"]) as file:
        place = len(file) - 1
        doc_id, before, ids = file.document(place)
    assert ids.tolist() == [*library_ids(dict(rows)[doc_id]), 0]
    assert (doc_id, files[1]["start"] + before) == next((r[0], r[1]) for r in got if r[0] == doc_id)


def test_a_shared_dictionary_is_trained_and_helps(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    data = tokenfiles.train(docs, PATH)
    assert data and data == tokenfiles.train(docs.repartition(5), PATH) and len(data) <= tokenfiles.DICTIONARY_BYTES
    size = lambda d: tokenfiles.frames(docs, PATH, d).agg(F.sum(F.octet_length("frame"))).first()[0]
    assert size(data) < size(b"")


def test_damage_is_found(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(40)], "doc_id bigint, text string").coalesce(1)
    row = tokenfiles.write(docs, PATH, str(tmp_path / "ids")).first()
    whole = open(row["path"], "rb").read()
    other = tmp_path / "other.dictionary"
    other.write_bytes(b"another dictionary")
    with pytest.raises(ValueError):
        tokenfiles.Reader(row["path"], str(other))
    for place, bad in enumerate((b"", whole[:-1], b"X" + whole[1:], whole[: len(whole) // 2])):
        path = tmp_path / f"bad{place}"
        path.write_bytes(bad)
        with pytest.raises(ValueError):
            tokenfiles.Reader(str(path), row["dictionary"])


def test_odd_rows(spark, odd_docs, no_docs):
    got = sorted(map(tuple, tokenfiles.read(spark, tokenfiles.write(odd_docs, PATH)).collect()), key=lambda r: r[1])
    want = brute((r["doc_id"], r["text"]) for r in odd_docs.collect())
    bare = lambda rows: sorted((str(r[0]), *r[2:]) for r in rows)
    assert bare(got) == bare(want)
    assert [r[0] for r in got] == [r[0] for r in want]
    starts = np.cumsum([0] + [r[2] for r in got])
    assert [r[1] for r in got] == starts[:-1].tolist()
    assert tokenfiles.read(spark, tokenfiles.write(no_docs, PATH)).count() == 0
