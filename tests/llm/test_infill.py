import hashlib
import random

import pytest
from check_queries import differences, duck
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import infill, queries
from odd_tables import no_docs, odd_docs  # noqa: F401

RULE = infill.Rule()
CHARS = ["a", "B", " ", "\n", "é", "ß", "\U0001f600", "<", ">", "P", "S", "M", "<P", "S>", "<M", "<P>", "é"]
texts = st.lists(st.sampled_from(CHARS), max_size=30).map("".join)


def brute(text, doc_id, rule=RULE):
    """Form, counts and output by slices of the string."""
    digest = hashlib.sha256(f"{rule.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    prefix, suffix, middle = (m.decode() for m in (rule.prefix, rule.suffix, rule.middle))
    if not text or any(m in text for m in (prefix, suffix, middle)) or h3 % 100 >= rule.turned_percent:
        return "plain", n, None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < rule.suffix_first_percent:
        return "spm", n, a, b - a, suffix + text[b:] + prefix + text[:a] + middle + text[a:b]
    return "psm", n, a, b - a, prefix + text[:a] + suffix + text[b:] + middle + text[a:b]


def turned(text, doc_id, rule=RULE):
    data = bytearray(text.encode())
    form, n, a, b = infill.turn(data, doc_id, rule)
    return form, n, a, b, data.decode()


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(-3, 10**12))
def test_forms_equal_slices_and_come_back(text, doc_id):
    form, n, a, b, output = turned(text, doc_id)
    assert (form, n, a, b, output) == brute(text, doc_id)
    data = bytearray(output.encode())
    infill.turn_back(data, form)
    assert data.decode() == text


def test_texts_longer_than_a_block():
    rng, seen = random.Random(5), set()
    for doc_id in range(12):
        text = "".join(rng.choices("ab é\U0001f600", k=infill.BLOCK + rng.randint(0, 2 * infill.BLOCK)))
        got = turned(text, doc_id)
        assert got == brute(text, doc_id)
        data = bytearray(got[-1].encode())
        infill.turn_back(data, got[0])
        assert data.decode() == text
        seen.add(got[0])
    assert {"psm", "spm"} <= seen


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=50), st.data())
def test_exchange(data, draw):
    a, b, c = sorted(draw.draw(st.lists(st.integers(0, len(data)), min_size=3, max_size=3)))
    held = bytearray(data)
    infill.exchange(held, a, b, c)
    assert held == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_damage_and_bad_marks_are_found():
    for form, output in (("psm", b"no marks"), ("psm", b"<S>a<P>b<M>c"), ("spm", b"<P>a<S>b<M>c"), ("psm", b"<P>a<S>b"), ("x", b"<P>a<S>b<M>c"),
                         ("psm", b"<P>a<S>b<M>c<M>")):
        with pytest.raises(ValueError):
            infill.turn_back(bytearray(output), form)
    for marks in ((b"<P>", b"<P>", b"<M>"), (b"<P>", b"<S>", b"[M]"), (b"<<", b"<S>", b"<M>"), (b"<P", b"<P>", b"<M>"), (b"", b"<S>", b"<M>")):
        with pytest.raises(ValueError):
            infill.Rule(*marks)


def test_other_rules(spark):
    rule = infill.Rule(b"<|pre|>", b"<|suf|>", b"<|mid|>", 100, 50, "seven")
    rows = [(i, f"text {i} é " * i) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in infill.restore(infill.transform(docs, rule), rule).collect()}
    for i, text in rows:
        r = got[i]
        assert (r["form"], r["n"], r["prefix_chars"], r["middle_chars"], r["output"]) == brute(text, i, rule) and r["text"] == text
    assert {r["form"] for r in got.values()} == {"psm", "spm"}


def test_odd_rows(odd_docs, no_docs):
    got = infill.restore(infill.transform(odd_docs)).collect()
    want = [(r["doc_id"], *brute(r["text"] or "", r["doc_id"]), r["text"] or "") for r in odd_docs.collect()]
    names = ("doc_id", "form", "n", "prefix_chars", "middle_chars", "output", "text")
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in got))) == sorted(map(repr, want))
    assert infill.transform(no_docs).count() == 0


def test_query_equals_sql(spark, small):
    got = queries.QUERIES["op13_infill"](spark, small)
    assert differences(got, duck(small), queries.ORACLE_SQL["op13_infill"]) == []
