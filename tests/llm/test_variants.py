import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import queries, variants
from odd_tables import no_docs, odd_docs  # noqa: F401

LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, least_chars=6, least_count=5):
    found = Counter()
    for doc_id, text in rows:
        for run in LETTERS.findall(text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least_chars and n >= least_count}


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=5):
    """Every pair of words of six letters or more that share a beginning or an end, compared letter by letter."""
    shares = defaultdict(set)
    for w in counts:
        shares["<", w[:3]].add(w)
        shares[">", w[-3:]].add(w)
    out, form = {}, {}
    for w, n in counts.items():
        close = [v for v in shares["<", w[:3]] | shares[">", w[-3:]] if one_apart(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
        out[w] = len(close)
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], counts[form[w]] if form[w] is not None else None))
    return rows


NAMES = ("word", "form", "root", "n", "n_near", "form_n")


def got(df):
    rows = [tuple(r[c] for c in NAMES) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def scanned(counts, plain):
    """Near words of each word by the rotations alone."""
    order = {w: i for i, w in enumerate(sorted(counts))}
    ranges = defaultdict(list)
    for w, n in counts.items():
        for key, what in variants.rotations(w, plain):
            ranges[key].append((order[w], n, what))
    near, best = Counter(), {}
    for members in ranges.values():
        for i, k, n, first in variants.near(members):
            near[i] += k
            best[i] = max(best.get(i, (0, 0)), (n, -first))
    return {w: (near[i], best.get(i)) for w, i in order.items()}


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.integers(1, 30), max_size=25), st.sampled_from([0, 2, 4, 5, 256]))
def test_ranges_find_every_near_word_once(counts, plain):
    order = {w: i for i, w in enumerate(sorted(counts))}
    want = {}
    for w in counts:
        close = [v for v in counts if one_apart(w, v)]
        want[w] = (len(close), max(((counts[v], -order[v]) for v in close), default=None))
    assert scanned(counts, plain) == want


def test_equals_brute_force_on_the_given_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = list(map(tuple, docs.collect()))
    assert got(queries.QUERIES["op11_variants"](spark, small)) == brute(brute_words(rows))
    loose = variants.variants(docs.repartition(7), least_chars=6, least_count=1, times=2)
    assert got(loose) == brute(brute_words(rows, 6, 1), 2)


def test_chains_ties_and_hot_words(spark):
    counts = {"abcdefgh": 20000, "abcdefg": 3000, "abcdef": 500, "abcdefx": 500, "abcdeg": 90, "bbcdeg": 17, "bbcdegg": 5, "bbcdeggg": 5,
              "étéété": 30, "ététét": 6, "lonely": 9, "aaaaaa": 50, "aaaaaaa": 50, "aaaaaaaa": 10}
    rows = [(i, w.upper() if i % 2 else w, n) for i, (w, n) in enumerate(counts.items())]
    texts = [(i, ". ".join([w] * n)) for i, w, n in rows]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = got(variants.variants(frame))
    assert found == brute(brute_words(texts))
    assert any(r[2] == "abcdefgh" and r[1] not in (None, "abcdefgh") for r in found)


def test_very_long_words(spark):
    long = "abcdefghij" * 100
    texts = [(i, " ".join([long] * 30 + [long[:500] + long[501:]] * 5 + [long[:700] + "z" + long[701:]] * 6 + ["q" * 257] * 5 + ["q" * 256] * 25))
             for i in (-7, -8)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    found = got(variants.variants(frame))
    assert found == brute(brute_words(texts)) and sum(r[1] is not None for r in found) >= 3


def test_odd_rows(odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert got(variants.variants(odd_docs)) == brute(brute_words(rows))
    assert variants.variants(no_docs).count() == 0
    with pytest.raises(ValueError):
        variants.variants(no_docs, times=1)
