import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import decontam
from odd_tables import no_docs, odd_docs  # noqa: F401


def folded(text):
    def low(c):
        if ord(c) > 0xFFFF:
            return c
        return (c.lower() if len(c.lower()) == 1 else c) if c.isalnum() else " "

    return " ".join("".join(map(low, text)).split())


def sellers(pattern, text):
    """Least edits of the pattern against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def windows(item):
    size = min(decontam.WINDOW, len(item))
    starts = sorted({*range(0, len(item) - size + 1, decontam.STRIDE), len(item) - size})
    return [item[s : s + size] for s in starts]


def brute(texts, items):
    out = set()
    for n, text in enumerate(texts):
        for m, item in enumerate(items):
            shown = folded(item)
            if len(shown) >= decontam.Q and any(sellers(w, folded(text)) <= decontam.budget(len(w)) for w in windows(shown)):
                out.add((n, m))
    return out


WORDS = "the of and reading train with from nation hewn stand letter other ring".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "tion"]) for _ in range(n))


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1 :]])
    return text


def cases(seed):
    rng = random.Random(seed)
    items = [sentence(rng, n) for n in (30, 18, 9, 5, 2)] + ["tiny", "", "Mixed CASE, with; punctuation! " * 4]
    texts = [sentence(rng, 60) for _ in range(6)]
    for edits in (0, 1, 4, 6, 8, 9, 12, 20):
        for item in items[:5]:
            texts.append(f"{sentence(rng, 8)}\n{edited(rng, item, min(edits, len(item) // 4))}, {sentence(rng, 8)}")
    for item in items[:2]:
        texts.append(sentence(rng, 5) + " " + item[20:135] + " " + sentence(rng, 5))
        texts.append(item[:60] + sentence(rng, 5) + item[60:])
    texts += [items[0], items[0].upper().replace(" ", " -- "), "", "x", items[7].lower()]
    return texts, items


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(seed):
    texts, items = cases(seed)
    index = decontam.Index(list(enumerate(items)))
    got = {(n, m) for n, m, *_ in index.search(texts)}
    assert got == brute(texts, items)
    firsts = {n for n, *_ in index.search(texts, first_only=True)}
    assert firsts == {n for n, _ in got}


def test_every_verbatim_quotation_of_a_window_is_found():
    rng = random.Random(12)
    item = sentence(rng, 60)
    shown = folded(item)
    texts = [f"{'qwertz yx ' * 6}{shown[at : at + decontam.WINDOW]}{' jkl vbnm' * 6}" for at in range(len(shown) - decontam.WINDOW + 1)]
    found = {n for n, *_ in decontam.Index([(0, item)]).search(texts)}
    assert len(texts) > 150 and found == set(range(len(texts)))


def test_spans_are_where_the_leak_is():
    texts, items = ["Ünrelated – words! " + "ab cd ef gh ij kl mn op qr st uv wx yz 12 34 56" + " tail"], ["ab cd ef gh ij kl mn op qr st uv wx yz 12 34 56"]
    ((n, item, edits, start, end),) = decontam.Index(list(enumerate(items))).search(texts)
    assert (n, item, edits) == (0, 0, 0) and texts[0][start:end] == items[0]


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=1, max_size=9), st.text("ab", max_size=12), st.integers(0, 4))
def test_alignment_equals_sellers(pattern, text, edits):
    codes = lambda s: np.array([ord(c) for c in s], dtype=np.uint64)
    got, want = decontam.align(codes(pattern), codes(text), edits), sellers(pattern, text)
    if want <= edits:
        assert got is not None and got[0] == want and 0 <= got[1] <= got[2] <= len(text)
    else:
        assert got is None


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB -é.\U0001f600", max_size=9), max_size=5))
def test_folding(texts):
    chars, heads, origin = decontam.folded_texts(texts)
    for n, text in enumerate(texts):
        own = chars[heads[n] : heads[n + 1]]
        assert "".join(chr(c) for c in own if c != decontam.OUTSIDE) == folded(text)
        for c, place in zip(own.tolist(), origin[heads[n] : heads[n + 1]].tolist(), strict=True):
            if c not in (decontam.OUTSIDE, decontam.BLANK):
                assert chr(c) == text[place].lower()


def test_grams_are_equal_where_the_text_is():
    codes = np.array([ord(c) for c in "abcabcabcabcd"], dtype=np.uint64)
    found = decontam.grams(codes, 9)
    assert len(found) == 5 and found[0] == found[3] and len(set(found.tolist())) == 4
    assert len(decontam.grams(codes[:4], 9)) == 0


def test_tables(spark, odd_docs, no_docs):
    texts, items = cases(9)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(0, items[0], "y"), (None, None, None)], "item_id bigint, text string, doc_id string")
    want = brute(texts, items)
    for block in (decontam.BLOCK_CHARS, 100):
        got = [(r["doc_id"], r["item_id"]) for r in decontam.leaks(docs, bench, block_chars=block).collect()]
        assert sorted(got) == sorted(want)
        kept = decontam.without_leaks(docs, bench, block_chars=block)
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(len(texts))) - {n for n, _ in want})
        assert kept.columns == docs.columns
    assert decontam.leaks(no_docs, bench).count() == decontam.leaks(docs, bench.limit(0)).count() == 0
    assert decontam.without_leaks(docs, bench.limit(0)).count() == len(texts)
    assert decontam.without_leaks(odd_docs, bench).count() == odd_docs.count()
