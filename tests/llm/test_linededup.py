import random
from collections import Counter

from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import linededup
from odd_tables import no_docs, odd_docs  # noqa: F401

PASSAGE = "\n".join(f"This is line {i} of a passage with quite a few words in it." for i in range(6))


def docs_of(spark, texts, extra=()):
    return spark.createDataFrame([(i, t, "k", 5) for i, t in enumerate(texts)] + list(extra), "doc_id bigint, text string, deleted string, key_id int")


def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=14), st.lists(st.integers(0, 9), max_size=14))
def test_alignment_is_a_common_order(a, b):
    pairs = linededup.aligned(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))
    assert len(pairs) <= lcs(a, b) and bool(pairs) == bool(set(a) & set(b))
    if a == b or len(set(a)) == len(a) and len(set(b)) == len(b):
        assert len(pairs) == lcs(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14), st.integers(1, 6))
def test_deleted_lines_stand_in_runs_that_are_long_enough(a, b, least):
    words = [2] * len(a)
    lost = linededup.shared_lines(a, words, b, least)
    assert all(a[i] in b for i in lost)
    # Nothing is left that is as long and stands in both without a gap.
    left = [a[i] for i in range(len(a)) if i not in lost]
    if least <= 2:
        assert not set(left) & set(b)


def test_passages_stay_in_the_first_document(spark):
    own = [f"Own words of document {i} and nobody else has them at all." for i in range(5)]
    texts = [f"{own[0]}\n{PASSAGE}\n{own[0]}x", f"{PASSAGE}\n{own[1]}", own[2], f"{own[3]}\n{PASSAGE}", f"{own[4]}\n{PASSAGE}\nThe."]
    got = {r["doc_id"]: r for r in linededup.dedup_lines(docs_of(spark, texts)).collect()}
    assert got[0]["text"] == texts[0] and got[2]["text"] == texts[2]
    assert got[1]["text"] == own[1] and got[3]["text"] == own[3] and got[4]["text"] == f"{own[4]}\nThe."
    assert [got[i]["n_deleted"] for i in range(5)] == [0, 6, 0, 6, 6]


def test_short_common_lines_stay(spark):
    texts = [f"The.\nLine of document number {i} with its own ten words here now.\nAll rights reserved." for i in range(30)]
    assert rows(linededup.dedup_lines(docs_of(spark, texts)).where("n_deleted > 0")) == []


def test_moved_passages_are_found(spark):
    a, b = PASSAGE, PASSAGE.replace("line", "row")
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs_of(spark, [f"{a}\n{b}", f"{b}\nnew words\n{a}"])).collect()}
    assert got[1] == "new words"


def brute(texts, least):
    """Every line that any earlier document holds in a run of enough words, by all pairs."""
    out = []
    for i, text in enumerate(texts):
        lines = text.split("\n")
        lost = set()
        for other in texts[:i]:
            theirs = other.split("\n")
            for p in range(len(lines)):
                for q in range(len(theirs)):
                    n = 0
                    while p + n < len(lines) and q + n < len(theirs) and lines[p + n] == theirs[q + n]:
                        n += 1
                    if sum(len(x.split()) for x in lines[p : p + n]) >= least:
                        lost |= set(range(p, p + n))
        out.append("\n".join(line for n, line in enumerate(lines) if n not in lost))
    return out


def test_equals_brute_force_on_passages_of_lines_of_their_own(spark):
    rng = random.Random(7)
    passages = ["\n".join(f"p{p} line {i} " + " ".join(f"w{rng.randint(0, 99)}" for _ in range(12)) for i in range(rng.randint(1, 4))) for p in range(5)]
    texts = []
    for i in range(40):
        parts = [f"own {i} {n} " + " ".join(f"v{rng.randint(0, 999)}" for _ in range(9)) for n in range(3)]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        texts.append("\n".join(dict.fromkeys("\n".join(parts).split("\n"))))
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, linededup.MIN_WORDS)


def test_odd_rows(spark, odd_docs, no_docs):
    got = linededup.dedup_lines(odd_docs)
    assert got.columns == [*odd_docs.columns, "n_deleted"] and got.count() == odd_docs.count()
    assert linededup.dedup_lines(no_docs).count() == 0
    copies = docs_of(spark, [PASSAGE, PASSAGE, None, "", PASSAGE], [(4, PASSAGE, "k", 5), (None, PASSAGE, "k", 5)])
    texts = Counter((r["doc_id"], r["text"]) for r in linededup.dedup_lines(copies).collect())
    assert texts == {(0, PASSAGE): 1, (1, ""): 1, (2, None): 1, (3, ""): 1, (4, ""): 2, (None, ""): 1}
    clash = linededup.dedup_lines(copies.withColumnRenamed("deleted", "n_deleted"))
    assert "n_deleted_" in clash.columns


def runs_by_pairs(a, words, b, least):
    """Places of ``a`` in runs of enough words that stand in ``b``, by all pairs of places."""
    lost = set()
    for p in range(len(a)):
        for q in range(len(b)):
            n = 0
            while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n]:
                n += 1
            if n and sum(words[p : p + n]) >= least:
                lost |= set(range(p, p + n))
    return sorted(lost)


def test_a_long_passage_crossed_by_short_lines_is_found():
    assert linededup.shared_lines([1, 8, 2, 3], [2, 5, 2, 60], [3, 1, 9, 2]) == [3]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 9), min_size=7, max_size=7), st.integers(1, 20))
def test_shared_lines_equal_all_pairs(a, b, sizes, least):
    words = [sizes[line] for line in a]
    assert linededup.shared_lines(a, words, b, least) == runs_by_pairs(a, words, b, least)


def test_equals_brute_force_on_short_shared_lines(spark):
    rng = random.Random(11)
    hot = [f"hot {i} " + "w " * rng.randint(0, 6) for i in range(25)] + ["", "."]
    texts = ["one two three four five six", "a b c d e f", "one two three four five six\na b c d e f", "own\none two three four five six\na b c d e f"]
    for i in range(120):
        parts = [f"own {i} {n} " + "v " * rng.randint(0, 12) for n in range(rng.randint(0, 2))]
        for _ in range(rng.randint(0, 4)):
            start = rng.randrange(len(hot))
            parts[rng.randint(0, len(parts)) : 0] = hot[start : start + rng.randint(1, 5)] if rng.random() < 0.7 else rng.sample(hot, 3)
        texts.append("\n".join(line.strip() for line in parts))
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs_of(spark, texts)).collect()}
    assert got[3] == "own"
    assert [got[i] for i in range(len(texts))] == brute(texts, linededup.MIN_WORDS)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 30), max_size=20))
def test_crossings_are_dealt_into_the_fewest_lists(places):
    lists = linededup._dealt(list(enumerate(places)))
    assert sorted(pair for one in lists for pair in one) == list(enumerate(places))
    assert all(x[0] < y[0] and x[1] < y[1] for one in lists for x, y in zip(one, one[1:], strict=False))
    # As many lists as pairs that cross one another in a row: fewer cannot be.
    longest = [0] * len(places)
    for i, place in enumerate(places):
        longest[i] = 1 + max((longest[j] for j in range(i) if places[j] >= place), default=0)
    assert len(lists) == max(longest, default=0)


def test_blocks_of_an_alignment():
    # Lines 0 to 3 and 6 to 7 of the later document stand in the earlier one, in the other order.
    common = [(1, 1, 0, 2, 10), (2, 2, 1, 3, 11), (3, 3, 2, 4, 12), (4, 4, 6, 8, 3)]
    assert linededup.common_blocks(common) == [(0, 4), (6, 8)]
    assert linededup.common_blocks([]) == []
    assert linededup.merged([(5, 9), (0, 2), (2, 3), (6, 7)]) == [(0, 3), (5, 9)]


def test_long_documents_in_reversed_order_take_one_pass():
    n = 60_000
    assert linededup.common_blocks([(i, i, i, i + 1, n - i) for i in range(n)]) == [(0, n)]


def test_linked_documents_are_aligned(spark, monkeypatch):
    """The query's deletions come from the alignment: without aligned pairs and dealt ones there are none."""
    docs = docs_of(spark, [PASSAGE, f"{PASSAGE}\nown"])
    assert [r["n_deleted"] for r in linededup.dedup_lines(docs).orderBy("doc_id").collect()] == [0, 6]
    monkeypatch.setattr(linededup, "aligned", lambda a, b: [])
    monkeypatch.setattr(linededup, "_dealt", lambda pairs: [])
    assert linededup.dedup_lines(docs).where("n_deleted > 0").count() == 0
