from collections import Counter
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cadenza.llm import packing
from odd_tables import no_docs, odd_docs  # noqa: F401


def padding(histogram, edges):
    return sum(n * (min(e for e in edges if e >= length) - length) for length, n in histogram.items())


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 9), max_size=8), st.integers(1, 5))
def test_boundaries_are_optimal(histogram, buckets):
    edges = packing.boundaries(histogram, buckets)
    if not histogram:
        assert edges == []
        return
    lengths = sorted(histogram)
    every = [
        [*c, lengths[-1]] for n in range(min(buckets, len(lengths))) for c in combinations(lengths[:-1], n)
    ]
    assert len(edges) <= buckets and edges == sorted(edges) and edges[-1] == lengths[-1]
    assert padding(histogram, edges) == min(padding(histogram, e) for e in every)


def test_words(spark):
    texts = [None, "", "  ", "one", " a  b\tc\n\nd ", "x " * 1000]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in frame.select(packing.word_count(F.col("text"))).collect()] == [0, 0, 0, 1, 4, 1000]


def test_batches_are_whole_and_within_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for salted in (10**9, 7):
        got = packing.pack(docs, max_tokens=300, buckets=4, budget=1500, rows_per_salt=salted).collect()
        tokens = Counter()
        for r in got:
            tokens[r["doc_id"]] += r["n_tokens"]
            assert r["padding"] == r["bucket"] - r["n_tokens"] >= 0 and r["n_tokens"] <= 300
            assert r["start"] == 300 * r["piece"]
        assert tokens == {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
        for bucket in {r["bucket"] for r in got}:
            own = [(r["batch"], r["slot"]) for r in got if r["bucket"] == bucket]
            capacity = 1500 // bucket
            # Full batches but for the last one, every slot once.
            assert sorted(own) == [(i // capacity, i % capacity) for i in range(len(own))]


def test_places_do_not_depend_on_salts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, two = (sorted(map(tuple, packing.pack(docs, rows_per_salt=n).collect())) for n in (10**9, 11))
    assert one == two


def test_odd_rows(odd_docs, no_docs):
    got = packing.pack(odd_docs, max_tokens=1000).collect()
    assert sum(r["n_tokens"] for r in got if r["doc_id"] == 6) == 120_000
    assert Counter(r["doc_id"] for r in got)[0] == 2 and len({(r["bucket"], r["batch"], r["slot"]) for r in got}) == len(got)
    assert packing.pack(no_docs).count() == 0
    assert packing.pack(odd_docs, length=F.lit(None)).select("n_tokens").distinct().collect()[0][0] == 0


def test_rows_without_an_id_are_spread(spark):
    """A third of all rows has no id and the same text, another third one id: places are whole, salts even."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "a b c") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = packing.pack(docs, budget=60, rows_per_salt=500)
    assert sorted((r["batch"], r["slot"]) for r in got.collect()) == [(i // 20, i % 20) for i in range(6000)]
    marks = packing.sequences(docs, packing.word_count(F.col("text"))).withColumn("row", F.monotonically_increasing_id())
    salt = F.floor(F.shiftrightunsigned(F.xxhash64("doc_id", "piece", "row"), 33) * 12 / (1 << 31))
    sizes = [r["count"] for r in marks.groupBy(salt.alias("salt")).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 500


def test_places_do_not_depend_on_the_layout(spark):
    """Null, equal and own ids, dealt to partitions in three ways: the same sequences at the same places."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, "a " * (1 + i % 3)) for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    layouts = [docs.coalesce(1), docs.repartition(5), docs.orderBy(F.desc("doc_id"), F.rand(3))]
    got = [sorted(packing.pack(d, budget=60, rows_per_salt=500).collect(), key=str) for d in layouts]
    assert got[0] == got[1] == got[2]
    for bucket in {r["bucket"] for r in got[0]}:
        own = [(r["batch"], r["slot"]) for r in got[0] if r["bucket"] == bucket]
        assert sorted(own) == [divmod(i, 60 // bucket) for i in range(len(own))]
    # Copies beyond one portion are spread: no long run of slots holds one id alone.
    assert Counter(r["doc_id"] for r in got[0])[None] == 3000 > 2 * packing.PORTION
