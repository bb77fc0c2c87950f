from collections import defaultdict

import corpus_pipeline
import pytest

from cadenza.llm import decontam, linededup, packing, quality, simjoin
from odd_tables import no_docs, odd_docs  # noqa: F401


@pytest.fixture(scope="module")
def stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stage(spark, out[-1], small).cache())
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for df in stages[1:-1]:
        assert df.schema.simpleString() == stages[0].schema.simpleString()


def test_quality_goes_by_score(spark, stages, small):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    good = quality.quality_scores(stages[0], labels).where("predicted = 1")
    assert ids(stages[1]) == ids(good)


def test_line_dedup_keeps_first_holders(stages):
    before = {r["doc_id"]: r for r in stages[1].collect()}
    after = {r["doc_id"]: r for r in stages[2].collect()}
    held = set()
    for doc in sorted(before):
        lines = before[doc]["text"].split("\n")
        left = after[doc]["text"].split("\n") if doc in after else []
        gone = lines if doc not in after else [x for x in lines if x not in left]
        assert {x.strip() for x in gone if x.strip()} <= held
        held |= {x.strip() for x in lines}
        if doc in after:
            assert after[doc]["n_chars"] == (len(after[doc]["text"]) if after[doc]["text"] != before[doc]["text"] else before[doc]["n_chars"])
    # No later document keeps a line of many words that stands in an earlier one.
    seen = defaultdict(list)
    for doc in sorted(after):
        for line in set(after[doc]["text"].split("\n")):
            if len(line.split()) > 50:
                seen[line.strip()].append(doc)
    assert all(len(v) == 1 for v in seen.values())


def test_one_of_each_group_stays(stages):
    rows = sorted((r["doc_id"], r["text"]) for r in stages[2].collect())
    words = {i: t.lower().split() for i, t in rows}
    sets = {i: {tuple(w[n : n + 5]) for n in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    keep, group = [], {}
    for i, _ in rows:
        group[i] = i
    top = lambda i: i if group[i] == i else top(group[i])
    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                group[b] = a
    keep = [i for i in group if top(i) == i]
    assert ids(stages[3]) == sorted(keep)


def test_leaks_go_and_nothing_else(spark, stages, small):
    bench = spark.read.parquet(f"{small}/benchmark.parquet").collect()
    index = decontam.Index([(r["item_id"], r["text"]) for r in bench])
    clean = [r["doc_id"] for r in stages[3].collect() if not list(index.search([r["text"]]))]
    assert ids(stages[4]) == sorted(clean)


def test_packing_holds_every_document(stages):
    assert sorted({r["doc_id"] for r in stages[5].collect()}) == ids(stages[4])


def test_run_equals_its_stages(spark, stages, small):
    one = sorted(tuple(r) for r in corpus_pipeline.run(spark, small).collect())
    assert one == sorted(tuple(r) for r in stages[-1].collect())


def test_odd_tables(spark, small, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        bench = spark.read.parquet(f"{small}/benchmark.parquet")
        labels = spark.read.parquet(f"{small}/labels.parquet")
        df = quality.keep_good(docs, labels, 0.0)
        df = linededup.dedup_lines(df).drop("n_deleted")
        df = decontam.without_leaks(simjoin.one_of_each(df), bench)
        assert df.columns == docs.columns and packing.pack(df).count() >= df.count()
