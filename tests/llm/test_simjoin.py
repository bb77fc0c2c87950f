import random
from collections import Counter, defaultdict

import pytest
from conftest import rows

from cadenza.llm import queries, simjoin
from odd_tables import no_docs, odd_docs  # noqa: F401


def shingles(text):
    words = (text or "").lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(docs, threshold=0.8):
    """(class, links) of each row, by all pairs."""
    sets = [shingles(t) for _, t in docs]
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= threshold * len(a | b):
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (own, _) in enumerate(docs):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        known = [docs[j][0] for j in seen if docs[j][0] is not None]
        out.append((own, min(known) if known else None, len(near[i])))
    return Counter(out)


def family(rng, n, words, changes):
    """Near copies of one text: each differs in a few words of its own."""
    base = [f"b{rng.randint(0, 9999)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(words)] = f"n{rng.randint(0, 9999)}"
        out.append(" ".join(own))
    return out


def make(seed, families=25):
    rng = random.Random(seed)
    texts = [t for _ in range(families) for t in family(rng, rng.randint(1, 6), rng.randint(3, 120), 3)]
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [passage + " " + " ".join(f"u{rng.randint(0, 99999)}" for _ in range(rng.randint(5, 40))) for _ in range(40)]
    texts += [None, "", "  ", "one two", "One  TWO", texts[0], texts[0], texts[3].upper()]
    return [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[5]), (None, "alone in the world by itself today")]


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "class_id", "n_links").collect())


@pytest.mark.parametrize("seed,limit", [(1, 512), (2, 8), (3, 3)])
def test_equals_brute_force(spark, monkeypatch, seed, limit):
    # Small limits force deep trees and blocks of dense nodes.
    monkeypatch.setattr(simjoin, "BLOCK", max(2, limit // 2))
    docs = make(seed)
    table = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id bigint, text string, rid string, class_id string")
    assert found(simjoin.similar(table, limit=limit)) == brute(docs)


def test_one_of_each_class_stays(spark):
    docs = make(4)
    table = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id bigint, text string, blank string, key_id string")
    kept = [(r["doc_id"], r["text"]) for r in simjoin.one_of_each(table).collect()]
    classes = defaultdict(list)
    for (own, cls, _), (_, text) in zip(per_row(docs), docs, strict=True):
        if shingles(text):
            classes[cls, None if cls is not None else text].append((own is None, own, text))
    blank = [(i, t) for i, t in docs if not shingles(t)]
    assert Counter(kept) == Counter([*[min(c)[1:] for c in classes.values()], *blank])
    assert simjoin.one_of_each(table).columns == table.columns


def per_row(docs):
    out = []
    sets = [shingles(t) for _, t in docs]
    for i, (own, _) in enumerate(docs):
        seen, todo = {i}, [i]
        while todo:
            a = sets[todo.pop()]
            for j, b in enumerate(sets):
                if j not in seen and a and b and len(a & b) >= 0.8 * len(a | b):
                    seen.add(j)
                    todo.append(j)
        known = [docs[j][0] for j in seen if docs[j][0] is not None]
        out.append((own, min(known) if known else None, 0))
    return out


def test_recall_at_the_threshold(spark):
    """Pairs close to the threshold among many that share half their words, in deep trees."""
    rng = random.Random(11)
    texts = []
    shared = [f"s{i}" for i in range(60)]
    for _ in range(60):
        own = shared[:45] + [f"o{rng.randint(0, 10**6)}" for _ in range(40)]
        texts.append(" ".join(own))
        twin = list(own)
        twin[-5:] = [f"t{rng.randint(0, 10**6)}" for _ in range(5)]
        texts.append(" ".join(twin))
    docs = list(enumerate(texts))
    got = found(simjoin.similar(spark.createDataFrame(docs, "doc_id bigint, text string"), limit=6))
    want = brute(docs)
    assert sum((want - got).values()) <= 0.02 * len(docs)


def test_runs_reach_the_target():
    runs, alive = simjoin.runs_for(), simjoin.survival()
    assert (1 - alive) ** runs <= 1 - simjoin.TARGET < (1 - alive) ** (runs - 1)


@pytest.mark.parametrize(("threshold", "changes"), [(0.5, 6), (0.6, 5), (0.7, 3)])
def test_lower_thresholds_reach_their_recall(spark, threshold, changes):
    rng = random.Random(int(100 * threshold))
    docs = list(enumerate(t for _ in range(60) for t in family(rng, 5, 60, changes)))
    got = found(simjoin.similar(spark.createDataFrame(docs, "doc_id bigint, text string"), threshold, limit=8))
    want = brute(docs, threshold)
    links = sum(n * k for (_, _, n), k in want.items())
    assert links > 300 and sum(n * k for (_, _, n), k in got.items()) >= 0.99 * links
    assert sum((want - got).values()) <= 0.02 * len(docs)


def test_what_cannot_be_reached_is_said():
    for threshold in (0.4, 0.5, 0.6, 0.7, 0.8, 0.95):
        assert simjoin.runs_for(threshold, branch=simjoin.branch_for(threshold)) <= simjoin.PLACES
    for threshold, target, branch in ((0.5, 0.999, 1.5), (0.66, 0.999, 1.5), (0.2, 0.999, 6.0), (0.8, 1.0, 1.5)):
        with pytest.raises(ValueError):
            simjoin.runs_for(threshold, target, branch)
    for threshold in (0.0, 1.5):
        with pytest.raises(ValueError):
            simjoin.branch_for(threshold)


def test_odd_rows(odd_docs, no_docs):
    got = simjoin.similar(odd_docs)
    want = brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert found(got) == want
    assert simjoin.similar(no_docs).count() == 0 and simjoin.one_of_each(no_docs).count() == 0


def test_equals_sql(spark, small):
    from check_queries import differences, duck

    con = duck(small)
    for name, sql in queries.ORACLE_SQL.items():
        assert differences(queries.QUERIES[name](spark, small), con, sql) == [], name
    assert rows(spark.range(1)) == [(0,)]
