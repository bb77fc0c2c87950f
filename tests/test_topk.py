import numpy as np
import pytest

from cadenza.operators import balls, bundles, topk


def frames(spark, users, items, seen=None, text_ids=False):
    name = (lambda p, i: f"{p}{i:04d}") if text_ids else (lambda p, i: i)
    kind = "string" if text_ids else "bigint"
    q = spark.createDataFrame(
        [(name("u", i), 0, [float(x) for x in v]) for i, v in enumerate(users)], f"user_id {kind}, probe int, vector array<double>"
    )
    t = spark.createDataFrame(
        [(name("t", i), [float(x) for x in v]) for i, v in enumerate(items)], f"track_id {kind}, vector array<double>"
    )
    s = None
    if seen is not None:
        s = spark.createDataFrame([(name("u", u), name("t", i)) for u, i in seen], f"user_id {kind}, track_id {kind}")
    return q, t, s


def brute(users, items, seen, k):
    out = {}
    for u, q in enumerate(users):
        scores = [(-round(float(np.dot(q, v)), 9), i) for i, v in enumerate(items) if (u, i) not in seen]
        out[u] = [i for _, i in sorted(scores)[:k]]
    return out


def result(hits, text_ids=False):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r["user_id"], r["rank"])):
        ident = (lambda x: int(x[1:])) if text_ids else int
        out.setdefault(ident(r["user_id"]), []).append(ident(r["track_id"]))
    return out


def data(seed, users=37, items=400):
    rng = np.random.default_rng(seed)
    vectors = np.round(rng.normal(size=(items, 3)), 2)
    vectors[: items // 3] = vectors[0]  # a third of the items are copies of one
    queries = np.round(rng.normal(size=(users, 3)), 2)
    queries[: users // 3] = queries[0]
    seen = {(int(u), int(i)) for u, i in zip(rng.integers(0, users, 900), rng.integers(0, items, 900))}
    seen |= {(0, i) for i in range(items)}  # this user has heard everything
    seen |= {(1, i) for i in range(items - 3)}  # this one all but three
    return queries, vectors, seen


@pytest.mark.parametrize("seed,block_items,text_ids", [(1, 4096, True), (1, 50, False), (12, 100, False), (90, 7, True)])
def test_equals_brute_force(spark, seed, block_items, text_ids):
    queries, items, seen = data(seed)
    q, t, s = frames(spark, queries, items, sorted(seen), text_ids)
    got = result(topk.top_k_dot(q, t, 5, s, block_items=block_items), text_ids)
    want = brute(queries, items, seen, 5)
    assert got == {u: w for u, w in want.items() if w}


@pytest.mark.parametrize("at_once", [(1, 1), (3, 11), (256, 40)])
def test_equals_brute_force_in_any_steps(spark, monkeypatch, at_once):
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", at_once[0])
    monkeypatch.setattr(topk, "ITEMS_AT_ONCE", at_once[1])
    queries, items, seen = data(5, users=20, items=150)
    q, t, s = frames(spark, queries, items, sorted(seen))
    got = result(topk.top_k_dot(q, t, 3, s))
    assert got == {u: w for u, w in brute(queries, items, seen, 3).items() if w}


def test_users_may_span_batches(spark):
    queries, items, seen = data(6)
    q, t, s = frames(spark, queries, items, sorted(seen))
    both = q.unionByName(q.selectExpr("user_id", "1 as probe", "vector"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for block_items in (100, 4096):
            hits = topk.top_k_dot(both, t, 5, s, block_items=block_items).cache()
            for probe in (0, 1):
                assert result(hits.where(f"probe = {probe}")) == {u: w for u, w in brute(queries, items, seen, 5).items() if w}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_without_seen_and_with_more_wanted_than_items(spark):
    queries, items, _ = data(7, users=5, items=30)
    q, t, _ = frames(spark, queries, items)
    for block_items in (6, 4096):
        got = result(topk.top_k_dot(q, t, 50, block_items=block_items))
        assert got == brute(queries, items, set(), 50)


def test_seen_items_outside_the_catalogue_and_no_items(spark):
    queries, items, _ = data(8, users=4, items=20)
    q, t, s = frames(spark, queries, items, [(0, 999), (0, 3), (0, 3)])
    assert result(topk.top_k_dot(q, t, 2, s)) == brute(queries, items, {(0, 3)}, 2)
    assert topk.top_k_dot(q, t.where("track_id < 0"), 2, s).count() == 0


def test_incomplete_vectors_take_no_part(spark):
    rows = [(0, [1.0, None]), (1, None), (2, [float("nan"), 1.0]), (3, [1.0, 2.0])]
    t = spark.createDataFrame(rows, "track_id bigint, vector array<double>")
    q = spark.createDataFrame([(i, 0, v) for i, v in rows] + [(None, 0, [1.0, 1.0])], "user_id bigint, probe int, vector array<double>")
    assert [(r["user_id"], r["track_id"]) for r in topk.top_k_dot(q, t, 2).collect()] == [(3, 3)]


def test_probes_are_separate(spark):
    queries, items, _ = data(9, users=3, items=40)
    q, t, _ = frames(spark, queries, items)
    both = q.unionByName(q.selectExpr("user_id", "1 as probe", "transform(vector, x -> -x) as vector"))
    for block_items in (8, 4096):
        hits = topk.top_k_dot(both, t, 1, digits=None, block_items=block_items).collect()
        assert len(hits) == 6
        for r in hits:
            products = items @ queries[r["user_id"]] * (1 if r["probe"] == 0 else -1)
            assert r["score"] == pytest.approx(products.max(), abs=1e-12)


def wide(spark, n, dims, key, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dims).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, f"{key} bigint, vector array<double>"), np.array([r[1] for r in rows])


def test_many_dimensions_plan_and_shuffle_little(spark):
    t, items = wide(spark, 900, 64, "track_id", 1)
    q, queries = wide(spark, 50, 64, "user_id", 2)
    hits = topk.top_k_dot(q.selectExpr("user_id", "0 as probe", "vector"), t, 4, block_items=300)
    assert result(hits) == brute(queries, items, set(), 4)
    # A query goes to each block once: 3 blocks, one copy of each item for 4 partitions.
    text = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in text and "Join" not in text
    asked = topk._scored(q.selectExpr("user_id", "0 as probe", "vector"), t, None, topk._Spec(4, 9, q.schema[0].dataType, t.schema[0].dataType), 3, 1)
    assert asked.count() <= 50 * 3 * 4


def clustered(seed, users=60, items=1200, groups=12, dims=64):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    spread = lambda n: np.round(centres[rng.integers(0, groups, n)] + 0.05 * rng.normal(size=(n, dims)), 6)
    vectors, queries = spread(items), spread(users)
    return queries, vectors, {(int(u), int(i)) for u, i in zip(rng.integers(0, users, 900), rng.integers(0, items, 900))}


def test_queries_are_sent_to_few_blocks_of_clustered_items(spark):
    queries, items, seen = clustered(3)
    q, t, s = frames(spark, queries, items, sorted(seen))
    held, groups = balls.grouped(t, 12, 100)
    sent = balls.asked(q, s, groups, 5, 1e-9)
    # Every query to every block would be 60 rows a block, of 12 blocks at least.
    assert groups.blocks.sum() >= 12 and sent.count() <= 60 * groups.blocks.sum() / 4
    assert held.groupBy("chunk").count().agg({"count": "max"}).first()[0] <= 200
    assert result(topk.top_k_dot(q, t, 5, s, block_items=100)) == brute(queries, items, seen, 5)


def test_balls_hold_their_items_and_bounds_hold(spark):
    queries, items, _ = clustered(4, users=20, items=300, groups=5, dims=6)
    _, t, _ = frames(spark, queries, items)
    held, groups = balls.grouped(t, 7, 50)
    rows = held.collect()
    assert sorted(r["track_id"] for r in rows) == list(range(300)) and groups.count.sum() == 300
    of_block = np.repeat(np.arange(len(groups.blocks)), groups.blocks)
    for r in rows:
        ball = of_block[r["chunk"]]
        assert np.linalg.norm(np.array(r["vector"]) - groups.centres[ball]) <= groups.radius[ball] + 1e-12
    # The groups reached hold every one of the best.
    place = {r["track_id"]: of_block[r["chunk"]] for r in rows}
    for wanted in (1, 10, 299, 1000):
        row, ball = balls._reached(queries, np.full(len(queries), wanted), groups, 1e-9)
        reached = set(zip(row.tolist(), ball.tolist(), strict=True))
        for u, best in brute(queries, items, set(), wanted).items():
            assert all((u, place[i]) in reached for i in best)


def test_vectors_of_no_and_of_endless_length(spark):
    items = [[0.0, 0.0]] * 40 + [[1.0, float("inf")]] + [[float(i), 1.0] for i in range(40)]
    q, t, _ = frames(spark, [[1.0, 0.0], [0.0, 0.0], [1.0, 1.0]], items)
    got = result(topk.top_k_dot(q, t.where("track_id <> 40"), 3, block_items=10))
    assert got == {0: [80, 79, 78], 1: [0, 1, 2], 2: [80, 79, 78]}
    # An item of endless length hides no other.
    assert result(topk.top_k_dot(q.where("user_id = 2"), t, 3, block_items=10)) == {2: [40, 80, 79]}


def test_bundles_bound_their_scores_and_spare_most_items():
    rng = np.random.default_rng(5)
    unit = rng.normal(1.0, 0.2, size=(20_000, 6))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    played = np.where(np.arange(20_000) < 50, rng.uniform(0.5, 1, 20_000), 0.0)
    items = np.column_stack([unit, played])
    # Profiles, which are means of many items, the same turned round, the popularity either way, both signals, and nothing.
    near = np.array([unit[rng.choice(20_000, 50)].mean(axis=0) for _ in range(40)])
    near /= np.linalg.norm(near, axis=1)[:, None]
    kinds = [np.column_stack([f * near, np.full(40, p)]) for f, p in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 0.2), (0, 0))]
    for kind, queries in enumerate(kinds):
        held = bundles.Bundles(queries, 40, [6, 1])
        assert sorted(held.order) == list(range(40)) and held.sizes.tolist() == [40]
        scores, upper = queries @ items.T, held.upper(items, 0)
        assert (scores.max(axis=0) <= upper + 1e-12).all()
        # By the product of lengths, every item may be the nearest of unit vectors.
        if kind not in (3, 5):
            assert (upper >= np.sort(scores, axis=1)[:, -10].min()).sum() < 2_000
    mixed = bundles.Bundles(np.concatenate(kinds), 40, [6, 1])
    assert mixed.sizes.max() <= 40 and mixed.sizes.sum() == 240
    for i, (low, n) in enumerate(zip(mixed.starts, mixed.sizes, strict=True)):
        rows = np.concatenate(kinds)[mixed.order[low : low + n]]
        assert ((rows @ items.T).max(axis=0) <= mixed.upper(items, i) + 1e-12).all()


def test_parts_change_no_result(spark):
    queries, items, seen = data(11)
    q, t, s = frames(spark, queries, items, sorted(seen))
    assert result(topk.top_k_dot(q, t, 5, s, widths=[2, 1])) == {u: w for u, w in brute(queries, items, seen, 5).items() if w}
    some = {r["user_id"]: r["score"] for r in topk.top_k_dot(q, t, 1, s, digits=None, tied=False).collect()}
    for u, best in brute(queries, items, seen, 1).items():
        assert not best or some[u] == pytest.approx(float(items[best[0]] @ queries[u]), abs=1e-11)
