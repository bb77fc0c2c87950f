import numpy as np
import pytest
from conftest import rows
from pyspark.ml.evaluation import RankingEvaluator
from pyspark.sql import functions as F

from cadenza.operators import clusters, content, evaluation, factors, features, hybrid, ids, plays
from cadenza.sources import bindings as B


@pytest.fixture(scope="module")
def listening(spark, small):
    return B.event_plays(spark, small), B.embedding_tracks(spark, small)


@pytest.fixture(scope="module")
def als(listening):
    return factors.fit_als(listening[0], rank=8, max_iter=3)


def check_lists(recs, score, k, users, heard=None):
    per_user = {}
    for r in recs.collect():
        per_user.setdefault(r["user_id"], []).append((r["rank"], r[score], r["track_id"]))
    assert len(per_user) == users
    for entries in per_user.values():
        entries.sort()
        assert [e[0] for e in entries] == list(range(1, k + 1))
        assert all(a[1] >= b[1] - 1e-9 for a, b in zip(entries, entries[1:], strict=False))
        assert len({e[2] for e in entries}) == k
    if heard is not None:
        assert recs.join(heard, ["user_id", "track_id"]).count() == 0


def test_als_lists(listening, als):
    p, t = listening
    users = p.select("user_id").distinct().count()
    heard = plays.heard_pairs(p)
    check_lists(factors.factor_recommendations(als, t, 10, exclude=heard), "predicted_score", 10, users, heard)
    check_lists(factors.factor_recommendations(als, t, 10), "predicted_score", 10, users)


def test_als_lists_equal_the_models_own(listening, als):
    p, t = listening
    mine = factors.factor_recommendations(als, t, 10, digits=12)
    names = {r["user_idx"]: r["user_id"] for r in als.train.select("user_idx", "user_id").distinct().collect()}
    theirs = als.model.recommendForAllUsers(10).select("user_idx", F.explode("recommendations").alias("r"))
    want, got = {}, {}
    for r in theirs.collect():
        want.setdefault(names[r["user_idx"]], []).append(r["r"]["rating"])
    for r in mine.collect():
        got.setdefault(r["user_id"], []).append(r["predicted_score"])
    assert want.keys() == got.keys()
    for u in want:
        assert np.allclose(sorted(want[u]), sorted(got[u]), atol=1e-5)


def test_als_blocks_and_errors(als):
    errors = dict(rows(evaluation.rating_errors(als.predictions)))
    assert errors["RMSE"] >= errors["MAE"] > 0
    assert als.train.count() + als.test.count() > als.predictions.count() > 0


def test_svd_matches_numpy(spark, listening):
    p, _ = listening
    fit = factors.fit_svd(p, rank=5, most_active_users=12, most_played_tracks=40)
    triples = fit.train.select("user_idx", "track_idx", "implicit_rating").collect()
    a = np.zeros((12, 40))
    for u, i, w in triples:
        a[u, i] = w
    left, s, right = np.linalg.svd(a, full_matrices=False)
    best = (left[:, :5] * s[:5]) @ right[:5]
    index = {r["user_id"]: r["user_idx"] for r in fit.train.union(fit.test).select("user_id", "user_idx").distinct().collect()}
    tindex = {r["track_id"]: r["track_idx"] for r in fit.train.union(fit.test).select("track_id", "track_idx").distinct().collect()}
    checked = fit.predictions.collect()
    assert checked
    for r in checked:
        assert r["prediction"] == pytest.approx(best[index[r["user_id"]], tindex[r["track_id"]]], abs=1e-8)


def test_svd_of_everything_gives_every_listener_a_list(spark, listening):
    p, t = listening
    fit = factors.fit_svd(p, rank=6)
    users = fit.train.select("user_id").distinct().count()
    recs = factors.factor_recommendations(fit, t, 3)
    assert recs.select("user_id").distinct().count() == users
    triples = fit.train.select("user_idx", "track_idx", "implicit_rating").collect()
    a = np.zeros((1 + max(r[0] for r in triples), 1 + max(r[1] for r in triples)))
    for u, i, w in triples:
        a[u, i] = w
    want = (np.linalg.svd(a, compute_uv=False)[:6] ** 2).sum()
    got = sum(sum(x * x for x in r["vector"]) for r in fit.users.collect())
    assert got == pytest.approx(want, rel=1e-9)


def _dense(train, columns="user_idx, track_idx, implicit_rating"):
    triples = train.select(*columns.split(", ")).collect()
    a = np.zeros((1 + max(r[0] for r in triples), 1 + max(r[1] for r in triples)))
    for u, i, w in triples:
        a[u, i] = w
    return a


def test_svd_of_the_given_plays_converges(spark):
    fit = factors.fit_svd(B.event_plays(spark, "/root/testdata/sf0.01"))
    want = np.linalg.svd(_dense(fit.train), compute_uv=False)[:50]
    assert fit.settled and 0 < fit.steps < factors.MAX_STEPS
    assert np.abs(np.array(fit.singular_values) - want).max() < 1e-6
    v = np.array([r["vector"] for r in fit.tracks.collect()])
    u = np.array([r["vector"] for r in fit.users.collect()])
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-9
    assert np.abs(u.T @ u - np.diag(want**2)).max() < 1e-6 * want[0] ** 2


@pytest.mark.parametrize("cell", [65_536, 37])
def test_svd_restarts_in_any_cells(spark, monkeypatch, cell):
    """A flat spectrum needs more blocks than are held; one track has a rating of every user."""
    rng = np.random.default_rng(8)
    pairs = sorted({(int(u), int(t)) for u, t in zip(rng.integers(0, 260, 4000), rng.integers(0, 150, 4000))} | {(u, 3) for u in range(260)})
    rated = [(u, t, int(w)) for (u, t), w in zip(pairs, rng.integers(1, 9, len(pairs)), strict=True)]
    frame = spark.createDataFrame(rated, "user_idx int, track_idx int, implicit_rating bigint")
    monkeypatch.setattr(factors, "CELL_ROWS", cell)
    sizes = {"user_idx": 260, "track_idx": 150}
    vectors, values, steps, settled = factors.truncated_svd(frame, sizes, 4)
    a = _dense(frame)
    _, want, right = np.linalg.svd(a)
    assert settled and steps > factors.HELD_BLOCKS
    assert np.abs(values - want[:4]).max() < 1e-9 * want[0]
    got = np.zeros((150, 4))
    for r in vectors.collect():
        got[r["track_idx"]] = r["vector"]
    assert np.abs(np.abs((right[:4] @ got)) - np.eye(4)).max() < 1e-5
    if cell == 37:
        return
    few = factors.truncated_svd(frame, sizes, 4, max_steps=1)
    assert not few[3] and few[2] == 1


def test_cells_hold_no_null_vectors(spark):
    # Null lists are what made a product take 18 microseconds a rating, 1 with empty ones.
    ratings = spark.createDataFrame([(u, u % 3, 2) for u in range(9)], "user_idx int, track_idx int, implicit_rating bigint")
    vectors = spark.createDataFrame([(t, [1.0, float(t)]) for t in range(3)], "track_idx int, vector array<double>")
    cells = factors._cells(ratings, vectors, "track_idx", "user_idx", 1, 2)
    assert cells.where("vector IS NULL").count() == 0 and cells.where("size(vector) = 0").count() == 9


def test_svd_of_nothing_and_of_less_than_the_rank(spark):
    empty = spark.createDataFrame([], "user_idx int, track_idx int, implicit_rating bigint")
    vectors, values, steps, settled = factors.truncated_svd(empty, {"user_idx": 0, "track_idx": 0}, 4)
    assert vectors.count() == 0 and len(values) == 0 and steps == 0 and settled
    one = spark.createDataFrame([(0, 0, 3), (1, 0, 4)], empty.schema)
    vectors, values, _, settled = factors.truncated_svd(one, {"user_idx": 2, "track_idx": 1}, 4)
    assert settled and values.tolist() == pytest.approx([5.0]) and vectors.count() == 1


@pytest.mark.parametrize("pairs", [100_000, 3])
def test_fold_in_is_a_half_step(spark, als, pairs):
    """Listeners unknown to the model, one with a rating of every track, against numpy."""
    vectors = {r["track_id"]: np.array(r["vector"]) for r in als.tracks.collect()}
    known = sorted(vectors)
    rng = np.random.default_rng(11)
    rated = [(900 + u, t, int(rng.integers(1, 9))) for u in range(6) for t in rng.choice(known, 4 + u, replace=False).tolist()]
    rated += [(950, t, 2) for t in known] + [(960, known[0], 1), (960, -5, 3), (970, -5, 3), (980, known[1], 0)]
    ratings = spark.createDataFrame(rated, "user_id bigint, track_id bigint, implicit_rating bigint")
    got = {r["user_id"]: np.array(r["vector"]) for r in factors.fold_in(als.tracks, ratings, 0.1, 40.0, pairs).collect()}
    y = np.array(list(vectors.values()))
    assert set(got) == {*range(900, 906), 950, 960}
    for user, x in got.items():
        mine = [(vectors[t], 40.0 * w) for u, t, w in rated if u == user and t in vectors and w > 0]
        normal = y.T @ y + sum(c * np.outer(v, v) for v, c in mine) + 0.1 * len(mine) * np.eye(8)
        assert x == pytest.approx(np.linalg.solve(normal, sum((1 + c) * v for v, c in mine)), rel=1e-8, abs=1e-10)


def test_fold_in_of_a_known_listener_is_the_models_next_half_step(spark, als):
    """After the last half-step, of the tracks, a further one of the users stays close to the model's users."""
    again = {r["user_id"]: np.array(r["vector"]) for r in factors.fold_in(als.tracks, als.train.select("user_id", "track_id", "implicit_rating")).collect()}
    model = {r["user_id"]: np.array(r["vector"]) for r in als.users.collect()}
    assert set(again) == set(model)
    cosines = [x @ model[u] / np.linalg.norm(x) / np.linalg.norm(model[u]) for u, x in again.items()]
    assert min(cosines) > 0.9


def test_fold_in_gives_lists_to_new_listeners(spark, als, listening):
    _, t = listening
    ratings = als.test.select((F.col("user_id") + 10_000).alias("user_id"), "track_id", "implicit_rating")
    recs = factors.fold_in_recommendations(als, ratings, t, 5)
    assert recs.count() > 0 and recs.where("user_id < 10000").count() == 0
    assert recs.join(ratings, ["user_id", "track_id"]).count() == 0


def test_blocks_depend_on_the_ratings_only(spark):
    assert factors._blocks(1) == 1 and factors._blocks(25_000) == 3 and factors._blocks(10**7) == 20


def test_ranking_metrics_match_sparks(spark):
    rng = np.random.default_rng(4)
    recs = [(u, int(i), n + 1) for u in range(9) for n, i in enumerate(rng.permutation(30)[:10])]
    relevant = sorted({(u, int(i)) for u in range(8) for i in rng.integers(0, 30, 3 + 2 * u)})
    r = spark.createDataFrame(recs, "user_id int, track_id int, rank int")
    w = spark.createDataFrame(relevant, "user_id int, track_id int")
    got = dict(rows(evaluation.ranking_metrics(r, w, 10)))
    lists = (
        w.groupBy("user_id").agg(F.collect_list(F.col("track_id").cast("double")).alias("label"))
        .join(r.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "track_id"))).alias("l")), "user_id")
        .select("label", F.col("l.track_id").cast("array<double>").alias("prediction"))
    )
    for ours, theirs in {"precision@10": "precisionAtK", "ndcg@10": "ndcgAtK", "map@10": "meanAveragePrecisionAtK"}.items():
        assert got[ours] == pytest.approx(RankingEvaluator(metricName=theirs, k=10).evaluate(lists), abs=1e-12)


def test_dense_ids_are_dense_and_ordered(spark):
    names = spark.createDataFrame([("b",)] * 3 + [("a",)] * 3 + [("z",)] * 9 + [("q",)] + [(None,)], "k string")
    assert rows(ids.dense_ids(names.repartition(5), "k", "i")) == [("a", 1), ("b", 2), ("q", 3), ("z", 0)]
    many = spark.range(5000).selectExpr("concat('n', id) as k")
    got = [r["i"] for r in ids.dense_ids(many, "k", "i").collect()]
    assert sorted(got) == list(range(5000))


def test_split_is_whole_and_repeatable(als):
    coded = als.train.unionByName(als.test)
    one, two = ids.hash_split(coded), ids.hash_split(coded.repartition(3))
    assert rows(one[0], "user_id", "track_id") == rows(two[0], "user_id", "track_id")
    share = one[0].count() / coded.count()
    assert 0.75 < share < 0.85


def test_split_is_fair_to_every_residue(spark):
    pairs = spark.range(200).crossJoin(spark.range(200).withColumnRenamed("id", "t")).selectExpr("cast(id as int) user_idx", "cast(t as int) track_idx")
    held = ids.hash_split(pairs)[1]
    for c in ("user_idx", "track_idx"):
        shares = [r["n"] / 4000 for r in held.groupBy(F.col(c) % 10).agg(F.count("*").alias("n")).collect()]
        assert len(shares) == 10 and all(0.15 < s < 0.25 for s in shares)
    per_user = [r["n"] for r in held.groupBy("user_idx").agg(F.count("*").alias("n")).collect()]
    assert len(per_user) == 200 and min(per_user) > 10 and max(per_user) < 80


def test_content_lists(listening):
    p, t = listening
    heard = plays.heard_pairs(p)
    near = content.content_recommendations(p, t, 10)
    check_lists(near, "similarity_score", 10, p.select("user_id").distinct().count(), heard)
    few = p.select("user_id").distinct().orderBy("user_id").limit(2)
    assert content.content_recommendations(p, t, 3, users=few).count() == 6


def test_lists_are_made_once(spark, listening):
    _, t = listening
    made = spark.range(5).selectExpr("id AS user_id", "id AS track_id").mapInArrow(lambda batches: batches, "user_id bigint, track_id bigint")
    named = content.with_metadata(made, t)
    assert "MapInArrow" not in named._jdf.queryExecution().optimizedPlan().toString() and named.count() == 5


def test_hybrid_lists(listening, als):
    p, t = listening
    near = hybrid.hybrid_recommendations(p, t, 5)
    check_lists(near, "hybrid_score", 5, p.select("user_id").distinct().count(), plays.heard_pairs(p))
    blend = (als.users, als.tracks)
    check_lists(hybrid.hybrid_recommendations(p, t, 5, factors=blend), "hybrid_score", 5, near.select("user_id").distinct().count())


def test_hybrid_without_content_is_popularity(listening):
    p, t = listening
    only = hybrid.hybrid_recommendations(p, t, 1, cf_weight=1.0, content_weight=0.0)
    counts = dict(rows(plays.play_counts(p)))
    heard = {}
    for u, i in rows(plays.heard_pairs(p)):
        heard.setdefault(u, set()).add(i)
    for r in only.collect():
        unheard = {i: n for i, n in counts.items() if i not in heard[r["user_id"]]}
        assert counts.get(r["track_id"], 0) == max(unheard.values(), default=0)


def test_cold_start(spark, play_table, track_table, user_table):
    got = rows(hybrid.cold_start_recommendations(play_table, track_table, user_table, 2), "user_id", "rank", "track_id")
    assert got == [("u3", 1, "t1"), ("u3", 2, "t2"), ("u4", 1, "t1"), ("u4", 2, "t2")]
    seeds = rows(hybrid.seed_genre_recommendations(play_table, track_table, user_table, 1), "user_id", "track_id")
    assert seeds == [("u3", "t1"), ("u4", "t1")]


def test_feature_scaling(spark):
    t = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, 5.0)], "track_id int, x double, y double")
    assert rows(features.minmax_scaled(t.where("x is not null"), ["x", "y"])) == [(1, 0.0, 0.5), (2, 1.0, 0.5)]
    got = features.standardised(t.where("x is not null"), ["x", "y"]).orderBy("track_id").collect()
    assert got[0]["x"] == pytest.approx(-1 / np.sqrt(2)) and got[0]["y"] == 0.0
    assert features.drop_incomplete(t, ["x"]).count() == 2


def test_clusters(listening):
    _, t = listening
    vectors = clusters.feature_vectors(t)
    model = clusters.fit_clusters(vectors, starts=2)
    assigned = clusters.track_clusters(vectors, model)
    assert assigned.count() == t.count()
    assert {r["cluster"] for r in assigned.select("cluster").distinct().collect()} <= set(range(6))
    assert sum(r["track_count"] for r in clusters.cluster_profile(vectors, model).collect()) == t.count()
    assert -1 <= clusters.silhouette(vectors, model).first()["silhouette"] <= 1
    assert clusters.cluster_labels(model, vectors, labels={0: "Calm"}).first()["label"] == "Calm"
    costs = [r["inertia"] for r in clusters.elbow(vectors, range(2, 6)).orderBy("k").collect()]
    assert all(b <= a * 1.02 for a, b in zip(costs, costs[1:], strict=False))
    other = clusters.feature_vectors(t, ["energy", "valence"], ["minmax", "standard"])
    assert clusters.fit_clusters(other, 3).getK() == 3


def test_principal_components_match_numpy(listening):
    _, t = listening
    vectors = clusters.feature_vectors(t)
    scores, variance = clusters.principal_components(vectors)
    x = np.array([r["features"].toArray() for r in vectors.orderBy("track_id").collect()])
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    got = [r["explained_variance"] for r in variance.orderBy("component").collect()]
    assert np.allclose(got, values[:2] / values.sum())
    mine = np.array([(r["pc1"], r["pc2"]) for r in scores.orderBy("track_id").collect()])
    assert np.allclose(mine.var(axis=0, ddof=1), values[:2]) and np.allclose(mine.mean(axis=0), 0)
