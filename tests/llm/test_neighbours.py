import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.llm import neighbours


def brute(rows, asked, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 4 and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i, tuple(v)] = np.array(v, dtype=np.float64)
    out = set()
    for (q, _), x in good.items():
        if not asked(q):
            continue
        best = {}
        for (i, _), v in good.items():
            if i != q:
                best[i] = min(best.get(i, np.inf), float(np.sqrt(((x - v) ** 2).sum())))
        out |= {(q, n + 1, i, round(d, 12)) for n, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:k])}
    return out


def got(df):
    return {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in df.collect()}


@pytest.mark.parametrize("kind", ["double", "float"])
def test_small_tables_are_exact(spark, kind):
    rng = np.random.default_rng(1)
    grid = lambda: (rng.integers(-8, 9, 4) / 4).tolist()
    rows = [(i, grid()) for i in range(60)]
    rows += [(100 + i, [0.5, 0.25, 0.0, 1.0]) for i in range(30)]  # copies
    rows += [(None, grid()), (200, None), (201, [0.0] * 4), (202, [1.0, None, 0.0, 0.0]), (203, [float("nan"), 1.0, 1.0, 1.0]),
             (204, [float("inf"), 1.0, 1.0, 1.0]), (205, [1.0, 2.0]), rows[3], (rows[4][0], grid())]
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, node string, rank int")
    result = neighbours.nearest(table, F.col("vec_id") % 5 == 0, 10)
    assert got(result) == brute(rows, lambda q: q % 5 == 0, 10)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 5 == 0).count() == 0
    few = table.where("vec_id in (0, 1, 2)")
    assert got(neighbours.nearest(few, F.col("vec_id") == 0)) == brute([r for r in rows if r[0] in (0, 1, 2)], lambda q: q == 0, 10)
    assert neighbours.nearest(table.where("vec_id = 7"), F.lit(True)).count() == 0


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = table.select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in data], dtype=np.float64)
    ids = np.array([r["vec_id"] for r in data])
    found = neighbours.nearest(table, F.col("vec_id") % 100 == 0).collect()
    near = {}
    for r in found:
        near.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in near:
        d = ((x - x[ids == q]) ** 2).sum(axis=1)
        d[ids == q] = np.inf
        hits += len(near[q] & set(ids[np.argsort(d)[:10]].tolist()))
    assert len(near) == (ids % 100 == 0).sum() and hits >= 0.9 * 10 * len(near)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_recall_beside_very_long_vectors(spark, kind):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 16))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    x[:500] *= rng.choice([1e-3, 1e3], 500)[:, None]
    x[500:505, 0] = 1e4, -1e6, 3e8, 1e4, 30
    x = x.astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id bigint, embedding array<{kind}>")
    near = {}
    for r in neighbours.nearest(table, F.col("vec_id") % 20 == 0).collect():
        near.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = 0
    for q in near:
        d = ((x - x[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        hits += len(near[q] & set(np.argsort(d)[:10].tolist()))
    assert len(near) == 100 and hits >= 0.9 * 10 * len(near)
