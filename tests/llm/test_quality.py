import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from cadenza.llm import quality
from odd_tables import no_docs, odd_docs  # noqa: F401


def counted(text):
    return dict(zip(quality.COUNTS, quality._counted([text])[0], strict=True))


def test_counts_of_a_text():
    c = counted("Ab CD!! x1\n  é. Zoo")
    assert c["chars"] == 19 and c["words"] == 5 and c["distinct"] == 5 and c["lines"] == 1
    assert c["upper"] == 4 and c["digits"] == 1 and c["symbols"] == 2 and c["stops"] == 1 and c["caps"] == 1
    assert c["square"] == 4 + 16 + 4 + 4 + 9


def test_counts_do_not_mix_texts():
    texts = ["", "a b", "  ", "C", "", "dd\ne"]
    together = quality._counted(texts)
    for row, text in zip(together, texts, strict=True):
        assert np.array_equal(row, quality._counted([text])[0])
    assert quality._counted([]).shape == (0, len(quality.COUNTS))


def test_held_out_rows_teach_nothing_and_predict_well(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality_scores(docs, labels)
    again = quality.quality_scores(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    assert rows(got) == rows(again)
    judged = got.where("held_out").join(labels, "doc_id").collect()
    assert len(judged) > 50 and sum(r["predicted"] != r["quality"] for r in judged) <= 0.03 * len(judged)
    assert got.count() == docs.count()


def test_scores_match_the_density_formula(spark):
    rng = np.random.default_rng(1)
    dims = len(quality.RATIOS) + 3
    x = [rng.normal(size=(200, dims)) + 2 * k for k in (0, 1)]
    held = np.array([np.concatenate([[len(v)], v.sum(axis=0), (v.T @ v).ravel()]) for v in x])
    model = quality._model(held, np.ones(dims), dims)
    covariances = [np.cov(v.T, bias=True) for v in x]
    pooled = sum(covariances) / 2
    at = rng.normal(size=dims)
    logs = []
    for v, own in zip(x, covariances, strict=True):
        blended = (1 - quality.BLEND) * own + quality.BLEND * pooled
        c = (1 - quality.DIAGONAL) * blended + quality.DIAGONAL * np.diag(np.diag(blended)) + quality.RIDGE * np.eye(dims)
        gap = at - v.mean(axis=0)
        logs.append(-0.5 * gap @ np.linalg.solve(c, gap) - 0.5 * np.linalg.slogdet(c)[1] + np.log(0.5))
    mine = [model.constants[k] - 0.5 * ((model.factors[k] @ (at - model.means[k])) ** 2).sum() for k in (0, 1)]
    assert np.allclose(np.array(mine) - np.array(logs), mine[0] - logs[0])


def test_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (4, 0), (6, 1), (None, 1), (7, None), (8, 0)], "doc_id bigint, quality int")
    got = quality.quality_scores(odd_docs, labels).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (0, 1)}) == 1
    assert quality.quality_scores(no_docs, labels).count() == 0
    assert quality.quality_scores(odd_docs, labels.limit(0)).count() == odd_docs.count()
    kept = quality.keep_good(odd_docs, labels, 0.0)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
