import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadenza.operators import quantiles


def summary(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return quantiles.describe(df, ["x"], 9).first()


@pytest.mark.parametrize("values", [
    [1.0], [2.0, 1.0], [5.0] * 7, [1.0, None, 3.0, float("nan")], list(np.random.default_rng(1).normal(size=2001)),
    [0.0] * 900 + [1e300, -1e300, 1e-300] + list(range(97)), list(np.random.default_rng(2).integers(0, 24, 500).astype(float)),
])
def test_quartiles_match_numpy(spark, values):
    got = summary(spark, [None if v is None else float(v) for v in values])
    clean = np.array([v for v in values if v is not None and v == v], dtype=float)
    assert got["count"] == len(clean)
    want = np.percentile(clean, [0, 25, 50, 75, 100])
    assert np.allclose([got[c] for c in ("min", "q25", "q50", "q75", "max")], want, rtol=1e-9, atol=1e-8)


def test_empty_column(spark):
    got = summary(spark, [None])
    assert got["count"] == 0 and got["q50"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60), rank=st.integers(0, 59))
def test_any_rank(spark, values, rank):
    rank = min(rank, len(values) - 1)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = quantiles.order_statistics(df, {"x": [rank]}, {"x": (min(values), max(values))})
    assert found["x", rank] == sorted(values)[rank]


def test_all_columns_take_two_scans(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = {"a": rng.normal(size=30_000), "b": rng.exponential(size=30_000) * 1e6, "c": rng.integers(0, 5, 30_000).astype(float)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values(), strict=True)], "a double, b double, c double")
    scans, rows = [], []
    melted, selected = quantiles._melted, quantiles._selected

    def counted(values, intervals):
        rows.append(values.count())
        return selected(values, intervals)

    monkeypatch.setattr(quantiles, "_melted", lambda *given: scans.append(given[1]) or melted(*given))
    monkeypatch.setattr(quantiles, "_selected", counted)
    got = {r["column"]: r for r in quantiles.describe(df, ["a", "b", "c"], 9).collect()}
    for c, values in data.items():
        assert np.allclose([got[c][q] for q in ("q25", "q50", "q75")], np.percentile(values, [25, 50, 75]), rtol=1e-9, atol=1e-8)
    # One scan after the sketch's, whatever the columns; another is for ranks that were missed, of which there are none.
    assert scans == [["a", "b", "c"]]
    # What ranks are selected from is a small part of the 90,000 values.
    assert rows[0] < 90_000 * 2 * 3 * (quantiles.REACH + 1) / quantiles.ACCURACY + 10


def test_brackets_that_miss_their_ranks_cost_scans_only(spark):
    values = [float(x) for x in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for spans in ([(400.0, 420.0)], [(-5.0, -1.0)], [(10.0, 10.0), (249.0, 251.0)]):
        assert quantiles._bracketed(df, {"x": [10, 250, 499]}, {"x": (0.0, 499.0)}, {"x": spans}) == {("x", r): float(r) for r in (10, 250, 499)}
