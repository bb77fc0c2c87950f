"""Quality classifier: regularised quadratic discriminant over document statistics.

Counts of characters, words and lines are taken of each whole text in one pass.  Ratios of
counts, drawn towards the corpus rate by a few pseudo-counts so that short texts do not look
extreme, are transformed to near-normal scale.  Each class is a Gaussian whose covariance is
shrunk towards the pooled one and towards its diagonal.  The score is the logistic function of
the difference of log-densities plus the prior log-odds, from Mahalanobis distances by
Cholesky factors computed once at the fit.

Counts, sums and cross products are Spark aggregates; the driver holds one vector and one
matrix per class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import Once, code_points, ship, slices, sums
from cadenza.session import stored

# What is counted, and for each ratio: numerator, denominator, pseudo-count of the denominator.
COUNTS = ("chars", "letters", "upper", "digits", "stops", "symbols", "words", "distinct", "square", "lines", "caps")
RATIOS = (
    ("upper", "letters", 40.0), ("digits", "chars", 60.0), ("symbols", "chars", 60.0), ("stops", "words", 30.0),
    ("caps", "words", 10.0), ("lines", "words", 60.0),
)
PER_DISTINCT = 20.0
THRESHOLD = 0.7
BLEND, DIAGONAL, RIDGE = 0.1, 0.1, 1e-4


@Once
def _kinds() -> np.ndarray:
    """Per code point of the basic plane: 0 space, 1 lower letter, 2 upper letter, 3 digit, 4 stop, 5 symbol."""
    kinds = np.full(1 << 16, 5, dtype=np.uint8)
    for point in range(1 << 16):
        char = chr(point)
        if char.isspace():
            kinds[point] = 0
        elif char.isalpha():
            kinds[point] = 2 if char.isupper() else 1
        elif char.isdigit():
            kinds[point] = 3
        elif char in ".,;:?'\"-()":
            kinds[point] = 4
    return kinds


def _counted(texts: list[str]) -> np.ndarray:
    points, starts = code_points(texts)
    kinds = _kinds()[np.minimum(points, 0xFFFF)]
    kinds = np.where(points > 0xFFFF, np.uint8(1), kinds)
    first = np.zeros(len(points) + 1, dtype=bool)
    first[starts[:-1]] = True
    space = kinds == 0
    begins = ~space & (np.concatenate([[True], space[:-1]]) | first[:-1])
    ends = ~space & (np.concatenate([space[1:], [True]]) | np.concatenate([first[1:-1], [True]])[: len(points)])
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends)
    size = end - begin + 1
    words = np.searchsorted(begin, starts)
    upper = np.concatenate([[0], np.cumsum(kinds == 2)])
    lower = np.concatenate([[0], np.cumsum(kinds == 1)])
    caps = (upper[end + 1] - upper[begin] >= 2) & (lower[end + 1] == lower[begin])
    distinct = [len(set(t.split())) for t in texts]
    per = {
        "chars": starts[1:] - starts[:-1], "letters": sums((kinds == 1) | (kinds == 2), starts),
        "upper": sums(kinds == 2, starts), "digits": sums(kinds == 3, starts), "stops": sums(kinds == 4, starts),
        "symbols": sums(kinds == 5, starts), "words": words[1:] - words[:-1], "distinct": np.array(distinct),
        "square": sums(size * size, words), "lines": sums(points == 10, starts), "caps": sums(caps, words),
    }
    return np.column_stack([np.asarray(per[c], dtype=np.float64) for c in COUNTS]).reshape(len(texts), len(COUNTS))


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, counts) of every row; a null text counts as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                rows = _counted(texts)
                offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(COUNTS)
                values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), values], names=["doc_id", "counts"])

    picked = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(count, "doc_id bigint, counts array<double>")


@dataclass(frozen=True)
class Model:
    """Corpus rates and, for class 0 and 1, the mean, the inverse Cholesky factor and the constant term."""

    rates: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def features(self, counts: np.ndarray) -> np.ndarray:
        return _features(counts, self.rates)

    def score(self, counts: np.ndarray) -> np.ndarray:
        x = self.features(counts)
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants, strict=True):
            logs.append(constant - 0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1))
        return 1.0 / (1.0 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def _features(counts: np.ndarray, rates: np.ndarray) -> np.ndarray:
    c = {name: counts[:, i] for i, name in enumerate(COUNTS)}
    out = [
        np.arcsin(np.sqrt(np.clip((c[top] + weight * rate) / (c[bottom] + weight), 0, 1)))
        for (top, bottom, weight), rate in zip(RATIOS, rates, strict=False)
    ]
    length, square, spread = rates[len(RATIOS) :]
    solid = c["letters"] + c["digits"] + c["stops"] + c["symbols"]
    mean = (solid + 20 * length) / (c["words"] + 20)
    out.append(np.log(mean))
    out.append(0.5 * np.log((c["square"] + 20 * square) / (c["words"] + 20)) - np.log(mean))
    # Distinct words grow as a power of all words; the power is what tells repetition.
    out.append((np.log(c["distinct"] + PER_DISTINCT) - np.log(c["words"] + PER_DISTINCT)) * spread)
    return np.column_stack(out)


def fit(counted: DataFrame, labels: DataFrame, label_column: str = "quality") -> Model:
    """Fit to the rows of ``labels`` (doc_id, label 0 or 1); rows of null id or other label are left out.

    ``counted`` comes from ``statistics``.  A label that occurs twice weighs twice.  A class without
    rows takes the other's Gaussian, so that every score is then the prior.
    """
    totals = counted.agg(*[F.sum(F.element_at("counts", i + 1)).alias(c) for i, c in enumerate(COUNTS)]).first()
    total = {c: float(totals[c] or 0.0) for c in COUNTS}
    solid = total["letters"] + total["digits"] + total["stops"] + total["symbols"]
    words = max(total["words"], 1.0)
    rates = np.array([
        *[min(total[top] / max(total[bottom], 1.0), 1.0) for top, bottom, _ in RATIOS],
        max(solid, 1.0) / words, max(total["square"], 1.0) / words, 1.0,
    ])
    dims = len(RATIOS) + 3
    width = 1 + dims + dims * dims

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, width))
        for batch in batches:
            if len(batch) == 0:
                continue
            x = _features(batch.column("counts").flatten().to_numpy().reshape(len(batch), len(COUNTS)), rates)
            label = batch.column("label").to_numpy()
            for k in (0, 1):
                rows = x[label == k]
                held[k] += np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(held.tolist(), pa.list_(pa.float64()))], names=["label", "sums"]
        )

    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label_column).cast("int").alias("label"))
    marked = marked.where("doc_id is not null and label in (0, 1)")
    parts = counted.join(marked, "doc_id").select("label", "counts").mapInArrow(moments, "label int, sums array<double>")
    rows = (
        parts.select("label", F.posexplode("sums").alias("place", "value"))
        .groupBy("label", "place").agg(F.sum("value").alias("value")).collect()
    )
    held = np.zeros((2, width))
    for row in rows:
        held[row["label"], row["place"]] = row["value"]
    return _model(held, rates, dims)


def _model(held: np.ndarray, rates: np.ndarray, dims: int) -> Model:
    n = held[:, 0]
    means, covariances = np.zeros((2, dims)), np.tile(np.eye(dims), (2, 1, 1))
    for k in (0, 1):
        if n[k]:
            means[k] = held[k, 1 : 1 + dims] / n[k]
            covariances[k] = held[k, 1 + dims :].reshape(dims, dims) / n[k] - np.outer(means[k], means[k])
    for k in (0, 1):
        if not n[k]:
            means[k], covariances[k] = means[1 - k], covariances[1 - k]
    pooled = (n[0] * covariances[0] + n[1] * covariances[1]) / max(n.sum(), 1.0) if n.sum() else covariances[0]
    factors, constants = np.zeros_like(covariances), np.zeros(2)
    for k in (0, 1):
        blended = (1 - BLEND) * covariances[k] + BLEND * pooled
        shrunk = (1 - DIAGONAL) * blended + DIAGONAL * np.diag(np.diag(blended)) + RIDGE * np.eye(dims)
        lower = np.linalg.cholesky(shrunk)
        factors[k] = np.linalg.inv(lower)
        constants[k] = np.log((n[k] + 1) / (n.sum() + 2)) - np.log(np.diag(lower)).sum()
    return Model(rates, means, factors, constants)


def scored(counted: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score): probability of label 1, for every row of ``statistics``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = batch.column("counts").flatten().to_numpy().reshape(len(batch), len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(counts))], names=["doc_id", "score"]
            )

    return counted.mapInArrow(score, "doc_id bigint, score double")


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a row without id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``, learnt from labels not held out.

    Null texts score as empty ones, a null id gets a score like any other, repeated rows score
    alike; an empty table gives no rows.  Other columns of either table are not read.
    """
    counted = stored(statistics(docs))
    model = fit(counted, labels.where(~held_out(F.col("doc_id"))))
    return scored(counted, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = fit(stored(statistics(docs)), labels.where(~held_out(F.col("doc_id"))))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                keep = model.score(_counted(texts)) >= threshold
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(judge, docs.schema)


ship(__name__)
