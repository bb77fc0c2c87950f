"""Rating error and ranking quality of recommendations."""

from __future__ import annotations

from functools import reduce
from math import exp, log2

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cadenza.operators.ids import stirred

REPLICATES = 200


def rating_errors(predictions: DataFrame, label: str = "implicit_rating", prediction: str = "prediction") -> DataFrame:
    """RMSE and MAE as (metric, value) rows."""
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    one = predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))
    return _as_rows(one, {"RMSE": "rmse", "MAE": "mae"})


def poisson_weight(unit, replicate, seed: int = 42):
    """How often a replicate draws a unit: a Poisson number of mean 1 from mixed bits of both."""
    mark = stirred((stirred(F.pmod(unit.cast("bigint"), F.lit(1 << 31)) + seed) + replicate) % (1 << 31))
    return reduce(lambda a, b: a + b, [(mark >= t).cast("int") for t in poisson_limits()])


def poisson_limits() -> list[int]:
    """2^31 times the chances of a Poisson number of mean 1 to be at most 0, 1, 2 and so on."""
    limits, chance, below = [], exp(-1), 0.0
    for n in range(8):
        below += chance
        limits.append(int(below * (1 << 31)))
        chance /= n + 1
    return limits


def rating_error_intervals(
    predictions: DataFrame, unit: str = "user_id", replicates: int = REPLICATES, seed: int = 42, level: float = 0.95,
    label: str = "implicit_rating", prediction: str = "prediction",
) -> DataFrame:
    """RMSE and MAE as (metric, value, low, high) rows, the interval from a bootstrap over whole units.

    One pass sums the errors of each unit (a listener); every replicate weighs these sums by ``poisson_weight``, which
    depends on unit, replicate and seed alone, so nothing is drawn, kept or shuffled per replicate but its sums.
    """
    error = F.col(label).cast("double") - F.col(prediction).cast("double")
    sums = predictions.groupBy(unit).agg(
        F.count(error).alias("n"), F.sum(error * error).alias("squares"), F.sum(F.abs(error)).alias("sizes")
    )
    # Replicate -1 is the sample itself.
    replicate = F.explode(F.sequence(F.lit(-1).cast("bigint"), F.lit(replicates - 1).cast("bigint"))).alias("replicate")
    drawn = sums.select("*", replicate).withColumn(
        "w", F.when(F.col("replicate") < 0, 1).otherwise(poisson_weight(F.col(unit), F.col("replicate"), seed))
    )
    total = lambda c: F.sum(F.col("w") * F.col(c))
    each = drawn.groupBy("replicate").agg(F.sqrt(total("squares") / total("n")).alias("RMSE"), (total("sizes") / total("n")).alias("MAE"))
    rows = each.unpivot("replicate", ["RMSE", "MAE"], "metric", "value")
    own, tail = F.col("replicate") < 0, (1 - level) / 2
    resampled = F.when(~own, F.col("value"))
    return rows.groupBy("metric").agg(
        F.max(F.when(own, F.col("value"))).alias("value"), F.percentile(resampled, F.lit(tail)).alias("low"),
        F.percentile(resampled, F.lit(1 - tail)).alias("high"),
    )


def _as_rows(one: DataFrame, names: dict[str, str]) -> DataFrame:
    cells = [F.struct(F.lit(m).alias("metric"), F.col(c).alias("value")) for m, c in names.items()]
    return one.select(F.inline(F.array(*cells)))


def ranking_metrics(recs: DataFrame, relevant: DataFrame, k: int = 10) -> DataFrame:
    """Precision, NDCG and mean average precision at ``k`` as (metric, value) rows.

    ``recs`` has (user_id, track_id, rank), ``relevant`` the held-out pairs; the
    mean is over users with a held-out pair.  Hits are found by a join on the
    pair, so no user's list is collected.
    """
    pairs = relevant.select("user_id", "track_id").distinct()
    wanted = pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("wanted"))
    by_rank = W.partitionBy("user_id").orderBy("rank")
    hits = (
        recs.where(F.col("rank") <= k)
        .select("user_id", "track_id", "rank")
        .join(pairs, ["user_id", "track_id"])
        .withColumn("nth", F.row_number().over(by_rank))
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.sum(1.0 / F.log2(F.col("rank") + 1.0)).alias("gain"),
            F.sum(F.col("nth") / F.col("rank")).alias("precisions"),
        )
    )
    ideal, best = [], 0.0
    for place in range(1, k + 1):
        best += 1 / log2(place + 1)
        ideal.append(F.lit(best))
    reachable = F.least(F.col("wanted"), F.lit(k)).cast("int")
    part = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    one = wanted.join(hits, "user_id", "left").agg(
        F.avg(part("hits") / k).alias("precision"),
        F.avg(part("gain") / F.element_at(F.array(*ideal), reachable)).alias("ndcg"),
        F.avg(part("precisions") / reachable).alias("map"),
    )
    return _as_rows(one, {f"precision@{k}": "precision", f"ndcg@{k}": "ndcg", f"map@{k}": "map"})
