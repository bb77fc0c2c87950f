"""Exact order statistics without sorting or collecting a column.

``describe`` reads its table twice, for all columns at once.  The first scan holds a mergeable
quantile sketch per column beside the plain sums; the sketch brackets each quantile between two values.
The second counts the values by bracket, and those between brackets as one sum each; this
table, a few ten-thousandths of the values at most or as many rows as a bracket has distinct values, is stored.
The ranks are selected from it alone.  A bracket that misses its rank (the sketch's error is
a bound in practice, not relied upon) costs further scans, never the result.

Selection counts the values of every open interval in equal-width bins, keeps the one bin that holds the
wanted rank and narrows the interval to that bin's smallest and largest value.  A rank is found
when its bin holds one value.  A pass shuffles at most ``BINS`` rows per interval and task,
whatever the number of values, and repeated values cost nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.session import stored

BINS = 1024
# Relative rank error of the sketch is 1 / ACCURACY; brackets reach three times as far to either side.
ACCURACY, REACH = 10_000, 3
# An open interval: column, smallest and largest value, values below it, wanted ranks.
Interval = tuple[str, float, float, int, list[int]]


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _melted(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n): a row per value that is neither null nor NaN, n = 1."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), _number(c).alias("value")) for c in columns])
    return df.select(F.inline(F.filter(cells, lambda x: x["value"].isNotNull()))).withColumn("n", F.lit(1).cast("bigint"))


def _selected(values: DataFrame, intervals: list[Interval]) -> dict[tuple[str, int], float]:
    """Value at each wanted rank of each interval of (column, value, n)."""
    found: dict[tuple[str, int], float] = {}
    while intervals:
        value, interval, bin_ = F.col("value"), F.lit(None).cast("int"), F.lit(None).cast("int")
        for i, (column, low, high, _, _) in enumerate(intervals):
            inside = (F.col("column") == column) & value.between(low, high)
            place = F.lit(0)
            if high > low:
                step = (value / 2 - low / 2) / (high / 2 - low / 2) * BINS
                place = F.least(F.floor(step), F.lit(BINS - 1)).cast("int")
            interval = F.when(inside, i).otherwise(interval)
            bin_ = F.when(inside, place).otherwise(bin_)
        binned = (
            values.select(interval.alias("interval"), bin_.alias("bin"), "value", "n").where("interval is not null")
            .groupBy("interval", "bin").agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        )
        rows = defaultdict(list)
        for row in binned.collect():
            rows[row["interval"]].append(row)
        narrowed = []
        for i, (column, _, _, below, wanted) in enumerate(intervals):
            for row in sorted(rows[i], key=lambda r: r["bin"]):
                inside = [r for r in wanted if below <= r < below + row["n"]]
                if inside and row["low"] == row["high"]:
                    found.update({(column, r): row["low"] for r in inside})
                elif inside:
                    narrowed.append((column, row["low"], row["high"], below, inside))
                below += row["n"]
        intervals = narrowed
    return found


def order_statistics(
    df: DataFrame, ranks: dict[str, Sequence[int]], bounds: dict[str, tuple[float, float]]
) -> dict[tuple[str, int], float]:
    """Value at each 0-based rank of each column; nulls and NaN are not ranked."""
    wanted = [c for c, r in ranks.items() if r]
    return _selected(_melted(df, wanted), [(c, *bounds[c], 0, sorted(set(ranks[c]))) for c in wanted])


def _bracketed(
    df: DataFrame, ranks: dict[str, list[int]], bounds: dict[str, tuple[float, float]], brackets: dict[str, list[tuple[float, float]]]
) -> dict[tuple[str, int], float]:
    """``order_statistics`` from one scan, where the brackets hold the wanted ranks."""
    region = F.lit(None).cast("int")
    for c, spans in brackets.items():
        # Odd regions are the brackets, even ones what lies below, between and above them.
        place = F.lit(2 * len(spans))
        for i, (low, high) in reversed(list(enumerate(spans))):
            place = F.when(F.col("value") < low, 2 * i).when(F.col("value") <= high, 2 * i + 1).otherwise(place)
        region = F.when(F.col("column") == c, place).otherwise(region)
    regions = _melted(df, list(ranks)).withColumn("region", region)
    kept = F.when(F.col("region") % 2 == 1, F.col("value"))
    counted = stored(regions.groupBy("column", "region", kept.alias("value")).agg(F.sum("n").alias("n")))
    sizes = counted.groupBy("column", "region").agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    near: list[Interval] = []
    missed: dict[str, list[int]] = {}
    below: dict[str, int] = defaultdict(int)
    for row in sorted(sizes.collect(), key=lambda r: (r["column"], r["region"])):
        c, start = row["column"], below[row["column"]]
        below[c] += row["n"]
        wanted = [r for r in sorted(set(ranks[c])) if start <= r < below[c]]
        if wanted and row["region"] % 2:
            near.append((c, row["low"], row["high"], start, wanted))
        elif wanted:
            missed.setdefault(c, []).extend(wanted)
    found = _selected(counted.where("value is not null"), near)
    return found | order_statistics(df, missed, bounds) if missed else found


def _joined(spans: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The same values as intervals that do not meet, in order."""
    out: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def describe(
    df: DataFrame, columns: Sequence[str], digits: int = 2, probabilities: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, one row each.

    Quartiles are exact and interpolate linearly between the two next ranks.
    """
    aggregates = []
    reach = [min(max(p + side * REACH / ACCURACY, 0.0), 1.0) for p in probabilities for side in (-1, 1)]
    for i, c in enumerate(columns):
        value = _number(c)
        aggregates += [
            F.count(value).alias(f"count_{i}"),
            F.avg(value).alias(f"mean_{i}"),
            F.stddev_samp(value).alias(f"std_{i}"),
            F.min(value).alias(f"min_{i}"),
            F.max(value).alias(f"max_{i}"),
            F.percentile_approx(value, reach, ACCURACY).alias(f"near_{i}"),
        ]
    row = df.agg(*aggregates).first()
    ranks: dict[str, list[int]] = {}
    bounds, brackets = {}, {}
    for i, c in enumerate(columns):
        last = row[f"count_{i}"] - 1
        if last < 0:
            continue
        places = [last * p for p in probabilities]
        ranks[c] = [r for x in places for r in (int(x), min(int(x) + 1, last))]
        bounds[c] = (row[f"min_{i}"], row[f"max_{i}"])
        near = row[f"near_{i}"]
        brackets[c] = _joined(list(zip(near[::2], near[1::2], strict=True)))
    values = _bracketed(df, ranks, bounds, brackets) if ranks else {}

    def quantile(column: str, last: int, p: float) -> float | None:
        if last < 0:
            return None
        place = last * p
        low = values[column, int(place)]
        high = values[column, min(int(place) + 1, last)]
        return low + (high - low) * (place - int(place))

    def shown(x: float | None) -> float | None:
        return None if x is None else round(float(x), digits)

    names = [f"q{round(p * 100):02d}" for p in probabilities]
    out = []
    for i, c in enumerate(columns):
        n = row[f"count_{i}"]
        quartiles = [shown(quantile(c, n - 1, p)) for p in probabilities]
        out.append((c, n, shown(row[f"mean_{i}"]), shown(row[f"std_{i}"]), shown(row[f"min_{i}"]),
                    *quartiles, shown(row[f"max_{i}"])))
    fields = ", ".join(f"{q} double" for q in names)
    schema = f"column string, count bigint, mean double, std double, min double, {fields}, max double"
    return df.sparkSession.createDataFrame(out, schema)
