"""Retention-time features: calibration set, monotone knots, base and best-per-peptide columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spectrail.schemas import ROW_ID, RT_BEST, RT_FEATURES


def half_even(n: int, fraction: float) -> int:
    """At least one; halves go to the even neighbour."""
    return max(1, round(n * fraction))


#: Cells of one pass of the search for the n-th value.
CELLS = 1024


def nth_largest(rows: DataFrame, column: str, n: int, ends: tuple[float, float] | None = None) -> tuple[float, int]:
    """(value, k): the n-th largest value of a column without nulls, and which of its equals the n-th is.

    Counts in ``CELLS`` cells of the range (``ends``, if they are known), then again in the one that holds the n-th, until it is a single
    value: a few narrow aggregates, whatever n is. A limit would carry n rows to one task.
    """
    low, high = ends or rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        part = rows.where(F.col(column).between(low, high))
        cell = F.least(F.floor((F.col(column) - F.lit(low)) / F.lit((high - low) or 1.0) * CELLS), F.lit(CELLS - 1))
        cells = part.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(cells.collect(), key=lambda r: -r["high"]):  # at most CELLS rows
            if n <= r["n"]:
                low, high = r["low"], r["high"]
                break
            n -= r["n"]
    return high, n


def top_n(rows: DataFrame, n: int | Callable[[int], int], score: Column, row_id: str = ROW_ID) -> DataFrame:
    """The n rows of highest score, ties by row id, nulls and NaN last; all rows if there are fewer. n may be told by the number of rows."""
    value = F.nanvl(score.cast("double"), F.lit(None).cast("double"))
    rows = rows.withColumn("__s", value).withColumn("__o", -F.col(row_id).cast("long"))
    known, total, *ends = rows.agg(F.count("__s"), F.count(F.lit(1)), F.min("__s"), F.max("__s")).first()
    n = n(total) if callable(n) else n
    if n >= total:
        return rows.drop("__s", "__o")
    if n < known:
        at, k = nth_largest(rows.where("__s IS NOT NULL"), "__s", n, tuple(ends))
        above, ties = F.col("__s") > F.lit(at), F.col("__s") == F.lit(at)
    else:
        k, above, ties = n - known, F.col("__s").isNotNull(), F.col("__s").isNull()
    last = nth_largest(rows.where(ties), "__o", k)[0] if k else None
    kept = above if last is None else above | ties & (F.col("__o") >= F.lit(last))
    return rows.where(kept).drop("__s", "__o")


def calibration_set(rows: DataFrame, fraction: float = 0.15, score: str = "Xcorr") -> DataFrame:
    """The top ``fraction`` of targets with a retention time, by score; ties and nulls by row order.

    Fails if there is no such target.
    """
    def part(n: int) -> int:
        if not n:
            raise ValueError("no target has a retention time: nothing to calibrate on")
        return half_even(n, fraction)

    return top_n(rows.where("Label = 1 AND observed_retention_time > 0"), part, F.col(score))


def knots(rows: DataFrame, bins: int = 20, cuts: list[float] | None = None) -> list[tuple[float, float]]:
    """Calibration knots (predicted, observed) that never fall: an isotonic fit to the medians of both in bins of the prediction.

    Bins end at ``cuts``, else at ``bins`` quantiles. Spark counts and takes medians; the fit is on one point a bin.
    """
    if cuts is None:
        cuts = rows.approxQuantile("raw", [i / bins for i in range(1, bins)], 0.001) if bins > 1 else []
    number = F.lit(0)
    for c in sorted(set(cuts)):
        number = number + (F.col("raw") > c).cast("int")
    known = rows.where("raw IS NOT NULL AND observed_retention_time IS NOT NULL")
    got = known.groupBy(number.alias("b")).agg(F.percentile("raw", F.lit(0.5)).alias("p"), F.percentile("observed_retention_time", F.lit(0.5)).alias("o"), F.count(F.lit(1)).alias("n"))
    return isotonic([(r["p"], r["o"], r["n"]) for r in got.collect()])  # a row a bin


def isotonic(points: list[tuple[float, float, float]]) -> list[tuple[float, float]]:
    """Points (x, y, weight) in order of x, as (x, fitted): the non-decreasing values of least weighted squared distance to y.

    Adjacent violators are pooled: a value under the mean of what lies before it joins that pool, until means ascend. Points of one x are
    one point, their weighted mean.
    """
    same: dict[float, list[float]] = {}
    for x, y, w in points:
        total = same.setdefault(x, [0.0, 0.0])
        total[0] += w * y
        total[1] += w
    pools: list[list] = []  # weighted sum, weight, values of x
    for x in sorted(same):
        pools.append([*same[x], [x]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            y, w, xs = pools.pop()
            pools[-1][0] += y
            pools[-1][1] += w
            pools[-1][2] += xs
    return [(x, y / w) for y, w, xs in pools for x in xs]


def calibrate(raw: Column, at: list[tuple[float, float]]) -> Column:
    """Piecewise linear through the knots; the first and the last piece go on beyond the ends."""
    if not at:
        return raw
    if len(at) == 1:
        return raw + F.lit(at[0][1] - at[0][0])
    out = None
    for (p, o), (q, r) in reversed(list(zip(at, at[1:], strict=False))):
        line = F.lit(o) + (raw - F.lit(p)) * F.lit((r - o) / (q - p) if q > p else 0.0)
        out = line if out is None else F.when(raw < q, line).otherwise(out)
    return out


def base_features(rows: DataFrame) -> DataFrame:
    """Adds the difference; both times are 32-bit floats."""
    rows = rows.withColumns({c: F.col(c).cast("float") for c in RT_FEATURES[:2]})
    return rows.withColumn("rt_diff", F.abs(F.col("predicted_retention_time") - F.col("observed_retention_time")))


def best_per_peptide(rows: DataFrame, peptide: str = "Peptide") -> DataFrame:
    """Adds the three times of each peptide's row of least difference, the first on ties.

    Missing values count as 0 first, so a row without a time has the least difference. The
    minimum is combined before the shuffle and joined back, so a frequent peptide is no hot window.
    """
    filled = rows.fillna(0.0, subset=list(RT_FEATURES))
    key = F.struct(F.col("rt_diff").alias("d"), F.col(ROW_ID).alias("r"))
    best = filled.where(F.col(peptide).isNotNull()).groupBy(F.col(peptide).alias("__p")).agg(F.min_by(F.struct(*RT_FEATURES), key).alias("__best"))
    out = filled.join(best, F.col(peptide) == F.col("__p"), "left").drop("__p")
    return out.withColumns({b: F.col(f"__best.{c}") for b, c in zip(RT_BEST, RT_FEATURES, strict=True)}).drop("__best")

