"""Nearest-peak tolerance join with two-sided neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spectrail.functions.text import log2_intensity
from spectrail.schemas import TOLERANCE


def nearest_peaks(ions: DataFrame, peaks: DataFrame, by: str, tolerance: float = TOLERANCE, mz: str = "mz", intensity: str = "intensity") -> DataFrame:
    """``ions`` with ``observed``: log2 intensity of the peak within ``tolerance``, 0.0 if unmatched.

    An ion needs a peak strictly below it and one at or above it among the peaks of its ``by``.
    The nearer one counts, the lower one on a tie, if its distance is under the tolerance.
    Ions of m/z 0 or less never match. Peaks: (by, mz, intensity), ties in m/z by ``peak_index`` if
    there is one, the highest index below and the lowest above; then so by intensity.

    One shuffle by ``by`` of the union; two running windows in opposite orders (a frame to the
    end of the partition would be evaluated anew for each row).
    """
    index = F.col("peak_index").cast("long") if "peak_index" in peaks.columns else F.lit(0).cast("long")
    keep = [c for c in ions.columns if c not in (by, mz)]
    peak = F.struct(F.col(mz).alias("mz"), F.col(intensity).alias("intensity"))
    left = ions.select(F.col(by).alias("__by"), F.col(mz).alias("__mz"), F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__index"), F.lit(None).cast(f"struct<mz:{peaks.schema[mz].dataType.simpleString()},intensity:{peaks.schema[intensity].dataType.simpleString()}>").alias("__peak"), F.struct(*keep).alias("__ion"))
    right = peaks.select(F.col(by).alias("__by"), F.col(mz).alias("__mz"), F.lit(1).alias("__kind"), index.alias("__index"), peak.alias("__peak"), F.lit(None).cast(left.schema["__ion"].dataType).alias("__ion"))
    rows = left.unionByName(right)
    up = Window.partitionBy("__by").orderBy("__mz", "__kind", "__index", "__peak.intensity").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("__by").orderBy(F.desc("__mz"), F.desc("__kind"), F.desc("__index"), F.desc("__peak.intensity")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__low", F.last("__peak", True).over(up)).withColumn("__high", F.last("__peak", True).over(down)).where("__kind = 0")
    below, above = F.col("__mz") - F.col("__low.mz"), F.col("__high.mz") - F.col("__mz")
    both = F.col("__low").isNotNull() & F.col("__high").isNotNull() & (F.col("__mz") > 0)
    value = F.when(both & (below <= above) & (below < F.lit(tolerance)), log2_intensity(F.col("__low.intensity"))).when(both & (above < below) & (above < F.lit(tolerance)), log2_intensity(F.col("__high.intensity")))
    return rows.select(F.col("__by").alias(by), F.col("__mz").alias(mz), *(F.col(f"__ion.{c}").alias(c) for c in keep), F.coalesce(value, F.lit(0.0)).alias("observed"))


def match_fraction(ions: DataFrame, *keys: str) -> DataFrame:
    """Share of results with any matched ion (log2 intensity above 0), with both counts."""
    per = ions.groupBy(*keys).agg(F.max((F.col("observed") > 0).cast("int")).alias("hit"))
    return per.agg(F.coalesce(F.sum("hit"), F.lit(0)).alias("matched"), F.count(F.lit(1)).alias("total")).withColumn("fraction", F.try_divide("matched", "total"))
