"""Predictions that come as ranges of rows: each precursor names the rows of a table of fragments that are its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectrail.functions.text import log2_intensity

# Columns of a fragment table, each an ion type and a charge.
FRAGMENT_COLUMNS = {"b_z1": ("b", 1), "b_z2": ("b", 2), "y_z1": ("y", 1), "y_z2": ("y", 2)}


def _failing(bad: Column, why: Column) -> Column:
    """True, unless the query fails."""
    return F.when(bad, F.raise_error(why).cast("boolean")).otherwise(F.lit(True))


def from_ranges(precursors: DataFrame, mz: DataFrame, intensity: DataFrame, key: str = "precursor_key", row: str = "frag_row", start: str = "frag_start", stop: str = "frag_stop", whole: bool = True) -> DataFrame:
    """Fragments (key, ion, row, frag_charge, mz, predicted in log2) of precursors (key, start, stop): rows start to stop - 1 of both tables.

    ``mz`` and ``intensity`` have the row's number and columns such as ``b_z1``; columns that both lack are left out, cells without an m/z
    too. A fragment's ``row`` is its place in the range. The query fails if two ranges share a row, if a row comes
    twice, if a range has rows that the tables lack, or no end or an end before its start; and, with ``whole``, if a row is in no range. An empty range has no fragments.

    Ranges are as long as peptides, so each is unfolded to its rows, and rows meet by number: everything is linear in rows, in one
    shuffle that the check of shared rows uses too.
    """
    wrong = F.col(start).isNull() | F.col(stop).isNull() | (F.col(start) > F.col(stop))
    named = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    # one condition: two could be tested in either order, and a null range would go unnoticed
    some = F.when(wrong, F.raise_error(F.concat(F.lit("no range of rows: "), named)).cast("boolean")).otherwise(F.col(start) < F.col(stop))
    ranges = precursors.where(some).select(F.col(key).alias("__key"), F.col(start).cast("long").alias("__start"), F.col(stop).cast("long").alias("__stop"))
    claims = ranges.select("__key", "__start", F.explode(F.expr("sequence(__start, __stop - 1)")).alias("__row"))
    columns = [c for c in FRAGMENT_COLUMNS if c in mz.columns and c in intensity.columns]
    held = mz.select(F.col(row).cast("long").alias("__row"), *(F.col(c).cast("float").alias(f"__m_{c}") for c in columns))
    values = intensity.select(F.col(row).cast("long").alias("__row"), *(F.col(c).cast("double").alias(f"__i_{c}") for c in columns))
    rows = claims.join(held.join(values, "__row").withColumn("__there", F.lit(True)), "__row", "full" if whole else "left")
    number = F.col("__row").cast("string")
    lone = F.count(F.lit(1)).over(Window.partitionBy("__row")) == 1
    rows = rows.withColumn("__lone", lone)
    good = _failing(~F.col("__lone"), F.concat(F.lit("row of several ranges, or several times: "), number)) & _failing(F.col("__there").isNull(), F.concat(F.lit("range beyond the rows: "), number))
    good &= _failing(F.col("__key").isNull() & F.col("__start").isNull(), F.concat(F.lit("row of no range: "), number))
    cells = F.array(*(F.struct(F.lit(ion).alias("ion"), F.lit(z).alias("frag_charge"), F.col(f"__m_{c}").alias("mz"), log2_intensity(F.col(f"__i_{c}")).alias("predicted")) for c, (ion, z) in FRAGMENT_COLUMNS.items() if c in columns))
    out = rows.where(good).select(F.col("__key").alias(key), (F.col("__row") - F.col("__start")).cast("int").alias("row"), F.explode(cells).alias("__c"))
    return out.where("__c.mz IS NOT NULL").select(key, "__c.ion", "row", "__c.frag_charge", "__c.mz", "__c.predicted")
