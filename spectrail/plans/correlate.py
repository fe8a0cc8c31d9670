"""Predicted against observed spectra of identified peptides, by spectrum identifier."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spectrail.functions.text import normal_id
from spectrail.operators import match, modifications, similarity
from spectrail.plans.predictors import FragmentPredictor
from spectrail.schemas import ROW_ID, TOLERANCE
from spectrail.sources import sinks

#: Below this share of matched results a warning is given.
EXPECTED = 0.9


def peptidoforms(psms: DataFrame, mods: DataFrame | None = None) -> DataFrame:
    """Rows (spectrum_id, peptidoform) with row id, sequence, charge, mods and mod_sites.

    Tables read by ``tables.read_psms`` bring their row ids; other rows get some that tell them apart.
    """
    rows = psms if ROW_ID in psms.columns else psms.withColumn(ROW_ID, F.monotonically_increasing_id())
    rows = rows.withColumn("__p", modifications.proforma_tokens(F.col("peptidoform"))).select("*", "__p.*").drop("__p").withColumn("precursor_key", F.col("peptidoform"))
    return rows.withColumns({"mods": F.lit(""), "mod_sites": F.lit("")}) if mods is None else modifications.annotate(rows, mods, ROW_ID)


def predict(psms: DataFrame, predictor: FragmentPredictor, mods: DataFrame | None = None) -> DataFrame:
    """Theoretical ions of every row: (row id, ion, row, frag_charge, mz, predicted). Joined by key, never by position."""
    rows = peptidoforms(psms, mods)
    ions = predictor.fragments(rows.select("precursor_key", "sequence", "charge", "mods", "mod_sites").dropDuplicates(["precursor_key"]))
    return rows.select(ROW_ID, "precursor_key", "spectrum_id").join(ions, "precursor_key")


def predict_single(spark: SparkSession, peptidoform: str, predictor: FragmentPredictor, mods: DataFrame | None = None) -> DataFrame:
    """Theoretical ions of one peptidoform, row 0."""
    one = spark.createDataFrame([(0, "", peptidoform)], f"{ROW_ID} long, spectrum_id string, peptidoform string")
    return predict(one, predictor, mods)


def ion_counts(ions: DataFrame) -> DataFrame:
    """(row id, n_b_ions, n_y_ions): ions with an m/z over 0."""
    return ions.groupBy(ROW_ID).agg(*(F.count_if((F.col("ion") == i) & (F.col("mz") > 0)).alias(f"n_{i}_ions") for i in "by"))


def attach(ions: DataFrame, observed: DataFrame, tolerance: float = TOLERANCE, id_pattern: str | None = None) -> DataFrame:
    """Adds ``observed``: log2 intensity of the nearest peak, null where the spectrum is missing."""
    ions = ions.withColumn("identifier", normal_id(F.col("spectrum_id"), id_pattern))
    known = observed.select("identifier", F.lit(True).alias("__known"))
    ions = ions.join(known, "identifier", "left")
    peaks = observed.select("identifier", F.inline("peaks"))
    hit = match.nearest_peaks(ions.where("__known").drop("__known"), peaks, "identifier", tolerance)
    none = ions.where("__known IS NULL").drop("__known").withColumn("observed", F.lit(None).cast("double"))
    return hit.unionByName(none.select(hit.columns))


def correlate(psms: DataFrame, observed: DataFrame, predictor: FragmentPredictor, mods: DataFrame | None = None, tolerance: float = TOLERANCE, id_pattern: str | None = None, folder: str | None = None) -> DataFrame:
    """(row id, correlation, n_b_ions, n_y_ions); null correlation where the spectrum is missing.

    One aggregate by row gives correlation, counts and whether any ion met a peak. With ``folder`` the narrow result is written there and read
    back, so whatever follows doesn't match anew; while it is written, matched results are counted, and few of them give a warning.
    """
    ions = attach(predict(psms, predictor, mods), observed, tolerance, id_pattern).where("mz > 0")
    hit = F.max((F.col("observed") > 0).cast("int")).alias("hit")
    per = similarity.correlation(ions, [ROW_ID], hit, *(F.count_if(F.col("ion") == i).alias(f"n_{i}_ions") for i in "by"))
    if folder is None:
        return per.drop("hit")
    seen = Observation()
    per.observe(seen, F.coalesce(F.sum("hit"), F.lit(0)).alias("matched"), F.count(F.lit(1)).alias("total")).drop("hit").write.mode("overwrite").parquet(folder)
    got = seen.get
    if got["total"] and got["matched"] / got["total"] < EXPECTED:
        warnings.warn(f"only {got['matched']} of {got['total']} results match a peak", RuntimeWarning, stacklevel=2)
    return psms.sparkSession.read.schema(per.drop("hit").schema).parquet(folder)


def median_correlation(correlations: DataFrame) -> DataFrame:
    return correlations.agg(F.percentile("correlation", F.lit(0.5)).alias("median_correlation"), F.count("correlation").alias("n"))


def summary(correlations: DataFrame) -> str:
    """How many results have a correlation, and its median."""
    r = correlations.agg(F.count(F.lit(1)).alias("total"), F.count("correlation").alias("n"), F.percentile("correlation", F.lit(0.5)).alias("median")).first()
    return f"{r['n']} of {r['total']} results correlated" + (f", median {r['median']:.4f}" if r["n"] else "")


def write_results(correlations: DataFrame, path: str) -> str:
    """One JSON list of (psm_index, correlation, n_b_ions, n_y_ions) in row order."""
    rows = correlations.select(F.col(ROW_ID).alias("psm_index"), "correlation", "n_b_ions", "n_y_ions")
    return sinks.write_json_list(rows, path, "psm_index")
