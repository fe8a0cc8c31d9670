"""Prediction-store lookup: routing, resolve chain, ambiguity check, status, and fragment scatter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectrail.functions.peptide import precursor_id
from spectrail.functions.text import log2_intensity
from spectrail.schemas import OFFSET

FOUND, NO_PREDICTION, NO_VARIANT, LOCAL = "store", "missing_prediction", "missing_variant", "local"
#: Codes up to which the dictionary is broadcast; a larger one is joined by shuffle.
BROADCAST_CODES = 1_000_000
#: Keys up to which they are broadcast to the predictions (9 bytes each); more meet them by buckets or by shuffle.
BROADCAST_KEYS = 1_000_000
#: What each table of a store is joined on.
KEYS = {"peptide": ("is_target", "pep_seq"), "variant": ("is_target", "peptide_id", "var_mod_sites_unimod"), "prediction": ("is_target", "precursor_id")}


@dataclass
class Store:
    """Tables with ``is_target``: peptide(peptide_id, pep_seq), variant(variant_id, peptide_id,
    var_mod_sites_unimod, fixed_mod_sites_unimod, all_unimods), prediction(precursor_id, peak_code[],
    mz[], intensity[]); and codes(peak_code, ion_type, position, fragment_charge, neutral_loss)."""

    peptide: DataFrame
    variant: DataFrame
    prediction: DataFrame
    codes: DataFrame
    #: The tables are bucketed and sorted by ``KEYS``, so joins read them where they lie.
    bucketed: bool = False
    #: Says which store this is and in what state, where caches ask for it.
    mark: str = ""

    def for_keys(self, queries: DataFrame) -> Store:
        """A store that holds at least what belongs to the queries: this one, where reading is pruned by Spark itself."""
        return self

    def close(self) -> None:
        """Frees what ``for_keys`` has set up."""


def is_target(label: Column) -> Column:
    return F.coalesce(label == 1, F.lit(False))


def resolve(queries: DataFrame, store: Store) -> DataFrame:
    """Queries (precursor_key, label, sequence, var_mod_sites_unimod, charge) with variant and precursor ids.

    Targets and decoys go through one plan: the side is part of each equi-join key. A null
    modification text matches no variant; unmodified is the empty text.
    """
    q = queries.withColumn("is_target", is_target(F.col("label")))
    pep = store.peptide.select("is_target", F.col("pep_seq").alias("sequence"), "peptide_id")
    var = store.variant.select("is_target", "peptide_id", "var_mod_sites_unimod", "variant_id", "fixed_mod_sites_unimod", F.array_join("all_unimods", ";").alias("all_unimods"))
    out = q.join(pep, ["is_target", "sequence"], "left").join(var, ["is_target", "peptide_id", "var_mod_sites_unimod"], "left")
    out = out.withColumn("precursor_id", precursor_id(F.col("variant_id"), F.col("charge"))).drop("peptide_id")
    return out.fillna("", subset=["fixed_mod_sites_unimod", "all_unimods"])


def ambiguous(resolved: DataFrame, key: str = "precursor_key", variant: str = "variant_id") -> DataFrame:
    """Keys with more than one variant, and how many."""
    return resolved.groupBy(key).agg(F.count_distinct(variant).alias("n_variants")).where("n_variants > 1")


def one_per_key(resolved: DataFrame, key: str = "precursor_key") -> DataFrame:
    """One row a key; several variants under a key fail the query; else the least variant, nulls last."""
    w = Window.partitionBy(key)
    spread = F.when(F.min("variant_id").over(w) < F.max("variant_id").over(w), F.raise_error(F.concat(F.lit("several variants: "), F.col(key))).cast("boolean")).otherwise(F.lit(True))
    ranked = resolved.withColumn("__n", F.row_number().over(w.orderBy(F.asc_nulls_last("variant_id")))).withColumn("__ok", spread)
    return ranked.where("__n = 1 AND __ok").drop("__n", "__ok")


def status(variant_id: Column, *arrays: Column) -> Column:
    present = F.lit(True)
    for a in arrays:
        present &= a.isNotNull()
    return F.when(variant_id.isNull(), NO_VARIANT).when(present, FOUND).otherwise(NO_PREDICTION)


def look_up(queries: DataFrame, store: Store, few: bool = False) -> DataFrame:
    """One row a query: ids, prediction_source and the raw arrays, which are fetched by the last join only."""
    return with_predictions(one_per_key(resolve(queries, store)), store, few)


def with_predictions(resolved: DataFrame, store: Store, few: bool = False) -> DataFrame:
    """Adds the arrays of each row's precursor and prediction_source.

    With ``few`` rows (``BROADCAST_KEYS`` at most, which the caller has counted) their keys are broadcast, and the scan of the predictions
    passes on what is asked for, so no other prediction is shuffled. More keys are shuffled to the buckets of a bucketed
    store, whose predictions stay where they lie; a plain store is shuffled.
    """
    held = store.prediction
    if few:
        asked = resolved.where("precursor_id IS NOT NULL").select("is_target", "precursor_id").distinct()
        held = held.join(F.broadcast(asked), ["is_target", "precursor_id"], "left_semi")
    got = resolved.join(held, ["is_target", "precursor_id"], "left")
    return got.withColumn("prediction_source", status(F.col("variant_id"), F.col("peak_code"), F.col("mz"), F.col("intensity"))).drop("is_target")


def scatter(found: DataFrame, codes: DataFrame, key: str = "precursor_key", small: bool | None = None) -> DataFrame:
    """Fragments (key, ion, row, frag_charge, mz, predicted) of the arrays; predicted is log2.

    Codes for other ions than b and y, with a neutral loss, a charge beyond 3 or a position
    outside the sequence are left out, as are unknown codes and values that aren't finite
    and positive. The shortest array bounds the others; of repeated cells the last one counts.
    """
    n = F.length("sequence")
    zipped = found.where("peak_code IS NOT NULL AND mz IS NOT NULL AND intensity IS NOT NULL")
    size = F.least(F.size("peak_code"), F.size("mz"), F.size("intensity"))
    zipped = zipped.withColumn("n", n).select(key, "n", F.posexplode(F.slice(F.arrays_zip("peak_code", "mz", "intensity"), 1, F.greatest(size, F.lit(0)))).alias("pos", "z"))
    zipped = zipped.select(key, "n", "pos", F.col("z.peak_code").alias("peak_code"), F.col("z.mz").cast("float").alias("mz"), F.col("z.intensity").cast("double").alias("intensity"))
    zipped = zipped.where("mz > 0 AND intensity > 0 AND mz < CAST('Infinity' AS FLOAT) AND intensity < CAST('Infinity' AS DOUBLE)")
    good = codes.where("neutral_loss = 'none' AND ion_type IN ('b', 'y') AND fragment_charge BETWEEN 1 AND 3 AND position >= 1")
    small = good.count() <= BROADCAST_CODES if small is None else small
    cells = zipped.join(F.broadcast(good) if small else good, "peak_code").where("position <= n - 1")
    cells = cells.withColumn("row", F.when(F.col("ion_type") == "b", F.col("position") - 1).otherwise(F.col("n") - 1 - F.col("position")))
    last = F.max_by(F.struct("mz", "intensity"), "pos").alias("v")
    out = cells.groupBy(key, F.col("ion_type").alias("ion"), "row", F.col("fragment_charge").alias("frag_charge")).agg(last)
    return out.select(key, "ion", "row", "frag_charge", F.col("v.mz").alias("mz"), log2_intensity(F.col("v.intensity"), OFFSET).alias("predicted"))


def matrices(fragments: DataFrame, lengths: DataFrame, key: str = "precursor_key") -> DataFrame:
    """Dense interchange form: for b and y arrays of (length - 1) x 3, absent cells 0, of m/z and log2 intensity."""
    cell = F.struct("ion", "row", "frag_charge", "mz", "predicted")
    held = fragments.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws(":", "ion", F.col("row").cast("string"), F.col("frag_charge").cast("string")), cell))).alias("m"))
    df = lengths.join(held, key, "left")

    def dense(ion: str, field: str) -> Column:
        rows = F.when(F.col("length") > 1, F.sequence(F.lit(0), F.col("length") - 2)).otherwise(F.array().cast("array<int>"))
        at = lambda r, z: F.coalesce(F.try_element_at("m", F.concat_ws(":", F.lit(ion), r.cast("string"), F.lit(str(z))))[field].cast("float"), F.lit(0.0).cast("float"))
        return F.transform(rows, lambda r: F.array(*(at(r, z) for z in (1, 2, 3))))

    return df.select(key, *(dense(ion, field).alias(f"{ion}_{name}") for ion in "by" for field, name in (("mz", "mz"), ("predicted", "intensity"))))
