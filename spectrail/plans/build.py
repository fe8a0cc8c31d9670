"""Match table + spectra + predictions to the table with 77 features."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spectrail.config import BuildConfig, BuildResult
from spectrail.functions.peptide import decode_charge, parse_peptide, precursor_key, psm_key
from spectrail.operators import cache, lookup, retention, similarity
from spectrail.operators.lookup import LOCAL, NO_PREDICTION, Store
from spectrail.plans.predictors import FragmentPredictor, TimePredictor, mark
from spectrail.progress import progressing, say, timed
from spectrail.schemas import FEATURES, ROW_ID, RT_FEATURES, SPECTRAL_FEATURES
from spectrail.sources import sinks, spectra, tables

_FRAGMENTS = "array<struct<ion:string,row:int,frag_charge:int,mz:float,predicted:double>>"
_PRECURSORS = f"precursor_key string, label long, sequence string, var_mod_sites_unimod string, charge int, fixed_mod_sites_unimod string, all_unimods string, variant_id long, precursor_id long, prediction_source string, fragments {_FRAGMENTS}"
_SPECTRAL = "psm_key string, " + ", ".join(f"{c} double" for c in SPECTRAL_FEATURES)
_TIMES = "psm_key string, observed_retention_time float, predicted_retention_time float, rt_diff float"


def augment(rows: DataFrame, run_id: str) -> DataFrame:
    """Adds charge, sequence, modification sites and both keys."""
    rows = rows.withColumn("charge", decode_charge(rows.columns)).withColumn("__p", parse_peptide(F.col("Peptide")))
    rows = rows.withColumns({"label_int": F.col("Label").cast("long"), "sequence": F.col("__p.sequence"), "var_mod_sites_unimod": F.col("__p.var_mod_sites")}).drop("__p")
    return rows.withColumns({
        "precursor_key": precursor_key(F.col("label_int"), F.col("sequence"), F.col("var_mod_sites_unimod"), F.col("charge")),
        "psm_key": psm_key(F.lit(run_id), F.col("SpecId"), F.col("Peptide"), F.col("charge"), F.col("label_int")),
    })


def with_observed_times(rows: DataFrame, observed: DataFrame) -> DataFrame:
    """Adds the retention time of each row's spectrum, 0 where there is none; no row is lost or doubled."""
    times = observed.select(F.col("scan_number").alias("__scan"), F.col("rt_seconds").alias("observed_retention_time"))
    return rows.join(times, F.col("ScanNr").cast("long") == F.col("__scan"), "left").drop("__scan").fillna(0.0, subset=["observed_retention_time"])


def packed(fragments: DataFrame) -> DataFrame:
    return fragments.groupBy("precursor_key").agg(F.collect_list(F.struct("ion", F.col("row").cast("int").alias("row"), F.col("frag_charge").cast("int").alias("frag_charge"), F.col("mz").cast("float").alias("mz"), F.col("predicted").cast("double").alias("predicted"))).alias("fragments"))


def wanting(found: DataFrame) -> DataFrame:
    """Looked-up rows that have a variant but no prediction: these are predicted locally."""
    return found.where((F.col("prediction_source") == NO_PREDICTION) & F.col("variant_id").isNotNull())


def update_precursors(rows: DataFrame, store: Store | None, local: FragmentPredictor | None, held: cache.Cache) -> DataFrame:
    """The precursor cache with every key of ``rows``: from the store, else predicted locally, else marked as missing.

    Keys that the cache lacks are written first, then what the store has for them: it is asked once, whatever reads the answer.
    """
    keys = rows.select("precursor_key", F.col("label_int").alias("label"), "sequence", "var_mod_sites_unimod", "charge")
    new, n = _held(cache.missing(cache.distinct_keys(keys, "precursor_key"), held.read(), "precursor_key"), f"{held.path}-asked")
    if not n:
        held.added = 0
        return held.read()
    if store is None:
        none = {"fixed_mod_sites_unimod": "string", "all_unimods": "string", "variant_id": "long", "precursor_id": "long"}
        found = new.withColumns({c: F.lit(None).cast(k) for c, k in none.items()}).withColumn("prediction_source", F.lit(NO_PREDICTION))
        fragments = None
        wanted = found
    else:
        asked = store.for_keys(new)
        raw, _ = _held(lookup.look_up(new, asked, n <= lookup.BROADCAST_KEYS), f"{held.path}-found")
        asked.close()
        found = raw.drop("peak_code", "mz", "intensity")
        fragments = packed(lookup.scatter(raw, store.codes))
        wanted = wanting(found)
    out = found.withColumn("fragments", F.lit(None).cast(_FRAGMENTS)) if fragments is None else found.join(fragments, "precursor_key", "left")
    if local is not None:
        made = packed(local.fragments(wanted.select("precursor_key", "sequence", "var_mod_sites_unimod", "charge"))).withColumn("prediction_source", F.lit(LOCAL))
        out = cache.update_by_key(out, made, "precursor_key", ["prediction_source", "fragments"])
    names = [c.split()[0] for c in _PRECURSORS.split(", ")[:-1]] + ["fragments"]
    return held.append(out.select(names))


def score(rows: DataFrame, precursors: DataFrame, observed: DataFrame, tolerance: float) -> DataFrame:
    """(psm_key, 71 features) of the rows; all 0 without a spectrum, a prediction or a valid ion.

    Both arrays, of a row's precursor and of its scan (scan_number, peaks), are joined to it, and one kernel matches and compares
    them: after the join by scan there is no shuffle. A precursor or scan of very many rows is a skewed key of a plain join.
    """
    some = rows.select("psm_key", "precursor_key", F.col("ScanNr").cast("long").alias("scan_number")).dropDuplicates(["psm_key"])
    held = precursors.where("fragments IS NOT NULL").select("precursor_key", *similarity.fragment_columns())
    both = some.join(held, "precursor_key").join(observed.select("scan_number", *similarity.peak_columns()), "scan_number")
    found = similarity.scored(both, ["psm_key"], tolerance)
    return some.select("psm_key").join(found, "psm_key", "left").fillna(0.0, subset=list(SPECTRAL_FEATURES))


def update_spectral(rows: DataFrame, precursors: DataFrame, observed: DataFrame, held: cache.Cache, tolerance: float) -> DataFrame:
    new = cache.missing(rows, held.read(), "psm_key")
    return held.append(score(new, precursors, observed, tolerance))


def update_times(rows: DataFrame, times: TimePredictor, held: cache.Cache, config: BuildConfig) -> DataFrame:
    """The retention-time cache; the calibration is fitted on all current rows, kept, and reused unless asked not to."""
    new = cache.missing(rows, held.read(), "psm_key")
    at = None if config.recalibrate else load_calibration(rows.sparkSession, config)
    if at is None:
        if new.isEmpty():
            held.added = 0
            return held.read()
        at = retention.knots(times.times(retention.calibration_set(rows, config.calibration_fraction)).where("raw IS NOT NULL"))
        save_calibration(rows.sparkSession, config, at)
    made = times.times(new).withColumn("predicted_retention_time", retention.calibrate(F.col("raw").cast("double"), [tuple(x) for x in at]))
    made = retention.base_features(made).dropDuplicates(["psm_key"]).select("psm_key", *RT_FEATURES)
    return held.append(made)


def load_calibration(spark: SparkSession, config: BuildConfig) -> list | None:
    return sinks.read_json(spark, f"{config.cache_dir}/calibration.json", None)


def save_calibration(spark: SparkSession, config: BuildConfig, at: list) -> None:
    sinks.write_json(spark, at, f"{config.cache_dir}/calibration.json")


def _held(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """A frame that several steps read, written once, and its rows; those of runs before the last one go."""
    held = cache.Cache(df.sparkSession, path, ROW_ID, "")
    old = [name for _, _, name in held._folders()]
    out = held.write(df)
    held._delete(old[:-1])
    return out, held.added


def counters(rows: DataFrame, precursors: DataFrame) -> dict[str, int]:
    """Distinct keys of the rows, and where their precursors' predictions come from: two narrow aggregates."""
    counts = rows.agg(F.count_distinct("precursor_key").alias("precursor_count"), F.count_distinct("psm_key").alias("psm_count")).first()
    kinds = precursors.join(rows.select("precursor_key").distinct(), "precursor_key", "left_semi").groupBy("prediction_source").agg(F.count(F.lit(1)).alias("n"))
    sources = {r["prediction_source"]: r["n"] for r in kinds.collect()}  # four kinds
    return counts.asDict() | {"store_hits": sources.get(lookup.FOUND, 0), "local_predictions": sources.get(LOCAL, 0)}


def with_cached(rows: DataFrame, held: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Adds a cache's columns by key, 0 where it lacks the key; no row is lost."""
    return rows.join(held.select(key, *columns), key, "left").fillna(0.0, subset=columns)


def _features(spark: SparkSession, config: BuildConfig, store: Store | None, local: FragmentPredictor | None, times: TimePredictor | None) -> tuple[DataFrame, dict]:
    pin = tables.read_matches(spark, config.match_table, config.max_rows, lambda df: _held(df, f"{config.cache_dir}/lines")[0])
    if times is not None and "Xcorr" not in pin.columns:
        raise ValueError("retention times need the column Xcorr")
    # each input is parsed once, into a table that later steps read
    dropped = Observation()
    mgf = tables.bare_name(config.spectra).endswith(".mgf")
    observed, _ = _held(spectra.read_spectra(spark, config.spectra, dropped if mgf else None, check=False), f"{config.cache_dir}/spectra")
    spectra.unique_scans(observed)
    rows, n = _held(with_observed_times(augment(pin, config.run_id), observed), f"{config.cache_dir}/rows")
    inputs = [[path, sinks.file_facts(spark, path)] for path in (config.match_table, config.spectra)]
    predicted = [mark(local), store.mark if store else ""]
    at = lambda name, key, schema, *facts: cache.Cache(spark, f"{config.cache_dir}/{name}", key, schema, config.fingerprint(*facts))
    spectral = at("spectral_features", "psm_key", _SPECTRAL, inputs, config.tolerance, predicted)
    clock, precursor = at("rt_features", "psm_key", _TIMES, inputs, mark(times)), at("precursors", "precursor_key", _PRECURSORS, predicted)
    say(f"{config.run_id}: {n} rows read, scoring what the caches lack")
    with timed(f"{config.run_id}: predictions"), progressing(spark, f"{config.run_id}: predictions"):
        precursors = update_precursors(rows, store, local, precursor)
    with timed(f"{config.run_id}: spectral features"), progressing(spark, f"{config.run_id}: spectral features"):
        scored = update_spectral(rows, precursors, observed, spectral, config.tolerance)
    out = with_cached(rows.drop("observed_retention_time"), scored, "psm_key", list(SPECTRAL_FEATURES))
    with timed(f"{config.run_id}: retention times", quiet=times is None):
        clocked = update_times(rows, times, clock, config) if times is not None else spark.createDataFrame([], _TIMES)
    out = retention.best_per_peptide(out.join(clocked, "psm_key", "left"))
    out = out.fillna(0.0, subset=list(FEATURES))
    names = [c for c in pin.columns if c != ROW_ID]
    stats = {"row_count": n, "spectral_misses": spectral.added, "rt_misses": clock.added if times else 0} | counters(rows, precursors)
    known = stats.pop("psm_count")
    stats |= {"spectral_hits": known - stats["spectral_misses"], "rt_hits": known - stats["rt_misses"] if times else 0}
    say(f"{config.run_id}: {stats['spectral_misses']} rows scored of {known}, {stats['precursor_count']} precursors")
    more = {f"dropped_{k}": v for k, v in dropped.get.items()} if mgf else {}
    return out.select(ROW_ID, *sinks.insert_before(names, list(FEATURES))), stats | {"more": more}


def build_features(spark: SparkSession, config: BuildConfig, store: Store | None = None, local: FragmentPredictor | None = None, times: TimePredictor | None = None, match_table: str | None = None, spectra_path: str | None = None) -> DataFrame:
    """The match table with its 77 features before ``Peptide``, in row order by ``__row_id``; updates the caches."""
    config = dataclasses.replace(config, match_table=match_table or config.match_table, spectra=spectra_path or config.spectra)
    return _features(spark, config, store, local, times)[0]


def build_pin(spark: SparkSession, config: BuildConfig, store: Store | None = None, local: FragmentPredictor | None = None, times: TimePredictor | None = None) -> BuildResult:
    """``build_features``, written as gzipped PIN text, with a manifest beside the caches."""
    table, stats = _features(spark, config, store, local, times)
    more = stats.pop("more")
    with timed(f"{config.run_id}: output"):
        sinks.write_pin(table, config.output, config.single_file)
    manifest = sinks.read_json(spark, f"{config.cache_dir}/manifest.json", {})
    facts = {f"{name}_{k}": v for name, path in (("match_table", config.match_table), ("spectra", config.spectra)) for k, v in sinks.file_facts(spark, path).items()}
    manifest |= stats | more | facts | {"run_id": config.run_id, "match_table": config.match_table, "spectra": config.spectra, "calibration_present": load_calibration(spark, config) is not None}
    sinks.write_json(spark, manifest, f"{config.cache_dir}/manifest.json")
    return BuildResult(config.run_id, config.output, config.cache_dir, **stats, metadata=manifest)
