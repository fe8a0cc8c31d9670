"""The command line, stores by JDBC, models in workers, caches that grow, row order over several files, output forms."""

import glob
import gzip
import json
import math
import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spectrail import cli
from spectrail.config import BuildConfig
from spectrail.operators import cache, lookup, match, modifications
from spectrail.plans import build, correlate
from spectrail.plans.predictors import ArrowModel, TableFragments
from spectrail.schemas import FEATURES, ROW_ID
from spectrail.sources import sinks, spectra, stores, tables
from spectrail.streaming.incremental import score_arrivals

from .test_reference import MODS, PIN, build_inputs

# The endings in the order in which they are tried.
MATCH_ORDER = (".pin.parquet", ".pin.tsv.gz", ".pin.tsv", ".pin.gz", ".pin", ".tsv.gz", ".tsv")
SPECTRUM_ORDER = (".mgf.parquet", ".mgf.gz", ".mgf")


def test_order_of_endings(tmp_path):
    assert (cli.MATCH_ENDINGS, cli.SPECTRUM_ENDINGS) == (MATCH_ORDER, SPECTRUM_ORDER)
    for endings in (MATCH_ORDER, SPECTRUM_ORDER):
        for e in reversed(endings):
            (tmp_path / f"r{e}").touch()
            assert cli.find_file(str(tmp_path), "r", endings) == f"{tmp_path}/r{e}"
    assert [cli.run_name(f"/x/a.b{e}") for e in (*MATCH_ORDER, ".other")] == ["a.b"] * 8
    with pytest.raises(SystemExit):
        cli.resolve_paths(cli.parser().parse_args(["build", "--pin-file", "a", "--pin-dir", "d", "--mgf-dir", "d", "--run-id", "r", "--out-dir", "o"]))


def test_command_line(spark, tmp_path, capsys):
    predictor, times = build_inputs(spark, tmp_path)
    predictor.table.write.parquet(f"{tmp_path}/fragments")
    times.table.write.parquet(f"{tmp_path}/times")
    args = ["build", "--pin-file", f"{tmp_path}/r.pin.gz", "--spectrum-file", f"{tmp_path}/r.mgf", "--out-dir", f"{tmp_path}/out", "--fragments", f"{tmp_path}/fragments", "--times", f"{tmp_path}/times"]
    cli.main(args, spark)
    assert "5 rows, 3 precursors" in capsys.readouterr().out
    manifest = json.loads((tmp_path / "out/cache/r/manifest.json").read_text())
    assert manifest["match_table_bytes"] == os.path.getsize(f"{tmp_path}/r.pin.gz") and manifest["spectra_changed_ms"] > 0 and manifest["calibration_present"] and manifest["row_count"] == 5
    whole = gzip.open(f"{tmp_path}/out/r.rescore.pin.gz", "rt").read()
    cli.main([*args[:6], f"{tmp_path}/out2", *args[7:], "--members"], spark)
    members = sorted(glob.glob(f"{tmp_path}/out2/r.rescore.pin.gz/part-*"))
    assert "".join(gzip.open(m, "rt").read() for m in members) == whole
    predictor.table.where("precursor_key = '1|PEPK||2'").withColumn("precursor_key", F.lit("PEPK/2")).write.parquet(f"{tmp_path}/peptidoforms")
    (tmp_path / "psms.tsv").write_text("spectrum_id\tpeptidoform\nscan=42\tPEPK/2\nscan=77\tPEPK/2\n")
    spark.createDataFrame(MODS, "mod_name string, unimod_id long").write.parquet(f"{tmp_path}/mods")
    with pytest.warns(RuntimeWarning, match="1 of 2"):
        cli.main(["correlate", "--psms", f"{tmp_path}/psms.tsv", "--fragments", f"{tmp_path}/peptidoforms", "--mods", f"{tmp_path}/mods", "--spectrum-file", f"{tmp_path}/r.mgf", "--spectrum-id-pattern", r"(scan=\d+)", "--output", f"{tmp_path}/o.json"], spark)
    assert "1 of 2 results correlated, median" in capsys.readouterr().out
    got = json.loads((tmp_path / "o.json").read_text())
    assert [(r["psm_index"], r["correlation"] is None, r["n_b_ions"], r["n_y_ions"]) for r in got] == [(0, False, 2, 1), (1, True, 2, 1)]
    cli.main(["predict", "--psms", f"{tmp_path}/psms.tsv", "--fragments", f"{tmp_path}/peptidoforms", "--output", f"{tmp_path}/ions"], spark)
    assert spark.read.parquet(f"{tmp_path}/ions").groupBy(ROW_ID).count().orderBy(ROW_ID).collect() == [(0, 3), (1, 3)]
    cli.main(["predict-single", "PEPK/2", "--predictor", "tests.test_more:small_predictor", "--device", "cpu"], spark)
    assert capsys.readouterr().out.splitlines() == ["b: 1 positions, 1 ions"]
    cli.main(["predict-single", "PEPK/2", "--predictor", "tests.test_more:small_predictor", "--output", f"{tmp_path}/one.json"], spark)
    assert json.loads((tmp_path / "one.json").read_text()) == [{"psm_index": 0, "correlation": None, "n_b_ions": 1, "n_y_ions": 0}]
    for wrong in (["predict-single", "PEPK/2"], ["predict-single", "PEPK/2", "--batch-size", "0"]):
        with pytest.raises(SystemExit):
            cli.main(wrong, spark)


def small_predictor(device, batch_size):
    assert device == "cpu" and batch_size > 0

    def predict(model, batch):
        n = batch.num_rows
        return pa.RecordBatch.from_pydict({"precursor_key": batch.column("precursor_key"), "ion": ["b"] * n, "row": pa.array([0] * n, pa.int32()), "frag_charge": pa.array([1] * n, pa.int32()), "mz": pa.array([model] * n, pa.float32()), "predicted": [1.5] * n})

    return ArrowModel(lambda: 100.0, predict, "precursor_key string, ion string, row int, frag_charge int, mz float, predicted double")


def test_model_is_loaded_once_in_a_worker(spark, tmp_path):
    def load():
        with open(f"{tmp_path}/{os.getpid()}-{os.urandom(4).hex()}", "w"):
            return 1

    model = ArrowModel(load, lambda m, batch: batch, "id long")
    for _ in range(2):
        assert model.fragments(spark.range(0, 400, 1, 40)).count() == 400
    workers = [os.path.basename(p).split("-")[0] for p in glob.glob(f"{tmp_path}/*")]
    assert len(workers) == len(set(workers)) < 40


def test_empty_results(spark, tmp_path):
    empty = spark.createDataFrame([], f"{ROW_ID} long, correlation double, n_b_ions long, n_y_ions long")
    correlate.write_results(empty, f"{tmp_path}/e.json")
    assert json.loads((tmp_path / "e.json").read_text()) == [] and correlate.summary(empty) == "0 of 0 results correlated"


def test_modification_error_type(spark):
    mods = spark.createDataFrame(MODS, "mod_name string, unimod_id long")
    rows = correlate.peptidoforms(spark.createDataFrame([("s", "A[UNIMOD:35]K/2")], "spectrum_id string, peptidoform string"), mods)
    with pytest.raises(modifications.ModificationError, match="unknown modification UNIMOD:35 on AK"):
        modifications.checked(rows)


def test_jdbc_store(spark, tmp_path):
    url = "jdbc:derby:memory:store;create=true"
    jvm = spark.sparkContext._jvm
    connection = jvm.java.sql.DriverManager.getConnection(url)
    say = connection.createStatement()
    for side, shift in (("target", 0), ("decoy", 50)):
        for text in (
            f"CREATE TABLE APP.{side}_peptide (peptide_id BIGINT, pep_seq VARCHAR(50))", f"CREATE TABLE APP.{side}_variant (variant_id BIGINT, peptide_id BIGINT, var_mod_sites_unimod VARCHAR(50))", f"CREATE TABLE APP.{side}_prediction (precursor_id BIGINT, peak_code INT)",
            *(f"INSERT INTO APP.{side}_peptide VALUES ({i + shift}, 'P{i}')" for i in range(5)), *(f"INSERT INTO APP.{side}_prediction VALUES ({i * 10 + shift}, {i})" for i in range(3)),
        ):
            say.executeUpdate(text)
    say.executeUpdate("CREATE TABLE APP.fragment_peak_codes (peak_code INT, ion_type VARCHAR(1))")
    say.executeUpdate("INSERT INTO APP.fragment_peak_codes VALUES (1, 'b')")
    (tmp_path / "password").write_text("secret\n")
    store = stores.jdbc_store(spark, url, "APP", "APP", f"{tmp_path}/password", partitions=3)
    assert sorted(tuple(r) for r in store.peptide.select("peptide_id", "pep_seq", "is_target").collect()) == sorted([(i, f"P{i}", True) for i in range(5)] + [(i + 50, f"P{i}", False) for i in range(5)])
    assert store.variant.count() == 0 and store.prediction.where("is_target").count() == 3 and store.codes.count() == 1
    assert store.peptide.rdd.getNumPartitions() == 6
    parquet = f"{tmp_path}/store"
    for name in ("peptide", "variant", "prediction", "codes"):
        getattr(store, name).write.parquet(f"{parquet}/{name}")
    assert stores.parquet_store(spark, parquet).peptide.count() == 10


def test_cache_grows_by_what_is_new(spark, tmp_path):
    held = cache.Cache(spark, f"{tmp_path}/c", "k", "k long, v long")
    held.COMPACT = 4
    folders = lambda: sorted(os.path.basename(p)[:11] for p in glob.glob(f"{tmp_path}/c/*"))
    for i in range(3):
        held.append(spark.range(i * 5, i * 5 + 5).selectExpr("id AS k", f"{i} AS v").select("k", F.col("v").cast("long")))
    before = folders()
    assert before == ["add00000000", "add00000001", "add00000002"]
    reader = held.read()
    held.append(spark.createDataFrame([], "k long, v long"))
    assert folders() == before and held.read().count() == 15
    held.append(spark.createDataFrame([(99, 9)], "k long, v long"))
    assert folders()[-1] == "gen00000004" and sorted(r.k for r in held.read().collect()) == [*range(15), 99]
    assert reader.count() == 15  # what a plan still reads stays until the next compaction
    for i in range(4):
        held.append(spark.createDataFrame([(200 + i, i)], "k long, v long"))
    assert [f for f in folders() if f < "add00000005"] == [] and held.read().count() == 20


def test_ten_arrivals_write_in_proportion(spark, tmp_path):
    held = cache.Cache(spark, f"{tmp_path}/cache", "psm_key", "psm_key string, v long")
    rows, written = [], []
    for n in range(10):
        spark.createDataFrame([(f"k{i}", i) for i in range(n * 100, n * 100 + 120)], "psm_key string, v long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        score_arrivals(spark, f"{tmp_path}/in", held.read().schema, f"{tmp_path}/check", held, lambda df: df)
        rows.append(held.read().count())
        written.append(sum(spark.read.parquet(p).count() for p in glob.glob(f"{tmp_path}/cache/*")))
    assert rows == [120 + 100 * n for n in range(10)] == written


def test_ties_of_new_rows(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v long")
    new = spark.createDataFrame([("a", v) for v in range(2, 40)], "k string, v long")
    got = {cache.merge_keep_last(old, new.repartition(n), "k").first().v for n in (1, 3, 7)}
    assert len(got) == 1 and got != {1}


def test_rows_of_several_text_files(spark, tmp_path):
    for name, n in (("a", 3), ("b", 500), ("c", 2)):
        (tmp_path / "t.pin").mkdir(exist_ok=True)
        (tmp_path / "t.pin" / f"{name}.txt").write_text(PIN + "".join(f"{name}{i}\t1\t{i}\t1.5\t0\t1\tAK\tp\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = tables.read_matches(spark, f"{tmp_path}/t.pin")
        assert got.rdd.getNumPartitions() > 2
        rows = sorted((r[ROW_ID], r.SpecId) for r in got.collect())
        assert rows == list(enumerate([*(f"a{i}" for i in range(3)), *(f"b{i}" for i in range(500)), *(f"c{i}" for i in range(2))]))
        (tmp_path / "s.mgf").mkdir()
        for name, mz in (("1", 500.0), ("2", 600.0)):
            blocks = "".join(f"BEGIN IONS\nTITLE=x{i}\nPEPMASS={mz + i}\n1 1\nEND IONS\n" for i in range(200 if name == "1" else 1))
            (tmp_path / "s.mgf" / f"{name}.txt").write_text(blocks)
        last = {r.identifier: r.precursor_mz for r in spectra.read_observed(spark, f"{tmp_path}/s.mgf").collect()}
        assert last == {f"x{i}": 600.0 if i == 0 else 500.0 + i for i in range(200)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_peaks_without_an_index(spark):
    ions = spark.createDataFrame([(1, 100.0)], "s int, mz double")
    peaks = spark.createDataFrame([(1, m, i) for m in (99.99, 100.02) for i in (1.0, 3.0, 2.0)], "s int, mz double, intensity double")
    got = {match.nearest_peaks(ions, peaks.repartition(n), "s", 0.03).first().observed for n in (1, 2, 5)}
    assert len(got) == 1 and got.pop() == pytest.approx(math.log2(3.001))


def test_calibration_is_kept(spark, tmp_path):
    predictor, times = build_inputs(spark, tmp_path)
    config = BuildConfig(f"{tmp_path}/r.pin.gz", f"{tmp_path}/r.mgf", f"{tmp_path}/out", "r")
    assert build.load_calibration(spark, config) is None
    build.save_calibration(spark, config, [[0.0, 100.0], [10.0, 110.0]])
    assert build.load_calibration(spark, config) == [[0.0, 100.0], [10.0, 110.0]]
    got = {r.SpecId: r.predicted_retention_time for r in build.build_features(spark, config, local=predictor, times=times).collect()}
    assert got["s1"] == pytest.approx(109.0)
    again = BuildConfig(config.match_table, config.spectra, f"{tmp_path}/out3", "r", recalibrate=True)
    build.save_calibration(spark, again, [[0.0, 100.0], [10.0, 110.0]])
    build.build_features(spark, again, local=predictor, times=times)
    assert build.load_calibration(spark, again) != [[0.0, 100.0], [10.0, 110.0]]


def test_predict_single(spark):
    table = spark.createDataFrame([("AK/2", "b", 0, 1, 100.0, 1.0), ("GK/2", "b", 0, 1, 90.0, 1.0)], "precursor_key string, ion string, row int, frag_charge int, mz float, predicted double")
    got = correlate.predict_single(spark, "AK/2", TableFragments(table)).collect()
    assert [(r[ROW_ID], r.mz) for r in got] == [(0, 100.0)] and len(FEATURES) == 77
    assert correlate.ion_counts(correlate.predict_single(spark, "AK/2", TableFragments(table))).first()["n_b_ions"] == 1
    assert np.isfinite(got[0].predicted) and lookup.FOUND == "store" and sinks.insert_before(["Peptide"], ["x"]) == ["x", "Peptide"]
