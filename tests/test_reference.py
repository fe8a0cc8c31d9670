"""Published facts about the computation, on small inputs: parser, scans, matching, features, caches, output."""

import gzip
import math
import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from spectrail import cli
from spectrail.config import BuildConfig
from spectrail.functions import peptide, text
from spectrail.operators import cache, lookup, match, modifications, retention, similarity
from spectrail.plans import build, correlate
from spectrail.plans.predictors import TableFragments, TableTimes
from spectrail.schemas import FEATURES, ROW_ID, SPECTRAL_FEATURES
from spectrail.sources import sinks, spectra, tables

from .test_numbers import feature_values


def one(spark, *columns):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()


@pytest.mark.parametrize(("written", "sequence", "sites"), [
    ("LHWLVM[U:35]RK", "LHWLVMRK", "5:35"), ("[U:1]-M[U:35]LQFLLEVNK", "MLQFLLEVNK", "0:35;10:1"), ("Q[U:28]AVKLVKANK", "QAVKLVKANK", "0:28"),
    ("AK-[U:2]", "AK", "-1:2"), (" UK ", "UK", ""), ("M[U:35][U:1]U[U:2]", "MU", "0:35;0:1;1:2"),
])
def test_peptides(spark, written, sequence, sites):
    got = one(spark, peptide.parse_peptide(F.lit(written)))[0]
    assert (got.sequence, got.var_mod_sites) == (sequence, sites)


@pytest.mark.parametrize("bad", ["", "pepTIDE", "K.PEP.R", "[U:x]-A", "A-[U:1]B"])
def test_bad_peptides(spark, bad):
    with pytest.raises(Exception, match="not a peptide"):
        one(spark, peptide.parse_peptide(F.lit(bad)))


def test_charges(spark):
    df = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "Charge1 int, Charge2 int, Charge3 int")
    assert [r[0] for r in df.select(peptide.decode_charge(df.columns)).collect()] == [2, 1]
    for row in ((1, 1), (0, 0), (None, None)):
        bad = spark.createDataFrame([row], "Charge1 int, Charge2 int")
        with pytest.raises(Exception, match="not one charge"):
            bad.select(peptide.decode_charge(bad.columns)).collect()


@pytest.mark.parametrize(("title", "scan"), [
    ("scan=42", 42), ("x SCANS: 7,8", 7), ("43", 43), ("run.43.43.2", 43), ("run.43.44.2", 43), ("a.b.c", None), ("only 9 here", 9), ("1 or 2", None), ("", None), ("discan=5", 5),
])
def test_titles(spark, title, scan):
    assert one(spark, text.scan_from_title(F.lit(title)))[0] == scan


def test_identifiers(spark):
    assert one(spark, text.normal_id(F.lit("a%20b+c")), text.normal_id(F.lit("bad%zz")), text.normal_id(F.lit(None).cast("string")), text.normal_id(F.lit("scan=12 x"), r"scan=(\d+)"), text.normal_id(F.lit("scan=12 x"), r"\d+"), text.normal_id(F.lit("none"), r"\d+"))[0:6] == ("a b+c", "bad%zz", "", "12", "12", "none")


def test_format(spark):
    values = [0.1, 1 / 3, 1e-5, 1e10, 123456789012.0, -0.5, 10.30000019, 5.0, float("inf"), None, float("nan")]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(text.format_10g("v")).collect()]
    assert got == ["" if v is None or v != v else f"{v:.10g}" for v in values]


def test_matching_vector(spark):
    ions = spark.createDataFrame([(1, i, m) for i, m in enumerate([0.0, 100.01, 200.0, 300.0])], "s int, i int, mz double")
    peaks = spark.createDataFrame([(1, 99.99, 10.0, 0), (1, 100.02, 20.0, 1), (1, 200.05, 30.0, 2)], "s int, mz double, intensity double, peak_index long")
    got = {r.i: r.observed for r in match.nearest_peaks(ions, peaks, "s", 0.03).collect()}
    assert got == pytest.approx({0: 0.0, 1: math.log2(20.001), 2: 0.0, 3: 0.0})


def test_matching_at_random(spark):
    r = random.Random(4)
    peaks = [(s, round(r.uniform(0, 5), 1), float(r.randint(1, 9)), i) for s in range(6) for i in range(r.choice([0, 1, 2, 40]))]
    ions = [(s, i, round(r.uniform(-0.2, 5.2), 2)) for s in range(7) for i in range(60)]
    got = {(x.s, x.i): x.observed for x in match.nearest_peaks(spark.createDataFrame(ions, "s int, i int, mz double"), spark.createDataFrame(peaks, "s int, mz double, intensity double, peak_index long"), "s", 0.06).collect()}
    for s, i, m in ions:
        own = sorted((p[1], p[3], p[2]) for p in peaks if p[0] == s)
        low, high = [p for p in own if p[0] < m], [p for p in own if p[0] >= m]
        want = 0.0
        if m > 0 and low and high:
            a, b = m - low[-1][0], high[0][0] - m
            best = low[-1] if a <= b and a < 0.06 else high[0] if b < a and b < 0.06 else None
            want = math.log2(best[2] + 0.001) if best else 0.0
        assert got[s, i] == pytest.approx(want)


def test_golden_features(spark):
    ions = spark.createDataFrame([(1, "b", 100.0, math.log2(0.5)), (1, "b", 200.0, math.log2(0.2)), (1, "y", 300.0, math.log2(0.4)), (1, "y", 400.0, math.log2(0.1))], "s int, ion string, mz double, predicted double")
    peaks = spark.createDataFrame([(1, 100.0, 50.0, 0), (1, 200.0, 20.0, 1), (1, 300.0, 40.0, 2), (1, 400.0, 10.0, 3)], "s int, mz double, intensity double, peak_index long")
    got = similarity.similarity(match.nearest_peaks(ions, peaks, "s"), ["s"]).first().asDict()
    assert len(SPECTRAL_FEATURES) == 71 and set(got) == {"s", *SPECTRAL_FEATURES}
    assert got["spec_pearson_norm"] == pytest.approx(-0.3138841974465237, abs=1e-6) and got["spec_spearman"] == pytest.approx(-0.2)
    assert got["min_abs_diff_iontype"] == 0 and got["max_abs_diff_iontype"] == 1 and got["cos"] == pytest.approx(0.6910891532897949, abs=1e-6)


def test_features_at_random(spark):
    r = np.random.default_rng(1)
    rows, want = [], {}
    for k in range(25):
        n_b, n_y = r.integers(0, 9, 2)
        if not n_b + n_y:
            continue
        x, y = r.normal(size=n_b + n_y).round(2), np.where(r.random(n_b + n_y) < 0.5, 0.0, r.normal(size=n_b + n_y))
        ions = ["b"] * n_b + ["y"] * n_y
        rows += [(k, i, float(a), float(b)) for i, a, b in zip(ions, x, y, strict=True)]
        want[k] = feature_values(x, y, np.array(ions))
    df = spark.createDataFrame(rows, "k int, ion string, predicted double, observed double")
    for way in (similarity.similarity, similarity.native_similarity):
        got = way(df, ["k"]).collect()
        assert len(got) == len(want)
        for row in got:
            assert row.asDict() == pytest.approx(want[row.k] | {"k": row.k}, abs=1e-7)


def test_store(spark):
    codes = spark.createDataFrame([(1, "b", 1, 1, "none"), (2, "y", 1, 2, "none"), (3, "b", 1, 1, "H2O"), (4, "y", 9, 1, "none"), (5, "b", 2, 4, "none")], "peak_code int, ion_type string, position int, fragment_charge int, neutral_loss string")
    pep = spark.createDataFrame([(1, "PEPK", True), (2, "DECK", False), (3, "TWOK", True)], "peptide_id long, pep_seq string, is_target boolean")
    var = spark.createDataFrame([(10, 1, "", True), (11, 1, "0:35", True), (20, 2, "", False), (30, 3, "", True), (31, 3, "", True)], "variant_id long, peptide_id long, var_mod_sites_unimod string, is_target boolean").withColumns({"fixed_mod_sites_unimod": F.lit(None).cast("string"), "all_unimods": F.lit(None).cast("array<string>")})
    pred = spark.createDataFrame([(102, True, [1, 2, 3, 4, 5, 99, 1], [100.0, 200.0, 1.0, 1.0, 1.0, 1.0, 150.0], [0.5, 0.25, 1.0, 1.0, 1.0, 1.0, 0.75]), (202, False, [], [], [])], "precursor_id long, is_target boolean, peak_code array<int>, mz array<double>, intensity array<double>")
    held = lookup.Store(pep, var, pred, codes)
    asked = spark.createDataFrame([("a", 1, "PEPK", "", 2), ("b", 1, "PEPK", "0:35", 2), ("c", 1, "NONE", "", 2), ("d", -1, "DECK", "", 2), ("e", -1, "PEPK", "", 2)], "precursor_key string, label int, sequence string, var_mod_sites_unimod string, charge int")
    got = lookup.look_up(asked, held)
    assert {r.precursor_key: r.prediction_source for r in got.collect()} == {"a": "store", "b": "missing_prediction", "c": "missing_variant", "d": "store", "e": "missing_variant"}
    cells = {(r.precursor_key, r.ion, r.row, r.frag_charge): (r.mz, r.predicted) for r in lookup.scatter(got, codes).collect()}
    assert cells == {("a", "b", 0, 1): (150.0, pytest.approx(math.log2(0.751))), ("a", "y", 2, 2): (200.0, pytest.approx(math.log2(0.251)))}
    dense = lookup.matrices(lookup.scatter(got, codes), spark.createDataFrame([("a", 4), ("d", 4)], "precursor_key string, length int")).orderBy("precursor_key").collect()
    assert dense[0].b_mz == [[150, 0, 0], [0, 0, 0], [0, 0, 0]] and dense[0].y_mz[2] == [0, 200, 0] and dense[1].y_mz == [[0, 0, 0]] * 3
    with pytest.raises(Exception, match="several variants"):
        lookup.look_up(spark.createDataFrame([("f", 1, "TWOK", "", 2)], asked.schema), held).collect()


def test_cache(spark, tmp_path):
    held = cache.Cache(spark, f"{tmp_path}/c", "k", "k string, v long")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    assert held.read().count() == 0
    held.write(cache.merge_keep_last(held.read(), rows, "k"))
    held.write(cache.merge_keep_last(held.read(), spark.createDataFrame([("b", 9), ("c", 3)], "k string, v long"), "k"))
    assert sorted(map(tuple, held.read().collect())) == [("a", 1), ("b", 9), ("c", 3)]
    assert cache.missing(rows, held.read(), "k").count() == 0
    other = cache.Cache(spark, f"{tmp_path}/c", "k", "k string, v long", fingerprint="x")
    assert other.read().count() == 0
    other.write(rows)
    assert other.read().count() == 2 and cache.Cache(spark, f"{tmp_path}/c", "k", "k string, v long", fingerprint="y").read().count() == 0


def test_times(spark):
    assert [retention.half_even(n, 0.15) for n in (1, 10, 30, 50)] == [1, 2, 4, 8]
    rows = spark.createDataFrame([(0, "P", 1, 10.0, 1.0, 10.5), (1, "P", 1, 21.0, 2.0, 20.5), (2, "Q", 0, 0.0, None, None), (3, "R", 1, 5.0, 2.0, 7.0)], f"{ROW_ID} long, Peptide string, Label int, observed_retention_time double, Xcorr double, predicted_retention_time double")
    assert [r[ROW_ID] for r in retention.calibration_set(rows, 0.5).orderBy(ROW_ID).collect()] == [1, 3]
    with pytest.raises(ValueError, match="calibrate"):
        retention.calibration_set(rows.where("Label = 0"))
    r = random.Random(3)
    data = [(i, r.choice([None, float("nan"), 1.5, -2.0, 1e300, r.random(), r.random()])) for i in range(300)]
    many = spark.createDataFrame(data, f"{ROW_ID} long, s double")
    order = sorted(data, key=lambda x: (x[1] is None or x[1] != x[1], -(x[1] or 0) if x[1] == x[1] else 0, x[0]))
    for n in (1, 37, 150, 240, 299, 300, 500):
        assert sorted(x[ROW_ID] for x in retention.top_n(many, n, F.col("s")).collect()) == sorted(x[0] for x in order[:n])
    base = retention.base_features(rows)
    for best in (retention.best_per_peptide,):
        got = {r[ROW_ID]: (r.rt_diff, r.observed_retention_time_best, r.rt_diff_best) for r in best(base).collect()}
        assert got == {0: (0.5, 10.0, 0.5), 1: (0.5, 10.0, 0.5), 2: (0.0, 0.0, 0.0), 3: (2.0, 5.0, 2.0)}
    at = [(0.0, 10.0), (10.0, 30.0), (20.0, 40.0)]
    line = [r[0] for r in spark.createDataFrame([(-5.0,), (5.0,), (15.0,), (30.0,)], "x double").select(retention.calibrate(F.col("x"), at)).collect()]
    assert line == [0.0, 20.0, 35.0, 50.0]


MODS = [("Oxidation@M", 35), ("Oxidation@K", 35), ("Oxidation@G^Any_C-term", 35), ("Acetyl@Any_N-term", 1), ("Acetyl@Protein_N-term", 1), ("Amidated@Any_C-term", 2), ("Gln->pyro-Glu@Q^Any_N-term", 28), ("Nothing@X", None), ("plain", 9)]


@pytest.mark.parametrize(("written", "sequence", "mods", "sites"), [
    ("RNVIM[Oxidation]DKVAK/2", "RNVIMDKVAK", "Oxidation@M", "5"), ("[Acetyl]-PEPTIDEK/2", "PEPTIDEK", "Acetyl@Any_N-term", "0"), ("[UNIMOD:1]-PEPTIDEK/2", "PEPTIDEK", "Acetyl@Any_N-term", "0"),
    ("PEPTIDEK-[Amidated]/2", "PEPTIDEK", "Amidated@Any_C-term", "-1"), ("[Gln->pyro-Glu]-QPEPTIDE/2", "QPEPTIDE", "Gln->pyro-Glu@Q^Any_N-term", "0"), ("Q[pyro-Glu]PEPTIDE/2", "QPEPTIDE", "Gln->pyro-Glu@Q^Any_N-term", "0"),
    ("Q[UNIMOD:28]PEPTIDE/2", "QPEPTIDE", "Gln->pyro-Glu@Q^Any_N-term", "0"), ("PEPTIDEK[UNIMOD:35]/2", "PEPTIDEK", "Oxidation@K", "8"), ("PEPTIDEG[UNIMOD:35]/2", "PEPTIDEG", "Oxidation@G^Any_C-term", "-1"),
    ("PEPK/3", "PEPK", "", ""), ("PEP[Own]K/3", "PEPK", "Own@P", "3"), ("[Acetyl]-M[35]K/2", "MK", "Acetyl@Any_N-term;Oxidation@M", "0;1"),
])
def test_peptidoforms(spark, written, sequence, mods, sites):
    df = spark.createDataFrame([("s", written)], "spectrum_id string, peptidoform string")
    got = correlate.peptidoforms(df, spark.createDataFrame(MODS, "mod_name string, unimod_id long")).first()
    assert (got.sequence, got.mods, got.mod_sites) == (sequence, mods, sites)


def test_modification_errors(spark):
    mods = spark.createDataFrame([*MODS, ("Other@M", 35)], "mod_name string, unimod_id long")
    for written, why in (("PEPK", "no charge"), ("A[UNIMOD:35]K/2", "unknown"), ("M[UNIMOD:35]K/2", "ambiguous")):
        with pytest.raises(Exception, match=why):
            correlate.peptidoforms(spark.createDataFrame([("s", written)], "spectrum_id string, peptidoform string"), mods).collect()


def test_store_sites(spark):
    rows = spark.createDataFrame([(1, "MKK", "0:35;3:1;-1:2")], "id int, sequence string, v string").withColumn("tokens", modifications.variant_tokens(F.col("v"), F.col("sequence")))
    got = modifications.annotate(rows, spark.createDataFrame(MODS, "mod_name string, unimod_id long"), "id").first()
    assert (got.mods, got.mod_sites) == ("Oxidation@M;Acetyl@Any_N-term;Amidated@Any_C-term", "1;0;-1")


MGF = """junk
BEGIN IONS
TITLE=x scan=42 y
SCANS=42
PEPMASS=500.5 1000
CHARGE=2+
RTINSECONDS=12.5
100 5
50 2.5
bad line
END IONS

BEGIN IONS
TITLE=run.43.43.2
RTINSECONDS=13.5
200.0 15
150.0 7.5 extra
END IONS
BEGIN IONS
TITLE=scan=44
END IONS
BEGIN IONS
TITLE=broken scan=45
1 2
"""


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_mgf(spark, tmp_path, ending):
    raw = MGF.replace("\n", ending).encode()
    (tmp_path / "a.mgf").write_bytes(raw)
    (tmp_path / "b.mgf.gz").write_bytes(gzip.compress(raw))
    for name in ("a.mgf", "b.mgf.gz"):
        got = {r.scan_number: r for r in spectra.read_spectra(spark, f"{tmp_path}/{name}").collect()}
        assert {k: (r.rt_seconds, [(p.mz, p.intensity) for p in r.peaks]) for k, r in got.items()} == {42: (12.5, [(50.0, 2.5), (100.0, 5.0)]), 43: (13.5, [(150.0, 7.5), (200.0, 15.0)])} | ({45: (0.0, [(1.0, 2.0)])} if 45 in got else {})
    dropped = Observation()
    rows = sorted(spectra.read_mgf(spark, f"{tmp_path}/a.mgf", dropped).collect(), key=lambda r: r["__order"])
    assert (rows[0].precursor_mz, rows[0].precursor_charge, rows[0].scans) == (500.5, 2, "42") and dropped.get == {"lines": 1, "blocks": 1 + (len(rows) == 2)}


def test_duplicates(spark, tmp_path):
    block = "BEGIN IONS\nTITLE=scan=1\nPEPMASS={}\nCHARGE={}+\n1 1\nEND IONS\n"
    (tmp_path / "a.mgf").write_text(block.format(500.1, 2) + block.format(600.2, 3))
    got = spectra.read_observed(spark, f"{tmp_path}/a.mgf").collect()
    assert [(r.precursor_mz, r.precursor_charge) for r in got] == [(600.2, 3)]
    with pytest.raises(Exception, match="scan comes twice"):
        spectra.read_spectra(spark, f"{tmp_path}/a.mgf").collect()


def test_mzml(spark, tmp_path):
    import base64
    import zlib

    mz, intensity = np.array([200.0, 100.0]), np.array([2.0, 1.0], "<f4")
    array = lambda data, *names: f'<binaryDataArray>{"".join(f"<cvParam name={chr(34)}{n}{chr(34)}/>" for n in names)}<binary>{base64.b64encode(data).decode()}</binary></binaryDataArray>'
    body = f"""<mzML xmlns="http://psi.hupo.org/ms/mzml"><run><spectrumList><spectrum id="scan=7"><scanList><scan><cvParam name="scan start time" value="3.5"/></scan></scanList>
<precursorList><precursor><selectedIonList><selectedIon><cvParam name="selected ion m/z" value="450.25"/><cvParam name="charge state" value="2"/></selectedIon></selectedIonList></precursor></precursorList>
<binaryDataArrayList>{array(zlib.compress(mz.tobytes()), "m/z array", "64-bit float", "zlib compression")}{array(intensity.tobytes(), "intensity array", "32-bit float")}</binaryDataArrayList></spectrum><spectrum id="empty"/></spectrumList></run></mzML>"""
    (tmp_path / "a.mzML").write_text(body)
    (tmp_path / "b.mzML.gz").write_bytes(gzip.compress(body.encode()))
    for name in ("a.mzML", "b.mzML.gz"):
        got = {r.identifier: r for r in spectra.read_observed(spark, f"{tmp_path}/{name}").collect()}
        r = got["scan=7"]
        assert (r.precursor_mz, r.precursor_charge, r.retention_time, [(p.mz, p.intensity) for p in r.peaks]) == (450.25, 2, 3.5, [(100.0, 1.0), (200.0, 2.0)]) and got["empty"].peaks == []


PIN = "SpecId\tLabel\tScanNr\tXcorr\tCharge1\tCharge2\tPeptide\tProteins\n"


def build_inputs(spark, folder):
    rows = ["s1\t1\t42\t2.5\t0\t1\tPEPK\tp1\tp2", "s2\t-1\t42\t1.25\t0\t1\tDECK\td1", "s3\t1\t99\t0.1\t0\t1\tPEPK\tp1", "s4\t1\t43\t3\t1\t0\tNA\tp3", "s1\t1\t42\t2.5\t0\t1\tPEPK\tp1"]
    (folder / "r.pin.gz").write_bytes(gzip.compress((PIN + "\n".join(rows) + "\n").encode()))
    (folder / "r.mgf").write_text("BEGIN IONS\nTITLE=scan=42\nRTINSECONDS=10\n" + "".join(f"{m} {i}\n" for m, i in [(90, 5), (100, 50), (200, 20), (300, 40), (400, 10)]) + "END IONS\nBEGIN IONS\nTITLE=scan=43\nRTINSECONDS=21\n1 1\n2 2\nEND IONS\n")
    fragments = [(f"{label}|{s}||2", i, r, 1, m, math.log2(v)) for label, s in ((1, "PEPK"), (-1, "DECK")) for i, r, m, v in (("b", 0, 100.0, 0.5), ("b", 1, 200.0, 0.2), ("y", 0, 300.0, 0.4))]
    predictor = TableFragments(spark.createDataFrame(fragments, "precursor_key string, ion string, row int, frag_charge int, mz float, predicted double"))
    times = TableTimes(spark.createDataFrame([("PEPK", 9.0), ("DECK", 12.0), ("NA", 20.0)], "Peptide string, raw double"))
    return predictor, times


def test_build(spark, tmp_path):
    predictor, times = build_inputs(spark, tmp_path)
    config = BuildConfig(f"{tmp_path}/r.pin.gz", f"{tmp_path}/r.mgf", f"{tmp_path}/out", "r")
    result = build.build_pin(spark, config, local=LocalOnly(predictor), times=times)
    lines = gzip.open(result.output, "rt").read().splitlines()
    names = lines[0].split("\t")
    assert names == sinks.insert_before(PIN.strip().split("\t"), list(FEATURES))
    rows = [dict(zip(names, x.split("\t", len(names) - 1), strict=True)) for x in lines[1:]]
    assert [r["SpecId"] for r in rows] == ["s1", "s2", "s3", "s4", "s1"] and rows[0]["Proteins"] == "p1\tp2" and rows[3]["Peptide"] == "NA"
    assert float(rows[0]["cos"]) > 0 and rows[0]["cos"] == rows[4]["cos"] and rows[2]["cos"] == "0" == rows[3]["cos"] and rows[0]["Xcorr"] == "2.5"
    assert rows[0]["observed_retention_time"] == "10" and rows[2]["observed_retention_time"] == "0"
    assert (result.row_count, result.precursor_count, result.local_predictions, result.spectral_misses, result.spectral_hits) == (5, 3, 2, 4, 0)
    again = build.build_pin(spark, config, local=LocalOnly(predictor), times=times)
    assert gzip.open(again.output, "rt").read().splitlines() == lines and (again.spectral_hits, again.spectral_misses, again.rt_misses) == (4, 0, 0)
    first = build.build_features(spark, BuildConfig(config.match_table, config.spectra, f"{tmp_path}/o2", "r", max_rows=2), local=LocalOnly(predictor))
    assert first.count() == 2 and [c for c in first.columns if c != ROW_ID] == names


class LocalOnly:
    """Without a store every precursor lacks a prediction; this one then predicts them."""

    def __init__(self, inner):
        self.inner = inner

    def fragments(self, precursors):
        return self.inner.fragments(precursors)


def test_parquet_order(spark, tmp_path):
    rows = [(f"s{i}", 1, i, "AK", "p", 1) for i in range(50)]
    spark.createDataFrame(rows, "SpecId string, Label int, ScanNr long, Peptide string, Proteins string, Charge1 int").repartitionByRange(4, "ScanNr").write.parquet(f"{tmp_path}/r.pin.parquet")
    got = tables.read_matches(spark, f"{tmp_path}/r.pin.parquet", 7).orderBy(ROW_ID).collect()
    assert [(r[ROW_ID], r.ScanNr) for r in got] == [(i, i) for i in range(7)]
    with pytest.raises(ValueError, match="lacks"):
        spark.range(3).write.parquet(f"{tmp_path}/bad.pin.parquet")
        tables.read_matches(spark, f"{tmp_path}/bad.pin.parquet")


def test_correlate(spark, tmp_path):
    predictor, _ = build_inputs(spark, tmp_path)
    table = predictor.table.where("precursor_key = '1|PEPK||2'").withColumn("precursor_key", F.lit("PEPK/2"))
    psms = spark.createDataFrame([(0, "scan=42", "PEPK/2"), (1, "scan=77", "PEPK/2")], f"{ROW_ID} long, spectrum_id string, peptidoform string")
    observed = spectra.read_observed(spark, f"{tmp_path}/r.mgf", r"(scan=\d+)")
    with pytest.warns(RuntimeWarning, match="1 of 2"):
        got = {r[ROW_ID]: r for r in correlate.correlate(psms, observed, TableFragments(table), folder=f"{tmp_path}/rows").collect()}
    assert got[0].correlation is not None and got[1].correlation is None and (got[0].n_b_ions, got[0].n_y_ions) == (2, 1)


def test_arrivals(spark, tmp_path):
    from spectrail.streaming.incremental import score_arrivals

    schema = "psm_key string, v long"
    held = cache.Cache(spark, f"{tmp_path}/cache", "psm_key", schema)
    for n in range(2):
        spark.createDataFrame([(f"k{i}", i) for i in range(n * 3, n * 3 + 4)], schema).write.mode("append").parquet(f"{tmp_path}/in")
        score_arrivals(spark, f"{tmp_path}/in", held.read().schema, f"{tmp_path}/check", held, lambda df: df.withColumn("v", F.col("v") * 10))
    assert sorted(map(tuple, held.read().collect())) == [(f"k{i}", i * 10) for i in range(7)]


def test_paths(tmp_path):
    for name in ("r.pin", "r.mgf.gz", "r.mgf.parquet"):
        (tmp_path / name).touch()
    parse = cli.parser().parse_args
    assert cli.resolve_paths(parse(["build", "--pin-dir", str(tmp_path), "--mgf-dir", str(tmp_path), "--run-id", "r", "--out-dir", "o"])) == (f"{tmp_path}/r.pin", f"{tmp_path}/r.mgf.parquet", "r")
    assert cli.resolve_paths(parse(["build", "--pin-file", "/a/q.pin.parquet", "--spectrum-file", "/a/q.mgf", "--out-dir", "o"]))[2] == "q"
    with pytest.raises(SystemExit):
        cli.resolve_paths(parse(["build", "--out-dir", "o"]))
    with pytest.raises(FileNotFoundError):
        cli.find_file(str(tmp_path), "zz", cli.MATCH_ENDINGS)
