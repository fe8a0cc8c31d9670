"""The fused kernel against the declarative path, the isotonic fit, fragments from ranges of rows."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectrail.operators import kernel, match, ranges, retention, similarity
from spectrail.plans import build
from spectrail.schemas import SPECTRAL_FEATURES

from .test_numbers import feature_values

FRAGMENTS = "array<struct<ion:string,row:int,frag_charge:int,mz:{0},predicted:double>>"
PEAKS = "array<struct<mz:{0},peak_index:int,intensity:{0}>>"


def spectra_and_precursors(seed, kind):
    """Scans with ties, repeated peaks, one peak and none; precursors with equal m/z, absent cells and none."""
    r = random.Random(seed)
    mz = lambda: round(r.choice([r.uniform(0, 3), r.randrange(30) / 10, r.randrange(300) / 100]), 2)
    cast = (lambda x: float(np.float32(x))) if kind == "float" else float
    observed = [(s, [(cast(m), i, cast(round(r.uniform(0, 9), 2))) for i, m in enumerate(sorted(mz() for _ in range(r.choice([0, 1, 2, 30, 120]))))]) for s in range(25)]
    precursors = [(f"p{k}", [(r.choice("by"), i, 1, cast(r.choice([0.0, -1.0]) if r.random() < 0.1 else mz()), round(r.uniform(-9, 2), 3)) for i in range(r.choice([0, 1, 5, 40]))]) for k in range(40)]
    return observed, precursors + [("none", None), ("nulls", [("b", 0, 1, None, 1.0), ("y", 0, 1, cast(1.0), None), ("y", 1, 1, cast(1.1), 0.5)])]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_fused_equals_the_declarative_path(spark, kind):
    observed, precursors = spectra_and_precursors(7, kind)
    peaks = spark.createDataFrame(observed, f"scan_number long, peaks {PEAKS.format(kind)}")
    held = spark.createDataFrame(precursors, f"precursor_key string, fragments {FRAGMENTS.format(kind)}")
    rows = [(f"{k}-{s}", k, s) for (k, _), (s, _) in itertools.product(precursors, [*observed, (99, None)])]
    rows = spark.createDataFrame([*rows, ("lost", "unknown", 3), rows[0]], "psm_key string, precursor_key string, ScanNr int")
    got = {r.psm_key: r.asDict() for r in build.score(rows, held, peaks, 0.1).collect()}
    ions = rows.dropDuplicates(["psm_key"]).join(held, "precursor_key").select("psm_key", F.col("ScanNr").cast("long").alias("scan_number"), F.inline("fragments")).where("mz > 0")
    ions = ions.join(peaks.select("scan_number"), "scan_number", "left_semi")
    matched = match.nearest_peaks(ions.select("psm_key", "scan_number", "ion", "mz", "predicted"), peaks.select("scan_number", F.inline("peaks")), "scan_number", 0.1).cache()
    want = {r.psm_key: r.asDict() for r in similarity.native_similarity(matched.where("predicted IS NOT NULL"), ["psm_key"]).collect()}
    assert matched.where("observed > 0").count() > 500 and matched.where("observed = 0").count() > 500
    for key, row in got.items():
        assert row == pytest.approx(want.get(key) or {"psm_key": key} | dict.fromkeys(SPECTRAL_FEATURES, 0.0), abs=1e-7), key
    assert len(got) == rows.select("psm_key").distinct().count() and {k for k in want} < set(got)


def test_golden_features_of_the_kernel(spark):
    """The bracketing rule: an ion at the first peak has none below it."""
    b = [("b", 0, 1, 100.0, math.log2(0.5)), ("b", 1, 1, 200.0, math.log2(0.2)), ("y", 0, 1, 300.0, math.log2(0.4)), ("y", 1, 1, 0.0, 5.0)]
    peaks = [(100.0, 0, 50.0), (200.0, 1, 20.0), (300.0, 2, 40.0), (400.0, 3, 10.0)]
    rows = spark.createDataFrame([("k", b, peaks)], f"psm_key string, fragments {FRAGMENTS.format('float')}, peaks {PEAKS.format('float')}")
    got = similarity.scored(rows.select("psm_key", *similarity.fragment_columns(), *similarity.peak_columns()), ["psm_key"]).first().asDict()
    seen = [0.0, math.log2(20.001), math.log2(40.001)]
    want = feature_values(np.array([x[4] for x in b[:3]]), np.array(seen), np.array(["b", "b", "y"]))
    assert {k: got[k] for k in want} == pytest.approx(want, abs=1e-6)


def test_no_shuffle_after_the_join_by_scan(spark):
    observed, precursors = spectra_and_precursors(1, "float")
    peaks = spark.createDataFrame(observed, f"scan_number long, peaks {PEAKS.format('float')}")
    held = spark.createDataFrame(precursors, f"precursor_key string, fragments {FRAGMENTS.format('float')}")
    both = held.crossJoin(peaks.limit(2)).select(F.col("precursor_key").alias("psm_key"), "fragments", "scan_number").join(peaks, "scan_number")
    plan = similarity.scored(both.select("psm_key", *similarity.fragment_columns(), *similarity.peak_columns()), ["psm_key"])._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Join")]
    assert "MapInArrow" in above and "Exchange" not in above and "Aggregate" not in above


def test_observed_values_of_many_rows():
    r = np.random.default_rng(4)
    for _ in range(20):
        peaks, ions = r.integers(0, 9, 30), r.integers(0, 9, 30)
        peak_mz = np.concatenate([np.sort(np.round(r.uniform(0, 2, n), 1)) for n in peaks]).astype(np.float32)
        intensity, mz = r.uniform(0, 5, len(peak_mz)).astype(np.float32), np.round(r.uniform(-0.2, 2, ions.sum()), 1).astype(np.float32)
        got, a, b = kernel.observed_values(mz, ions, peak_mz, intensity, peaks, 0.15), 0, 0
        for n, k in zip(ions, peaks, strict=True):
            row, tall = peak_mz[b : b + k], intensity[b : b + k]
            for i in range(a, a + n):
                t, at = mz[i], int(np.searchsorted(row, mz[i]))
                value = 0.0
                if t > 0 and 0 < at < k:
                    below, above = t - row[at - 1], row[at] - t
                    hit = at - 1 if below <= above and float(below) < 0.15 else at if above < below and float(above) < 0.15 else None
                    value = 0.0 if hit is None else math.log2(float(tall[hit]) + 0.001)
                assert got[i] == pytest.approx(value, abs=1e-12)
            a, b = a + n, b + k


def test_isotonic():
    r = random.Random(2)
    assert retention.isotonic([]) == [] and retention.isotonic([(1.0, 5.0, 2)]) == [(1.0, 5.0)]
    assert retention.isotonic([(2.0, 1.0, 1), (1.0, 3.0, 1), (3.0, 4.0, 1)]) == [(1.0, 2.0), (2.0, 2.0), (3.0, 4.0)]
    for _ in range(60):
        points = [(float(r.randrange(12)), r.uniform(0, 9), r.randint(1, 9)) for _ in range(r.randint(1, 25))]
        got = retention.isotonic(points)
        xs = sorted({p[0] for p in points})
        mean = lambda a, b: sum(y * w for x, y, w in points if a <= x <= b) / sum(w for x, _, w in points if a <= x <= b)
        want = [max(min(mean(a, b) for b in xs if b >= x) for a in xs if a <= x) for x in xs]
        assert [x for x, _ in got] == xs and [y for _, y in got] == pytest.approx(want)
        assert all(a[1] <= b[1] for a, b in zip(got, got[1:], strict=False))


def test_knots_never_fall(spark):
    noisy = spark.range(4000).select((F.col("id") / 40).alias("raw"), (F.col("id") / 40 + 30 * F.sin(F.col("id") / 150)).alias("observed_retention_time"))
    for bins in (1, 7, 40):
        at = retention.knots(noisy, bins)
        assert len(at) == bins and all(a[0] < b[0] and a[1] <= b[1] for a, b in zip(at, at[1:], strict=False))
    some = noisy.withColumn("raw", F.when(F.col("raw") < 50, F.col("raw")))
    assert max(x for x, _ in retention.knots(some, 5)) < 50


def tables_of(spark, n=12):
    mz = spark.createDataFrame([(i, i + 0.5, i + 1.5, None if i == 4 else i + 2.5) for i in range(n)], "frag_row long, b_z1 double, b_z2 double, y_z1 double")
    return mz, spark.createDataFrame([(i, float(i), 1.0, 2.0) for i in range(n)], "frag_row long, b_z1 double, b_z2 double, y_z1 double")


def test_ranges(spark):
    mz, intensity = tables_of(spark)
    held = spark.createDataFrame([("a", 0, 5), ("b", 5, 5), ("c", 5, 12)], "precursor_key string, frag_start int, frag_stop int")
    got = {(r.precursor_key, r.ion, r.row, r.frag_charge): (r.mz, r.predicted) for r in ranges.from_ranges(held, mz, intensity).collect()}
    want = {}
    for key, start, stop in (("a", 0, 5), ("c", 5, 12)):
        for i in range(start, stop):
            for ion, z, m, v in (("b", 1, i + 0.5, i), ("b", 2, i + 1.5, 1.0), ("y", 1, i + 2.5, 2.0)):
                if not (ion == "y" and i == 4):
                    want[key, ion, i - start, z] = (m, pytest.approx(math.log2(v + 0.001)))
    assert got == want


@pytest.mark.parametrize(("held", "why"), [
    ([("a", 0, 6), ("c", 5, 12)], "several ranges"), ([("a", 0, 5), ("c", 6, 12)], "row of no range: 5"), ([("a", 0, 13)], "beyond the rows: 12"),
    ([("a", 0, None), ("c", 0, 12)], "no range of rows: a"), ([("a", 7, 2), ("c", 0, 12)], "no range of rows: a"),
])
def test_wrong_ranges(spark, held, why):
    got = ranges.from_ranges(spark.createDataFrame(held, "precursor_key string, frag_start int, frag_stop int"), *tables_of(spark))
    with pytest.raises(Exception, match=why):
        got.collect()


def test_ranges_of_some_rows(spark):
    mz, intensity = tables_of(spark)
    held = spark.createDataFrame([("a", 2, 4)], "precursor_key string, frag_start int, frag_stop int")
    assert ranges.from_ranges(held, mz, intensity, whole=False).count() == 6
    with pytest.raises(Exception, match="several times"):
        ranges.from_ranges(held, mz.union(mz.where("frag_row = 3")), intensity, whole=False).collect()
    assert ranges.from_ranges(held.limit(0), mz.limit(0), intensity.limit(0)).count() == 0
