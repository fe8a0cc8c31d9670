"""Inputs read once and in splits, counters observed on the way, caches that notice changed contents, progress inside a step."""

import base64
import gzip
import os
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from spectrail import progress
from spectrail.config import BuildConfig
from spectrail.operators import cache
from spectrail.plans import build
from spectrail.plans.predictors import TableFragments, mark
from spectrail.sources import spectra, tables

from .test_reference import LocalOnly, build_inputs


def mzml(n, index, encoding="utf-8"):
    r = random.Random(n)
    parts, offsets = [f'<?xml version="1.0" encoding="{encoding}"?>\n<indexedmzML xmlns="http://psi.hupo.org/ms/mzml"><mzML><run><spectrumList count="{n}">'], []
    for i in range(n):
        values = np.array([r.random() * 900 for _ in range(r.randrange(40))])
        data = base64.b64encode(values.tobytes()).decode()
        array = "".join(f'<binaryDataArray><cvParam name="{k}"/><cvParam name="64-bit float"/><binary>{data}</binary></binaryDataArray>' for k in ("m/z array", "intensity array"))
        body = f'\n<spectrum id="scan={i} &lt;é&gt;" note="a > b"><scanList><scan><cvParam name="scan start time" value="{i}"/></scan></scanList>{array}</spectrum>' if i % 50 else f'\n<spectrum id="scan={i} &lt;é&gt;"/>'
        offsets.append(len("".join(parts).encode(encoding)) + 1)
        parts.append(body)
    parts.append("</spectrumList></run></mzML>")
    if index:
        at = len("".join(parts).encode(encoding))
        parts.append('<indexList><index name="spectrum">' + "".join(f'<offset idRef="scan={i}">{o}</offset>' for i, o in enumerate(offsets)) + f"</index></indexList><indexListOffset>{at}</indexListOffset>")
    return ("".join(parts) + "</indexedmzML>").encode(encoding)


@pytest.mark.parametrize(("index", "encoding"), [(True, "utf-8"), (False, "utf-8"), (True, "iso-8859-1")])
def test_mzml_in_splits(spark, tmp_path, index, encoding):
    raw = mzml(1000, index, encoding)
    (tmp_path / "a.mzML").write_bytes(raw)
    (tmp_path / "b.mzML.gz").write_bytes(gzip.compress(raw))
    spark.dataSource.register(spectra.MzmlSource)
    read = lambda name, size: spark.read.format("mzml").option("splitBytes", size).load(f"{tmp_path}/{name}")
    whole = read("b.mzML.gz", 1000)
    want = [tuple(r) for r in whole.collect()]
    assert len(want) == 1000 and want[7][0] == "scan=7 <é>" and whole.rdd.getNumPartitions() == 1
    for size in (len(raw) // 7, 60_000, 5_000):
        got = read("a.mzML", size)
        assert got.rdd.getNumPartitions() == -(-len(raw) // size) and [tuple(r) for r in got.collect()] == want
        tasks = got.groupBy(F.spark_partition_id()).count().count()
        assert tasks > 5
    steps, spectra.STEP_BYTES = spectra.STEP_BYTES, 37  # tags and ends that are cut anywhere
    try:
        with open(f"{tmp_path}/a.mzML", "rb") as f:
            cuts = sorted(random.Random(3).sample(range(len(raw)), 60))
            texts = [t for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True) for t in spectra.spectrum_texts(f, a, b)]
    finally:
        spectra.STEP_BYTES = steps
    assert len(texts) == 1000 and b"".join(texts) == b"".join(re.findall(rb"<spectrum [^>]*/>|<spectrum .*?</spectrum>", raw, re.S))


def test_mzml_with_prefixes_is_read_whole(spark, tmp_path):
    (tmp_path / "p.mzML").write_text('<m:mzML xmlns:m="urn:x"><m:run><m:spectrum id="scan=1"/><m:spectrum id="scan=2"/></m:run></m:mzML>')
    (tmp_path / "none.mzML").write_text("<mzML><run/></mzML>")
    spark.dataSource.register(spectra.MzmlSource)
    assert [r.identifier for r in spark.read.format("mzml").option("splitBytes", 20).load(f"{tmp_path}/p.mzML").collect()] == ["scan=1", "scan=2"]
    assert spark.read.format("mzml").option("splitBytes", 5).load(f"{tmp_path}/none.mzML").count() == 0


def test_dropped_lines_are_counted_on_the_way(spark, tmp_path):
    lines = "".join(f"BEGIN IONS\nTITLE=scan={i}\n{'bad\n' * (i % 3)}{'1 2\n' * (i % 4)}END IONS\n" for i in range(60))
    (tmp_path / "a.mgf").write_text(lines)
    dropped = Observation()
    rows = spectra.read_mgf(spark, f"{tmp_path}/a.mgf", dropped).collect()
    assert len(rows) == 45 and dropped.get == {"lines": 60, "blocks": 15}


def scans(spark, name):
    """Executed plans that scan a file, but for a look at its first line."""
    store = spark._jsparkSession.sharedState().statusStore()
    plans = [store.executionsList().apply(i) for i in range(store.executionsList().size())]
    texts = [p.physicalPlanDescription().split("== Initial Plan ==")[0] for p in plans]
    return sum(name in t and "CollectLimit" not in t for t in texts)


def test_a_build_parses_its_inputs_once(spark, tmp_path):
    predictor, times = build_inputs(spark, tmp_path)
    names = f"{tmp_path}/r.mgf", f"{tmp_path}/r.pin.gz"
    config = BuildConfig(names[1], names[0], f"{tmp_path}/out", "r")
    result = build.build_pin(spark, config, local=LocalOnly(predictor), times=times)
    assert [scans(spark, name) for name in names] == [1, 1]
    assert (result.metadata["dropped_lines"], result.metadata["dropped_blocks"]) == (0, 0) and result.row_count == 5


def test_pin_text_with_numbers_of_several_splits(spark, tmp_path):
    lines = ["SpecId\tLabel\tScanNr\tXcorr\tCharge1\tPeptide\tProteins"] + [f"s{i}\t1\t{i}\t{i if i < 900 else i + 0.5}\t1\t{i}\tp\tq{i}" for i in range(1000)]
    (tmp_path / "a.pin").write_text("\n".join(lines))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        df = tables.read_matches(spark, f"{tmp_path}/a.pin")
        assert df.rdd.getNumPartitions() > 4
        got = sorted(map(tuple, df.select("__row_id", "SpecId", "ScanNr", "Xcorr", "Peptide", "Proteins").collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert got == [(i, f"s{i}", i, float(i if i < 900 else i + 0.5), str(i), f"p\tq{i}") for i in range(1000)]


def test_appended_rows_are_counted_while_written(spark, tmp_path):
    held = cache.Cache(spark, f"{tmp_path}/c", "k", "k long")
    for n in (5, 0, 7):
        held.append(spark.range(n).withColumnRenamed("id", "k").repartition(3))
        assert held.added == n
    held.COMPACT = 1
    held.append(spark.range(3).withColumnRenamed("id", "k"))
    assert held.added == 3


def test_changed_contents_are_scored_anew(spark, tmp_path):
    predictor, times = build_inputs(spark, tmp_path)
    config = BuildConfig(f"{tmp_path}/r.pin.gz", f"{tmp_path}/r.mgf", f"{tmp_path}/out", "r", fingerprint_caches=True)
    run = lambda plug=predictor: build.build_pin(spark, config, local=TableFragments(plug.table, getattr(plug, "mark", "")), times=times)
    assert (run().spectral_misses, run().spectral_misses) == (4, 0)
    text = (tmp_path / "r.mgf").read_text()
    (tmp_path / "r.mgf").write_text(text.replace("100 50", "100 55"))  # as long as before
    os.utime(tmp_path / "r.mgf", (time.time() + 5, time.time() + 5))
    changed = run()
    assert (changed.spectral_misses, changed.rt_misses, changed.local_predictions) == (4, 4, 2)
    predictor.mark = "version 2"
    assert run().spectral_misses == 4
    plain = BuildConfig(config.match_table, config.spectra, f"{tmp_path}/other", "r")
    assert plain.fingerprint("x") is None and config.fingerprint("x", 1) != config.fingerprint("x", 2) and mark(None) == ""


def test_progress_is_told_inside_a_step(spark, capsys, monkeypatch):
    monkeypatch.setattr(progress, "EVERY", 0.05)
    slow = F.udf(lambda x: time.sleep(0.15) or x, "long")
    with progress.progressing(spark, "counting"):
        spark.range(0, 80, 1, 80).select(slow("id")).write.format("noop").mode("overwrite").save()
    spark.range(10).count()
    said = re.findall(r"counting: (\d+)% of (\d+) tasks", capsys.readouterr().err)
    shares = [int(s) for s, _ in said]
    assert len(shares) >= 4 and shares == sorted(set(shares)) and all(s % 10 == 0 for s in shares) and {n for _, n in said} == {"80"}
