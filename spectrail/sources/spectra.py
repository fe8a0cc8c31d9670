"""Observed spectra from Parquet, MGF and mzML."""

from __future__ import annotations

import base64
import gzip
import re
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import numpy as np
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from spectrail.functions.text import normal_id, scan_from_mgf
from spectrail.sources.tables import bare_name, in_order


def sorted_peaks(mz: Column, intensity: Column) -> Column:
    """array<struct(mz, peak_index, intensity)> of 32-bit floats by m/z, then place."""
    zipped = F.arrays_zip(F.coalesce(mz, F.array().cast("array<float>")).alias("m"), F.coalesce(intensity, F.array().cast("array<float>")).alias("i"))
    return F.array_sort(F.transform(zipped, lambda z, k: F.struct(z["m"].cast("float").alias("mz"), k.alias("peak_index"), z["i"].cast("float").alias("intensity"))))


def _pack(df: DataFrame, *more: str) -> DataFrame:
    peaks = sorted_peaks(F.col("mz_array"), F.col("intensity_array"))
    return df.select(*more, peaks.alias("peaks"))


def read_spectra(spark: SparkSession, path: str, dropped: Observation | None = None, check: bool = True) -> DataFrame:
    """scan_number, rt_seconds, peaks, by the file's ending; a scan that comes twice fails the query, unless the caller checks later."""
    name = bare_name(path)
    if name.endswith(".parquet"):
        df = _pack(spark.read.parquet(path).select("scan_number", F.coalesce("rt_seconds", F.lit(0.0)).alias("rt_seconds"), "mz_array", "intensity_array"), "scan_number", "rt_seconds")
    elif name.endswith(".mgf"):
        scans = read_mgf(spark, path, dropped)
        df = _pack(scans.select(scan_from_mgf(F.col("scans"), F.col("identifier")).alias("scan_number"), F.coalesce("retention_time", F.lit(0.0)).alias("rt_seconds"), "mz_array", "intensity_array"), "scan_number", "rt_seconds")
    else:
        raise ValueError(f"spectra of {path}: neither .parquet nor .mgf")
    df = df.withColumn("scan_number", F.col("scan_number").cast("long"))
    return unique_scans(df) if check else df


def unique_scans(df: DataFrame) -> DataFrame:
    """``df``, or an error if a scan comes twice: scan numbers alone are counted, peaks stay where they are."""
    twice = df.groupBy("scan_number").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"scan comes twice: {twice[0]['scan_number']}")
    return df


def peaks_long(spectra: DataFrame, key: str = "scan_number") -> DataFrame:
    return spectra.select(key, F.inline("peaks"))


def read_mgf(spark: SparkSession, path: str, dropped: Observation | None = None) -> DataFrame:
    """identifier, scans, precursor_mz, precursor_charge, retention_time, mz_array, intensity_array; file order (file, split, place) in ``__order``.

    Text is split at END IONS, so a plain file is read in parallel. Of a block counts what follows its last
    BEGIN IONS; a last block without END IONS counts too. Peak lines need two numbers, others are dropped; so are blocks without a header or peak line.
    ``dropped`` observes how many ``lines`` and ``blocks`` are dropped, while the first action on the result runs: one that passes over it once, not
    a global sort, which samples it first.
    """
    return mgf_spectra(in_order(spark.read.text(path, lineSep="END IONS")), dropped)


def mgf_spectra(blocks: DataFrame, dropped: Observation | None = None) -> DataFrame:
    """Spectra of MGF blocks (value, __order)."""
    body = F.regexp_extract(F.regexp_replace("value", "\r", ""), r"(?is)^(?:.*\n)?\s*BEGIN IONS[ \t]*\n(.*)$", 1)
    lines = F.filter(F.transform(F.split(body, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    df = blocks.select("__order", (F.trim(F.regexp_replace("value", r"\s", "")) == "").alias("blank"), lines.alias("lines"))
    headers = F.filter("lines", lambda x: x.contains("="))
    pairs = F.transform(F.filter("lines", lambda x: ~x.contains("=")), lambda x: F.split(x, r"\s+"))
    number = lambda p, i: F.get(p, F.lit(i)).try_cast("double")
    peaks = F.filter(pairs, lambda p: number(p, 0).isNotNull() & number(p, 1).isNotNull())
    df = df.withColumns({"headers": headers, "pairs": pairs}).withColumn("peaks", peaks)
    if dropped is not None:
        bad = F.coalesce(F.sum(F.size("pairs") - F.size("peaks")), F.lit(0)).alias("lines")
        df = df.observe(dropped, bad, F.count_if((F.size("peaks") == 0) & ~F.col("blank")).alias("blocks"))
    value = lambda key: F.try_element_at(F.filter("headers", lambda x: F.upper(F.trim(F.split_part(x, F.lit("="), F.lit(1)))) == key), F.lit(-1))
    text = lambda key: F.trim(F.regexp_extract(value(key), r"^[^=]*=(.*)$", 1))
    df = df.where(F.size("peaks") > 0)
    return df.select(
        "__order", F.coalesce(text("TITLE"), F.lit("")).alias("identifier"), text("SCANS").alias("scans"),
        F.coalesce(F.get(F.split(text("PEPMASS"), r"\s+"), F.lit(0)).try_cast("double"), F.lit(0.0)).alias("precursor_mz"),
        F.coalesce(F.regexp_extract(text("CHARGE"), r"^([0-9]+)", 1).try_cast("int"), F.lit(0)).alias("precursor_charge"),
        text("RTINSECONDS").try_cast("double").alias("retention_time"),
        F.transform("peaks", lambda p: number(p, 0).cast("float")).alias("mz_array"), F.transform("peaks", lambda p: number(p, 1).cast("float")).alias("intensity_array"),
    )


OBSERVED = "identifier string, precursor_mz double, precursor_charge int, retention_time double, mz_array array<float>, intensity_array array<float>"


#: Bytes of an mzML file that one task reads; spectra are some ten KB each.
SPLIT_BYTES = 64 << 20
#: Bytes that are read at once, and of a file's head that are looked at for its encoding.
STEP_BYTES, HEAD_BYTES = 1 << 20, 4096
_START, _END = re.compile(rb"<spectrum[\s/>]"), b"</spectrum>"
_TAG = re.compile(rb"<spectrum(?:[^<>\"\']|\"[^\"]*\"|\'[^\']*\')*?(/?)>")


class MzmlSource(DataSource):
    """``mzml``: spectra of mzML files in splits of ``splitBytes``, and of mzML.gz files whole, streamed."""

    @classmethod
    def name(cls) -> str:
        return "mzml"

    def schema(self) -> str:
        return OBSERVED

    def reader(self, schema) -> MzmlReader:
        return MzmlReader(self.options)


class Split(InputPartition):
    """Bytes of a file: the spectra that begin in them. No end: the file is read as one document."""

    def __init__(self, path: str, start: int, end: int | None, encoding: str = "utf-8"):
        self.path, self.start, self.end, self.encoding = path, start, end, encoding


class MzmlReader(DataSourceReader):
    """A plain file is cut into ranges of bytes, whatever index it has or lacks; a task looks for the first spectrum that begins in its own.

    Compressed files, and files whose elements have a namespace prefix or whose encoding isn't a superset of ASCII, are read whole.
    """

    def __init__(self, options: dict[str, str]):
        self.paths, self.size = options["path"].split(","), int(options.get("splitBytes", SPLIT_BYTES))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            fs, inner = _file_system(path)
            with fs.open_input_file(inner) as f:
                head, size = f.read(HEAD_BYTES), f.size()
            found = re.search(rb"encoding=[\"\']([A-Za-z0-9._-]+)", head.split(b"?>")[0])
            encoding = found[1].decode().lower() if found else "utf-8"
            plain = not inner.endswith(".gz") and re.search(rb"<(?:indexedmzML|mzML)[\s>]", head) and encoding in ("utf-8", "us-ascii", "iso-8859-1")
            out += [Split(path, a, min(a + self.size, size), encoding) for a in range(0, size, self.size)] if plain else [Split(path, 0, None)]
        return out

    def read(self, partition: Split) -> Iterator[tuple]:
        fs, inner = _file_system(partition.path)
        if partition.end is None:
            with fs.open_input_stream(inner, compression=None) as raw:
                yield from mzml_spectra(gzip.open(raw) if inner.endswith(".gz") else raw)
            return
        head = f'<?xml version="1.0" encoding="{partition.encoding}"?>'.encode()
        with fs.open_input_file(inner) as f:
            for text in spectrum_texts(f, partition.start, partition.end):
                yield _spectrum(ElementTree.fromstring(head + text))


def _file_system(path: str):
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def spectrum_texts(file, start: int, end: int) -> Iterator[bytes]:
    """Elements ``spectrum`` that begin at bytes start to end of a file, each to its end, wherever that is."""
    file.seek(start)
    held, base = b"", start  # what has been read from ``base`` on

    def more() -> bool:
        nonlocal held
        got = file.read(STEP_BYTES)
        held += got
        return bool(got)

    while True:
        found = _START.search(held)
        if found is None:
            keep = max(0, len(held) - len(b"<spectrum"))  # a tag may go on in what comes
            held, base = held[keep:], base + keep
            if base >= end or not more():
                return
            continue
        if base + found.start() >= end:
            return
        held, base = held[found.start() :], base + found.start()
        while not (tag := _TAG.match(held)):
            if not more():
                return
        close, searched = tag.end(), tag.end()
        if not tag[1]:
            while (close := held.find(_END, searched)) < 0:
                searched = max(tag.end(), len(held) - len(_END))
                if not more():
                    return
            close += len(_END)
        yield held[:close]
        held, base = held[close:], base + close


def mzml_spectra(stream) -> Iterator[tuple]:
    for _, node in ElementTree.iterparse(stream):
        if node.tag.rpartition("}")[2] == "spectrum":
            yield _spectrum(node)
            node.clear()


def _params(node) -> dict[str, str]:
    return {x.get("name"): x.get("value") for x in node if x.tag.rpartition("}")[2] == "cvParam"}


def _all(node, name: str) -> list:
    return [x for x in node.iter() if x.tag.rpartition("}")[2] == name]


def _spectrum(node) -> tuple:
    arrays = {"m/z array": [], "intensity array": []}
    for binary in _all(node, "binaryDataArray"):
        named = _params(binary)
        kind = next((k for k in arrays if k in named), None)
        text = next((x.text or "" for x in binary if x.tag.rpartition("}")[2] == "binary"), "")
        if kind:
            data = base64.b64decode(text)
            data = zlib.decompress(data) if "zlib compression" in named and data else data
            arrays[kind] = np.frombuffer(data, "<f8" if "64-bit float" in named else "<f4").astype(np.float32).tolist()
    ions, scans = _all(node, "selectedIon"), _all(node, "scan")
    ion, scan = _params(ions[0]) if ions else {}, _params(scans[0]) if scans else {}
    start = scan.get("scan start time")
    return (node.get("id", ""), float(ion.get("selected ion m/z") or 0.0), int(ion.get("charge state") or 0), None if start is None else float(start), arrays["m/z array"], arrays["intensity array"])


def read_observed(spark: SparkSession, path: str, id_pattern: str | None = None, dropped: Observation | None = None) -> DataFrame:
    """Spectra by normalised identifier, from MGF or mzML; of equal identifiers the last in the file stays."""
    name = bare_name(path).lower()
    if name.endswith(".mgf"):
        df = read_mgf(spark, path, dropped)
    elif name.endswith(".mzml"):
        spark.dataSource.register(MzmlSource)
        # splits of a file are partitions in its order, files in the order of the list
        df = spark.read.format("mzml").load(path).withColumn("__order", F.monotonically_increasing_id())
    else:
        raise ValueError(f"spectra of {path}: neither .mgf nor .mzML")
    df = df.withColumn("identifier", normal_id(F.col("identifier"), id_pattern))
    return _pack(last_of_each(df, "identifier"), "identifier", "precursor_mz", "precursor_charge", "retention_time")


def last_of_each(df: DataFrame, key: str, order: str = "__order") -> DataFrame:
    """The last row of each key."""
    last = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))
    return df.withColumn("__n", last).where("__n = 1").drop("__n")
