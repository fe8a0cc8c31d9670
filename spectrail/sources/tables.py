"""Match tables: Parquet or PIN text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.schemas import REQUIRED, ROW_ID, require


Keep = Callable[[DataFrame], DataFrame]

# The endings of match tables and of spectra, in the order in which files are looked for.
MATCH_ENDINGS = (".pin.parquet", ".pin.tsv.gz", ".pin.tsv", ".pin.gz", ".pin", ".tsv.gz", ".tsv")
SPECTRUM_ENDINGS = (".mgf.parquet", ".mgf.gz", ".mgf")


def bare_name(path: str) -> str:
    """File name without ``.gz``."""
    return path.rstrip("/").rpartition("/")[2].removesuffix(".gz")


def read_matches(spark: SparkSession, path: str, limit: int | None = None, keep: Keep | None = None) -> DataFrame:
    """A match table with ``__row_id``, its rows' order; ``limit`` keeps the first rows of that order.

    Parquet is split over files and row groups; a row's number is its file's place in name order and
    its index there. Text is tab-separated with a header; more fields than columns
    stay in the last one (``Proteins``), so ragged lines lose nothing. Text columns stay text, whatever
    they spell; the others are numbers where every value is one. Kinds and numbers need a look at all lines before: ``keep``
    writes a frame and reads it back, so that the text itself is parsed once.
    """
    df = _parquet(spark, path) if bare_name(path).endswith(".parquet") else _text(spark, path, keep)
    require(df, REQUIRED, f"the match table {path}")
    return first_rows(df, limit)


def first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """Rows whose number is under the limit, all without one: the same ones in any plan."""
    return df if limit is None else df.where(F.col(ROW_ID) < limit)


def _parquet(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    df = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    sizes = df.groupBy("__file").agg((F.max("__index") + 1).alias("n")).orderBy("__file").collect()  # one row a file
    if len(sizes) < 2:
        return df.withColumn(ROW_ID, F.col("__index")).drop("__file", "__index")
    before, start = 0, []
    for r in sizes:
        start.append((r["__file"], before))
        before += r["n"]
    starts = F.broadcast(spark.createDataFrame(start, "__file string, __before long"))
    return df.join(starts, "__file").withColumn(ROW_ID, F.col("__before") + F.col("__index")).drop("__file", "__index", "__before")


#: Columns of a PIN text that are never read as numbers.
TEXT_COLUMNS = ("SpecId", "Peptide", "Proteins", "spectrum_id", "peptidoform")


def _text(spark: SparkSession, path: str, keep: Keep | None = None) -> DataFrame:
    lines = spark.read.text(path)
    header = lines.first()
    names = header[0].rstrip("\r\n").split("\t") if header else []
    if not names:
        raise ValueError(f"{path} is empty")
    rows = fields(in_order(lines, header[0]), names)
    rows = keep(rows) if keep else rows
    # one pass over the text for the splits' sizes and the columns' kinds: a row a split
    split = [F.col("__order.__file").alias("f"), F.col("__order.__block").alias("b")]
    splits = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("n"), F.min("__order.__line").alias("first"), *_numeric(names)).orderBy("f", "b").collect()
    kinds = _kinds(names, splits)
    starts, before = [], 0
    for r in splits:
        starts.append((r["f"], r["b"], before, r["first"]))
        before += r["n"]
    small = F.broadcast(spark.createDataFrame(starts, "f string, b long, before long, first long"))
    rows = rows.join(small, (F.col("__order.__file") == F.col("f")) & (F.col("__order.__block") == F.col("b")))
    return rows.select(*_typed(names, kinds), (F.col("before") + F.col("__order.__line") - F.col("first")).alias(ROW_ID))


def fields(rows: DataFrame, names: list[str]) -> DataFrame:
    """Lines (value, __order) by column, as text: tabs beyond the last name stay in its column."""
    parts = F.split(F.regexp_replace("value", "\r$", ""), "\t", len(names))
    return rows.select("__order", *(F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(names)))


def _numeric(names: list[str]) -> list[Column]:
    """Whether every value of a column is a whole number (``l``) or a number (``d``), or empty."""
    numbers = [c for c in names if c not in TEXT_COLUMNS]
    return [F.bool_and((F.col(f"`{c}`") == "") | F.col(f"`{c}`").try_cast(kind).isNotNull()).alias(f"{kind[0]}{i}") for kind in ("long", "double") for i, c in enumerate(numbers)]


def _kinds(names: list[str], found: list) -> dict[str, str]:
    numbers = [c for c in names if c not in TEXT_COLUMNS]
    every = lambda key: all(r[key] is not False for r in found)
    return {c: "long" if every(f"l{i}") else "double" if every(f"d{i}") else "string" for i, c in enumerate(numbers)}


def _typed(names: list[str], kinds: dict[str, str]) -> list[Column]:
    return [F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if kinds.get(c, "string") != "string" else F.col(f"`{c}`") for c in names]


def text_rows(rows: DataFrame, names: list[str]) -> DataFrame:
    """Lines (value, __order) as typed columns: a column is numbers where every value is one."""
    rows = fields(rows, names)
    return rows.select("__order", *_typed(names, _kinds(names, rows.agg(F.lit(1), *_numeric(names)).collect())))


def in_order(lines: DataFrame, header: str | None = None) -> DataFrame:
    """Lines of text files without the header's, with ``__order``: file, split of it, and a number that grows along the split, whatever task reads it."""
    rows = lines.select("value", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
    rows = rows if header is None else rows.where(F.col("value") != header)
    return rows.withColumn("__order", F.struct("__file", "__block", F.monotonically_increasing_id().alias("__line"))).drop("__file", "__block")


def read_psms(spark: SparkSession, path: str) -> DataFrame:
    """Rows (spectrum_id, peptidoform) of Parquet or tab-separated text with a header, numbered in file order."""
    df = _parquet(spark, path) if bare_name(path).endswith(".parquet") else _text(spark, path)
    return require(df, ("spectrum_id", "peptidoform"), f"the table {path}")

