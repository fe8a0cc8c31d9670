"""Output: PIN text in row order, manifest and JSON reports."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.functions.text import format_10g
from spectrail.schemas import ROW_ID


def insert_before(columns: list[str], added: list[str], before: str = "Peptide") -> list[str]:
    at = columns.index(before)
    return [*columns[:at], *added, *columns[at:]]


def as_text(df: DataFrame) -> DataFrame:
    """Every column as PIN text: null and NaN empty, whole numbers plain, reals as ``%.10g``."""
    def one(name: str, kind: str):
        c = F.col(f"`{name}`")
        return (format_10g(c.cast("double")) if kind in ("double", "float") else F.coalesce(c.cast("string"), F.lit(""))).alias(name)

    return df.select(ROW_ID, *(one(c, k) for c, k in df.dtypes if c != ROW_ID))


def write_pin(df: DataFrame, path: str, single: bool = True) -> str:
    """Gzipped text with a header, rows in their order: one file, or a folder of members.

    Rows are sorted by ranges on the executors and compressed there, each range as a gzip member of
    its own, the header in the first. Members one after another are one gzip file: the last step only moves bytes, through the
    driver's JVM unless the file system can join files by itself. For output too large for that, ``single=False``
    leaves the folder, whose files in name order are the same text.
    """
    spark, columns = df.sparkSession, [c for c in df.columns if c != ROW_ID]
    header = spark.range(1).select(F.lit(-1).cast("long").alias(ROW_ID), F.lit("\t".join(columns)).alias("value"))
    line = as_text(df).select(F.col(ROW_ID).cast("long").alias(ROW_ID), F.concat_ws("\t", *(F.col(f"`{c}`") for c in columns)).alias("value"))
    line = header.unionByName(line).orderBy(ROW_ID).select("value")
    folder = f"{path}.parts" if single else path
    line.write.mode("overwrite").text(folder, compression="gzip")
    return joined_files(spark, folder, path) if single else path


def joined_files(spark: SparkSession, folder: str, path: str) -> str:
    """Files of the folder, in name order, as one; it takes its name when it is complete."""
    fs, hadoop = _hadoop(spark, path)
    target, temporary = hadoop.Path(path), hadoop.Path(f"{path}.tmp")
    names = sorted((s.getPath() for s in fs.listStatus(hadoop.Path(folder)) if s.getPath().getName().startswith("part-")), key=str)
    out = fs.create(temporary, True)
    for name in names:
        stream = fs.open(name)
        spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
        stream.close()
    out.close()
    fs.delete(hadoop.Path(folder), True)
    _replace(spark, temporary, target)
    return path


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _replace(spark: SparkSession, temporary, target) -> None:
    """The file under its own name in one step, over an older one."""
    sc = spark.sparkContext
    hadoop, conf = sc._jvm.org.apache.hadoop.fs, sc._jsc.hadoopConfiguration()
    kind = getattr(hadoop, "Options$Rename")
    over = sc._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    uri = target.getFileSystem(conf).getUri()
    hadoop.FileContext.getFileContext(uri, conf).rename(temporary, target, over)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _hadoop(spark, path)
    fs.delete(hadoop.Path(path), True)


def file_facts(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes and time of change (ms) of a file, or of all files of a folder."""
    fs, hadoop = _hadoop(spark, path)
    found = fs.getContentSummary(hadoop.Path(path))
    return {"bytes": found.getLength(), "files": found.getFileCount(), "changed_ms": fs.getFileStatus(hadoop.Path(path)).getModificationTime()}


def read_json(spark: SparkSession, path: str, default: Any) -> Any:
    """A small JSON file wherever Spark reads from."""
    fs, hadoop = _hadoop(spark, path)
    if not fs.exists(hadoop.Path(path)):
        return default
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def write_json(spark: SparkSession, value: Any, path: str) -> None:
    """Sorted keys; written beside the file, which then takes its place."""
    fs, hadoop = _hadoop(spark, path)
    target, temporary = hadoop.Path(path), hadoop.Path(f"{path}.tmp")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(value, indent=2, sort_keys=True).encode()))
    out.close()
    _replace(spark, temporary, target)


def write_json_list(df: DataFrame, path: str, order: str) -> str:
    """One JSON list of the rows in order; nulls are written. Rows are sorted and formatted on the executors."""
    spark = df.sparkSession
    fields = F.to_json(F.struct(*(c for c in df.columns)), {"ignoreNullFields": "false"})
    rows = df.select(F.col(order).cast("long").alias("__at"), fields.alias("value"))
    first = rows.agg(F.min("__at")).first()[0]
    rows = rows.withColumn("value", F.concat(F.lit("  "), F.when(F.col("__at") == F.lit(first), "").otherwise(", "), "value"))
    ends = spark.createDataFrame([(-(2**62), "["), (2**62, "]")], "__at long, value string")
    ends.unionByName(rows).orderBy("__at").select("value").write.mode("overwrite").text(f"{path}.parts")
    return joined_files(spark, f"{path}.parts", path)
