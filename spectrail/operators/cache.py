"""Keyed caches: what is missing, merging with keep-last, and publishing without touching what is read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F


def missing(rows: DataFrame, cache: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key the cache lacks."""
    return rows.join(cache.select(*keys), list(keys), "left_anti")


def merge_keep_last(cache: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Both, and one row a key: a new one over an old one; of several of one side always the same, by a hash of the row."""
    both = cache.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    whole = F.xxhash64(*(F.col(c) for c in sorted(both.columns)))
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__new"), whole))
    return both.withColumn("__n", last).where("__n = 1").drop("__n", "__new")


def distinct_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.dropDuplicates(list(keys))


def update_by_key(base: DataFrame, local: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``base`` with ``columns`` overwritten where ``local`` has the key."""
    own = local.select(key, F.lit(True).alias("__hit"), *(F.col(c).alias(f"__{c}") for c in columns))
    joined = base.join(own, key, "left")
    return joined.select(*(F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns))


class Cache:
    """A Parquet table under ``path``: a generation, and what was appended after it, each a numbered folder.

    ``append`` writes new rows alone, so a run costs what it adds; after ``COMPACT`` appends they and the
    generation become the next generation. Folders are never changed, so a plan that reads the cache may write it;
    compaction keeps the folders that it replaces until the next one, for plans that still read them. One
    writer at a time. Missing caches are empty. Rows are never dropped by a parameter change unless a
    ``fingerprint`` is set: then rows of another fingerprint count as missing.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, path: str, key: str, schema: str, fingerprint: str | None = None):
        self.spark, self.path, self.key, self.schema, self.fingerprint = spark, path.rstrip("/"), key, schema, fingerprint
        #: Rows of the last ``append`` or ``write``, counted while they were written.
        self.added = 0

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder, jvm

    def _folders(self) -> list[tuple[int, str, str]]:
        """(number, kind, name) of all complete folders."""
        fs, folder, jvm = self._fs()
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted((int(n[3:11]), n[:3], n) for n in names if n[:3] in ("gen", "add"))

    def _current(self, folders: list[tuple[int, str, str]]) -> list[str]:
        last = max((number for number, kind, _ in folders if kind == "gen"), default=-1)
        return [name for number, kind, name in folders if number == last and kind == "gen" or number > last]

    def read(self) -> DataFrame:
        names = self._current(self._folders())
        if not names:
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.parquet(*(f"{self.path}/{n}" for n in names))
        if self.fingerprint is not None:
            df = df.where(F.col("fingerprint") == self.fingerprint) if "fingerprint" in df.columns else df.limit(0)
        return df.drop("fingerprint")

    def _put(self, df: DataFrame, kind: str, number: int) -> str:
        name, counted = f"{kind}{number:08d}-{uuid.uuid4().hex}", Observation()
        df.observe(counted, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{name}")
        self.added = counted.get["n"]
        return name

    def _next(self, folders: list[tuple[int, str, str]]) -> int:
        return folders[-1][0] + 1 if folders else 0

    def _delete(self, names: list[str]) -> None:
        fs, _, jvm = self._fs()
        for name in names:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def _marked(self, df: DataFrame) -> DataFrame:
        return df if self.fingerprint is None else df.withColumn("fingerprint", F.lit(self.fingerprint))

    def append(self, df: DataFrame) -> DataFrame:
        """Adds rows whose keys the cache lacks, each once; writes nothing if there are none."""
        name = self._put(self._marked(df), "add", self._next(self._folders()))
        if not self.added:
            self._delete([name])
        folders = self._folders()
        if sum(n[:3] == "add" for n in self._current(folders)) >= self.COMPACT:
            added = self.added
            self.compact()
            self.added = added
        return self.read()

    def write(self, df: DataFrame) -> DataFrame:
        """Replaces the whole cache by a new generation."""
        self._put(self._marked(df), "gen", self._next(self._folders()))
        return self.read()

    def compact(self) -> None:
        """One generation of all that is held; what the one before had replaced is deleted."""
        folders = self._folders()
        current = self._current(folders)
        self._put(self.spark.read.parquet(*(f"{self.path}/{n}" for n in current)).repartition(self.key), "gen", self._next(folders))
        self._delete([name for _, _, name in folders if name not in current])
