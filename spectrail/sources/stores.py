"""Prediction stores: Parquet folders, bucketed or not, and databases that are asked for a run's keys alone."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.operators.lookup import KEYS, Store, is_target
from spectrail.sources import sinks

STORE_TABLES = ("peptide", "variant", "prediction")


def parquet_store(spark: SparkSession, folder: str) -> Store:
    """Tables ``peptide``, ``variant``, ``prediction`` with is_target, and ``codes``, under a folder; bucketed if ``write_store`` made it."""
    folder = folder.rstrip("/")
    buckets = (sinks.read_json(spark, f"{folder}/store.json", None) or {}).get("buckets")
    read = (lambda t: spark.read.parquet(f"{folder}/{t}")) if buckets is None else (lambda t: _bucketed(spark, folder, t, buckets))
    facts = [sinks.file_facts(spark, f"{folder}/{t}") for t in (*STORE_TABLES, "codes")]
    return Store(*(read(t) for t in STORE_TABLES), spark.read.parquet(f"{folder}/codes"), buckets is not None, f"{folder} {facts}")


def _name(folder: str, table: str) -> str:
    return f"spectrail_{hashlib.md5(folder.encode()).hexdigest()[:12]}_{table}"


def _columns(table: str) -> str:
    return ", ".join(f"`{c}`" for c in KEYS[table])


def _bucketed(spark: SparkSession, folder: str, table: str, buckets: int) -> DataFrame:
    """The table under its name in the session's catalogue, which a new session doesn't know yet: the files say in which bucket they are."""
    name = _name(folder, table)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{folder}/{table}").schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({kinds}) USING parquet CLUSTERED BY ({_columns(table)}) SORTED BY ({_columns(table)}) INTO {buckets} BUCKETS LOCATION '{folder}/{table}'")
    return spark.table(name)


def write_store(store: Store, folder: str, buckets: int) -> Store:
    """The store as Parquet, each table bucketed and sorted by the columns that ``look_up`` joins it on, side first; what was written.

    One shuffle of each table, once: a lookup then sorts and shuffles its keys to the buckets and reads the store where it lies.
    Take a number of buckets that leaves some hundred MB of predictions in each; a file is a bucket.
    """
    folder, spark = folder.rstrip("/"), store.prediction.sparkSession
    for table in STORE_TABLES:
        keys = KEYS[table]
        df = getattr(store, table).repartition(buckets, *keys)
        spark.sql(f"DROP TABLE IF EXISTS {_name(folder, table)}")
        df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", f"{folder}/{table}").mode("overwrite").saveAsTable(_name(folder, table))
    store.codes.write.mode("overwrite").parquet(f"{folder}/codes")
    sinks.write_json(spark, {"buckets": buckets}, f"{folder}/store.json")
    return parquet_store(spark, folder)


@dataclass
class Database:
    """How a database is reached, and how many connections read from it or write to it at once."""

    spark: SparkSession
    url: str
    schema: str
    user: str
    password: str
    partitions: int = 16
    fetch: int = 2048
    #: Where the keys of a run are staged; None: the store's own schema.
    staging: str | None = None

    def _options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password}

    def read(self, query: str, parts: list[str] | None = None) -> DataFrame:
        """Rows of a table or of ``(SELECT ..) AS name``, a connection for each of the conditions ``parts``."""
        own = {"user": self.user, "password": self.password, "fetchsize": str(self.fetch)}
        return self.spark.read.jdbc(self.url, query, predicates=parts, properties=own) if parts else self.spark.read.jdbc(self.url, query, properties=own)

    def ranges(self, table: str, column: str) -> DataFrame:
        """A whole table, in ranges of a column."""
        name = f"{self.schema}.{table}"
        low, high = self.read(f"(SELECT min({column}) AS low, max({column}) AS high FROM {name}) AS ends").first()
        if low is None:
            return self.read(name)
        reader = self.spark.read.format("jdbc").options(**self._options(), fetchsize=str(self.fetch), dbtable=name)
        return reader.options(partitionColumn=column, lowerBound=str(low), upperBound=str(high + 1), numPartitions=str(self.partitions)).load()

    def put(self, df: DataFrame, table: str, kinds: str) -> None:
        """Rows as a new table, by batches of inserts from ``partitions`` tasks."""
        df.coalesce(self.partitions).write.format("jdbc").options(**self._options(), dbtable=table, batchsize="5000", createTableColumnTypes=kinds).mode("error").save()

    def run(self, *statements: str) -> None:
        """Statements that return nothing, over a connection of the driver; Spark has loaded the database's driver by then."""
        properties = self.spark.sparkContext._jvm.java.util.Properties()
        for name, value in (("user", self.user), ("password", self.password)):
            properties.setProperty(name, value)
        connection = self.spark.sparkContext._jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            for s in statements:
                connection.createStatement().executeUpdate(s)
        finally:
            connection.close()


@dataclass
class JdbcStore(Store):
    """A store in a database, with a table a side. Its frames read whole tables; ``for_keys`` reads what a run asks for."""

    database: Database | None = None

    def for_keys(self, queries: DataFrame) -> Store:
        """The store's rows that belong to queries (label, sequence, var_mod_sites_unimod, charge), found by joins in the database.

        The distinct keys are staged there once, a table a side, and each table of the store is joined with them: peptides by
        sequence, variants by peptide and sites, predictions by variant and charge. So the rows that come back follow the keys, not the
        store. Keys of one sequence share a part, the unit of reading: parts need nothing of each other and no row comes twice.
        Null sequences, sites or charges match nothing. ``close`` drops the staged tables, after the last use of the frames.
        """
        db = self.database
        keys = queries.select(is_target(F.col("label")).alias("is_target"), F.col("sequence"), F.col("var_mod_sites_unimod").alias("sites"), F.col("charge").cast("int").alias("charge"))
        keys = keys.where("sequence IS NOT NULL AND sites IS NOT NULL").distinct().withColumn("part", F.pmod(F.xxhash64("sequence"), F.lit(db.partitions)).cast("int"))
        name, found, tables = uuid.uuid4().hex[:12], {}, []
        for side in ("target", "decoy"):
            asked = f"{db.staging or db.schema}.asked_{side}_{name}"
            db.put(keys.where(F.col("is_target") == (side == "target")).drop("is_target"), asked, "sequence VARCHAR(8000), sites VARCHAR(8000)")
            tables.append(asked)
            for table, query in self._queries(side, asked).items():
                rows = db.read(query, [f'"part" = {k}' for k in range(db.partitions)]).drop("part").withColumn("is_target", F.lit(side == "target"))
                found[table] = found[table].unionByName(rows) if table in found else rows
        return Asked(*(found[t] for t in STORE_TABLES), self.codes, False, self.mark, db, tables)

    def _queries(self, side: str, asked: str) -> dict[str, str]:
        """A query a table, all with the staged ``part``. Names that Spark has created are quoted, the store's own aren't."""
        peptide, variant, prediction = (f"{self.database.schema}.{side}_{t}" for t in STORE_TABLES)
        by_sequence = f'{asked} a JOIN {peptide} p ON p.pep_seq = a."sequence"'
        by_sites = f'{by_sequence} JOIN {variant} v ON v.peptide_id = p.peptide_id AND v.var_mod_sites_unimod = a."sites"'
        wanted = {
            "peptide": f'SELECT DISTINCT p.peptide_id AS k, a."part" FROM {by_sequence}', "variant": f'SELECT DISTINCT v.variant_id AS k, a."part" FROM {by_sites}',
            "prediction": f'SELECT DISTINCT v.variant_id * 10 + a."charge" AS k, a."part" FROM {by_sites}',
        }
        held = {"peptide": (peptide, "peptide_id"), "variant": (variant, "variant_id"), "prediction": (prediction, "precursor_id")}
        return {t: f'(SELECT r.*, w."part" FROM ({q}) w JOIN {held[t][0]} r ON r.{held[t][1]} = w.k) AS asked' for t, q in wanted.items()}


@dataclass
class Asked(Store):
    """What a database holds for the keys of one run."""

    database: Database | None = None
    staged: list[str] | None = None

    def for_keys(self, queries: DataFrame) -> Store:
        return self

    def close(self) -> None:
        self.database.run(*(f"DROP TABLE {t}" for t in self.staged or []))
        self.staged = None


def jdbc_store(spark: SparkSession, url: str, schema: str, user: str, password_file: str, partitions: int = 16, fetch: int = 2048, staging: str | None = None) -> JdbcStore:
    """A database's store with a table a side (``target_peptide``, ``decoy_peptide`` and so on).

    Whole tables are read in ``partitions`` ranges of their id. The driver's jar must be on Spark's class path; ``staging`` names a
    schema that the user may create tables in, if that isn't the store's.
    """
    with open(password_file) as f:
        db = Database(spark, url, schema, user, f.read().strip(), partitions, fetch, staging)

    def sides(table: str, column: str) -> DataFrame:
        target, decoy = (db.ranges(f"{side}_{table}", column).withColumn("is_target", F.lit(side == "target")) for side in ("target", "decoy"))
        return target.unionByName(decoy)

    return JdbcStore(sides("peptide", "peptide_id"), sides("variant", "variant_id"), sides("prediction", "precursor_id"), db.read(f"{schema}.fragment_peak_codes"), False, f"{url} {schema}", db)

