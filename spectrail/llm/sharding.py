"""Operator 1: proportional stratified interleaving into shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spectrail.llm._shared import free_prefix, table, written

#: Buckets that a stratum's ranks, and the global order, are counted in: at least, and rows for each.
BUCKETS, BUCKET_ROWS = 4096, 20_000
#: Rows of a file of a written shard.
FILE_ROWS = 500_000
SEED = "interleave-1"


def assign_shards(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "source", seed: str = SEED, row_col: str | None = None) -> DataFrame:
    """Shard and slot of every row, by proportional stratified interleaving.

    Rows of a stratum are ordered by a seeded hash of their id and text; a row's fractional rank
    is (rank - 0.5) / size of its stratum. All rows in order of fractional rank are cut
    into ``n_shards`` runs whose lengths differ by one at most. So every shard holds each
    stratum in proportion, off by one row at most.

    Both rankings are counted in hash buckets (a count per bucket, a running total over
    the few buckets, then ``row_number`` inside one), so no stratum and no global order
    ever meets in one task; the buckets grow in number with the rows. Only narrow columns are shuffled; texts never are.

    Null ids, texts and strata are ordinary values (a null stratum is one stratum; a
    null or empty text has size 1 and checksum 0). Repeated rows each get a slot of
    their own. Ties of the hash go by id, size, then checksum (then ``row_col``, if there is one). An empty table gives no
    rows. Other columns are ignored. Columns: id, size, text_crc32, stratum, fraction, shard, slot (and row_col).
    """
    buckets = max(BUCKETS, 1 << (df.count() // BUCKET_ROWS).bit_length())
    own = ["__row"] if row_col else []
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("__id"),
        F.col(stratum_col).alias("__stratum"),
        (F.octet_length(text).cast("long") + 1).alias("__size"),
        F.crc32(text.cast("binary")).alias("__crc"),
        *([F.col(row_col).alias("__row")] if row_col else []),
    )
    named = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("__id").cast("string"), F.lit("null")), "__size", "__crc")
    rows = rows.withColumn("__hash", F.md5(named.cast("binary")))
    # the leading bits of the hash: buckets are in its order
    rows = rows.withColumn("__bucket", (F.conv(F.substring("__hash", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)).cast("int"))
    ranked = _bucket_rank(rows, ["__stratum"], "__bucket", ["__hash", "__id", "__size", "__crc", *own], "__rank", "__total")
    ranked = ranked.withColumn("__fraction", (F.col("__rank") - F.lit(0.5)) / F.col("__total"))
    ranked = ranked.withColumn("__cell", F.floor(F.col("__fraction") * buckets).cast("int"))
    placed = _bucket_rank(ranked, [], "__cell", ["__fraction", "__stratum", "__hash", "__id", "__size", "__crc", *own], "__place", "__all")
    place = F.col("__place") - 1
    placed = placed.withColumn("__shard", F.expr(f"(__place - 1) * {n_shards} div __all").cast("int"))
    first = F.expr(f"(__shard * __all + {n_shards - 1}) div {n_shards}")
    return placed.select(
        F.col("__id").alias(id_col), F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.col("__stratum").alias(stratum_col),
        F.col("__fraction").alias("fraction"), F.col("__shard").alias("shard"), (place - first).alias("slot"),
        *([F.col("__row").alias(row_col)] if row_col else []),
    )


def _bucket_rank(df: DataFrame, keys: list[str], bucket: str, order: list[str], rank: str, total: str) -> DataFrame:
    """Adds the 1-based rank of a row by (bucket, *order) among rows with equal ``keys``, and their number."""
    counts = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("__n"))
    run = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *(F.col(k).alias(f"{k}_c") for k in [*keys, bucket]),
        F.coalesce(F.sum("__n").over(run), F.lit(0)).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*keys)).alias(total),
    )
    match = F.col(bucket) == F.col(f"{bucket}_c")
    for k in keys:
        match &= F.col(k).eqNullSafe(F.col(f"{k}_c"))
    inside = F.row_number().over(Window.partitionBy(*keys, bucket).orderBy(*order))
    ranked = df.withColumn("__inside", inside).join(counts, match)
    return ranked.withColumn(rank, F.col("__inside") + F.col("__before")).drop("__inside", "__before", *(f"{k}_c" for k in [*keys, bucket]))


def write_shards(df: DataFrame, path: str, n_shards: int, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "source", seed: str = SEED, file_rows: int = FILE_ROWS) -> DataFrame:
    """Write every row of ``df`` once, by shard (folders ``shard=..``), each file a range of slots in order; what was written.

    Rows are numbered in a copy in the shared folder, so null and repeated ids keep their rows. A shard is as many
    tasks and files as its rows need. Columns ``shard`` and ``slot`` that ``df`` has are replaced.
    """
    row = free_prefix(*df.columns) + "row"
    rows = written(df.withColumn(row, F.monotonically_increasing_id()), "rows")
    assigned = assign_shards(rows, n_shards, id_col, text_col, stratum_col, seed, row).select(F.col(row).alias(f"{row}_of"), "shard", "slot")
    spread = rows.drop("shard", "slot").join(assigned, F.col(row) == F.col(f"{row}_of")).drop(row, f"{row}_of")
    part = F.expr(f"slot div {file_rows}")
    files = max(n_shards, rows.count() // file_rows + n_shards)
    spread.repartition(files, "shard", part).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.parquet(path)


def op1_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assign_shards(table(spark, sf_dir, "documents"), 8)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source", "fraction")


def _crc_table() -> list[int]:
    """CRC-32 remainders of the 16 nibbles (reflected polynomial 0xEDB88320)."""
    out = []
    for c in range(16):
        for _ in range(4):
            c = c >> 1 ^ 0xEDB88320 * (c & 1)
        out.append(c)
    return out


OP1_SQL = f"""
WITH bytes AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size, string_split(hex(encode(coalesce(text, ''))), '') AS digits
  FROM documents),
c AS (
  SELECT doc_id, source, size, xor(4294967295, list_reduce(
      list_transform(range(CASE WHEN size = 1 THEN 0 ELSE len(digits) END), lambda i: (strpos('0123456789ABCDEF', digits[xor(i, 1) + 1]) - 1)::BIGINT),
      lambda c, n: xor(c >> 4, ({_crc_table()}::BIGINT[])[(xor(c, n) & 15) + 1]), 4294967295::BIGINT)) AS text_crc32
  FROM bytes),
d AS (SELECT *, md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, 'null'), size, text_crc32)) AS h FROM c),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY h, doc_id, size, text_crc32) - 0.5::DOUBLE)
    / count(*) OVER (PARTITION BY source) AS fraction FROM d),
p AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source NULLS FIRST, h, doc_id, size, text_crc32) - 1 AS place, count(*) OVER () AS n FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 8 // n)::INTEGER AS shard,
  place - ((place * 8 // n) * n + 7) // 8 AS slot, NULL::INTEGER AS grown_shard, source, fraction
FROM p
"""
