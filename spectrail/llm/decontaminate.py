"""Operator 9: benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spectrail.llm._shared import table, written

#: Words of a shingle; the share of an item's shingles that a document must hold, as a fraction.
WORDS, SHARE = 5, (4, 5)
#: Item shingles up to which the index is broadcast (about 200 bytes each); beyond, it is shuffled.
BROADCAST_SHINGLES = 500_000


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingles(df: DataFrame, id_cols: list[str], words: str, n: int) -> DataFrame:
    """A row for each run of n words: columns __w0 .. and its hash."""
    size = F.size(words)
    shifted = [F.slice(words, i + 1, F.greatest(size - n + 1, F.lit(0))).alias(f"__w{i}") for i in range(n)]
    rows = df.select(*id_cols, *shifted).select(*id_cols, F.inline(F.arrays_zip(*(f"__w{i}" for i in range(n)))))
    return rows.withColumn("__hash", F.xxhash64(F.lit(n), *(f"__w{i}" for i in range(n))))


def item_index(items: DataFrame, item_col: str = "item_id", text_col: str = "text", words: int = WORDS, share: tuple[int, int] = SHARE) -> DataFrame:
    """Distinct shingles of every item, each marked whether it is in the item's MinHash sketch.

    Items are partitioned by size (powers of two of their shingle count n). Of n shingles a
    match holds at least ceil(share * n), so any k = n - ceil(share * n) + 1 of them include
    one that the document holds: the sketch is the k smallest hashes, with the k of the
    partition's largest size. A search by sketches alone so misses no match.
    Items of fewer than ``words`` words are one shingle of all their words; items without
    words are left out.
    """
    a, b = share
    base = items.select(F.col(item_col).alias("item_id"), normal_words(F.col(text_col)).alias("__words")).where(F.size("__words") > 0)
    rows = None
    for n in range(1, words + 1):
        part = base.where(F.size("__words") >= words) if n == words else base.where(F.size("__words") == n)
        part = _shingles(part, ["item_id"], "__words", n).select("item_id", F.lit(n).alias("width"), "__hash", F.concat_ws(" ", *(f"__w{i}" for i in range(n))).alias("shingle"))
        rows = part if rows is None else rows.unionByName(part)
    rows = rows.distinct()
    per_item = Window.partitionBy("item_id")
    rows = rows.withColumn("n", F.count(F.lit(1)).over(per_item)).withColumn("ordinal", F.row_number().over(per_item.orderBy("__hash", "shingle")))
    largest = (F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1).cast("long")
    need = lambda n: F.floor((n * a + (b - 1)) / b)
    return rows.select("item_id", "width", "__hash", "shingle", "ordinal", "n", need(F.col("n")).alias("need"), (F.col("ordinal") <= largest - need(largest) + 1).alias("sketch"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", words: int = WORDS, share: tuple[int, int] = SHARE, broadcast_up_to: int = BROADCAST_SHINGLES) -> DataFrame:
    """Pairs of document and benchmark item of which the document holds at least ``share``.

    Search: every document's shingle hashes up to the sketches' largest probe the sketches; a pair with a
    hit is a candidate. Verification: the candidates' documents alone give all their shingles, which are compared
    as text with all of the item's; a pair stays if the distinct ones reach the need.
    Only candidates are shuffled, by pair, so a passage that sits in a third of all documents is no hot
    key. The index is broadcast only while it has ``broadcast_up_to`` shingles at most, else joined by
    shuffle; so, by Spark's own threshold, are the candidates' ids. Words are lower-cased runs of letters and
    digits. Null and empty texts match nothing; rows with equal ids count as one document; a null id is
    one too. Columns: id, item_id, n_item, n_shared, containment.
    """
    index = written(item_index(items, item_col, item_text_col, words, share), "items")
    stats = index.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("sketch"), F.col("__hash"))).alias("top")).collect()  # at most ``words`` rows
    tops = {r["width"]: r["top"] for r in stats}
    small = sum(r["n"] for r in stats) <= broadcast_up_to
    base = docs.select(F.col(id_col).alias("__id"), normal_words(F.col(text_col)).alias("__words"))

    def probe(of: DataFrame, sketch: bool) -> DataFrame:
        """Hits of the documents' shingles in the index or its sketches: (id, item_id, ordinal, n, need)."""
        hits = None
        for width in sorted(tops) or [words]:
            shingles = _shingles(of, ["__id"], "__words", width)
            part = index.where(F.col("width") == width).withColumnRenamed("__hash", "__key")
            if sketch:
                shingles, part = shingles.where(F.col("__hash") <= F.lit(tops.get(width, 0))), part.where("sketch")
            part = shingles.join(F.broadcast(part) if small else part, F.col("__hash") == F.col("__key"))
            if not sketch:
                part = part.where(F.concat_ws(" ", *(f"__w{i}" for i in range(width))) == F.col("shingle"))
            part = part.select("__id", "item_id", "ordinal", "n", "need")
            hits = part if hits is None else hits.unionByName(part)
        return hits

    candidates = written(probe(base, True).select("__id", "item_id").distinct(), "candidates")
    ids = candidates.select(F.col("__id").alias("__c")).distinct()
    held = base.join(ids, F.col("__id").eqNullSafe(F.col("__c")), "left_semi")
    shared = probe(held, False).groupBy("__id", "item_id", "n", "need", "ordinal").agg(F.lit(1).alias("one"))
    shared = shared.groupBy("__id", "item_id", "n", "need").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= F.col("need"))
    found = candidates.select(F.col("__id").alias("__c"), F.col("item_id").alias("__i"))
    pairs = shared.join(found, F.col("__id").eqNullSafe(F.col("__c")) & F.col("item_id").eqNullSafe(F.col("__i")), "left_semi")
    return pairs.select(F.col("__id").alias(id_col), "item_id", F.col("n").alias("n_item"), F.col("shared").alias("n_shared"), (F.col("shared") / F.col("n")).alias("containment"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH w AS (
  SELECT 0 AS side, doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents
  UNION ALL
  SELECT 1, item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') FROM benchmark),
k AS (SELECT DISTINCT least(len(w), 5) AS width FROM w WHERE side = 1 AND len(w) > 0),
s AS (
  SELECT DISTINCT side, id, width, unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS shingle
  FROM w JOIN k ON CASE WHEN side = 0 THEN len(w) >= width ELSE least(len(w), 5) = width END),
n AS (SELECT id, count(*) AS n FROM s WHERE side = 1 GROUP BY id),
p AS (
  SELECT d.id AS doc_id, i.id AS item_id, n.n AS n_item, count(*) AS n_shared
  FROM s d JOIN s i USING (shingle, width) JOIN n ON n.id = i.id WHERE d.side = 0 AND i.side = 1 GROUP BY d.id, i.id, n.n)
SELECT *, n_shared / n_item::DOUBLE AS containment FROM p WHERE n_shared * 5 >= n_item * 4
"""
