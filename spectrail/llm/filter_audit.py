"""Operator 11: what each filter of a chain removes, in every order of the chain."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spectrail.llm._shared import table, written

#: Filters of the audit by letter, and the bit of each in a document's mask of failures.
FILTERS = "ABCDE"
BLANKS = "[\\x20\\x09-\\x0D]+"
#: Documents that one task replays: with 120 orders of five steps these are 600 rows each.
TASK_ROWS = 50_000


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails A (under 50 words), B (under 65 % of its words distinct), C (over 5 % capitals), D (odd signs).

    Words are maximal runs of other characters than the six ASCII blanks, compared as they are. A text without words has no share
    of distinct ones below 65 %, and an empty one no share of capitals over 5 %.
    """
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed != "", F.split(trimmed, BLANKS))
    n, distinct = F.coalesce(F.size(words), F.lit(0)).cast("long"), F.coalesce(F.size(F.array_distinct(words)), F.lit(0)).cast("long")
    n, distinct = F.greatest(n, F.lit(0)), F.greatest(distinct, F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return [n < 50, distinct * 100 < n * 65, capitals * 100 > F.length(text).cast("long") * 5, text.rlike("[#$%&*|]")]


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) of every row: bit k of the mask is set where filter k of ``FILTERS`` fails.

    E fails where a row of a smaller id has the same text, anywhere in the table. Texts are told apart by their SHA-256, so
    only digests are shuffled; the least id of each repeated text is counted with map-side combining, and is joined back as a table,
    which lets Spark broadcast it while it is small and split a text of very many copies beyond.

    A null text is empty, a null part the empty string. A null id is smaller than none and larger than none, so such a row
    never fails E and makes none fail. Rows of one id and one text don't fail each other. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text"))
    mask = sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(text_failures(F.col("text")))), F.lit(0))
    rows = written(rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask")), "failures")
    least = rows.groupBy("digest").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    least = written(least.select("digest", "least"), "repeated")
    later = F.coalesce(F.col("id") > F.col("least"), F.lit(False))
    return rows.join(least, "digest", "left").select("id", "part", (F.col("mask") + F.when(later, 16).otherwise(0)).alias("mask"))


def with_labels(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds ``good`` (some label of the id has quality 1) and ``toxic`` (some has toxic 1); ids without labels are neither."""
    held = labels.groupBy(F.col(id_col).alias("of")).agg(*(F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))))
    held = written(held.where("of IS NOT NULL AND (good OR toxic)"), "labels")
    joined = failed.join(held, F.col("id") == F.col("of"), "left").drop("of")
    return joined.fillna(False, subset=["good", "toxic"])


def replay(failed: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of rows (part, mask, good, toxic).

    Every row meets every order of the filters (a broadcast table of as many rows as there are orders, 120 of five), the first failure
    in that order is where it is removed, and each step counts it as kept, removed or redundant (failing, but removed
    earlier). Counts are combined in each task, so what is shuffled is at most a row for each part, order and step.
    ``shapley`` is what the step's filter removes from the part, over all orders. Parts without rows don't appear.
    """
    n = len(filters)
    orders = [("".join(o), *(1 << filters.index(c) for c in o)) for o in permutations(filters)]
    bits = [f"b{k}" for k in range(n)]
    known = failed.sparkSession.createDataFrame(orders, "filter_order string, " + ", ".join(f"{b} int" for b in bits))
    assert len(orders) == factorial(n) <= 5040  # what is broadcast doesn't grow with the data
    first = F.lit(n + 1)
    for k in reversed(range(n)):
        first = F.when(F.col("mask").bitwiseAND(F.col(bits[k])) != 0, k + 1).otherwise(first)
    met = failed.crossJoin(F.broadcast(known)).withColumn("first", first)
    steps = met.select("part", "filter_order", "mask", "good", "toxic", "first", F.posexplode(F.array(*bits)).alias("step", "bit"))
    step, bit, first = F.col("step") + 1, F.col("bit"), F.col("first")
    gone, fails = first == step, F.col("mask").bitwiseAND(bit) != 0
    counts = {
        "kept": first > step, "removed": gone, "redundant": fails & (first < step), "unique_fails": F.col("mask") == bit,
        "good_lost": gone & F.col("good"), "toxic_lost": gone & F.col("toxic"),
    }
    got = steps.groupBy("part", "filter_order", "step", "bit").agg(*(F.count_if(c).alias(k) for k, c in counts.items()))
    own = Window.partitionBy("part", "bit")
    return got.withColumn("shapley", F.sum("removed").over(own)).select("part", "filter_order", (F.col("step") + 1).cast("int").alias("step"), *counts, "shapley")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(with_labels(failures(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels")).select("part", "mask", "good", "toxic"), "flags")
    # masks are few bytes a row, so their files would go to few tasks: deal them by number
    return replay(rows.repartition(max(1, -(-rows.count() // TASK_ROWS), spark.sparkContext.defaultParallelism)))


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda s: s <> '') AS ws FROM t),
m AS (SELECT x, min(doc_id) AS least FROM t GROUP BY x),
k AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.part, coalesce(k.good, false) AS good, coalesce(k.toxic, false) AS toxic,
    CASE WHEN len(ws) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(w.x, '[^A-Z]', '', 'g')) > 5 * length(w.x) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(w.x, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN w.doc_id > m.least THEN 'E' ELSE '' END AS failed
  FROM w JOIN m ON m.x = w.x LEFT JOIN k ON k.doc_id = w.doc_id),
g AS (SELECT part, good, toxic, failed, count(*) AS n FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT g.*, filter_order, step, letter, contains(failed, letter) AS fails, len(list_filter(string_split(before, ''), lambda c: c <> '' AND contains(failed, c))) > 0 AS gone FROM g, s),
a AS (SELECT part, filter_order, step::INTEGER AS step, letter, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND fails), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE gone AND fails), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (WHERE failed = letter), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND good), 0)::BIGINT AS good_lost, coalesce(sum(n) FILTER (WHERE NOT gone AND fails AND toxic), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM a
"""
