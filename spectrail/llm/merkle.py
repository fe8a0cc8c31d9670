"""Operator 13: a Merkle manifest of a table, with a proof for every row."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spectrail.llm._shared import table, written

ARITY = 3
#: Levels of a block: a task holds ``ARITY ** LEVELS`` nodes (2,187) of one tree at a time.
LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(values: list[Column]) -> Column:
    """Digest (binary) of values one after another, each ``-`` if null, else its UTF-8 bytes' number, a colon and the value."""
    parts = []
    for v in values:
        s = v.cast("string")
        parts.append(F.when(s.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Nodes (tree, ...) with ``idx``, the place in the tree by ``order``, from 0, and ``n``, the tree's number of nodes.

    One global sort, so a tree of most of the rows is spread over tasks like any other; its places are counted by
    partition, one row for each tree and partition.
    """
    rows = written(nodes.orderBy("tree", *order).withColumn("at", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("part", F.shiftright("at", 33))
    counts = rows.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("c").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("c").over(tree).alias("n"))
    return rows.join(counts, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def height(n: int) -> int:
    """Levels over n nodes."""
    k = 0
    while ARITY**k < n:
        k += 1
    return k


def visit(digests: list[bytes], low: int, high: int, levels: int, paths: list[bytearray]) -> bytes:
    """Digest of the subtree over digests low to high (hexadecimal); its leaves' paths get their siblings on the way back.

    A step of a path is the place in its run, the number of siblings and their digests.
    """
    if not levels:
        return digests[low]
    width = ARITY ** (levels - 1)
    runs = [(a, min(a + width, high)) for a in range(low, high, width)]
    roots = [visit(digests, a, b, levels - 1, paths) for a, b in runs]
    for k, (a, b) in enumerate(runs):
        step = bytes([k, len(runs) - 1]) + b"".join(bytes.fromhex(r.decode()) for r in roots[:k] + roots[k + 1 :])
        for path in paths[a:b]:
            path += step
    return digest(b"".join(roots))


def digest(text: bytes) -> bytes:
    return sha256(text).hexdigest().encode()


def _block(levels: int):
    """A block's nodes with their paths inside it; its root stands beside the first."""

    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("idx")
        digests = [d.hex().encode() for d in block.column("digest").to_pylist()]
        paths = [bytearray() for _ in digests]
        root = visit(digests, 0, len(digests), min(levels, height(block.column("n")[0].as_py())), paths)
        block = block.append_column("path", pa.array([bytes(p) for p in paths], pa.binary()))
        return block.append_column("root", pa.array([bytes.fromhex(root.decode())] + [None] * (len(digests) - 1), pa.binary()))

    return run


def traversed(nodes: DataFrame, levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Traversals of nodes (tree, idx, n, digest, ...), one on the block roots of another, and each tree's root (tree, digest).

    A block is an aligned stretch of three to the power of ``levels`` nodes, a group of its own however many nodes its tree has. The block roots
    are the nodes of the next traversal, so there are as many as the largest tree's height needs, four for 10 ** 13 rows.
    """
    rounds, width = [], ARITY**levels
    while True:
        blocks = nodes.withColumn("block", F.expr(f"idx div {width}"))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in blocks.schema) + ", path binary, root binary"
        done = written(blocks.groupBy("tree", "block").applyInArrow(_block(levels), kinds), "traversed")
        rounds.append(done)
        nodes = done.where("root IS NOT NULL").select("tree", F.col("block").alias("idx"), F.expr(f"(n + {width - 1}) div {width}").alias("n"), F.col("root").alias("digest"))
        if nodes.where("n > 1").isEmpty():
            return rounds, nodes.select("tree", "digest")


def _unwound(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Nodes of the first traversal with whole paths: their own, their block's, and so on, then ``path`` of ``above`` (tree, path, ...)."""
    more = [c for c in above.columns if c not in ("tree", "path")]
    above = above.withColumnRenamed("path", "__up")
    on = ["tree"]
    for nodes in reversed(rounds):
        whole = nodes.join(above, on).withColumn("path", F.concat("path", "__up")).drop("__up", "root")
        above = whole.select("tree", F.col("idx").alias("block"), F.col("path").alias("__up"), *more)
        on = ["tree", "block"]
    return whole


def manifest(leaves: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, bytes | None]:
    """Proofs for leaves (tree, digest, ...) in order of ``order``, and the root (None without leaves).

    Of each tree the nodes are hashed in runs of three, level by level, until one remains, its subroot; the subroots in order of
    ``tree``, byte by byte, are hashed likewise. ``path`` leads from a leaf to the root (see ``visit``), ``subroot`` is its tree's.
    """
    rounds, subroots = traversed(ranked(leaves, ["order", "digest"]), levels)
    trees = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), ["of"])
    tops, root = traversed(trees, levels)
    known = root.first()  # one row at most: all subroots are one tree
    top = root.select("tree", F.lit(b"").alias("path"))
    above = _unwound(tops, top).select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"))
    return _unwound(rounds, above), None if known is None else bytes(known["digest"])


def folded(first: bytes, path: bytes) -> tuple[bytes, bytes]:
    """Root that a leaf's digest and its path lead to, and the digest of all siblings on the way (hexadecimal)."""
    siblings, at = sha256(), 0
    while at < len(path):
        place, n = path[at], path[at + 1]
        run = [path[at + 2 + 32 * k : at + 34 + 32 * k].hex().encode() for k in range(n)]
        for s in run:
            siblings.update(s)
        first = digest(b"".join([*run[:place], first, *run[place:]]))
        at += 2 + 32 * n
    return first, siblings.hexdigest().encode()


def proofs(rows: DataFrame, root: bytes | None) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (id, digest, changed, subroot, path).

    ``folded_root`` is folded anew from ``changed``, a digest of what is there now, or from the leaf where that is null.
    """
    kind, whole = rows.schema["id"].dataType.simpleString(), (root or b"").hex()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, now, sub, path = (batch.column(c).to_pylist() for c in ("digest", "changed", "subroot", "path"))
            got = [folded((b if b is not None else a).hex().encode(), p) for a, b, p in zip(own, now, path, strict=True)]
            found = [g[0].decode() for g in got]
            text = [[x.hex() for x in own], [x.hex() for x in sub], [whole] * len(own), [g[1].decode() for g in got], found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(t, pa.string()) for t in text), pa.array([f == whole for f in found], pa.bool_())], ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.select("id", "digest", "changed", "subroot", "path").mapInArrow(run, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")


def audited(docs: DataFrame, tampered: Column, changed: dict[str, Column], columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", tree_col: str = "source", levels: int = LEVELS) -> DataFrame:
    """A proof of every row of ``docs``, checked against the row as it is where ``tampered``: with the columns of ``changed`` as they say.

    Leaves of one ``tree_col`` ascend by ``id_col``, null ids first; rows of one id by their leaf, so repeated rows stand side by side and
    their proofs are the same set in any run. A null tree is a tree before all others. Null ids are tampered with only if the condition is
    true for them. An empty table gives no rows. Columns that ``columns`` doesn't name have no part in a leaf.
    """
    now = [changed.get(c, F.col(c)) for c in columns]
    tree = F.when(F.col(tree_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(tree_col).cast("string")))
    different = F.coalesce(tampered, F.lit(False))
    leaves = docs.select(tree.alias("tree"), F.col(id_col).alias("order"), leaf([F.col(c) for c in columns]).alias("digest"), F.when(different, leaf(now)).alias("changed"))
    rows, root = manifest(written(leaves, "leaves"), levels)
    return proofs(rows.withColumnRenamed("order", "id"), root).withColumnRenamed("id", id_col)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return audited(table(spark, sf_dir, "documents"), half, {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"


def _op13_sql() -> str:
    whole = lambda text: f"sha256({' || '.join([*map(_field, COLUMNS[:-1]), _field(text)])})"
    crc = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))"
    return f"""
WITH RECURSIVE docs AS (SELECT *, coalesce(xor({crc}, 4294967295) % 2 = 0, false) AS changed FROM documents),
leaves AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1)::BIGINT AS idx, count(*) OVER (PARTITION BY source) AS n, row_number() OVER () AS id FROM (
  SELECT doc_id, coalesce('s' || source, 'n') AS tree, source, {whole('text')} AS leaf, CASE WHEN changed THEN {whole("replace(text, chr(10), '')")} END AS now FROM docs)),
up AS (SELECT tree, 0 AS lvl, idx, n, leaf AS d FROM leaves
  UNION ALL SELECT tree, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY tree, lvl, n, idx // 3),
subs AS (SELECT tree, lvl AS top, d AS subroot, (row_number() OVER (ORDER BY encode(tree)) - 1)::BIGINT AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
over AS (SELECT 0 AS lvl, idx, n, subroot AS d FROM subs
  UNION ALL SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM over WHERE n > 1 GROUP BY lvl, n, idx // 3),
nodes AS (SELECT tree, lvl, idx, d FROM up WHERE n > 1 UNION ALL SELECT s.tree, s.top + o.lvl, o.idx, o.d FROM over o, subs s WHERE o.n > 1),
steps AS (SELECT l.id, 0 AS depth, l.tree, l.idx, l.n FROM leaves l WHERE l.n > 1
  UNION ALL SELECT id, depth + 1, tree, idx // 3, (n + 2) // 3 FROM steps WHERE n > 3),
higher AS (SELECT l.id, s.top::INTEGER AS depth, l.tree, s.idx, s.n FROM leaves l JOIN subs s USING (tree) WHERE s.n > 1
  UNION ALL SELECT id, depth + 1, tree, idx // 3, (n + 2) // 3 FROM higher WHERE n > 3),
runs AS (SELECT p.id, p.depth, coalesce(string_agg(m.d, '' ORDER BY m.idx) FILTER (WHERE m.idx < p.idx), '') AS low, coalesce(string_agg(m.d, '' ORDER BY m.idx) FILTER (WHERE m.idx > p.idx), '') AS high
  FROM (FROM steps UNION ALL FROM higher) p JOIN nodes m ON m.tree = p.tree AND m.lvl = p.depth AND m.idx // 3 = p.idx // 3 GROUP BY p.id, p.depth, p.idx),
fold AS (SELECT id, 0 AS depth, coalesce(now, leaf) AS d FROM leaves
  UNION ALL SELECT f.id, f.depth + 1, sha256(r.low || f.d || r.high) FROM fold f JOIN runs r ON r.id = f.id AND r.depth = f.depth),
proof AS (SELECT id, string_agg(low || high, '' ORDER BY depth) AS siblings FROM runs GROUP BY id),
root AS (SELECT d AS root FROM over WHERE n = 1)
SELECT l.doc_id, l.leaf, s.subroot, root, sha256(coalesce(p.siblings, '')) AS proof_sha256, f.d AS folded_root, f.d = root AS verified
FROM leaves l JOIN subs s USING (tree) CROSS JOIN root LEFT JOIN proof p ON p.id = l.id
  JOIN (SELECT id, arg_max(d, depth) AS d FROM fold GROUP BY id) f ON f.id = l.id
"""


OP13_SQL = _op13_sql()
