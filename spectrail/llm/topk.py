"""Operator 2: exact top-k inner-product search by columnar branch and bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.llm._shared import table

#: Vectors in a candidate block, queries in a tile, dimensions in a step; bytes of the queries that one task holds.
BLOCK, TILE, STEP, QUERY_BYTES = 2048, 1024, 16, 32 << 20
#: Below this share of survivors the pairs are compacted and finished one by one.
COMPACT = 0.08


def quantised(vector: Column) -> Column:
    """floor(256 * x) of every component as double; null if the vector takes no part."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(vector.isNotNull() & sound, F.transform(vector, lambda x: F.floor(x.cast("double") * 256.0).cast("double")))


def top_k_inner_product(rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK, tile: int = TILE, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The k rows of largest integer inner product with each query row, ties to the smaller id.

    Vectors are quantised, dealt by hash into candidate blocks of about ``block`` rows and
    laid out dimension by dimension. Queries likewise form tiles, and as many tiles as have ``query_bytes`` a query
    block. Every query block meets every candidate block (the stated query set against all rows); a task streams the
    candidate blocks of its share past one query block, so the candidates are sent once for each ``query_bytes`` of
    queries. It adds up inner products ``STEP``
    dimensions at a time and after each step drops the pairs whose score so far plus the
    largest possible rest (the product of the remaining norms) can't reach the query's
    k-th best score; few survivors are compacted into a list of pairs and finished there.
    Bounds carry rounding slack and ties survive, so the answer is exact. A candidate block whose largest norm can't
    reach any query's k-th best score is passed over.

    Memory of a task: one query block, one candidate block and the scores of a tile. The emitted
    rows are k for each query and share. Nothing is broadcast.

    Null vectors and those with null or non-finite components take no part. Vectors meet
    only vectors of equal length. Rows that share the query's id are not its candidates;
    other repeated rows each count; equal query rows are answered once. Null ids take no part.
    A score outside a long is held at its end before ranking. Columns: query_id, rank, <id_col>, score.
    """
    spark = rows.sparkSession
    base = rows.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    base = base.where(F.col("v").isNotNull() & F.col("id").isNotNull())
    n, n_queries, size = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    blocks, tiles, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // tile)), max(1, -(-n_queries * 4 * size // query_bytes))
    # as many shares of the candidates as keep the cluster busy, one if the query blocks do that
    shares = max(1, min(blocks, -(-2 * spark.sparkContext.defaultParallelism // query_blocks)))
    hashed = F.xxhash64("id", "v")
    pack = "dim int, qb int, share int, kind int, cb int, n int, ids binary, vectors binary"
    candidates = (
        base.select("id", "v", F.size("v").alias("dim"), F.pmod(hashed, F.lit(blocks)).cast("int").alias("cb"))
        .groupBy("dim", "cb").applyInPandas(_packed(1), "dim int, kind int, cb int, n int, ids binary, vectors binary")
        .withColumn("share", F.col("cb") % shares).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    )
    queries = (
        base.where("q").select("id", "v", F.size("v").alias("dim"), F.pmod(hashed, F.lit(tiles)).cast("int").alias("cb")).distinct()
        .groupBy("dim", "cb").applyInPandas(_packed(0), "dim int, kind int, cb int, n int, ids binary, vectors binary")
        .withColumn("qb", F.col("cb") % query_blocks).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    )
    names = [c.split()[0] for c in pack.split(", ")]
    pairs = candidates.select(names).unionByName(queries.select(names))
    pairs = pairs.repartition(query_blocks * shares, "dim", "qb", "share").sortWithinPartitions("dim", "qb", "share", "kind", "cb")
    found = pairs.mapInPandas(lambda it: _search(it, k), "query_id long, qkey long, id long, score long")
    found = found.groupBy("query_id", "qkey").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("s"), "id", "score"))), 1, k).alias("best"))
    out = found.select("query_id", F.posexplode("best").alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))


def _packed(kind: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["id"].to_numpy(), kind="stable")
        vertical = np.ascontiguousarray(np.array(pdf["v"].tolist(), np.float64).reshape(len(pdf), -1)[order].T)
        if np.abs(vertical).max(initial=0) < 2**24:  # whole numbers that 32 bits hold
            vertical = vertical.astype(np.float32)
        return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "kind": [kind], "cb": [int(pdf["cb"].iloc[0])], "n": [len(pdf)], "ids": [pdf["id"].to_numpy(np.int64)[order].tobytes()], "vectors": [vertical.tobytes()]})

    return pack


def _search(it: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    tiles, key = [], None
    for pdf in it:
        for row in pdf.itertuples(index=False):
            kind = np.float32 if len(row.vectors) == 4 * row.dim * row.n else np.float64
            ids, vectors = np.frombuffer(row.ids, np.int64), np.frombuffer(row.vectors, kind).reshape(row.dim, row.n)
            if key != (row.dim, row.qb, row.share):
                yield from (t.result() for t in tiles)
                tiles, key = [], (row.dim, row.qb, row.share)
            if row.kind == 0:
                tiles.append(Best(ids, vectors, k))
            else:
                for t in tiles:
                    t.meet(ids, vectors)
    yield from (t.result() for t in tiles)


class Best:
    """The best k candidates so far of every query of a block (vectors: dimensions x queries)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, step: int = STEP):
        self.ids, self.q, self.k, self.step = ids, vectors, k, step
        self.norm = np.sqrt(np.einsum("ij,ij->j", self.q.astype(np.float64), self.q.astype(np.float64)))
        self.score: list[np.ndarray] = [np.zeros(0)] * len(ids)
        self.found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        self.least = np.full(len(ids), -np.inf)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        d = len(vectors)
        wide = vectors.astype(np.float64)
        top = float(np.sqrt(np.einsum("ij,ij->j", wide, wide)).max(initial=0))
        reach = float(self.norm.max(initial=0)) * top
        if reach >= 2**52:
            return self._large(ids, vectors)
        if len(self.ids) and (self.least > self.norm * top * (1 + 1e-9) + 1e-3).all():
            return None
        kind = np.float32 if reach < 2**23 else np.float64
        q, v = self.q.astype(kind), vectors.astype(kind)
        cuts = list(range(0, d, self.step)) + [d]
        total, pairs = np.zeros((q.shape[1], v.shape[1]), kind), None
        for a, b in zip(cuts, cuts[1:], strict=False):
            if pairs is None:
                total += q[a:b].T @ v[a:b]
            else:
                qi, ci, score = pairs
                score = score + np.einsum("ij,ij->j", q[a:b][:, qi], v[a:b][:, ci])
            if b == d:
                break
            rest_q = np.sqrt(np.einsum("ij,ij->j", self.q[b:], self.q[b:], dtype=np.float64))
            rest_v = np.sqrt(np.einsum("ij,ij->j", wide[b:], wide[b:]))
            if pairs is None:
                # slack: the bound is a rounded product, the scores are exact integers
                need = self.least[:, None] - rest_q[:, None] * rest_v[None, :] * (1 + 1e-9) - 1e-3
                alive = total >= need
                if alive.sum() < COMPACT * alive.size:
                    qi, ci = np.nonzero(alive)
                    pairs = (qi, ci, total[qi, ci])
            else:
                alive = score >= self.least[qi] - rest_q[qi] * rest_v[ci] * (1 + 1e-9) - 1e-3
                pairs = (qi[alive], ci[alive], score[alive])
        if pairs is None:
            qi, ci = np.nonzero(total >= self.least[:, None])
            score = total[qi, ci]
        self._keep(qi, ids[ci], score.astype(np.float64))
        return None

    def _keep(self, qi: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        fit = (score >= self.least[qi]) & (ids != self.ids[qi])
        qi, ids, score = qi[fit], ids[fit], score[fit]
        order = np.lexsort((ids, -score, qi))
        qi, ids, score = qi[order], ids[order], score[order]
        first = np.searchsorted(qi, qi)
        top = np.arange(len(qi)) - first < self.k
        qi, ids, score = qi[top], ids[top], score[top]
        at = np.flatnonzero(np.r_[True, qi[1:] != qi[:-1]]) if len(qi) else np.zeros(0, int)
        for a, b in zip(at, [*at[1:], len(qi)], strict=False):
            x = qi[a]
            s, i = np.concatenate([self.score[x], score[a:b]]), np.concatenate([self.found[x], ids[a:b]])
            best = np.lexsort((i, -s))[: self.k]
            self.score[x], self.found[x] = s[best], i[best]
            if len(best) == self.k:
                self.least[x] = self.score[x][-1]

    def _large(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Components so large that doubles don't hold the products: whole numbers of any size."""
        whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
        total = whole(self.q).T @ whole(vectors) if len(vectors) else np.zeros((self.q.shape[1], len(ids)), object)
        for x in range(len(self.ids)):
            new = [min(max(y, -(2**63)), 2**63 - 1) for y in total[x][ids != self.ids[x]]]
            s = np.concatenate([np.array(self.score[x], object), np.array(new, object)])
            i = np.concatenate([self.found[x], ids[ids != self.ids[x]]])
            best = sorted(range(len(s)), key=lambda j: (-int(s[j]), i[j]))[: self.k]
            self.score[x], self.found[x] = s[best], i[best]
            if len(best) == self.k:
                self.least[x] = np.nextafter(float(self.score[x][-1]), -np.inf)

    def result(self) -> pd.DataFrame:
        sizes = [len(x) for x in self.found]
        key = [int.from_bytes(hashlib.blake2b(c.tobytes(), digest_size=8).digest(), "little", signed=True) for c in np.ascontiguousarray(self.q.T.astype(np.float64))]
        score = [int(s) for x in self.score for s in x]
        return pd.DataFrame({"query_id": np.repeat(self.ids, sizes), "qkey": np.repeat(np.array(key, np.int64), sizes), "id": np.concatenate([*self.found, np.zeros(0, np.int64)]).astype(np.int64), "score": np.array(score, np.int64)})


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k_inner_product(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
WHERE rank <= 5
"""
