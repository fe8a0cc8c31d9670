"""Operator 4: language by nearest centroid of TF-IDF n-gram vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spectrail.llm._shared import table, written
from spectrail.llm._text import slices, text_bytes

#: Dimensions that byte n-grams are hashed to; n-gram lengths; centroids of a language.
DIMENSIONS, GRAMS, CENTROIDS = 8192, (2, 3, 4), 4
#: The bounds of the training sample: documents of a language; languages, beyond which learning fails loudly.
SAMPLE, LANGUAGES = 300, 128
#: Languages whose sizes are broadcast to thin out the sample; more are joined by shuffle.
BROADCAST_LANGUAGES = 10_000
#: Documents, and bytes of text, whose counts are laid out at once: 8 MB of floats and as much while they are counted.
SLICE_ROWS, SLICE_BYTES = 256, 1 << 19
#: A document is rejected below this share of the least similarity that training documents of its size have.
REJECT = 0.5
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_ASCII = np.full(256, 0x20, np.uint8)
_ASCII[0x80:] = np.arange(0x80, 0x100)
_ASCII[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed byte n-grams of each lower-cased text: documents x DIMENSIONS.

    Other ASCII characters than letters count as one space; grams that hold two spaces in
    a row, or reach into the next text, are left out.
    """
    lowered = pa.array([(t or "").lower() for t in texts.to_pylist()], pa.large_string())
    data, offsets = text_bytes(lowered)
    data = _ASCII[data]
    n, docs = len(data), len(offsets) - 1
    out = np.zeros((docs, DIMENSIONS), np.float32)
    if not n:
        return out
    keep = np.ones(n, bool)
    keep[1:] = (data[1:] != 0x20) | (data[:-1] != 0x20)
    at = np.cumsum(keep)
    data = data[keep].astype(np.uint32)
    offsets = np.append(0, at)[offsets]
    doc = np.repeat(np.arange(docs, dtype=np.int64), np.diff(offsets))
    for length in GRAMS:
        if len(data) < length:
            continue
        m = len(data) - length + 1
        code = np.zeros(m, np.uint32)
        for i in range(length):
            code = code * np.uint32(0x01000193) + data[i : i + m]
        code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
        inside = doc[:m] == doc[length - 1 :]
        cell = doc[:m][inside] * DIMENSIONS + code[inside]
        held, times = np.unique(cell, return_counts=True) if len(cell) < out.size // 8 else (slice(None), np.bincount(cell, minlength=out.size))
        out.reshape(-1)[held] += times
    return out


@dataclass
class Model:
    """Weights of the dimensions, centroids (rows), the language of each, and least similarities by size class."""

    weight: np.ndarray
    centroids: np.ndarray
    language: list[str]
    least: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        v = np.log1p(counts) * self.weight
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def predict(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, cosine clipped to 0..1, rejected) of each document."""
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0).astype(np.float64)
        return best, score, score < self.least[size_class(counts)]


def size_class(counts: np.ndarray) -> np.ndarray:
    """Powers of two of the number of n-grams."""
    return np.minimum(np.log2(counts.sum(axis=1) + 1).astype(int), 15)


def slices_of(batch: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch that are small both in rows and in bytes of text."""
    for part in slices(batch, text_col, SLICE_BYTES):
        for first in range(0, part.num_rows, SLICE_ROWS):
            yield part.slice(first, SLICE_ROWS)


def centres_of(v: np.ndarray, centroids: int) -> np.ndarray:
    """Spherical k-means on unit vectors; starts and ties are fixed by the order of rows."""
    centre = v[np.linspace(0, len(v) - 1, min(centroids, len(v))).astype(int)]
    for _ in range(12):
        best = (v @ centre.T).argmax(axis=1)
        centre = np.stack([v[best == c].sum(axis=0) if (best == c).any() else centre[c] for c in range(len(centre))])
        centre = centre / np.maximum(np.linalg.norm(centre, axis=1, keepdims=True), 1e-12)
    return centre


def least_similarities(own: np.ndarray, size: np.ndarray) -> np.ndarray:
    """By size class, the similarity below which a document is rejected."""
    least = np.array([np.quantile(own[size == c], 0.01) if (size == c).sum() >= 20 else np.nan for c in range(16)])
    for c in range(15, -1, -1):  # shorter texts lie farther off: an unseen class takes half its longer neighbour's
        if np.isnan(least[c]):
            least[c] = least[c + 1] / 2 if c < 15 and not np.isnan(least[c + 1]) else np.nan
    return np.nan_to_num(least, nan=np.nanmin(least) if not np.isnan(least).all() else 0.0) * REJECT


def fit(sampled: DataFrame, centroids: int = CENTROIDS) -> Model | None:
    """A model of sparse counts (lang, place, cells, counts); None without any.

    Documents that have a dimension are counted with map-side combining; then each language, a bounded number of
    documents, is laid out and clustered in a task of its own. The driver gets the centroids, a float for each dimension
    and one similarity a document.
    """

    def having(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for cells in batch.column("cells"):
                total[np.frombuffer(cells.as_buffer(), np.uint16)] += 1
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["cell", "n"])

    found = sampled.mapInArrow(having, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # at most DIMENSIONS rows
    in_documents = np.zeros(DIMENSIONS)
    for r in found:
        in_documents[r["cell"]] = r["n"]
    weight = (np.log((1 + sampled.count()) / (1 + in_documents)) + 1).astype(np.float32)
    shared = sampled.sparkSession.sparkContext.broadcast(weight)

    def clustered(rows: pa.Table) -> pa.Table:
        rows = sorted(rows.to_pylist(), key=lambda r: (r["place"], r["cells"], r["counts"]))
        model = Model(shared.value, np.zeros((0, DIMENSIONS), np.float32), [], np.zeros(16))
        counts = np.zeros((len(rows), DIMENSIONS), np.float32)
        for x, r in enumerate(rows):
            counts[x, np.frombuffer(r["cells"], np.uint16)] = np.frombuffer(r["counts"], np.uint32)
        size, v = size_class(counts), model.vectors(counts)
        centre = centres_of(v, centroids)
        own = (v @ centre.T).max(axis=1)
        return pa.table({"lang": [rows[0]["lang"]], "centroids": pa.array([centre.astype(np.float32).tobytes()], pa.binary()), "own": pa.array([own.astype(np.float64).tobytes()], pa.binary()), "size": pa.array([size.astype(np.int32).tobytes()], pa.binary())})

    got = sampled.groupBy("lang").applyInArrow(clustered, "lang string, centroids binary, own binary, size binary").collect()  # a row a language
    got.sort(key=lambda r: r["lang"])
    if not got:
        return None
    centre = [np.frombuffer(r["centroids"], np.float32).reshape(-1, DIMENSIONS) for r in got]
    own, size = (np.concatenate([np.frombuffer(r[c], kind) for r in got]) for c, kind in (("own", np.float64), ("size", np.int32)))
    return Model(weight, np.concatenate(centre), [r["lang"] for r, c in zip(got, centre, strict=True) for _ in c], least_similarities(own, size))


def training_sample(labelled: DataFrame, per_language: int, id_col: str, text_col: str, lang_col: str, seed: str) -> DataFrame:
    """(lang, place, text) of at most ``per_language`` documents of each language, chosen by a seeded hash of the id.

    Counting reads two narrow columns. A threshold on the hash leaves a few times the bound
    before the exact cut, so no task meets all rows of a language; rows that share an id, which the hash
    doesn't tell apart, are told apart by their texts.
    """
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("lang is not null")
    place = F.pmod(F.xxhash64(F.lit(seed), "id", "text"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 3 * per_language + 30)
    large = written(counts.select(F.col("lang").alias("of"), (F.lit(3.0 * per_language + 30.0) / F.col("n")).alias("share")), "languages")
    small = large.count() <= BROADCAST_LANGUAGES
    near = rows.withColumn("place", place).join(F.broadcast(large) if small else large, F.col("lang") == F.col("of"), "left").where("share is null or place <= share")
    cut = F.row_number().over(Window.partitionBy("lang").orderBy("place", "id", "text"))
    return near.withColumn("r", cut).where(F.col("r") <= per_language).select("lang", "place", "text")


def learn(labelled: DataFrame, per_language: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", seed: str = "language-1") -> Model | None:
    """A model from a bounded sample of rows with a language and a letter; None without any.

    N-grams are counted and each language's centroids are found on the executors; the driver gets a few vectors
    for each of at most ``LANGUAGES`` languages, whatever the table's size; more languages are an error. Other columns, whatever their names, are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices_of(whole, "text"):
                counts = gram_counts(batch.column("text"))
                cells = [np.flatnonzero(c).astype(np.uint16) for c in counts]
                values = [c[x].astype(np.uint32).tobytes() for c, x in zip(counts, cells, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), pa.array([x.tobytes() for x in cells], pa.binary()), pa.array(values, pa.binary())], ["lang", "place", "cells", "counts"])

    labelled = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    sampled = training_sample(labelled, per_language, id_col, text_col, lang_col, seed).mapInArrow(run, "lang string, place double, cells binary, counts binary")
    sampled = written(sampled, "sample")
    if (n := sampled.select("lang").distinct().count()) > LANGUAGES:
        raise ValueError(f"{n} languages; at most {LANGUAGES} can be learned")
    return fit(sampled)


def identify(df: DataFrame, model: Model | None, text_col: str = "text", prefix: str = "", keep_text: bool = True) -> DataFrame:
    """Adds lang_pred, score and rejected (after ``prefix``) to every row; other columns (the text if ``keep_text``) pass through.

    A document gets the language of its nearest centroid by cosine, and the cosine as its
    score. It is rejected if that is far below what training documents of its size reach.
    Null texts and those without a letter (and all, without a model) are ``und``, score 0,
    rejected. Whole texts are read; rows are never shuffled. Columns that have the new names are replaced.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)  # languages x CENTROIDS x DIMENSIONS floats
    added = [f"{prefix}lang_pred", f"{prefix}score", f"{prefix}rejected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for batch in slices_of(whole, text_col):
                texts = batch.column(text_col)
                lettered = np.array([t is not None and _LETTER.search(t) is not None for t in texts.to_pylist()], bool)
                language, score, rejected = np.full(len(lettered), UNKNOWN, object), np.zeros(len(lettered)), ~lettered
                if m is not None and lettered.any():
                    best, cosine, far = m.predict(gram_counts(texts))
                    language = np.where(lettered, np.array(m.language, object)[best], UNKNOWN)
                    score, rejected = np.where(lettered, cosine, 0.0), rejected | far
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), pa.array(language.tolist(), pa.string()), pa.array(score), pa.array(rejected)], [*passed, *added])

    passed = [c for c in df.columns if (keep_text or c != text_col) and c.lower() not in added]
    ddl = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in passed] + [f"`{added[0]}` string, `{added[1]}` double, `{added[2]}` boolean"])
    return df.mapInArrow(run, ddl)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()).select("doc_id", "text", "lang"))
    found = identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model, keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
