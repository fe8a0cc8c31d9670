"""Operator 12: near copies by SimHash fingerprints, found by multi-index hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spectrail.llm._shared import table, written
from spectrail.llm.components import components

SEED, BITS, HALF = 42, 64, 32
#: Bytes of text whose words are held at once, and shingles whose bits are counted at once.
PIECE, CHUNK = 1 << 20, 1 << 16
#: Fingerprints of a table's bucket that one task compares with each other at most.
BUCKET = 16_384
#: Hot keys up to which they are broadcast (8 bytes each); more are joined by shuffle.
BROADCAST_KEYS = 1_000_000
#: Buckets of at most so many fingerprints are compared many at once, by distance in the bucket.
SMALL = 64
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, A-Z in lower case, about ``PIECE`` bytes at a time."""
    at = 0
    while at < len(text):
        end = len(text)
        if at + PIECE < end and (found := _BLANK.search(text, at + PIECE)):
            end = found.start()
        yield text[at:end].lower().split()  # bytes know ASCII alone: its capitals and its six blanks
        at = end


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Majority of the bits of XXH64 (seed 42) over all shingles of words, repeats included, as an unsigned number.

    Fewer words than a shingle has are one shingle; no words give 0.
    """
    votes, n, last = np.zeros(BITS, np.int64), 0, []
    for words in _pieces(text):
        words = last + words
        if len(words) >= shingle:
            for first in range(0, len(words) - shingle + 1, CHUNK):
                votes += _votes(words[first : first + CHUNK + shingle - 1], shingle)
            n += len(words) - shingle + 1
        last = words[-(shingle - 1) :] if shingle > 1 else []
    if not n and last:
        votes, n = _votes(last, len(last)), 1
    bits = (2 * votes > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _votes(words: list[bytes], shingle: int) -> np.ndarray:
    """How many shingles of the words have each bit set."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.cumsum(size) - size
    end = start + size - 1
    text, digest = b" ".join(words), xxhash.xxh64_intdigest
    spans = zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(text[a:b], SEED) for a, b in spans], "<u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp) of every row; fp is the fingerprint as a signed long. Null texts have no words, so their fingerprint is 0."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(got, "<u8").view("<i8"))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, f"id {kind}, fp long")


def ball(bits: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of so many bits."""
    return [sum(1 << b for b in chosen) for k in range(radius + 1) for chosen in combinations(range(bits), k)]


def _keys(fp: Column, masks: list[list[int]]) -> Column:
    """Keys of a fingerprint: number of the half and its value, changed by each mask of that half."""
    halves = [fp.bitwiseAND(F.lit((1 << HALF) - 1)), F.shiftrightunsigned(fp, HALF).bitwiseOR(F.lit(1 << HALF))]
    return F.concat(*(around(half, own) for half, own in zip(halves, masks, strict=True)))


def around(value: Column, masks: list[int]) -> Column:
    """The value, changed by each mask."""
    return F.transform(F.lit(masks).cast("array<long>"), lambda m: value.bitwiseXOR(m))


def links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``radius`` bits of each other, of a frame of distinct ones (fp).

    Of two fingerprints within r bits either the first halves differ by r // 2 at most, or the second ones by less than r - r // 2.
    So each fingerprint enters, for each half, the buckets of all values in a small ball around it; balls of
    half the distance on both sides meet in a bucket. Whole distances are verified there, in a task that holds one bucket (and a
    batch) at a time and returns what connects the bucket, not its pairs.

    A bucket holds at most ``BUCKET`` fingerprints: halves that too many share are counted first (one row a fingerprint, combined
    before the shuffle), and fingerprints with a key near such a half are linked without pairs instead: each enters the
    bucket of every value within radius / 2 of its whole self. Two of them within the radius meet in one of these, and any two that meet
    are within it, so neighbours in such a bucket, which never holds more than a ball, are links. That is exact
    and linear too, but for 2,081 rows a fingerprint instead of 66.
    """
    reach = (radius // 2, (radius - 1) - radius // 2)
    masks = [ball(HALF, -(-r // 2)) for r in reach]
    largest = BUCKET // max(map(len, masks))
    keys = F.explode(_keys(F.col("fp"), masks)).alias("key")
    own = fps.select(F.explode(_keys(F.col("fp"), [[0], [0]])).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowded = written(own.where(F.col("n") > largest).select("key"), "crowded")
    rows = fps.select("fp", keys)
    near = None
    if not crowded.isEmpty():
        hot = crowded.select(F.explode(F.when(F.col("key") < 1 << HALF, around(F.col("key"), masks[0])).otherwise(around(F.col("key"), masks[1]))).alias("key")).distinct()
        hot = written(hot, "hot_keys")
        held = F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot
        heavy = written(rows.join(held, "key", "left_semi").select("fp").distinct(), "heavy")
        rows = rows.join(held, "key", "left_anti")
        middles = heavy.select("fp", F.explode(around(F.col("fp"), [m - (1 << BITS) if m >> BITS - 1 else m for m in ball(BITS, -(-radius // 2))])).alias("middle"))
        before = F.lag("fp").over(Window.partitionBy("middle").orderBy("fp"))
        near = middles.withColumn("b", before).where("b IS NOT NULL").select(F.col("fp").alias("a"), "b").distinct()
        near = near if radius % 2 == 0 else near.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    found = rows.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_verified(radius), "a long, b long").distinct()
    return found if near is None else found.unionByName(near)


def _verified(radius: int):
    """Rows (fp, key) in order of key to links: buckets may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp, key = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            f, k = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "key"))
            fp, key = np.concatenate([fp, f]), np.concatenate([key, k])
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0
            yield _as_batch(connecting(fp[:done], key[:done], radius))
            fp, key = fp[done:], key[done:]
        yield _as_batch(connecting(fp, key, radius))

    return run


def _as_batch(pairs: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(p) for p in pairs], ["a", "b"])


def connecting(fp: np.ndarray, key: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the fingerprints of each bucket (equal keys, in order) within the radius."""
    new = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    size = np.diff(np.append(new, len(key)))
    left, right = [], []
    few = np.flatnonzero((size > 1) & (size <= SMALL))
    n = size[few]
    at = np.repeat(new[few] - (np.cumsum(n) - n), n) + np.arange(n.sum())  # rows of small buckets
    after = np.repeat(np.cumsum(n), n) - np.arange(n.sum())  # rows from each to its bucket's end
    f, root, here = fp[at], np.arange(len(at)), np.arange(len(at))
    for gap in range(1, SMALL):
        here = here[after[here] > gap]
        if not len(here):
            break
        hit = here[np.bitwise_count((f[here] ^ f[here + gap]).view(np.uint64)) <= radius]
        hit = hit[root[hit] != root[hit + gap]]
        if len(hit):
            left.append(f[hit])
            right.append(f[hit + gap])
            least = np.minimum(root[hit], root[hit + gap])
            np.minimum.at(root, hit, least)
            np.minimum.at(root, hit + gap, least)
            for _ in range(SMALL.bit_length() - 1):
                root = root[root]
    for g in np.flatnonzero(size > SMALL):
        a, b = _spread(fp[new[g] : new[g] + size[g]], radius)
        left.append(a)
        right.append(b)
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _spread(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one bucket: from each fingerprint reached to those near it that aren't reached yet."""
    rest, front, left, right = fp, [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while len(rest):
        if not front:
            front, rest = [rest[0]], rest[1:]
        x = front.pop()
        near = np.bitwise_count((rest ^ x).view(np.uint64)) <= radius
        if near.any():
            hit = rest[near]
            left.append(np.full(len(hit), x))
            right.append(hit)
            front.extend(hit)
            rest = rest[~near]
    return np.concatenate(left), np.concatenate(right)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4) -> DataFrame:
    """(id, fp, component_id) of every row: component_id is the smallest id that links of at most ``radius`` differing bits reach.

    Only distinct fingerprints are compared, so exact copies cost nothing after the first. A null text is a text without words (fingerprint
    0, linked like any other). Repeated ids keep their rows; null ids keep theirs, but name no component unless
    nothing else is reached (then it is null). An empty table gives no rows; other columns are ignored.
    """
    rows = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    label = components(links(fps.select("fp"), radius)).withColumnRenamed("node", "fp")
    owners = written(fps.join(label, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "least"), "owners")
    named = written(owners.groupBy("label").agg(F.min("least").alias("component_id")), "named")
    named = written(owners.join(named, "label").select("fp", "component_id"), "components")
    return rows.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_copies(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
