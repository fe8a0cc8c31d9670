"""A bitmap of bounded size that keeps most rows out of a join on a 64-bit id."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spectrail.llm._shared import written
from spectrail.llm._text import mix

#: Least bits of a bitmap (8 KB); bits of a chunk. A bitmap has 16 bits or more for each id.
LEAST_BITS, CHUNK_BITS = 1 << 16, 1 << 18
#: Ids up to which a bitmap is made and broadcast (8 MB at most). Beyond, callers join by shuffle instead.
MOST_IDS = 1 << 22
#: Bits at most (64 MB), for callers that want a bitmap of any number of ids; bits that the driver gets at a time.
MOST_BITS, BITS_AT_ONCE = 1 << 29, 1 << 26


class IdFilter:
    """Tells of an id that it surely isn't, or may be, among the distinct ``ids[column]``; ``bitmap`` is None if they are too many.

    ``most`` None: never too many. Beyond ``MOST_BITS`` the bitmap gets denser instead, so ever more other ids may be among them.
    """

    def __init__(self, ids: DataFrame, column: str, most: int | None = MOST_IDS):
        n = ids.count()
        self.bitmap = None
        if most is not None and n > most:
            return
        bits = LEAST_BITS
        while bits < min(16 * n, MOST_BITS):
            bits *= 2
        chunk_bits = min(bits, CHUNK_BITS)

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = _cell(batch.column(0).drop_null().to_numpy(), bits)
                yield pa.RecordBatch.from_arrays([pa.array((at // chunk_bits).astype(np.int32)), pa.array((at % chunk_bits).astype(np.int32))], ["chunk", "bit"])

        def packed(pdf: pd.DataFrame) -> pd.DataFrame:
            flags = np.zeros(chunk_bits, bool)
            flags[pdf["bit"].to_numpy()] = True
            return pd.DataFrame({"chunk": [int(pdf["chunk"].iloc[0])], "bits": [np.packbits(flags, bitorder="little").tobytes()]})

        # a chunk has at most CHUNK_BITS distinct rows, however many ids there are
        distinct = ids.select(F.col(column).cast("long")).mapInArrow(cells, "chunk int, bit int").distinct()
        chunks = distinct.groupBy("chunk").applyInPandas(packed, "chunk int, bits binary")
        at_once = max(1, BITS_AT_ONCE // chunk_bits)
        if bits > BITS_AT_ONCE:
            chunks = written(chunks, "bitmap")
        bitmap = np.zeros(bits >> 3, np.uint8)
        for first in range(0, bits // chunk_bits, at_once):
            for r in chunks.where(F.col("chunk").between(first, first + at_once - 1)).collect():  # BITS_AT_ONCE at most
                part = np.frombuffer(r["bits"], np.uint8)
                bitmap[r["chunk"] * len(part) : (r["chunk"] + 1) * len(part)] = part
        self.bitmap = ids.sparkSession.sparkContext.broadcast(bitmap)

    def rows(self, df: DataFrame, column: str, maybe: bool) -> DataFrame:
        """Rows of ``df`` whose id may be among the ids, or the others (null ids are among these). Without a bitmap all may be."""
        if self.bitmap is None:
            return df if maybe else df.limit(0)
        bitmap = self.bitmap

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(column)
                found = may_hold(bitmap.value, ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(found == maybe))

        return df.mapInArrow(run, df.schema)


def may_hold(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = _cell(ids, len(bitmap) << 3)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _cell(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids.astype(np.int64, copy=False).view(np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def without(df: DataFrame, ids: DataFrame, column: str, most: int = MOST_IDS) -> DataFrame:
    """``df`` without the rows of the distinct ``ids``: only rows that the bitmap can't clear are shuffled. Null ids stay."""
    known = IdFilter(ids, column, most)
    rest = known.rows(df, column, True).join(ids, column, "left_anti").select(df.columns)
    return known.rows(df, column, False).unionByName(rest)
