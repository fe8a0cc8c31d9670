"""Scoring of match tables that arrive file by file, through the same caches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from spectrail.operators import cache


def score_arrivals(spark: SparkSession, folder: str, schema: StructType, checkpoint: str, held: cache.Cache, score: Callable[[DataFrame], DataFrame]) -> int:
    """Scores rows of Parquet files not seen before whose key the cache lacks; returns the number of micro-batches.

    A batch that is run again after a failure finds its keys in the cache and adds nothing.
    """
    def step(batch: DataFrame, number: int) -> None:
        new = cache.missing(batch.dropDuplicates([held.key]), held.read(), held.key)
        if not new.isEmpty():
            held.append(score(new))

    query = spark.readStream.schema(schema).parquet(folder).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(query.recentProgress)
