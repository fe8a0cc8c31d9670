"""Python workers must find this package, also where only the driver's ``sys.path`` names its folder."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[1])
#: Bytes of an Arrow batch, where the session has Spark's default: texts come in long rows.
BATCH, BATCH_BYTES, DEFAULT_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 8 << 20, 64 << 20


def locate(spark: SparkSession) -> SparkSession:
    """Put the package's folder on the path of the workers started from now on, and bound their batches by bytes."""
    if spark.conf.get(BATCH).rstrip("b") == str(DEFAULT_BYTES):
        spark.conf.set(BATCH, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *have])
    return spark
