"""Timed lines about a run, on standard error."""

from __future__ import annotations

import sys
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import SparkSession


def say(message: str) -> None:
    print(f"{datetime.now():%Y-%m-%d %H:%M:%S} spectrail: {message}", file=sys.stderr, flush=True)


@contextmanager
def timed(what: str, quiet: bool = False) -> Iterator[None]:
    """Says how long a step took, also if it fails."""
    began = time.perf_counter()
    try:
        yield
    finally:
        if not quiet:
            say(f"{what}: {time.perf_counter() - began:.2f} s")


#: Seconds between two looks at a step's tasks, and the share of them between two lines.
EVERY, STEP = 0.5, 0.1


def share_done(spark: SparkSession, group: str) -> tuple[int, int]:
    """Tasks done and tasks known of all jobs of a group; stages that Spark skips count as done."""
    tracker, done, known = spark.sparkContext.statusTracker(), 0, 0
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in (tracker.getStageInfo(s) for s in (info.stageIds if info else ())):
            if stage:
                known += stage.numTasks
                done += stage.numTasks if info.status == "SUCCEEDED" else stage.numCompletedTasks
    return done, known


@contextmanager
def progressing(spark: SparkSession, what: str) -> Iterator[None]:
    """Says, while a step runs, each tenth of the tasks known so far that is done: the jobs of this thread, under a group of their own.

    Spark adds tasks as it plans, so shares may stand still; they are never told twice or backwards.
    """
    context, group, over = spark.sparkContext, uuid.uuid4().hex, threading.Event()
    before = context.getLocalProperty("spark.jobGroup.id"), context.getLocalProperty("spark.job.description")

    def watch() -> None:
        told = 0.0
        while not over.wait(EVERY):
            done, known = share_done(spark, group)
            if known and (share := int(done / known / STEP + 1e-9) * STEP) > told + 1e-9:
                told = share
                say(f"{what}: {share:.0%} of {known} tasks")

    context.setJobGroup(group, what)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    finally:
        over.set()
        watcher.join()
        context.setLocalProperty("spark.jobGroup.id", before[0])
        context.setLocalProperty("spark.job.description", before[1])
