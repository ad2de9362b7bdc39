"""First source that has rows wins."""

from __future__ import annotations

import logging
import queue
import time
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from incidentia.schemas import CLEAN

NO_DATA = "none"
# Seconds that the tasks of cancelled jobs are waited for. Spark ends a Python
# worker that does not listen after `spark.python.task.killTimeout`, 2 s.
FREED = 10.0
# Seconds without any such task after which there is none: they show up late.
QUIET = 0.5
T = TypeVar("T")


def active_tasks(spark: SparkSession, group: str) -> int:
    """Tasks that jobs of the group still run; cancelled jobs may have some."""
    tracker = spark.sparkContext.statusTracker()
    jobs = filter(None, map(tracker.getJobInfo, tracker.getJobIdsForGroup(group)))
    stages = {stage for job in jobs for stage in job.stageIds}
    return sum(info.numActiveTasks for info in map(tracker.getStageInfo, stages) if info)


def within(spark: SparkSession, seconds: float | None, action: Callable[[], T]) -> T:
    """What ``action`` gives; TimeoutError if it takes longer than ``seconds``.

    Its Spark jobs are cancelled then, and their tasks get ``FREED`` seconds more to
    end, so that what comes next does not wait for their cores. The thread of an action
    that hangs outside of Spark is left to itself.
    """
    if seconds is None:
        return action()
    group, outcome = f"probe-{uuid.uuid4().hex}", queue.SimpleQueue()

    def run() -> None:
        context = spark.sparkContext
        context.setJobGroup(group, "probe under a time limit", interruptOnCancel=True)
        try:
            outcome.put((action(), None))
        except Exception as error:
            outcome.put((None, error))

    InheritableThread(target=run, daemon=True, session=spark).start()
    try:
        found, error = outcome.get(timeout=seconds)
    except queue.Empty:
        spark.sparkContext.cancelJobGroup(group)
        now = seen = time.monotonic()
        latest = now + FREED
        while now < min(latest, seen + QUIET):
            if active_tasks(spark, group):
                seen = now
            time.sleep(0.05)
            now = time.monotonic()
        raise TimeoutError(f"no answer within {seconds} s") from None
    if error is not None:
        raise error
    return found


def load_first(
    spark: SparkSession,
    loaders: Sequence[tuple[str, Callable[[], DataFrame]]],
    schema: StructType = CLEAN,
    *,
    seconds: float | None = None,
) -> DataFrame:
    """Rows of the first loader that works and is not empty, plus ``source``.

    If there is none, an empty table of ``schema``. With ``seconds`` a loader
    that takes longer to give its first row has failed.
    """

    def first_rows(load: Callable[[], DataFrame]) -> DataFrame | None:
        rows = load()
        return None if rows.isEmpty() else rows

    for label, load in loaders:
        try:
            rows = within(spark, seconds, lambda: first_rows(load))  # noqa: B023
            if rows is None:
                continue
        except Exception as error:
            logging.getLogger(__name__).warning("source %s failed: %s", label, error)
            continue
        return rows.withColumn("source", F.lit(label))
    return spark.createDataFrame([], schema).withColumn("source", F.lit(NO_DATA))
