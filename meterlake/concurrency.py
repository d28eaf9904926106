"""Independent Spark jobs side by side, so that short ones do not leave the cluster waiting."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")

MAX_TOGETHER = 8


def together(spark: SparkSession, jobs: Sequence[Callable[[], Result]]) -> list[Result]:
    """Results of all jobs, in order; the first failure is raised."""
    with ThreadPool(min(MAX_TOGETHER, len(jobs))) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs], chunksize=1)
