"""Independent jobs side by side, so that small ones do not leave the cluster idle."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(spark: SparkSession, jobs: Mapping[Hashable, Callable], parallel: int) -> dict:
    """The result of every job. One that fails does not stop the others; at the end all failures are raised."""
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()}
    failures = [run.exception() for run in running.values() if run.exception() is not None]
    if failures:
        raise ExceptionGroup("some jobs failed", failures)
    return {name: run.result() for name, run in running.items()}
