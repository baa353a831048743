"""Submitting independent Spark jobs at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(work: Callable[[str], None], names: Iterable[str]) -> None:
    """Call ``work`` for every name from threads of the driver; the first failure is raised.

    Each call writes its own table, so Spark can fill idle executors of one job with tasks of
    another. All calls have ended when this returns or raises. Threads keep the job group of the
    caller, so that a stopped stream or a cancelled group takes them along.
    """
    names = list(names)
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
        for done in [pool.submit(inherit(work), name) for name in names]:
            done.result()
