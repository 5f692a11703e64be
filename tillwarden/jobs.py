"""Independent Spark actions at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def run_together(actions: list[Callable[[], None]], at_once: int = 4) -> None:
    """Run actions that do not depend on each other; the first error is raised.

    The cluster fills the gaps at the end of one job with tasks of the next.
    Job group and scheduler pool of the caller carry over to the threads.
    """
    carry = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        for done in [pool.submit(carry(a)) for a in actions]:
            done.result()
