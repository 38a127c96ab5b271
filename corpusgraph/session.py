"""Session defaults."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "corpusgraph", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with UTC timestamps and adaptive execution on.

    ``master`` is only for local runs; on a cluster it comes from spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def side_by_side(job: Callable, items: Iterable) -> list:
    """``job`` of each of a few items, submitted to Spark at the same time: the stages of
    one fill the cores that those of another leave idle."""
    listed = list(items)
    run = inheritable_thread_target(SparkSession.active())(job)
    with ThreadPoolExecutor(max(1, len(listed))) as pool:
        return list(pool.map(run, listed))
