"""Several pieces of work at once, on one Spark application."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

Item, Answer = TypeVar("Item"), TypeVar("Answer")
POOL = "spark.scheduler.pool"


def at_once(spark: SparkSession, work: Callable[[Item], Answer], items: Iterable[Item], limit: int) -> list[Answer]:
    """``work`` of every item, at most ``limit`` at a time; answers in the items' order, the first failure is raised.

    Each thread has a scheduler pool of its own, so under ``spark.scheduler.mode=FAIR`` a short piece is not kept waiting
    behind the tasks of a long one.
    """
    items = list(items)
    if limit <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    context = spark.sparkContext

    def run(numbered: tuple[int, Item]) -> Answer:
        number, item = numbered
        before = context.getLocalProperty(POOL)
        context.setLocalProperty(POOL, f"snapflow-{number % limit}")
        try:
            return work(item)
        finally:
            context.setLocalProperty(POOL, before)

    with ThreadPoolExecutor(min(limit, len(items))) as pool:
        return list(pool.map(run, enumerate(items)))
