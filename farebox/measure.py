"""Timing and comparison helpers for benches and tests."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame

from farebox.sources.readers import evaluate

# Settings under which only hints choose the join strategy.
NO_PLANNER_CHOICE = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def seconds(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def measure(df: DataFrame, runs: int = 3) -> float:
    """Median seconds of full evaluations into the discard sink."""
    return statistics.median(seconds(lambda: evaluate(df)) for _ in range(runs))


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` held in memory and on disk for a block, filled before the block starts."""
    held = df.persist()
    try:
        held.count()
        yield held
    finally:
        held.unpersist()


def plan_text(df: DataFrame) -> str:
    """The formatted physical plan."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
