"""Run-time figures of a query without a second pass."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows; after an action the observation has their number."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


@contextmanager
def timed(report: Callable[[str, float, float | None], None], name: str, items: Callable[[], int] | None = None):
    """Report a block's seconds, and its seconds an item where their number is known after it."""
    began = time.perf_counter()
    yield
    took = time.perf_counter() - began
    n = items() if items else 0
    report(name, took, took / n if n else None)
