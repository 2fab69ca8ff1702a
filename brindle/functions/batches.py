"""Small Arrow batches for long texts."""

from __future__ import annotations

from pyspark.sql import SparkSession

ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Have Spark send texts to Python in batches of 4 MB rather than of 10,000 rows; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key, "67108864")).rstrip("b") or 0) > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))
