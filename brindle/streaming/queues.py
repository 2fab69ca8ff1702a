"""The work queue as a stream: new state rows are handled in micro-batches, and what is written is insert-ignored, so a retry changes nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import store
from ..schemas import STATE


def read_state(spark: SparkSession, path: str, *, max_files: int = 1000) -> DataFrame:
    """State rows as they are appended; max_files a trigger is the back-pressure."""
    return spark.readStream.schema(STATE).option("maxFilesPerTrigger", max_files).parquet(path)


def first_writes(rows: DataFrame, delay: str = "1 day") -> DataFrame:
    """One row an (id, state) within the watermark."""
    return rows.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["id", "state"])


def worker(source: DataFrame, path: str, include: str, done: str, work: Callable[[DataFrame], DataFrame], checkpoint: str, as_of: Callable[[], Column] = F.current_timestamp) -> StreamingQuery:
    """Run ``work`` on ids that reach a state and append its rows (id, data) under the done state.

    A batch that failed is handled again; rows that it had written are ignored then.
    """

    def handle(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        stored = spark.read.schema(STATE).parquet(path)
        todo = batch.where(F.col("state") == include).join(stored.where(F.col("state") == done).select("id"), "id", "left_anti")
        made = work(todo).select("id", "data")
        rows = made.select(F.lit("beans").alias("object_type"), "id", F.lit(done).alias("state"), as_of().alias("ts"), "data")
        store.append(store.insert_ignore(stored, rows, ["id", "state"]).select("object_type", "id", "state", "ts", "data"), path)

    return source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sliding_counts(rows: DataFrame, *, window: str = "1 day", slide: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """State changes in each window, late rows up to the delay."""
    return rows.withWatermark("ts", delay).groupBy(F.window("ts", window, slide), "state").agg(F.count(F.lit(1)).alias("n"))
