"""Cutting lineage in a folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, which ``spark.checkpoint.dir`` names; only a local session without one gets a folder of its own."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="brindle-")
    sc.setCheckpointDir(folder)
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder, so that a lost executor loses nothing of them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reaches."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Tables:
    """Intermediate tables in the shared folder, all of which ``close`` removes.

    As written tables have a known size and are read in as many tasks as that needs, a small one costs few tasks, and Spark broadcasts it by its own rule.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0

    def cut(self, df: DataFrame) -> DataFrame:
        self.n += 1
        df.write.parquet(f"{self.folder}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{self.n}")

    def last_bytes(self) -> int:
        """The size of the last table."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{self.n}")
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(place).getLength()

    def close(self) -> None:
        remove(self.spark, self.folder)
