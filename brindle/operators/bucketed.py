"""A target table bucketed by its key, so that an insert-ignore shuffles the batch alone.

``create`` makes an external table of Parquet in buckets by the key's hash.  In ``insert_ignore`` the batch is dealt by the same hash to as many partitions, each meets its bucket where it lies, and what is new is appended to
the buckets that it belongs to.  The target is never shuffled, and buckets without new rows get no file.
``compact`` writes the buckets anew, each as one sorted file, when batches have left many.

Defined cases: rows with a null key are left out; of a batch's rows with one key the one that ``store.one_of_each`` takes; a repeated batch adds nothing; an empty batch writes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store


def _quoted(names: list[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def create(spark: SparkSession, table: str, path: str, schema: str, keys: list[str], *, buckets: int = 64) -> None:
    """Name the table in this session's catalogue; rows that a folder already holds stay."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({schema}) USING parquet CLUSTERED BY ({_quoted(keys)}) SORTED BY ({_quoted(keys)}) INTO {buckets} BUCKETS LOCATION '{path}'")


def _about(spark: SparkSession, table: str) -> tuple[list[str], int]:
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED `{table}`").collect()}
    return [k.strip(" `") for k in told["Bucket Columns"].strip("[]").split(",")], int(told["Num Buckets"])


def new_rows(spark: SparkSession, table: str, rows: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """The batch's rows whose key the table lacks, one a key."""
    keys, buckets = _about(spark, table)
    batch = store.first_of_batch(rows.where(" and ".join(f"`{k}` is not null" for k in keys)), keys, order).select(*spark.table(table).columns)
    return batch.repartition(buckets, *keys).join(spark.table(table).select(*keys).hint("merge"), keys, "left_anti").select(*batch.columns)


def insert_ignore(spark: SparkSession, table: str, rows: DataFrame, order: list[Column] | None = None) -> None:
    """Append what is new."""
    keys, buckets = _about(spark, table)
    made = new_rows(spark, table, rows, order)
    made.write.format("parquet").mode("append").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    spark.catalog.refreshTable(table)


def compact(spark: SparkSession, table: str, path: str) -> str:
    """One file a bucket: the rows go through a table beside, which takes the first one's place in the catalogue; the new folder."""
    keys, buckets = _about(spark, table)
    fresh, at = f"{table}_{uuid.uuid4().hex}", f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    rows = spark.table(table)
    rows.repartition(buckets, *keys).write.format("parquet").option("path", at).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(fresh)
    spark.sql(f"DROP TABLE `{table}`")  # external: its files stay until they are removed
    spark.sql(f"ALTER TABLE `{fresh}` RENAME TO `{table}`")
    return at


def count(spark: SparkSession, table: str) -> int:
    return spark.table(table).agg(F.count(F.lit(1))).first()[0]
