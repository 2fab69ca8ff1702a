"""Mutations on immutable tables: each takes a table and returns what is to be written.

Insert-ignore is an anti-join, so a batch costs one shuffle of both sides' keys (none, where the target is bucketed by the key).
Merges rewrite the target.  ``write_table`` writes beside the old files, moves those aside and then swaps, so a plan never reads what it overwrites and a failure between
loses nothing (the old table lies beside under ``...-old``).  On object stores, where a move is a copy, keep versioned folders instead.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def one_of_each(rows: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row a key by one combining aggregate: of the greatest order, or of those the greatest in all columns that have an order, so that every run takes the same."""
    names = rows.columns
    fixed = [F.col(f.name) for f in rows.schema.fields if f.name not in keys and not re.search("map<|variant|calendar", f.dataType.simpleString())]
    by = F.struct(*(order or []), *fixed) if order or fixed else F.lit(0)
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(names)]), by).alias("_best"))
    return best.select(*[F.col(f"_best.c{k}").alias(c) for k, c in enumerate(names)])


def first_of_batch(rows: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row a key: the first in this order, or the same one in every run."""
    if not order:
        return one_of_each(rows, keys)
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """The rows whose key the target lacks, one a key: append them."""
    return first_of_batch(rows.where(" and ".join(f"`{k}` is not null" for k in keys)), keys, order).join(target.select(*keys), keys, "left_anti").select(*rows.columns)


def merge_partial(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """The target with the updates' non-null values; updates without a match are ignored."""
    columns = columns or [c for c in updates.columns if c not in keys and c in target.columns]
    new = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    new = one_of_each(new, keys)
    joined = target.join(new, keys, "left")
    return joined.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in target.columns])


def ttl_retain(table: DataFrame, ts: str, as_of: Column, window: str) -> DataFrame:
    """What stays after rows older than the window are deleted."""
    return table.where(F.col(ts) >= as_of - F.expr(f"INTERVAL {window}"))


def ttl_null_out(table: DataFrame, ts: str, data: str, as_of: Column, window: str) -> DataFrame:
    """Old rows keep their key and lose their payload, so that work markers stay."""
    return table.withColumn(data, F.when(F.col(ts) >= as_of - F.expr(f"INTERVAL {window}"), F.col(data)))


def delete_where(table: DataFrame, condition: str) -> DataFrame:
    return table.where(~F.coalesce(F.expr(condition), F.lit(False)))


def duplicated(table: DataFrame, key: str) -> DataFrame:
    """Keys on several rows, most first."""
    return table.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy(F.desc("n"), key)


def drop_duplicated(table: DataFrame, key: str) -> DataFrame:
    """Without every row of a key that is on several rows."""
    return table.join(table.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key), key, "left_anti")


def missing(keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Distinct keys that the table lacks."""
    return keys.select(key).subtract(table.select(key))


def union_distinct(*tables: DataFrame) -> DataFrame:
    """Rows of any of the tables, each once; columns by name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.distinct()


def lookup_first(rows: DataFrame, table: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The rows with the first match (in this order) of their key in the table, whose columns are null where there is none."""
    return rows.join(first_of_batch(table, [key], order), key, "left")


def delete_count(table: DataFrame, condition: str) -> DataFrame:
    """How many rows ``delete_where`` takes away, and how many it leaves: n_deleted, n_left."""
    goes = F.coalesce(F.expr(condition), F.lit(False))
    return table.agg(F.count_if(goes).alias("n_deleted"), F.count_if(~goes).alias("n_left"))


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    """Replace the Parquet table at path, whose files the plan may still read."""
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(staged)
    jvm = spark.sparkContext._jvm
    old, new = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(staged)
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{staged}-old")
    had = fs.exists(old)
    if had and not fs.rename(old, aside):  # at every moment the old or the new table is there whole
        raise OSError(f"could not move {path} aside")
    if not fs.rename(new, old):
        if had:
            fs.rename(aside, old)
        raise OSError(f"could not move {staged} to {path}")
    if had:
        fs.delete(aside, True)


def append(df: DataFrame, path: str, *, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def compact(spark: SparkSession, path: str, files: int) -> None:
    """Rewrite a table into fewer, larger files."""
    write_table(spark.read.parquet(path).repartition(files), path)
