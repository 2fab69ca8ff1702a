"""Backups of tables: a copy of each in a folder of its own stamp, with what is needed to trust it again.

``take`` copies the tables' rows with Spark, in parallel, and writes a note last: for each table its columns, number of rows and a sum of row hashes that no order of rows changes.  A backup without its note is not one.
``restore`` reads a backup, compares each table with the note, and only when all agree puts them in the place of the present tables (``store.write_table``: the old one lies aside until the new one is there).
``prune`` keeps the newest backups.

Defined cases: an empty table is a table; columns of any type that Parquet holds come back, maps and variants as their JSON in the sum; a table that the note does not name is refused.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store
from .durable import remove

NOTE = "name string, columns string, rows long, total decimal(38,0)"


class Damaged(ValueError):
    """A backup that does not say what its note does."""


def _row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.to_json(F.struct(c)) if re.search("map<|variant", t) else F.col(c) for c, t in df.dtypes]) if df.columns else F.lit(0)


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """How many rows, and the sum of their hashes: equal for equal rows in any order."""
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(_row_hash(df).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
    return n, int(total)


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in df.dtypes)


def take(spark: SparkSession, tables: dict[str, str], folder: str, stamp: str) -> str:
    """Back up the Parquet tables {name: path} below folder/stamp."""
    at, notes = f"{folder.rstrip('/')}/{stamp}", []
    for name, path in sorted(tables.items()):
        df = spark.read.parquet(path)
        df.write.parquet(f"{at}/{name}")
        n, total = fingerprint(spark.read.schema(df.schema).parquet(f"{at}/{name}"))
        notes.append((name, _columns(df), n, total))
    note = spark.createDataFrame([(a, b, c, str(d)) for a, b, c, d in notes], "name string, columns string, rows long, total string")
    note.withColumn("total", F.col("total").cast("decimal(38,0)")).coalesce(1).write.parquet(f"{at}/note")
    return at


def stamps(spark: SparkSession, folder: str) -> list[str]:
    """The finished backups, oldest first."""
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = jvm.Path(folder)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(place) if fs.exists(jvm.Path(f"{f.getPath().toString()}/note/_SUCCESS")))


def check(spark: SparkSession, backup: str) -> dict[str, DataFrame]:
    """The tables of a backup, each compared with the note."""
    out = {}
    for r in spark.read.schema(NOTE).parquet(f"{backup}/note").collect():  # a row a table
        df = spark.read.schema(r["columns"]).parquet(f"{backup}/{r['name']}")
        if fingerprint(df) != (r["rows"], int(r["total"])):
            raise Damaged(f"{r['name']} is not what was backed up")
        out[r["name"]] = df
    return out


def restore(spark: SparkSession, backup: str, tables: dict[str, str]) -> None:
    """Put the backup's tables in the place of those at {name: path}; nothing is touched if any of them is damaged or missing."""
    found = check(spark, backup)
    if missing := sorted(set(tables) - set(found)):
        raise Damaged(f"the backup has no {', '.join(missing)}")
    for name, path in sorted(tables.items()):
        store.write_table(found[name], path)


def prune(spark: SparkSession, folder: str, keep: int) -> list[str]:
    """Remove all but the newest backups; what went."""
    gone = stamps(spark, folder)[: -keep or None] if keep else stamps(spark, folder)
    for stamp in gone:
        remove(spark, f"{folder.rstrip('/')}/{stamp}")
    return gone
