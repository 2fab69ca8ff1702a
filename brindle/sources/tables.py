"""Readers and writers by format, and point files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READERS: dict[str, Callable[..., DataFrame]] = {}
WRITERS: dict[str, Callable[..., None]] = {}
#: Other names of a format.
ALIASES = {"pq": "parquet", "pg": "jdbc", "postgres": "jdbc", "postgresql": "jdbc"}


def _plain(fmt: str) -> None:
    READERS[fmt] = lambda spark, path, schema=None, **o: (spark.read.schema(schema) if schema else spark.read).format(fmt).options(**o).load(path)
    WRITERS[fmt] = lambda df, path, mode="append", partition_by=(), **o: df.write.format(fmt).mode(mode).options(**o).partitionBy(*partition_by).save(path)


for _f in ("parquet", "orc", "json", "csv"):
    _plain(_f)
READERS["table"] = lambda spark, name, **_: spark.table(name)
WRITERS["table"] = lambda df, name, mode="append", **_: df.write.mode(mode).saveAsTable(name)
READERS["jdbc"] = lambda spark, url, **o: spark.read.format("jdbc").options(url=url, **o).load()
WRITERS["jdbc"] = lambda df, url, mode="append", **o: df.write.format("jdbc").mode(mode).options(url=url, **o).save()
READERS["yaml"] = lambda spark, path, **_: catalogue(spark, path)


def read(spark: SparkSession, fmt: str, path: str, **options) -> DataFrame:
    return READERS[ALIASES.get(fmt, fmt)](spark, path, **options)


def write(df: DataFrame, fmt: str, path: str, **options) -> None:
    WRITERS[ALIASES.get(fmt, fmt)](df, path, **options)


def copy(spark: SparkSession, source: tuple[str, str], target: tuple[str, str], *, since: str | None = None, ts_col: str = "collected", key: str | None = None) -> None:
    """One table from store to store; with a key only rows whose key the target lacks."""
    df = read(spark, *source)
    if since:
        df = df.where(F.col(ts_col) >= F.lit(since).cast("timestamp"))
    if key:
        from ..operators.store import insert_ignore

        df = insert_ignore(read(spark, *target), df, [key])
    write(df, *target)


def catalogue(spark: SparkSession, source: str) -> DataFrame:
    """A feed catalogue ``sources: {type: [path, ...]}`` from a YAML file or an inline text: type, path."""
    text = source
    if "\n" not in source:
        rows = spark.read.text(source, wholetext=True).limit(1).collect()
        text = rows[0][0] if rows else ""
    try:
        import yaml

        found = (yaml.safe_load(text) or {}).get("sources", {})
    except ImportError:
        found = _simple_yaml(text)
    return spark.createDataFrame([(k, p) for k, own in found.items() for p in own or ()], "type string, path string")


def _simple_yaml(text: str) -> dict[str, list[str]]:
    """The catalogue's own form only: a key, then dashes."""
    out: dict[str, list[str]] = {}
    key = None
    for line in text.split("\n"):
        bare = line.split(" #", 1)[0].rstrip()
        if bare.strip().startswith("- ") and key:
            out[key].append(bare.strip()[2:].strip().strip("'\""))
        elif bare.endswith(":") and bare.startswith(" "):
            key = bare.strip()[:-1]
            out[key] = []
    return out


def shuffled(df: DataFrame, seed: int) -> DataFrame:
    """Rows in an order that the seed decides."""
    return df.orderBy(F.xxhash64(*df.columns, F.lit(seed)))


def labels(spark: SparkSession, path: str) -> DataFrame:
    """A label index: id, embedding."""
    df = spark.read.parquet(path)
    return df.withColumnRenamed(next(c for c in df.columns if c != "embedding"), "id")


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Whole files: path, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


def upload(df: DataFrame, folder: str, *, name_col: str, body_col: str) -> None:
    """Texts as one file a row below folder/name=..., through Spark's writer and so to any store."""
    df.select(F.col(name_col).alias("name"), F.col(body_col).cast("string").alias("value")).write.mode("append").option("maxRecordsPerFile", 1).partitionBy("name").text(folder)
