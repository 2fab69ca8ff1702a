"""The engine's logical tables over the star schema's files; the present of all of them is 1 February 2024."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-02-01"
NEAR = 1.15


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def state(spark: SparkSession, d: str) -> DataFrame:
    """An id a user and day, an event type as state, the first event's props as payload."""
    e = table(spark, d, "events")
    key = F.concat(F.col("user_id").cast("string"), F.lit("@"), F.to_date("ts").cast("string"))
    return e.groupBy(key.alias("id"), F.col("event_type").alias("state")).agg(F.min("ts").alias("ts"), F.min_by("props", F.struct("ts", "event_id")).alias("data"))


def chatters(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    talk = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.col("event_type"))
    return e.select(talk.alias("chatter_url"), F.concat(F.lit("doc://"), (F.col("user_id") % 40).cast("string")).alias("url"), F.col("event_type").alias("source"), F.col("ts").alias("collected"), F.floor("value").cast("long").alias("likes"), F.get_json_object("props", "$.k").cast("long").alias("comments"), F.lit(0).cast("long").alias("subscribers"), F.lit(0).cast("long").alias("shares"))


def beans(spark: SparkSession, d: str, content: bool = True) -> DataFrame:
    doc = table(spark, d, "documents")
    created = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01").cast("timestamp")) + (F.col("doc_id") % 30) * 86400)
    vec = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", "label")
    j = doc.join(vec, "doc_id", "left")
    return j.select(F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"), "doc_id", "source", F.when(F.col("doc_id") % 3 == 0, "blog").otherwise("news").alias("kind"), *([F.col("text").alias("content")] if content else []), created.alias("created"), F.array("lang").alias("categories"), F.array(F.concat(F.lit("topic "), F.coalesce("label", F.lit(-1)).cast("string")), F.initcap("source")).alias("entities"), F.array(F.when(F.col("lang") == "en", "World").otherwise("Europe")).alias("regions"), "embedding")


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def related(spark: SparkSession, d: str, kept: bool = False) -> DataFrame:
    """Directed edges between vectors within NEAR of each other.  Pairs are searched for each time that the result is read; ``kept`` ones are written once, for plans that read them more than once."""
    from ..operators.durable import Tables
    from ..operators.graph import both_ways
    from ..operators.search import radius_pairs

    p = radius_pairs(vectors(spark, d), NEAR).select("a", "b")
    both = both_ways(Tables(spark, "related").cut(p) if kept else p, "a", "b")
    name = lambda c: F.concat(F.lit("doc://"), F.col(c).cast("string"))
    return both.select(name("a").alias("url"), name("b").alias("related_url"))


def publishers(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "documents").select("source").distinct()
    return s.select("source", F.concat("source", F.lit(".example.com")).alias("base_url"), F.initcap("source").alias("site_name"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("favicon"), F.lit(None).cast("string").alias("rss_feed"))
