"""Trends that are refreshed by what has changed.

A batch of snapshots touches the chatters it names; a chatter's peak may move between items, so it touches every item that those chatters ever spoke of, and edges and new items touch theirs.  ``refresh`` reads the parts
of the touched chatters and items alone, makes their peaks and sums anew, and replaces just the parts that hold touched items.  The score depends on the day, so the table keeps what it is made of
and ``trends`` scores on reading.

After any batches the table equals ``trend.trend_aggregates`` over all rows.  Defined cases: rows without their key are left out, as there; an item that comes again keeps its first date; repeated snapshots count as rows, as there; an empty
batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import trend
from .durable import Tables
from .parted import Change, Parted

_COUNTS = "likes long, comments long, subscribers long, shares long"
TABLES = {
    "chatters": ("chatter_url", f"chatter_url string, url string, collected timestamp, {_COUNTS}"),
    "peaks": ("url", f"chatter_url string, url string, collected timestamp, {_COUNTS}"),
    "related": ("url", "url string, related_url string"),
    "days": ("url", "url string, created timestamp"),
    "trends": ("url", f"url string, {_COUNTS}, related long, updated date"),
}


def _columns(df: DataFrame | None, name: str, spark: SparkSession) -> DataFrame:
    key, schema = TABLES[name]
    empty = spark.createDataFrame([], schema)
    if df is None:
        return empty
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in empty.schema]).where(F.col(key).isNotNull())


class TrendStore:
    def __init__(self, spark: SparkSession, path: str, *, parts: int = 64) -> None:
        self.spark, self.store = spark, Parted(spark, path, TABLES, parts=parts)

    def refresh(self, chatters: DataFrame | None = None, related: DataFrame | None = None, beans: DataFrame | None = None) -> list[int]:
        """Take in new rows; the parts of the trends that were written anew."""
        store, tables = self.store, Tables(self.spark, "trends")
        new, edges, days = (tables.cut(_columns(df, name, self.spark)) for df, name in ((chatters, "chatters"), (related, "related"), (beans, "days")))
        talk = tables.cut(new.select("chatter_url").distinct())
        # all snapshots, old and new, of the touched chatters
        snapshots = tables.cut(store.read("chatters", store.touched(talk)).join(talk, "chatter_url", "left_semi").unionByName(new))
        keys = tables.cut(snapshots.select("url").unionByName(edges.select("url")).unionByName(days.select("url")).where("url is not null").distinct())
        parts = store.touched(keys)
        if not parts:
            if not new.isEmpty():
                store.commit({"chatters": Change(new)})
            tables.close()
            return []
        peaks = store.read("peaks", parts).join(talk, "chatter_url", "left_anti").unionByName(trend.peak_snapshots(snapshots).where("url is not null").select(*store.read("peaks", []).columns))
        peaks = tables.cut(peaks)
        mine = lambda df: df.join(keys, "url", "left_semi")
        stats = mine(peaks).groupBy("url").agg(F.to_date(F.max("collected")).alias("updated"), *[F.sum(c).alias(c) for c in ("likes", "comments", "subscribers", "shares")])
        counts = mine(store.read("related", parts).unionByName(edges)).groupBy("url").agg(F.count(F.lit(1)).alias("related"))
        known = store.read("days", parts)
        first = tables.cut(days.groupBy("url").agg(F.min("created").alias("created")).join(known, "url", "left_anti"))
        dated = mine(known.unionByName(first)).select("url", F.to_date("created").alias("day"))
        joined = dated.join(counts, "url", "left").join(stats, "url", "left")
        zero = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("likes", "comments", "subscribers", "shares", "related")]
        rows = joined.select("url", *zero, F.greatest("day", F.coalesce("updated", "day")).alias("updated"))
        rows = rows.where(F.greatest("likes", "comments", "shares", "related") > 0)
        trends = store.read("trends", parts).join(keys, "url", "left_anti").unionByName(rows)
        store.commit({"chatters": Change(new), "related": Change(edges), "days": Change(first), "peaks": Change(peaks, parts), "trends": Change(trends, parts)})
        tables.close()
        return parts

    def trends(self, as_of: Column, whole: bool = False) -> DataFrame:
        """The trends with their scores of a day."""
        score = trend.trend_score(*[F.col(c) for c in ("related", "comments", "shares", "likes", "updated")], as_of, whole)
        return self.store.read("trends").withColumn("trend_score", score)
