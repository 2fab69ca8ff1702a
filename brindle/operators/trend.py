"""Engagement trends, cluster representatives and the joined views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def peak_snapshots(chatters: DataFrame) -> DataFrame:
    """Snapshots at the first time that both maxima of a chatter stand in one snapshot; a chatter where they never do drops out.

    One combining aggregate finds the maxima and the first of the best snapshots; snapshots then meet only the chatters' peaks.
    """
    back = -F.unix_micros(F.col("collected").cast("timestamp"))
    some = chatters.where("likes is not null and comments is not null").groupBy("chatter_url")
    top = some.agg(F.max_by("collected", F.struct("likes", "comments", back)).alias("collected"), F.max(F.struct("likes", "comments")).alias("best"), F.max("likes").alias("likes"), F.max("comments").alias("comments"))
    peaks = top.where((F.col("best.likes") == F.col("likes")) & (F.col("best.comments") == F.col("comments"))).select("chatter_url", "collected")
    return chatters.join(peaks, ["chatter_url", "collected"])


def chatter_stats(chatters: DataFrame, key: str = "url", count_shares: bool = False) -> DataFrame:
    """Sums by item over the peak snapshots; shares are summed, or with count_shares are the number of snapshots."""
    rows = peak_snapshots(chatters)
    shares = F.count("chatter_url") if count_shares else F.sum("shares")
    return rows.groupBy(key).agg(F.to_date(F.max("collected")).alias("updated"), F.sum("likes").alias("likes"), F.sum("comments").alias("comments"), F.sum("subscribers").alias("subscribers"), shares.alias("shares"))


def trend_score(related: Column, comments: Column, shares: Column, likes: Column, updated: Column, as_of: Column, whole: bool = False) -> Column:
    """Weighted engagement over age in days plus 2; null where that is 0; with whole it is cut to a whole number."""
    total = 100 * related + 50 * comments + 10 * shares + likes
    score = F.try_divide(total.cast("double"), (F.datediff(as_of, updated) + 2).cast("double"))
    return F.when(score >= 0, F.floor(score)).otherwise(F.ceil(score)).cast("double") if whole else score


def trend_aggregates(beans: DataFrame, chatters: DataFrame, related: DataFrame, as_of: Column, *, key: str = "url", related_key: str = "url", count_shares: bool = False, whole: bool = False) -> DataFrame:
    """One row for each item with likes, comments, shares or related items."""
    stats, edges = chatter_stats(chatters, key, count_shares), related.groupBy(F.col(related_key).alias(key)).agg(F.count(F.lit(1)).alias("related"))
    joined = beans.select(key, F.to_date("created").alias("_day")).join(edges, key, "left").join(stats, key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    rows = joined.select(key, *[zero(c) for c in ("likes", "comments", "subscribers", "shares", "related")], F.greatest("_day", F.coalesce("updated", "_day")).alias("updated"))
    rows = rows.where(F.greatest("likes", "comments", "shares", "related") > 0)
    return rows.withColumn("trend_score", trend_score(*[F.col(c) for c in ("related", "comments", "shares", "likes", "updated")], as_of, whole))


def representatives(related: DataFrame, *, key: str = "url", other: str = "related_url") -> DataFrame:
    """Of each item and those it points to, the one that most items point to; ties by name."""
    degree = related.groupBy(F.col(other).alias("candidate")).agg(F.count(F.lit(1)).alias("freq"))
    # the least of a set, so that repeated edges need no distinct
    sides = related.select(F.col(key), F.col(other).alias("candidate")).unionByName(related.select(F.col(key), F.col(key).alias("candidate")).distinct())
    best = F.min(F.struct((-F.coalesce("freq", F.lit(0))).alias("f"), F.col("candidate").alias("c")))
    # a hash of the few degrees in each task: edges need not be sorted
    return sides.join(degree.hint("shuffle_hash"), "candidate", "left").groupBy(key).agg(best.alias("b")).select(key, F.col("b.c").alias("cluster_id"), (-F.col("b.f")).alias("freq"))


def trending_view(beans: DataFrame, trends: DataFrame, key: str = "url") -> DataFrame:
    return beans.join(trends, key)


def sources_view(beans: DataFrame, publishers: DataFrame) -> DataFrame:
    """Items with what is known of their publisher; Spark broadcasts publishers where their measured size allows."""
    return beans.join(publishers.select("source", "base_url", "site_name", "description", "favicon", "rss_feed"), "source", "left")


def aggregated_view(beans: DataFrame, trends: DataFrame, related: DataFrame, publishers: DataFrame) -> DataFrame:
    groups = related.groupBy("url").agg(F.sort_array(F.collect_list("related_url")).alias("related_urls"))
    return sources_view(beans.join(trends, "url", "left").join(groups, "url", "left"), publishers)


def top_per_group(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= k)
