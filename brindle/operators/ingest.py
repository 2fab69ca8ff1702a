"""From collected items to clean beans, chatters and publishers, and the triage that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, texts, urls
from . import store

# Fields of an item that a bean does not keep.
NOT_BEAN = ("article_language", "chatter_url", "comments", "description", "favicon", "forum", "likes", "platform", "rss_feed", "site_language", "site_name", "subscribers")
TEXT_FIELDS = ("kind", "source", "platform", "title", "summary", "content", "author", "chatter_url", "base_url", "site_name", "description", "language", "article_language", "site_language", "author_email", "forum")
URL_FIELDS = ("url", "base_url", "favicon", "rss_feed", "image_url", "source", "chatter_url")


def cleanup_items(items: DataFrame, as_of: Column) -> DataFrame:
    """Trim texts, lower urls, drop placeholder authors, fill dates, count words: one projection."""
    have = set(items.columns)
    if "url" in have:
        base = urls.base_url(texts.trimmed(F.col("url")))
        items = items.withColumn("base_url", F.coalesce(F.nullif(F.col("base_url"), F.lit("")), base) if "base_url" in have else base)
        have.add("base_url")
    changes = {c: texts.cleanup_text(F.col(c)) for c in TEXT_FIELDS if c in have}
    changes |= {c: urls.clean(texts.trimmed(F.col(c))) for c in URL_FIELDS if c in have}
    if "author" in have:
        changes["author"] = texts.cleanup_author(F.col("author"))
    collected = F.coalesce(F.col("collected"), as_of) if "collected" in have else as_of
    changes["collected"] = collected
    changes["created"] = F.when(dates.usable(F.col("created"), as_of), F.col("created")).otherwise(collected) if "created" in have else collected
    for c in ("title", "summary", "content"):
        changes[f"{c}_length"] = texts.count_words(F.col(c)) if c in have else F.lit(0)
    return items.withColumns(changes)


def split_items(items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Beans, chatters and publishers of flat items; three projections of one table."""
    have = items.columns
    pick = lambda *cs: [F.col(c) for c in cs if c in have]
    beans = items.select(*[F.col(c) for c in have if c not in NOT_BEAN])
    chatters = items.select(*pick("chatter_url", "url"), *([F.coalesce("platform", "source").alias("source")] if "platform" in have else pick("source")), *pick("forum", "collected", "likes", "comments", "subscribers"))
    publishers = items.select(*pick("source", "base_url", "site_name", "description", "favicon", "rss_feed", "collected"))
    # of a site's rows one that is valid, then the one that says most, then the newest
    says = [F.when(_some(c), 1).otherwise(0) for c in ("site_name", "description", "favicon", "rss_feed") if c in publishers.columns]
    order = [_some("source"), sum(says, F.lit(0)), *([F.col("collected")] if "collected" in have else [])] if "source" in have else says
    return beans, chatters, store.one_of_each(publishers, ["base_url"] if "base_url" in have else ["source"], order)


def _some(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def valid_beans(df: DataFrame) -> DataFrame:
    return df.where(_some("title") & F.col("collected").isNotNull() & F.col("created").isNotNull() & _some("source") & _some("kind"))


def valid_chatters(df: DataFrame) -> DataFrame:
    counted = F.lit(False)
    for c in ("likes", "comments", "subscribers"):
        if c in df.columns:
            counted = counted | F.coalesce(F.col(c) != 0, F.lit(False))
    return df.where(_some("chatter_url") & _some("url") & counted)


def valid_publishers(df: DataFrame) -> DataFrame:
    return df.where(_some("source") & _some("base_url"))


def storable(words: int = 160) -> Column:
    return F.coalesce(F.col("content_length") >= words, F.lit(False)) & ~texts.is_word_game(F.col("title"))


def scrapable(words: int = 160) -> Column:
    return F.coalesce(F.col("kind") != "post", F.lit(True)) & (F.coalesce(F.col("content_length"), F.lit(0)) < words) & ~texts.is_word_game(F.col("title"))


def described() -> Column:
    """A publisher that needs no scraping."""
    return _some("site_name") | _some("favicon") | _some("description")


def triage(beans: DataFrame, words: int = 160) -> DataFrame:
    """Each bean's way: store, scrape or drop."""
    return beans.withColumn("triage", F.when(storable(words), "store").when(scrapable(words), "scrape").otherwise("drop"))


def merge_scraped(beans: DataFrame, scraped: DataFrame, as_of: Column) -> DataFrame:
    """Fill beans from their pages: the longer content, the earlier date, other fields where the bean has none; such content is restricted."""
    s = scraped.select("url", *[F.col(c).alias(f"_s_{c}") for c in scraped.columns if c != "url"])
    # a number of its own keeps Spark from putting partitions together by their compressed size, as texts are many times that in a task's sort
    parts = int(beans.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    j = beans.repartition(parts, "url").join(s.repartition(parts, "url"), "url", "left")
    have = set(beans.columns)
    found = lambda c: F.col(f"_s_{c}") if f"_s_{c}" in j.columns else F.lit(None)
    longer = F.coalesce(F.length(found("content")), F.lit(0)) > F.coalesce(F.length("content"), F.lit(0))
    out = {"content": F.when(longer, found("content")).otherwise(F.col("content")), "restricted_content": F.when(longer, F.lit(True)).otherwise(F.col("restricted_content") if "restricted_content" in have else F.lit(None).cast("boolean"))}
    for c in ("title", "author", "image_url", "summary", "kind"):
        if c in have:
            out[c] = F.coalesce(F.nullif(F.col(c), F.lit("")), found(c))
    if "_s_published_time" in j.columns and "created" in have:
        out["created"] = F.least(F.col("created"), dates.parse(found("published_time"), as_of))
    out["content_length"] = texts.count_words(out["content"])
    return j.withColumns(out).select(*beans.columns, *[c for c in ("restricted_content", "content_length") if c not in have])
