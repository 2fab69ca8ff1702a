"""From merged states to rows of the serving stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import texts, urls
from . import store

RENAMED = {"briefing": "summary", "events": "key_points"}


def _arr(df: DataFrame, c: str) -> Column:
    return F.coalesce(F.col(c), F.array().cast("array<string>")) if c in df.columns else F.array().cast("array<string>")


def beans(merged: DataFrame) -> DataFrame:
    """Entities of all fields in one list, regions apart; a creation date after the collection date becomes it."""
    df = merged.withColumn("entities", texts.merge_lists(*[_arr(merged, c) for c in ("entities", "people", "companies", "products", "stock_tickers") if c in merged.columns] or [F.array().cast("array<string>")]))
    if "regions" in merged.columns:
        df = df.withColumn("regions", texts.merge_lists(F.col("regions")))
    if {"created", "collected"} <= set(merged.columns):
        df = df.withColumn("created", F.coalesce(F.least("created", "collected"), "collected"))
    return df.drop("people", "companies", "products", "stock_tickers")


def sampled_tags(tags: Column, most: int = 50, seed: str = "") -> Column:
    """At most so many tags, drawn by hash, so a rerun draws the same."""
    by = F.transform(tags, lambda t: F.struct(F.xxhash64(F.concat(F.lit(seed), t)).alias("h"), t.alias("t")))
    return F.when(F.size(tags) <= most, tags).otherwise(F.transform(F.slice(F.array_sort(by), 1, most), lambda s: s["t"]))


def _digest(df: DataFrame, fields: list[str]) -> Column:
    """JSON of the digest's fields, under their serving names, without null ones."""
    return F.to_json(F.struct(*[F.col(c).alias(RENAMED.get(c, c)) for c in fields if c in df.columns]))


def events(merged: DataFrame, *, digest_fields: list[str], tag_fields: list[str], max_tags: int = 50, vector_len: int | None = None) -> DataFrame:
    """Sips of kind event; those without a digest, or with a wrong vector, go."""
    df = merged.where(F.coalesce(*[F.col(c).isNotNull() for c in digest_fields if c in merged.columns], F.lit(False)))
    if vector_len:
        df = df.where(F.size("embedding") == vector_len)
    tags = sampled_tags(texts.merge_tags(*[_arr(df, c) for c in tag_fields]), max_tags)
    return df.select(urls.uuid5(F.col("url")).alias("id"), F.lit("event").alias("kind"), *[c for c in ("source", "url", "base_url", "created", "embedding") if c in df.columns], tags.alias("tags"), _digest(df, digest_fields).alias("digest"), F.to_date("created").alias("ts"))


def signals(merged: DataFrame, *, prefix: str, digest_fields: list[str], tag_fields: list[str], max_tags: int = 50) -> DataFrame:
    """Sips of kind signal, whose url is a prefix and the id."""
    df = merged.withColumn("url", F.concat(F.lit(prefix), F.col("id")))
    tags = sampled_tags(texts.merge_tags(*[_arr(df, c) for c in tag_fields]), max_tags)
    return df.select(urls.uuid5(F.col("url")).alias("id"), F.lit("signal").alias("kind"), F.lit(None).cast("string").alias("source"), "url", F.lit(None).cast("string").alias("base_url"), *[c for c in ("created", "embedding") if c in df.columns], tags.alias("tags"), _digest(df, digest_fields).alias("digest"), F.to_date("created").alias("ts"))


def sources(merged: DataFrame, as_of: Column) -> DataFrame:
    """Publishers under their serving names."""
    return merged.select(urls.uuid5(F.col("base_url")).alias("id"), "base_url", F.col("source").alias("domain_name"), *[c for c in ("site_name", "description", "favicon", "rss_feed") if c in merged.columns], F.to_date(as_of).alias("ts")).dropDuplicates(["id"])


def chatters(packed: DataFrame) -> DataFrame:
    """{id, chatters: [...]} -> one row a snapshot."""
    return packed.select(F.explode("chatters").alias("c")).select("c.*")


def storable_sips(target: DataFrame, sips: DataFrame, vector_len: int) -> DataFrame:
    rows = sips.where((F.size("embedding") == vector_len) & F.coalesce(F.col("digest") != "", F.lit(False)) & (F.col("digest") != "{}"))
    return store.insert_ignore(target, rows, ["id"])


def render(df: DataFrame, fields: list[str]) -> Column:
    """A prompt text: ``field: value`` lines in this order, lists joined, null and empty ones left out."""
    lines = []
    kinds = dict(df.dtypes)
    for f in fields:
        if f in kinds:
            v = F.array_join(F.col(f), ", ") if kinds[f].startswith("array") else F.date_format(f, "yyyy-MM-dd") if kinds[f] in ("timestamp", "date") else F.col(f).cast("string")
            lines.append(F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{f}: "), v)))
    return F.concat_ws("\n", *lines)


def render_groups(df: DataFrame, group_col: str, fields: list[str], order: list[str]) -> DataFrame:
    """One text a group: its members' texts in order, between blank lines.  Groups are of bounded size (see chunk_groups)."""
    rows = df.select(group_col, F.struct(*[F.col(c) for c in order], render(df, fields).alias("_text")).alias("m"))
    return rows.groupBy(group_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["_text"]), "\n\n").alias("text"))
