"""One query builder for all stores: scalar, range, overlap and full-text filters, vector distance, order and page."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import texts, vectors


@dataclass(frozen=True)
class QuerySpec:
    """Ranges are a lower bound, or a pair of bounds that both belong; ``distance`` is used where it is set, with ``embedding``."""

    urls: list[str] | None = None
    kind: str | list[str] | None = None
    created: Any = None
    collected: Any = None
    updated: Any = None
    categories: list[str] | None = None
    regions: list[str] | None = None
    entities: list[str] | None = None
    tags: list[str] | None = None
    tags_mode: str = "any"
    sources: list[str] | None = None
    embedding: list[float] | None = None
    metric: str = "cosine"
    distance: float | None = None
    conditions: list[str] = field(default_factory=list)
    equals: dict[str, Any] = field(default_factory=dict)
    order: list[Column] = field(default_factory=list)
    limit: int = 0
    offset: int = 0
    columns: list[str] | None = None


def _range(column: Column, value) -> Column:
    if isinstance(value, (tuple, list)):
        return column.between(value[0], value[1])
    return column >= F.lit(value)


def overlaps(column: str, values: list[str]) -> Column:
    return F.arrays_overlap(F.col(column), F.array(*[F.lit(v) for v in values]))


def _any_tag(df: DataFrame, values: list[str]) -> Column:
    hit = F.lit(False)
    for c in ("regions", "entities", "categories", "tags"):
        if c in df.columns:
            hit = hit | F.coalesce(overlaps(c, values), F.lit(False))
    return hit


def all_tags(df: DataFrame, values: list[str]) -> Column:
    """Every word of the values is a word of the rows' regions, entities, categories or tags."""
    return texts.has_all_lexemes(texts.tags_to_text(*[F.col(c) for c in ("regions", "entities", "categories", "tags") if c in df.columns]), values)


def filtered(df: DataFrame, q: QuerySpec) -> DataFrame:
    """All conditions but distance.  Plain comparisons come first, as they reach the scan."""
    if q.urls:
        df = df.where(F.col("url").isin(q.urls))
    if q.kind:
        df = df.where(F.col("kind").isin(q.kind) if isinstance(q.kind, (list, tuple)) else F.col("kind") == q.kind)
    for name in ("created", "collected", "updated"):
        if (value := getattr(q, name)) is not None:
            df = df.where(_range(F.col(name), value))
    if q.sources:
        df = df.where(F.col("source").isin(q.sources))
    for name, value in q.equals.items():
        df = df.where(F.col(name).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    for c in q.conditions:
        df = df.where(F.expr(c))
    for name in ("categories", "regions", "entities"):
        if value := getattr(q, name):
            df = df.where(overlaps(name, value))
    if q.tags:
        df = df.where(_any_tag(df, q.tags) if q.tags_mode == "any" else all_tags(df, q.tags))
    return df


def select(df: DataFrame, q: QuerySpec) -> DataFrame:
    """Filter, then distance, then order, page and project.  With an embedding the nearest come first."""
    df = filtered(df, q)
    order = list(q.order)
    if q.embedding is not None:
        df = df.withColumn("distance", vectors.METRICS[q.metric](F.col("embedding"), vectors.literal(q.embedding)))
        if q.distance:
            df = df.where(F.col("distance") <= q.distance)
        order.insert(0, F.col("distance").asc_nulls_last())
    if order:
        df = df.orderBy(*order)
    if q.offset:
        df = df.offset(q.offset)
    if q.limit:
        df = df.limit(q.limit)
    if q.columns:
        extra = ["distance"] if q.embedding is not None and "distance" not in q.columns else []
        df = df.select(*q.columns, *extra)
    return df


def _ordered(q: QuerySpec, *order: Column) -> QuerySpec:
    from dataclasses import replace

    return q if q.order else replace(q, order=list(order))


def latest(beans: DataFrame, q: QuerySpec = QuerySpec()) -> DataFrame:
    return select(beans, _ordered(q, F.col("created").desc_nulls_last(), F.col("url")))


def trending(view: DataFrame, q: QuerySpec = QuerySpec()) -> DataFrame:
    return select(view, _ordered(q, F.col("trend_score").desc_nulls_last(), F.col("url")))


def aggregated(view: DataFrame, q: QuerySpec = QuerySpec()) -> DataFrame:
    return select(view, _ordered(q, F.col("created").desc_nulls_last(), F.col("url")))


def publishers(table: DataFrame, q: QuerySpec = QuerySpec()) -> DataFrame:
    return select(table, _ordered(q, F.col("source")))


def chatters(table: DataFrame, q: QuerySpec = QuerySpec()) -> DataFrame:
    return select(table, q)


def sips(table: DataFrame, q: QuerySpec = QuerySpec()) -> DataFrame:
    """Events and signals: with a radius by date, without by distance and date."""
    date = F.col("created").desc_nulls_last()
    if q.embedding is not None and q.distance:
        near = filtered(table, q).withColumn("distance", vectors.METRICS[q.metric](F.col("embedding"), vectors.literal(q.embedding))).where(F.col("distance") <= q.distance).orderBy(date, "id")
        near = near.offset(q.offset) if q.offset else near
        near = near.limit(q.limit) if q.limit else near
        return near.select(*q.columns, "distance") if q.columns else near
    return select(table, _ordered(q, date, F.col("id")))


def reranked(df: DataFrame, by: str = "created") -> DataFrame:
    """The nearest rows in another order, with relevance scaled to 0..1 over the result."""
    low, high = df.agg(F.min("distance"), F.max("distance")).first()
    relevance = F.try_divide(F.lit(high) - F.col("distance"), F.lit(high) - F.lit(low)) if low is not None else F.lit(None).cast("double")
    return df.withColumn("relevance", F.coalesce(relevance, F.lit(1.0))).orderBy(F.col(by).desc_nulls_last(), "url")


def keyset_page(df: DataFrame, key: str, after, size: int = 16384) -> DataFrame:
    if after is not None:
        df = df.where(F.col(key) > after)
    return df.orderBy(key).limit(size)


def distinct_items(df: DataFrame, column: str) -> DataFrame:
    """Distinct items of an array column (or values of a plain one), in order."""
    items = F.explode(column) if dict(df.dtypes)[column].startswith("array") else F.col(column)
    return df.where(F.col(column).isNotNull()).select(items.alias(column)).where(F.col(column).isNotNull()).distinct().orderBy(column)


def count(df: DataFrame, conditions: list[str] | None = None) -> DataFrame:
    return filtered(df, QuerySpec(conditions=conditions or [])).agg(F.count(F.lit(1)).alias("n"))


def sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, **params) -> DataFrame:
    """Free SQL over named tables, with named parameters."""
    return spark.sql(text, args=params or None, **(tables or {}))
