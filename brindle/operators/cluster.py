"""Density clustering and group building."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import metricjoin, search, vectorindex
from .durable import cut
from .graph import both_ways, connected_components

SPREAD = 6  # blocks of a dense region, as each row moves once for each in both passes: 21 tasks, more from 393,216 rows on


def dbscan(df: DataFrame, eps: float, min_samples: int, *, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """id, cluster (least core id of it; the own id for noise), core.  Whole-number ids.

    A core has min_samples neighbours, itself included; cores within eps are one cluster; a border point takes the cluster of least id among its cores.
    No pair leaves the task that finds it: one pass counts neighbours, another joins up what it has of cores and tells border points of them, of whose pairs there are fewer than min_samples a point.
    Rows with equal vectors are one point of that weight, so copies are never paired; rows with a null vector or a non-finite component are noise.
    """
    fine = F.coalesce(~F.exists(vec_col, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = df.select(F.col(id_col).alias("_id"), F.when(fine, F.col(vec_col)).alias("_v"))
    points = cut(rows.where("_v is not null").groupBy("_v").agg(F.min("_id").cast("long").alias("point"), F.count(F.lit(1)).alias("n")).where("point is not null"))
    meet = lambda table, keep: metricjoin.joins(table, eps, id_col="point", vec_col="_v", spread=SPREAD, keep=(keep,))
    counts = [j.neighbours("n", min_samples) for j in meet(points, "n")]
    none = df.sparkSession.createDataFrame([], "id long, more long")
    around = reduce(DataFrame.unionByName, counts, none).groupBy("id").agg(F.sum("more").alias("more"))
    core = F.col("n") + F.coalesce("more", F.lit(0)) >= min_samples
    seen = cut(points.join(around, F.col("point") == F.col("id"), "left").where(core | F.col("more").isNotNull()).select("point", "_v", core.alias("core")))
    found = [j.links("core") for j in meet(seen, "core")]
    links = cut(reduce(DataFrame.unionByName, found, df.sparkSession.createDataFrame([], "src long, dst long, inner boolean")))
    cores = seen.where("core").select(F.col("point").alias("core"))
    roots = connected_components(links.where("inner").select("src", "dst"))
    least = roots.groupBy("root").agg(F.min("node").alias("cluster"))
    labels = cores.join(roots.join(least, "root"), cores["core"] == F.col("node"), "left").select("core", F.coalesce("cluster", "core").alias("cluster"))
    border = links.where("not inner").join(labels, F.col("dst") == F.col("core")).groupBy("src").agg(F.min("cluster").alias("cluster"))
    known = labels.select(F.col("core").alias("point"), "cluster", F.lit(True).alias("core")).unionByName(border.select(F.col("src").alias("point"), "cluster", F.lit(False).alias("core")))
    whose = rows.join(points.select(F.col("_v").alias("_of"), "point"), F.col("_v") == F.col("_of"), "left").select("_id", F.col("point").alias("_point"))
    made = whose.join(known, F.col("_point") == F.col("point"), "left")
    return made.select(F.col("_id").alias(id_col), F.coalesce("cluster", "_id").alias("cluster"), F.coalesce("core", F.lit(False)).alias("core"))


def related(df: DataFrame, eps: float, *, limit: int = 500, id_col: str = "id", vec_col: str = "embedding", itself: bool = True) -> DataFrame:
    """id, related (ids within eps, nearest first, at most limit, itself included): the same for any order of arrival."""
    pairs = search.radius_pairs(df, eps, id_col=id_col, vec_col=vec_col)
    both = both_ways(pairs, "a", "b")
    if itself:
        both = both.unionByName(df.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("a"), F.col(id_col).alias("b"), F.lit(0.0).alias("distance")))
    near = both.withColumn("_rn", F.row_number().over(Window.partitionBy("a").orderBy("distance", "b"))).where(F.col("_rn") <= limit)
    return near.groupBy("a").agg(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "b"))), lambda s: s["b"]).alias("related")).withColumnRenamed("a", id_col)


def related_to(stored: DataFrame, batch: DataFrame, eps: float, *, limit: int = 500, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """For a new batch: ids of all stored and new items within eps of each.  An id in both counts with the batch's vector; only the batch's ids move."""
    old = stored.select(id_col, vec_col).join(F.broadcast(batch.select(id_col)) if batch.count() <= search.MAX_QUERIES else batch.select(id_col), id_col, "left_anti")
    pool = old.unionByName(batch.select(id_col, vec_col))
    return _lists(search.batch_topk(pool, batch.select(F.col(id_col).alias("query"), vec_col), k=limit, distance=eps, metric="l2", id_col=id_col, vec_col=vec_col), id_col, id_col)


def related_through(path: str, batch: DataFrame, eps: float, *, limit: int = 500, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """The same through a vector index that is kept: what it lacks of the batch is added to it, and the batch then searched for among all that it holds; just the cells within eps of a new vector are read.

    Exact, and a batch that comes again changes nothing.  An id that the index already holds keeps its vector there.
    """
    spark = batch.sparkSession
    have = vectorindex.known(spark, path, batch.select(F.col(id_col).alias("id"))).select(F.col("id").alias("_have"))
    new = cut(batch.select(id_col, vec_col).join(have, F.col(id_col) == F.col("_have"), "left_anti"))
    if not new.isEmpty():
        vectorindex.add(spark, path, new, id_col=id_col, vec_col=vec_col)
    hits = vectorindex.topk(batch.sparkSession, path, batch.select(F.col(id_col).alias("query"), vec_col), k=limit, distance=eps, exact=True, vec_col=vec_col)
    return _lists(hits, "id", id_col)


def _lists(hits: DataFrame, hit: str, id_col: str) -> DataFrame:
    return hits.groupBy("query").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", hit))), lambda s: s[hit]).alias("related")).withColumnRenamed("query", id_col)


def chunk_groups(members: DataFrame, *, group_col: str = "cluster", id_col: str = "id", most: int = 64, least: int = 4) -> DataFrame:
    """Groups of more than ``most`` are cut into chunks of that size; chunks under ``least`` go."""
    w = Window.partitionBy(group_col).orderBy(id_col)
    chunked = members.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / most))
    sizes = chunked.groupBy(group_col, "chunk").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= least)
    return chunked.join(sizes, [group_col, "chunk"])


def expand_groups(members: DataFrame, related: DataFrame, eligible: DataFrame, *, group_col: str = "cluster", id_col: str = "id", most: int = 64, least: int = 4) -> DataFrame:
    """Small groups gain eligible related items that they lack, up to ``most``, where that brings them to ``least``."""
    size = members.groupBy(group_col).agg(F.count(F.lit(1)).alias("_size"))
    small = members.join(size.where(F.col("_size") < most), group_col)
    new = small.join(related, id_col).select(group_col, "_size", F.explode("related").alias("_new")).distinct()
    new = new.join(members.select(F.col(group_col), F.col(id_col).alias("_new")), [group_col, "_new"], "left_anti")
    new = new.join(eligible.select(F.col(id_col).alias("_new")), "_new", "left_semi")
    gain = new.groupBy(group_col).agg(F.count(F.lit(1)).alias("_gain"))
    w = Window.partitionBy(group_col).orderBy("_new")
    new = new.join(gain, group_col).where(F.col("_size") + F.col("_gain") >= least).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most - F.col("_size"))
    return members.select(group_col, id_col).unionByName(new.select(group_col, F.col("_new").alias(id_col)))
