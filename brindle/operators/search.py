"""Exact vector search and joins.

Queries and labels are collected behind a count (more than ``MAX_QUERIES`` queries or ``MAX_LABELS`` labels in parts) and worked off in blocks: each batch of vectors meets a block in one matrix product; a task
keeps the best so far of each query, so what is shuffled is at most k rows a query and task.  Distances are double.  Queries and vectors of different lengths never meet: each length is a search of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import texts, vectors
from .durable import cut

BLOCK_VALUES = 4 << 20
ROWS = 2_048  # of vectors that meet a block of queries at a time
MAX_QUERIES = 100_000
MAX_LABELS = 10_000


def topk(df: DataFrame, vector, *, k: int | None = 10, distance: float | None = None, metric: str = "cosine", id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """The nearest rows to one vector: id, distance; with k=None all within the distance."""
    d = vectors.METRICS[metric](F.col(vec_col), vectors.literal(vector))
    near = df.select(id_col, d.alias("distance")).where("distance is not null")
    if distance:
        near = near.where(F.col("distance") <= distance)
    near = near.orderBy("distance", id_col)
    return near if k is None else near.limit(k)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    if metric == "l2":
        sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
        out = np.sqrt(np.maximum(sq, 0))
        i, j = np.nonzero(sq < 1e-6 * ((a * a).sum(1)[:, None] + 1e-300))
        for lo in range(0, len(i), 1 << 15):  # where the difference has lost its digits
            x, y = i[lo : lo + (1 << 15)], j[lo : lo + (1 << 15)]
            out[x, y] = np.sqrt(((a[x] - b[y]) ** 2).sum(1))
        return out
    if metric == "ip":
        return -(a @ b.T)
    with np.errstate(invalid="ignore", divide="ignore"):
        return 1 - (a @ b.T) / (np.sqrt((a * a).sum(1))[:, None] * np.sqrt((b * b).sum(1))[None, :])


def keep_best(held: pa.Table | None, who: np.ndarray, ids, d: np.ndarray, k: int) -> pa.Table:
    """The k nearest rows of each query so far: what was held and a matrix of distances (the queries of these numbers by rows); ties go by id."""
    d = np.where(np.isnan(d), np.inf, d)
    most = min(k, d.shape[1])
    edge = np.partition(d, most - 1, axis=1)[:, most - 1] if most else np.zeros(len(d))
    at, row = np.nonzero((d <= edge[:, None]) & np.isfinite(d))
    new = pa.table({"_q": pa.array(who[at], pa.int32()), "id": ids.take(pa.array(row)), "distance": pa.array(d[at, row])})
    if held is not None:
        new = pa.concat_tables([held, new])
    new = new.sort_by([("_q", "ascending"), ("distance", "ascending"), ("id", "ascending")])
    own = new.column("_q").to_numpy()
    begin = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, int)
    rank = np.arange(len(own)) - np.repeat(begin, np.diff(np.r_[begin, len(own)]))
    return new.filter(pa.array(rank < k))


def batch_topk(df: DataFrame, queries: DataFrame, *, k: int = 10, distance: float | None = None, metric: str = "cosine", id_col: str = "id", vec_col: str = "embedding", query_col: str = "query") -> DataFrame:
    """The k nearest rows to each query (columns query and the vector's): query, id, distance, rank."""
    n = queries.count()
    if n > MAX_QUERIES:
        parts = -(-n // MAX_QUERIES) + 1
        # a number that Spark gives each row, written with it, deals even equal queries out
        dealt = cut(queries.select(query_col, vec_col).withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(parts))))
        found = None
        for p in range(parts):
            near = batch_topk(df, dealt.where(F.col("_part") == p).drop("_part"), k=k, distance=distance, metric=metric, id_col=id_col, vec_col=vec_col, query_col=query_col)
            found = near if found is None else found.unionByName(near)
        return found
    rows = queries.where(F.col(vec_col).isNotNull()).select(query_col, vec_col).collect()
    kinds = dict(df.dtypes)
    query_kind = dict(queries.dtypes)[query_col]
    found = None
    for size in sorted({len(r[1]) for r in rows}) or [0]:
        near = _batch_topk(df, [r for r in rows if len(r[1]) == size], size, k, distance, metric, id_col, vec_col, query_col, kinds, query_kind)
        found = near if found is None else found.unionByName(near)
    return found


def _few(batches):
    """Some rows of a batch at a time, so that a matrix of distances is as small for batches of 10,000."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _batch_topk(df, rows, size, k, distance, metric, id_col, vec_col, query_col, kinds, query_kind) -> DataFrame:
    """The search for queries of one length."""
    names = [r[0] for r in rows]
    sent = df.sparkSession.sparkContext.broadcast(np.array([r[1] for r in rows], np.float32).reshape(len(rows), size))
    step = max(1, BLOCK_VALUES // 8192)

    def run(batches):
        q = sent.value
        held: list[pa.Table] = [None] * -(-len(q) // step)
        for b in _few(batches if len(q) else ()):
            m = _matrix(b.column(1))
            for lo in range(0, len(q), step):
                d = distances(q[lo : lo + step].astype(np.float64), m, metric)
                d[np.isnan(d)] = np.inf
                best = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, : min(k, d.shape[1])]
                edge = np.take_along_axis(d, best, 1).max(1)
                at, row = np.nonzero((d <= edge[:, None]) & np.isfinite(d) & (d <= (distance or np.inf)))
                new = pa.table({"_q": pa.array(at + lo, pa.int32()), "id": b.column(0).take(pa.array(row)), "distance": pa.array(d[at, row])})
                have = held[lo // step]
                if have is not None:
                    new = pa.concat_tables([have, new]).sort_by([("_q", "ascending"), ("distance", "ascending"), ("id", "ascending")])
                    who = new.column("_q").to_numpy()
                    begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else np.zeros(0, int)
                    rank = np.arange(len(who)) - np.repeat(begin, np.diff(np.r_[begin, len(who)]))
                    new = new.filter(pa.array(rank < k))
                held[lo // step] = new
        for t in held:
            if t is not None:
                yield from t.to_batches()

    part = df.where(F.size(vec_col) == size).select(F.col(id_col).alias("id"), vec_col)
    near = part.mapInArrow(run, f"_q int, id {kinds[id_col]}, distance double")
    w = Window.partitionBy("_q").orderBy("distance", "id")
    near = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    table = df.sparkSession.createDataFrame([(i, x) for i, x in enumerate(names)], f"_q int, query {query_kind}")
    return near.join(table, "_q").select(F.col("query").alias(query_col), F.col("id").alias(id_col), "distance", "rank")


def multi_vector(df: DataFrame, queries: DataFrame, *, k: int = 10, distance: float | None = None, metric: str = "cosine", id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Rows near any of the queries, each once with its least distance."""
    hits = batch_topk(df, queries, k=k, distance=distance, metric=metric, id_col=id_col, vec_col=vec_col)
    return hits.groupBy(id_col).agg(F.min("distance").alias("distance")).orderBy("distance", id_col)


def nearest_labels(df: DataFrame, labels: DataFrame, *, k: int = 2, id_col: str = "id", vec_col: str = "embedding", label_col: str = "id", metric: str = "cosine", as_tags: bool = True) -> DataFrame:
    """id and its k nearest labels of its vector's length, nearest first; ties go by label.  Labels without a vector, or with a null component, are left out.

    Labels are broadcast in blocks of ``MAX_LABELS``: one block needs no shuffle, of several a row's k best of each are merged.
    """
    good = labels.where(F.coalesce(F.size(vec_col) > 0, F.lit(False)) & F.coalesce(~F.exists(vec_col, lambda x: x.isNull()), F.lit(False))).select(F.col(label_col).cast("string").alias("_label"), F.col(vec_col).alias("_v"))
    parts = max(1, -(-good.count() // MAX_LABELS))
    kind = dict(df.dtypes)[id_col]
    near = None
    for p in range(parts):
        own = good if parts == 1 else good.where(F.pmod(F.xxhash64("_label", "_v"), F.lit(parts)) == p)
        some = _labels_of_block(df, own.orderBy("_label", "_v").collect(), k, metric, id_col, vec_col, kind)  # a block
        near = some if near is None else near.unionByName(some)
    if parts > 1:
        merged = near.groupBy("id").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
        near = merged.select("id", F.slice("near", 1, k).alias("near"))
    names = F.col("near.label")
    return near.select(F.col("id").alias(id_col), (F.transform(names, texts.snake) if as_tags else names).alias("labels"))


def _labels_of_block(df: DataFrame, rows: list, k: int, metric: str, id_col: str, vec_col: str, kind: str) -> DataFrame:
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(len(r["_v"]), []).append(r)
    sent = df.sparkSession.sparkContext.broadcast({n: ([r["_label"] for r in own], np.array([r["_v"] for r in own], np.float64)) for n, own in by.items()})

    def run(batches):
        for b in batches:
            sizes = b.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for n, (names, q) in sent.value.items():
                part = b.filter(pa.array(sizes == n))
                for lo in range(0, part.num_rows, max(1, BLOCK_VALUES // len(q))):
                    some = part.slice(lo, max(1, BLOCK_VALUES // len(q)))
                    d = distances(_matrix(some.column("v")), q, metric)
                    best = np.argsort(np.where(np.isnan(d), np.inf, d), axis=1, kind="stable")[:, :k]
                    made = [[{"far": float(d[i, j]), "label": names[j]} for j in own] for i, own in enumerate(best)]
                    yield pa.RecordBatch.from_arrays([some.column("id"), pa.array(made, pa.list_(pa.struct([("far", pa.float64()), ("label", pa.string())])))], ["id", "near"])

    vectors_ = df.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    return vectors_.mapInArrow(run, f"id {kind}, near array<struct<far:double,label:string>>")


def radius_pairs(df: DataFrame, eps: float, *, id_col: str = "id", vec_col: str = "embedding", sample_rows: int = 4096, block: int = 2048) -> DataFrame:
    """All pairs (a < b) at an L2 distance of at most eps, exactly: see ``metricjoin``."""
    from . import metricjoin

    found = None
    for own in metricjoin.joins(df, eps, id_col=id_col, vec_col=vec_col, sample_rows=sample_rows, block=block):
        found = own.pairs() if found is None else found.unionByName(own.pairs())
    kind = dict(df.dtypes)[id_col]
    return df.sparkSession.createDataFrame([], f"a {kind}, b {kind}, distance double") if found is None else found


def median_vector(df: DataFrame, by: str, vec_col: str = "embedding") -> DataFrame:
    """Per-dimension exact median of each (bounded) group's vectors; shorter vectors have no part in the dimensions that they lack."""
    kind = dict(df.dtypes)[by]

    def run(table: pa.Table) -> pa.Table:
        flat = table.column("v").combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        size = flat.value_lengths().to_numpy()
        m = np.full((len(size), size.max(initial=0)), np.nan)
        m[np.arange(m.shape[1])[None, :] < size[:, None]] = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        whole = m if np.isfinite(m).all() else None
        out = np.median(whole, 0) if whole is not None else [_median(m[:, j]) for j in range(m.shape[1])]
        return pa.table({by: table.column(by).slice(0, 1), vec_col: pa.array([list(out)], pa.list_(pa.float64()))})

    rows = df.where(F.size(vec_col) > 0).select(by, F.col(vec_col).alias("v"))
    return rows.groupBy(by).applyInArrow(run, f"`{by}` {kind}, `{vec_col}` array<double>")


def _median(x: np.ndarray) -> float | None:
    x = x[~np.isnan(x)]
    return float(np.median(x)) if len(x) else None


def mean_vector(df: DataFrame, by: str, vec_col: str = "embedding") -> DataFrame:
    """Per-dimension mean of each group's vectors, as for the chunks of a document: tasks sum what they hold, so a group of any size moves one sum from each."""
    kind = dict(df.dtypes)[by]
    dims = F.size(vec_col)
    # one sum and count a dimension: a wide aggregate that combines before the shuffle
    sizes = [r["n"] for r in df.where(dims > 0).select(dims.alias("n")).distinct().collect()]  # a row a length
    most = max(sizes, default=0)
    if not most:
        return df.sparkSession.createDataFrame([], f"`{by}` {kind}, `{vec_col}` array<double>")
    rows = df.where(dims > 0).select(by, dims.alias("n"), *[F.try_element_at(vec_col, F.lit(j + 1)).cast("double").alias(f"x{j}") for j in range(most)])
    means = rows.groupBy(by).agg(*[F.avg(f"x{j}").alias(f"x{j}") for j in range(most)], F.max("n").alias("n"))
    return means.select(by, F.slice(F.array(*[F.col(f"x{j}") for j in range(most)]), F.lit(1), F.col("n")).alias(vec_col))


def valid(embedding: Column, n: int) -> Column:
    return F.coalesce(F.size(embedding) == n, F.lit(False))


def hit_profile(df: DataFrame, samples: DataFrame, radii: list[float], *, k: int = 5, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """For each radius the average, least and most hits of the samples that hit more than themselves."""
    hits = batch_topk(df, samples.select(F.col(id_col).alias("query"), vec_col), k=k, metric="l2", id_col=id_col, vec_col=vec_col)
    each = hits.select("query", "distance", F.explode(F.array(*[F.lit(r) for r in radii])).alias("radius")).where("distance <= radius")
    per = each.groupBy("radius", "query").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return per.groupBy("radius").agg(F.avg("n").alias("avg_hits"), F.min("n").alias("min_hits"), F.max("n").alias("max_hits"))
