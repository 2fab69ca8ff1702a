"""Lloyd's clustering on whole numbers, exact in every sum.

A component x becomes floor(scale * x), the scale being a power of two, so that the product is exact.  A task meets the centroids in blocks of rows: distances are
|x|² - 2 x·c + |c|², one matrix product of doubles.  With components of at most m and centroids of at most c, no sum on the way exceeds size * (m + c)², so below 2^53 doubles hold
every one of them exactly, in whatever order the product adds.  Rows above that bound go through whole numbers of 64 bits while these hold, and beyond them through Python's integers.

Each task gives its sums and counts as one row of Python integers; ``treeAggregate`` combines them, so the driver gets one table of centroids and components, whatever the
number of rows or tasks.  The rows themselves are read again each round and never move; a table that is dear to make should be written first.

Defined cases: vectors of another length, null ones, and those with a null or non-finite component are left out of everything; the first centroids are those with the smallest sha256 of ``seed:id`` (a null id
counts as an empty one, rows that share an id go by their components), and with fewer vectors than centroids there are fewer centroids; equal distances go to the smaller number; a centroid
without vectors stays; repeated rows count each; an empty table gives no rows; a distance or a sum of distances over 2^63 - 1 is null; input columns named like a result are replaced, all others come back.
"""

from __future__ import annotations

import hashlib
import pickle
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
EXACT = 1 << 53
LONG = 1 << 63
RESULTS = ("cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _vector(vectors: DataFrame, vec_col: str) -> Column:
    return F.col(vec_col) if dict(vectors.dtypes)[vec_col] == "array<float>" else F.col(vec_col).cast("array<double>")


def _kept(vectors: DataFrame, vec_col: str, size: int) -> DataFrame:
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    v = _vector(vectors, vec_col)
    return vectors.where(F.coalesce((F.size(v) == size) & ~F.exists(v, odd), F.lit(False)))


def whole(values: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of each component as doubles, and the rows whose values doubles hold exactly (all at most 2^53)."""
    with np.errstate(over="ignore"):
        x = np.floor(values * scale)
    return x, (np.abs(x) <= EXACT).all(1)


def whole_exactly(row: np.ndarray, scale: int) -> list[int]:
    return [floor(Fraction(float(x)) * scale) for x in row]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of rows of whole numbers that doubles hold, by one product; the caller has checked the bound."""
    d = (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None, :]
    home = d.argmin(1)  # the first of equal ones
    return home, d[np.arange(len(x)), home]


def nearest_whole(x: list[list[int]], centroids: list[list[int]]) -> tuple[list[int], list[int]]:
    """The same for rows of any size, by integers: of 64 bits where they hold the sums, else Python's."""
    most = max((abs(v) for rows in (x, centroids) for row in rows for v in row), default=0)
    kind = np.int64 if 4 * len(centroids[0]) * most * most < LONG else object
    c = np.array(centroids, kind)
    home, away = [], []
    for row in x:
        gap = np.array(row, kind)[None, :] - c
        d = [int(v) for v in (gap * gap).sum(1)]
        home.append(min(range(len(d)), key=lambda k: (d[k], k)))
        away.append(d[home[-1]])
    return home, away


class _Rows:
    """A block's rows: those that doubles hold within the bound, and the rest as integers."""

    def __init__(self, column, centroids: list[list[int]], scale: int) -> None:
        size = len(centroids[0])
        values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
        x, ok = whole(values, scale)
        top = min(1 << 1000, max(abs(v) for row in centroids for v in row))
        with np.errstate(over="ignore", invalid="ignore"):
            ok &= size * (np.abs(x).max(1) + float(top)) ** 2 < EXACT / 2  # half: the bound itself is made of rounded doubles
        self.ok, self.x = ok, x[ok]
        self.rest = [whole_exactly(row, scale) for row in values[~ok]]
        if len(self.x):
            self.home, self.away = nearest(self.x, np.array(centroids, np.float64))
        if self.rest:
            self.rest_home, self.rest_away = nearest_whole(self.rest, centroids)

    def placed(self) -> tuple[np.ndarray, list[int | None]]:
        """Cluster and distance of all rows in their order."""
        home, away = np.zeros(len(self.ok), np.int32), np.zeros(len(self.ok), object)
        if len(self.x):
            home[self.ok], away[self.ok] = self.home, [int(v) for v in self.away]
        if self.rest:
            home[~self.ok], away[~self.ok] = self.rest_home, [v if v < LONG else None for v in self.rest_away]
        return home, away.tolist()


def _blocks(batches, name: str):
    for b in batches:
        for lo in range(0, b.num_rows, BLOCK):
            yield b.slice(lo, BLOCK), b.slice(lo, BLOCK).column(b.schema.get_field_index(name))


def _zero(k: int, size: int) -> list:
    """Counts, sums of distances, and sums of components of each cluster, as Python integers."""
    return [[0] * k, [0] * k, [[0] * size for _ in range(k)]]


def _add(a: list, b: list) -> list:
    """a + b, into a."""
    for k in range(len(a[0])):
        if b[0][k]:
            a[0][k] += b[0][k]
            a[1][k] += b[1][k]
            a[2][k] = [x + y for x, y in zip(a[2][k], b[2][k], strict=True)]
    return a


def _sums(kept: DataFrame, centroids: list[list[int]], scale: int) -> list:
    """Counts, inertia and component sums of each cluster over all rows."""
    k, size = len(centroids), len(centroids[0])

    def run(batches):
        total = _zero(k, size)
        for _, column in _blocks(batches, "v"):
            rows = _Rows(column, centroids, scale)
            if len(rows.x):
                part = _zero(k, size)
                part[0] = np.bincount(rows.home, minlength=k).tolist()
                own = rows.home[:, None] == np.arange(k)[None, :]
                part[1] = (rows.away.astype(np.int64) @ own.astype(np.int64)).tolist()  # a block has 2^10 rows, each less than 2^52
                part[2] = (own.astype(np.float64).T @ rows.x).astype(np.int64).tolist()  # components within the bound are less than 2^26
                _add(total, part)
            for x, c, d in zip(rows.rest, *(rows.rest_home, rows.rest_away) if rows.rest else ((), ()), strict=True):
                total[0][c] += 1
                total[1][c] += d
                total[2][c] = [a + b for a, b in zip(total[2][c], x, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], ["sums"])

    parts = kept.select("v").mapInArrow(run, "sums binary").rdd.map(lambda r: pickle.loads(r["sums"]))
    return parts.treeAggregate(_zero(k, size), _add, _add, depth=3)


def _first(kept: DataFrame, k: int, seed: int, scale: int) -> list[list[int]]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = kept.select(digest.alias("digest"), F.transform("v", lambda x: x.cast("double")).alias("v")).orderBy("digest", "v").limit(k).collect()  # k rows
    return [whole_exactly(r["v"], scale) for r in rows]


def fit(vectors: DataFrame, *, k: int = 16, size: int = 64, rounds: int = 3, seed: int = 1, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[list[list[int]], list[int], list[int]]:
    """The final centroids as whole numbers, and how many vectors each has and their summed distances."""
    if scale < 1 or scale & (scale - 1):
        raise ValueError("the scale must be a power of two")
    kept = _kept(vectors, vec_col, size).select(F.col(id_col).alias("id"), _vector(vectors, vec_col).alias("v"))
    centroids = _first(kept, k, seed, scale)
    if not centroids:
        return [], [], []
    for _ in range(rounds):
        n, _, sums = _sums(kept, centroids, scale)
        centroids = [[s // m for s in own] if m else c for own, m, c in zip(sums, n, centroids, strict=True)]
    n, inertia, _ = _sums(kept, centroids, scale)
    return centroids, n, inertia


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def assign(vectors: DataFrame, centroids: list[list[int]], *, size: int = 64, scale: int = 64, vec_col: str = "embedding") -> DataFrame:
    """The kept vectors with cluster and distance; no shuffle."""
    names = [c for c in vectors.columns if c not in RESULTS[:2]]
    plain = _kept(vectors, vec_col, size).select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], _vector(vectors, vec_col).alias("v"))
    types = "".join(f"{c} {t}, " for c, t in plain.dtypes[:-1])

    def run(batches):
        for b, column in _blocks(batches, "v"):
            home, away = _Rows(column, centroids, scale).placed()
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(home, pa.int32()), pa.array(away, pa.int64())], [*b.schema.names[:-1], "cluster", "distance"])

    made = plain.where(F.lit(bool(centroids))).mapInArrow(run, f"{types}cluster int, distance long")
    return made.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "cluster", "distance")


def cluster(vectors: DataFrame, *, k: int = 16, size: int = 64, rounds: int = 3, seed: int = 1, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The kept vectors with cluster, distance, cluster_inertia, inertia and centroid_sha256."""
    centroids, _, inertia = fit(vectors, k=k, size=size, rounds=rounds, seed=seed, scale=scale, id_col=id_col, vec_col=vec_col)
    placed = assign(vectors.drop(*RESULTS[2:]), centroids, size=size, scale=scale, vec_col=vec_col)
    bounded = lambda v: F.lit(v if v < LONG else None).cast("long")
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None)
    return placed.withColumns({
        "cluster_inertia": of([bounded(v) for v in inertia]).cast("long"),
        "inertia": bounded(sum(inertia)),
        "centroid_sha256": of([F.lit(digest(c)) for c in centroids]).cast("string"),
    })
