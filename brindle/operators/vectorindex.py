"""A growing inverted-file index over vectors: cells around centres, searched in a few cells by short codes, or exactly.

``build`` fits the centres and the code books on a bounded sample (``sample_rows`` vectors by hash of the id; the bound decides speed, never exact results) and adds the table.  ``add`` appends a
batch: each vector goes to the folder of its nearest cell, with a code (the nearest of 256 entries in each of some stretches of the vector).  A cell of more than ``split_rows`` rows is split among
centres of its own, so only such cells are ever rewritten; one whose sample is a single point stays whole, since no centre tells its rows apart.  Every row is in the index.

What counts is the newest finished version of a small table of cells (centre, radius, rows, batches); a batch that failed leaves folders that nothing reads, and ``vacuum`` removes those.

``topk`` sends each query to its ``probe`` nearest cells.  There one scan of the codes keeps ``rerank`` candidates a query, and a second one reads the vectors of just the cells that hold some, and measures
the candidates exactly.  With ``exact`` the vectors of the probed cells are measured right away, and by the triangle inequality (no member is nearer than the centre's distance less the radius) just
the cells that the k-th distance so far does not rule out are searched too.  Stored vectors are never shuffled: queries go to them, a task keeps a running best of each query, and at most k rows a
query and task move.  Queries are collected in blocks of ``QUERIES``, or of ``QUERY_VALUES`` components if that is more; of a block of more than ``QUERIES`` the
candidates are measured where they are found, by one scan, and never collected.  More than ``QUERIES`` queries that ask exactly for what is within a distance are never collected: each goes to the cells that its distance
reaches, a cell's rows go to each of its (at most ``SPREAD``, until they would be of more than ``MOST``) blocks of queries, and what a block and a cell find together is at most k rows a query.

Defined cases: null vectors and those of another length than most of the first sample are not in the index (``build`` and ``add`` say how many: ``skipped``); null and such queries have no hits; ties go
by id; repeated ids are rows of their own; an empty table makes an index without cells, which finds nothing and refuses to grow.  For cosine, vectors are scaled to length one, and one of length zero has no distance.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .durable import Tables, remove
from .metricjoin import MOST, SPREAD, compare
from .search import _matrix, distances

QUERIES = 2_000
SAMPLED, SPARE = 200, 0.03  # queries on which a recall is measured, and what a sample may err
BLOCK_VALUES = 1 << 21  # of a matrix of distances
QUERY_VALUES = 1 << 20  # of the queries that are collected at a time, where that is more than QUERIES of them
ROWS = 2_048  # that meet a block of queries at a time
TASK_ROWS = 32_768
PENDING = 1 << 18  # rows that a task holds beside the best of each query before it drops those that are not
BLOCK = 16_384  # queries that meet a cell in one task, where that makes at most SPREAD blocks
WIDTH = 4  # components to a stretch of the code
CELL = "cell int, centre array<double>, radius double, n long, batches array<string>, whole boolean"


def _centres(sample: np.ndarray, cells: int, rounds: int) -> np.ndarray:
    """Lloyd's rounds from evenly chosen members of the sample; a cell that loses all members keeps its centre."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        home = ((centres * centres).sum(1)[None, :] - 2 * (sample @ centres.T)).argmin(1)
        n = np.bincount(home, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        centres[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centres


def _scaled(v: np.ndarray, metric: str) -> np.ndarray:
    if metric != "cosine":
        return v
    n = np.linalg.norm(v, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return v / n


def _stretches(size: int) -> list[tuple[int, int]]:
    return [(lo, min(size, lo + WIDTH)) for lo in range(0, size, WIDTH)]


class _Books:
    """Code books: for each stretch its entries."""

    def __init__(self, books: list[np.ndarray], size: int) -> None:
        self.books, self.size = books, size

    def codes(self, m: np.ndarray) -> np.ndarray:
        out = np.empty((len(m), len(self.books)), np.uint8)
        for j, ((lo, hi), book) in enumerate(zip(_stretches(self.size), self.books, strict=True)):
            out[:, j] = ((book * book).sum(1)[None, :] - 2 * (m[:, lo:hi] @ book.T)).argmin(1)
        return out

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """What the codes stand for."""
        return np.concatenate([book[codes[:, j]] for j, book in enumerate(self.books)], axis=1) if len(codes) else np.zeros((0, self.size))


class _State:
    """The newest finished version of the table of cells."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        about = spark.read.parquet(f"{self.path}/about").first()
        self.size, self.metric, self.kind = about["size"], about["metric"], about["kind"]
        self.books = _Books([np.array(b, np.float64).reshape(-1, hi - lo) for b, (lo, hi) in zip(about["books"], _stretches(self.size), strict=True)], self.size)
        jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
        place = jvm.Path(f"{self.path}/cells")
        fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found = [int(f.getPath().getName()[2:]) for f in (fs.listStatus(place) if fs.exists(place) else ()) if fs.exists(jvm.Path(f"{f.getPath().toString()}/_SUCCESS"))]
        self.version = max(found, default=-1)
        rows = spark.read.schema(CELL).parquet(f"{self.path}/cells/v={self.version}").collect() if found else []  # a row a cell
        self.cells = {r["cell"]: r.asDict() for r in rows}
        self.listed: tuple[set[str], DataFrame] | None = None

    def write(self) -> None:
        self.version += 1
        rows = [(c, x["centre"], x["radius"], x["n"], x["batches"], x["whole"]) for c, x in sorted(self.cells.items())]
        self.spark.createDataFrame(rows, CELL).coalesce(1).write.parquet(f"{self.path}/cells/v={self.version}")

    def order(self) -> list[int]:
        return sorted(self.cells)

    def centres(self) -> np.ndarray:
        return np.array([self.cells[c]["centre"] for c in self.order()], np.float64).reshape(len(self.cells), self.size)

    def rows(self, cells: list[int], *columns: str) -> DataFrame:
        """Stored rows of these cells: only their folders in the batches that count are read.  Those folders are listed once, however often rows are asked for."""
        batches = {b for c in cells for b in self.cells[c]["batches"]}
        if self.listed is None or not batches <= self.listed[0]:
            schema = f"id {self.kind}, code binary, v array<double>, distance double, batch string, cell int"
            self.listed = batches, self.spark.read.schema(schema).option("basePath", f"{self.path}/rows").parquet(*[f"{self.path}/rows/batch={b}" for b in sorted(batches)])
        # one expression, as a literal a cell is a call each; folders may still have cells that were split since
        return self.listed[1].where(F.expr(f"cell in ({', '.join(map(str, cells))})")).select("cell", *columns)


def _sample(plain: DataFrame, rows: int) -> list:
    return plain.where("size(v) > 0").orderBy(F.xxhash64("id"), "id").limit(rows).coalesce(1).collect()  # bounded, and merged in a task: plain collect brings as many from every partition


def build(df: DataFrame, path: str, *, cells: int = 64, metric: str = "l2", sample_rows: int = 20_000, rounds: int = 8, split_rows: int = 1_000_000, id_col: str = "id", vec_col: str = "embedding") -> dict:
    """Write the index below path; what comes back says how many rows are in it and how many were skipped."""
    if metric not in ("l2", "cosine"):
        raise ValueError("the index knows l2 and cosine")
    spark = df.sparkSession
    plain = df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
    drawn = _sample(plain, sample_rows)
    size = Counter(len(r["v"]) for r in drawn).most_common(1)[0][0] if drawn else 0
    sample = np.array([r["v"] for r in drawn if len(r["v"]) == size and None not in r["v"]], np.float64).reshape(-1, size) if drawn else np.zeros((0, 0))
    sample = _scaled(sample, metric)
    sample = sample[np.isfinite(sample).all(1)]
    books = [_centres(sample[:8192, lo:hi], 256, 4) for lo, hi in _stretches(size)] if len(sample) else [np.zeros((1, hi - lo)) for lo, hi in _stretches(size)]
    about = [(size, metric, dict(plain.dtypes)["id"], [b.reshape(-1).tolist() for b in books])]
    spark.createDataFrame(about, "size int, metric string, kind string, books array<array<double>>").coalesce(1).write.parquet(f"{path.rstrip('/')}/about")
    state = _State(spark, path)
    if not len(sample):
        return {"rows": 0, "skipped": df.count(), "cells": 0}
    state.cells = {k: {"centre": c.tolist(), "radius": 0.0, "n": 0, "batches": [], "whole": False} for k, c in enumerate(_centres(sample, cells, rounds))}
    return _added(state, plain, split_rows)


def add(spark: SparkSession, path: str, df: DataFrame, *, split_rows: int = 1_000_000, id_col: str = "id", vec_col: str = "embedding") -> dict:
    """Append a batch; what comes back says how many rows are in the index and how many of the batch were skipped."""
    state = _State(spark, path)
    if not state.cells:
        raise ValueError("an index that was built from no vectors cannot grow: build it anew")
    return _added(state, df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")), split_rows)


def known(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Which of these ids (a column ``id``) the index holds; of the stored rows only ids are read, and those of a batch of up to ``QUERIES`` ids go to them."""
    state = _State(spark, path)
    cells = [c for c, x in state.cells.items() if x["n"]]
    if not cells:
        return spark.createDataFrame([], f"id {state.kind}")
    asked = ids.select("id").distinct()
    return state.rows(cells, "id").select("id").join(F.broadcast(asked) if asked.limit(QUERIES + 1).count() <= QUERIES else asked, "id", "left_semi").distinct()


def _place(state: _State, rows: DataFrame, targets: dict[int | None, list[int]], centres: dict[int, list[float]], scale: bool) -> str:
    """Write rows (cell, id, v) under the nearest of their cell's targets, as a batch of its own, and give its name."""
    metric, books, size = state.metric, state.books, state.size
    own = {c: (np.array(t, np.int32), np.array([centres[x] for x in t], np.float64)) for c, t in targets.items()}
    sent = state.spark.sparkContext.broadcast((own, books))

    def assign(batches):
        own, books = sent.value
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                m = _matrix(part.column("v")).reshape(-1, size)
                m = _scaled(m, metric) if scale else m
                ok = np.isfinite(m).all(1)
                m = np.where(ok[:, None], m, 0.0)
                home, away = np.zeros(len(m), np.int32), np.zeros(len(m))
                cell = part.column("cell").to_numpy(zero_copy_only=False)
                for c, (names, middle) in own.items():
                    mine = np.isnan(cell) if c is None else cell == c
                    if mine.any():
                        d = distances(m[mine], middle, "l2")
                        home[mine], away[mine] = names[d.argmin(1)], d.min(1)
                codes = pa.array([x.tobytes() for x in books.codes(m)], pa.binary())
                v = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * size, pa.int32()), pa.array(m.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("id"), codes, v, pa.array(away), pa.array(home)], ["id", "code", "v", "distance", "cell"]).filter(pa.array(ok))

    batch = uuid.uuid4().hex
    placed = rows.mapInArrow(assign, f"id {state.kind}, code binary, v array<double>, distance double, cell int")
    # few files a cell, and a cell of many rows over many tasks
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{state.path}/rows/batch={batch}")
    return batch


def _measured(state: _State, batch: str) -> list:
    rows = state.spark.read.schema(f"id {state.kind}, distance double, cell int").parquet(f"{state.path}/rows/batch={batch}")
    return rows.groupBy("cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).collect()  # a row a cell


def _added(state: _State, plain: DataFrame, split_rows: int) -> dict:
    fits = plain.where((F.size("v") == state.size) & ~F.exists("v", lambda x: x.isNull()))
    centres = {c: x["centre"] for c, x in state.cells.items()}
    batch = _place(state, fits.select(F.lit(None).cast("double").alias("cell"), "id", F.col("v").cast("array<double>").alias("v")), {None: state.order()}, centres, True)
    new = 0
    for r in _measured(state, batch):
        cell = state.cells[r["cell"]]
        cell["radius"], cell["n"], cell["batches"] = max(cell["radius"], r["radius"]), cell["n"] + r["n"], [*cell["batches"], batch]
        new += r["n"]
    while big := [c for c, x in state.cells.items() if x["n"] > split_rows and not x["whole"]]:
        _split(state, big, split_rows)
    state.write()
    return {"rows": sum(x["n"] for x in state.cells.values()), "skipped": plain.count() - new, "cells": len(state.cells)}


def _split(state: _State, big: list[int], split_rows: int) -> None:
    """Deal the rows of these cells among new centres of their own, fitted on some 2,000 rows of each: a group is a cell's sample, and only its centres come back."""
    plan = [(c, max(1, 2000 * (1 << 20) // state.cells[c]["n"]), min(16, 2 * -(-state.cells[c]["n"] // split_rows))) for c in big]
    share = F.broadcast(state.spark.createDataFrame(plan, "cell int, share long, parts int"))
    drawn = state.rows(big, "id", "v").join(share, "cell").where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.col("share"))

    def fit(g):
        sample = np.array(sorted(map(tuple, g["v"])), np.float64)
        parts = np.unique(_centres(sample, int(g["parts"].iloc[0]), 6), axis=0)
        return g[["cell"]].head(1).assign(centres=[parts.tolist()])

    # equal rows count once, so a sample is bounded whatever is repeated
    fitted = drawn.select("cell", "parts", "v").distinct().groupBy("cell").applyInPandas(fit, "cell int, centres array<array<double>>")
    found = {r["cell"]: r["centres"] for r in fitted.collect()}
    targets: dict[int | None, list[int]] = {}
    centres: dict[int, list[float]] = {}
    at = max(state.cells) + 1
    for c in big:
        parts = found.get(c, [])
        if len(parts) < 2:
            state.cells[c]["whole"] = True
            continue
        targets[c] = list(range(at, at + len(parts)))
        centres |= dict(zip(targets[c], parts, strict=True))
        at += len(parts)
    if not targets:
        return
    moved = state.rows(list(targets), "id", "v").select(F.col("cell").cast("double").alias("cell"), "id", "v")
    batch = _place(state, moved, targets, centres, False)
    before = {new: state.cells[old]["n"] for old, own in targets.items() for new in own}
    for r in _measured(state, batch):
        # where all rows went one way, no centre tells them apart
        state.cells[r["cell"]] = {"centre": centres[r["cell"]], "radius": r["radius"], "n": r["n"], "batches": [batch], "whole": r["n"] >= before[r["cell"]]}
    for c in targets:
        del state.cells[c]


def _scan(state: _State, order: list[int], q: np.ndarray, wanted: np.ndarray, k: int, coded: bool, edge: np.ndarray, measured: bool = False) -> DataFrame:
    """The k nearest of each query among the rows of the cells that it wants, none farther than its edge: _q, id, cell, near, distance; near is by codes or by vectors, and with ``measured`` distance is by vectors.

    wanted: a row of bits a cell, a bit a query.  A task keeps k rows a query.  Single floats and a bound of their error tell which rows may count, whatever their cells; only those are measured in double.
    """
    out = f"_q int, id {state.kind}, cell int, near double, distance double"
    cells = [(j, c) for j, c in enumerate(order) if state.cells[c]["n"] and wanted[j].any()]
    if not cells:
        return state.spark.createDataFrame([], out)
    spark, rows, exact = state.spark, sum(state.cells[c]["n"] for _, c in cells), measured or not coded
    sent = spark.sparkContext.broadcast((q, np.array([c for _, c in cells]), wanted[[j for j, _ in cells]], edge, state.books))

    def near(batches):
        q, names, bits, edge, books = sent.value
        held = _Best(len(q), k, edge)
        square = (q * q).sum(1)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                own, home = np.unique(part.column("cell").to_numpy(), return_inverse=True)
                asks = np.unpackbits(bits[np.searchsorted(names, own)], axis=1, count=len(q)).astype(bool)
                v = _matrix(part.column("v")) if exact else None
                m = books.vectors(np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(part.num_rows, -1)) if coded else v
                size = (m * m).sum(1)
                some = np.flatnonzero(asks.any(0))
                # squares that single floats hold
                kind = np.float32 if max(size.max(), square[some].max(initial=0)) < 1e30 else np.float64
                slack = (8 + q.shape[1]) * np.finfo(kind).eps
                t, n = m.T.astype(kind), size.astype(kind)
                step = max(1, BLOCK_VALUES // part.num_rows)
                for at in range(0, len(some), step):
                    who = some[at : at + step]
                    sq = q[who].astype(kind) @ t
                    sq *= -2
                    sq += n
                    sq += square[who].astype(kind)[:, None]
                    every = asks[:, who].all()
                    if not every:
                        sq[~asks[:, who].T[:, home]] = np.inf
                    wide = slack * (square[who] + size.max()) + 1e-36
                    top = np.nextafter((held.edge[who] ** 2 + wide).astype(kind), kind(np.inf))
                    ok = sq <= top[:, None]
                    if not every:
                        ok &= sq < np.inf
                    if k < part.num_rows and np.count_nonzero(ok) > 2 * k * len(who):  # no good edge yet
                        top = np.minimum(top, np.partition(sq, k - 1, axis=1)[:, k - 1] + 2 * wide).astype(kind)
                        ok &= sq <= np.nextafter(top, kind(np.inf))[:, None]
                    i, j = np.nonzero(ok)
                    if len(i):
                        d = _apart(q, v, who[i], j) if exact else None
                        held.take(who[i], part.column("id").take(pa.array(j)), part.column("cell").take(pa.array(j)), np.sqrt(np.maximum(sq[i, j], 0)).astype(np.float64) if coded else d, d)
        held.cut()
        if held.rows is not None:
            yield from held.rows.to_batches()

    columns = ["id", *["code"] * coded, *["v"] * exact]
    # a task answers with k rows a query, so there are no more tasks than keep the cores busy, or than have many rows
    return state.rows([c for _, c in cells], *columns).coalesce(max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))).mapInArrow(near, out)


def _apart(q: np.ndarray, v: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of query i and row j from their differences, so that equal rows are equally far."""
    out = np.empty(len(i))
    step = max(1, BLOCK_VALUES // max(1, q.shape[1]))
    for lo in range(0, len(i), step):
        x = q[i[lo : lo + step]]
        x -= v[j[lo : lo + step]]
        out[lo : lo + step] = np.sqrt(np.einsum("ij,ij->i", x, x))
    return out


class _Best:
    """The k nearest rows of each of n queries so far, and how far a row may be to be one; ties go by id."""

    def __init__(self, n: int, k: int, edge: np.ndarray) -> None:
        self.n, self.k, self.edge = n, k, edge.copy()
        self.rows: pa.Table | None = None
        self.new: list[pa.Table] = []
        self.pending = 0

    def take(self, who, ids, cells, near, distance) -> None:
        ok = near <= self.edge[who]
        t = pa.table({"_q": pa.array(who, pa.int32()), "id": ids, "cell": cells, "near": pa.array(near), "distance": pa.array(near if distance is None else distance)})
        self.new.append(t if ok.all() else t.filter(pa.array(ok)))
        self.pending += self.new[-1].num_rows
        if self.pending > max(PENDING, self.rows.num_rows if self.rows else 0):
            self.cut()

    def cut(self) -> None:
        if not self.pending:
            return
        table = pa.concat_tables(([self.rows] if self.rows else []) + self.new).combine_chunks()
        self.new, self.pending = [], 0
        q, near = table.column("_q").to_numpy(), table.column("near").to_numpy()
        order = np.lexsort((near, q))
        who, far = q[order], near[order]
        begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        n = np.diff(np.r_[begin, len(who)])
        full = n >= self.k
        self.edge[who[begin[full]]] = np.minimum(self.edge[who[begin[full]]], far[begin[full] + self.k - 1])
        keep = far <= self.edge[who]
        table = table.take(pa.array(order[keep]))
        if table.num_rows > 2 * self.k * len(begin):  # many are as far as the k-th
            table = table.sort_by([("_q", "ascending"), ("near", "ascending"), ("id", "ascending")])
            who = table.column("_q").to_numpy()
            begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            table = table.filter(pa.array(np.arange(len(who)) - np.repeat(begin, np.diff(np.r_[begin, len(who)])) < self.k))
        self.rows = table


def _wants(q: np.ndarray, state: _State, order: list[int], bound: np.ndarray, probe: int | None) -> np.ndarray:
    """Which cells a query wants, as a row of bits a cell: of its ``probe`` nearest, or of all, those that may hold a row within its bound."""
    centres, radius = state.centres(), np.array([state.cells[c]["radius"] for c in order])
    out = np.zeros((len(order), -(-len(q) // 8)), np.uint8)
    step = 8 * max(1, BLOCK_VALUES // (8 * max(1, len(order))))
    for lo in range(0, len(q), step):
        away = distances(q[lo : lo + step], centres, "l2")
        fits = away - radius[None, :] <= bound[lo : lo + step, None] + 1e-9
        if probe is not None and probe < len(order):
            edge = np.partition(away, probe - 1, axis=1)[:, probe - 1 : probe]
            less, same = away < edge, away == edge
            fits &= less | (same & (same.cumsum(1) <= probe - less.sum(1, keepdims=True)))  # of cells as near the first
        bits = np.packbits(fits.T, axis=1)
        out[:, lo // 8 : lo // 8 + bits.shape[1]] = bits
    return out


def _measure(state: _State, near: DataFrame, cells: list[int], q: np.ndarray) -> DataFrame:
    """Exact distances of candidates (_q, id), at most a block of queries times ``rerank``; only their cells' vectors are read."""
    rows = near.select("_q", "id").collect()
    sent = state.spark.sparkContext.broadcast((q, np.array([r["_q"] for r in rows], np.int32), [r["id"] for r in rows]))
    kind = state.kind

    def exact(batches):
        q, who, names = sent.value
        order = None
        for b in batches:
            if not b.num_rows:
                continue
            if order is None:
                ids = pa.array(names, b.column("id").type)
                values = pc.unique(ids)
                at = pc.index_in(ids, values).to_numpy(zero_copy_only=False)
                order = np.argsort(at, kind="stable")
                begin = np.searchsorted(at[order], np.arange(len(values) + 1))
            hit = pc.index_in(b.column("id"), values)
            some = np.flatnonzero(hit.is_valid().to_numpy(zero_copy_only=False))
            if not len(some):
                continue
            part = b.take(pa.array(some))
            place = hit.take(pa.array(some)).to_numpy(zero_copy_only=False)
            n = begin[place + 1] - begin[place]
            row = np.repeat(np.arange(len(some)), n)
            asked = who[order[np.repeat(begin[place], n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)]]
            m = _matrix(part.column("v"))
            d = np.sqrt(((m[row] - q[asked]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([pa.array(asked, pa.int32()), part.column("id").take(pa.array(row)), part.column("cell").take(pa.array(row)), pa.array(d)], ["_q", "id", "cell", "distance"])

    return state.rows(cells, "id", "v").mapInArrow(exact, f"_q int, id {kind}, cell int, distance double")


def topk(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    *,
    k: int = 10,
    probe: int = 8,
    exact: bool = False,
    distance: float | None = None,
    rerank: int = 0,
    recall: float = 0.0,
    id_kind: str | None = None,
    vec_col: str = "embedding",
    query_col: str = "query",
) -> DataFrame:
    """query, id, distance, rank: of each query the k nearest rows (within the distance, if there is one) of its ``probe`` nearest cells, or of all with ``exact``.

    ``rerank`` candidates a query (10 k, at least 100, if 0) are measured exactly.  With ``recall`` both are where the search begins: they grow until a sample of the queries finds that share of its
    exact result, as more cells are needed the more there are.
    """
    state = _State(spark, path)
    kind = dict(queries.dtypes)[query_col]
    found = spark.createDataFrame([], f"{query_col} {kind}, id {id_kind or state.kind}, distance double, rank int")
    asked = queries.where((F.size(vec_col) == state.size) & ~F.exists(vec_col, lambda x: x.isNull()))
    n = asked.count() if state.cells else 0
    block = max(QUERIES, QUERY_VALUES // max(1, state.size))
    parts = -(-5 * n // (4 * block)) if n > block else 1  # dealt by hash, so with some room
    rerank = rerank or max(100, 10 * k)
    if n > QUERIES and exact and distance is not None:
        return _within(state, asked.select(F.col(query_col).alias("query"), F.col(vec_col).cast("array<double>").alias("v")), n, k, distance).withColumnRenamed("query", query_col)
    if n and recall and not exact:
        probe, rerank = _enough(state, asked.select(query_col, vec_col).orderBy(F.xxhash64(query_col, vec_col), query_col).limit(SAMPLED).collect(), kind, k, probe, rerank, distance, recall, query_col)
    for p in range(parts if n else 0):
        own = (asked if parts == 1 else asked.where(F.pmod(F.xxhash64(query_col, vec_col), F.lit(parts)) == p)).select(query_col, vec_col).collect()
        if own:
            found = found.unionByName(_searched(state, own, kind, k, probe, exact, distance, rerank, query_col))
    return found


def _within(state: _State, asked: DataFrame, n: int, k: int, within: float) -> DataFrame:
    """The k nearest within the distance of each of n queries (query, v), as a join: query, id, distance, rank."""
    metric, kind, out = state.metric, state.kind, f"_q long, id {state.kind}, distance double"
    limit = float(np.sqrt(2 * within)) if metric == "cosine" else within
    asked = Tables(state.spark, "vector-index").cut(asked.withColumn("_q", F.monotonically_increasing_id()))  # written, so that numbers stay
    order = [c for c in state.order() if state.cells[c]["n"]]
    # a cell's rows in parts, and the queries in blocks; every part meets every block that has queries for the cell
    blocks = min(-(-n // BLOCK), max(SPREAD, -(-n // MOST)))
    parts = {c: -(-state.cells[c]["n"] // MOST) for c in order}
    sent = state.spark.sparkContext.broadcast((np.array(order, np.int32), *(np.array([state.cells[c][x] for c in order], np.float64) for x in ("centre", "radius"))))

    def reach(batches):
        names, centres, radius = sent.value
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                m = _scaled(_matrix(part.column("v")), metric)
                fine = np.isfinite(m).all(1)
                row, cell = np.nonzero((distances(np.where(fine[:, None], m, 0.0), centres, "l2") - radius[None, :] <= limit + 1e-9) & fine[:, None])
                v = pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(names[cell]), part.column("_q").take(pa.array(row)), v.take(pa.array(row))], ["cell", "_q", "v"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        own = pc.is_valid(table.column("_q"))
        queries, rows = table.filter(own), table.filter(pc.invert(own))
        if not queries.num_rows or not rows.num_rows:
            return
        who, ids = queries.column("_q").to_numpy(), pa.concat_arrays(rows.column("id").chunks)
        for i, j, d in compare(_matrix(queries.column("v")), _matrix(rows.column("v")), limit):
            if len(i) and np.bincount(i - i.min()).max() > k:
                at = np.lexsort((d, i))
                i, j, d = i[at], j[at], d[at]
                begin = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
                size = np.diff(np.r_[begin, len(i)])
                edge = np.where(size > k, d[np.minimum(begin + k, begin + size) - 1], np.inf)
                keep = d <= np.repeat(edge, size)  # those as far as the k-th stay, as ties go by id
                i, j, d = i[keep], j[keep], d[keep]
            yield pa.RecordBatch.from_arrays([pa.array(who[i]), ids.take(pa.array(j)), pa.array(d)], ["_q", "id", "distance"])

    queries = asked.select("_q", "v").mapInArrow(reach, "cell int, _q long, v array<double>")
    many = F.element_at(F.create_map(*[F.lit(int(x)) for c in order for x in (c, parts[c])]), F.col("cell"))
    queries = queries.select("cell", F.explode(F.sequence(F.lit(0), many - 1)).alias("part"), F.pmod(F.xxhash64("_q"), F.lit(blocks)).cast("int").alias("block"), "_q", F.lit(None).cast(kind).alias("id"), "v")
    rows = state.rows(order, "id", "v").select("cell", F.pmod(F.xxhash64("id"), many).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(None).cast("long").alias("_q"), "id", "v")
    # as many partitions as groups and more: each is much work, so none are put together
    both = queries.unionByName(rows).repartition(min(2 * blocks * sum(parts.values()), 1024), "cell", "part", "block")
    found = both.groupBy("cell", "part", "block").applyInArrow(near, out)
    # dealt by query before it is ranked, so that it is sorted once
    best = found.repartition("_q").withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy("distance", "id"))).where(F.col("rank") <= k)
    value = F.col("distance") * F.col("distance") / 2 if metric == "cosine" else F.col("distance")
    return best.join(asked.select("_q", "query"), "_q").select("query", "id", value.alias("distance"), F.col("rank").cast("int").alias("rank"))


def _enough(state: _State, asked: list, kind: str, k: int, probe: int, rerank: int, within: float | None, recall: float, query_col: str) -> tuple[int, int]:
    """How many cells and candidates give the recall, and ``SPARE`` over it, on these (at most ``SAMPLED``) queries: first the cells double, and where all are searched the candidates.

    Where the exact result lies tells how much of it so many cells can find at most; numbers of cells that cannot be enough are not tried."""
    q = _scaled(np.array([r[1] for r in asked], np.float64).reshape(len(asked), state.size), state.metric)
    asked, q = [r for r, fine in zip(asked, np.isfinite(q).all(1), strict=True) if fine], q[np.isfinite(q).all(1)]
    search = lambda probe, exact: _found(state, asked, kind, k, probe, exact, within, rerank, query_col).select(query_col, "id", "_q", "cell").collect()
    pairs = lambda rows: Counter((r[0], r[1]) for r in rows)
    best = search(4, True)
    whole, rows = pairs(best), sum(x["n"] for x in state.cells.values())
    place = {c: j for j, c in enumerate(state.order())}
    nearer = distances(q, state.centres(), "l2").argsort(1, kind="stable").argsort(1)
    cell = np.array([nearer[r["_q"], place[r["cell"]]] for r in best], int)  # how many cells are nearer than that of a row
    enough = min(1.0, recall + SPARE) * whole.total()
    while probe < len(state.cells) and (cell < probe).sum() < enough:
        probe = min(2 * probe, len(state.cells))
    while (whole & pairs(search(probe, False))).total() < enough:
        if probe < len(state.cells):
            probe = min(2 * probe, len(state.cells))
        elif rerank < rows:
            rerank = min(2 * rerank, rows)
        else:
            break
    return probe, rerank


def _searched(state: _State, asked: list, kind: str, k: int, probe: int, exact: bool, within: float | None, rerank: int, query_col: str) -> DataFrame:
    found = _found(state, asked, kind, k, probe, exact, within, rerank, query_col)
    return found.select(query_col, "id", "distance", "rank")


def _found(state: _State, asked: list, kind: str, k: int, probe: int, exact: bool, within: float | None, rerank: int, query_col: str) -> DataFrame:
    q = _scaled(np.array([r[1] for r in asked], np.float64).reshape(len(asked), state.size), state.metric)
    ok = np.isfinite(q).all(1)
    asked, q = [r for r, fine in zip(asked, ok, strict=True) if fine], q[ok]
    order = state.order()
    # stored distances are those of scaled vectors
    limit = np.inf if within is None else np.sqrt(2 * within) if state.metric == "cosine" else within
    bound = np.full(len(q), limit)
    wanted = _wants(q, state, order, bound, probe)
    ranked = lambda d, by, n: d.withColumn("rank", F.row_number().over(Window.partitionBy("_q").orderBy(by, "id"))).where(F.col("rank") <= n)
    if exact:
        near = Tables(state.spark, "vector-index").cut(ranked(_scan(state, order, q, wanted, k, False, bound), "distance", k))
        for r in near.where(F.col("rank") == k).select("_q", "distance").collect():  # a row a query of this block
            bound[r["_q"]] = min(bound[r["_q"]], r["distance"])
        more = _wants(q, state, order, bound, None) & ~wanted
        near = near.drop("rank").unionByName(_scan(state, order, q, more, k, False, bound))
    elif len(q) > QUERIES:  # more candidates than should come to the driver
        near = ranked(_scan(state, order, q, wanted, rerank, True, np.full(len(q), np.inf), measured=True), "near", rerank)
    else:
        near = _measure(state, ranked(_scan(state, order, q, wanted, rerank, True, np.full(len(q), np.inf)), "near", rerank), [c for j, c in enumerate(order) if wanted[j].any()], q)
    near = ranked(near.where(F.col("distance") <= limit) if within is not None else near, "distance", k)
    names = state.spark.createDataFrame([(i, r[0]) for i, r in enumerate(asked)], f"_q int, {query_col} {kind}")
    value = F.col("distance") * F.col("distance") / 2 if state.metric == "cosine" else F.col("distance")
    return near.join(names, "_q").withColumn("distance", value).withColumn("rank", F.col("rank").cast("int"))


def vacuum(spark: SparkSession, path: str) -> None:
    """Remove folders that the newest version does not read: rows of cells since split, batches that failed, older versions."""
    state = _State(spark, path)
    live = {(b, c) for c, x in state.cells.items() for b in x["batches"]}
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = jvm.Path(f"{state.path}/rows")
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(place) if fs.exists(place) else ():
        batch = f.getPath().getName()[6:]
        if batch not in {b for b, _ in live}:
            remove(spark, f.getPath().toString())
            continue
        for g in fs.listStatus(f.getPath()):
            name = g.getPath().getName()
            if name.startswith("cell=") and (batch, int(name[5:])) not in live:
                remove(spark, g.getPath().toString())
    for f in fs.listStatus(jvm.Path(f"{state.path}/cells")):
        if f.getPath().getName() != f"v={state.version}":
            remove(spark, f.getPath().toString())
