"""All pairs of vectors within a distance, by recursive hyperplane partitions.

A bounded sample grows a binary tree on the driver: a node's hyperplane is normal to the line between two far members, and lies in their middle or at the median.  Two vectors within eps are no farther apart along the
normal, so those on the left within eps of the plane visit the right side as guests, and every pair that crosses meets there.  A node is split only where the sample says that this saves comparisons, so an eps that is large in one
direction still prunes along others, and where nothing prunes no copies are made.

Each copy carries the levels at which it is a guest.  A pair counts where no level has both as guests: at each node it goes left if both are at home there, and right otherwise, so it counts in one leaf.

A leaf of more than ``block`` rows is cut into blocks by hash, and each pair of blocks is a task's own, so a dense region spreads.  There are at most ``SPREAD`` blocks to a leaf, as each row is sent once for each, until they would be
of more than ``MOST`` rows; so what is shuffled grows with the rows and only the comparisons with their square.  A task compares a tile of rows at a time by one product of single floats, whose error is bounded (of doubles where that
bound is too wide), measures what this cannot rule out from the differences in double, and hands its pairs on tile by tile.
Where only sums or parts of the graph of pairs are wanted, ``neighbours`` and ``links`` take them inside each task, so that what leaves it grows with its rows and not with its pairs, which grow with the square of the table.
``report`` tells for each leaf its rows at home, its guests, blocks, and how many pairs its tasks compare.

Defined cases: null vectors and those with a null or non-finite component have no pairs; vectors of different lengths never meet; repeated ids are rows of their own, but pair only with other ids; equal vectors
pair at distance 0 (``cluster.dbscan`` puts them together first); an empty table has no pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import unite
from .search import _matrix

SLICE, TILE = 512, 4096  # rows of one side and the other that are compared at a time
SPREAD, MOST = 16, 65_536
MEASURED = 1 << 14  # pairs whose differences are held at a time
LEVELS = 62
GAIN = 0.85  # a split must leave at most this share of a node's comparisons


@dataclass
class Node:
    """An inner node has a normal, an offset and two children; a leaf has a number."""

    normal: np.ndarray | None = None
    offset: float = 0.0
    left: Node | None = None
    right: Node | None = None
    leaf: int = -1


@dataclass
class Tree:
    root: Node
    leaves: int
    depth: int
    sampled: int = field(default=0)


def grow(sample: np.ndarray, eps: float, rows: int, block: int) -> Tree:
    """The tree for about so many rows of which the sample is some."""
    scale = rows / max(1, len(sample))
    leaves = deepest = 0

    def node(at: np.ndarray, depth: int) -> Node:
        nonlocal leaves, deepest
        deepest = max(deepest, depth)
        best = None
        if len(at) * scale > block and len(at) > 16 and depth < LEVELS:
            own = sample[at]
            for start in range(0, len(at), max(1, len(at) // 6)):
                one = own[np.argmax(((own - own[start]) ** 2).sum(1))]
                two = own[np.argmax(((own - one) ** 2).sum(1))]
                gap = np.sqrt(((two - one) ** 2).sum())
                if gap == 0:
                    break  # equal vectors: no plane parts them
                normal = (two - one) / gap
                along = own @ normal
                for offset in (float(normal @ (one + two)) / 2, float(np.median(along))):
                    low = along < offset
                    right = int((~low).sum() + (low & (along >= offset - eps)).sum())
                    cost = int(low.sum()) ** 2 + right**2
                    if 0 < low.sum() < len(at) and (best is None or cost < best[0]):
                        best = (cost, normal, offset, along)
        if best is None or best[0] > GAIN * len(at) ** 2:
            leaves += 1
            return Node(leaf=leaves - 1)
        _, normal, offset, along = best
        return Node(normal, offset, node(at[along < offset], depth + 1), node(at[along >= offset - eps], depth + 1))

    root = node(np.arange(len(sample)), 0)
    return Tree(root, leaves, deepest, len(sample))


def place(root: Node, m: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, leaf and guest levels of each copy."""
    slack = eps + 1e-9 * (1.0 + float(np.sqrt((m * m).sum(1).max(initial=0.0))))  # for what rounding takes from a product
    rows, leaf, guest = [], [], []

    def down(node: Node, at: np.ndarray, mask: np.ndarray, depth: int) -> None:
        if not len(at):
            return
        if node.normal is None:
            rows.append(at)
            leaf.append(np.full(len(at), node.leaf, np.int32))
            guest.append(mask)
            return
        along = m[at] @ node.normal - node.offset
        low, visit = along < 0, (along < 0) & (along >= -slack)
        down(node.left, at[low], mask[low], depth + 1)
        both = ~low | visit
        down(node.right, at[both], mask[both] | np.where(visit[both], np.int64(1) << np.int64(depth), 0), depth + 1)

    down(root, np.arange(len(m)), np.zeros(len(m), np.int64), 0)
    z = np.zeros(0, np.int64)
    return np.concatenate([z, *rows]), np.concatenate([z.astype(np.int32), *leaf]), np.concatenate([z, *guest])


def _sides(m: np.ndarray, other: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray, float]:
    """Two matrices whose product is minus half the squared distance, and what it is at least for a pair within eps, whatever rounding did."""
    middle = other.mean(0)
    m, other = m - middle, other - middle
    a, b = (m * m).sum(1) / 2, (other * other).sum(1) / 2
    for kind in (np.float32, np.float64):
        slack = float((m.shape[1] + 8) * np.finfo(kind).eps * 4 * max(a.max(initial=0), b.max(initial=0)))
        if slack <= 0.025 * eps * eps:
            break
    left, right = np.c_[m, -a, np.ones(len(m))], np.c_[other, np.ones(len(other)), -b]
    return left.astype(kind), np.ascontiguousarray(right.astype(kind).T), -eps * eps / 2 - slack


def close(m: np.ndarray, other: np.ndarray | None, eps: float, wanted: Callable | None = None):
    """Pairs of rows within eps, at most ``MEASURED`` at a time: the slice, row, row of the other side (of the same, and later, without one), distance.

    wanted(rows, rows) says which of some pairs to measure, each time with what the caller has made of those before.
    """
    own = other is None
    other = m if own else other
    if not len(m) or not len(other):
        return
    with np.errstate(over="ignore", invalid="ignore"):
        left, right, least = _sides(m, other, eps)
        for lo in range(0, len(m), SLICE):
            for at in range(lo if own else 0, len(other), TILE):
                part = left[lo : lo + SLICE] @ right[:, at : at + TILE]
                hit = np.flatnonzero(~(part < least))  # what has no number stays in
                i, j = hit // part.shape[1] + lo, hit % part.shape[1] + at
                if own:
                    i, j = i[j > i], j[j > i]
                for k in range(0, len(i), MEASURED):
                    x, y = i[k : k + MEASURED], j[k : k + MEASURED]
                    if wanted is not None:
                        ok = wanted(x, y)
                        x, y = x[ok], y[ok]
                    gap = m[x] - other[y]
                    d = np.sqrt(np.einsum("ij,ij->i", gap, gap))
                    near = d <= eps
                    yield lo, x[near], y[near], d[near]


def compare(m: np.ndarray, other: np.ndarray | None, eps: float):
    """Pairs of rows within eps, a slice at a time: row, row of the other side, distance."""
    for _, found in groupby(close(m, other, eps), key=lambda f: f[0]):
        yield tuple(np.concatenate(c) for c in list(zip(*found, strict=True))[1:])


class RadiusJoin:
    """The join of one table of vectors of one length with itself."""

    def __init__(self, plain: DataFrame, size: int, eps: float, *, sample_rows: int = 4096, block: int = 2048, spread: int = SPREAD) -> None:
        """plain: id, v (all of this length), and columns that go with a row."""
        self.eps, self.block, self.spread, self.kind = eps, block, spread, dict(plain.dtypes)["id"]
        finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x) == float("inf")))
        self.plain = plain.where((F.size("v") == size) & finite)
        rows = self.plain.count()
        drawn = self.plain.orderBy(F.xxhash64("id"), "id").limit(sample_rows).coalesce(1).collect()  # bounded, and merged in a task; decides speed only
        self.tree = grow(np.array([r["v"] for r in drawn], np.float64).reshape(len(drawn), -1), eps, rows, block)
        root, names = self.tree.root, [*plain.columns, "leaf", "guest"]

        def assign(batches):
            for b in batches:
                for lo in range(0, b.num_rows, 4096):
                    part = b.slice(lo, 4096)
                    row, leaf, guest = place(root, _matrix(part.column(1)), eps)
                    yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in part.columns), pa.array(leaf, pa.int32()), pa.array(guest, pa.int64())], names)

        self.members = self.plain.mapInArrow(assign, "".join(f"{c} {t}, " for c, t in plain.dtypes) + "leaf int, guest long")

    def _sizes(self) -> DataFrame:
        n = F.count(F.lit(1))
        return self.members.groupBy("leaf").agg(F.count_if(F.col("guest") == 0).alias("home"), n.alias("n"), F.least(F.ceil(n / self.block), F.greatest(F.lit(self.spread), F.ceil(n / MOST))).cast("int").alias("blocks"))

    def report(self) -> DataFrame:
        """leaf, home (rows that are guests nowhere on the way), guests, blocks, compared (pairs of rows that tasks look at)."""
        s = self._sizes()
        return s.select("leaf", "home", (F.col("n") - F.col("home")).alias("guests"), "blocks", F.expr("n * (n - 1) div 2").alias("compared"))

    def _copies(self, blocks: dict[int, int]) -> DataFrame:
        """Each copy once for each block that its own meets."""
        own = self.members.withColumn("blocks", F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("leaf")))
        own = own.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        copies = own.select(*self.plain.columns, "guest", "leaf", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"))
        return copies.select(*self.plain.columns, "guest", "leaf", "mine", F.least("mine", "with").alias("lo"), F.greatest("mine", "with").alias("hi"))

    def _tasks(self, work: Callable, kind: str) -> DataFrame:
        """work(sides) of each two blocks that meet; one side where a block meets itself.  A side is a table and its vectors."""
        blocks = {r["leaf"]: r["blocks"] for r in self._sizes().collect()}  # a row a leaf
        if not blocks:
            return self.plain.sparkSession.createDataFrame([], kind)

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches)).combine_chunks()
            lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
            mine = table.column("mine").to_numpy()
            sides = [table] if lo == hi else [table.filter(pa.array(mine == x)) for x in (lo, hi)]  # inside a block only where it meets itself
            yield from work([(t, _matrix(t.column("v"))) for t in sides])

        # as many partitions as groups: those of a large leaf are few and each is much work, so none are put together
        groups = sum(n * (n + 1) // 2 for n in blocks.values())
        copies = self._copies(blocks)
        if max(blocks.values()) > 1:
            copies = copies.repartition(min(groups, 1024), "leaf", "lo", "hi")
        return copies.groupBy("leaf", "lo", "hi").applyInArrow(meet, kind)

    def pairs(self) -> DataFrame:
        """a < b, distance."""
        eps, kind = self.eps, self.kind

        def near(sides) -> Iterator[pa.RecordBatch]:
            m = [m for _, m in sides]
            guest, ids = ([f(t) for t, _ in sides] for f in (lambda t: t.column("guest").to_numpy(), lambda t: pa.concat_arrays(t.column("id").chunks)))
            for i, j, d in compare(m[0], m[1] if len(m) > 1 else None, eps):
                ok = np.flatnonzero((guest[0][i] & guest[-1][j]) == 0)
                yield pa.RecordBatch.from_arrays([ids[0].take(pa.array(i[ok])), ids[-1].take(pa.array(j[ok])), pa.array(d[ok])], ["a", "b", "distance"])

        found = self._tasks(near, f"a {kind}, b {kind}, distance double").where("a <> b")
        return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")

    def neighbours(self, weight: str, enough: int) -> DataFrame:
        """id, more: the weights of the rows within eps of each, in parts that are to be summed; ids are whole numbers.

        They are whole for a row whose sum, with its own weight, is below ``enough``; of others so many are counted that it is reached.
        """
        eps = self.eps

        def count(sides) -> Iterator[pa.RecordBatch]:
            m = [m for _, m in sides]
            guest, ids, own = ([t.column(c).to_numpy() for t, _ in sides] for c in ("guest", "id", weight))
            sums = [w.astype(np.int64) for w in own]

            def wanted(i, j):
                return ((guest[0][i] & guest[-1][j]) == 0) & (ids[0][i] != ids[-1][j]) & ((sums[0][i] < enough) | (sums[-1][j] < enough))

            for _, i, j, _ in close(m[0], m[1] if len(m) > 1 else None, eps, wanted):
                np.add.at(sums[0], i, own[-1][j])
                np.add.at(sums[-1], j, own[0][i])
            for one, total, w in zip(ids, sums, own, strict=True):
                some = np.flatnonzero(total > w)
                yield pa.RecordBatch.from_arrays([pa.array(one[some], pa.int64()), pa.array(total[some] - w[some], pa.int64())], ["id", "more"])

        return self._tasks(count, "id long, more long")

    def links(self, core: str) -> DataFrame:
        """src, dst, inner: pairs of core rows that join up the same rows as all pairs of core rows within eps, fewer than a task has rows; and not inner, from each other row to one core row of each part
        that those of its task make of the core rows within eps of it.  Ids are whole numbers."""
        eps = self.eps

        def join(sides) -> Iterator[pa.RecordBatch]:
            m = [m for _, m in sides]
            guest, ids, cores = ([t.column(c).to_numpy(zero_copy_only=False) for t, _ in sides] for c in ("guest", "id", core))
            shift = len(m[0]) if len(m) > 1 else 0
            names, root, border = np.concatenate(ids), np.arange(sum(map(len, m))), [np.zeros((2, 0), np.int64)]

            def wanted(i, j):
                a, b = cores[0][i], cores[-1][j]
                return ((guest[0][i] & guest[-1][j]) == 0) & (ids[0][i] != ids[-1][j]) & (a | b) & ~(a & b & (root[i] == root[j + shift]))

            for _, i, j, _ in close(m[0], m[1] if len(m) > 1 else None, eps, wanted):
                a, b, j = cores[0][i], cores[-1][j], j + shift
                unite(root, i[a & b], j[a & b])
                one = a ^ b
                border.append(np.stack([np.where(a, j, i)[one], np.where(a, i, j)[one]]))
            src = np.flatnonzero(root != np.arange(len(root)))
            other, near = np.concatenate(border, 1)
            other, near = np.unique(np.stack([other, root[near]]), axis=1)
            for x, y, inner in ((src, root[src], True), (other, near, False)):
                yield pa.RecordBatch.from_arrays([pa.array(names[x], pa.int64()), pa.array(names[y], pa.int64()), pa.array(np.full(len(x), inner))], ["src", "dst", "inner"])

        return self._tasks(join, "src long, dst long, inner boolean")


def joins(df: DataFrame, eps: float, *, id_col: str = "id", vec_col: str = "embedding", sample_rows: int = 4096, block: int = 2048, spread: int = SPREAD, keep: tuple[str, ...] = ()) -> list[RadiusJoin]:
    """A join for each length of vectors that the table has; its rows keep some columns."""
    plain = df.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"), *keep)
    sizes = [r["n"] for r in plain.select(F.size("v").alias("n")).where("n > 0").distinct().orderBy("n").collect()]  # a row a length
    return [RadiusJoin(plain, n, eps, sample_rows=sample_rows, block=block, spread=spread) for n in sizes]
