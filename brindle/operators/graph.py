"""Connected components of an edge table by contraction.

A round has two steps.  Tasks of ``TASK_BYTES`` of edges each first join up what they hold (union-find in memory), so that of any
number of edges a star for each of a task's parts is left.  Then every node goes to the least of itself and its
neighbours, and edges follow their ends; loops go.  The first round orders nodes by id (which ends stars at once), the later
ones by a hash that changes, so long paths shrink by a constant factor a round even where no task holds two of their edges.
It ends when one task holds all that is left.
Nodes with many neighbours cost one combining aggregate, never a list.  The rounds' maps, each much smaller than the one before, are
composed from the last to the first.  All intermediate tables lie in the shared folder and go at the end; no rows come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .durable import Tables, cut

TASK_BYTES = 4 << 20


def unite(root, x, y) -> None:
    """Join up pairs of places.  root leads from each place to the least one of its part, before and after."""
    import numpy as np

    x, y = root[x], root[y]
    while True:
        apart = x != y
        x, y = x[apart], y[apart]
        if not len(x):
            return
        low = np.minimum(x, y)
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        while True:  # pointers lead to ever lesser nodes
            up = root[root]
            if (up == root).all():
                break
            root[:] = up
        x, y = root[x], root[y]


def _settled(a, b):
    """Nodes of these edges, and the least node of each one's part."""
    import numpy as np

    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(nodes))
    unite(root, ends[: len(a)], ends[len(a) :])
    return nodes, nodes[root]


def _joined_up(itself: bool):
    """The edges of a task -> (node, the least node of its part), for those least ones too or not."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        none = np.zeros(0, np.int64)
        held, waiting, size = (none, none), [], 0
        for batch in batches:
            waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > 1 << 20:
                held = _settled(*(np.concatenate(c) for c in zip(held, *waiting, strict=True)))
                waiting, size = [], 0
        a, b = _settled(*(np.concatenate(c) for c in zip(held, *waiting, strict=True)))
        if not itself:
            a, b = a[a != b], b[a != b]
        for lo in range(0, len(a), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(a[lo : lo + (1 << 16)]), pa.array(b[lo : lo + (1 << 16)])], ["src", "dst"])

    return run


def connected_components(edges: DataFrame, *, rounds: int = 60) -> DataFrame:
    """edges (src long, dst long) -> (node, root) of every node that has an edge to another; equal roots: connected."""
    tables = Tables(edges.sparkSession, "components")
    edges = tables.cut(edges.where("src <> dst").select(F.col("src").cast("long"), F.col("dst").cast("long")))
    steps: list[DataFrame] = []
    for k in range(rounds):
        tasks = max(1, -(-tables.last_bytes() // TASK_BYTES))
        stars = tables.cut(edges.coalesce(tasks).mapInArrow(_joined_up(tasks == 1), "src long, dst long"))
        if tasks == 1:
            steps.append(stars.toDF("node", "root"))
            break
        order = F.col("b") if k == 0 else F.xxhash64("b", F.lit(k))
        both = F.explode(F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a in ("src", "dst") for b in ("src", "dst"))))
        near = stars.select(both.alias("e")).select("e.a", "e.b")
        step = tables.cut(near.groupBy("a").agg(F.min(F.struct(order.alias("o"), "b")).alias("m")).select(F.col("a").alias("node"), F.col("m.b").alias("root")))
        steps.append(step)
        left = step.select(F.col("node").alias("src"), F.col("root").alias("a"))
        right = step.select(F.col("node").alias("dst"), F.col("root").alias("b"))
        edges = tables.cut(stars.join(left, "src").join(right, "dst").where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = steps.pop()
    while steps:
        moved = found.withColumnsRenamed({"node": "at", "root": "to"})
        found = steps.pop().join(moved, F.col("root") == F.col("at"), "left").select("node", F.coalesce("to", "root").alias("root"))
    found = cut(found)
    tables.close()
    return found


def symmetric(edges: DataFrame, a: str = "url", b: str = "related_url") -> DataFrame:
    """Every edge in both directions, each once, without loops."""
    # an edge moves once, and is turned round where it has come to
    some = edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias(a), F.greatest(a, b).alias(b)).distinct()
    return both_ways(some, a, b)


def both_ways(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Each row, and the same with its ends changed over, from one reading of the edges."""
    ends = F.explode(F.array(F.struct(F.col(a).alias("a"), F.col(b).alias("b")), F.struct(F.col(b).alias("a"), F.col(a).alias("b"))))
    rest = [c for c in edges.columns if c not in (a, b)]
    return edges.select(ends.alias("_ends"), *rest).select(F.col("_ends.a").alias(a), F.col("_ends.b").alias(b), *rest)


def explode_edges(rows: DataFrame, from_col: str, to_col: str, *, from_name: str = "url", to_name: str = "related_url") -> DataFrame:
    """{from, [to, ...]} -> one distinct row an edge."""
    return rows.select(F.col(from_col).alias(from_name), F.explode(to_col).alias(to_name)).where(F.col(to_name).isNotNull()).distinct()


def resolved(edges: DataFrame, nodes: DataFrame, key: str, ends: tuple[str, str] = ("from_id", "to_id")) -> DataFrame:
    """Edges both of whose ends exist."""
    for end in ends:
        edges = edges.join(nodes.select(F.col(key).alias(end)), end, "left_semi")
    return edges


def relations(edges: DataFrame, relationship: str, as_of) -> DataFrame:
    """from_id, to_id -> typed edges of a date; relationship is SAME_AS, DERIVED_FROM or PUBLISHED."""
    return edges.select("from_id", "to_id").distinct().select("from_id", "to_id", F.lit(relationship).alias("relationship"), F.to_date(as_of).alias("ts"))


def published(sources: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """PUBLISHED edges from a source to each event with its base_url."""
    pairs = sources.select(F.col("id").alias("from_id"), "base_url").join(events.select(F.col("id").alias("to_id"), "base_url"), "base_url")
    return relations(pairs, "PUBLISHED", as_of)
