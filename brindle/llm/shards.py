"""Sharding by the longest-processing-time rule: groups that must stay together, largest first, each to the shard with the least load so far.

The rule needs the sizes alone, and groups of one size are alike, so it goes through the table (size, number of groups) from large to small.  One task streams it, with a
heap of loads and no rows held (``schedule``); of many groups of one size it takes those that the heap would deal out before a common level in one step.
What comes out, for each size the number of groups that each shard gets, is a table that joins the groups; a group takes its shard from its rank
in its size.  Ranks and slots are numbered in salted parts whose offsets are running sums of part counts, so no size and no shard is numbered by a single task.

Defined cases: null and empty texts are one group of size 1 a row; repeated rows are rows; a null id is numbered like others; a very long text is one group by its hash;
an empty table gives no rows; only the id and the text are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.durable import Tables
from .shared import cut

PART_ROWS = 20_000


def schedule(sizes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """(size, groups) from large to small -> (size, groups for each shard): to the least load each, the lower shard if loads are equal."""
    loads = [0] * shards
    for size, n in sizes:
        take = [0] * shards
        if n > 4 * shards:  # all turns at loads up to the level come before any other turn
            dealt = lambda level: sum(max(0, (level - x) // size + 1) for x in loads)  # noqa: B023, E731
            low, high = min(loads) - 1, max(loads) + n * size
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if dealt(middle) <= n else (low, middle)
            take = [max(0, (low - x) // size + 1) for x in loads]
        heap = [(x + t * size, k) for k, (x, t) in enumerate(zip(loads, take, strict=True))]
        heapq.heapify(heap)
        for _ in range(n - sum(take)):
            load, k = heap[0]
            take[k] += 1
            heapq.heapreplace(heap, (load + size, k))
        loads = [x + t * size for x, t in zip(loads, take, strict=True)]
        yield size, take


def _plan(sizes: DataFrame, shards: int) -> DataFrame:
    """(bytes, n) -> (bytes, ends): the first ``ends[0]`` groups of a size go to shard 0, those up to ``ends[1]`` to shard 1, ..."""

    def run(batches):
        rows = ((s, n) for b in batches for s, n in zip(b.column("bytes").to_pylist(), b.column("n").to_pylist(), strict=True))
        out: list[tuple[int, list[int]]] = []
        pack = lambda: pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([e for _, e in out], pa.list_(pa.int64()))], ["bytes", "ends"])
        for size, take in schedule(rows, shards):
            ends = []
            for t in take:
                ends.append(t + (ends[-1] if ends else 0))
            out.append((size, ends))
            if len(out) == 4096:
                yield pack()
                out = []
        yield pack()

    return sizes.repartition(1).sortWithinPartitions(F.col("bytes").desc()).mapInArrow(run, "bytes long, ends array<long>")


def _numbered(df: DataFrame, by: str, order: list[str], salt: str, parts: int, name: str) -> DataFrame:
    """A gapless number from 0 within each value of ``by``, made in parts by the (written) salt."""
    df = df.withColumn("_part", F.pmod(F.col(salt), F.lit(parts)).cast("int"))
    counts = df.groupBy(by, "_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(by).orderBy("_part")
    counts = counts.select(F.col(by), "_part", (F.sum("_n").over(w) - F.col("_n")).alias("_from"))
    inside = F.row_number().over(Window.partitionBy(by, "_part").orderBy(*order)) - 1
    return df.withColumn("_in", inside).join(counts, [by, "_part"]).withColumn(name, (F.col("_from") + F.col("_in")).cast("long")).drop("_part", "_from", "_in")


def assign(docs: DataFrame, shards: int = 8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, group (the hash of the text), shard, slot; a group is one text, all of its rows are in one shard."""
    raw = F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.unhex(F.substring(F.sha2(raw, 256), 1, 32)).alias("group"))
    # the salt of a row is written with it, so that equal rows spread and a task that runs again sees the same one
    rows = cut(rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "group"), F.lit(1 << 40)) + F.monotonically_increasing_id() % 9973))
    tables = Tables(docs.sparkSession, "shards")
    groups = tables.cut(rows.groupBy("group").agg(F.sum("size").alias("bytes")).withColumn("_hash", F.xxhash64("group")))
    n, n_rows = groups.count(), rows.count()
    plan = tables.cut(_plan(groups.groupBy("bytes").agg(F.count(F.lit(1)).alias("n")), shards))
    ranked = _numbered(groups, "bytes", ["group"], "_hash", max(1, -(-n // PART_ROWS)), "rank").join(plan, "bytes")
    placed = ranked.select("group", F.size(F.filter("ends", lambda e: e <= F.col("rank"))).cast("int").alias("shard"))
    placed = cut(rows.join(placed, "group"))
    tables.close()
    return _numbered(placed, "shard", ["doc_id", "group"], "_salt", max(1, -(-n_rows // PART_ROWS)) * 2, "slot").drop("_salt")
