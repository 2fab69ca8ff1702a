"""What the operators share: cut lineage, small Arrow batches, and set filters of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.batches import small_batches
from ..operators.durable import cut, shared_folder

__all__ = ["bitmap", "cut", "maybe_in", "shared_folder", "size_cuts", "small_batches"]

BITS = 1 << 25


def bit_of(column: str) -> F.Column:
    return F.pmod(F.xxhash64(F.col(column)), F.lit(BITS))


def bitmap(df: DataFrame, column: str) -> bytearray:
    """One bit for each hash of a value: 4 MB however many rows there are.  With more values more bits are set, which lets more rows through, never fewer."""
    # Spark numbers bitmap positions from 1
    rows = df.select((bit_of(column) + 1).alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    out = bytearray(BITS // 8 + 8192)
    for k, m in rows.collect():  # at most BITS / 32768 rows of 4 KB
        out[(k - 1) * 4096 : (k - 1) * 4096 + len(m)] = m
    return out


def maybe_in(df: DataFrame, column: str, bits: bytearray, keep: bool = True, then=None, schema=None) -> DataFrame:
    """Rows whose value may be (or with keep=False is surely not) among those of the bitmap; no shuffle.

    ``then`` (batches -> batches, with its schema) works on what is left, in the same pass.
    """
    import numpy as np
    import pyarrow as pa

    small_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(bytes(bits))
    marked = df.withColumn("_bit", bit_of(column))

    def left(batches):
        table = np.frombuffer(sent.value, np.uint8)
        for b in batches:
            at = b.column(len(b.columns) - 1).to_numpy(zero_copy_only=False)
            hit = (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            kept = b.filter(pa.array(hit.astype(bool) if keep else ~hit.astype(bool)))
            yield pa.RecordBatch.from_arrays(kept.columns[:-1], kept.schema.names[:-1])

    def run(batches):
        yield from then(left(batches)) if then else left(batches)

    return marked.mapInArrow(run, schema or df.schema)


def size_cuts(sized: DataFrame, batch_mb: int) -> list[int]:
    """(_id long, _n long, bytes) -> the ids at which stretches of about batch_mb begin, but the first.  Ids and sizes alone are sorted by ranges; each range gives its stretches of about batch_mb, one row each, and small neighbours merge here."""
    limit = batch_mb << 20
    import pyarrow as pa

    parts = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def stretches(batches):
        first, last, size, out = None, None, 0, []
        for b in batches:
            for i, n in zip(b.column("_id").to_pylist(), b.column("_n").to_pylist(), strict=True):
                if first is None:
                    first = i
                elif i != last and size + n > limit:
                    out.append((first, size))
                    first, size = i, 0
                last, size = i, size + n
        if first is not None:
            out.append((first, size))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([n for _, n in out], pa.int64())], ["first", "size"])

    rows = sized.where("_id is not null").repartitionByRange(parts, "_id").sortWithinPartitions("_id").mapInArrow(stretches, "first long, size long")
    bounds, size = [], None
    for first, n in sorted((r["first"], r["size"]) for r in rows.toLocalIterator()):  # one row a batch
        if size is None or size + n > limit:
            if size is not None:
                bounds.append(first)
            size = 0
        size += n
    return bounds
