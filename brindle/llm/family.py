"""A logarithmic family of sorted suffix runs that stays in a folder and takes batch after batch of documents.

``add`` judges a new batch against everything that was added before, then adds it: a byte goes if a string of ``length`` bytes that covers
it starts in a document of an earlier batch, or in one of its own batch with a smaller id.  When ids grow from batch to batch the rows
are those of one run of ``suffix.repeats`` over all documents.

* A batch's sparse suffix array (minimisers, as in ``suffix``) is written as a run: for each suffix its hash and the block of bytes that all
  strings around it fill, each different pair once, dealt by ranges of both columns and sorted.  Every string of ``length`` bytes of a document lies in one of its blocks.
* The new batch is scanned against each run: a bitmap of its suffixes (4 MB) lets rows through without a shuffle, and a
  semi-join keeps those whose suffix the batch has.  Their blocks go before the batch as small documents, and ``suffix.repeats`` finds the exact matches.
* The rank of a run is the logarithm of its rows.  Two runs of equal rank merge, pairs that both hold once, so there are at most log2(rows) runs and a row is
  rewritten at most that often.

A run takes about six bytes for each new byte of text before compression; nothing is collected but the names and sizes of the runs.

A state of the family is one small table of runs.  It counts from when its writing ended, so an ``add`` that fails, at whatever point, leaves the
state before it, and can be repeated.  One writer at a time.

Defined cases: ids are whole numbers from 0 on (others are an error) or null; a null id counts as larger than all of its batch; null, empty and short texts stay whole and add
nothing; a document of any length is worked off whole, as in ``suffix``; equal rows in one batch never serve each other; an empty batch gives no rows; of the columns only id and text are used.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.durable import remove
from . import suffix, vec
from .shared import bitmap, maybe_in, small_batches

_STATE = "name string, n_rows long, length long"
#: Bytes of blocks in one Arrow batch.
_PIECE = 8 << 20


def _blocks(docs: DataFrame, length: int) -> DataFrame:
    """(key long, block binary): each suffix of the sparse arrays with the bytes of the strings around it."""

    def run(batches):
        for b in batches:
            data, offsets = vec.text_buffer(b.column(0))
            for lo, hi in vec.slices(offsets):
                part = data[offsets[lo] : offsets[hi]]
                value, start, count, _ = suffix._runs(part, offsets[lo : hi + 1] - offsets[lo], length)
                size = count + length - 1
                ends = np.cumsum(size)
                at = 0
                while at < len(size):
                    to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PIECE, "right")))
                    bytes_ = part[suffix._expand(start[at:to], size[at:to])]
                    places = np.r_[0, np.cumsum(size[at:to])].astype(np.int32)
                    block = pa.Array.from_buffers(pa.binary(), to - at, [None, pa.py_buffer(places), pa.py_buffer(bytes_)])
                    yield pa.RecordBatch.from_arrays([pa.array(value[at:to].view(np.int64)), block], ["key", "block"])
                    at = to

    return docs.select("_bytes").mapInArrow(run, "key long, block binary")


class SuffixFamily:
    """The family in ``folder``, which all executors reach."""

    def __init__(self, spark: SparkSession, folder: str, length: int = 50) -> None:
        self.spark, self.folder, self.length = spark, folder.rstrip("/"), length
        if any(r["length"] != length for r in self._state()[1]):
            raise ValueError(f"the family in {folder} has another length")

    def _state(self):
        """The number of the last whole state, and its runs."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/state-*/_SUCCESS")
        found = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        numbers = [int(f.getPath().getParent().getName().removeprefix("state-")) for f in found or []]
        if not numbers:
            return 0, []
        return max(numbers), self.spark.read.schema(_STATE).parquet(f"{self.folder}/state-{max(numbers)}").collect()  # one row a run

    def _commit(self, number: int, runs) -> None:
        rows = [(r["name"], r["n_rows"], r["length"]) for r in runs]
        self.spark.createDataFrame(rows, _STATE).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/state-{number}")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema("key long, block binary").parquet(f"{self.folder}/{name}")

    def _write(self, rows: DataFrame) -> dict:
        """A sorted run of the different rows."""
        name = f"run-{uuid.uuid4().hex}"
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows.distinct().repartitionByRange(parts, "key", "block").sortWithinPartitions("key", "block").write.parquet(f"{self.folder}/{name}")
        return {"name": name, "n_rows": self._read(name).count(), "length": self.length}

    def runs(self) -> list[int]:
        """Rows of each run."""
        return sorted(r["n_rows"] for r in self._state()[1])

    def add(self, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", batch_mb: int = 8) -> DataFrame:
        """Judge the batch, then add it; the rows of ``suffix.repeats`` for it, which are written in the folder and stay until their reader removes them."""
        small_batches(self.spark)
        batch = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_bytes"))
        least = batch.agg(F.min("_id")).first()[0]
        if least is not None and least < 0:
            raise ValueError("ids are whole numbers from 0 on")
        number, runs = self._state()
        fresh = self._write(_blocks(batch, self.length))
        both = batch
        if runs and fresh["n_rows"]:
            keys = self._read(fresh["name"]).select("key").distinct()
            bits = bitmap(keys, "key")
            for r in runs:
                met = maybe_in(self._read(r["name"]), "key", bits).join(keys, "key", "left_semi")
                both = both.unionByName(met.select((-1 - F.shiftrightunsigned(F.xxhash64("block"), 1)).alias("_id"), F.col("block").alias("_bytes")))
        out = f"{self.folder}/found-{uuid.uuid4().hex}"
        found = suffix.repeats(both, id_col="_id", text_col="_bytes", length=self.length, batch_mb=batch_mb).where("_id is null or _id >= 0")
        found.withColumnRenamed("_id", id_col).write.parquet(out)
        if fresh["n_rows"]:
            runs = [*runs, fresh]
            number += 1
            self._commit(number, runs)
            self._merge(number, runs)
        else:
            remove(self.spark, f"{self.folder}/{fresh['name']}")
        return self.spark.read.parquet(out)

    def _merge(self, number: int, runs) -> None:
        """Merge runs of equal rank until there are none; what a state no longer names goes after it is written."""
        gone = [f"state-{number - 1}"]
        while True:
            by_rank: dict[int, list] = {}
            for r in runs:
                by_rank.setdefault(r["n_rows"].bit_length(), []).append(r)
            pair = next((x[:2] for _, x in sorted(by_rank.items()) if len(x) > 1), None)
            if pair is None:
                break
            made = self._write(self._read(pair[0]["name"]).unionByName(self._read(pair[1]["name"])))
            runs = [r for r in runs if r["name"] not in (pair[0]["name"], pair[1]["name"])] + [made]
            gone += [pair[0]["name"], pair[1]["name"], f"state-{number}"]
            number += 1
            self._commit(number, runs)
        for name in gone:
            remove(self.spark, f"{self.folder}/{name}")
