"""An inverted index: for each token the sorted ids of its rows, in stored blocks that a search reads instead of the rows.

Ids are whole numbers.  A chunk is a stretch of ids (``2^shift`` of them); the ids that a token has in a chunk are one block, coded as gaps in bytes of seven bits.  Blocks lie in
folders by a hash of their token (``bucket``), sorted by token and chunk, so a search reads the folders of its tokens, and of those the row groups that can hold them.  A dictionary keeps for each
token its number of rows and its first and last chunk.

``search`` deals the queries out to at most ``SPREAD`` deals.  A task has the queries of a deal and, of one chunk, the blocks of their tokens, each once however many queries ask for it; there the shortest list
of a query is looked up in the next.  So what moves are coded blocks (of each token asked for, at most ``SPREAD`` times) and a row for each query and chunk, never rows of the indexed table.

``add`` takes batch after batch.  Its blocks are appended below a folder of their own and count once the batch's dictionary has been written; a batch that failed leaves nothing behind that a search reads.

Defined cases: null tokens, rows without an id and rows whose list is null or empty are not in the index; rows of one id, in one batch or several, are one with the tokens of all; a token that a third of all rows have is
spread over tasks by id; a query without tokens finds nothing; a token that no row has makes an ``all`` query empty and adds nothing to an ``any`` query; an empty table makes an empty index.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .durable import Tables, remove

BLOCKS = "bucket int, token string, chunk long, n int, low long, gaps binary"
DICTIONARY = "batch string, token string, bucket int, n long, first long, last long"
SPREAD, QUERIES = 16, 1024  # deals of queries at most, and queries to a deal where that makes fewer
TOLD = 1 << 18  # hits that a task hands on at a time
PUSHED = 1000  # so many tokens are written into the scan's filter; more are joined


def _coded(gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers from 0, in bytes of seven bits, low ones first; the eighth bit says that more follow.  The bytes, and how many each number takes."""
    gaps = gaps.astype(np.uint64)
    size = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        size += gaps >= np.uint64(1) << np.uint64(7 * k)
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        own = size > k
        low = (gaps[own] >> np.uint64(7 * k) & np.uint64(127)).astype(np.uint8)
        out[at[own] + k] = low | np.where(size[own] > k + 1, 128, 0).astype(np.uint8)
    return out, size


def coded(gaps: np.ndarray) -> bytes:
    return _coded(gaps)[0].tobytes()


def decoded(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.zeros(0, np.int64)
    last = b < 128
    begin = np.flatnonzero(np.r_[True, last[:-1]])
    place = np.arange(len(b)) - np.repeat(begin, np.diff(np.r_[begin, len(b)]))
    return np.add.reduceat((b & 127).astype(np.uint64) << (7 * place).astype(np.uint64), begin).astype(np.int64)


def _blocks(rows: pa.Table, upto: int, begin: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """The blocks of the first ``upto`` rows; begin says where each block begins."""
    new = np.zeros(upto, bool)
    new[begin] = True
    keep = new | (np.r_[True, ids[1:upto] != ids[: upto - 1]])
    block = np.cumsum(new) - 1
    gap = np.diff(ids[:upto], prepend=0)[keep & ~new]
    raw, size = _coded(gap)
    ends = np.r_[0, np.cumsum(np.bincount(block[keep & ~new], size, len(begin)).astype(np.int64))]
    gaps = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])
    first = rows.take(pa.array(begin)).combine_chunks()
    columns = [first.column(c).combine_chunks() for c in ("bucket", "token", "chunk")]
    columns = [pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in columns]
    n = np.bincount(block[keep], minlength=len(begin)).astype(np.int32)
    return pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(ids[begin]), gaps], ["bucket", "token", "chunk", "n", "low", "gaps"])


def _encode(batches):
    """(bucket, token, chunk, id) in this order -> blocks.  Rows of a batch's last block are held back, as the next may go on with it."""
    held: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        rows = pa.Table.from_batches([b])
        rows = pa.concat_tables([held, rows]) if held is not None else rows
        rows = rows.combine_chunks()
        code = rows.column("token").combine_chunks().dictionary_encode()
        code = (code.chunk(0) if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy(zero_copy_only=False)
        chunk, ids = rows.column("chunk").to_numpy(), rows.column("id").to_numpy()
        begin = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (chunk[1:] != chunk[:-1])])
        if len(begin) > 1:
            yield _blocks(rows, int(begin[-1]), begin[:-1], ids)
        held = rows.slice(int(begin[-1]))
    if held is not None:
        yield _blocks(held, held.num_rows, np.zeros(1, np.int64), held.column("id").to_numpy())


class Postings:
    """An index in a folder.  ``shift`` and ``buckets`` are set by ``create`` and stay."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        about = spark.read.parquet(f"{self.path}/about").first()
        self.buckets, self.shift = about["buckets"], about["shift"]

    @classmethod
    def create(cls, spark: SparkSession, path: str, *, rows: int, span: int, buckets: int = 64) -> Postings:
        """An empty index for about so many rows whose ids span so much: a chunk then has some 65,536 rows."""
        shift = 16 + max(0, (max(span, 1) // max(rows, 1)).bit_length() - 1)
        spark.createDataFrame([(buckets, min(shift, 62))], "buckets int, shift int").coalesce(1).write.parquet(f"{path.rstrip('/')}/about")
        return cls(spark, path)

    @classmethod
    def of(cls, df: DataFrame, path: str, *, id_col: str, tokens_col: str, buckets: int = 64) -> Postings:
        """The index of a table."""
        low, high, n = df.agg(F.min(id_col), F.max(id_col), F.count(id_col)).first()
        index = cls.create(df.sparkSession, path, rows=n, span=(high - low if n else 0), buckets=buckets)
        index.add(df, id_col=id_col, tokens_col=tokens_col)
        return index

    def _bucket(self, token: str = "token") -> F.Column:
        return F.pmod(F.xxhash64(token), F.lit(self.buckets)).cast("int")

    def add(self, df: DataFrame, *, id_col: str, tokens_col: str) -> None:
        """Index more rows."""
        batch = uuid.uuid4().hex
        rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.explode(F.array_distinct(tokens_col)).alias("token")).where("token is not null")
        rows = rows.select(self._bucket().alias("bucket"), "token", F.shiftright("id", self.shift).alias("chunk"), "id")
        # ranges over token and id: a token of many rows falls to many tasks, and equal rows to one
        parts = max(2, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        rows = rows.repartitionByRange(parts, "bucket", "token", "id").sortWithinPartitions("bucket", "token", "id")
        at = f"{self.path}/blocks/batch={batch}"
        rows.mapInArrow(_encode, BLOCKS).write.partitionBy("bucket").parquet(at)
        blocks = self.spark.read.schema(BLOCKS).parquet(at)
        told = blocks.groupBy("token", "bucket").agg(F.sum("n").alias("n"), F.min("chunk").alias("first"), F.max("chunk").alias("last"))
        told.repartition(F.col("bucket")).sortWithinPartitions("token").write.partitionBy("bucket").parquet(f"{self.path}/dictionary/batch={batch}")

    def dictionary(self) -> DataFrame:
        """token, n (rows, those that came again in a later batch counted each time), first and last chunk."""
        rows = self._read("dictionary", DICTIONARY)
        return rows.groupBy("token", "bucket").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))

    def _batches(self) -> list[str]:
        """Batches whose dictionary was written to the end."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/dictionary")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(place):
            return []
        return sorted(f.getPath().toString() for f in fs.listStatus(place) if fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{f.getPath().toString()}/_SUCCESS")))

    def _read(self, what: str, schema: str) -> DataFrame:
        folders = [p.replace("/dictionary/", f"/{what}/") for p in self._batches()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{what}").parquet(*folders)

    def _of_tokens(self, table: DataFrame, asked: DataFrame, few: list[str] | None) -> DataFrame:
        """Rows of the asked tokens; a few tokens go into the scan, so that only their folders and row groups are read."""
        if few is None:
            return table.join(asked.select("bucket", "token").distinct(), ["bucket", "token"], "left_semi")
        buckets = [r["b"] for r in self.spark.createDataFrame([(t,) for t in few], "token string").select(self._bucket().alias("b")).distinct().collect()] if few else []
        return table.where(F.col("bucket").isin(buckets) & F.col("token").isin(few))

    def search(self, queries: DataFrame, *, mode: str = "all", query_col: str = "query", tokens_col: str = "tokens", id_col: str = "id") -> DataFrame:
        """(query, tokens) -> query, id: the ids that have all tokens of the query, or any of them.  Queries with equal names are one."""
        if mode not in ("all", "any"):
            raise ValueError("mode is all or any")
        asked = queries.select(F.col(query_col).alias("query"), F.explode(tokens_col).alias("token")).where("token is not null").distinct().withColumn("bucket", self._bucket())
        tables = Tables(self.spark, "asked")  # read several times below
        asked = tables.cut(asked)
        names = [r["token"] for r in asked.select("token").distinct().limit(PUSHED + 1).collect()]
        few = names if len(names) <= PUSHED else None
        kind = dict(queries.dtypes)[query_col]
        stored = self._of_tokens(self._read("blocks", f"batch string, {BLOCKS}"), asked, few) if few is not None else self._read("blocks", f"batch string, {BLOCKS}")
        known = asked.join(self._of_tokens(self.dictionary(), asked, few), ["bucket", "token"], "left")
        per = known.groupBy("query").agg(F.count(F.lit(1)).alias("need"), F.count("n").alias("have"), F.max("first").alias("from"), F.min("last").alias("to"), F.min("first").alias("low"), F.max("last").alias("high"), F.array_agg("token").alias("tokens"))
        # all: every token is known, and only chunks within all tokens' stretches count
        per = per.where("have = need and query is not null") if mode == "all" else per.where("have > 0").withColumns({"from": F.col("low"), "to": F.col("high")})
        deals = max(1, min(SPREAD, -(-asked.select("query").distinct().count() // QUERIES)))
        per = tables.cut(per.select("query", "tokens", "from", "to", F.pmod(F.xxhash64("query"), F.lit(deals)).cast("int").alias("deal")))
        need = per.select("deal", F.explode("tokens").alias("token")).distinct().withColumn("bucket", self._bucket())
        chunks = tables.cut(stored.select("chunk").distinct())  # a row for some 65,536 rows of the table
        lists = stored.join(need, ["bucket", "token"]).select("chunk", "deal", F.lit(None).cast(kind).alias("query"), F.lit(None).cast("array<string>").alias("tokens"), "token", "low", "gaps")
        who = per.join(chunks, F.col("chunk").between(F.col("from"), F.col("to"))).select("chunk", "deal", "query", "tokens", F.lit(None).cast("string").alias("token"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("binary").alias("gaps"))

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches)).combine_chunks()
            own = pc.is_valid(table.column("tokens"))
            queries, rest = table.filter(own), table.filter(pc.invert(own))
            by: dict[str, list[np.ndarray]] = {}
            for token, low, gaps in zip(*(rest.column(c).to_pylist() for c in ("token", "low", "gaps")), strict=True):
                by.setdefault(token, []).append(low + np.r_[0, np.cumsum(decoded(gaps))])
            ids_of = {t: p[0] if len(p) == 1 else np.unique(np.concatenate(p)) for t, p in by.items()}
            rows, out, held = [], [], 0

            def told() -> pa.RecordBatch:
                at = pa.array(np.repeat(np.array(rows, np.int64), [len(x) for x in out]))
                return pa.RecordBatch.from_arrays([pa.concat_arrays(queries.column("query").chunks).take(at), pa.array(np.concatenate(out))], ["query", "id"])

            for row, tokens in enumerate(queries.column("tokens").to_pylist()):
                each = sorted((ids_of[t] for t in tokens if t in ids_of), key=len)
                if not each or (mode == "all" and len(each) < len(tokens)):
                    continue
                ids = each[0] if mode == "all" or len(each) == 1 else np.unique(np.concatenate(each))
                for other in each[1:] if mode == "all" else ():
                    at = np.searchsorted(other, ids)
                    ids = ids[other[np.minimum(at, len(other) - 1)] == ids]
                if len(ids):
                    rows, out, held = [*rows, row], [*out, ids], held + len(ids)
                if held >= TOLD:
                    yield told()
                    rows, out, held = [], [], 0
            if out:
                yield told()

        # as many partitions as groups: each is more work than its coded size says, so none are put together
        both = who.unionByName(lists).repartition(max(1, min(1024, deals * chunks.count())), "chunk", "deal")
        found = both.groupBy("chunk", "deal").applyInArrow(meet, f"query {kind}, id long")
        return found.select(F.col("query").alias(query_col), F.col("id").alias(id_col))

    def rows(self, df: DataFrame, tokens: list[str], *, mode: str = "all", id_col: str) -> DataFrame:
        """The rows of the indexed table that one list of tokens finds."""
        query = self.spark.createDataFrame([(0, tokens)], "query int, tokens array<string>")
        found = self.search(query, mode=mode).select(F.col("id").alias("_found"))
        return df.join(found, F.col(id_col) == F.col("_found"), "left_semi")

    def vacuum(self) -> None:
        """Remove blocks of batches that were never finished."""
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/blocks")
        fs = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        whole = {p.rsplit("/", 1)[-1] for p in self._batches()}
        for f in fs.listStatus(place) if fs.exists(place) else ():
            if f.getPath().getName() not in whole:
                remove(self.spark, f.getPath().toString())
