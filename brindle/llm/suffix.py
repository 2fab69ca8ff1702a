"""Removal of repeated byte strings with a logarithmic family of sorted suffix runs.

A byte of a document goes if a string of ``length`` bytes that covers it also starts in a document with
a smaller id.  Documents are dealt into batches of consecutive ids, of about ``batch_mb`` of text each.

* Each batch makes a suffix array.  It is sparse: of the suffixes in any stretch of ``length`` bytes, the one whose
  first ``KEY`` bytes hash lowest is taken (a minimiser), so equal strings always hold the same suffix at
  the same place and none is missed, with about one suffix for 10 bytes.  Suffixes sort by the hash of
  their first bytes, which brings equal ones together as byte order would.
* The arrays are cut by key range.  For each range one task takes the batches in order of ids, scans each
  against the sorted levels of the family and then adds it; two levels of the same rank merge into one of the
  next (``LevelFamily``).  So a batch meets at most log2(batches) runs.
* A batch gets back one bit a suffix: also in an earlier batch, or in a later one.  Neighbouring strings with the same shared suffix
  form a block, and the hashes of the blocks go the same way: a block that an earlier batch has is settled whole.
  Where a suffix has blocks that differ, the strings of the first of each go through the family at full
  length, as 64 bits of hash and a key range chosen by a second hash, and one bit a string comes back.

What is shuffled: the texts once (all passes reuse that exchange), four bytes a suffix, twelve a shared block, eight a string at the edges of shared passages.
A key counts once a batch, so copies cannot make a range hot, and no task holds more than a batch or a key range.
Nothing is collected but the first id of each batch.

Two strings that differ could be taken for equal only if both hashes agree (64 bits and the range): at 10^10 strings
the chance that it happens anywhere is about 1 in 500.

Defined cases: a null text is empty; documents with equal ids never serve each other as the earlier one;
a null id counts as larger than all others; texts under ``length`` bytes stay whole; a document of any length is worked off whole, in
segments, by one task, which holds its bytes and about twenty for each suffix; an empty table gives no rows; input columns named like those of a result are left out
by ``repeats`` (``carry``), and come back whole from ``remove_repeats``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import size_cuts, small_batches

KEY = 32


class LevelFamily:
    """Sorted runs of distinct keys; runs of equal rank merge, so there are at most log2(batches) of them."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, np.ndarray]] = []

    def scan(self, keys: np.ndarray) -> np.ndarray:
        """Which of the keys some level holds."""
        hit = np.zeros(len(keys), bool)
        for _, run in self.levels:
            at = np.searchsorted(run, keys)
            at[at == len(run)] = 0
            hit |= run[at] == keys
        return hit

    def add(self, keys: np.ndarray) -> None:
        if not len(keys):
            return
        rank, run = 0, keys
        while self.levels and self.levels[-1][0] == rank:
            other = self.levels.pop()[1]
            run = np.concatenate([other, run])
            run.sort(kind="stable")
            run = run[np.r_[True, run[1:] != run[:-1]]]
            rank += 1
        self.levels.append((rank, run))


def _runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of neighbouring strings with the same suffix in them: suffix hash, first start, count, row."""
    total = len(data) - length + 1
    breaks = np.unique(np.concatenate([offsets, np.maximum(offsets - length + 1, 0)]))  # strings from here on leave a row or begin one
    values, starts, counts = [], [], []
    for lo in range(0, total, vec.SEGMENT):
        hi = min(total, lo + vec.SEGMENT)
        least = vec.sliding_min(vec.window_hashes(data[lo : hi + length - 1], KEY, spread=vec.stir), length - KEY + 1)
        new = np.empty(hi - lo, bool)
        new[0] = True
        np.not_equal(least[1:], least[:-1], out=new[1:])
        a, b = np.searchsorted(breaks, (lo, hi))
        new[breaks[a:b] - lo] = True
        new = np.flatnonzero(new)
        values.append(least[new])
        starts.append(new + lo)
        counts.append(np.diff(np.r_[new, hi - lo]))
    if not values:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z
    value, start, count = (np.concatenate(x) for x in (values, starts, counts))
    row = np.searchsorted(offsets, start, "right") - 1
    ok = start + length <= offsets[row + 1]
    return value[ok], start[ok], count[ok], row[ok]


def _spread(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest of sorted groups: positions where each group of equal keys begins, and its number."""
    new = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
    return np.flatnonzero(new), np.cumsum(new) - 1


def _several(keys: np.ndarray, rank: np.ndarray):
    """Distinct keys, whether a key is in several documents, the least document of each, and the key of each item."""
    order = np.argsort(keys)
    begin, group = _spread(keys[order])
    if not len(begin):
        return keys[:0], np.zeros(0, bool), rank[:0], np.zeros(0, np.int64)
    sorted_rank = rank[order]
    least, most = np.minimum.reduceat(sorted_rank, begin), np.maximum.reduceat(sorted_rank, begin)
    of = np.empty(len(keys), np.int64)
    of[order] = group
    return keys[order][begin], least < most, least, of


class _Batch:
    """The documents of one batch in order of ids, with what each pass needs of them."""

    def __init__(self, table: pa.Table, length: int, ranges: int) -> None:
        self.table = table.sort_by([("_id", "ascending")]) if table.num_rows > 1 else table
        self.length, self.ranges = length, ranges
        self.data, self.offsets = vec.text_buffer(self.table.column("_bytes"))
        ids = self.table.column("_id")
        top = np.iinfo(np.int64).max
        ids = ids.fill_null(top).to_numpy() if ids.null_count else ids.to_numpy()
        self.rank = np.cumsum(np.r_[False, ids[1:] != ids[:-1]]) if len(ids) else np.zeros(0, np.int64)
        self.value, self.start, self.count, self.row = _runs(self.data, self.offsets, length)
        # key range above, 32 bits of key below
        self.key = (((self.value >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32) << np.uint64(32)) | (self.value & np.uint64(0xFFFFFFFF))
        self.keys, self.inside, _, self.of = _several(self.key, self.rank[self.row])

    def suffixes(self):
        """Key range and keys to send."""
        return (self.keys >> np.uint64(32)).astype(np.int64), self.keys.astype(np.uint32)

    def blocks(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Choose the runs with a shared suffix; key range, suffix and block hash of each distinct pair to send."""
        self.runs = np.flatnonzero((shared | self.inside)[self.of])
        first, count = self.start[self.runs], self.count[self.runs]
        block = np.empty(len(first), np.uint64)
        for lo in range(0, len(self.data), vec.SEGMENT):
            a, b = np.searchsorted(first, (lo, lo + vec.SEGMENT))
            if a < b:
                begin = first[a:b] - lo
                block[a:b] = vec.span_hashes(self.data[lo : lo + vec.SEGMENT + self.length - 1], begin, begin + count[a:b] + self.length - 1)
        suffix = self.of[self.runs]
        order = np.lexsort((block, suffix))
        new = np.r_[True, (suffix[order][1:] != suffix[order][:-1]) | (block[order][1:] != block[order][:-1])][: len(order)]
        self.pair = np.empty(len(order), np.int64)
        self.pair[order] = np.cumsum(new) - 1
        keys = self.keys[suffix[order][new]]
        return (keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32), block[order][new]

    def strings(self, earlier: np.ndarray, several: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key range and key of the strings to send: those of the first of each block that no earlier batch has and whose suffix has other blocks too.

        The other blocks need no closer look: a copy of a block is settled whole, and a block that is alone with its suffix shares no string.
        """
        rank = self.rank[self.row[self.runs]]
        first_rank = np.full(len(earlier), np.iinfo(np.int64).max)
        np.minimum.at(first_rank, self.pair, rank)
        self.copied = earlier[self.pair] | (rank > first_rank[self.pair])
        close = np.flatnonzero(several[self.pair] & ~self.copied)
        self.at = at = _expand(self.start[self.runs[close]], self.count[self.runs[close]])
        h, g = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
        for lo in range(0, len(self.data), vec.SEGMENT):
            a, b = np.searchsorted(at, (lo, lo + vec.SEGMENT))
            if a < b:
                part, begin = self.data[lo : lo + vec.SEGMENT + self.length - 1], at[a:b] - lo
                h[a:b] = vec.span_hashes(part, begin, begin + self.length)
                g[a:b] = vec.span_hashes(part, begin, begin + self.length, _OTHER)
        of_string = np.repeat(rank[close], self.count[self.runs[close]])
        keys, _, least, self.string = _several(h, of_string)
        self.inside_batch = of_string > least[self.string]
        bucket = np.zeros(len(keys), np.int64)
        bucket[self.string] = (((g >> np.uint64(32)) * np.uint64(self.ranges)) >> np.uint64(32)).astype(np.int64)
        self.sent = np.argsort(bucket, kind="stable")
        return bucket[self.sent], keys[self.sent]

    def spans(self, earlier: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each maximal stretch of bytes that goes, from the bits for the strings sent."""
        known = np.empty(len(earlier), bool)
        known[self.sent] = earlier
        hit = self.at[self.inside_batch | known[self.string]]
        runs = self.runs[self.copied]
        s = np.r_[hit, self.start[runs]]
        order = np.argsort(s, kind="stable")
        s = s[order]
        e = np.maximum.accumulate(np.r_[hit + self.length, self.start[runs] + self.count[runs] + self.length - 1][order])
        row = np.searchsorted(self.offsets, s, "right") - 1
        new = np.r_[True, (s[1:] > e[:-1]) | (row[1:] != row[:-1])][: len(s)]
        return s[new], e[np.r_[new[1:], True]] if len(s) else e, row[new]


def _whole_characters(data: np.ndarray, offsets: np.ndarray, begin: np.ndarray, end: np.ndarray, owner: np.ndarray):
    """The spans, grown to the borders of characters; those that then meet are one."""
    inner = lambda at: (at < len(data)) & ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80)
    begin, end = begin.copy(), end.copy()
    for _ in range(3):  # a character has four bytes at most
        begin -= (begin > offsets[owner]) & inner(begin)
        end += (end < offsets[owner + 1]) & inner(end)
    new = np.r_[True, (begin[1:] > end[:-1]) | (owner[1:] != owner[:-1])][: len(begin)]
    return begin[new], end[np.r_[new[1:], True]] if len(begin) else end, owner[new]


def _expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each count."""
    if not len(first):
        return np.zeros(0, np.int64)
    return np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())


_OTHER = vec.series(77, 256)


def _packets(batch: int, bucket: np.ndarray, *keys: np.ndarray) -> list[tuple[int, int, bytes]]:
    begin, _ = _spread(bucket)
    ends = np.r_[begin[1:], len(bucket)][: len(begin)]  # none where nothing is sent
    return [(batch, int(bucket[a]), b"".join(k[a:b].tobytes() for k in keys)) for a, b in zip(begin, ends, strict=True)]


def _flags(rows, bucket: np.ndarray, n: int = 1) -> list[np.ndarray]:
    """The n series of bits that came back, in the order in which keys were sent (by range)."""
    out = [np.zeros(len(bucket), bool) for _ in range(n)]
    begin, _ = _spread(bucket)
    ends = dict(zip(bucket[begin].tolist(), zip(begin.tolist(), np.r_[begin[1:], len(bucket)][: len(begin)].tolist(), strict=True), strict=True))
    for to, bits in rows:
        a, b = ends[to]
        size = -(-(b - a) // 8)
        for k in range(n):
            out[k][a:b] = np.unpackbits(np.frombuffer(bits, np.uint8, size, k * size), count=b - a).astype(bool)
    return out


def _merge_scan(keys: list[np.ndarray], order) -> list[np.ndarray]:
    """In this order of batches, which keys of each the family of those before holds."""
    family, found = LevelFamily(), [None] * len(keys)
    for k in order:
        own = keys[k]
        found[k] = family.scan(own)
        family.add(own if not len(own) or (own[1:] > own[:-1]).all() else np.unique(own))
    return found


def _serve_suffixes(raw: list[bytes]):
    keys = [np.frombuffer(x, np.uint32) for x in raw]
    n = range(len(keys))
    return [[a | b] for a, b in zip(_merge_scan(keys, n), _merge_scan(keys, n[::-1]), strict=True)]


def _serve_blocks(raw: list[bytes]):
    suffix = [np.frombuffer(x, np.uint32, len(x) // 12) for x in raw]
    pair = [vec.mix(np.frombuffer(x[4 * len(s) :], np.uint64) + s * np.uint64(0x9E3779B97F4A7C15)) for x, s in zip(raw, suffix, strict=True)]
    earlier = _merge_scan(pair, range(len(pair)))
    new = np.concatenate([s[~e] for s, e in zip(suffix, earlier, strict=True)])  # each different block once
    some, n = np.unique(new, return_counts=True)
    several = some[n > 1]
    at = [np.searchsorted(several, s) for s in suffix]
    return [[e, several[np.minimum(a, len(several) - 1)] == s if len(several) else np.zeros(len(s), bool)] for e, a, s in zip(earlier, at, suffix, strict=True)]


def _serve_strings(raw: list[bytes]):
    return [[x] for x in _merge_scan([np.frombuffer(x, np.uint64) for x in raw], range(len(raw)))]


def _serve(kind: str, judge):
    """The task of one key range: the batches' packets in order of ids, and an answer to each."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("batch", "ascending")])
        bits = [b"".join(np.packbits(y).tobytes() for y in x) for x in judge([x.as_py() for x in table.column("keys")])]
        return pa.table({"batch": table.column("batch"), "kind": pa.array([kind] * len(bits), pa.string()), "bucket": table.column("bucket"), "keys": pa.array(bits, pa.binary())})

    return run


def repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, batch_mb: int = 8, carry: tuple[str, ...] = (), characters: bool = False) -> DataFrame:
    """One row a document: id, n_bytes, the removed spans (in bytes), the bytes that are kept, and the columns in ``carry`` that have other names.  With ``characters`` spans grow to the borders of the characters they touch."""
    if length < KEY + 4:
        raise ValueError(f"length is at least {KEY + 4}")
    small_batches(docs.sparkSession)
    carried = [c for c in carry if c not in (id_col, "n_bytes", "spans", "kept")]
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").cast("binary").alias("_bytes"), *[F.col(c).alias(f"_c{k}") for k, c in enumerate(carried)])
    types = dict(source.dtypes)
    bounds = size_cuts(docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("_n")), batch_mb)
    spark = docs.sparkSession
    ranges = max(32, 2 * (len(bounds) + 1))  # a range gets about 2 MB of keys at any size
    edges = spark.sparkContext.broadcast(bounds)

    def deal(batches):
        cuts = np.array(edges.value, np.int64)
        for b in batches:
            ids = b.column("_id")
            to = np.searchsorted(cuts, ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), "right")
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), *b.columns], ["batch", *b.schema.names])

    plain = ", ".join(f"{c} {t}" for c, t in source.dtypes)
    dealt = source.mapInArrow(deal, f"batch long, {plain}")
    packets = "batch long, bucket long, keys binary"
    answers = "batch long, kind string, bucket long, keys binary"

    def table_of(rows, names=("batch", "bucket", "keys")) -> pa.Table:
        return pa.table({n: pa.array([r[k] for r in rows], pa.binary() if n == "keys" else pa.int64()) for k, n in enumerate(names)})

    def came_back(table: pa.Table, kind: str):
        return [(r["bucket"], r["keys"]) for r in table.to_pylist() if r["kind"] == kind]

    def first(key, table):
        vec.trim()
        return table_of(_packets(key[0].as_py(), *_Batch(table, length, ranges).suffixes()))

    def second(key, left, right):
        vec.trim()
        if not left.num_rows:
            return table_of([])
        b = _Batch(left, length, ranges)
        return table_of(_packets(key[0].as_py(), *b.blocks(*_flags(came_back(right, "suffix"), b.suffixes()[0]))))

    def with_blocks(left, right):
        vec.trim()
        b = _Batch(left, length, ranges)
        bucket, _, _ = b.blocks(*_flags(came_back(right, "suffix"), b.suffixes()[0]))
        return b, b.strings(*_flags(came_back(right, "block"), bucket, 2))

    def third(key, left, right):
        return table_of(_packets(key[0].as_py(), *with_blocks(left, right)[1])) if left.num_rows else table_of([])

    def last(left, right):
        b, (bucket, _) = with_blocks(left, right)
        begin, end, owner = b.spans(*_flags(came_back(right, "string"), bucket))
        if characters:
            begin, end, owner = _whole_characters(b.data, b.offsets, begin, end, owner)
        n = b.table.num_rows
        stays = np.tile([True, False], len(begin) + 1)[:-1]
        left_over = b.data[np.repeat(stays, np.diff(np.r_[0, np.column_stack([begin, end]).reshape(-1), len(b.data)]))]
        size = np.diff(b.offsets) - np.bincount(owner, end - begin, minlength=n).astype(np.int64)
        at = np.r_[0, np.cumsum(np.bincount(owner, minlength=n))]
        spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([pa.array(begin - b.offsets[owner], pa.int64()), pa.array(end - b.offsets[owner], pa.int64())], ["start", "end"]))
        if size.sum() < 1 << 31:
            kept = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.r_[0, np.cumsum(size)].astype(np.int32)), pa.py_buffer(left_over)])
        else:
            ends = np.cumsum(size)
            kept = pa.array([left_over[y - x : y].tobytes() for x, y in zip(size, ends, strict=True)], pa.binary())
        vec.trim()
        cols = {"_id": b.table.column("_id"), "n_bytes": pa.array(np.diff(b.offsets), pa.int64()), "spans": spans, "kept": kept}
        return pa.table(cols | {f"_c{k}": b.table.column(f"_c{k}") for k in range(len(carried))})

    out = ", ".join([f"_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary", *[f"_c{k} {types[f'_c{k}']}" for k in range(len(carried))]])

    def fourth(key, left, right):
        if left.num_rows:
            return last(left, right)
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string

        return to_arrow_schema(_parse_datatype_string(out)).empty_table()

    by_batch = dealt.groupBy("batch")
    suffixes = by_batch.applyInArrow(first, packets).groupBy("bucket").applyInArrow(_serve("suffix", _serve_suffixes), answers)
    blocks = by_batch.cogroup(suffixes.groupBy("batch")).applyInArrow(second, packets).groupBy("bucket").applyInArrow(_serve("block", _serve_blocks), answers)
    known = suffixes.unionByName(blocks)
    strings = by_batch.cogroup(known.groupBy("batch")).applyInArrow(third, packets).groupBy("bucket").applyInArrow(_serve("string", _serve_strings), answers)
    found = by_batch.cogroup(known.unionByName(strings).groupBy("batch")).applyInArrow(fourth, out)
    return found.withColumnsRenamed({"_id": id_col} | {f"_c{k}": c for k, c in enumerate(carried)})


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents' own columns with the repeated strings cut out; a document of which nothing is left goes.  A character of which a cut touches a part goes whole."""
    names = {c: f"brindle in {k}" for k, c in enumerate(docs.columns)}
    found = repeats(docs.toDF(*names.values()), id_col=names[id_col], text_col=names[text_col], carry=tuple(v for c, v in names.items() if c not in (id_col, text_col)), characters=True, **options)
    found = found.where("size(spans) = 0 or length(kept) > 0")
    return found.select(*[(F.col("kept").cast("string") if c == text_col else F.col(v)).alias(c) for c, v in names.items()])
