"""Names of a large table found in texts: a trie over tokens with failure links, and of overlapping names the leftmost and longest.

Tokens are runs of letters and digits, in lower case.  A name, and each of its aliases, is a path of tokens; every node has a failure link to the longest proper suffix that is a path too, and knows the names that end there or
at a node its links lead to.  One pass over a text's tokens finds every name; ``resolved`` keeps those that no name to the left, or longer at the same place, covers.

A table of up to ``MOST`` names is broadcast as a trie, and nothing is shuffled.  A larger one is joined: its paths, and the runs of tokens of the texts that are as long as some path (a run once for a stretch of
``PIECE`` characters, with its places), meet by a shuffle, and the finds go back to their rows by another, so no task holds the table; overlaps are resolved a row.  Which way is taken does not show in the
finds; with ``overlapping`` they come in order of place there.

``tallies`` only counts: how often phrases come in the texts of a key.  Of more than ``MOST`` phrases a bitmap (of at most 2**``BITS`` bits) is broadcast, and of the runs of tokens just those that it lets through move: a
run once for a stretch of ``STRETCH`` characters, with a count and a sum of places for each key.  No text and no find goes back to its row.

Defined cases: null and empty texts have no finds; names without a token, and null ones, are left out; of aliases that stand for several names the least (name, field) counts; repeated rows get equal results; an empty table
finds nothing; an input column named like the result is replaced, all others come back.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict, deque
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.durable import Tables, cut
from .batches import small_batches

MOST = 500_000
PIECE = 1 << 19
STRETCH = 1 << 23
BITS = 29
MIX = np.uint64(0x9E3779B97F4A7C15)
FOUND = "array<struct<name:string,field:string,start:int,tokens:int>>"
_KIND = pa.list_(pa.struct([("name", pa.string()), ("field", pa.string()), ("start", pa.int32()), ("tokens", pa.int32())]))
_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


class Trie:
    """names: (alias, name, field)."""

    def __init__(self, names) -> None:
        self.number: dict[str, int] = {}
        self.go: dict[int, int] = {}  # node and token -> node
        self.ends: list[tuple[str, str, int] | None] = [None]
        paths = []
        for alias, name, field in names:
            own = tokens(alias)
            if not own:
                continue
            node = 0
            for t in own:
                key = node << 32 | self.number.setdefault(t, len(self.number))
                if key not in self.go:
                    self.go[key] = len(self.ends)
                    self.ends.append(None)
                    paths.append(key)
                node = self.go[key]
            if self.ends[node] is None or (name, field) < self.ends[node][:2]:
                self.ends[node] = (name, field, len(own))
        self.fail, self.next = [0] * len(self.ends), [0] * len(self.ends)
        children: dict[int, list[tuple[int, int]]] = {}
        for key in paths:
            children.setdefault(key >> 32, []).append((key & 0xFFFFFFFF, self.go[key]))
        queue = deque([0])
        while queue:
            node = queue.popleft()
            for token, child in children.get(node, ()):
                back = self.fail[node]
                while node and back and back << 32 | token not in self.go:
                    back = self.fail[back]
                self.fail[child] = self.go.get(back << 32 | token, 0) if node else 0
                # the nearest node by failure links where a name ends
                link = self.fail[child]
                self.next[child] = link if self.ends[link] else self.next[link]
                queue.append(child)

    def find(self, text: str | None) -> list[tuple[int, int, str, str]]:
        """(start, tokens, name, field) of every name, overlapping ones too."""
        out, node, go, fail, number = [], 0, self.go, self.fail, self.number
        for at, t in enumerate(tokens(text)):
            k = number.get(t)
            if k is None:
                node = 0
                continue
            while node and node << 32 | k not in go:
                node = fail[node]
            node = go.get(node << 32 | k, 0)
            hit = node
            while hit:
                if end := self.ends[hit]:
                    out.append((at + 1 - end[2], end[2], end[0], end[1]))
                hit = self.next[hit]
        return out


def resolved(finds: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """The leftmost, and of one place the longest; of equal stretches the least name."""
    out, free = [], 0
    for f in sorted(finds, key=lambda f: (f[0], -f[1], f[2], f[3])):
        if f[0] >= free:
            out.append(f)
            free = f[0] + f[1]
    return out


def find(df: DataFrame, names: DataFrame, *, text_col: str = "text", out: str = "entities", overlapping: bool = False) -> DataFrame:
    """The rows with the names found in their text, or with ``overlapping`` all of them.  names: alias, name, field (one row an alias; the name itself is one too)."""
    table = names.where("alias is not null and name is not null").select("alias", "name", F.coalesce("field", F.lit("")).alias("field")).distinct()
    cols = [c for c in df.columns if c != out]
    rows = df.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(cols)], F.col(text_col).cast("string").alias("text"), F.array().cast(FOUND).alias("found"))
    if table.limit(MOST + 1).count() > MOST:
        rows = _joined(rows, table)
        rows = rows if overlapping else rows.mapInArrow(_resolving, rows.schema)
    else:
        sent = df.sparkSession.sparkContext.broadcast([tuple(r) for r in table.toLocalIterator()])  # at most MOST names
        rows = rows.mapInArrow(_adding(sent, not overlapping), rows.schema)
    return rows.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(cols)], F.col("found").alias(out))


def _joined(rows: DataFrame, table: DataFrame) -> DataFrame:
    """The rows with all their finds, by place and the longest first."""
    rows = cut(rows.drop("found").withColumn("row", F.monotonically_increasing_id()))  # written once: numbers stay
    paths = table.mapInArrow(_paths, "path string, tokens int, name string, field string").groupBy("path", "tokens").agg(F.min(F.struct("name", "field")).alias("best"))
    lengths = sorted(r["tokens"] for r in paths.select("tokens").distinct().collect())  # not more than the longest name has tokens
    runs = rows.select("row", "text").mapInArrow(_runs(lengths), "path string, places array<struct<row:long,start:int>>")
    hits = runs.join(paths, "path").select(F.explode("places").alias("p"), "tokens", "best")
    one = F.struct(F.col("p.start").alias("start"), (-F.col("tokens")).alias("less"), F.col("best.name").alias("name"), F.col("best.field").alias("field"))
    found = hits.select(F.col("p.row").alias("row"), one.alias("one")).groupBy("row").agg(F.sort_array(F.collect_list("one")).alias("found"))
    made = F.transform("found", lambda x: F.struct(x["name"].alias("name"), x["field"].alias("field"), x["start"].alias("start"), (-x["less"]).alias("tokens")))
    return rows.join(found, "row", "left").withColumn("found", F.coalesce(made, F.array()).cast(FOUND)).drop("row")


def _paths(batches):
    for b in batches:
        own = [tokens(x) for x in b.column("alias").to_pylist()]
        n = pa.array([len(x) for x in own], pa.int32())
        made = pa.RecordBatch.from_arrays([pa.array([" ".join(x) for x in own], pa.string()), n, b.column("name"), b.column("field")], ["path", "tokens", "name", "field"])
        yield made.filter(pc.greater(n, 0))


def _runs(lengths: list[int]):
    def told(held):
        at = np.cumsum([0, *map(len, held.values())], dtype=np.int32)
        flat = np.fromiter((x for places in held.values() for p in places for x in p), np.int64, 2 * int(at[-1])).reshape(-1, 2)
        places = pa.StructArray.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1].astype(np.int32))], ["row", "start"])
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.ListArray.from_arrays(pa.array(at), places)], ["path", "places"])

    def run(batches):
        for b in batches:
            held, chars = {}, 0
            for row, text in zip(b.column("row"), b.column("text"), strict=True):
                row, text = row.as_py(), text.as_py()
                own = tokens(text)
                for n in lengths:
                    for at, path in enumerate(map(" ".join, zip(*(own[j:] for j in range(n)), strict=False))):
                        held.setdefault(path, []).append((row, at))
                chars += len(text or "")
                if chars > PIECE:
                    yield told(held)
                    held, chars = {}, 0
            if held:
                yield told(held)

    return run


def _resolving(batches):
    for b in batches:
        made = [[{"name": n, "field": f, "start": s, "tokens": k} for s, k, n, f in resolved([(x["start"], x["tokens"], x["name"], x["field"]) for x in found])] for found in b.column("found").to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, _KIND)], b.schema.names)


def _adding(sent, resolve: bool):
    def run(batches):
        trie = Trie(sent.value)
        for b in batches:
            made = []
            for text in b.column("text").to_pylist():
                finds = trie.find(text)
                made.append([{"name": n, "field": f, "start": s, "tokens": k} for s, k, n, f in (resolved(finds) if resolve else finds)])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(made, _KIND)], b.schema.names)

    return run


def tallies(df: DataFrame, phrases: DataFrame, *, key_col: str = "id", text_col: str = "text") -> DataFrame:
    """Of each key whose texts have some phrase: key, n (how often phrases come, overlapping ones too), n_names (how many different ones) and places (the sum of their first tokens' places).  phrases: alias."""
    spark, kind = df.sparkSession, dict(df.dtypes)[key_col]
    small_batches(spark)
    tables = Tables(spark, "gazetteer")
    made = phrases.where("alias is not null").select("alias", F.lit("").alias("name"), F.lit("").alias("field")).mapInArrow(_paths, "path string, tokens int, name string, field string")
    paths = tables.cut(made.select("path", "tokens").distinct())
    n = paths.count()
    if n <= MOST:
        names = paths.select(F.col("path").alias("alias"), F.col("path").alias("name"), F.lit("").alias("field"))
        found = find(df.select(key_col, text_col), names, text_col=text_col, overlapping=True).select(key_col, F.explode("entities").alias("e"))
        return found.groupBy(key_col).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("e.name").alias("n_names"), F.sum("e.start").alias("places"))
    lengths = {r["tokens"] for r in paths.select("tokens").distinct().collect()}  # not more than the longest phrase has tokens
    bits = min(BITS, max(16, (16 * n).bit_length()))
    place = paths.mapInArrow(_places(bits), "b long")
    rows = place.groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    mask = bytearray(max(1 << bits >> 3, 4096))
    for r in rows.toLocalIterator():
        mask[(r["k"] - 1) * 4096 : r["k"] * 4096] = r["m"]
    sent = spark.sparkContext.broadcast(bytes(mask))
    del mask
    texts = df.select(F.col(key_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    runs = texts.mapInArrow(_tallied(lengths, sent, bits), f"path string, keys array<{kind}>, counts array<int>, sums array<long>")
    one = runs.join(paths.select("path"), "path").select("path", F.explode(F.arrays_zip("keys", "counts", "sums")).alias("e")).select("path", F.col("e.keys").alias(key_col), F.col("e.counts").alias("n"), F.col("e.sums").alias("places"))
    if texts.groupBy("key").count().where("count > 1").limit(1).count():  # texts of one key may lie in several stretches
        one = one.groupBy("path", key_col).agg(F.sum("n").alias("n"), F.sum("places").alias("places"))
    return one.groupBy(key_col).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_names"), F.sum("places").alias("places"))


def _hashes(words: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join(blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest() for w in words), np.uint64)


def _places(bits: int):
    """The bits of paths, numbered from 1 as Spark does."""

    def run(batches):
        for b in batches:
            number: defaultdict[str, int] = defaultdict()
            number.default_factory = number.__len__
            own = [[number[w] for w in path.split(" ")] for path in b.column("path").to_pylist()]
            h = _hashes(list(number))
            n = np.array([len(x) for x in own])
            flat = np.fromiter((c for x in own for c in x), np.int64, int(n.sum()))
            begin = np.cumsum(n) - n
            sums = h[flat[begin]] if len(own) else np.zeros(0, np.uint64)
            for k in range(1, int(n.max(initial=0))):
                more = n > k
                sums[more] = sums[more] * MIX + h[flat[begin[more] + k]]
            yield pa.RecordBatch.from_arrays([pa.array((sums >> np.uint64(64 - bits)).astype(np.int64) + 1)], ["b"])

    return run


def _tallied(lengths: set[int], sent, bits: int):
    def told(keys: pa.Array, sizes: list[int], words: list[str], code: np.ndarray, mask: np.ndarray):
        h, names, n = _hashes(words), pa.array(words, pa.string()), np.array(sizes, np.int64)
        doc = np.repeat(np.arange(len(n)), n)
        start = np.arange(len(code)) - np.repeat(np.cumsum(n) - n, n)
        left = n[doc] - start
        run, sums = code, h[code]
        for k in range(1, max(lengths) + 1):
            if k > 1:
                run = np.unique(run[:-1], return_inverse=True)[1] if k > 2 else run[:-1]
                run, sums = run * len(words) + code[k - 1 :], sums[:-1] * MIX + h[code[k - 1 :]]
            if k not in lengths:
                continue
            bit = sums >> np.uint64(64 - bits)
            at = np.flatnonzero((left[: len(run)] >= k) & ((mask[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1).astype(bool))
            if not len(at):
                continue
            at = at[np.argsort(run[at], kind="stable")]
            own, of = run[at], doc[at]
            first = np.r_[True, own[1:] != own[:-1]]
            begin = np.flatnonzero(first | np.r_[True, of[1:] != of[:-1]])
            heads = at[first]
            path = pc.binary_join_element_wise(*(names.take(pa.array(code[heads + j])) for j in range(k)), " ") if k > 1 else names.take(pa.array(code[heads]))
            ends = pa.array(np.r_[np.flatnonzero(first[begin]), len(begin)].astype(np.int32))
            lists = (keys.take(pa.array(of[begin])), pa.array(np.diff(np.r_[begin, len(at)]).astype(np.int32)), pa.array(np.add.reduceat(start[at], begin)))
            yield pa.RecordBatch.from_arrays([path, *(pa.ListArray.from_arrays(ends, x) for x in lists)], ["path", "keys", "counts", "sums"])

    def run(batches):
        mask = np.frombuffer(sent.value, np.uint8)
        empty = lambda: ([], [], defaultdict(), array("q"), 0)
        keys, sizes, number, code, chars = empty()
        number.default_factory = number.__len__
        done = lambda: told(pa.concat_arrays(keys), sizes, list(number), np.frombuffer(code, np.int64), mask) if len(code) else ()
        for b in batches:
            began = 0
            for at, text in enumerate(b.column("text")):
                text = text.as_py()
                own = tokens(text)
                code.extend(map(number.__getitem__, own))
                sizes.append(len(own))
                chars += len(text or "")
                if chars > STRETCH:
                    keys.append(b.column("key").slice(began, at + 1 - began))
                    yield from done()
                    keys, sizes, number, code, chars = empty()
                    number.default_factory = number.__len__
                    began = at + 1
            if began < b.num_rows:
                keys.append(b.column("key").slice(began))
        yield from done()

    return run
