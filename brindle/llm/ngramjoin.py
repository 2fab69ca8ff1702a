"""Similarity join of documents on the Jaccard similarity of their word n-gram sets, by MinHash banding.

1. One pass makes each document's set key (a hash of its sorted distinct n-grams), and the hashes of its bands.  The numbers of bands
   and rows are the steepest that keep the target recall at the threshold (``choose_bands``).  Documents with
   equal keys are one class from here on, so copies are never paired.
2. Band hashes are shuffled.  Classes that share one point to the least class there; components of these
   pointers hold every candidate pair.
3. The classes of a component (found in the texts through a bitmap of fixed size) are verified against each other on
   their full sets.  Small components are packed together; one of over ``BLOCK`` classes or ``BLOCK_GRAMS`` n-grams is cut into blocks, and each
   pair of blocks is a task of its own, so neither a task's memory nor its time follows the component's size.  A task
   counts links and keeps, for each class, one pointer inside its own linked part; pairs are never written.
4. Components of the verified pointers are the result's classes.

The result has for each document the least id of its class and its number of links: of other documents, copies included, at or over the threshold.

Similarity is that of the full sets; the hashes of n-grams have 64 bits.  A pair at the threshold is missed with a chance of 1 - recall.

Defined cases: a text of fewer than n words, but not none, has one n-gram of them all; texts without words are linked only to equal texts;
null counts as empty; repeated rows get equal results, and count as links of each other; an empty table gives no rows.  Rows without an id
take part, and their id counts as larger than all others: a class of only such rows has a null class_id, and keep_first keeps one row of it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.durable import Tables
from ..operators.graph import connected_components as components
from . import vec
from .shared import bitmap, cut, maybe_in, small_batches

BLOCK, BLOCK_GRAMS = 512, 1 << 20  # 8 MB of n-grams
PACK, PACK_GRAMS = 1024, 1 << 21
WITHIN = 2  # the side of a block that is verified against itself; a pair of blocks has sides 0 and 1


def choose_bands(threshold: float, recall: float, most: int) -> tuple[int, int]:
    """The largest number of rows a band, and the bands, that find a pair at the threshold with this recall, with at most so many hashes."""
    best = None
    for rows in range(1, most + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - p))
        if bands * rows > most:
            break
        best = (bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall with so few hashes")
    return best


def _signatures(g: np.ndarray, begin: np.ndarray, n: int) -> np.ndarray:
    """n MinHashes of each stretch of g that begins there: array (n, stretches)."""
    seeds = vec.series(9, 2 * n)
    low = (g ^ (g >> np.uint64(32))).astype(np.uint32)
    out = np.empty((n, len(begin)), np.uint32)
    for k in range(n):
        x = low * np.uint32((int(seeds[2 * k]) & 0xFFFFFFFF) | 1) + np.uint32(int(seeds[2 * k + 1]) & 0xFFFFFFFF)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        out[k] = np.minimum.reduceat(x, begin)
    return out


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts' distinct n-grams one after another, where each text's begin, and the texts' set keys."""
    _, _, h, row = vec.words(data, offsets)
    g, r = vec.distinct_per_row(*vec.row_shingles(h, row, n))
    m = len(offsets) - 1
    at = np.r_[0, np.cumsum(np.bincount(r, minlength=m))]
    node = np.empty(m, np.int64)
    for d in range(m):
        raw = g[at[d] : at[d + 1]].tobytes() if at[d] < at[d + 1] else b"no words" + data[offsets[d] : offsets[d + 1]].tobytes()
        node[d] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)
    return g, at, node


def _keyed(docs: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    """_id, node (64-bit set key), number of n-grams, band hashes."""

    def run(batches):
        for b in batches:
            data, offsets = vec.text_buffer(b.column("_t"))
            for lo, hi in vec.slices(offsets):
                g, at, node = _sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], n)
                m = hi - lo
                full = np.flatnonzero(np.diff(at))
                keys = np.zeros((bands, len(full)), np.uint64)
                if len(full):
                    sig = _signatures(g, at[full], bands * rows).reshape(bands, rows, len(full))
                    salt = vec.series(5, bands)
                    for k in range(bands):
                        x = np.full(len(full), salt[k])
                        for j in range(rows):
                            x = vec.mix(x * np.uint64(0x9E3779B97F4A7C15) + sig[k, j])
                        keys[k] = x
                counts = np.zeros(m + 1, np.int32)
                counts[full + 1] = bands
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(counts, dtype=np.int32)), pa.array(keys.T.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("_id").slice(lo, m), pa.array(node), pa.array(np.diff(at)), lists], ["_id", "node", "grams", "bands"])

    return docs.mapInArrow(run, "_id long, node long, grams long, bands array<long>")


def _linked(sets: list[np.ndarray], split: int, threshold: float) -> np.ndarray:
    """Which pairs of sets are at or over the threshold; of all pairs if split is 0, else of those across it."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.float64)
    values, of, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = count > 1
    of, owner = (np.cumsum(shared) - 1)[of[shared[of]]], owner[shared[of]]
    order = np.argsort(of, kind="stable")
    of, owner = of[order], owner[order]
    both = np.zeros((split, n - split) if split else (n, n), np.float32)
    for lo in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(of, (lo, lo + 4096))
        m = np.zeros((n, 4096), np.float32)
        m[owner[a:b], of[a:b] - lo] = 1
        both += m[:split] @ m[split:].T if split else m @ m.T
    rest = (size[:split, None] + size[None, split:] if split else size[:, None] + size[None, :]) - both
    ok = both >= threshold * rest - 1e-9
    if split:
        full = np.zeros((n, n), bool)
        full[:split, split:] = ok
        return full | full.T
    np.fill_diagonal(ok, False)
    return ok


def _verify(threshold: float):
    def one(nodes, counts, sets, split):
        linked = _linked(sets, split, threshold)
        links = linked @ counts
        root = nodes.copy()
        while True:
            low = np.minimum(root, np.where(linked, root[None, :], np.iinfo(np.int64).max).min(1, initial=np.iinfo(np.int64).max))
            if (low == root).all():
                break
            root = low
        some = links > 0
        return nodes[some], links[some], root[some]

    def run(table: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        comp, side = table.column("comp").to_numpy(), table.column("side").to_numpy()
        node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        raw = table.column("set")
        order = np.lexsort((node, side, comp))
        same = (comp[order][1:] == comp[order][:-1]) & (side[order][1:] == side[order][:-1]) & (node[order][1:] == node[order][:-1])
        order = order[np.r_[True, ~same]]  # a class whose least id is on several rows came once for each
        begin = np.flatnonzero(np.r_[True, comp[order][1:] != comp[order][:-1]])
        out = []
        for own in np.split(order, begin[1:]):
            split = 0 if side[own[0]] == WITHIN else int((side[own] == 0).sum())
            if len(own) > 1 and (side[own[0]] == WITHIN or 0 < split < len(own)):
                out.append(one(node[own], n[own], [np.frombuffer(raw[int(k)].as_buffer(), np.uint64) for k in own], split))
        z = np.zeros(0, np.int64)
        cols = [np.concatenate([z, *(o[k] for o in out)]) for k in range(3)]
        return pa.table({"node": cols[0], "links": cols[1].astype(np.int64), "root": cols[2]})

    return run


def join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, n: int = 5, recall: float = 0.9995, hashes: int = 240) -> DataFrame:
    """One row a document: id, class_id (the least id linked to it, over any number of links), n_links, set key ``node``, and whether the class
    stands for itself in this row (``leads``: of the rows with the class's least id, those with its least set key)."""
    small_batches(docs.sparkSession)
    bands, rows = choose_bands(threshold, recall, hashes)
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"))
    tables = Tables(docs.sparkSession, "ngram-join")
    keyed = cut(_keyed(source, bands, rows, n))
    # copies combine before the shuffle; their bands are the same
    classes = tables.cut(keyed.groupBy("node").agg(F.min("_id").alias("first"), F.count(F.lit(1)).alias("n"), F.max("grams").alias("grams"), F.first("bands").alias("bands")))
    reps = classes.select("node", F.explode("bands").alias("band"))
    least = reps.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("band", "low")
    candidates = reps.join(least, "band").where("node <> low").select(F.col("node").alias("src"), F.col("low").alias("dst"))
    classes = classes.drop("bands")
    members = tables.cut(components(candidates).withColumnRenamed("root", "comp").join(classes, "node").select("node", "comp", "first", "n", "grams"))
    # only the sizes of components that need blocks are joined back: at most one row for each BLOCK classes
    sizes = members.groupBy("comp").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    large = tables.cut(sizes.where("blocks > 1"))

    def sets_of(batches):
        seen = set()  # of texts that only rows without an id have, each once a task
        for b in batches:
            data, offsets = vec.text_buffer(b.column("_t"))
            for lo, hi in vec.slices(offsets):
                _, _, h, row = vec.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                g, r = vec.distinct_per_row(*vec.row_shingles(h, row, n))
                at = np.searchsorted(r, np.arange(hi - lo + 1))
                made = [g[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
                keys = [int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) for x in made]
                ids = b.column("_id").slice(lo, hi - lo)
                new = [i is not None or not (k in seen or seen.add(k)) for i, k in zip(ids.to_pylist(), keys, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), ids, vec.packed(made)], ["node", "_id", "set"]).filter(pa.array(new, pa.bool_()))

    sets = maybe_in(source, "_id", bitmap(members, "first"), then=sets_of, schema="node long, _id long, set binary")
    total, grams = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("grams"), F.lit(0))).first()
    placed = members.join(large, "comp", "left").select("node", "comp", "first", "n", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    full = sets.join(placed, (sets["node"] == placed["node"]) & sets["_id"].eqNullSafe(placed["first"])).select(placed["node"], "comp", "blocks", "n", "set")
    full = full.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    small = F.col("blocks") == 1
    other = F.explode(F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = full.select("node", "comp", "n", "set", "blocks", "mine", other.alias("with"))
    pack = F.when(small, F.pmod(F.xxhash64("comp"), F.lit(max(1, total // PACK, grams // PACK_GRAMS)))).otherwise(F.xxhash64("comp", F.least("mine", "with"), F.greatest("mine", "with")))
    side = F.when(F.col("mine") == F.col("with"), WITHIN).when(F.col("mine") > F.col("with"), 1).otherwise(0).cast("int")
    side = F.when(small, WITHIN).otherwise(side)
    packed = paired.select(small.alias("small"), pack.alias("pack"), "comp", side.alias("side"), "node", "n", "set").groupBy("small", "pack")
    verified = tables.cut(packed.applyInArrow(_verify(threshold), "node long, links long, root long"))
    final = components(verified.select(F.col("node").alias("src"), F.col("root").alias("dst")))
    known = tables.cut(final.join(verified.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(classes.select("node", "first"), "node"))
    leading = known.groupBy("root").agg(F.min("first").alias("class_id"), F.min(F.struct(F.col("first").isNull(), "first", "node"))["node"].alias("lead"))
    told = known.join(leading, "root").select("node", "class_id", "lead", "links")
    per_class = classes.join(told, "node", "left").select("node", F.coalesce("class_id", "first").alias("class_id"), F.coalesce("lead", "node").alias("lead"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    per_class = cut(per_class)
    tables.close()
    leads = (F.col("node") == F.col("lead")) & F.col("_id").eqNullSafe(F.col("class_id"))
    return keyed.select("_id", "node").join(per_class, "node").select(F.col("_id").alias(id_col), "class_id", "n_links", "node", leads.alias("leads"))


def _with_node(docs: DataFrame, text_col: str, n: int) -> DataFrame:
    """The documents with their set key as ``_node``."""

    def run(batches):
        for b in batches:
            data, offsets = vec.text_buffer(b.column(len(b.columns) - 1))
            for lo, hi in vec.slices(offsets):
                _, _, node = _sets(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], n)
                yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in b.columns[:-1]), pa.array(node)], [*b.schema.names[:-1], "_node"])

    return docs.withColumn("_text", F.col(text_col).cast("string")).mapInArrow(run, StructType([*docs.schema.fields, StructField("_node", LongType())]))


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, **options) -> DataFrame:
    """The documents' own columns, one document of each class: that with the least id (of rows with that id and equal sets of n-grams, each stays; of rows without an id, one).

    A row goes by its id alone where all rows with that id go; where rows with one id fare differently, by id and set key.
    """
    found = join(docs, id_col=id_col, text_col=text_col, n=n, **options).select(F.col(id_col).alias("_out"), "node", (~F.col("leads")).alias("goes"))
    dropped = cut(found.groupBy("_out").agg(F.max("goes").alias("some"), F.min("goes").alias("all")).where("some and _out is not null").select("_out", "all"))
    everything = docs.withColumn("_gone", F.col(id_col).cast("long"))
    marked = everything.where("_gone is not null")
    same = F.col("_gone") == F.col("_out")
    bits = bitmap(dropped, "_out")
    kept = maybe_in(marked, "_gone", bits, keep=False).unionByName(maybe_in(marked, "_gone", bits).join(dropped, same, "left_anti"))
    mixed = dropped.where("not all").select("_out")
    if not mixed.isEmpty():
        pairs = cut(found.where("goes").join(mixed.select(F.col("_out").alias("_gone")), same, "left_semi").select("_out", "node").distinct())
        unsure = maybe_in(marked, "_gone", bitmap(mixed, "_out")).join(mixed, same, "left_semi")
        pairs = pairs.withColumnRenamed("node", "_pair")
        kept = kept.unionByName(_with_node(unsure, text_col, n).join(pairs, same & (F.col("_node") == F.col("_pair")), "left_anti").drop("_node"))
    single = cut(found.where("_out is null and not goes").select(F.col("node").alias("_lead")).distinct())
    if not single.isEmpty():
        own = _with_node(everything.where("_gone is null"), text_col, n)
        kept = kept.unionByName(own.join(single, F.col("_node") == F.col("_lead"), "left_semi").dropDuplicates(["_node"]).drop("_node"))
    return kept.select(*docs.columns)
