"""Benchmark decontamination: find the word windows of benchmark items in documents and remove them.

The windows of the benchmark (``window`` consecutive words; an item of fewer words, but not none, is one
window) form a sorted array of hashes that goes to every task; documents are scanned once, without
a shuffle.  Every hash hit is compared word for word before it counts.

The benchmark is measured first.  One of at most ``block_mb`` of text is one block, whose index takes about five times that.  A larger one is cut into
blocks that are worked off one after the other: each gets a broadcast of its own and a scan that writes the hits, and goes before the next comes, so neither the driver nor a
worker holds more than one block at any time.  The hits of all blocks then join the documents by id and text.

Defined cases: a null or empty text has no words; a null item is no item; repeated items count once
per item_id; repeated documents are judged row by row; a very long text is worked off whole, in segments; an empty benchmark leaves all clean; an empty table of documents gives
no rows; columns of the documents named like those of a result are left out by ``scan`` (``carry``), and come back whole from ``decontaminate``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import cut, small_batches

_OWN = "n_words long, spans array<struct<start:long,end:long>>, n_hit long, items array<string>, cleaned string"
_HITS = "array<struct<first:long,size:long>>"
_HIT = pa.list_(pa.struct([("first", pa.int64()), ("size", pa.int64())]))


def _index(items: list[tuple[str, bytes]], window: int) -> dict:
    """ids: the items; text: their words, one space apart; sizes: window length -> sorted hashes, with begin and end in text and item of each."""
    ids, texts, at = sorted({i for i, _ in items}), [], 0
    number = {i: k for k, i in enumerate(ids)}
    made: dict[int, list[tuple]] = {}
    for item, raw in items:
        data = np.frombuffer(raw, np.uint8)
        s, e, h, _ = vec.words(data, np.array([0, len(data)]))
        n = min(window, len(s))
        if not n:
            continue
        lowered = vec.LOWER[data].tobytes()
        own = b" ".join([lowered[a:b] for a, b in zip(s, e, strict=True)])
        start = at + np.r_[0, np.cumsum(e - s + 1)[:-1]]
        end = start + (e - s)
        made.setdefault(n, []).append((vec.grams(h, n), start[: len(s) - n + 1], end[n - 1 :], np.full(len(s) - n + 1, number[item])))
        texts.append(own)
        at += len(own) + 1
    sizes = {}
    for n, parts in made.items():
        g, start, end, item = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((item, g))
        g, start, end, item = g[order], start[order], end[order], item[order]
        new = np.r_[True, (g[1:] != g[:-1]) | (item[1:] != item[:-1])]
        sizes[n] = (g[new], start[new], (end - start)[new].astype(np.int32), item[new].astype(np.int32))
    return {"ids": ids, "text": b"\n".join(texts), "sizes": sizes}


def _found(index: dict, data: np.ndarray, s: np.ndarray, e: np.ndarray, h: np.ndarray, row: np.ndarray) -> tuple[list[tuple[int, int]], dict[int, set[str]]]:
    """(first word, number of words) of each window that is in the benchmark; the items of each row."""
    hits: list[tuple[int, int]] = []
    found: dict[int, set[int]] = {}
    lowered = None
    text, ids = index["text"], index["ids"]
    for size, (known, start, length, item) in index["sizes"].items():
        g = vec.grams(h, size)
        if not len(g):
            continue
        at = np.searchsorted(known, g)
        at[at == len(known)] = 0
        for k in np.flatnonzero((known[at] == g) & (row[: len(g)] == row[size - 1 :])).tolist():
            if lowered is None:
                lowered = vec.LOWER[data].tobytes()
            own = b" ".join([lowered[a:b] for a, b in zip(s[k : k + size], e[k : k + size], strict=True)])
            j, some = int(at[k]), False
            while j < len(known) and known[j] == g[k]:
                if length[j] == len(own) and text[start[j] : start[j] + length[j]] == own:
                    found.setdefault(int(row[k]), set()).add(int(item[j]))
                    some = True
                j += 1
            if some:
                hits.append((k, size))
    return hits, {r: {ids[k] for k in own} for r, own in found.items()}


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_mb: float):
    """The number of blocks, and how to make the index of one."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text")).where("item is not null and length(text) > 0")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-size // int(block_mb * (1 << 20))))

    def block(k: int) -> dict:
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        return _index([(r[0], bytes(r[1])) for r in part.toLocalIterator()], window)

    return n, block


def scan(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, block_mb: float = 4, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: its number of words, hit spans (in bytes of the UTF-8 text), words hit, items found, the text without the spans, and the columns in ``carry`` that have other names."""
    small_batches(docs.sparkSession)
    carried = [c for c in carry if c not in (id_col, "n_words", "spans", "n_hit", "items", "cleaned")]
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), *[F.col(c).alias(f"_c{k}") for k, c in enumerate(carried)])
    types = dict(source.dtypes)
    out = ", ".join([f"_id {types['_id']}", _OWN, *[f"_c{k} {types[f'_c{k}']}" for k in range(len(carried))]])
    n, block = _blocks(benchmark, item_col, item_text_col, window, block_mb)
    sc = docs.sparkSession.sparkContext

    def tell(batch, lo, hi, part, own, words, hits, items):
        """The output of a slice of a batch; hits: (first word, words) of the slice; items: of each row."""
        s, e, _, row = words
        step = np.zeros(len(s) + 1, np.int64)
        if hits:
            first, size = np.array(hits).T
            np.add.at(step, first, 1)
            np.add.at(step, first + size, -1)
        inside = np.cumsum(step)[:-1] > 0
        counts = np.bincount(row, minlength=hi - lo)
        n_hit = np.bincount(row[inside], minlength=hi - lo)
        spans: list[list] = [[] for _ in range(hi - lo)]
        if hits:  # consecutive hit words of one document are one span
            w = np.flatnonzero(inside)
            new = np.r_[True, (np.diff(w) > 1) | (row[w[1:]] != row[w[:-1]])]
            last = np.r_[new[1:], True]
            for a, b in zip(w[new], w[last], strict=True):
                d = int(row[a])
                spans[d].append({"start": int(s[a] - own[d]), "end": int(e[b] - own[d])})
        texts = batch.column("_text").slice(lo, hi - lo)
        if hits:
            kept = texts.to_pylist()
            for d, some in enumerate(spans):
                if some:
                    raw, at, left = part[own[d] : own[d + 1]].tobytes(), 0, []
                    for x in some:
                        left.append(raw[at : x["start"]])
                        at = x["end"]
                    kept[d] = b"".join([*left, raw[at:]]).decode("utf-8", "replace")
            texts = pa.array(kept, pa.string())
        cols = [batch.column("_id").slice(lo, hi - lo), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), texts]
        names = ["_id", "n_words", "spans", "n_hit", "items", "cleaned"]
        for k in range(len(carried)):
            cols.append(batch.column(f"_c{k}").slice(lo, hi - lo))
            names.append(f"_c{k}")
        return pa.RecordBatch.from_arrays(cols, names)

    def slices(batches):
        for batch in batches:
            data, offsets = vec.text_buffer(batch.column("_text"))
            for lo, hi in vec.slices(offsets):
                own, part = offsets[lo : hi + 1] - offsets[lo], data[offsets[lo] : offsets[hi]]
                yield batch, lo, hi, part, own, vec.words(part, own)

    def named(df: DataFrame) -> DataFrame:
        return df.withColumnsRenamed({"_id": id_col} | {f"_c{k}": c for k, c in enumerate(carried)})

    if n == 1:
        sent = sc.broadcast(block(0))

        def run(batches):
            for batch, lo, hi, part, own, words in slices(batches):
                hits, found = _found(sent.value, part, *words)
                yield tell(batch, lo, hi, part, own, words, hits, [sorted(found.get(d, ())) for d in range(hi - lo)])

        return named(source.mapInArrow(run, out))

    # equal rows have equal hits, so a row is known by its id and text
    source = source.withColumn("_key", F.concat_ws(" ", F.coalesce(F.col("_id").cast("string"), F.lit("no id")), F.md5(F.coalesce(F.col("_text"), F.lit("")).cast("binary"))))
    tables = None
    for k in range(n):
        sent = sc.broadcast(block(k))

        def hits_of(batches, sent=sent):
            for batch, lo, hi, part, own, words in slices(batches):
                hits, found = _found(sent.value, part, *words)
                if hits:
                    row, begin = words[3], np.searchsorted(words[3], np.arange(hi - lo))
                    per: dict[int, list] = {}
                    for a, size in hits:
                        d = int(row[a])
                        per.setdefault(d, []).append({"first": int(a - begin[d]), "size": size})
                    at = sorted(per)
                    yield pa.RecordBatch.from_arrays([batch.column("_key").slice(lo, hi - lo).take(pa.array(at)), pa.array([per[d] for d in at], _HIT), pa.array([sorted(found[d]) for d in at], pa.list_(pa.string()))], ["_key", "hits", "found"])

        mine = cut(source.select("_key", "_text").mapInArrow(hits_of, f"_key string, hits {_HITS}, found array<string>").dropDuplicates(["_key"]))
        sent.destroy()
        tables = mine if tables is None else tables.unionByName(mine)
    known = tables.groupBy("_key").agg(F.flatten(F.collect_list("hits")).alias("_hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("_found"))  # one row a block

    def last(batches):
        for batch, lo, hi, part, own, words in slices(batches):
            begin = np.searchsorted(words[3], np.arange(hi - lo))
            told = batch.column("_hits").slice(lo, hi - lo).to_pylist()
            hits = [(int(begin[d]) + x["first"], x["size"]) for d, some in enumerate(told) for x in some or ()]
            yield tell(batch, lo, hi, part, own, words, hits, [x or [] for x in batch.column("_found").slice(lo, hi - lo).to_pylist()])

    return named(source.join(known, "_key", "left").drop("_key").mapInArrow(last, out))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, mode: str = "documents", id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents' own columns; mode ``documents`` drops each document with a hit, ``spans`` cuts the hit words out."""
    if mode not in ("documents", "spans"):
        raise ValueError(f"mode is documents or spans, not {mode!r}")
    names = {c: f"brindle in {k}" for k, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    found = scan(plain, benchmark, id_col=names[id_col], text_col=names[text_col], carry=tuple(v for c, v in names.items() if c not in (id_col, text_col)), **options)
    if mode == "documents":
        found = found.where("n_hit = 0")
    return found.select(*[F.col("cleaned" if c == text_col else v).alias(c) for c, v in names.items()])
