"""Document fingerprints: bottom-k sketches of the hashes of word shingles.

A fingerprint holds the ``k`` least distinct 48-bit hashes of a text's shingles, in order, base64-coded after a letter: ``=`` where all of them
are there, ``+`` where there were more.  Sketches merge by keeping the k least of both (``merge``), so a corpus' sketch is that of its parts in any order.
From two sketches follow estimates of resemblance, containment and of the number of distinct shingles; they are exact
while the union has at most k shingles.

Defined cases: a null or empty text, or one without words, has the empty sketch ``=``; two empty sketches are alike (1), an empty and another are not (0);
a text of fewer than five words has one shingle of them all; a very long text is worked off in segments; an empty table gives no rows; only the id and the text
are read, so other columns may have any name.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import size_cuts, small_batches

K = 128
_BITS = 48


def _of(hashes: np.ndarray, row: np.ndarray, rows: int, k: int, n: int) -> list[tuple[np.ndarray, bool]]:
    """Sketch of each row: the least hashes, and whether they are all."""
    g, r = vec.row_shingles(hashes, row, n)
    g = g >> np.uint64(64 - _BITS)
    size = np.bincount(r, minlength=rows)
    # far more than k of a long row's hashes lie below this, so the rest need no sorting
    bound = np.where(size > 8 * k, (4.0 * k / np.maximum(size, 1)) * 2.0**_BITS, 2.0**_BITS)
    near = g < bound[r]
    a, b = vec.distinct_per_row(g[near], r[near])
    at = np.searchsorted(b, np.arange(rows + 1))
    whole = size <= 8 * k
    out = []
    for d in range(rows):
        own = a[at[d] : at[d + 1]]
        if not whole[d] and len(own) < k:  # many repeats: sort them all
            own = np.unique(g[r == d])
            out.append((own[:k], len(own) <= k))
        else:
            out.append((own[:k], bool(whole[d]) and len(own) <= k))
    return out


def encode(sketch: tuple[np.ndarray, bool]) -> str:
    values, whole = sketch
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    return ("=" if whole else "+") + base64.b64encode(raw).decode()


def decode(text: str) -> tuple[np.ndarray, bool]:
    raw = np.frombuffer(base64.b64decode(text[1:]), np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.view("<u8").reshape(-1).astype(np.uint64), text[0] == "="


def merge(a, b, k: int = K):
    """The sketch of two parts together."""
    both = np.union1d(a[0], b[0])
    return both[:k], a[1] and b[1] and len(both) <= k


def distinct(a, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a[0])) if a[1] else (k - 1) * 2.0**_BITS / float(a[0][-1])


def resemblance(a, b, k: int = K) -> float:
    """Estimated Jaccard similarity."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    both = np.union1d(a[0], b[0])
    if not (a[1] and b[1]):
        both = both[: min(k, *(len(x[0]) if not x[1] else k for x in (a, b)))]
    return len(np.intersect1d(np.intersect1d(a[0], b[0], True), both, True)) / len(both)


def containment(a, b, k: int = K) -> float:
    """Estimated share of a's shingles that b has."""
    n = distinct(a, k)
    if not n:
        return 1.0
    r = resemblance(a, b, k)
    return min(1.0, r * distinct(merge(a, b, k), k) / n)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, n: int = 5) -> DataFrame:
    """id, fingerprint, n_shingles (estimated number of distinct shingles) of each document; no shuffle."""
    small_batches(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))

    def run(batches):
        for b in batches:
            data, offsets = vec.text_buffer(b.column("_t"))
            for lo, hi in vec.slices(offsets):
                _, _, h, row = vec.words(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                made = _of(h, row, hi - lo, k, n)
                yield pa.RecordBatch.from_arrays([b.column("_id").slice(lo, hi - lo), pa.array([encode(x) for x in made], pa.string()), pa.array([distinct(x, k) for x in made], pa.float64())], ["_id", "fingerprint", "n_shingles"])

    return plain.mapInArrow(run, f"_id {plain.dtypes[0][1]}, fingerprint string, n_shingles double").withColumnRenamed("_id", id_col)


def merged(prints: DataFrame, key_col: str | None = None, *, fingerprint_col: str = "fingerprint", k: int = K, fan_in: int = 4096) -> DataFrame:
    """The merged fingerprint of each key (of all rows without one): every partition merges its own first, so a key has one sketch a partition, or one for ``fan_in`` keys that came between; salted groups of a key's sketches merge next, and then what is left of it."""
    key = F.col(key_col) if key_col else F.lit(0)
    rows = prints.select(key.alias("_k"), F.col(fingerprint_col).alias("_f"))
    kind = rows.dtypes[0][1]

    def local(batches):
        held: dict = {}
        for b in batches:
            for x, f in zip(b.column("_k").to_pylist(), b.column("_f").to_pylist(), strict=True):
                if f is not None:
                    s = decode(f)
                    held[x] = merge(held[x], s, k) if x in held else s
            if len(held) > fan_in:
                yield out(held)
                held = {}
        yield out(held)

    def out(held):
        return pa.RecordBatch.from_arrays([pa.array(list(held), types), pa.array([encode(s) for s in held.values()], pa.string())], ["_k", "_f"])

    from pyspark.sql.pandas.types import to_arrow_type

    types = to_arrow_type(rows.schema[0].dataType)
    rows = rows.mapInArrow(local, f"_k {kind}, _f string").repartition(F.col("_k"), F.pmod(F.xxhash64("_f"), F.lit(64)))
    rows = rows.mapInArrow(local, f"_k {kind}, _f string").groupBy("_k").applyInArrow(lambda t: pa.Table.from_batches(list(local(t.to_batches()))), f"_k {kind}, _f string")
    return rows.select(*([F.col("_k").alias(key_col)] if key_col else []), F.col("_f").alias(fingerprint_col))


def _part(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """Part 0 has the greatest ids, the last one the least and null."""
    at = np.searchsorted(cuts, ids.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False), "right")
    return (len(cuts) - at).astype(np.int32)


def against_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = K, n: int = 5, part_mb: int = 8) -> DataFrame:
    """Each document's fingerprint, that of its edited text (the last half of its code points replaced by as many first ones of the next document, going down by id;
    after the last, the first), and the likeness of its fingerprint to the edited text's and to the next document's.

    Documents go to parts by ranges of ids, once; the first document of each part also goes, as a guest, to the part before, where it is the last one's next.
    Ranges hold about ``part_mb`` of text each, and each is a task's own.  A repeated id goes by text (rows of one id are one part, which Spark sorts on disk); a null id counts as the least.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    cuts = np.array(size_cuts(rows.select("_id", F.octet_length("_t").cast("long").alias("_n")), part_mb), np.int64)

    def parts(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_part(b.column("_id"), cuts)), b.column("_id")], ["p", "_id"])

    heads = rows.select("_id").mapInArrow(parts, "p int, _id long").groupBy("p").agg(F.max("_id").alias("_id")).orderBy("p").collect()  # one row a part
    # the first document of a part is a guest of the part before it, that of part 0 of the last one
    guest_of = {h["p"]: (h["_id"], heads[k - 1]["p"]) for k, h in enumerate(heads)} if len(heads) > 1 else {}

    def deal(batches):
        for b in batches:
            p = _part(b.column("_id"), cuts)
            n = len(p)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(p), pa.array(np.zeros(n, bool))], ["_id", "_t", "p", "g"])
            ids = b.column("_id").to_pylist()
            again = [k for k, (i, own) in enumerate(zip(ids, p.tolist(), strict=True)) if own in guest_of and guest_of[own][0] == i]
            if again:
                own = b.take(pa.array(again))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array([guest_of[int(p[k])][1] for k in again], pa.int32()), pa.array([True] * len(again))], ["_id", "_t", "p", "g"])

    rows = rows.mapInArrow(deal, "_id long, _t string, p int, g boolean")
    schema = "_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def sketches(texts: list[str]):
        data = [t.encode("utf-8", "surrogatepass") for t in texts]
        offsets = np.r_[0, np.cumsum([len(x) for x in data])].astype(np.int64)
        whole = np.frombuffer(b"".join(data), np.uint8)
        out = []
        for lo, hi in vec.slices(offsets):
            _, _, h, row = vec.words(whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            out += _of(h, row, hi - lo, k, n)
        return out

    def emit(ids, texts, nexts):
        edited = [t[: len(t) - len(t) // 2] + x[: len(t) // 2] for t, x in zip(texts, nexts, strict=True)]
        s, e, x = sketches(texts), sketches(edited), sketches(nexts[-1:])
        follow = [*s[1:], x[0]]
        cols = [ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in edited], [encode(v) for v in s], [encode(v) for v in e], [resemblance(a, b, k) for a, b in zip(s, e, strict=True)], [resemblance(a, b, k) for a, b in zip(s, follow, strict=True)]]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        """Rows come by part, guests last, ids going down; groups of a few megabytes are worked off as they come."""
        ids, texts, size, at, first = [], [], 0, None, None

        def close(follower):
            return emit(ids, texts, [*texts[1:], follower])

        for b in batches:
            for p, g, i, t in zip(b.column("p").to_pylist(), b.column("g").to_pylist(), b.column("_id").to_pylist(), b.column("_t").to_pylist(), strict=True):
                if p != at:
                    if ids:
                        yield close(first)  # only without guests, in a table of one part
                    ids, texts, size, at, first = [], [], 0, p, t
                if g:
                    if ids:
                        yield close(t)
                    ids, texts, size = [], [], 0
                    continue
                if size > vec.CHUNK:
                    yield close(t)
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(t)
                size += len(t)
        if ids:
            yield close(first)

    dealt = rows.repartitionById(len(cuts) + 1, "p").sortWithinPartitions("p", "g", F.col("_id").desc_nulls_last(), "_t")
    return dealt.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
