"""Toxicity scores: logistic regression trained by FTRL-proximal over hashed word n-grams and skip-grams.

Besides words, pairs and skip-grams, the first four and five bytes of longer words are features (stems), as inflected forms of one
word share them.

``train`` fits on a bounded sample: the ``max_rows`` labelled documents that hash lowest by id, of each of
which all words are used.  A document's features lie in a list or, where that is shorter, in a bitmap, so none takes more than ``2**bits`` / 8 bytes
however long it is.  One task learns them in a fixed order; each coordinate has its own
learning rate and the L1 term leaves most weights at exactly 0, so the model is a short list of
(slot, weight) of at most ``2**bits`` entries.  ``score`` broadcasts it, hashes each whole document once and
adds the weights of the distinct features that it has; rows are never shuffled.

Defined cases: a null or empty text has the bias alone as its score; a document labelled twice with
different labels is labelled toxic; labels other than 0 and 1, and null ones, are left out; with no labels all scores are 0.5.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import small_batches

_BIAS = 0


@dataclass(frozen=True)
class Settings:
    bits: int = 20
    alpha: float = 1.5
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.1
    epochs: int = 4
    max_rows: int = 12_000
    skip: int = 2
    stems: tuple[int, ...] = (4, 5)


def _slots(data: np.ndarray, offsets: np.ndarray, s: Settings):
    """Slot and row of each word, stem, bigram and skip-gram (two words with 1 to ``skip`` between them)."""
    start, end, hashes, row = vec.words(data, offsets)
    shift = np.uint64(64 - s.bits)
    out, rows = [hashes >> shift], [row]
    for gap in range(1, s.skip + 2):
        if len(hashes) > gap:
            same = row[:-gap] == row[gap:]
            pair = vec.mix(hashes[:-gap] * np.uint64(0x9E3779B97F4A7C15) + hashes[gap:] + np.uint64(gap))
            out.append((pair >> shift)[same])
            rows.append(row[:-gap][same])
    for n in s.stems:
        long = np.flatnonzero(end - start > n)
        stem = np.full(len(long), n, np.uint64)
        for j in range(n):
            stem = stem * np.uint64(0x100000001B3) + vec.LOWER_BYTES[data[start[long] + j]]
        out.append(vec.mix(stem) >> shift)
        rows.append(row[long])
    return np.concatenate(out).astype(np.int64), np.concatenate(rows)


def _features(data: np.ndarray, offsets: np.ndarray, s: Settings) -> list[np.ndarray]:
    """The distinct slots of each row."""
    slot, at = _slots(data, offsets, s)
    key = np.unique(at * (1 << s.bits) + slot)
    cut = np.searchsorted(key, np.arange(len(offsets)) << s.bits)
    key &= (1 << s.bits) - 1
    return [key[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _pack(slots: np.ndarray, bits: int) -> bytes:
    """A sorted list of slots as 32-bit numbers, or as a bitmap where that is shorter."""
    if len(slots) < 1 << (bits - 5):
        return slots.astype(np.int32).tobytes()
    flags = np.zeros(1 << bits, bool)
    flags[slots] = True
    return np.packbits(flags).tobytes()


def _unpack(raw, bits: int) -> np.ndarray:
    if memoryview(raw).nbytes < 1 << (bits - 3):
        return np.frombuffer(raw, np.int32)
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8)))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def fit(rows, labels, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """rows: for each document its distinct slots (or their packed form).  Slots and weights that are not 0; slot -1 is the bias."""
    n = 1 << s.bits
    z, q = np.zeros(n + 1), np.zeros(n + 1)

    def weights(at):
        zi, qi = z[at], q[at]
        return np.where(np.abs(zi) <= s.l1, 0.0, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(qi)) / s.alpha + s.l2))

    for _ in range(s.epochs):
        for row, y in zip(rows, labels, strict=True):
            at = np.r_[n, row if isinstance(row, np.ndarray) else _unpack(row, s.bits)]
            w = weights(at)
            g = _sigmoid(w.sum()) - y
            sigma = (np.sqrt(q[at] + g * g) - np.sqrt(q[at])) / s.alpha
            z[at] += g - sigma * w
            q[at] += g * g
    slots = np.arange(n + 1)
    w = weights(slots)
    keep = np.flatnonzero(w)
    return np.where(keep == n, -1, keep), w[keep]


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", settings: Settings = Settings()) -> DataFrame:
    """The model as a DataFrame (slot int, weight double)."""
    small_batches(docs.sparkSession)
    s = settings
    drawn = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    drawn = drawn.withColumn("_at", F.xxhash64(F.col("_id").cast("string"))).orderBy("_at", "_id").limit(s.max_rows)  # bounded: max_rows ids
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_t"))
    rows = texts.join(F.broadcast(drawn), "_id").select("_at", "_id", "_y", "_t")

    def features(batches):
        for b in batches:
            data, offsets = vec.text_buffer(b.column("_t"))
            for lo, hi in vec.slices(offsets):
                made = _features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], s)
                yield pa.RecordBatch.from_arrays([b.column("_at").slice(lo, hi - lo), b.column("_y").slice(lo, hi - lo), vec.packed([_pack(x, s.bits) for x in made])], ["_at", "_y", "_f"])

    def learn(batches):
        at, y, f = [], [], []
        for b in batches:
            at += b.column("_at").to_pylist()
            y += b.column("_y").to_pylist()
            f += [x.as_buffer() for x in b.column("_f")]  # views, so the sample is held once
        key = lambda k: (at[k], y[k])
        order = []
        for _, same in groupby(sorted(range(len(at)), key=key), key=key):
            own = list(same)
            # rows of one id go by their features, of which only theirs are copied
            order += own if len(own) == 1 else sorted(own, key=lambda k: f[k].to_pybytes())
        slots, w = fit([f[k] for k in order], np.array([y[k] for k in order], float), s)
        yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(w, pa.float64())], ["slot", "weight"])

    return rows.mapInArrow(features, "_at long, _y int, _f binary").repartition(1).mapInArrow(learn, "slot int, weight double")


def score(docs: DataFrame, model: DataFrame, *, text_col: str = "text", score_col: str = "score", settings: Settings = Settings()) -> DataFrame:
    """The documents with one more column, the chance that a text is toxic; a column of that name is replaced."""
    small_batches(docs.sparkSession)
    s = settings
    table = np.zeros(1 << s.bits, np.float32)
    bias = 0.0
    for r in model.toLocalIterator():  # at most 2**bits rows
        if r["slot"] < 0:
            bias = r["weight"]
        else:
            table[r["slot"]] = r["weight"]
    used = np.flatnonzero(table)
    sent = docs.sparkSession.sparkContext.broadcast((used.astype(np.int32), table[used], bias))
    names = [c for c in docs.columns if c != score_col]
    plain = docs.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(names)], F.col(text_col).cast("string").alias("_t"))
    types = ", ".join(f"{c} {t}" for c, t in plain.dtypes[:-1])

    def run(batches):
        slots, weights, b0 = sent.value
        full = np.zeros(1 << s.bits, np.float32)
        full[slots] = weights
        for b in batches:
            data, offsets = vec.text_buffer(b.column("_t"))
            total = np.full(len(offsets) - 1, b0)
            for lo, hi in vec.slices(offsets):
                slot, at = _slots(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], s)
                hit = full[slot] != 0
                key = np.unique(at[hit] * (1 << s.bits) + slot[hit])
                total[lo:hi] += np.bincount(key >> s.bits, full[key & ((1 << s.bits) - 1)], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(_sigmoid(total), pa.float64())], [*b.schema.names[:-1], "_score"])

    made = plain.mapInArrow(run, f"{types}, _score double")
    return made.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(names)], F.col("_score").alias(score_col))


def held_out(id_col: str = "doc_id"):
    """Whether a document belongs to the fifth that labels are never learnt from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def reject(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """The documents, with their own columns, that score below the threshold."""
    model = train(docs, labels.where(~held_out(id_col)), id_col=id_col, text_col=text_col, settings=settings)
    return score(docs, model, text_col=text_col, score_col="_toxicity", settings=settings).where(F.col("_toxicity") < threshold).drop("_toxicity")
