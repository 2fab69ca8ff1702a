"""Models behind small interfaces, with deterministic defaults that need no weights and no network.

A provider is built once in each Python worker and works on lists, so a remote or GPU model is a class with the same method.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Chunks that a model gets at a time at most, and words, each chunk counted as long as the longest beside it.
EMBED_BATCH, EMBED_WORDS = 128, 16_384


class Embedder(Protocol):
    size: int
    context: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class Extractor(Protocol):
    def extract(self, texts: list[str]) -> list[dict[str, list[str]]]: ...


class Analyst(Protocol):
    def analyse(self, texts: list[str]) -> list[str | None]: ...


class HashEmbedder:
    """Signed feature hashing of words and word pairs, unit length; an empty text is a zero vector."""

    #: Hashes of words that came before; emptied when it has so many.
    MEMO = 200_000

    def __init__(self, size: int = 320, context: int = 512) -> None:
        self.size, self.context = size, context
        self.known: dict[str, int] = {}

    def _hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        for w in set(words).difference(known):
            known[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
        out = np.fromiter((known[w] for w in words), np.uint64, len(words))
        if len(known) > self.MEMO:
            known.clear()
        return out

    def embed(self, texts: list[str]) -> np.ndarray:
        own = [re.findall(r"\w+", t.lower()) for t in texts]
        h = self._hashes([w for ws in own for w in ws])
        row = np.repeat(np.arange(len(texts)), [len(ws) for ws in own])
        pair = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
        pair ^= pair >> np.uint64(29)
        pair *= np.uint64(0xBF58476D1CE4E5B9)
        same = row[:-1] == row[1:]
        every, at = np.concatenate([h, pair[same]]), np.concatenate([row, row[:-1][same]])
        slot = at * self.size + (every % np.uint64(self.size)).astype(np.int64)
        out = np.bincount(slot, np.where(every >> np.uint64(63), 1.0, -1.0), minlength=len(texts) * self.size).reshape(len(texts), self.size)
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(n > 0, n, 1)).astype(np.float32)


# Entity labels and the field each goes to.
LABEL_FIELDS = {
    "person": "people", "people": "people", "politician": "people", "company": "companies", "organization": "companies", "government agency": "companies", "product": "products",
    "technology": "products", "software": "products", "stock ticker": "stock_tickers", "location": "regions", "country": "regions", "city": "regions", "region": "regions",
}
FIELDS = ("regions", "people", "products", "companies", "stock_tickers")


class PatternExtractor:
    """Entities by a gazetteer {name: label} and by the pattern of stock tickers."""

    def __init__(self, gazetteer: dict[str, str] | None = None) -> None:
        self.names = {k.lower(): (k, v) for k, v in (gazetteer or {}).items()}
        self.find = re.compile(r"\b(" + "|".join(sorted(map(re.escape, self.names), key=len, reverse=True)) + r")\b", re.I) if self.names else None

    def extract(self, texts: list[str]) -> list[dict[str, list[str]]]:
        out = []
        for t in texts:
            found: dict[str, dict[str, str]] = {f: {} for f in FIELDS}
            for m in self.find.findall(t) if self.find else ():
                name, label = self.names[m.lower()]
                found[LABEL_FIELDS[label]].setdefault(name.lower(), name)
            for m in re.findall(r"(?:\$|\b(?:NYSE|NASDAQ):\s?)([A-Z]{1,6})\b", t):
                found["stock_tickers"].setdefault(m.lower(), m)
            out.append({k: sorted(v.values()) for k, v in found.items()})
        return out


class LeadAnalyst:
    """A digest without a model: the first sentences as briefing."""

    def __init__(self, sentences: int = 3) -> None:
        self.sentences = sentences

    def analyse(self, texts: list[str]) -> list[str | None]:
        out: list[str | None] = []
        for t in texts:
            s = [x.strip() for x in re.split(r"(?<=[.!?])\s+", t) if x.strip()]
            out.append(json.dumps({"briefing": " ".join(s[: self.sentences]), "events": s[:1]}) if s else None)
        return out


def split_words(text: str, context: int, overlap: int = 32, least_tail: int = 64) -> list[str]:
    """Overlapping chunks of at most ``context`` words; a last chunk under ``least_tail`` characters goes, if it is not the only one."""
    w = text.split()
    if len(w) <= context:
        return [text] if w else []
    out = [" ".join(w[k : k + context]) for k in range(0, max(1, len(w) - overlap), context - overlap)]
    return out[:-1] if len(out) > 1 and len(out[-1]) < least_tail else out


def bisected(work: Callable, items: list, tooBig: tuple = (MemoryError,)) -> list:
    """Work on a batch; where it does not fit, on its halves; a single item that does not fit gives None."""
    try:
        return list(work(items))
    except tooBig:
        if len(items) == 1:
            return [None]
        half = len(items) // 2
        return bisected(work, items[:half], tooBig) + bisected(work, items[half:], tooBig)


def by_length(sizes: list[int], most: int, budget: int) -> list[list[int]]:
    """Batches of items of like length, longest first: of at most ``most`` items, and of at most ``budget`` in all where each counts as the longest (or of one item)."""
    out: list[list[int]] = []
    for k in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        if out and len(out[-1]) < most and (len(out[-1]) + 1) * sizes[out[-1][0]] <= budget:
            out[-1].append(k)
        else:
            out.append([k])
    return out


def padded_share(sizes: list[int], batches: list[list[int]]) -> float:
    """How much of what the model works on is padding."""
    whole = sum(len(b) * max(sizes[k] for k in b) for b in batches)
    return 1 - sum(sizes) / whole if whole else 0.0


def _map(df: DataFrame, text_col: str, out: str, kind: str, build: Callable, work: Callable) -> DataFrame:
    names = [c for c in df.columns if c != out]
    plain = df.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(names)], F.col(text_col).alias("_t"))
    types = "".join(f"{c} {t}, " for c, t in plain.dtypes[:-1])

    def run(batches: Iterator[pa.RecordBatch]):
        model = build()
        for b in batches:
            texts = [t or "" for t in b.columns[-1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], work(model, texts)], [*b.schema.names[:-1], "_y"])

    return plain.mapInArrow(run, f"{types}_y {kind}").select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(names)], F.col("_y").alias(out))


def embed(df: DataFrame, build: Callable[[], Embedder] = HashEmbedder, *, text_col: str = "content", out: str = "embedding", max_chars: int | None = None, prefix: str = "") -> DataFrame:
    """Embeddings of whole texts: chunks of the model's context, sent to it in batches of like length whatever text they are of, put back in order, and averaged by text.

    A batch that does not fit is halved until it does; a chunk that does not fit alone has no vector.
    """

    def work(model, texts):
        parts, ends = [], [0]
        for t in texts:
            parts += split_words((prefix + t)[:max_chars] if max_chars else prefix + t, model.context)
            ends.append(len(parts))
        vecs: list = [None] * len(parts)
        for batch in by_length([len(p.split()) for p in parts], EMBED_BATCH, EMBED_WORDS):
            for k, v in zip(batch, bisected(model.embed, [parts[k] for k in batch]), strict=True):
                vecs[k] = v
        own = [[v for v in vecs[a:b] if v is not None] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.array([np.mean(x, axis=0).astype(np.float32) if x else None for x in own], pa.list_(pa.float32()))

    return _map(df, text_col, out, "array<float>", build, work)


def embed_query(text: str, build: Callable[[], Embedder] = HashEmbedder) -> list[float]:
    return [float(x) for x in build().embed([f"query: {text}"])[0]]


def extract(df: DataFrame, build: Callable[[], Extractor] = PatternExtractor, *, text_col: str = "content", out: str = "found", context: int = 512) -> DataFrame:
    """Entities of whole texts: chunks are searched and merged, a name once whatever its case."""

    def work(model, texts):
        made = []
        for t in texts:
            merged: dict[str, dict[str, str]] = {f: {} for f in FIELDS}
            for found in model.extract(split_words(t, context) or [""]):
                for f, names in found.items():
                    for n in names:
                        merged[f].setdefault(n.lower(), n)
            made.append({f: sorted(v.values()) for f, v in merged.items()})
        return pa.array(made, pa.struct([(f, pa.list_(pa.string())) for f in FIELDS]))

    return _map(df, text_col, out, "struct<" + ",".join(f"{f}:array<string>" for f in FIELDS) + ">", build, work)


def analyse(df: DataFrame, schema: str, build: Callable[[], Analyst] = LeadAnalyst, *, text_col: str = "content", out: str = "digest", max_prompt_words: int = 4096) -> DataFrame:
    """A structured answer a text, by schema; null where the model gave none or no JSON.  Texts are cut to four characters a prompt word."""

    def work(model, texts):
        return pa.array(bisected(model.analyse, [t[: max_prompt_words << 2] for t in texts]), pa.string())

    raw = _map(df, text_col, out, "string", build, work)
    return raw.withColumn(out, F.from_json(F.regexp_replace(F.col(out), r"^\s*```(?:json)?\s*|\s*```\s*$", ""), schema))


def json_schema(schema: str) -> dict:
    """The JSON schema of a DDL schema, for models that answer by schema."""
    from pyspark.sql import types as T

    plain = {"string": "string", "boolean": "boolean", "double": "number", "float": "number"}

    def of(t) -> dict:
        if isinstance(t, T.StructType):
            return {"type": "object", "properties": {f.name: of(f.dataType) for f in t.fields}, "required": [f.name for f in t.fields if not f.nullable]}
        if isinstance(t, T.ArrayType):
            return {"type": "array", "items": of(t.elementType)}
        if isinstance(t, T.MapType):
            return {"type": "object", "additionalProperties": of(t.valueType)}
        if isinstance(t, (T.DateType, T.TimestampType)):
            return {"type": "string", "format": "date" if isinstance(t, T.DateType) else "date-time"}
        return {"type": plain.get(t.typeName(), "integer")}

    return of(T._parse_datatype_string(schema))


#: Providers by URI prefix.
EMBEDDERS: dict[str, Callable[[str], Callable[[], Embedder]]] = {"hash://": lambda rest: lambda: HashEmbedder(int(rest or 320))}


def embedder(uri: str) -> Callable[[], Embedder]:
    """hash://320, or another prefix that was registered in EMBEDDERS."""
    for prefix, make in EMBEDDERS.items():
        if uri.startswith(prefix):
            return make(uri.removeprefix(prefix))
    raise ValueError(f"no embedder for {uri}")
