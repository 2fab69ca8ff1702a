"""Token counts of a byte-fallback BPE vocabulary, by merging arrays instead of strings.

A text's tokens are what is left when, over and over, the adjacent pair of lowest rank is merged.  No piece holds a space mark behind another character, nor a newline, so no merge crosses
these places and a text falls into pre-tokens that are merged on their own.  Pre-tokens not met before are held together as ragged arrays: symbols, the pre-token of each, and the rank of each
adjacent pair.  A round finds the lowest rank of every pre-token, applies all its pairs at once (of overlapping ones the first, third, ...), and looks up the ranks beside the new symbols alone;
finished pre-tokens leave the arrays.  What survives is counted: a piece is one token, a character that is no piece one for each of its bytes.

Applying all pairs of a rank at once equals applying them one by one, unless a merged symbol could go on to a pair of no higher rank.  ``Merges`` finds the ranks
where the vocabulary allows that (pieces of one score have one rank, as runs of spaces here), and of those the leftmost pair is applied in a round.

A pre-token of over ``LONG`` symbols (a text without spaces) would need as many rounds over all of it as it has ranks: its places are filed by rank instead, and each round
takes up the places of the lowest rank alone, so the work follows the merges.  It needs some 30 bytes a character.

Each worker keeps the counts of the pre-tokens it met last, at most twice ``MEMO``.

Defined cases: null and empty texts have no tokens; the space mark in a text counts as a space, as in the library; a very long text is read in parts of a megabyte; repeated rows get equal results;
an empty table gives no rows; columns named like a result are replaced, all others come back.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .pieces import MARK
from .shared import small_batches

NONE = np.iinfo(np.int32).max  # the rank of a pair that no piece is made of
LONG = 512
MEMO = 200_000
PART = 1 << 20
RESULTS = ("n_bytes", "n_tokens", "over_limit")

_PRE = re.compile(f"\n|[ {MARK}]*[^ {MARK}\n]+|[ {MARK}]+")
_EDGE = re.compile(f"(?<=[^ {MARK}])[ {MARK}]|\n")


class Merges:
    """Symbols are numbered: pieces first, then characters that only occur inside pieces.  pieces: (text, score, kind) by id, as ``pieces.load`` gives them."""

    def __init__(self, pieces: list[tuple[str, float, str]]) -> None:
        normal = [(t, s) for t, s, kind in pieces if kind == "normal"]
        if any("\n" in t or MARK in t.lstrip(MARK) for t, _ in normal):
            raise ValueError("pieces that cross a space or a newline are not supported")
        number = {t: k for k, (t, _) in enumerate(normal)}
        tier = {x: k for k, x in enumerate(sorted({x for _, x in normal}, reverse=True))}
        self.tier = np.array([*(tier[x] for _, x in normal), NONE], np.int32)  # by piece; the last is that of piece -1
        letters = sorted({c for t in number for c in t} - number.keys())
        symbols = number | {c: len(number) + k for k, c in enumerate(letters)}
        self.has_bytes = any(kind == "byte" for _, _, kind in pieces)
        self.cost = np.array([1] * len(number) + [len(c.encode()) if self.has_bytes else 1 for c in letters], np.int32)
        self.symbol = np.full(0x110000, -1, np.int32)
        for t, k in symbols.items():
            if len(t) == 1:
                self.symbol[ord(t)] = k
        self.pairs: dict[int, int] = {}  # two symbols -> the piece that they make
        self.one_by_one = np.zeros(len(tier), bool)
        for k, (t, _) in enumerate(normal):
            for cut in range(1, len(t)):
                a, b = symbols.get(t[:cut]), symbols.get(t[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = k
                    for x in (a, b):
                        if x < len(normal) and self.tier[x] >= self.tier[k]:
                            self.one_by_one[self.tier[x]] = True
        # open addressing: a pair's place is its hash, or one of the few after it
        keys = np.array(sorted(self.pairs), np.int64)
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.made = np.full((1 << self.bits) + 64, -1, np.int64), np.full((1 << self.bits) + 64, -1, np.int32)
        self.steps = 0
        for key, at in zip(keys.tolist(), self._place(keys).tolist(), strict=True):
            step = 0
            while self.keys[at + step] >= 0:
                step += 1
            self.keys[at + step], self.made[at + step] = key, self.pairs[key]
            self.steps = max(self.steps, step + 1)
        self.memo: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, -1 if none."""
        keys = a.astype(np.int64) << 32 | b
        keys[(a < 0) | (b < 0)] = -2
        at = self._place(keys)
        have = self.keys[at]
        out = np.where(have == keys, self.made[at], -1).astype(np.int32)
        left = np.flatnonzero((have != keys) & (have >= 0))
        for step in range(1, self.steps):
            if not len(left):
                break
            have = self.keys[at[left] + step]
            hit = have == keys[left]
            out[left[hit]] = self.made[at[left[hit]] + step]
            left = left[~hit & (have >= 0)]
        return out

    def _symbols(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and costs of the parts' characters, one after another."""
        points = np.frombuffer("".join(parts).replace(" ", MARK).encode("utf-32-le"), np.uint32)
        sym = self.symbol[points]
        cost = self.cost[sym]
        other = sym < 0
        if other.any():
            p = points[other]
            cost[other] = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF) if self.has_bytes else 1
        return sym, cost

    def count(self, parts: list[str]) -> np.ndarray:
        """How many tokens each pre-token has."""
        out = np.zeros(len(parts), np.int64)
        short = [k for k, p in enumerate(parts) if len(p) <= LONG]
        if len(short) < len(parts):
            for k, p in enumerate(parts):
                if len(p) > LONG:
                    out[k] = self._count_long(*self._symbols([p]))
        if short:
            out[short] = self._count_ragged([parts[k] for k in short])
        return out

    def _count_ragged(self, parts: list[str]) -> np.ndarray:
        sym, cost = self._symbols(parts)
        out = np.zeros(len(parts), np.int64)
        who = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        made = np.full(len(sym), -1, np.int32)  # by each symbol and the next
        made[:-1] = np.where(who[1:] == who[:-1], self.join(sym[:-1], sym[1:]), -1)
        while len(who):
            rank = self.tier[made]
            begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
            least = np.repeat(np.minimum.reduceat(rank, begin), np.diff(np.r_[begin, len(who)]))
            done = least == NONE
            if done.any():
                out += np.bincount(who[done], cost[done], len(out)).astype(np.int64)
                sym, cost, who, made, rank, least = (x[~done] for x in (sym, cost, who, made, rank, least))
                if not len(who):
                    break
            hits = np.flatnonzero(rank == least)
            first = np.r_[True, who[hits[1:]] != who[hits[:-1]]]
            alone = self.one_by_one[rank[hits]]
            apart = self._apart(hits[1:] == hits[:-1] + 1)
            hits = hits[np.where(alone, first, apart)]
            sym[hits] = made[hits]
            cost[hits] = 1
            keep = np.ones(len(sym), bool)
            keep[hits + 1] = False
            at = np.cumsum(keep)[hits] - 1  # where the new symbols will be
            sym, cost, who, made = sym[keep], cost[keep], who[keep], made[keep]
            beside = np.zeros(len(sym), bool)
            beside[at] = True
            beside[at[at > 0] - 1] = True
            made[-1], beside[-1] = -1, False
            near = np.flatnonzero(beside)
            made[near] = np.where(who[near] == who[near + 1], self.join(sym[near], sym[near + 1]), -1)
        return out

    @staticmethod
    def _apart(touch: np.ndarray) -> np.ndarray:
        """Which hits stay when of those that overlap one after another every second one goes; touch says whether a hit overlaps the one before."""
        n = np.arange(len(touch) + 1)
        return (n - np.maximum.accumulate(np.where(np.r_[True, ~touch], n, 0))) % 2 == 0

    def _count_long(self, sym: np.ndarray, cost: np.ndarray) -> int:
        n = len(sym)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        made = np.full(n, -1, np.int32)
        files: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def file(places: np.ndarray) -> None:
            places = places[made[places] >= 0]
            if not len(places):
                return
            rank = self.tier[made[places]]
            order = np.argsort(rank, kind="stable")
            places, rank = places[order], rank[order]
            cuts = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
            for lo, hi in zip(cuts, np.r_[cuts[1:], len(rank)], strict=True):
                key = int(rank[lo])
                if key not in files:
                    files[key] = []
                    heapq.heappush(ranks, key)
                files[key].append(places[lo:hi])

        def one(place: int) -> list[int]:
            """Merge at one place; the places whose pair has changed."""
            sym[place], cost[place] = made[place], 1
            gone = after[place]
            beyond = after[gone]
            cost[gone], made[gone], after[place] = 0, -1, beyond
            if beyond < n:
                before[beyond] = place
            near = [place] if before[place] < 0 else [int(before[place]), place]
            for k in near:
                made[k] = -1 if after[k] >= n else self.pairs.get(int(sym[k]) << 32 | int(sym[after[k]]), -1) if sym[k] >= 0 <= sym[after[k]] else -1
            return near

        for lo in range(0, n - 1, PART):
            hi = min(n - 1, lo + PART)
            made[lo:hi] = self.join(sym[lo:hi], sym[lo + 1 : hi + 1])
        file(np.arange(n, dtype=np.int32))
        while ranks:
            lowest = heapq.heappop(ranks)
            places = np.unique(np.concatenate(files.pop(lowest)))
            places = places[self.tier[made[places]] == lowest]  # others have merged since
            if self.one_by_one[lowest]:
                heap = places.tolist()  # sorted, so a heap
                lower = False
                while heap and not lower:
                    place = heapq.heappop(heap)
                    if self.tier[made[place]] != lowest:
                        continue
                    for k in one(place):
                        rank = self.tier[made[k]]
                        if rank == lowest:
                            heapq.heappush(heap, k)
                        elif rank != NONE:
                            file(np.array([k], np.int32))
                            lower = lower or rank < lowest
                if heap:
                    file(np.unique(np.array(heap, np.int32)))
                continue
            hits = places[self._apart(places[1:] == after[places[:-1]])] if len(places) else places
            gone = after[hits]
            beyond = after[gone]
            sym[hits], cost[hits] = made[hits], 1
            cost[gone], made[gone] = 0, -1
            after[hits] = beyond
            inside = beyond < n
            before[beyond[inside]] = hits[inside]
            near = np.unique(np.concatenate([hits, before[hits][before[hits] >= 0]]))
            made[near] = -1
            near = near[after[near] < n]
            made[near] = self.join(sym[near], sym[after[near]])
            file(near)
        return int(cost.sum(dtype=np.int64))

    def known(self, parts: set[str]) -> None:
        """Count the pre-tokens that the memo lacks, all at once."""
        if len(self.memo) > MEMO:
            self.old, self.memo = self.memo, {}
        missing = parts.difference(self.memo)
        again = missing.intersection(self.old)
        self.memo.update((p, self.old[p]) for p in again)
        if new := list(missing - again):
            self.memo.update(zip(new, self.count(new).tolist(), strict=True))


def _parts(text: str):
    """The pre-tokens of a text, as lists for each megabyte or so."""
    text, lo = " " + text, 0
    while lo < len(text):
        edge = _EDGE.search(text, lo + PART) if lo + PART < len(text) else None
        hi = edge.start() if edge else len(text)
        yield _PRE.findall(text, lo, hi)
        lo = hi


def _tallies(merges: Merges, texts: list[str | None]) -> list[int]:
    """Tokens of each text; pre-tokens of about a megabyte are looked up together."""
    out = [0] * len(texts)
    held: list[tuple[int, list[str]]] = []
    size = 0

    def settle() -> None:
        nonlocal held, size
        every = set().union(*(found for _, found in held))
        merges.known(every)
        count = merges.memo.__getitem__
        for k, found in held:
            out[k] += sum(map(count, found))
        for p in every:
            if len(p) > 64:  # kept only while its megabyte is worked on
                del merges.memo[p]
        held, size = [], 0

    for k, text in enumerate(texts):
        for found in _parts(text) if text else ():
            held.append((k, found))
            size += len(text)
            if size > PART:
                settle()
    settle()
    return out


_built: dict[tuple, Merges] = {}


def _merges(sent, key) -> Merges:
    if key not in _built:
        _built.clear()
        _built[key] = Merges(sent.value)
    return _built[key]


def count(docs: DataFrame, pieces, *, limit: int = 4096, text_col: str = "text") -> DataFrame:
    """The documents with n_bytes (UTF-8), n_tokens, and over_limit (n_tokens > limit); no shuffle."""
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in RESULTS]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(names)], text.alias("_t"))
    types = "".join(f"{c} {t}, " for c, t in plain.dtypes[:-1])
    sent = docs.sparkSession.sparkContext.broadcast(list(pieces))  # as many rows as the vocabulary has
    key = (len(pieces), hash(tuple(pieces)))

    def run(batches):
        merges = _merges(sent, key)
        for b in batches:
            _, offsets = vec.text_buffer(b.columns[-1])
            tokens = _tallies(merges, b.columns[-1].to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(np.diff(offsets), pa.int64()), pa.array(tokens, pa.int64())], [*b.schema.names[:-1], "_n", "_k"])
            vec.trim()

    made = plain.mapInArrow(run, f"{types}_n long, _k long")
    return made.select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(names)], F.col("_n").alias("n_bytes"), F.col("_k").alias("n_tokens"), (F.col("_k") > limit).alias("over_limit"))
