"""Encoding to SentencePiece ids and back.

The pieces and scores of a model file form an Aho-Corasick automaton.  One pass over a text follows its output links: every piece
that ends at a position relaxes the best score there (longest first, and a tie keeps the first), so the segmentation with the greatest sum
of scores is read off the back pointers.  A character that no piece covers costs the least score minus 10 and becomes its bytes' pieces.

Where no piece crosses from another character to the space mark, or holds a newline, the best segmentation falls apart
at those places; the parts repeat much, and each worker keeps the ids of those it met last, some twice ``MEMO`` of them.  The parts of a megabyte of text that it does not have go
through the automaton together, a character of each at a time; those with a character that is no piece, and those of more than ``SHORT`` characters, one by one.

A model of kind BPE is scored in the same way, by the greatest sum of its scores; the order of merges that the library's
own BPE takes may give other ids, with a sum that is never greater.

Spaces become the mark U+2581, of which one more comes first.  Decoding gives the text back exactly, but that a mark in the text itself comes back as a space.

Defined cases: a null text has null ids and decodes to null; an empty text has none; a very long text is worked off in parts of a megabyte where the vocabulary lets it fall apart, and in windows of
65,536 characters where it does not; rows never affect each other; an empty table gives no rows; a column named like a result's is replaced, all others come back.
"""

from __future__ import annotations

import re
from array import array
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vec
from .shared import small_batches

MEMO = 150_000
ROWS = 512
SHORT = 64
SLICE = 1 << 20
WINDOW = 1 << 16
MARK = "▁"
_EDGE = re.compile(f"(?<=[^{MARK}]){MARK}")
_built: dict[tuple, PieceModel] = {}


class _Arrays:
    """The automaton as arrays, for many short texts at once.  State 0 is the root, and the states of a level follow those of the one above."""

    def __init__(self, pieces: list[tuple[str, int, float]]) -> None:
        pieces = [p for p in pieces if p[0]]
        self.size = np.array([len(t) for t, _, _ in pieces], np.int64)
        self.id = np.array([k for _, k, _ in pieces], np.int32)
        self.score = np.array([s for _, _, s in pieces], np.float64)
        points = _points("".join(t for t, _, _ in pieces))
        self.classes = np.zeros(int(points.max(initial=0)) + 2, np.int64)  # 0: in no piece
        known = np.unique(points)
        self.classes[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        first = np.cumsum(self.size) - self.size
        self.single = np.zeros(self.width, bool)
        self.single[self.classes[points[first[self.size == 1]]]] = True
        self.keys = np.zeros(0, np.int64)  # state before * width + class, ascending; the state after is the place in it and 1
        self.fail = np.zeros(1, np.int64)
        self._file()
        at, own = np.zeros(len(pieces), np.int64), np.full(1, -1, np.int64)
        for depth in range(int(self.size.max(initial=0))):
            alive = np.flatnonzero(self.size > depth)
            keys, place = np.unique(at[alive] * self.width + self.classes[points[first[alive] + depth]], return_inverse=True)
            fail = self.step(self.fail[keys // self.width], keys % self.width) if depth else np.zeros(len(keys), np.int64)
            at[alive] = len(own) + place
            mine = np.full(len(keys), -1, np.int64)
            ends = alive[self.size[alive] == depth + 1]
            mine[at[ends] - len(own)] = ends
            self.fail, self.keys, own = np.r_[self.fail, fail], np.r_[self.keys, keys], np.r_[own, mine]
            self._file()
        # out: the state itself or the next along its failures that ends a piece; link: the same from its failure on; 0: none
        self.out, self.link = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        depth = np.array(self._depths(), np.int64)
        for d in range(1, int(depth.max(initial=0)) + 1):
            level = np.flatnonzero(depth == d)
            self.link[level] = self.out[self.fail[level]]
            self.out[level] = np.where(own[level] >= 0, level, self.link[level])
        # of the piece that ends with a state; the root stands for a character of none
        ends = np.flatnonzero(own >= 0)
        which, self.steps, self.gains, self.ids = own[ends], np.ones(len(own), np.int64), np.zeros(len(own)), np.zeros(len(own), np.int32)
        self.steps[ends], self.gains[ends], self.ids[ends] = self.size[which], self.score[which], self.id[which]

    def _depths(self) -> list[int]:
        depth = [0]
        for parent in (self.keys // self.width).tolist():
            depth.append(depth[parent] + 1)
        return depth

    def _file(self) -> None:
        """Keys by hash, each in the first free place from its own on."""
        bits = max(4, (4 * len(self.keys)).bit_length())
        self.shift, self.slots, self.after = np.uint64(64 - bits), np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        todo, at = np.arange(len(self.keys)), self._slot(self.keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = self.keys[todo[free]]  # the last of several stays
            here = self.slots[at] == self.keys[todo]
            self.after[at[here]] = todo[here] + 1
            todo, at = todo[~here], (at[~here] + 1) & (len(self.slots) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _child(self, key: np.ndarray) -> np.ndarray:
        """The state that a key leads to, 0 if there is none."""
        at = self._slot(key)
        seen = self.slots[at]
        found = np.where(seen == key, self.after[at], 0)
        on = np.flatnonzero((seen != key) & (seen >= 0))
        while len(on):
            at[on] = (at[on] + 1) & (len(self.slots) - 1)
            seen = self.slots[at[on]]
            hit = seen == key[on]
            found[on[hit]] = self.after[at[on[hit]]]
            on = on[~hit & (seen >= 0)]
        return found

    def step(self, state: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """The states after a character of these classes."""
        after = self._child(state * self.width + kind)
        todo = np.flatnonzero((after == 0) & (state > 0))
        state = state[todo]
        while len(todo):
            state = self.fail[state]
            found = self._child(state * self.width + kind[todo])
            after[todo] = found
            on = (found == 0) & (state > 0)
            todo, state = todo[on], state[on]
        return after

    def segment(self, texts: list[str]) -> list[bytes | None]:
        """Ids of the best segmentation of each, as the bytes of whole numbers of 32 bits; none for those with a character that is no piece.  No text is empty; the longest come first."""
        size = np.array([len(t) for t in texts], np.int64)
        points = _points("".join(texts))
        kinds = self.classes[np.minimum(points, len(self.classes) - 1)]
        first = np.cumsum(size) - size
        place = first + np.arange(len(size))  # of a text's start, one place more than it has characters
        best = np.zeros(len(points) + len(size))
        ended, state = np.zeros(len(best), np.int64), np.zeros(len(size), np.int64)
        fine = np.logical_and.reduceat(self.single[kinds], first) if len(size) else np.zeros(0, bool)
        for k in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-size, -k))  # those that go on
            state = self.step(state[:n], kinds[first[:n] + k])
            ends, out = place[:n] + k + 1, self.out[state]
            best[ends], ended[ends] = best[ends - self.steps[out]] + self.gains[out], out
            while True:  # the longest first, and a tie keeps the first
                out = self.link[out]
                some = np.flatnonzero(out)
                if not len(some):
                    break
                ends, out = ends[some], out[some]
                sums = best[ends - self.steps[out]] + self.gains[out]
                better = np.flatnonzero(sums > best[ends])
                at = ends[better]
                best[at], ended[at] = sums[better], out[better]
        found, count = [], np.zeros(len(size), np.int64)
        rows = np.flatnonzero(fine)
        at = place[rows] + size[rows]
        while len(rows):
            out = ended[at]
            found.append((rows, self.ids[out]))
            count[rows] += 1
            at = at - self.steps[out]
            on = at > place[rows]
            rows, at = rows[on], at[on]
        ends = np.cumsum(count)
        ids, left = np.zeros(int(count.sum()), np.int32), ends.copy()
        for rows, which in found:  # from a text's end to its start
            left[rows] -= 1
            ids[left[rows]] = which
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] if b > a else None for a, b in zip((ends - count).tolist(), ends.tolist(), strict=True)]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


class _Memo:
    """Ids of parts that came before, in two generations: what is still used moves on when the younger one is full."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[list[str]]) -> list[bytes]:
        """Ids of texts that are cut into parts."""
        young, old, model = self.young, self.old, self.model
        new, long = [], []
        for part in set().union(*texts).difference(young):
            if part in old:
                young[part] = old[part]
            elif len(part) <= SHORT:
                new.append(part)
            else:
                long.append(part)
        new.sort(key=len, reverse=True)
        young.update(zip(new, model.arrays.segment(new), strict=True))
        for part in [p for p in new if young[p] is None] + long:
            young[part] = array("i", model.segment(part)).tobytes()
        made = [b"".join([young[p] for p in parts]) for parts in texts]
        for part in long:
            del young[part]
        if len(young) >= MEMO:
            self.young, self.old = {}, young
        return made


class PieceModel:
    """pieces: (text, score, kind) by id, kind one of normal, byte, unknown, control."""

    def __init__(self, pieces: list[tuple[str, float, str]]) -> None:
        self.bytes: dict[int, int] = {}
        self.raw: list[bytes] = []
        self.unknown = 0
        self.normal = []
        for k, (text, score, kind) in enumerate(pieces):
            if kind == "normal":
                self.normal.append((text, k, score))
                self.raw.append(text.replace(MARK, " ").encode())
            elif kind == "byte":
                self.bytes[int(text[3:5], 16)] = k
                self.raw.append(bytes([int(text[3:5], 16)]))
            else:
                self.raw.append(" ⁇ ".encode() if kind == "unknown" else b"")
                if kind == "unknown":
                    self.unknown = k
        self.longest = max((len(t) for t, _, _ in self.normal), default=1)
        self.single = {t for t, _, _ in self.normal if len(t) == 1}
        self.penalty = min((s for _, _, s in self.normal), default=0.0) - 10.0
        crosses = any(MARK in t.lstrip(MARK) for t, _, _ in self.normal)
        newline = any("\n" in t for t, _, _ in self.normal)
        self.parts = None if crosses else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if newline else f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        self.memo = _Memo(self)

    @cached_property
    def machine(self):
        """The automaton; decoding never needs it."""
        import ahocorasick

        machine = ahocorasick.Automaton()
        for text, k, score in self.normal:
            machine.add_word(text, (k, len(text), score))
        machine.make_automaton()
        return machine

    @cached_property
    def arrays(self) -> _Arrays:
        return _Arrays(self.normal)

    def segment(self, text: str) -> list[int]:
        """Ids of the best segmentation of a text whose spaces are marks.

        A long text is worked off in windows.  The last places of a window, as many as the longest piece has characters, are all that what follows can build on; where their
        best paths run together, everything before is settled, and the next window begins there.
        """
        out: list[int] = []
        lo = 0
        while len(text) - lo > 2 * WINDOW:
            size, settled = WINDOW, 0
            while not settled and lo + size < len(text):  # paths that have not met yet: a longer window
                start, piece = self._paths(text[lo : lo + size])
                settled = self._meeting(start, size)
                size *= 2
            if not settled:
                break
            out += self._ids(text[lo : lo + settled], start, piece, settled)
            lo += settled
        rest = text[lo:]
        start, piece = self._paths(rest)
        return out + self._ids(rest, start, piece, len(rest))

    def _meeting(self, start: list[int], n: int) -> int:
        """The last place that the best paths to all of the last places go through."""
        heads = set(range(max(1, n - self.longest + 1), n + 1))
        while len(heads) > 1:
            far = max(heads)
            heads.discard(far)
            heads.add(start[far])
        return heads.pop()

    def _paths(self, text: str) -> tuple[list[int], list[int]]:
        """The best way to each place: where its last piece begins, and the piece."""
        n = len(text)
        best, start, piece = [0.0] + [-float("inf")] * n, [0] * (n + 1), [-1] * (n + 1)
        if self.single.issuperset(text):  # every character is a piece, so every place is reached
            for end, (pid, size, score) in self.machine.iter(text):
                end += 1
                v = best[end - size] + score
                if v > best[end]:
                    best[end], start[end], piece[end] = v, end - size, pid
        else:
            self._with_unknown(text, best, start, piece)
        return start, piece

    def _ids(self, text: str, start: list[int], piece: list[int], n: int) -> list[int]:
        out: list[int] = []
        while n:
            if piece[n] >= 0:
                out.append(piece[n])
            else:
                out += [self.bytes.get(x, self.unknown) for x in reversed(text[start[n] : n].encode("utf-8", "replace"))]
            n = start[n]
        return out[::-1]

    def _with_unknown(self, text: str, best: list[float], start: list[int], piece: list[int]) -> None:
        done = 0

        def rest(upto: int) -> None:  # characters that are no piece
            for k in range(done, upto):
                if text[k] not in self.single and best[k] + self.penalty > best[k + 1]:
                    best[k + 1], start[k + 1], piece[k + 1] = best[k] + self.penalty, k, -1

        for end, (pid, size, score) in self.machine.iter(text):
            if end > done:
                rest(end)
                done = end
            v = best[end + 1 - size] + score
            if v > best[end + 1]:
                best[end + 1], start[end + 1], piece[end + 1] = v, end + 1 - size, pid
        rest(len(text))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text; none of a null one."""
        if self.parts is None:
            return [None if t is None else np.array(self.segment(MARK + t.replace(" ", MARK)) if t else [], np.int32) for t in texts]
        made: list[list[bytes]] = [[] for _ in texts]
        held, size = [], 0

        def settle() -> None:
            for (k, _), ids in zip(held, self.memo.ids([parts for _, parts in held]), strict=True):
                made[k].append(ids)
            held.clear()

        for k, text in enumerate(texts):
            if not text:
                continue
            text, lo = MARK + text.replace(" ", MARK), 0
            while lo < len(text):
                hi = min(len(text), lo + SLICE)
                edge = _EDGE.search(text, hi) if hi < len(text) else None
                hi = edge.start() if edge else len(text)  # the next place where the text falls apart
                held.append((k, self.parts.findall(text[lo:hi])))
                size += hi - lo
                if size >= SLICE:
                    settle()
                    size = 0
                lo = hi
        settle()
        return [None if t is None else np.frombuffer(b"".join(m), np.int32) for t, m in zip(texts, made, strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        text = b"".join([raw[k] for k in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


def _fields(raw: bytes):
    """(number, value) of the fields of a serialised message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = number() if key & 7 == 2 else 8 if key & 7 == 1 else 4
            yield key >> 3, raw[at : at + size]
            at += size


#: Fixed field numbers of the public model format.
_TRAINER, _NORMALIZER, _PIECE, _KIND, _SUFFIX = 2, 3, 1, 3, 24
_CHARSMAP, _PREFIX, _SQUEEZE, _ESCAPE, _USER_DEFINED = 2, 3, 4, 5, 4


def _refused(raw: bytes) -> str | None:
    """What of a model's settings encode does not follow, if anything."""
    norm, train, user = {}, {}, False
    for number, value in _fields(raw):
        if number == _NORMALIZER:
            norm = dict(_fields(value))
        elif number == _TRAINER:
            train = dict(_fields(value))
        elif number == _PIECE:
            user = user or any(f == (_KIND, _USER_DEFINED) for f in _fields(value))
    found = {"a normaliser": norm.get(_CHARSMAP), "white space that is squeezed": norm.get(_SQUEEZE, 1), "no mark before the text": not norm.get(_PREFIX, 1), "spaces that stay": not norm.get(_ESCAPE, 1), "marks as suffixes": train.get(_SUFFIX), "user-defined pieces": user}
    return ", ".join(k for k, v in found.items() if v) or None


def load(path: str) -> list[tuple[str, float, str]]:
    """The pieces of a SentencePiece model file; one with settings that ``encode`` does not follow is refused."""
    import sentencepiece

    with open(path, "rb") as f:
        raw = f.read()
    if what := _refused(raw):
        raise ValueError(f"the model has {what}")
    p = sentencepiece.SentencePieceProcessor(model_proto=raw)
    kind = lambda k: "byte" if p.is_byte(k) else "unknown" if p.is_unknown(k) else "control" if p.is_control(k) or p.is_unused(k) else "normal"
    return [(p.id_to_piece(k), float(p.get_score(k)), kind(k)) for k in range(p.vocab_size())]


def _model(sent, key) -> PieceModel:
    if key not in _built:
        _built.clear()
        _built[key] = PieceModel(sent.value)
    return _built[key]


def _apply(docs: DataFrame, pieces, source: F.Column, out: str, kind: str, work) -> DataFrame:
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c != out]
    plain = docs.select(*[F.col(c).alias(f"_c{k}") for k, c in enumerate(names)], source.alias("_x"))
    types = "".join(f"{c} {t}, " for c, t in plain.dtypes[:-1])
    sent = docs.sparkSession.sparkContext.broadcast(list(pieces))  # as many rows as the vocabulary has
    key = (len(pieces), hash(tuple(pieces)))

    def run(batches):
        model = _model(sent, key)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], work(model, part.columns[-1])], [*b.schema.names[:-1], "_y"])
            vec.trim()

    return plain.mapInArrow(run, f"{types}_y {kind}").select(*[F.col(f"_c{k}").alias(c) for k, c in enumerate(names)], F.col("_y").alias(out))


def encode(docs: DataFrame, pieces, *, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with their ids as array<int>; a column of that name is replaced."""

    def work(model: PieceModel, column) -> pa.Array:
        made = model.encode_all(column.to_pylist())
        ends = np.cumsum([0] + [0 if m is None else len(m) for m in made])
        flat = np.concatenate([np.zeros(0, np.int32), *(m for m in made if m is not None)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat), mask=pa.array([m is None for m in made]))

    return _apply(docs, pieces, F.col(text_col).cast("string"), ids_col, "array<int>", work)


def decode(docs: DataFrame, pieces, *, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the text of their ids; a column of that name is replaced."""

    def work(model: PieceModel, column) -> pa.Array:
        flat, at = column.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(int)
        return pa.array([None if null else model.decode(flat[a:b]) for null, a, b in zip(column.is_null().to_pylist(), at[:-1], at[1:], strict=True)], pa.string())

    return _apply(docs, pieces, F.col(ids_col), text_col, "string", work)
