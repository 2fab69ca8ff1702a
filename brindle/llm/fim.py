"""Fill-in-middle: a text is cut at two unit boundaries and its middle is moved to the end, behind marks.

A grammar says what a unit is: alternatives of the forms ``[C]+`` (a run), ``[C]`` (one character) and ``[C]*[D]`` (a run up to its end mark, as lines are), tried in
order.  ``boundary`` translates it to a regular expression of width zero: a place is a boundary unless the characters on both sides belong together, and which do
follows from their classes alone.  Splitting there with Spark's ``split`` gives the units and loses no character.  Everything is a DataFrame function.

Where a text is cut, and in what form it comes out, follows from its id and the seed by sha256, so a task that runs again, or a table dealt differently, gives the same.

Defined cases: null and empty texts have no units, stay plain, and come out empty (a split of nothing would be one unit, so they are told apart before); a text that contains a
mark stays plain, so each other output has each mark once and ``restore`` is exact; a null id counts as an empty one; a very long text is cut whole, by one task; repeated rows get equal
results; an empty table gives no rows; input columns named like a result are replaced, all others come back.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = "[A-Za-z]+|[^A-Za-z]"
CHARACTERS = r"[\n]|[^\n]"
LINES = r"[^\n]*[\n]|[^\n]+"
RESULTS = ("units", "form", "prefix", "middle", "suffix", "output")

_CLASS = r"\[(\^?(?:\\[nrt\\\]^-]|[^\\\[\]&])+)\]"
_ALTERNATIVE = re.compile(rf"{_CLASS}(?:(\+)|\*{_CLASS})?(?:\||$)")


@dataclass(frozen=True)
class Marks:
    """Three marks of which none begins inside or at the end of another, as ``restore`` looks for them."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = self.all()
        inside = any(x in y for x in marks for y in marks if x is not y)
        if not all(marks) or len(set(marks)) < 3 or inside or any(x[-k:] == y[:k] for x in marks for y in marks for k in range(1, min(len(x), len(y)))):
            raise ValueError("marks must not overlap each other")

    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def _alternatives(grammar: str) -> list[tuple[str, str | None, str | None]]:
    """(class, "+" or None, end class or None) of each alternative."""
    out, at = [], 0
    while at < len(grammar):
        m = _ALTERNATIVE.match(grammar, at)
        if not m:
            raise ValueError(f"not a unit grammar: {grammar[at:]}")
        out.append(m.groups())
        at = m.end()
    return out


@cache
def boundary(grammar: str) -> str:
    """The regular expression of the places between units.

    The grammar's classes must be disjoint and hold all characters, so that a character's class, and with it the unit it begins, is sure; an end mark of ``[C]*[D]`` must not begin a
    run, and ``[C]+`` must follow for a run that has none.
    """
    found = _alternatives(grammar)
    classes = list(dict.fromkeys(c for first, _, end in found for c in (first, end) if c))
    everything = "".join(map(chr, range(0x110000)))
    if sum(sum(map(len, re.findall(f"[{c}]+", everything))) for c in classes) != len(everything) or any(re.search(f"(?=[{a}])[{b}]", everything) for i, a in enumerate(classes) for b in classes[:i]):
        raise ValueError("the classes of a unit grammar must be disjoint and hold all characters")
    joins: dict[str, list[str]] = {}
    for first, plus, end in found:
        if first not in joins:  # a later alternative that begins with the same class is never reached, but for a run without its end mark
            joins[first] = [first] if plus else [first, end] if end else []
    if any(joins.get(end) for _, _, end in found if end):
        raise ValueError("an end mark must not begin a run")
    if any(end and (first, "+", None) not in found for first, _, end in found):
        raise ValueError("a run that may lack its end mark needs an alternative of its own")
    for c in classes:
        joins.setdefault(c, [])  # an end mark alone is a unit
    # what follows must not belong to what is on the left, and something must follow
    together = {c: "".join(f"[{x}]" for x in own) for c, own in joins.items()}
    return "|".join(f"(?<=[{c}])" + (f"(?![{together[c]}])" if own else "") + r"(?=[\s\S])" for c, own in joins.items() if set(own) != set(classes))


def draws(id_: Column, seed: int, n: int = 4) -> list[Column]:
    """n whole numbers of 32 bits from an id: the leading groups of eight hex digits of a sha256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(n)]


def transform(docs: DataFrame, *, grammar: str = WORDS, seed: int = 1, percent: int = 90, spm_percent: int = 20, marks: Marks = Marks(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with units (how many), form (plain, psm or spm), prefix, middle, suffix (null if plain) and output.

    psm is prefix, suffix, middle, each behind its mark; spm has the suffix first.  ``percent`` of the texts are cut, ``spm_percent`` of those as spm.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    names = [c for c in docs.columns if c not in RESULTS]
    h = draws(F.col(id_col), seed)
    marked = F.lit(False)
    for m in marks.all():
        marked = marked | F.contains(text, F.lit(m))
    plain = (text == "") | marked | (h[2] % 100 >= percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    pieces = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, boundary(grammar), -1))
    own = F.struct(*[F.col(c) for c in names]) if names else F.lit(None)
    rows = docs.select(own.alias("row"), text.alias("text"), form.alias("form"), h[0].alias("h1"), h[1].alias("h2"), pieces.alias("pieces"))
    n = F.size("pieces")
    one, two = F.col("h1") % (n + 1), F.col("h2") % (n + 1)
    rows = rows.select("row", "text", "form", "pieces", n.cast("long").alias("n"), F.least(one, two).cast("int").alias("a"), F.greatest(one, two).cast("int").alias("b"))
    part = lambda lo, hi: F.when(F.col("form") != "plain", F.array_join(F.slice("pieces", lo + 1, hi - lo), ""))
    a, b = F.col("a"), F.col("b")
    rows = rows.select("row", "text", "form", "n", part(F.lit(0), a).alias("prefix"), part(a, b).alias("middle"), part(b, F.col("n").cast("int")).alias("suffix"))
    p, s, m = (F.lit(x) for x in marks.all())
    psm, spm = F.concat(p, "prefix", s, "suffix", m, "middle"), F.concat(s, "suffix", p, "prefix", m, "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("text"))
    return rows.select(*([F.col("row")[c].alias(c) for c in names]), F.col("n").alias("units"), "form", "prefix", "middle", "suffix", output.alias("output"))


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text from an output and its form."""
    # no text that was cut holds a mark, and no mark can begin inside one or at the end of a part, so the three are where the parts meet
    parts = F.split(output, "|".join(re.sub(r"([^A-Za-z0-9])", r"\\\1", m) for m in marks.all()), -1)
    first, second, middle = parts.getItem(1), parts.getItem(2), parts.getItem(3)
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
