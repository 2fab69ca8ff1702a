"""Public suffixes: which labels of a host are sold as one, and the name registered below them.

The rules are the lines of a public suffix list that the user gives: ``com``, ``co.uk``, a wildcard ``*.ck`` for any one label, and exceptions ``!www.ck`` to it; comments begin with ``//``.  They form a trie over labels from the
right.  A host walks it from its last label on, along the named label and the wildcard at once; the longest match is the suffix, and an exception beats all, its suffix being one label shorter.
Each distinct host of a batch is looked up once.  The trie is broadcast, so a list has at most ``MOST`` rules (the full public one has some ten thousand); a longer one is refused.

Defined cases: a null url and one without a host have null results; a host that no rule fits has an empty suffix and its last label as domain; a host that is itself a suffix has no domain; an address of numbers is a domain
of its own; case, a last dot, port and user do not matter; labels beyond ASCII and their ASCII form (xn--) are the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import urls

MOST = 200_000
RESULT = "struct<suffix:string,domain:string,registered:string>"
_ADDRESS = re.compile(r"^(\d{1,3}(\.\d{1,3}){3}|\[.*\])$")
_PRIVATE = re.compile(r"===(BEGIN|END) PRIVATE DOMAINS===")


def _ascii(label: str) -> str:
    if label.isascii():
        return label
    try:
        return label.encode("idna").decode()
    except UnicodeError:
        return label


class Suffixes:
    """The trie: each node a dict of labels, with "" for the kind of rule that ends there (1 plain, 2 an exception)."""

    def __init__(self, lines: Iterable[str], *, private: bool = True) -> None:
        self.root: dict = {}
        n, own = 0, False
        for line in lines:
            if mark := _PRIVATE.search(line):
                own = mark[1] == "BEGIN"
            rule = line.strip().split(" ", 1)[0].split("\t", 1)[0].lower()
            if not rule or rule.startswith("//") or (own and not private):
                continue
            node = self.root
            for label in reversed(rule.removeprefix("!").strip(".").split(".")):
                node = node.setdefault(_ascii(label), {})
            node[""] = 2 if rule.startswith("!") else 1
            n += 1
        if n > MOST:
            raise ValueError(f"more than {MOST} rules")

    def length(self, labels: list[str]) -> int:
        """How many of the labels, from the right, are the suffix."""
        best, at = 0, [self.root]
        for depth, label in enumerate(reversed(labels), 1):
            at = [n for node in at for key in ((label, "*") if label != "*" else ("*",)) if (n := node.get(key)) is not None]
            if not at:
                break
            kinds = {node.get("") for node in at}
            if 2 in kinds:
                return depth - 1
            if 1 in kinds:
                best = depth
        return best

    def parts(self, host: str | None) -> tuple[str, str | None, str | None] | None:
        """suffix, domain label, registered name."""
        host = (host or "").lower().rstrip(".")
        if not host:
            return None
        if _ADDRESS.match(host):
            return "", host, None
        shown = host.split(".")
        n = self.length([_ascii(x) for x in shown])
        rest = len(shown) - n
        return ".".join(shown[rest:]), shown[rest - 1] if rest else None, ".".join(shown[rest - 1 :]) if rest and n else None


def read(spark: SparkSession, path: str, *, private: bool = False) -> Suffixes:
    """A list of any store, read by Spark; behind a count, as it goes through the driver."""
    lines = [r["value"] for r in spark.read.text(path).limit(2 * MOST + 1).collect()]
    return Suffixes(lines, private=private)


def parts(spark: SparkSession, url: Column, suffixes: Suffixes) -> Column:
    """suffix, domain (the label left of it) and registered name of each url."""
    sent = spark.sparkContext.broadcast(suffixes)

    def run(hosts: pd.Series) -> pd.DataFrame:
        found = {h: sent.value.parts(h) or (None, None, None) for h in hosts.unique()}
        return pd.DataFrame([found[h] for h in hosts], columns=["suffix", "domain", "registered"])

    return F.pandas_udf(run, RESULT)(urls.host(url))


def source(spark: SparkSession, url: Column, suffixes: Suffixes) -> Column:
    """The name that a url's publisher goes by: its domain label, or its authority where it has none."""
    return F.lower(F.trim(F.coalesce(F.nullif(parts(spark, url, suffixes)["domain"], F.lit("")), urls.base_url(url))))
