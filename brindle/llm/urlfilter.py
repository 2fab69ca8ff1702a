"""URL filters: pattern rules that are indexed by their rarest literal token.

A rule has a regular expression and the literal tokens that each url it fits must hold.  The index keys a rule by the
token that the fewest rules share (then the longest).  A url's tokens fetch their rules from the index, and only the regular expressions of
those run; rules without a token are tried on all.  Everything is built from DataFrame functions.

With up to ``INLINE`` rules the index is a constant map inside the plan, so urls are judged row by row, without a shuffle.
With more, it is a table: the tokens of the distinct urls join it, the best rule of each url is kept by a
combining aggregate, and the urls' rows join that.  Spark decides from the table's size whether to broadcast it.  Both ways give the same results.

Defined cases: a null url, and one without ``://``, has an empty host and path and gets the default verdict unless a pattern fits it; a very long url is judged
whole; repeated rows get equal results; an empty table gives no rows;
input columns named like a result column are replaced.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INLINE = 200
_RULE = "struct<rank:int,size:int,name:string,verdict:string,site:boolean,regex:string>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """rank: rules of a higher rank win (2: of a site, 1: allowing, 0: blocking patterns), then the longer name, then the greater name."""

    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...] = ()
    rank: int = 0
    site: bool = False


def site_rule(verdict: str, name: str) -> Rule:
    """``host/path``: the host and its subdomains, where the path starts with the rule's."""
    host, slash, path = name.partition("/")
    path = slash + path
    tokens = [t for t in re.split("[^a-z0-9]+", host.lower()) if t]
    whole = re.split("[^a-z0-9]+", path.translate(str.maketrans(_UPPER, _LOWER)))  # as urls' tokens are; the expression minds case; the last piece of a prefix may go on
    tokens += [t for t in whole[:-1] if t]
    return Rule(name, verdict, f"^(?:[^/]*\\.)?{_quote(host)}{_quote(path) if path else '(?:/|$)'}", tuple(tokens), 2, True)


def _quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9])", r"\\\1", text)


def host_word(word: str, verdict: str = "block") -> Rule:
    """Hosts with this word between dots or hyphens, but not as the last one."""
    return Rule(f"host word {word}", verdict, f"^[a-z][a-z0-9+.-]*://(?:[^/?#]*[.-])?{_quote(word)}[.-]", (word,))


def filters(lines) -> list[Rule]:
    """Rules of the common blocking syntax: ``||`` (start of the host or of a part of it), ``|`` (start or end), ``*``, ``^`` (a separator or the end),
    ``/expression/``, ``@@`` (allow, over all that block) and comments after ``!``.  Case does not matter.  A filter with ``$`` options is refused."""
    out = []
    for line in lines:
        name = line.strip()
        if not name or name.startswith(("!", "[")):
            continue
        body = name.removeprefix("@@").lower()
        verdict, rank = ("allow", 1) if name.startswith("@@") else ("block", 0)
        if len(body) > 2 and body.startswith("/") and body.endswith("/"):
            out.append(Rule(name, verdict, "(?i)" + name.removeprefix("@@")[1:-1], (), rank))
            continue
        if "$" in body:
            raise ValueError(f"options are not supported: {name}")
        left = "||" if body.startswith("||") else "|" if body.startswith("|") else ""
        right = "|" if body.endswith("|") and len(body) > len(left) else ""
        body = body[len(left) : len(body) - len(right)]
        made = {"*": ".*", "^": "(?:[^a-z0-9_.%-]|$)"}
        regex = {"||": r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?", "|": "^", "": ""}[left] + "".join(made.get(c) or _quote(c) for c in body) + ("$" if right else "")
        whole = [m for m in re.finditer("[a-z0-9]+", body) if (left if m.start() == 0 else body[m.start() - 1] != "*") and (right if m.end() == len(body) else body[m.end()] != "*")]
        out.append(Rule(name, verdict, regex, tuple(m[0] for m in whole), rank))
    return out


#: Fixed words of hosts that the method itself rejects where no site rule fits.
HOST_WORDS = ("betting", "casino", "malware", "phishing", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "xxx")
PATTERNS = tuple(host_word(w) for w in HOST_WORDS)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _indexed(rules) -> tuple[dict[str, list[dict]], list[dict]]:
    often = Counter(t for r in rules for t in set(r.tokens))
    index: dict[str, list[dict]] = {}
    always = []
    for r in rules:
        row = {"rank": r.rank, "size": len(r.name), "name": r.name, "verdict": r.verdict, "site": r.site, "regex": r.regex}
        if r.tokens:
            index.setdefault(min(r.tokens, key=lambda t: (often[t], -len(t), t)), []).append(row)
        else:
            always.append(row)
    return index, always


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER), "[^a-z0-9]+"), lambda t: t != ""))


def _fits(rule: Column, url: Column, site: Column) -> Column:
    return F.rlike(F.when(rule["site"], site).otherwise(url), rule["regex"])


RESULTS = ("host", "path", "rule", "pattern", "verdict")


def judge(pages: DataFrame, rules, *, url_col: str = "url", default: str = "allow", inline: int = INLINE) -> DataFrame:
    """The pages with host, path, the rule that decides (null if none), the pattern that does (likewise) and the verdict."""
    rules = list(rules)
    index, always = _indexed(rules)
    host, path = parts(F.col(url_col))
    names = [c for c in pages.columns if c not in RESULTS]
    low, site = F.translate(F.coalesce(F.col(url_col), F.lit("")), _UPPER, _LOWER), F.concat(host, path)
    # a page's own columns stay in one, so none can clash
    work = pages.select(F.struct(*names).alias("page"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"), low.alias("low"), site.alias("site"))
    fixed = F.from_json(F.lit(json.dumps(always)), f"array<{_RULE}>")
    fits = lambda r: _fits(r, F.col("low"), F.col("site"))
    if len(rules) <= inline:
        table = F.from_json(F.lit(json.dumps(index)), f"map<string,array<{_RULE}>>")
        fetched = F.flatten(F.transform(F.filter(_tokens(F.col("url")), lambda t: F.map_contains_key(table, t)), lambda t: F.element_at(table, t)))
        judged = work.withColumn("best", F.array_max(F.filter(F.concat(fetched, fixed), fits)))
    else:
        spark = pages.sparkSession
        keyed = spark.createDataFrame([(t, json.dumps(r)) for t, own in index.items() for r in own], "token string, rule string").select("token", F.from_json("rule", _RULE).alias("rule"))
        urls = work.select("url", "low", "site").distinct()
        some = urls.select("url", "low", "site", F.explode(_tokens(F.col("url"))).alias("token")).join(keyed, "token").where(fits(F.col("rule"))).select("url", "rule")
        if always:
            some = some.unionByName(urls.select("url", F.explode(F.filter(fixed, fits)).alias("rule")))
        best = some.groupBy(F.col("url").alias("of")).agg(F.max("rule").alias("best"))
        judged = work.join(best, F.col("url").eqNullSafe(F.col("of")), "left")  # a pattern may fit a null url
    best = F.col("best")
    decided = [F.when(best["site"], best["name"]).alias("rule"), F.when(~best["site"], best["name"]).alias("pattern"), F.coalesce(best["verdict"], F.lit(default)).alias("verdict")]
    return judged.select(*[F.col("page")[c].alias(c) for c in names], "host", "path", *decided)
