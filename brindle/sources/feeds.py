"""Payloads that collectors fetched, as flat items.  Fetching is not an operator: raw bodies come as tables."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, html, texts, urls
from ..operators import store

ENTRY = "struct<url:string,title:string,summary:string,content:string,author:string,published:string,tags:array<string>,image_url:string,comments_url:string>"
FEED = f"struct<title:string,link:string,description:string,entries:array<{ENTRY}>>"
_ENTRY_KEYS = [p.split(":")[0] for p in ENTRY[7:-1].split(",")]


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1].lower()


def _entry(node) -> dict:
    out: dict = dict.fromkeys(_ENTRY_KEYS)
    out["tags"] = []
    for c in node:
        name, text = _local(c.tag), (c.text or "").strip()
        if name == "link":
            if c.get("href"):
                if c.get("rel", "alternate") == "alternate" or not out["url"]:
                    out["url"] = c.get("href")
            elif text:
                out["url"] = text
        elif name in ("guid", "id") and text.startswith("http") and not out["url"]:
            out["url"] = text
        elif name == "title":
            out["title"] = text
        elif name in ("description", "summary"):
            out["summary"] = "".join(c.itertext()).strip()
        elif name in ("encoded", "content") and (text or len(c)):
            out["content"] = "".join(c.itertext()).strip()
        elif name in ("author", "creator"):
            out["author"] = " ".join("".join(c.itertext()).split())
        elif name in ("pubdate", "published", "updated", "date") and (not out["published"] or name in ("pubdate", "published")):
            out["published"] = text
        elif name == "category":
            out["tags"].append(c.get("term") or text)
        elif name in ("thumbnail", "enclosure") and c.get("url"):
            out["image_url"] = c.get("url")
        elif name == "comments" and text.startswith("http"):
            out["comments_url"] = text
    return out


def parse_feed(xml: str | None) -> dict | None:
    """RSS 2.0 or Atom; null for what is neither."""
    try:
        root = ElementTree.fromstring(re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", xml or "").encode())
    except ElementTree.ParseError:
        return None
    head = next((c for c in root if _local(c.tag) == "channel"), root)
    entries = [_entry(n) for n in root.iter() if _local(n.tag) in ("item", "entry")]
    first = lambda *names: next(((c.text or c.get("href") or "").strip() for c in head if _local(c.tag) in names), None)
    return {"title": first("title"), "link": first("link"), "description": first("description", "subtitle"), "entries": entries}


def feed_items(raw: DataFrame, *, feed_col: str = "feed", body_col: str = "body", as_of: Column) -> DataFrame:
    """(feed url, XML) -> flat items."""

    def run(batches):
        kind = pa.struct([("title", pa.string()), ("link", pa.string()), ("description", pa.string()), ("entries", pa.list_(pa.struct([(k, pa.list_(pa.string()) if k == "tags" else pa.string()) for k in _ENTRY_KEYS])))])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([parse_feed(x) for x in b.column(1).to_pylist()], kind)], ["feed", "f"])

    rows = raw.select(F.col(feed_col).alias("feed"), F.col(body_col).alias("body")).mapInArrow(run, f"feed string, f {FEED}")
    e = rows.select("feed", F.col("f.title").alias("site_name"), F.col("f.link").alias("site"), F.col("f.description").alias("description"), F.explode("f.entries").alias("e")).select("feed", "site_name", "site", "description", "e.*")
    created = F.least(dates.parse(F.col("published"), as_of), as_of)
    return e.select("url", urls.source(F.col("url")).alias("source"), "title", html.text_native(F.col("summary")).alias("summary"), html.markdown(F.col("content")).alias("content"), "author", created.alias("created"), as_of.alias("collected"), "tags", "image_url", F.col("feed").alias("rss_feed"), "site_name", "description", urls.base_url(F.col("url")).alias("base_url"), F.col("comments_url").alias("chatter_url"))


# Where a government package's documents lie, and which of them come first.
GOVINFO = "https://www.govinfo.gov/content/pkg/"
_PACKAGE = r"(?i)^https://www\.govinfo\.gov/content/pkg/([^/]+)/(?:html|text|pdf)/[^/?#]+\.(htm|html|txt|pdf)(?:[?#].*)?$"


def govinfo_link(description: Column, guid: Column) -> Column:
    """The best document link of an entry's description: one over https, of the site itself and of the entry's own package, text before pdf; null if there is none."""
    plain = description
    for entity, mark in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(mark))
    links = F.transform(F.regexp_extract_all(plain, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']\s*([^"']+?)\s*["']"""), 1), lambda u: F.replace(u, F.lit("&amp;"), F.lit("&")))
    kind = lambda u: F.lower(F.regexp_extract(u, _PACKAGE, 2))
    own = F.filter(links, lambda u: (kind(u) != "") & (F.regexp_extract(u, _PACKAGE, 1) == F.trim(guid)))
    return F.array_min(F.transform(own, lambda u: F.struct(F.when(kind(u) == "pdf", 1).otherwise(0).alias("r"), u.alias("u"))))["u"]


def govinfo_candidates(guid: Column) -> Column:
    """Where a package's document may be if its entry names none, best first."""
    name = F.trim(guid)
    at = lambda folder, tail: F.concat(F.lit(GOVINFO), name, F.lit(f"/{folder}/"), name, F.lit(tail))
    return F.when(F.length(name) > 0, F.array(at("html", ".htm"), at("html", ".html"), at("text", ".txt"), at("pdf", ".pdf")))


def govinfo_items(entries: DataFrame, answers: DataFrame) -> DataFrame:
    """(guid, description, ...) with the entry's link, else its first candidate that is there; entries without either go.

    answers: (url, head, get), the status that asking for a url's head gave, and the one that getting it gave; a candidate is there by a head of 2xx, or by a get of 2xx where the site does not answer
    heads (405, 501).  A url without an answer is not there.
    """
    rows = entries.withColumn("link", govinfo_link(F.col("description"), F.col("guid")))
    good = lambda c: F.col(c).between(200, 299)
    there = answers.where(good("head") | (F.col("head").isin(405, 501) & good("get"))).select("url").distinct()
    open_ = rows.where("link is null").select("guid").distinct()
    asked = open_.select("guid", F.posexplode(govinfo_candidates(F.col("guid"))).alias("place", "url"))
    found = asked.join(there, "url", "left_semi").groupBy("guid").agg(F.min_by("url", "place").alias("_found"))
    return rows.join(found, "guid", "left").withColumn("link", F.coalesce("link", "_found")).drop("_found").where("link is not null")


REDDIT = "created_utc double, permalink string, is_self boolean, url string, title string, selftext string, author string, score long, num_comments long, subreddit string, subreddit_subscribers long"


def reddit_items(raw: DataFrame, body_col: str, as_of: Column) -> DataFrame:
    """Reddit post JSON -> items with their chatter; a self post is a post, a link post is of unknown kind."""
    p = raw.select(F.from_json(body_col, REDDIT).alias("p")).select("p.*")
    talk = F.concat(F.lit("https://www.reddit.com"), F.col("permalink"))
    url = F.when(F.col("is_self"), talk).otherwise(F.col("url"))
    return p.select(url.alias("url"), urls.source(url).alias("source"), "title", F.nullif("selftext", F.lit("")).alias("content"), "author", dates.from_epoch(F.col("created_utc"), as_of).alias("created"), as_of.alias("collected"), F.when(F.col("is_self"), "post").alias("kind"), talk.alias("chatter_url"), F.lit("reddit").alias("platform"), F.concat(F.lit("r/"), F.col("subreddit")).alias("forum"), F.col("score").alias("likes"), F.col("num_comments").alias("comments"), F.col("subreddit_subscribers").alias("subscribers"))


STORY = "id long, time long, url string, title string, text string, by string, score long, kids array<long>, type string"


def hackernews_items(raw: DataFrame, body_col: str, as_of: Column) -> DataFrame:
    """Hacker News story JSON -> items with their chatter; a story without a url is a post."""
    p = raw.select(F.from_json(body_col, STORY).alias("p")).select("p.*")
    talk = F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("id").cast("string"))
    url = F.coalesce(F.nullif("url", F.lit("")), talk)
    return p.select(url.alias("url"), urls.source(url).alias("source"), "title", html.text_native(F.col("text")).alias("content"), F.col("by").alias("author"), dates.from_epoch(F.col("time"), as_of).alias("created"), as_of.alias("collected"), F.when(F.coalesce(F.col("url"), F.lit("")) == "", "post").alias("kind"), talk.alias("chatter_url"), F.lit("hackernews").alias("platform"), F.lit("hackernews").alias("forum"), F.col("score").alias("likes"), F.coalesce(F.size("kids"), F.lit(0)).cast("long").alias("comments"))


def hackernews_ids(raw: DataFrame, body_col: str) -> DataFrame:
    """Id lists (JSON arrays) of several listings -> each id once, newest first."""
    return raw.select(F.explode(F.from_json(body_col, "array<long>")).alias("id")).where("id is not null").distinct().orderBy(F.desc("id"))


def first_html_of_zip(files: DataFrame) -> DataFrame:
    """(path, content of a ZIP) -> path, member, html: the first HTML member; bad archives give null."""

    def run(batches):
        for b in batches:
            out = []
            for raw in b.column(1).to_pylist():
                try:
                    z = zipfile.ZipFile(io.BytesIO(raw))
                    name = next((n for n in z.namelist() if n.lower().endswith((".htm", ".html"))), None)
                    out.append((name, z.read(name).decode("utf-8", "replace") if name else None))
                except zipfile.BadZipFile:
                    out.append((None, None))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.string())], ["path", "member", "html"])

    return files.select("path", "content").mapInArrow(run, "path string, member string, html string")


def pdf_text(files: DataFrame, reader=None) -> DataFrame:
    """(path, content of a PDF) -> path, content: by the given reader (bytes -> text), or pypdf where it is installed."""

    def run(batches):
        read = reader
        if read is None:
            import pypdf

            def read(raw):
                return "\n\n".join(p.extract_text() or "" for p in pypdf.PdfReader(io.BytesIO(raw)).pages)

        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([read(x) for x in b.column(1).to_pylist()], pa.string())], ["path", "content"])

    return files.select("path", "content").mapInArrow(run, "path string, content string")


def page_items(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", min_chars: int = 300) -> DataFrame:
    """Pages -> url, readable body and metadata; excluded urls and short bodies go."""
    rows = pages.where(~urls.excluded(F.col(url_col))).select(F.col(url_col).alias("_url"), html.page(F.col(html_col), min_chars).alias("p"))
    fields = [F.col(f"p.{c}").alias(c) for c in ("title", "author", "content", "published_time", "description", "image_url", "site_name", "favicon", "rss_feed", "language")]
    return rows.where(F.length("p.content") >= min_chars).select(F.col("_url").alias("url"), urls.base_url(F.col("_url")).alias("base_url"), *fields, texts.split_parts(F.col("p.tags")).alias("tags"))


def site_items(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Publishers of pages, one a base_url."""
    rows = pages.select(urls.base_url(F.col(url_col)).alias("base_url"), urls.source(F.col(url_col)).alias("source"), html.metadata(F.col(html_col)).alias("m"))
    found = rows.select("base_url", "source", F.coalesce("m.site_name", "m.title").alias("site_name"), F.col("m.description").alias("description"), F.col("m.favicon").alias("favicon"), F.col("m.rss_feed").alias("rss_feed"))
    says = sum((F.when(F.col(c) != "", 1).otherwise(0) for c in ("site_name", "description", "favicon", "rss_feed")), F.lit(0))
    return store.one_of_each(found, ["base_url"], [says])
