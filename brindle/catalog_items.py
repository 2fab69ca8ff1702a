"""Registered queries over text, url and date functions, collected items, ports, workers, stores and streams, and DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .functions import dates, html, texts, urls
from .operators import cluster, graph, ingest, port, query, search, state, store, trend, vectorindex
from .operators.durable import shared_folder
from .plans import workers
from .schemas import STATE
from .sources import adapters as a
from .sources import feeds, tables
from .streaming import queues

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- texts ------------------------------------------------------------------------------------------------
@_query("""SELECT c_custkey, trim(c_name) AS name, CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS author,
  CASE WHEN c_nationkey % 4 = 0 THEN 0 ELSE CAST(c_custkey AS INTEGER) END AS n, [c_mktsegment, c_name] AS parts, c_mktsegment AS before_, c_name AS after_, c_name || 'NULL_BYTE' AS no_null, c_name AS no_control, substr(c_name, 1, 11) AS short FROM customer""")
def texts_clean(spark, d):
    c = a.table(spark, d, "customer")
    author = F.when(F.col("c_nationkey") % 3 == 0, F.element_at(F.array(F.lit("[No-Author]"), F.lit("Anonymous"), F.lit("  ")), (F.col("c_custkey") % 3 + 1).cast("int"))).otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("\t")))
    number = F.when(F.col("c_nationkey") % 4 == 0, F.col("c_name")).otherwise(F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit("\n")))
    both = F.concat("c_mktsegment", F.lit(",,"), F.col("c_name"))
    return c.select("c_custkey", texts.cleanup_text(F.concat(F.lit("\n "), F.col("c_name"), F.lit(" "))).alias("name"), texts.cleanup_author(author).alias("author"), texts.parse_int(number).alias("n"), texts.split_parts(F.concat(F.lit(" , "), both, F.lit(", "))).alias("parts"),
                    texts.remove_after(both, ",,").alias("before_"), texts.remove_before(both, ",,").alias("after_"), texts.without_null_bytes(F.concat("c_name", F.lit("\x00"))).alias("no_null"), texts.without_controls(F.concat(F.lit("\x01\x0b"), F.col("c_name"), F.lit("\x1f"))).alias("no_control"), texts.truncated(F.col("c_name"), 11).alias("short"))


@_query("""SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN replace(p_name, ' ', ' x ') END AS briefing, list_filter([CASE WHEN p_size % 2 = 0 THEN p_brand END, p_type], lambda x: x IS NOT NULL) AS actions,
  CASE WHEN p_size % 3 = 0 THEN 'high' END AS impact_level, lower(p_type) AS event_type, [lower(p_type) || ': ' || p_name, p_name] AS cross_domain_impacts, CASE WHEN p_size % 2 = 0 THEN ['ABC'] ELSE ['X' || (p_size % 10)] END AS stock_tickers,
  [replace(p_name, ' ', '_'), lower(p_type)] AS regions FROM part""")
def texts_normalized(spark, d):
    """The normaliser of each digest field, through the dispatch table."""
    p = a.table(spark, d, "part")
    word = F.element_at(F.array(*[F.lit(w) for w in ("N/A", "None", " not specified ", "Unmentioned", "")]), (F.col("p_partkey") % 5 + 1).cast("int"))
    name, kind = F.col("p_name"), F.col("p_type")
    made = p.select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.concat(F.lit(" "), F.replace(name, F.lit(" "), F.lit("\nx ")), F.lit("\n"))).otherwise(word).alias("briefing"), F.array(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(word), F.concat(F.lit(" "), kind)).alias("actions"),
                    F.when(F.col("p_size") % 3 == 0, F.lit("High")).otherwise(F.lit("unclear")).alias("impact_level"), F.initcap(kind).alias("event_type"), F.array(F.concat(F.lit("<"), kind, F.lit("> : <"), name, F.lit(">")), F.lit(""), name).alias("cross_domain_impacts"),
                    F.array(F.when(F.col("p_size") % 2 == 0, "ABC").otherwise(F.concat(F.lit("X"), (F.col("p_size") % 10).cast("string"))), F.lit("LONGTICKER"), F.lit("abd"), F.lit("12")).alias("stock_tickers"), F.array(F.concat(F.lit("--"), name, F.lit("_")), F.lit("n/a"), F.upper(name), kind, F.lit("!!"), F.repeat(F.lit("x"), 51)).alias("regions"))
    return texts.normalize_fields(made.withColumn("regions", F.transform(F.col("regions"), F.lower)))


@_query("SELECT s_suppkey, s_name || chr(10) || 'tail' AS body, '{\"a\": ' || s_suppkey || '}' AS fenced FROM supplier")
def texts_markdown(spark, d):
    s = a.table(spark, d, "supplier")
    page = F.concat(F.lit("menu\n\n# Title of it\n"), F.col("s_name"), F.lit("\ntail"))
    block = F.concat(F.lit("```json\n{\"a\": "), F.col("s_suppkey").cast("string"), F.lit("}\n```\n"))
    return s.select("s_suppkey", texts.from_first_heading(page).alias("body"), texts.without_fences(block).alias("fenced"))


# --- urls and dates ---------------------------------------------------------------------------------------
@_query("""SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || '/img/' || page_id || '.svg' AS absolute, 'http://other.example.net/x' AS other, 'news of ' || page_id AS title, lpad(CAST(page_id AS VARCHAR), 10, '0') || '-24-000123' AS accession,
  CASE page_id % 3 WHEN 0 THEN '10-K/A' WHEN 1 THEN '8-K' END AS filing FROM pages""")
def url_parts(spark, d):
    p, n = a.table(spark, d, "pages"), F.col("page_id").cast("string")
    title = F.concat(F.lit("Annual report "), F.element_at(F.array(F.lit("(10-k/a)"), F.lit("8-K of"), F.lit("10-X")), (F.col("page_id") % 3 + 1).cast("int")), F.lit(" x"))
    return p.select("page_id", urls.resolve(F.col("url"), F.concat(F.lit("/img/./a/../"), n, F.lit(".svg"))).alias("absolute"), urls.resolve(F.col("url"), F.lit("http://other.example.net/x")).alias("other"), urls.title_from_path(F.concat(F.lit("http://x.org/a/news-of%20"), n, F.lit(".html?q=1#f"))).alias("title"),
                    urls.accession_number(F.concat(F.lit("https://x.org/data/"), F.lpad(n, 10, "0"), F.lit("-24-000123.zip"))).alias("accession"), urls.filing_type(title).alias("filing"))


@_query("""WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'text/HTML; charset=utf-8' WHEN 2 THEN 'application/pdf' WHEN 4 THEN 'text/html' END AS mime, CASE page_id % 4 WHEN 0 THEN 20000000 WHEN 1 THEN 100 END AS size FROM pages)
SELECT page_id, coalesce(mime = 'image/png', FALSE) OR coalesce(size, 0) > 16777216 AS excluded, coalesce(mime = 'application/pdf', FALSE) AS is_pdf, 16777216 AS max_size FROM p""")
def url_gate(spark, d):
    p = a.table(spark, d, "pages")
    mime = F.element_at(F.array(F.lit("image/png"), F.lit("text/HTML; charset=utf-8"), F.lit("application/pdf"), F.lit(None), F.lit("text/html")), (F.col("page_id") % 5 + 1).cast("int"))
    size = F.when(F.col("page_id") % 4 == 0, 20_000_000).when(F.col("page_id") % 4 == 1, 100)
    return p.select("page_id", urls.gate(F.col("url"), mime, size).alias("g")).select("page_id", "g.*")


@_query("""SELECT o_orderkey, o_orderdate AS utc, o_orderdate - INTERVAL 2 HOURS AS shifted, o_orderdate AS plain, CASE WHEN o_orderdate >= TIMESTAMP '1998-08-02' - INTERVAL 1825 DAYS THEN o_orderdate END AS parsed,
  least(o_orderdate, TIMESTAMP '1998-08-02') AS epoch, TIMESTAMP '1998-07-30' AS before_, CAST(o_orderdate AS DATE) AS day, greatest(CAST(o_orderdate AS DATE), DATE '1995-01-01') AS later FROM orders""")
def dates_parsed(spark, d):
    o, t, now = a.table(spark, d, "orders"), F.col("o_orderdate"), F.lit("1998-08-02").cast("timestamp")
    form = F.element_at(F.array(F.date_format(t, "EEE, d MMM yyyy HH:mm:ss 'GMT'"), F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.date_format(t, "MMMM d, yyyy"), F.date_format(t, "yyyy/MM/dd")), (F.col("o_orderkey") % 4 + 1).cast("int"))
    iso = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return o.select("o_orderkey", dates.ensure_utc(F.concat(iso, F.lit("Z"))).alias("utc"), dates.ensure_utc(F.concat(iso, F.lit("+02:00"))).alias("shifted"), dates.ensure_utc(iso).alias("plain"), dates.parse(form, now).alias("parsed"), dates.from_epoch(F.unix_timestamp(t), now).alias("epoch"), dates.days_ago(now, 3).alias("before_"), F.to_date(t).alias("day"), F.greatest(F.to_date(t), F.lit("1995-01-01").cast("date")).alias("later"))


# --- collected items --------------------------------------------------------------------------------------
_AS_OF = "TIMESTAMP '2024-02-01'"


def _items(spark, d, spread=False):
    """Flat items as a collector gives them: untrimmed, with placeholders and gaps; ``spread`` over as many tasks as a shuffle has before their texts are made, as a file of few row groups is read by few."""
    e = a.table(spark, d, "events")
    if spread:
        e = e.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = F.col("event_id").cast("string")
    return e.select(
        F.concat(F.lit(" HTTPS://Site"), (F.col("user_id") % 50).cast("string"), F.lit(".Example.com/a/"), n, F.lit(" ")).alias("url"),
        F.when(F.col("event_id") % 11 == 0, F.lit(" ")).when(F.col("event_id") % 13 == 0, F.lit("Wordle today: hints")).otherwise(F.concat(F.lit("  Title "), n)).alias("title"),
        F.repeat(F.lit("word "), F.col("value").cast("int") * 5).alias("content"), F.when(F.col("event_id") % 7 == 0, F.lit("NoReply")).otherwise(F.concat(F.lit(" Author "), F.col("event_type"))).alias("author"),
        F.when(F.col("event_id") % 17 != 0, F.concat(F.lit("site"), (F.col("user_id") % 50).cast("string"))).alias("source"), F.when(F.col("event_type") == "click", "post").otherwise("news").alias("kind"),
        F.when(F.col("event_id") % 5 != 0, F.when(F.col("event_id") % 19 == 0, F.lit("2001-01-01").cast("timestamp")).otherwise(F.col("ts"))).alias("created"), F.lit(None).cast("timestamp").alias("collected"),
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("HTTP://talk.example.org/"), n)).alias("chatter_url"), F.lit("hub").alias("platform"), F.lit("r/x").alias("forum"), (F.col("event_id") % 3).alias("likes"), F.lit(0).cast("long").alias("comments"), F.lit(0).cast("long").alias("subscribers"),
        F.when(F.col("user_id") % 2 == 0, F.lit("A site")).alias("site_name"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("favicon"), F.lit(None).cast("string").alias("rss_feed"),
    )


_ITEMS = f"""raw AS (SELECT event_id, event_type, user_id, value, ts FROM events), items AS (SELECT 'https://site' || (user_id % 50) || '.example.com/a/' || event_id AS url, 'Site' || (user_id % 50) || '.Example.com' AS net,
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'Wordle today: hints' ELSE 'Title ' || event_id END AS title, CAST(trunc(value) AS INTEGER) * 5 AS words, CASE WHEN event_id % 7 <> 0 THEN 'Author ' || event_type END AS author,
  CASE WHEN event_id % 17 <> 0 THEN 'site' || (user_id % 50) END AS source, CASE WHEN event_type = 'click' THEN 'post' ELSE 'news' END AS kind, CASE WHEN event_id % 5 = 0 OR event_id % 19 = 0 THEN {_AS_OF} ELSE ts END AS created,
  CASE WHEN event_id % 2 = 0 THEN 'http://talk.example.org/' || event_id END AS chatter_url, event_id % 3 AS likes, user_id FROM raw)"""


@_query(f"WITH {_ITEMS} SELECT url, lower(net) AS base_url, title, words AS content_length, author, source, kind, created, {_AS_OF} AS collected, chatter_url FROM items")
def items_cleaned(spark, d):
    return ingest.cleanup_items(_items(spark, d), a.as_of()).select("url", "base_url", "title", "content_length", "author", "source", "kind", "created", "collected", "chatter_url")


@_query(f"WITH {_ITEMS} SELECT url, title, kind, CASE WHEN words >= 160 AND NOT contains(lower(title), 'wordle today') THEN 'store' WHEN kind <> 'post' AND words < 160 AND NOT contains(lower(title), 'wordle today') THEN 'scrape' ELSE 'drop' END AS triage FROM items WHERE title IS NOT NULL AND source IS NOT NULL")
def items_beans(spark, d):
    beans, _, _ = ingest.split_items(ingest.cleanup_items(_items(spark, d), a.as_of()))
    return ingest.triage(ingest.valid_beans(beans)).select("url", "title", "kind", "triage")


@_query(f"WITH {_ITEMS} SELECT chatter_url, url, 'hub' AS source, 'r/x' AS forum, {_AS_OF} AS collected, likes FROM items WHERE chatter_url IS NOT NULL AND likes <> 0")
def items_chatters(spark, d):
    _, chatters, _ = ingest.split_items(ingest.cleanup_items(_items(spark, d), a.as_of()))
    return ingest.valid_chatters(chatters).select("chatter_url", "url", "source", "forum", "collected", "likes")


@_query(f"WITH {_ITEMS} SELECT DISTINCT lower(net) AS base_url, user_id % 2 = 0 AS described FROM items WHERE source IS NOT NULL")
def items_publishers(spark, d):
    """Publishers of the items, one a base_url, and whether they need no scraping."""
    _, _, publishers = ingest.split_items(ingest.cleanup_items(_items(spark, d), a.as_of()))
    return ingest.valid_publishers(publishers).select("base_url", ingest.described().alias("described"))


@_query(f"""WITH {_ITEMS}, s AS (SELECT url, 300 AS n, TIMESTAMP '2024-01-03' AS p FROM items WHERE words % 2 = 0), j AS (SELECT i.*, s.n, s.p, s.n * 6 - 1 > greatest(words * 5 - 1, 0) AS longer FROM items i LEFT JOIN s USING (url))
SELECT url, CASE WHEN longer THEN 300 ELSE words END AS content_length, CASE WHEN longer THEN TRUE END AS restricted_content, coalesce(title, CASE WHEN n IS NOT NULL THEN 'Scraped' END) AS title, CASE WHEN p IS NOT NULL THEN least(created, p) ELSE created END AS created, kind FROM j""")
def items_scraped(spark, d):
    clean = ingest.cleanup_items(_items(spark, d), a.as_of())
    found = clean.where("content_length % 2 = 0").select("url", F.trim(F.repeat(F.lit("pages "), 300)).alias("content"), F.lit("Scraped").alias("title"), F.lit("2024-01-03").alias("published_time"))
    beans, _, _ = ingest.split_items(clean)
    return ingest.merge_scraped(beans, found, a.as_of()).select("url", "content_length", "restricted_content", "title", "created", "kind")


@_query(f"WITH {_ITEMS}, v AS (SELECT *, words >= 160 AND NOT contains(lower(title), 'wordle today') AS keep FROM items WHERE title IS NOT NULL AND source IS NOT NULL) SELECT 'stored' AS way, count(*) AS n FROM v WHERE keep UNION ALL SELECT 'scrape', count(*) FROM v WHERE NOT keep AND kind <> 'post' AND words < 160 AND NOT contains(lower(title), 'wordle today') UNION ALL SELECT 'chatters', count(*) FROM items WHERE chatter_url IS NOT NULL AND likes <> 0 UNION ALL SELECT 'publishers', count(DISTINCT net) FROM items WHERE source IS NOT NULL")
def worker_collect(spark, d):
    """The collector's ways for all items over an empty state table."""

    out = workers.collect(spark.createDataFrame([], STATE), _items(spark, d, spread=True), a.as_of())
    sizes = [out[k].agg(F.lit(name).alias("way"), F.count(F.lit(1)).alias("n")) for k, name in (("beans", "stored"), ("scrape", "scrape"), ("chatters", "chatters"), ("publishers", "publishers"))]
    return sizes[0].union(sizes[1]).union(sizes[2]).union(sizes[3])


# --- payloads of collectors -------------------------------------------------------------------------------
@_query("""SELECT 'http://x.example.org/' || s_suppkey AS url, 'example' AS source, s_name AS title, 'about & of ' || s_suppkey AS summary, 'Ann' AS author, TIMESTAMP '2024-01-05 10:00:00' AS created, ['tag ' || s_nationkey] AS tags, 'feed' || s_nationkey AS rss_feed, 'Site' AS site_name, 'x.example.org' AS base_url FROM supplier
UNION ALL SELECT 'http://y.example.org/' || s_suppkey, 'example', s_name, 'atom', NULL, TIMESTAMP '2024-01-06', [], 'atom' || s_suppkey, 'Atom site', 'y.example.org' FROM supplier""")
def feed_items(spark, d):
    """RSS and Atom bodies made of suppliers."""
    s = a.table(spark, d, "supplier")
    item = F.concat(F.lit("<item><title>"), F.col("s_name"), F.lit("</title><link>http://x.example.org/"), F.col("s_suppkey").cast("string"), F.lit("</link><description>about &amp;amp; of "), F.col("s_suppkey").cast("string"), F.lit("</description><author>Ann</author><pubDate>Fri, 05 Jan 2024 10:00:00 GMT</pubDate><category>tag "), F.col("s_nationkey").cast("string"), F.lit("</category></item>"))
    rss = s.groupBy("s_nationkey").agg(F.concat(F.lit("<rss><channel><title>Site</title><link>http://x.example.org</link>"), F.array_join(F.collect_list(item), ""), F.lit("</channel></rss>")).alias("body")).select(F.concat(F.lit("feed"), F.col("s_nationkey").cast("string")).alias("feed"), "body")
    atom = s.select(F.concat(F.lit("atom"), F.col("s_suppkey").cast("string")).alias("feed"), F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>Atom site</title><entry><title>'), F.col("s_name"), F.lit('</title><link href="http://y.example.org/'), F.col("s_suppkey").cast("string"), F.lit('"/><summary>atom</summary><updated>2024-01-06T00:00:00Z</updated></entry></feed>')).alias("body"))
    return feeds.feed_items(rss.unionByName(atom), as_of=a.as_of()).select("url", "source", "title", "summary", "author", "created", "tags", "rss_feed", "site_name", "base_url")


@_query("""SELECT CASE WHEN c_custkey % 2 = 0 THEN 'https://www.reddit.com/r/x/' || c_custkey ELSE 'http://a.example.org/' || c_custkey END AS url, c_name AS title, nullif(CASE WHEN c_custkey % 2 = 0 THEN 'body' ELSE '' END, '') AS content, least(TIMESTAMP '2024-01-01' + to_seconds(c_custkey * 60000), TIMESTAMP '2024-02-01') AS created,
  CASE WHEN c_custkey % 2 = 0 THEN 'post' END AS kind, 'https://www.reddit.com/r/x/' || c_custkey AS chatter_url, 'r/x' AS forum, CAST(c_nationkey AS BIGINT) AS likes, c_custkey AS comments, 5 AS subscribers FROM customer""")
def reddit_items(spark, d):
    c = a.table(spark, d, "customer")
    own, n = F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")
    body = F.to_json(F.struct((F.lit(1704067200.0) + F.col("c_custkey") * 60000).alias("created_utc"), F.concat(F.lit("/r/x/"), n).alias("permalink"), own.alias("is_self"), F.concat(F.lit("http://a.example.org/"), n).alias("url"), F.col("c_name").alias("title"), F.when(own, "body").otherwise("").alias("selftext"), F.lit("me").alias("author"), F.col("c_nationkey").alias("score"), F.col("c_custkey").alias("num_comments"), F.lit("x").alias("subreddit"), F.lit(5).alias("subreddit_subscribers")))
    return feeds.reddit_items(c.select(body.alias("body")), "body", a.as_of()).select("url", "title", "content", "created", "kind", "chatter_url", "forum", "likes", "comments", F.col("subscribers").cast("int").alias("subscribers"))


@_query("""SELECT CASE WHEN c_custkey % 3 = 0 THEN 'https://news.ycombinator.com/item?id=' || c_custkey ELSE 'http://b.example.org/' || c_custkey END AS url, c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN 'post' END AS kind, 'https://news.ycombinator.com/item?id=' || c_custkey AS chatter_url, CAST(c_nationkey AS BIGINT) AS likes, CAST(2 AS BIGINT) AS comments, TIMESTAMP '2024-01-01' AS created FROM customer""")
def hackernews_items(spark, d):
    c, n = a.table(spark, d, "customer"), F.col("c_custkey").cast("string")
    body = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.lit(1704067200).alias("time"), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("http://b.example.org/"), n)).alias("url"), F.col("c_name").alias("title"), F.col("c_nationkey").alias("score"), F.array(F.lit(1), F.lit(2)).alias("kids")))
    return feeds.hackernews_items(c.select(body.alias("body")), "body", a.as_of()).select("url", "title", "kind", "chatter_url", "likes", "comments", "created")


@_query("SELECT DISTINCT unnest([c_custkey, c_custkey + 1, CAST(c_nationkey AS BIGINT)]) AS id FROM customer")
def hackernews_ids(spark, d):
    c = a.table(spark, d, "customer")
    return feeds.hackernews_ids(c.select(F.to_json(F.array("c_custkey", F.col("c_custkey") + 1, "c_nationkey")).alias("body")), "body")


@_query("""SELECT s_suppkey, 'https://www.govinfo.gov/content/pkg/P-' || s_suppkey || CASE s_suppkey % 4 WHEN 0 THEN '/html/a.htm' WHEN 1 THEN '/text/P-' || s_suppkey || '.txt' ELSE '/pdf/a.pdf' END AS link,
  'http://z.example.org/' || s_suppkey AS target FROM supplier WHERE s_suppkey % 4 <> 3""")
def feed_links(spark, d):
    """The link of a government feed's entry, in its description or among the candidates that are there, and the target of a link post's body."""
    s = a.table(spark, d, "supplier")
    n, k = F.col("s_suppkey").cast("string"), F.col("s_suppkey") % 4
    guid = F.concat(F.lit("P-"), n)
    one = lambda package, tail: F.concat(F.lit('<a href="https://www.govinfo.gov/content/pkg/'), package, F.lit(f'{tail}">x</a>'))
    foreign = F.concat(F.lit('<a href="https://evil.example.org/content/pkg/'), guid, F.lit('/html/a.htm">x</a>'), one(F.lit("OTHER"), "/html/a.htm"), one(guid, "/xml/a.xml"))
    text = F.concat(foreign, F.when(k % 2 == 0, one(guid, "/pdf/a.pdf")).otherwise(F.lit("")), F.when(k == 0, one(guid, "/html/a.htm")).otherwise(F.lit("")))
    places = s.select("s_suppkey", F.posexplode(feeds.govinfo_candidates(guid)).alias("place", "url"))
    answers = places.select("url", F.when(F.col("place") == 0, 404).when(F.col("s_suppkey") % 4 == 3, 500).when(F.col("place") == 2, 405).when(F.col("place") == 3, 200).otherwise(404).alias("head"), F.lit(200).alias("get"))
    rows = feeds.govinfo_items(s.select("s_suppkey", guid.alias("guid"), text.alias("description")), answers)
    post = F.concat(F.lit('by <a href="http://u.example.org">u</a> <a href="http://z.example.org/'), n, F.lit('">[link]</a> <a href="http://r.example.org">[comments]</a>'))
    return rows.select("s_suppkey", "link", html.link_target(post, "link").alias("target"))


@_query("SELECT s_suppkey, s_name AS title, 'Body of ' || s_suppkey AS content, '2024-01-0' || (s_suppkey % 9 + 1) AS published_time FROM supplier")
def html_json_ld(spark, d):
    s = a.table(spark, d, "supplier")
    article = F.to_json(F.struct(F.lit("NewsArticle").alias("@type"), F.col("s_name").alias("headline"), F.concat(F.lit("Body of "), F.col("s_suppkey").cast("string")).alias("articleBody"), F.concat(F.lit("2024-01-0"), (F.col("s_suppkey") % 9 + 1).cast("string")).alias("datePublished")))
    page = F.concat(F.lit('<html><head><script type="application/ld+json">{"@context": "https://schema.org", "@graph": [{"@type": "WebSite", "name": "w"}, '), article, F.lit("]}</script></head><body>x</body></html>"))
    return s.select("s_suppkey", html.json_ld(page).alias("j")).select("s_suppkey", "j.title", "j.content", "j.published_time")


@_query()
def site_items(spark, d):
    return feeds.site_items(a.table(spark, d, "pages"))


# --- ports ------------------------------------------------------------------------------------------------
_UUID = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"


def _uuid(x: str) -> str:
    return _UUID.replace("h,", f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(lower({x}))),")


def _merged(spark, d):
    """Merged states as a porter gets them."""
    c, n = a.table(spark, d, "customer"), F.col("c_custkey").cast("string")
    return c.select(F.concat(F.lit("http://n.example.org/"), n).alias("id"), F.concat(F.lit("http://n.example.org/"), n).alias("url"), F.lit("n.example.org").alias("base_url"), F.lit("n").alias("source"), F.col("c_name").alias("title"), F.lit("2024-01-10").cast("timestamp").alias("collected"),
                    F.when(F.col("c_custkey") % 2 == 0, F.lit("2024-01-20").cast("timestamp")).otherwise(F.lit("2024-01-02").cast("timestamp")).alias("created"), F.array("c_mktsegment", F.lit("Ann")).alias("people"), F.array("c_mktsegment", F.lit("")).alias("companies"), F.array(F.lit("Thing")).alias("products"), F.lit(None).cast("array<string>").alias("stock_tickers"),
                    F.array(F.lit("Europe"), F.lit("Europe")).alias("regions"), F.when(F.col("c_nationkey") % 5 != 0, F.col("c_name")).alias("briefing"), F.when(F.col("c_nationkey") % 5 == 1, F.array(F.lit("one"), F.lit("two"))).alias("events"), F.array(F.lit(1.0), F.lit(0.5)).cast("array<float>").alias("embedding"))


@_query("SELECT 'http://n.example.org/' || c_custkey AS url, list_sort([c_mktsegment, 'Ann', 'Thing']) AS entities, ['Europe'] AS regions, CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '2024-01-02' END AS created FROM customer")
def port_beans(spark, d):
    rows = port.beans(_merged(spark, d))
    return rows.select("url", F.array_sort("entities").alias("entities"), "regions", "created")


@_query(f"""SELECT {_uuid("'http://n.example.org/' || c_custkey")} AS id, 'event' AS kind, 'http://n.example.org/' || c_custkey AS url, list_sort(list_distinct(['europe', lower(c_mktsegment), 'ann', 'thing'])) AS tags,
  '{{"summary":"' || c_name || '"' || CASE WHEN c_nationkey % 5 = 1 THEN ',"key_points":["one","two"]' ELSE '' END || '}}' AS digest, CASE WHEN c_custkey % 2 = 0 THEN DATE '2024-01-20' ELSE DATE '2024-01-02' END AS ts FROM customer WHERE c_nationkey % 5 <> 0""")
def port_events(spark, d):
    made = port.events(_merged(spark, d), digest_fields=["briefing", "events"], tag_fields=["regions", "people", "companies", "products"], vector_len=2)
    return made.select("id", "kind", "url", F.array_sort("tags").alias("tags"), "digest", "ts")


@_query(f"SELECT {_uuid("'signal://s' || s_suppkey")} AS id, 'signal' AS kind, 'signal://s' || s_suppkey AS url, ['europe'] AS tags, '{{\"summary\":\"' || s_name || '\"}}' AS digest, DATE '2024-01-02' AS ts FROM supplier")
def port_signals(spark, d):
    s = a.table(spark, d, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("briefing"), F.array(F.lit("Europe")).alias("regions"), F.lit("2024-01-02").cast("timestamp").alias("created"))
    return port.signals(s, prefix="signal://", digest_fields=["briefing"], tag_fields=["regions"]).select("id", "kind", "url", "tags", "digest", "ts")


@_query(f"SELECT {_uuid("s_name || '.example.org'")} AS id, s_name || '.example.org' AS base_url, s_name AS domain_name, 'Site' AS site_name, DATE '2024-02-01' AS ts FROM supplier")
def port_sources(spark, d):
    s = a.table(spark, d, "supplier").select(F.concat("s_name", F.lit(".example.org")).alias("base_url"), F.col("s_name").alias("source"), F.lit("Site").alias("site_name"))
    return port.sources(s.union(s), a.as_of())


@_query("SELECT CAST(user_id AS VARCHAR) AS chatter_url, event_type AS source, CAST(floor(value) AS BIGINT) AS likes FROM events")
def port_chatters(spark, d):
    e = a.table(spark, d, "events")
    one = F.struct(F.col("user_id").cast("string").alias("chatter_url"), F.col("event_type").alias("source"), F.floor("value").cast("long").alias("likes"))
    return port.chatters(e.groupBy(F.col("user_id").alias("id"), F.to_date("ts").alias("day")).agg(F.collect_list(one).alias("chatters")))


@_query("SELECT c_custkey AS id FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 <> 0 AND c_nationkey <> 7")
def sips_stored(spark, d):
    """New sips with a digest and a vector of the right length, where those of nation 7 are there already."""
    c = a.table(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 2 == 1, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.lit(1.0))).alias("embedding"), F.when(F.col("c_custkey") % 3 == 0, "{}").otherwise('{"a":1}').alias("digest"))
    return port.storable_sips(c.where("c_nationkey = 7").select(F.col("c_custkey").alias("id")), rows, 2).select("id")


@_query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN [c_name, c_mktsegment] END AS short, CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 4 END AS n, TRUE AS same FROM customer")
def tags_sampled(spark, d):
    """At most four of a list's tags, by hash, and all of a short list."""
    c = a.table(spark, d, "customer")
    tags = F.when(F.col("c_custkey") % 2 == 0, F.array("c_name", "c_mktsegment")).otherwise(F.array(*[F.concat(F.lit(f"t{k} "), F.col("c_name")) for k in range(9)]))
    drawn = port.sampled_tags(tags, 4, "seed")
    again = port.sampled_tags(F.reverse(tags), 4, "seed")  # the draw goes by the tags alone
    same = F.when(F.col("c_custkey") % 2 == 0, True).otherwise(F.array_sort(drawn) == F.array_sort(again))
    return c.select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, drawn).alias("short"), F.size(F.array_intersect(drawn, tags)).alias("n"), same.alias("same"))


@_query("SELECT c_custkey AS from_id, o_orderkey AS to_id FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_acctbal > 0 AND o_totalprice > 100000")
def edges_resolved(spark, d):
    c, o = a.table(spark, d, "customer"), a.table(spark, d, "orders")
    edges = o.select(F.col("o_custkey").alias("from_id"), F.col("o_orderkey").alias("to_id"))
    half = graph.resolved(edges, c.where("c_acctbal > 0").select(F.col("c_custkey").alias("id")), "id", ends=("from_id",))
    return graph.resolved(half, o.where("o_totalprice > 100000").select(F.col("o_orderkey").alias("id")), "id", ends=("to_id",))


# --- state, stores ----------------------------------------------------------------------------------------
_STATE = "state AS (SELECT CAST(user_id AS VARCHAR) || '@' || CAST(CAST(ts AS DATE) AS VARCHAR) AS id, event_type AS state, min(ts) AS ts, arg_min(props, (ts, event_id)) AS data FROM events GROUP BY 1, 2)"


@_query("SELECT c_custkey || '' AS id, 'known' AS state, TIMESTAMP '2024-02-01' AS ts, '{' || concat_ws(',', '\"name\":\"' || c_name || '\"', CASE WHEN c_nationkey <> 0 THEN '\"nation\":' || c_nationkey END, CASE WHEN c_custkey % 2 = 0 THEN '\"tags\":[\"t\"]' END) || '}' AS data FROM customer")
def state_payloads(spark, d):
    """Payloads of a put: null, empty and zero fields stay out."""
    c = a.table(spark, d, "customer")
    items = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("t"))).otherwise(F.array().cast("array<string>")).alias("tags"), F.lit("").alias("empty"), F.lit(None).cast("string").alias("nothing"))
    return state.put(spark.createDataFrame([], STATE), items, "known", as_of=a.as_of()).select("id", "state", "ts", "data")


@_query(f"WITH {_STATE} SELECT id, ts, data FROM state WHERE state = 'view' AND CAST(json_extract_string(data, '$.k') AS BIGINT) IN (1, 2, 3, 50)")
def state_conditions(spark, d):
    return state.get_one(a.state(spark, d), "view", conditions={"k": [1, 2, 3, 50]})


@_query(f"WITH {_STATE}, q AS (SELECT id, row_number() OVER (ORDER BY ts, id) AS rn FROM state WHERE state = 'click') SELECT id, (rn - 1) // 64 AS batch FROM q")
def state_batches(spark, d):
    return state.batches(state.get_one(a.state(spark, d), "click"), 64, ["ts", "id"]).select("id", "batch")


@_query("SELECT count_if(event_type = 'view' AND value < 50) AS n_deleted, count_if(NOT (event_type = 'view' AND value < 50)) AS n_left FROM events")
def delete_count(spark, d):
    return store.delete_count(a.table(spark, d, "events"), "event_type = 'view' AND value < 50")


@_query("WITH f AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN (SELECT * FROM f WHERE rn = 1) ON o_custkey = c_custkey")
def lookup_first(spark, d):
    o = a.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate")
    return store.lookup_first(a.table(spark, d, "customer").select("c_custkey"), o, "c_custkey", [F.col("o_orderdate"), F.col("o_orderkey")]).select("c_custkey", "o_orderkey", "o_totalprice")


@_query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 UNION ALL SELECT user_id, event_type, count(*) FROM events WHERE event_type = 'view' GROUP BY 1, 2")
def chatters_appended(spark, d):
    """Appends never look at what is there: written twice, read back by name and format."""
    e = a.table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    path = _folder(spark, "appended")
    store.append(e, path, partition_by=["event_type"])
    store.append(e.where("event_type = 'view'"), path, partition_by=["event_type"])
    return tables.read(spark, "pq", path, schema="user_id long, n long, event_type string")


@_query("SELECT c_custkey, c_name, c_nationkey FROM customer UNION ALL SELECT s_suppkey + 10000000, s_name, s_nationkey FROM supplier WHERE s_acctbal > 0")
def table_copied(spark, d):
    """Loaded, replaced, compacted, then topped up from another store with what it lacks."""
    one, two = _folder(spark, "one"), _folder(spark, "two")
    c = a.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    tables.write(c.where("c_nationkey < 5"), "parquet", one)
    store.write_table(c, one)
    store.compact(spark, one, 2)
    s = a.table(spark, d, "supplier").where("s_acctbal > 0").select((F.col("s_suppkey") + 10_000_000).alias("c_custkey"), F.col("s_name").alias("c_name"), F.col("s_nationkey").alias("c_nationkey"))
    tables.write(s.unionByName(c.where("c_nationkey = 1")), "orc", two)
    tables.copy(spark, ("orc", two), ("parquet", one), key="c_custkey")
    return tables.read(spark, "parquet", one, schema=c.schema)


@_query("SELECT t AS type, p AS path FROM (VALUES ('rss', 'http://a.example.org/feed'), ('rss', 'http://b.example.org/feed'), ('reddit', 'x')) AS v(t, p)")
def feed_catalogue(spark, d):
    return tables.catalogue(spark, "sources:\n  rss:\n    - http://a.example.org/feed\n    - http://b.example.org/feed\n  reddit:\n    - x\n")


@_query("SELECT 'name=' || n_nationkey AS name, n_name AS value FROM nation")
def texts_uploaded(spark, d):
    """One file a text, read back as whole files."""
    path = _folder(spark, "uploaded")
    tables.upload(a.table(spark, d, "nation"), path, name_col="n_nationkey", body_col="n_name")
    files = tables.binary_files(spark, f"{path}/name=*", "*.txt")
    return files.select(F.regexp_extract("path", "(name=[0-9]+)", 1).alias("name"), F.trim(F.regexp_replace(F.col("content").cast("string"), "\n$", "")).alias("value"))


@_query("SELECT CAST(ts AS DATE) AS day, event_type AS state, count(*) AS n FROM events GROUP BY 1, 2")
def stream_window_counts(spark, d):
    """State changes of each day, counted by a stream with a watermark, written and read back."""
    source, sink, mark = _folder(spark, "stream"), _folder(spark, "counts"), _folder(spark, "marks")
    rows = a.table(spark, d, "events").select(F.lit("beans").alias("object_type"), F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("state"), "ts", F.lit("{}").alias("data"))
    rows.write.parquet(source)
    end = spark.createDataFrame([("beans", "end", "end", "{}")], "object_type string, id string, state string, data string").withColumn("ts", F.lit("2030-01-01").cast("timestamp"))
    counts = queues.sliding_counts(queues.read_state(spark, source), window="1 day", slide="1 day", delay="1 hour")
    flat = counts.select(F.to_date("window.start").alias("day"), "state", "n")
    for more in (None, end):  # what comes last moves the watermark past all windows
        if more is not None:
            store.append(more.select("object_type", "id", "state", "ts", "data"), source)
        flat.writeStream.format("parquet").option("path", sink).option("checkpointLocation", mark).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("day date, state string, n long").parquet(sink).where("state <> 'end'")


@_query("SELECT DISTINCT CAST(user_id AS VARCHAR) AS id, 'done' AS state FROM events WHERE event_type = 'view'")
def stream_worker(spark, d):
    """The queue as a stream: ids that reach a state are handled once, a second run changes nothing."""
    path, mark = _folder(spark, "queue"), _folder(spark, "marks")
    rows = a.table(spark, d, "events").select(F.lit("beans").alias("object_type"), F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("state"), "ts", F.lit("{}").alias("data"))
    rows.write.parquet(path)
    for again in range(2):
        queues.worker(queues.read_state(spark, path), path, "view", "done", lambda b: b.select("id", "data"), f"{mark}-{again}", a.as_of).awaitTermination()
    return spark.read.schema(STATE).parquet(path).where("state = 'done'").select("id", "state")


# --- vectors, groups, backfills -----------------------------------------------------------------------------
_VECTORS = "vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"


@_query(f"WITH {_VECTORS}, r AS (SELECT x.id AS q, y.id, list_distance(x.v, y.v) AS d, row_number() OVER (PARTITION BY x.id ORDER BY list_distance(x.v, y.v), y.id) AS rn FROM vectors x, vectors y WHERE x.id % 20 = 0) SELECT id, round(min(d), 5) AS distance FROM r WHERE rn <= 10 GROUP BY id")
def vec_multi_query(spark, d):
    v = a.vectors(spark, d)
    near = search.multi_vector(v, v.where("id % 20 = 0").select(F.col("id").alias("query"), "embedding"), k=10, metric="l2")
    return near.select("id", F.round("distance", 5).alias("distance"))


@_query(f"WITH {_VECTORS}, hits AS (SELECT x.id AS q, list_distance(x.v, y.v) AS d, row_number() OVER (PARTITION BY x.id ORDER BY list_distance(x.v, y.v), y.id) AS rn FROM vectors x, vectors y WHERE x.label = 3), per AS (SELECT r, q, count(*) AS n FROM hits, (VALUES (1.1), (1.3)) AS v(r) WHERE rn <= 5 AND d <= r GROUP BY 1, 2 HAVING count(*) > 1) SELECT CAST(r AS DOUBLE) AS radius, round(avg(n), 6) AS avg_hits, min(n) AS min_hits, max(n) AS max_hits FROM per GROUP BY r")
def vec_hit_profile(spark, d):
    v = a.vectors(spark, d)
    return search.hit_profile(v, v.where("label = 3"), [1.1, 1.3]).withColumn("avg_hits", F.round("avg_hits", 6))


@_query(f"WITH {_VECTORS}, near AS (SELECT x.id AS a, y.id AS b, row_number() OVER (PARTITION BY x.id ORDER BY list_distance(x.v, y.v), y.id) AS rn FROM vectors x, vectors y WHERE x.label = 2 AND list_distance(x.v, y.v) <= 1.15) SELECT a AS id, list(b ORDER BY rn) AS related FROM near WHERE rn <= 500 GROUP BY a")
def cluster_new_batch(spark, d):
    """Related items of a new batch, among those stored and itself: the incremental search."""
    v = a.vectors(spark, d)
    return cluster.related_to(v.where("label <> 2 or label is null"), v.where("label = 2"), a.NEAR)


@_query("WITH m AS (SELECT c_nationkey AS cluster, c_custkey AS id FROM customer WHERE c_acctbal < -500), s AS (SELECT cluster, count(*) AS n FROM m GROUP BY 1), new AS (SELECT DISTINCT m.cluster, m.id + d AS id, s.n FROM m JOIN s USING (cluster), (VALUES (1), (2)) AS v(d) WHERE s.n < 6), fit AS (SELECT * FROM new WHERE (cluster, id) NOT IN (SELECT cluster, id FROM m) AND id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)), g AS (SELECT cluster, count(*) AS gain FROM fit GROUP BY 1), r AS (SELECT fit.cluster, id, n, row_number() OVER (PARTITION BY fit.cluster ORDER BY id) AS rn FROM fit JOIN g USING (cluster) WHERE n + gain >= 4) SELECT cluster, id FROM m UNION ALL SELECT cluster, id FROM r WHERE rn <= 6 - n")
def groups_expanded(spark, d):
    """Small groups gain the eligible related items of their members."""
    c = a.table(spark, d, "customer")
    members = c.where("c_acctbal < -500").select(F.col("c_nationkey").alias("cluster"), F.col("c_custkey").alias("id"))
    near = c.select(F.col("c_custkey").alias("id"), F.array(F.col("c_custkey") + 1, F.col("c_custkey") + 2).alias("related"))
    return cluster.expand_groups(members, near, c.where("c_acctbal > 0").select(F.col("c_custkey").alias("id")), most=6, least=4)


@_query("""SELECT doc_id, CAST(len(embedding) AS BIGINT) AS n FROM documents JOIN embeddings ON vec_id = doc_id WHERE doc_id % 30 >= 10 AND label <> 1""")
def vectors_hydrated(spark, d):
    """Recent items with a vector that the collection lacks."""
    b = a.beans(spark, d, content=False).join(a.table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "label"), "doc_id", "left")
    have = b.where("label = 1").select(F.col("url").alias("id"), F.col("created").alias("ts"), "embedding")
    rows = workers.hydrate_vectors(have, b.where("label is not null"), F.lit("2024-04-10").cast("timestamp"), days=90)
    return rows.select(F.substring_index("id", "/", -1).cast("long").alias("doc_id"), F.size("embedding").cast("long").alias("n"))


@_query(f"WITH {_VECTORS}, labels AS (SELECT 'label ' || CAST(label AS VARCHAR) AS name, v FROM (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY id) AS rn FROM vectors) WHERE rn = 1), ranked AS (SELECT id, replace(name, ' ', '_') AS name, row_number() OVER (PARTITION BY id ORDER BY list_cosine_distance(list_reverse(x.v), l.v), name) AS rn FROM vectors x, labels l WHERE x.label = 4), best AS (SELECT id, list(name ORDER BY rn) AS c FROM ranked WHERE rn <= 2 GROUP BY id) SELECT vec_id AS url, coalesce(c, ['old']) AS categories, CASE WHEN label = 4 THEN list_reverse(embedding) ELSE embedding END AS embedding FROM embeddings LEFT JOIN best ON id = vec_id")
def embeddings_updated(spark, d):
    """New vectors for some beans and the labels nearest to them; the others stay."""
    v = a.vectors(spark, d)
    first = v.groupBy("label").agg(F.min_by("embedding", "id").alias("embedding")).select(F.concat(F.lit("label "), F.col("label").cast("string")).alias("id"), "embedding")
    beans = v.select(F.col("id").alias("url"), "embedding", F.array(F.lit("old")).alias("categories"), F.array(F.lit("old")).alias("sentiments"))
    n = len(v.select("embedding").first()[0])
    return workers.update_embeddings(beans, v.where("label = 4").select(F.col("id").alias("url"), F.reverse("embedding").alias("embedding")), first, first, Settings(vector_len=n)).select("url", "categories", "embedding")


@_query(f"SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'own' ELSE {_uuid('c_name')} END AS id, list_sort(['x ' || c_nationkey, c_mktsegment]) AS regions, 'new' AS name FROM customer")
def rows_backfilled(spark, d):
    """Missing ids from urls, tags without signs at their ends, a staged column in the place of the old one."""
    c = a.table(spark, d, "customer")
    rows = c.select("c_custkey", F.col("c_name").alias("url"), F.when(F.col("c_custkey") % 2 == 0, "own").alias("id"), F.array(F.concat(F.lit("--x "), F.col("c_nationkey").cast("string"), F.lit("!")), F.col("c_mktsegment"), F.concat("c_mktsegment", F.lit(".")), F.lit("??")).alias("regions"), F.lit("old").alias("name"), F.lit("new").alias("name_v2"))
    made = workers.promote_column(workers.clean_tag_columns(workers.backfill_ids(rows)), "name_v2", "name")
    return made.select("c_custkey", "id", F.array_sort("regions").alias("regions"), "name")


@_query("SELECT 'doc://' || CAST(doc_id AS VARCHAR) AS url, DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS updated FROM documents WHERE doc_id % 30 BETWEEN 9 AND 19")
def filter_updated_range(spark, d):
    b = a.beans(spark, d, content=False).select("url", F.to_date("created").alias("updated"))
    return query.select(b, query.QuerySpec(updated=("2024-01-10", "2024-01-20")))


@_query("SELECT c_nationkey AS cluster, max(c_custkey) AS newest, list_sort(list(DISTINCT c_mktsegment)) AS tags, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1")
def group_digest(spark, d):
    """Of each group the newest date's stand-in, the union of tags and the prompt's members."""
    c = a.table(spark, d, "customer").where("c_acctbal > 0")
    rows = c.select(F.col("c_nationkey").alias("cluster"), F.col("c_custkey").alias("id"), F.array("c_mktsegment", "c_mktsegment").alias("regions"))
    about = workers.group_facts(rows.withColumn("entities", F.array().cast("array<string>")), "cluster", "id")
    told = port.render_groups(rows, "cluster", ["id"], ["id"]).select("cluster", F.size(F.split("text", "\n\n")).cast("long").alias("n"))
    return about.join(told, "cluster").select("cluster", "newest", F.array_sort("tags").alias("tags"), "n")


@_query("SELECT source, count(*) AS n, sum(words) AS words FROM (SELECT source, least(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')), 32767) AS words FROM documents) GROUP BY source")
def sources_counted(spark, d):
    """Words a source, through the free SQL of the query layer over a counted view."""
    counted = a.table(spark, d, "documents").select("source", texts.count_words(F.col("text")).alias("words"))
    return query.sql(spark, "SELECT source, count(*) AS n, sum(words) AS words FROM {t} GROUP BY source", {"t": counted})


@_query(f"""WITH c AS (SELECT 'doc://' || CAST(user_id % 40 AS VARCHAR) AS url, CAST(user_id AS VARCHAR) || '/' || event_type AS chatter_url, ts, floor(value) AS likes, CAST(json_extract_string(props, '$.k') AS BIGINT) AS comments FROM events),
p AS (SELECT chatter_url, max(likes) AS likes, max(comments) AS comments FROM c GROUP BY 1) SELECT c.chatter_url, min(ts) AS collected FROM c JOIN p USING (chatter_url, likes, comments) GROUP BY 1""")
def chatter_peaks(spark, d):
    return trend.peak_snapshots(a.chatters(spark, d)).groupBy("chatter_url").agg(F.min("collected").alias("collected"))


@_query(f"WITH {_VECTORS} SELECT query, id, rank, round(distance, 5) AS distance FROM (SELECT x.id AS query, y.id, list_distance(x.v, y.v) AS distance, row_number() OVER (PARTITION BY x.id ORDER BY list_distance(x.v, y.v), y.id) AS rank FROM vectors x, vectors y WHERE x.id % 20 = 0) WHERE rank <= 5")
def vec_index_exact(spark, d):
    """The five nearest of every twentieth vector, through the inverted-file index and its exact search."""
    v, path = a.vectors(spark, d), _folder(spark, "cells")
    vectorindex.build(v, path, cells=32)
    near = vectorindex.topk(spark, path, v.where("id % 20 = 0").select(F.col("id").alias("query"), "embedding"), k=5, probe=4, exact=True)
    return near.select("query", "id", F.round("distance", 5).alias("distance"), F.col("rank").cast("long").alias("rank"))


@_query("SELECT vec_id AS id, len(embedding) AS n FROM embeddings")
def label_index(spark, d):
    """A label index as it is read: its own first column is the id."""
    path = _folder(spark, "labels")
    tables.write(a.table(spark, d, "embeddings").select(F.col("vec_id").alias("label"), "embedding"), "parquet", path)
    return tables.labels(spark, path).select("id", F.size("embedding").cast("long").alias("n"))
