"""Operators: states, stores, search, clusters, sources, workers, streams."""

import datetime as dt
import io
import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle import providers
from brindle.config import Settings
from brindle.functions import urls
from brindle.operators import cluster, graph, ingest, port, query, search, state, store, trend, vectorindex
from brindle.plans import workers
from brindle.schemas import STATE
from brindle.sources import feeds, tables
from brindle.streaming import queues

NOW = dt.datetime(2024, 2, 1)
AS_OF = None


@pytest.fixture(autouse=True)
def _present(spark):
    global AS_OF
    AS_OF = F.lit("2024-02-01").cast("timestamp")


def ago(days):
    return NOW - dt.timedelta(days=days)


@pytest.fixture
def states(spark):
    rows = [("beans", f"u{k}", "collected", ago(10 if k < 4 else 1), json.dumps({"url": f"u{k}", "n": k, "s": "old"})) for k in range(10)]
    rows += [("beans", "u5", "embedded", ago(0), json.dumps({"s": "", "e": [1.0]})), ("beans", "u6", "embedded", ago(0), json.dumps({"s": "new", "n": 0})), ("other", "u7", "embedded", ago(0), "{}")]
    return spark.createDataFrame(rows, STATE)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_state_queue_invariants(states):
    assert ids(state.get_one(states, "collected", ids=["u1", "u9", "none"])) == ["u1", "u9"]
    assert ids(state.get_one(states, "collected", window_days=7, as_of=AS_OF)) == [f"u{k}" for k in range(4, 10)]
    assert len(ids(state.get_one(states, "collected", window_days=14, as_of=AS_OF))) == 10
    assert "u5" not in ids(state.get_one(states, "collected", "embedded", object_type="beans"))
    assert "u7" in ids(state.get_one(states, "collected", "embedded", object_type="beans"))
    done = state.mark_done(states, states.select("id"), ["embedded"], AS_OF)
    assert state.get_one(states.select("id", "state", "ts", "data").unionByName(done), "collected", "embedded").count() == 0
    assert [r.id for r in state.get_one(states, "collected", limit=2, offset=3).collect()] == ["u3", "u4"]
    assert ids(state.get_one(states, "collected", conditions={"n": [2, 5], "s": "old"})) == ["u2", "u5"]


def test_state_merge_keeps_truthy_values(states):
    rows = {r.id: r for r in state.get_many(states, ["collected", "embedded"], fields={"n": "long", "s": "string", "e": "array<double>"}, object_type="beans").collect()}
    assert set(rows) == {"u5", "u6"}
    assert (rows["u5"].s, rows["u5"].e) == ("old", [1.0]) and (rows["u6"].s, rows["u6"].n) == ("new", 6)


def test_state_put_is_idempotent(spark, states):
    items = spark.createDataFrame([("u1", "x", None, 0), ("n1", "", [1], 3), ("n1", "", [1], 3)], "id string, a string, b array<int>, c int")
    new = state.put(states, items, "collected", object_type="beans", as_of=AS_OF)
    rows = new.collect()
    assert [r.id for r in rows] == ["n1"] and json.loads(rows[0].data) == {"b": [1], "c": 3}
    assert state.put(states.unionByName(new), items, "collected", object_type="beans", as_of=AS_OF).count() == 0
    last = state.deduplicate(states, spark.createDataFrame([("n2", 1), ("n2", 2), ("u1", 1)], "id string, k int"), "collected", arrival="k")
    assert [tuple(r) for r in last.collect()] == [("n2", 2)]
    assert state.expire(states, AS_OF, 7).where("data is null").count() == 4
    assert state.expire(states, AS_OF, 7, keep_markers=False).count() == 9


def test_stores(spark, tmp_path):
    t = spark.createDataFrame([(1, "a", None), (2, "b", 2), (2, "b2", 3)], "k int, v string, n int")
    assert [r.k for r in store.insert_ignore(t, spark.createDataFrame([(1,), (3,), (3,), (None,)], "k int"), ["k"]).collect()] == [3]
    m = store.merge_partial(t, spark.createDataFrame([(1, None, 9), (5, "z", 1)], "k int, v string, n int"), ["k"])
    assert sorted((r.k, r.v, r.n) for r in m.collect()) == [(1, "a", 9), (2, "b", 2), (2, "b2", 3)]
    assert [r.k for r in store.drop_duplicated(t, "k").collect()] == [1]
    path = str(tmp_path / "t")
    store.write_table(t, path)
    store.write_table(spark.read.parquet(path).where("k = 1"), path)  # reads what it replaces
    assert spark.read.parquet(path).count() == 1
    store.append(t, path)
    store.compact(spark, path, 1)
    assert spark.read.parquet(path).count() == 4


def test_query_edges(spark):
    df = spark.createDataFrame([("a", 1, [1.0, 0.0], ["x"]), ("b", 2, [0.0, 1.0], None), ("c", 3, None, ["y"])], "url string, created int, embedding array<float>, entities array<string>")
    q = query.QuerySpec
    assert [r.url for r in query.latest(df, q(offset=1)).collect()] == ["b", "a"]
    assert [r.url for r in query.latest(df, q(limit=1)).collect()] == ["c"]
    assert [r.url for r in query.select(df, q(created=(1, 2), embedding=[1.0, 0.0])).collect()] == ["a", "b"]
    assert [r.url for r in query.select(df, q(embedding=[1.0, 0.0], distance=0.5, columns=["url"])).collect()] == ["a"]
    assert [r.url for r in query.select(df, q(entities=["x", "q"])).collect()] == ["a"]
    assert [r.url for r in query.select(df, q(tags=["Y"], tags_mode="all")).collect()] == ["c"]
    near = query.select(df, q(embedding=[1.0, 0.0], limit=2))
    assert [r.url for r in query.reranked(near).collect()] == ["b", "a"]


def test_trend_edges(spark):
    chat = spark.createDataFrame([("c1", "u", 5, 1, ago(3)), ("c1", "u", 5, 2, ago(2)), ("c1", "u", 5, 2, ago(1)), ("c2", "u", 9, 0, ago(3)), ("c2", "u", 1, 4, ago(2))], "chatter_url string, url string, likes long, comments long, collected timestamp").withColumns({"subscribers": F.lit(0), "shares": F.lit(0)})
    got = trend.chatter_stats(chat).collect()
    assert [(r.url, r.likes, r.comments) for r in got] == [("u", 5, 2)]  # c2's maxima never meet
    beans = spark.createDataFrame([("u", NOW), ("late", NOW + dt.timedelta(days=2))], "url string, created timestamp")
    rel = spark.createDataFrame([("late", "u")], "url string, related_url string")
    rows = {r.url: r for r in trend.trend_aggregates(beans, chat, rel, AS_OF).collect()}
    assert rows["late"].trend_score is None and rows["u"].trend_score == pytest.approx((50 * 2 + 5) / 2)


def naive_dbscan(v, eps, least):
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1)) <= eps
    core = d.sum(1) >= least
    label = np.arange(len(v))
    for _ in range(len(v)):
        for i in np.flatnonzero(core):
            label[i] = label[np.flatnonzero(d[i] & core)].min()
    return [int(label[np.flatnonzero(d[i] & core)].min()) if (d[i] & core).any() else i for i in range(len(v))], core


@pytest.mark.parametrize("block", [2048, 7])
def test_dbscan_and_radius_pairs(spark, block):
    rng = np.random.default_rng(0)
    v = np.concatenate([rng.normal(c, 0.25, (25, 3)) for c in (0, 2, 4)] + [rng.uniform(-3, 7, (15, 3)), np.zeros((4, 3))]).astype(np.float32)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, embedding array<float>")
    pairs = search.radius_pairs(df, 0.5, sample_rows=40, block=block).collect()
    d = np.sqrt(((v[:, None].astype(float) - v[None]) ** 2).sum(-1))
    assert sorted((r.a, r.b) for r in pairs) == sorted((i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if d[i, j] <= 0.5)
    want, core = naive_dbscan(v.astype(float), 0.5, 4)
    rows = sorted(cluster.dbscan(df, 0.5, 4).collect())
    assert [r.cluster for r in rows] == want and [r.core for r in rows] == core.tolist()


def test_search(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(60, 8)).astype(np.float32)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)] + [(99, None), (98, [0.0] * 8)], "id long, embedding array<float>").repartition(3)
    cos = 1 - (v @ v.T) / np.linalg.norm(v, axis=1)[:, None] / np.linalg.norm(v, axis=1)[None]
    got = search.batch_topk(df, df.where("id < 5").select(F.col("id").alias("query"), "embedding"), k=3).collect()
    for r in got:
        assert r.id == np.argsort(cos[r.query])[r["rank"] - 1]
    assert len(got) == 15
    labels = spark.createDataFrame([(f"Label {k}", v[k].tolist()) for k in range(10)], "id string, embedding array<float>")
    for r in search.nearest_labels(df.where("id < 10"), labels, k=2).collect():
        assert r.labels[0] == f"label_{r.id}" and len(r.labels) == 2  # each label's own vector finds it first
    assert search.multi_vector(df, df.where("id < 2").select(F.col("id").alias("query"), "embedding"), k=3).count() == len(set(np.argsort(cos[0])[:3]) | set(np.argsort(cos[1])[:3]))
    prof = search.hit_profile(df.where("id < 60"), df.where("id < 10"), [0.1, 100.0]).collect()
    assert [(r.radius, r.max_hits) for r in prof] == [(100.0, 5)]


def test_radius_without_a_limit(spark):
    df = spark.range(1500).select("id", F.array(F.col("id") / 1500, F.lit(0.0)).alias("embedding"))
    assert search.topk(df, [0.0, 0.0], k=None, distance=0.9, metric="l2").count() == 1351


def test_batch_topk_of_many_queries(spark, monkeypatch):
    df = spark.range(30).select("id", F.array(F.cos(F.col("id")), F.sin(F.col("id"))).alias("embedding"))
    queries = df.where("id < 9").withColumnRenamed("id", "query")
    tell = lambda: sorted((r.query, r.id, r["rank"]) for r in search.batch_topk(df, queries, k=2).collect())
    whole = tell()
    monkeypatch.setattr(search, "MAX_QUERIES", 4)
    assert tell() == whole and len(whole) == 18


def test_groups(spark):
    members = spark.createDataFrame([(1, k) for k in range(10)] + [(2, 20), (2, 21), (3, 30)], "cluster int, id int")
    chunks = cluster.chunk_groups(members, most=4, least=2).collect()
    assert sorted({(r.cluster, r.chunk, r.size) for r in chunks}) == [(1, 0, 4), (1, 1, 4), (1, 2, 2), (2, 0, 2)]
    related = spark.createDataFrame([(20, [40, 41, 20]), (30, [42])], "id int, related array<int>")
    grown = cluster.expand_groups(members, related, spark.createDataFrame([(40,), (41,), (42,)], "id int"), most=4, least=4)
    assert sorted((r.cluster, r.id) for r in grown.collect() if r.cluster > 1) == [(2, 20), (2, 21), (2, 40), (2, 41), (3, 30)]


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "c")], "url string, related_url string")
    assert sorted(tuple(r) for r in graph.symmetric(e).collect()) == [("a", "b"), ("b", "a")]
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("a", "z")], "from_id string, to_id string")
    assert [(r.from_id, r.to_id) for r in graph.resolved(edges, nodes, "id").collect()] == [("a", "b")]
    assert graph.relations(edges, "SAME_AS", AS_OF).first().relationship == "SAME_AS"


def test_ingest(spark):
    long = "word " * 170
    items = spark.createDataFrame(
        [(" HTTPS://A.com/X ", " T ", long, "Admin", None, ago(9000), "https://talk/1", 3), ("https://b.com/y", "Wordle today", long, "J", None, ago(3), None, 0), ("https://c.com/z", "Short", "few words", "J", "c", ago(3), "https://talk/2", 0)],
        "url string, title string, content string, author string, source string, created timestamp, chatter_url string, likes int",
    ).withColumn("source", F.lit("s")).withColumn("kind", F.lit("news"))
    clean = {r.url: r for r in ingest.cleanup_items(items, AS_OF).collect()}
    first = clean["https://a.com/x"]
    assert (first.title, first.author, first.created, first.content_length, first.base_url) == ("T", None, NOW, 170, "a.com")
    beans, chatters, pubs = ingest.split_items(ingest.cleanup_items(items, AS_OF))
    assert "likes" not in beans.columns and ingest.valid_chatters(chatters).count() == 1 and ingest.valid_publishers(pubs).count() == 3
    assert {r.url: r.triage for r in ingest.triage(ingest.valid_beans(beans)).collect()} == {"https://a.com/x": "store", "https://b.com/y": "drop", "https://c.com/z": "scrape"}
    scraped = spark.createDataFrame([("https://c.com/z", "a much longer text " * 20, "2024-01-15")], "url string, content string, published_time string")
    r = ingest.merge_scraped(beans, scraped, AS_OF).where("url = 'https://c.com/z'").first()
    assert r.restricted_content and r.content_length == 80 and r.created == dt.datetime(2024, 1, 15)


def test_port(spark):
    m = spark.createDataFrame([("https://a/1", ["Jane Doe"], ["ACME", ""], ["EU"], NOW + dt.timedelta(days=9), NOW, "b", [0.5, 0.5])], "url string, people array<string>, companies array<string>, regions array<string>, created timestamp, collected timestamp, briefing string, embedding array<float>")
    b = port.beans(m).first()
    assert sorted(b.entities) == ["ACME", "Jane Doe"] and b.created == NOW
    e = port.events(m, digest_fields=["briefing", "people"], tag_fields=["people", "companies", "regions"], vector_len=2).first()
    assert e.tags == ["jane_doe", "acme", "eu"] and json.loads(e.digest) == {"summary": "b", "people": ["Jane Doe"]} and e.kind == "event"
    many = spark.createDataFrame([([f"t{k}" for k in range(80)],)], "t array<string>").select(port.sampled_tags(F.col("t"), 50).alias("t")).first().t
    assert len(set(many)) == 50
    s = port.signals(m.withColumn("id", F.lit("x1")), prefix="signal://", digest_fields=["briefing"], tag_fields=["regions"]).first()
    assert s.url == "signal://x1"
    assert port.chatters(spark.createDataFrame([(1, [("c", 2), ("d", 3)])], "id int, chatters array<struct<u:string,n:int>>")).count() == 2


RSS = """<rss version="2.0"><channel><title>Site</title><link>https://s.com</link><item><title>One</title><link>https://s.com/1</link><description>&lt;p&gt;Sum&lt;/p&gt;</description>
<pubDate>Fri, 05 Jan 2024 10:00:00 GMT</pubDate><category>a</category><category>b</category></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title><entry><title>Two</title><link rel="alternate" href="https://t.com/2"/><updated>2024-01-06T00:00:00Z</updated><author><name>N</name></author></entry></feed>"""


def test_feeds(spark):
    raw = spark.createDataFrame([("f1", RSS), ("f2", ATOM), ("f3", "<broken"), ("f4", None)], "feed string, body string")
    rows = {r.url: r for r in feeds.feed_items(raw, as_of=AS_OF).collect()}
    assert set(rows) == {"https://s.com/1", "https://t.com/2"}
    assert (rows["https://s.com/1"].summary, rows["https://s.com/1"].tags, rows["https://s.com/1"].created) == ("Sum", ["a", "b"], dt.datetime(2024, 1, 5, 10))
    assert rows["https://t.com/2"].author == "N"
    pkg = "https://www.govinfo.gov/content/pkg/"
    bodies = [
        ("A", f'<a href="{pkg}A/pdf/A.pdf">p</a> <a class="x" href="{pkg}A/html/A.htm">h</a>', f"{pkg}A/html/A.htm"),
        ("B", f"&lt;a href=&quot;{pkg}B/pdf/B.pdf&quot;&gt;p&lt;/a&gt;", f"{pkg}B/pdf/B.pdf"),
        ("C", f'<a href="https://evil.example.org/x.html">x</a><a href="{pkg}OTHER/html/OTHER.htm">o</a><a href="{pkg}C/xml/C.xml">x</a><a href="{pkg}C.zip">z</a><a href="http://www.govinfo.gov/content/pkg/C/html/C.htm">plain</a>', None),
        ("D", None, None), (None, f'<a href="{pkg}A/html/A.htm">h</a>', None),
    ]
    gov = spark.createDataFrame([x[:2] for x in bodies], "guid string, description string")
    assert {r.guid: r.link for r in gov.select("guid", feeds.govinfo_link(F.col("description"), F.col("guid")).alias("link")).collect()} == {g: link for g, _, link in bodies}
    places = gov.select(feeds.govinfo_candidates(F.lit(" C ")).alias("c")).first().c
    assert places == [f"{pkg}C/html/C.htm", f"{pkg}C/html/C.html", f"{pkg}C/text/C.txt", f"{pkg}C/pdf/C.pdf"]
    answers = spark.createDataFrame([(places[0], 404, 200), (places[1], 405, 500), (places[2], 501, 204), (places[3], 200, None), (f"{pkg}A/html/A.html", 200, None)], "url string, head int, get int")
    assert {r.guid: r.link for r in feeds.govinfo_items(gov, answers).collect()} == {"A": bodies[0][2], "B": bodies[1][2], "C": places[2]}
    reddit = spark.createDataFrame([(json.dumps({"created_utc": 1.7e9, "permalink": "/r/x/1", "is_self": True, "url": "u", "title": "t", "selftext": "s", "score": 5, "num_comments": 2, "subreddit": "x"}),)], "b string")
    r = feeds.reddit_items(reddit, "b", AS_OF).first()
    assert (r.kind, r.url, r.platform, r.likes, r.forum) == ("post", "https://www.reddit.com/r/x/1", "reddit", 5, "r/x")
    hn = spark.createDataFrame([(json.dumps({"id": 7, "time": 1700000000, "title": "t", "url": "https://a.com", "score": 3, "kids": [1, 2]}),), (json.dumps({"id": 8, "time": 1700000000, "title": "t", "text": "<p>x"}),)], "b string")
    rows = feeds.hackernews_items(hn, "b", AS_OF).collect()
    assert [(r.kind, r.comments, r.platform) for r in rows] == [(None, 2, "hackernews"), ("post", 0, "hackernews")]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.txt", "no")
        z.writestr("b.HTM", "<p>yes</p>")
    z = feeds.first_html_of_zip(spark.createDataFrame([("p", bytearray(buf.getvalue())), ("q", bytearray(b"bad"))], "path string, content binary")).collect()
    assert [(r.member, r.html) for r in z] == [("b.HTM", "<p>yes</p>"), (None, None)]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    for fmt in ("parquet", "orc", "json", "csv"):
        tables.write(df, fmt, str(tmp_path / fmt))
        assert tables.read(spark, fmt, str(tmp_path / fmt), **({"schema": "k int, v string"})).collect() == df.collect()
    tables.write(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), "parquet", str(tmp_path / "src"))
    tables.copy(spark, ("parquet", str(tmp_path / "src")), ("parquet", str(tmp_path / "parquet")), key="k")
    assert sorted(r.v for r in tables.read(spark, "parquet", str(tmp_path / "parquet")).collect()) == ["a", "c"]
    cat = tables.catalogue(spark, "sources:\n  rss:\n    - https://a/1\n    - https://a/2\n  reddit:\n    - x\n")
    assert sorted(tuple(r) for r in cat.collect()) == [("reddit", "x"), ("rss", "https://a/1"), ("rss", "https://a/2")]


def test_providers(spark):
    df = spark.createDataFrame([(1, "alpha beta " * 400), (2, ""), (3, "Jane of ACME buys $MSFT. It was fine. Then more. And more.")], "id int, content string")
    rows = {r.id: r.embedding for r in providers.embed(df, lambda: providers.HashEmbedder(32, 100)).collect()}
    assert len(rows[1]) == 32 and rows[2] is None
    found = {r.id: r.found for r in providers.extract(df, lambda: providers.PatternExtractor({"Jane": "person", "ACME": "company"})).collect()}
    assert (found[3].people, found[3].companies, found[3].stock_tickers) == (["Jane"], ["ACME"], ["MSFT"])
    digest = {r.id: r.digest for r in providers.analyse(df, "briefing string, events array<string>").collect()}
    assert digest[3].briefing.startswith("Jane of ACME") and digest[2] is None
    assert providers.bisected(lambda x: (_ for _ in ()).throw(MemoryError()) if len(x) > 1 or x == [3] else x, [1, 2, 3]) == [1, 2, None]
    assert len(providers.embed_query("q")) == 320 and providers.embedder("hash://16")().size == 16


def test_backfills(spark):
    cfg = Settings(vector_len=2)
    beans = spark.createDataFrame([("a", NOW, [1.0, 0.0], ["old"], None), ("b", ago(200), [0.0, 1.0], None, None), ("c", NOW, None, None, None)], "url string, created timestamp, embedding array<float>, categories array<string>, sentiments array<string>")
    have = spark.createDataFrame([], "id string, ts timestamp, embedding array<float>")
    assert ids(workers.hydrate_vectors(have, beans, AS_OF)) == ["a"]
    labels = spark.createDataFrame([("Up Side", [0.0, 1.0]), ("x", [1.0, 0.0])], "id string, embedding array<float>")
    got = {r.url: r for r in workers.update_embeddings(beans, spark.createDataFrame([("c", [0.1, 1.0]), ("a", [1.0])], "url string, embedding array<float>"), labels, labels, cfg).collect()}
    assert got["c"].categories == ["up_side", "x"] and got["a"].categories == ["old"] and len(got) == 3
    assert workers.backfill_ids(beans).where("length(id) = 36").count() == 3
    tags = spark.createDataFrame([(["!a!", "a", "..", "b c"],)], "regions array<string>")
    assert workers.clean_tag_columns(tags).first().regions == ["a", "b c"]
    assert workers.promote_column(beans.withColumn("v2", F.lit(1)), "v2", "embedding").columns[-1] == "embedding"
    assert providers.json_schema("a string, b array<int>, c date")["properties"]["b"] == {"type": "array", "items": {"type": "integer"}}


def test_workers_end_to_end(spark):
    text = "Jane of ACME met the board in Paris. The plan was set. Profit grew. " * 20
    items = spark.createDataFrame([(f"https://s{k % 2}.com/{k}", f"Story {k}", text + f" variant {k}", "s", "news", ago(1)) for k in range(6)], "url string, title string, content string, source string, kind string, created timestamp")
    table = spark.createDataFrame([], STATE)
    cfg = Settings(vector_len=64, cluster_eps=0.6, consolidation_eps=0.6, consolidation_min_size=3)
    build = lambda: providers.HashEmbedder(64)

    def grow(rows):
        nonlocal table
        table = spark.createDataFrame(table.unionByName(rows.select(table.columns), allowMissingColumns=True).collect(), STATE)

    grow(workers.collect(table, items, AS_OF, cfg)["beans"])
    assert table.count() == 6
    labels = spark.createDataFrame([(n, build().embed([n])[0].tolist()) for n in ("board plan", "sports")], "id string, embedding array<float>")
    grow(workers.embed(table, labels, labels, AS_OF, build=build, settings=cfg))
    grow(workers.extract(table, AS_OF, build=lambda: providers.PatternExtractor({"Jane": "person", "ACME": "company", "Paris": "city"}), settings=cfg))
    grow(workers.digest(table, AS_OF, settings=cfg))
    grow(workers.cluster_related(table, AS_OF, settings=cfg))
    assert {r.state: r["count"] for r in table.groupBy("state").count().collect()} == dict.fromkeys(("collected", "embedded", "extracted", "digested", "clustered"), 6)
    assert workers.embed(table, labels, labels, AS_OF, build=build, settings=cfg).count() == 0
    beans = spark.createDataFrame([], "url string, title string, entities array<string>, regions array<string>, categories array<string>, created timestamp")
    ported = workers.port_beans(table, beans, AS_OF, cfg)
    first = ported["beans"].orderBy("url").first()
    assert ported["beans"].count() == 6 and set(first.entities) == {"jane", "acme"} and first.regions == ["paris"]
    sips = spark.createDataFrame([], "id string, tags array<string>")
    assert workers.port_sips(table, sips, AS_OF, cfg)["sips"].count() == 6
    out = workers.consolidate(table, AS_OF, settings=cfg)
    composites = out["composites"].collect()
    assert len(composites) == 1 and composites[0].id.startswith("2024_02_01_") and len(json.loads(composites[0].data)["related"]) == 6
    assert out["marks"].count() == 6
    # what is related, composites as signals, publishers and chatters, and the edges between what is served
    assert ported["related"].count() == 30 and ported["related"].where("url = related_url").count() == 0
    grow(out["composites"])
    signals = workers.port_signals(table, sips, AS_OF, settings=cfg)
    assert [r.kind for r in signals["sips"].collect()] == ["signal"] and signals["relations"].where("relationship = 'DERIVED_FROM'").count() == 6 and signals["marks"].count() == 1
    nodes = items.select(urls.uuid5(F.col("url")).alias("id"), urls.base_url(F.col("url")).alias("base_url")).where("base_url = 's0.com'")
    linked = workers.port_relations(table, nodes, AS_OF, cfg)
    assert linked["relations"].count() == 6 and linked["marks"].count() == 6
    grow(linked["marks"].withColumn("object_type", F.lit("beans")))
    assert workers.port_relations(table, nodes, AS_OF, cfg)["relations"].count() == 0
    known = spark.createDataFrame([("publishers", "s0", "collected", ago(0), '{"source": "s", "base_url": "s0.com", "site_name": "S"}'), ("publishers", "bad", "collected", ago(0), '{"source": "s"}'), ("chatters", "c", "collected", ago(0), '{"chatters": [{"chatter_url": "x", "url": "u", "likes": 3}, {"chatter_url": "y", "url": "u", "likes": 0}]}')], STATE)
    grow(known)
    publishers = spark.createDataFrame([], "source string, base_url string, site_name string")
    assert [tuple(r) for r in workers.port_publishers(table, publishers, AS_OF, cfg)["publishers"].collect()] == [("s", "s0.com", "S")]
    served = workers.port_sources(table, spark.createDataFrame([], "id string, base_url string, domain_name string"), nodes, AS_OF, cfg)
    assert [r.base_url for r in served["sources"].collect()] == ["s0.com"] and served["relations"].count() == 3
    told = workers.port_chatters(table, AS_OF, cfg)
    assert [(r.chatter_url, r.likes) for r in told["chatters"].collect()] == [("x", 3)] and told["marks"].count() == 1


def test_clustering_is_incremental(spark):
    """A later batch meets what was embedded before, and only its own rows come out."""
    cfg = Settings(vector_len=2, cluster_eps=0.5)
    row = lambda i, s, v, t: ("beans", i, s, ago(t), json.dumps({"embedding": v}))
    table = spark.createDataFrame([row("a", "embedded", [0.0, 0.0], 2), row("b", "embedded", [3.0, 0.0], 2), ("beans", "a", "clustered", ago(2), "{}"), ("beans", "b", "clustered", ago(2), "{}"), row("c", "embedded", [0.1, 0.0], 1)], STATE)
    made = workers.cluster_related(table, AS_OF, settings=cfg).collect()
    assert [(r.id, json.loads(r.data)["related"]) for r in made] == [("c", ["c", "a"])]


def test_vectors_of_several_lengths(spark):
    v = spark.createDataFrame([(1, [0.0, 0.0]), (2, [0.1, 0.0]), (3, [0.0]), (4, [0.2]), (5, None), (6, [])], "id long, embedding array<float>")
    assert {(r.a, r.b) for r in search.radius_pairs(v, 0.5).collect()} == {(1, 2), (3, 4)}
    q = v.where("id in (1, 3)").select(F.col("id").alias("query"), "embedding")
    assert {(r.query, r.id) for r in search.batch_topk(v, q, k=5, metric="l2").collect()} == {(1, 1), (1, 2), (3, 3), (3, 4)}


def test_table_swap(spark, tmp_path, monkeypatch):
    """A failed swap leaves the old table in its place."""
    path = str(tmp_path / "t")
    store.write_table(spark.range(3), path)
    store.write_table(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_vector_index(spark, tmp_path, monkeypatch, metric):
    """Every row is in it; the exact search is the brute one; a few cells reach a recall of 0.9; a hot cell is cut into blocks."""
    monkeypatch.setattr(vectorindex, "BLOCK_VALUES", 3000)
    monkeypatch.setattr(vectorindex, "QUERIES", 30)
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(12, 16)) * 3
    rows = [(k, (middles[k % 12 if k % 3 else 0] + rng.normal(size=16)).astype(np.float32).tolist()) for k in range(900)] + [(900, None), (901, [1.0]), (902, [0.0] * 16), (903, middles[0].tolist()), (904, middles[0].tolist())]
    v = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(5)
    path = str(tmp_path / "index")
    said = vectorindex.build(v, path, cells=16, metric=metric)
    assert said["rows"] + said["skipped"] == 905 and said["skipped"] == (2 if metric == "l2" else 3)
    q = v.where("id % 20 = 0 or id >= 900").select(F.col("id").alias("query"), "embedding")
    tell = lambda d: {(r.query, r.rank): (r.id, round(r.distance, 4)) for r in d.collect()}
    want = tell(search.batch_topk(v.where("id <> 902" if metric == "cosine" else "true"), q.where("size(embedding) = 16" + (" and query <> 902" if metric == "cosine" else "")), k=5, metric=metric))
    assert tell(vectorindex.topk(spark, path, q, k=5, probe=2, exact=True)) == want
    some = tell(vectorindex.topk(spark, path, q, k=5, probe=4))
    assert len({(a, i) for (a, _), (i, _) in some.items()} & {(a, i) for (a, _), (i, _) in want.items()}) >= 0.9 * len(want)
    empty = str(tmp_path / "empty")
    assert vectorindex.build(v.limit(0), empty)["rows"] == 0 and vectorindex.topk(spark, empty, q).count() == 0


def test_first_match_and_delete_count(spark):
    rows = spark.createDataFrame([(1,), (2,)], "k long")
    found = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z")], "k long, v string")
    assert sorted(tuple(r) for r in store.lookup_first(rows, found, "k", [F.col("v")]).collect()) == [(1, "a"), (2, None)]
    assert tuple(store.delete_count(found, "v > 'a'").first()) == (2, 1)
    assert tuple(store.delete_count(found.limit(0), "v > 'a'").first()) == (0, 0)


def test_stream_worker_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = [("beans", f"u{k}", "collected", NOW, "{}") for k in range(5)]
    store.append(spark.createDataFrame(rows, STATE), path)
    work = lambda df: df.select("id", F.lit('{"x":1}').alias("data"))
    for k in range(2):  # a second checkpoint handles everything again
        q = queues.worker(queues.read_state(spark, path), path, "collected", "embedded", work, str(tmp_path / f"c{k}"), lambda: AS_OF)
        q.awaitTermination(120)
        assert q.exception() is None
    done = spark.read.schema(STATE).parquet(path).where("state = 'embedded'")
    assert done.count() == 5 and done.select("id").distinct().count() == 5
    q = queues.first_writes(queues.read_state(spark, path)).writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("firsts").count() == 10


def test_publishers_keep_their_valid_rows(spark):
    """Of a site's rows one that is valid, whatever comes first; the rest in a fixed order."""
    rows = [("http://a.org/1", None, None, "d"), ("http://a.org/2", "a", None, None), ("http://a.org/3", "a", "A", "d"), ("http://b.org/1", "", "B", "d")]
    for own in (rows, rows[::-1]):
        items = spark.createDataFrame(own, "url string, source string, site_name string, description string").coalesce(1)
        _, _, found = ingest.split_items(ingest.cleanup_items(items, AS_OF))
        assert [(r.base_url, r.source, r.site_name) for r in ingest.valid_publishers(found).collect()] == [("a.org", "a", "A")]


def test_one_row_of_each_key_is_the_same_in_every_order(spark):
    rows = [(1, "a", None, {"x": 1}), (1, "b", 2.0, {"x": 2}), (1, "b", 1.0, None), (None, "c", None, None), (None, "d", None, None)]
    for own in (rows, rows[::-1]):
        df = spark.createDataFrame(own, "k int, v string, d double, m map<string,int>").coalesce(1)
        assert sorted(((r.k, r.v, r.d) for r in store.first_of_batch(df, ["k"]).collect()), key=repr) == [(1, "b", 2.0), (None, "d", None)]
    target, updates = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "p"), (1, "q"), (1, None)], "k int, v string")
    assert [tuple(r) for r in store.merge_partial(target, updates, ["k"]).collect()] == [(1, "q")]


@pytest.mark.parametrize("most", [10_000, 2])
def test_labels_of_any_number_and_length(spark, monkeypatch, most):
    monkeypatch.setattr(search, "MAX_LABELS", most)
    labels = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [0.0, 1.0]), ("none", None), ("gap", [None, 1.0]), ("short", [1.0]), ("nought", [])], "id string, embedding array<double>")
    rows = spark.createDataFrame([(1, [2.0, 0.1]), (2, [0.0, 3.0]), (3, [5.0]), (4, None), (5, [1.0, 1.0, 1.0])], "id long, embedding array<double>")
    got = {r.id: r.labels for r in search.nearest_labels(rows, labels, as_tags=False).collect()}
    assert got == {1: ["a", "b"], 2: ["c", "a"], 3: ["short"]}


def test_many_equal_queries(spark, monkeypatch):
    monkeypatch.setattr(search, "MAX_QUERIES", 3)
    v = spark.createDataFrame([(k, [float(k)]) for k in range(5)], "id long, embedding array<double>")
    q = spark.createDataFrame([("same", [2.2])] * 20, "query string, embedding array<double>")
    got = search.batch_topk(v, q, k=2, metric="l2").collect()
    assert sorted((r.id, r["rank"]) for r in got) == sorted([(2, 1), (3, 2)] * 20)


def test_batches_over_ranges(spark):
    rows = spark.createDataFrame([(f"x{k:03d}", k % 5) for k in range(230)], "id string, ts int").repartition(7)
    got = {r.id: r.batch for r in state.batches(rows, 32, ["ts", "id"]).collect()}
    order = sorted((k % 5, f"x{k:03d}") for k in range(230))
    assert got == {i: n // 32 for n, (_, i) in enumerate(order)}
    assert state.batches(rows.limit(0), 32, ["ts", "id"]).count() == 0
