"""The engine's registered queries over the star schema's files, and DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import catalog_items, catalog_stores, catalog_workers, providers
from .functions import dates, html, kinds, texts, urls, vectors
from .operators import cluster, graph, ingest, port, query, search, state, store, trend
from .sources import adapters as a
from .sources import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- the adapters in SQL ---------------------------------------------------------------------------------
_STATE = "state AS (SELECT CAST(user_id AS VARCHAR) || '@' || CAST(CAST(ts AS DATE) AS VARCHAR) AS id, event_type AS state, min(ts) AS ts, arg_min(props, (ts, event_id)) AS data FROM events GROUP BY 1, 2)"
_CHATTERS = """chatters AS (SELECT CAST(user_id AS VARCHAR) || '/' || event_type AS chatter_url, 'doc://' || CAST(user_id % 40 AS VARCHAR) AS url, event_type AS source, ts AS collected,
  CAST(floor(value) AS BIGINT) AS likes, CAST(json_extract_string(props, '$.k') AS BIGINT) AS comments, CAST(0 AS BIGINT) AS subscribers, CAST(0 AS BIGINT) AS shares FROM events)"""
_BEANS = """beans AS (SELECT 'doc://' || CAST(doc_id AS VARCHAR) AS url, doc_id, source, CASE WHEN doc_id % 3 = 0 THEN 'blog' ELSE 'news' END AS kind, text AS content,
  TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) AS created, [lang] AS categories,
  ['topic ' || CAST(coalesce(label, -1) AS VARCHAR), upper(source[1]) || source[2:]] AS entities, [CASE WHEN lang = 'en' THEN 'World' ELSE 'Europe' END] AS regions, embedding
  FROM documents LEFT JOIN embeddings ON vec_id = doc_id)"""
_VECTORS = "vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
_PAIRS = f"{_VECTORS}, pairs AS (SELECT x.id AS a, y.id AS b, list_distance(x.v, y.v) AS distance FROM vectors x JOIN vectors y ON x.id < y.id AND list_distance(x.v, y.v) <= 1.15)"
_RELATED = f"{_PAIRS}, related AS (SELECT 'doc://' || CAST(a AS VARCHAR) AS url, 'doc://' || CAST(b AS VARCHAR) AS related_url FROM pairs UNION ALL SELECT 'doc://' || CAST(b AS VARCHAR), 'doc://' || CAST(a AS VARCHAR) FROM pairs)"
_TREND = """peaks AS (SELECT chatter_url, max(likes) AS likes, max(comments) AS comments FROM chatters GROUP BY 1),
firsts AS (SELECT c.chatter_url, min(c.collected) AS collected FROM chatters c JOIN peaks USING (chatter_url, likes, comments) GROUP BY 1),
stats AS (SELECT c.url, CAST(max(c.collected) AS DATE) AS updated, sum(c.likes) AS likes, sum(c.comments) AS comments, sum(c.subscribers) AS subscribers, sum(c.shares) AS shares
  FROM chatters c JOIN firsts USING (chatter_url, collected) GROUP BY 1),
edges AS (SELECT url, count(*) AS related FROM related GROUP BY 1),
joined AS (SELECT url, CAST(coalesce(likes, 0) AS BIGINT) AS likes, CAST(coalesce(comments, 0) AS BIGINT) AS comments, CAST(coalesce(subscribers, 0) AS BIGINT) AS subscribers, CAST(coalesce(shares, 0) AS BIGINT) AS shares,
  CAST(coalesce(related, 0) AS BIGINT) AS related, greatest(CAST(created AS DATE), coalesce(updated, CAST(created AS DATE))) AS updated FROM beans LEFT JOIN edges USING (url) LEFT JOIN stats USING (url)),
trends AS (SELECT *, CAST(100 * related + 50 * comments + 10 * shares + likes AS DOUBLE) / nullif(DATE '2024-02-01' + 2 - updated, 0) AS trend_score FROM joined WHERE greatest(likes, comments, shares, related) > 0)"""
_ALL = f"{_BEANS}, {_CHATTERS}, {_RELATED}, {_TREND}"
_PUBS = "pubs AS (SELECT DISTINCT source, source || '.example.com' AS base_url, upper(source[1]) || source[2:] AS site_name FROM documents)"


def _trends(spark, d):
    return trend.trend_aggregates(a.beans(spark, d, content=False), a.chatters(spark, d), a.related(spark, d), a.as_of())


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- trends and views -------------------------------------------------------------------------------------
@_query(f"WITH {_ALL} SELECT url, likes, comments, subscribers, shares, related, updated, round(trend_score, 6) AS trend_score FROM trends")
def trend_aggregates(spark, d):
    return _rounded(_trends(spark, d), "trend_score")


@_query(f"WITH {_ALL} SELECT url, source, kind, related, round(trend_score, 6) AS trend_score FROM beans JOIN trends USING (url) ORDER BY trends.trend_score DESC, url LIMIT 20")
def trending_topk(spark, d):
    view = trend.trending_view(a.beans(spark, d, content=False), _trends(spark, d))
    return _rounded(query.trending(view, query.QuerySpec(limit=20, columns=["url", "source", "kind", "related", "trend_score"])), "trend_score")


@_query(f"""WITH {_RELATED}, degree AS (SELECT related_url AS c, count(*) AS freq FROM related GROUP BY 1), sides AS (SELECT url, related_url AS c FROM related UNION SELECT url, url FROM related),
ranked AS (SELECT url, c, coalesce(freq, 0) AS freq, row_number() OVER (PARTITION BY url ORDER BY coalesce(freq, 0) DESC, c) AS rn FROM sides LEFT JOIN degree USING (c)) SELECT url, c AS cluster_id, freq FROM ranked WHERE rn = 1""")
def trend_cluster_rep(spark, d):
    return trend.representatives(a.related(spark, d, kept=True))


@_query(f"WITH {_ALL} SELECT url, CASE WHEN trend_score >= 0 THEN floor(trend_score) ELSE ceil(trend_score) END AS trend_score FROM trends")
def trend_whole_scores(spark, d):
    return trend.trend_aggregates(a.beans(spark, d, content=False), a.chatters(spark, d), a.related(spark, d), a.as_of(), whole=True).select("url", "trend_score")


@_query(f"WITH {_BEANS}, {_CHATTERS}, {_RELATED}, peaks AS (SELECT chatter_url, max(likes) AS likes, max(comments) AS comments FROM chatters GROUP BY 1), firsts AS (SELECT c.chatter_url, min(c.collected) AS collected FROM chatters c JOIN peaks USING (chatter_url, likes, comments) GROUP BY 1) SELECT url, CAST(count(chatter_url) AS BIGINT) AS mentions FROM chatters JOIN firsts USING (chatter_url, collected) GROUP BY 1")
def trend_mentions(spark, d):
    return trend.chatter_stats(a.chatters(spark, d), count_shares=True).select("url", F.col("shares").alias("mentions"))


@_query(f"""WITH {_ALL}, {_PUBS}, groups AS (SELECT url, list_sort(list(related_url)) AS related_urls FROM related GROUP BY 1)
SELECT url, b.source, related, updated, related_urls, site_name FROM beans b LEFT JOIN trends USING (url) LEFT JOIN groups USING (url) LEFT JOIN pubs p ON b.source = p.source""")
def aggregated_view(spark, d):
    beans, related = a.beans(spark, d, content=False), a.related(spark, d, kept=True)
    view = trend.aggregated_view(beans, trend.trend_aggregates(beans, a.chatters(spark, d), related, a.as_of()), related, a.publishers(spark, d))
    return view.select("url", "source", "related", "updated", "related_urls", "site_name")


@_query(f"WITH {_BEANS}, {_PUBS} SELECT url, b.source, base_url, site_name, created FROM beans b LEFT JOIN pubs p ON b.source = p.source ORDER BY created DESC, url LIMIT 25 OFFSET 50")
def latest_page(spark, d):
    view = trend.sources_view(a.beans(spark, d, content=False), a.publishers(spark, d))
    return query.latest(view, query.QuerySpec(limit=25, offset=50, columns=["url", "source", "base_url", "site_name", "created"]))


@_query(f"WITH {_PUBS} SELECT source, base_url, site_name FROM pubs WHERE source IN ('src1', 'src3', 'src5') ORDER BY source")
def publishers_by_source(spark, d):
    return query.publishers(a.publishers(spark, d), query.QuerySpec(sources=["src1", "src3", "src5"], columns=["source", "base_url", "site_name"]))


@_query(f"WITH {_CHATTERS} SELECT chatter_url, url, collected, likes FROM chatters WHERE collected BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-07' AND likes >= 10")
def chatters_in_range(spark, d):
    return query.chatters(a.chatters(spark, d), query.QuerySpec(collected=("2024-01-05 00:00:00", "2024-01-07 00:00:00"), conditions=["likes >= 10"], columns=["chatter_url", "url", "collected", "likes"]))


# --- filters ------------------------------------------------------------------------------------------------
@_query(f"WITH {_BEANS} SELECT url, kind, created FROM beans WHERE kind = 'blog' AND created >= TIMESTAMP '2024-01-10' AND source IN ('src1', 'src2') AND list_has_any(categories, ['fr', 'de'])")
def filter_scalar_and_overlap(spark, d):
    q = query.QuerySpec(kind="blog", created="2024-01-10 00:00:00", sources=["src1", "src2"], categories=["fr", "de"], columns=["url", "kind", "created"])
    return query.select(a.beans(spark, d, content=False), q)


@_query(f"WITH {_BEANS} SELECT url FROM beans WHERE list_has_any(regions, ['topic 3', 'Europe']) OR list_has_any(entities, ['topic 3', 'Europe']) OR list_has_any(categories, ['topic 3', 'Europe'])")
def filter_tags_any(spark, d):
    return query.select(a.beans(spark, d, content=False), query.QuerySpec(tags=["topic 3", "Europe"], columns=["url"]))


@_query(f"WITH {_BEANS} SELECT url FROM beans WHERE list_has_all(string_split_regex(lower(array_to_string(list_concat(list_concat(regions, entities), categories), ' ')), '[^\\p{{L}}\\p{{N}}]+'), ['topic', '3', 'world'])")
def filter_tags_fts(spark, d):
    return query.select(a.beans(spark, d, content=False), query.QuerySpec(tags=["Topic 3", "world"], tags_mode="all", columns=["url"]))


@_query(f"WITH {_BEANS} SELECT url, kind FROM beans WHERE url IN ('doc://1', 'doc://2', 'doc://77') AND kind IN ('news', 'blog') AND doc_id > 1")
def filter_urls_and_conditions(spark, d):
    return query.select(a.beans(spark, d, content=False), query.QuerySpec(urls=["doc://1", "doc://2", "doc://77"], kind=["news", "blog"], conditions=["doc_id > 1"], columns=["url", "kind"]))


@_query(f"WITH {_BEANS} SELECT DISTINCT unnest(entities) AS entities FROM beans ORDER BY 1")
def distinct_unnest(spark, d):
    return query.distinct_items(a.beans(spark, d, content=False), "entities")


@_query(f"WITH {_BEANS} SELECT count(*) AS n FROM beans WHERE kind = 'news' AND doc_id > 10")
def count_with_conditions(spark, d):
    return query.count(a.beans(spark, d, content=False), ["kind = 'news'", "doc_id > 10"])


@_query(f"WITH {_BEANS} SELECT url, doc_id FROM beans WHERE url > 'doc://5' ORDER BY url LIMIT 100")
def keyset_page(spark, d):
    return query.keyset_page(a.beans(spark, d, content=False), "url", "doc://5", 100).select("url", "doc_id")


@_query("SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY 1 HAVING count(*) > 5")
def raw_sql(spark, d):
    t = {"c": a.table(spark, d, "customer"), "n": a.table(spark, d, "nation")}
    return query.sql(spark, "SELECT n_name, count(*) AS customers FROM {c} JOIN {n} ON c_nationkey = n_nationkey WHERE c_acctbal > 0 GROUP BY 1 HAVING count(*) > 5", t)


# --- state machine ----------------------------------------------------------------------------------------
@_query(f"WITH {_STATE} SELECT id, ts, data FROM state WHERE state = 'view' AND id NOT IN (SELECT id FROM state WHERE state = 'purchase')")
def state_queue_single(spark, d):
    return state.get_one(a.state(spark, d), "view", "purchase")


@_query(f"WITH {_STATE} SELECT id, max(ts) AS ts, arg_max(CAST(json_extract_string(data, '$.k') AS BIGINT), (ts, state)) FILTER (WHERE CAST(json_extract_string(data, '$.k') AS BIGINT) <> 0) AS k FROM state WHERE state IN ('view', 'click') AND id NOT IN (SELECT id FROM state WHERE state = 'purchase') GROUP BY id HAVING count(*) >= 2")
def state_queue_multi(spark, d):
    return state.get_many(a.state(spark, d), ["view", "click"], "purchase", fields={"k": "long"})


@_query(f"WITH {_STATE} SELECT id, ts, data FROM state WHERE state = 'view' AND ts >= TIMESTAMP '2024-02-01' - INTERVAL 7 DAYS AND id NOT IN (SELECT id FROM state WHERE state = 'purchase')")
def state_window(spark, d):
    return state.get_one(a.state(spark, d), "view", "purchase", window_days=7, as_of=a.as_of())


@_query(f"WITH {_STATE} SELECT id, ts, data FROM state WHERE state = 'click' ORDER BY ts, id LIMIT 30 OFFSET 10")
def state_page(spark, d):
    return state.get_one(a.state(spark, d), "click", limit=30, offset=10)


@_query(f"WITH {_STATE}, ids AS (SELECT DISTINCT id FROM state) SELECT count(*) AS n FROM ids WHERE id NOT IN (SELECT id FROM state WHERE state = 'view')")
def state_put_count(spark, d):
    s = a.state(spark, d)
    return state.put(s, s.select("id", F.lit("x").alias("v")), "view", as_of=a.as_of()).agg(F.count(F.lit(1)).alias("n"))


@_query(f"WITH {_STATE} SELECT DISTINCT id FROM state WHERE id NOT IN (SELECT id FROM state WHERE state = 'purchase')")
def state_deduplicate(spark, d):
    s = a.state(spark, d)
    return state.deduplicate(s, s.select("id"), "purchase")


@_query(f"WITH {_STATE} SELECT id, state, ts, CASE WHEN ts >= TIMESTAMP '2024-02-01' - INTERVAL 10 DAYS THEN data END AS data FROM state")
def state_expire_markers(spark, d):
    return state.expire(a.state(spark, d), a.as_of(), 10)


# --- stores -------------------------------------------------------------------------------------------------
@_query("SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 20))")
def insert_ignore_count(spark, d):
    target = a.table(spark, d, "part").where("p_size < 20").select(F.col("p_partkey").alias("l_partkey"))
    return store.insert_ignore(target, a.table(spark, d, "lineitem").select("l_partkey"), ["l_partkey"]).agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT c_custkey, coalesce(u.name, c_name) AS c_name, coalesce(u.bal, c_acctbal) AS c_acctbal FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN o_custkey % 2 = 0 THEN '[UPDATED]' END AS name, max(o_totalprice) AS bal FROM orders GROUP BY 1) u ON o_custkey = c_custkey")
def merge_partial(spark, d):
    u = a.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    u = u.withColumn("c_name", F.when(F.col("c_custkey") % 2 == 0, "[UPDATED]"))
    return store.merge_partial(a.table(spark, d, "customer"), u, ["c_custkey"]).select("c_custkey", "c_name", "c_acctbal")


@_query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-02-01' - INTERVAL 14 DAYS")
def ttl_retain(spark, d):
    return store.ttl_retain(a.table(spark, d, "events").select("event_id", "ts"), "ts", a.as_of(), "14 DAYS")


@_query("SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1")
def dup_id_report(spark, d):
    return store.duplicated(a.table(spark, d, "events"), "user_id")


@_query("SELECT doc_id FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) = 1)")
def drop_duplicated_ids(spark, d):
    docs = a.table(spark, d, "documents").withColumn("key", F.sha2("text", 256))
    return store.drop_duplicated(docs, "key").select("doc_id")


@_query("SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def set_except(spark, d):
    return store.missing(a.table(spark, d, "orders").select("o_custkey"), a.table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey")


@_query("SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def set_union(spark, d):
    return store.union_distinct(a.table(spark, d, "customer").select(F.col("c_nationkey").alias("nation")), a.table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")))


@_query("SELECT event_id FROM events WHERE NOT (event_type = 'view' AND value < 50)")
def delete_where(spark, d):
    return store.delete_where(a.table(spark, d, "events"), "event_type = 'view' AND value < 50").select("event_id")


# --- vectors --------------------------------------------------------------------------------------------------
def _probe(spark, d):
    return [float(x) for x in a.table(spark, d, "embeddings").where("vec_id = 7").select("embedding").first()[0]]


@_query(f"WITH {_VECTORS} SELECT id, round(distance, 6) AS distance FROM (SELECT y.id, list_cosine_distance(x.v, y.v) AS distance FROM vectors x, vectors y WHERE x.id = 7 ORDER BY 2, 1 LIMIT 10)")
def vec_topk_cosine(spark, d):
    return _rounded(search.topk(a.vectors(spark, d), _probe(spark, d)), "distance")


@_query(f"WITH {_VECTORS} SELECT y.id, round(list_distance(x.v, y.v), 6) AS distance FROM vectors x, vectors y WHERE x.id = 7 AND list_distance(x.v, y.v) <= 1.3")
def vec_radius_l2(spark, d):
    return _rounded(search.topk(a.vectors(spark, d), _probe(spark, d), k=None, distance=1.3, metric="l2"), "distance")


@_query(f"WITH {_VECTORS} SELECT query, id, rank, round(distance, 5) AS distance FROM (SELECT x.id AS query, y.id, list_cosine_distance(x.v, y.v) AS distance, row_number() OVER (PARTITION BY x.id ORDER BY list_cosine_distance(x.v, y.v), y.id) AS rank FROM vectors x, vectors y WHERE x.id % 20 = 0) WHERE rank <= 5")
def vec_batch_topk(spark, d):
    v = a.vectors(spark, d)
    return _rounded(search.batch_topk(v, v.where("id % 20 = 0").select(F.col("id").alias("query"), "embedding"), k=5), "distance", digits=5).withColumn("rank", F.col("rank").cast("long"))


@_query(f"WITH {_VECTORS}, labels AS (SELECT 'label ' || CAST(label AS VARCHAR) AS name, v FROM (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY id) AS rn FROM vectors) WHERE rn = 1), ranked AS (SELECT id, replace(name, ' ', '_') AS name, row_number() OVER (PARTITION BY id ORDER BY list_cosine_distance(x.v, l.v), name) AS rn FROM vectors x, labels l) SELECT id, list(name ORDER BY rn) AS labels FROM ranked WHERE rn <= 2 GROUP BY id")
def label_top2(spark, d):
    v = a.vectors(spark, d)
    first = v.groupBy("label").agg(F.min_by("embedding", "id").alias("embedding")).select(F.concat(F.lit("label "), F.col("label").cast("string")).alias("id"), "embedding")
    return search.nearest_labels(v, first)


@_query(f"WITH {_VECTORS}, each AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM vectors), med AS (SELECT label, p, median(x) AS m FROM each GROUP BY 1, 2) SELECT label, list(round(m, 6) ORDER BY p) AS centre FROM med GROUP BY 1")
def vec_group_median(spark, d):
    m = search.median_vector(a.vectors(spark, d), "label")
    return m.select("label", F.transform("embedding", lambda x: F.round(x, 6)).alias("centre"))


@_query(f"WITH {_VECTORS}, each AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM vectors), med AS (SELECT label, p, avg(x) AS m FROM each GROUP BY 1, 2) SELECT label, list(round(m, 6) ORDER BY p) AS centre FROM med GROUP BY 1")
def vec_group_mean(spark, d):
    m = search.mean_vector(a.vectors(spark, d), "label")
    return m.select("label", F.transform("embedding", lambda x: F.round(x, 6)).alias("centre"))


@_query(f"WITH {_PAIRS} SELECT a, b, round(distance, 5) AS distance FROM pairs")
def radius_pairs(spark, d):
    return _rounded(search.radius_pairs(a.vectors(spark, d), a.NEAR), "distance", digits=5)


@_query(f"""WITH RECURSIVE {_PAIRS}, both_ways AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs), cores AS (SELECT a AS id FROM both_ways GROUP BY a HAVING count(*) + 1 >= 4),
reach(id, root) AS (SELECT id, id FROM cores UNION SELECT e.b, r.root FROM reach r JOIN both_ways e ON e.a = r.id WHERE e.b IN (SELECT id FROM cores)),
labels AS (SELECT id, min(root) AS cluster FROM reach GROUP BY id),
border AS (SELECT e.a AS id, min(l.cluster) AS cluster FROM both_ways e JOIN labels l ON l.id = e.b WHERE e.a NOT IN (SELECT id FROM cores) GROUP BY 1)
SELECT v.id, coalesce(l.cluster, b.cluster, v.id) AS cluster, l.id IS NOT NULL AS core FROM vectors v LEFT JOIN labels l ON l.id = v.id LEFT JOIN border b ON b.id = v.id""")
def dbscan_groups(spark, d):
    return cluster.dbscan(a.vectors(spark, d), a.NEAR, 4)


@_query(f"WITH {_PAIRS}, near AS (SELECT a, b, distance FROM pairs UNION ALL SELECT b, a, distance FROM pairs UNION ALL SELECT id, id, 0 FROM vectors), ranked AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY distance, b) AS rn FROM near) SELECT a AS id, list(b ORDER BY rn) AS related FROM ranked WHERE rn <= 500 GROUP BY a")
def cluster_related(spark, d):
    return cluster.related(a.vectors(spark, d), a.NEAR)


@_query("WITH m AS (SELECT c_nationkey AS cluster, c_custkey AS id, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 16 AS chunk FROM customer), s AS (SELECT cluster, chunk, count(*) AS size FROM m GROUP BY 1, 2 HAVING count(*) >= 4) SELECT id, cluster, chunk, size FROM m JOIN s USING (cluster, chunk)")
def group_chunks(spark, d):
    return cluster.chunk_groups(a.table(spark, d, "customer").select(F.col("c_nationkey").alias("cluster"), F.col("c_custkey").alias("id")), most=16).select("id", "cluster", "chunk", "size")


# --- graph ------------------------------------------------------------------------------------------------------
@_query("SELECT DISTINCT user_id AS url, unnest(list_distinct(list(event_type))) AS related_url FROM events GROUP BY user_id")
def edges_explode(spark, d):
    packed = a.table(spark, d, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    return graph.explode_edges(packed, "user_id", "kinds")


@_query(f"WITH {_PAIRS} SELECT a AS url, b AS related_url FROM pairs UNION SELECT b, a FROM pairs")
def edges_symmetric(spark, d):
    return graph.symmetric(search.radius_pairs(a.vectors(spark, d), a.NEAR).select(F.col("a").alias("url"), F.col("b").alias("related_url")))


@_query("SELECT DISTINCT o_custkey AS from_id, o_orderkey AS to_id, 'PUBLISHED' AS relationship, DATE '2024-02-01' AS ts FROM orders JOIN customer ON c_custkey = o_custkey")
def edges_published(spark, d):
    c = a.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("base_url"))
    o = a.table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("base_url"))
    return graph.published(c, o, a.as_of())


# --- scalars ----------------------------------------------------------------------------------------------------
@_query("""SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) AS base_url, regexp_replace(url, '[?#].*$', '') AS bare, lower(trim(url)) AS clean, regexp_extract(regexp_extract(lower(url), '//([^/?#]*)', 1), '([^.]+)\\.[^.]+$', 1) AS source, regexp_replace(url, '[?#].*$', '') LIKE '%.pdf' AS pdf FROM pages""")
def url_normalise(spark, d):
    u = F.col("url")
    return a.table(spark, d, "pages").select("page_id", urls.base_url(u).alias("base_url"), urls.without_query(u).alias("bare"), urls.clean(u).alias("clean"), urls.source(u).alias("source"), urls.is_pdf_url(u).alias("pdf"))


@_query("SELECT page_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST('0x' || substr(h, 17, 1) AS INTEGER) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS id FROM (SELECT page_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(lower(trim(url)))) AS h FROM pages)")
def uuid5(spark, d):
    return a.table(spark, d, "pages").select("page_id", urls.uuid5(F.col("url")).alias("id"))


@_query("SELECT doc_id, CAST(least(len(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '')), 32767) AS INTEGER) AS words FROM documents")
def word_count(spark, d):
    return a.table(spark, d, "documents").select("doc_id", texts.count_words(F.col("text")).alias("words"))


@_query("""SELECT page_id, CASE WHEN regexp_matches(lower(url), '(medium\\.com|substack\\.|wordpress\\.|blogspot\\.|newsletter\\.|developers\\.|blogs\\.|blog\\.|\\.so/|\\.dev/|\\.io/|\\.to/|\\.rs/|\\.tech/|\\.ai/|\\.blog/|/blog/|/reviews/)') THEN 'blog' WHEN contains(lower(url), '/news/') THEN 'news' END AS kind FROM pages""")
def kind_cascade(spark, d):
    return a.table(spark, d, "pages").select("page_id", kinds.content_kind(url=F.col("url")).alias("kind"))


@_query("SELECT p_partkey, [lower(regexp_replace(p_type, '[^A-Za-z0-9]+', '_', 'g')), lower(regexp_replace(regexp_replace(p_brand, '[^A-Za-z0-9]+', '_', 'g'), '([a-z])([0-9])', '\\1\\2'))] AS tags FROM part")
def tags_snake(spark, d):
    tags = texts.normalize_tags(F.array("p_type", "p_brand"))
    return a.table(spark, d, "part").select("p_partkey", tags.alias("tags"))


@_query("SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is'), '\\s+', ' ', 'g')), '') AS title FROM pages")
def html_title(spark, d):
    return a.table(spark, d, "pages").select("page_id", html.title(F.col("html")).alias("title"))


@_query()
def html_text(spark, d):
    return a.table(spark, d, "pages").select("page_id", html.strip_tags(F.col("html")).alias("text"))


@_query()
def html_markdown(spark, d):
    return a.table(spark, d, "pages").select("page_id", html.markdown(F.col("html")).alias("markdown"))


@_query()
def html_metadata(spark, d):
    return a.table(spark, d, "pages").select("page_id", html.metadata(F.col("html")).alias("m")).select("page_id", "m.*")


@_query()
def page_items(spark, d):
    return feeds.page_items(a.table(spark, d, "pages"))


@_query("SELECT o_orderkey, o_orderdate >= TIMESTAMP '1998-01-01' - INTERVAL 1825 DAYS AS usable, CAST(DATE '1998-01-01' - CAST(o_orderdate AS DATE) AS INTEGER) AS age FROM orders")
def date_functions(spark, d):
    as_of = F.lit("1998-01-01").cast("timestamp")
    return a.table(spark, d, "orders").select("o_orderkey", dates.usable(F.col("o_orderdate"), as_of).alias("usable"), dates.age_days(as_of, F.col("o_orderdate")).alias("age"))


@_query(f"WITH {_VECTORS} SELECT x.id, round(list_dot_product(x.v, y.v), 6) AS ip, round(list_distance(x.v, y.v), 6) AS l2, round(list_cosine_distance(x.v, y.v), 6) AS cosine FROM vectors x, vectors y WHERE y.id = 7")
def vector_columns(spark, d):
    q = vectors.literal(_probe(spark, d))
    e = F.col("embedding")
    return a.vectors(spark, d).select("id", F.round(vectors.dot(e, q), 6).alias("ip"), F.round(vectors.l2(e, q), 6).alias("l2"), F.round(vectors.cosine_distance(e, q), 6).alias("cosine"))


# --- workers ------------------------------------------------------------------------------------------------------
@_query(f"WITH {_BEANS}, sized AS (SELECT url, kind, least(len(list_filter(string_split_regex(content, '\\s+'), lambda x: x <> '')), 32767) AS n FROM beans) SELECT url, CASE WHEN n >= 160 THEN 'store' ELSE 'scrape' END AS triage FROM sized")
def triage_split(spark, d):
    b = a.beans(spark, d).withColumn("title", F.lit("a title"))
    return ingest.triage(b.withColumn("content_length", texts.count_words(F.col("content")))).select("url", "triage")


@_query()
def embed_documents(spark, d):
    return providers.embed(a.table(spark, d, "documents").select("doc_id", "text"), lambda: providers.HashEmbedder(64), text_col="text").select("doc_id", "embedding")


@_query()
def extract_entities(spark, d):
    names = {r[0].title(): "country" for r in a.table(spark, d, "nation").select("n_name").collect()}
    return providers.extract(a.table(spark, d, "documents").select("doc_id", "text"), lambda: providers.PatternExtractor(names), text_col="text").select("doc_id", "found.*")


@_query(f"WITH {_BEANS} SELECT url, 'url: ' || url || chr(10) || 'created: ' || strftime(created, '%Y-%m-%d') || chr(10) || 'regions: ' || array_to_string(regions, ', ') AS prompt FROM beans")
def prompt_render(spark, d):
    b = a.beans(spark, d, content=False)
    return b.select("url", port.render(b, ["url", "created", "regions", "missing"]).alias("prompt"))


@_query(f"WITH {_BEANS} SELECT url, list_sort(list_distinct(list_concat(list_concat(regions, entities), categories))) AS tags, array_to_string(list_concat(list_concat(regions, entities), categories), ' ') AS words FROM beans")
def tags_merged(spark, d):
    b = a.beans(spark, d, content=False)
    three = [F.col(c) for c in ("regions", "entities", "categories")]
    return b.select("url", F.array_sort(texts.merge_lists(*three)).alias("tags"), texts.tags_to_text(*three).alias("words"))


@_query(f"WITH {_VECTORS}, q AS (SELECT v FROM vectors WHERE id = 7), near AS (SELECT b.url, b.created, list_cosine_distance(CAST(b.embedding AS DOUBLE[]), q.v) AS d FROM ({{beans}}) b, q WHERE b.kind = 'news' AND b.embedding IS NOT NULL ORDER BY 3, 1 LIMIT 25) SELECT url, created, round(CASE WHEN max(d) OVER () > min(d) OVER () THEN (max(d) OVER () - d) / (max(d) OVER () - min(d) OVER ()) ELSE 1 END, 6) AS relevance FROM near".replace("{beans}", "SELECT 'doc://' || CAST(doc_id AS VARCHAR) AS url, CASE WHEN doc_id % 3 = 0 THEN 'blog' ELSE 'news' END AS kind, TIMESTAMP '2024-01-01' + to_days(CAST(doc_id % 30 AS INTEGER)) AS created, embedding FROM documents LEFT JOIN embeddings ON vec_id = doc_id"))
def vec_filter_rerank(spark, d):
    near = query.select(a.beans(spark, d, content=False).where("embedding is not null"), query.QuerySpec(kind="news", embedding=_probe(spark, d), limit=25, order=[F.col("url")]))
    return query.reranked(near).select("url", "created", F.round("relevance", 6).alias("relevance"))


@_query(f"WITH {_BEANS}, {_VECTORS} SELECT url, created FROM beans, (SELECT v AS q FROM vectors WHERE id = 7) WHERE embedding IS NOT NULL AND list_cosine_distance(CAST(embedding AS DOUBLE[]), q) <= 0.9 AND kind IN ('news', 'blog') ORDER BY created DESC, url LIMIT 40")
def sips_in_radius(spark, d):
    b = a.beans(spark, d, content=False).withColumn("id", F.col("url"))
    return query.sips(b, query.QuerySpec(kind=["news", "blog"], embedding=_probe(spark, d), distance=0.9, limit=40, columns=["url", "created"])).drop("distance")


@_query("SELECT page_id, CASE WHEN regexp_matches(url, '//www\\.') THEN NULL ELSE regexp_replace(url, '^([a-z]+://)', '\\1www.') END AS www, regexp_replace(url, '^.*/', '') AS last FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages)".replace("\\\\", "\\"))
def url_forms(spark, d):
    u = urls.without_query(F.col("url"))
    return a.table(spark, d, "pages").select("page_id", urls.with_www(u).alias("www"), F.substring_index(u, "/", -1).alias("last"))


@_query("SELECT page_id, url IS NULL OR url = '' OR regexp_matches(url, '\\.(png|jpeg|jpg|gif|webp|mp4|avi|mkv|mp3|wav)$') OR regexp_matches(url, '/video(s)?/') OR regexp_matches(url, '/image(s)?/') OR regexp_matches(url, '://[^/?#]+\\.(ru|su)([:/?#]|$)') AS excluded FROM pages")
def url_excluded(spark, d):
    return a.table(spark, d, "pages").select("page_id", urls.excluded(F.col("url")).alias("excluded"))


@_query("WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) SELECT o_custkey, o_orderkey, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 2")
def top_per_group(spark, d):
    o = a.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return trend.top_per_group(o, "o_custkey", [F.col("o_totalprice").desc(), F.col("o_orderkey")], 2).select("o_custkey", "o_orderkey", "rank")


@_query(f"WITH {_BEANS} SELECT url, sha1(url) AS h, '2024_02_01_' || sha1(content) AS composite_id FROM beans")
def dated_ids(spark, d):
    return a.beans(spark, d).select("url", F.sha1(F.col("url").cast("binary")).alias("h"), urls.dated_id(F.col("content"), a.as_of()).alias("composite_id"))


@_query(f"WITH {_STATE}, ids AS (SELECT DISTINCT id FROM state), want AS (SELECT id, s AS state FROM ids, (VALUES ('view'), ('done')) AS v(s)) SELECT id, want.state, TIMESTAMP '2024-02-01' AS ts, '{{{{}}}}' AS data FROM want ANTI JOIN state USING (id, state)".replace("{{}}", "{}"))
def state_mark_done(spark, d):
    s = a.state(spark, d)
    return state.mark_done(s, s.select("id").distinct(), ["view", "done"], a.as_of()).select("id", "state", "ts", "data")


@_query(f"WITH {_BEANS} SELECT url, created, kind FROM beans WHERE kind = 'blog' AND created BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-07' ORDER BY created DESC, url")
def filter_created_range(spark, d):
    return query.latest(a.beans(spark, d, content=False), query.QuerySpec(created=("2024-01-04 00:00:00", "2024-01-07 00:00:00"), equals={"kind": "blog"}, columns=["url", "created", "kind"]))


QUERIES |= catalog_items.QUERIES | catalog_stores.QUERIES | catalog_workers.QUERIES
ORACLES |= catalog_items.ORACLES | catalog_stores.ORACLES | catalog_workers.ORACLES


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return trending_topk(spark, d)
