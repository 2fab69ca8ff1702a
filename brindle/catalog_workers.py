"""Registered queries that run the workers over state tables made of the star schema, and DuckDB SQL for what they must put out."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import providers
from .config import Settings
from .operators import vectorindex
from .operators.durable import cut, shared_folder
from .plans import workers
from .sources import adapters as a

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


class DigestEmbedder:
    """Counts of words by the first digits of their MD5, scaled to length one: a model that SQL can say too."""

    size, context = 4, 512

    def embed(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size))
        for k, t in enumerate(texts):
            for w in re.findall(r"\w+", t.lower()):
                out[k, int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % self.size] += 1
        n = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(n > 0, n, 1)).astype(np.float32)


def _rows(df: DataFrame, state: str, object_type: str = "beans", **payload) -> DataFrame:
    """State rows of a table with an id: the payload's columns as a JSON object."""
    data = F.to_json(F.struct(*[(v if isinstance(v, F.Column) else F.lit(v)).alias(k) for k, v in payload.items()]))
    return df.select(F.lit(object_type).alias("object_type"), "id", F.lit(state).alias("state"), F.lit("2024-01-20").cast("timestamp").alias("ts"), data.alias("data"))


def _union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return cut(out)


def _customers(spark: SparkSession, d: str) -> DataFrame:
    c, n = a.table(spark, d, "customer"), a.table(spark, d, "nation")
    rows = c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.withColumns({"id": F.concat(F.lit("http://c.example.org/"), F.col("c_custkey").cast("string")), "k": F.col("c_custkey")})


def _content() -> F.Column:
    ticker = F.upper(F.substring("n_name", 1, 3))
    return F.concat("c_name", F.lit(" of "), "n_name", F.lit(" holds $"), ticker, F.lit(". Its number is "), F.col("c_custkey").cast("string"), F.lit("! Third of all. Fourth and last."))


def _collected(rows: DataFrame) -> DataFrame:
    created = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("k") % 20).cast("int")).cast("timestamp")
    return _rows(rows, "collected", url=F.col("id"), title=F.col("c_name"), content=_content(), source=F.lit("example"), base_url=F.lit("c.example.org"), kind=F.lit("news"), created=created, collected=a.as_of())


_C = """c AS (SELECT *, 'http://c.example.org/' || CAST(c_custkey AS VARCHAR) AS id, c_custkey AS k, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 20 AS INTEGER)) AS created,
  c_name || ' of ' || n_name || ' holds $' || upper(n_name[1:3]) || '. Its number is ' || c_custkey || '! Third of all. Fourth and last.' AS content FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


@_query(f"""WITH {_C}, w AS (SELECT id, unnest(regexp_extract_all(lower(content), '[0-9a-z_]+')) AS w FROM c),
s AS (SELECT id, CAST('0x' || md5(w)[1:4] AS INTEGER) % 4 AS slot, count(*) AS n FROM w GROUP BY 1, 2),
full_ AS (SELECT i.id, j, coalesce(n, 0) AS n FROM (SELECT id, j FROM c, range(4) AS r(j)) AS i LEFT JOIN s ON s.id = i.id AND s.slot = j),
norm AS (SELECT id, sqrt(sum(n * n)) AS len FROM full_ GROUP BY id)
SELECT id, list(round(n / len, 4) ORDER BY j) AS embedding, list('axis_' || j ORDER BY n DESC, j)[1:2] AS categories FROM full_ JOIN norm USING (id) GROUP BY id""")
def worker_embed(spark, d):
    """Vectors and nearest labels of collected items."""
    axes = spark.createDataFrame([(f"Axis {k}", [1.0 if j == k else 0.0 for j in range(4)]) for k in range(4)], "id string, embedding array<double>")
    made = workers.embed(_union(_collected(_customers(spark, d))), axes, axes, a.as_of(), build=DigestEmbedder, settings=Settings(vector_len=4))
    told = made.select("id", F.from_json("data", "embedding array<double>, categories array<string>").alias("d"))
    return told.select("id", F.transform("d.embedding", lambda x: F.round(x, 4)).alias("embedding"), F.col("d.categories").alias("categories"))


@_query(f"WITH {_C} SELECT id, [lower(replace(n_name, ' ', '_'))] AS regions, [upper(n_name[1:3])] AS stock_tickers FROM c WHERE k % 5 <> 0")
def worker_extract(spark, d):
    """Entities of collected items that were not extracted before, normalised."""
    rows = _customers(spark, d)
    table = _union(_collected(rows), _rows(rows.where("k % 5 = 0"), "extracted", regions=F.array(F.lit("done"))))
    names = {r["n_name"]: "country" for r in a.table(spark, d, "nation").select("n_name").limit(1000).collect()}
    made = workers.extract(table, a.as_of(), build=lambda: providers.PatternExtractor(names))
    return made.select("id", F.from_json("data", "regions array<string>, stock_tickers array<string>").alias("d")).select("id", "d.*")


@_query(f"""WITH {_C}, p AS (SELECT id, 'title: ' || c_name || ' created: ' || strftime(created, '%Y-%m-%d') || ' content: ' || c_name || ' of ' || n_name || ' holds $' || upper(n_name[1:3]) || '.' AS lead, k FROM c)
SELECT id, lead || ' Its number is ' || k || '! Third of all.' AS briefing, [lead] AS events FROM p""")
def worker_digest(spark, d):
    """Digests of collected items: the prompt's first sentences, normalised."""
    made = workers.digest(_union(_collected(_customers(spark, d))), a.as_of())
    return made.select("id", F.from_json("data", "briefing string, events array<string>").alias("d")).select("id", "d.*")


@_query("""WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS e, vec_id FROM embeddings),
near AS (SELECT x.id, y.id AS other, row_number() OVER (PARTITION BY x.id ORDER BY list_distance(x.e, y.e), y.id) AS rank FROM v x JOIN v y ON list_distance(x.e, y.e) <= 1.15 WHERE x.vec_id % 4 <> 0)
SELECT id, list_sort(list(other)) AS related FROM near WHERE rank <= 500 GROUP BY id""")
def worker_cluster(spark, d):
    """Related items of those not clustered before, among all that have vectors."""
    v = a.table(spark, d, "embeddings").withColumn("id", F.col("vec_id").cast("string"))
    table = _union(_rows(v, "embedded", embedding=F.col("embedding")), _rows(v.where("vec_id % 4 = 0"), "clustered", related=F.array(F.lit("x"))))
    made = workers.cluster_related(table, a.as_of(), settings=Settings(vector_len=64, cluster_eps=1.15))
    return made.select("id", F.sort_array(F.from_json("data", "related array<string>")["related"]).alias("related"))


@_query("""WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS e, vec_id FROM embeddings),
near AS (SELECT x.id, y.id AS other, row_number() OVER (PARTITION BY x.id ORDER BY list_distance(x.e, y.e), y.id) AS rank FROM v x JOIN v y ON list_distance(x.e, y.e) <= 1.15 WHERE x.vec_id % 4 <> 0)
SELECT id, list_sort(list(other)) AS related FROM near WHERE rank <= 500 GROUP BY id""")
def worker_cluster_indexed(spark, d):
    """The same through a vector index that held those clustered before and takes the others in."""
    v = a.table(spark, d, "embeddings").withColumn("id", F.col("vec_id").cast("string"))
    table = _union(_rows(v, "embedded", embedding=F.col("embedding")), _rows(v.where("vec_id % 4 = 0"), "clustered", related=F.array("id")))
    path = f"{shared_folder(spark)}/cells-{uuid.uuid4().hex}"
    vectorindex.build(v.where("vec_id % 4 = 0"), path, cells=16)
    made = workers.cluster_related(table, a.as_of(), settings=Settings(vector_len=64, cluster_eps=1.15), index=path)
    return made.select("id", F.sort_array(F.from_json("data", "related array<string>")["related"]).alias("related"))


def _served(spark: SparkSession, d: str) -> DataFrame:
    """Customers collected, embedded (every third with a vector of a wrong length), extracted (but every seventh) and digested."""
    rows = _customers(spark, d)
    vec = F.when(F.col("k") % 3 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0.0)))
    more = rows.where("k % 7 <> 0")
    found = _rows(more, "extracted", regions=F.array("n_name", F.lit("")), people=F.array("c_name"), companies=F.array("c_mktsegment", "c_name"))
    return _union(_collected(rows), _rows(rows, "embedded", embedding=vec, categories=F.array(F.lit("topic"))), found, _rows(more, "digested", briefing=F.concat(F.lit("About "), "c_name"), events=F.array("n_name")))


@_query(f"WITH {_C} SELECT id AS url, c_name AS title, created, [n_name] AS regions, [c_name, c_mktsegment] AS entities, ['topic'] AS categories FROM c WHERE k % 3 <> 0 AND k % 7 <> 0 AND k % 10 <> 0")
def worker_port_beans(spark, d):
    """Items with all their states that the store lacks, as its rows."""
    schema = "url string, title string, created timestamp, regions array<string>, entities array<string>, categories array<string>"
    have = _customers(spark, d).where("k % 10 = 0").select(F.col("id").alias("url"), F.lit("old").alias("title"), a.as_of().alias("created"), *[F.array().cast("array<string>").alias(c) for c in ("regions", "entities", "categories")])
    return workers.port_beans(_served(spark, d), spark.createDataFrame([], schema).unionByName(have), a.as_of(), Settings(vector_len=4))["beans"]


@_query(f"""WITH {_C} SELECT id AS url, 'event' AS kind, CAST(created AS DATE) AS ts, 'About ' || c_name AS summary, [n_name] AS key_points,
  list_sort(list_distinct([lower(replace(n_name, ' ', '_')), lower(replace(c_name, '#', '_')), lower(c_mktsegment), 'topic'])) AS tags FROM c WHERE k % 3 <> 0 AND k % 7 <> 0""")
def worker_port_sips(spark, d):
    """Events of digested items: tags of all fields, the digest under its serving names."""
    empty = spark.createDataFrame([], "id string")
    made = workers.port_sips(_served(spark, d), empty, a.as_of(), Settings(vector_len=4))["sips"]
    of = F.from_json("digest", "summary string, key_points array<string>")
    return made.select("url", "kind", "ts", of["summary"].alias("summary"), of["key_points"].alias("key_points"), F.sort_array("tags").alias("tags"))


@_query("""SELECT CAST(user_id AS VARCHAR) || '/' || event_id AS chatter_url, 'http://e.example.org/' || user_id AS url, event_type AS source, ts AS collected, CAST(floor(value) AS BIGINT) AS likes FROM events
WHERE user_id % 6 <> 0 AND floor(value) <> 0""")
def worker_port_chatters(spark, d):
    """Packed snapshots of items, one row each; those already stored, and those that count nothing, are left out."""
    e = a.table(spark, d, "events")
    user = F.col("user_id").cast("string")
    one = F.struct(F.concat(user, F.lit("/"), F.col("event_id").cast("string")).alias("chatter_url"), F.concat(F.lit("http://e.example.org/"), user).alias("url"), F.col("event_type").alias("source"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("collected"), F.floor("value").cast("long").alias("likes"))
    packed = e.groupBy("user_id").agg(F.collect_list(one).alias("chatters")).withColumn("id", F.col("user_id").cast("string"))
    table = _union(_rows(packed, "collected", "chatters", chatters=F.col("chatters")), _rows(packed.where("user_id % 6 = 0"), "stored", "chatters"))
    made = workers.port_chatters(table, a.as_of())["chatters"]
    return made.select("chatter_url", "url", "source", F.col("collected").cast("timestamp_ntz").alias("collected"), "likes")


@_query("SELECT 's' || s_suppkey || '.example.org' AS base_url, s_name AS site_name FROM supplier WHERE s_suppkey % 4 <> 0 AND s_suppkey % 5 <> 0")
def worker_port_publishers(spark, d):
    """Valid publishers that the store lacks."""
    s = a.table(spark, d, "supplier").withColumns({"id": F.concat(F.lit("s"), F.col("s_suppkey").cast("string"), F.lit(".example.org"))})
    table = _union(_rows(s, "collected", "publishers", source=F.when(F.col("s_suppkey") % 5 == 0, "").otherwise("src"), base_url=F.col("id"), site_name=F.col("s_name")))
    have = s.where("s_suppkey % 4 = 0").select(F.col("id").alias("base_url"), F.lit("old").alias("site_name"))
    return workers.port_publishers(table, have, a.as_of())["publishers"].select("base_url", "site_name")


@_query("""WITH s AS (SELECT 'http://s.example.org/' || s_suppkey AS id, s_nationkey AS n, TIMESTAMP '2024-01-01' + to_days(CAST(s_suppkey % 25 AS INTEGER)) AS created, lower(s_name) AS tag FROM supplier),
c AS (SELECT *, (row_number() OVER (PARTITION BY n ORDER BY id) - 1) // 64 AS chunk FROM s QUALIFY count(*) OVER (PARTITION BY n) >= 4)
SELECT CAST(n AS BIGINT) AS nation, count(*) AS members, max(created) AS created, list_sort(list(id)) AS related, list_sort(list_concat(['region ' || n], list(tag))) AS tags FROM c GROUP BY n, chunk HAVING count(*) >= 4""")
def worker_consolidate(spark, d):
    """Composites of the groups of suppliers with equal vectors (one a nation), in chunks of at most 64."""
    s = a.table(spark, d, "supplier").withColumn("id", F.concat(F.lit("http://s.example.org/"), F.col("s_suppkey").cast("string")))
    vec = F.transform(F.sequence(F.lit(0), F.lit(24)), lambda j: F.when(j == F.col("s_nationkey"), 1.0).otherwise(0.0))
    created = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s_suppkey") % 25).cast("int")).cast("timestamp")
    tags = {"regions": F.array(F.concat(F.lit("region "), F.col("s_nationkey").cast("string"))), "entities": F.array(F.lower("s_name"))}
    table = _union(_rows(s, "collected", created=created), _rows(s, "embedded", embedding=vec), _rows(s, "extracted", **tags), _rows(s, "digested", briefing=F.concat("s_name", F.lit("."))), _rows(s, "clustered", related=F.array("id")))
    made = workers.consolidate(table, a.as_of(), settings=Settings(vector_len=25))["composites"]
    of = F.from_json("data", "embedding array<double>, related array<string>, created timestamp, tags array<string>")
    told = made.select(of.alias("d")).select("d.*")
    return told.select((F.array_position("embedding", 1.0) - 1).alias("nation"), F.size("related").cast("long").alias("members"), F.col("created").cast("timestamp_ntz").alias("created"), "related", F.sort_array("tags").alias("tags"))
