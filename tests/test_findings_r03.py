"""Cases that the findings of round 3 showed."""

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from brindle import catalog
from brindle.config import Settings
from brindle.functions import gazetteer, html
from brindle.operators import metricjoin, postings, state, vectorindex
from brindle.plans import workers
from brindle.sources import adapters as a


def test_page_body_keeps_an_unfinished_reference():
    body = "<html><body><article><h1>A &amp;&amp</h1><p>" + "Words of a paragraph, with &amp; and &ampere in it, that is long enough. " * 3 + "</p></article></body></html>"
    content = html.to_page(body, 1)["content"]
    assert content.startswith("# A &&amp\n") and "with & and &ampere in" in content
    ld = '<script type="application/ld+json">{"@type": "Article", "headline": "A & B &amp"}</script>'
    assert html.to_json_ld(f"<html><head>{ld}</head><body>&lt</body></html>")["title"] == "A & B &amp"


def test_letters_of_text_and_markdown_keep_an_unfinished_reference(spark):
    page = '<html><body><p>This &amp;&amp</p><a href="/x?a=1&amp;b=2&c">that &quot</a></body></html>'
    row = spark.createDataFrame([(page,)], "html string").select(html.strip_tags("html").alias("t"), html.markdown("html").alias("m")).first()
    assert row["t"] == "This &&amp that &quot" and row["m"] == "This &&amp\n\n[that &quot](/x?a=1&b=2&c)"


def test_metadata_as_written(spark):
    page = '<!DOCTYPE html><html lang="en"><head><title>A &amp; B = &quot;c &amp</title><meta name="author" content="D &amp; E"></head><body>x</body></html>'
    df = spark.createDataFrame([(page,)], "html string")
    row = df.select(html.metadata("html").alias("m"), html.metadata("html", written=True).alias("w")).first()
    assert (row["m"]["title"], row["m"]["author"]) == ('A & B = "c &amp', "D & E")
    assert (row["w"]["title"], row["w"]["author"], row["w"]["language"]) == ("A &amp; B = &quot;c &amp", "D &amp; E", "en")


def _agrees(spark, tmp_path, name: str, tables: dict) -> None:
    """The query's rows are those of its SQL over these tables."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t, df in tables.items():
        df.write.parquet(f"{tmp_path}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = catalog.QUERIES[name](spark, str(tmp_path))
    cur = con.execute(catalog.ORACLES[name])
    names = [x[0] for x in cur.description]
    assert sorted(df.select(*names).collect(), key=repr) == sorted((Row(*r) for r in cur.fetchall()), key=repr)


def test_title_letters_agree_with_sql(spark, tmp_path):
    page = '<!DOCTYPE html><html lang="en"><head><title>{}</title></head><body>x</body></html>'
    rows = [(k, "http://a.example.org/", page.format(t)) for k, t in enumerate(["A &amp; B&amp", "be token = &quot;7c", "It&#x27;s &lt;b&gt;", "Å plain"])]
    _agrees(spark, tmp_path, "page_metadata", {"pages": spark.createDataFrame(rows, "page_id long, url string, html string")})


def test_page_letters_agree_with_sql_whatever_references_are_written(spark, tmp_path):
    page = '<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title></head><body><p>{}</p></body></html>'
    texts = ["It&#x27;s a &lt;b&gt;", "caf&eacute; &Eacute;t&eacute;", "&frac12; of &nosuch; it", "cut &am", "&amp;lt; twice", '<a href="/x_(y)?a=1&amp;b=2">that</a> <img src="/i.png" alt="words"> [it](literal) end']
    rows = [(k, "http://a.example.org/", page.format(t)) for k, t in enumerate(texts)] + [(99, "http://b.example.org/", page.format("a line break follows") + "\n")]
    _agrees(spark, tmp_path, "page_letters", {"pages": spark.createDataFrame(rows, "page_id long, url string, html string")})


def test_a_worker_takes_its_whole_queue(spark, monkeypatch):
    """Workers are not limited unless the settings say so; a set limit takes the first by time and id."""
    asked = []
    paged = state._paged
    monkeypatch.setattr(state, "_paged", lambda df, limit, offset: asked.append(limit) or paged(df, limit, offset))
    rows = [("beans", f"i{k}", s, f'{{"title": "t{k}", "content": "One of {k}. Two.", "url": "i{k}", "created": "2024-01-01"}}') for k in range(5) for s in ("collected", "embedded", "extracted", "digested")]
    table = spark.createDataFrame(rows, "object_type string, id string, state string, data string").withColumn("ts", a.as_of()).select("object_type", "id", "state", "ts", "data")
    queue = table.where("state = 'collected'")
    assert workers.digest(queue, a.as_of()).count() == 5
    workers.extract(queue, a.as_of())
    workers.port_sips(table, spark.createDataFrame([], "id string"), a.as_of())
    assert not any(asked)
    few = workers.digest(queue, a.as_of(), settings=Settings(processing_limit=2))
    assert sorted(r["id"] for r in few.collect()) == ["i0", "i1"]


def _unclustered(spark, n: int, size: int = 32):
    rng = np.random.default_rng(3)
    return spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rng.normal(size=(n, size)))], "id long, embedding array<double>")


def test_recall_holds_however_many_cells_there_are(spark, tmp_path):
    v = _unclustered(spark, 3000)
    vectorindex.build(v, f"{tmp_path}/x", cells=8, split_rows=60)
    asked = v.where("id % 20 = 0").select(F.col("id").alias("query"), "embedding")
    whole = {(r["query"], r["id"]) for r in vectorindex.topk(spark, f"{tmp_path}/x", asked, k=10, exact=True).collect()}
    share = lambda **more: len(whole & {(r["query"], r["id"]) for r in vectorindex.topk(spark, f"{tmp_path}/x", asked, k=10, probe=4, **more).collect()}) / len(whole)
    assert share() < 0.9 <= share(recall=0.9)


def test_a_split_sends_centres_to_the_driver_and_no_rows(spark, tmp_path, monkeypatch):
    sizes = []
    kind = type(spark.range(1))
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: sizes.append(len(got := collect(df))) or got)
    made = vectorindex.build(_unclustered(spark, 3000, 8), f"{tmp_path}/x", cells=4, sample_rows=50, split_rows=300)
    assert made["rows"] == 3000 and made["cells"] > 8 and max(sizes) <= 50


def test_a_large_table_of_names_is_joined_and_not_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a b c a b"), (2, None), (3, "c d")], "id int, text string")
    names = spark.createDataFrame([(x, x, "pair") for x in ("a b", "b c", "c", "d", "b c a", "-")], "alias string, name string, field string")
    few = {o: gazetteer.find(df, names, overlapping=o).collect() for o in (False, True)}
    monkeypatch.setattr(gazetteer, "MOST", 2)
    monkeypatch.setattr(spark.sparkContext, "broadcast", None)
    key = lambda rows: {r["id"]: sorted(r["entities"]) for r in rows}
    for o, rows in few.items():
        assert key(rows) == key(gazetteer.find(df, names, overlapping=o).collect())


def test_rows_of_a_large_leaf_are_sent_a_bounded_number_of_times(spark):
    """However small the blocks are asked to be, a row is copied at most SPREAD times; pairs are those of brute force, far from the origin too."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(700, 16)) + np.where(np.arange(700) % 7 == 0, 1e5, 0)[:, None]
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, embedding array<double>")
    (own,) = metricjoin.joins(df, 4.4, block=4)
    blocks = {r["leaf"]: r["blocks"] for r in own.report().collect()}
    assert own._copies(blocks).count() <= own.members.count() * metricjoin.SPREAD
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    got = own.pairs().collect()
    assert sorted((r["a"], r["b"]) for r in got) == [(i, j) for i, j in zip(*map(lambda x: x.tolist(), np.nonzero(d <= 4.4))) if i < j] and len(got) > 700
    assert max(abs(r["distance"] - d[r["a"], r["b"]]) for r in got) < 1e-12


def test_pairs_are_searched_for_once(spark, tmp_path, monkeypatch):
    """Edges in both directions come from one reading of the pairs, and a plan that uses them twice reads what was written."""
    from brindle.operators import cluster, graph

    rng = np.random.default_rng(6)
    rows = [(k, (x / np.linalg.norm(x)).tolist(), k % 3) for k, x in enumerate(rng.normal(size=(120, 6)))]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long").write.parquet(f"{tmp_path}/embeddings.parquet")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    once, kept = a.related(spark, str(tmp_path)), a.related(spark, str(tmp_path), kept=True)
    assert plan(once).count("FlatMapGroupsInArrow") == 1 and plan(kept).count("FlatMapGroupsInArrow") == 0
    assert sorted(once.collect()) == sorted(kept.collect()) and once.count() > 120
    v = a.vectors(spark, str(tmp_path))
    assert plan(cluster.related(v, a.NEAR)).count("FlatMapGroupsInArrow") == 1
    e = spark.createDataFrame([("a", "b", 1), ("b", "a", 2), ("c", "c", 3), (None, "a", 4)], "url string, related_url string, n int")
    assert sorted(graph.both_ways(e.where("n < 3"), "url", "related_url").collect()) == [("a", "b", 1), ("a", "b", 2), ("b", "a", 1), ("b", "a", 2)]
    assert sorted(graph.symmetric(e).collect()) == [("a", "b"), ("b", "a")]


def test_pages_come_in_small_batches(spark):
    """However many long pages there are, a task's batch is of some megabytes."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(64 << 20))
        html.page(F.col("html"))
        assert int(spark.conf.get(key)) == 4 << 20
        spark.conf.set(key, "1000")
        html.strip_tags(F.col("html"))
        assert spark.conf.get(key) == "1000"
    finally:
        spark.conf.set(key, before)


def test_a_block_of_queries_meets_few_vectors_at_a_time(spark):
    import pyarrow as pa

    from brindle.operators import search

    batch = pa.RecordBatch.from_pydict({"id": list(range(10_000))})
    parts = list(search._few([batch, batch.slice(0, 0), batch.slice(0, 5)]))
    assert max(p.num_rows for p in parts) <= 2048 and [x for p in parts for x in p.column(0).to_pylist()] == [*range(10_000), *range(5)]
    v = _unclustered(spark, 5000, 4).coalesce(1)
    asked = v.where("id < 9").withColumnRenamed("id", "query")
    got = [(r["query"], r["id"]) for r in sorted(search.batch_topk(v, asked, k=3, metric="l2").collect(), key=lambda r: (r["query"], r["rank"]))]
    m = np.array([r["embedding"] for r in v.orderBy("id").collect()])
    assert got == [(k, int(j)) for k in range(9) for j in np.argsort(((m - m[k]) ** 2).sum(1), kind="stable")[:3]]


def test_a_scrape_join_keeps_its_partitions(spark):
    """Texts that compress well are not put together in one task."""
    from brindle.operators import ingest

    beans = spark.range(400).select(F.concat(F.lit("u"), "id").alias("url"), F.repeat(F.lit("word "), 300).alias("content"), F.lit("t").alias("title"))
    made = ingest.merge_scraped(beans, beans.select("url", F.repeat(F.lit("word "), 400).alias("content")), a.as_of())
    assert made.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and made.where("content_length = 400").count() == 400


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_many_queries_within_a_distance_are_joined_not_collected(spark, tmp_path, monkeypatch, metric):
    """More queries than a block take no block of their own, and find what blocks of queries find: equal vectors, ties at the k-th, queries without a vector."""
    v = _unclustered(spark, 900, 4).unionByName(spark.createDataFrame([(900 + k, [1.0, 0.5, 0.0, 0.0]) for k in range(40)], "id long, embedding array<double>"))
    vectorindex.build(v, f"{tmp_path}/x", cells=6, metric=metric)
    asked = v.select(F.col("id").alias("query"), "embedding").unionByName(spark.createDataFrame([(-1, None), (-2, [0.0] * 4), (-3, [float("nan")] * 4), (-4, [9.0] * 4)], "query long, embedding array<double>"))
    find = lambda: {(r["query"], r["id"], r["rank"], round(r["distance"], 6)) for r in vectorindex.topk(spark, f"{tmp_path}/x", asked, k=7, distance=0.3, exact=True).collect()}
    whole = find()
    monkeypatch.setattr(vectorindex, "QUERIES", 100)
    monkeypatch.setattr(vectorindex, "BLOCK", 200)
    monkeypatch.setattr(vectorindex, "MOST", 150)
    monkeypatch.setattr(vectorindex, "_searched", None)
    assert find() == whole and len(whole) > 900


@pytest.mark.parametrize("mode", ["all", "any"])
def test_postings_meet_queries_in_deals(spark, tmp_path, monkeypatch, mode):
    """A block goes once to a deal of queries, however many ask for its token; deals, chunks and batches of hits change nothing."""
    for name, value in (("QUERIES", 5), ("SPREAD", 3), ("TOLD", 7)):
        monkeypatch.setattr(postings, name, value)
    rng = np.random.default_rng(5)
    lists = {k: sorted({f"w{x}" for x in rng.integers(0, 6, 3)}) for k in range(0, 200_000, 4_000)}
    docs = spark.createDataFrame(list(lists.items()), "id long, tokens array<string>")
    index = postings.Postings.create(spark, f"{tmp_path}/p", rows=200_000, span=200_000)
    for part in ("id % 8000 = 0", "id % 8000 <> 0", "id < 40000"):  # some rows come again
        index.add(docs.where(part), id_col="id", tokens_col="tokens")
    asked = {q: t for q, t in enumerate(lists.values())} | {100: ["w1", "none"], 101: [], 102: None}
    found = index.search(spark.createDataFrame(list(asked.items()), "query long, tokens array<string>"), mode=mode).collect()
    fits = all if mode == "all" else any
    assert sorted(map(tuple, found)) == sorted((q, k) for q, t in asked.items() if t for k, own in lists.items() if fits(x in own for x in t))


def test_parts_of_many_texts_are_segmented_together(monkeypatch):
    from brindle.llm import pieces

    rng = np.random.default_rng(5)
    some = {"".join(rng.choice(list("abcdé"), n)) for n in rng.integers(2, 7, 150)}
    # scores of eighths tie often, and a tie keeps the longest last piece
    vocabulary = [("<unk>", 0.0, "unknown"), *((c, -float(k % 3) - 4, "normal") for k, c in enumerate("abcdé▁")), *((t, -float(rng.integers(8, 40)) / 8, "normal") for t in sorted(some)), ("▁ab", -1.0, "normal"), ("▁▁", -2.0, "normal")]
    words = ["".join(rng.choice(list("abcdé"), n)) for n in rng.integers(1, 40, 3000)]
    texts = [" ".join(words[lo : lo + 30]) for lo in range(0, 3000, 30)] + ["", None, " a  b ", "x", "ab xb a", "a" * 500 + " b", "abc\n\nab", "d" * 64 + " " + "d" * 65]
    plain = pieces.PieceModel(vocabulary)
    want = [None if t is None else plain.segment("▁" + t.replace(" ", "▁")) if t else [] for t in texts]
    alone = []
    segment = pieces.PieceModel.segment
    monkeypatch.setattr(pieces.PieceModel, "segment", lambda self, text: alone.append(text) or segment(self, text))
    monkeypatch.setattr(pieces, "MEMO", 500)  # both generations change hands
    model = pieces.PieceModel(vocabulary)
    got = [ids for lo in range(0, len(texts), 20) for ids in model.encode_all(texts[lo : lo + 20])]
    assert [None if ids is None else ids.tolist() for ids in got] == want
    assert all(len(part) > pieces.SHORT or not set(part) <= set("abcdé▁") for part in alone)  # the others went together


@pytest.mark.parametrize("block", [64, 4096])
def test_neighbours_and_links_are_those_of_all_pairs(spark, block):
    rng = np.random.default_rng(8)
    v = np.concatenate([rng.normal(0, 0.3, (250, 3)), rng.normal(2, 0.5, (250, 3)), rng.uniform(-3, 5, (200, 3))])  # dense, looser and scattered
    weight = rng.integers(1, 4, len(v))
    df = spark.createDataFrame([(3 * k, x.tolist(), int(w)) for k, (x, w) in enumerate(zip(v, weight, strict=True))], "id long, embedding array<double>, n long")
    near = np.sqrt(((v[:, None] - v[None]) ** 2).sum(2)) <= 0.5
    np.fill_diagonal(near, False)
    more, enough = near @ weight, 9
    core = more + weight >= enough
    (join,) = metricjoin.joins(df, 0.5, sample_rows=200, block=block, keep=("n",))
    parts = join.neighbours("n", enough)
    got = {r.id // 3: r.more for r in parts.groupBy("id").agg(F.sum("more").alias("more")).collect()}
    for k in range(len(v)):
        assert got.get(k, 0) == more[k] if not core[k] else enough <= got.get(k, 0) + weight[k] and got.get(k, 0) <= more[k]

    flags = df.join(spark.createDataFrame([(3 * k, bool(c)) for k, c in enumerate(core)], "id long, core boolean"), "id")
    (join,) = metricjoin.joins(flags, 0.5, sample_rows=200, block=block, keep=("core",))
    links = join.links("core").collect()
    inner = [(r.src // 3, r.dst // 3) for r in links if r.inner]
    border = {(r.src // 3, r.dst // 3) for r in links if not r.inner}
    part = np.arange(len(v))

    def root(k):
        while part[k] != k:
            k = part[k]
        return k

    for a, b in inner:
        assert core[a] and core[b]
        part[root(a)] = root(b)
    of = np.array([root(k) for k in range(len(v))])
    reach = near[np.ix_(core, core)] | np.eye(core.sum(), dtype=bool)
    while True:  # what all pairs of cores join up
        wider = (reach.astype(int) @ reach.astype(int)) > 0
        if (wider == reach).all():
            break
        reach = wider
    assert ((of[core][:, None] == of[core][None]) == reach).all()
    assert {(a, of[b]) for a, b in border} == {(a, of[b]) for a, b in np.argwhere(near) if core[b] and not core[a]}
    copies = join._copies({r["leaf"]: r["blocks"] for r in join._sizes().collect()}).count()
    assert len(inner) < copies < near.sum() / 2 or block == 64  # not a link for each pair


def test_dbscan_hands_on_no_pairs(spark, monkeypatch):
    from brindle.operators import cluster

    def refuse(self):
        raise AssertionError("pairs leave their tasks")

    monkeypatch.setattr(metricjoin.RadiusJoin, "pairs", refuse)
    rows = [(k, [0.001 * k, 0.0]) for k in range(400)]  # all pairs within eps
    rows += [(500, [1.2, 0.0]), (501, [9.0, 9.0]), (502, None), (503, [float("nan"), 0.0]), (504, [0.0, 0.0]), (505, [0.0, 0.0, 0.0])]
    got = {r.id: (r.cluster, r.core) for r in cluster.dbscan(spark.createDataFrame(rows, "id long, embedding array<double>"), 0.802, 4).collect()}
    assert all(got[k] == (0, True) for k in range(400)) and got[504] == (0, True)
    assert got[500] == (0, False)  # within eps of two cores
    assert [got[k] for k in (501, 502, 503, 505)] == [(k, False) for k in (501, 502, 503, 505)]
