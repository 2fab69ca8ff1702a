"""Structures that are kept and grow: postings, the vector index, and the metric join's partitions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import cluster, metricjoin, search, vectorindex
from brindle.operators.postings import Postings, coded, decoded


def test_gap_codes():
    for x in ([], [0], [127, 128], [0, 1, 2**14 - 1, 2**14, 2**35, 2**62]):
        assert decoded(coded(np.array(x, np.int64))).tolist() == x
    draw = np.random.default_rng(1)
    x = draw.integers(0, 2 ** draw.integers(1, 62, 5000))
    assert (decoded(coded(x)) == x).all()


TAGGED = [(i * 3 - 50, ["hot"] * (i % 3 == 0) + [f"t{random.Random(i * 7 + j).randint(0, 30)}" for j in range(5)]) for i in range(1500)]
TAGGED += [(1, None), (None, ["hot"]), (2, []), (4, [None, "hot"]), (10, ["hot"]), (10, ["hot", "x"]), (10, ["hot", "x"])]


@pytest.fixture(scope="module")
def postings(spark, tmp_path_factory):
    df = spark.createDataFrame(TAGGED, "id long, tags array<string>")
    index = Postings.create(spark, str(tmp_path_factory.mktemp("index") / "tags"), rows=1500, span=4500, buckets=8)
    index.shift = 8  # many chunks
    for part in ("id % 2 = 0 or id is null", "id % 2 <> 0", "id < 20"):
        index.add(df.where(part), id_col="id", tokens_col="tags")
    return index


@pytest.mark.parametrize("mode", ["all", "any"])
@pytest.mark.parametrize("pushed", [1000, 2])
def test_postings_equal_the_scan(spark, postings, mode, pushed, monkeypatch):
    from brindle.operators import postings as module

    monkeypatch.setattr(module, "PUSHED", pushed)
    draw = random.Random(5)
    queries = [(k, draw.sample(["hot", "none", "x", *(f"t{j}" for j in range(31))], draw.randint(1, 3))) for k in range(40)] + [(100, []), (101, None), (102, [None, "hot"]), (103, ["hot", "hot"])]
    got = sorted(map(tuple, postings.search(spark.createDataFrame(queries, "query int, tokens array<string>"), mode=mode).collect()))
    every = all if mode == "all" else any
    have: dict = {}
    for i, tags in TAGGED:
        have.setdefault(i, set()).update(tags or ())  # rows of one id are one
    want = {(k, i) for k, ts in queries if ts for i, tags in have.items() if i is not None and every(t in tags for t in ts if t)}
    assert got == sorted(want) and len(got) > 500


def test_postings_read_what_is_asked_for(spark, postings):
    """The scan names the folders and tokens, and rows of other tokens never leave it."""
    one = spark.createDataFrame([(0, ["hot", "x"])], "query int, tokens array<string>")
    plan = postings.search(one)._jdf.queryExecution().executedPlan().toString()
    assert "token" in plan and "IN (" in plan and "bucket" in plan
    df = spark.createDataFrame(TAGGED, "id long, tags array<string>")
    found = postings.rows(df, ["hot", "x"], id_col="id")
    assert sorted(r.id for r in found.collect()) == [10] * 4  # the table's own rows of that id
    n = {r.token: r.n for r in postings.dictionary().collect()}
    assert n["x"] == 2 and n["t0"] > 0 and None not in n  # once for each batch that it was in


def test_postings_of_unfinished_batches_do_not_count(spark, postings, tmp_path):
    df = spark.createDataFrame([(1, ["a"]), (2, ["a", "b"])], "id long, tags array<string>")
    index = Postings.of(df, str(tmp_path / "few"), id_col="id", tokens_col="tags", buckets=2)
    blocks = spark.read.parquet(f"{index.path}/blocks").drop("batch")
    blocks.write.partitionBy("bucket").parquet(f"{index.path}/blocks/batch=torn")
    one = spark.createDataFrame([("q", ["a"])], "query string, tokens array<string>")
    assert sorted(r.id for r in index.search(one).collect()) == [1, 2]
    index.vacuum()
    assert not (tmp_path / "few" / "blocks" / "batch=torn").exists()
    assert sorted(r.id for r in index.search(one).collect()) == [1, 2]
    empty = Postings.of(df.limit(0), str(tmp_path / "none"), id_col="id", tokens_col="tags")
    assert empty.search(one).count() == 0 and empty.search(one, mode="any").count() == 0


def test_a_vector_index_that_grows(spark, tmp_path, monkeypatch):
    """Batches, cells that split, a cell of equal vectors that cannot, a failed batch and old folders: exact search is brute force throughout, a few cells reach 0.9."""
    monkeypatch.setattr(vectorindex, "QUERIES", 40)
    rng = np.random.default_rng(7)
    middles = rng.normal(size=(10, 12)) * 3
    rows = [(k, (middles[k % 10 if k % 3 else 0] + rng.normal(size=12)).astype(np.float32).tolist()) for k in range(1200)]
    rows += [(2000 + k, [9.0] * 12) for k in range(150)] + [(3000, None), (3001, [1.0]), (3002, [None] * 12), (3003, [float("nan")] * 12)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>").repartition(3)
    path = str(tmp_path / "index")
    vectorindex.build(v.where("id < 400"), path, cells=6, split_rows=100)
    for part in ("id between 400 and 799", "id between 800 and 1999", "id >= 2000"):
        said = vectorindex.add(spark, path, v.where(part), split_rows=100)
    assert said["rows"] == 1350 and said["skipped"] == 4
    state = vectorindex._State(spark, path)
    assert said["cells"] == len(state.cells) > 12 and all(x["n"] <= 100 or x["whole"] for x in state.cells.values()) and any(x["whole"] for x in state.cells.values())
    q = v.where("id % 20 = 0").select(F.col("id").alias("query"), "embedding")
    tell = lambda d: {(r.query, r.rank): (r.id, round(r.distance, 4)) for r in d.collect()}
    want = tell(search.batch_topk(v.where("id < 3000"), q.where("query < 3000"), k=5, metric="l2"))
    plan = vectorindex.topk(spark, path, q.limit(1), k=5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("Scan parquet")[-1]  # nothing is shuffled between the stored vectors and their search
    assert tell(vectorindex.topk(spark, path, q, k=5, probe=1, exact=True)) == want
    near = tell(vectorindex.topk(spark, path, q, k=5, probe=6))
    assert len({(a, i) for (a, _), (i, _) in near.items()} & {(a, i) for (a, _), (i, _) in want.items()}) >= 0.9 * len(want)
    assert all(abs(d - want[at][1]) < 1e-3 for at, (i, d) in near.items() if want[at][0] == i)  # distances are exact, not those of the codes
    within = tell(vectorindex.topk(spark, path, q, k=500, exact=True, distance=2.5))
    assert within == tell(search.batch_topk(v.where("id < 3000"), q.where("query < 3000"), k=500, metric="l2", distance=2.5))
    (tmp_path / "index" / "rows" / "batch=torn").mkdir()
    (tmp_path / "index" / "cells" / "v=99").mkdir()  # not finished: no _SUCCESS
    vectorindex.vacuum(spark, path)
    assert not (tmp_path / "index" / "rows" / "batch=torn").exists() and len(list((tmp_path / "index" / "cells").iterdir())) == 1
    assert tell(vectorindex.topk(spark, path, q, k=5, probe=1, exact=True)) == want


def test_related_items_of_a_batch(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=4).astype(np.float32).tolist()) for k in range(200)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>")
    vectorindex.build(v.where("id < 150"), str(tmp_path / "i"), cells=8)
    one = {r.id: r.related for r in cluster.related_to(v.where("id < 150"), v.where("id >= 150"), 0.8).collect()}
    for _ in range(2):  # a batch that comes again changes nothing
        assert one == {r.id: r.related for r in cluster.related_through(str(tmp_path / "i"), v.where("id >= 150"), 0.8).collect()}
    assert sorted(r.id for r in vectorindex.known(spark, str(tmp_path / "i"), spark.createDataFrame([(3,), (160,), (999,)], "id long")).collect()) == [3, 160]
    moved = v.where("id >= 150").select("id", F.transform("embedding", lambda x: x + 50).alias("embedding"))
    again = {r.id: r.related for r in cluster.related_to(v, moved, 0.8).collect()}
    assert all(set(x) <= set(range(150, 200)) for x in again.values())  # an id in both goes by the batch's vector


@pytest.mark.parametrize("eps", [0.05, 0.6, 3.0, 50.0])
@pytest.mark.parametrize("block", [2048, 16])
def test_metric_join_is_brute_force(spark, eps, block):
    """Each pair once, whatever the distance; a dense region and equal vectors are cut into blocks."""
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 4, (90, 3)), rng.normal(0, 0.05, (60, 3)), np.ones((20, 3)), rng.normal(0, 4, (40, 3)) * [30, 0.1, 0.1]]).astype(np.float32)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)] + [(900, None), (901, [float("nan"), 0.0, 0.0]), (902, [None, 0.0, 0.0])], "id long, embedding array<float>").repartition(4)
    (own,) = metricjoin.joins(df, eps, block=block)
    got = own.pairs().collect()
    d = np.sqrt(((v[:, None].astype(float) - v[None, :].astype(float)) ** 2).sum(-1))
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if d[i, j] <= eps}
    assert len(got) == len(want) and {(r.a, r.b) for r in got} == want
    assert all(abs(r.distance - d[r.a, r.b]) < 1e-5 for r in got)
    told = own.report().collect()
    assert sum(r.home for r in told) == len(v)
    if block == 16 and eps < 1:
        assert own.tree.leaves > 4 and sum(r.compared for r in told) < len(v) ** 2 / 4  # planes prune
    if eps == 50.0:
        assert sum(r.guests for r in told) < len(v)  # and make no copies where they cannot


def test_an_eps_that_is_large_in_one_direction_only(spark):
    """A long thin cloud: the distance is far over its width and far under its length."""
    rng = np.random.default_rng(8)
    v = (rng.normal(size=(600, 4)) * [200, 1, 1, 1]).astype(np.float32)
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "id long, embedding array<float>")
    (own,) = metricjoin.joins(df, 8.0, block=32)
    told = own.report().collect()
    assert sum(r.compared for r in told) < 600 * 600 / 8
    d = np.sqrt(((v[:, None].astype(float) - v[None, :].astype(float)) ** 2).sum(-1))
    assert own.pairs().count() == ((d <= 8).sum() - 600) // 2


def test_dbscan_of_equal_vectors(spark):
    """Copies are one point of their weight: cores by themselves, and no pairs of copies."""
    rows = [(k, [0.0, 0.0]) for k in range(10, 500)] + [(1, [0.3, 0.0]), (2, [5.0, 5.0]), (3, [5.0, 5.0]), (4, None), (5, [float("nan"), 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    got = {r.id: (r.cluster, r.core) for r in cluster.dbscan(df, 0.5, 4).collect()}
    assert all(got[k] == (10 if k >= 10 else 1, True) or got[k] == (1, True) for k in [*range(10, 500), 1])
    assert got[1] == (1, True) and got[2] == (2, False) and got[3] == (3, False) and got[4] == (4, False) and got[5] == (5, False)


def test_means_and_medians(spark):
    rows = [(1, [1.0, 5.0]), (1, [3.0, 1.0]), (1, [8.0]), (2, [2.0]), (2, []), (3, None), (None, [4.0])]
    df = spark.createDataFrame(rows, "g int, embedding array<float>")
    assert {r.g: r.embedding for r in search.mean_vector(df, "g").collect()} == {1: [4.0, 3.0], 2: [2.0], None: [4.0]}
    assert {r.g: r.embedding for r in search.median_vector(df, "g").collect()} == {1: [3.0, 3.0], 2: [2.0], None: [4.0]}
    assert search.mean_vector(df.where("g = 3"), "g").count() == 0


def test_parts_change_together_or_not_at_all(spark, tmp_path):
    from brindle.operators.parted import Change, Parted

    tables = {"a": ("k", "k long, v string"), "b": ("k", "k long")}
    path = str(tmp_path / "p")
    store = Parted(spark, path, tables, parts=4)
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit("one").alias("v"))
    store.commit({"a": Change(rows), "b": Change(rows)})
    part = store.touched(rows.where("k = 3").select("k"))
    kept = {p: f for (n, p), f in store.folders.items() if n == "a" and p not in part}
    store.commit({"a": Change(store.read("a", part).where("k <> 3").withColumn("v", F.lit("two")), part)})  # reads what it replaces
    assert {r.k: r.v for r in Parted(spark, path, tables).read("a").collect()} == {k: "two" if [p] == part else "one" for k in range(20) if k != 3 for p in store.touched(spark.createDataFrame([(k,)], "k long"))}
    assert {p: f for (n, p), f in store.folders.items() if n == "a" and p not in part} == kept
    with pytest.raises(ValueError):
        store.commit({"b": Change(rows), "a": Change(rows, part)})  # rows outside the replaced part: nothing of it counts
    again = Parted(spark, path, tables)
    assert again.read("b").count() == 20 and again.read("a").count() == 19
    store.commit({"a": Change(rows.limit(0), part)})
    store.vacuum()
    assert Parted(spark, path, tables).read("a", part).count() == 0 and Parted(spark, path, tables).read("a").where("v = 'one'").count() == store.read("a").count() > 0


def test_refreshed_trends_equal_the_rebuild(spark, tmp_path):
    """Three batches of snapshots, edges and items: the table is the full rebuild after each, and only parts of touched items are written."""
    from brindle.operators import trend
    from brindle.operators.trendstore import TrendStore

    draw = random.Random(11)
    at = lambda k: f"2024-01-{1 + k % 28:02d} 0{k % 10}:00:00"
    beans = spark.createDataFrame([(f"u{k}", at(k)) for k in range(60)], "url string, created string").withColumn("created", F.col("created").cast("timestamp"))
    talk = [(f"c{draw.randint(0, 40)}", f"u{draw.randint(0, 70)}", at(draw.randint(0, 27)), draw.randint(0, 5), draw.randint(0, 3), draw.randint(0, 9), draw.randint(0, 2)) for _ in range(400)]
    talk += [("c1", "u1", at(3), None, 2, 1, 1), (None, "u2", at(1), 9, 9, 9, 9), ("c2", None, at(2), 5, 5, 5, 5), talk[0]]
    chatters = spark.createDataFrame(talk, "chatter_url string, url string, collected string, likes long, comments long, subscribers long, shares long").withColumn("collected", F.col("collected").cast("timestamp")).withColumn("n", F.monotonically_increasing_id())
    chatters = spark.createDataFrame(chatters.collect(), chatters.schema)
    edges = spark.createDataFrame([(f"u{draw.randint(0, 59)}", f"u{draw.randint(0, 59)}") for _ in range(90)], "url string, related_url string")
    as_of = F.lit("2024-02-01").cast("timestamp")
    store = TrendStore(spark, str(tmp_path / "t"), parts=16)
    seen_c, seen_e, seen_b = chatters.limit(0), edges.limit(0), beans.limit(0)
    for c, e, b in ((chatters.where("n % 3 = 0"), edges.where("url < 'u3'"), beans.where("url < 'u4'")), (chatters.where("n % 3 = 1"), edges.where("url >= 'u3'"), beans.where("url >= 'u4'")), (chatters.where("n % 3 = 2 and chatter_url in ('c1', 'c2')"), None, None)):
        before = {k: v for k, v in store.store.folders.items() if k[0] == "trends"}
        parts = store.refresh(c, e, b)
        seen_c = seen_c.unionByName(c)
        seen_e, seen_b = (seen_e.unionByName(e), seen_b.unionByName(b)) if e is not None else (seen_e, seen_b)
        want = trend.trend_aggregates(seen_b, seen_c.where("chatter_url is not null"), seen_e, as_of)
        columns = want.columns
        assert sorted(map(tuple, store.trends(as_of).select(*columns).collect())) == sorted(map(tuple, want.collect()))
        after = {k: v for k, v in store.store.folders.items() if k[0] == "trends"}
        assert {k[1] for k in before.keys() | after.keys() if before.get(k) != after.get(k)} <= set(parts)
    assert 0 < len(parts) < 16 and store.refresh() == []
    reopened = TrendStore(spark, str(tmp_path / "t"))
    assert reopened.trends(as_of).count() == want.count()


def test_backups_are_checked_before_they_replace_anything(spark, tmp_path):
    from brindle.operators import backup

    one, two, folder = str(tmp_path / "one"), str(tmp_path / "two"), str(tmp_path / "kept")
    rows = spark.range(50).select("id", F.array(F.col("id"), F.lit(None)).alias("v"), F.create_map(F.lit("k"), F.col("id")).alias("m"), F.when(F.col("id") % 2 == 0, "x").alias("s"))
    rows.repartition(3).write.parquet(one)
    rows.limit(0).write.parquet(two)
    assert backup.stamps(spark, folder) == []
    for stamp in ("2024-01-01", "2024-01-02", "2024-01-03"):
        backup.take(spark, {"one": one, "two": two}, folder, stamp)
    (tmp_path / "kept" / "2024-01-04" / "one").mkdir(parents=True)  # without a note it is none
    assert backup.stamps(spark, folder) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert backup.prune(spark, folder, 2) == ["2024-01-01"] and backup.prune(spark, folder, 2) == []
    rows.where("id < 5").write.mode("overwrite").parquet(one)
    spark.catalog.clearCache()
    with pytest.raises(backup.Damaged):
        backup.restore(spark, f"{folder}/2024-01-03", {"one": one, "three": str(tmp_path / "three")})
    rows.where("id <> 7").union(rows.where("id = 8")).write.mode("overwrite").parquet(f"{folder}/2024-01-02/one")
    with pytest.raises(backup.Damaged):
        backup.restore(spark, f"{folder}/2024-01-02", {"one": one})
    assert spark.read.parquet(one).count() == 5
    backup.restore(spark, f"{folder}/2024-01-03", {"one": one, "two": two})
    assert backup.fingerprint(spark.read.parquet(one)) == backup.fingerprint(rows) and spark.read.parquet(two).count() == 0
    assert spark.read.parquet(one).dtypes == rows.dtypes
