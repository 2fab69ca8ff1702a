"""Findings of round 4."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle import catalog_stores
from brindle.functions import gazetteer
from brindle.operators import vectorindex


@pytest.mark.parametrize("most", [2, 500_000])
def test_tallies_move_no_texts_and_no_finds(spark, monkeypatch, most):
    """many phrases were joined by writing every text out and sending every find back with its names."""
    monkeypatch.setattr(gazetteer, "MOST", most)
    monkeypatch.setattr(gazetteer, "STRETCH", 20)
    monkeypatch.setattr(gazetteer, "cut", None)
    rows = [(1, "a b a b c"), (1, "A, b! a"), (2, None), (3, ""), (4, "c d e c d"), (None, "b c a b"), (5, "x y"), (6, "É b c d é b"), (7, "a")] + [(8, "a b " * 30)]
    phrases = ["a b", "A  b", "b c", "c d e", "d", "é b", "zz", "", None]
    texts = spark.createDataFrame(rows, "id long, text string")
    paths = {tuple(gazetteer.tokens(x)) for x in phrases if x} - {()}
    want: dict = {}
    for key, text in rows:
        own = gazetteer.tokens(text)
        for p in paths:
            for at in range(len(own) - len(p) + 1):
                if tuple(own[at : at + len(p)]) == p:
                    want.setdefault(key, []).append((p, at))
    got = {tuple(r) for r in gazetteer.tallies(texts, spark.createDataFrame([(x,) for x in phrases], "alias string")).select("id", "n", "n_names", "places").collect()}
    assert got == {(k, len(f), len({p for p, _ in f}), sum(at for _, at in f)) for k, f in want.items()}


def test_names_found_is_the_same_by_trie_and_by_join(spark, monkeypatch):
    """F2."""
    run = lambda: {tuple(r) for r in catalog_stores.names_found(spark, "/root/testdata/sf0.001").select("doc_id", "n", "n_names", "places").collect()}
    few = run()
    monkeypatch.setattr(gazetteer, "MOST", 2)
    monkeypatch.setattr(gazetteer, "cut", None)
    assert few and run() == few


def test_many_queries_are_few_searches_and_cells_are_listed_once(spark, tmp_path, monkeypatch):
    """2,000 queries a search, and each search listed all folders twice.  Equal vectors are equally far, so their ties go by id."""
    rng = np.random.default_rng(4)
    m = rng.normal(size=(600, 8)).astype(np.float32)
    rows = [(k, m[k % 600].tolist()) for k in range(1200)]
    v = spark.createDataFrame(rows, "id long, embedding array<float>")
    vectorindex.build(v.where("id % 2 = 0"), f"{tmp_path}/x", cells=8, split_rows=60)
    vectorindex.add(spark, f"{tmp_path}/x", v.where("id % 2 = 1"), split_rows=60)
    asked = v.where("id % 3 = 0").select(F.col("id").alias("query"), "embedding")
    monkeypatch.setattr(vectorindex, "QUERIES", 50)
    monkeypatch.setattr(vectorindex, "PENDING", 100)
    searches, found = [], vectorindex._searched
    monkeypatch.setattr(vectorindex, "_searched", lambda *a: searches.append(a) or found(*a))
    d = np.sqrt(((m[:, None].astype(float) - m[None].astype(float)) ** 2).sum(2))
    want = {q: sorted((round(d[q % 600, k % 600], 9), k) for k in range(1200))[:7] for q in range(0, 1200, 3)}
    tell = lambda **more: {(r["query"], r["rank"], r["id"]) for r in vectorindex.topk(spark, f"{tmp_path}/x", asked, k=7, **more).collect()}
    exact = tell(exact=True, probe=2)
    assert exact == {(q, n + 1, k) for q, own in want.items() for n, (_, k) in enumerate(own)}
    assert len(searches) == 1
    assert len(tell(probe=2, recall=0.9) & exact) >= 0.85 * len(exact)
    assert max(Counter((q, r) for q, r, _ in tell(probe=2)).values()) == 1
    state = vectorindex._State(spark, f"{tmp_path}/x")
    state.rows(state.order(), "id")
    listed = state.listed[1]
    state.rows(state.order()[:2], "v")
    assert state.listed[1] is listed
    assert state.rows(state.order(), "id").count() == 1200


def test_edges_of_large_and_small_vectors(spark, tmp_path):
    """candidates are ruled out in single floats, which hold neither squares of these nor their last digits."""
    rng = np.random.default_rng(5)
    near = 1 + rng.normal(size=(150, 4)) * 1e-7
    for k, m in enumerate((near, near * 1e25, near * 1e-25)):
        v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id long, embedding array<double>")
        vectorindex.build(v, f"{tmp_path}/{k}", cells=4)
        got = vectorindex.topk(spark, f"{tmp_path}/{k}", v.where("id < 20").select(F.col("id").alias("query"), "embedding"), k=4, exact=True).collect()
        d = np.sqrt(((m[:20, None] - m[None]) ** 2).sum(2))
        assert {(r["query"], r["rank"], r["id"]) for r in got} == {(q, n + 1, int(i)) for q in range(20) for n, i in enumerate(d[q].argsort(kind="stable")[:4])}
