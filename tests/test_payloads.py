"""Payloads as VARIANT, a bucketed target, names of a large table, batches by length."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle import providers
from brindle.functions import gazetteer
from brindle.operators import bucketed, state, store

ROWS = [
    ("i1", "a", 1, '{"k": 5, "t": {"u": "x", "v": [1, 2]}, "s": "5"}'), ("i1", "b", 2, '{"k": 0, "tags": ["p"]}'), ("i2", "a", 1, '{"k": "7", "t": {"u": 3}}'), ("i2", "b", 1, '{"k": null}'),
    ("i3", "a", 1, "not json"), ("i3", "b", 3, "{}"), ("i4", "a", 1, None), ("i5", "a", 2, '{"k": 1.5, "t": "flat"}'), ("i5", "z", 2, "{}"),
]


def test_queries_over_variant_payloads(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id string, state string, ts int, data string").withColumn("ts", F.timestamp_seconds("ts"))
    state.as_variant(df).write.parquet(str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert state.is_variant(stored) and not state.is_variant(df)
    fields = {"k": "long", "tags": "array<string>"}
    good = df.where("id in ('i1')")
    assert state.get_many(stored.where("id in ('i1')"), ["a", "b"], "z", fields=fields).collect() == state.get_many(good, ["a", "b"], "z", fields=fields).collect()
    got = {r.id: r.k for r in state.get_many(stored, ["a", "b"], "z", fields=fields).collect()}
    assert got == {"i1": 5, "i2": 7}  # text of a number converts; i3 has no payload in a
    assert [r.id for r in state.get_one(stored, "a", conditions={"t.u": "x"}).collect()] == ["i1"]
    assert sorted(r.id for r in state.get_one(stored, "a", conditions={"t.u": ["x", 3]}).collect()) == ["i1", "i2"]
    assert [r.id for r in state.get_one(stored, "a", conditions={"t.u": 3}).collect()] == [r.id for r in state.get_one(df, "a", conditions={"t.u": 3}).collect()] == ["i2"]
    new = state.put(stored, spark.createDataFrame([("i1", 1), ("i9", 2)], "id string, k int"), "b", as_of=F.lit("2024-01-01").cast("timestamp"))
    assert [(r.id, r.k) for r in new.select("id", F.try_variant_get("data", "$.k", "int").alias("k")).collect()] == [("i9", 2)]
    assert state.expire(stored, F.timestamp_seconds(F.lit(86400 * 9)), 1).where("data is not null").count() == 0


def test_a_bucketed_target_is_never_shuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("DROP TABLE IF EXISTS bucket_test")
    bucketed.create(spark, "bucket_test", path, "id string, state string, n long", ["id", "state"], buckets=8)
    rows = spark.range(200).select(F.concat(F.lit("x"), (F.col("id") % 90).cast("string")).alias("id"), F.lit("s").alias("state"), F.col("id").alias("n"))
    for _ in range(3):  # the same batch again and again
        bucketed.insert_ignore(spark, "bucket_test", rows)
    assert bucketed.count(spark, "bucket_test") == 90
    files = {p.name for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"}
    more = spark.createDataFrame([("x1", "s", 1), ("new", "s", 1), ("new", "s", 2), (None, "s", 3)], "id string, state string, n long")
    plan = bucketed.new_rows(spark, "bucket_test", more)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    lines = text.splitlines()
    join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lines[join].index("SortMergeJoin")
    right = next(k for k in range(join + 1, len(lines)) if lines[k][depth : depth + 2] == "+-")
    assert "Exchange" in "".join(lines[join:right]) and "Exchange" not in "".join(lines[right:])  # the batch moves, the target does not
    assert "SelectedBucketsCount: 8 out of 8" in "".join(lines[right:])
    bucketed.insert_ignore(spark, "bucket_test", more)
    assert bucketed.count(spark, "bucket_test") == 91
    assert len({p.name for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"} - files) == 1  # only the bucket of the new key
    want = sorted(r.id for r in spark.table("bucket_test").collect())
    at = bucketed.compact(spark, "bucket_test", path)
    assert sorted(r.id for r in spark.table("bucket_test").collect()) == want and at != path
    assert store.insert_ignore(spark.table("bucket_test"), more, ["id", "state"]).count() == 0
    spark.sql("DROP TABLE bucket_test")


def plain_names(names, text):
    """Every name tried at every token."""
    own, finds = gazetteer.tokens(text), set()
    best: dict = {}
    for alias, name, field in names:
        key = tuple(gazetteer.tokens(alias))
        if key and (key not in best or (name, field) < best[key]):
            best[key] = (name, field)
    for key, (name, field) in best.items():
        for at in range(len(own) - len(key) + 1):
            if tuple(own[at : at + len(key)]) == key:
                finds.add((at, len(key), name, field))
    return gazetteer.resolved(sorted(finds))


@pytest.mark.parametrize("most", [500_000, 7])
def test_names_are_found_as_by_trying_each(spark, monkeypatch, most):
    monkeypatch.setattr(gazetteer, "MOST", most)
    draw = random.Random(6)
    words = "a b c d New York Times ÉCOLE s x-y".split()
    names = [(" ".join(draw.choice(words) for _ in range(draw.randint(1, 4))), f"N{k % 17}", draw.choice(["people", "regions"])) for k in range(40)] + [("--", "none", "people"), ("a a", "AA", "regions"), ("a a a", "AAA", "regions")]
    texts = [" ".join(draw.choice([*words, "other", "a"]) for _ in range(draw.randint(0, 40))) for _ in range(80)] + ["", "a a a a a a a", "NEW york, Times!"]
    table = spark.createDataFrame([*names, (None, "x", "y"), ("z", None, "y")], "alias string, name string, field string")
    df = spark.createDataFrame([*enumerate(texts), (900, None)], "id long, text string").withColumns({c: F.lit("own") for c in ("found", "c0", "entities")})
    got = {r.id: [(f["start"], f["tokens"], f["name"], f["field"]) for f in r.entities] for r in gazetteer.find(df, table).collect()}
    assert got == {k: plain_names(names, t) for k, t in enumerate(texts)} | {900: []}
    assert gazetteer.find(df, table).where("found = 'own' and c0 = 'own'").count() == len(texts) + 1


class Fragile(providers.HashEmbedder):
    """Fails on batches over a size, and on one text alone."""

    def embed(self, texts):
        if sum(len(t.split()) for t in texts) > 60 or any("poison" in t for t in texts):
            raise MemoryError
        return super().embed(texts)


def test_batches_of_like_length(spark, monkeypatch):
    draw = random.Random(2)
    sizes = [draw.randint(1, 500) for _ in range(400)]
    batches = providers.by_length(sizes, 32, 4000)
    assert sorted(k for b in batches for k in b) == list(range(400))
    assert all(len(b) <= 32 and (len(b) == 1 or len(b) * max(sizes[k] for k in b) <= 4000) for b in batches)
    plain = [list(range(lo, min(400, lo + 8))) for lo in range(0, 400, 8)]
    assert providers.padded_share(sizes, batches) < 0.05 < 0.3 < providers.padded_share(sizes, plain)
    monkeypatch.setattr(providers, "EMBED_WORDS", 200)
    rows = [(k, " ".join(f"w{draw.randint(0, 50)}" for _ in range(draw.randint(0, 40)))) for k in range(60)] + [(60, None), (61, "poison")]
    df = spark.createDataFrame(rows, "id long, content string")
    got = {r.id: r.embedding for r in providers.embed(df, lambda: Fragile(16, 20)).collect()}
    one = Fragile(16, 20)
    for k, t in rows[:60]:
        parts = providers.split_words(t, 20)
        want = np.mean([one.embed([p])[0] for p in parts], axis=0) if parts else None
        assert (got[k] is None) == (want is None) and (want is None or np.allclose(got[k], want, atol=1e-6))
    assert got[60] is None and got[61] is None
