"""The suffix family that stays in a folder, against brute force and against one run over everything."""

import random

import pytest
from pyspark.sql import functions as F

from brindle.llm import suffix
from brindle.llm.family import SuffixFamily

SCHEMA = "doc_id long, text string"


def brute(batches, length=50):
    """Row by row: a byte goes if a string over it was seen in an earlier batch or under a smaller id of its own."""
    seen, out = set(), {}
    for batch in batches:
        own: dict[bytes, int] = {}
        rows = sorted((float("inf") if i is None else i, k, (t or "").encode()) for k, (i, t) in enumerate(batch))
        for i, _, b in rows:
            for k in range(len(b) - length + 1):
                own.setdefault(b[k : k + length], i)
        for i, _, b in rows:
            gone = [False] * len(b)
            for k in range(len(b) - length + 1):
                s = b[k : k + length]
                if s in seen or own[s] < i:
                    gone[k : k + length] = [True] * length
            out.setdefault(i, []).append(bytes(x for x, g in zip(b, gone, strict=True) if not g))
        seen |= set(own)
    return {i: sorted(v) for i, v in out.items()}


def kept(rows):
    out = {}
    for r in rows:
        out.setdefault(float("inf") if r["doc_id"] is None else r["doc_id"], []).append(bytes(r["kept"]))
    return {i: sorted(v) for i, v in out.items()}


def texts(seed, n):
    r = random.Random(seed)
    line = "This very common line stands in almost every one of the documents, as licences do. "
    shared = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(40, 160))) for _ in range(12)]
    return ["".join(r.choice([r.choice(shared), line, "".join(r.choice("ijklmno é") for _ in range(r.randint(1, 90)))]) for _ in range(r.randint(0, 9))) for _ in range(n)]


def test_batches_against_brute_force(spark, tmp_path):
    docs = list(enumerate(texts(1, 48)))
    batches = [docs[k : k + 12] for k in range(0, 48, 12)]
    rows, sizes = [], []
    for b in batches:
        family = SuffixFamily(spark, str(tmp_path / "family"))  # read from its folder each time
        rows += family.add(spark.createDataFrame(b, SCHEMA)).collect()
        sizes.append(family.runs())
    assert kept(rows) == brute(batches)
    whole = suffix.repeats(spark.createDataFrame(docs, SCHEMA)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, whole))  # spans too
    for s in sizes:
        assert len({n.bit_length() for n in s}) == len(s)  # no two runs of one rank
    assert any(len(b) < len(a) + 1 for a, b in zip(sizes, sizes[1:], strict=False))  # some merged


def test_strings_across_two_removed_passages_still_serve(spark, tmp_path):
    """C is made of A and B alone, so all of it goes, yet a string over their border starts in C first."""
    r = random.Random(3)
    a, b = ("".join(r.choice("abcdefghij") for _ in range(80)) for _ in range(2))
    batches = [[(0, a), (1, b)], [(2, a + b)], [(3, "xyz" + a[-30:] + b[:30] + "xyz")]]
    family = SuffixFamily(spark, str(tmp_path / "family"))
    rows = [x for batch in batches for x in family.add(spark.createDataFrame(batch, SCHEMA)).collect()]
    assert kept(rows) == brute(batches)
    assert kept(rows)[2] == [b""] and kept(rows)[3] == [b"xyzxyz"]


def test_odd_rows(spark, tmp_path, odd_docs, no_docs):
    folder = str(tmp_path / "family")
    family = SuffixFamily(spark, folder)
    assert family.add(no_docs).count() == 0 and family.runs() == []
    own = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    extra = [(None, own[5][1]), (None, "only a row without an id says this, in some more than fifty bytes"), (20, None), (21, ""), (21, "x" * 49), (22, "x" * 50)]
    later = [(30, "x" * 200), (31, extra[1][1]), (31, own[9][1])]
    rows = [x for b in (odd_docs, spark.createDataFrame(extra, SCHEMA), spark.createDataFrame(later, SCHEMA)) for x in family.add(b).collect()]
    assert kept(rows) == brute([own, extra, later])
    with pytest.raises(ValueError):
        SuffixFamily(spark, folder, length=60)
    with pytest.raises(ValueError):
        family.add(spark.createDataFrame([(-1, "a")], SCHEMA))


def test_a_failed_batch_leaves_the_state_before_it(spark, tmp_path):
    family = SuffixFamily(spark, str(tmp_path / "family"))
    text = "one passage that both of the documents have, and it is long enough"
    first = spark.createDataFrame([(0, text)], SCHEMA)
    family.add(first)
    before = family.runs()
    broken = spark.createDataFrame([(1, "other words, which nobody else has, but in a batch that will fail soon")], SCHEMA)
    with pytest.raises(Exception):
        family.add(broken.withColumn("text", F.when(F.lit(True), F.raise_error(F.lit("lost"))).otherwise(F.col("text"))))
    assert SuffixFamily(spark, str(tmp_path / "family")).runs() == before
    assert [r["n_bytes"] - len(r["kept"]) for r in family.add(first.withColumn("doc_id", F.lit(2).cast("long"))).collect()] == [len(text)]
