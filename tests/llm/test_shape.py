"""Fill-in-middle, token counts and centroid clustering against plain versions of each."""

import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brindle.llm import centroids, fim, pieces, queries, tokencounts

# --- fill-in-middle ---------------------------------------------------------------------------------------


def plain_fim(doc_id, text, grammar=fim.WORDS, percent=90):
    text = text or ""
    units = re.findall(grammar, text)
    h = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    form = "plain" if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent else "spm" if h[3] % 100 < 20 else "psm"
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = {"plain": text, "psm": f"<P>{p}<S>{s}<M>{m}", "spm": f"<S>{s}<P>{p}<M>{m}"}[form]
    return n, form, None if form == "plain" else p, None if form == "plain" else m, out


TEXTS = [None, "", "a", " ", "\n", "ab cd", "don't stop", "é😀 x😀y", "<P>", "a<S>b", "<", "x<", "<S", "P>", "<P", "9 lives\r\n\r\ntabs\t end", "z" * 5000, "<" * 50, "\x00 nul", "ends in space "]


@pytest.mark.parametrize("grammar", [fim.WORDS, fim.CHARACTERS, fim.LINES, "[A-Za-z]+|[0-9]+|[^A-Za-z0-9]", r"[ \t]+|[^ \t]+"])
def test_fill_in_middle(spark, grammar):
    rows = [(k, TEXTS[k % len(TEXTS)]) for k in range(8 * len(TEXTS))] + [(None, "no id at all"), (3, "same"), (3, "same")]
    got = fim.transform(spark.createDataFrame(rows, "doc_id long, text string"), grammar=grammar)
    back = got.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((r.doc_id, r.text, r.units, r.form, r.prefix, r.middle, r.output) for r in back if r.doc_id is not None and r.text is not None) == sorted((i, t, *plain_fim(i, t, grammar)) for i, t in rows if i is not None and t is not None)
    assert all(r.back == (r.text or "") for r in back)
    assert {r.form for r in back} == {"plain", "psm", "spm"}


@settings(max_examples=12, deadline=None)
@given(texts=st.lists(st.text(alphabet="aZ9 \n<PSM>é😀퟿", max_size=30), min_size=1, max_size=20))
def test_fill_in_middle_of_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = fim.transform(df, percent=100).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert sorted((r.doc_id, r.units, r.form, r.prefix, r.middle, r.output, r.back) for r in made) == sorted((k, *plain_fim(k, t, percent=100), t) for k, t in enumerate(texts))


def test_fill_in_middle_with_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumns({"form": F.lit("own"), "units": F.lit("own"), "row": F.lit("own"), "pieces": F.lit("own"), "h1": F.lit("own"), "a": F.lit("own")})
    made = fim.transform(clash)
    assert made.count() == odd_docs.count() and made.where("row <> 'own' or pieces <> 'own' or h1 <> 'own' or a <> 'own' or kept <> 'own'").count() == 0
    assert [c for c in made.columns if c not in fim.RESULTS] == [c for c in clash.columns if c not in fim.RESULTS]
    assert fim.transform(no_docs).count() == 0


@pytest.mark.parametrize("grammar", ["", "[a-z]+", "[a-z]+|[^b]", "[a-z]*[ ]|[^a-z]", r"[^\n]*[\n]|[^\n]", "a+|b", "[a]+|[b]+|[^ab"])
def test_grammars_that_lose_text_are_refused(grammar):
    with pytest.raises(ValueError):
        fim.boundary(grammar)


def test_marks_that_overlap_are_refused():
    for bad in (("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("", "<S>", "<M>"), ("<P>", "x<P>y", "<M>")):
        with pytest.raises(ValueError):
            fim.Marks(*bad)


# --- token counts -----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)


@pytest.fixture(scope="module")
def merges():
    return tokencounts.Merges(pieces.load(queries.PIECES))


ALPHABETS = ["abcdefghijklmnopqrstuvwxyzABCDEF0123456789=-_ \n\t▁éßжщ漢字😀\x00.,;()[]{}", "etaoinsr", "ab", "a", " ", "▁ a", "-=", "\n ", "the in on ing"]


@pytest.mark.parametrize("size", [1, 5, 40, 600, 3000])
def test_token_counts_are_the_librarys(merges, library, size):
    draw = random.Random(size)
    texts = ["".join(draw.choice(a) for _ in range(draw.randint(size // 2, size))) for a in ALPHABETS for _ in range(2 if size > 500 else 60)]
    assert tokencounts._tallies(merges, [None, "", *texts]) == [0, 0, *(len(library.encode(t)) for t in texts)]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_places_filed_by_rank_give_the_same(merges, library, alphabet):
    draw = random.Random(len(alphabet))
    for n in (2, 3, 9, 60, 700):
        text = "".join(draw.choice(alphabet.replace("\n", "")) if alphabet != "\n " else " " for _ in range(n))
        assert merges._count_long(*merges._symbols([" " + text])) == len(library.encode(text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_token_counts_of_any_text(merges, library, texts):
    texts = [t for t in texts if not any("\ud800" <= c <= "\udfff" for c in t)]
    assert tokencounts._tallies(merges, texts) == [len(library.encode(t)) for t in texts]


def test_token_counts_beyond_a_part_and_a_memo(monkeypatch, library):
    own = tokencounts.Merges(pieces.load(queries.PIECES))
    monkeypatch.setattr(tokencounts, "PART", 64)
    monkeypatch.setattr(tokencounts, "MEMO", 20)
    texts = [" ".join(f"word{k * j % 91}" for k in range(200)) + "x" * 300 + "\n" * 70 for j in range(5)]
    assert tokencounts._tallies(own, texts) == [len(library.encode(t)) for t in texts]
    assert len(own.memo) <= 20 + 91 + 10 and not any(len(p) > 64 for p in own.memo)


def test_a_small_vocabulary_of_unsafe_ranks():
    """Pieces whose merges lead to pairs of lower rank, and of equal scores, one pair at a time as a plain loop does."""
    vocabulary = [("a", -9.0, "normal"), ("b", -9.5, "normal"), ("ab", -3.0, "normal"), ("aba", -1.0, "normal"), ("ba", -2.0, "normal"), ("bb", -2.0, "normal"), ("abab", -2.0, "normal"), ("aab", -4.0, "normal"), ("▁a", -2.5, "normal")]
    score = {t: s for t, s, _ in vocabulary}

    def plain(text):
        sym = list("▁" + text)
        while True:
            found = [(-score[x + y], k) for k, (x, y) in enumerate(zip(sym, sym[1:])) if x + y in score]  # noqa: B905
            if not found:
                return len(sym)
            _, k = min(found)
            sym[k : k + 2] = [sym[k] + sym[k + 1]]

    own = tokencounts.Merges(vocabulary)
    draw = random.Random(3)
    texts = ["".join(draw.choice("aab") for _ in range(draw.randint(1, 40))) for _ in range(300)]
    want = [plain(t) for t in texts]
    assert tokencounts._tallies(own, texts) == want
    assert [own._count_long(*own._symbols(["▁" + t])) for t in texts] == want


def test_token_counts_with_odd_rows(spark, odd_docs, no_docs, library):
    clash = odd_docs.withColumns({c: F.lit("own") for c in ("n_tokens", "over_limit", "_k", "_c0")})
    made = tokencounts.count(clash, pieces.load(queries.PIECES), limit=100)
    assert [c for c in made.columns if c not in tokencounts.RESULTS] == [c for c in clash.columns if c not in tokencounts.RESULTS]
    rows = made.collect()
    assert all((r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n := len(library.encode(r.text or "")), n > 100) and r["_k"] == r["_c0"] == "own" for r in rows)
    assert len(rows) == odd_docs.count() and any(r.over_limit for r in rows)
    assert tokencounts.count(no_docs, pieces.load(queries.PIECES)).count() == 0


def test_vocabularies_that_cross_spaces_are_refused():
    for t in ("a▁b", "a\n"):
        with pytest.raises(ValueError):
            tokencounts.Merges([(t, 0.0, "normal")])


def test_token_counts_of_the_table(spark, library):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.op12_token_counts(spark, sf).collect()
    assert sorted(map(tuple, got)) == sorted((i, len(t.encode()), n := len(library.encode(t)), n > 4096) for i, t in text.items())


# --- centroids ----------------------------------------------------------------------------------------------


def plain_clusters(rows, k, size, rounds, scale=64):
    """Python integers alone: (id, cluster, distance, cluster_inertia, inertia, sha256)."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    c = [v for _, v in order[:k]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, w, strict=True)), j) for j, w in enumerate(c))
    for _ in range(rounds):
        home = [near(v)[1] for _, v in kept]
        for j in range(len(c)):
            own = [v for (_, v), h in zip(kept, home, strict=True) if h == j]
            if own:
                c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    end = [(i, *near(v)[::-1]) for i, v in kept]
    cap = lambda x: x if x < 1 << 63 else None
    per = {j: sum(d for _, h, d in end if h == j) for j in range(len(c))}
    return sorted(((i, h, cap(d), cap(per[h]), cap(sum(per.values())), hashlib.sha256(",".join(map(str, c[h])).encode()).hexdigest()) for i, h, d in end), key=repr)


def clusters(df, **options):
    return sorted((tuple(r) for r in centroids.cluster(df, id_col="id", vec_col="v", **options).select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


@pytest.mark.parametrize("most", [1.0, 3e5, 2e8, 1e30])
def test_centroids_at_every_magnitude(spark, most):
    draw = np.random.default_rng(int(math.log(most)))
    rows = [(k, [float(x) for x in draw.normal(0, most, 5)]) for k in range(60)] + [(100 + k, [float(x) for x in draw.normal(0, 1, 5)]) for k in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    assert clusters(df, k=7, size=5, rounds=3) == plain_clusters(rows, 7, 5, 3)


def test_centroids_with_odd_rows(spark):
    inf, nan = math.inf, math.nan
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.5, 0.0]), (4, None), (5, [1.0]), (6, [1.0, None]), (7, [inf, 0.0]), (8, [nan, 0.0]), (9, []), (None, [2.0, -2.0]), (10, [-0.004, -1e-300]), (11, [1.7e308, -1.7e308]), (12, [5e-324, 1 / 3])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    for k in (1, 3, 40):
        assert clusters(df, k=k, size=2, rounds=2) == plain_clusters(rows, k, 2, 2)
    clash = df.withColumns({c: F.lit("own") for c in ("cluster", "inertia", "c0", "digest", "_x")})
    made = centroids.cluster(clash, k=3, size=2, id_col="id", vec_col="v")
    assert made.where("c0 = 'own' and digest = 'own' and _x = 'own'").count() == len(plain_clusters(rows, 3, 2, 3))
    assert centroids.cluster(df.where("id = 4"), size=2, id_col="id", vec_col="v").count() == 0
    assert centroids.cluster(df.limit(0), size=2, id_col="id", vec_col="v").count() == 0
    with pytest.raises(ValueError):
        centroids.fit(df, size=2, scale=100, id_col="id", vec_col="v")


def test_an_empty_centroid_stays(spark):
    rows = [(k, [0.0]) for k in range(9)] + [(9, [50.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    assert clusters(df, k=4, size=1, rounds=3) == plain_clusters(rows, 4, 1, 3)
    found, n, _ = centroids.fit(df, k=4, size=1, id_col="id", vec_col="v")
    assert len(found) == 4 and sum(n) == 10 and 0 in n


def test_the_product_is_exact_up_to_its_bound():
    draw = np.random.default_rng(5)
    for top in (2**10, 2**20, 2**22):
        x, c = draw.integers(-top, top, (500, 64)), draw.integers(-top, top, (16, 64))
        home, away = centroids.nearest(x.astype(float), c.astype(float))
        want, far = centroids.nearest_whole(x.tolist(), c.tolist())
        assert home.tolist() == want and [int(v) for v in away] == far
