"""SentencePiece, sharding, fingerprints, the n-gram join, components, WARC, the pipeline."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import ngramjoin, pieces, queries, shards, sketch, suffix, vec, warc
from brindle.llm.shared import shared_folder
from brindle.operators import graph

from .test_filters import words

MODEL = Path(queries.PIECES)


def brute_segment(model, scores, text):
    """Best sum of scores, by trying every piece at every place."""
    best = [(0.0, [])] + [None] * len(text)
    for k in range(len(text)):
        options = [(n, s, p) for p, (t, s) in scores.items() if (n := len(t)) and text.startswith(t, k)]
        if not any(n == 1 for n, _, _ in options):
            options.append((1, model.penalty, None))
        for n, s, p in options:
            v = best[k][0] + s
            if best[k + n] is None or v > best[k + n][0] + 1e-9:
                best[k + n] = (v, [*best[k][1], p if p is not None else text[k]])
    return best[-1][0]


def test_viterbi_finds_the_best_sum():
    rng = random.Random(4)
    listed = {"a": -1.5, "b": -2, "ab": -2.5, "ba": -4, "aba": -3.2, "▁": -1, "▁a": -1.7, "bb": -3.5, "c▁": -9}
    vocabulary = [("<unk>", 0.0, "unknown"), *((f"<0x{k:02X}>", 0.0, "byte") for k in range(256)), *((t, s, "normal") for t, s in listed.items())]
    model = pieces.PieceModel(vocabulary)
    assert model.parts is None  # a piece crosses
    scores = {k: v[:2] for k, v in enumerate(vocabulary) if v[2] == "normal"}
    for _ in range(200):
        text = "".join(rng.choice("aab b▁c") for _ in range(rng.randrange(1, 14))).replace(" ", "▁")
        ids = model.segment(text)
        if all(k in scores for k in ids):
            assert sum(scores[k][1] for k in ids) == pytest.approx(brute_segment(model, scores, text))
        assert b"".join(model.raw[k] for k in ids).decode() == text.replace("▁", " ")


@pytest.mark.skipif(not MODEL.exists(), reason="no vocabulary file")
def test_scores_on_the_vocabulary_file(spark):
    """On real words the sum of scores is the best there is, and never below that of the library's merges or its unigram reading of the pieces."""
    import sentencepiece

    raw = MODEL.read_bytes()
    at = raw.index(b"tok_v0") + len(b"tok_v0")
    assert raw[at : at + 2] == b"\x18\x02"  # model_type: BPE
    library = sentencepiece.SentencePieceProcessor(model_proto=raw[:at] + b"\x18\x01" + raw[at + 2 :])
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(80).collect()
    vocabulary = pieces.load(str(MODEL))
    model = pieces.PieceModel(vocabulary)
    total = lambda ids: sum(vocabulary[k][1] for k in ids)
    by_text = {t: s for t, s, kind in vocabulary if kind == "normal"}
    merges = sentencepiece.SentencePieceProcessor(model_proto=raw)
    lines = 0
    for word in {w for r in docs for w in r.text.split()}:  # single words: the library adds in 32 bits, which is exact for short sums only
        if all(c in model.single for c in word):
            ours = total(model.encode(word).tolist())
            best = [0.0] + [-float("inf")] * (len(word) + 1)
            marked = "▁" + word
            for k in range(len(marked)):
                for m in range(k + 1, len(marked) + 1):
                    if (p := by_text.get(marked[k:m])) is not None:
                        best[m] = max(best[m], best[k] + p)
            assert ours == best[-1] and ours >= total(library.encode(word)) and ours >= total(merges.encode(word)), word
            lines += 1
    assert lines > 1000


@pytest.mark.skipif(not MODEL.exists(), reason="no vocabulary file")
def test_whole_texts_have_the_best_sum(spark):
    """A plain dynamic programme over whole texts, with every piece of the vocabulary tried at every place and bytes where none fits."""
    vocabulary = pieces.load(str(MODEL))
    model = pieces.PieceModel(vocabulary)
    score = {t: s for t, s, kind in vocabulary if kind == "normal"}
    longest = max(map(len, score))
    texts = [r.text[:4000] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) > 500").orderBy("doc_id").limit(5).collect()]
    texts += ["a  b\n\n c\t😀x ", "   ", "naïve ﬁ ▁ mark", "\x00"]
    byte = {k for k, (_, _, kind) in enumerate(vocabulary) if kind == "byte"}
    for text in texts:
        marked = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-float("inf")] * len(marked)
        for k in range(len(marked)):
            for m in range(k + 1, min(len(marked), k + longest) + 1):
                s = score.get(marked[k:m])
                if s is None and m == k + 1:
                    s = model.penalty
                if s is not None:
                    best[m] = max(best[m], best[k] + s)
        ids = model.encode(text).tolist()
        runs = [vocabulary[k][1] for k in ids if k not in byte]
        raw = b"".join(model.raw[k] for k in ids if k in byte)
        total = sum(runs) + model.penalty * len(raw.decode())
        assert total == pytest.approx(best[-1], abs=1e-6), text[:40]


@pytest.mark.skipif(not MODEL.exists(), reason="no vocabulary file")
def test_models_with_other_settings_are_refused():
    raw = MODEL.read_bytes()
    norm = bytes([0x0A, 8]) + b"identity" + bytes([0x12, 0, 0x18, 1, 0x20, 0])
    at = raw.rindex(norm)
    assert pieces._refused(raw) is None
    assert pieces._refused(raw[:at] + norm[:-1] + b"\x01" + raw[at + len(norm) :]) == "white space that is squeezed"
    assert pieces._refused(raw[:at] + norm[:-3] + b"\x00\x20\x00" + raw[at + len(norm) :]) == "no mark before the text"


@pytest.mark.skipif(not MODEL.exists(), reason="no vocabulary file")
def test_pieces_round_trip_with_odd_rows(odd_docs, no_docs):
    vocabulary = pieces.load(str(MODEL))
    coded = pieces.decode(pieces.encode(odd_docs, vocabulary), vocabulary)
    for r in coded.collect():
        assert r.decoded == (None if r.text is None else r.text.replace("▁", " "))
        assert (r.ids is None) == (r.text is None)
    assert sorted(coded.columns) == sorted([*odd_docs.columns, "decoded"])
    assert pieces.encode(no_docs, vocabulary).count() == 0


def heap_rule(sizes, shards):
    """The shard of each of these sizes, largest first, one by one."""
    import heapq

    heap, out = [(0, k) for k in range(shards)], []
    for s in sorted(sizes, reverse=True):
        load, k = heapq.heappop(heap)
        out.append((s, k))
        heapq.heappush(heap, (load + s, k))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_schedule_is_the_heap_rule(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([3, 5, 8, 100, 1000, rng.randrange(1, 1 << 20)]) for _ in range(rng.choice([1, 7, 500, 3000]))]
    want = Counter(heap_rule(sizes, 8))
    plan = list(shards.schedule(sorted(Counter(sizes).items(), reverse=True), 8))
    assert {(s, k): n for s, take in plan for k, n in enumerate(take) if n} == dict(want)


def test_sharding_with_odd_rows(spark, odd_docs, no_docs):
    """Sizes from 1 byte to a megabyte go where the heap puts them, groups stay together, slots have no gaps."""
    made = spark.range(300).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 120).cast("string"), F.repeat(F.lit("x"), F.pow(F.lit(1.122), F.col("id") % 120).cast("int"))).alias("text"), F.lit("own").alias("shard"), F.lit("own").alias("slot"))
    again = spark.range(40).select(F.lit(7777).cast("long").alias("doc_id"), F.lit("one row many times").alias("text"), F.lit("own").alias("shard"), F.lit("own").alias("slot"))
    docs = odd_docs.select("doc_id", "text", "shard", "slot").unionByName(made).unionByName(again).unionByName(spark.createDataFrame([(None, "no id", "own", "own")], "doc_id long, text string, shard string, slot string"))
    rows = shards.assign(docs, 8).collect()
    texts = {r.doc_id: (r.text or "") for r in docs.collect()}
    assert len(rows) == docs.count()
    where, bytes_of = {}, Counter()
    for r in rows:
        t = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(t) + 1, zlib.crc32(t))
        assert where.setdefault(t, r.shard) == r.shard
        bytes_of[t] += r.size
    assert max(bytes_of.values()) > 1 << 20
    assert Counter((bytes_of[t], k) for t, k in where.items()) == Counter(heap_rule(bytes_of.values(), 8))
    for k in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == k)
        assert own == list(range(len(own)))
    assert shards.assign(no_docs, 8).count() == 0


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_sketches_estimate_and_merge(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(5000)]
    a = " ".join(rng.choice(vocabulary, 3000))
    b = " ".join(a.split()[:2000]) + " " + " ".join(rng.choice(vocabulary, 1000))
    small, part = "one two three four five six", "one two three four five six seven"
    df = spark.createDataFrame([(1, a), (2, b), (3, a), (4, None), (5, ""), (6, small), (7, part), (8, a + " " + a)], "doc_id long, text string")
    rows = {r.doc_id: r for r in sketch.fingerprints(df).collect()}
    s = {k: sketch.decode(r.fingerprint) for k, r in rows.items()}
    assert all(sketch.encode(s[k]) == rows[k].fingerprint for k in s)
    assert rows[1].fingerprint == rows[3].fingerprint and rows[4].fingerprint == rows[5].fingerprint == "="
    true = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
    assert sketch.resemblance(s[1], s[2]) == pytest.approx(true, abs=0.13)
    assert sketch.containment(s[1], s[2]) == pytest.approx(2000 / 3000, abs=0.2)
    assert sketch.distinct(s[1]) == pytest.approx(2996, rel=0.3)
    assert sketch.resemblance(s[6], s[7]) == pytest.approx(2 / 3) and sketch.containment(s[6], s[7]) == 1 and sketch.distinct(s[7]) == 3
    assert (sketch.resemblance(s[4], s[5]), sketch.resemblance(s[4], s[6])) == (1.0, 0.0)
    whole = sketch.merged(sketch.fingerprints(df).where("doc_id in (1, 2)")).first()[0]
    assert sketch.decode(whole)[0].tolist() == sketch.merge(s[1], s[2])[0].tolist()


def plain_fingerprint(text, k=128):
    """The least hashes of the distinct shingles, by the hash of one shingle alone."""
    made = []
    for s in shingles(text):
        raw = " ".join(s).encode()
        _, _, h, row = vec.words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        g, _ = vec.row_shingles(h, row, 5)
        assert len(g) == 1
        made.append(int(g[0]) >> 16)
    made = sorted(set(made))
    raw = b"".join(x.to_bytes(6, "little") for x in made[:k])
    return ("=" if len(made) <= k else "+") + base64.b64encode(raw).decode()


def plain_likeness(a, b, k=128):
    """Of the k least hashes of both together the share that both have."""
    x, y = (([int.from_bytes(raw[j : j + 6], "little") for j in range(0, len(raw), 6)]) for raw in (base64.b64decode(f[1:]) for f in (a, b)))
    if not x or not y:
        return float(len(x) == len(y))
    both = sorted(set(x) | set(y))
    if "+" in (a[0], b[0]):
        both = both[: min(k, *(len(v) for v, f in ((x, a), (y, b)) if f[0] == "+"))]
    return len(set(x) & set(y) & set(both)) / len(both)


@pytest.mark.parametrize("parts", [1, 5])
def test_next_documents(spark, odd_docs, no_docs, monkeypatch, parts):
    """Every column against a plain version, with one part and with several."""
    docs = odd_docs.select("doc_id", "text", "node").unionByName(spark.createDataFrame([(None, "null id", "own")], "doc_id long, text string, node string"))
    monkeypatch.setattr(sketch, "size_cuts", lambda sized, mb: [2, 5, 6, 9][: parts - 1])
    rows = sketch.against_next(docs).collect()
    low = -1
    order = sorted(((low if r.doc_id is None else r.doc_id, r.text or "") for r in docs.collect()), key=lambda x: (-x[0], x[1]))
    want = Counter()
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        f, e, g = plain_fingerprint(t), plain_fingerprint(edited), plain_fingerprint(after)
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, e, plain_likeness(f, e), plain_likeness(f, g))] += 1
    assert Counter((low if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in rows) == want
    assert sketch.against_next(no_docs).count() == 0
    one = sketch.against_next(docs.where("doc_id = 5").limit(1)).first()
    assert one.near_next == 1.0


def test_next_documents_over_parts_of_their_own(spark):
    """Parts of a megabyte, as sizes make them: every document meets its next one."""
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1500)), lambda k: F.sha1((k * 1000 + F.col("id")).cast("string").cast("binary")).substr(1, 6))).alias("text"))
    texts = [r.text for r in docs.orderBy(F.col("doc_id").desc()).collect()]
    rows = {r.doc_id: r for r in sketch.against_next(docs, part_mb=1).collect()}
    assert len(rows) == 300
    for k, t in enumerate(texts):
        after = texts[(k + 1) % 300]
        assert rows[299 - k].edited_sha256 == hashlib.sha256((t[: len(t) - len(t) // 2] + after[: len(t) // 2]).encode()).hexdigest()


def brute_classes(rows, threshold=0.8):
    sets = [shingles(t) or {("no words", t or "")} for _, t in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, least[find(k)], links[k]) for k, (i, _) in enumerate(rows))


def test_choose_bands():
    bands, rows = ngramjoin.choose_bands(0.8, 0.9995, 240)
    assert bands * rows <= 240 and 1 - (1 - 0.8**rows) ** bands >= 0.9995
    with pytest.raises(ValueError):
        ngramjoin.choose_bands(0.2, 0.9999, 4)


@pytest.mark.parametrize("block", [512, 3])
def test_ngram_join_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngramjoin, "BLOCK", block)
    rng = np.random.default_rng(6)
    vocabulary = [f"w{k}" for k in range(3000)]
    docs = []
    for g in range(8):
        base = list(rng.choice(vocabulary, 150))
        for _ in range(int(rng.integers(1, 9))):
            w = list(base)
            for _ in range(int(rng.integers(0, 5))):
                w[int(rng.integers(0, 150))] = str(rng.choice(vocabulary))
            docs.append(" ".join(w))
    docs += docs[:6] + ["tiny", "tiny", "Tiny!", "", "", None, "??", "!!"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(docs)), docs, strict=True)]
    got = ngramjoin.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute_classes(rows)


def test_ngram_join_with_odd_rows(odd_docs, no_docs):
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngramjoin.join(odd_docs).collect())
    assert got == brute_classes([(r.doc_id, r.text) for r in odd_docs.collect()])
    kept = ngramjoin.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, c, _ in got if i == c)
    assert ngramjoin.join(no_docs).count() == 0 and ngramjoin.keep_first(no_docs).count() == 0


def test_keep_first_decides_by_row(spark):
    """Where one id is on rows with different texts, each class keeps a document and only one."""
    text = lambda c: [f"{c}{k}" for k in range(200)]
    near = lambda c: [*text(c)[:-1], "other"]
    rows = [(3, near("a")), (5, text("a")), (5, text("b")), (6, near("b")), (7, text("c")), (7, near("c")), (8, text("c")), (9, text("d")), (9, text("d")), (10, text("e"))]
    rows = [(i, " ".join(w)) for i, w in rows]
    kept = sorted((r.doc_id, r.text) for r in ngramjoin.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    one_of = [x for x in kept if x[0] == 7]
    assert len(one_of) == 1 and one_of[0] in rows
    assert [x for x in kept if x[0] != 7] == sorted([rows[0], rows[2], rows[7], rows[8], rows[9]])


def test_rows_without_an_id_take_part(spark):
    base = [f"w{k}" for k in range(200)]
    text = lambda lo, hi: " ".join(["new" + w if lo <= k < hi else w for k, w in enumerate(base)])
    alone = " ".join(f"x{k}" for k in range(60))
    # the middle one links the ends: 1 ~ null ~ 2
    rows = [(1, text(0, 13)), (None, text(0, 0)), (2, text(187, 200)), (None, alone), (None, alone), (None, alone + " more"), (None, text(0, 0)), (4, "one"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0, r[2])
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in ngramjoin.join(df).collect()), key=key)
    want = [(i, None if c == 99 else c, n) for i, c, n in ((None if i == 99 else i, c, n) for i, c, n in brute_classes([(99 if i is None else i, t) for i, t in rows]))]
    assert got == sorted(want, key=key) and (2, 1, 2) in got
    kept = [(r.doc_id, r.text) for r in ngramjoin.keep_first(df).collect()]
    assert sorted(i for i, _ in kept if i is not None) == [1, 4]
    assert len([t for i, t in kept if i is None and t]) == 1 and (None, None) in kept and len(kept) == 4


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    rows = graph.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()
    by = {}
    for r in rows:
        by.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, by.values())) == [list(range(61)), list(range(100, 140)), [300, 301]]


def test_warc_round_trip(spark, tmp_path):
    html = ["<p>é</p>", None, "", "<p>é</p>", "x" * 300_000, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n", "\0\0", "<p>é</p>"]
    rows = [(k, f"http://b{k % 3}.example.org/p?{k}" if k else None, h) for k, h in enumerate(html)]
    rows += [rows[0], (None, "u\r\nX: y", "solo"), (None, "http://c.org/", "<p>é</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("own"))
    folder = f"{shared_folder(spark)}/test-warc"
    warc.write(df.repartition(3), folder, archive_mb=1)
    got = warc.read(spark, folder).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h in rows:
        key = (h or "").encode()
        if i is not None:
            first[key] = min(first.get(key, i), i)
    for r in got:
        body = next((h or "").encode() for i, u, h in rows if i == r.page_id and (i is not None or (u or "").startswith(r.url[:1])))
        assert (r.payload_bytes, r.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        reply = r.page_id == first.get(body)
        assert (r.record_type, r.refers_to) == (("response", None) if reply else ("revisit", first[body]))
        assert (r.intact, None if r.payload is None else bytes(r.payload)) == ((True, body) if reply else (None, None))
    for f in Path(folder.removeprefix("file:")).glob("part-*"):
        content = gzip.decompress(f.read_bytes())
        assert content.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and content.count(b"HTTP/1.1 200 OK\r\n") == content.count(b"msgtype=response")
    directory = warc.index(warc.read(spark, folder), f"{folder}-index", lines=2)
    assert directory.count() >= 4
    hits = warc.lookup(spark, f"{folder}-index", ["HTTP://B1.example.org/p?4", "http://none.org/"]).collect()
    assert [r.url for r in hits] == ["HTTP://B1.example.org/p?4"]
    head, body = warc.fetch(spark, hits[0].archive, hits[0].offset, hits[0].length)
    assert body == b"x" * 300_000 and head["WARC-Target-URI"] == "http://b1.example.org/p?4" and head["X-Page"] == "4"
    empty = f"{folder}-empty"
    warc.write(df.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


@pytest.mark.parametrize("ranged", [True, False])
@pytest.mark.parametrize("piece", [200_000, 4])
def test_warc_index_finds_every_page(spark, monkeypatch, ranged, piece):
    monkeypatch.setattr(warc, "DIRECTORY_ROWS", piece)
    rows = [(k, f"http://b{k % 3}.Example.org/p?{k}", f"<p>{k % 7}</p>") for k in range(40)]
    rows += [(7, "http://b1.example.org/p?7", "again"), (None, None, "solo"), *[(None, "u\r\nX:\ty", "many")] * 5, (99, "http://b0.example.org/p?0", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"{shared_folder(spark)}/test-warc-all-{ranged}-{piece}"
    warc.write(df.repartition(3), folder)
    records = warc.read(spark, folder)
    warc.index(records, f"{folder}-index", lines=2, files=3)
    if not ranged:
        monkeypatch.setattr(warc, "_store", lambda path: None)
    tell = lambda d: sorted((tuple(r) for r in d.collect()), key=repr)
    assert tell(warc.fetch_all(warc.captures(df, f"{folder}-index"), folder)) == tell(records) and records.count() == len(rows)
    some = warc.captures(df.where("page_id in (7, 99)"), f"{folder}-index")
    assert sorted(r.page_id for r in warc.fetch_all(some, folder).collect()) == [7, 7, 99]
    assert sorted(r.url for r in warc.lookup(spark, f"{folder}-index", ["http://b1.example.org/p?7", "http://b0.Example.org/p?0", "http://b0.example.org/none"]).collect()) == ["http://b0.Example.org/p?0"] * 2 + ["http://b1.example.org/p?7"] * 2
    assert warc.captures(spark.createDataFrame([(8, "http://b1.example.org/p?7")], "page_id long, url string"), f"{folder}-index").count() == 0


def test_warc_query_goes_through_the_index(spark, monkeypatch):
    """Without the index's lines the query has no rows."""
    made = []
    real = warc.index
    monkeypatch.setattr(warc, "index", lambda records, path, **options: made.append(path) or real(records.limit(0), path, **options))
    assert queries.op10_warc(spark, "/root/testdata/sf0.001").count() == 0 and made


def test_pipeline_stages(spark):
    import corpus_pipeline as p

    from .test_filters import brute_contamination, whole_characters

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    for k, (_, stage) in enumerate(p.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        docs = spark.createDataFrame(stage(spark, docs, d).collect(), stage(spark, docs, d).schema)
        after = {r.doc_id: r for r in docs.collect()}
        assert set(after) <= set(before) and len(after) == docs.count()
        if k < 4:
            assert docs.columns == columns
        if k == 1:
            classes = brute_classes([(r.doc_id, r.text) for r in before.values()])
            assert set(after) == {i for i, c, _ in classes if i == c}
        if k == 2:
            want = dict(whole_characters([(r.doc_id, r.text) for r in before.values()]))
            assert {i: r.text for i, r in after.items()} == {i: t for i, t in want.items() if t or not before[i].text}
        if k == 3:
            bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
            assert set(after) == {i for i, _, hit, _ in brute_contamination([(r.doc_id, r.text) for r in before.values()], bench) if not hit}
    assert docs.columns == ["doc_id", "n_tokens", "ids"] and docs.where("n_tokens <> size(ids)").count() == 0


def test_pipeline_stages_with_odd_rows(spark, odd_docs, no_docs):
    """Null, empty and long texts, repeated rows, rows without an id, an empty table, and columns named as operators name theirs."""
    import corpus_pipeline as p

    d = "/root/testdata/sf0.001"
    lost = odd_docs.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long"))
    for k, (_, stage) in enumerate(p.STAGES):
        docs = odd_docs.unionByName(lost)
        rows = stage(spark, docs, d).collect()
        empty = stage(spark, no_docs, d)
        assert empty.count() == 0
        if k == 4:
            assert empty.columns == ["doc_id", "n_tokens", "ids"] and len(rows) == docs.count()
            assert {r.doc_id: r.n_tokens for r in rows}[0] == 0
            continue
        assert empty.columns == no_docs.columns and stage(spark, docs, d).columns == docs.columns
        assert all(r[c] == "own" for r in rows for c in docs.columns if c not in no_docs.columns)
        if k != 1:
            assert {0, 1} <= {r.doc_id for r in rows} and len([r for r in rows if r.doc_id == 5]) == 2
        else:
            assert [r.doc_id for r in rows if not r.text] == [0] and 7 not in {r.doc_id for r in rows}
        if k == 2:
            assert all((r.n_chars or 0) == len(r.text or "") for r in rows) and len([r for r in rows if r.text and "t29999" in r.text]) == 1


def test_ids_that_are_no_whole_numbers(spark):
    """Operators that order by id say so loudly."""
    from pyspark.errors import PySparkException

    docs = spark.createDataFrame([("one", "some text"), ("2", "other")], "doc_id string, text string")
    for made in (lambda: ngramjoin.join(docs), lambda: suffix.repeats(docs), lambda: sketch.against_next(docs), lambda: warc.write(docs, f"{shared_folder(spark)}/no", id_col="doc_id", url_col="text", payload_col="text")):
        with pytest.raises(PySparkException):
            made().count()
