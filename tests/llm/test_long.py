"""Cases that only size or odd columns bring: a url filter's two ways, long unbroken texts, many equal rows."""

import random

import pytest
from pyspark.sql import functions as F

from brindle.llm import pieces, queries, shards, urlfilter


@pytest.mark.parametrize("inline", [200, 0])
def test_both_ways_of_the_url_filter_give_the_same(spark, inline):
    """A null url that a pattern fits, repeated rows, and columns of any name."""
    rows = [(1, None), (2, "http://ads.example.org/x"), (2, "http://ads.example.org/x"), (3, ""), (4, "nothing"), (5, "http://b.org/?q=ads")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    clash = ["_url", "_best", "_low", "_site", "token", "best", "low", "site", "page", "of", "host", "rule"]
    df = df.withColumns({c: F.lit("own") for c in clash})
    rules = [*urlfilter.filters([r"/^$/", "||ads."]), urlfilter.site_rule("allow", "b.org/")]
    got = urlfilter.judge(df, rules, inline=inline)
    assert [c for c in got.columns if c not in urlfilter.RESULTS] == [c for c in df.columns if c not in urlfilter.RESULTS]
    told = sorted((r.page_id, r.rule, r.pattern, r.verdict) for r in got.collect())
    assert told == [(1, None, "/^$/", "block"), (2, None, "||ads.", "block"), (2, None, "||ads.", "block"), (3, None, "/^$/", "block"), (4, None, None, "allow"), (5, "b.org/", None, "allow")]
    assert got.where("_url = 'own' and _best = 'own' and _low = 'own' and _site = 'own' and token = 'own' and best = 'own' and page = 'own' and of = 'own'").count() == 6


@pytest.mark.parametrize("alphabet", ["etaoinsrhl", "ab", "a", "=-", "aé漢😀z", "thequickand"])
def test_windows_of_a_text_without_spaces(monkeypatch, alphabet):
    model = pieces.PieceModel(pieces.load(queries.PIECES))
    draw = random.Random(len(alphabet))
    texts = [pieces.MARK + "".join(draw.choice(alphabet) for _ in range(n)) for n in (90, 400, 1500)]
    whole = [model.segment(t) for t in texts]
    for window in (20, 64, 300):
        monkeypatch.setattr(pieces, "WINDOW", window)
        assert [model.segment(t) for t in texts] == whole


def test_windows_where_paths_never_meet():
    """Two segmentations of equal score run side by side until the last character: no window settles anything, and the text is worked off as one."""
    model = pieces.PieceModel([("ab", -1.0, "normal"), ("ba", -1.0, "normal"), ("a", -9.0, "normal"), ("b", -9.0, "normal")])
    text = "ab" * 300 + "a"
    want = model.segment(text)
    pieces_window, pieces.WINDOW = pieces.WINDOW, 16
    try:
        assert model.segment(text) == want
    finally:
        pieces.WINDOW = pieces_window


def test_many_equal_rows_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(shards, "PART_ROWS", 50)
    df = spark.createDataFrame([(None if k % 2 else 1, None) for k in range(700)] + [(k, f"text {k}") for k in range(90)], "doc_id long, text string")
    got = shards.assign(df, 4).collect()
    assert len(got) == 790
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert len({r.shard for r in got if r["size"] == 1}) == 1  # one group


def test_a_very_long_turn_beside_columns_of_any_name(spark):
    from brindle.llm import chat

    text = "é<|im_end|>\n&amp; " * 60_000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "assistant", "short")], "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("own") for c in ("t", "ts", "at", "k", "targets", "context", "example", "n_examples", "raw")})
    got = {r.example: r for r in chat.expand(df).select("example", chat.loss_text(F.concat("context", "target"), F.col("loss_start"), F.col("loss_end")).alias("loss"), F.size(chat.parse(F.concat("context", "target"))).alias("n")).collect()}
    assert got[1].loss == text and got[2].loss == "short" and [got[k].n for k in (1, 2)] == [2, 3]
    assert chat.expand(df.limit(0)).count() == 0
