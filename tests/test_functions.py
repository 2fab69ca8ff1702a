"""Scalar functions, against Python or truth tables."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from brindle.functions import dates, html, kinds, texts, urls, vectors

NOW = dt.datetime(2024, 2, 1)


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_urls(spark):
    rows = [("HTTPS://User@www.Example.co.uk:8080/a/b.PDF?x=1#f",), ("http://news.site.com/some-title_here.html",), ("no url",), (None,)]
    u = F.col("u")
    got = one(spark, rows, "u string", urls.base_url(u), urls.domain(u), urls.without_query(u), urls.is_pdf_url(u), urls.title_from_path(u))
    assert got[0] == ("User@www.Example.co.uk:8080", "example", "HTTPS://User@www.Example.co.uk:8080/a/b.PDF", True, "b")
    assert got[1] == ("news.site.com", "site", "http://news.site.com/some-title_here.html", False, "some title here")
    assert got[3][:3] == (None, None, None)
    assert one(spark, [("http://a.com/x",), ("http://www.a.com/",)], "u string", urls.with_www(u)) == [("http://www.a.com/x",), (None,)]
    assert one(spark, [("http://a.com/x/y", "../z?q"), ("http://a.com", None)], "b string, t string", urls.resolve(F.col("b"), F.col("t"))) == [("http://a.com/z?q",), (None,)]


def test_uuid5_equals_pythons(spark):
    names = ["https://Example.com/A ", "http://é.com/ü", "x"]
    got = one(spark, [(n,) for n in names], "u string", urls.uuid5(F.col("u")))
    assert got == [(str(uuid.uuid5(uuid.NAMESPACE_URL, n.strip().lower())),) for n in names]


@pytest.mark.parametrize(
    ("url", "out"),
    [(None, True), ("", True), ("http://a.com/x.png", True), ("http://a.com/x.png?y", False), ("https://youtube.com/w", True), ("http://a.com/video/1", True), ("http://a.ru/x", True), ("http://a.rus/x", False), ("http://tass.com/a", True), ("http://mytass.com/a", False), ("http://a.com/text", False)],
)
def test_excluded_urls(spark, url, out):
    assert one(spark, [(url,)], "u string", urls.excluded(F.col("u"))) == [(out,)]


def test_content_gate(spark):
    rows = [("http://a.com/x", "text/html; charset=utf-8", 10), ("http://a.com/x", "image/png", 10), ("http://a.com/x.pdf", "application/pdf", 17 << 20), ("http://a.com/x", None, None)]
    got = one(spark, rows, "u string, t string, n long", urls.gate(F.col("u"), F.col("t"), F.col("n")))
    assert [g[0].excluded for g in got] == [False, True, True, False] and got[2][0].is_pdf


def test_texts(spark):
    t = F.col("t")
    rows = [("  a b c\n",), ("",), (None,), ("Not Mentioned",)]
    assert one(spark, rows, "t string", texts.count_words(t), texts.cleanup_text(t), texts.normalize_text(t)) == [(3, "a b c", "a b c"), (0, None, None), (0, None, None), (2, "Not Mentioned", None)]
    assert one(spark, [("NoReply",), (" Jane ",), (None,)], "t string", texts.cleanup_author(t)) == [(None,), ("Jane",), (None,)]
    names = [["'Open AI'", "openai!", "OpenAI", "n/a", "x" * 51, "é!", "__"]]
    assert one(spark, [(n,) for n in names], "t array<string>", texts.normalize_names(t)) == [(["Open AI", "OpenAI", "é"],)]
    assert one(spark, [("HTTPServerError v2",), ("snake_case-here",), ("Élan Vital",)], "t string", texts.snake(t)) == [("http_server_error_v2",), ("snake_case_here",), ("élan_vital",)]
    assert one(spark, [(["AAPL", "Apple", "TOOLONGX", "MSFT "],)], "t array<string>", texts.normalize_tickers(t)) == [(["AAPL", "MSFT"],)]
    assert one(spark, [(["<Energy Sector>: <up>", "plain", ""],)], "t array<string>", texts.normalize_impacts(t)) == [(["energy_sector: up", "plain"],)]
    assert one(spark, [("HIGH",), ("huge",)], "t string", texts.normalize_level(t)) == [("high",), (None,)]
    assert one(spark, [("a, b,,c ",)], "t string", texts.split_parts(t)) == [(["a", "b", "c"],)]
    assert one(spark, [("abcXdeX",)], "t string", texts.remove_before(t, "X"), texts.remove_after(t, "X")) == [("deX", "abc")]
    assert one(spark, [("intro\n# Title\nbody",)], "t string", texts.from_first_heading(t)) == [("body",)]
    assert one(spark, [("12",), ("x",), (None,)], "t string", texts.parse_int(t)) == [(12,), (0,), (0,)]
    assert one(spark, [("a\x00b",)], "t string", texts.without_null_bytes(t)) == [("aNULL_BYTEb",)]


def test_dates(spark):
    as_of = F.lit("2024-02-01").cast("timestamp")
    rows = [("2024-01-05T10:00:00+02:00",), ("Fri, 05 Jan 2024 10:00:00 GMT",), ("Jan 5 2024",), ("2010-01-01",), ("nonsense",), (None,)]
    got = [r[0] for r in one(spark, rows, "t string", dates.parse(F.col("t"), as_of))]
    assert got == [dt.datetime(2024, 1, 5, 8), dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 5), None, None, None]
    assert one(spark, [(1_900_000_000,), (1_700_000_000,)], "t long", dates.from_epoch(F.col("t"), as_of)) == [(NOW,), (dt.datetime(2023, 11, 14, 22, 13, 20),)]


@pytest.mark.parametrize(
    ("item", "kind"),
    [
        ({"feed": "https://www.sec.gov/news/pressreleases.rss"}, "press_release"),
        ({"feed": "https://www.govinfo.gov/rss/uscourts-ca9.xml"}, "court_opinion"),
        ({"url": "https://www.SEC.gov/Archives/edgar/data/1"}, "sec_filing"),
        ({"url": "https://arxiv.org/abs/1"}, "research_paper"),
        ({"url": "https://x.org/docs/a"}, "technical_documentation"),
        ({"title": "Q3 earnings beat"}, "earnings_report"),
        ({"title": "Smith v. Jones"}, "lawsuit"),
        ({"title": "A Working Paper on X"}, "research_paper"),
        ({"content": "This Agreement is entered into by"}, "contract"),
        ({"source": "reddit"}, "post"),
        ({"url": "https://a.substack.com/p"}, "blog"),
        ({"title": "Episode 5"}, "podcast"),
        ({"title": "Headline of the day"}, "news"),
        ({"title": "An opinion"}, "blog"),
        ({"site_name": "The Daily"}, "news"),
        ({"site_name": "My Weekly"}, "blog"),
        ({"url": "https://a.com/news/1"}, "news"),
        ({"title": "A sewing machine", "source": "plain"}, None),
    ],
)
def test_kinds(spark, item, kind):
    columns = {k: F.lit(v) for k, v in item.items()}
    assert spark.range(1).select(kinds.content_kind(**columns)).first()[0] == kind


HTML = """<html lang="en"><head><title>T &amp; t</title><meta property="og:title" content="OG"><meta name="description" content="D">
<link rel="canonical" href="https://a.com/c"><script type="application/ld+json">{"@graph":[{"@type":"NewsArticle","headline":"H","author":[{"name":"N"}],"articleBody":"Body","datePublished":"2024-01-01"}]}</script></head>
<body><nav><a href="/n">nav</a></nav><h1>Head</h1><p>One <b>bold</b> and <a href="/l">link</a>.</p><ul><li>x</li><li>y</li></ul><script>var a="</p>";</script><p>broken <i>tail</body>"""


def test_html():
    assert html.to_text(HTML) == "nav Head One bold and link. x y broken tail"
    md = html.to_markdown(HTML)
    for part in ("# Head", "One **bold** and [link](/l).", "- x\n- y"):
        assert part in md
    assert "nav" not in html.to_markdown(HTML, True)
    m = html.to_metadata(HTML)
    assert (m["title"], m["description"], m["url"], m["language"], m["site_name"]) == ("OG", "D", "https://a.com/c", "en", None)
    assert html.to_json_ld(HTML) == {"title": "H", "author": "N", "content": "Body", "published_time": "2024-01-01"}
    p = html.to_page(HTML)
    assert (p["title"], p["content"], p["author"]) == ("OG", "Body", "N")
    for x in (None, ""):
        assert html.to_text(x) is None and html.to_markdown(x) is None and html.to_json_ld(x)["title"] is None
    assert html.to_markdown("   ") is None


def test_html_columns(spark):
    df = spark.createDataFrame([(HTML,), (None,), ("",)], "h string")
    rows = df.select(html.strip_tags(F.col("h")), html.metadata(F.col("h"))["title"], html.title(F.col("h")), html.page(F.col("h"))["author"]).collect()
    assert tuple(rows[0]) == ("nav Head One bold and link. x y broken tail", "OG", "T &amp; t", "N") and rows[1][0] is None


def test_vectors(spark):
    rows = [([1.0, 0.0], [0.0, 1.0]), ([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 2.0])]
    got = one(spark, rows, "a array<float>, b array<float>", vectors.cosine_distance(F.col("a"), F.col("b")), vectors.l2(F.col("a"), F.col("b")), vectors.dot(F.col("a"), F.col("b")))
    assert got[0] == (1.0, pytest.approx(2**0.5), 0.0) and got[1] == (pytest.approx(0), 0.0, 25.0) and got[2][0] is None and got[3] == (None, None, None)


def plain_suffix(rules, host):
    """All rules tried one by one."""
    labels = host.split(".")
    hits = []
    for rule in rules:
        own = rule.removeprefix("!").split(".")
        if len(own) <= len(labels) and all(a in ("*", b) for a, b in zip(own, labels[-len(own) :], strict=True)):
            hits.append((rule.startswith("!"), len(own)))
    if any(e for e, _ in hits):
        return min(n for e, n in hits if e) - 1
    return max((n for _, n in hits), default=0)


def test_suffixes_are_the_longest_rule(spark):
    import random

    from brindle.functions import suffixes

    rules = ["com", "uk", "co.uk", "*.uk", "ck", "*.ck", "!www.ck", "*.kobe.jp", "!city.kobe.jp", "jp", "b.c.d", "*.c.d", "x.*.d", "d", "a.a", "münchen.de", "de"]
    trie = suffixes.Suffixes(["// comment", "", *rules[:8], "co.uk  // twice", *rules[8:]])
    draw = random.Random(4)
    for _ in range(3000):
        host = ".".join(draw.choice("a b c d uk co ck www kobe jp city com x de".split()) for _ in range(draw.randint(1, 5)))
        n = plain_suffix(rules, host)
        suffix, domain, registered = trie.parts(host)
        labels = host.split(".")
        assert suffix == ".".join(labels[len(labels) - n :]) and domain == (labels[len(labels) - n - 1] if n < len(labels) else None), host
        assert registered == (".".join(labels[len(labels) - n - 1 :]) if 0 < n < len(labels) else None)
    urls_ = ["https://News.BBC.co.uk:8080/x?y", "http://127.0.0.1/a", "http://u:p@www.example.com.", "http://co.uk/", "http://unknown.zone/", None, "nothing", "http://a.xn--mnchen-3ya.de", "http://b.münchen.de"]
    rows = spark.createDataFrame([(k, u) for k, u in enumerate(urls_)], "k int, u string")
    got = {r.k: (r.p.suffix, r.p.domain, r.p.registered) for r in rows.select("k", suffixes.parts(spark, F.col("u"), trie).alias("p")).collect()}
    assert got == {0: ("co.uk", "bbc", "bbc.co.uk"), 1: ("", "127.0.0.1", None), 2: ("com", "example", "example.com"), 3: ("co.uk", None, None), 4: ("", "zone", None), 5: (None, None, None), 6: (None, None, None), 7: ("xn--mnchen-3ya.de", "a", "a.xn--mnchen-3ya.de"), 8: ("münchen.de", "b", "b.münchen.de")}
    private = ["com", "// ===BEGIN PRIVATE DOMAINS===", "blog.com", "// ===END PRIVATE DOMAINS==="]
    assert suffixes.Suffixes(private, private=False).parts("x.blog.com")[1] == "blog" and suffixes.Suffixes(private).parts("x.blog.com")[1] == "x"
    names = [r.s for r in rows.orderBy("k").select(suffixes.source(spark, F.col("u"), trie).alias("s")).collect()]
    assert names[0] == "bbc" and names[3] == "co.uk"


DATES = [
    ("2024-01-05T10:00:00Z", "2024-01-05 10:00:00"), ("2024-01-05T10:00:00.123456+02:00", "2024-01-05 08:00:00.123456"), ("2024-01-05 10:11:12", "2024-01-05 10:11:12"), ("Fri, 05 Jan 2024 10:00:00 GMT", "2024-01-05 10:00:00"),
    ("Fri, 05 Jan 2024 10:00:00 -0530", "2024-01-05 15:30:00"), ("January 5, 2024", "2024-01-05 00:00:00"), ("Jan. 5th, 2024 at 3:04 pm", "2024-01-05 15:04:00"), ("5th of January 2024", "2024-01-05 00:00:00"),
    ("5 January, 2024, 12:30 a.m.", "2024-01-05 00:30:00"), ("2024/01/05", "2024-01-05 00:00:00"), ("01/05/2024", "2024-01-05 00:00:00"), ("25/12/2023", "2023-12-25 00:00:00"), ("05.01.24", "2024-05-01 00:00:00"),
    ("Sat Jan 06 10:00:00 UTC 2024", "2024-01-06 10:00:00"), ("20240105", "2024-01-05 00:00:00"), ("20240105T101112Z", "2024-01-05 10:11:12"), ("20240105 10:11", "2024-01-05 10:11:00"), ("2024-Jan-05", "2024-01-05 00:00:00"),
    ("Published on March 3, 2023 by Ann, 5 comments", "2023-03-03 00:00:00"), ("January 2024", "2024-01-01 00:00:00"), ("2024-02-30", None), ("hello", None), ("", None), (None, None), ("12:30", None), ("99/99/9999", None),
    ("5pm 3 Feb 2023", "2023-02-03 17:00:00"), ("12 pm Jan 3 2024", "2024-01-03 12:00:00"), ("Dec 31 99", "1999-12-31 00:00:00"), ("2024-01-05T10:00", "2024-01-05 10:00:00"), ("2024-01-05 10:00:00 EST", "2024-01-05 10:00:00"),
    ("Sept 4 2023", "2023-09-04 00:00:00"), ("MAY 4, 2023", "2023-05-04 00:00:00"),
]


def test_free_form_dates(spark):
    as_of = F.lit("2024-02-01").cast("timestamp")
    rows = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(DATES)], "k int, t string").select("k", dates.free_form(F.col("t"), as_of).cast("string").alias("r")).collect()
    assert {DATES[r.k][0]: r.r for r in rows} == dict(DATES)


def test_readable_body():
    """The article's paragraphs, wherever the page puts them, without the menus, lists of links and advertisements around and in it."""
    text = "A sentence of the article, which is long enough to count, and goes on for a while. "
    paragraphs = "".join(f"<p>{k} {text * 3}" for k in range(4))  # unclosed
    links = "".join(f'<li><a href="/{k}">Another headline of the site {k}</a></li>' for k in range(9))
    pages = [
        f'<body><nav>{links}</nav><div class="sidebar"><p>{text}</p></div><article><h1>Title</h1>{paragraphs}</article><footer>about {text}</footer></body>',
        f'<div id="top"><div class="ad">Buy, buy, buy: a long advertisement text that has commas, too.</div><div class="story"><div class="related"><ul>{links}</ul></div>{paragraphs}<div class="share">tweet this page, and like it</div></div></div>',
        f'<table><tr><td class="menu">{links}</td><td>{paragraphs}</td></tr></table>',
        f"<div><div>{paragraphs}</div><div><ul>{links}</ul></div><div class=comments><p>first, {text}</p></div></div>",
    ]
    for page in pages:
        content = html.to_page(page)["content"]
        assert all(f"{k} A sentence" in content for k in range(4)), page
        assert not any(x in content for x in ("headline", "Buy", "about A", "first,", "tweet")), content
        assert content.count("A sentence of the article") == 12
    assert html.to_page("<p>short</p>")["content"] == "short" and html.to_page("")["content"] is None
    assert "[x](/x)" in html.to_page(f'<div><p>{text}<a href="/x">x</a></p><p>{text}</p></div>')["content"]
