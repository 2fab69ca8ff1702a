"""The content-kind cascade: the first signal that speaks decides, from feed and url to site name.

One expression: every rule list is a chain of regular expressions in order, so it runs inside the scan's stage.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Feeds whose kind is known.
FEEDS = {
    "https://www.sec.gov/news/pressreleases.rss": "press_release",
    "https://www.sec.gov/news/statements.rss": "official_statement",
    "https://www.sec.gov/news/speeches-statements.rss": "official_statement",
    "https://www.sec.gov/enforcement-litigation/administrative-proceedings/rss": "enforcement_action",
    "https://www.sec.gov/enforcement-litigation/litigation-releases/rss": "enforcement_action",
}
# Patterns of feeds, in order.
FEED_PATTERNS = (
    ("legislative_bill", r"/rss/bills(?:-enr)?\.xml$"),
    ("enacted_law", r"/rss/plaw\.xml$"),
    ("enacted_law", r"/rss/(?:statute|uscode)\.xml$"),
    ("regulation", r"/rss/cfr\.xml$"),
    ("rulemaking_notice", r"/rss/fr\.xml$"),
    ("court_opinion", r"/rss/uscourts-[a-z0-9]+\.xml$"),
    ("court_opinion", r"/rss/usreports\.xml$"),
    ("hearing", r"/rss/chrg\.xml$"),
    ("legislative_record", r"/rss/(?:crec|crecb|hjournal|sjournal)\.xml$"),
    ("budget_document", r"/rss/(?:budget|erp)\.xml$"),
    ("government_report", r"/rss/(?:gaoreports|crpt|cprt)\.xml$"),
)
# Patterns of urls, in order.
URL_PATTERNS = (
    ("sec_filing", r"(?:sec\.gov/(?:archives/edgar|ixviewer)|/edgar/data/)"),
    ("procurement_notice", r"sam\.gov/opp/"),
    ("contract", r"(?:sam\.gov/award/|usaspending\.gov/award/)"),
    ("legislative_bill", r"(?:congress\.gov/(?:bill|legislation)/|govtrack\.us/congress/bills/|legiscan\.com/.*/bill/|govinfo\.gov/content/pkg/bills-)"),
    ("enacted_law", r"(?:congress\.gov/public-law/|govinfo\.gov/content/pkg/(?:plaw|statute|uscode)-)"),
    ("regulation", r"(?:ecfr\.gov/|govinfo\.gov/content/pkg/cfr-)"),
    ("rulemaking_notice", r"(?:federalregister\.gov/documents/|regulations\.gov/(?:document|docket)/|govinfo\.gov/content/pkg/fr-)"),
    ("court_opinion", r"(?:supremecourt\.gov/opinions/|courtlistener\.com/opinion/|law\.justia\.com/cases/|govinfo\.gov/content/pkg/(?:uscourts|usreports)-)"),
    ("lawsuit", r"(?:courtlistener\.com/docket/|pacer\.uscourts\.gov/)"),
    ("earnings_report", r"(?:/earnings(?:[-_/]|\?|\b)|/quarterly[-_/]?(?:results|earnings)|/financials/quarterly-results)"),
    ("financial_report", r"(?:/annual-reports?/|/financials/(?:annual|reports?))"),
    ("research_paper", r"(?:arxiv\.org/(?:abs|pdf)/|doi\.org/10\.)"),
    ("technical_documentation", r"(?:/docs?/(?:[^/]+/)?|readthedocs\.io/)"),
)
# Patterns of titles, summaries, descriptions and tags, in order.
TITLE_PATTERNS = (
    ("sec_filing", r"\b(?:form\s+(?:10-[kq]|8-k(?:/a)?|20-f|40-f|def\s*14a|s-[134])|(?:10-[kq]|8-k(?:/a)?|20-f|40-f|def\s*14a)\s+(?:filing|annual report|quarterly report))\b"),
    ("earnings_report", r"\b(?:q[1-4]|first|second|third|fourth)\s+(?:quarter\s+)?(?:\d{4}\s+)?(?:earnings|financial results)|earnings\s+(?:results|release|report)|quarterly\s+results|full[- ]year\s+results\b"),
    ("financial_report", r"\b(?:annual|quarterly|financial)\s+report\b|\bform\s+(?:10-k|10-q|20-f|40-f)\b"),
    ("contract", r"\b(?:master\s+(?:service|purchase)\s+agreement|(?:asset|purchase|employment|license|lease|credit|share)\s+agreement|definitive\s+agreement|contract\s+(?:award|agreement)|indenture)\b"),
    ("legislative_proposal", r"\b(?:draft\s+(?:bill|legislation)|proposed\s+(?:bill|legislation|act)|legislative\s+proposal)\b"),
    ("lawsuit", r"\b(?:class action|civil|antitrust)\s+(?:lawsuit|complaint)|\bcomplaint\s+(?:filed|against|for)\b|\b[a-z][\w.& -]+\s+v\.\s+[a-z]"),
    ("court_opinion", r"\b(?:opinion of the court|court opinion|memorandum opinion|per curiam)\b"),
    ("press_release", r"\b(?:press release|news release|media release)\b"),
    ("official_statement", r"\b(?:official\s+)?(?:statement|remarks|speech)\s+(?:by|from)\b"),
    ("enforcement_action", r"\b(?:enforcement action|administrative proceeding|litigation release|cease-and-desist order)\b"),
    ("government_report", r"\b(?:gao|inspector general|government accountability office)\s+report\b"),
    ("whitepaper", r"\bwhite\s*paper\b"),
    ("research_paper", r"\b(?:research|working)\s+paper\b"),
)
# Patterns of bodies, in order.
BODY_PATTERNS = (
    ("sec_filing", r"\b(?:united states securities and exchange commission|form 10-[kq])\b"),
    ("contract", r"\bthis (?:agreement|contract) is (?:made|entered into)\b"),
    ("financial_report", r"\bconsolidated financial statements\b"),
    ("court_opinion", r"\b(?:opinion of the court|memorandum opinion|per curiam)\b"),
    ("whitepaper", r"\bwhite\s*paper\b"),
)
# Words that hint at a kind.
POST_DOMAINS = ("reddit", "redd", "linkedin", "x", "twitter", "facebook", "ycombinator")
BLOG_URLS = ("medium.com", "substack.", "wordpress.", "blogspot.", "newsletter.", "developers.", "blogs.", "blog.", ".so/", ".dev/", ".io/", ".to/", ".rs/", ".tech/", ".ai/", ".blog/", "/blog/", "/reviews/")
BLOG_SITES = ("blog", "magazine", "newsletter", "weekly")
NEWS_SITES = ("daily", "wire", "times", "today", "news", "the ")
NEWS_TAGS = ("news", "headline", "press release", "announcement")
BLOG_TAGS = ("blog", "newsletter", "analysis", "opinion", "review")
PODCAST_SITES = ("podcast", "show", "episode")
PODCAST_TAGS = ("podcast", "episode", "show")


def _first(patterns, text: Column) -> Column:
    return F.coalesce(*[F.when(F.rlike(text, F.lit(f"(?U){p}" if "\\b" in p or "\\w" in p or "\\s" in p else p)), F.lit(kind)) for kind, p in patterns])


def _any(words, text: Column) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | F.contains(text, F.lit(w))
    return hit


def content_kind(*, url=None, base_url=None, title=None, summary=None, description=None, tags=None, content=None, source=None, site_name=None, feed=None, own_feed=None) -> Column:
    """The kind of an item, null where nothing speaks; arguments are Columns, tags an array."""
    low = lambda c: F.lit("") if c is None else F.lower(F.coalesce(c, F.lit("")))
    u, b, site = low(url), low(base_url), low(site_name)
    words = F.lit("") if tags is None else F.lower(F.coalesce(F.array_join(tags, " "), F.lit("")))
    told = F.concat_ws(" ", low(title), low(summary), low(description), words)
    steps = []
    for f in (feed, own_feed):
        if f is not None:
            steps += [F.when(low(f) == k, F.lit(v)) for k, v in FEEDS.items()]
            steps.append(_first(FEED_PATTERNS, low(f)))
    steps += [
        _first(URL_PATTERNS, F.concat_ws(" ", u, b)),
        _first(TITLE_PATTERNS, told),
        _first(BODY_PATTERNS, low(content)),
        F.when(_any(POST_DOMAINS, low(source)), "post"),
        F.when(_any(BLOG_URLS, u) | _any(BLOG_URLS, b), "blog"),
        F.when(_any(PODCAST_TAGS, told) | _any(PODCAST_SITES, site), "podcast"),
        F.when(_any(NEWS_TAGS, told), "news"),
        F.when(_any(BLOG_TAGS, told), "blog"),
        F.when(_any(BLOG_SITES, site), "blog"),
        F.when(_any(NEWS_SITES, site) | F.contains(u, F.lit("/news/")), "news"),
    ]
    return F.coalesce(*steps)
