"""Columns over urls and ids."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The UUID namespace for urls, and two-part public suffixes under which a name is registered.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
TWO_PART_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.in", "com.br", "com.cn", "com.mx", "co.za", "com.sg", "com.tr")

# Urls that are never content.
EXCLUDED = (
    r"\.(png|jpeg|jpg|gif|webp|mp4|avi|mkv|mp3|wav)$",
    r"(v\.redd\.it|i\.redd\.it|www\.reddit\.com\/gallery|youtube\.com|youtu\.be)",
    r"\/video(s)?\/",
    r"\/image(s)?\/",
    r"://[^/?#]+\.ru(?:[:/?#]|$)",
    r"://[^/?#]+\.su(?:[:/?#]|$)",
    r"(?:^|//|\.)(?:tass\.com|rt\.com|newsru\.com|russia-insider\.com|pravdareport\.com|sputniknews\.com|sputnikglobe\.com)(?:[:/]|$)",
)
# MIME types that can be read.
HTML_TYPES = ("text/html", "application/xhtml+xml", "text/xml", "application/xml", "application/rss+xml", "application/atom+xml", "text/plain")
PDF_TYPE = "application/pdf"


def uuid5(name: Column) -> Column:
    """Version 5 UUID of the trimmed, lower-cased name in the url namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.lower(F.trim(name)).cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def uuid5_or_null(name: Column) -> Column:
    return F.when(F.length(name) > 0, uuid5(name))


def base_url(url: Column) -> Column:
    """Authority: host with port and user, case kept; empty without a scheme."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def host(url: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(base_url(url), r"^.*@", ""), r":\d*$", ""))


def domain(url: Column) -> Column:
    """The registered label: example of www.example.co.uk.  Suffixes are the last label, or a listed pair."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    pair = F.array_join(F.slice(labels, -2, 2), ".")
    at = F.when((n > 2) & pair.isin(*TWO_PART_SUFFIXES), n - 2).otherwise(n - 1)
    return F.when(n > 1, F.try_element_at(labels, at)).otherwise(F.when(n == 1, labels[0]))


def source(url: Column) -> Column:
    return F.lower(F.trim(F.coalesce(F.nullif(domain(url), F.lit("")), base_url(url))))


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def with_www(url: Column) -> Column:
    """The url with www., or null where it has it already or has no host."""
    net = base_url(url)
    return F.when((net != "") & ~net.startswith("www."), F.regexp_replace(url, r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?//)", "$1www."))


def clean(url: Column) -> Column:
    return F.nullif(F.lower(F.trim(url)), F.lit(""))


def is_pdf_url(url: Column) -> Column:
    return F.coalesce(F.rlike(without_query(url), F.lit(r"(?i)/[^?#]*\.pdf$")), F.lit(False))


def is_pdf(url: Column, content_type: Column) -> Column:
    return F.coalesce(_mime(content_type) == PDF_TYPE, F.lit(False)) | is_pdf_url(url)


def _mime(content_type: Column) -> Column:
    return F.lower(F.trim(F.substring_index(content_type, ";", 1)))


def excluded(url: Column) -> Column:
    hit = F.lit(False)
    for p in EXCLUDED:
        hit = hit | F.rlike(url, F.lit(p))
    return F.coalesce(hit | (url == ""), F.lit(True))


def gate(url: Column, content_type: Column, content_length: Column, *, html_only: bool = False, max_html: int = 16 << 20, max_pdf: int = 16 << 20) -> Column:
    """struct<excluded,is_pdf,max_size>: whether a response may be read, by url, MIME type and size."""
    allowed = HTML_TYPES if html_only else (*HTML_TYPES, PDF_TYPE)
    pdf = is_pdf(url, content_type)
    most = F.when(pdf, F.lit(max_pdf)).otherwise(F.lit(max_html))
    mime = F.coalesce(_mime(content_type), F.lit(""))
    out = excluded(url) | ((mime != "") & ~mime.isin(*allowed)) | (F.coalesce(content_length, F.lit(0)) > most)
    return F.struct(out.alias("excluded"), pdf.alias("is_pdf"), most.alias("max_size"))


def title_from_path(url: Column) -> Column:
    """A readable title from the last path segment: decoded, without extension, dashes as spaces."""
    name = F.regexp_extract(without_query(url), r"([^/]*)/?$", 1)
    plain = F.regexp_replace(F.try_url_decode(name), r"\.[A-Za-z0-9]{1,5}$", "")
    return F.nullif(F.trim(F.regexp_replace(F.translate(plain, "-_", "  "), r"\s+", " ")), F.lit(""))


def dated_id(text: Column, as_of: Column) -> Column:
    return F.concat(F.date_format(as_of, "yyyy_MM_dd"), F.lit("_"), F.sha1(text.cast("binary")))


def accession_number(url: Column) -> Column:
    return F.nullif(F.regexp_extract(url, r"(\d{10}-\d{2}-\d{6})", 1), F.lit(""))


def filing_type(title: Column) -> Column:
    return F.nullif(F.upper(F.regexp_extract(title, r"(?i)\b(10-[KQ](?:/A)?|8-K(?:/A)?|20-F|40-F|S-[134]|DEF\s*14A)\b", 1)), F.lit(""))


def resolve(base: Column, target: Column) -> Column:
    """RFC 3986 resolution of a reference, which no built-in function does; Arrow batches."""
    @F.pandas_udf("string")
    def join(b: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else urljoin(x, y) for x, y in zip(b, t, strict=True)], dtype=object)

    return join(base, target)
