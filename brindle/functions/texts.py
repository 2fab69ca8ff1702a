"""Columns over text, names and tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
UNDETERMINED = ("n/a", "na", "none", "unmentioned", "not mentioned", "unspecified", "unstated", "unavailable", "undetermined", "not specified", "not found", "null")
IMPACT_LEVELS = ("low", "medium", "high", "critical", "transformative")
EXCLUDED_AUTHORS = ("[no-author]", "noreply", "hidden", "admin", "isbpostadmin", "unknown", "anonymous")
WORD_GAMES = ("hurdle hints", "nyt strands hints", "wordle today", "crossword today", "crossword hints", "nyt connections hints", "spelling bee hints", "wordle answers")
#: The characters of Unicode's white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
MAX_WORDS = 32767
TAG_LEN, TICKER_LEN = 50, 6


def count_words(text: Column) -> Column:
    """Pieces between white space, at most 32767; 0 for null."""
    return F.least(F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"(?U)\S+")), F.lit(MAX_WORDS))


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def cleanup_text(text: Column) -> Column:
    return F.nullif(trimmed(text), F.lit(""))


def cleanup_author(author: Column) -> Column:
    return F.when(~F.lower(author).isin(*EXCLUDED_AUTHORS), cleanup_text(author))


def is_word_game(title: Column) -> Column:
    low, hit = F.lower(F.coalesce(title, F.lit(""))), F.lit(False)
    for phrase in WORD_GAMES:
        hit = hit | F.contains(low, F.lit(phrase))
    return hit


def normalize_text(text: Column) -> Column:
    """Trimmed, newlines as spaces; null where it says that there is nothing."""
    t = F.replace(trimmed(text), F.lit("\n"), F.lit(" "))
    return F.when((t != "") & ~F.lower(t).isin(*UNDETERMINED), t)


def normalize_texts(items: Column) -> Column:
    return F.array_compact(F.transform(items, normalize_text))


def distinct_ignoring_case(items: Column) -> Column:
    """One item for each lower-cased value: at the first one's place, spelt as the last one."""
    keys = F.array_distinct(F.transform(items, F.lower))
    return F.transform(keys, lambda k: F.element_at(F.filter(items, lambda x: F.lower(x) == k), -1))


def normalize_names(items: Column) -> Column:
    bare = F.transform(items, lambda s: trimmed(F.regexp_replace(s, r"(?U)^[\W_]+|[\W_]+$", "")))
    return distinct_ignoring_case(F.filter(bare, lambda s: (s != "") & (F.char_length(s) <= TAG_LEN) & ~F.lower(s).isin(*UNDETERMINED)))


def snake(text: Column) -> Column:
    """snake_case: humps and runs that are no words become underscores."""
    t = F.regexp_replace(text, r"(\p{Ll}|\p{N})(\p{Lu})", "$1_$2")
    t = F.regexp_replace(t, r"(\p{Lu}+)(\p{Lu}\p{Ll})", "$1_$2")
    t = F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}]+", "_"))
    return F.regexp_replace(F.regexp_replace(t, "_+", "_"), "^_|_$", "")


def normalize_tags(items: Column) -> Column:
    return F.transform(normalize_names(items), snake)


def normalize_tickers(items: Column) -> Column:
    return F.filter(normalize_names(items), lambda s: (F.char_length(s) <= TICKER_LEN) & (s == F.upper(s)) & F.rlike(s, F.lit(r"\p{Lu}")))


def normalize_level(value: Column) -> Column:
    return F.when(F.lower(value).isin(*IMPACT_LEVELS), F.lower(value))


def normalize_context(tag: Column) -> Column:
    s = snake(tag)
    return F.when((F.char_length(s) <= TAG_LEN) & ~s.isin(*UNDETERMINED), s)


def normalize_impacts(items: Column) -> Column:
    """``<domain>: rest`` with the domain in snake_case and angle brackets off."""
    bare = lambda s: F.regexp_replace(trimmed(s), "^<|>$", "")
    at = lambda s: F.instr(s, ":")
    one = lambda s: F.when(at(s) > 0, F.concat(snake(bare(F.substr(s, F.lit(1), at(s) - 1))), F.lit(": "), bare(F.substr(s, at(s) + 1)))).otherwise(bare(s))
    return F.transform(F.filter(items, lambda s: s != ""), one)


#: How each digest field is normalised.
NORMALIZERS = {
    "regions": normalize_tags, "people": normalize_tags, "products": normalize_tags, "companies": normalize_tags, "entities": normalize_tags,
    "stock_tickers": normalize_tickers, "macro_context": normalize_context, "cross_domain_impacts": normalize_impacts, "event_type": normalize_context,
    "impacted_domains": normalize_tags, "impact_level": normalize_level, "confidence": normalize_level, "future_outlook": normalize_texts,
    "forecast": normalize_texts, "actions": normalize_texts, "activities": normalize_texts, "events": normalize_texts, "drivers": normalize_texts, "briefing": normalize_text,
}


def normalize_fields(df):
    """Apply the normaliser of each known column."""
    return df.withColumns({c: f(F.col(c)) for c, f in NORMALIZERS.items() if c in df.columns})


def merge_lists(*lists: Column) -> Column:
    """Distinct items of all lists, without null and empty ones."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(*[F.coalesce(x, empty) for x in lists]), lambda s: s.isNotNull() & (s != "")))


def merge_tags(*lists: Column) -> Column:
    return F.array_distinct(normalize_tags(merge_lists(*lists)))


def tags_to_text(*lists: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.array_join(F.array_compact(F.concat(*[F.coalesce(x, empty) for x in lists])), " ")


def lexemes(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def has_all_lexemes(text: Column, query: list[str]) -> Column:
    """Full-text match: every lexeme of the query is in the text."""
    import re

    wanted = list(dict.fromkeys(w for q in query for w in re.split(r"[\W_]+", q.lower()) if w))
    have = lexemes(text)
    return F.forall(F.array(*[F.lit(w) for w in wanted]) if wanted else F.array().cast("array<string>"), lambda w: F.array_contains(have, w))


def split_parts(text: Column, sep: str = "[,]+") -> Column:
    return F.filter(F.transform(F.split(text, sep), trimmed), lambda s: s != "")


def remove_before(text: Column, sub: str) -> Column:
    at = F.instr(text, sub)
    return F.when(at > 0, F.substr(text, at + len(sub))).otherwise(text)


def remove_after(text: Column, sub: str) -> Column:
    at = F.instr(text, sub)
    return F.when(at > 0, F.substr(text, F.lit(1), at - 1)).otherwise(text)


def without_null_bytes(text: Column) -> Column:
    return F.replace(text, F.lit("\x00"), F.lit("NULL_BYTE"))


def without_controls(html: Column) -> Column:
    return F.regexp_replace(html, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def from_first_heading(markdown: Column) -> Column:
    """Drop everything up to and with the first ``# `` line."""
    return F.regexp_replace(markdown, r"(?ms)\A.*?^# [^\n]*\n?", "")


def without_fences(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"^\s*```[A-Za-z]*\s*\n?", ""), r"\n?\s*```\s*$", "")


def parse_int(text: Column) -> Column:
    """A whole number, 0 where it is none."""
    return F.coalesce(trimmed(text.cast("string")).try_cast("int"), F.lit(0))


def truncated(text: Column, limit: int) -> Column:
    return F.substring(text, 1, limit)
