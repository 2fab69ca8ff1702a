"""Columns over dates; the present is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The months' names by their first letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MAX_AGE_DAYS = 5 * 365

_MONTH = "(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
# a time of day, its half and its zone; what follows a date of digits after a T is one
_CLOCK = r"(?:(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*(?:([ap])\.?m\b\.?)?|(\d{1,2})\s*([ap])\.?m\b\.?)(?:\s*(?:z|utc|gmt)\b)?(?:\s*([+-])(\d{2}):?(\d{2})?(?!\d))?"
_TIME = rf"(?i)(?:(?<=\d)t|(?<![\w:.])){_CLOCK}"
_SPLIT = r"(?:st|nd|rd|th)?(?:,?\s+(?:of\s+)?|\s*[-/.,]\s*)"
# three of day, month and year, the month a number or a name; or a name and a year
_DATE = rf"(?i)(?<![\w])(?:(\d{{1,4}}|{_MONTH}\.?){_SPLIT}(\d{{1,2}}|{_MONTH}\.?){_SPLIT}(\d{{1,4}})(?![\d:])(?!\w*[a-su-z])|({_MONTH})\.?,?\s+(\d{{4}})(?!\d))"
_COMPACT = r"(?i)(?<!\d)(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2})?)?(?!\d)"


def usable(created: Column, as_of: Column) -> Column:
    return F.coalesce(created >= as_of - F.expr(f"INTERVAL {MAX_AGE_DAYS} DAYS"), F.lit(False))


def _month(token: Column) -> Column:
    """The number of a month, from its name or number; null if it is neither."""
    name = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(token, 1, 3))).cast("int")
    return F.when(F.rlike(token, F.lit("^[0-9]")), token.try_cast("int")).otherwise(F.nullif(name, F.lit(0)))


def free_form(text: Column, as_of: Column) -> Column:
    """The instant that a free-form date names, with other text around it or not; null if there is none.

    A time of day is looked for and taken out, then three tokens that may be day, month and year.  Their classes resolve them: a name is the month; a number of three or four digits or over 31 the
    year; without a name, the year comes first or last, and the month before the day unless it is over 12.  A year of two digits is the one within fifty years of the present; a
    month and a year alone mean the present's day of it, or its last.  Where no zone is given it is UTC; names of zones but UTC, GMT and Z are passed over, as are weekdays.  A date is made once, and one that does not exist is null.
    """
    some = lambda c, pattern, k: F.nullif(F.regexp_extract(c, pattern, k), F.lit(""))
    found = _let(F.struct(text.alias("text"), F.regexp_extract(text, _TIME, 0).alias("clock")), lambda x: F.struct(x["clock"].alias("clock"), F.when(x["clock"] != "", F.regexp_replace(x["text"], _TIME, " ")).otherwise(x["text"]).alias("rest")))
    found = _let(found, lambda x: F.struct(x["clock"].alias("clock"), x["rest"].alias("rest"), F.regexp_extract(x["rest"], _DATE, 0).alias("date")))
    found = _let(found, lambda x: F.struct(x["clock"].alias("clock"), x["date"].alias("date"), F.when(x["date"] == "", F.regexp_extract(x["rest"], _COMPACT, 0)).otherwise(F.lit("")).alias("packed")))

    def tokens(x: Column) -> Column:
        date = [some(x["date"], _DATE, k).alias(name) for k, name in enumerate(("one", "two", "three", "name", "whole"), 1)]
        packed = [some(x["packed"], _COMPACT, k).alias(name) for k, name in enumerate(("cy", "cm", "cd", "ch", "cmi", "cs"), 1)]
        clock = [some(x["clock"], "(?i)^t?" + _CLOCK, k).alias(name) for k, name in enumerate(("h", "m", "s", "f", "half", "only", "half2", "sign", "zh", "zm"), 1)]
        return F.struct(*date, *packed, *clock)

    return F.when((F.length(text) > 0), _let(_let(found, tokens), lambda x: _instant(x, x, as_of)))


def _let(value: Column, f) -> Column:
    """f of a value that is made once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def _instant(p: Column, t: Column, as_of: Column) -> Column:
    number = lambda c: c.try_cast("int")
    n1, n2, n3 = number(p["one"]), number(p["two"]), number(p["three"])
    year_first = (F.length(p["one"]) >= 3) | (n1 > 31)
    # (year, month, day) by the classes of the three tokens
    year = F.when(p["one"].isNotNull(), F.when(n1.isNotNull() & year_first, p["one"]).otherwise(p["three"])).otherwise(F.coalesce(p["whole"], p["cy"]))
    month = F.when(n1.isNull() & p["one"].isNotNull(), _month(p["one"])).when(n2.isNull() & p["two"].isNotNull(), _month(p["two"]))
    month = F.coalesce(month, F.when(p["one"].isNotNull(), F.when(year_first, F.when(n2 > 12, n3).otherwise(n2)).when(n1 > 12, n2).otherwise(n1)), _month(p["name"]), number(p["cm"]))
    day = F.when(n1.isNull() & p["one"].isNotNull(), n2).when(n1.isNotNull() & year_first, F.when(n2.isNotNull() & (n2 > 12), n2).otherwise(n3))
    day = day.when(n2.isNull() & p["two"].isNotNull(), n1).when(p["one"].isNotNull(), F.when(n1 > 12, n1).otherwise(n2)).otherwise(number(p["cd"]))
    full = number(year)
    this = F.year(as_of)
    near = F.floor(this / 100).cast("int") * 100 + full
    near = F.when(near >= this + 50, near - 100).when(near < this - 50, near + 100).otherwise(near)
    full = F.when(F.length(year) <= 2, near).otherwise(full)
    last = F.dayofmonth(F.last_day(F.try_make_timestamp(full, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC")).cast("date")))
    day = F.when(p["name"].isNotNull(), F.least(F.dayofmonth(as_of), last)).otherwise(day)
    hour = F.coalesce(number(t["h"]), number(t["only"]), number(p["ch"]), F.lit(0))
    hour = F.when(F.lower(F.coalesce(t["half"], t["half2"])) == "p", F.when(hour < 12, hour + 12).otherwise(hour)).when(F.lower(F.coalesce(t["half"], t["half2"])) == "a", F.when(hour == 12, 0).otherwise(hour)).otherwise(hour)
    minute = F.coalesce(number(t["m"]), number(p["cmi"]), F.lit(0))
    second = F.concat(F.coalesce(t["s"], p["cs"], F.lit("0")), F.lit("."), F.coalesce(F.substring(t["f"], 1, 6), F.lit("0"))).cast("decimal(8,6)")
    made = F.try_make_timestamp(full, month, day, hour, minute, second, F.lit("UTC"))
    away = (F.coalesce(number(t["zh"]), F.lit(0)) * 60 + F.coalesce(number(t["zm"]), F.lit(0))) * F.when(t["sign"] == "-", -1).otherwise(1)
    return made - F.make_dt_interval(F.lit(0), F.lit(0), away)


def parse(text: Column, as_of: Column) -> Column:
    """Free-form date, null if there is none in the text or it is too old."""
    t = free_form(text, as_of)
    return F.when(usable(t, as_of), t)


def ensure_utc(text: Column) -> Column:
    """ISO date and time as an instant: by its own offset, or as UTC where it has none; null if it is neither."""
    plain = F.trim(text)
    zoned = F.rlike(plain, F.lit(r"(Z|[+-]\d\d:?\d\d)$")) & F.contains(plain, F.lit(":"))
    return F.try_to_timestamp(F.when(zoned, plain).otherwise(F.concat(plain, F.when(F.length(plain) <= 10, F.lit("T00:00:00Z")).otherwise(F.lit("Z")))))


def from_epoch(seconds: Column, as_of: Column) -> Column:
    """Seconds since 1970, not later than now."""
    return F.least(F.timestamp_seconds(seconds), as_of)


def days_ago(as_of: Column, n: int) -> Column:
    return as_of - F.expr(f"INTERVAL {n} DAYS")


def age_days(as_of: Column, updated: Column) -> Column:
    return F.datediff(as_of, updated)
