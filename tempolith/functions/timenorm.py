"""Time expressions to ISO, relative to an anchor date: a closed grammar of Column expressions.

Forms, in this order: ISO as it is; ``October 15th, 2023``; ``15 October 2023``;
``7/20/2012``; ``October 2023``; ``2023``; now and today; yesterday, tomorrow; last, this and
next week, month, year; ``3 weeks ago``, ``in 2 days``, ``2 months later``; ``6 months``;
names of weekdays.  Anything else gives an empty string.  Months before or after name a
month, years a year, weeks and days a day; ``last week`` is a week counted from January 1st.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
NUMBERS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")
_MONTH = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\\.?"
_COUNT = f"([0-9]+|an?|{'|'.join(NUMBERS)})"
_UNIT = "(second|minute|hour|day|week|month|year)s?"


def _month(name: Column) -> Column:
    out = None
    for i, m in enumerate(MONTHS, 1):
        hit = F.substring(name, 1, 3) == m[:3]
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def _number(text: Column) -> Column:
    out = F.when(text.rlike("^[0-9]+$"), text.try_cast("int")).when(text.isin("a", "an"), 1)
    for i, n in enumerate(NUMBERS, 1):
        out = out.when(text == n, i)
    return out


def _day(year: Column, month: Column, day: Column) -> Column:
    """An ISO date; null where the calendar has none."""
    whole = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when(F.try_to_date(whole, "yyyy-MM-dd").isNotNull(), whole)


def week_of(date: Column) -> Column:
    """YYYY-Www with weeks counted from January 1st."""
    week = F.floor((F.dayofyear(date) - 1) / 7) + 1
    return F.format_string("%04d-W%02d", F.year(date), week.cast("int"))


def _shifted(anchor: Column, n: Column, unit: Column) -> Column:
    """The anchor moved by n units, as coarse as the unit."""
    days = F.when(unit == "week", 7 * n).otherwise(n)
    out = F.when(unit.isin("day", "week"), F.date_format(F.date_add(anchor, days.cast("int")), "yyyy-MM-dd"))
    out = out.when(unit == "month", F.date_format(F.add_months(anchor, n), "yyyy-MM"))
    out = out.when(unit == "year", F.date_format(F.add_months(anchor, 12 * n), "yyyy"))
    return out.otherwise(F.date_format(anchor, "yyyy-MM-dd"))


def normalize(text: Column, anchor: Column) -> Column:
    """ISO form of a time expression, or an empty string; null and blank texts give one too."""
    raw = strip(text)
    both = F.struct(raw.alias("raw"), F.regexp_replace(F.lower(raw), r"\s+", " ").alias("t"))
    return let(both, lambda x: _read(x["raw"], x["t"], anchor))


def _read(raw: Column, t: Column, anchor: Column) -> Column:
    g = lambda pattern, i: F.regexp_extract(t, pattern, i)
    num = lambda pattern, i: g(pattern, i).try_cast("int")
    word_day = f"^{_MONTH} ([0-9]{{1,2}})(?:st|nd|rd|th)?,? ([0-9]{{4}})$"
    day_word = f"^([0-9]{{1,2}})(?:st|nd|rd|th)? (?:of )?{_MONTH},? ([0-9]{{4}})$"
    stroke = "^([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})$"
    word_year = f"^{_MONTH},? (?:of )?([0-9]{{4}})$"
    near = "^(last|past|previous|this|current|next) (week|month|year)$"
    ago = f"^(?:about |approximately )?{_COUNT} {_UNIT} (?:ago|prior|before|earlier)$"
    later = f"^(?:in )?{_COUNT} {_UNIT} (?:from now|later|after|from today)$|^in {_COUNT} {_UNIT}$"
    span = f"^(?:for |over |past |last |the past |the last )*{_COUNT} {_UNIT}$"
    weekday = f"^(last |this |next |on )?({'|'.join(DAYS)})$"
    step = F.when(g(near, 1).isin("last", "past", "previous"), -1).when(g(near, 1) == "next", 1).otherwise(0)
    near_week = week_of(F.date_add(anchor, (7 * step).cast("int")))
    near_iso = F.when(g(near, 2) == "week", near_week).otherwise(_shifted(anchor, step, g(near, 2)))
    plus = F.coalesce(_number(g(later, 1)), _number(g(later, 3)))
    plus_unit = F.when(g(later, 2) != "", g(later, 2)).otherwise(g(later, 4))
    unit = g(span, 2)
    letter = F.upper(F.substring(unit, 1, 1))
    period = F.concat(F.when(unit.isin("second", "minute", "hour"), "PT").otherwise("P"), _number(g(span, 1)).cast("string"), letter)
    named = F.lit(None).cast("int")
    for i, d in enumerate(DAYS):
        named = F.when(g(weekday, 2) == d, i).otherwise(named)
    here = F.weekday(anchor)
    back = -F.pmod(here - named - 1, F.lit(7)) - 1
    ahead = F.pmod(named - here - 1, F.lit(7)) + 1
    day_iso = F.date_format(F.date_add(anchor, F.when(g(weekday, 1) == "next ", ahead).otherwise(back)), "yyyy-MM-dd")
    iso_like = r"^[0-9]{4}(?:-(?:[0-9]{2}(?:-[0-9]{2}(?:T[0-9:]+Z?)?)?|W[0-9]{2}))?$|^P(?:T?[0-9]+[A-Z])$|^(?:PRESENT|PAST|FUTURE)_REF$"
    found = F.coalesce(
        F.when(raw.rlike(iso_like), raw),
        F.when(t.rlike(word_day), _day(num(word_day, 3), _month(g(word_day, 1)), num(word_day, 2))),
        F.when(t.rlike(day_word), _day(num(day_word, 3), _month(g(day_word, 2)), num(day_word, 1))),
        F.when(t.rlike(stroke), _day(num(stroke, 3), num(stroke, 1), num(stroke, 2))),
        F.when(t.rlike(word_year), F.format_string("%04d-%02d", num(word_year, 2), _month(g(word_year, 1)))),
        F.when(t.isin("today", "now", "currently", "today's date", "this morning", "this afternoon", "tonight"), F.date_format(anchor, "yyyy-MM-dd")),
        F.when(t == "yesterday", F.date_format(F.date_sub(anchor, 1), "yyyy-MM-dd")),
        F.when(t == "tomorrow", F.date_format(F.date_add(anchor, 1), "yyyy-MM-dd")),
        F.when(t.rlike(near), near_iso),
        F.when(t.rlike(ago), _shifted(anchor, -_number(g(ago, 1)), g(ago, 2))),
        F.when(t.rlike(later), _shifted(anchor, plus, plus_unit)),
        F.when(t.rlike(span), period),
        F.when(t.rlike(weekday), day_iso),
    )
    return F.coalesce(found, F.lit(""))
