"""Queries of the grammar of time expressions, and their SQL twins.

Each form is written in SQL that both engines understand: the expression as a text, and the
ISO form and days that the rules of the grammar give it, from the date and key of an order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timenorm import MONTHS
from ..operators.times import read_times
from .catalogue import query, table


def _months(c: str) -> str:
    return f"case {c} " + " ".join(f"when {i} then '{m.title()}'" for i, m in enumerate(MONTHS, 1)) + " end"


#: columns of an order: key k, anchor a, a day t (a third of a year before) with its year y, month m, day d and their texts, a number n of 2 to 7
_SPARK = f"select o_orderkey, k, a, t, y, m, d, n, cast(y as string) ys, {_months('m')} ms, cast(d as string) ds, cast(n as string) ns, lpad(cast(y % 100 as string), 2, '0') yy from (select *, year(t) y, month(t) m, day(t) d from (select o_orderkey, o_orderkey div 3 k, cast(o_orderdate as date) a, cast(date_sub(cast(o_orderdate as date), 122) as date) t, cast(o_orderkey % 6 + 2 as int) n from orders))"
_DUCK = _SPARK.replace(" div 3", " // 3").replace("date_sub(cast(o_orderdate as date), 122)", "cast(o_orderdate as date) - 122").replace("as string)", "as varchar)")

_FIRST = "make_date(y, m, 1)"
_LAST = "last_day(make_date(y, m, 1))"
_WEEK = "(t - cast((dayofyear(t) - 1) % 7 as int))"
_WEEK_END = f"least({_WEEK} + 6, make_date(y, 12, 31))"
_AGO = "(a - 21)"
_AGO_WEEK = f"({_AGO} - cast((dayofyear({_AGO}) - 1) % 7 as int))"


def _week_iso(day: str) -> str:
    return f"strftime({day}, '%Y') || '-W' || lpad(cast((dayofyear({day}) - 1) // 7 + 1 as varchar), 2, '0')"


_DAY, _MONTH = "'%Y-%m-%d'", "'%Y-%m'"
#: the last day of that month and date not after the anchor
_RECENT = "case when make_date(year(a), m, least(d, 28)) > a then make_date(year(a) - 1, m, least(d, 28)) else make_date(year(a), m, least(d, 28)) end"
_SHORT_DAY = "cast(least(d, 28) as string)"
#: (expression in both engines' SQL; iso, first and last day in DuckDB's; kind; about)
COMPOSED = (
    ("cast(m as string) || '/' || ys", f"strftime(t, {_MONTH})", _FIRST, _LAST, "point", False),
    ("cast(m as string) || '/' || ds || '/' || yy", f"strftime(t, {_DAY})", "t", "t", "point", False),
    ("'early ' || ys", "cast(y as varchar)", "make_date(y, 1, 1)", "make_date(y, 4, 30)", "point", False),
    ("'in mid-' || ms || ' ' || ys", f"strftime(t, {_MONTH})", f"{_FIRST} + cast(floor(day({_LAST}) / 3) as int)", f"{_FIRST} + cast(floor(day({_LAST}) * 2 / 3) as int) - 1", "point", False),
    ("'Q' || cast((m + 2) div 3 as string) || ' ' || ys", "cast(y as varchar)", "make_date(y, (m + 2) // 3 * 3 - 2, 1)", "last_day(make_date(y, (m + 2) // 3 * 3, 1))", "point", False),
    (f"ms || ' ' || {_SHORT_DAY}", f"strftime({_RECENT}, {_DAY})", _RECENT, _RECENT, "point", False),
    ("'the week of ' || ms || ' ' || ds || ', ' || ys", _week_iso("t"), _WEEK, _WEEK_END, "point", False),
    ("'every ' || ns || ' weeks'", "'P' || n || 'W'", "null", "null", "set", False),
    ("'a few weeks ago'", _week_iso(_AGO), _AGO_WEEK, f"least({_AGO_WEEK} + 6, make_date(year({_AGO}), 12, 31))", "point", True),
    ("'since ' || ys", "cast(y as varchar)", "make_date(y, 1, 1)", "null", "since", False),
    ("ns || ' and a half years'", "'P' || (12 * n + 6) || 'M'", "null", "null", "duration", False),
    ("'until ' || ms || ' ' || ys", f"strftime(t, {_MONTH})", "null", _LAST, "until", False),
    ("'late last year'", "cast(year(a) - 1 as varchar)", "make_date(year(a) - 1, 9, 1)", "make_date(year(a) - 1, 12, 31)", "point", False),
    ("ns || ' weeks after ' || ms || ' ' || ds || ', ' || ys", f"strftime(t + 7 * n, {_DAY})", "t + 7 * n", "t + 7 * n", "point", False),
    ("ns || ' months before ' || ms || ' ' || ds || ', ' || ys", f"strftime(t - to_months(n), {_MONTH})", "cast(date_trunc('month', t - to_months(n)) as date)", "last_day(t - to_months(n))", "point", False),
    ("ns || ' times a week'", "case n when 2 then 'PT84H' when 3 then 'PT56H' when 4 then 'PT42H' when 5 then 'PT2016M' when 6 then 'PT28H' else 'P1D' end", "null", "null", "set", False),
    ("ns || ' years and ' || ns || ' months'", "'P' || (13 * n) || 'M'", "null", "null", "duration", False),
    ("'since the week of ' || ms || ' ' || ds || ', ' || ys", _week_iso("t"), _WEEK, "null", "since", False),
    ("'about ' || ns || ' hours'", "'PT' || n || 'H'", "null", "null", "duration", True),
    ("ms || ' ' || ds || ' of the moon'", "''", "null", "null", None, False),
    ("cast(m + 12 as string) || '/' || ds || '/' || ys", "''", "null", "null", None, False),
)

_E = "(t + 40)"
_COVER = f"case when year(t) = year({_E}) then cast(y as varchar) else strftime(t, {{0}}) end"
_OTHER = f"case month({_E}) " + " ".join(f"when {i} then '{m.title()}'" for i, m in enumerate(MONTHS, 1)) + " end"
_E_SPARK = "date_add(t, 40)"


def _pair(text: str) -> str:
    """Spark's form of an expression that speaks of a day 40 days on."""
    return text.replace(_E, _E_SPARK)


RANGES = (
    ("ms || ' ' || cast(least(d, 20) as string) || '-' || cast(least(d, 20) + n as string) || ', ' || ys", f"strftime(t, {_MONTH})", "make_date(y, m, least(d, 20))", "make_date(y, m, least(d, 20) + n)", "range", False),
    (f"ms || ' to ' || {_OTHER} || ' ' || cast(year({_E}) as string)", _COVER.format(_MONTH), _FIRST, f"last_day({_E})", "range", False),
    ("'between ' || ys || ' and ' || cast(y + n as string)", "cast(y as varchar)", "make_date(y, 1, 1)", "make_date(y + n, 12, 31)", "range", False),
    (f"'from ' || ms || ' ' || ys || ' to ' || {_OTHER} || ' ' || cast(year({_E}) as string)", _COVER.format(_MONTH), _FIRST, f"last_day({_E})", "range", False),
    (f"ms || ' ' || ds || ' - ' || {_OTHER} || ' ' || cast(day({_E}) as string) || ', ' || cast(year({_E}) as string)", _COVER.format(_DAY), "t", _E, "range", False),
    ("ys || '-' || cast(y + n as string)", "cast(y as varchar)", "make_date(y, 1, 1)", "make_date(y + n, 12, 31)", "range", False),
    (f"'between ' || ms || ' and ' || {_OTHER} || ' ' || cast(year({_E}) as string)", _COVER.format(_MONTH), _FIRST, f"last_day({_E})", "range", False),
    ("ys || ' to ' || cast(y - n as string)", "''", "null", "null", None, False),
)


def _case(values: list[str], by: str = "k") -> str:
    return f"case {by} % {len(values)} " + " ".join(f"when {i} then {v}" for i, v in enumerate(values)) + " end"


def _twin(forms: tuple) -> str:
    text, iso, first, last, kind, about = (list(x) for x in zip(*forms, strict=True))
    text = [x.replace("as string)", "as varchar)").replace(" div 3", " // 3") for x in text]
    days = lambda values: f"strftime({_case([f'cast({v} as date)' for v in values])}, {_DAY})"
    kinds = ["null" if x is None else f"'{x}'" for x in kind]
    return f"""with o as ({_DUCK}) select o_orderkey, {_case(text)} as text, {_case(iso)} as iso, {days(first)} first_day, {days(last)} last_day, {_case(kinds)} time_kind, {_case([str(x).lower() for x in about])} about from o"""


def _read(spark, d, forms: tuple):
    table(spark, d, "orders").createOrReplaceTempView("__orders")
    text = _case([_pair(f[0]) for f in forms])
    o = spark.sql(f"select o_orderkey, a, {text} as text from ({_SPARK.replace('from orders', 'from __orders')})")
    read = read_times(o, "text", "a")
    joined = o.join(read, (o["text"] == read["text"]) & (o["a"] == read["a"]))
    return joined.select("o_orderkey", o["text"], "iso", *(F.date_format(c, "yyyy-MM-dd").alias(c) for c in ("first_day", "last_day")), "time_kind", "about")


@query(_twin(COMPOSED))
def time_norm_compositional(spark, d):
    """Points, spans, sets and anchors, and what is composed of them."""
    return _read(spark, d, COMPOSED)


@query(_twin(RANGES))
def time_norm_ranges(spark, d):
    """Intervals of days, months and years, and those whose end comes first."""
    return _read(spark, d, RANGES)
