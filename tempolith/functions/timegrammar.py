"""Time expressions by a compositional grammar: a chart of typed terms over the tokens of a text.

A token has the terms of its word (``may`` a month, ``second`` a unit or a place in an order).
Two neighbouring terms make a term where a rule for their kinds says so: ``July`` and ``10`` a
day of some year, that and ``2023`` a point, ``since`` and a point an open interval, and so on
from small spans to large ones.  All derivations are kept in the chart; of those that cover
the whole text the one of least cost is the reading, and ``readings`` counts how many values
they have.  A text that no derivation covers has no reading.

The chart is an array of structs in one row.  Spans are closed from the right end of the text
to its left, so each term meets each term behind it once; no row is shuffled and no Python
runs.  Reading doesn't need the document's date: ``resolved`` sets a reading against it.

Stated rules.  A day or month without year is the last one not after the document's date;
with ``last``, ``this`` or ``next`` it is the one before, in or after the date's year.  Years of
two digits lie in the hundred years that end nine years after the document's.  Early,
mid and late are thirds.  ``a few`` is three, ``several`` four, ``a couple`` two, ``half`` a month 15 days.
Something recurring is read by the period in which it recurs.  Weeks count from January 1st, as everywhere here.
The ISO form of an interval is that of the least day, week, month or year that holds it, so
it claims no more than the text does; ``begin`` and ``end`` are the interval's own days.
"""

from __future__ import annotations

import functools

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let
from .timenorm import DAYS, MONTHS, NUMBERS, week_of

#: more tokens than any expression of time needs; longer texts have no reading
MAX_TOKENS = 16

KINDS = (
    "int num ord suffix article half month weekday unit letter season slash dash comma to and fill direction beside near edge "
    "q every other times adverb open about point slashed dashed days_slashed year_dashed month_dashed nums_to to_half point_to point_and range "
    "duration duration_and shift set unit_of within often ahead"
).split()
K = {name: i for i, name in enumerate(KINDS)}

#: fields of a term besides its span: kind; year, month, day; the same of an interval's end; grain of a point
#: (d day, w week, m month, q quarter, h half year, s season, y year, k day of the week, r relative, n now); number and unit;
#: part of a point (early, mid, late); side on which it is open; shift of a point and its unit; approximate; cost
FIELDS = {
    "k": "int", "y": "int", "m": "int", "d": "int", "y2": "int", "m2": "int", "d2": "int", "g": "string", "n": "double",
    "u": "string", "f": "string", "o": "string", "sn": "double", "su": "string", "about": "boolean", "c": "int",
}
ITEM = "struct<" + ",".join(f"{n}:{t}" for n, t in {"b": "int", "e": "int", **FIELDS}.items()) + ">"

_UNITS = {"second": "second", "minute": "minute", "min": "minute", "hour": "hour", "hr": "hour", "day": "day", "week": "week", "wk": "week", "month": "month", "mo": "month", "quarter": "quarter", "year": "year", "yr": "year", "decade": "decade"}
_LETTERS = {"d": "day", "w": "week", "m": "month", "y": "year", "h": "hour"}
_SEASONS = {"spring": 3, "summer": 6, "autumn": 9, "fall": 9, "winter": 12}
_MORE_NUMBERS = {"thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "ninety": 90}
_VAGUE = {"few": 3, "several": 4, "couple": 2}
_ORDERS = ("first", "second", "third", "fourth")
_SHORT_DAYS = {"mon": 0, "tue": 1, "tues": 1, "wed": 2, "thu": 3, "thur": 3, "thurs": 3, "fri": 4, "sat": 5, "sun": 6}


def lexicon() -> dict[str, list[dict]]:
    """The terms of each word."""
    words: dict[str, list[dict]] = {}

    def add(names, kind: str, **fields) -> None:
        for name in [names] if isinstance(names, str) else names:
            words.setdefault(name, []).append({"k": K[kind], **fields})

    for i, name in enumerate(MONTHS, 1):
        add({name, name[:3]}, "month", m=i)
    add("sept", "month", m=9)
    for i, name in enumerate(DAYS):
        add(name, "weekday", d=i)
    for name, i in _SHORT_DAYS.items():
        add(name, "weekday", d=i)
    for i, name in enumerate(NUMBERS, 1):
        add(name, "num", n=float(i))
    for name, i in _MORE_NUMBERS.items():
        add(name, "num", n=float(i))
    for name, i in _VAGUE.items():
        add(name, "num", n=float(i), about=True)
    for i, name in enumerate(_ORDERS, 1):
        add(name, "ord", n=float(i))
    add(("a", "an"), "article", n=1.0)
    add("half", "half", n=0.5)
    for name, unit in _UNITS.items():
        add({name, f"{name}s"}, "unit", u=unit, n=1.0)
    add("fortnight", "unit", u="week", n=2.0)
    for name, unit in _LETTERS.items():
        add(name, "letter", u=unit, n=1.0)
    for name, m in _SEASONS.items():
        add(name, "season", m=m, g="s")
    add(("st", "nd", "rd", "th"), "suffix")
    add("/", "slash")
    add(("-", "–", "—"), "dash")
    add(("-", "–", "—", "to", "through", "thru", "until", "till"), "to")
    add(",", "comma")
    add(("and", "or", "&"), "and")
    add((",", ".", "the", "of", "in", "on", "at", "during", "for", "over", "within", "'s", "approximately in"), "fill")
    add("in", "ahead")
    add(("about", "around", "approximately", "roughly", "circa", "ca", "~", "almost", "nearly"), "about")
    add(("ago", "prior", "earlier", "before"), "direction", n=-1.0)
    add(("later", "hence", "after"), "direction", n=1.0)
    add(("before", "prior"), "beside", n=-1.0)
    add(("after", "following", "from"), "beside", n=1.0)
    add(("last", "past", "previous", "prior"), "near", n=-1.0)
    add(("this", "current"), "near", n=0.0)
    add(("next", "coming", "following"), "near", n=1.0)
    add(("early", "beginning", "start"), "edge", f="early")
    add(("mid", "middle"), "edge", f="mid")
    add(("late", "end"), "edge", f="late")
    add("q", "q")
    add(("every", "each", "per"), "every")
    add("other", "other", n=2.0)
    add("alternate", "other", n=2.0)
    for i, name in enumerate(("once", "twice", "thrice"), 1):
        add(name, "times", n=float(i))
    add(("times", "x"), "often")
    for name, unit, n in (("daily", "day", 1.0), ("nightly", "day", 1.0), ("weekly", "week", 1.0), ("biweekly", "week", 2.0), ("fortnightly", "week", 2.0), ("monthly", "month", 1.0), ("quarterly", "month", 3.0), ("yearly", "year", 1.0), ("annually", "year", 1.0), ("hourly", "hour", 1.0)):
        add(name, "adverb", u=unit, n=n)
    add(("since", "from", "after"), "open", o="since")
    add(("until", "till", "before", "by"), "open", o="until")
    add("between", "open", o="between")
    for name, n in (("today", 0), ("tonight", 0), ("yesterday", -1), ("tomorrow", 1)):
        add(name, "point", g="r", u="day", n=float(n))
    add(("now", "currently", "present"), "point", g="n")
    return words


_ALL = {"b": "int", "e": "int", **FIELDS}


def _literal(values: dict[str, object]) -> str:
    """A term as a SQL literal."""

    def field(name: str, kind: str) -> str:
        value = values.get(name, {"about": False, "c": 0}.get(name))
        text = "null" if value is None else f"'{value}'" if kind == "string" else str(value).lower()
        return f"'{name}',cast({text} as {kind})"

    return "named_struct(" + ",".join(field(n, t) for n, t in _ALL.items()) + ")"


def _changed(base: Column, b: Column, e: Column, **values) -> Column:
    """``base`` over another span with some fields changed."""
    for name, value in {"b": b, "e": e, **values}.items():
        base = base.withField(name, (value if isinstance(value, Column) else F.lit(value)).cast(_ALL[name]))
    return base


def _item(begin: Column, end: Column, values: dict[str, object]) -> Column:
    return _changed(F.expr(_literal({})), begin, end, **values)


@functools.cache
def _words_literal() -> str:
    """The lexicon as a SQL map literal, word to terms."""

    def terms(entries: list[dict]) -> str:
        return f"array({','.join(map(_literal, entries))})"

    quoted = {w: w.replace("'", "\\'") for w in lexicon()}
    return "map(" + ",".join(f"'{quoted[w]}',{terms(e)}" for w, e in lexicon().items()) + ")"


def _terminals(token: Column, at: Column) -> Column:
    """The terms of one token: its word's, and those of a number."""
    none = F.expr(f"cast(array() as array<{ITEM}>)")
    found = F.transform(F.coalesce(F.try_element_at(F.expr(_words_literal()), token), none), lambda t: _changed(t, at, at + 1))
    number = token.try_cast("int")
    # y holds how many digits there are
    whole = _item(at, at + 1, {"k": F.lit(K["int"]), "n": number, "y": F.length(token)})
    year = _item(at, at + 1, {"k": F.lit(K["point"]), "y": number, "g": F.lit("y"), "c": F.lit(1)})
    plain = F.when((F.length(token) == 4) & number.between(1900, 2099), F.array(whole, year)).otherwise(F.array(whole))
    return F.when(token.rlike("^[0-9]{1,6}$"), plain).when(F.array_size(found) > 0, found).otherwise(none)


# --- rules: (kind, kind) to a term or null


def _is_day(n: Column) -> Column:
    return n.between(1, 31)


def _rules() -> dict[tuple[str, str], object]:
    rules: dict[tuple[str, str], object] = {}

    def rule(left: str, right: str):
        def register(build):
            for x in left.split():
                for y in right.split():
                    before = rules.get((x, y))
                    rules[x, y] = build if before is None else (lambda a, b, p=before, q=build: F.coalesce(p(a, b), q(a, b)))
            return build

        return register

    def make(a: Column, b: Column, kind: str, base: Column | None = None, more: int = 0, **values) -> Column:
        cost = a["c"] + b["c"] + more
        fields = {"k": F.lit(K[kind]), "about": a["about"] | b["about"], "c": cost} | values
        return _item(a["b"], b["e"], fields) if base is None else _changed(base, a["b"], b["e"], **fields)

    null = F.lit(None)
    bare = lambda p: p["f"].isNull() & p["o"].isNull() & p["sn"].isNull()
    is_year = lambda p: (p["g"] == "y") & bare(p)
    yearless = lambda p: p["y"].isNull() & p["g"].isin("d", "m", "q", "h", "s") & bare(p)

    # what adds nothing
    @rule("fill", "num ord month weekday unit season near edge every point range duration set within int q half")
    def _(a, b):
        return _changed(b, a["b"], b["e"], c=b["c"] + 1)

    @rule("month weekday edge near num point_to", "fill comma")
    def _(a, b):
        return _changed(a, a["b"], b["e"], c=a["c"] + 1)

    @rule("point", "comma")
    def _(a, b):
        return F.when((a["g"] != "y") & bare(a), _changed(a, a["b"], b["e"], c=a["c"] + 1))

    @rule("edge", "dash")
    def _(a, b):
        return _changed(a, a["b"], b["e"])

    @rule("about", "point range duration num int set")
    def _(a, b):
        return _changed(b, a["b"], b["e"], about=F.lit(True))

    # numbers
    @rule("int", "suffix")
    def _(a, b):
        return F.when(_is_day(a["n"]), make(a, b, "ord", n=a["n"]))

    @rule("article", "num")
    def _(a, b):
        return F.when(b["about"], make(a, b, "num", n=b["n"]))

    @rule("num dashed", "num")
    def _(a, b):
        return F.when((a["n"] >= 20) & (a["n"] % 10 == 0) & (b["n"] < 10) & ~b["about"], make(a, b, "num", n=a["n"] + b["n"]))

    @rule("article", "half")
    @rule("half", "article")
    def _(a, b):
        return make(a, b, "half", n=F.lit(0.5))

    @rule("and", "half")
    def _(a, b):
        return make(a, b, "to_half")

    @rule("num int article", "to_half")
    def _(a, b):
        return make(a, b, "num", n=a["n"] + 0.5)

    # days, months, years
    @rule("month", "int ord")
    def _(a, b):
        return F.when(_is_day(b["n"]) & F.coalesce(b["y"] <= 2, F.lit(True)), make(a, b, "point", m=a["m"], d=b["n"], g=F.lit("d")))

    @rule("int ord", "month")
    def _(a, b):
        return F.when(_is_day(a["n"]) & F.coalesce(a["y"] <= 2, F.lit(True)), make(a, b, "point", m=b["m"], d=a["n"], g=F.lit("d")))

    @rule("month", "point")
    def _(a, b):
        return F.when(is_year(b), make(a, b, "point", y=b["y"], m=a["m"], g=F.lit("m")))

    @rule("month", "dash")
    def _(a, b):
        return make(a, b, "point_to", m=a["m"], g=F.lit("m"))

    @rule("point", "point")
    def _(a, b):
        return F.when(yearless(a) & is_year(b), make(a, b, "point", a, y=b["y"]))

    @rule("range", "point")
    def _(a, b):
        return F.when(a["y"].isNull() & a["y2"].isNull() & is_year(b), make(a, b, "range", a, y=b["y"] - F.when(a["m"] > a["m2"], 1).otherwise(0), y2=b["y"]))

    @rule("range", "comma")
    def _(a, b):
        return F.when(a["y2"].isNull(), _changed(a, a["b"], b["e"], c=a["c"] + 1))

    @rule("weekday", "point")
    def _(a, b):
        return F.when((b["g"] == "d") & bare(b), make(a, b, "point", b))

    @rule("season", "point")
    def _(a, b):
        return F.when(is_year(b), make(a, b, "point", y=b["y"], m=a["m"], g=F.lit("s")))

    @rule("q", "int")
    def _(a, b):
        return F.when(b["n"].between(1, 4), make(a, b, "point", m=3 * b["n"] - 2, g=F.lit("q")))

    @rule("ord", "unit")
    def _(a, b):
        return F.when((b["u"] == "quarter") & a["n"].between(1, 4), make(a, b, "point", m=3 * a["n"] - 2, g=F.lit("q")))

    @rule("ord", "half")
    def _(a, b):
        return F.when(a["n"].between(1, 2), make(a, b, "point", m=6 * a["n"] - 5, g=F.lit("h")))

    @rule("point", "fill")
    def _(a, b):
        return F.when(yearless(a) & a["g"].isin("q", "h", "m", "d"), _changed(a, a["b"], b["e"], c=a["c"] + 1))

    # numbers with strokes and dashes
    @rule("int", "slash")
    def _(a, b):
        return F.when(a["y"] <= 2, make(a, b, "slashed", n=a["n"]))

    @rule("slashed", "int")
    def _(a, b):
        month = F.when(a["n"].between(1, 12) & (b["y"] == 4) & b["n"].between(1900, 2099), make(a, b, "point", y=b["n"], m=a["n"], g=F.lit("m")))
        return F.coalesce(month, F.when(a["n"].between(1, 12) & (b["y"] <= 2) & _is_day(b["n"]), make(a, b, "point", m=a["n"], d=b["n"], g=F.lit("d"), more=1)))

    @rule("point", "slash")
    def _(a, b):
        return F.when(yearless(a) & (a["g"] == "d"), make(a, b, "days_slashed", a))

    @rule("days_slashed", "int")
    def _(a, b):
        return F.when(b["y"].isin(2, 4) & ((b["y"] == 2) | b["n"].between(1900, 2099)), make(a, b, "point", a, y=b["n"], more=-1))

    @rule("int", "dash")
    def _(a, b):
        year = F.when((a["y"] == 4) & a["n"].between(1900, 2099), make(a, b, "year_dashed", y=a["n"]))
        return F.coalesce(year, make(a, b, "dashed", n=a["n"]))

    @rule("year_dashed", "int")
    def _(a, b):
        return F.when((b["y"] == 2) & b["n"].between(1, 12), make(a, b, "point", y=a["y"], m=b["n"], g=F.lit("m")))

    @rule("point", "dash")
    def _(a, b):
        return F.when((a["g"] == "m") & a["y"].isNotNull() & bare(a), make(a, b, "month_dashed", a))

    @rule("month_dashed", "int")
    def _(a, b):
        return F.when((b["y"] == 2) & _is_day(b["n"]), make(a, b, "point", a, d=b["n"], g=F.lit("d")))

    @rule("dashed", "unit")
    def _(a, b):
        return make(a, b, "duration", n=a["n"] * b["n"], u=b["u"])

    @rule("num", "dash")
    def _(a, b):
        return make(a, b, "dashed", n=a["n"])

    # durations
    @rule("num int article half", "unit")
    def _(a, b):
        return F.when(b["u"] != "quarter", make(a, b, "duration", n=a["n"] * b["n"], u=b["u"]))

    @rule("int", "letter")
    def _(a, b):
        return make(a, b, "duration", n=a["n"], u=b["u"], more=2)

    @rule("duration", "to_half")
    def _(a, b):
        return F.when(a["n"] == 1, make(a, b, "duration", a, n=F.lit(1.5)))

    @rule("num int", "to and")
    def _(a, b):
        return make(a, b, "nums_to", n=a["n"])

    @rule("nums_to", "duration")
    def _(a, b):
        return F.when((a["n"] < b["n"]) & (b["u"] != ""), make(a, b, "duration", b, n=a["n"], about=F.lit(True), more=1))

    @rule("duration", "and comma")
    def _(a, b):
        return make(a, b, "duration_and", a)

    @rule("duration duration_and", "duration")
    def _(a, b):
        years = (a["u"] == "year") & (b["u"] == "month")
        weeks = (a["u"] == "week") & (b["u"] == "day")
        return F.when(years, make(a, b, "duration", n=12 * a["n"] + b["n"], u=F.lit("month"), more=1)).when(weeks, make(a, b, "duration", n=7 * a["n"] + b["n"], u=F.lit("day"), more=1))

    @rule("near", "duration")
    def _(a, b):
        return make(a, b, "duration", b)

    @rule("near", "num int")
    def _(a, b):
        return make(a, b, "num", n=b["n"])

    # relative points
    @rule("duration", "direction")
    def _(a, b):
        return make(a, b, "point", g=F.lit("r"), n=a["n"] * b["n"], u=a["u"])

    @rule("duration", "beside")
    def _(a, b):
        return make(a, b, "shift", n=a["n"] * b["n"], u=a["u"])

    @rule("shift", "point")
    def _(a, b):
        return F.when(b["sn"].isNull() & b["o"].isNull(), make(a, b, "point", b, sn=a["n"], su=a["u"]))

    @rule("ahead", "duration")
    def _(a, b):
        # "in two days" lies ahead; that it may also be a span of time costs more
        return make(a, b, "point", g=F.lit("r"), n=b["n"], u=b["u"])

    @rule("near", "unit")
    def _(a, b):
        return F.when(b["u"].isin("week", "month", "year", "day", "quarter", "decade"), make(a, b, "point", g=F.lit("r"), n=a["n"] * b["n"], u=b["u"], f=null, d=F.lit(1)))

    @rule("near", "month")
    def _(a, b):
        return make(a, b, "point", m=b["m"], g=F.lit("m"), n=a["n"])

    @rule("near", "season")
    def _(a, b):
        return make(a, b, "point", m=b["m"], g=F.lit("s"), n=a["n"])

    @rule("near", "weekday")
    def _(a, b):
        return make(a, b, "point", d=b["d"], g=F.lit("k"), n=a["n"])

    # parts of points, open intervals, intervals
    @rule("edge", "point")
    def _(a, b):
        return F.when(bare(b) & (b["g"] != "n"), make(a, b, "point", b, f=a["f"]))

    @rule("edge", "month season")
    def _(a, b):
        return make(a, b, "point", m=b["m"], g=F.when(b["k"] == K["month"], "m").otherwise("s"), f=a["f"])

    @rule("open", "point")
    def _(a, b):
        return F.when(b["o"].isNull() & (a["o"] != "between"), make(a, b, "point", b, o=a["o"]))

    @rule("open", "month")
    def _(a, b):
        return F.when(a["o"] != "between", make(a, b, "point", m=b["m"], g=F.lit("m"), o=a["o"]))

    @rule("open", "range")
    def _(a, b):
        return F.when(a["o"] == "since", make(a, b, "range", b))

    @rule("point", "to")
    def _(a, b):
        return F.when(bare(a) & a["g"].isin("d", "m", "q", "h", "s", "y"), make(a, b, "point_to", a))

    @rule("month", "to")
    def _(a, b):
        return make(a, b, "point_to", m=a["m"], g=F.lit("m"))

    @rule("point month", "and")
    def _(a, b):
        point = (a["k"] == K["month"]) | (bare(a) & a["g"].isin("d", "m", "y"))
        return F.when(point, make(a, b, "point_and", a, g=F.coalesce(a["g"], F.lit("m"))))

    def spanned(a: Column, b: Column, m2: Column, d2: Column, y2: Column, grain: Column, kind: str) -> Column:
        """From ``a`` to another point; a year that only the second has is the first one's too."""
        wraps = F.coalesce((a["m"] > m2) & (y2.isNotNull()), F.lit(False))
        y = F.coalesce(a["y"], y2 - F.when(wraps, 1).otherwise(0))
        return make(a, b, kind, y=y, m=a["m"], d=a["d"], y2=y2, m2=m2, d2=d2, g=grain)

    @rule("point_to", "int ord")
    def _(a, b):
        later = (a["g"] == "d") & a["y"].isNull() & (b["n"] > a["d"]) & _is_day(b["n"]) & F.coalesce(b["y"] <= 2, F.lit(True))
        return F.when(later, spanned(a, b, a["m"], b["n"].cast("int"), a["y"], F.lit("d"), "range"))

    @rule("point_to", "point")
    def _(a, b):
        same = bare(b) & ((a["g"] == b["g"]) | ((a["g"] == "m") & (b["g"] == "m")))
        ordered = F.coalesce(a["y"] <= b["y"], F.lit(True))
        return F.when(same & ordered & b["g"].isin("d", "m", "q", "y"), spanned(a, b, b["m"], b["d"], b["y"], b["g"], "range"))

    @rule("point_to", "month")
    def _(a, b):
        return F.when((a["g"] == "m") & a["y"].isNull(), spanned(a, b, b["m"], null.cast("int"), null.cast("int"), F.lit("m"), "range"))

    @rule("point_and", "point month")
    def _(a, b):
        g = F.when(b["k"] == K["month"], "m").otherwise(b["g"])
        same = (a["g"] == g) & ((b["k"] == K["month"]) | bare(b)) & F.coalesce(a["y"] <= b["y"], F.lit(True))
        return F.when(same, spanned(a, b, b["m"], b["d"], b["y"], g, "within"))

    @rule("within", "point")
    def _(a, b):
        return F.when(a["y2"].isNull() & is_year(b), make(a, b, "within", a, y=b["y"] - F.when(a["m"] > a["m2"], 1).otherwise(0), y2=b["y"]))

    @rule("open", "within")
    def _(a, b):
        return F.when(a["o"] == "between", make(a, b, "range", b))

    # the week of a day
    @rule("unit", "fill")
    def _(a, b):
        return F.when(a["u"].isin("week", "month", "year"), make(a, b, "unit_of", u=a["u"]))

    @rule("fill", "unit_of")
    def _(a, b):
        return _changed(b, a["b"], b["e"])

    @rule("unit_of", "point")
    def _(a, b):
        week = (a["u"] == "week") & (b["g"] == "d") & bare(b)
        same = (a["u"].substr(1, 1) == b["g"]) & bare(b)
        return F.when(week, make(a, b, "point", b, g=F.lit("w"))).when(same, make(a, b, "point", b))

    # what recurs
    @rule("every", "duration")
    def _(a, b):
        return make(a, b, "set", n=b["n"], u=b["u"])

    @rule("every", "unit")
    def _(a, b):
        return make(a, b, "set", n=b["n"], u=b["u"])

    @rule("every", "weekday")
    def _(a, b):
        return make(a, b, "set", n=F.lit(1.0), u=F.lit("week"))

    @rule("other", "unit")
    def _(a, b):
        return make(a, b, "duration", n=2 * b["n"], u=b["u"], f=F.lit("other"))

    @rule("q", "duration")
    def _(a, b):
        return make(a, b, "set", n=b["n"], u=b["u"])

    @rule("num int", "often")
    def _(a, b):
        return make(a, b, "times", n=a["n"])

    @rule("times", "duration")
    def _(a, b):
        return F.when(b["n"] == 1, make(a, b, "set", n=1 / a["n"], u=b["u"]))

    @rule("times", "set")
    def _(a, b):
        return F.when(b["n"] == 1, make(a, b, "set", n=1 / a["n"], u=b["u"]))

    return rules


_BARE = {"month": {"g": "m"}, "adverb": {}, "season": {"g": "s"}}


@functools.cache
def _table() -> tuple[list[int], list]:
    """For each pair of kinds the number of its rule from 1, 0 without one; and the rules."""
    rules = _rules()
    distinct = list(dict.fromkeys(rules.values()))
    table = [0] * (len(KINDS) ** 2)
    for (x, y), build in rules.items():
        table[K[x] * len(KINDS) + K[y]] = distinct.index(build) + 1
    return table, distinct


def _combined(a: Column, b: Column) -> Column:
    table, rules = _table()
    number = F.get(F.expr(f"array({','.join(map(str, table))})"), a["k"] * len(KINDS) + b["k"])

    def apply(i: Column) -> Column:
        out = F.when(i == 0, F.lit(None).cast(ITEM))
        for j, build in enumerate(rules, 1):
            out = out.when(i == j, build(a, b))
        return out

    return let(number, apply)


def _closed(item: Column) -> Column:
    """A term as something that can stand for itself: a month is a point, an adverb a set; null for what is only a part."""
    k = item["k"]
    asis = k.isin(*(K[x] for x in ("point", "range", "duration", "set")))
    point = k.isin(K["month"], K["season"])
    return (
        F.when(asis, item)
        .when(point, _changed(item, item["b"], item["e"], k=F.lit(K["point"]), g=F.when(k == K["month"], "m").otherwise("s")))
        .when(k == K["weekday"], _changed(item, item["b"], item["e"], k=F.lit(K["point"]), g=F.lit("k"), n=F.lit(-1.0)))
        .when(k == K["adverb"], _changed(item, item["b"], item["e"], k=F.lit(K["set"])))
    )


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[0-9]+|[\p{L}]+|[^\s0-9\p{L}]"), F.lit(0))


def readings(text: Column) -> Column:
    """Array of the readings of a text, terms that cover all of it, the best first."""
    none = F.expr(f"cast(array() as array<{ITEM}>)")

    def chart(words: Column) -> Column:
        n = F.array_size(words)

        def from_start(state: Column, i: Column) -> Column:
            # ``state``: for each place already done, from the right, the terms that begin there
            own = _terminals(F.get(words, i), i)

            def grow(acc: Column, _: Column) -> Column:
                new = F.flatten(F.transform(acc["front"], lambda a: F.filter(F.transform(F.coalesce(F.get(state, n - 1 - a["e"]), none), lambda b: _combined(a, b)), lambda x: x.isNotNull())))
                return let(new, lambda v: F.struct(F.concat(acc["all"], v).alias("all"), v.alias("front")))

            # a term that begins here ends ever further right, so the steps are as many as places at most
            start = F.struct(own.alias("all"), own.alias("front"))
            grown = F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1 - i)), start, lambda acc, x: F.when(F.array_size(acc["front"]) == 0, acc).otherwise(grow(acc, x)))
            return F.concat(state, F.array(let(grown, lambda g: F.array_distinct(g["all"]))))

        empty = F.expr(f"cast(array() as array<array<{ITEM}>>)")
        done = F.aggregate(F.sequence(n - 1, F.lit(0)), empty, from_start)
        whole = F.filter(F.transform(F.get(done, n - 1), _closed), lambda x: x.isNotNull() & (x["e"] == n))
        ordered = F.array_sort(F.transform(whole, lambda x: F.struct(x["c"].alias("cost"), x.alias("item"))))
        return F.when(n.between(1, MAX_TOKENS), F.transform(ordered, lambda x: x["item"])).otherwise(none)

    return F.coalesce(let(tokens(text), chart), none)


# --- a reading against the document's date


def _year(item_year: Column, anchor: Column) -> Column:
    """A year; one of two digits in the hundred years that end nine years after the anchor's."""
    here = F.coalesce(F.year(anchor), F.lit(2029))
    short = item_year + 100 * F.floor((here + 9 - item_year) / 100).cast("int")
    return F.when(item_year < 100, short).otherwise(item_year)


def _moved(date: Column, n: Column, unit: Column) -> Column:
    whole = n.cast("int")
    months = F.when(unit == "month", n).when(unit == "year", 12 * n).when(unit == "quarter", 3 * n).when(unit == "decade", 120 * n)
    days = F.when(unit == "day", n).when(unit == "week", 7 * n)
    return F.when(months.isNotNull(), F.add_months(date, months.cast("int"))).when(days.isNotNull(), F.date_add(date, days.cast("int"))).otherwise(F.when(whole.isNotNull(), date))


_MONTHS_OF = {"m": 1, "q": 3, "h": 6, "s": 3, "y": 12}


def _interval(y: Column, m: Column, d: Column, grain: Column) -> Column:
    """struct(begin, end) of a point with a year, both days inclusive; null where the calendar has none."""
    begin = F.try_to_date(F.format_string("%04d-%02d-%02d", y, F.coalesce(m, F.lit(1)), F.coalesce(d, F.lit(1))), "yyyy-MM-dd")
    months = F.lit(None).cast("int")
    for g, n in _MONTHS_OF.items():
        months = F.when(grain == g, n).otherwise(months)
    end = F.when(grain == "d", begin).when(grain == "w", F.least(F.date_add(_week_begin(begin), 6), F.last_day(F.make_date(F.year(begin), F.lit(12), F.lit(1))))).otherwise(F.date_sub(F.add_months(begin, months), 1))
    return F.struct(F.when(grain == "w", _week_begin(begin)).otherwise(begin).alias("begin"), end.alias("end"))


def _week_begin(date: Column) -> Column:
    """First day of a date's week, counted from January 1st."""
    return F.date_sub(date, F.pmod(F.dayofyear(date) - 1, F.lit(7)))


def _week_end(date: Column) -> Column:
    """Last day of a date's week; the year's last week has a day or two."""
    return F.least(F.date_add(_week_begin(date), 6), F.make_date(F.year(date), F.lit(12), F.lit(31)))


def _whole(iso: Column, begin: Column, end: Column) -> Column:
    return F.struct(iso.alias("iso"), begin.alias("begin"), end.alias("end"))


def covering(begin: Column, end: Column, grain: Column | None = None) -> Column:
    """ISO form of the least day, week, month or year that holds both days; without one, of the begin as fine as ``grain``."""
    day = F.date_format(begin, "yyyy-MM-dd")
    week = (_week_begin(begin) == _week_begin(end)) & (F.year(begin) == F.year(end))
    month = F.trunc(begin, "month") == F.trunc(end, "month")
    exact_week = (_week_begin(begin) == begin) & (end == _week_end(begin))
    of_week = F.lit(False) if grain is None else F.coalesce(grain == "w", F.lit(False))
    return (
        F.when(of_week & exact_week, week_of(begin))
        .when(begin == end, day)
        .when(week & exact_week, week_of(begin))
        .when(month, F.date_format(begin, "yyyy-MM"))
        .when(week, week_of(begin))
        .when(F.year(begin) == F.year(end), F.date_format(begin, "yyyy"))
        .when(F.lit(None).cast("boolean") if grain is None else grain == "y", F.date_format(begin, "yyyy"))
        .when(F.lit(None).cast("boolean") if grain is None else grain.isin("m", "q", "h", "s"), F.date_format(begin, "yyyy-MM"))
        .otherwise(day)
    )


def _third(span: Column, part: Column) -> Column:
    """Early, mid or late of an interval: its thirds, by whole months where it has twelve, else by days."""
    days = F.datediff(span["end"], span["begin"]) + 1
    year = days > 360

    def cut(i: int) -> Column:
        return F.when(year, F.add_months(span["begin"], 4 * i)).otherwise(F.date_add(span["begin"], F.floor(days * i / 3).cast("int")))

    at = F.when(part == "early", 0).when(part == "mid", 1).otherwise(2)
    begin = F.when(at == 0, span["begin"]).when(at == 1, cut(1)).otherwise(cut(2))
    end = F.when(at == 0, F.date_sub(cut(1), 1)).when(at == 1, F.date_sub(cut(2), 1)).otherwise(span["end"])
    return F.struct(begin.alias("begin"), end.alias("end"))


def _period(n: Column, unit: Column) -> Column:
    """ISO period of whole units: halves and parts go down to the next smaller unit."""
    smaller = {"year": ("month", 12), "quarter": ("month", 3), "decade": ("year", 10), "month": ("day", 30), "week": ("day", 7), "day": ("hour", 24), "hour": ("minute", 60), "minute": ("second", 60)}
    step = F.struct(n.alias("n"), unit.alias("u"))

    def down(s: Column) -> Column:
        factor, name = F.lit(1.0), s["u"]
        for u, (v, k) in smaller.items():
            factor, name = F.when(s["u"] == u, float(k)).otherwise(factor), F.when(s["u"] == u, v).otherwise(name)
        whole = (F.abs(s["n"] - F.round(s["n"])) < 1e-9) & ~s["u"].isin("quarter", "decade")
        return F.when(whole | (s["u"] == "second"), s).otherwise(F.struct((s["n"] * factor).alias("n"), name.alias("u")))

    for _ in range(3):
        step = let(step, down)

    def spelled(s: Column) -> Column:
        letter = F.upper(s["u"].substr(1, 1))
        return F.concat(F.when(s["u"].isin("second", "minute", "hour"), "PT").otherwise("P"), F.round(s["n"]).cast("int").cast("string"), letter)

    return let(step, spelled)


def resolved(item: Column, anchor: Column) -> Column:
    """struct(iso, begin, end) of a reading; null where it names no day of the calendar or needs a date there isn't."""
    k, g = item["k"], item["g"]

    # the begin of a point without year: the last one not after the anchor, or as last, this and next say
    def dated(y: Column, m: Column, d: Column, n: Column) -> Column:
        here = F.year(anchor)
        first = F.try_to_date(F.format_string("%04d-%02d-%02d", here, m, F.coalesce(d, F.lit(1))), "yyyy-MM-dd")
        back = F.when(n.isNotNull(), F.when(n < 0, F.when(first < F.trunc(anchor, "month"), 0).otherwise(-1)).when(n > 0, F.when(first > anchor, 0).otherwise(1)).otherwise(0)).otherwise(F.when(F.coalesce(first > anchor, F.lit(False)), -1).otherwise(0))
        return F.when(y.isNotNull(), _year(y, anchor)).otherwise(here + back)

    relative_day = _moved(anchor, item["n"], item["u"])
    coarse = F.when(item["u"] == "year", "y").when(item["u"] == "month", "m").when(item["u"] == "quarter", "q").when((item["u"] == "week") & (item["d"].isNotNull() | item["about"]), "w").otherwise("d")
    quarter_month = F.when(coarse == "q", 3 * F.floor((F.month(relative_day) - 1) / 3).cast("int") + 1).otherwise(F.month(relative_day))
    relative = let(relative_day, lambda r: _interval(F.year(r), F.when(coarse != "y", quarter_month), F.when(coarse.isin("d", "w"), F.dayofmonth(r)), coarse))
    weekday = F.weekday(anchor)
    step = F.when(item["n"] > 0, F.pmod(item["d"] - weekday - 1, F.lit(7)) + 1).when(item["n"] == 0, item["d"] - weekday).otherwise(-F.pmod(weekday - item["d"] - 1, F.lit(7)) - 1)
    named = F.date_add(anchor, step)
    calendar = _interval(dated(item["y"], item["m"], item["d"], item["n"]), item["m"], item["d"], g)
    today = F.struct(anchor.alias("begin"), anchor.alias("end"))
    span = F.when(g == "r", relative).when(g == "n", today).when(g == "k", F.struct(named.alias("begin"), named.alias("end"))).otherwise(calendar)

    def shifted(s: Column) -> Column:
        day = item["su"].isin("day", "week")
        begin, end = _moved(s["begin"], item["sn"], item["su"]), _moved(s["end"], item["sn"], item["su"])
        # moved by months or years, a day is known to the month or year only
        month = F.when(item["su"] == "year", F.trunc(begin, "year")).otherwise(F.trunc(begin, "month"))
        last = F.when(item["su"] == "year", F.date_sub(F.add_months(F.trunc(end, "year"), 12), 1)).otherwise(F.last_day(end))
        return F.when(item["sn"].isNull(), s).when(day, F.struct(begin.alias("begin"), end.alias("end"))).otherwise(F.struct(month.alias("begin"), last.alias("end")))

    def parted(s: Column) -> Column:
        return F.when(item["f"].isNull(), s).otherwise(_third(s, item["f"]))

    # a point that was moved is as fine as the step
    step_grain = F.when(item["su"] == "year", "y").when(item["su"].isin("day", "week"), "d").otherwise("m")
    fine = F.when(item["sn"].isNotNull(), step_grain).when(g == "r", coarse).otherwise(g)

    def opened(s: Column) -> Column:
        iso = F.when((g == "n") & item["sn"].isNull(), F.date_format(anchor, "yyyy-MM-dd")).otherwise(covering(s["begin"], s["end"], fine))
        since, until = item["o"] == "since", item["o"] == "until"
        begin = F.when(until, F.lit(None).cast("date")).otherwise(s["begin"])
        end = F.when(since, F.lit(None).cast("date")).when(until, s["end"]).otherwise(s["end"])
        return F.when(s["begin"].isNotNull() & s["end"].isNotNull(), _whole(iso, begin, end))

    point = let(let(let(span, shifted), parted), opened)

    def between(y2: Column) -> Column:
        wraps = F.coalesce(item["m"] > item["m2"], F.lit(False))
        y1 = F.when(item["y"].isNotNull(), _year(item["y"], anchor)).otherwise(y2 - F.when(wraps, 1).otherwise(0))
        pair = F.struct(_interval(y1, item["m"], item["d"], g)["begin"].alias("begin"), _interval(y2, item["m2"], item["d2"], g)["end"].alias("end"))
        return let(pair, lambda s: F.when(s["begin"] <= s["end"], _whole(covering(s["begin"], s["end"], g), s["begin"], s["end"])))

    ranged = let(dated(item["y2"], item["m2"], item["d2"], F.lit(None).cast("double")), between)
    period = _whole(_period(item["n"], item["u"]), F.lit(None).cast("date"), F.lit(None).cast("date"))
    return F.when(k == K["point"], point).when(k == K["range"], ranged).otherwise(period)


def reading(found: Column, anchor: Column) -> Column:
    """struct(iso, begin, end, kind, about, readings) of ``readings`` against a date.

    kind: ``point``, ``since``, ``until``, ``range``, ``duration`` or ``set``; iso is empty and
    readings 0 where there is none.  readings counts the different values of all derivations.
    """
    names = F.expr("array(" + ",".join(f"'{n}'" for n in KINDS) + ")")
    values = F.transform(found, lambda x: F.struct(resolved(x, anchor).alias("v"), F.coalesce(x["o"], F.get(names, x["k"])).alias("kind"), x["about"].alias("about")))

    def best(some: Column) -> Column:
        first = F.get(some, F.lit(0))
        return F.struct(
            F.coalesce(first["v"]["iso"], F.lit("")).alias("iso"),
            first["v"]["begin"].alias("begin"),
            first["v"]["end"].alias("end"),
            first["kind"].alias("kind"),
            F.coalesce(first["about"], F.lit(False)).alias("about"),
            F.array_size(F.array_distinct(F.transform(some, lambda s: F.struct(s["v"].alias("v"), s["kind"].alias("kind"))))).alias("readings"),
        )

    return let(F.filter(values, lambda s: s["v"]["iso"].isNotNull()), best)


_built: dict[tuple, Column] = {}


def reading_of(text: str, anchor: str) -> tuple[Column, Column]:
    """``readings`` of a column and, of a column ``found`` that holds them, ``reading`` against another; built once for each pair of names."""
    key = (id(SparkContext._gateway), text, anchor)  # a column belongs to the JVM it was made in
    if key not in _built:
        _built[key] = (readings(F.col(text)), reading(F.col("found"), F.col(anchor)))
    return _built[key]
