"""From an ISO expression to its class, fields and texts, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DURATION, FAILED, INSTANT, SENTINEL
from .text import let, parse_int

_UNITS = {"Y": "Year", "M": "Month", "W": "Week", "D": "Day", "H": "Hour", "S": "Second"}


def time_class(iso: Column) -> Column:
    """FAILED_NORMALIZATION for nothing, DURATION for periods, INSTANT for the rest."""
    duration = iso.startswith("P") & (F.upper(iso) != "PRESENT_REF")
    return F.when(F.coalesce(iso, F.lit("")) == "", FAILED).when(duration, DURATION).otherwise(INSTANT)


def is_present(iso: Column) -> Column:
    return F.lower(iso) == "present_ref"


def date_iso(iso: Column) -> Column:
    """What stands before the time of day; PRESENT_REF stays."""
    return F.when(is_present(iso), iso).otherwise(F.regexp_extract(iso, "^[^T]*", 0))


def week_date(year: Column, week: Column) -> Column:
    """First day of a week counted from January 1st (not the ISO week)."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), 7 * (week - 1))


def date_fields(iso: Column, doc_date: Column | None = None) -> Column:
    """struct(text, year, year_value, month, month_value, day, day_value).

    Absent fields are 0, unreadable ones the sentinel; PRESENT_REF takes ``doc_date``.
    """

    def build(p: Column) -> Column:
        raw = [F.coalesce(F.get(p, F.lit(i)), F.lit("")) for i in range(3)]
        value = [F.when(r == "", 0).otherwise(parse_int(r, SENTINEL)) for r in raw]
        return let(F.struct(*(r.alias(f"r{i}") for i, r in enumerate(raw)), *(v.alias(f"v{i}") for i, v in enumerate(value))), dated)

    def dated(s: Column) -> Column:
        week = F.when(s["r1"].rlike("^W[0-9]{1,2}$") & (s["v0"] > 0), week_date(s["v0"], F.substring(s["r1"], 2, 2).cast("int")))
        month = F.when(week.isNotNull(), F.month(week)).otherwise(s["v1"])
        day = F.when(week.isNotNull(), F.dayofmonth(week)).otherwise(s["v2"])
        fields = [s["v0"], month, day]
        if doc_date is not None:
            here = is_present(iso)
            fields = [F.when(here, f(doc_date)).otherwise(v) for f, v in zip((F.year, F.month, F.dayofmonth), fields, strict=True)]
        named = F.struct(*(v.alias(n) for n, v in zip("ymd", fields, strict=True)))
        return let(named, lambda v: final(s, v))

    def final(s: Column, v: Column) -> Column:
        return F.struct(
            date_text(v["y"], v["m"], v["d"]).alias("text"),
            s["r0"].alias("year"),
            v["y"].alias("year_value"),
            s["r1"].alias("month"),
            v["m"].alias("month_value"),
            s["r2"].alias("day"),
            v["d"].alias("day_value"),
        )

    return let(F.split(date_iso(iso), "-"), build)


def two(value: Column) -> Column:
    """At least two digits."""
    return F.format_string("%02d", value)


def date_text(year: Column, month: Column, day: Column) -> Column:
    """YYYY[-MM[-DD]]: fields of 0 or less end it."""
    tail = F.when(month > 0, F.concat(F.lit("-"), two(month), F.when(day > 0, F.concat(F.lit("-"), two(day))).otherwise("")))
    return F.concat(year.cast("string"), F.coalesce(tail, F.lit("")))


def time_fields(iso: Column, doc_ts: Column | None = None) -> Column:
    """struct(text, hour, hour_value, minute, minute_value, second, second_value) of what follows the T."""
    body = F.regexp_replace(F.regexp_extract(iso, "^[^T]*T(.*)$", 1), "Z$", "")
    names = ("hour", "minute", "second")

    def build(p: Column) -> Column:
        raw = [F.coalesce(F.get(p, F.lit(i)), F.lit("")) for i in range(3)]
        value = [F.when(r == "", 0).otherwise(parse_int(r, SENTINEL)) for r in raw]
        if doc_ts is not None:
            here = is_present(iso)
            value = [F.when(here, f(doc_ts)).otherwise(v) for f, v in zip((F.hour, F.minute, F.second), value, strict=True)]
        text = F.concat(two(value[0]), F.lit(":"), two(value[1]))
        return F.struct(text.alias("text"), *(c for n, r, v in zip(names, raw, value, strict=True) for c in (r.alias(n), v.alias(f"{n}_value"))))

    return let(F.split(F.when(is_present(iso), F.lit("")).otherwise(body), ":"), build)


def duration_fields(iso: Column) -> Column:
    """struct(text, number, number_value, unit) of a period with one unit; others give the sentinel."""
    part = F.struct(*(F.regexp_extract(iso, "^P(T?)(.*)(.)$", i).alias(n) for i, n in enumerate(("timed", "number", "letter"), 1)))

    def build(p: Column) -> Column:
        unit = F.when((p["letter"] == "M") & (p["timed"] == "T"), "Minute")
        for k, v in _UNITS.items():
            unit = unit.when(p["letter"] == k, v)
        unit, value = unit.otherwise(""), parse_int(p["number"], SENTINEL)
        return F.struct(F.concat_ws(" ", value.cast("string"), unit).alias("text"), p["number"].alias("number"), value.alias("number_value"), unit.alias("unit"))

    return let(part, build)


def frequency_fields(iso: Column) -> Column:
    """struct(text, number, number_value, unit) of a period by which something recurs; ``text`` is the period itself."""
    text = F.trim(iso)
    return let(duration_fields(text), lambda d: F.struct(text.alias("text"), d["number"].alias("number"), d["number_value"].alias("number_value"), d["unit"].alias("unit")))


def modifier(begin: Column, end: Column, form: Column) -> Column:
    """struct(begin, end, form): a duration or a frequency where it stands in a text."""
    return F.struct(begin.alias("begin"), end.alias("end"), form.alias("form"))


def normal_text(iso: Column, doc_ts: Column | None = None) -> Column:
    """The normalized time as people read it."""
    instant = F.concat_ws(" ", date_fields(iso, doc_ts)["text"], time_fields(iso, doc_ts)["text"])
    return F.when(time_class(iso) == FAILED, "").when(time_class(iso) == DURATION, duration_fields(iso)["text"]).otherwise(instant)


def timeline_text(iso: Column, doc_ts: Column | None = None) -> Column:
    """The instant of a timeline: a date, or a coarser ISO form as it stands."""
    human = F.when(is_present(iso), date_fields(iso, doc_ts)["text"]).otherwise(date_iso(iso)) if doc_ts is not None else date_iso(iso)
    return F.when(iso.contains("T"), human).otherwise(iso)


def instant_text(iso: Column, doc_ts: Column | None = None, style: str = "mix") -> Column:
    """An instant as ``iso``, as people read it (``human``), or as ``mix``: dates for what has a time of day, else ISO."""
    if style == "iso":
        return iso
    if style == "human":
        return normal_text(iso, doc_ts)
    if style == "mix":
        return timeline_text(iso, doc_ts)
    raise ValueError(f"{style} is none of iso, human, mix")
