"""Personal data replaced by format-preserving Feistel pseudonyms, in Column expressions only.

A validated number or date is a point of a finite domain (its digits, its day, its
octets).  A keyed Feistel network permutes the domain, so the pseudonym has the same
format, stays valid, and is the same wherever the same value occurs, while different
values stay different.  E-mail addresses have no finite domain; they get keyed tags of
64 bits for the mailbox and for the domain, so two of them share one by chance only.  Where the domain is no product of two numbers, the network runs
on the next larger product and is walked until it falls inside the domain again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import unused

ROUNDS = 8
#: steps of a walk; the domains fill at least 0.6 of their product, so it ends long before
WALK = 96
_FIRST_DAY, _DAYS = "1900-01-01", 73049  # to 2099-12-31

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
#: characters of an IBAN by country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban_form(length: int) -> str:
    groups, rest = divmod(length - 4, 4)
    return f"(?: ?[A-Z0-9]{{4}}){{{groups}}}" + (f" ?[A-Z0-9]{{{rest}}}" if rest else "")


_KNOWN = "|".join(f"(?:{'|'.join(names.split())})[0-9]{{2}}{_iban_form(n)}" for n, names in IBAN_LENGTHS.items())
#: by the country's length, so that no token behind it is taken in; other countries and lengths as long as they go
_IBAN = rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_KNOWN}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?)(?![0-9A-Za-z])"
_NANP = r"\+1[ .-]?(?:\([2-9][0-9]{2}\)|[2-9][0-9]{2})[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
#: without a plus: area and exchange codes begin with 2 to 9 and one separator stands twice, or the area code
#: stands in brackets, or the number begins with a trunk 0
_HOME = r"[2-9][0-9]{2}(?: [2-9][0-9]{2} |-[2-9][0-9]{2}-|\.[2-9][0-9]{2}\.)[0-9]{4}|\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}|0[0-9]{1,3}[ .-][0-9]{3,4}[ .-][0-9]{4}"
_OTHER = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?|[0-9]{2,4}[ .-][0-9]{3,4}[ .-])[0-9]{4}"
#: international form: at most 15 digits, with or without separators
_ABROAD = r"\+(?=[2-9])(?=(?:[ .()-]{0,2}[0-9]){8,15}(?![0-9A-Za-z]))[0-9](?:[ .-]?(?:\([0-9]{1,4}\)|[0-9])){6,14}"
#: what stays of a phone number: a trunk 0, or the calling code, that is one digit, one of the pairs, or three digits
_CALLING = r"^(?:\(?0|\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}|[0-9]{1,2})[ .-]?)"
#: months by their English names, behind the day or before it
_MONTH = "(?:Jan(?:uary|[.])?|Feb(?:ruary|[.])?|Mar(?:ch|[.])?|Apr(?:il|[.])?|May|Jun(?:e|[.])?|Jul(?:y|[.])?|Aug(?:ust|[.])?|Sep(?:tember|t?[.]|t)?|Oct(?:ober|[.])?|Nov(?:ember|[.])?|Dec(?:ember|[.])?)"
_WRITTEN = rf"(?:{_MONTH} [0-9]{{1,2}},? |[0-9]{{1,2}} {_MONTH},? )(?:19|20)[0-9]{{2}}"
#: kind: pattern; where two fit at one place, the first of the list is tried first
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++",
    "iban": _IBAN,
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z-])",
    "date": rf"(?<![0-9A-Za-z./-])(?:(?:19|20)[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{1,2}}([./])[0-9]{{1,2}}\2(?:19|20)[0-9]{{2}}|{_WRITTEN})(?![0-9A-Za-z]|[./-][0-9])",
    "phone": rf"(?<![0-9A-Za-z])(?:{_NANP}|{_ABROAD}|{_OTHER}|{_HOME})(?![0-9A-Za-z])",
    "ip": rf"(?<![0-9A-Za-z.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
}
#: a line that can hold none of them is passed over by this
_ANY = "(?:" + "|".join(PATTERNS.values()) + ")"
KINDS = tuple(PATTERNS)


def _prf(key: str, tweak: Column, round_: Column, value: Column) -> Column:
    """60 keyed pseudo-random bits."""
    text = F.concat_ws("|", F.lit(key), tweak, round_.cast("string"), value.cast("string"), F.lit(key))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("bigint")


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """Keyed permutation of the pairs (x, y) with x < a and y < b, as a struct."""

    def step(s: Column, r: Column) -> Column:
        left = F.struct(((s["x"] + F.pmod(_prf(key, tweak, r, s["y"]), a)) % a).alias("x"), s["y"].alias("y"))
        right = F.struct(s["x"].alias("x"), ((s["y"] + F.pmod(_prf(key, tweak, r, s["x"]), b)) % b).alias("y"))
        return F.when(r % 2 == 1, left).otherwise(right)

    start = F.struct(x.cast("bigint").alias("x"), y.cast("bigint").alias("y"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def permute_index(index: Column, n: int, key: str, tweak: Column, inside=None) -> Column:
    """Keyed permutation of 0 .. n-1, or of those of them for which ``inside`` holds, by cycle-walking."""
    a = int(n**0.5)
    while a * a < n:
        a += 1
    b = -(-n // a)

    def step(v: Column) -> Column:
        s = feistel((v / b).cast("bigint"), v % b, F.lit(a), F.lit(b), key, tweak)
        return F.transform(F.array(s), lambda t: t["x"] * b + t["y"])[0]

    def outside(v: Column) -> Column:
        return (v >= n) if inside is None else ((v >= n) | ~inside(v))

    first = step(index.cast("bigint"))
    # a walk passes each point outside once at most, and goes on with the share of them
    walk = WALK if inside is not None else min(a * b - n, WALK, math.ceil(30 / math.log10(a * b / max(1, a * b - n))) if a * b > n else 0)
    return F.aggregate(F.sequence(F.lit(1), F.lit(walk)), first, lambda v, _: F.when(outside(v), step(v)).otherwise(v)) if walk else first


def permute_digits(digits: Column, key: str, tweak: Column) -> Column:
    """Keyed permutation of the strings of as many digits (up to 30)."""
    n = F.length(digits)
    half = F.ceil(n / 2).cast("int")

    def power(k: Column) -> Column:
        return F.rpad(F.lit("1"), k + 1, F.lit("0")).cast("bigint")

    rest = n - half
    s = feistel(F.substring(digits, F.lit(1), half).cast("bigint"), F.concat(F.lit("0"), F.substring(digits, half + 1, rest)).cast("bigint"), power(half), power(rest), key, F.concat(tweak, n.cast("string")))
    return F.transform(F.array(s), lambda t: F.concat(F.lpad(t["x"].cast("string"), half, "0"), F.when(rest > 0, F.lpad(t["y"].cast("string"), rest, "0")).otherwise("")))[0]


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits``, one by one."""

    def char(i: Column) -> Column:
        c = F.substring(form, i, F.lit(1))
        nth = F.length(_digits(F.substring(form, F.lit(1), i)))
        return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), char), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of digits whose last is a check digit."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _mod97(text: Column) -> Column:
    """Remainder of an IBAN-like string whose letters count as 10 to 35."""

    def add(r: Column, c: Column) -> Column:
        v = F.when(c.between("0", "9"), r * 10 + (F.ascii(c) - 48)).otherwise(r * 100 + (F.ascii(c) - 55))
        return v % 97

    return F.aggregate(F.split(text, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(add(r, c)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _card(m: Column, key: str) -> Column:
    def build(payload: Column) -> Column:
        return _let(payload, lambda p: F.concat(p, F.pmod(-_luhn(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))

    new = _let(_digits(m), lambda d: F.when(_luhn(d) % 10 == 0, build(permute_digits(F.substring(d, F.lit(1), F.length(d) - 1), key, F.lit("card")))))
    return _let(new, lambda d: F.when(d.isNotNull(), _refill(m, d)).otherwise(m))


def _iban(m: Column, key: str) -> Column:
    def build(plain: Column) -> Column:
        def numbered(bban: Column) -> Column:
            country = F.substring(plain, 1, 2)
            check = 98 - _mod97(F.concat(bban, country, F.lit("00")))
            return F.concat(F.lpad(check.cast("string"), 2, "0"), _digits(bban))

        rest = F.substring(plain, F.lit(5), F.length(plain))
        changed = _let(_digits(rest), lambda d: F.when(F.length(d) > 0, _refill(rest, permute_digits(d, key, F.concat(F.lit("iban"), F.regexp_replace(plain, "[0-9]", "#"))))).otherwise(rest))
        return _let(changed, lambda bban: _refill(m, numbered(bban)))

    plain = F.regexp_replace(m, " ", "")
    return _let(plain, lambda p: F.when(_mod97(F.concat(F.substring(p, F.lit(5), F.length(p)), F.substring(p, 1, 4))) == 1, build(p)).otherwise(m))


def _ssn(m: Column, key: str) -> Column:
    def rank(d: Column) -> Column:
        area = F.substring(d, 1, 3).cast("bigint")
        area = F.when(area < 666, area - 1).otherwise(area - 2)
        return (area * 99 + F.substring(d, 4, 2).cast("bigint") - 1) * 9999 + F.substring(d, 6, 4).cast("bigint") - 1

    def form(v: Column) -> Column:
        area = (v / (99 * 9999)).cast("bigint")
        area = F.when(area < 665, area + 1).otherwise(area + 2)
        group, serial = (v / 9999).cast("bigint") % 99 + 1, v % 9999 + 1
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad(group.cast("string"), 2, "0"), F.lpad(serial.cast("string"), 4, "0"))

    return _let(permute_index(_let(_digits(m), rank), 898 * 99 * 9999, key, F.lit("ssn")), form)


def _late(day: Column) -> Column:
    """Whether the day of the month is over 12, so that it can't be read as a month."""
    return F.dayofmonth(F.date_add(F.to_date(F.lit(_FIRST_DAY)), day.cast("int"))) > 12


def permute_day(day: Column, key: str) -> Column:
    """Keyed permutation of the days from 1900 to 2099.

    Days over the 12th of a month and others are permuted among themselves: whichever of day
    and month a form puts first, the pseudonym is read as the value was, in every form.
    """
    return _let(day, lambda d: permute_index(d, _DAYS, key, F.lit("day"), inside=lambda v: _late(v) == _late(d)))


def _date(m: Column, key: str) -> Column:
    first = F.to_date(F.lit(_FIRST_DAY))
    # what a month's abbreviation may have besides its three letters
    plain = F.regexp_replace(F.regexp_replace(m, "Sept(?!e)", "Sep"), "(?<=[A-Za-z])[.]|,", "")
    written, lead = m.rlike("[A-Z]"), m.rlike("^[0-9]")
    #: (where it may stand, the form read, its numbers with leading zeros); with strokes the day comes first where that is a date
    forms = [
        (m.contains("-"), "yyyy-MM-dd"),
        *((~written & m.contains(mark) & ((F.length(m) == 10) == F.lit(form.startswith(("dd", "MM")))), form) for mark, form in ((".", "dd.MM.yyyy"), (".", "d.M.yyyy"), ("/", "dd/MM/yyyy"), ("/", "d/M/yyyy"), ("/", "MM/dd/yyyy"), ("/", "M/d/yyyy"))),
        *((written & (lead if form.startswith("d") else ~lead), form) for form in ("d MMMM yyyy", "MMMM d yyyy", "d MMM yyyy", "MMM d yyyy")),
    ]

    def read(i: int, fits: Column, form: str) -> Column:
        day = F.datediff(F.to_date(F.try_to_timestamp(F.when(fits, plain), F.lit(form))), first)
        return _let(day, lambda d: F.when(d.isNotNull(), F.struct(d.alias("day"), F.lit(i).alias("form"))))

    def rendered(form: str, date: Column) -> Column:
        text = F.date_format(date, form)
        if not form.endswith(" yyyy"):
            return text
        # a full stop or comma stands where it stood
        text = F.regexp_replace(text, "([A-Za-z]+)", F.concat(F.lit("$1"), F.when(m.contains("."), ".").otherwise("")))
        return F.when(m.contains(","), F.regexp_replace(text, " (?=[0-9]{4}$)", ", ")).otherwise(text)

    def moved(found: Column) -> Column:
        def written_out(date: Column) -> Column:
            out = F.lit(None).cast("string")
            for i, (_, form) in enumerate(forms):
                out = F.when(found["form"] == i, rendered(form, date)).otherwise(out)
            return out

        return F.when(found.isNotNull(), _let(F.date_add(first, permute_day(found["day"], key).cast("int")), written_out))

    return F.coalesce(_let(F.coalesce(*(read(i, *f) for i, f in enumerate(forms))), moved), m)


def _subscriber(digits: Column) -> Column:
    """Whether ten digits, as a number, have area and exchange codes as North American numbers have."""
    return ((digits / 1_000_000_000).cast("bigint") > 1) & (((digits / 1_000_000).cast("bigint") % 10) > 1)


def _phone(m: Column, key: str) -> Column:
    def moved(digits: Column) -> Column:
        # ten digits that are a North American number become one, others others
        ten = _let(digits.cast("bigint"), lambda v: permute_index(v, 10**10, key, F.lit("phone"), inside=lambda x: _subscriber(x) == _subscriber(v)))
        return F.when(F.length(digits) == 10, F.lpad(ten.cast("string"), 10, "0")).otherwise(permute_digits(digits, key, F.lit("phone")))

    prefix = F.regexp_extract(m, _CALLING, 0)
    return _let(prefix, lambda p: _let(F.substring(m, F.length(p) + 1, F.length(m)), lambda rest: F.concat(p, _refill(rest, moved(_digits(rest))))))


def _ip(m: Column, key: str) -> Column:
    part = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    moved = _let(part, lambda p: feistel(p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key, F.lit("ip")))
    return _let(moved, lambda s: F.concat_ws(".", *(v.cast("bigint").cast("string") for v in ((s["x"] / 256).cast("bigint"), s["x"] % 256, (s["y"] / 256).cast("bigint"), s["y"] % 256))))


def _email(m: Column, key: str) -> Column:
    def tag(text: Column, what: str, n: int) -> Column:
        return F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(what), F.lower(text), F.lit(key)).cast("binary"), 256), 1, n)

    domain = F.substring_index(m, "@", -1)
    return F.concat(F.lit("u"), tag(m, "mailbox", 16), F.lit("@d"), tag(domain, "domain", 16), F.lit(".example"))


_PSEUDONYM = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "date": _date, "phone": _phone, "ip": _ip}


def kind(m: Column) -> Column:
    """The kind of a match of the common pattern; the order is the pattern's."""
    out = F.when(m.contains("@"), "email").when(m.rlike("^[A-Z]{2}[0-9]{2}"), "iban")
    bare = m.rlike("^(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\\1[0-9]{4}\\1[0-9]{1,7}|3[47][0-9]{2}[ -][0-9]{6}[ -][0-9]{5})$")
    out = out.when(bare, "card").when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
    out = out.when(m.rlike(r"^(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4}|.*[A-Z].*)$"), "date")
    return out.when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip").otherwise("phone")


def pseudonym(m: Column, key: str) -> Column:
    """Pseudonym of one match; what fails validation (check digits, calendar) comes back as it is."""
    k = kind(m)
    out = F.when(k == "email", _email(m, key))
    for name in KINDS[1:]:
        out = out.when(k == name, _PSEUDONYM[name](m, key))
    return out


def pseudonymise(docs: DataFrame, key: str, text: str = "text", count: str | None = "n_private") -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a new column ``count`` of how many stand there, if it is named.

    Nothing but the matches changes; a null text stays null and has none.  Texts of any
    length are read whole, and repeated rows get the same pseudonyms.  Where ``docs`` has a
    column named ``count``, the new one has underscores before its name.  Where two kinds fit
    at one place, the first of PATTERNS is meant.
    """
    body, there, new = F.col(text), unused("__found", docs.columns), unused("__new", docs.columns)
    found = docs.withColumn(there, F.when(body.rlike("[0-9@]"), F.regexp_extract_all(body, F.lit(_ANY), F.lit(0))))
    found = found.withColumn(new, F.when(F.size(there) > 0, F.transform(there, lambda m: pseudonym(m, key))))
    gaps = F.split(body, _ANY, -1)
    whole = F.array_join(F.zip_with(gaps, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with(there, new, lambda a, b: a != b), lambda x: x))
    out = found.withColumn(text, F.when(F.col(new).isNotNull(), whole).otherwise(body))
    if count is not None:
        out = out.withColumn(unused(count, docs.columns), F.when(F.col(new).isNotNull(), changed).otherwise(0).cast("long"))
    return out.drop(there, new)
