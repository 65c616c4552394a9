"""Secret scanning with multipart credential linking, in Column expressions and joins only.

Base secrets are found by pattern alone.  Weaker candidates (an identifier, a short or
unprefixed secret, an endpoint) are reported only where complementary parts stand within
one scope: an interval join per document brings together a secret and the identifiers and
endpoints that are at most ``SCOPE`` code points away from it.  A base access key may stand
for the identifier, a base assignment or hex string for the secret.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .storage import materialise

#: code points between parts that belong together
SCOPE = 200
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind: (pattern, group whose length counts, least length); the maximal runs below are the
#: same spans as those of the open-ended patterns that are long enough
BASE = {
    "assign": (ASSIGN, 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
WEAK = {
    "identifier": (r"""(?i)(?<![A-Za-z0-9])(?:access_?key_?id|client_?id|app_?id|account_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", 0, 1),
    "weak_secret": (r"""(?i)(?<![A-Za-z0-9])(?:pwd|pass|pass_?phrase|private_?key|auth_?key|access_?key|credentials?|signature|key)["']?\x20*[:=]\x20*["']?[^\s"',;]{4,}|(?-i)(?<![A-Za-z0-9+/=])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])(?=[A-Za-z+/]*[0-9])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])""", 0, 1),
    "endpoint": (r"""(?i)(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?|s?ftp|ssh)://[^\s"'<>]+|(?<![A-Za-z0-9])(?:host|hostname|server|endpoint|url)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.:/_-]{3,}""", 0, 1),
}
#: the order of kinds at one start
KINDS = (*BASE, *WEAK)


#: a text without all of these, or any of a tuple's, holds no match of the kind; letters in lower case
_HINTS = {
    "assign": ((":", "="), ("password", "passwd", "secret", "token", "apikey", "api_key")),
    "access": ("akia",),
    "identifier": ((":", "="), ("access", "client", "app", "account", "user", "login")),
    "endpoint": ((":", "="), ("://", "host", "server", "endpoint", "url")),
}


def _matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """Array of (gap before the match, its length, whether it counts), null where there is none."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    rows = F.zip_with(F.transform(whole, lambda m: F.length(m)), F.transform(part, lambda p: F.length(p) >= least), lambda n, ok: F.struct(n.alias("n"), ok.alias("ok")))
    rows = F.zip_with(gaps, rows, lambda g, r: F.struct(g.alias("gap"), r["n"].alias("n"), r["ok"].alias("ok")))
    return F.when(text.rlike(pattern), F.filter(rows, lambda r: r["n"].isNotNull()))


def _likely(lower: Column, kind: str) -> Column:
    out = F.lit(True)
    for hint in _HINTS.get(kind, ()):
        out &= functools.reduce(lambda a, b: a | b, (F.contains(lower, F.lit(h)) for h in ((hint,) if isinstance(hint, str) else hint)))
    return out


def scan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): doc_id with a row number of its own, and (row, kind, start, end) of all candidates.

    Offsets are code points, ends exclusive.  kind is the place in KINDS.
    """
    text = F.col("text")
    # the text is scanned once; what is kept is short
    named = docs.select("doc_id", "text", F.lower(text).alias("lower"))
    found = named.select("doc_id", *(F.when(_likely(F.col("lower"), kind), _matches(text, *how)).alias(kind) for kind, how in (BASE | WEAK).items()))
    found = materialise(found.withColumn("row", F.monotonically_increasing_id()), "candidates")
    each = F.array(*(F.struct(F.lit(i).alias("kind"), F.col(k).alias("found")) for i, k in enumerate(KINDS)))
    some = found.where(" or ".join(f"`{k}` is not null" for k in KINDS))
    flat = some.select("row", F.explode(each).alias("k")).where("k.found is not null").select("row", "k.kind", F.posexplode("k.found").alias("i", "m"))
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = flat.select("row", "kind", "m.n", "m.ok", F.sum(F.col("m.gap") + F.col("m.n")).over(upto).alias("end"))
    spans = placed.where("ok").select("row", "kind", (F.col("end") - F.col("n")).alias("start"), "end")
    return found.select("row", "doc_id"), materialise(spans, "spans")


def _binned(spans: DataFrame, reach: int, scope: int) -> DataFrame:
    """One row for each bin of ``scope`` code points that a span, widened by ``reach``, touches."""
    low = F.floor((F.col("start") - reach) / scope)
    high = F.floor((F.col("end") + reach) / scope)
    return spans.withColumn("bin", F.explode(F.sequence(low, high)))


def _near(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Rows of ``left`` with a row of ``right`` in the same document beside it, at most ``scope`` code points away."""
    a, b = _binned(left, scope, scope).alias("a"), _binned(right, 0, scope).alias("b")
    close = (F.col("a.row") == F.col("b.row")) & (F.col("a.bin") == F.col("b.bin"))
    gap = F.greatest(F.col("b.start") - F.col("a.end"), F.col("a.start") - F.col("b.end"))
    return a.join(b, close & gap.between(0, scope), "left_semi").drop("bin").distinct()


def _apart(left: DataFrame, right: DataFrame, scope: int) -> DataFrame:
    """Rows of ``left`` that share no code point with a row of ``right``."""
    a, b = _binned(left, 0, scope).alias("a"), _binned(right, 0, scope).alias("b")
    met = (F.col("a.row") == F.col("b.row")) & (F.col("a.bin") == F.col("b.bin")) & (F.col("a.start") < F.col("b.end")) & (F.col("b.start") < F.col("a.end"))
    return left.join(a.join(b, met, "left_semi").drop("bin").distinct(), ["row", "kind", "start", "end"], "left_anti")


def link(spans: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak spans (row, kind, start, end) whose complementary parts co-occur within ``scope``.

    A secret needs an identifier or an endpoint beside it; identifiers and endpoints are
    reported where they are near such a secret.  Parts that overlap are no complements: a
    weak secret within a base span is that span's, and an identifier is no company for the
    string that is its own value.
    """
    of = {k: i for i, k in enumerate(KINDS)}
    company = spans.where(F.col("kind").isin(of["identifier"], of["access"], of["endpoint"]))
    base = spans.where(F.col("kind").isin(of["assign"], of["hex"]))
    weak = _apart(spans.where(F.col("kind") == of["weak_secret"]), spans.where(F.col("kind") < len(BASE)), scope)
    secret = base.union(weak.select(base.columns))
    whole = materialise(_near(secret, company, scope), "linked")
    parts = _near(company, whole, scope).union(whole)
    return parts.where(F.col("kind") >= len(BASE))


def _listed(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): counts of base kinds and all spans.

    Columns: doc_id, base and found, both arrays of (start, kind, end) in that order, base
    without the linked parts.  A null text counts as empty: no spans.  Texts of any length
    are read whole, repeated rows one by one.  Spans of one start stand in the order of
    KINDS.  Other columns of ``docs`` are not read.
    """
    rows, spans = scan(docs.select("doc_id", "text"))
    base = spans.where(F.col("kind") < len(BASE))
    every = base.union(link(spans, scope))
    packed = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    none = F.expr("cast(array() as array<struct<start:bigint,kind:int,end:bigint>>)")
    out = rows.join(packed, "row", "left").withColumn("found", F.coalesce("found", none))
    return out.select("doc_id", F.filter("found", lambda s: s["kind"] < len(BASE)).alias("base"), "found")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of ``docs``."""
    found = secrets(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))
