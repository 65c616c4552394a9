"""Column functions against tables of known values."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempolith.functions import iso, text
from tempolith.functions.literals import read_literal
from tempolith.functions.timenorm import normalize
from tempolith.schemas import SENTINEL

ISO = [
    # iso, class, timeline text, normal text
    ("2023-10-15", "INSTANT", "2023-10-15", "2023-10-15 00:00"),
    ("2023-10", "INSTANT", "2023-10", "2023-10 00:00"),
    ("2023", "INSTANT", "2023", "2023 00:00"),
    ("2026-W01", "INSTANT", "2026-W01", "2026-01-01 00:00"),
    ("2026-W05", "INSTANT", "2026-W05", "2026-01-29 00:00"),
    ("2026-02-13T05:15:30", "INSTANT", "2026-02-13", "2026-02-13 05:15"),
    ("2026-02-13T05:15Z", "INSTANT", "2026-02-13", "2026-02-13 05:15"),
    ("PRESENT_REF", "INSTANT", "2024-03-08", "2024-03-08 14:45"),
    ("P6M", "DURATION", None, "6 Month"),
    ("P3W", "DURATION", None, "3 Week"),
    ("P2Y", "DURATION", None, "2 Year"),
    ("P10D", "DURATION", None, "10 Day"),
    ("PT45M", "DURATION", None, "45 Minute"),
    ("PT12H", "DURATION", None, "12 Hour"),
    ("PT30S", "DURATION", None, "30 Second"),
    ("PXW", "DURATION", None, f"{SENTINEL} Week"),
    ("P1Y6M", "DURATION", None, f"{SENTINEL} Month"),
    ("P1.5Y", "DURATION", None, f"{SENTINEL} Year"),
    ("PAST_REF", "DURATION", None, f"{SENTINEL} "),
    ("FUTURE_REF", "INSTANT", "FU", f"{SENTINEL} {SENTINEL}:00"),
    ("2023-SU", "INSTANT", "2023-SU", "2023 00:00"),
    ("2023-Q3", "INSTANT", "2023-Q3", "2023 00:00"),
    ("2023-11-14TMO", "INSTANT", "2023-11-14", f"2023-11-14 {SENTINEL}:00"),
    ("", "FAILED_NORMALIZATION", None, ""),
]


def test_iso_table(spark):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(ISO)], "i int, iso string, kind string, shown string, normal string")
    ts = F.lit("2024-03-08 14:45:00").cast("timestamp")
    c = F.col("iso")
    for r in rows.select("*", iso.time_class(c).alias("k"), iso.timeline_text(c, ts).alias("t"), iso.normal_text(c, ts).alias("n")).collect():
        assert (r.k, r.n) == (r.kind, r.normal), r
        if r.shown is not None:
            assert r.t == r.shown, r


TIMES = [
    ("October 15, 2023", "2023-10-15"),
    ("Oct. 15th, 2023", "2023-10-15"),
    ("15 October 2023", "2023-10-15"),
    ("7/20/2012", "2012-07-20"),
    ("October 2023", "2023-10"),
    ("2023", "2023"),
    ("2023-10-15", "2023-10-15"),
    ("today", "2023-11-15"),
    (" Yesterday\n", "2023-11-14"),
    ("tomorrow", "2023-11-16"),
    ("last week", "2023-W45"),
    ("last month", "2023-10"),
    ("next year", "2024"),
    ("3 weeks ago", "2023-10-25"),
    ("two months ago", "2023-09"),
    ("a year ago", "2022"),
    ("in 2 days", "2023-11-17"),
    ("6 months", "P6M"),
    ("12 hours", "PT12H"),
    ("Monday", "2023-11-13"),
    ("next Monday", "2023-11-20"),
    ("Wednesday", "2023-11-08"),
    ("February 30, 2023", ""),
    ("13/45/2020", ""),
    ("cycle 3", ""),
    ("", ""),
    (None, ""),
]


def test_time_expressions(spark):
    rows = spark.createDataFrame([(i, t, w) for i, (t, w) in enumerate(TIMES)], "i int, t string, want string")
    got = rows.select("t", "want", normalize(F.col("t"), F.lit("2023-11-15").cast("date")).alias("iso")).collect()
    assert [(r.t, r.iso) for r in got] == [(r.t, r.want) for r in got]


@settings(max_examples=15, deadline=None)
@given(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)))
def test_dates_round_trip(spark, day):
    texts = [f"{day:%B} {day.day}, {day.year}", f"{day.month}/{day.day}/{day.year}", f"{day.day} {day:%b} {day.year}", day.isoformat()]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0] for r in rows.select(normalize(F.col("t"), F.current_date())).collect()} == {day.isoformat()}


def test_text_functions(spark):
    row = spark.range(1).select(
        text.strip_think(F.lit("<think>a</think>\n b \n")).alias("stripped"),
        text.strip_think(F.lit(" none ")).alias("same"),
        text.bracketed(F.lit("x [1][2] y")).alias("list"),
        text.bracketed(F.lit("] x [")).alias("crossed"),
        text.find(F.lit("abcabc"), "c").alias("first"),
        text.find_last(F.lit("abcabc"), "b").alias("last"),
        text.find_last(F.lit("abc"), "x").alias("nowhere"),
        text.snippet(F.lit("0123456789"), F.lit(6), F.lit(8), F.lit(2), F.lit(3)).alias("snippet"),
        text.parse_int(F.lit("1.5"), SENTINEL).alias("bad"),
        text.parse_int(F.lit("07"), SENTINEL).alias("good"),
    ).first()
    assert row.asDict() == {"stripped": "b", "same": " none ", "list": "[1][2]", "crossed": None, "first": 2, "last": 4, "nowhere": -1, "snippet": "234567", "bad": SENTINEL, "good": 7}


@pytest.mark.parametrize("body, want", [("[{'SACT': 'a', 'relation': None}, ]", [{"SACT": "a", "relation": None, "time": None}]), ("['x']", None), ("{", None), (None, None), ("[]", []), ("[{'time': 7}]", [{"SACT": None, "relation": None, "time": "7"}])])
def test_literals(body, want):
    assert read_literal(body) == want
