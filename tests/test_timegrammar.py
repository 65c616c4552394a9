"""The grammar of time expressions: usual forms, nestings, ambiguity, failures."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tempolith.functions import timegrammar as g
from tempolith.operators.times import read_times

ANCHOR = datetime.date(2023, 10, 20)
#: expression: (iso, first day, last day, kind)
FORMS = {
    "10/2023": ("2023-10", "2023-10-01", "2023-10-31", "point"),
    "10/15/23": ("2023-10-15", "2023-10-15", "2023-10-15", "point"),
    "10/15/99": ("1999-10-15", "1999-10-15", "1999-10-15", "point"),
    "early 2023": ("2023", "2023-01-01", "2023-04-30", "point"),
    "Q3 2023": ("2023", "2023-07-01", "2023-09-30", "point"),
    "third quarter of 2022": ("2022", "2022-07-01", "2022-09-30", "point"),
    "the first half of 2022": ("2022", "2022-01-01", "2022-06-30", "point"),
    "October 15": ("2023-10-15", "2023-10-15", "2023-10-15", "point"),
    "October 25": ("2022-10-25", "2022-10-25", "2022-10-25", "point"),
    "the week of July 10, 2023": ("2023-W28", "2023-07-09", "2023-07-15", "point"),
    "July 10-12, 2023": ("2023-07", "2023-07-10", "2023-07-12", "range"),
    "every 3 weeks": ("P3W", None, None, "set"),
    "every other week": ("P2W", None, None, "set"),
    "twice a day": ("PT12H", None, None, "set"),
    "daily": ("P1D", None, None, "set"),
    "a few weeks ago": ("2023-W39", "2023-09-24", "2023-09-30", "point"),
    "since 2019": ("2019", "2019-01-01", None, "since"),
    "until March 2024": ("2024-03", None, "2024-03-31", "until"),
    "two and a half years": ("P30M", None, None, "duration"),
    "a year and a half ago": ("2022", "2022-01-01", "2022-12-31", "point"),
    "twenty-one days": ("P21D", None, None, "duration"),
    "2-3 weeks": ("P2W", None, None, "duration"),
    "1 year and 3 months": ("P15M", None, None, "duration"),
    "half an hour": ("PT30M", None, None, "duration"),
    "late last year": ("2022", "2022-09-01", "2022-12-31", "point"),
    "mid-October": ("2023-10", "2023-10-11", "2023-10-20", "point"),
    "last October": ("2022-10", "2022-10-01", "2022-10-31", "point"),
    "next spring": ("2024", "2024-03-01", "2024-05-31", "point"),
    "Monday, October 16, 2023": ("2023-10-16", "2023-10-16", "2023-10-16", "point"),
    "from January 2020 to March 2021": ("2020-01", "2020-01-01", "2021-03-31", "range"),
    "December to February 2023": ("2022-12", "2022-12-01", "2023-02-28", "range"),
    "between March and June 2022": ("2022", "2022-03-01", "2022-06-30", "range"),
    "two weeks after October 15, 2023": ("2023-10-29", "2023-10-29", "2023-10-29", "point"),
    "three months before early 2023": ("2022-10", "2022-10-01", "2023-01-31", "point"),
    "since two weeks before the week of July 10, 2023": ("2023-W26", "2023-06-25", None, "since"),
    "Q3W": ("P3W", None, None, "set"),
}
FAIL = ["31/31/2023", "February 30, 2023", "13/15/2023", "2023 to 2020", "early early 2023", "of the", "July 40, 2023", "weeks", "every", "5", "a b c d e f g h i j k l m n o p q", "¿?"]


@pytest.fixture(scope="module")
def read(spark):
    def run(texts, anchor=ANCHOR):
        frame = spark.createDataFrame([(t, anchor) for t in texts], "covered_text string, doc_date date")
        return {r.covered_text: r for r in read_times(frame).collect()}

    return run


def test_usual_forms_and_nestings(read):
    got, wrong = read([*FORMS]), {}
    for text, (iso, first, last, kind) in FORMS.items():
        r = got[text]
        day = lambda x: None if x is None else x.isoformat()
        want = (iso, first, last, kind)
        if (r.iso, day(r.first_day), day(r.last_day), r.time_kind) != want or r.readings < 1:
            wrong[text] = r
    assert not wrong


def test_what_has_no_reading_by_rule(read):
    got = read(FAIL + ["", "  ", None])
    assert all((r.iso, r.readings, r.first_day) == ("", 0, None) for r in got.values()) and len(got) == len(FAIL) + 3


def test_ambiguity_is_counted(spark):
    texts = ["in 2 days", "Q3 2023", "q 3 weeks", "October 2023"]
    frame = spark.createDataFrame([(t, ANCHOR) for t in texts], "t string, a date")
    got = {r.t: r.r for r in frame.withColumn("found", g.readings(F.col("t"))).select("t", g.reading(F.col("found"), F.col("a")).alias("r")).collect()}
    # two days from now is cheaper than a span of two days
    assert (got["in 2 days"].iso, got["in 2 days"].readings) == ("2023-10-22", 2)
    assert [got[t].readings for t in texts[1:]] == [1, 1, 1]


def test_without_a_date_only_what_needs_none_is_read(read):
    got = read(["early 2023", "October 15", "a few weeks ago", "every 3 weeks", "10/15/23"], None)
    assert [got[t].iso for t in ("early 2023", "October 15", "a few weeks ago", "every 3 weeks")] == ["2023", "", "", "P3W"]


def test_each_text_and_date_is_read_once(spark):
    frame = spark.createDataFrame([("early 2023", ANCHOR - datetime.timedelta(i)) for i in range(20)] * 3, "covered_text string, doc_date date")
    assert read_times(frame).count() == 20


MONTH = ["January", "May", "September", "December"]


def test_composed_at_random_equal_their_parts(read):
    """What is composed of a day and a number of weeks, by arithmetic on days."""
    rng = random.Random(2)
    want = {}
    for _ in range(60):
        day = datetime.date(rng.randint(1990, 2030), rng.choice([1, 5, 9, 12]), rng.randint(1, 28))
        name = f"{MONTH[[1, 5, 9, 12].index(day.month)]} {day.day}, {day.year}"
        n, sign = rng.randint(2, 40), rng.choice([-1, 1])
        moved = day + datetime.timedelta(7 * n * sign)
        want[f"{n} weeks {'after' if sign > 0 else 'before'} {name}"] = (moved.isoformat(), moved, moved)
        want[f"since {name}"] = (day.isoformat(), day, None)
    got = read([*want])
    assert {t: (r.iso, r.first_day, r.last_day) for t, r in got.items()} == want
