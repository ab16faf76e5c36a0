from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folioforge.functions.dates import floor_day
from folioforge.operators import windows as W


def rows(df):
    return [(r.date_from, r.date_to) for r in df.orderBy("position").collect()]


def test_months_are_clipped_and_newest_first(spark):
    limits = W.bounds(spark, date(2023, 12, 15), date(2024, 2, 10))
    assert rows(W.month_windows(limits)) == [
        (date(2024, 2, 1), date(2024, 2, 10)),
        (date(2024, 1, 1), date(2024, 1, 31)),
        (date(2023, 12, 15), date(2023, 12, 31)),
    ]


def test_years_are_clipped_and_newest_first(spark):
    limits = W.bounds(spark, date(2022, 6, 1), date(2024, 3, 5))
    assert rows(W.year_windows(limits)) == [
        (date(2024, 1, 1), date(2024, 3, 5)),
        (date(2023, 1, 1), date(2023, 12, 31)),
        (date(2022, 6, 1), date(2022, 12, 31)),
    ]


def test_a_single_day_is_one_window(spark):
    day = date(2024, 2, 29)
    assert rows(W.month_windows(W.bounds(spark, day, day))) == [(day, day)]


def test_inverted_limits_are_an_error(spark):
    with pytest.raises(PySparkException, match="is after until"):
        W.month_windows(W.bounds(spark, date(2024, 2, 1), date(2024, 1, 1))).collect()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dates(date(1975, 1, 1), date(2030, 1, 1)), st.integers(0, 900))
def test_months_cover_each_day_once(spark, start, days):
    end = start + timedelta(days=days)
    found = rows(W.month_windows(W.bounds(spark, start, end)))
    covered = [a + timedelta(days=i) for a, b in reversed(found) for i in range((b - a).days + 1)]
    assert covered == [start + timedelta(days=i) for i in range(days + 1)]


def test_overlap_starts_three_days_before_the_cutoff(spark):
    corpus = spark.createDataFrame([("2020-03-02",), ("",), (None,)], "date string")
    got = W.overlap_range(corpus, date(2020, 4, 1)).collect()
    assert got == [(date(2020, 2, 28), date(2020, 4, 1))]
    full = W.overlap_range(corpus, date(2020, 4, 1), full=True).collect()
    assert full == [(date(1975, 1, 1), date(2020, 4, 1))]


def test_no_cutoff_is_an_error(spark):
    corpus = spark.createDataFrame([("",), (None,)], "date string")
    with pytest.raises(PySparkException, match="no cutoff"):
        W.overlap_range(corpus, date(2020, 4, 1)).collect()


DATES = [
    "2020-01-01", "2020-01-31", "2020-01-31T10:00", "2020-02-01", "2020-1-5", "2020", "",
    None, "2019-12-31", "2020-01-1", "junk", "2020-12-31", "2021-01-01",
]
SPANS = [
    (date(2020, 1, 1), date(2020, 1, 31)),
    (date(2020, 1, 31), date(2020, 1, 31)),
    (date(2020, 1, 1), date(2020, 12, 31)),
    (date(2019, 12, 1), date(2020, 2, 1)),
    (date(2020, 9, 15), date(2020, 10, 31)),
    (date(2022, 1, 1), date(2022, 1, 31)),
]


def test_counts_compare_text_inclusively(spark):
    """Also malformed dates are counted exactly as a text comparison counts them."""
    corpus = spark.createDataFrame([(d,) for d in DATES], "date string")
    spans = spark.createDataFrame(SPANS, "date_from date, date_to date")
    got = {(r.date_from, r.date_to): r.local_count for r in W.window_counts(corpus, spans).collect()}
    want = {
        (a, b): sum(d is not None and a.isoformat() <= d <= b.isoformat() for d in DATES)
        for a, b in SPANS
    }
    assert got == want


def odd_dates(seed):
    """Days, texts around days, texts cut short, and texts that are no dates at all."""
    rng = random.Random(seed)
    out = [None, "", " ", "-", "~", "9", "99", "199", "19999", "0000-05-05", "0001-01-01", "0000", "000x", "é", "9999-12-31", "9999-12-31x"]
    for _ in range(150):
        day = date(2018, 1, 1) + timedelta(days=rng.randrange(1500))
        text = day.isoformat()
        lot = rng.random()
        if lot < 0.5:
            text = text[: rng.randint(0, 9)] + rng.choice(["", "x", "-", "0", "9", "/", ":", "é"])
        elif lot < 0.7:
            text += rng.choice(["T10:00", " ", "0", "-"])
        elif lot < 0.8:
            text = text[:5] + rng.choice(["00", "13", "19", "1x"]) + text[7:]
        elif lot < 0.9:
            text = text[:8] + rng.choice(["00", "32", "31", "3", "9"])
        out.append(text)
    return out


def wide_spans(seed):
    rng = random.Random(seed)
    spans = {(date(2000, 1, 1), date(2030, 12, 31)), (date(2019, 1, 1), date(2019, 12, 31)), (date(2020, 2, 1), date(2020, 2, 29)),
             (date(2018, 12, 31), date(2021, 1, 1)), (date(2021, 5, 5), date(2021, 5, 4)), (date(1, 1, 1), date(9999, 12, 31))}
    for _ in range(25):
        begin = date(2017, 6, 1) + timedelta(days=rng.randrange(1600))
        spans.add((begin, begin + timedelta(days=rng.choice([0, 1, 27, 31, 60, 400, 900]))))
    return sorted(spans)


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_of_any_width_compare_text(spark, seed):
    dates, spans = odd_dates(seed), wide_spans(seed)
    corpus = spark.createDataFrame([(n, d) for n, d in enumerate(dates)], "n int, date string")
    windows = spark.createDataFrame(spans, "date_from date, date_to date")
    inside = {(n, a, b) for n, d in enumerate(dates) for a, b in spans if d is not None and a.isoformat().rjust(10, "0") <= d <= b.isoformat()}
    joined = [(r.n, r.date_from, r.date_to) for r in W.range_window_join(corpus, windows).collect()]
    assert sorted(joined) == sorted(inside)
    counted = {(r.date_from, r.date_to): r.local_count for r in W.window_counts(corpus, windows).collect()}
    assert counted == {(a, b): sum((n, a, b) in inside for n in range(len(dates))) for a, b in spans}


def test_whole_months_are_joined_on_one_level(spark):
    corpus = spark.createDataFrame([("2020-01-05",), ("2020-02-29",)], "date string")
    windows = spark.createDataFrame([(date(2020, 1, 1), date(2020, 1, 31)), (date(2020, 2, 1), date(2020, 2, 29))], "date_from date, date_to date")
    pieces = W._pieces(windows).collect()
    assert sorted((r["_level"], r["_piece"]) for r in pieces) == [(7, "2020-01"), (7, "2020-02")]
    decade = spark.createDataFrame([(date(2010, 1, 1), date(2019, 12, 31))], "date_from date, date_to date")
    assert [r["_level"] for r in W._pieces(decade).collect()] == [4] * 10
    assert W.range_window_join(corpus, windows).count() == 2 and W.range_window_join(corpus, windows.limit(0)).count() == 0


def test_floor_days(spark):
    dates = [d for d in odd_dates(3) if d is not None]
    days = [(date(1999, 1, 1) + timedelta(days=n)).isoformat() for n in range(9000)]
    got = spark.createDataFrame([(d,) for d in dates], "date string").select("date", floor_day(F.col("date")).alias("day")).collect()
    for row in got:
        want = max((d for d in days if d <= row.date), default=None)
        if want is not None and want != days[-1]:
            assert row.day == want, row.date
        elif want is None:
            assert row.day is None or row.day < days[0]
