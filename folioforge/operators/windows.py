"""Calendar windows: generation, row counts and membership."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.dates import filled, floor_day, iso, to_date
from folioforge.schema import ARCHIVE_START, OVERLAP_DAYS
from folioforge.session import stage

_UNIT = {"month": ("MM", "interval 1 month"), "year": ("YEAR", "interval 1 year")}


def bounds(spark: SparkSession, since: date, until: date) -> DataFrame:
    return spark.range(1).select(F.lit(since).alias("since"), F.lit(until).alias("until"))


def calendar_windows(limits: DataFrame, granularity: str) -> DataFrame:
    """``(position, date_from, date_to)`` for each row of ``(since, until)``.

    Windows are inclusive calendar units clipped to the limits; position 0 is the newest.
    Inverted limits are an error.
    """
    if granularity not in _UNIT:
        raise ValueError("granularity must be 'month' or 'year'")
    unit, step = _UNIT[granularity]
    since, until = F.col("since"), F.col("until")
    complaint = F.concat(
        F.lit("since "), since.cast("string"), F.lit(" is after until "), until.cast("string")
    )
    checked = limits.select(
        F.when(since > until, F.raise_error(complaint).cast("date")).otherwise(since).alias("since"),
        "until",
    )
    units = checked.select(
        "*",
        F.posexplode(
            F.reverse(F.sequence(F.trunc(since, unit), F.trunc(until, unit), F.expr(step)))
        ).alias("position", "unit_start"),
    )
    start = F.col("unit_start")
    end = F.last_day(start) if granularity == "month" else F.make_date(F.year(start), F.lit(12), F.lit(31))
    return units.select(
        F.col("position").cast("bigint").alias("position"),
        F.greatest(start, since).alias("date_from"),
        F.least(end, until).alias("date_to"),
    )


def month_windows(limits: DataFrame) -> DataFrame:
    return calendar_windows(limits, "month")


def year_windows(limits: DataFrame) -> DataFrame:
    return calendar_windows(limits, "year")


def _required(value: Column, message: str) -> Column:
    return F.when(value.isNull(), F.raise_error(F.lit(message)).cast("date")).otherwise(value)


def overlap_range(
    corpus: DataFrame,
    until: date,
    since: date | None = None,
    full: bool = False,
    overlap_days: int = OVERLAP_DAYS,
) -> DataFrame:
    """Range of a top-up: from a few days before the newest stored date up to ``until``."""
    if since is not None or full:
        return bounds(corpus.sparkSession, since or ARCHIVE_START, until)
    newest = corpus.where(filled(F.col("date"))).agg(F.max("date").alias("cutoff"))
    start = F.date_sub(to_date(F.col("cutoff")), overlap_days)
    return newest.select(
        _required(start, "the corpus has no cutoff date: give since, or ask for a full range").alias("since"),
        F.lit(until).alias("until"),
    )


def audit_windows(
    corpus: DataFrame, until: date, since: date | None = None, granularity: str = "month"
) -> DataFrame:
    """Windows of an audit, by default from the oldest stored date up to ``until``."""
    if since is not None:
        limits = bounds(corpus.sparkSession, since, until)
    else:
        oldest = corpus.where(filled(F.col("date"))).agg(F.min("date").alias("oldest"))
        limits = oldest.select(
            _required(to_date(F.col("oldest")), "an empty corpus has no audit range").alias("since"),
            F.lit(until).alias("until"),
        )
    return calendar_windows(limits, granularity)


def day_counts(corpus: DataFrame) -> DataFrame:
    """``(day, beyond, n)``: rows by the floor day of their date text, and whether the text is after it.

    At most two rows per calendar day come out, whatever the texts are; the map side counts.
    """
    text = F.col("date")
    placed = corpus.where(text.isNotNull()).select(floor_day(text).alias("day"), text)
    return (
        placed.where("day is not null")
        .groupBy(to_date(F.col("day")).alias("day"), (F.col("date") != F.col("day")).alias("beyond"))
        .agg(F.count("*").alias("n"))
    )


def counts_of_days(days: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` with ``local_count``, from rows per day.

    Sums up to a day answer every window by three look-ups, at its last day, the day before
    that and the day before its first one; it may be of any width. The sums are kept per year:
    what came before it, and its days' counts, so a look-up is an equi-join by year.
    """
    span = windows.select("date_from", "date_to").distinct().where(F.col("date_from") <= F.col("date_to"))
    before_first, last = F.date_sub("date_from", 1), F.col("date_to")
    point = lambda at, exact, later: F.struct(at.alias("at"), F.lit(exact).alias("exact"), F.lit(later).alias("later"))
    # Texts that are days count up to the last day, texts beyond a day only up to the day before.
    points = span.select("*", F.inline(F.array(point(last, 1, 0), point(F.date_sub(last, 1), 0, 1), point(before_first, -1, -1))))
    points = points.withColumn("year", F.year("at"))
    listed = days.select(F.year("day").alias("year"), F.dayofyear("day").alias("doy"), F.when(~F.col("beyond"), F.col("n")).otherwise(0).alias("e"),
                         F.when(F.col("beyond"), F.col("n")).otherwise(0).alias("b"))
    by_year = listed.groupBy("year").agg(F.sum("e").alias("e"), F.sum("b").alias("b"), F.collect_list(F.struct("doy", "e", "b")).alias("days"))
    asked = points.select("year", F.lit(0).cast("bigint").alias("e"), F.lit(0).cast("bigint").alias("b"), F.lit(None).alias("days")).distinct()
    years = by_year.unionByName(asked).groupBy("year").agg(F.sum("e").alias("e"), F.sum("b").alias("b"), F.any_value("days", True).alias("days"))
    earlier = W.orderBy("year").rowsBetween(W.unboundedPreceding, -1)  # one row per year
    sums = years.select("year", "days", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in "eb"))

    def reached(column: str) -> Column:
        return F.col(f"{column}_before") + F.aggregate(
            F.coalesce(F.filter("days", lambda d: d["doy"] <= F.dayofyear("at")), F.array()), F.lit(0).cast("bigint"), lambda total, d: total + d[column])

    counts = (
        points.join(sums, "year")
        .groupBy("date_from", "date_to")
        .agg(F.sum(F.col("exact") * reached("e") + F.col("later") * reached("b")).alias("local_count"))
    )
    return windows.join(counts, ["date_from", "date_to"], "left").withColumn(
        "local_count", F.coalesce("local_count", F.lit(0).cast("bigint"))
    )


def window_counts(corpus: DataFrame, windows: DataFrame) -> DataFrame:
    """``windows`` with ``local_count``; one pass over the corpus for any number and width of windows.

    The corpus is first reduced to counts per day. The result equals the comparison of texts
    also for malformed dates.
    """
    return counts_of_days(day_counts(corpus), windows)


_LEVELS = (("year", 4), ("month", 7), ("day", 10))


def _pieces(windows: DataFrame) -> DataFrame:
    """Each window as whole years, the whole months beside them, and the days beside those.

    ``_level`` is the number of characters that all ISO texts of the piece share, ``_piece`` are these.
    """
    first, last = F.col("date_from"), F.col("date_to")
    inside = lambda low, high, step, length: F.when(
        low <= high, F.transform(F.sequence(low, high, F.expr(step)), lambda d: F.substring(iso(d), 1, length))
    ).otherwise(F.array().cast("array<string>"))
    day, month, year = "interval 1 day", "interval 1 month", "interval 1 year"
    up = lambda d, unit, step: F.when(F.trunc(d, unit) == d, d).otherwise((F.trunc(d, unit) + F.expr(step)).cast("date"))
    after = F.date_add(last, 1)
    bounded = windows.select(
        "date_from", "date_to", up(first, "MM", month).alias("m0"), F.trunc(after, "MM").alias("m1"),
        up(first, "YEAR", year).alias("y0"), F.trunc(after, "YEAR").alias("y1"),
    ).where(first <= last)
    whole_months, whole_years = F.col("m0") < F.col("m1"), F.col("y0") < F.col("y1")
    no_text = F.array().cast("array<string>")
    back = lambda c: F.date_sub(c, 1)
    days = F.when(whole_months, F.concat(inside(first, back("m0"), day, 10), inside(F.col("m1"), last, day, 10))).otherwise(inside(first, last, day, 10))
    months = F.when(whole_months & whole_years, F.concat(inside(F.col("m0"), back("y0"), month, 7), inside(F.col("y1"), back("m1"), month, 7))
                    ).when(whole_months, inside(F.col("m0"), back("m1"), month, 7)).otherwise(no_text)
    years = F.when(whole_years, inside(F.col("y0"), back("y1"), year, 4)).otherwise(no_text)
    leveled = [F.struct(F.lit(length).alias("_level"), texts.alias("texts")) for (_, length), texts in zip(_LEVELS, (years, months, days), strict=True)]
    return (
        bounded.select("date_from", "date_to", F.inline(F.array(*leveled)))
        .select("date_from", "date_to", "_level", F.explode("texts").alias("_piece"))
    )


def range_window_join(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Each row with every window its date text lies in; windows may have any width.

    Windows are cut into whole years, months and days; the join is an equi-join of these with the
    beginning of each row's floor day. A row meets a window once at most, so the one condition left
    is that a text after its floor day isn't in a window that ends on it. Rows are repeated only for
    the levels that occur: windows of whole months need one.
    """
    distinct = windows.select("date_from", "date_to").distinct()
    pieces = stage(_pieces(distinct), "pieces")
    levels = sorted(r["_level"] for r in pieces.select("_level").distinct().collect())  # three at most
    keys = [F.struct(F.lit(n).alias("_level"), F.substring("_day", 1, n).alias("_piece")) for n in levels or (0,)]
    keyed = rows.withColumn("_day", floor_day(F.col("date"))).select("*", F.inline(F.array(*keys)))
    joined = keyed.join(pieces, ["_level", "_piece"])
    return joined.where(F.col("date") <= iso(F.col("date_to"))).drop("_level", "_piece", "_day")
