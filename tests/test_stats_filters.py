from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from folioforge.operators import filters as FL
from folioforge.operators import stats as ST
from folioforge.operators.records import normalize_schema
from folioforge.schema import SearchSpec


def corpus(spark, *rows, columns="document_id string, doc_type string, date string"):
    return normalize_schema(spark.createDataFrame(list(rows), columns))


def test_an_empty_corpus(spark):
    empty = corpus(spark, ("a", "b", "c")).limit(0)
    assert ST.status_report(empty).first().asDict() == {
        "total_documents": 0, "first_date": None, "last_date": None, "detail_share": 0.0,
    }
    assert ST.overview(empty).first().documents == 0
    assert ST.type_distribution(empty).collect() == []


def test_empty_and_missing_dates_do_not_count(spark):
    rows = corpus(spark, ("a", "IP", ""), ("b", "IP", None), ("c", "IP", "2020-01-02"), ("d", "IP", "1999-01-01"))
    assert ST.cutoff(rows).first()[0] == "2020-01-02"
    assert tuple(ST.date_range(rows).first()) == ("1999-01-01", "2020-01-02")


def test_the_rest_is_summed_only_when_there_is_one(spark):
    rows = corpus(spark, *[(f"{t}{n}", t, "2020-01-01") for t, k in zip("abcd", (4, 3, 2, 1)) for n in range(k)], ("x", None, ""))
    assert [tuple(r) for r in ST.type_distribution(rows, top=3).collect()] == [("a", 4), ("b", 3), ("c", 2), ("…", 2)]
    five = [tuple(r) for r in ST.type_distribution(rows, top=5).collect()]
    assert ("(missing)", 1) in five and len(five) == 5


def test_modal_language_and_types(spark):
    rows = corpus(
        spark, ("1", "IP", "2020-01-01", "en"), ("2", "IP", "2019-01-01", "EN"), ("3", None, "", "fr"),
        ("4", "X", None, "fr"), ("5", "X", None, None), ("6", "X", None, None), ("7", "X", None, None),
        columns="document_id string, doc_type string, date string, language string",
    )
    got = ST.overview(rows).first()
    assert (got.documents, got.types, got.language) == (7, 2, "EN")
    assert (got.first_date, got.last_date) == (date(2019, 1, 1), date(2020, 1, 1))


def test_completeness_treats_empty_as_missing_and_blank_as_filled(spark):
    rows = corpus(
        spark, ("1", "1985-01-01", ""), ("2", "1986-01-01", " "), ("3", "1989-01-01", None), ("4", "1989-05-05", "x"),
        ("5", "1979-01-01", "x"), ("6", "", "x"),
        columns="document_id string, date string, subtitle string",
    )
    got = {(r.field, r.decade): r.share for r in ST.completeness_by_decade(rows).collect()}
    assert got[("Subtitle", 1980)] == 0.5 and {d for _, d in got} == {1980} and len(got) == 7
    wide = ST.completeness_table(rows, [1980, 1990]).where("field = 'Subtitle'").first()
    assert (wide["1980"], wide["1990"]) == (0.5, 0.0)


def test_years_and_sources(spark):
    rows = corpus(spark, ("a", "CJE", "2020-01-01"), ("b", None, "2020-05-01"), ("c", "IP", "bad"))
    got = {(r.year, r.source): r.n for r in ST.docs_per_year_source(rows).collect()}
    assert got == {
        (2020, "Other EU institutions (RAPID legacy)"): 1, (2020, "European Commission"): 1, (None, "European Commission"): 1,
    }


def test_unknown_types(spark):
    rows = corpus(spark, ("a", "xyz", ""), ("b", "XYZ", ""), ("c", "ip", ""), ("d", "TRANS", ""), ("e", None, ""))
    assert [r.doc_type for r in FL.unknown_types(rows).collect()] == ["TRANS", "XYZ"]


def test_window_filter_compares_text(spark):
    rows = corpus(spark, ("a", "IP", "2020-01-31"), ("b", "IP", "2020-01-31T10:00"), ("c", "IP", None))
    got = FL.filter_window(rows, date(2020, 1, 1), date(2020, 1, 31)).collect()
    assert [r.document_id for r in got] == ["a"]


@pytest.mark.parametrize(
    ("spec", "want"),
    [
        (SearchSpec(), "abcd"),
        (SearchSpec(keywords=("TRADE",)), "ab"),
        (SearchSpec(commissioners=("Ann",)), "c"),
        (SearchSpec(commissioners=("An",)), ""),
        (SearchSpec(policy_areas=("Energy",)), "d"),
        (SearchSpec(keywords=("trade",), commissioners=("Ann",), policy_areas=("Energy",)), "abcd"),
        (SearchSpec(keywords=("trade",), document_types=("ip",)), "a"),
        (SearchSpec(language="fr"), ""),
        (SearchSpec(language=None, start=date(2020, 1, 2)), "d"),
    ],
)
def test_descriptive_corpora(spark, spec, want):
    rows = corpus(
        spark,
        ("a", "IP", "2020-01-01", "A Trade deal", None, None, None),
        ("b", "MEMO", "2020-01-01", None, "on trade", None, None),
        ("c", "IP", "2020-01-01", None, None, "Bob; Ann", None),
        ("d", "IP", "2020-01-05", None, None, "Annette", "Energy; Climate"),
        columns="document_id string, doc_type string, date string, title string, full_text string, "
        "commissioners string, policy_areas string",
    ).withColumn("language", F.lit("en"))
    got = FL.build_descriptive(rows, spec, until=date(2020, 12, 31))
    assert "".join(sorted(r.document_id for r in got.collect())) == want
