from __future__ import annotations

import json

import pytest
from payloads import FEBRUARY, JANUARY, MARCH, page, pages, summary
from pyspark.sql import functions as F

from folioforge.schema import SearchSpec
from folioforge.sources import landed as L


def status(spark, *rows, search=SearchSpec()):
    facts = L.page_facts(L.parse_pages(pages(spark, *rows)))
    return {(r.date_from, r.date_to): (r.status, r.items) for r in L.page_completeness(facts, search).collect()}


A, B, C = (summary(f"IP/20/{n}") for n in (1, 2, 3))


def test_items_keep_their_order_and_non_objects_are_skipped(spark):
    landed = pages(spark, page(JANUARY, ["junk", A, None, 7, B]), page(JANUARY, [C], number=2))
    got = L.ingest_search_pages(landed).orderBy("page_no", "pos").select("ref_code", "requested_id").collect()
    assert [tuple(r) for r in got] == [("IP/20/1", "ip_20_1"), ("IP/20/2", "ip_20_2"), ("IP/20/3", "ip_20_3")]


@pytest.mark.parametrize(
    ("rows", "want"),
    [
        # read to the reported total
        ([dict(items=[A, B])], "complete"),
        ([dict(items=[A], total=2), dict(items=[B], total=2, number=2)], "complete"),
        # a total that grows while reading
        ([dict(items=[A], total=2), dict(items=[B], total=3, number=2), dict(items=[C], total=3, number=3)], "complete"),
        # an empty page ends it, whatever the total says
        ([dict(items=[A], total=5), dict(items=[], total=5, number=2)], "complete"),
        ([dict(items=[], total="many")], "complete"),
        # a missing total reads as zero and ends it at once
        ([dict(items=[A], total="absent"), dict(items=[B], number=2, status=500)], "complete"),
        ([dict(items=[A], total="1")], "complete"),
        # failures before the end
        ([dict(items=[A], total=2), dict(items=[B], total=2, number=2, status=502)], "failed"),
        ([dict(items=[A], total=2)], "failed"),
        ([dict(items=[A], total=3), dict(items=[B], total=2, number=3)], "failed"),
        ([dict(items=[A], total="many")], "failed"),
        ([dict(items=[], body="not json")], "failed"),
        ([dict(items=[], body="[]")], "failed"),
        ([dict(items=[], body='{"docuLanguageListResources": {}}')], "failed"),
        ([dict(items=[A], status=None)], "failed"),
    ],
)
def test_completeness(spark, rows, want):
    landed = [page(JANUARY, r.pop("items"), **r) for r in [dict(row) for row in rows]]
    assert status(spark, *landed)[JANUARY][0] == want


def test_every_variant_has_to_be_complete(spark):
    got = status(
        spark,
        page(JANUARY, [A]),
        page(JANUARY, [B], variant=1, status=500),
        page(FEBRUARY, [A]),
        page(FEBRUARY, [B], variant=1),
        page(MARCH, [A]),
        page(MARCH, [B], variant=4),
        search=SearchSpec(policy_areas=("x", "y")),
    )
    assert got[JANUARY][0] == "failed" and got[MARCH][0] == "failed"
    assert got[FEBRUARY] == ("complete", 2)


def test_blank_references_are_noticed_only_where_read(spark):
    landed = pages(
        spark,
        page(JANUARY, [A, summary("  ")]),
        page(FEBRUARY, [A], total=1),
        page(FEBRUARY, [summary("")], number=2),
    )
    ends = L.search_ends(L.page_facts(L.parse_pages(landed)))
    got = {(r.date_from, r.date_to): r.blank_reference for r in ends.collect()}
    assert got == {JANUARY: True, FEBRUARY: False}


@pytest.mark.parametrize(
    ("total", "want"),
    [(7, 7), ("12", 12), (None, 1), ("absent", 0), ("many", None), ("1.5", None), (3.9, 3), ([1], None)],
)
def test_counts(spark, total, want):
    landed = pages(spark, page(JANUARY, [A], total=total)).drop("variant_no", "page_no")
    assert L.ingest_counts(landed).first().api_count == want


def test_an_explicit_null_total_is_invalid(spark):
    body = json.dumps({"docuLanguageListResources": [A], "totalNumber": None})
    landed = pages(spark, page(JANUARY, [], body=body))
    assert L.ingest_counts(landed.drop("variant_no", "page_no")).first().api_count is None


def test_a_failed_count_is_no_count(spark):
    landed = pages(spark, page(JANUARY, [A], status=503)).drop("variant_no", "page_no")
    assert L.ingest_counts(landed).first().api_count is None


@pytest.mark.parametrize(
    ("code", "body", "want"),
    [
        (200, "not JSON", "transient"),
        (200, " \n\t", "permanently_empty"),
        (200, None, "permanently_empty"),
        (200, '{"refCd": "x"}', "ok"),
        (204, "", "permanently_empty"),
        (503, '{"refCd": "x"}', "transient"),
        (404, "", "transient"),
        (None, "", "transient"),
        (200, "{}", "transient"),
        (200, " { \n} ", "transient"),
        (200, "[]", "transient"),
        (200, '["x"]', "transient"),
        (200, '"text"', "transient"),
        (200, "null", "transient"),
        (200, '{"a": 1', "transient"),
    ],
)
def test_detail_outcomes(spark, code, body, want):
    row = spark.createDataFrame([(code, body)], "http_status int, body string")
    got = row.select(L.classify_detail(F.col("http_status"), F.col("body")).alias("o")).first().o
    read = L.read_details(row).first()
    assert (got, read.outcome, read.detail is not None) == (want, want, want == "ok")
