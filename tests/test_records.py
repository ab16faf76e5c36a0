from __future__ import annotations

import json

import pytest
from payloads import SITE, detail, details, summary
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.operators.records import flatten_record, migrate_legacy, normalize_schema, rebuild_retry_summary
from folioforge.plans.update import attach_detail
from folioforge.schema import CORPUS_COLUMNS, CORPUS_SCHEMA
from folioforge.sources.landed import ingest_search_pages

from payloads import JANUARY, page, pages, ref_ledger


def listed(spark, *summaries):
    return ingest_search_pages(pages(spark, page(JANUARY, list(summaries))))


def record(spark, entry, bodies, keep_html=False):
    attached = attach_detail(listed(spark, entry), details(spark, bodies), keep_html=keep_html)
    return flatten_record(attached, SITE, scraped_at="fixed").first()


def test_full_record(spark):
    row = record(
        spark, summary("SPEECH/19/88", "2019-05-06"), {"SPEECH/19/88": detail("SPEECH/19/88", "2019-05-06")}, keep_html=True
    )
    assert row.asDict() == {
        "document_id": "speech_19_88",
        "reference": "SPEECH/19/88",
        "doc_type": "IP",
        "doc_type_name": "Press release",
        "title": "Harbour widened",
        "subtitle": "Work ends in autumn",
        "summary": "What is planned for the quay",
        "date": "2019-05-06",
        "publish_datetime": "2019-05-06T07:08:09Z",
        "place": "Ostend",
        "language": "en",
        "original_language": "en",
        "commissioners": "Member for ports",
        "spokespersons": "Olu Quay; Mira Dock (Harbour office)",
        "policy_areas": "Seas, rivers and canals; Work; Towns",
        "policy_codes": "SEA; JOBS; TOWN",
        "full_text": "Three cranes\narrived\nfrom the north",
        "html": "<p>Three cranes <i>arrived</i></p><ul><li>from the north</li></ul>",
        "url": "https://archive.example/detail/en/speech_19_88",
        "pdf_url": "https://archive.example/api/files/document/print/en/speech_19_88/SPEECH_19_88_EN.pdf",
        "detail_ok": True,
        "scraped_at": "fixed",
    }


def test_missing_sections_become_null(spark):
    body = json.dumps({"refCd": "SPEECH/19/88", "docuLanguageResource": {"title": "Only a title"}})
    row = record(spark, summary("SPEECH/19/88"), {"SPEECH/19/88": body})
    for name in ("subtitle", "commissioners", "spokespersons", "policy_areas", "policy_codes", "place", "html"):
        assert row[name] is None
    assert (row.title, row.full_text, row.detail_ok) == ("Only a title", "", True)
    assert (row.date, row.doc_type) == ("2020-01-10", "IP")


def test_no_detail_gives_a_partial_record(spark):
    row = record(spark, summary("SPEECH/19/88"), {})
    assert (row.title, row.summary, row.full_text, row.detail_ok) == ("Harbour plans", "What is planned for the quay", "", False)


def test_sections_of_the_wrong_kind_read_as_absent(spark):
    body = detail(
        "IP/1", docutypeResource=[1], placeResource="x", contactsResource={"firstName": "A"},
        commissionerResource=[None, 3, {"shortDescription": " C "}], policiesResource=["x", {"code": "P"}],
        docuLanguageResource=7,
    )
    row = record(spark, summary("IP/1"), {"IP/1": body})
    assert (row.doc_type, row.place, row.spokespersons, row.commissioners) == ("IP", None, None, "C")
    assert (row.policy_areas, row.policy_codes, row.title, row.full_text) == (None, "P", "Harbour plans", "")


def test_html_is_dropped_unless_asked_for(spark):
    assert record(spark, summary("IP/1"), {"IP/1": detail("IP/1")}).html is None


def test_a_stamp_is_made_up_when_none_is_given(spark):
    attached = attach_detail(listed(spark, summary("IP/1")), details(spark, {}))
    assert flatten_record(attached, SITE).first().scraped_at.endswith("+00:00")


def test_normalize_adds_drops_orders_and_casts(spark):
    loose = spark.createDataFrame([("yes", 5, "x")], "detail_ok string, title int, extra string")
    tidy = normalize_schema(loose)
    assert tidy.schema == CORPUS_SCHEMA
    assert (tidy.first().detail_ok, tidy.first().title) == (True, "5")


@pytest.mark.parametrize(
    ("value", "want"),
    [("TRUE", True), (" yes ", True), ("1", True), ("0", False), ("No", False), ("false", False),
     ("1.0", None), ("", None), (None, None)],
)
def test_booleans(spark, value, want):
    got = spark.range(1).select(X.coerce_boolean(F.lit(value).cast("string"))).first()[0]
    assert got is want


def test_migration(spark):
    legacy = spark.createDataFrame(
        [
            ("ip_20_1", "IP/20/1", "IP", "2020-01-02", "Legacy body", "Lee Wharf", "", "newer"),
            ("speech_20_2", "SPEECH/20/2", "SPEECH", "2020-01-01", "", "Ben Sample", "unused", None),
        ],
        "document_id string, reference_number string, document_type string, publication_date string, "
        "full_text string, authors string, keywords string, doc_type string",
    )
    first, second = normalize_schema(migrate_legacy(legacy)).orderBy("document_id").collect()
    assert list(first.asDict()) == list(CORPUS_COLUMNS)
    assert (first.reference, first.spokespersons, first.detail_ok) == ("IP/20/1", "Lee Wharf", True)
    assert (first.doc_type, second.doc_type, second.detail_ok) == ("newer", "SPEECH", False)
    assert "keywords" not in migrate_legacy(legacy).columns


def test_migration_without_text_and_of_current_layout(spark):
    bare = migrate_legacy(spark.createDataFrame([("a", "")], "document_id string, keywords string"))
    assert bare.first().detail_ok is False
    current = spark.createDataFrame([("a", None)], "document_id string, detail_ok boolean")
    assert migrate_legacy(current) is current


def test_retry_summary_fills_absent_keys_only(spark):
    ledger = ref_ledger(spark, {"IP/1": {"title": None, "docutype": {"code": "X"}}, "IP/2": "[]"})
    stored = normalize_schema(
        spark.createDataFrame(
            [("ip_1", "Row", "2020-01-01", "fr", "IP", "Name", "Lead")],
            "document_id string, title string, date string, language string, doc_type string, "
            "doc_type_name string, summary string",
        )
    )
    one, two = rebuild_retry_summary(ledger, stored).orderBy("reference").collect()
    assert (one.title, one.type_code, one.type_name) == (None, "X", None)
    assert (one.event_date, one.language_code, one.lead_text, one.ref_code) == ("2020-01-01", "fr", "Lead", "IP/1")
    assert (two.ref_code, two.title, two.language_code) == ("IP/2", None, None)
