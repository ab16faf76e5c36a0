from __future__ import annotations

from datetime import date

import pytest
from payloads import FEBRUARY, JANUARY, MARCH, SITE, details, page, pages, summary, window_rows

from folioforge.operators import audit as A
from folioforge.operators.records import normalize_schema
from folioforge.plans.repair import audit_repair
from folioforge.schema import SearchSpec


def counts(spark, **api):
    names = {"january": JANUARY, "february": FEBRUARY, "march": MARCH}
    rows = [(*names[name], count) for name, count in api.items()]
    return spark.createDataFrame(rows, "date_from date, date_to date, api_count bigint")


def corpus(spark, rows):
    return normalize_schema(spark.createDataFrame(rows, "document_id string, date string"))


def test_statuses(spark):
    stored = corpus(spark, [("a", "2020-03-02"), ("b", "2020-02-02"), ("c", "2020-02-03"), ("d", "2020-01-02")])
    windows = window_rows(spark, MARCH, FEBRUARY, JANUARY)
    audit = A.reconcile_windows(windows, counts(spark, march=2, february=1, january=1), stored)
    got = [(r.status, r.difference) for r in audit.orderBy("position").collect()]
    assert got == [("deficient", 1), ("surplus", -1), ("match", 0)]
    assert {r.status for r in A.mismatches(audit).collect()} == {"deficient", "surplus"}
    assert A.audit_summary(audit).first().asDict() == {
        "windows": 3, "deficient": 1, "surplus": 1, "reconciled": 0, "unknown": 0, "matched": 1,
    }


def test_a_window_without_count_is_unknown_and_empty_ones_count_zero(spark):
    windows = window_rows(spark, FEBRUARY, JANUARY)
    audit = A.reconcile_windows(windows, counts(spark, january=0), corpus(spark, [("a", None)]))
    assert [(r.status, r.local_count) for r in audit.orderBy("position").collect()] == [("unknown", 0), ("match", 0)]


@pytest.mark.parametrize(
    ("second", "status", "phantoms"),
    [
        ([summary("IP/20/1")], "reconciled", 1),
        ([], "reconciled", 1),
        ([summary("IP/20/1"), summary("IP/20/2")], "deficient", 0),
        ([summary("IP/20/1"), summary(" ")], "deficient", 0),
        (None, "deficient", 0),
    ],
)
def test_only_unretrievable_entries_are_reconciled(spark, second, status, phantoms):
    stored = corpus(spark, [("ip_20_1", "2020-01-15")])
    api = counts(spark, january=2)
    audit = A.reconcile_windows(window_rows(spark, JANUARY), api, stored)
    landed = pages(spark, page(JANUARY, [summary("IP/20/1")]))
    verification = page(JANUARY, [], status=500) if second is None else page(JANUARY, second)
    repair = audit_repair(
        stored, audit, landed, details(spark, {}), api, pages(spark, verification), SITE, SearchSpec(), scraped_at="fixed"
    )
    row = repair.windows.first()
    assert (row.status, row.phantom_count, row.after_local) == (status, phantoms, 1)


def test_repair_adds_to_deficient_windows_only_and_deletes_nothing(spark):
    stored = corpus(spark, [("ip_20_1", "2020-01-15"), ("x1", "2020-02-01"), ("x2", "2020-02-02")])
    api = counts(spark, january=2, february=1)
    audit = A.reconcile_windows(window_rows(spark, FEBRUARY, JANUARY), api, stored)
    landed = pages(
        spark,
        page(JANUARY, [summary("IP/20/1"), summary("IP/20/2")]),
        page(FEBRUARY, [summary("IP/20/7", "2020-02-05")]),
    )
    repair = audit_repair(stored, audit, landed, details(spark, {}), api, landed, SITE, SearchSpec(), scraped_at="fixed")
    rows = repair.windows.collect()
    assert [(r.date_from, r.before_local, r.after_local, r.status) for r in rows] == [(date(2020, 1, 1), 1, 2, "match")]
    assert sorted(r.document_id for r in repair.corpus.collect()) == ["ip_20_1", "ip_20_2", "x1", "x2"]


def test_a_failed_repair_stays_deficient(spark):
    stored = corpus(spark, [("ip_20_1", "2020-01-15")])
    api = counts(spark, january=2)
    audit = A.reconcile_windows(window_rows(spark, JANUARY), api, stored)
    landed = pages(spark, page(JANUARY, [], status=500))
    fine = pages(spark, page(JANUARY, [summary("IP/20/1")]))
    repair = audit_repair(stored, audit, landed, details(spark, {}), api, fine, SITE, SearchSpec(), scraped_at="fixed")
    assert repair.windows.first().status == "deficient"
    assert [(r.date_from, r.date_to) for r in repair.run.window_ledger.collect()] == [JANUARY]


def test_pending_windows_stay_in_the_ledger_during_a_repair(spark):
    stored = corpus(spark, [("ip_20_1", "2020-01-15")])
    api = counts(spark, january=2)
    audit = A.reconcile_windows(window_rows(spark, JANUARY), api, stored)
    landed = pages(spark, page(JANUARY, [summary("IP/20/1"), summary("IP/20/2")]), page(MARCH, [summary("IP/20/3")]))
    repair = audit_repair(
        stored, audit, landed, details(spark, {}), api, landed, SITE, SearchSpec(),
        pending=window_rows(spark, MARCH), scraped_at="fixed",
    )
    assert [(r.date_from, r.date_to) for r in repair.run.window_ledger.collect()] == [MARCH]
    assert sorted(r.document_id for r in repair.corpus.collect()) == ["ip_20_1", "ip_20_2"]


def test_a_window_is_not_reconciled_before_all_search_values_were_read(spark):
    """The second value's pages never landed: nothing is known about what the count includes."""
    stored = corpus(spark, [("ip_20_1", "2020-01-15")])
    api, search = counts(spark, january=2), SearchSpec(keywords=("port", "quay"))
    audit = A.reconcile_windows(window_rows(spark, JANUARY), api, stored)
    half = pages(spark, page(JANUARY, [summary("IP/20/1")]))
    whole = pages(spark, page(JANUARY, [summary("IP/20/1")]), page(JANUARY, [], variant=1))
    for landed, verification, status, left in (
        (half, half, "deficient", 1), (whole, half, "deficient", 0), (half, whole, "deficient", 1), (whole, whole, "reconciled", 0),
    ):
        repair = audit_repair(stored, audit, landed, details(spark, {}), api, verification, SITE, search, scraped_at="fixed")
        row = repair.windows.first()
        assert (row.status, row.phantom_count) == (status, int(status == "reconciled"))
        assert repair.run.window_ledger.count() == left
