from __future__ import annotations

from datetime import date

import pytest
from payloads import FEBRUARY, JANUARY, SITE, detail, details, page, pages, summary

from folioforge.plans import dataset as D
from folioforge.sources.corpus import scan_snapshot
from folioforge.sources.sinks import read_metadata

END = date(2020, 2, 29)


def update(spark, root, landed, answers, **options):
    got = D.update_dataset(
        spark, root, pages(spark, *landed), details(spark, answers), SITE, END,
        since=date(2020, 1, 1), **options,
    )
    return got.first()


def ids(spark, root):
    return sorted(r.document_id for r in scan_snapshot(spark, D.corpus_root(root)).collect())


def test_an_update_stores_corpus_ledgers_and_metadata(spark, tmp_path):
    root = str(tmp_path / "data")
    february = page(FEBRUARY, [summary("IP/20/2", "2020-02-10")])
    with pytest.raises(ValueError):
        update(spark, root, [february], {})
    first = update(
        spark, root, [february, page(JANUARY, [], status=502)], {"IP/20/2": (503, "")},
        full=True, scope="active", scraped_at="2020-03-01T00:00:00Z",
    )
    assert (first.new_documents, first.pending_windows, first.pending_refs) == (1, 1, 1)
    assert [(r.date_from, r.date_to) for r in D.pending_windows(spark, root).collect()] == [JANUARY]
    assert [r.reference for r in D.pending_refs(spark, root).collect()] == ["IP/20/2"]
    told = read_metadata(spark, f"{root}/metadata").first()
    assert (told.scope, told.total_documents, told.failed_window_count, told.failed_ref_count) == ("active", 1, 1, 1)

    second = update(
        spark, root, [february, page(JANUARY, [summary("IP/20/1")])],
        {"IP/20/1": detail("IP/20/1"), "IP/20/2": detail("IP/20/2", "2020-02-10")},
        scraped_at="2020-03-02T00:00:00Z",
    )
    assert (second.new_documents, second.recovered_details, second.partial) == (1, 1, False)
    assert ids(spark, root) == ["ip_20_1", "ip_20_2"]
    assert D.pending_windows(spark, root).isEmpty() and D.pending_refs(spark, root).isEmpty()
    told = read_metadata(spark, f"{root}/metadata").first()
    assert (told.scope, told.total_documents, told.failed_window_count, told.failed_ref_count) == ("active", 2, 0, 0)


def test_an_active_dataset_stores_active_types_only(spark, tmp_path):
    root = str(tmp_path / "data")
    old = {"docutype": {"code": "MEMO", "description": "Memo"}}
    landed = [page(FEBRUARY, []), page(JANUARY, [summary("IP/20/1"), summary("MEMO/20/2", **old)])]
    got = update(spark, root, landed, {}, full=True, scope="active")
    assert (got.new_documents, got.pending_refs, got.pending_windows) == (1, 1, 0) and ids(spark, root) == ["ip_20_1"]
    assert read_metadata(spark, f"{root}/metadata").first().per_type_counts == {"IP": 1}
    everything = str(tmp_path / "all")
    assert update(spark, everything, landed, {}, full=True, scope="all").new_documents == 2


@pytest.mark.parametrize(("step", "before"), [("save_run", 0), ("write_failed_windows", 0), ("write_metadata", 1)])
def test_an_update_that_was_cut_off_is_repeated_in_full(spark, tmp_path, monkeypatch, step, before):
    root = str(tmp_path / "data")
    landed = [page(FEBRUARY, []), page(JANUARY, [summary("IP/20/1"), summary("IP/20/3")])]
    calls, real = [], getattr(D, step)

    def lost(*args):
        if len(calls) == before:
            raise RuntimeError("lost")
        calls.append(args)
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(D, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            update(spark, root, landed, {"IP/20/3": detail("IP/20/3")}, full=True)
    with pytest.raises(ValueError):
        update(spark, root, landed, {}, full=True, scope="all")
    again = update(spark, root, landed, {"IP/20/1": detail("IP/20/1"), "IP/20/3": detail("IP/20/3")})
    assert not again.partial and ids(spark, root) == ["ip_20_1", "ip_20_3"]
    assert scan_snapshot(spark, D.corpus_root(root)).where("detail_ok").count() == 2
    assert read_metadata(spark, f"{root}/metadata").first().scope == "active"
