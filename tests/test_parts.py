"""Corpora stored in parts: replacement without rewriting, counts per day, compaction."""

from __future__ import annotations

import random
from datetime import date
from pathlib import Path

import pytest
from payloads import FEBRUARY, JANUARY, SITE, detail, details, page, pages, summary, window_rows
from pyspark.sql import functions as F

from folioforge.operators.records import normalize_schema
from folioforge.operators.windows import day_counts
from folioforge.plans import dataset as D
from folioforge.schema import SearchSpec
from folioforge.sources import parts as P
from folioforge.sources import sinks as K
from folioforge.sources.corpus import scan_snapshot, scan_snapshot_window


def rows(spark, *data):
    return normalize_schema(spark.createDataFrame(list(data), "document_id string, date string, title string"))


def files(root):
    return {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def stored(spark, root):
    return sorted((r.document_id, r.title) for r in scan_snapshot(spark, root).collect())


def days_of(df):
    return sorted((r.day, r.beyond, r.n) for r in df.collect())


def test_replacing_a_row_touches_no_stored_file(spark, tmp_path):
    root = str(tmp_path / "corpus")
    K.write_corpus(rows(spark, *[(f"d{n}", f"20{10 + n % 10}-03-0{1 + n % 9}", "old") for n in range(200)]), root)
    before = files(root)
    for step, title in enumerate(("new", "newer")):
        replaced = scan_snapshot(spark, root).where("document_id = 'd7'").select("document_id", "date")
        K.replace_rows(rows(spark, ("d7", "2021-01-01", title), (f"x{step}", "2021-01-02", "added")), replaced, root)
    after = files(root)
    assert {p: after[p] for p in before} == before and len(after) - len(before) < 20
    got = dict(stored(spark, root))
    assert len(got) == 202 and got["d7"] == "newer" and got["d8"] == "old" and got["x0"] == "added"
    assert days_of(P.stored_days(spark, root)) == days_of(day_counts(scan_snapshot(spark, root)))
    assert [r.document_id for r in scan_snapshot_window(spark, root, date(2021, 1, 1), date(2021, 1, 1)).collect()] == ["d7"]

    path = K.compact_corpus(spark, root)
    assert path.endswith("snapshot=2") and dict(stored(spark, root)) == got
    assert P.committed_parts(spark, path) == [0] and not P.exists(spark, f"{path}/replaced")
    assert days_of(P.stored_days(spark, root)) == days_of(day_counts(scan_snapshot(spark, root)))


def test_a_part_that_was_not_committed_is_invisible_and_written_over(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "corpus")
    K.write_corpus(rows(spark, ("a", "2020-01-01", "1"), (None, None, "no id")), root)
    replaced = scan_snapshot(spark, root).where("document_id = 'a'").select("document_id", "date")

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(P, "touch", lost)
        with pytest.raises(RuntimeError, match="lost"):
            K.replace_rows(rows(spark, ("a", "2020-01-01", "2")), replaced, root)
    assert ("a", "1") in scan_snapshot(spark, root).where("document_id is not null").select("document_id", "title").collect()
    K.replace_rows(rows(spark, ("a", "", "3")), replaced, root)
    assert sorted((r.document_id or "", r.title) for r in scan_snapshot(spark, root).collect()) == [("", "no id"), ("a", "3")]


def test_files_of_a_year_are_in_order_of_dates(spark, tmp_path):
    root, rng = str(tmp_path / "corpus"), random.Random(1)
    data = [(f"d{n}", None if n % 50 == 0 else f"202{n % 2}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", "x" * 50) for n in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = K.write_corpus(rows(spark, *data).repartition(7), root)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    several = 0
    for year in sorted(Path(path).glob("rows/part=0/pub_year=202*")):
        names = sorted(str(p) for p in year.glob("*.parquet"))
        several += len(names) > 1
        read = [r.date for name in names for r in spark.read.parquet(name).collect()]
        assert read == sorted(read, reverse=True)
    assert several


def test_a_snapshot_of_the_former_layout_is_read_and_continued(spark, tmp_path):
    root = str(tmp_path / "corpus")
    old = rows(spark, ("a", "2020-01-01", "1"), ("b", "2021-01-01", "1")).withColumn("pub_year", P.year_of(F.col("date")))
    old.write.partitionBy("pub_year").parquet(f"{root}/snapshot=3")
    assert stored(spark, root) == [("a", "1"), ("b", "1")]
    assert days_of(P.stored_days(spark, root)) == days_of(day_counts(old))
    K.append_corpus(rows(spark, ("c", "2022-01-01", "1")), root)
    assert stored(spark, root) == [("a", "1"), ("b", "1"), ("c", "1")]


def test_a_recount_reads_no_corpus_rows(spark, tmp_path):
    root = str(tmp_path / "data")
    landed = pages(spark, page(JANUARY, [summary("IP/20/1"), summary("IP/20/3")]), page(FEBRUARY, []))
    built = D.build_dataset(
        spark, root, SearchSpec(start=date(2020, 1, 1)), details(spark, {"IP/20/1": detail("IP/20/1")}), SITE,
        landed_pages=landed, until=date(2020, 2, 29), scraped_at="fixed", project_metadata={"name": "ports"},
    ).first()
    assert (built.new_documents, built.completed_windows, built.pending_refs) == (2, 2, 1)
    told = K.read_metadata(spark, f"{root}/metadata").first()
    assert (told.scope, told.metadata, told.failed_ref_count) == ("all", '{"name": "ports"}', 1) and told.config_hash and told.package_version
    windows, refs = K.metadata_ledgers(spark, f"{root}/metadata")
    assert windows.isEmpty() and [r.reference for r in refs.collect()] == ["IP/20/3"]

    remote = spark.createDataFrame([(*JANUARY, 3), (*FEBRUARY, 0)], "date_from date, date_to date, api_count bigint")
    audit = D.audit_dataset(spark, root, remote, date(2020, 1, 1), date(2020, 2, 29))
    assert {r.date_from: (r.status, r.local_count) for r in audit.collect()} == {JANUARY[0]: ("deficient", 2), FEBRUARY[0]: ("match", 0)}
    read = audit.inputFiles()
    assert read and all("/days/part=" in name for name in read)

    found = pages(spark, page(JANUARY, [summary(f"IP/20/{n}") for n in (1, 3, 4)]))
    answers = details(spark, {"IP/20/4": detail("IP/20/9")})  # its detail names it differently
    repaired = D.repair_dataset(spark, root, audit, found, answers, remote, found, SITE, scraped_at="fixed").collect()
    assert [(r.date_from, r.before_local, r.after_local, r.status) for r in repaired] == [(JANUARY[0], 2, 3, "match")]
    assert sorted(r.document_id for r in scan_snapshot(spark, D.corpus_root(root)).collect()) == ["ip_20_1", "ip_20_3", "ip_20_9"]
    assert [r.reference for r in D.pending_refs(spark, root).collect()] == ["IP/20/3"]


def test_a_corpus_of_listed_references_is_built_and_resumed(spark, tmp_path):
    root = str(tmp_path / "data")
    wanted = spark.createDataFrame([("IP/20/3", 0), (" ip/20/1", 1), ("IP/20/2", 2)], "reference string, position int")
    first = D.build_dataset(spark, root, wanted, details(spark, {"IP/20/3": (503, "")}), SITE, limit=2, scraped_at="fixed").first()
    assert (first.new_documents, first.pending_refs, first.limit_reached, first.partial) == (2, 2, True, True)
    assert sorted(r.document_id for r in scan_snapshot(spark, D.corpus_root(root)).collect()) == ["ip_20_1", "ip_20_3"]
    answers = {f"IP/20/{n}": detail(f"IP/20/{n}") for n in (1, 2, 3)}
    second = D.build_dataset(spark, root, wanted, details(spark, answers), SITE, limit=2, scraped_at="fixed").first()
    assert (second.new_documents, second.recovered_details, second.pending_refs, second.limit_reached) == (1, 2, 0, False)
    assert scan_snapshot(spark, D.corpus_root(root)).where("detail_ok").count() == 3
    third = D.build_dataset(spark, root, wanted, details(spark, {}), SITE, scraped_at="fixed").first()
    assert (third.new_documents, third.partial) == (0, False)
    with pytest.raises(ValueError):
        D.build_dataset(spark, root, wanted, details(spark, {}), SITE, limit=0)
    with pytest.raises(ValueError, match="landed pages"):
        D.build_dataset(spark, root, SearchSpec(), details(spark, {}), SITE)


def test_metadata_of_one_time_stamp_is_told_apart(spark, tmp_path):
    meta = f"{tmp_path}/meta"
    empty = window_rows(spark).withColumn("dataset", F.lit("d"))
    for n in range(1, 5):
        data = rows(spark, *[(f"d{k}", "2020-01-01", "x") for k in range(n)])
        K.write_metadata(K.metadata_row(data, empty, empty, last_run="2026-01-01"), meta)
        assert K.read_metadata(spark, meta).first().total_documents == n
