"""Streaming top-ups: whole datasets, stored keys in buckets, last rows from the state store."""

from __future__ import annotations

import random

import pytest
from payloads import FEBRUARY, JANUARY, MARCH, SITE, detail, details, page, pages, ref_ledger, summary, window_rows

from folioforge.plans import dataset as D
from folioforge.plans import update as U
from folioforge.schema import SearchSpec
from folioforge.sources.corpus import empty_corpus, scan_snapshot
from folioforge.sources.sinks import read_metadata
from folioforge.streaming import topup as T
from folioforge.streaming.feed import stream_dataset

LANDED = [
    page(JANUARY, [summary("IP/20/1"), summary("IP/20/2")], total=3),
    page(JANUARY, [summary("IP/20/3")], number=2, total=3),
    page(JANUARY, [summary("IP/20/1", title="again")], variant=1),
    page(FEBRUARY, [summary("IP/20/5", "2020-02-10")], total=2),
    page(FEBRUARY, [], variant=1),
    page(MARCH, [summary("IP/20/7", "2020-03-10"), summary("IP/20/8", "2020-03-11")]),
    page(MARCH, [], variant=1),
]
ANSWERS = {
    "IP/20/1": detail("IP/20/1"), "IP/20/2": "", "IP/20/3": (503, ""), "IP/20/5": detail("IP/20/5"),
    "IP/20/7": detail("IP/20/70", "2020-03-10"), "IP/20/99": detail("IP/20/99"),
}
SEARCH = SearchSpec(keywords=("port", "quay"))


@pytest.mark.parametrize(("files", "seed"), [(1, 1), (3, 2), (100, 3)])
def test_a_stream_ends_like_one_run_over_all_files(spark, tmp_path, files, seed):
    requested = window_rows(spark, MARCH, FEBRUARY, JANUARY)
    run = U.run_windows(
        empty_corpus(spark), pages(spark, *LANDED), details(spark, ANSWERS), requested, window_rows(spark), ref_ledger(spark),
        SITE, SEARCH, scraped_at="fixed",
    )
    want = sorted(map(str, U.merged_corpus(empty_corpus(spark), run).collect()))
    windows = sorted((r.date_from, r.date_to) for r in run.window_ledger.collect())
    refs = sorted(r.reference for r in run.ref_ledger.collect())

    root, state = str(tmp_path / "data"), str(tmp_path / "state")
    landing = [(pages, row, "pages") for row in LANDED] + [(details, answer, "details") for answer in ANSWERS.items()]
    random.Random(seed).shuffle(landing)
    halves = landing[:6], landing[6:]
    for half in halves:
        for build, row, name in half:
            frame = build(spark, row) if name == "pages" else build(spark, dict([row]))
            frame.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        for name, build in (("pages", pages), ("details", lambda s: details(s, {}))):
            if not (tmp_path / name).exists():
                (tmp_path / name).mkdir()
        stream_dataset(spark, str(tmp_path / "pages"), str(tmp_path / "details"), root, state, requested, SITE, SEARCH,
                       files_per_batch=files, scraped_at="fixed")
    assert sorted(map(str, scan_snapshot(spark, D.corpus_root(root)).collect())) == want
    assert sorted((r.date_from, r.date_to) for r in D.pending_windows(spark, root).collect()) == windows == [FEBRUARY]
    assert sorted(r.reference for r in D.pending_refs(spark, root).collect()) == refs == ["IP/20/3", "IP/20/8"]
    told = read_metadata(spark, f"{root}/metadata").first()
    assert (told.total_documents, told.failed_window_count, told.failed_ref_count) == (len(want), 1, 2)


def test_a_batch_writes_what_stays_open_and_nothing_else(spark, tmp_path):
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=200_000))
    body = {"docuLanguageResource": {"title": "t", "htmlContent": f"<p>{text}</p>", "language": "en"}}
    pages(spark, page(JANUARY, [summary("IP/20/1", leadText=text)])).coalesce(1).write.parquet(str(tmp_path / "pages"))
    details(spark, {"IP/20/1": detail("IP/20/1", **body)}).coalesce(1).write.parquet(str(tmp_path / "details"))
    root = tmp_path / "data"
    stream_dataset(spark, str(tmp_path / "pages"), str(tmp_path / "details"), str(root), str(tmp_path / "state"),
                   window_rows(spark, JANUARY), SITE, SearchSpec(), scraped_at="fixed")
    assert [len(r.full_text) for r in scan_snapshot(spark, D.corpus_root(str(root))).collect()] == [200_000]
    assert sum(f.stat().st_size for f in (root / "open").rglob("*.parquet")) < 50_000


def test_answers_given_again_are_ranked_and_the_others_pass(spark):
    from folioforge.sources.landed import latest_answers
    from folioforge.streaming.feed import _DETAIL_KEY, _latest

    schema = "batch_id bigint, reference string, language string, body string"
    data = [(n, f"r{k}", "en", f"{k}.{n}") for k in range(6) for n in range(1 + k % 3)]
    rows = spark.createDataFrame([*data, (1, None, "en", "x"), (2, None, "en", "y"), (1, "r1", None, "z")], schema)
    for landed in (rows, rows.where("batch_id = 0")):
        assert sorted(map(str, _latest(landed, _DETAIL_KEY).collect())) == sorted(map(str, latest_answers(landed, _DETAIL_KEY).collect()))
    once = rows.where("batch_id = 0")
    assert _latest(once, _DETAIL_KEY) is once


def test_a_late_batch_opens_the_buckets_of_its_keys_only(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, title string").schema
    landed, root, state = (str(tmp_path / n) for n in ("landed", "root", "state"))

    def land(*ids):
        spark.createDataFrame([(i, "x") for i in ids], schema).coalesce(1).write.mode("append").parquet(landed)

    def consume():
        T.incremental_update(spark, landed, root, state, schema, key="id", order=["title"], files_per_batch=1)
        return sorted(r.id for r in T.read_parts(spark, root, schema).collect())

    land(*range(400))
    land(*range(300, 700))
    assert consume() == list(range(700))
    every = T.bucket_paths(spark, root, list(range(T.BUCKETS)))
    one = T.bucket_paths(spark, root, [5])
    assert len(every) > 100 and len(one) == 2 and all(path.endswith("bucket=5") for path in one)
    T.compact_ids(spark, root, "id", schema)
    assert len(T.bucket_paths(spark, root, list(range(T.BUCKETS)))) == T.BUCKETS
    assert [path.rsplit("/", 2)[1] for path in T.bucket_paths(spark, root, [5])] == ["1"]
    land(3, 699, 700, 5000)
    assert consume() == [*range(701), 5000]
    assert len(T.bucket_paths(spark, root, list(range(T.BUCKETS)))) <= T.BUCKETS + 2
    T.compact_ids(spark, root, "id", schema)
    land(700, 5000, 1)
    assert consume() == [*range(701), 5000]


def test_the_last_row_of_each_key_comes_from_the_state_store(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, seq int, title string").schema
    landed, root, state = (str(tmp_path / n) for n in ("landed", "root", "state"))
    options = {"key": "id", "order": ["seq", "title"]}
    rng, best = random.Random(4), {}

    def land(n):
        data = [(rng.randrange(40), rng.randrange(1000), rng.choice("abc")) for _ in range(n)]
        for row in data:
            best[row[0]] = max(best.get(row[0], (-1, "")), row[1:])
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(landed)

    def check(got):
        assert sorted(map(tuple, got.collect())) == sorted((k, *v) for k, v in best.items())

    for _ in range(3):
        land(30)
    check(T.stream_latest(spark, landed, root, state, schema, files_per_batch=1, **options))
    T.compact_latest(spark, root, schema, **options)
    check(T.read_latest(spark, root, schema, **options))
    land(10)
    check(T.stream_latest(spark, landed, root, state, schema, files_per_batch=1, **options))
    # A batch holds its own keys only.
    last = max(int(p.name.partition("=")[2]) for p in (tmp_path / "root" / "rows").glob("*/part=*"))
    assert spark.read.parquet(f"{root}/rows").where(f"part = {last}").count() <= 10
    T.compact_latest(spark, root, schema, **options)
    land(10)
    # Another checkpoint starts with an empty state and reads everything again.
    check(T.stream_latest(spark, landed, root, str(tmp_path / "state2"), schema, files_per_batch=2, **options))
