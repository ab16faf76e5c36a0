from __future__ import annotations

import random
from datetime import date

from pyspark.sql import functions as F

from folioforge.operators import ledgers as L
from folioforge.operators import merge as M
from folioforge.operators import ordered as O
from folioforge.operators.records import normalize_schema
from folioforge.session import stage


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "document_id string, title string, seq int")


def titles(df):
    return sorted(((r.document_id, r.title) for r in df.collect()), key=str)


def test_the_last_row_wins_and_null_identifiers_collapse(spark):
    rows = docs(spark, ("a", "1", 1), ("a", "2", 2), (None, "3", 3), (None, "4", 4), ("", "5", 5))
    assert titles(M.keep_last(rows, ["seq"])) == [("", "5"), ("a", "2"), (None, "4")]
    assert titles(M.first_wins(rows, ["seq"])) == [("", "5"), ("a", "1"), (None, "3")]


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    rows = spark.range(1000).select(key.alias("document_id"), F.col("id").alias("seq"))
    plan = M.keep_last(rows, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    before_shuffle = plan[plan.index("Exchange hashpartitioning") :]
    assert "WindowGroupLimit" in before_shuffle


def test_upsert_is_idempotent_and_the_last_batch_wins(spark):
    stored = docs(spark, ("a", "old", 0), ("b", "kept", 0), (None, "nameless", 0))
    batch = docs(spark, ("a", "x", 1), ("a", "new", 2), ("c", "added", 1), (None, "newer", 3))
    want = [("a", "new"), ("b", "kept"), ("c", "added"), (None, "newer")]
    once = M.append_upsert(stored, batch, ["seq"])
    assert titles(once) == want
    assert titles(M.append_upsert(once, batch, ["seq"])) == want
    repeated = stored.unionByName(docs(spark, ("b", "kept later", 5)))
    twice = M.append_upsert(repeated, batch, ["seq"], stored_order=["seq"])
    assert ("b", "kept later") in titles(twice)


def test_an_empty_batch_changes_nothing(spark):
    stored = docs(spark, ("a", "old", 0))
    assert titles(M.append_upsert(stored, stored.limit(0), ["seq"])) == [("a", "old")]


def test_upsert_does_not_shuffle_the_stored_rows(spark, tmp_path):
    normalize_schema(docs(spark, *[(f"d{n}", "t", 0) for n in range(50)])).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    batch = stage(docs(spark, ("d1", "new", 1)), "batch")
    merged = M.append_upsert(stored, batch, ["seq"])
    assert merged.count() == 50
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # A batch of known, small size is broadcast: no shuffled join touches the corpus.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_running_totals_equal_a_plain_loop(spark):
    random.seed(7)
    data = [(random.choice("ab"), n, random.randint(-5, 5)) for n in range(300)]
    frame = spark.createDataFrame(data, "k string, n int, v int")
    got = O.running_total(frame, ["k"], "n", {"total": "v"}, bucket=16)
    totals = {"a": 0, "b": 0}
    want = {}
    for k, n, v in data:
        totals[k] += v
        want[(k, n)] = totals[k]
    assert {(r.k, r.n): r.total for r in got.collect()} == want


def test_canary_limit_equals_a_sorted_list(spark):
    random.seed(3)
    data = [(random.randint(0, 6), random.randint(1, 4), p) for p in range(120)]
    frame = spark.createDataFrame(data, "queue_key bigint, page_key bigint, pos int")
    for limit in (1, 17, 60, 120, 500):
        selected, progress = O.canary_limit(frame, limit)
        want = sorted(data)[:limit]
        assert sorted(tuple(r) for r in selected.select("queue_key", "page_key", "pos").collect()) == want
        for row in progress.collect():
            mine = [d for d in data if d[0] == row.queue_key]
            taken = [d for d in want if d[0] == row.queue_key]
            assert (row.missing, row.selected, row.complete) == (len(mine), len(taken), len(mine) == len(taken))


def test_newest_first_with_nulls_last_and_arrival_order(spark):
    rows = spark.createDataFrame(
        [("a", None), ("b", ""), ("c", "2020-01-01"), ("d", "2021-01-01"), ("e", "2020-01-01")],
        "document_id string, date string",
    )
    assert [r.document_id for r in O.sort_newest(rows).collect()] == ["d", "c", "e", "b", "a"]


JAN, FEB, CLIP = (
    (date(2020, 1, 1), date(2020, 1, 31)),
    (date(2020, 2, 1), date(2020, 2, 29)),
    (date(2020, 1, 5), date(2020, 1, 31)),
)


def windows(spark, *spans):
    return spark.createDataFrame(
        [(n, *span) for n, span in enumerate(spans)], "position bigint, date_from date, date_to date"
    )


def queue(df):
    return [(r.date_from, r.date_to) for r in df.orderBy("queue_key").collect()]


def test_pending_windows_come_first_and_clips_are_different_windows(spark):
    pending, requested = windows(spark, JAN), windows(spark, FEB, JAN, CLIP)
    assert queue(L.window_queue(pending, requested)) == [JAN, FEB, CLIP]
    assert queue(L.window_queue(pending, requested, retry_pending=False)) == [FEB, JAN, CLIP]
    ledger = L.window_ledger(pending, requested)
    assert ledger.count() == 3
    left = L.resolve_windows(ledger, windows(spark, JAN, FEB))
    assert [(r.date_from, r.date_to) for r in left.collect()] == [CLIP]


def test_ledger_entries_of_complete_documents_are_resolved(spark):
    ledger = spark.createDataFrame([("IP/1", ""), ("IP/2", ""), ("IP/3", "")], "reference string, summary_json string")
    corpus = spark.createDataFrame(
        [("ip_1", True), ("ip_2", None), ("other", True)], "document_id string, detail_ok boolean"
    )
    assert sorted(r.reference for r in L.unresolved_refs(ledger, corpus).collect()) == ["IP/2", "IP/3"]


def test_no_pending_window_is_ever_lost(spark):
    """Ledger after a run = (pending or requested) minus exactly the completed ones."""
    random.seed(11)
    spans = [(date(2020, m, d), date(2020, m, 28)) for m in range(1, 13) for d in (1, 9)]
    for _ in range(4):
        pending, requested, done = (set(random.sample(spans, k)) for k in (6, 10, 7))
        ledger = L.window_ledger(windows(spark, *pending), windows(spark, *requested))
        left = L.resolve_windows(ledger, windows(spark, *done)).collect()
        assert sorted((r.date_from, r.date_to) for r in left) == sorted((pending | requested) - done)
