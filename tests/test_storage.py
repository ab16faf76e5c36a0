from __future__ import annotations

import json
import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folioforge import session as S
from folioforge.operators.records import normalize_schema
from folioforge.schema import ACTIVE_TYPES, CORPUS_COLUMNS
from folioforge.sources import corpus as C
from folioforge.sources import ledgers as LG
from folioforge.sources import release as R
from folioforge.sources import sinks as K
from folioforge.streaming import topup as T

SCHEMA = "document_id string, doc_type string, date string, title string, detail_ok boolean"


def rows(spark, *data):
    return normalize_schema(spark.createDataFrame(list(data), SCHEMA))


@pytest.fixture
def small(spark):
    return rows(
        spark,
        ("ip_26_301", "IP", "2026-01-20", "Press", True),
        ("bio_20_1", "BIO", "2020-01-01", "Brief; \"quoted\", with comma\nand line", False),
        ("none_1", None, "", "  padded ", None),
    )


def test_a_missing_path_is_an_empty_corpus(spark, tmp_path):
    for got in (C.scan_corpus(spark, f"{tmp_path}/no"), C.scan_snapshot(spark, f"{tmp_path}/no")):
        assert got.columns == list(CORPUS_COLUMNS) and got.count() == 0


def test_round_trip_and_replacement(spark, tmp_path, small):
    root = str(tmp_path / "corpus")
    K.write_corpus(small, root)
    assert sorted(map(str, C.scan_snapshot(spark, root).collect())) == sorted(map(str, small.collect()))
    later = C.scan_snapshot(spark, root).withColumn("seq", F.lit(0)).unionByName(
        rows(spark, ("ip_26_301", "IP", "2026-01-20", "Replacement", True)).withColumn("seq", F.lit(1))
    )
    K.write_corpus(later, root, order=["seq"])
    got = {r.document_id: r.title for r in C.scan_snapshot(spark, root).collect()}
    assert got["ip_26_301"] == "Replacement" and len(got) == 3


def test_an_uncommitted_snapshot_is_invisible(spark, tmp_path, small):
    root = tmp_path / "corpus"
    K.write_corpus(small, str(root))
    (root / "snapshot=2").mkdir()
    assert C.scan_snapshot(spark, str(root)).count() == 3
    assert K.write_corpus(small, str(root)).endswith("snapshot=2")


def test_years_prune_partitions(spark, tmp_path, small):
    root = str(tmp_path / "corpus")
    K.write_corpus(small, root)
    got = C.scan_snapshot_window(spark, root, date(2019, 6, 1), date(2021, 1, 1))
    assert [r.document_id for r in got.collect()] == ["bio_20_1"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*pub_year", plan)


def test_a_legacy_file_is_migrated_on_read_only(spark, tmp_path):
    path = str(tmp_path / "legacy")
    spark.createDataFrame([("a", "IP/1", "x")], "document_id string, reference_number string, keywords string").write.parquet(path)
    assert C.scan_corpus(spark, path).first().reference == "IP/1"
    assert "reference_number" in spark.read.parquet(path).columns


def test_exports(spark, tmp_path, small):
    K.export_by_type(small, str(tmp_path / "types"))
    assert {p.name for p in (tmp_path / "types").glob("stem=*")} == {"stem=press-releases", "stem=other"}
    assert spark.read.parquet(f"{tmp_path}/types").where("stem = 'other'").count() == 2
    K.export_active(small, str(tmp_path / "active"))
    active = spark.read.parquet(f"{tmp_path}/active").collect()
    assert [r.document_id for r in active] == ["ip_26_301"] and active[0].doc_type in ACTIVE_TYPES
    K.export_csv(small, str(tmp_path / "csv"))
    back = {r.document_id: r for r in K.read_csv_export(spark, f"{tmp_path}/csv").collect()}
    assert back["bio_20_1"].title == "Brief; \"quoted\", with comma\nand line"
    assert (back["none_1"].title, back["none_1"].detail_ok, back["ip_26_301"].detail_ok) == ("  padded ", None, "True")


def test_metadata(spark, tmp_path, small):
    windows, refs = LG.empty_ledgers(spark)
    one_window = spark.createDataFrame([("d", 0)], "dataset string, position bigint")
    for stamp, digest in (("2026-01-01", None), ("2026-01-02", "abc")):
        row = K.metadata_row(small, one_window, refs, config_hash=digest, last_run=stamp)
        K.write_metadata(row, f"{tmp_path}/meta")
    got = K.read_metadata(spark, f"{tmp_path}/meta").first()
    assert (got.total_documents, got.cutoff, got.scope, got.config_hash) == (3, "2026-01-20", "all", "abc")
    assert got.per_type_counts == {"BIO": 1, "IP": 1}
    assert (got.failed_window_count, got.failed_ref_count) == (1, 0)
    with pytest.raises(ValueError):
        K.metadata_row(small, one_window, refs, scope="some")
    assert K.metadata_row(small.limit(0), windows, refs).first().total_documents == 0


def test_ledgers(spark, tmp_path):
    assert LG.scan_failed_windows(spark, f"{tmp_path}/no").count() == 0
    (tmp_path / "windows.json").write_text('{"dataset":"d","position":0,"date_from":"2020-01-01"}\n')
    with pytest.raises(PySparkException, match="date_to"):
        LG.scan_failed_windows(spark, f"{tmp_path}/windows.json").collect()
    entries = spark.createDataFrame(
        [("d", "IP/1", "[1]"), ("d", "IP/2", '{"refCode":"x"}')], "dataset string, reference string, summary_json string"
    )
    LG.write_failed_refs(entries, f"{tmp_path}/refs")
    got = {r.reference: json.loads(r.summary_json) for r in LG.scan_failed_refs(spark, f"{tmp_path}/refs").collect()}
    assert got == {"IP/1": {"refCode": "IP/1"}, "IP/2": {"refCode": "x"}}


def test_digests_of_files_of_any_size(spark, tmp_path):
    import hashlib

    folder = tmp_path / "files"
    folder.mkdir()
    want = {}
    for n, size in enumerate((1, 10, 5_000, 20_000_000)):
        (folder / f"f{n}.bin").write_bytes(bytes([n]) * size)
        want[f"f{n}.bin"] = (size, hashlib.sha256(bytes([n]) * size).hexdigest())
    found = R.file_digests(spark, str(folder)).collect()
    assert {r.path.rsplit("/", 1)[-1]: (r.size_bytes, r.sha256) for r in found} == want


def test_verification_verdicts(spark):
    digests = spark.createDataFrame(
        [("/d/a", 1, "aa"), ("/d/b", 1, "bb"), ("/d/c", 2, "cc"), ("/d/e", 2, "ee"), ("/d/f", 1, "ff")],
        "path string, size_bytes bigint, sha256 string",
    )
    manifest = spark.createDataFrame(
        [("http://x/a", " AA", 1), ("http://x/b", "b0", 1), ("http://x/c", "cc", 1), ("http://x/e", "ee", None),
         ("http://x/g", "gg", 1)],
        "url string, sha256 string, size_bytes bigint",
    )
    got = {r.file_name: r.verdict for r in R.verify_files(digests, manifest).collect()}
    assert got == {"a": "verified", "b": "digest mismatch", "c": "size mismatch", "e": "verified", "f": "unlisted",
                   "g": "missing"}


def test_tables_in_parts_have_one_verdict_each(spark, tmp_path):
    """Parts of all tables have equal names, as Spark's and DuckDB's writers give them."""
    from workload.storage_queries import TABLES, q_verify_files

    for name in TABLES:
        parts = [f"{name}.parquet"] if name in ("nation", "labels") else [f"{name}.parquet/part-{k}.parquet" for k in range(3)]
        for part in parts:
            (tmp_path / part).parent.mkdir(exist_ok=True)
            (tmp_path / part).write_text(part)
    got = {r.file_name: r.verdict for r in q_verify_files(spark, str(tmp_path)).collect()}
    wrong = {"nation": "unlisted", "region": "digest mismatch", "part": "size mismatch"}
    assert got == {f"{name}.parquet": wrong.get(name, "verified") for name in TABLES}


def test_the_worst_part_decides(spark):
    digests = spark.createDataFrame(
        [("file:/d/a/1", 1, "aa"), ("file:/d/a/2", 1, "xx"), ("file:/d/b/1", 2, "bb"), ("file:/d/c", 3, "cc")],
        "path string, size_bytes bigint, sha256 string",
    )
    manifest = spark.createDataFrame(
        [("http://x/a/1", "aa", 1), ("http://x/a/2", "a2", 1), ("http://x/b/1", "bb", 2), ("http://x/b/2", "b2", 1),
         ("http://x/c", "cc", 3)],
        "url string, sha256 string, size_bytes bigint",
    )
    got = R.verify_tables(R.verify_files(digests, manifest, "/d", "http://x")).collect()
    assert {r.file_name: r.verdict for r in got} == {"a": "digest mismatch", "b": "missing", "c": "verified"}


def test_manifest_without_columns(spark):
    manifest = spark.createDataFrame([("1", "u")], "version string, url string")
    got = R.validate_manifest(manifest).first()
    assert (got.missing_fields, got.scope, got.valid) == (["cutoff", "sha256", "size_bytes"], "all", False)


def test_streamed_batches_are_idempotent(spark, tmp_path):
    schema = spark.createDataFrame([], "id string, title string, seq int").schema
    landed, root, state = (str(tmp_path / n) for n in ("landed", "root", "state"))

    def land(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(landed)

    def consume(checkpoint):
        T.incremental_update(spark, landed, root, checkpoint, schema, key="id", order=["seq"], files_per_batch=1)
        return sorted((r.id, r.title) for r in T.read_parts(spark, root, schema).collect())

    land(("a", "1", 1), ("a", "2", 2), ("b", "1", 1))
    assert consume(state) == [("a", "1"), ("b", "1")]
    land(("b", "late", 9), ("c", "1", 1))
    assert consume(state) == [("a", "1"), ("b", "1"), ("c", "1")]
    # A replay from the start, as after a lost checkpoint, ends in the same corpus.
    assert consume(str(tmp_path / "state2")) == [("a", "1"), ("b", "1"), ("c", "1")]


def test_another_checkpoint_or_batch_size_keeps_what_is_stored(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, title string").schema
    root = str(tmp_path / "root")
    scratch = Path(S.shared_dir(spark).removeprefix("file:")) / "folioforge"
    before = set(scratch.glob("micro-batch-*"))

    def consume(landed, state, files):
        T.incremental_update(spark, str(tmp_path / landed), root, str(tmp_path / state), schema, key="id", order=["title"],
                             files_per_batch=files)
        return sorted(r.id for r in T.read_parts(spark, root, schema).collect())

    for n in range(5):
        frame = spark.createDataFrame([(3 * n + k, "x") for k in range(3)], schema)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "one"))
    assert consume("one", "state1", 1) == list(range(15))
    assert consume("one", "state2", 2) == list(range(15))
    spark.createDataFrame([(1, "again"), (20, "x"), (21, "x")], schema).write.parquet(str(tmp_path / "two"))
    assert consume("two", "state3", 1) == [*range(15), 20, 21]
    assert set(scratch.glob("micro-batch-*")) == before


def test_a_repeated_document_is_never_stored_twice(spark, tmp_path, small):
    with pytest.raises(ValueError, match="ip_26_301"):
        K.write_corpus(small.unionByName(small.where("doc_type = 'IP'")), str(tmp_path / "corpus"))
    assert C.scan_snapshot(spark, str(tmp_path / "corpus")).count() == 0


def test_the_latest_entry_of_a_reference_is_kept(spark, tmp_path):
    entries = spark.createDataFrame(
        [("d", "IP/1", '{"title":"new"}', 2), ("d", "IP/1", '{"title":"zold"}', 1)],
        "dataset string, reference string, summary_json string, step int",
    )
    LG.write_failed_refs(entries, str(tmp_path / "refs"), order=["step"])
    assert [r.summary_json for r in LG.scan_failed_refs(spark, str(tmp_path / "refs")).collect()] == ['{"title":"new"}']
    with pytest.raises(PySparkException, match="no order"):
        LG.write_failed_refs(entries.drop("step"), str(tmp_path / "unsure"))


def test_recorded_scope_of_a_dataset(spark, tmp_path, small):
    windows, refs = LG.empty_ledgers(spark)
    assert K.stored_scope(spark, f"{tmp_path}/none") == "all"
    K.write_metadata(K.metadata_row(small, windows, refs, scope="active", last_run="2026-01-01"), f"{tmp_path}/meta")
    assert K.stored_scope(spark, f"{tmp_path}/meta") == "active"
    (tmp_path / "meta" / "rows" / "later.json").write_text('{"number":2,"last_run":"2025","scope":"some"}\n')
    with pytest.raises(ValueError, match="some"):
        K.stored_scope(spark, f"{tmp_path}/meta")


def test_an_unbounded_feed_passes_a_key_once(spark, tmp_path):
    landed, out = str(tmp_path / "landed"), str(tmp_path / "out")
    frame = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, s int").select(
        "id", F.timestamp_seconds("s").alias("ts")
    )
    frame.write.parquet(landed)
    stream = T.stream_first(spark.readStream.schema(frame.schema).parquet(landed), "id", "ts", "1 hour")
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(out)
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_staged_tables_lie_in_the_shared_folder(spark):
    folder = S.shared_dir(spark)
    staged = S.stage(spark.range(3), "three")
    assert staged.count() == 3
    assert folder.removeprefix("file:") in staged.inputFiles()[0]


def test_a_cluster_needs_a_named_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(Session())
