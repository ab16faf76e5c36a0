"""Writing and reading back, file verification, and streaming top-ups."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from folioforge.schema import ACTIVE_TYPES, CORPUS_COLUMNS, EXPORT_STEMS
from folioforge.session import new_path
from folioforge.sources import ledgers as LG
from folioforge.sources import release, sinks
from folioforge.sources.corpus import scan_snapshot, scan_snapshot_window
from folioforge.sources.files import qualified
from folioforge.streaming import topup
from workload.archive_queries import MONTHS_DUCK, months, with_duck
from workload.corpus_queries import sql_list
from workload.registry import query
from workload.views import (
    corpus,
    corpus_columns,
    dates_as_text,
    duck_views,
    keyed_corpus,
    table,
)

C = duck_views("corpus")

# --- Sinks -------------------------------------------------------------------


@query("write_corpus", C + f"select {corpus_columns()} from corpus")
def q_write_corpus(spark, sf):
    """Two snapshots: the second one reads the first, and replaces every row with itself."""
    root = new_path(spark, "corpus")
    rows = keyed_corpus(spark, sf).withColumnRenamed("doc_id", "arrival")
    older = rows.withColumns({"title": F.lit("old"), "arrival": F.col("arrival") - 1_000_000})
    sinks.write_corpus(rows.unionByName(older), root, order=["arrival"])
    sinks.compact_corpus(spark, root)
    return scan_snapshot(spark, root)


@query(
    "scan_snapshot_window",
    C + f"select {corpus_columns()} from corpus where date between '1995-03-01' and '1999-10-15'",
)
def q_scan_snapshot_window(spark, sf):
    root = new_path(spark, "corpus")
    sinks.write_corpus(corpus(spark, sf), root)
    return scan_snapshot_window(spark, root, date(1995, 3, 1), date(1999, 10, 15))


@query("append_corpus", C + f"select {corpus_columns()} from corpus")
def q_append_corpus(spark, sf):
    root, rows = new_path(spark, "corpus"), keyed_corpus(spark, sf)
    for part in range(3):
        sinks.append_corpus(rows.where(F.col("doc_id") % 3 == part), root)
    return scan_snapshot(spark, root)


STEM_SQL = "case " + " ".join(
    f"when doc_type = '{code}' then '{stem}'" for code, stem in EXPORT_STEMS.items()
) + " else 'other' end"


@query("export_by_type", C + f"select {STEM_SQL} as stem, document_id, doc_type, title from corpus")
def q_export_by_type(spark, sf):
    target = new_path(spark, "by-type")
    sinks.export_by_type(corpus(spark, sf), target)
    return spark.read.parquet(target).select("stem", "document_id", "doc_type", "title")


@query("export_active", C + f"select {corpus_columns()} from corpus where doc_type in ({sql_list(ACTIVE_TYPES)})")
def q_export_active(spark, sf):
    target = new_path(spark, "active")
    sinks.export_active(corpus(spark, sf), target)
    return spark.read.parquet(target)


CSV_SQL = ", ".join(
    "case when detail_ok then 'True' when not detail_ok then 'False' end as detail_ok"
    if name == "detail_ok"
    else f"nullif({name}, '') as {name}"
    for name in CORPUS_COLUMNS
)


@query("export_csv", C + f"select {CSV_SQL} from corpus")
def q_export_csv(spark, sf):
    target = new_path(spark, "csv")
    sinks.export_csv(corpus(spark, sf), target)
    return sinks.read_csv_export(spark, target)


@query(
    "write_metadata",
    with_duck(MONTHS_DUCK) + C.replace("with ", ", ", 1) + """select (select count(*) from corpus) as total_documents, (select max(date) from corpus where date <> '') as cutoff,
      cast(1 as bigint) as number, '0.1.0' as package_version, '{"name": "orders"}' as metadata,
      'active' as scope, 'abc' as config_hash, '2026.05' as dataset_version, (select count(*) from months) as failed_window_count,
      (select count(*) from documents where doc_id % 9 = 1) as failed_ref_count,
      '2026-05-08T00:00:00' as last_run,
      '{' || (select string_agg('"' || doc_type || '":' || cast(n as varchar), ',' order by doc_type)
        from (select doc_type, count(*) as n from corpus where doc_type is not null group by 1) t) || '}' as per_type_counts""",
)
def q_write_metadata(spark, sf):
    rows = corpus(spark, sf)
    failed_windows = months(spark, sf)
    failed_refs = table(spark, sf, "documents").where("doc_id % 9 = 1")
    row = sinks.metadata_row(
        rows, failed_windows, failed_refs, scope="active", config_hash="abc",
        dataset_version="2026.05", last_run="2026-05-08T00:00:00", project_metadata={"name": "orders"},
    )
    target = new_path(spark, "metadata")
    sinks.write_metadata(row, target, failed_windows.withColumn("dataset", F.lit("orders")))
    return sinks.read_metadata(spark, target).withColumn("per_type_counts", F.to_json("per_type_counts"))


@query(
    "write_ledgers",
    with_duck(MONTHS_DUCK) + """select cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to, position
      from months""",
)
def q_write_ledgers(spark, sf):
    pending = months(spark, sf).withColumn("dataset", F.lit("orders"))
    twice = pending.unionByName(pending.withColumn("position", F.col("position") + 500))
    target = new_path(spark, "failed-windows")
    LG.write_failed_windows(twice, target)
    return dates_as_text(LG.scan_failed_windows(spark, target).drop("dataset"))


@query(
    "write_ref_ledger",
    "select 'refs' as dataset, source || '/' || cast(doc_id as varchar) as reference from documents where doc_id % 4 = 1",
)
def q_write_ref_ledger(spark, sf):
    entries = table(spark, sf, "documents").where("doc_id % 4 = 1").select(
        F.lit("refs").alias("dataset"),
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string")).alias("reference"),
        F.lit("[]").alias("summary_json"),
    )
    target = new_path(spark, "failed-refs")
    LG.write_failed_refs(entries, target)
    return LG.scan_failed_refs(spark, target).where(
        F.get_json_object("summary_json", "$.refCode") == F.col("reference")
    ).select("dataset", "reference")


# --- Release files -----------------------------------------------------------


TABLES = ("benchmark conversations customer documents embeddings events labels lineitem nation orders "
          "pages part region supplier").split()


@query(
    "verify_files",
    "select name || '.parquet' as file_name, case name when 'nation' then 'unlisted' when 'region' then 'digest mismatch' "
    "when 'part' then 'size mismatch' else 'verified' end as verdict from (select unnest([" + sql_list(TABLES) + "]) as name) t",
)
def q_verify_files(spark, sf):
    """Digests of this scale's tables, files or folders of parts, against a manifest with wrong entries."""
    digests, address = release.file_digests(spark, sf), "https://archive.example"
    name = release.name_below(F.col("path"), qualified(spark, sf))
    manifest = digests.where(~name.startswith("nation")).select(
        F.concat(F.lit(f"{address}/"), name).alias("url"),
        F.when(name.startswith("region"), F.lit("0" * 64)).otherwise(F.upper("sha256")).alias("sha256"),
        (F.col("size_bytes") + F.when(name.startswith("part"), 1).otherwise(0)).alias("size_bytes"),
    )
    verified = release.verify_files(digests, manifest, sf, address)
    return release.verify_tables(verified).select("file_name", "verdict")


@query(
    "validate_manifest",
    """select doc_id, case when doc_id % 4 = 1 and doc_id % 5 = 2 then 'sha256,version' when doc_id % 4 = 1 then 'sha256'
        when doc_id % 5 = 2 then 'version' else '' end as missing_fields, coalesce(scope, 'all') as scope,
        doc_id % 4 <> 1 and doc_id % 5 <> 2 and coalesce(scope, 'all') <> 'some' as valid
      from (select *, case doc_id % 3 when 0 then 'active' when 1 then 'some' end as scope from documents) d""",
)
def q_validate_manifest(spark, sf):
    manifest = table(spark, sf, "documents").select(
        "doc_id",
        F.expr("case when doc_id % 5 <> 2 then source end").alias("version"),
        F.lit("2026-05-08").alias("cutoff"),
        F.lit("https://archive.example/file").alias("url"),
        F.expr("case when doc_id % 4 <> 1 then sha2(text, 256) end").alias("sha256"),
        F.col("n_chars").alias("size_bytes"),
        F.expr("case doc_id % 3 when 0 then 'active' when 1 then 'some' end").alias("scope"),
    )
    checked = release.validate_manifest(manifest)
    return checked.select(
        "doc_id", F.array_join("missing_fields", ",").alias("missing_fields"), "scope", "valid"
    )


# --- Streaming ---------------------------------------------------------------


def event_files(spark, sf):
    """Events in several landed files, and a copy of each third event to land later."""
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")
    )
    late = events.where("event_id % 3 = 0").withColumn("event_type", F.concat(F.lit("late "), "event_type"))
    path = new_path(spark, "events")
    events.repartition(3, "event_id").write.parquet(path)
    return path, events, late


ORDER = ["ts", "event_type"]


@query("incremental_update", "select event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts from events")
def q_incremental_update(spark, sf):
    landed, events, _ = event_files(spark, sf)
    root, checkpoint = new_path(spark, "stream"), new_path(spark, "stream-state")
    options = {"key": "event_id", "order": ORDER, "files_per_batch": 1}
    topup.incremental_update(spark, landed, root, checkpoint, events.schema, **options)
    return topup.read_parts(spark, root, events.schema)


@query("late_arrivals", "select event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts from events")
def q_late_arrivals(spark, sf):
    """Copies that land after their documents were stored change nothing."""
    landed, events, late = event_files(spark, sf)
    root, checkpoint = new_path(spark, "stream"), new_path(spark, "stream-state")
    options = {"key": "event_id", "order": ORDER, "files_per_batch": 2}
    topup.incremental_update(spark, landed, root, checkpoint, events.schema, **options)
    late.write.mode("append").parquet(landed)
    topup.incremental_update(spark, landed, root, checkpoint, events.schema, **options)
    return topup.read_parts(spark, root, events.schema)


@query(
    "stream_dedup",
    """select user_id, event_id, event_type from (select *, row_number() over (partition by user_id
      order by strftime(ts, '%Y-%m-%d %H:%M:%S.%f') desc, event_type desc, event_id desc) as rn from events) e where rn = 1""",
)
def q_stream_dedup(spark, sf):
    landed, events, _ = event_files(spark, sf)
    root, checkpoint = new_path(spark, "stream"), new_path(spark, "stream-state")
    latest = topup.stream_latest(
        spark, landed, root, checkpoint, events.schema, key="user_id", order=[*ORDER, "event_id"], files_per_batch=1
    )
    return latest.select("user_id", "event_id", "event_type")
