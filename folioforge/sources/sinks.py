"""Writing a corpus, its exports and its metadata."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge import __version__
from folioforge.functions import dates as D
from folioforge.operators.filters import filter_types
from folioforge.operators.merge import keep_last
from folioforge.operators.records import ISO_UTC, normalize_schema
from folioforge.schema import (
    ACTIVE_TYPES,
    CORPUS_COLUMNS,
    EXPORT_STEMS,
    OTHER_STEM,
    REF_LEDGER_SCHEMA,
    SCOPES,
    WINDOW_LEDGER_SCHEMA,
)
from folioforge.session import stage
from folioforge.sources.files import exists, latest_snapshot
from folioforge.sources.parts import add_part, compact, new_snapshot

METADATA_SCHEMA = (
    "number bigint, package_version string, metadata string, last_run string, total_documents bigint, cutoff string, scope string, "
    "per_type_counts map<string, bigint>, config_hash string, dataset_version string, "
    "failed_window_count bigint, failed_ref_count bigint"
)


def write_corpus(rows: DataFrame, root: str, order: list[str] | None = None) -> str:
    """Write a new snapshot next to the ones before and return its path.

    A snapshot is never written over the one being read. Readers take the highest
    committed number, so a failed write stays invisible. ``order`` names the arrival
    columns of rows that may repeat a document, the latest copy is stored; without it a
    repeated document is an error, found in the identifiers of the staged rows.
    """
    if order is not None:
        unique = keep_last(normalize_schema(rows, keep=tuple(order)), order).drop(*order)
    else:
        unique = stage(normalize_schema(rows), "rows")
        repeated = unique.groupBy("document_id").agg(F.count("*").alias("n")).where("n > 1").first()
        if repeated is not None:
            raise ValueError(f"document {repeated.document_id!r} occurs {repeated.n} times and no order is given")
    return new_snapshot(unique, root)


def append_corpus(rows: DataFrame, root: str) -> str:
    """Add new documents to the latest snapshot; stored files are not touched.

    Rows must be unique and not stored yet. An append that was cut off is invisible, and
    written over by the next one.
    """
    if latest_snapshot(rows.sparkSession, root) is None:
        return write_corpus(rows, root)
    return add_part(normalize_schema(rows), root)


def replace_rows(rows: DataFrame, replaced: DataFrame, root: str) -> str:
    """Add rows to the latest snapshot, some of them in the place of stored ones.

    ``replaced`` are the stored rows (document_id, date) that count no more. Stored files stay as
    they are, the work follows the rows given; ``compact_corpus`` folds such parts together.
    """
    return add_part(normalize_schema(rows), root, replaced)


def compact_corpus(spark: SparkSession, root: str) -> str:
    """A new snapshot of one part, without replaced rows, newest rows first."""
    return compact(spark, root)


def export_stem(doc_type: Column) -> Column:
    """Export subset of a type code; other codes and rows without one go together."""
    named = F.create_map(*[F.lit(part) for pair in EXPORT_STEMS.items() for part in pair])
    return F.coalesce(F.try_element_at(named, doc_type), F.lit(OTHER_STEM))


def export_by_type(corpus: DataFrame, target: str) -> None:
    """One Parquet subset per named type and one for all others; none is empty."""
    (
        corpus.withColumn("stem", export_stem(F.col("doc_type")))
        .hint("rebalance", "stem")
        .write.partitionBy("stem")
        .option("compression", "snappy")
        .mode("errorifexists")
        .parquet(target)
    )


def export_active(corpus: DataFrame, target: str) -> None:
    filter_types(corpus, ACTIVE_TYPES).write.option("compression", "snappy").mode(
        "errorifexists"
    ).parquet(target)


def export_csv(corpus: DataFrame, target: str) -> None:
    """The whole corpus as UTF-8 CSV with header; booleans print as True and False."""
    printed = F.when(F.col("detail_ok"), "True").when(~F.col("detail_ok"), "False")
    corpus.withColumn("detail_ok", printed).write.options(
        header=True,
        quote='"',
        escape='"',
        emptyValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).mode("errorifexists").csv(target)


def read_csv_export(spark: SparkSession, target: str) -> DataFrame:
    """Read such an export back; the columns are text, empty text reads as null."""
    schema = ", ".join(f"{name} string" for name in CORPUS_COLUMNS)
    return spark.read.schema(schema).options(
        header=True,
        quote='"',
        escape='"',
        multiLine=True,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(target)


def metadata_row(
    corpus: DataFrame,
    failed_windows: DataFrame,
    failed_refs: DataFrame,
    *,
    scope: str = "all",
    config_hash: str | None = None,
    dataset_version: str | None = None,
    last_run: str | None = None,
    project_metadata: Mapping[str, object] | None = None,
) -> DataFrame:
    """One row that describes corpus and pending work.

    The corpus is reduced to one row per type first; the map is built from those. The row has the
    ledgers' sizes; ``write_metadata`` keeps their contents, which have no bound, in tables beside it.
    ``project_metadata`` is stored as JSON.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    date = F.col("date")
    per_type = corpus.groupBy("doc_type").agg(
        F.count("*").alias("n"), F.max(F.when(D.filled(date), date)).alias("newest")
    )
    entry = F.when(F.col("doc_type").isNotNull(), F.struct("doc_type", "n"))
    totals = per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_documents"),
        F.max("newest").alias("cutoff"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("per_type_counts"),
    )
    window_count = failed_windows.agg(F.count("*").alias("n"))
    ref_count = failed_refs.agg(F.count("*").alias("n"))
    now = F.date_format(F.current_timestamp(), ISO_UTC) if last_run is None else F.lit(last_run)
    project = None if project_metadata is None else json.dumps(project_metadata, sort_keys=True)
    return totals.select(
        F.lit(__version__).alias("package_version"),
        F.lit(project).cast("string").alias("metadata"),
        now.alias("last_run"),
        "total_documents",
        "cutoff",
        F.lit(scope).alias("scope"),
        "per_type_counts",
        F.lit(config_hash).cast("string").alias("config_hash"),
        F.lit(dataset_version).cast("string").alias("dataset_version"),
        window_count.scalar().alias("failed_window_count"),
        ref_count.scalar().alias("failed_ref_count"),
    )


def write_metadata(
    row: DataFrame, target: str, failed_windows: DataFrame | None = None, failed_refs: DataFrame | None = None
) -> None:
    """Append to the metadata history under the next running number, which decides what is latest.

    With them, the contents of the ledgers are kept under the same number. The row is written
    last: a number without a row is not read, and given again.
    """
    spark = row.sparkSession
    last = _history(spark, target).agg(F.max("number").alias("last")).first()["last"]
    number = (0 if last is None else last) + 1
    for name, ledger in (("failed_windows", failed_windows), ("failed_refs", failed_refs)):
        if ledger is not None:
            ledger.write.mode("overwrite").json(f"{target}/{name}/number={number}")
    row.withColumn("number", F.lit(number).cast("bigint")).write.mode("append").json(f"{target}/rows")


def _history(spark: SparkSession, target: str) -> DataFrame:
    if not exists(spark, f"{target}/rows"):
        return spark.createDataFrame([], METADATA_SCHEMA)
    return spark.read.schema(METADATA_SCHEMA).json(f"{target}/rows")


def read_metadata(spark: SparkSession, target: str) -> DataFrame:
    """The latest metadata row; none for a dataset without metadata."""
    return _history(spark, target).orderBy(F.col("number").desc()).limit(1)


def metadata_ledgers(spark: SparkSession, target: str) -> tuple[DataFrame, DataFrame]:
    """Pending windows and references as the latest metadata row found them."""
    row = read_metadata(spark, target).first()
    found = []
    for name, schema in (("failed_windows", WINDOW_LEDGER_SCHEMA), ("failed_refs", REF_LEDGER_SCHEMA)):
        path = None if row is None else f"{target}/{name}/number={row.number}"
        known = path is not None and exists(spark, path)
        found.append(spark.read.schema(schema).json(path) if known else spark.createDataFrame([], schema))
    return tuple(found)


def stored_scope(spark: SparkSession, target: str) -> str:
    """The scope a dataset was recorded with; ``all`` where none is, an unknown one is an error."""
    row = read_metadata(spark, target).first()
    scope = "all" if row is None or row.scope is None else row.scope
    if scope not in SCOPES:
        raise ValueError(f"recorded scope {scope!r} is none of {SCOPES}")
    return scope
