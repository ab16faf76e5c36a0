"""Topping up a stored dataset from search pages and details as they land.

Every micro-batch is one run over the windows that are still open, with all their pages so far and the
details that nothing has asked for yet. What is finished leaves these two tables, so a batch
reads what is new and what is open, never what is done. Landed rows are read where they landed;
only those that stay open are written.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.plans.dataset import corpus_root, describe, pending_refs, pending_windows, save, save_windows
from folioforge.plans.update import run_windows
from folioforge.schema import LANDED_DETAILS_SCHEMA, LANDED_PAGES_SCHEMA, SearchSpec, Site, recorded_scope
from folioforge.session import stage
from folioforge.sources.corpus import scan_snapshot
from folioforge.sources.files import exists
from folioforge.sources.landed import TRANSIENT, WINDOW, latest_answers
from folioforge.sources.sinks import metadata_row
from folioforge.streaming.topup import Place, consume, landed_files

_PAGE_KEY, _DETAIL_KEY = [*WINDOW, "variant_no", "page_no"], ["reference", "language"]


def stream_dataset(
    spark: SparkSession,
    landed_pages: str,
    landed_details: str,
    root: str,
    checkpoint: str,
    requested: DataFrame,
    site: Site,
    search: SearchSpec,
    *,
    files_per_batch: int = 1000,
    scraped_at: str | None = None,
) -> None:
    """Consume all pages and details that have landed; ``requested`` windows join the pending ones.

    A window is settled in the batch that completes it. Its documents are stored then, with the
    details that have landed by that time; the others are stored partial and stay pending, and are
    replaced when their details land. Pages and details may come in any order and in any batches:
    the corpus and both ledgers end as one run over all files leaves them. A document
    that several windows list has the summary of the one completed first.

    A replayed batch starts from the tables that its predecessor left, and finds in the corpus what it
    had stored. One stream at a time may write to ``root``.
    """
    save_windows(spark, root, requested, site.language)
    page_rows = landed_files(spark, landed_pages, LANDED_PAGES_SCHEMA, files_per_batch)
    detail_rows = landed_files(spark, landed_details, LANDED_DETAILS_SCHEMA, files_per_batch)
    nothing = lambda schema: F.lit(None).cast(schema)
    stream = page_rows.select(F.struct(*page_rows.columns).alias("page"), nothing(LANDED_DETAILS_SCHEMA).alias("detail")).unionByName(
        detail_rows.select(nothing(LANDED_PAGES_SCHEMA).alias("page"), F.struct(*detail_rows.columns).alias("detail")))

    def settle(batch: DataFrame, place: Place) -> None:
        session, (name, number) = batch.sparkSession, place
        folder = f"{root}/open/{name}"
        pages = _latest(_kept(session, f"{folder}/pages", number - 1, LANDED_PAGES_SCHEMA).unionByName(
            batch.where("page is not null").select("page.*")), _PAGE_KEY)
        details = _latest(_kept(session, f"{folder}/details", number - 1, LANDED_DETAILS_SCHEMA).unionByName(
            batch.where("detail is not null").select("detail.*")), _DETAIL_KEY)

        corpus = scan_snapshot(session, corpus_root(root))
        windows = pending_windows(session, root).drop("dataset")
        run = run_windows(
            corpus, pages, details, windows.limit(0), windows, pending_refs(session, root).drop("dataset"), site, search,
            scraped_at=scraped_at,
        )
        # A narrow table of known size: as long as it can be broadcast, no detail is shuffled to leave out the settled ones.
        settled = stage(run.rows.where(F.col("outcome") != TRANSIENT).select(F.col("reference_key").alias("reference")), "settled")
        _write(pages.join(run.window_ledger.select(*WINDOW), WINDOW, "left_semi"), f"{folder}/pages", number)
        _write(details.join(settled, "reference", "left_anti"), f"{folder}/details", number)
        save(session, root, corpus, run, site.language)

    consume(stream, checkpoint, settle)
    row = metadata_row(
        scan_snapshot(spark, corpus_root(root)), pending_windows(spark, root), pending_refs(spark, root),
        scope=recorded_scope(search.document_types), last_run=scraped_at,
    )
    describe(spark, root, row)


def _latest(rows: DataFrame, key: list[str]) -> DataFrame:
    """The newest answer to each request; answers to requests that have one only stay where they are.

    Keys alone are shuffled to find requests answered again, and the answers to these are ranked.
    """
    repeated = stage(rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*(F.col(c).alias(f"_{c}") for c in key)), "repeated")
    if repeated.isEmpty():
        return rows
    again = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key))
    newest = stage(latest_answers(rows.join(repeated, again, "left_semi"), key), "newest")
    return rows.join(repeated, again, "left_anti").unionByName(newest)


def _kept(spark: SparkSession, folder: str, number: int, schema) -> DataFrame:
    path = f"{folder}/batch={number}"
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def _write(rows: DataFrame, folder: str, number: int) -> None:
    rows.write.option("compression", "zstd").mode("overwrite").parquet(f"{folder}/batch={number}")
