"""Audit repair: add what deficient windows lack, then judge what remains."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import audit as A
from folioforge.operators import windows as W
from folioforge.plans.update import Run, merged_corpus, replaced_rows, run_rows, run_windows, search_queue, touched_ids
from folioforge.schema import REF_LEDGER_SCHEMA, SearchSpec, Site
from folioforge.session import stage
from folioforge.sources.landed import COMPLETE, WINDOW


@dataclass(frozen=True)
class Repair:
    windows: DataFrame  # before and after per deficient window
    corpus: DataFrame
    run: Run


def audit_repair(
    corpus: DataFrame,
    audit: DataFrame,
    landed_pages: DataFrame,
    landed_details: DataFrame,
    remote_after: DataFrame,
    verification_pages: DataFrame,
    site: Site,
    search: SearchSpec,
    *,
    pending: DataFrame | None = None,
    ref_ledger: DataFrame | None = None,
    days: DataFrame | None = None,
    scraped_at: str | None = None,
) -> Repair:
    """Repair deficient windows only; surplus rows are never deleted.

    A window that is still deficient becomes ``reconciled`` when it was processed, added
    nothing, and a second, later enumeration lists stored documents only: its count then
    includes entries that cannot be retrieved. ``days`` are the corpus's rows per day, where they
    are stored (``parts.stored_days``). Both enumerations must have read every value
    of ``search``, else the window stays deficient. ``pending`` windows stay in the ledger.
    """
    spark = corpus.sparkSession
    deficient = stage(
        audit.where(F.col("status") == A.DEFICIENT).select(
            "position", *WINDOW, "api_count", "local_count"
        ),
        "deficient",
    )
    requested = deficient.select("position", *WINDOW)
    run = run_windows(
        corpus,
        landed_pages,
        landed_details,
        requested,
        requested.limit(0) if pending is None else pending,
        spark.createDataFrame([], REF_LEDGER_SCHEMA) if ref_ledger is None else ref_ledger,
        site,
        search,
        retry_pending=False,
        retry_details=False,
        scraped_at=scraped_at,
    )
    touched = touched_ids(run)
    repaired = merged_corpus(corpus, run, touched)
    # The recount needs the rows added and replaced only: the corpus was counted before.
    rows = run_rows(run, touched)
    changes = W.day_counts(rows)
    if not touched.isEmpty():
        changes = changes.unionByName(W.day_counts(replaced_rows(corpus, touched)).withColumn("n", -F.col("n")))
    counted = W.day_counts(corpus) if days is None else days
    after = A.reconcile_days(requested, remote_after, counted.unionByName(changes)).select(
        *WINDOW, F.col("api_count").alias("after_api"), F.col("local_count").alias("after_local"),
        F.col("status").alias("after_status"),
    )

    unchanged = run.windows.where((F.col("status") == COMPLETE) & (F.col("additions") == 0))
    doubtful = stage(
        after.where(F.col("after_status") == A.DEFICIENT)
        .join(unchanged.select(*WINDOW, "queue_key"), WINDOW)
        .select(*WINDOW, "queue_key"),
        "doubtful",
    )
    placed, listed = search_queue(doubtful, verification_pages, search)
    now = corpus.select("document_id").join(touched, "document_id", "left_anti").unionByName(rows.select("document_id"))
    held = A.phantom_check(listed, now)
    reconciled = (
        placed.where(F.col("status") == COMPLETE)
        .join(held, WINDOW, "left")
        .where(F.coalesce("all_stored", F.lit(True)))
        .select(*WINDOW, F.lit(True).alias("reconciled"))
    )

    before = deficient.select(
        *WINDOW, F.col("api_count").alias("before_api"), F.col("local_count").alias("before_local")
    )
    judged = (
        before.join(after, WINDOW)
        .join(reconciled, WINDOW, "left")
        .withColumn("reconciled", F.coalesce("reconciled", F.lit(False)))
    )
    api, local, flag = F.col("after_api"), F.col("after_local"), F.col("reconciled")
    windows = judged.select(
        *WINDOW,
        "before_api",
        "before_local",
        "after_api",
        "after_local",
        A.audit_status(api, local, flag).alias("status"),
        A.phantom_count(api, local, flag).alias("phantom_count"),
    )
    return Repair(windows, repaired, run)
