"""Pending work: the window queue and the two retry ledgers as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import document_id
from folioforge.operators.merge import keep_last

WINDOW = ["date_from", "date_to"]


def window_queue(
    pending: DataFrame, requested: DataFrame, retry_pending: bool = True
) -> DataFrame:
    """Windows to process with their ``queue_key``: pending first, then requested.

    Both inputs carry ``position``, unique within each. Requested windows queue up behind the
    last pending one, wherever earlier runs have put it. A window is one exact (date_from, date_to) pair;
    differently clipped windows of one month are different windows.
    """
    behind = pending.agg((F.coalesce(F.max("position") + 1, F.lit(0))).cast("bigint").alias("behind"))
    later = requested.join(behind).select(  # ``behind`` is one row
        *WINDOW, (F.col("position") + F.col("behind")).alias("queue_key")
    )
    earlier = pending.select(*WINDOW, F.col("position").cast("bigint").alias("queue_key"))
    listed = earlier.unionByName(later) if retry_pending else later
    return listed.groupBy(*WINDOW).agg(F.min("queue_key").alias("queue_key"))


def window_ledger(pending: DataFrame, requested: DataFrame) -> DataFrame:
    """The ledger as it stands while a run is under way: pending and requested windows."""
    return window_queue(pending, requested).select(
        *WINDOW, F.col("queue_key").alias("position")
    )


def resolve_windows(ledger: DataFrame, completed: DataFrame) -> DataFrame:
    return ledger.join(completed.select(*WINDOW), WINDOW, "left_anti")


def resolve_refs(ledger: DataFrame, resolved: DataFrame) -> DataFrame:
    return ledger.join(resolved.select("reference"), "reference", "left_anti")


def _by_id(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("requested_id", document_id(F.col("reference")))


def unresolved_refs(ledger: DataFrame, corpus: DataFrame) -> DataFrame:
    """Ledger entries whose document is not stored with its detail."""
    entries = _by_id(ledger)
    complete = (
        corpus.where("detail_ok")
        .select(F.col("document_id").alias("requested_id"))
        .join(entries.select("requested_id"), "requested_id", "left_semi")
    )
    return entries.join(complete, "requested_id", "left_anti").drop("requested_id")


def ledger_latest(ledger: DataFrame, corpus: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Stored rows of the ledger's documents, the latest one each.

    The corpus is cut down to the ledger's few documents first. ``order`` names the
    arrival columns of a corpus that may hold a document more than once.
    """
    wanted = _by_id(ledger).select(F.col("requested_id").alias("document_id"))
    rows = corpus.join(wanted, "document_id", "left_semi")
    return rows if order is None else keep_last(rows, order)
