"""Whole jobs on a stored dataset: corpus, both ledgers and metadata, stored in a durable order."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.audit import reconcile_days
from folioforge.operators.ledgers import window_ledger
from folioforge.operators.windows import bounds, calendar_windows, month_windows
from folioforge.plans.repair import audit_repair
from folioforge.plans.update import Run, run_fixed, run_windows, save_run, update_scope, update_windows
from folioforge.schema import SearchSpec, Site, recorded_scope, scope_types
from folioforge.session import stage
from folioforge.sources.corpus import scan_snapshot
from folioforge.sources.files import exists, latest_snapshot
from folioforge.sources.ledgers import (
    empty_ledgers,
    scan_failed_refs,
    scan_failed_windows,
    write_failed_refs,
    write_failed_windows,
)
from folioforge.sources.parts import stored_days
from folioforge.sources.sinks import metadata_row, read_metadata, stored_scope, write_metadata


def corpus_root(root: str) -> str:
    return f"{root}/corpus"


def pending_windows(spark: SparkSession, root: str) -> DataFrame:
    """Windows that earlier updates of the dataset left unfinished."""
    return scan_failed_windows(spark, _current(spark, f"{root}/windows"))


def pending_refs(spark: SparkSession, root: str) -> DataFrame:
    """References whose details earlier updates of the dataset could not get."""
    return scan_failed_refs(spark, _current(spark, f"{root}/refs"))


def _current(spark: SparkSession, folder: str) -> str:
    """The latest committed ledger; a path that does not exist stands for an empty one."""
    return f"{folder}/snapshot={latest_snapshot(spark, folder) or 0}"


def _next(spark: SparkSession, folder: str) -> str:
    """Path of the next ledger, beyond what a write that was cut off has left."""
    number = (latest_snapshot(spark, folder) or 0) + 1
    while exists(spark, f"{folder}/snapshot={number}"):
        number += 1
    return f"{folder}/snapshot={number}"


def update_dataset(
    spark: SparkSession,
    root: str,
    landed_pages: DataFrame,
    landed_details: DataFrame,
    site: Site,
    until: date,
    *,
    since: date | None = None,
    full: bool = False,
    scope: str | None = None,
    limit: int | None = None,
    scraped_at: str | None = None,
    keep_html: bool = False,
) -> DataFrame:
    """Bring the dataset at ``root`` up to ``until``; returns the run's row of counters.

    References to retry are stored before the corpus: a row without its detail is never
    stored unless its reference is. Windows are settled after the corpus: an update that
    was cut off reads its windows again and finds what it had stored. Metadata comes last
    and describes what is stored then. The scope of a new dataset is recorded first, in a
    row without time, so that it holds even if its first update was cut off. It limits the
    types that are stored: what landed beyond them is neither listed, counted nor stored.
    """
    name = site.language
    stored = latest_snapshot(spark, corpus_root(root)) is not None
    known = stored or not read_metadata(spark, f"{root}/metadata").isEmpty()
    recorded = stored_scope(spark, f"{root}/metadata") if known else None
    chosen = update_scope(recorded, scope, full)
    corpus = scan_snapshot(spark, corpus_root(root))
    if not known:
        new = metadata_row(corpus, *empty_ledgers(spark), scope=chosen)
        write_metadata(new.withColumn("last_run", F.lit(None).cast("string")), f"{root}/metadata")
    # The range follows from the corpus, which grows below; it must not be computed again.
    requested = stage(update_windows(corpus, until, since, full), "requested")
    run = run_windows(
        corpus,
        landed_pages,
        landed_details,
        requested,
        pending_windows(spark, root).drop("dataset"),
        pending_refs(spark, root).drop("dataset"),
        site,
        SearchSpec(language=name, document_types=scope_types(chosen)),
        limit=limit,
        scraped_at=scraped_at,
        keep_html=keep_html,
    )
    summary = save(spark, root, corpus, run, name)
    described = metadata_row(
        scan_snapshot(spark, corpus_root(root)),
        pending_windows(spark, root),
        pending_refs(spark, root),
        scope=chosen,
        last_run=scraped_at,
    )
    describe(spark, root, described)
    return summary


def describe(spark: SparkSession, root: str, row: DataFrame) -> None:
    """Append a metadata row, with the ledgers as they stand."""
    write_metadata(row, f"{root}/metadata", pending_windows(spark, root), pending_refs(spark, root))


def save(spark: SparkSession, root: str, corpus: DataFrame, run: Run, name: str) -> DataFrame:
    """Store a run: references to retry, then corpus, then windows; returns its counters."""
    summary = stage(run.summary, "summary")
    dataset = F.lit(name).alias("dataset")
    windows = stage(run.window_ledger.select(dataset, "position", "date_from", "date_to"), "windows")
    write_failed_refs(
        run.ref_ledger.select(dataset, "reference", "summary_json"), _next(spark, f"{root}/refs")
    )
    save_run(corpus, run, corpus_root(root))
    write_failed_windows(windows, _next(spark, f"{root}/windows"))
    return summary


def save_windows(spark: SparkSession, root: str, requested: DataFrame, name: str) -> None:
    """Queue requested windows (position, date_from, date_to) behind the pending ones."""
    ledger = window_ledger(pending_windows(spark, root).drop("dataset"), requested)
    queued = stage(ledger.select(F.lit(name).alias("dataset"), "position", "date_from", "date_to"), "queued")
    write_failed_windows(queued, _next(spark, f"{root}/windows"))


def build_dataset(
    spark: SparkSession,
    root: str,
    wanted: SearchSpec | DataFrame,
    landed_details: DataFrame,
    site: Site,
    *,
    landed_pages: DataFrame | None = None,
    until: date | None = None,
    limit: int | None = None,
    scraped_at: str | None = None,
    keep_html: bool = False,
    config_hash: str | None = None,
    project_metadata: Mapping[str, object] | None = None,
) -> DataFrame:
    """Build or resume the corpus that a specification or a list of references asks for.

    A ``SearchSpec`` runs its months, from ``start`` to its end or ``until``, over the landed
    pages; a table with a column ``reference`` needs no pages. The metadata is stamped with the
    specification's digest, unless a caller has its own, and with the project's description. The recorded scope
    is ``active`` for the exact list of active types. Returns the run's row of counters.
    """
    corpus = scan_snapshot(spark, corpus_root(root))
    refs, windows = pending_refs(spark, root).drop("dataset"), pending_windows(spark, root).drop("dataset")
    common = {"limit": limit, "scraped_at": scraped_at, "keep_html": keep_html}
    if isinstance(wanted, SearchSpec):
        end = wanted.end or until
        if landed_pages is None or end is None:
            raise ValueError("a search needs landed pages, and an end: give until where the specification has none")
        requested = stage(month_windows(bounds(spark, wanted.start, end)), "requested")
        run = run_windows(corpus, landed_pages, landed_details, requested, windows, refs, site, wanted, **common)
        scope = recorded_scope(wanted.document_types)
        digest = hashlib.sha256(repr(wanted).encode()).hexdigest()
    else:
        run = run_fixed(corpus, wanted, landed_details, site, pending=windows, ref_ledger=refs, **common)
        scope, digest = "all", None
    summary = save(spark, root, corpus, run, site.language)
    row = metadata_row(
        scan_snapshot(spark, corpus_root(root)), pending_windows(spark, root), pending_refs(spark, root),
        scope=scope, config_hash=config_hash or digest, last_run=scraped_at, project_metadata=project_metadata,
    )
    describe(spark, root, row)
    return summary


def audit_dataset(
    spark: SparkSession, root: str, remote: DataFrame, since: date, until: date, granularity: str = "month"
) -> DataFrame:
    """Windows of a range with reported and stored counts; nothing stored is changed.

    ``remote`` (date_from, date_to, api_count) holds what the source reports for the dataset's scope.
    Stored rows are counted from the parts' counts per day, no rows are read.
    """
    windows = calendar_windows(bounds(spark, since, until), granularity)
    return reconcile_days(windows, remote, stored_days(spark, corpus_root(root)))


def repair_dataset(
    spark: SparkSession,
    root: str,
    audit: DataFrame,
    landed_pages: DataFrame,
    landed_details: DataFrame,
    remote_after: DataFrame,
    verification_pages: DataFrame,
    site: Site,
    *,
    scraped_at: str | None = None,
) -> DataFrame:
    """Repair the deficient windows of an audit and store what was added; returns them before and after."""
    corpus = scan_snapshot(spark, corpus_root(root))
    scope = stored_scope(spark, f"{root}/metadata")
    repair = audit_repair(
        corpus, audit, landed_pages, landed_details, remote_after, verification_pages, site,
        SearchSpec(language=site.language, document_types=scope_types(scope)),
        pending=pending_windows(spark, root).drop("dataset"), ref_ledger=pending_refs(spark, root).drop("dataset"),
        days=stored_days(spark, corpus_root(root)), scraped_at=scraped_at,
    )
    judged = stage(repair.windows, "repaired")
    save(spark, root, corpus, repair.run, site.language)
    row = metadata_row(scan_snapshot(spark, corpus_root(root)), pending_windows(spark, root), pending_refs(spark, root), scope=scope, last_run=scraped_at)
    describe(spark, root, row)
    return judged
