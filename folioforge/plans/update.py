"""Top-up jobs: landed payloads and pending work in, corpus rows and ledgers out.

Each job is one set-based pass over all windows. Failed windows are found first and
left out of the merge; ledgers are derived from what was merged, so work that was not
finished stays pending.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.text import document_id, normalize_ref, record_language
from folioforge.operators import ledgers as L
from folioforge.operators.merge import first_wins, keep_last, may_match, new_documents
from folioforge.operators.ordered import canary_limit
from folioforge.operators.records import (
    flatten_record,
    normalize_schema,
    rebuild_retry_summary,
)
from folioforge.operators.windows import month_windows, overlap_range
from folioforge.schema import REF_LEDGER_SCHEMA, SearchSpec, Site, scope_types
from folioforge.session import stage
from folioforge.sources.landed import (
    COMPLETE,
    FAILED,
    OK,
    PERMANENTLY_EMPTY,
    TRANSIENT,
    VARIANT,
    WINDOW,
    page_facts,
    page_summaries,
    parse_pages,
    read_details,
    search_ends,
    selected_summaries,
)
from folioforge.sources.sinks import append_corpus, replace_rows

# What a batch keeps beside the corpus columns.
BATCH_COLUMNS = ("requested_id", "outcome", "reference_key", "summary_json")
# Where a row stood in the queue: later rows win over earlier ones.
ARRIVAL = ("queue_key", "page_key", "pos")


@dataclass(frozen=True)
class Batch:
    """Rows made from summaries, and what happened to each reference."""

    rows: DataFrame  # corpus columns, requested_id, outcome, reference_key, summary_json
    refs: DataFrame  # reference, outcome, summary_json (of those that stay pending)


@dataclass(frozen=True)
class Run:
    """Everything a run produces; nothing is written into the corpus yet."""

    rows: DataFrame  # corpus columns, batch columns and arrival columns
    windows: DataFrame  # date_from, date_to, status, listed, additions
    window_ledger: DataFrame
    ref_ledger: DataFrame
    summary: DataFrame  # one row


def wanted_details(details: DataFrame, staged: DataFrame, language: str = "en") -> DataFrame:
    """The landed details that some staged summaries may ask for, and few others.

    Only their bodies are parsed. They are told apart where they are scanned, however many
    summaries there are: a body is never shuffled, the join with the summaries moves plain fields.
    """
    keys = staged.select(
        F.col("ref_code").alias("reference"),
        record_language(F.col("language_code"), F.lit(language)).alias("language"),
    )
    return may_match(details, keys, ["reference", "language"])


def attach_detail(
    summaries: DataFrame, details: DataFrame, language: str = "en", keep_html: bool = False
) -> DataFrame:
    """Each summary with the detail landed for its reference and language, if any.

    A summary without a landed detail counts as a transient failure.
    """
    keyed = summaries.withColumn(
        "_language", record_language(F.col("language_code"), F.lit(language))
    )
    landed = read_details(details, keep_html).select(
        F.col("reference").alias("ref_code"), F.col("language").alias("_language"), "outcome", "detail"
    )
    joined = keyed.join(landed, ["ref_code", "_language"], "left").drop("_language")
    return joined.withColumn("outcome", F.coalesce("outcome", F.lit(TRANSIENT)))


def _pending_summary() -> Column:
    """The summary of a reference that is asked for again; a settled one has no use for it."""
    return F.when(F.col("outcome") == TRANSIENT, F.col("summary_json"))


def process_batch(
    summaries: DataFrame,
    details: DataFrame,
    site: Site,
    *,
    scraped_at: str | None = None,
    keep_html: bool = False,
    carry: tuple[str, ...] = (),
) -> Batch:
    """Full or partial rows for summaries, and the outcome per reference."""
    attached = attach_detail(summaries, details, site.language, keep_html)
    rows = flatten_record(
        attached.withColumns({"reference_key": F.col("ref_code"), "summary_json": _pending_summary()}),
        site,
        scraped_at=scraped_at,
        carry=(*BATCH_COLUMNS, *carry),
    )
    staged = stage(rows, "batch")
    refs = staged.select(F.col("reference_key").alias("reference"), "outcome", "summary_json")
    return Batch(staged, refs)


def retry_pass(
    ledger: DataFrame,
    corpus: DataFrame,
    details: DataFrame,
    site: Site,
    *,
    scraped_at: str | None = None,
    keep_html: bool = False,
) -> Batch:
    """Resolve ledger references against newly landed details.

    Outcomes: ``stale`` (stored in full meanwhile), ``ok`` (recovered),
    ``permanently_empty``, or ``transient`` (stays pending). Rows come only from the
    two middle ones; they replace the partial rows of their documents.
    """
    latest = L.ledger_latest(ledger, corpus)
    rebuilt = rebuild_retry_summary(ledger, latest)
    # A detail is asked for under the ledger's reference, whatever the summary says.
    entries = stage(
        rebuilt.withColumn("own_ref", F.col("ref_code")).withColumn("ref_code", F.col("reference")),
        "retry-entries",
    )
    landed = wanted_details(details, entries, site.language)
    attached = attach_detail(entries, landed, site.language, keep_html).withColumn(
        "outcome", F.when(F.col("already_complete"), "stale").otherwise(F.col("outcome"))
    ).withColumn("summary_json", _pending_summary())
    rows = flatten_record(
        attached.withColumn("ref_code", F.col("own_ref")).withColumnRenamed("reference", "reference_key"),
        site,
        scraped_at=scraped_at,
        carry=BATCH_COLUMNS,
    )
    staged = stage(rows, "retry")
    refs = staged.select(F.col("reference_key").alias("reference"), "outcome", "summary_json")
    return Batch(staged.where(F.col("outcome").isin(OK, PERMANENTLY_EMPTY)), refs)


def ledger_after(ledger: DataFrame, *batches: DataFrame) -> DataFrame:
    """The reference ledger after some batches of ``(reference, outcome, summary_json)``.

    The last batch that saw a reference decides: a transient outcome keeps it pending,
    any other one settles it. One aggregate by reference covers all batches.
    """
    columns = ("reference", "outcome", "summary_json")
    seen = ledger.withColumn("outcome", F.lit(TRANSIENT)).select(*columns, F.lit(0).alias("step"))
    for step, refs in enumerate(batches, start=1):
        seen = seen.unionByName(refs.select(*columns, F.lit(step).alias("step")))
    last = seen.groupBy("reference").agg(
        F.max_by(F.struct("outcome", "summary_json"), "step").alias("last")
    )
    return last.where(F.col("last.outcome") == TRANSIENT).select("reference", "last.summary_json")


def search_queue(
    queue: DataFrame, landed_pages: DataFrame, search: SearchSpec
) -> tuple[DataFrame, DataFrame]:
    """Window outcomes and the summaries of the windows that were read completely.

    Returned are ``(date_from, date_to, queue_key, status)`` and one row per summary, without
    its texts, with its place in the queue. A window is complete when each of the search's values was
    read to its end there; pages of other variants are ignored, they can't stand in for one
    that didn't land. A window that lists a summary without reference has failed.

    Totals count what a response lists, whatever its type: a window is read whole before its
    summaries are cut down to the types asked for.
    """
    expected = F.sequence(F.lit(0), F.lit(len(search.search_values()) - 1))
    asked = stage(queue.withColumn("variant_no", F.explode(expected)), "asked")
    wanted = landed_pages.join(asked.select(*VARIANT), VARIANT, "left_semi")
    pages = stage(parse_pages(wanted, whole=False), "pages")
    judged = search_ends(page_facts(pages)).select(
        *VARIANT, "last_page", (F.col("complete") & ~F.col("blank_reference")).alias("read")
    )
    of_window = W.partitionBy(*WINDOW)
    variants = stage(
        asked.join(judged, VARIANT, "left").withColumn(
            "usable", F.bool_and(F.coalesce("read", F.lit(False))).over(of_window)
        ),
        "variants",
    )
    placed = variants.groupBy(*WINDOW, "queue_key").agg(
        F.when(F.bool_and("usable"), COMPLETE).otherwise(FAILED).alias("status")
    )
    read = variants.where("usable").select(*VARIANT, "queue_key", "last_page")
    listed = page_summaries(pages).join(read, VARIANT).where(F.col("page_no") <= F.col("last_page"))
    if search.document_types:
        listed = listed.where(F.upper(F.trim("type_code")).isin(*search.document_types))
    return placed, listed.drop("last_page")


def run_windows(
    corpus: DataFrame,
    landed_pages: DataFrame,
    landed_details: DataFrame,
    requested: DataFrame,
    pending: DataFrame,
    ref_ledger: DataFrame,
    site: Site,
    search: SearchSpec,
    *,
    limit: int | None = None,
    retry_pending: bool = True,
    retry_details: bool = True,
    scraped_at: str | None = None,
    keep_html: bool = False,
) -> Run:
    """Process the window queue: search, add what is new, settle both ledgers.

    ``search`` says which values each window was searched for, and which types are wanted; a
    window for which one didn't land has failed and stays in the ledger.
    ``requested`` and ``pending`` are (position, date_from, date_to); the landed tables
    hold the responses of this run.
    """
    spark = corpus.sparkSession
    ledger = ref_ledger.select("reference", "summary_json")
    if retry_details:
        retried = retry_pass(
            ledger, corpus, landed_details, site, scraped_at=scraped_at, keep_html=keep_html
        )
        retried_rows, retried_refs = retried.rows, retried.refs
    else:
        retried_refs = spark.createDataFrame([], "reference string, outcome string, summary_json string")
        retried_rows = None

    queue = L.window_queue(pending, requested, retry_pending)
    placed, listed = search_queue(queue, landed_pages, search)

    order = ["queue_key", "variant_no", "page_no", "pos"]
    unique = stage(first_wins(listed, order, "requested_id"), "unique")
    held = corpus.select("document_id")
    if retried_rows is not None:
        held = held.unionByName(retried_rows.select("document_id"))
    missing = new_documents(unique, held)
    missing = missing.withColumn(
        "page_key",
        F.col("variant_no").cast("bigint") * F.lit(1_000_000_000) + F.col("page_no"),
    )
    selected, progress = missing, None
    if limit is not None:
        selected, progress = canary_limit(stage(missing, "missing"), limit)
    selected = stage(selected, "selected")

    # Few windows: the join with them is a broadcast, and no page is shuffled for it.
    complete = placed.where(F.col("status") == COMPLETE).select(*WINDOW)
    batch = process_batch(
        selected_summaries(landed_pages.join(complete, WINDOW, "left_semi"), selected),
        wanted_details(landed_details, selected, site.language),
        site,
        scraped_at=scraped_at,
        keep_html=keep_html,
        carry=ARRIVAL,
    )
    windows = stage(window_outcomes(placed, unique, batch.rows, progress, limit), "windows")
    window_ledger = L.resolve_windows(
        L.window_ledger(pending, requested), windows.where(F.col("status") == COMPLETE)
    )

    rows = batch.rows
    if retried_rows is not None:
        first = {name: F.lit(-1).cast(rows.schema[name].dataType) for name in ARRIVAL}
        rows = retried_rows.withColumns(first).unionByName(rows)
    # Documents that are stored in full by now need no retry, whoever stored them.
    held = corpus.select("document_id", "detail_ok").unionByName(
        rows.select("document_id", "detail_ok")
    )
    pending_refs = L.unresolved_refs(ledger_after(ledger, retried_refs, batch.refs), held)
    ledger_now = stage(pending_refs, "ref-ledger")

    summary = run_summary(windows, batch.refs, retried_refs, window_ledger, ledger_now)
    return Run(rows, windows, window_ledger, ledger_now, summary)


def window_outcomes(
    placed: DataFrame,
    unique: DataFrame,
    added: DataFrame,
    progress: DataFrame | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Per queued window: status, documents listed for the first time, documents added.

    A window that a limit cut short, or that it kept from being read at all, is
    ``pending``; it does not count as an attempt.
    """
    listed = unique.groupBy("queue_key").agg(F.count("*").alias("listed"))
    additions = added.groupBy("queue_key").agg(F.count("*").alias("additions"))
    joined = (
        placed.join(listed, "queue_key", "left")
        .join(additions, "queue_key", "left")
        .na.fill(0, ["listed", "additions"])
    )
    status = F.col("status")
    if progress is not None:
        cut = progress.where(~F.col("complete")).select("queue_key", F.lit(True).alias("cut"))
        joined = joined.join(cut, "queue_key", "left")
        joined = stage(joined, "progress")
        reached = joined.agg(
            F.sum("additions").alias("taken"), F.max(F.when(F.col("additions") > 0, F.col("queue_key"))).alias("last")
        ).first()
        stopped = F.lit((reached.taken or 0) >= limit) & (F.col("queue_key") > F.lit(reached["last"]))
        beyond = F.col("cut").isNotNull() | stopped
        status = F.when(F.coalesce(beyond, F.lit(False)), "pending").otherwise(status)
    return joined.select(*WINDOW, "queue_key", status.alias("status"), "listed", "additions")


def run_summary(
    windows: DataFrame,
    batch_refs: DataFrame,
    retried_refs: DataFrame,
    window_ledger: DataFrame,
    ref_ledger: DataFrame,
) -> DataFrame:
    """One row of counters for a run."""
    outcomes = batch_refs.select(F.lit("new").alias("kind"), "outcome").unionByName(
        retried_refs.select(F.lit("retry").alias("kind"), "outcome")
    )
    kind, outcome = F.col("kind"), F.col("outcome")
    counted = outcomes.agg(
        F.count_if(kind == "new").alias("new_documents"),
        F.count_if((kind == "retry") & (outcome == OK)).alias("recovered_details"),
        F.count_if(outcome == PERMANENTLY_EMPTY).alias("permanently_empty_details"),
    )
    by_status = windows.agg(
        F.struct(*[F.count_if(F.col("status") == s).alias(s) for s in (COMPLETE, FAILED, "pending")])
    ).scalar()
    left = window_ledger.agg(F.count("*").alias("n"))
    refs = ref_ledger.agg(F.count("*").alias("n"))
    return counted.select(
        "*",
        by_status[COMPLETE].alias("completed_windows"),
        by_status[FAILED].alias("failed_window_attempts"),
        left.scalar().alias("pending_windows"),
        refs.scalar().alias("pending_refs"),
        (by_status["pending"] > 0).alias("limit_reached"),
    ).withColumn("partial", (F.col("pending_windows") > 0) | (F.col("pending_refs") > 0))


def touched_ids(run: Run) -> DataFrame:
    """Identifiers whose stored row a run may replace.

    Rows of new documents were checked against the corpus under the identifier they were
    requested by. What remains are retried rows, and documents whose detail names them
    differently; both are few, and as a staged table their size is known.
    """
    retried = F.col("queue_key") < 0
    renamed = F.col("document_id") != F.col("requested_id")
    return stage(run.rows.where(retried | renamed).select("document_id").distinct(), "touched")


def run_rows(run: Run, touched: DataFrame) -> DataFrame:
    """Corpus rows of a run, the latest one per document.

    Only touched documents can occur twice, and hardly any does; all other rows pass without a
    shuffle. Which ones do is found by their identifiers.
    """
    rows = normalize_schema(run.rows, keep=ARRIVAL)
    found = rows.select("document_id").join(touched, "document_id", "left_semi")
    repeated = found.groupBy("document_id").agg(F.count("*").alias("n")).where("n > 1").select("document_id")
    repeated = stage(repeated, "repeated")
    if repeated.isEmpty():
        return rows.drop(*ARRIVAL)
    single = rows.join(repeated, "document_id", "left_anti")
    several = keep_last(rows.join(repeated, "document_id", "left_semi"), list(ARRIVAL))
    return single.unionByName(several).drop(*ARRIVAL)


def merged_corpus(corpus: DataFrame, run: Run, touched: DataFrame | None = None) -> DataFrame:
    """The corpus after a run: recovered rows replace partial ones, new rows join."""
    touched = touched_ids(run) if touched is None else touched
    untouched = normalize_schema(corpus).join(touched, "document_id", "left_anti")
    return untouched.unionByName(run_rows(run, touched))


def save_run(corpus: DataFrame, run: Run, root: str) -> str:
    """Store a run in the corpus at ``root``, of which ``corpus`` is the latest snapshot.

    What is written follows from the run, also where it replaces rows: they are listed as
    replaced, and stay where they are. Of the corpus, identifiers and dates are read.
    """
    touched = touched_ids(run)
    replaced = stage(replaced_rows(corpus, touched), "replaced")
    rows = run_rows(run, touched)
    if replaced.isEmpty():
        return append_corpus(rows, root)
    return replace_rows(rows, replaced, root)


def replaced_rows(corpus: DataFrame, touched: DataFrame) -> DataFrame:
    """(document_id, date) of the stored rows that a run replaces."""
    return corpus.select("document_id", "date").join(touched, "document_id", "left_semi")


def update_scope(recorded: str | None, requested: str | None = None, full: bool = False) -> str:
    """Scope of an update. A dataset keeps the scope it was created with.

    ``recorded`` is the scope of an existing dataset, None when there is none yet.
    """
    if requested is not None:
        scope_types(requested)
        if not full:
            raise ValueError("a scope can only be chosen for a full update")
    if not full:
        if recorded is None:
            raise ValueError("there is no dataset to update; ask for a full update")
        return recorded
    chosen = requested or "active"
    if recorded not in (None, chosen):
        raise ValueError(f"the dataset has scope {recorded}; {chosen} needs a new dataset")
    return chosen


def update_windows(corpus: DataFrame, until: date, since: date | None = None, full: bool = False) -> DataFrame:
    """Month windows of a top-up, newest first."""
    return month_windows(overlap_range(corpus, until, since, full))


def run_fixed(
    corpus: DataFrame,
    references: DataFrame,
    details: DataFrame,
    site: Site,
    *,
    pending: DataFrame | None = None,
    ref_ledger: DataFrame | None = None,
    limit: int | None = None,
    scraped_at: str | None = None,
    keep_html: bool = False,
) -> Run:
    """Build or resume a corpus of listed references: retry what is pending, then add what is missing.

    ``references`` are taken in the order of ``position``, if they have one, else by reference;
    ``limit`` bounds how many are added. Unresolved ones stay partial and pending. Windows have no
    part in it: their ledger, ``pending``, passes unchanged. Only details of selected and pending
    references are parsed.
    """
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    spark = corpus.sparkSession
    if ref_ledger is None:
        ref_ledger = spark.createDataFrame([], REF_LEDGER_SCHEMA)
    if pending is None:
        pending = spark.createDataFrame([], "position bigint, date_from date, date_to date")
    ledger = ref_ledger.select("reference", "summary_json")
    retried = retry_pass(ledger, corpus, details, site, scraped_at=scraped_at, keep_html=keep_html)

    place = F.col("position").cast("bigint") if "position" in references.columns else F.lit(0).cast("bigint")
    listed = references.select(normalize_ref(F.col("reference")).alias("ref_code"), place.alias("queue_key"))
    wanted = listed.groupBy("ref_code").agg(F.min("queue_key").alias("queue_key"))
    wanted = wanted.withColumn("requested_id", document_id(F.col("ref_code")))
    held = corpus.select("document_id").unionByName(retried.rows.select("document_id"))
    missing = stage(new_documents(wanted, held), "missing")
    chosen = missing if limit is None else missing.orderBy("queue_key", "ref_code").limit(limit)
    unknown = F.lit(None).cast("string")
    selected = stage(
        chosen.select(
            "requested_id",
            "ref_code",
            *[unknown.alias(c) for c in ("event_date", "title", "lead_text", "type_code", "type_name")],
            F.lit(site.language).alias("language_code"),
            F.to_json(
                F.struct(F.col("ref_code").alias("refCode"), F.lit(site.language).alias("languageCode"))
            ).alias("summary_json"),
            "queue_key",
            F.lit(0).cast("bigint").alias("page_key"),
            F.lit(0).alias("pos"),
        ),
        "selected",
    )
    batch = process_batch(
        selected, wanted_details(details, selected, site.language), site,
        scraped_at=scraped_at, keep_html=keep_html, carry=ARRIVAL,
    )
    first = {name: F.lit(-1).cast(batch.rows.schema[name].dataType) for name in ARRIVAL}
    rows = retried.rows.withColumns(first).unionByName(batch.rows)
    now = corpus.select("document_id", "detail_ok").unionByName(rows.select("document_id", "detail_ok"))
    ledger_now = stage(L.unresolved_refs(ledger_after(ledger, retried.refs, batch.refs), now), "ref-ledger")
    windows = spark.createDataFrame([], "date_from date, date_to date, queue_key bigint, status string, listed bigint, additions bigint")
    window_ledger = pending.select(*WINDOW, "position")
    summary = run_summary(windows, batch.refs, retried.refs, window_ledger, ledger_now)
    if limit is not None:
        summary = summary.withColumn("limit_reached", F.lit(missing.count() > limit))
    return Run(rows, windows, window_ledger, ledger_now, summary)
