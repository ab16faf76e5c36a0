"""Landed payloads -> rows: search pages, counts and detail bodies.

A landed table holds one row per request of one enumeration (``batch_id``): callers
select a batch before they pass the frame in, or reduce several with ``latest_answers``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import variants as V
from folioforge.functions.html import html_to_text
from folioforge.functions.text import contact_label, document_id, join_nonempty, nullable, strip
from folioforge.operators.merge import keep_last, may_match
from folioforge.operators.ordered import running_total
from folioforge.schema import SearchSpec

WINDOW = ["date_from", "date_to"]
VARIANT = [*WINDOW, "variant_no"]
PAGE = [*VARIANT, "page_no"]

# Key names of the landed payloads.
ITEMS_KEY = "docuLanguageListResources"
TOTAL_KEY = "totalNumber"

OK, PERMANENTLY_EMPTY, TRANSIENT = "ok", "permanently_empty", "transient"
COMPLETE, FAILED = "complete", "failed"


def http_ok(status: Column) -> Column:
    """False for an error status and for a request that got no response at all."""
    return F.coalesce(status < 400, F.lit(False))


def _summary(item: Column) -> Column:
    """The fields of one listed summary, as far as they are there."""
    reference = strip(F.coalesce(V.text(item, "refCode"), F.lit("")))
    return F.struct(
        document_id(reference).alias("requested_id"),
        reference.alias("ref_code"),
        V.text(item, "eventDate").alias("event_date"),
        V.text(item, "title").alias("title"),
        V.text(item, "leadText").alias("lead_text"),
        V.text(item, "docutype", "code").alias("type_code"),
        V.text(item, "docutype", "description").alias("type_name"),
        V.text(item, "languageCode").alias("language_code"),
        F.to_json(item).alias("summary_json"),
    )


def _listing(item: Column) -> Column:
    """What tells a listed summary from others, without its texts."""
    reference = strip(F.coalesce(V.text(item, "refCode"), F.lit("")))
    return F.struct(
        document_id(reference).alias("requested_id"),
        reference.alias("ref_code"),
        V.text(item, "docutype", "code").alias("type_code"),
        V.text(item, "languageCode").alias("language_code"),
    )


def parse_pages(landed: DataFrame, whole: bool = True) -> DataFrame:
    """One row per page: is it usable, which total it reports, which summaries it lists.

    Every body is parsed once; unless ``whole``, summaries are read without their texts. ``total`` is null when the page reports something that is
    not a number; a page without the key reports 0 and is flagged by ``total_missing``.
    ``summaries`` holds the listed objects; a page has a limited number of them.
    """
    answered = F.when(http_ok(F.col("http_status")), strip(F.col("body")))
    parsed = landed.select(*PAGE, answered.alias("body")).select(
        *PAGE, V.parse_object(F.col("body")).alias("payload")
    )
    payload = F.col("payload")
    listed = parsed.select(
        *PAGE,
        V.items(payload, ITEMS_KEY).alias("listed"),
        (payload.isNotNull() & ~V.has_key(payload, TOTAL_KEY)).alias("total_missing"),
        F.try_variant_get(payload, f"$.{TOTAL_KEY}", "bigint").alias("total"),
    )
    objects = F.filter("listed", V.is_object)
    return listed.select(
        *PAGE,
        F.col("listed").isNotNull().alias("page_ok"),
        F.when(F.col("total_missing"), F.lit(0).cast("bigint")).otherwise(F.col("total")).alias("total"),
        F.coalesce("total_missing", F.lit(False)).alias("total_missing"),
        F.coalesce(F.array_size("listed"), F.lit(0)).alias("n_listed"),
        F.transform(objects, _summary if whole else _listing).alias("summaries"),
    )


def page_summaries(pages: DataFrame) -> DataFrame:
    """One row per listed summary, ``pos`` giving its place on the page."""
    exploded = pages.select(*PAGE, F.posexplode("summaries").alias("pos", "summary"))
    return exploded.select(*PAGE, "pos", "summary.*")


def ingest_search_pages(landed: DataFrame) -> DataFrame:
    """Every object listed on a usable landed page, in page order."""
    return page_summaries(parse_pages(landed))


def selected_summaries(landed: DataFrame, selected: DataFrame) -> DataFrame:
    """The whole summaries at the places that ``selected`` names, with its further columns.

    Queues are cut down by identifiers and places. Texts are read here, for what is left of them;
    others aren't moved, however many places there are.
    """
    place = [*PAGE, "pos"]
    listed = may_match(ingest_search_pages(landed), selected, place)
    further = [c for c in selected.columns if c not in listed.columns]
    return listed.join(selected.select(*place, *further), place)


def page_facts(pages: DataFrame) -> DataFrame:
    """The few numbers per page that decide about completeness."""
    return pages.select(
        *PAGE,
        "page_ok",
        F.col("total").isNotNull().alias("total_ok"),
        "total",
        "n_listed",
        F.coalesce(F.array_size("summaries"), F.lit(0)).cast("bigint").alias("n_items"),
        F.coalesce(F.exists("summaries", lambda s: s["ref_code"] == ""), F.lit(False)).alias("has_blank"),
    )


def search_ends(facts: DataFrame) -> DataFrame:
    """Per window and search variant: where reading ends, and whether it got there.

    A variant ends at its first empty page, or at the page where the items read so far
    reach the total that this page reports. An unusable or missing page before the end
    makes it incomplete; whatever was landed after the end is ignored.
    ``blank_reference`` tells of a summary without reference on the pages read.

    The facts are read twice; stage them, or the pages they come from, beforehand.
    """
    counted = running_total(
        facts.withColumn("_one", F.lit(1)),
        keys=VARIANT,
        order="page_no",
        totals={"items_so_far": "n_items", "pages_so_far": "_one"},
    )
    page = F.col("page_no")
    empty = F.col("page_ok") & (F.col("n_listed") == 0)
    bad = ~F.col("page_ok") | (~empty & ~F.col("total_ok"))
    ends = empty | (~bad & (F.col("items_so_far") >= F.col("total")))
    marked = counted.withColumns({"_bad": bad, "_ends": ends})

    def at_end(column: str) -> Column:
        return F.coalesce(F.min_by(column, F.when(F.col("_ends"), page)), F.max(column))

    found = marked.groupBy(*VARIANT).agg(
        F.min(F.when(F.col("_ends"), page)).alias("last_page"),
        F.min(F.when(F.col("_bad"), page)).alias("first_bad"),
        F.min(F.when(F.col("has_blank"), page)).alias("first_blank"),
        at_end("pages_so_far").alias("pages"),
        at_end("items_so_far").alias("items"),
    )
    last = F.col("last_page")
    whole = (F.col("pages") == last) & F.coalesce(F.col("first_bad") > last, F.lit(True))
    return found.select(
        *VARIANT,
        "last_page",
        "pages",
        "items",
        F.coalesce(whole, F.lit(False)).alias("complete"),
        F.coalesce(F.col("first_blank") <= F.coalesce(last, F.col("first_blank")), F.lit(False)).alias("blank_reference"),
    )


def page_completeness(facts: DataFrame, search: SearchSpec) -> DataFrame:
    """Per window: ``complete`` when every value of the search was read to its end.

    ``variant_no`` numbers the values; variants beyond them are left out.
    """
    values = len(search.search_values())
    landed = F.count("*") == values
    return search_ends(facts.where(F.col("variant_no").between(0, values - 1))).groupBy(*WINDOW).agg(
        F.when(F.bool_and("complete") & landed, COMPLETE).otherwise(FAILED).alias("status"),
        F.sum("pages").alias("pages"),
        F.sum("items").alias("items"),
    )


def latest_answers(landed: DataFrame, request: list[str]) -> DataFrame:
    """The newest answer to each request, for tables that hold several batches."""
    return keep_last(landed, ["batch_id"], request)


def require_reference(summaries: DataFrame) -> DataFrame:
    """Per window: does any listed summary lack its reference? One such fails it."""
    return summaries.groupBy(*WINDOW).agg(
        F.bool_or(F.col("ref_code") == "").alias("blank_reference")
    )


def ingest_counts(landed: DataFrame) -> DataFrame:
    """Window and reported total; null marks a count that could not be read."""
    pages = parse_pages(
        landed.withColumns({"variant_no": F.lit(0), "page_no": F.lit(1)})
    )
    return pages.select(*WINDOW, F.when(F.col("page_ok"), F.col("total")).alias("api_count"))


def _outcome(status: Column, trimmed: Column, payload: Column) -> Column:
    return (
        F.when(~http_ok(status), TRANSIENT)
        .when(F.coalesce(trimmed, F.lit("")) == "", PERMANENTLY_EMPTY)
        .when(payload.isNull() | trimmed.rlike(r"^\{\s*\}$"), TRANSIENT)
        .otherwise(OK)
    )


def classify_detail(status: Column, body: Column) -> Column:
    """``ok``, ``permanently_empty`` (answered with nothing) or ``transient``."""
    return _outcome(status, strip(body), V.parse_object(strip(body)))


def detail_payloads(details: DataFrame) -> DataFrame:
    """Details with their outcome; the parsed ``payload`` is kept for ``ok`` only."""
    kept = [c for c in details.columns if c not in ("body", "http_status")]
    trimmed = details.select(*kept, "http_status", strip(F.col("body")).alias("body"))
    parsed = trimmed.withColumn("payload", V.parse_object(F.col("body")))
    judged = parsed.select(
        *kept,
        "payload",
        _outcome(F.col("http_status"), F.col("body"), F.col("payload")).alias("outcome"),
    )
    return judged.withColumn("payload", F.when(F.col("outcome") == OK, F.col("payload")))


def read_details(details: DataFrame, keep_html: bool = False) -> DataFrame:
    """Details with their outcome and, for ``ok``, the fields of a record as ``detail``.

    Bodies are reduced to plain fields here, where they are scanned, so that a join
    moves the text of a document and not its JSON and HTML.
    """
    judged = detail_payloads(details)
    payload = F.col("payload")
    html = V.text(payload, "docuLanguageResource", "htmlContent")
    contacts = F.transform(
        V.items(payload, "contactsResource"),
        lambda c: contact_label(V.text(c, "firstName"), V.text(c, "lastName"), V.text(c, "title")),
    )
    fields = F.struct(
        V.text(payload, "refCd").alias("reference"),
        V.text(payload, "docutypeResource", "code").alias("doc_type"),
        V.text(payload, "docutypeResource", "description").alias("doc_type_name"),
        V.text(payload, "docuLanguageResource", "title").alias("title"),
        nullable(V.text(payload, "docuLanguageResource", "subtitle")).alias("subtitle"),
        V.text(payload, "eventDate").alias("date"),
        nullable(V.text(payload, "publishDate")).alias("publish_datetime"),
        nullable(V.text(payload, "placeResource", "description")).alias("place"),
        nullable(V.text(payload, "originalLanguage")).alias("original_language"),
        join_nonempty(V.texts(payload, "commissionerResource", "shortDescription")).alias("commissioners"),
        join_nonempty(contacts).alias("spokespersons"),
        join_nonempty(V.texts(payload, "policiesResource", "description")).alias("policy_areas"),
        join_nonempty(V.texts(payload, "policiesResource", "code")).alias("policy_codes"),
        html_to_text(html).alias("full_text"),
        (nullable(html) if keep_html else F.lit(None).cast("string")).alias("html"),
    )
    kept = [c for c in judged.columns if c != "payload"]
    return judged.select(*kept, F.when(payload.isNotNull(), fields).alias("detail"))
