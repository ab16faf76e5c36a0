"""The corpus schema, its code dimensions and the small driver-side specs."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import types as T

# --- Fixed values (data format, lookup tables and constants) -----------------

CORPUS_COLUMNS = (
    "document_id",
    "reference",
    "doc_type",
    "doc_type_name",
    "title",
    "subtitle",
    "summary",
    "date",
    "publish_datetime",
    "place",
    "language",
    "original_language",
    "commissioners",
    "spokespersons",
    "policy_areas",
    "policy_codes",
    "full_text",
    "html",
    "url",
    "pdf_url",
    "detail_ok",
    "scraped_at",
)

LEGACY_RENAMES = {
    "reference_number": "reference",
    "document_type": "doc_type",
    "document_type_name": "doc_type_name",
    "publication_date": "date",
    "authors": "spokespersons",
}

ACTIVE_TYPES = ("IP", "SPEECH", "STATEMENT", "MEX", "READ", "AC", "QANDA", "FS", "INF")

KNOWN_TYPES = (
    "IP", "MEX", "SPEECH", "MEMO", "STATEMENT", "QANDA", "READ", "INF", "FS", "AC",
    "BIO", "PRES", "CJE", "PESC", "CES", "COR", "ECA", "EO", "BEI", "OLAF", "EDPS",
    "EPSO", "STAT", "P", "DOC", "AGENDA", "CLDR", "WM", "DN",
)

OTHER_INSTITUTION_TYPES = (
    "PRES", "CJE", "STAT", "BEI", "CES", "COR", "ECA", "EO", "OLAF", "EDPS", "EPSO",
    "PESC", "DOC",
)

EXPORT_STEMS = {
    "IP": "press-releases",
    "MEX": "daily-news",
    "SPEECH": "speeches",
    "MEMO": "memoranda",
    "STATEMENT": "statements",
    "QANDA": "questions-and-answers",
    "READ": "read-outs",
    "INF": "infringement-decisions",
    "FS": "factsheets",
    "AC": "news-articles",
}

TYPE_LABELS = {
    "IP": "Press release",
    "SPEECH": "Speech",
    "MEX": "Daily news (Midday Express)",
    "MEMO": "Memo / background note",
    "STATEMENT": "Statement",
    "QANDA": "Questions and answers",
    "READ": "Read-out",
    "INF": "Infringement decisions",
    "FS": "Factsheet",
    "AC": "News article",
    "BIO": "Spokesperson's briefing (legacy)",
    "P": "Early press note (legacy)",
    "PRES": "Council of the EU press release (legacy)",
    "CJE": "Court of Justice press release (legacy)",
    "PESC": "CFSP declaration (legacy)",
    "CES": "European Economic and Social Committee (legacy)",
    "COR": "Committee of the Regions (legacy)",
    "ECA": "Court of Auditors (legacy)",
    "EO": "European Ombudsman (legacy)",
    "BEI": "European Investment Bank (legacy)",
    "OLAF": "European Anti-Fraud Office (legacy)",
    "EDPS": "European Data Protection Supervisor (legacy)",
    "EPSO": "European Personnel Selection Office (legacy)",
    "STAT": "Eurostat release (legacy)",
    "DOC": "European Council conclusions digest (legacy)",
    "AGENDA": "Weekly agenda (legacy)",
    "CLDR": "Calendar (legacy)",
    "WM": "Week in the media (legacy)",
    "DN": "Daily news bulletin (legacy)",
    "COUNTRY": "Country information (legacy)",
    "ETW": "Enterprise Europe Network (legacy)",
    "TRANS": "Transcript (legacy)",
}

# Completeness report: corpus column (or its predecessor name) -> printed name.
COMPLETENESS_FIELDS = (
    (("full_text",), "Full text"),
    (("subtitle",), "Subtitle"),
    (("summary",), "Summary"),
    (("policy_areas",), "Policy areas"),
    (("spokespersons", "authors"), "Spokespersons"),
    (("commissioners",), "Commissioners"),
    (("place",), "Place"),
)

MANIFEST_FIELDS = ("version", "cutoff", "url", "sha256", "size_bytes")
SCOPES = ("active", "all")
ARCHIVE_START = date(1975, 1, 1)
OVERLAP_DAYS = 3
NO_LABEL = "—"
MISSING_TYPE = "(missing)"
OTHER_STEM = "other"
COMMISSION_SOURCE = "European Commission"
OTHER_SOURCE = "Other EU institutions (RAPID legacy)"

# --- Schemas -----------------------------------------------------------------

CORPUS_SCHEMA = T.StructType(
    [
        T.StructField(name, T.BooleanType() if name == "detail_ok" else T.StringType())
        for name in CORPUS_COLUMNS
    ]
)

LANDED_PAGES_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("date_from", T.DateType()),
        T.StructField("date_to", T.DateType()),
        T.StructField("variant_no", T.IntegerType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

LANDED_COUNTS_SCHEMA = T.StructType(
    [f for f in LANDED_PAGES_SCHEMA.fields if f.name not in ("variant_no", "page_no")]
)

LANDED_DETAILS_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("reference", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("http_status", T.IntegerType()),
        T.StructField("body", T.StringType()),
    ]
)

WINDOW_LEDGER_SCHEMA = "dataset string, position bigint, date_from date, date_to date"
REF_LEDGER_SCHEMA = "dataset string, reference string, summary_json string"


# --- Driver-side specs -------------------------------------------------------


@dataclass(frozen=True)
class Site:
    """Where published documents live; used only to fill the two link columns."""

    base_url: str
    language: str = "en"


@dataclass(frozen=True)
class SearchSpec:
    """Filters of one sub-corpus: the three search lists are OR-ed together."""

    start: date = ARCHIVE_START
    end: date | None = None
    language: str | None = "en"
    document_types: tuple[str, ...] = ()
    keywords: tuple[str, ...] = ()
    commissioners: tuple[str, ...] = ()
    policy_areas: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.end is not None and self.start > self.end:
            raise ValueError("start must be on or before end")
        object.__setattr__(self, "document_types", normalize_type_codes(self.document_types))

    def search_values(self) -> tuple[tuple[str, str], ...]:
        """(field, value) of each search a window needs; landed pages number them ``variant_no`` from 0.

        Types are asked for together, the other lists value by value; without any, one search
        without a value covers a window.
        """
        lists = {"keyword": self.keywords, "commissioner": self.commissioners, "policy_area": self.policy_areas}
        return tuple((field, value) for field, values in lists.items() for value in values) or (("", ""),)


def normalize_type_codes(codes: str | Iterable[str] | None) -> tuple[str, ...]:
    """Trim and upper-case type codes; the word ``active`` stands for the active set."""
    if codes is None:
        return ()
    listed = [codes] if isinstance(codes, str) else list(codes)
    cleaned = tuple(str(code).strip().upper() for code in listed)
    if "ACTIVE" not in cleaned:
        return cleaned
    if set(cleaned) != {"ACTIVE"}:
        raise ValueError("'active' cannot be combined with other type codes")
    return ACTIVE_TYPES


def scope_types(scope: str) -> tuple[str, ...]:
    """Type codes a dataset scope is limited to; an empty tuple means no limit."""
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}, not {scope!r}")
    return ACTIVE_TYPES if scope == "active" else ()


def recorded_scope(document_types: tuple[str, ...]) -> str:
    """Scope a build records: ``active`` only for the exact active list, in order."""
    return "active" if tuple(document_types) == ACTIVE_TYPES else "all"
