"""Shaping rows: schema normalisation, migration and record flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.functions import variants as V
from folioforge.schema import (
    COMMISSION_SOURCE,
    CORPUS_SCHEMA,
    LEGACY_RENAMES,
    OTHER_INSTITUTION_TYPES,
    OTHER_SOURCE,
    Site,
)


ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _conformed(df: DataFrame, name: str, dtype: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(dtype).alias(name)
    if dtype == "boolean" and df.schema[name].dataType.typeName() != "boolean":
        return X.coerce_boolean(F.col(name)).alias(name)
    return F.col(name).cast(dtype).alias(name)


def normalize_schema(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the corpus columns, in order and typed; ``keep`` carries extra ones on."""
    fixed = [
        _conformed(df, field.name, field.dataType.simpleString()) for field in CORPUS_SCHEMA
    ]
    return df.select(*fixed, *keep)


def typed_view(corpus: DataFrame) -> DataFrame:
    """The corpus with typed dates and times, and lists as arrays; what is not a date or
    time becomes null. Comparisons on stored text and on this view can differ."""
    lists = ("commissioners", "spokespersons", "policy_areas", "policy_codes")
    return corpus.withColumns(
        {
            "date": F.col("date").try_cast("date"),
            "publish_datetime": F.col("publish_datetime").try_cast("timestamp"),
            "scraped_at": F.col("scraped_at").try_cast("timestamp"),
            **{name: X.split_list(F.col(name)) for name in lists},
        }
    )


def migrate_legacy(df: DataFrame) -> DataFrame:
    """Map a predecessor layout to today's names; a newer value wins where it is set."""
    columns = set(df.columns)
    if not columns & {*LEGACY_RENAMES, "keywords"}:
        return df
    renamed_to = {new: old for old, new in LEGACY_RENAMES.items() if old in columns}
    kept = [c for c in df.columns if c not in LEGACY_RENAMES and c != "keywords"]
    out = [
        F.coalesce(F.col(c), F.col(renamed_to[c])).alias(c) if c in renamed_to else F.col(c)
        for c in kept
    ]
    out += [F.col(old).alias(new) for new, old in renamed_to.items() if new not in columns]
    if "detail_ok" not in columns:
        has_text = F.coalesce(F.col("full_text"), F.lit("")) != "" if "full_text" in columns else F.lit(False)
        out.append(has_text.alias("detail_ok"))
    return df.select(*out)


def source_bucket(doc_type: Column) -> Column:
    """Publisher group of a type code; a missing code counts for the main publisher."""
    return F.when(doc_type.isin(*OTHER_INSTITUTION_TYPES), OTHER_SOURCE).otherwise(
        COMMISSION_SOURCE
    )


def flatten_record(
    attached: DataFrame,
    site: Site,
    *,
    scraped_at: str | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Corpus rows from summaries with their ``detail``, a struct that may be null.

    Every field falls back on its own: detail value, else summary value, else empty.
    A row without detail is a partial record with ``detail_ok`` false.
    """
    now = F.date_format(F.current_timestamp(), ISO_UTC)
    stamp = now if scraped_at is None else F.lit(scraped_at)
    reference = X.strip(X.first_filled(F.col("detail.reference"), F.col("ref_code")))
    named = attached.select(
        "*",
        reference.alias("_reference"),
        X.record_language(F.col("language_code"), F.lit(site.language)).alias("_language"),
    )
    language, doc_id = F.col("_language"), X.document_id(F.col("_reference"))
    return named.select(
        doc_id.alias("document_id"),
        F.col("_reference").alias("reference"),
        X.first_filled(F.col("detail.doc_type"), F.col("type_code")).alias("doc_type"),
        X.first_filled(F.col("detail.doc_type_name"), F.col("type_name")).alias("doc_type_name"),
        X.first_filled(F.col("detail.title"), F.col("title")).alias("title"),
        "detail.subtitle",
        X.nullable(F.col("lead_text")).alias("summary"),
        X.first_filled(F.col("detail.date"), F.col("event_date")).alias("date"),
        "detail.publish_datetime",
        "detail.place",
        language.alias("language"),
        "detail.original_language",
        "detail.commissioners",
        "detail.spokespersons",
        "detail.policy_areas",
        "detail.policy_codes",
        F.coalesce("detail.full_text", F.lit("")).alias("full_text"),
        "detail.html",
        X.detail_url(site.base_url, language, doc_id).alias("url"),
        X.pdf_url(site.base_url, language, doc_id, F.col("_reference")).alias("pdf_url"),
        F.col("detail").isNotNull().alias("detail_ok"),
        stamp.alias("scraped_at"),
        *carry,
    )


def rebuild_retry_summary(ledger: DataFrame, latest: DataFrame) -> DataFrame:
    """Ledger summaries completed from the stored row of the same document.

    ``ledger`` is (reference, summary_json), ``latest`` has one row per document. Only
    keys that are absent from the ledger are filled in: an explicit null stays null.
    """
    stored = latest.select(
        F.col("document_id").alias("requested_id"),
        *[
            F.col(c).alias(f"_{c}")
            for c in ("title", "date", "language", "summary", "doc_type", "doc_type_name", "detail_ok")
        ],
    )
    summary = F.col("_summary_object")

    def kept(column: str, fallback: Column, key: str, *path: str) -> Column:
        value = V.text(summary, *(path or (key,)))
        return F.when(V.has_key(summary, key), value).otherwise(fallback).alias(column)

    entries = ledger.select(
        "reference",
        "summary_json",
        X.document_id(F.col("reference")).alias("requested_id"),
        F.coalesce(V.parse_object(X.strip(F.col("summary_json"))), F.parse_json(F.lit("{}"))).alias(
            "_summary_object"
        ),
    )
    return entries.join(stored, "requested_id", "left").select(
        "reference",
        "requested_id",
        kept("ref_code", F.col("reference"), "refCode"),
        kept("event_date", F.col("_date"), "eventDate"),
        kept("title", F.col("_title"), "title"),
        kept("lead_text", F.col("_summary"), "leadText"),
        kept("type_code", F.col("_doc_type"), "docutype", "docutype", "code"),
        kept("type_name", F.col("_doc_type_name"), "docutype", "docutype", "description"),
        kept("language_code", F.col("_language"), "languageCode"),
        F.coalesce("_detail_ok", F.lit(False)).alias("already_complete"),
        "summary_json",
    )
