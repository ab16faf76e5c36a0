"""Row selection: scope, type, language, calendar window and search values."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.dates import filled
from folioforge.functions.text import document_id, normalize_ref, split_list
from folioforge.schema import KNOWN_TYPES, SearchSpec, scope_types


def filter_types(df: DataFrame, codes: Iterable[str]) -> DataFrame:
    """Rows of the given type codes; no codes means no filter."""
    listed = tuple(codes)
    return df.where(F.col("doc_type").isin(*listed)) if listed else df


def filter_scope(df: DataFrame, scope: str) -> DataFrame:
    return filter_types(df, scope_types(scope))


def filter_language(df: DataFrame, language: str) -> DataFrame:
    return df.where(F.col("language") == language)


def filter_window(df: DataFrame, date_from: date, date_to: date) -> DataFrame:
    """Inclusive range on ISO text: a date with a time part lies after its own day."""
    return df.where(F.col("date").between(date_from.isoformat(), date_to.isoformat()))


def filter_nonempty_date(df: DataFrame) -> DataFrame:
    return df.where(filled(F.col("date")))


def keyword_match(word: str) -> Column:
    """Case-insensitive substring of title, summary or text."""
    needle = word.lower()
    found = (
        F.lower(F.coalesce(F.col(c), F.lit(""))).contains(needle)
        for c in ("title", "summary", "full_text")
    )
    return reduce(Column.__or__, found)


def commissioner_match(name: str) -> Column:
    return F.array_contains(split_list(F.col("commissioners")), name)


def policy_match(area: str) -> Column:
    """A policy area by name or by code."""
    return F.array_contains(split_list(F.col("policy_areas")), area) | F.array_contains(
        split_list(F.col("policy_codes")), area
    )


def search_predicate(spec: SearchSpec) -> Column | None:
    """Any of the search values; None when the spec has none."""
    branches = [
        *(commissioner_match(value) for value in spec.commissioners),
        *(policy_match(value) for value in spec.policy_areas),
        # Last, as it is the only branch that has to look into the text.
        *(keyword_match(value) for value in spec.keywords),
    ]
    return reduce(Column.__or__, branches) if branches else None


def filter_union(df: DataFrame, spec: SearchSpec) -> DataFrame:
    predicate = search_predicate(spec)
    return df if predicate is None else df.where(predicate)


def build_descriptive(corpus: DataFrame, spec: SearchSpec, until: date | None = None) -> DataFrame:
    """Sub-corpus of a spec: dates, types and language, and any of its search values."""
    end = spec.end or until or date.today()
    selected = filter_types(filter_window(corpus, spec.start, end), spec.document_types)
    if spec.language is not None:
        selected = filter_language(selected, spec.language)
    return filter_union(selected, spec)


def select_references(corpus: DataFrame, references: DataFrame) -> DataFrame:
    """Stored rows of a list of references (column ``reference``)."""
    wanted = references.select(
        document_id(normalize_ref(F.col("reference"))).alias("document_id")
    )
    return corpus.join(wanted, "document_id", "left_semi")


def unknown_types(df: DataFrame, column: str = "doc_type") -> DataFrame:
    """Distinct upper-cased codes outside the documented set, in order."""
    code = F.upper(F.col(column))
    return (
        df.where(~code.isin(*KNOWN_TYPES)).select(code.alias("doc_type")).distinct().orderBy("doc_type")
    )
