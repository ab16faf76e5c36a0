"""Column expressions for identifiers, lists and links of a document."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character that counts as white space when text is trimmed.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

LIST_SEPARATOR = "; "


def strip(value: Column) -> Column:
    """Trim all white space, not only spaces."""
    return F.btrim(value, F.lit(WHITESPACE))


def nullable(value: Column) -> Column:
    """Empty text becomes null; white space is kept."""
    return F.nullif(value, F.lit(""))


def first_filled(*values: Column) -> Column:
    """The first value that is neither null nor empty, else the empty text."""
    return F.coalesce(*(nullable(value) for value in values), F.lit(""))


def document_id(reference: Column) -> Column:
    """``IP/26/301`` -> ``ip_26_301``."""
    return F.translate(F.lower(strip(reference)), "/", "_")


def normalize_ref(reference: Column) -> Column:
    return F.upper(strip(reference))


def join_nonempty(values: Column) -> Column:
    """Trim every element, drop the blank ones and join the rest; none gives null."""
    kept = F.filter(F.transform(values, strip), lambda value: value != "")
    return nullable(F.array_join(kept, LIST_SEPARATOR))


def split_list(value: Column) -> Column:
    """The elements of a joined list column; null and empty give an empty array."""
    return F.filter(F.split(F.coalesce(value, F.lit("")), LIST_SEPARATOR), lambda v: v != "")


def contact_label(first: Column, last: Column, title: Column) -> Column:
    """``First Last (Title)``, or whichever part is there; empty when none is."""
    first, last, title = (strip(F.coalesce(part, F.lit(""))) for part in (first, last, title))
    name = F.concat_ws(" ", nullable(first), nullable(last))
    return (
        F.when((name != "") & (title != ""), F.concat(name, F.lit(" ("), title, F.lit(")")))
        .when(name != "", name)
        .otherwise(title)
    )


def record_language(code: Column, default: Column) -> Column:
    return F.coalesce(nullable(strip(F.coalesce(nullable(code), default))), default)


def detail_url(base_url: str, language: Column, doc_id: Column) -> Column:
    return F.concat(F.lit(f"{base_url}/detail/"), language, F.lit("/"), doc_id)


def pdf_url(base_url: str, language: Column, doc_id: Column, reference: Column) -> Column:
    stem = F.upper(F.translate(reference, "/", "_"))
    return F.concat(
        F.lit(f"{base_url}/api/files/document/print/"),
        language,
        F.lit("/"),
        doc_id,
        F.lit("/"),
        stem,
        F.lit("_"),
        F.upper(language),
        F.lit(".pdf"),
    )


def row_digest(value: Column) -> Column:
    return F.sha2(value, 256)


def coerce_boolean(value: Column) -> Column:
    """Read a boolean from common spellings; anything else is null."""
    word = F.lower(strip(value.cast("string")))
    return F.when(word.isin("true", "1", "yes"), F.lit(True)).when(
        word.isin("false", "0", "no"), F.lit(False)
    )
