"""HTML body -> readable text, inside the JVM."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import strip

# One pattern finds every place where text is interrupted. Elements whose content is
# not prose go as a whole; comments, declarations and tags go alone. A quoted
# attribute value may hold '>'. All inner loops are possessive, so matching needs
# neither backtracking nor deep recursion on long documents.
_SILENT = r"<(script|style|template|rt|rp)(?=[\s>])[^>]*(?<!/)>.*?(?:</\1\s*>|\z)"
_COMMENT = r"<!--.*?(?:-->|\z)"
_TAG = r"""<[a-z](?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+>"""
_OTHER_MARKUP = r"<[!?/a-z][^>]*>"
MARKUP = f"(?is){_SILENT}|{_COMMENT}|{_TAG}|{_OTHER_MARKUP}"

# Named references come from the standard library's table. Lookup scans the map in
# order, so the names met in most pages stand first.
_COMMON = ("amp", "nbsp", "quot", "lt", "gt", "apos", "rsquo", "lsquo", "rdquo", "ldquo",
           "ndash", "mdash", "hellip", "euro", "copy", "middot", "eacute", "egrave")
_PAIR, _KEY = "\x1d", "\x1e"


def _named_references() -> Column:
    plain = {name.rstrip(";"): text for name, text in sorted(html5.items())}
    names = [*_COMMON, *(name for name in plain if name not in _COMMON)]
    # Only separators that occur in no entry may be used to write the table down.
    packed = _PAIR.join(f"{name}{_KEY}{plain[name]}" for name in names)
    return F.str_to_map(F.lit(packed), F.lit(_PAIR), F.lit(_KEY))


def _windows_1252() -> Column:
    """Code points 128-159 are read as Windows-1252, as pages in the wild mean them."""
    pairs = []
    for code in range(128, 160):
        text = bytes([code]).decode("cp1252", errors="ignore")
        if text:
            pairs.append(f"{code}{_KEY}{text}")
    return F.str_to_map(F.lit(_PAIR.join(pairs)), F.lit(_PAIR), F.lit(_KEY))


def _character(code: Column) -> Column:
    """The character of a code point, U+FFFD when there is none."""
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    encoded = F.unhex(F.lpad(F.hex(F.when(valid, code)), 8, "0"))
    return F.coalesce(
        F.try_element_at(_windows_1252(), code.cast("string")),
        F.decode(encoded, "UTF-32"),
        F.lit("\ufffd"),
    )


def _after_ampersand(part: Column) -> Column:
    """Decode the reference at the start of ``part``, the text that followed a '&'."""
    digits = F.regexp_extract(part, r"^#0*([0-9]{1,9})(?![0-9])", 1)
    hexadecimal = F.regexp_extract(part, r"^#[xX]0*([0-9a-fA-F]{1,7})(?![0-9a-fA-F])", 1)
    name = F.regexp_extract(part, r"^([a-zA-Z][-.a-zA-Z0-9]*)", 1)
    rest = F.regexp_replace(part, r"^(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][-.a-zA-Z0-9]*);?", "")
    known = F.try_element_at(_named_references(), name)
    return (
        F.when(digits != "", F.concat(_character(digits.try_cast("bigint")), rest))
        .when(
            hexadecimal != "",
            F.concat(_character(F.conv(hexadecimal, 16, 10).try_cast("bigint")), rest),
        )
        .when(part.rlike(r"^#(?:[0-9]|[xX][0-9a-fA-F])"), F.concat(F.lit("\ufffd"), rest))
        .when(name != "", F.concat(F.coalesce(known, F.concat(F.lit("&"), name)), rest))
        .otherwise(F.concat(F.lit("&"), part))
    )


def unescape(text: Column) -> Column:
    """Replace character references; text without '&' passes untouched."""
    decoded = F.transform(
        F.split(text, "&"),
        lambda part, place: F.when(place == 0, part).otherwise(_after_ampersand(part)),
    )
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def _cdata_as_text(html: Column) -> Column:
    """The content of CDATA sections as text nodes of their own: '<' and '&' in them are no markup."""

    def section(part: Column, place: Column) -> Column:
        inner = F.substring_index(part, "]]>", 1)
        plain = F.replace(F.replace(inner, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        rest = F.substring(part, F.length(inner) + 4, F.length(part))
        return F.when(place == 0, part).otherwise(F.concat(F.lit("<!>"), plain, F.lit("<!>"), rest))

    parts = F.transform(F.split(html, r"<!\[CDATA\["), section)
    return F.when(html.contains("<![CDATA["), F.array_join(parts, "")).otherwise(html)


def html_to_text(html: Column) -> Column:
    """Text nodes, trimmed, blank ones dropped, one per line; empty text for null."""
    nodes = F.transform(F.split(_cdata_as_text(html), MARKUP), lambda node: strip(unescape(node)))
    return F.coalesce(
        F.array_join(F.filter(nodes, lambda node: node != ""), "\n"), F.lit("")
    )
