"""A tolerant reading of HTML into the nodes and text pieces that extraction needs."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template".split())
HIDDEN = frozenset("head select option datalist button".split())
FOREIGN = frozenset(("svg", "math"))  # inside them a tag may close itself
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small "
                   "span strike strong sub sup time tt u var wbr img math maction menclose merror mfrac mi mmultiscripts mn mo mover "
                   "mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder munderover none "
                   "semantics annotation".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
                     "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": (), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",),
         "option": ("select",), "tbody": ("table",), "tfoot": ("table",)}

_TOKEN = re.compile(
    r"<!--(?:.*?-->|[^>]*>)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def label_of(attributes: str) -> str:
    """The values of class, id, role and the like, in one text."""
    return " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if "=" in attributes else ""


@dataclass
class Page:
    """Scored nodes in page order, and text pieces with their node and block.

    Inline elements without a class, id or role belong to the node around them.
    """

    tags: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    pieces: list[tuple[int, int, bool, str]] = field(default_factory=list)  # node, block, in a link, text


def parse(html: str) -> Page:
    """Nodes and text of the page; never fails. Scripts, styles, templates, heads and controls have no text."""
    page = Page()
    tags, names, parents, pieces = page.tags, page.names, page.parents, page.pieces
    tags.append("")
    names.append("")
    parents.append(-1)
    stack: list[tuple[str, int]] = [("", 0)]  # open elements, with the node that holds their text
    hidden = links = foreign = block = at = 0
    size = len(html)

    def close(depth: int) -> None:
        nonlocal hidden, links, foreign, block
        while len(stack) > depth:
            tag, _ = stack.pop()
            if tag in HIDDEN:
                hidden -= 1
            elif tag == "a":
                links -= 1
            elif tag in FOREIGN:
                foreign -= 1
            if tag not in INLINE:
                block += 1

    def text(lo: int, hi: int, raw: bool = False) -> None:
        if hi > lo and not hidden:
            piece = html[lo:hi]
            pieces.append((stack[-1][1], block, links > 0, unescape(piece) if "&" in piece and not raw else piece))

    while at < size:
        found = _TOKEN.search(html, at)
        if found is None:
            text(at, size)
            break
        text(at, found.start())
        at = found.end()
        end, name, attributes = found[1], found[2], found[3]
        if name is None:
            end, name, attributes = found[4], found[5], found[6]
            if name is None:
                if html.startswith("<![CDATA[", found.start()):
                    text(found.start() + 9, found.end() - 3)
                continue
        tag = name.lower()
        if end:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            continue
        if tag in RAW:
            match = re.compile(f"</{tag}[\\s/>]", re.I).search(html, at) if not attributes.endswith("/") else None
            if match is None:
                at = size if not attributes.endswith("/") else at
            else:
                at = html.find(">", match.start()) + 1 or size
            continue
        if tag in CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == "p":
                    close(depth)
                    break
                if stack[depth][0] not in INLINE:
                    break
        if tag in CLOSES:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in CLOSES[tag]:
                    close(depth)
                elif stack[depth][0] in STOPS.get(tag, ()):
                    break
        if tag not in INLINE:
            block += 1
        if tag in VOID or attributes.endswith("/") and (foreign or tag in FOREIGN or tag == "path"):
            continue
        node = stack[-1][1]
        label = label_of(attributes)
        if tag not in INLINE or label:
            tags.append(tag)
            names.append(label)
            parents.append(node)
            node = len(tags) - 1
        stack.append((tag, node))
        if tag in HIDDEN:
            hidden += 1
        elif tag == "a":
            links += 1
        elif tag in FOREIGN:
            foreign += 1
        elif tag == "xmp":  # its text holds no markup
            match = re.compile("</xmp[\\s/>]", re.I).search(html, at)
            stop = match.start() if match else size
            text(at, stop, raw=True)
            at = stop
    return page


def assemble(pieces: list[tuple[int, int, bool, str]], keep) -> str:
    """The text of the pieces whose node is kept: blocks joined by one space, white space made one."""
    out, last = [], None
    for node, block, _, text in pieces:
        if keep[node]:
            if block != last:
                out.append(" ")
                last = block
            out.append(text)
    return " ".join("".join(out).split())
