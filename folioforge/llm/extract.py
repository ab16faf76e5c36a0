"""Main text of web pages: boosted trees over DOM nodes and hierarchical decoding.

No page comes with labels. The trees learn from pages composed here: paragraphs and short lines
of a bounded sample of the given pages are set into many different layouts, whose parts are
known to be main text or not, so the trees learn what menus, notices or comments look like in
general and not one site's template.
"""

from __future__ import annotations

import math
import random
import re
from html import escape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm import trees
from folioforge.llm.dom import INLINE, RAW, VOID, Page, assemble, label_of, parse

SAMPLE = 200  # pages whose wording the layouts are filled with, at most
LAYOUTS = 1500  # pages that are composed

# Words in classes, ids and roles that tell main text from the rest.
MAIN = frozenset("article articlebody content contents main mainbody post postbody entry body story text prose markdown "
                 "chapter page reading longform copy".split())
BESIDE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner teaser
nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs toolbar sidebar side rail aside widget widgets
footer foot header head masthead topbar logo branding comment comments reply replies respond response disqus discussion thread
reader readers feedback review reviews cookie cookies consent gdpr notice notices notification alert warning disclaimer popup modal
overlay dialog share sharing social follow like subscribe subscription newsletter signup login register form search searchbox
related recommended recommendations more popular trending tags tagcloud categories archive archives meta byline copyright legal
license skip hidden print complementary contentinfo sitemap links outbrain taboola""".split())
_PART = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

_GROUPS = ("p", "h1 h2 h3 h4 h5 h6", "li dt dd", "ul ol dl menu", "div", "article main", "section", "nav", "aside", "header", "footer",
           "form fieldset input label", "table thead tbody tr td th", "blockquote pre figure figcaption", "body html", "span a")
_GROUP = {tag: k for k, tags in enumerate(_GROUPS) for tag in tags.split()}
FEATURES = len(_GROUPS) + 22


def _named(label: str) -> tuple[int, int]:
    """How many words of the label speak for main text and against it."""
    words = _PART.findall(_CAMEL.sub(" ", label).lower())
    return sum(w in MAIN for w in words), sum(w in BESIDE for w in words)


def features(page: Page) -> np.ndarray:
    """A row per node: tag, attribute words, depth, own and subtree text, links, and siblings."""
    n = len(page.tags)
    own, linked, ends = [0] * n, [0] * n, [0] * n
    for node, _, link, text in page.pieces:
        size = len(text)
        own[node] += size
        if link:
            linked[node] += size
        ends[node] += text.count(".") + text.count(",")
    parents = page.parents
    all_text, all_links, all_ends, nodes = own[:], linked[:], ends[:], [1] * n
    paragraphs = [int(t == "p") for t in page.tags]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = parents[i]
        all_text[p] += all_text[i]
        all_links[p] += all_links[i]
        all_ends[p] += all_ends[i]
        nodes[p] += nodes[i]
        paragraphs[p] += paragraphs[i]
    for i in range(1, n):
        children[parents[i]].append(i)
    good, bad, depth = [0] * n, [0] * n, [0] * n
    good_above, bad_above, main_above = [0] * n, [0] * n, [0] * n
    log = [math.log1p(x) for x in all_text]
    out = np.zeros((n, FEATURES))
    k = len(_GROUPS)
    rows = []
    for i in range(n):
        p = parents[i]
        if page.names[i]:
            good[i], bad[i] = _named(page.names[i])
        if p >= 0:
            depth[i] = depth[p] + 1
            good_above[i] = good_above[p] + good[p]
            bad_above[i] = bad_above[p] + bad[p]
            main_above[i] = main_above[p] or page.tags[p] in ("article", "main")
        group = _GROUP.get(page.tags[i])
        if group is not None:
            out[i, group] = 1
        rows.append(None)
    for p in range(n):
        kids = children[p]
        if not kids:
            continue
        count, total = len(kids), all_text[p] + 1
        same: dict[str, int] = {}
        for c in kids:
            same[page.tags[c]] = same.get(page.tags[c], 0) + 1
        for place, c in enumerate(kids):
            rows[c] = (place, count - 1 - place, count, same[page.tags[c]], all_text[c] / total,
                       log[kids[place - 1]] if place else -1.0, log[kids[place + 1]] if place + 1 < count else -1.0)
    rows[0] = (0, 0, 1, 1, 1.0, -1.0, -1.0)
    text = np.array(all_text, float)
    page_text = max(1.0, text[0])
    out[:, k : k + 7] = rows
    out[:, k + 7] = np.log1p(own)
    out[:, k + 8] = log
    out[:, k + 9] = np.array(all_links) / np.maximum(1, text)
    out[:, k + 10] = text / np.array(nodes)  # density of the subtree
    out[:, k + 11] = np.log1p(nodes)
    out[:, k + 12] = np.array(all_ends) / np.maximum(1, text)
    out[:, k + 13] = text / page_text
    out[:, k + 14] = depth
    out[:, k + 15], out[:, k + 16] = good, bad
    out[:, k + 17], out[:, k + 18], out[:, k + 19] = good_above, bad_above, main_above
    out[:, k + 20] = np.log1p(paragraphs)
    out[:, k + 21] = np.arange(n) / n
    return out


def decode(parents: list[int], logits) -> list[bool]:
    """The likeliest labelling in which every kept node's ancestors are kept.

    Bottom up, a node's subtree is worth either all of it dropped, or the node kept and each
    child at its best; top down the choices are made. The root is always kept.
    """
    n = len(parents)
    keep = [-math.log1p(math.exp(-z)) if z > -700 else z for z in logits]  # log p
    drop = [k - z for k, z in zip(keep, logits, strict=True)]  # log(1 - p)
    for i in range(n - 1, 0, -1):
        p = parents[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[parents[i]] and keep[i] > drop[i]
    return kept


def _composed(rng: random.Random, prose: list[str], short: list[str]) -> str:
    """A page of random layout; tags of main text carry the mark ``data-keep``, which no feature reads."""
    def pick(words):
        return rng.choice(words.split())

    def line():
        return escape(rng.choice(short))

    def passage():
        return escape(rng.choice(prose if rng.random() < 0.88 else short))

    def named(words, odds=0.75):
        kind = pick("class id class role") if rng.random() < 0.9 else "class"
        word = pick(words)
        style = rng.choice([word, word + "-" + pick("box block wrap area list inner 2 x"), pick("site page l c js") + "-" + word, word.capitalize()])
        return f' {kind}="{style}"' if rng.random() < odds else ""

    def mark(html):
        return re.sub(r"<([a-z0-9]+)", r"<\1 data-keep", html, count=1)

    def links(n):
        return "".join(f'<li><a href="/{i}">{line()}</a></li>' for i in range(n))

    def beside(inside):
        kind = rng.random()
        tag = rng.choice(["div", "div", "aside", "section", "p", "span"] if inside else ["div", "div", "aside", "section"])
        if kind < 0.22:
            return f"<{tag}{named('ad ads advert advertisement sponsor promo banner', 0.97)}>{rng.choice([line, passage])()}</{tag}>"
        if kind < 0.36:
            return f"<{tag}{named('notice cookie consent alert disclaimer popup', 0.97)}>{rng.choice([line, passage])()}</{tag}>"
        if kind < 0.50:
            return f"<{rng.choice(['div', 'aside'])}{named('sidebar side widget related recommended more', 0.97)}><h3>{line()}</h3><ul>{links(rng.randint(2, 7))}</ul></div>"
        if kind < 0.62:
            return f"<form{named('subscribe newsletter signup search login', 0.6)}><label>{line()}</label><input type=text><p>{line()}</p><button>{line()}</button></form>"
        if kind < 0.74:
            return f"<div{named('share social follow tags meta byline', 0.97)}>" + " ".join(f'<a href="#">{line()}</a>' for _ in range(rng.randint(1, 5))) + "</div>"
        if kind < 0.88:
            inner = "".join(f"<{t}{named('comment reply', 0.6)}><b>{line()}</b><p>{passage()}</p></{t}>" for t in [rng.choice(["div", "li", "article"])] for _ in range(rng.randint(1, 6)))
            return f"<{rng.choice(['div', 'section'])}{named('comments discussion responses disqus replies', 0.98)}><h3>{line()}</h3>{inner}</div>"
        return f"<aside{named('sidebar widget', 0.5)}><p>{passage()}</p></aside>"

    def block():
        kind = rng.random()
        if kind < 0.62:
            lead = rng.choice(["", "", "", "<b>", "<i>", "<a href='/x'>"])
            return mark(f"<p{named('text lead', 0.1)}>{lead}{passage()}" + rng.choice(["</p>", "</p>", "<br>", "<br>" + passage() + "</p>", ""]))
        if kind < 0.72:
            return mark(f"<h{(level := rng.randint(2, 4))}>{line()}</h{level}>")
        if kind < 0.79:
            return mark("<ul>" + "".join(mark(f"<li>{rng.choice([line, passage])()}</li>") for _ in range(rng.randint(1, 6))) + "</ul>")
        if kind < 0.84:
            return mark(f"<blockquote>{mark(f'<p>{passage()}</p>')}</blockquote>")
        if kind < 0.88:
            return mark("<table>" + "".join(mark("<tr>" + "".join(mark(f"<td>{line()}</td>") for _ in range(3)) + "</tr>") for _ in range(rng.randint(1, 4))) + "</table>")
        if kind < 0.94:
            return mark(f"<div{named('text body paragraph', 0.3)}>{passage()}</div>")
        return mark(f"<pre>{passage()}</pre>")

    body = mark(f"<h1>{line()}</h1>") if rng.random() < 0.85 else ""
    crowd = rng.choice([0.0, 0.0, 0.1, 0.3])
    for _ in range(rng.choice([0, 1, 1, 1, 2, 2, 3, 5, 8, 14, 25])):
        body += block()
        if rng.random() < crowd:
            body += beside(True)
    if rng.random() < 0.25:
        body += beside(True)
    tag = rng.choice(["article", "article", "main", "div", "div", "section"])
    odds = 0.3 if tag in ("article", "main") else 0.95
    main = mark(f"<{tag}{named('article content main post entry body story text', odds)}>{body}</{tag}>")
    for _ in range(rng.choice([0, 0, 1, 2])):
        side = beside(False) if rng.random() < 0.4 else ""
        main = mark(f"<{rng.choice(['div', 'main', 'div'])}{named('content main page container wrapper row', 0.6)}>{main}{side}</div>")
    top = f"<{(t := rng.choice(['nav', 'nav', 'div', 'header']))}{named('nav menu navbar header topbar breadcrumb', 0.98 if t == 'div' else 0.3)}><ul>{links(rng.randint(2, 9))}</ul></{t}>"
    if rng.random() < 0.4:
        top = f"<header{named('header masthead', 0.5)}><h1>{line()}</h1><p>{line()}</p>{top}</header>"
    foot = f"<{(t := rng.choice(['footer', 'footer', 'div']))}{named('footer copyright legal contentinfo', 0.98 if t == 'div' else 0.3)}>&copy; {line()} {rng.choice([line, passage])()}</{t}>"
    around = [beside(False) for _ in range(rng.choice([0, 1, 1, 2, 3]))]
    cut = rng.randint(0, len(around))
    page = top + "".join(around[:cut]) + main + "".join(around[cut:]) + foot
    return f"<!DOCTYPE html><html data-keep><head><title>{line()}</title></head><body data-keep>{page}</body></html>"


def fit_extractor(pages: DataFrame, sample: int = SAMPLE, layouts: int = LAYOUTS, seed: int = 7) -> trees.Forest:
    """Trees fitted to ``layouts`` composed pages, worded by the ``sample`` pages of smallest hash."""
    def wording(batches):
        for batch in batches:
            out = []
            for html in batch["html"]:
                page = parse(html)
                found: dict[tuple[int, int], list[str]] = {}
                for node, block, _, text in page.pieces:
                    found.setdefault((node, block), []).append(text)
                out += [text for parts in found.values() if (text := " ".join("".join(parts).split()))]
            yield pd.DataFrame({"text": out})

    chosen = (pages.where("html is not null").orderBy(F.xxhash64(F.lit(seed), F.col("page_id")), "page_id", F.sha1("html"))
              .select("html").limit(sample))
    # Bounded by the sample: blocks of at most ``sample`` pages, each at most 2,000 code points long as wording.
    texts = [t[:2000] for (t,) in chosen.mapInPandas(wording, "text string").distinct().orderBy(F.xxhash64("text"), "text").limit(40 * sample).collect()]
    prose = [t for t in texts if len(t) >= 60] or ["One sentence stands for all of them, for want of other words here."]
    short = [t for t in texts if len(t) < 60] + [" ".join(t.split()[:k]) for k, t in zip([1, 2, 3, 4, 6, 8] * len(prose), prose, strict=False)]
    rng = random.Random(seed)
    rows, labels = [], []
    for _ in range(layouts):
        html = _composed(rng, prose, [s for s in short if s] or ["Words"])
        page, marks = parse(html), []
        for found in re.finditer(r"<([a-z0-9]+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>", html):
            marks.append((found[1], " data-keep" in found[2], found[2]))
        keep = _labels(page, marks)
        rows.append(features(page)[1:])
        labels.append(keep[1:])
    return trees.fit(np.vstack(rows), np.concatenate(labels).astype(float))


def _labels(page: Page, marks) -> np.ndarray:
    """The marks of the tags that became nodes, in page order."""
    keep = [True]
    for tag, kept, attributes in marks:
        if tag in RAW or tag in VOID or tag in INLINE and not label_of(attributes):
            continue
        keep.append(kept)
    assert len(keep) == len(page.tags)
    return np.array(keep)


def main_text(forest: trees.Forest):
    """A column function: the main text of a page's HTML; null is an empty page."""
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        out: list[str] = []
        for start in range(0, len(pages), 500):  # nodes of so many pages at once
            parsed = [parse(html or "") for html in pages.iloc[start : start + 500]]
            logits = forest.logits(np.vstack([features(p) for p in parsed])).tolist()
            at = 0
            for page in parsed:
                n = len(page.tags)
                out.append(assemble(page.pieces, decode(page.parents, logits[at : at + n])))
                at += n
        return pd.Series(out)

    return extract


def extract_pages(pages: DataFrame, forest: trees.Forest | None = None) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages`` (page_id, url, html).

    Null and empty html, and pages without main text, give an empty text. Repeated rows are
    read each by itself. Broken markup is read as far as it goes, never rejected.
    """
    extract = main_text(forest or fit_extractor(pages))
    return pages.select("page_id", "url", extract("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
