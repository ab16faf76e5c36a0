"""Phrase mining against plain counting, on odd tables, with many small shards."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

from folioforge.llm import phrases


def plain(rows, support, longest, top):
    counts, sizes = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", folded):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if a >= support and len(p) > 1}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        found = []
        for p, a in often.items():
            if any(len(q) > len(p) and b >= a and inside(p, q) for q, b in often.items()):
                continue
            score, _, left, right = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((score, a, " ".join(p), left, right))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, rank, p, a, left, right, sizes[lang], score) for rank, (score, a, p, left, right) in enumerate(found[:top], 1)]
    return sorted(out)


def rows_of(seed):
    rng = random.Random(seed)
    words = ["the", "The", "ÉTÉ", "été", "a\x00b", "x y", "new", "york", "ÿ", "über", "of", "of"]
    sentences = ["new york city of the", "the of the of the", "one-off thing"]
    rows = []
    for _ in range(150):
        parts = [rng.choice(sentences) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(rng.randint(0, 5))]
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), rng.choice([". ", ", ", "\n", " \t ", "\x0b", "!"]).join(parts)))
    return [*rows, ("en", None), ("en", ""), ("xx", None), ("xx", " . "), rows[0], rows[0], ("fr", "the of " * 3000)]


@pytest.mark.parametrize(("seed", "support", "block_words"), [(1, 6, 40), (2, 3, 10**6), (3, 20, 300)])
def test_phrases_equal_plain_counts(spark, seed, support, block_words):
    rows = rows_of(seed)
    frame = spark.createDataFrame([(i, *r, 1, "x") for i, r in enumerate(rows)],
                                  "doc_id long, lang string, text string, f long, phrase string").repartition(3)
    known = phrases.phrase_counts(frame, support, 5, block_words, 5).where("k > 1").count()
    got = sorted(map(tuple, phrases.collocations(frame, support, 5, 12).collect()))
    assert got == plain(rows, support, 5, 12) and known >= len(got) > 0


def test_long_products_and_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(empty).collect() == []
    few = spark.createDataFrame([(1, "en", "a b. " * 3)], empty.schema)
    assert phrases.collocations(few).collect() == []


def test_support_of_shards_sums_to_the_whole(spark):
    """A phrase that is spread evenly, below the support in every shard, is found."""
    rows = [(i, "en", f"spread evenly w{i}a w{i}b") for i in range(120)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(6)
    got = phrases.collocations(frame).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n) for r in got] == [("spread evenly", 120, 120, 120, 480)]
