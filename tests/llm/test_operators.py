"""Each operator against a brute-force version or an exact round trip, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from folioforge.llm import decontaminate, dom, extract, gam, jaccard, lines, mixing, neighbours, quality, secret_scan, shards, warc
from folioforge.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, root string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None, "x", "y") for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, a null and an empty text, a null id, repeated rows and a long text."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    rows = []
    for i in range(60):
        rows.append((i, " ".join(word() for _ in range(rng.randint(1, 120))), rng.choice(["en", "de", None]), f"s{i % 3}"))
    base = [word() for _ in range(200)]
    for i in range(60, 100):  # a group of near copies, larger than a leaf
        words = base[:]
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = word()
        rows.append((i, " ".join(words).upper() if i % 2 else "\t".join(words), "en", "s0"))
    return [*rows, (200, None, None, None), (201, "", "en", "s1"), (202, " \n\t", "en", "s1"), (None, rows[3][1], "en", "s1"),
            rows[5], rows[5], (203, " ".join(word() for _ in range(20_000)), "en", "s2"), (204, "one two", "en", "s2"), (205, "ONE\ntwo", "en", "s2")]


def shingles_of(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def test_jaccard_components_equal_brute_force(spark, corpus, monkeypatch):
    rows = sorted(map(tuple, jaccard.jaccard_components(docs_of(spark, corpus)).collect()), key=str)
    sets = [shingles_of(t) for _, t, _, _ in corpus]
    top = list(range(len(corpus)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(corpus)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    want = []
    for i, (doc_id, *_ ) in enumerate(corpus):
        ids = [corpus[j][0] for j in range(len(corpus)) if find(j) == find(i) and corpus[j][0] is not None]
        want.append((doc_id, len(sets[i]), min(ids, default=None) if sets[i] else doc_id))
    assert rows == sorted(want, key=str)


def test_tree_join_loses_no_pair():
    rng = np.random.default_rng(1)
    points = rng.poisson(2, (300, 16)).astype(np.int32)
    points[150:] = points[:150] + (rng.random((150, 16)) < 0.05)
    sizes, roots = points.sum(1).astype(np.int64), np.arange(300)
    left, right = jaccard.tree(points[:150], sizes[:150], roots[:150]), jaccard.tree(points[150:], sizes[150:], roots[150:])
    got = {(int(a), int(b)) for i, j in jaccard.tree_pairs(left, right, 64) for a, b in zip(i, j, strict=True)}
    want = {(i, j) for i in range(150) for j in range(150)
            if np.minimum(points[i], points[150 + j]).sum() >= jaccard.needed(sizes[i], sizes[150 + j])}
    assert got == want and want
    whole = jaccard.tree(points, sizes, roots)
    pairs = [(int(a), int(b)) for i, j in jaccard.tree_pairs(whole, whole, 64) for a, b in zip(i, j, strict=True)]
    every = {(i, j) for i in range(300) for j in range(i + 1, 300)
             if np.minimum(points[i], points[j]).sum() >= jaccard.needed(sizes[i], sizes[j])}
    assert len(pairs) == len(set(pairs)) and set(pairs) == every and every > {(i, 150 + j) for i, j in want if i != j}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (5, 5), (None, 3)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert len(roots) == 303 and len({roots[i] for i in range(301)}) == 1 and roots[900] == roots[901] != roots[0]


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(4)
    pool = ["  Same line here ", "same LINE here", "short", "", "\x0bA much longer line that repeats\x0c", "É accented é line", "own %d line of text"]
    rows = [(i, "\n".join(p % rng.randrange(9) if "%" in p else p for p in rng.choices(pool, k=rng.randint(1, 8))), "en", "s") for i in range(80)]
    rows += [(90, None, "en", "s"), (91, "", "en", "s"), (None, "same line here\nx", "en", "s"), rows[0], (5, "same line here", "en", "s")]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    first = {}
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            first[key(line)] = min(first.get(key(line), 2**63 - 1), 2**63 - 1 if doc_id is None else doc_id)
    want = []
    for doc_id, text, *_ in rows:
        own = (text or "").split("\n")
        kept = [x for x in own if len(key(x)) < 10 or first[key(x)] == (2**63 - 1 if doc_id is None else doc_id)]
        want.append((doc_id, len(own), len(own) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = list(map(tuple, lines.line_digest(docs_of(spark, rows)).collect()))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_shards_are_even_and_match_the_mixture(spark, corpus):
    rows = shards.shard_documents(docs_of(spark, corpus), 4, bucket_rows=7).collect()
    assert len(rows) == len(corpus)
    sizes = [sorted(r.slot for r in rows if r.shard == k) for k in range(4)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    for source in ("s0", "s1", "s2"):
        n = [sum(r.shard == k and r.source == source for r in rows) for k in range(4)]
        assert max(n) - min(n) <= 2
    facts = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in corpus)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == facts


def test_secrets_are_linked_only_near_their_parts(spark):
    key = "aB3" + "x9Y" * 12 + "z"
    rows = [(1, f'é password = "hunter22" {"x" * 400} login: someone', "en", "s"), (2, f"AKIA{'Q' * 16} and {key}", "en", "s"),
            (3, f"only {key}", "en", "s"), (4, "secret=token: abcdef", "en", "s"), (5, "0123456789abcdef01234567", "en", "s"),
            (6, None, "en", "s"), (6, None, "en", "s"), (None, "token:abcdef", "en", "s"), (7, f"AKIA{'Q' * 16} secret: abcdefg http://a.example/x", "en", "s")]
    got = {(r.doc_id, r.spans) for r in secret_scan.secret_digest(docs_of(spark, rows)).collect()}
    assert got == {(1, "assign:2:22"), (2, "access:0:20,key:25:65"), (3, ""), (4, ""), (5, "hex:0:24"), (6, ""), (None, "assign:0:12"),
                   (7, "access:0:20,assign:21:36,endpoint:37:55")}


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((120, 16))
    base[40:100] = base[0] + 0.1 * rng.standard_normal((60, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    odd = [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [None] * 16), (505, [1.0, 2.0]), (None, rows[0][1]), rows[1], (506, rows[1][1])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.near_vectors(
        spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>"), window=8).collect()}
    unit = base / np.linalg.norm(base, axis=1)[:, None]
    close = unit @ unit.T >= 0.9
    for i in range(120):
        assert got[i][0] == close[i].sum() - 1 + (i == 1)
    assert got[506][:2] == (1, 1) and all(got[i] == (0, i, True) for i in range(500, 506)) and got[None] == (0, None, False)


def test_near_vectors_of_a_common_direction_are_found(spark):
    rng = np.random.default_rng(8)
    n, dims, cosine = 6000, 32, 0.75
    first = rng.standard_normal((n, dims))
    first /= np.linalg.norm(first, axis=1)[:, None]
    base = np.sqrt(1 - cosine) * first
    base[:, 0] += np.sqrt(cosine)  # unrelated vectors have a cosine of about 0.75
    base /= np.linalg.norm(base, axis=1)[:, None]
    side = rng.standard_normal((300, dims))
    side -= (side * base[:300]).sum(1, keepdims=True) * base[:300]
    side /= np.linalg.norm(side, axis=1)[:, None]
    base[300:600] = 0.905 * base[:300] + np.sqrt(1 - 0.905**2) * side
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)] + [(10_000 + i, [1.0] * dims) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_vectors(frame, window=16).collect()}
    close = base @ base.T >= 0.9
    links = sum(got[i][0] for i in range(n)) / (close.sum() - n)
    planted = np.mean([got[i][1] == got[300 + i][1] for i in range(300)])
    assert links >= 0.9 and planted >= 0.9
    assert all(got[10_000 + i] == (199, 10_000) for i in range(200))


def test_edit_distance_and_planted_items(spark):
    rng = random.Random(5)
    for _ in range(500):
        item, text = rng.choices("abc", k=rng.randint(1, 9)), rng.choices("abc", k=rng.randint(0, 14))
        row = [0] * (len(text) + 1)
        for i, a in enumerate(item):
            then = [i + 1]
            for j, b in enumerate(text):
                then.append(min(row[j + 1] + 1, then[j] + 1, row[j] + (a != b)))
            row = then
        assert decontaminate.best_end(item, text)[0] == min(min(row), len(item))
    words = [f"w{i}" for i in range(400)]
    item = rng.choices(words, k=30)
    changed = item[:]
    for at in (2, 9, 17, 25):
        changed[at] = "other"
    del changed[12]
    filler = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(1, f"{filler(50)} {' '.join(item).upper()}! {filler(3)}", "en", "s"), (2, f"{filler(9)} {', '.join(changed)}", "en", "s"),
            (3, filler(300), "en", "s"), (4, None, "en", "s"), (5, "", "en", "s"), (6, " ".join(item[:15]), "en", "s")]
    bench = spark.createDataFrame([(7, " ".join(item)), (7, " ".join(item)), (8, None), (9, "too short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contamination(docs_of(spark, rows), bench, block_bytes=10).collect()}
    assert got == {(1, 7, 0), (2, 7, 5)}
    kept = decontaminate.decontaminate(docs_of(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == docs_of(spark, rows).columns


def test_search_finds_what_the_whole_text_holds():
    rng = random.Random(11)

    def check(item, text):
        index = decontaminate.Index([(1, " ".join(item))], 0.2, 8)
        distance, end = decontaminate.best_end(item, text)
        length = decontaminate.best_end(item[::-1], text[:end][::-1])[1]
        want = [(1, distance, end - length, end)] if distance <= int(len(item) * 0.2) else []
        assert index.search(" ".join(text)) == want
        return bool(want)

    item = [f"w{i}" for i in range(20)]
    inserted = [x for i, word in enumerate(item) for x in ([f"new{i}", word] if i in (6, 10, 14, 18) else [word])]
    assert check(item, item[:4] + inserted)  # a piece recurs just before the passage
    hits = 0
    for _ in range(3000):
        item = rng.choices("abcdefghijkl"[: rng.randint(2, 12)], k=rng.randint(8, 30))
        text = rng.choices("abcdefghijkl", k=rng.randint(0, 10))
        for _ in range(rng.randint(1, 3)):
            copy = item[rng.choice([0, 0, rng.randrange(len(item))]) : rng.choice([len(item), rng.randint(1, len(item))])]
            for _ in range(rng.randint(0, 6)):
                at = rng.randint(0, len(copy))
                copy[at : at + rng.randint(0, 1)] = rng.choices("abcxyz", k=rng.randint(0, 1))
            text += copy + rng.choices("abcdefghijkl", k=rng.randint(0, 4))
        hits += check(item, text)
    assert 500 < hits < 2900


def test_a_rare_source_reaches_a_large_target(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choices(["oak", "elm", "fir", "ash", "yew", "bay"], k=100)), "en", "a" if i % 100 == 0 else "b") for i in range(20_000)]
    targets = {"source": {"a": 0.5, "b": 0.5}}
    decisions = mixing.mixed_decisions(docs_of(spark, rows).repartition(4), targets)
    shares = {(r.margin, r.category): r for r in mixing.reached(decisions, targets).itertuples()}
    rare = shares["source", "a"]
    assert abs(rare.before - 0.01) < 1e-9 and rare.target == 0.5 and abs(rare.expected - 0.5) < 1e-6 and abs(rare.kept - 0.5) < 0.1
    assert all(abs(r.expected - r.target) < 1e-6 for r in shares.values())


def test_raking_meets_the_margins_and_rows_keep_their_columns(spark, corpus):
    import pandas as pd

    cells = pd.DataFrame([(s, g, t, 10 + 7 * i) for i, (s, g, t) in enumerate((s, g, t) for s in "ab" for g in ("en", None) for t in "xy")],
                         columns=["source", "lang", "topic", "tokens"])
    targets = {"source": {"a": 0.6, "b": 0.4}, "lang": {"en": 0.5, None: 0.5}, "topic": {"x": 0.55, "y": 0.45}}
    weighted = cells.assign(w=mixing.rake(cells, targets, spread=100) * cells["tokens"])
    for margin, goals in targets.items():
        for name, goal in goals.items():
            own = weighted[margin].isna() if name is None else weighted[margin] == name
            assert abs(weighted.loc[own, "w"].sum() / weighted["w"].sum() - goal) < 1e-6
    frame = docs_of(spark, corpus)
    kept = mixing.mixed(frame)
    assert kept.columns == frame.columns and {200, 201, 202} <= {r.doc_id for r in kept.collect()}
    decisions = mixing.mixed_decisions(frame).collect()
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) for r in decisions)
    half = mixing.mixed_decisions(frame, budget=sum(r.tokens for r in decisions) // 2).collect()
    total = sum(r.tokens for r in decisions)  # rows that repeat a document share a decision, so sums over these are near
    assert abs(sum(r.rate * r.tokens for r in half) - total / 2) < total / 100


def plain_mixture(spark, docs, targets=None, seed=0):
    """{(doc_id, text, source, lang): copies} by loops over dictionaries; topics are the operator's model."""
    import struct

    import xxhash

    centres = mixing.fit_topics(docs, seed=seed)
    rows = {(r.doc_id, r.text or "", r.source, r.lang) for r in docs.collect()}
    cell, tokens = {}, {}
    for row in rows:
        topic = f"topic{int((mixing._vectors([row[1]])[0] @ centres.T).argmax())}"
        cell[row], tokens[row] = (row[2], row[3], topic), len(row[1].split())
    sums = {}
    for r in docs.collect():  # repeated rows count in the cells
        row = (r.doc_id, r.text or "", r.source, r.lang)
        sums[cell[row]] = sums.get(cell[row], 0) + tokens[row]
    total, goals = sum(sums.values()), []
    for m, name in enumerate(mixing.MARGINS):
        have = {}
        for c, n in sums.items():
            have[c[m]] = have.get(c[m], 0) + n
        goal = (targets or {}).get(name) or {k: (n / total) ** mixing.TEMPER for k, n in have.items() if n}
        goals.append({k: v / sum(goal.values()) for k, v in goal.items()})
    weight = {c: float(n > 0) for c, n in sums.items()}
    for _ in range(300):
        for m, goal in enumerate(goals):
            have = {}
            for c, n in sums.items():
                have[c[m]] = have.get(c[m], 0) + n * weight[c]
            met = sum(goal.get(k, 0) for k, n in have.items() if n > 0)
            for c in sums:
                if have[c[m]] > 0:
                    weight[c] *= goal.get(c[m], 0) / met / (have[c[m]] / sum(have.values()))
    scale = total / sum(n * weight[c] for c, n in sums.items())
    out = {}
    for row in rows:
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        if row[0] is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", row[0]), h)
        key = xxhash.xxh64_intdigest(row[1].encode(), 42)
        u = xxhash.xxh64_intdigest(struct.pack("<Q", key), h) % 2**53 / 2**53
        rate = weight[cell[row]] * scale if sums[cell[row]] else 1.0
        rate = rate if tokens[row] else 1.0
        out[row] = int(rate) + (u < rate - int(rate))
    return out


def test_the_draw_equals_plain_loops(spark, corpus):
    frame = docs_of(spark, [(i, t, lang, s) for i, t, lang, s in corpus])
    targets = {"lang": {"en": 0.3, "de": 0.6, None: 0.1}, "source": {"s0": 0.2, "s1": 0.5, "s2": 0.3}}
    for goals in (None, targets):
        want = plain_mixture(spark, frame, goals)
        got = [(r.doc_id, r.text, r.source, r.lang) for r in mixing.mixed(frame, goals).collect()]
        each = {}
        for r in frame.collect():
            row = (r.doc_id, r.text, r.source, r.lang)
            each[row] = each.get(row, 0) + want[(r.doc_id, r.text or "", r.source, r.lang)]
        assert sorted(got, key=str) == sorted((row for row, n in each.items() for _ in range(n)), key=str)
    assert max(want.values()) > 1 and min(want.values()) == 0


def test_topics_come_from_all_documents(spark):
    """The sample starts the rounds; centres are those that k-means over all rows ends with, copies included."""
    rng = random.Random(8)
    words = [[f"{kind}{n}" for n in range(40)] for kind in ("oak", "pier", "loom")]
    rows = [(i, " ".join(rng.choices(words[i % 3], k=60)), "en", "s") for i in range(90)]
    rows += [(100 + i, rows[0][1], "en", "s") for i in range(30)] + [(500, None, "en", "s"), (501, "", "en", "s")]
    docs = docs_of(spark, rows)
    got = mixing.fit_topics(docs, topics=3, sample=4)
    x = mixing._vectors([t or "" for _, t, _, _ in rows])
    x = x[np.abs(x).sum(1) > 0]
    own = (x @ got.T).argmax(1)
    want = np.stack([x[own == k].sum(0) for k in range(3)])
    want /= np.sqrt((want * want).sum(1, keepdims=True))
    assert (got * want).sum(1).min() > 1 - 1e-6
    assert (mixing.fit_topics(docs.repartition(7), topics=3, sample=4) == got).all()


def test_a_lone_rare_document_leaves_the_others_in(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["oak", "elm", "fir"], k=50)), rng.choice(["en", "de"]), rng.choice(["a", "b", "c"])) for i in range(600)]
    rows += [(1000, "one small text", "es", "d")]
    kept = mixing.mixed(docs_of(spark, rows)).collect()
    assert len({r.doc_id for r in kept}) > 450 and abs(len(kept) - 601) < 100
    with pytest.warns(UserWarning, match="aren't met"):
        mixing.mixed(docs_of(spark, rows), {"source": {"a": 0.9, "d": 0.1}, "lang": {"en": 0.1, "de": 0.1, "es": 0.8}}).count()


def test_short_items_and_scripts_without_blanks(spark):
    bench = spark.createDataFrame([(1, "Quartz Sphinx judges"), (2, "今天天气很好我们去公园"), (3, "seven short words stand here in a"), (4, "two words"),
                                   (5, "ประเทศไทยมีอากาศร้อน")], "item_id long, text string")
    rows = [(1, "a quartz, sphinx judges b", "en", "s"), (2, "quartz sphinx never judges", "en", "s"), (3, "他说今天天气很好我们去公园吧", "zh", "s"),
            (4, "他说今天天气不好", "zh", "s"), (5, "x seven short words stand here in a y", "en", "s"), (6, "seven short words stood here in a", "en", "s"),
            (7, "two words", "en", "s"), (8, "วันนี้ประเทศไทยมีอากาศร้อนมาก", "th", "s")]
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contamination(docs_of(spark, rows), bench).collect()}
    assert got == {(1, 1, 0), (3, 2, 0), (5, 3, 0), (8, 5, 0)}


def test_archives_come_back_whole(spark):
    fake = "x" * 50 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\nWARC/1.1\r\n"
    rows = [(i, f"http://a/{i}", ("é%d " % (i % 7)) * (i * 13 % 400) + (fake if i % 3 == 0 else "")) for i in range(120)]
    rows += [(1000, None, None), (None, "u\nv", "z" * 2000), (1001, "", "z" * 2000), (1002, "", "z" * 2000), (1003, "", "WARC/1.1\r\n" * 3000)]
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= 1000 and i != best[h or ""]
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", best[h or ""] if again else None))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = list(map(tuple, warc.archive_round_trip(frame, 3000).collect()))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_archives_with_long_headers_and_damage(spark, tmp_path):
    url = "data:text/plain," + "x" * 1_500_000
    rows = [(i, url if i in (3, 6) else f"http://a/{i}", f"page {i} " * 40) for i in range(10)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    want = {(i, len(h.encode()), hashlib.sha1(h.encode()).hexdigest()) for i, _, h in rows}
    warc.write_archives(frame, str(tmp_path / "whole"))
    for chunk in (3000, 1_000_000):
        assert {(r.page_id, r.payload_bytes, r.payload_digest) for r in warc.read_payloads(spark, str(tmp_path / "whole"), chunk).collect()} == want
    data = next((tmp_path / "whole").glob("part-*")).read_bytes()
    for k, damaged in enumerate((data[:-3], data.replace(b"WARC/1.1\r\nWARC-Type", b"WARC/1.0\r\nWARC-Type", 1), data + b"more")):
        (tmp_path / f"damaged{k}").mkdir()
        (tmp_path / f"damaged{k}" / "part-0").write_bytes(damaged)
        with pytest.raises(ValueError, match="part-0"):
            warc.read_records(spark, str(tmp_path / f"damaged{k}"), 3000)


def test_odd_markup_and_decoding():
    page = dom.parse("<p class='a>b'>x &amp; y<p>z<!-- <p>no --><script>var t='</p>'</script><ul><li>1<li>2</ul><title>t</title>tail<b")
    assert dom.assemble(page.pieces, [True] * len(page.tags)) == "x & y z 1 2 tail<b"
    assert dom.assemble(dom.parse("").pieces, [True]) == ""
    kept = extract.decode([-1, 0, 1, 0], [5.0, -4.0, 1.0, 2.0])
    assert kept == [True, False, False, True]  # a likely child doesn't save an unlikely parent
    assert extract.decode([-1, 0, 1, 1], [5.0, -1.0, 3.0, 3.0]) == [True] * 4  # two likely ones do


def test_main_text_of_given_pages(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    more = spark.createDataFrame([(9001, None, None), (9002, "u", ""), (9003, "u", "<<<>>")], "page_id long, url string, html string")
    rows = {r.page_id: r for r in extract.extract_pages(pages.unionByName(more)).collect()}
    right = 0
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        text = " ".join(html.unescape(re.sub(r"</?(p|h1|br)>", " ", inner).replace("<b>", "")).split())
        right += rows[r.page_id].text == text and rows[r.page_id].n_chars == len(text)
    assert right >= 0.97 * pages.count() and rows[9001].text == rows[9002].text == ""


def test_formulas_and_preformatted_text_are_article_text(spark):
    page = dom.parse("<p>so <math><mi>a</mi><mspace/><mo>=</mo><mn>4</mn></math>, <svg><path/><text>b</text></svg>"
                     "<xmp><b>&amp;</xmp>c<object>d</object><map>e</map><noscript><i>f</i></noscript><template>no</template><select><option>no</select>")
    assert dom.assemble(page.pieces, [True] * len(page.tags)) == "so a=4, b <b>&amp; c d e f"
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    forest = extract.fit_extractor(pages)
    right = total = 0
    for tag in ("math", "xmp", "object", "map", "noscript"):
        rows = []
        for r in pages.orderBy("page_id").limit(20).collect():
            start = r.html.index("</article>")
            words = "Preformatted words that stand in the article, as its other sentences do, and belong to it."
            rows.append((r.page_id, "u", r.html[:start] + f"<{tag}>{words}</{tag}>" + r.html[start:]))
        got = extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"), forest).collect()
        right, total = right + sum(words in r.text for r in got), total + len(got)
    assert right >= 0.95 * total


def test_quality_on_held_out_rows_and_odd_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in quality.quality_scores(docs, labels).collect()}
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all(rows[r.doc_id].held_out for r in held)
    assert sum(rows[r.doc_id].predicted == r.quality for r in held) >= 0.95 * len(held)
    odd = docs_of(spark, [(1, None, None, None), (None, "", "en", "s"), (1, "x" * 200_000, "en", "s")])
    scored = quality.quality_scores(odd, labels.limit(0)).collect()
    assert len(scored) == 3 and all(0 <= r.score <= 1 for r in scored) and scored[1].held_out


def test_interactions_are_learned():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((gam.fit(x, y).scores(x) > 0.5) == y).mean() > 0.95


def test_empty_tables(spark):
    docs, pages = docs_of(spark, []), spark.createDataFrame([], "page_id long, url string, html string")
    vectors, bench = spark.createDataFrame([], "vec_id long, embedding array<float>"), spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for frame in (jaccard.jaccard_components(docs), lines.line_digest(docs), shards.shard_documents(docs), secret_scan.secret_digest(docs),
                  neighbours.near_vectors(vectors), decontaminate.contamination(docs, bench), mixing.mixed_decisions(docs),
                  mixing.mixed(docs), quality.quality_scores(docs, labels), extract.extract_pages(pages), warc.archive_round_trip(pages)):
        assert frame.count() == 0


def test_stages_equal_brute_force(spark, tmp_path):
    from collections import Counter

    import corpus_pipeline
    from folioforge.session import stage

    folder = str(tmp_path / "sf")
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels, bench = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("labels", "benchmark"))
    rows = [r.asDict() for r in given.orderBy("doc_id").limit(120).collect()]
    item = next(t for _, t in bench.select("item_id", "text").orderBy("item_id").collect() if len(decontaminate.words_of(t)) >= 8)
    rows += [rows[1], rows[1], rows[2] | {"doc_id": None}, rows[3] | {"doc_id": 90_001}, rows[4] | {"doc_id": 90_002, "text": rows[4]["text"] + " end"},
             rows[5] | {"doc_id": 90_003, "text": f"{rows[5]['text']} {item}"}, rows[6] | {"doc_id": None, "text": item}, rows[7] | {"text": rows[3]["text"]},
             rows[8] | {"doc_id": None, "text": None}, rows[9] | {"doc_id": 90_004, "text": ""}]
    spark.createDataFrame(rows, given.schema).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")

    def by_quality(docs):
        score = quality.quality_score(quality.fit_quality(docs, labels))
        return [r[:-1] for r in docs.select("*", score("text").alias("_score")).collect() if r[-1] >= quality.THRESHOLD]

    def by_copies(docs):
        own = docs.collect()
        sets, top = [shingles_of(r.text) for r in own], list(range(len(own)))
        for i in range(len(own)):
            for j in range(i):
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    top = [top[j] if t == top[i] else t for t in top]
        least = {}
        for t, r in zip(top, own, strict=True):
            if r.doc_id is not None:
                least[t] = min(least.get(t, r.doc_id), r.doc_id)
        gone = {r.doc_id for t, r, s in zip(top, own, sets, strict=True) if s and r.doc_id is not None and r.doc_id != least[t]}
        return [r for r in own if r.doc_id not in gone]

    def by_items(docs):
        items = [w for _, t in bench.select("item_id", "text").collect() if len(w := decontaminate.words_of(t)) >= 3]
        held = {r.doc_id for r in docs.collect() if r.text is not None
                and any(decontaminate.best_end(w, decontaminate.words_of(r.text))[0] <= (int(len(w) * 0.2) if len(w) >= 8 else 0) for w in items)}
        return [r for r in docs.collect() if r.doc_id not in held]

    def by_draw(docs):
        copies = plain_mixture(spark, docs)
        return [r for r in docs.collect() for _ in range(copies[(r.doc_id, r.text or "", r.source, r.lang)])]

    docs, sizes = spark.read.parquet(f"{folder}/documents.parquet"), []
    for (name, step), brute in zip(corpus_pipeline.STAGES[:-1], (by_quality, by_copies, by_items, by_draw), strict=True):
        after = stage(step(spark, docs, folder), name)
        assert after.columns == docs.columns
        assert Counter(map(tuple, after.collect())) == Counter(map(tuple, brute(docs))), name
        sizes.append((docs.count(), after.count()))
        docs = after
    assert sizes[1][1] < sizes[1][0] and sizes[2][1] < sizes[2][0] and sizes[3][1] > 0
    last = corpus_pipeline.run(spark, folder).collect()
    assert Counter(map(tuple, last)) == Counter(map(tuple, corpus_pipeline.sharding(spark, docs, folder).collect())) and len(last) == sizes[3][1]
