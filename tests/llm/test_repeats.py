"""Removal of repeated byte strings against a search over all strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from folioforge.llm import repeats


def plain(rows, length):
    datas = [(t or "").encode() for _, t in rows]
    places = {}
    for i, data in enumerate(datas):
        for x in range(len(data) - length + 1):
            places.setdefault(data[x : x + length], []).append((i, x))
    covered = [np.zeros(len(d), bool) for d in datas]
    for found in places.values():
        for i, x in found if len(found) > 1 else ():
            covered[i][x : x + length] = True
    return sorted([(doc_id, len(d), int(c.sum()), int((np.diff(np.r_[0, c.astype(int)]) == 1).sum()),
                    hashlib.sha256(bytes(np.frombuffer(d, np.uint8)[~c])).hexdigest())
                   for (doc_id, _), d, c in zip(rows, datas, covered, strict=True)], key=str)


def rows_of(seed, length):
    """Whole and cut copies, edited copies, runs of one byte and short periods, own text."""
    rng = random.Random(seed)
    own = lambda k: " ".join("".join(rng.choice("abcdeéf") for _ in range(rng.randint(2, 6))) for _ in range(k))
    base = [own(rng.randint(length // 8, length)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            text, lot = rng.choice(base), rng.random()
            if lot < 0.3:
                text = own(rng.randint(1, length // 4))
            elif lot < 0.7:
                begin = rng.randrange(len(text))
                text = text[begin : begin + rng.randint(length // 2, 2 * length)] if lot > 0.45 else text
            elif lot < 0.8:
                text = rng.choice(["a", "xyz"]) * rng.randint(length // 2, 2 * length)
            else:
                letters = list(text)
                for _ in range(3):
                    letters[rng.randrange(len(letters))] = "Q"
                text = "".join(letters)
            parts.append(text)
        rows.append((i, "".join(parts)))
    return [*rows, (900, None), (901, ""), (None, rows[3][1]), (None, "short"), rows[5], rows[5],
            (902, "z" * (length - 1)), (903, "z" * length), (904, "q" * (length + 1))]


def got_of(spark, rows, length, group):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, core long, kind string, at long").repartition(5)
    done = repeats.remove_repeats(frame, length, group).collect()
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in done], key=str)


@pytest.mark.parametrize(("seed", "length", "group"), [(1, 400, 2_000), (2, 40, 2_000), (3, 40, 3), (4, 100, 1)])
def test_removed_bytes_equal_a_search_over_all_strings(spark, seed, length, group):
    rows = rows_of(seed, length)
    want = plain(rows, length)
    assert got_of(spark, rows, length, group) == want and sum(w[2] for w in want) > 1_000


def test_one_very_common_passage(spark):
    """Very many texts share a passage; what surrounds it differs, or agrees for a few bytes."""
    rng = random.Random(9)
    passage = " ".join(str(rng.random()) for _ in range(30))
    rows = [(i, "".join(rng.choice("pqrs") for _ in range(rng.randint(0, 90))) + passage + str(i % 7) + str(rng.random()) * 3) for i in range(400)]
    assert got_of(spark, rows, 400, 50) == plain(rows, 400)


def test_long_text_is_hashed_in_segments(spark, monkeypatch):
    rng = random.Random(2)
    data = np.frombuffer(bytes(rng.choices(range(256), k=20_000)), np.uint8)
    begins = np.sort(np.array(rng.sample(range(19_600), 300)))
    whole, triggers = repeats._Hashes(3).of(data, begins, 400), repeats._triggers(data, 66)
    monkeypatch.setattr(repeats, "SEGMENT", 1_000)
    assert (repeats._Hashes(3).of(data, begins, 400) == whole).all() and (repeats._triggers(data, 66) == triggers).all()


def test_no_documents(spark):
    assert repeats.repeat_digest(spark.createDataFrame([], "doc_id long, text string")).collect() == []
