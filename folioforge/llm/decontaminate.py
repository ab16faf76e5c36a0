"""Benchmark items inside documents, by pieces of the items and edit distance in words."""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET = 0.2  # edits allowed for each word of an item
WHOLE = 8  # items of fewer words are looked for without edits
SHORTEST = 3  # words of the shortest item that is looked for
BLOCK_BYTES = 4_000_000  # UTF-8 bytes of items that are looked for in one pass over the documents
# Scripts without blanks between words: Thai to Tibetan, Burmese, Khmer, kana, ideographs. Each character is a word.
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(f"(?:(?![{_UNSPACED}])\\w)+|[{_UNSPACED}]")


def words_of(text: str | None) -> list[str]:
    """The text's words in lower case, without marks; single characters in scripts without blanks."""
    return _WORD.findall((text or "").lower())


def pieces(words: list[str], budget: int) -> list[tuple[int, list[str]]]:
    """The item cut into ``budget`` + 1 runs: wherever it occurs with so many edits, one run is whole."""
    cuts = [len(words) * i // (budget + 1) for i in range(budget + 2)]
    return [(lo, words[lo:hi]) for lo, hi in zip(cuts, cuts[1:], strict=False) if hi > lo]


def best_end(item: list[str], text: list[str]) -> tuple[int, int]:
    """(distance, end) of the closest stretch of ``text`` to ``item``, in words; the first of equals.

    Myers' bit-parallel columns, with a Python integer as the bit vector: a step per word of
    the text, whatever the length of the item.
    """
    size = len(item)
    where: dict[str, int] = {}
    for i, word in enumerate(item):
        where[word] = where.get(word, 0) | 1 << i
    full, top = (1 << size) - 1, 1 << (size - 1)
    rise, fall, score = full, 0, size
    best, end = size, 0
    for at, word in enumerate(text):
        match = where.get(word, 0)
        diagonal = (((match & rise) + rise) ^ rise) | match | fall
        up, down = fall | ~(diagonal | rise) & full, rise & diagonal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & full, down << 1 & full  # a stretch may begin anywhere at no cost
        rise, fall = (down | ~(diagonal | up)) & full, up & diagonal
        if score < best:
            best, end = score, at + 1
    return best, end


class Index:
    """All pieces of a block of items in one automaton over words joined by spaces."""

    def __init__(self, items: list[tuple[int, str]], rate: float, shortest: int):
        self.items, holders = [], {}
        for item_id, text in items:
            words = words_of(text)
            if len(words) >= shortest:
                budget = int(len(words) * rate) if len(words) >= WHOLE else 0
                for at, piece in pieces(words, budget):
                    holders.setdefault(" " + " ".join(piece) + " ", []).append((len(self.items), at, len(piece)))
                self.items.append((item_id, words, budget))
        self.automaton = ahocorasick.Automaton()
        for key, value in holders.items():
            self.automaton.add_word(key, value)
        if holders:
            self.automaton.make_automaton()

    def search(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, first word, end word) of the best occurrence of each item in the text."""
        words = words_of(text)
        if not words or not self.items:
            return []
        joined = " " + " ".join(words) + " "
        starts, found = None, {}
        for stop, holders in self.automaton.iter(joined):
            if starts is None:
                starts = np.cumsum([1] + [len(w) + 1 for w in words])
            past = int(np.searchsorted(starts, stop, side="right")) - 1  # words up to the piece's last
            for number, at, size in holders:
                found.setdefault(number, set()).add(past - size + 1 - at)  # where the item would begin
        out = []
        for number, begins in found.items():
            item_id, item, budget = self.items[number]
            best, windows = None, []
            for begin in sorted(begins):
                lo, hi = max(0, begin - budget), min(len(words), begin + len(item) + budget)
                if windows and lo <= windows[-1][1]:  # windows that meet are searched as one
                    windows[-1][1] = max(hi, windows[-1][1])
                else:
                    windows.append([lo, hi])
            for lo, hi in windows:
                distance, end = best_end(item, words[lo:hi])
                if distance <= budget and (best is None or distance < best[0]):
                    back, length = best_end(item[::-1], words[lo : lo + end][::-1])
                    best = (distance, lo + end - length, lo + end)
            if best is not None:
                out.append((item_id, *best))
        return sorted(out)


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Lists of (item_id, text) of bounded size, streamed from the table in order of id."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long"), "text").where("text is not null").distinct().orderBy("item_id", "text")
    for item_id, text in rows.toLocalIterator():
        if block and size + len(text.encode()) > block_bytes:
            yield block
            block, size = [], 0
        block.append((item_id, text))
        size += len(text.encode())
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, shortest: int = SHORTEST,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, distance, first_word, end_word: the items that documents hold.

    An item of n words occurs in a text if some stretch of its words is at an edit distance of
    at most ``budget`` * n words. Case and marks don't count. Texts are searched whole, each in
    one pass for a block of items: the pieces of bounded length that an occurrence must leave
    whole are found by one automaton, and only around them distances are computed. The items are
    broadcast block by block, never more than ``block_bytes`` (or one item) at once.

    Items of fewer than ``WHOLE`` words are found only whole, without edits. Items of fewer than
    ``shortest`` words stand in texts by chance; they, null items and null texts are found nowhere. Rows
    that repeat a doc_id are searched each by itself; equal (item_id, text) rows count once.
    """
    schema = "doc_id long, item_id long, distance int, first_word int, end_word int"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null")
    found = None
    for block in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def search(batches, shared=shared):
            index = Index(shared.value, budget, shortest)
            for batch in batches:
                rows = [(doc_id, *hit) for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True)
                        for hit in index.search(text)]
                if rows:
                    out = pd.DataFrame(rows, columns=["doc_id", "item_id", "distance", "first_word", "end_word"])
                    yield out.astype({"doc_id": "Int64", "item_id": "Int64"})

        hits = texts.mapInPandas(search, schema)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return docs.sparkSession.createDataFrame([], schema)
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` that hold no item; a text with its items' words is gone whole.

    Rows are told apart by doc_id: if several rows repeat one, an item in any of them takes all.
    """
    held = contamination(docs, benchmark, **limits).select(F.col("doc_id").alias("_held")).distinct()
    return docs.join(held, docs["doc_id"].eqNullSafe(held["_held"]), "left_anti")
