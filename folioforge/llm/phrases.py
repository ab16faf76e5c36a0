"""Phrases that occur often, mined shard by shard and counted exactly (SON partitioning)."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from folioforge.llm.grams import _FACTORS, WordHashes, mix
from folioforge.session import stage

SUPPORT = 100  # occurrences of the rarest phrase that counts
LONGEST = 5  # words of the longest phrase
TOP = 2000  # phrases reported per language
SHARDS = 16  # parts of the corpus that are mined each by itself
BLOCK_WORDS = 1_500_000  # words of a shard that a task holds at once
FILTER_BITS = 1 << 26  # of a filter in the tasks; more phrases make it weaker, never wrong
SALTS = 64
STEP = 100_000  # places or phrases handled together

_BREAK = b"\xff"  # never part of UTF-8
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + _BREAK * 10)


class _Words(dict):
    """Word -> number in order of first sight; 0 is the break between pieces."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _numbers(text: str, words: _Words) -> np.ndarray:
    """A text's words as numbers, pieces kept apart by zeros, one zero at the end."""
    found = text.encode("utf-8", "surrogatepass").translate(_FOLD).replace(_BREAK, b" \xff ").split()
    ids = np.zeros(len(found) + 1, np.int32)
    ids[:-1] = np.fromiter(map(words.__getitem__, found), np.int32, len(found))
    return ids


def _blocks(batches, size: int):
    """(language, words, numbers of its texts) of a task's next ``size`` words, language by language."""

    def packed(parts):
        for lang, (words, ids) in parts.items():
            ids = np.concatenate(ids)
            if ids.any():
                yield lang, list(words), ids

    parts, held = {}, 0
    for batch in batches:
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):  # one text at a time
            words, ids = parts.setdefault(lang.as_py(), (_Words(), []))
            ids.append(_numbers(text.as_py(), words))
            held += len(ids[-1])
            if held >= size:
                yield from packed(parts)
                parts, held = {}, 0
    yield from packed(parts)


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 7))


def _hashes(lang: str, hashes: np.ndarray) -> np.ndarray:
    """Hashes of phrases given as rows of word hashes."""
    k = hashes.shape[1]
    return mix(_seed(lang) + np.uint64(k) + (hashes * _FACTORS[:k]).sum(1, dtype=np.uint64))


def _slots(lang: str, hashes: np.ndarray) -> np.ndarray:
    """Places in a filter of phrases given as rows of word hashes."""
    return (_hashes(lang, hashes) % np.uint64(FILTER_BITS)).astype(np.int64)


def _filter_of(phrases: DataFrame):
    """The filter of a table (lang, phrase), broadcast: ``FILTER_BITS`` bits whatever the table's size."""
    hashes = WordHashes()

    @F.pandas_udf(LongType())
    def slot(lang: pd.Series, phrase: pd.Series) -> pd.Series:
        return pd.Series([int(_slots(x, np.array([[hashes[w] for w in p.encode("utf-8", "surrogatepass").split(b" ")]], np.uint64))[0])
                          for x, p in zip(lang, phrase, strict=True)], dtype="int64")

    return _bits(phrases.select(slot("lang", "phrase").alias("slot")))


def _bits(slots: DataFrame):
    rows = (slots.groupBy(F.expr("slot div 32768").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.expr("slot % 32768")).alias("bits")).collect())
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in rows:
        bits[row["bucket"] * 4096 : row["bucket"] * 4096 + 4096] = np.frombuffer(row["bits"], np.uint8)
    return slots.sparkSession.sparkContext.broadcast(bits)


def _found(words: list[bytes], lang: str, ids: np.ndarray, lengths, filters):
    """(k, phrases as rows of word numbers, their hashes, counts) of all phrases of ``lengths`` in a block.

    ``filters`` holds, by length, what phrases and their parts may be; a phrase is looked at only
    where the two phrases one word shorter passed. Phrases are named exactly: by the number of
    the phrase without its last word, and that word.
    """
    hashes, known = np.zeros(len(words), np.uint64), WordHashes()
    hashes[1:] = [known[w] for w in words[1:]]
    may = np.zeros(len(words), bool)
    may[1:] = _passes(filters[1], lang, hashes[1:, None])
    names = np.where(may, np.arange(len(words), dtype=np.int32), np.int32(-1))[ids]
    spelt, base = np.arange(len(words))[:, None], len(words)
    for k in range(2, max(lengths) + 1):
        good = (names[:-1] >= 0) & (names[1:] >= 0)
        if k in filters:
            for part in np.split(np.flatnonzero(good), range(STEP, int(good.sum()), STEP)):
                good[part] = _passes(filters[k], lang, np.stack([hashes[ids[part + i]] for i in range(k)], 1))
        at = np.flatnonzero(good).astype(np.int32)  # a block never has more places
        codes = names[at].astype(np.int64)
        codes *= base
        codes += ids[at + k - 1]
        more = k < max(lengths)
        ordered = np.sort(codes) if more else codes
        if not more:
            ordered.sort()
        ends = np.flatnonzero(np.concatenate([ordered[1:] != ordered[:-1], [True]])) if len(ordered) else np.empty(0, np.int64)
        found, counts = ordered[ends], np.diff(ends, prepend=-1)
        del ordered
        spelt = np.concatenate([spelt[found // base], found[:, None] % base], 1)
        if k in lengths:
            yield k, spelt, hashes, counts
        if more and len(found):
            place = np.minimum(np.searchsorted(found, codes), len(found) - 1)
            names = np.full(len(ids), -1, np.int32)
            passed = found[place] == codes
            names[at[passed]] = place[passed]
        elif not len(found):
            return


def _passes(bits: np.ndarray, lang: str, hashes: np.ndarray) -> np.ndarray:
    slots = _slots(lang, hashes)
    return bits[slots >> 3] >> (slots & 7) & 1 == 1


_COUNTS = "lang string, phrase string, k int, f long"


def _rows(lang, phrases, k, counts) -> pa.RecordBatch:
    size = len(phrases)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * size, pa.string()), pa.array(phrases, pa.string()), pa.array([k] * size, pa.int32()),
         pa.array(counts, pa.int64())], ["lang", "phrase", "k", "f"])


def _words(texts: DataFrame, size: int) -> DataFrame:
    """(lang, word, 1, count) of each block; the number of words goes along as a row without a phrase."""

    def run(batches):
        for lang, words, ids in _blocks(batches, size):
            yield _rows(lang, [None], 0, [int((ids > 0).sum())])
            counts = np.bincount(ids, minlength=len(words))[1:]
            yield _rows(lang, [w.decode("utf-8", "surrogatepass") for w in words[1:]], 1, counts)

    return texts.mapInArrow(run, _COUNTS)


_LOCAL = "shard int, k int, hash long, f long"


def _mined(texts: DataFrame, lengths, filters, size: int, shards: int) -> DataFrame:
    """(shard, k, hash, f): the phrases of each block that pass the filters, by a hash of language and words.

    Tasks go to the shards in turn.
    """

    def run(batches):
        bits = {k: b.value for k, b in filters.items()}
        shard = TaskContext.get().partitionId() % shards
        for lang, words, ids in _blocks(batches, size):
            for k, spelt, hashes, counts in _found(words, lang, ids, lengths, bits):
                for begin in range(0, len(spelt), STEP):
                    part = _hashes(lang, hashes[spelt[begin : begin + STEP]]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), shard, np.int32)),
                         pa.array(np.full(len(part), k, np.int32)), pa.array(part), pa.array(counts[begin : begin + STEP].astype(np.int64))],
                        ["shard", "k", "hash", "f"])

    return texts.mapInArrow(run, _LOCAL)


def _phrases(texts: DataFrame, lengths, filters, size: int) -> DataFrame:
    """(lang, phrase, k, f): the phrases of each block that pass the filters."""

    def run(batches):
        bits = {k: b.value for k, b in filters.items()}
        for lang, words, ids in _blocks(batches, size):
            for k, spelt, _, counts in _found(words, lang, ids, lengths, bits):
                for begin in range(0, len(spelt), STEP):
                    part = spelt[begin : begin + STEP].tolist()
                    yield _rows(lang, [b" ".join([words[i] for i in row]).decode("utf-8", "surrogatepass") for row in part],
                                k, counts[begin : begin + STEP])

    return texts.mapInArrow(run, _COUNTS)


def phrase_counts(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST,
                  block_words: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """(lang, phrase, k, f): words per language (k = 0, no phrase), and all phrases of 1 to ``longest``
    words with f >= ``support``, counted exactly.

    Words are counted first. Two steps follow, pairs and then longer phrases, of two passes over the
    texts each. The first mines ``shards`` parts of the corpus completely, at a ``shards``-th of the
    support: tasks count their texts, ``block_words`` words at a time, and Spark adds up each shard's
    counts. A phrase that reaches the support reaches that share in some shard, so the union
    of what the shards found holds every result. The second counts the union in all texts. Tasks know
    the union, the frequent words and the frequent pairs as filters of fixed size; what passes by
    chance is counted like the rest. The first pass moves hashes only: equal ones of
    different phrases add a candidate, which the second counts as what it is.
    """
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    total = lambda rows: rows.groupBy("lang", "phrase", "k").agg(F.sum("f").alias("f"))
    often = F.col("f") >= support
    known = stage(total(_words(texts, block_words)).where(often | (F.col("k") == 0)), "words")
    filters = {1: _filter_of(known.where("k = 1"))}
    for lengths in ([2], range(3, longest + 1)):
        if not lengths or longest < 2:
            break
        local = _mined(texts, lengths, filters, block_words, shards).groupBy("shard", "k", "hash").agg(F.sum("f").alias("f"))
        union = stage(local.where(F.col("f") * shards >= support).select("k", F.pmod("hash", F.lit(FILTER_BITS)).alias("slot")).distinct(), "union")
        bits = {k: _bits(union.where(F.col("k") == k)) for k in lengths}
        counted = stage(total(_phrases(texts, lengths, filters | bits, block_words)).where(often), "counts")
        known = known.union(counted)
        filters = filters | {2: _filter_of(counted)} if lengths == [2] else filters
    return known


def collocations(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    A-Z are lower-cased, pieces end at ``[.,;:!?\\x0A-\\x0D]``, words are ``[^\\x20\\x09]+``. Null
    texts are empty, a null language is ``und``; rows that repeat count each time. ``score`` is
    floor(1000 a n / (l r)) at the cut of the phrase that scores least (the leftmost of equal
    ones). A phrase inside a longer one that is as frequent is left out. Ranks go by score, a (both
    descending) and phrase in byte order.
    """
    known = stage(phrase_counts(docs, support, longest), "known")
    phrases = known.where("k >= 2").withColumn("w", F.split("phrase", " "))
    part = known.where("k >= 1")
    join = lambda words: F.array_join(words, " ")
    cuts = phrases.select(
        "lang", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"), "w", "k",
    ).select("lang", "phrase", "a", "cut", join(F.slice("w", F.lit(1), F.col("cut"))).alias("left"),
             join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("right"))
    side = lambda name, f: part.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    big = lambda c: F.col(c).cast("decimal(18,0)")
    scored = (
        cuts.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
        .join(known.where("k = 0").select("lang", F.col("f").alias("n")), "lang")
        .withColumn("x", F.lit(1000) * big("a") * big("n")).withColumn("y", big("l") * big("r"))
        .withColumn("score", F.expr("x div y"))
        .groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
        .select("lang", "phrase", "a", "n", "m.score", "m.l", "m.r"))
    # A longer phrase as frequent holds one, as frequent, of just a word more.
    inner = lambda begin: phrases.where("k >= 3").select(
        "lang", join(F.slice("w", F.lit(begin), F.col("k") - 1)).alias("phrase"), "f")
    longer = inner(1).union(inner(2)).groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where("longer is null or longer < a")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    # First within salted parts of a language, so that no task sorts a language whole.
    first = kept.withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    ranked = first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
