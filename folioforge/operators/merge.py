"""Merging rows by document identifier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions.text import document_id
from folioforge.operators.records import normalize_schema

# A filter of keys has 512 bitmaps of 4 KB, however many keys there are.
FILTER_BITS, BITMAP_BITS = 1 << 24, 1 << 15


def _one_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    # Catalyst turns "row_number = 1" into a group limit that runs before the shuffle
    # as well: every map task sends at most one row per key, however hot the key is.
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def keep_last(df: DataFrame, order: list[str], key: list[str] | str = "document_id") -> DataFrame:
    """The last row per key in arrival order; rows without a key collapse to one."""
    keys = [key] if isinstance(key, str) else key
    return _one_per_key(df, keys, [F.col(c).desc() for c in order])


def first_wins(df: DataFrame, order: list[str], key: list[str] | str = "document_id") -> DataFrame:
    """The first row per key in arrival order."""
    keys = [key] if isinstance(key, str) else key
    return _one_per_key(df, keys, [F.col(c).asc() for c in order])


def search_union(variants: list[DataFrame], order: list[str], key: str = "requested_id") -> DataFrame:
    """Union of search results in variant order, each document once, first one wins."""
    numbered = [df.withColumn("variant_no", F.lit(n)) for n, df in enumerate(variants)]
    return first_wins(reduce(DataFrame.unionByName, numbered), ["variant_no", *order], key)


def stored_ids(corpus: DataFrame) -> DataFrame:
    """Identifiers in the corpus; a scan of this reads the identifier column only."""
    return corpus.where(F.col("document_id") != "").select("document_id")


def new_documents(summaries: DataFrame, corpus: DataFrame, key: str = "requested_id") -> DataFrame:
    """Summaries whose document is not stored yet; partial rows count as stored.

    The stored identifiers are first cut down to those asked for. That semi join can
    broadcast the small summary side, so a huge corpus is scanned but not shuffled.
    """
    asked = summaries.select(F.col(key).alias("document_id"))
    found = stored_ids(corpus).join(asked, "document_id", "left_semi")
    return summaries.join(found, summaries[key] == found["document_id"], "left_anti")


def missing_references(references: DataFrame, corpus: DataFrame) -> DataFrame:
    """Distinct wanted references that the corpus does not hold."""
    wanted = references.select("reference").distinct()
    return new_documents(
        wanted.withColumn("requested_id", document_id(F.col("reference"))), corpus
    )


def may_match(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose ``on`` may be among ``keys``: all that are, and few others. An exact join follows.

    Hashes of the keys are set in bitmaps of 2 MB together, which go to where the rows are read, so what no
    key asks for isn't shuffled, also when the keys are too many to be broadcast. Beyond some
    ten million keys the bitmaps fill up: more rows pass, none is lost.
    """
    slot = F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in on]), F.lit(FILTER_BITS))
    place = F.col("_slot") % BITMAP_BITS
    bitmap = F.floor(F.col("_slot") / BITMAP_BITS)
    bitmaps = (
        keys.select(slot.alias("_slot"))
        .groupBy(bitmap.alias("_bitmap"))
        .agg(F.bitmap_construct_agg(place).alias("_bits"))
    )
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumn("_slot", slot).join(F.broadcast(bitmaps), bitmap == F.col("_bitmap"))
    return marked.where(F.getbit(byte, (place % 8).cast("int")) == 1).drop("_slot", "_bitmap", "_bits")


def append_upsert(
    stored: DataFrame,
    incoming: DataFrame,
    order: list[str],
    stored_order: list[str] | None = None,
) -> DataFrame:
    """Stored rows and incoming rows, the newest copy per document, corpus columns only.

    ``order`` are the arrival columns of ``incoming``. A corpus written by this library
    is unique by identifier: its rows are not shuffled, only those about to be replaced
    are left out. For a corpus that may repeat documents, name its arrival columns in
    ``stored_order``; it is then reduced first.
    """
    newest = keep_last(normalize_schema(incoming, keep=tuple(order)), order).drop(*order)
    if stored_order is None:
        kept = normalize_schema(stored)
    else:
        kept = keep_last(normalize_schema(stored, keep=tuple(stored_order)), stored_order)
        kept = kept.drop(*stored_order)
    replaced = newest.select(F.col("document_id").alias("_id"))
    untouched = kept.join(replaced, F.col("document_id").eqNullSafe(F.col("_id")), "left_anti")
    return untouched.unionByName(newest)


def insert_only_merge(stored: DataFrame, incoming: DataFrame, order: list[str]) -> DataFrame:
    """Add documents that are not stored; stored rows stay as they are."""
    added = new_documents(first_wins(incoming, order), stored, key="document_id")
    return normalize_schema(stored).unionByName(normalize_schema(added))


def replace_partials(stored: DataFrame, recovered: DataFrame, order: list[str]) -> DataFrame:
    """Put recovered rows in the place of the partial rows of the same documents."""
    return append_upsert(stored, recovered, order)
