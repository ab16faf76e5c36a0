"""Line deduplication across documents."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from folioforge.session import stage

SHORTEST = 10  # code points of the shortest key that counts
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_HELD = "line1 long, line2 long, doc_id long, text_key long, at int, place int, edge boolean"


def _first_occurrences(batches):
    """Lines that a smaller document of the same range holds, and the lines of the range's edges.

    Rows come sorted by (line, doc_id, text, position). Only the first line of a range can have
    begun in an earlier one, so its rows are handed on for a look at the other ranges (``edge``),
    and of the other lines the first row, which tells later ranges where the line began.
    """
    open_line, first_doc, first_line = None, None, None
    for batch in batches:
        line1, line2 = batch["line1"].to_numpy(), batch["line2"].to_numpy()
        docs = batch["doc_id"].to_numpy()
        starts = np.r_[True, (line1[1:] != line1[:-1]) | (line2[1:] != line2[:-1])]
        if open_line is not None and (line1[0], line2[0]) == open_line:
            starts[0] = False
        firsts = np.where(starts, docs, 0)
        group = np.cumsum(starts)
        holder = np.r_[0 if first_doc is None else first_doc, firsts[starts]][group]
        if first_line is None:
            first_line = (line1[0], line2[0])
        edge = (line1 == first_line[0]) & (line2 == first_line[1])
        keep = edge | (docs != holder)
        out = batch[keep].copy()
        out["edge"] = edge[keep]
        yield out
        last = np.flatnonzero(starts)
        if len(last):  # where the line that is open now began; an earlier batch's otherwise
            begin = batch.iloc[[last[-1]]]
        open_line, first_doc = (line1[-1], line2[-1]), holder[-1]
    if open_line is not None and open_line != first_line:
        begin = begin.copy()
        begin["edge"] = True
        begin["at"] = np.int32(-1)  # a mark, not a line to drop
        yield begin


@F.pandas_udf(BinaryType())
def _bitmap(dropped: pd.Series) -> pd.Series:
    """A document's keep bitmap: a bit per line up to the last dropped one, compressed."""
    out = []
    for at in dropped:
        keep = np.ones(at.max() + 1, bool)
        keep[at] = False
        out.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 1))
    return pd.Series(out)


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): null texts are empty; the key tells apart rows of one doc_id."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def keep_bitmaps(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_bits, n_dropped, keep) for each document of ``docs`` that loses lines.

    A line's key is the line without blanks at its ends, A-Z lower-cased; keys of fewer than
    ``SHORTEST`` code points don't count. All lines with a key go, except in the smallest doc_id
    that holds it; a null doc_id counts as the largest. Rows that repeat a doc_id are one
    document with several texts. ``keep`` holds a bit per line (1: stays), zlib-compressed;
    lines beyond ``n_bits`` stay.

    Only hashes move: 128 bits of the key, the document and the position, once, by range. A
    line that occurs very often spans several ranges, since doc_id and position are part of the
    range key; the ranges' edges are settled among themselves.
    """
    spark = docs.sparkSession
    key = F.translate(F.trim(F.col("line"), F.lit(BLANKS)), UPPER, LOWER)
    lines = (texts_of(docs)
             .select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc_id"), "text_key",
                     F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
             .select("doc_id", "text_key", "at", key.alias("key")).where(F.char_length("key") >= SHORTEST)
             .select(F.xxhash64("key").alias("line1"), F.xxhash64(F.lit("second"), "key").alias("line2"),
                     "doc_id", "text_key", "at"))
    lines = stage(lines, "lines")
    order = ("line1", "line2", "doc_id", "text_key", "at")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = (lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
            .select(*order, F.spark_partition_id().alias("place"), F.lit(False).alias("edge"))
            .mapInPandas(_first_occurrences, _HELD))
    held = stage(held, "held")
    edges = held.where("edge")
    # At most two lines a range have a row here, however many rows the line has: staged, its size
    # is known, and the many rows of a hot line needn't be dealt by the line.
    holders = stage(edges.groupBy("line1", "line2").agg(F.min("doc_id").alias("holder")), "holders")
    settled = (edges.where("at >= 0").join(holders, ["line1", "line2"]).where("doc_id <> holder")
               .select("doc_id", "text_key", "at"))
    dropped = held.where("not edge").select("doc_id", "text_key", "at").union(settled)
    places = dropped.groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("dropped"))  # of one document
    return places.select(F.when(F.col("doc_id") != 2**63 - 1, F.col("doc_id")).alias("doc_id"), "text_key",
                         (F.array_max("dropped") + 1).alias("n_bits"), F.size("dropped").cast("long").alias("n_dropped"),
                         _bitmap("dropped").alias("keep"))


def apply_bitmaps(docs: DataFrame, maps: DataFrame) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) with the dropped lines taken out; one row per row of ``docs``."""

    def run(batches):
        for batch in batches:
            texts, counts = [], []
            for text, n_bits, keep in zip(batch["text"], batch["n_bits"], batch["keep"], strict=True):
                lines = text.split("\n")
                counts.append(len(lines))
                if keep is not None:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")[: int(n_bits)]
                    lines = [x for x, bit in zip(lines, bits, strict=False) if bit] + lines[int(n_bits):]
                    text = "\n".join(lines)
                texts.append(text)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": texts, "n_lines": counts,
                                "n_dropped": batch["n_dropped"].fillna(0).astype("int64")})

    texts, maps = texts_of(docs), maps.withColumnRenamed("doc_id", "map_id")
    joined = texts.join(maps, (texts["text_key"] == maps["text_key"]) & texts["doc_id"].eqNullSafe(maps["map_id"]), "left")
    return joined.select("doc_id", "text", "n_bits", "keep", "n_dropped").mapInPandas(
        run, "doc_id long, text string, n_lines long, n_dropped long")


def line_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every row of ``docs`` (doc_id, text)."""
    maps = stage(keep_bitmaps(docs), "bitmaps")
    return apply_bitmaps(docs, maps).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
