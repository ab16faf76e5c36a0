"""WARC archives: written with revisits, read back by verified chains of records."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.session import new_path, stage
from folioforge.sources.files import open_bytes

SHORTEST = 1000  # bytes of the smallest payload that others may revisit
CHUNK = 8 * 2**20  # bytes of an archive that a task looks through
HEADER = 2**20  # bytes beyond a chunk that are read at first; more if a header needs them
END = "\r\n\r\n"  # between records
DATE = "2024-01-01T00:00:00Z"
_MAGIC = b"WARC/1.1\r\n"
_HEADER = re.compile(rb"WARC/1\.1\r\n((?:[A-Za-z0-9-]+:[^\r\n]*\r\n)+)\r\n")
_BEGUN = re.compile(rb"WARC/1\.1\r\n(?:[A-Za-z0-9-]++:[^\r\n]*+\r\n)*+(?:[A-Za-z0-9-]++(?::[^\r\n]*+)?+)?+\r?+\Z")  # as far as it was read


def write_archives(pages: DataFrame, path: str, date: str = DATE) -> None:
    """A record per row of ``pages`` (page_id, url, html) in the files of folder ``path``.

    Of payloads of at least ``SHORTEST`` bytes that are equal, the one with the largest page_id
    is a response and the others are revisits, which refer to it and carry no payload. Null html
    is an empty payload, a null url is left out, a null page_id is written as ``null`` and never
    preferred. Rows that repeat the largest page_id are responses each.

    Records end with what Spark's text writer puts between lines, so files are written by its
    commit protocol on any file system. Payloads move only if the table of revisits is too large
    to broadcast: it is staged first, and its size is known when the join is planned.
    """
    payload = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         payload.alias("payload"), F.sha1(payload).alias("digest"),
                         F.octet_length(payload).cast("long").alias("size"))
    large = stage(pages.where(F.col("size") >= SHORTEST).select("page_id", "digest"), "digests")
    first = (large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
             .where("n > 1 and refers_to is not null").select("digest", "refers_to"))
    again = (large.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
             .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to").distinct())
    again = stage(again, "revisits")
    match = pages["page_id"].eqNullSafe(again["_id"]) & (pages["digest"] == again["_digest"])
    rows = pages.join(again, match, "left")

    def line(name, value):
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", F.lit("text/html; charset=utf-8")),
                    line("Content-Length", F.col("size").cast("string")), F.lit("\r\n"))
    block = F.when(revisit, F.col("http")).otherwise(F.concat("http", "payload"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    record = F.concat(
        F.lit(_MAGIC.decode()), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(">"))),
        line("WARC-Date", F.lit(date)), F.coalesce(line("WARC-Target-URI", url), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", (F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("size"))).cast("string")),
        F.lit("\r\n"), block)
    rows.withColumn("http", http).select(record.alias("value")).write.option("lineSep", END).text(path)


def _candidates(chunk_bytes: int):
    """Every place of a chunk that reads like the start of a record, and where the record would end.

    Within the chunk chains are followed at once: ``leaves`` is the first place beyond the chunk
    on the chain of a candidate. ``first`` and ``last`` number the candidates such that those
    whose chain leads through a candidate have a ``first`` from its ``first`` to before its ``last``.
    """

    def run(batches):
        for batch in batches:
            for path, chunk, length in zip(batch["path"], batch["chunk"], batch["length"], strict=True):
                start = int(chunk) * chunk_bytes
                with open_bytes(path) as stream:
                    stream.seek(start)
                    data = stream.read(chunk_bytes + HEADER)
                    at = data.find(_MAGIC)
                    while 0 <= at < chunk_bytes:  # a header that was cut off is read to its end
                        while not _HEADER.match(data, at) and _BEGUN.match(data, at) and (more := stream.read(len(data))):
                            data += more
                        at = data.find(_MAGIC, at + 1)
                rows, at = [], data.find(_MAGIC)
                while 0 <= at < chunk_bytes:
                    if match := _HEADER.match(data, at):
                        fields = dict(x.split(": ", 1) for x in match[1].decode("utf-8", "replace").split("\r\n") if ": " in x)
                        size = fields.get("Content-Length", "")
                        if size.isdigit():
                            after = start + match.end() + int(size) + len(END)
                            if after <= length:
                                rows.append((start + at, after, start + match.end(), int(size), fields.get("WARC-Type"),
                                             fields.get("WARC-Record-ID"), fields.get("WARC-Refers-To"), fields.get("WARC-Payload-Digest")))
                    at = data.find(_MAGIC, at + 1)
                number = {row[0]: i for i, row in enumerate(rows)}
                after = [number.get(row[1]) for row in rows]
                sizes = [1] * len(rows)
                for i, then in enumerate(after):  # a record's successor lies after it
                    if then is not None:
                        sizes[then] += sizes[i]
                first, free, leaves, roots = [0] * len(rows), [0] * len(rows), [0] * len(rows), 0
                for i in range(len(rows) - 1, -1, -1):
                    then = after[i]
                    if then is None:
                        first[i], leaves[i] = roots, rows[i][1]
                        roots += sizes[i]
                    else:
                        first[i], leaves[i] = free[then], leaves[then]
                        free[then] += sizes[i]
                    free[i] = first[i] + 1
                out = pd.DataFrame(rows, columns=["start", "after", "block", "size", "kind", "record_id", "refers_to", "digest"])
                yield out.assign(path=path, chunk=np.int64(chunk), leaves=np.array(leaves, np.int64),
                                 first=np.array(first, np.int64), last=np.array(first, np.int64) + np.array(sizes, np.int64)).drop(columns="after")

    return run


_FOUND = ("start long, block long, size long, kind string, record_id string, refers_to string, digest string, "
          "path string, chunk long, leaves long, first long, last long")


def read_records(spark: SparkSession, path: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """The records of the archives in folder ``path``: path, start, kind, record_id, refers_to, digest, block, size.

    Files are looked through in chunks, for candidates and their successors. Pointer jumping
    from the start of each file then reaches a place in every chunk, in as many rounds as the
    number of chunks has bits, and only candidates on the chain from there are records: a
    record's magic inside a payload is never reached. A file whose chain doesn't end exactly at
    its length holds something else or a damaged record, and is an error.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    chunks = files.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (length - 1) div {chunk_bytes})")))
    found = stage(chunks.repartition(parts, "path", "chunk").mapInPandas(_candidates(chunk_bytes), _FOUND), "candidates")
    most = files.agg(F.max((F.col("length") - 1) / chunk_bytes)).first()[0] or 0
    reached = files.select("path", F.lit(0).cast("long").alias("start"))
    jumps = found.select("path", "start", "leaves")
    for _ in range(int(most).bit_length()):
        reached = stage(reached.union(reached.join(jumps, ["path", "start"]).select("path", F.col("leaves").alias("start"))).distinct(), "reached")
        then = jumps.select("path", F.col("start").alias("leaves"), F.col("leaves").alias("further"))
        jumps = stage(jumps.join(then, ["path", "leaves"]).select("path", "start", F.col("further").alias("leaves")), "jumps")
    entries = stage(found.join(reached, ["path", "start"]).select("path", "chunk", F.col("first").alias("entry"), "leaves"), "entries")
    ends = entries.select("path", F.col("leaves").alias("length"))
    if broken := files.join(ends, ["path", "length"], "left_anti").select("path").take(1):
        raise ValueError(f"{broken[0][0]} has bytes that no record of it leads to")
    entries = entries.drop("leaves")
    return (found.join(entries, ["path", "chunk"]).where("first <= entry and entry < last")
            .select("path", "chunk", "start", "kind", "record_id", "refers_to", "digest", "block", "size"))


def _payloads(batches):
    """Length and SHA-1 of the payload of each record, which is read by its place."""
    stream, opened = None, None
    for batch in batches:
        sizes, digests = [], []
        for path, block, size in zip(batch["path"], batch["block"], batch["size"], strict=True):
            if path != opened:
                stream, opened = open_bytes(path), path
            stream.seek(int(block))
            payload = stream.read(int(size)).partition(END.encode())[2]
            sizes.append(len(payload))
            digests.append(hashlib.sha1(payload).hexdigest())
        yield batch[["record_id", "kind", "refers_to"]].assign(payload_bytes=np.array(sizes, np.int64), payload_digest=digests)


def read_payloads(spark: SparkSession, path: str, chunk_bytes: int = CHUNK) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in ``path``.

    A revisit's payload is that of the response it refers to.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    records = read_records(spark, path, chunk_bytes).repartition(parts, "path", "chunk").sortWithinPartitions("path", "start")
    read = stage(records.mapInPandas(
        _payloads, "record_id string, kind string, refers_to string, payload_bytes long, payload_digest string"), "payloads")
    whole = (read.where("kind = 'response'").groupBy(F.col("record_id").alias("_of"))
             .agg(F.max(F.struct("payload_bytes", "payload_digest")).alias("_p")))

    def page(column):
        return F.expr(f"try_cast(regexp_extract({column}, '<urn:page:(.*)>', 1) as long)")

    # Responses stay as they are; only revisits look for the payload they stand for.
    again = (read.where("kind = 'revisit'").join(whole, F.col("refers_to") == F.col("_of"), "left")
             .select(page("record_id").alias("page_id"), "_p.payload_bytes", "_p.payload_digest",
                     F.col("kind").alias("record_type"), page("refers_to").alias("refers_to")))
    responses = read.where("kind = 'response'").select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to"))
    return responses.unionByName(again)


def archive_round_trip(pages: DataFrame, chunk_bytes: int = CHUNK) -> DataFrame:
    """``pages`` written as archives to the shared folder and read back."""
    path = new_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_payloads(pages.sparkSession, path, chunk_bytes)
