"""Shards that match the mixture of the whole: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import stage

BUCKET = 20_000  # rows that one task ranks together, about


def _ranked(rows: DataFrame, group: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """``name``: place from 0 of each row in its group by (bucket, order), one bucket a window."""
    sizes = rows.groupBy(*group, bucket).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    own = F.row_number().over(Window.partitionBy(*group, bucket).orderBy(*order)) - 1
    keys = [*group, bucket]
    right = starts.select(*(F.col(k).alias(f"_{k}") for k in keys), "_start")
    ranked = rows.withColumn("_own", own)
    match = [ranked[k].eqNullSafe(right[f"_{k}"]) for k in keys]
    return (ranked.join(right, match, "left").withColumn(name, F.col("_start") + F.col("_own"))
            .drop("_own", "_start", *(f"_{k}" for k in keys)))


def interleave(rows: DataFrame, source: str, keys: list[str], shards: int, seed: int = 0,
               bucket_rows: int = BUCKET) -> DataFrame:
    """``rows`` with _shard (0 to ``shards`` - 1) and _slot (place in the shard, from 0).

    Rows are shuffled within their source by a seeded hash of ``keys`` and ranked; a row's
    fractional rank is (rank + phase) / size of the source, with a phase from 0 to 1 hashed from
    the source, so that sources of a row each spread over all shards. Sorted by it, every run of
    consecutive rows holds the sources in proportion, and the whole is cut into ``shards`` runs
    whose sizes differ by one row at most. Rows with a null source are a source of their own;
    rows equal in all of ``keys`` are interchangeable.

    No task sees a whole source: hashes are dealt to buckets of about ``bucket_rows`` rows, as
    are fractional ranks, and only bucket sizes are summed across.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    # Rows that agree in all keys would meet in one bucket; a salt from their place spreads them.
    rows = stage(rows.withColumns({"_hash": F.md5(text), "_salt": F.xxhash64(F.lit(seed), F.monotonically_increasing_id())}), "shuffled")
    total = rows.count()
    buckets = max(1, -(-total // bucket_rows))
    place = f"(conv(substring(_hash, 1, 6), 16, 10) * 16777216L + pmod(_salt, 16777216L)) / 281474976710656D * {buckets}"
    rows = rows.withColumn("_bucket", F.expr(f"cast(floor({place}) as long)"))
    rows = _ranked(rows, [source], "_bucket", ["_hash", "_salt"], "_rank").drop("_bucket")
    sizes = rows.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_of"))
    rows = rows.join(sizes, rows[source].eqNullSafe(sizes["_source"]), "left").drop("_source")
    phase = F.pmod(F.xxhash64(F.lit(seed), F.lit("phase"), F.coalesce(F.col(source).cast("string"), F.lit(""))), F.lit(2**20))
    rows = rows.withColumn("_phase", phase)
    part = "((cast(_rank as decimal(20,0)) * 1048576 + _phase) * 1048576) div _of"  # 40 bits
    rows = stage(rows.withColumn("_part", F.expr(f"cast({part} as long)")).drop("_phase"), "ranked")
    rows = rows.withColumn("_all", F.lit(0)).withColumn("_bucket", F.expr(f"cast(floor(_part / 1099511627776D * {buckets}) as long)"))
    rows = _ranked(rows, ["_all"], "_bucket", ["_part", "_hash", "_salt"], "_at")
    shard = F.expr(f"_at * {shards} div {max(total, 1)}")
    first = F.expr(f"(_shard * {total} + {shards - 1}) div {shards}")
    return (rows.withColumn("_shard", shard.cast("int")).withColumn("_slot", F.col("_at") - first)
            .drop("_salt", "_hash", "_rank", "_of", "_part", "_all", "_bucket", "_at"))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 0, bucket_rows: int = BUCKET) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and source for every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 (null: 1), ``text_crc32`` that of the same bytes
    (null: of none). The law is ``rows``: shards differ by one row at most; ``slot`` counts
    from 0 without gaps in each shard. Repeated rows are rows of their own.
    """
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                         (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = interleave(narrow, "source", ["doc_id", "text_crc32", "size"], shards, seed, bucket_rows)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_shard").alias("shard"),
                        F.col("_slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "source")
