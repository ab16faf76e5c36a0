"""Incremental top-ups with Structured Streaming.

Rows land as files. Each micro-batch adds the documents that are not stored yet as its
own part of the corpus, so nothing stored is ever rewritten. A part is named by the stream
and the batch: another checkpoint is another stream and writes parts of its own. Beside its rows
a part keeps their keys in hash buckets; a batch looks at the buckets that its own keys fall into.
``compact_ids`` and ``compact_latest`` fold the small files of many parts together.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.merge import first_wins, keep_last
from folioforge.session import staged
from folioforge.sources.files import children, exists, touch

# Buckets of stored keys. A batch opens those it touches; more buckets make them smaller.
BUCKETS = 64
_PLACE = [T.StructField("stream", T.StringType()), T.StructField("part", T.LongType())]
Place = tuple[str, int]


def read_parts(
    spark: SparkSession, root: str, schema: T.StructType, but: Place | None = None
) -> DataFrame:
    """All parts of a streamed corpus, or all but that of one (stream, batch)."""
    return _placed(spark, f"{root}/rows", schema, but).drop("stream", "part")


def _placed(spark: SparkSession, folder: str, schema: T.StructType, but: Place | None = None) -> DataFrame:
    whole = T.StructType([*schema.fields, *_PLACE])
    if not exists(spark, folder):
        return spark.createDataFrame([], whole)
    parts = spark.read.schema(whole).parquet(folder)
    if but is not None:
        parts = parts.where((F.col("stream") != but[0]) | (F.col("part") != but[1]))
    return parts


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def bucket_paths(spark: SparkSession, root: str, buckets: list[int], but: Place | None = None) -> list[str]:
    """Folders that hold the stored keys of some buckets: compacted ones, and those of parts since then."""
    wanted, folders = {f"bucket={b}" for b in buckets}, []
    bases = sorted(int(name) for name in children(spark, f"{root}/ids-base") if exists(spark, f"{root}/ids-base/{name}/_SUCCESS"))
    folded = set()
    if bases:
        folders.append(f"{root}/ids-base/{bases[-1]}")
        folded = set(children(spark, f"{root}/ids-folded/{bases[-1]}"))
    for stream in children(spark, f"{root}/ids"):
        for part in children(spark, f"{root}/ids/{stream}"):
            name = f"{stream.partition('=')[2]}.{part.partition('=')[2]}"
            if name not in folded and (but is None or name != f"{but[0]}.{but[1]}"):
                folders.append(f"{root}/ids/{stream}/{part}")
    return [f"{folder}/{name}" for folder in folders for name in children(spark, folder) if name in wanted]


def _stored_keys(spark: SparkSession, paths: list[str], field: T.StructField) -> DataFrame:
    schema = T.StructType([field])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact_ids(spark: SparkSession, root: str, key: str, schema: T.StructType) -> None:
    """Fold the keys of all parts into one file a bucket; parts that come later stand beside them.

    Not to be run while a stream writes to ``root``. A compaction that was cut off isn't seen.
    """
    paths = bucket_paths(spark, root, list(range(BUCKETS)))
    if not paths:
        return
    number = max((int(name) for name in children(spark, f"{root}/ids-base")), default=0) + 1
    for stream in children(spark, f"{root}/ids"):
        for part in children(spark, f"{root}/ids/{stream}"):
            touch(spark, f"{root}/ids-folded/{number}/{stream.partition('=')[2]}.{part.partition('=')[2]}")
    _write_keys(_stored_keys(spark, paths, schema[key]), key, f"{root}/ids-base/{number}")


def _write_keys(rows: DataFrame, key: str, path: str) -> None:
    (rows.select(key, _bucket(key).alias("bucket")).repartition("bucket").sortWithinPartitions("bucket", key)
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The identifier that Spark keeps in a checkpoint from its first batch on."""
    lines = spark.read.text(f"{checkpoint}/metadata").collect()  # one line that Spark wrote
    return json.loads("".join(line.value for line in lines))["id"]


def landed_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def consume(
    stream: DataFrame, checkpoint: str, on_batch: Callable[[DataFrame, Place], None], mode: str = "append"
) -> None:
    """Run ``on_batch`` over all that has landed and not been seen yet."""
    names = {}  # of a stream, once a run

    def run(batch: DataFrame, number: int) -> None:
        if not names:
            names["stream"] = _stream_id(batch.sparkSession, checkpoint)
        on_batch(batch, (names["stream"], number))

    (
        stream.writeStream.foreachBatch(run)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def _write_part(rows: DataFrame, folder: str, place: Place) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/stream={place[0]}/part={place[1]}")


def incremental_update(
    spark: SparkSession,
    landed: str,
    root: str,
    checkpoint: str,
    schema: T.StructType,
    *,
    key: str,
    order: list[str],
    files_per_batch: int = 1000,
    landed_schema: T.StructType | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Consume all files that have landed, insert-only by ``key``.

    ``prepare`` turns landed rows into rows of ``schema`` where the two differ, for
    example landed search pages into summaries. A batch replayed after a failure
    overwrites its own part and looks at all others, those of earlier streams included, so
    the outcome is the same however often it runs. Documents that are landed again, or
    late, meet the stored keys and change nothing; of these, only the buckets of the
    batch's own keys are opened. One stream at a time may write to ``root``.
    """

    def add_new(batch: DataFrame, place: Place) -> None:
        # Staged, the batch is read and prepared once and its size is known: a small one
        # is broadcast to the scan of stored keys, which is then not shuffled.
        first = first_wins(prepare(batch), order, key).select(*schema.names, _bucket(key).alias("_bucket"))
        session = batch.sparkSession
        with staged(first, "micro-batch") as fresh:
            buckets = [r["_bucket"] for r in fresh.select("_bucket").distinct().collect()]  # no more than there are buckets
            stored = _stored_keys(session, bucket_paths(session, root, buckets, but=place), schema[key])
            known = stored.join(fresh.select(key), key, "left_semi")
            added = fresh.join(known, key, "left_anti").select(*schema.names)
            _write_part(added, f"{root}/rows", place)
            # The rows of a part whose keys are missing would be added again by a later batch:
            # keys come last, and a batch is finished only with them.
            written = session.read.schema(schema).parquet(f"{root}/rows/stream={place[0]}/part={place[1]}")
            _write_keys(written, key, f"{root}/ids/stream={place[0]}/part={place[1]}")

    consume(landed_files(spark, landed, landed_schema or schema, files_per_batch), checkpoint, add_new)


def stream_latest(
    spark: SparkSession,
    landed: str,
    root: str,
    checkpoint: str,
    schema: T.StructType,
    *,
    key: str,
    order: list[str],
    files_per_batch: int = 1000,
) -> DataFrame:
    """Consume landed files and give the last row per key.

    The state store holds the last row of every key, an aggregate that Spark updates; a batch
    passes on the last rows of its own keys. Its work follows the batch, whatever is stored.
    Choose the RocksDB state store for more keys than executors have memory for.
    """
    stream = landed_files(spark, landed, schema, files_per_batch)
    row, rank = F.struct(*schema.names), F.struct(*order)
    last = stream.groupBy(key).agg(F.max_by(row, rank).alias("_row")).select("_row.*")

    def add_changed(batch: DataFrame, place: Place) -> None:
        _write_part(batch.select(*schema.names), f"{root}/rows", place)

    consume(last, checkpoint, add_changed, mode="update")
    return read_latest(spark, root, schema, key=key, order=order)


def _bases(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n) for n in children(spark, f"{root}/base") if exists(spark, f"{root}/base/{n}/_SUCCESS"))


def read_latest(spark: SparkSession, root: str, schema: T.StructType, *, key: str, order: list[str]) -> DataFrame:
    """The last row per key of what ``stream_latest`` stored.

    Rows folded by ``compact_latest`` are unique: they are scanned, not shuffled, less the keys of
    parts written since then. Only these parts are ranked, and they hold what changed.
    """
    parts, bases = _placed(spark, f"{root}/rows", schema), _bases(spark, root)
    if not bases:
        return keep_last(parts.drop("stream", "part"), order, key)
    base = spark.read.schema(schema).parquet(f"{root}/base/{bases[-1]}")
    folded = [name.rpartition(".") for name in children(spark, f"{root}/base-folded/{bases[-1]}")]
    done = spark.createDataFrame([(s, int(p)) for s, _, p in folded], "_stream string, _part bigint")
    recent = parts.join(done, (F.col("stream") == F.col("_stream")) & (F.col("part") == F.col("_part")), "left_anti").drop("stream", "part")
    # A part of another stream may hold an older row than the base does.
    changed = keep_last(recent.unionByName(base.join(recent.select(key), key, "left_semi")), order, key)
    return base.join(recent.select(key), key, "left_anti").unionByName(changed)


def compact_latest(spark: SparkSession, root: str, schema: T.StructType, *, key: str, order: list[str]) -> None:
    """Fold all parts into a base of one row per key. Not to be run while a stream writes to ``root``."""
    number = max((int(n) for n in children(spark, f"{root}/base")), default=0) + 1
    rows = read_latest(spark, root, schema, key=key, order=order)
    for stream in children(spark, f"{root}/rows"):
        for part in children(spark, f"{root}/rows/{stream}"):
            if "=" in part:
                touch(spark, f"{root}/base-folded/{number}/{stream.partition('=')[2]}.{part.partition('=')[2]}")
    rows.write.mode("overwrite").parquet(f"{root}/base/{number}")


def stream_first(
    stream: DataFrame, key: str, event_time: str, delay: str
) -> DataFrame:
    """Unbounded first-wins feed: a key is passed on once within ``delay``."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
