"""Session settings and the shared folder used to stage intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from folioforge.sources.files import remove

# Settings the library is written for. AQE sizes shuffle partitions, splits skewed
# join and rebalance partitions, and turns joins into broadcasts by measured size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def local_session(
    app: str = "folioforge", cores: int | str = "*", shuffle_partitions: int = 8
) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="folioforge-"))
    return context.getCheckpointDir()


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path in the shared folder."""
    return f"{shared_dir(spark)}/folioforge/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a scan of it.

    Cuts the lineage at a place that survives lost executors, lets several outputs
    share one computation, and gives the optimizer exact sizes for what follows, so a
    join with a small staged table becomes a broadcast and one with a big table
    does not.
    """
    return _written(df, new_path(df.sparkSession, label))


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Like ``stage`` for jobs that repeat: the table is removed at the end of the block."""
    path = new_path(df.sparkSession, label)
    try:
        yield _written(df, path)
    finally:
        remove(df.sparkSession, path)


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
