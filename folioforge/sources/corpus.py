"""Reading a stored corpus."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators.filters import filter_window
from folioforge.operators.records import migrate_legacy, normalize_schema
from folioforge.operators.stats import per_type_counts, resolve
from folioforge.schema import CORPUS_SCHEMA
from folioforge.sources.files import exists
from folioforge.sources.parts import stored_rows

def empty_corpus(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CORPUS_SCHEMA)


def scan_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Any Parquet corpus, today's or the predecessor's layout; a missing path is empty.

    Migration happens on read only: the files stay as they are until the next write.
    """
    if not exists(spark, path):
        return empty_corpus(spark)
    return normalize_schema(migrate_legacy(spark.read.parquet(path)))


def scan_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The latest committed snapshot of a corpus written by this library."""
    return stored_rows(spark, root).drop("part", "pub_year")


def scan_snapshot_window(
    spark: SparkSession, root: str, date_from: date, date_to: date
) -> DataFrame:
    """Rows of a date range; only the partitions of its years are read."""
    year = F.col("pub_year")
    wanted = year.between(date_from.year, date_to.year) | year.isNull()
    rows = stored_rows(spark, root).where(wanted)
    return filter_window(rows, date_from, date_to).drop("part", "pub_year")


def scan_summary(raw: DataFrame) -> DataFrame:
    """Row count and newest date of either layout; only the date column is read.

    Unlike the cutoff of a corpus, this drops null dates but not empty ones.
    """
    column = resolve(raw, "date", "publication_date")
    newest = F.max(column) if column else F.lit(None)
    return raw.agg(F.count("*").alias("row_count"), newest.cast("string").alias("cutoff"))


def scan_type_counts(raw: DataFrame) -> DataFrame:
    """Documents per type of either layout; only the type column is read."""
    return per_type_counts(raw)
