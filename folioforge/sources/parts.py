"""How a corpus is stored: numbered parts of a snapshot, each committed by one file written last.

``snapshot=<n>/rows/part=<k>``      rows of part k, partitioned by publication year
``snapshot=<n>/replaced/part=<k>``  identifiers whose rows in earlier parts count no more
``snapshot=<n>/days/part=<k>``      rows per day that part k adds, and takes away by replacing
``snapshot=<n>/commits/<k>``        empty; readers know part k by it

A run that replaces a few rows adds a part and a short list of identifiers; nothing that is stored
is written again. ``compact`` folds parts and lists into a new snapshot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.operators.windows import day_counts
from folioforge.schema import CORPUS_SCHEMA
from folioforge.sources.files import children, exists, latest_snapshot, touch

# Rows lie in folders by part and by the year that their date text begins with.
STORED_SCHEMA = T.StructType(
    [*CORPUS_SCHEMA.fields, T.StructField("part", T.IntegerType()), T.StructField("pub_year", T.IntegerType())]
)
DAYS_SCHEMA = "day date, beyond boolean, n bigint"


def snapshot_path(spark: SparkSession, root: str) -> str | None:
    number = latest_snapshot(spark, root)
    return None if number is None else f"{root}/snapshot={number}"


def committed_parts(spark: SparkSession, snapshot: str) -> list[int]:
    return sorted(int(name) for name in children(spark, f"{snapshot}/commits") if name.isdigit())


def stored_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the latest snapshot with ``part`` and ``pub_year``; replaced ones are left out.

    The identifiers of replaced rows are few and lie in a table of known size, so that the join
    is a broadcast until there are many. Parts behind the last replacement don't take part in it.
    """
    snapshot = snapshot_path(spark, root)
    if snapshot is None:
        return spark.createDataFrame([], STORED_SCHEMA)
    parts = committed_parts(spark, snapshot)
    if not parts:  # a snapshot of one part, from before there were several
        return spark.read.schema(STORED_SCHEMA).parquet(snapshot).withColumn("part", F.lit(0))
    rows = _read(spark, f"{snapshot}/rows", parts, STORED_SCHEMA)
    replacing = [k for k in parts if exists(spark, f"{snapshot}/replaced/part={k}")]
    if not replacing:
        return rows
    later = _read(spark, f"{snapshot}/replaced", replacing, "document_id string, part int")
    later = later.groupBy("document_id").agg(F.max("part").alias("last")).withColumnRenamed("document_id", "_id")
    older = rows.where(F.col("part") < replacing[-1])
    kept = older.join(later, (F.col("document_id") == F.col("_id")) & (F.col("part") < F.col("last")), "left_anti")
    return kept.unionByName(rows.where(F.col("part") >= replacing[-1]))


def stored_days(spark: SparkSession, root: str) -> DataFrame:
    """``(day, beyond, n)`` of the rows stored, added up from the parts' counts; no rows are read."""
    snapshot = snapshot_path(spark, root)
    parts = [] if snapshot is None else committed_parts(spark, snapshot)
    if not parts:
        return day_counts(stored_rows(spark, root))
    counts = _read(spark, f"{snapshot}/days", parts, DAYS_SCHEMA + ", part int")
    return counts.groupBy("day", "beyond").agg(F.sum("n").alias("n")).where("n > 0")


def _read(spark: SparkSession, folder: str, parts: list[int], schema) -> DataFrame:
    return spark.read.schema(schema).option("basePath", folder).parquet(*(f"{folder}/part={k}" for k in parts))


def write_part(rows: DataFrame, snapshot: str, part: int, replaced: DataFrame | None = None) -> None:
    """Store corpus rows as a part and commit it; a part that was not committed is written over.

    ``replaced`` are stored rows (document_id, date) whose place these rows take. Newest rows come
    first: files of a year, in order of their names, are in order of dates. The
    range key ends with the identifier, so a date of very many rows is spread over several files.
    """
    spark = rows.sparkSession
    year, newest = F.col("pub_year").desc_nulls_last(), F.col("date").desc_nulls_last()
    (
        rows.withColumn("pub_year", year_of(F.col("date")))
        .repartitionByRange(year, newest, "document_id")
        .sortWithinPartitions(year, newest, "document_id")
        .write.partitionBy("pub_year")
        .option("compression", "snappy")
        .mode("overwrite")
        .parquet(f"{snapshot}/rows/part={part}")
    )
    written = spark.read.schema(STORED_SCHEMA).parquet(f"{snapshot}/rows/part={part}")
    days = day_counts(written)
    if replaced is not None:
        replaced.select("document_id").distinct().write.mode("overwrite").parquet(f"{snapshot}/replaced/part={part}")
        days = days.unionByName(day_counts(replaced).withColumn("n", -F.col("n")))
    days.write.mode("overwrite").parquet(f"{snapshot}/days/part={part}")
    touch(spark, f"{snapshot}/commits/{part}")


def new_snapshot(rows: DataFrame, root: str) -> str:
    target = f"{root}/snapshot={(latest_snapshot(rows.sparkSession, root) or 0) + 1}"
    write_part(rows, target, 0)
    return target


def add_part(rows: DataFrame, root: str, replaced: DataFrame | None = None) -> str:
    """Add rows to the latest snapshot as its next part."""
    spark = rows.sparkSession
    snapshot = snapshot_path(spark, root)
    if snapshot is None:
        return new_snapshot(rows, root)
    parts = committed_parts(spark, snapshot)
    if not parts:
        snapshot, parts = compact(spark, root), [0]
    write_part(rows, snapshot, parts[-1] + 1, replaced)
    return snapshot


def compact(spark: SparkSession, root: str) -> str:
    """Fold all parts into one new snapshot; the one before stays for those who read it."""
    return new_snapshot(stored_rows(spark, root).drop("part", "pub_year"), root)


def year_of(date):
    """Year in the first four characters of date text, null where they are no digits.

    Taken from the text, not from a parsed date, so that it orders like the text does:
    the years of a text range are exactly the years of its limits.
    """
    start = F.substring(date, 1, 4)
    return F.when(start.rlike("^[0-9]{4}$"), start).try_cast("int")
