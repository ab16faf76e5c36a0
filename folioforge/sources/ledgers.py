"""Reading and writing the two retry ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import variants as V
from folioforge.functions.text import strip
from folioforge.operators.merge import keep_last
from folioforge.schema import REF_LEDGER_SCHEMA, WINDOW_LEDGER_SCHEMA
from folioforge.sources.files import exists


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def scan_failed_windows(spark: SparkSession, path: str) -> DataFrame:
    """Pending windows; an entry without both dates is an error, not skipped."""
    raw = _rows(spark, path, "dataset string, position bigint, date_from string, date_to string")

    def required(name: str):
        parsed = F.col(name).try_cast("date")
        return (
            F.when(parsed.isNull(), F.raise_error(F.lit(f"invalid ledger entry: {name}")).cast("date"))
            .otherwise(parsed)
            .alias(name)
        )

    return raw.select("dataset", "position", required("date_from"), required("date_to"))


def scan_failed_refs(spark: SparkSession, path: str) -> DataFrame:
    """Pending references; a summary that is not an object becomes the bare reference."""
    return repair_ref_ledger(_rows(spark, path, REF_LEDGER_SCHEMA))


def repair_ref_ledger(ledger: DataFrame) -> DataFrame:
    bare = F.to_json(F.struct(F.col("reference").alias("refCode")))
    summary = F.when(V.parse_object(strip(F.col("summary_json"))).isNotNull(), F.col("summary_json"))
    return ledger.withColumn("summary_json", F.coalesce(summary, bare))


def write_failed_windows(ledger: DataFrame, path: str) -> None:
    """Replace the ledger; each (date_from, date_to) once, the earliest place kept."""
    unique = ledger.groupBy("dataset", "date_from", "date_to").agg(
        F.min("position").alias("position")
    )
    unique.write.mode("errorifexists").json(path)


def write_failed_refs(ledger: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Replace the ledger; each reference once, its latest entry kept.

    ``order`` names the arrival columns of entries that may repeat a reference. Without it
    a reference with two different summaries is an error: none of them is known to be newer.
    """
    key = ["dataset", "reference"]
    if order is not None:
        unique = keep_last(ledger, order, key).drop(*order)
    else:
        first, last = F.min("summary_json"), F.max("summary_json")
        unsure = F.raise_error(F.concat(F.lit("no order of entries for "), F.first("reference"))).cast("string")
        unique = ledger.groupBy(*key).agg(F.when(first.eqNullSafe(last), last).otherwise(unsure).alias("summary_json"))
    unique.write.mode("errorifexists").json(path)


def empty_ledgers(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return (
        spark.createDataFrame([], WINDOW_LEDGER_SCHEMA),
        spark.createDataFrame([], REF_LEDGER_SCHEMA),
    )
