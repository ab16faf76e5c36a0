"""Comparing stored rows with the counts a source reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.operators.merge import stored_ids
from folioforge.operators.windows import counts_of_days, day_counts

WINDOW = ["date_from", "date_to"]
# Audit outcomes.
MATCH, DEFICIENT, SURPLUS, RECONCILED = "match", "deficient", "surplus", "reconciled"
# A window whose count could not be read.
UNKNOWN = "unknown"


def audit_status(api: Column, local: Column, reconciled: Column | None = None) -> Column:
    compared = (
        F.when(api.isNull(), UNKNOWN)
        .when(api > local, DEFICIENT)
        .when(local > api, SURPLUS)
        .otherwise(MATCH)
    )
    return compared if reconciled is None else F.when(reconciled, RECONCILED).otherwise(compared)


def difference(api: Column, local: Column) -> Column:
    """Signed number of reported documents that are not stored."""
    return api - local


def phantom_count(api: Column, local: Column, reconciled: Column) -> Column:
    """Reported documents that cannot be retrieved, for a reconciled window."""
    return F.when(reconciled, F.greatest(difference(api, local), F.lit(0))).otherwise(0).cast("bigint")


def reconcile_windows(windows: DataFrame, remote: DataFrame, corpus: DataFrame) -> DataFrame:
    """All windows with reported and stored counts, status and difference.

    ``remote`` is (date_from, date_to, api_count). A window without a readable count
    gets the status ``unknown``; the other windows are not held up by it.
    """
    return reconcile_days(windows, remote, day_counts(corpus))


def reconcile_days(windows: DataFrame, remote: DataFrame, days: DataFrame) -> DataFrame:
    """``reconcile_windows`` from rows per day, such as a stored corpus keeps them."""
    counted = counts_of_days(days, windows).join(
        remote.select(*WINDOW, "api_count"), WINDOW, "left"
    )
    api, local = F.col("api_count"), F.col("local_count")
    return counted.withColumn("status", audit_status(api, local)).withColumn(
        "difference", difference(api, local)
    )


def dry_run_counts(windows: DataFrame, remote: DataFrame, corpus: DataFrame) -> DataFrame:
    return reconcile_windows(windows, remote, corpus).drop("status")


def mismatches(audit: DataFrame) -> DataFrame:
    return audit.where(F.col("status").isin(DEFICIENT, SURPLUS))


def audit_summary(audit: DataFrame) -> DataFrame:
    """One row of totals; every window outside the named outcomes counts as matched."""
    status = F.col("status")
    named = {
        "windows": F.count("*"),
        "deficient": F.count_if(status == DEFICIENT),
        "surplus": F.count_if(status == SURPLUS),
        "reconciled": F.count_if(status == RECONCILED),
        "unknown": F.count_if(status == UNKNOWN),
    }
    totals = audit.agg(*(value.alias(name) for name, value in named.items()))
    return totals.withColumn(
        "matched",
        F.col("windows") - F.col("deficient") - F.col("surplus") - F.col("reconciled") - F.col("unknown"),
    )


def phantom_check(enumerated: DataFrame, corpus: DataFrame) -> DataFrame:
    """Per enumerated window: is every listed document stored, with no blank reference?

    ``enumerated`` is (date_from, date_to, requested_id, ref_code).
    """
    asked = enumerated.select(F.col("requested_id").alias("document_id"))
    found = stored_ids(corpus).join(asked, "document_id", "left_semi")
    held = found.select(F.col("document_id").alias("requested_id"), F.lit(True).alias("held"))
    stored = F.coalesce("held", F.lit(False)) & (F.col("ref_code") != "")
    return (
        enumerated.join(held, "requested_id", "left")
        .groupBy(*WINDOW)
        .agg(F.bool_and(stored).alias("all_stored"))
    )
