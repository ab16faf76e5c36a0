"""Running totals and first-N selection that never pull one group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET = 4096


def running_total(
    df: DataFrame, keys: list[str], order: str, totals: dict[str, str], bucket: int = BUCKET
) -> DataFrame:
    """Sums per key up to and including each row, by integer ``order``.

    ``totals`` maps new columns to the columns they add up. A key of any size is cut
    into buckets of ``bucket`` consecutive order values. Bucket sums are added up first,
    one row per bucket; rows are then only summed within their bucket, so the longest
    sorted run is ``bucket`` order values and a hot key spreads over many tasks. ``df`` is
    read twice: stage it when it is costly to compute.
    """
    cut = df.withColumn("_bucket", F.floor(F.col(order) / F.lit(bucket)))
    grouped = [*keys, "_bucket"]
    sums = cut.groupBy(*grouped).agg(*[F.sum(v).alias(f"_{out}") for out, v in totals.items()])
    earlier = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        *grouped,
        *[F.coalesce(F.sum(f"_{out}").over(earlier), F.lit(0)).alias(f"_{out}") for out in totals],
    )
    within = W.partitionBy(*grouped).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    reached = {out: F.col(f"_{out}") + F.sum(v).over(within) for out, v in totals.items()}
    return cut.join(offsets, grouped).select(
        *df.columns, *[total.alias(out) for out, total in reached.items()]
    )


def newest_first(df: DataFrame, column: str = "date_from") -> DataFrame:
    return df.orderBy(F.col(column).desc())


def sort_newest(df: DataFrame, arrival: str = "document_id") -> DataFrame:
    """Date descending, nulls last, ties in arrival order.

    The arrival column is part of the range key, so one date that holds a large share
    of all rows is still split over many sort partitions.
    """
    return df.orderBy(F.col("date").desc_nulls_last(), F.col(arrival).asc())


def canary_limit(missing: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """The first ``limit`` new documents in queue order, and per-window progress.

    ``missing`` has ``queue_key, page_key, pos`` plus any payload. Returned are the
    selected rows and ``(queue_key, missing, selected, complete)``. A window is complete
    when all its missing documents were selected.

    Ranks come from three levels of totals (windows, pages, rows of a page): only the
    rows of a single page are ever numbered together.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    per_page = missing.groupBy("queue_key", "page_key").agg(F.count("*").alias("n"))
    per_window = per_page.groupBy("queue_key").agg(F.sum("n").alias("missing"))
    windows = running_total(
        per_window.withColumn("_all", F.lit(0)), ["_all"], "queue_key", {"_through": "missing"}
    ).select(
        "queue_key",
        "missing",
        (F.col("_through") - F.col("missing")).alias("_before"),
    )
    pages = running_total(per_page, ["queue_key"], "page_key", {"_pages_through": "n"}).select(
        "queue_key", "page_key", (F.col("_pages_through") - F.col("n")).alias("_pages_before")
    )
    on_page = W.partitionBy("queue_key", "page_key").orderBy("pos")
    reached = windows.where(F.col("_before") < limit)
    selected = (
        missing.join(reached.select("queue_key", "_before"), "queue_key")
        .join(pages, ["queue_key", "page_key"])
        .withColumn("_on_page", F.row_number().over(on_page))
        .where(F.col("_before") + F.col("_pages_before") + F.col("_on_page") <= limit)
        .drop("_before", "_pages_before", "_on_page")
    )
    taken = F.greatest(F.lit(0), F.least(F.col("missing"), F.lit(limit) - F.col("_before")))
    progress = windows.select(
        "queue_key",
        "missing",
        taken.cast("bigint").alias("selected"),
        (taken == F.col("missing")).alias("complete"),
    )
    return selected, progress
