"""Coverage, completeness and distribution statistics of a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioforge.functions import dates as D
from folioforge.operators.records import source_bucket
from folioforge.schema import COMPLETENESS_FIELDS, MISSING_TYPE, NO_LABEL, TYPE_LABELS


def resolve(df: DataFrame, *names: str) -> str | None:
    """The first of several alternative column names that the frame has."""
    return next((name for name in names if name in df.columns), None)


def total_documents(corpus: DataFrame) -> DataFrame:
    return corpus.agg(F.count("*").alias("total_documents"))


def _dated(function, name: str) -> Column:
    date = F.col("date")
    return function(F.when(D.filled(date), date)).alias(name)


def cutoff(corpus: DataFrame) -> DataFrame:
    """Newest date text; null when no row has one."""
    return corpus.agg(_dated(F.max, "cutoff"))


def date_range(corpus: DataFrame) -> DataFrame:
    return corpus.agg(_dated(F.min, "first_date"), _dated(F.max, "last_date"))


def _detail_share() -> Column:
    share = F.avg(F.coalesce(F.col("detail_ok"), F.lit(False)).cast("int")) * 100
    return F.coalesce(share, F.lit(0.0)).alias("detail_share")


def detail_share(corpus: DataFrame) -> DataFrame:
    """Percentage of rows whose detail is complete; 0 for an empty corpus."""
    return corpus.agg(_detail_share())


def status_report(corpus: DataFrame) -> DataFrame:
    """The one-row status of a corpus, in a single pass over three narrow columns."""
    return corpus.agg(
        F.count("*").alias("total_documents"),
        _dated(F.min, "first_date"),
        _dated(F.max, "last_date"),
        _detail_share(),
    )


def per_type_counts(corpus: DataFrame) -> DataFrame:
    """Documents per type code, in code order; rows without a code are left out."""
    code = resolve(corpus, "doc_type", "document_type")
    if code is None:
        return corpus.sparkSession.createDataFrame([], "doc_type string, n bigint")
    return (
        corpus.where(F.col(code).isNotNull())
        .groupBy(F.col(code).alias("doc_type"))
        .agg(F.count("*").alias("n"))
        .orderBy("doc_type")
    )


def type_distribution(corpus: DataFrame, top: int = 12, rest: str = "…") -> DataFrame:
    """The most frequent types and one row that sums up all others, if there are any."""
    counts = corpus.groupBy(
        F.coalesce(F.col("doc_type"), F.lit(MISSING_TYPE)).alias("doc_type")
    ).agg(F.count("*").alias("n"))
    largest = counts.orderBy(F.col("n").desc(), F.col("doc_type")).limit(top)
    signed = counts.select("n", F.lit(1).alias("types")).unionAll(
        largest.select(-F.col("n"), F.lit(-1))
    )
    others = (
        signed.agg(F.sum("n").alias("n"), F.sum("types").alias("types"))
        .where(F.col("types") > 0)
        .select(F.lit(rest).alias("doc_type"), "n")
    )
    return largest.unionAll(others)


def type_labels(spark: SparkSession) -> DataFrame:
    """Fixed dimension table of 32 rows."""
    pairs = F.create_map(*[F.lit(part) for pair in TYPE_LABELS.items() for part in pair])
    return spark.range(1).select(F.explode(pairs).alias("doc_type", "label"))


def with_type_label(df: DataFrame) -> DataFrame:
    # The label table is a constant of this module: its size never depends on the data.
    labelled = df.join(F.broadcast(type_labels(df.sparkSession)), "doc_type", "left")
    return labelled.withColumn("label", F.coalesce("label", F.lit(NO_LABEL)))


def coverage_by_type(corpus: DataFrame) -> DataFrame:
    """Per type: documents, first and last date and year, label; largest type first."""
    code = resolve(corpus, "doc_type", "document_type")
    date = resolve(corpus, "date", "publication_date")
    per_type = (
        corpus.where(F.col(code).isNotNull())
        .groupBy(F.col(code).alias("doc_type"))
        .agg(
            F.count("*").alias("n"),
            F.min(date).alias("first_date"),
            F.max(date).alias("last_date"),
        )
    )
    years = per_type.withColumn("first_year", D.coverage_year(F.col("first_date"))).withColumn(
        "last_year", D.coverage_year(F.col("last_date"))
    )
    return with_type_label(years).orderBy(F.col("n").desc(), F.col("doc_type"))


def overview(corpus: DataFrame) -> DataFrame:
    """Documents, date span, number of types and the most frequent language.

    Reduced to one row per (language, type) first; everything else works on that.
    """
    code = resolve(corpus, "doc_type", "document_type")
    date = D.to_date(F.col(resolve(corpus, "date", "publication_date")))
    pairs = corpus.groupBy(
        F.upper("language").alias("language"), F.col(code).alias("doc_type")
    ).agg(
        F.count("*").alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date")
    )
    weighed = pairs.withColumn("_n", F.sum("n").over(W.partitionBy("language")))
    ranked = F.when(
        F.col("language").isNotNull(), F.struct(-F.col("_n"), F.col("language"))
    )
    return weighed.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("documents"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.count_distinct("doc_type").alias("types"),
        F.min_by("language", ranked).alias("language"),
    )


def completeness_by_decade(corpus: DataFrame, since: int = 1980) -> DataFrame:
    """Share of rows with a value, per field and decade.

    All shares come from one aggregate per decade; the few results are then turned into
    rows, so the corpus itself is never multiplied by the number of fields.
    """
    date = D.to_date(F.col(resolve(corpus, "date", "publication_date")))
    fields = [
        (column, label)
        for names, label in COMPLETENESS_FIELDS
        if (column := resolve(corpus, *names)) is not None
    ]
    shares = (
        corpus.select(D.decade(date).alias("decade"), *[F.col(c) for c, _ in fields])
        .where(F.col("decade") >= since)
        .groupBy("decade")
        .agg(
            *[
                F.avg(F.when(D.filled(F.col(c)), 1.0).otherwise(0.0).cast("double")).alias(label)
                for c, label in fields
            ]
        )
    )
    return shares.unpivot("decade", [f"`{label}`" for _, label in fields], "field", "share")


def completeness_table(corpus: DataFrame, decades: list[int]) -> DataFrame:
    """The same shares with one column per decade; a decade without rows shows 0."""
    long = completeness_by_decade(corpus, since=min(decades))
    return long.groupBy("field").pivot("decade", decades).agg(F.first("share")).na.fill(0.0)


def docs_per_year_source(corpus: DataFrame) -> DataFrame:
    """Documents per year and publisher group; rows without a date form their own year."""
    return corpus.groupBy(
        F.year(D.to_date(F.col("date"))).alias("year"),
        source_bucket(F.col("doc_type")).alias("source"),
    ).agg(F.count("*").alias("n"))
