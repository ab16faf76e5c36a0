"""Checking published release files against their manifest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions.text import strip
from folioforge.schema import MANIFEST_FIELDS, SCOPES
from folioforge.sources.files import open_bytes, qualified

_CHUNK = 8 * 1024 * 1024


def validate_manifest(manifest: DataFrame) -> DataFrame:
    """Manifest rows with the names of missing fields, the scope and a verdict."""
    missing = F.filter(
        F.array(
            *[
                F.when(F.col(name).isNull() if name in manifest.columns else F.lit(True), name)
                for name in sorted(MANIFEST_FIELDS)
            ]
        ),
        lambda name: name.isNotNull(),
    )
    scope = F.coalesce(F.col("scope"), F.lit("all")) if "scope" in manifest.columns else F.lit("all")
    checked = manifest.withColumn("missing_fields", missing).withColumn("scope", scope)
    return checked.withColumn(
        "valid", (F.size("missing_fields") == 0) & F.col("scope").isin(*SCOPES)
    )


def _digest_in_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        digests = []
        for path in batch["path"]:
            digest = hashlib.sha256()
            with open_bytes(path) as stream:
                while chunk := stream.read(_CHUNK):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield batch.assign(sha256=digests)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of every file under ``path``.

    Tasks read files of any size in chunks; a file never becomes one value in memory.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return (
        files.select("path", F.col("length").alias("size_bytes"))
        .hint("rebalance", "path")
        .mapInPandas(_digest_in_chunks, "path string, size_bytes bigint, sha256 string")
    )


# From what makes a release useless to what is in order.
VERDICTS = ("missing", "digest mismatch", "size mismatch", "unlisted", "verified")


def name_below(path: Column, root: str) -> Column:
    """The part of a path behind the folder ``root``; a path that lies elsewhere stays whole."""
    folder = root.rstrip("/") + "/"
    return F.when(path.startswith(folder), F.substring(path, len(folder) + 1, 2**31 - 1)).otherwise(path)


def verify_files(
    digests: DataFrame, manifest: DataFrame, root: str | None = None, address: str | None = None
) -> DataFrame:
    """Files matched to manifest rows by file name, with a verdict each.

    With the ``root`` that was digested and the ``address`` it is published under, files are
    matched by their paths below these: parts of different tables may have equal file names.
    The digest is compared in any letter case; the size only where the manifest has one.
    Both sides are kept whole: ``unlisted`` files and ``missing`` ones are reported.
    """

    def name_of(column: str, folder: str | None):
        return F.element_at(F.split(F.col(column), "/"), -1) if folder is None else name_below(F.col(column), folder)

    folder = None if root is None else qualified(digests.sparkSession, root)
    expected = manifest.select(
        name_of("url", address).alias("file_name"),
        F.lower(strip(F.col("sha256"))).alias("expected_sha256"),
        F.col("size_bytes").alias("expected_size"),
    )
    found = digests.withColumn("file_name", name_of("path", folder)).select("file_name", "size_bytes", "sha256")
    joined = found.join(expected, "file_name", "full")
    return joined.withColumn(
        "verdict",
        F.when(F.col("sha256").isNull(), "missing")
        .when(F.col("expected_sha256").isNull(), "unlisted")
        .when(F.lower("sha256") != F.col("expected_sha256"), "digest mismatch")
        .when(F.col("size_bytes") != F.col("expected_size"), "size mismatch")
        .otherwise("verified"),
    )


def verify_tables(verified: DataFrame) -> DataFrame:
    """One verdict per file or folder of parts in the root: the worst one of its files."""
    rank = F.array_position(F.array(*map(F.lit, VERDICTS)), F.col("verdict"))
    worst = F.min_by("verdict", rank).alias("verdict")
    return verified.groupBy(F.split_part("file_name", F.lit("/"), F.lit(1)).alias("file_name")).agg(worst)
