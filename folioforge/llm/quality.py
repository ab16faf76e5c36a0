"""Quality scores of whole texts by a generalised additive model."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.llm import gam

SAMPLE = 20_000  # labelled rows that a model is fitted to, at most
THRESHOLD = 0.3

# What any text has: no single signs that one collection's bad texts happen to use.
FEATURES = ("log_bytes", "upper", "digits", "blanks", "beyond_ascii", "word_length", "longest_word", "distinct_words", "top_word",
            "line_bytes", "repeated_lines", "distinct_starts")


def _table(characters: bytes) -> np.ndarray:
    table = np.zeros(256)
    table[list(characters)] = 1
    return table


_CLASSES = np.stack([
    _table(bytes(range(65, 91))), _table(b"0123456789"), _table(b" \t\n\r\x0b\x0c"), _table(bytes(range(128, 256)))])


def features(text: str | None) -> list[float]:
    """Numbers that describe the whole text; null is empty."""
    data = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, len(data))
    shares = _CLASSES @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / size
    words = data.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = data.split(b"\n")
    return [
        np.log1p(len(data)), *shares,
        sum(map(len, words)) / n, np.log1p(max(map(len, counts), default=0)), len(counts) / n,
        max(counts.values(), default=0) / n, np.log1p(len(data) / len(lines)), 1 - len(set(lines)) / len(lines), len({w[:3] for w in counts}) / n,
    ]


def matrix(texts: pd.Series) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))


def held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from learning: crc32 of its id mod ``folds`` is 0. A null id always is."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % folds == 0, F.lit(True))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> gam.Model:
    """A model of ``labels`` (doc_id, ``label``) by the texts of ``docs``.

    Learns only from rows that aren't held out, of these from the ``sample`` whose ids have the
    smallest hashes. Rows without label or text are left out; an id with several rows or labels
    counts with each. Without any label the model is a constant 0.5.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    known = (known.select(F.col("doc_id").alias("_doc"), F.col(label).cast("double").alias("y"))
             .orderBy(F.xxhash64("_doc"), "_doc", "y").limit(sample))

    def described(batches):
        for batch in batches:
            yield pd.DataFrame({"doc": batch["_doc"], "y": batch["y"], "x": list(matrix(batch["text"]))})

    # At most ``sample`` pairs of numbers are broadcast, and as many rows of features come back.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("_doc"))
    rows = rows.where("text is not null").select("_doc", "y", "text").mapInPandas(described, "doc long, y double, x array<double>")
    rows = rows.orderBy(F.xxhash64("doc"), "doc", "y", "x").limit(sample).toPandas()
    x = np.array(rows["x"].tolist()).reshape(len(rows), len(FEATURES))
    return gam.fit(x, rows["y"].to_numpy(dtype=float))


def quality_score(model: gam.Model) -> callable:
    """A column function: the text's probability of label 1. Null and empty texts have one too."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(matrix(texts)))

    return score


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs`` (doc_id, text)."""
    score = quality_score(fit_quality(docs, labels))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
