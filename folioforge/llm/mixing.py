"""Sources mixed to target weights: iterative proportional fitting, then calibrated sampling."""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from folioforge.llm.grams import WordHashes
from folioforge.session import stage

TOPICS = 6
TOPIC_SAMPLE = 3_000  # documents that the first centres come from, at most
FULL_ROUNDS = 5  # rounds of k-means over all documents, at most
STILL = 1e-4  # centres whose cosines with those before are nearer to 1 are taken as settled
FIXED = 2.0**30  # vectors are added in whole parts of 1 / FIXED
DIMS = 512  # hashed words of a document's vector
TEMPER = 0.9  # a category's target share is its share of tokens to this power
ROUNDS = 200
TOLERANCE = 1e-4  # a last round that moved a category by more is reported
MOST_CELLS = 1_000_000  # (source, language, topic) combinations that occur; more is an error
MARGINS = ("source", "lang", "topic")


def _counts(texts: pd.Series) -> np.ndarray:
    """Signed counts of hashed words, over whole texts."""
    out, hashes = np.zeros((len(texts), DIMS), "<i4"), WordHashes()
    for row, text in zip(out, texts, strict=True):
        words = hashes.of(text or "")
        signs = (words >> np.uint64(63)).astype(float) * 2 - 1
        row[:] = np.bincount((words % np.uint64(DIMS)).astype(np.int64), signs, DIMS)
    return out


def _unit(counts: np.ndarray) -> np.ndarray:
    """Unit vectors of damped counts."""
    out = np.sign(counts) * np.log1p(np.abs(counts.astype(float)))
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)


def _vectors(texts: pd.Series) -> np.ndarray:
    return _unit(_counts(texts))


def _stored(counts: pd.Series) -> np.ndarray:
    return _unit(np.frombuffer(b"".join(counts), "<i4").reshape(len(counts), DIMS))


@F.pandas_udf(StructType([StructField("v", BinaryType()), StructField("tokens", LongType())]))
def _described(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"v": [v.tobytes() for v in _counts(texts)], "tokens": [len((t or "").split()) for t in texts]})


def described(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Every row's identifiers, number of tokens and counts of hashed words, staged: texts are hashed once."""
    h = F.when(F.col("text") != "", F.xxhash64(F.lit(seed), "text"))
    return stage(docs.select("doc_id", text_key().alias("_key"), F.col("source").alias("_source"), F.col("lang").alias("_lang"),
                             h.alias("_h"), _described("text").alias("_d")).select("doc_id", "_key", "_source", "_lang", "_h", "_d.*"), "described")


def _moved(sums: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Unit vectors of the sums; a centre that nothing is near stays."""
    sums = np.where((sums != 0).any(1, keepdims=True), sums, centres)
    return sums / np.maximum(np.sqrt((sums * sums).sum(1, keepdims=True)), 1e-12)


def _first_centres(vectors: DataFrame, topics: int, sample: int) -> np.ndarray:
    """Where the rounds over all documents start: k-means on the ``sample`` texts of smallest hash."""
    hashed = vectors.select(F.col("_h").alias("h"), "v").where("h is not null")
    keys = hashed.select("h").distinct().orderBy("h").limit(sample)
    chosen = hashed.join(F.broadcast(keys), "h").dropDuplicates(["h"])  # at most ``sample`` numbers are broadcast
    rows = chosen.orderBy("h").limit(sample).toPandas()
    if rows.empty:
        return np.zeros((1, DIMS))
    x = _stored(rows["v"])
    centres = x[:1]
    while len(centres) < min(topics, len(x)):  # each next centre is the text farthest from all others
        centres = np.vstack([centres, x[np.argmin((x @ centres.T).max(1))]])
    for _ in range(20):
        own = (x @ centres.T).argmax(1)
        centres = _moved(np.stack([x[own == k].sum(0) for k in range(len(centres))]), centres)
    return centres


def _sums(vectors: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Per centre the sum of the vectors next to it, over all rows.

    Components are added as whole numbers, so that the sums don't depend on the order of rows.
    """

    def add(batches):
        total = np.zeros(centres.shape, np.int64)
        for batch in batches:
            x = _stored(batch["v"])
            own = (x @ centres.T).argmax(1)
            whole = np.rint(x * FIXED).astype(np.int64)
            for k in range(len(centres)):
                total[k] += whole[own == k].sum(0)
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells.astype(np.int32), "total": total.ravel()[cells]})

    cells = vectors.select("v").mapInPandas(add, "cell int, total long").groupBy("cell").agg(F.sum("total").alias("total")).toPandas()
    out = np.zeros(centres.size)  # a number per centre and dimension came to the driver
    out[cells["cell"].to_numpy(dtype=np.int64)] = cells["total"].to_numpy(dtype=float) / FIXED
    return out.reshape(centres.shape)


def fit_centres(vectors: DataFrame, topics: int = TOPICS, sample: int = TOPIC_SAMPLE, rounds: int = FULL_ROUNDS) -> np.ndarray:
    """Centres of the topics, by rounds of spherical k-means over all rows of ``described``.

    Only the first centres come from a sample. Each round is an aggregate of all rows; copies weigh as
    often as they occur. Rounds end early once no centre moves.
    """
    centres = _first_centres(vectors, topics, sample)
    for _ in range(rounds):
        before, centres = centres, _moved(_sums(vectors, centres), centres)
        if (before * centres).sum(1).min() > 1 - STILL:
            break
    return centres


def fit_topics(docs: DataFrame, topics: int = TOPICS, sample: int = TOPIC_SAMPLE, seed: int = 0) -> np.ndarray:
    """Centres of the topics of all documents."""
    return fit_centres(described(docs, seed), topics, sample)


def topic_of(centres: np.ndarray):
    """A column function: the topic of a text, from its counts of hashed words."""

    @F.pandas_udf(StringType())
    def topic(counts: pd.Series) -> pd.Series:
        return pd.Series([f"topic{k}" for k in (_stored(counts) @ centres.T).argmax(1)])

    return topic


def tempered(cells: pd.DataFrame, margin: str, temper: float = TEMPER) -> dict:
    """Target shares of a margin's categories: their shares of tokens to a power, which lifts the rare ones."""
    shares = cells.groupby(margin, dropna=False)["tokens"].sum() / max(1, cells["tokens"].sum())
    shares = shares[shares > 0] ** temper
    return {_name(name): share for name, share in (shares / shares.sum()).items()}


def _name(category):
    """None for a null category, whichever way pandas holds it."""
    return None if category is None or category != category else category


def rake(cells: pd.DataFrame, targets: dict[str, dict], rounds: int = ROUNDS, close: float = 1e-9,
         spread: float | None = None) -> np.ndarray:
    """A weight per cell such that the weighted tokens meet each margin's target shares.

    Iterative proportional fitting: margins take turns in scaling their categories. A category
    without a target gets none of the mixture; one without tokens can't be met and is left out.
    With a ``spread``, weights are held between 1 / spread and spread, and targets are missed
    where that binds.
    """
    tokens = cells["tokens"].to_numpy(dtype=float)
    weight = np.where(tokens > 0, 1.0, 0.0)
    coded = {m: pd.factorize(cells[m], use_na_sentinel=False) for m in targets}
    goals = {}
    for m, (_, names) in coded.items():
        goal = np.array([targets[m].get(_name(name), 0.0) for name in names])
        goals[m] = goal
        weight[goal[coded[m][0]] == 0] = 0.0
    for _ in range(rounds):
        moved = 0.0
        for m, (codes, names) in coded.items():
            have = np.bincount(codes, weight * tokens, len(names))
            goal = np.where(have > 0, goals[m], 0.0)
            if not goal.sum():
                return weight
            factor = np.divide(goal / goal.sum(), have / have.sum(), out=np.zeros_like(have), where=have > 0)
            moved = max(moved, float(np.abs(factor[have > 0] - 1).max()))
            weight = weight * factor[codes]
        if spread is not None:
            weight = np.where(weight > 0, np.clip(weight, 1 / spread, spread), 0.0)
        if moved < close:
            break
    else:
        if spread is None and moved > TOLERANCE:
            warnings.warn(f"targets aren't met after {rounds} rounds, the last one still moved a category by {moved:.2g}", stacklevel=2)
    return weight


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def uniform(seed: int, *keys: str) -> Column:
    """A number from 0 to 1 that depends on the seed and the keys alone."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(2**53)) / F.lit(float(2**53))


def mixture(docs: DataFrame, targets: dict[str, dict] | None = None, seed: int = 0, spread: float | None = None,
            budget: int | None = None) -> DataFrame:
    """The decision on each distinct document: _id, _key (hash of the text), _source, _lang, _topic,
    _tokens, _weight, _rate and _copies.

    Tokens are words between blanks. The documents' tokens by source, language and topic form a
    table of cells; its weights are raked to the targets of all three margins (``targets`` by
    ``MARGINS``; tempered shares where none are given). Weights are scaled to rates so that the
    expected tokens are ``budget``, by default as many as the documents have. A document is taken
    as often as its rate has whole numbers, and once more with the probability of the rest. So a
    rare category that is raised is repeated, as in several epochs, and doesn't make the sample of
    all others small; ``spread`` bounds weights, and misses targets where it binds; ``reached`` shows
    what came out. The draw depends on seed, doc_id and text only. Documents without
    tokens have no share in any margin and are taken once. Null sources and languages are categories
    of their own (None); rows that repeat a doc_id and text share their fate.

    The cell table is an aggregate whose size is checked before it is read: more than
    ``MOST_CELLS`` combinations are an error, since targets for so many can't be meant.
    """
    spark = docs.sparkSession
    vectors = described(docs, seed)
    topic = topic_of(fit_centres(vectors))("v").alias("topic")
    facts = stage(vectors.select("doc_id", "_key", "_source", "_lang", topic, "tokens"), "facts")
    grouped = stage(facts.groupBy(F.col("_source").alias("source"), F.col("_lang").alias("lang"), "topic")
                    .agg(F.sum("tokens").alias("tokens")), "cells")
    if grouped.count() > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells; use coarser categories")
    cells = grouped.toPandas().sort_values(["source", "lang", "topic"], na_position="first", ignore_index=True)
    for m in ("source", "lang"):
        cells[m] = pd.Series([_name(x) for x in cells[m]], dtype=object)
    goals = {m: (targets or {}).get(m) or tempered(cells, m) for m in MARGINS}
    cells["weight"] = rake(cells, goals, spread=spread)
    weighed = float((cells["weight"] * cells["tokens"]).sum())
    scale = (cells["tokens"].sum() if budget is None else budget) / weighed if weighed else 0.0
    kind = StructType([StructField("_s", StringType()), StructField("_l", StringType()), StructField("_t", StringType()),
                       StructField("_weight", DoubleType()), StructField("_rate", DoubleType())])
    weights = spark.createDataFrame(
        [(s, lang, t, float(w), 1.0 if not n else float(w * scale))
         for s, lang, t, n, w in zip(cells["source"], cells["lang"], cells["topic"], cells["tokens"], cells["weight"], strict=True)], kind)
    facts = facts.distinct()
    known = facts.join(weights, facts["_source"].eqNullSafe(weights["_s"]) & facts["_lang"].eqNullSafe(weights["_l"])
                       & (facts["topic"] == weights["_t"]), "left")
    rate = F.when(F.col("tokens") == 0, 1.0).otherwise(F.col("_rate"))
    known = known.select(F.col("doc_id").alias("_id"), "_key", "_source", "_lang", F.col("topic").alias("_topic"),
                         F.col("tokens").alias("_tokens"), "_weight", rate.alias("_rate"))
    whole = F.floor("_rate").cast("long")
    return known.withColumn("_copies", whole + (uniform(seed, "_id", "_key") < F.col("_rate") - whole).cast("long"))


def mixed_decisions(docs: DataFrame, targets: dict[str, dict] | None = None, seed: int = 0, spread: float | None = None,
                    budget: int | None = None) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight, rate, copies: the decision on each distinct document."""
    known = mixture(docs, targets, seed, spread, budget)
    return known.select(F.col("_id").alias("doc_id"), F.col("_source").alias("source"), F.col("_lang").alias("lang"),
                        F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), F.col("_weight").alias("weight"),
                        F.col("_rate").alias("rate"), F.col("_copies").alias("copies"))


def reached(decisions: DataFrame, targets: dict[str, dict] | None = None) -> pd.DataFrame:
    """margin, category, before, target, expected, kept: shares of tokens in rows of ``mixed_decisions``.

    ``targets`` are those the decisions were made with; ``expected`` is by rate, ``kept`` by draw.
    """
    p, k = F.col("tokens") * F.col("rate"), F.col("tokens") * F.col("copies")
    cells = decisions.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"), F.sum(p).alias("expected"), F.sum(k).alias("kept")).toPandas()
    out = []
    for m in MARGINS:
        goals = (targets or {}).get(m) or tempered(cells, m)
        sums = cells.groupby(m, dropna=False)[["tokens", "expected", "kept"]].sum().astype(float)
        shares = sums / np.maximum(sums.sum(), 1e-300)
        out += [(m, _name(c), row["tokens"], goals.get(_name(c), 0.0), row["expected"], row["kept"]) for c, row in shares.iterrows()]
    return pd.DataFrame(out, columns=["margin", "category", "before", "target", "expected", "kept"])


def mixed(docs: DataFrame, targets: dict[str, dict] | None = None, seed: int = 0, spread: float | None = None,
          budget: int | None = None) -> DataFrame:
    """The rows of ``docs`` as often as the mixture takes them, with their own columns only."""
    known = mixture(docs, targets, seed, spread, budget)
    taken = known.where("_copies > 0").select("_id", F.col("_key").alias("_text"), F.col("_source").alias("_s"), F.col("_lang").alias("_l"),
                                             F.sequence(F.lit(1).cast("long"), "_copies").alias("_each"))
    match = (docs["doc_id"].eqNullSafe(taken["_id"]) & (text_key() == taken["_text"])
             & docs["source"].eqNullSafe(taken["_s"]) & docs["lang"].eqNullSafe(taken["_l"]))
    return docs.join(taken, match).withColumn("_each", F.explode("_each")).select(*(docs[c] for c in docs.columns))
