"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.components import cells, components
from folioforge.session import stage, staged

WINDOW = 64  # neighbours a vector is compared with on either side, in each pass
BITS = 40  # random hashes of one sign bit each, concatenated to a sort key
RECALL = 0.95  # of pairs that lie right at the threshold; closer ones are found more often
BLOCK = 1024  # members a cell takes from one block when links are counted
ROUND = 32  # passes of one round, at most
SEED = 20_240_601


def passes(rows: int, threshold: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes to begin with: enough if every bit halves the rows; whether it did is counted afterwards.

    Keys that agree in log2(rows / window) bits are then neighbours; one bit agrees with
    probability 1 - angle / pi.
    """
    agree = 1 - math.acos(threshold) / math.pi
    found = agree ** max(0.0, math.log2(max(rows, 1) / window))
    return 1 if found > recall else math.ceil(math.log(1 - recall) / math.log(1 - found))


def _missed(keys, others, threshold: float) -> np.ndarray:
    """Log of the bound on missing a pair at the threshold on one side of a row, in one pass.

    ``others`` are the keys a window away. What shares more bits with the row than they do lies
    before them, and a pair at the threshold shares so many with a known probability, whatever
    the other rows are. A partner is on this side half of the time.
    """
    differ = np.frexp((keys ^ others).astype(float))[1]  # bits from the first that differs
    found = np.where(differ > 0, (1 - math.acos(threshold) / math.pi) ** (BITS + 1.0 - differ), 0.0)
    return np.log1p(-found / 2)


def _usable(batch: pd.DataFrame):
    """Usable rows grouped by the length of their vectors: (ids, unit vectors)."""
    rows = {}
    for vec_id, vector in zip(batch["vec_id"], batch["embedding"], strict=True):
        if vector is None or pd.isna(vec_id):
            continue
        vector = np.array(vector, dtype=object) if vector.dtype == object else vector
        if any(x is None for x in vector) if vector.dtype == object else False:
            continue
        vector = vector.astype(np.float64)
        if len(vector) == 0 or not np.isfinite(vector).all():
            continue
        top = np.abs(vector).max()
        if top > 0:
            vector = vector / top
            rows.setdefault(len(vector), []).append((int(vec_id), vector / np.sqrt((vector * vector).sum())))
    for found in rows.values():
        yield np.array([i for i, _ in found]), np.stack([v for _, v in found])


def _keys(count: int, seed: int, turn: int):
    """Rows (pass, key, slot, vec_id, unit): a sort key per vector and pass."""

    def run(batches):
        planes = {}
        for batch in batches:
            blocks = [rows[at : at + 2048] for _, rows in batch.groupby(batch["unit"].map(len)) for at in range(0, len(rows), 2048)]
            for rows in blocks:
                unit = np.frombuffer(b"".join(rows["unit"]), "<f8").reshape(len(rows), -1)
                dims = unit.shape[1]
                if dims not in planes:
                    planes[dims] = np.random.default_rng([seed, dims, turn]).standard_normal((dims, count * BITS))
                signs = (unit @ planes[dims] > 0).reshape(len(rows), count, BITS)
                keys = signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                yield pd.DataFrame({
                    "pass": np.tile(np.arange(count, dtype=np.int32), len(rows)), "key": keys.ravel(),
                    "slot": np.repeat(rows["slot"].to_numpy(), count), "vec_id": np.repeat(rows["vec_id"].to_numpy(), count),
                    "unit": np.repeat(rows["unit"].to_numpy(), count)})

    return run


def _compare(ids, units, gaps, window, threshold):
    """Pairs within the window; rows whose number of gaps before them differ aren't neighbours."""
    by_size = {}
    for i, u in enumerate(units):
        by_size.setdefault(len(u), []).append(i)
    firsts, seconds = [], []
    for at in by_size.values():
        at = np.array(at)
        x = np.frombuffer(b"".join(units[i] for i in at), "<f8").reshape(len(at), -1)
        own, gap = ids[at], gaps[at]
        for start in range(0, len(at), 1024):  # a block against itself and the window after it
            left, right = slice(start, start + 1024), slice(start, start + 1024 + window)
            close = x[left] @ x[right].T >= threshold
            i, j = np.nonzero(close)
            keep = (j > i) & (j - i <= window) & (gap[left][i] == gap[right][j]) & (own[left][i] != own[right][j])
            firsts.append(own[left][i[keep]])
            seconds.append(own[right][j[keep]])
    a = np.concatenate(firsts) if firsts else np.empty(0, np.int64)
    b = np.concatenate(seconds) if seconds else np.empty(0, np.int64)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


_FOUND = "a long, b long, pass int, place int, at int, key long, slot long, vec_id long, unit binary, missed double"
_KINDS = {"a": "Int64", "b": "Int64", "pass": "Int32", "place": "Int32", "at": "Int32", "key": "Int64", "slot": "Int64",
          "vec_id": "Int64", "unit": "object", "missed": "Float64"}


def _found(**columns):
    """Rows of ``_FOUND`` with nulls in all other columns."""
    n = len(next(iter(columns.values())))
    return pd.DataFrame({name: pd.Series(columns[name] if name in columns else [None] * n, dtype=kind) for name, kind in _KINDS.items()})


def _sides(slots, keys, gaps, window, threshold, cross=None):
    """(slot, missed) of both sides of every two rows a window apart, as far as no gap lies between them."""
    left, right = slice(None, max(0, len(keys) - window)), slice(window, None)
    known = gaps[left] == gaps[right]
    if cross is not None:
        known &= cross[left] != cross[right]
    missed = _missed(keys[left][known], keys[right][known], threshold)
    return np.r_[slots[left][known], slots[right][known]], np.r_[missed, missed]


def _within(window: int, threshold: float):
    """Pairs of one sorted range, and its first and last rows for the seams between ranges."""

    def seam(number, place, start, rows):
        n = len(rows["vec_id"])
        return _found(**{"pass": [number] * n}, place=[place] * n, at=np.arange(start, start + n),
                      **{c: rows[c] for c in ("key", "slot", "vec_id", "unit")})

    def run(batches):
        number, seen, tail, place = None, 0, None, None
        for batch in batches:
            for value, part in batch.groupby("pass", sort=True):
                rows = {c: part[c].to_numpy() for c in ("key", "slot", "vec_id", "unit")}
                if value != number:
                    if number is not None and len(tail["key"]):
                        yield seam(number, place, seen - len(tail["key"]), tail)
                    number, seen, place = value, 0, int(part["place"].iloc[0])
                    tail = {c: x[:0] for c, x in rows.items()}
                if seen < window:
                    yield seam(number, place, seen, {c: x[: window - seen] for c, x in rows.items()})
                old = len(tail["key"])
                seen += len(rows["key"])
                rows = {c: np.r_[tail[c], x] for c, x in rows.items()}
                none = np.zeros(len(rows["key"]), int)
                found = _compare(rows["vec_id"], rows["unit"], none, window, threshold)
                if len(found):
                    yield _found(a=found["a"].to_numpy(), b=found["b"].to_numpy())
                # The tail holds at most a window of rows, so two rows of it were never a window apart.
                assert old <= window
                slots, missed = _sides(rows["slot"], rows["key"], none, window, threshold)
                if len(slots):
                    yield _found(slot=slots, missed=missed)
                # What was sent as a head isn't sent again as a tail.
                tail = {c: x[-window:] for c, x in rows.items()}
        if number is not None and len(tail["key"]):
            yield seam(number, place, seen - len(tail["key"]), tail)

    return run


def _seams(window: int, threshold: float):
    """Pairs across the seams of one pass, and sides of its rows there: the rows around them, in the order of the pass."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["place", "at"]).sort_values(["place", "at"])
        place, at = rows["place"].to_numpy(), rows["at"].to_numpy()
        slots, keys = rows["slot"].to_numpy(), rows["key"].to_numpy()
        gap = np.cumsum(np.r_[False, (place[1:] == place[:-1]) & (at[1:] != at[:-1] + 1)])
        found = _compare(rows["vec_id"].to_numpy(), rows["unit"].to_numpy(), gap, window, threshold)
        inner, missed = _sides(slots, keys, gap, window, threshold, cross=place)
        ends = np.r_[slots[:window], slots[::-1][:window]]  # beyond the first and last rows there is nothing to miss
        names = ("a", "b", "slot", "missed")
        return pd.concat([_found(a=found["a"].to_numpy(), b=found["b"].to_numpy()),
                          _found(slot=np.r_[inner, ends], missed=np.r_[missed, np.full(len(ends), math.log(0.5))])])[list(names)]

    return run


def _links(threshold: float):
    """A spanning forest of the links in one cell; the links of a dense group would be too many."""

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, rows in cell.groupby(cell["unit"].map(len), sort=True):
            ids = rows["vec_id"].to_numpy()
            x = np.frombuffer(b"".join(rows["unit"]), "<f8").reshape(len(rows), -1)
            close, free = x @ x.T >= threshold, np.ones(len(ids), bool)
            for start in range(len(ids)):
                queue = [start] if free[start] else []
                free[start] = False
                while queue:
                    i = queue.pop()
                    then = np.flatnonzero(close[i] & free)
                    free[then] = False
                    queue += then.tolist()
                    out += [(ids[i], ids[j]) for j in then]
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _counts(threshold: float):
    """Links of each member of one cell with the members of the other block."""

    def side(rows):
        rows = rows.sort_values("node")
        return rows["node"].to_numpy(), rows["unit"].to_numpy()

    def linked(ids1, units1, ids2, units2):
        """For each distinct id of the first side, how many other distinct ids of the second it links with."""
        starts1 = np.flatnonzero(np.r_[True, ids1[1:] != ids1[:-1]])
        starts2 = np.flatnonzero(np.r_[True, ids2[1:] != ids2[:-1]])
        close = np.zeros((len(ids1), len(ids2)), bool)
        size1, size2 = (np.array([len(u) for u in units]) for units in (units1, units2))
        for size in np.intersect1d(size1, size2):
            i, j = np.flatnonzero(size1 == size), np.flatnonzero(size2 == size)
            x = np.frombuffer(b"".join(units1[i]), "<f8").reshape(len(i), -1)
            y = np.frombuffer(b"".join(units2[j]), "<f8").reshape(len(j), -1)
            close[np.ix_(i, j)] = x @ y.T >= threshold
        close = np.logical_or.reduceat(np.logical_or.reduceat(close, starts1, axis=0), starts2, axis=1)
        same = ids1[starts1][:, None] == ids2[starts2][None, :]
        return ids1[starts1], (close & ~same).sum(1)

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        lo, hi = cell["lo"].iloc[0], cell["hi"].iloc[0]
        one, two = side(cell[cell["part"] == lo]), side(cell[cell["part"] == hi])
        out = []
        if len(one[0]) and len(two[0]):
            out.append(linked(*one, *two))
            if lo != hi:
                out.append(linked(*two, *one))
        ids = np.concatenate([x for x, _ in out]) if out else np.empty(0, np.int64)
        n = np.concatenate([x for _, x in out]) if out else np.empty(0, np.int64)
        return pd.DataFrame({"node": ids, "n": n.astype(np.int64)})

    return run


def _units(batches):
    for batch in batches:
        for ids, unit in _usable(batch):
            yield pd.DataFrame({"node": ids, "unit": [v.astype("<f8").tobytes() for v in unit]})


def _pairs(rows: DataFrame, threshold: float, window: int, recall: float, seed: int) -> DataFrame:
    """Pairs (a, b) of ``rows`` (slot, vec_id, unit) that join all links, each found with probability ``recall``.

    After a round of passes each row knows how likely a pair of its own was missed. Rows that
    have reached ``recall`` leave: a pair needs one end that has. For the others a further round
    follows, or, when that would cost more, all of them are compared in cells of bounded size.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    goal = math.log(1 - recall)
    total, turn, done = rows.count(), 0, 0
    count, edges, state = min(ROUND, passes(total, threshold, window, recall)), None, None
    while total > 1:
        with staged(rows.mapInPandas(_keys(count, seed, turn), "pass int, key long, slot long, vec_id long, unit binary"), "keys") as keyed:
            sorted_rows = (keyed.repartitionByRange(parts, "pass", "key", "slot").sortWithinPartitions("pass", "key", "slot")
                           .withColumn("place", F.spark_partition_id()))
            found = stage(sorted_rows.mapInPandas(_within(window, threshold), _FOUND), "windows")
        across = stage(found.where("unit is not null").select("pass", "place", "at", "key", "slot", "vec_id", "unit")
                       .groupBy("pass").applyInPandas(_seams(window, threshold), "a long, b long, slot long, missed double"), "seams")
        both = found.select("a", "b", "slot", "missed").union(across)
        pairs = both.where("a is not null").select("a", "b")
        edges = pairs if edges is None else edges.union(pairs)
        sums = both.where("missed is not null").select("slot", "missed")
        sums = sums if state is None else sums.union(state)
        left = rows.select("slot").join(sums.groupBy("slot").agg(F.sum("missed").alias("missed")), "slot", "left")
        state = stage(left.select("slot", F.coalesce("missed", F.lit(0.0)).alias("missed")).where(F.col("missed") > goal), "unfinished")
        turn, done = turn + 1, done + count
        more = (goal - F.col("missed")) / F.least(F.col("missed"), F.lit(-1e-9)) * done
        total, more = state.agg(F.count("*"), F.percentile_approx(more, 0.5)).first()  # passes that half of them lack
        if total < 2:
            break
        rows = stage(rows.join(state.select("slot"), "slot", "left_semi"), "rows")
        if more >= total / BLOCK:
            cell = cells(rows.withColumn("size", F.lit(total)), "size", "slot", BLOCK).groupBy("lo", "hi")
            return edges.union(cell.applyInPandas(_links(threshold), "a long, b long"))
        count = min(ROUND, math.ceil(more) + 1)
    return edges


def near_vectors(vectors: DataFrame, threshold: float = 0.9, window: int = WINDOW,
                 recall: float = RECALL, seed: int = SEED) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding).

    Equal vectors are linked and go on as one. Each pass sorts the vectors by a key of
    concatenated random hashes (signs of random projections) and compares every vector with the
    ``window`` next ones. How many bits separate rows a window apart is counted in the sorted
    keys, and passes go on for each vector until that makes ``recall`` sure, whatever the size
    and directions of the table; vectors too crowded for it are compared with each other whole.
    The windows' verified pairs are united over all passes. A window may be too narrow for a
    large group of near copies: within each component all members are then compared in cells of
    bounded size, so links are counted whole, also those that no window held.

    Vectors that are null, empty, zero or hold a null or non-finite component link with
    nothing, nor do vectors of different lengths. Rows that repeat a vec_id are one vertex that
    links with what any of them is close to; each is returned. A null vec_id has no links, no
    component and isn't kept.
    """
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    units = stage(vectors.mapInPandas(_units, "node long, unit binary").distinct(), "units")
    single = stage(units.groupBy("unit").agg(F.min("node").alias("vec_id"), F.count("*").alias("n")), "single")
    rows = single.select(F.xxhash64("vec_id", "unit").alias("slot"), "vec_id", "unit")
    copies = units.join(single.where("n > 1"), "unit").select(F.col("node").alias("a"), F.col("vec_id").alias("b"))
    pairs = _pairs(rows, threshold, window, recall, seed)
    roots = components(copies if pairs is None else copies.union(pairs))

    sizes = roots.groupBy("root").agg(F.count("*").alias("size"), F.min("node").alias("component_id"))
    members = units.join(roots, "node").join(sizes, "root")
    counts = (cells(members, "size", "node", BLOCK).groupBy("root", "lo", "hi")
              .applyInPandas(_counts(threshold), "node long, n long")
              .groupBy("node").agg(F.sum("n").alias("n_links")))
    named = roots.join(sizes, "root").select("node", "component_id").join(counts, "node")
    return (
        vectors.select("vec_id").join(named.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
