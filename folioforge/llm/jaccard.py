"""N-gram Jaccard join over an index of count vectors.

Every text is the set of its distinct shingles. Shingles are coordinates, hashed into groups
at two grains, and the number of shingles a text has in each group is its point:

* fine groups (single shingles) cut space into slabs ``coordinate >= 1``. Sums of coordinate
  minima bound the overlap, so a text whose partner must share ``t`` of its ``n`` shingles
  has to visit only the slabs of its ``n - t + 1`` rarest coordinates: outside them the sum
  of minima stays below ``t``. Rarity is the count of the shingle's coarse order group over
  the whole corpus, a table of fixed size.
* coarse groups (``DIMS``) give the points of the R-trees inside a slab. A node keeps the
  coordinate maxima of its points; two nodes are opened only if the summed minima of their
  maxima reach the overlap that their smallest points need, and two points survive only if
  the summed minima of their own counts do.

Surviving pairs are verified on the full sets. A slab of at most ``LEAF`` texts is a leaf and
compared whole. In a larger one each text is first compared with the slab's guide and with
its neighbour by size, which joins a group of copies with one pair per member; only texts
that are then still in different components meet in R-trees, in cells of bounded size. No
partner is capped: a link is left out only between texts that are connected already.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.components import cells, components
from folioforge.llm.grams import TextHashes, mix, shingles
from folioforge.session import stage

ORDER_BITS = 14  # groups whose counts put coordinates in order: a table of 16,384 numbers
DIMS = 256  # coordinates of the points in the R-trees
HIGHEST = 65_535  # a count this high stands for any higher one
LEAF = 16  # points of a leaf
CELL = 2048  # points a cell takes from one block
SETS = 4_000_000  # shingles of full sets a cell takes from one block, about
ROW = 400  # shingles that a text counts as besides its own, in sizes of cells
FILTER_BITS = 24  # bits of the filter that keeps texts without candidates from being read again
_FULL = 2**ORDER_BITS


def needed(na, nb):
    """The least overlap of sets of ``na`` and ``nb`` with 100 * intersection >= 80 * union."""
    return (4 * (na + nb) + 8) // 9


def _order_counts(grams: list[np.ndarray]) -> np.ndarray:
    joined = np.concatenate(grams) if grams else np.empty(0, np.uint64)
    return np.bincount((joined & np.uint64(_FULL - 1)).astype(np.int64), minlength=_FULL)


def _sketch(batches):
    """Rows per text (its class and point), then the counts of the order groups of these texts."""
    hashes, counts, waiting = TextHashes(), np.zeros(_FULL, np.int64), []
    for batch in batches:
        sigs, sizes, points, held = [], [], [], 0
        for text in batch["text"]:
            grams = shingles(hashes.of(text or ""))
            waiting.append(grams)
            held += len(grams)
            if held > 500_000:
                counts += _order_counts(waiting)
                waiting, held = [], 0
            sigs.append(int(mix(grams + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
            sizes.append(len(grams))
            point = np.bincount((grams >> np.uint64(56)).astype(np.int64), minlength=DIMS)
            points.append(np.minimum(point, HIGHEST).astype("<u2").tobytes() if len(grams) else None)
        yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_key": batch["text_key"],
                            "sig": sigs, "n": sizes, "point": points,
                            "order_group": pd.array([None] * len(sigs), "Int32"),
                            "count": pd.array([None] * len(sigs), "Int64")})
        counts += _order_counts(waiting)
        waiting = []
    groups = np.flatnonzero(counts)
    if len(groups):
        empty = pd.array([None] * len(groups), "Int64")
        yield pd.DataFrame({"doc_id": empty, "text_key": empty, "sig": empty, "n": empty, "point": None,
                            "order_group": groups.astype(np.int32), "count": counts[groups]})


def _ordered(grams: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Coordinates, rarest first: the rank of the order group, then the other bits; one to one."""
    low = (grams & np.uint64(_FULL - 1)).astype(np.int64)
    return np.sort(rank[low] << np.uint64(64 - ORDER_BITS) | grams >> np.uint64(ORDER_BITS))


def _slabs(rank: np.ndarray):
    """Rows (slab, sig, n, at): the slabs a text visits and the coordinate's place in its order."""

    def run(batches):
        hashes = TextHashes()
        for batch in batches:
            seen, out = set(), []
            for text in batch["text"]:
                grams = shingles(hashes.of(text or ""))
                n = len(grams)
                if n == 0:
                    continue
                sig = int(mix(grams + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                if sig in seen:
                    continue
                seen.add(sig)
                keys = _ordered(grams, rank)[: n - (4 * n + 4) // 5 + 1].astype(np.int64)
                out.append((keys, np.full(len(keys), sig), np.full(len(keys), n, np.int32),
                            np.arange(len(keys), dtype=np.int32)))
            if out:
                slab, sig, n, at = map(np.concatenate, zip(*out, strict=True))
                yield pd.DataFrame({"slab": slab, "sig": sig, "n": n, "at": at})

    return run


def _possible(n1, at1, n2, at2):
    """Whether sizes and places leave room for the overlap that the two sizes need."""
    room = 1 + np.minimum(n1 - at1 - 1, n2 - at2 - 1)
    return (room >= needed(n1, n2)) & (5 * np.minimum(n1, n2) >= 4 * np.maximum(n1, n2))


def _candidates(batches):
    """Pairs (a, b) of small slabs, guides' pairs and members (slab, a) of large ones.

    Rows come sorted by slab, size and class. A slab that goes on over batches is carried; one
    that grows past all bounds is handed on in pieces, so memory stays bounded.
    """

    def pairs(a, b, n1, at1, n2, at2):
        keep = _possible(n1, at1, n2, at2) & (a != b)
        a, b = a[keep], b[keep]
        return pd.DataFrame({"slab": pd.array([None] * len(a), "Int64"), "n": pd.array([None] * len(a), "Int32"),
                             "a": np.minimum(a, b), "b": np.maximum(a, b)})

    def large(part):
        sig, n = part["sig"].to_numpy(), part["n"].to_numpy()
        guide, guides = 0, np.zeros(len(sig), np.int64)
        for i in range(len(sig)):
            if 5 * n[guide] < 4 * n[i]:
                guide = i
            guides[i] = guide
        a, b = np.concatenate([sig[guides], sig[:-1]]), np.concatenate([sig, sig[1:]])
        keep = a != b
        yield pd.DataFrame({"slab": pd.array([None] * int(keep.sum()), "Int64"), "n": pd.array([None] * int(keep.sum()), "Int32"),
                            "a": np.minimum(a, b)[keep], "b": np.maximum(a, b)[keep]})
        yield pd.DataFrame({"slab": part["slab"].astype("Int64"), "n": part["n"].astype("Int32"), "a": sig,
                            "b": pd.array([None] * len(sig), "Int64")})

    def whole(part):
        part = part.drop_duplicates(["slab", "sig"])
        slab, sig, n, at = (part[c].to_numpy() for c in ("slab", "sig", "n", "at"))
        starts = np.flatnonzero(np.r_[True, slab[1:] != slab[:-1]]) if len(slab) else np.empty(0, int)
        sizes = np.diff(np.r_[starts, len(slab)])
        firsts, seconds = [], []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= LEAF)]):  # all slabs of a size at once
            i, j = np.triu_indices(size, 1)
            base = starts[sizes == size][:, None]
            firsts.append((base + i).ravel())
            seconds.append((base + j).ravel())
        if firsts:
            f, s = np.concatenate(firsts), np.concatenate(seconds)
            yield pairs(sig[f], sig[s], n[f], at[f], n[s], at[s]).drop_duplicates(["a", "b"])
        for start, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF], strict=True):
            yield from large(part.iloc[start : start + size])

    carry, open_slab = None, None
    for batch in batches:
        rows = batch if carry is None else pd.concat([carry, batch], ignore_index=True)
        last = rows["slab"].iloc[-1]
        done = rows["slab"].to_numpy() != last
        ready, carry = rows[done], rows[~done].reset_index(drop=True)
        if open_slab is not None and len(ready):
            head = ready["slab"].to_numpy() == open_slab
            yield from large(ready[head].drop_duplicates("sig"))
            ready, open_slab = ready[~head], None
        if len(ready):
            yield from whole(ready)
        if len(carry) > 50_000:
            yield from large(carry.drop_duplicates("sig"))
            carry, open_slab = carry.iloc[-1:].reset_index(drop=True), last
    if carry is not None and len(carry):
        yield from large(carry.drop_duplicates("sig")) if open_slab is not None else whole(carry)


def _points(column: pd.Series) -> np.ndarray:
    points = np.frombuffer(b"".join(column), "<u2").reshape(-1, DIMS)
    if (points == HIGHEST).any():
        points = points.astype(np.int32)
        points[points == HIGHEST] = 2**22  # sums over all coordinates still fit
    return points


def _overlap(p, q) -> np.ndarray:
    """Summed coordinate minima: no two sets at these points share more."""
    return np.minimum(p, q).sum(1, dtype=np.int32)


def _bounded(batches):
    """Pairs whose points' summed minima reach the overlap that the sizes need."""
    for batch in batches:
        if len(batch):
            n1, n2 = batch["na"].to_numpy(), batch["nb"].to_numpy()
            reach = _overlap(_points(batch["pa"]), _points(batch["pb"])) >= needed(n1, n2)
            keep = reach & (5 * np.minimum(n1, n2) >= 4 * np.maximum(n1, n2))
            yield batch.loc[keep, ["a", "b"]]


def tree(points: np.ndarray, sizes: np.ndarray, roots: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Levels of a packed R-tree, points first: coordinate maxima, least and greatest size, first and last root."""
    levels = [(points, sizes, sizes, roots, roots)]
    while len(levels[-1][1]) > 1:
        maxima, least, most, first, last = levels[-1]
        starts = np.arange(0, len(least), LEAF)
        levels.append((np.maximum.reduceat(maxima, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts),
                       np.minimum.reduceat(first, starts), np.maximum.reduceat(last, starts)))
    return levels


def tree_pairs(left, right, step: int = 4096):
    """Pairs (i, j) of points of different components that survive the bound at every level.

    Nodes are opened depth first, ``step`` pairs at a time, so memory stays bounded. A tree that is
    joined with itself is opened in one order only. Roots and sizes, which cost two numbers a
    node, are looked at before the coordinates.
    """
    same = left is right
    stack = [(len(left) - 1, len(right) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        up, down, i, j = stack.pop()
        if len(i) > step:
            stack.append((up, down, i[step:], j[step:]))
            i, j = i[:step], j[:step]
        (max1, n1, most1, lo1, hi1), (max2, n2, most2, lo2, hi2) = left[up], right[down]
        if same and up == down:
            once = i <= j if up else i < j
            i, j = i[once], j[once]
        apart = (lo1[i] != hi1[i]) | (lo2[j] != hi2[j]) | (lo1[i] != lo2[j])
        apart &= (5 * most1[i] >= 4 * n2[j]) & (5 * most2[j] >= 4 * n1[i])
        i, j = i[apart], j[apart]
        reach = _overlap(max1[i], max2[j]) >= needed(n1[i], n2[j])
        i, j = i[reach], j[reach]
        if up == down == 0:
            yield i, j
        elif len(i) and up >= down:
            child = (i[:, None] * LEAF + np.arange(LEAF)).ravel()
            there = child < len(left[up - 1][1])
            stack.append((up - 1, down, child[there], np.repeat(j, LEAF)[there]))
        elif len(i):
            child = (j[:, None] * LEAF + np.arange(LEAF)).ravel()
            there = child < len(right[down - 1][1])
            stack.append((up, down - 1, np.repeat(i, LEAF)[there], child[there]))


def _cell_pairs(cell: pd.DataFrame) -> pd.DataFrame:
    """Pairs across components within one cell of a slab, by joining the trees of its two blocks."""
    sides = []
    for part in sorted({cell["lo"].iloc[0], cell["hi"].iloc[0]}):
        rows = cell[cell["part"] == part].drop_duplicates("sig").sort_values(["root", "n", "sig"])
        if len(rows):
            sig, root = rows["sig"].to_numpy(), rows["root"].to_numpy()
            sides.append((sig, tree(_points(rows["point"]), rows["n"].to_numpy().astype(np.int64), root)))
    found = [pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})]
    if sides and (len(sides) == 2 or cell["lo"].iloc[0] == cell["hi"].iloc[0]):
        (sig1, tree1), (sig2, tree2) = sides[0], sides[-1]  # one tree twice where both blocks are one
        for i, j in tree_pairs(tree1, tree2):
            a, b = np.minimum(sig1[i], sig2[j]), np.maximum(sig1[i], sig2[j])
            found.append(pd.DataFrame({"a": a, "b": b}).drop_duplicates())
    return pd.concat(found).drop_duplicates()


def _packed(grams: np.ndarray) -> bytes:
    """48 bits of each shingle hash: two sets of 20,000 agree in a shingle by chance once in a million pairs."""
    return grams.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return np.sort(wide.view("<u8").ravel())


def _sets(bits: bytes):
    """(sig, grams) of the texts that the filter names."""
    table = np.frombuffer(bits, np.uint8)

    def run(batches):
        hashes = TextHashes()
        for batch in batches:
            place = batch["text_key"].to_numpy().astype(np.uint64) & np.uint64(2**FILTER_BITS - 1)
            wanted = table[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1
            seen, sigs, sets = set(), [], []
            for text in batch["text"][wanted.astype(bool)]:
                grams = shingles(hashes.of(text or ""))
                sig = int(mix(grams + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64))
                if len(grams) and sig not in seen:
                    seen.add(sig)
                    sigs.append(sig)
                    sets.append(_packed(grams))
            yield pd.DataFrame({"sig": np.array(sigs, np.int64), "grams": sets})

    return run


def _connect(pairs: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """Links among the candidate pairs of one cell; pairs that are connected already are skipped."""
    sets = {sig: _unpacked(x) for sig, x in zip(members["sig"], members["grams"], strict=True)}
    root = dict(zip(members["sig"], members["root"], strict=True))
    up: dict[int, int] = {}

    def top(x):
        while up.get(x, x) != x:
            up[x] = x = up.get(up[x], up[x])
        return x

    out = []
    for a, b in zip(pairs["a"], pairs["b"], strict=True):
        ra, rb = top(root[a]), top(root[b])
        if ra != rb:
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                up[ra] = rb
                out.append((a, b))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _needed_sets(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(sig, grams) of both ends of ``pairs``. The texts are read again; a filter of fixed size
    leaves most of the others out before they are taken apart, the join leaves out the rest."""
    ends = pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()
    bit = F.expr(f"text_key & {2**FILTER_BITS - 1}")
    words = (ends.join(nodes.select("sig", "text_key"), "sig").select(bit.alias("bit"))
             .groupBy(F.expr("bit div 32").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 as int))")).alias("set")))
    table = np.zeros(2 ** (FILTER_BITS - 5), "<u4")  # as many numbers at any size of the corpus
    for word, bits in words.toLocalIterator():
        table[word] = bits
    sets = (texts.mapInPandas(_sets(table.tobytes()), "sig long, grams binary")
            .join(ends, "sig", "left_semi").dropDuplicates(["sig"]))
    return stage(sets, "sets")


def _verified(pairs: DataFrame, roots: DataFrame | None, nodes: DataFrame, texts: DataFrame, parts: int) -> DataFrame:
    """Links (a, b) that connect what the candidate ``pairs`` can connect, besides ``roots``.

    Pairs fall into families, the components of the candidate graph. A family's sets go to one
    cell, together with other small families', so a set travels once and not with each of its
    pairs; a family of more than ``SETS`` shingles is dealt to several cells of bounded size. A text
    counts as ``ROW`` shingles more, so that cells are bounded in rows too. The number of cells for
    small families follows from the sum of their sizes.
    """
    pairs = stage(pairs, "pairs")
    families = components(pairs).withColumnsRenamed({"node": "sig", "root": "family"})
    families = families.join(nodes.select("sig", "n"), "sig")
    sizes = stage(families.groupBy("family").agg(F.sum(F.col("n") + ROW).alias("size")), "families")
    total = sizes.where(F.col("size") <= SETS).agg(F.sum("size")).first()[0] or 0
    small = max(4 * parts, 4 * total // SETS)
    cell = F.when(F.col("size") <= SETS, F.pmod(F.xxhash64("family"), F.lit(small))).otherwise(F.xxhash64("family", "lo", "hi"))
    dealt = stage(cells(families.join(sizes, "family"), "size", "sig", SETS)
                  .select("sig", "part", "size", "family", "lo", "hi", cell.alias("cell")), "dealt")
    own = dealt.where("lo = hi")
    both = (pairs.join(own.select(F.col("sig").alias("a"), "family", "size", F.col("part").alias("pa")), "a")
            .join(own.select(F.col("sig").alias("b"), F.col("part").alias("pb")), "b")
            .withColumns({"lo": F.least("pa", "pb"), "hi": F.greatest("pa", "pb")}).select(cell.alias("cell"), "a", "b"))
    both = stage(both, "dealt-pairs")
    # A set goes only to cells that hold a pair of it.
    members = both.select("cell", F.col("a").alias("sig")).union(both.select("cell", F.col("b").alias("sig"))).distinct()
    members = stage(members, "dealt-members")
    if roots is None:
        members = members.withColumn("root", F.col("sig"))
    else:
        members = (members.join(roots.withColumnRenamed("node", "sig"), "sig", "left")
                   .withColumn("root", F.coalesce("root", "sig")))
    members = members.join(_needed_sets(both, nodes, texts), "sig")
    return stage(both.groupBy("cell").cogroup(members.groupBy("cell")).applyInPandas(_connect, "a long, b long"), "links")


def jaccard_components(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Two texts link when 100 * intersection >= 80 * union of their shingle sets; the component
    is named by its smallest doc_id. Null and wordless texts have no shingles and stand for
    themselves. A null doc_id names no component: its row gets the smallest id of the others,
    or null if there is none. Rows that repeat a doc_id are rows of their own. ``parts`` is
    the number of tasks that read slabs; by default the session's shuffle partitions.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_key"))
    rows = stage(texts.mapInPandas(
        _sketch, "doc_id long, text_key long, sig long, n int, point binary, order_group int, count long"), "sketch")
    counts = np.zeros(_FULL, np.int64)
    for group, count in (rows.where("order_group is not null").groupBy("order_group")
                         .agg(F.sum("count")).collect()):  # at most 16,384 rows
        counts[group] = count
    rank = np.empty(_FULL, np.uint64)
    rank[np.argsort(counts, kind="stable")] = np.arange(_FULL, dtype=np.uint64)

    rows = rows.where("order_group is null").drop("order_group", "count")
    nodes = stage(
        rows.where("n > 0").groupBy("sig")
        .agg(F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("point").alias("point"),
             F.min("doc_id").alias("least_id")), "nodes")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stage(
        texts.mapInPandas(_slabs(rank), "slab long, sig long, n int, at int")
        .repartition(parts, "slab").sortWithinPartitions("slab", "n", "sig")
        .mapInPandas(_candidates, "slab long, n int, a long, b long"), "candidates")
    def end(c):
        return nodes.select(F.col("sig").alias(c), F.col("n").alias(f"n{c}"), F.col("point").alias(f"p{c}"))

    pairs = found.where("slab is null").select("a", "b").distinct().join(end("a"), "a").join(end("b"), "b")
    links = _verified(pairs.mapInPandas(_bounded, "a long, b long"), None, nodes, texts, parts)
    roots = components(links)

    # Slabs of many texts: what is still apart meets in trees.
    members = found.where("slab is not null").select("slab", F.col("a").alias("sig")).distinct()
    members = members.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn(
        "root", F.coalesce("root", "sig"))
    members = stage(members, "members")
    apart = (members.groupBy("slab").agg(F.count("*").alias("size"), F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo <> hi").select("slab", "size"))
    dealt = cells(members.join(apart, "slab").join(nodes.select("sig", "n", "point"), "sig"), "size", "sig", CELL)
    more = stage(dealt.groupBy("slab", "lo", "hi").applyInPandas(_cell_pairs, "a long, b long").distinct(), "across")
    if not more.isEmpty():
        roots = components(links.union(_verified(more, roots, nodes, texts, parts)))

    named = nodes.select("sig", "least_id").join(roots.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.withColumn("root", F.coalesce("root", "sig"))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = stage(named.join(least, "root").select("sig", "component_id"), "named")
    return (
        rows.select("doc_id", F.when(F.col("n") > 0, F.col("sig")).alias("sig"), F.col("n").cast("long").alias("n_shingles"))
        .join(named, "sig", "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    )
