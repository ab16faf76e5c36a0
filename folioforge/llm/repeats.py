"""Removal of long byte strings that occur twice, by prefix-free parsing.

A trigger is a place whose next ``GRAM`` bytes hash below a bound; triggers cut a text into phrases.
A suffix of the corpus is the rest of its phrase followed by the parse from the next trigger on, and
two equal strings of ``length`` bytes have their first trigger at the same place. So corpus order
is the order of phrase endings, then that of parse suffixes, and only suffixes with the same
first trigger need be compared.

Positions before a trigger are taken together in blocks. All strings of ``length`` bytes that
begin in one block share the block's core, the bytes from its last position to the end of the string
that begins first, and lie in its hull, from its first position to the end of the last string.
Blocks whose core occurs once hold no repeated string; where the hull recurs, all are
repeated. Both follow from sorted hashes. For what is left, the ends of copied passages, two
suffix arrays are built over blocks of equal core: one of the phrase endings left of the core, one
of what follows it in the parse. A string is repeated when both number it like another.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.grams import mix
from folioforge.session import stage

LENGTH = 400  # bytes of the shortest string that counts
GRAM = 8  # bytes that decide about a trigger
TASK_ROWS = 500_000  # blocks sorted in one task
GROUP = 2_000  # blocks of one core whose suffixes are sorted in one task; larger groups go by hashes of whole strings
SEGMENT = 1 << 20  # bytes hashed at a time
FILTER_BITS = 1 << 24

_BLOCKS = "core long, hull long, at int, size int, tie int, doc_id long, text_key long"


def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


class _Hashes:
    """64-bit hashes of equally long ranges of a text: polynomials modulo 2^64 over a random number per byte value."""

    def __init__(self, seed: int):
        self.numbers = mix(np.arange(256, dtype=np.uint64) + np.uint64(seed << 32))
        self.base = int(mix(np.array([seed], np.uint64))[0]) | 5
        self._grow(4096)

    def _grow(self, size: int) -> None:
        self.up, self.down = _powers(self.base, size), _powers(pow(self.base, -1, 1 << 64), size)

    def of(self, data: np.ndarray, begins: np.ndarray, length: int) -> np.ndarray:
        """Hashes of ``data[begin : begin + length]``; ``begins`` ascend."""
        out = np.empty(len(begins), np.uint64)
        for low in range(0, len(data), SEGMENT):
            i, j = np.searchsorted(begins, [low, low + SEGMENT])
            if i == j:
                continue
            part = self.numbers[data[low : low + SEGMENT + length]]
            if len(part) > len(self.up):
                self._grow(2 * len(part))
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * self.up[: len(part)], out=sums[1:])
            at = begins[i:j] - low
            out[i:j] = (sums[at + length] - sums[at]) * self.down[at]
        return mix(out)


def _triggers(data: np.ndarray, every: int) -> np.ndarray:
    """Places whose next ``GRAM`` bytes hash below a bound, about one in ``every``."""
    found, bound = [], np.uint64((1 << 64) // max(2, every))
    for low in range(0, len(data) - GRAM + 1, SEGMENT):
        part = np.ascontiguousarray(data[low : low + SEGMENT + GRAM - 1])
        grams = np.ndarray((len(part) - GRAM + 1,), np.dtype("<u8"), part, 0, (1,))
        found.append(np.flatnonzero(mix(grams.astype(np.uint64)) < bound) + low)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _blocks(data: np.ndarray, length: int):
    """(end, size, first, last) of each block: it is named by its last place, holds ``size`` at most, and
    of these the places from first to last; every string of ``length`` bytes begins in one block.

    Blocks lie before triggers. Strings without a trigger inside, as in long runs of few letters, take the
    next of more and more frequent triggers, and blocks are smaller; without any, a string is a
    block by itself.
    """
    n = len(data)
    last = length - GRAM  # a string that begins further before a trigger doesn't hold it whole
    found, open_places = [], np.arange(n - length + 1)
    for every, size in ((length // 6, length * 8 // 25), (8, length // 25), (2, length // 100)):
        at, size = _triggers(data, every), max(1, size)
        if not len(at) or not len(open_places):
            continue
        place = np.searchsorted(at, open_places)
        back = at[np.minimum(place, len(at) - 1)] - open_places
        inside = (place < len(at)) & (back <= last)
        here, back = open_places[inside], back[inside]
        ends = here + back % size
        new = np.flatnonzero(np.diff(ends, prepend=-1))
        found.append((ends[new], np.full(len(new), size), here[new], here[np.append(new[1:], len(here)) - 1] if len(new) else here[:0]))
        open_places = open_places[~inside]
    found.append((open_places, np.ones(len(open_places), np.int64), open_places, open_places))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, text): null texts are empty; the key tells apart rows of one doc_id."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


_KINDS_OF = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}


def _table(schema: str, columns: dict) -> pa.RecordBatch:
    """A batch of ``schema``; columns are arrays, or lists of arrays to be joined."""
    names, arrays = [], []
    for name, kind in (x.split() for x in schema.split(", ")):
        values = columns[name]
        if isinstance(values, list) and values and isinstance(values[0], np.ndarray):
            values = np.concatenate(values)
        names.append(name)
        arrays.append(values.cast(_KINDS_OF[kind]) if isinstance(values, pa.Array) else pa.array(values, _KINDS_OF[kind]))
    return pa.RecordBatch.from_arrays(arrays, names)


def _taken(batch, rows: np.ndarray, names) -> dict:
    """Columns of some rows of a batch."""
    at = pa.array(rows)
    return {name: batch.column(name).take(at) for name in names}


def _hashed(hashes: _Hashes, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of ranges of a few different lengths."""
    out = np.empty(len(begins), np.uint64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        rows = rows[np.argsort(begins[rows], kind="stable")]
        out[rows] = hashes.of(data, begins[rows], int(length))
    return out


def _parsed(texts: DataFrame, length: int) -> DataFrame:
    """A row per block: hashes of core and hull, and where it ends."""

    def run(batches):
        one, two, seen = _Hashes(1), _Hashes(2), 0
        for batch in batches:
            out = {name: [np.empty(0, np.int64)] for name in ("core", "hull", "at", "size", "row")}
            for row, (key, text) in enumerate(zip(batch.column("text_key").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                if len(data) < length:
                    continue
                ends, sizes, _, _ = _blocks(data, length)
                whole = (ends >= sizes - 1) & (ends + length <= len(data))
                # A block at the edge of its text has no hull; its mark is its own.
                hull = mix(ends.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 64)))
                hull[whole] = _hashed(two, data, (ends - sizes + 1)[whole], (length + sizes - 1)[whole])
                out["core"].append(_hashed(one, data, ends, length - sizes + 1).view(np.int64))
                out["hull"].append(hull.view(np.int64))
                out["at"].append(ends)
                out["size"].append(sizes)
                out["row"].append(np.full(len(ends), row))
            rows = np.concatenate(out.pop("row"))
            out["tie"] = (rows + seen) % (1 << 31)
            seen += batch.num_rows
            yield _table(_BLOCKS, out | _taken(batch, rows, ("doc_id", "text_key")))

    return texts.mapInArrow(run, _BLOCKS)


def _lengths(starts: np.ndarray) -> np.ndarray:
    """For each row the number of rows of its run; ``starts`` marks the first of each."""
    runs = np.cumsum(starts) - 1
    return np.bincount(runs)[runs]


# kind: 0 the hull recurs, 1 only the core does, 2 stands for a hull that recurs, 3 first or last row of a range
_KINDS = "kind int, place int, core_n int, hull_n int, core long, hull long, at int, size int, doc_id long, text_key long"


def _sorted_runs(batches):
    """What a range of blocks, sorted by core and hull, tells about them.

    Equal cores stand together, so only a range's first and last row can have equals elsewhere
    that aren't seen here; these are handed on for a look at the other ranges' (kind 3).
    """
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.concat_batches(held)
    core, hull, size = (table.column(name).to_numpy() for name in ("core", "hull", "size"))
    new_core = np.concatenate([[True], core[1:] != core[:-1]])
    new_hull = new_core | np.concatenate([[True], hull[1:] != hull[:-1]])
    core_n, hull_n = _lengths(new_core), _lengths(new_hull)
    edge = np.zeros(len(core), bool)
    edge[[0, -1]] = True
    many = (size > 1) & (core_n > 1)
    single = many & (hull_n == 1)
    run = np.cumsum(new_core) - 1
    asked = np.bincount(run, weights=single)[run] > 0
    asked |= (core == core[0]) | (core == core[-1])
    for kind, rows in ((0, hull_n > 1), (1, single & ~edge), (2, many & (hull_n > 1) & new_hull & asked), (3, edge)):
        found = np.flatnonzero(rows)
        columns = _taken(table, found, ("place", "core", "hull", "at", "size", "doc_id", "text_key"))
        if kind == 0:  # most rows of copies; nobody asks for their hashes again
            columns |= dict.fromkeys(("core", "hull"), [None] * len(found))
        yield _table(_KINDS, columns | {"kind": np.full(len(found), kind), "core_n": np.minimum(core_n[found], 2),
                                        "hull_n": np.minimum(hull_n[found], 2)})


def _classed(blocks: DataFrame) -> DataFrame:
    """(kind, core, at, size, doc_id, text_key) of blocks whose core recurs; one shuffle, by range.

    A core that occurs very often spans several ranges: hull and tie are part of the range key.
    """
    spark = blocks.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-blocks.count() // TASK_ROWS))
    order = ("core", "hull", "tie")
    found = stage(
        blocks.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("place", F.spark_partition_id()).mapInArrow(_sorted_runs, _KINDS), "runs")
    rows = ("core", "at", "size", "doc_id", "text_key")
    edges = found.where("kind = 3")  # two rows a range at most
    seen = lambda keys, name: edges.groupBy(*keys).agg((F.min("place") < F.max("place")).alias(name))
    kinds = lambda *k: F.array(*map(F.lit, k)).cast("array<int>")
    settled = (edges.join(seen(["core", "hull"], "hull_twice"), ["core", "hull"]).join(seen(["core"], "core_twice"), "core")
               .withColumn("kind", F.explode(
                   F.when(F.col("hull_twice") | (F.col("hull_n") > 1), F.when(F.col("size") > 1, kinds(0, 2)).otherwise(kinds(0)))
                   .when((F.col("size") > 1) & (F.col("core_twice") | (F.col("core_n") > 1)), kinds(1)).otherwise(kinds()))))
    return found.where("kind < 3").select("kind", *rows).union(settled.select("kind", *rows))


def _order_numbers(rows: np.ndarray, groups: np.ndarray):
    """Suffix array of ``rows`` within groups: their order, and the bytes each shares with the one before (-1: other group)."""
    keys = np.concatenate([groups.astype(">u4").view(np.uint8).reshape(-1, 4), rows], 1)
    order = np.argsort(np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").ravel(), kind="stable")
    sorted_keys = keys[order]
    differ = sorted_keys[1:] != sorted_keys[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), keys.shape[1]) - 4
    return order, np.concatenate([[-1], np.where(shared < 0, -1, shared)])


def repeated_strings(groups, left, n_left, right, n_right) -> np.ndarray:
    """Which strings of blocks recur: a row per block, a column per number of bytes taken left of the core.

    ``left`` holds the bytes before the core, nearest first, ``right`` those after it; the string of
    column d has d of the first and all but d of the second. ``groups`` are the cores.
    """
    n, reach = left.shape
    out = np.zeros((n, reach + 1), bool)
    sides = [_order_numbers(left, groups), _order_numbers(right, groups)]

    def numbers(side, depth):
        order, shared = side
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(shared < depth)
        return out

    for d in range(reach + 1):
        there = np.flatnonzero((n_left >= d) & (n_right >= reach - d))
        if len(there) < 2:
            continue
        names = numbers(sides[0], d)[there] * (n + 1) + numbers(sides[1], reach - d)[there]
        _, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
        out[there, d] = counts[inverse] > 1
    return out


def _marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``texts`` with ``marked``: false only where no row of ``wanted`` has the text's key.

    A filter of ``FILTER_BITS`` bits whatever the tables' sizes, so that texts nobody asks for
    aren't shuffled; more keys make it weaker, never wrong.
    """
    slot = F.expr(f"text_key & {FILTER_BITS - 1}")
    words = (wanted.select((slot / 64).cast("int").alias("word"), (slot % 64).cast("int").alias("bit")).distinct()
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")))
    joined = texts.join(F.broadcast(words), (slot / 64).cast("int") == F.col("word"), "left")
    bit = F.expr(f"shiftright(bits, cast((text_key & {FILTER_BITS - 1}) % 64 as int)) & 1")
    return joined.withColumn("marked", F.coalesce(bit == 1, F.lit(False))).drop("word", "bits")


_SPANS = "doc_id long, text_key long, low int, high int"
_SIDES = "core long, open boolean, at int, size int, doc_id long, text_key long, before binary, after binary"


def _looked_up(texts: DataFrame, wanted: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over the texts that have rows in ``wanted``, each with its rows as the list ``found``."""
    lists = (wanted.groupBy(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
             .agg(F.collect_set(F.struct("core", "open", "at", "size", "hot")).alias("found")))  # of one text
    named = _marked(texts, wanted).where("marked")
    joined = named.join(lists, (F.col("text_key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
    return joined.select("doc_id", "text_key", "text", "found").mapInArrow(run, schema)


def _sides(length: int):
    """The bytes beside the cores of blocks; for blocks of very frequent cores hashes of their strings instead."""
    schema = _SIDES + ", first long, second long"

    def run(batches):
        one, two = _Hashes(1), _Hashes(2)
        for batch in batches:
            near = {name: [] for name in ("core", "open", "at", "size", "before", "after", "row")}
            far = {name: [np.empty(0, np.int64)] for name in ("at", "first", "second", "row")}
            for row, (text, found) in enumerate(zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True)):
                raw = text.encode("utf-8", "surrogatepass")
                for x in found:
                    if not x["hot"]:
                        at, reach = x["at"], x["size"] - 1
                        for name, value in zip(near, (x["core"], x["open"], at, x["size"], raw[max(0, at - reach) : at],
                                                      raw[at + length - reach : at + length], row), strict=True):
                            near[name].append(value)
                hot = {(x["at"], x["size"]) for x in found if x["hot"]}
                if hot:
                    data = np.frombuffer(raw, np.uint8)
                    # Of the places a block names, those that are its own, so no string is counted twice.
                    begins = np.sort(np.concatenate([np.arange(first, last + 1) for end, size, first, last
                                                     in zip(*(x.tolist() for x in _blocks(data, length)), strict=True) if (end, size) in hot]))
                    for name, values in zip(far, (begins, one.of(data, begins, length).view(np.int64), two.of(data, begins, length).view(np.int64),
                                                  np.full(len(begins), row)), strict=True):
                        far[name].append(values)
            rows = np.array(near.pop("row"), np.int64)
            none = [None] * len(rows)
            yield _table(schema, near | {"first": none, "second": none} | _taken(batch, rows, ("doc_id", "text_key")))
            rows = np.concatenate(far.pop("row"))
            none = [None] * len(rows)
            yield _table(schema, far | dict.fromkeys(("core", "open", "size", "before", "after"), none) | _taken(batch, rows, ("doc_id", "text_key")))

    return run, schema


def _solved(length: int):
    """Spans of the repeated strings of blocks that come sorted by core."""

    def spans(rows: pa.RecordBatch):
        sizes = rows.column("size").to_numpy()
        for size in np.unique(sizes).tolist():
            yield spans_of(rows.filter(pa.array(sizes == size)), size - 1)

    def spans_of(rows: pa.RecordBatch, reach: int):
        core, at = rows.column("core").to_numpy(), rows.column("at").to_numpy()
        groups = np.cumsum(np.concatenate([[0], core[1:] != core[:-1]]))
        left, n_left = _matrix([x[::-1] for x in rows.column("before").to_pylist()], reach)
        right, n_right = _matrix(rows.column("after").to_pylist(), reach)
        found = repeated_strings(groups, left, n_left, right, n_right) & rows.column("open").to_numpy(zero_copy_only=False)[:, None]
        steps = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, begin = np.nonzero(steps == 1)
        stop = np.nonzero(steps == -1)[1]
        return _table(_SPANS, _taken(rows, row, ("doc_id", "text_key")) | {"low": at[row] - stop + 1, "high": at[row] - begin + length})

    def run(batches):
        held, kept = [], 0
        for batch in batches:
            held.append(batch)
            kept += batch.num_rows
            if kept < 8 * GROUP:
                continue
            rows = pa.concat_batches(held)
            core = rows.column("core").to_numpy()
            cut = int(np.flatnonzero(core == core[-1])[0])  # the last group may go on
            if cut:
                yield from spans(rows.slice(0, cut))
            held, kept = [rows.slice(cut)], len(core) - cut
        if kept:
            yield from spans(pa.concat_batches(held))

    return run


def _matrix(rows: list[bytes], width: int):
    """Rows of bytes, filled up with zeros, and their lengths."""
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    filled = b"".join(x.ljust(width, b"\0") for x in rows)
    return np.frombuffer(filled, np.uint8).reshape(len(rows), width), lengths  # a block has two places at least


def repeated_spans(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(doc_id, text_key, low, high): bytes covered by strings of ``length`` bytes that occur twice.

    Spans of a text may overlap; bytes in no span aren't covered. ``group`` bounds the blocks of
    one core that are sorted together.
    """
    texts = _texts(docs)
    classed = _classed(stage(_parsed(texts, length), "blocks"))
    whole = classed.where("kind = 0").select(
        "doc_id", "text_key", F.greatest(F.lit(0), F.col("at") - F.col("size") + 1).alias("low"), (F.col("at") + length).alias("high"))
    open_or_model = stage(classed.where("kind in (1, 2)"), "open")
    sizes = open_or_model.groupBy("core").agg(F.count("*").alias("n"), F.max(F.col("kind") == 1).alias("asked"))
    sizes = stage(sizes.where("n > 1 and asked").select("core", (F.col("n") > group).alias("hot")), "cores")
    wanted = open_or_model.join(sizes, "core").select("core", (F.col("kind") == 1).alias("open"), "at", "size", "hot", "doc_id", "text_key")
    run, schema = _sides(length)
    sides = stage(_looked_up(texts, wanted, run, schema), "sides")
    near = sides.where("core is not null").select(*(x.split()[0] for x in _SIDES.split(", ")))
    solved = near.repartition("core").sortWithinPartitions("core").mapInArrow(_solved(length), _SPANS)
    spans = whole.union(solved)
    strings = sides.where("core is null").select(
        F.col("first").alias("core"), F.col("second").alias("hull"), "at", F.lit(1).alias("size"),
        F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(1 << 30)).cast("int").alias("tie"), "doc_id", "text_key")
    if not sizes.where("hot").isEmpty():
        spans = spans.union(_classed(strings).where("kind = 0").select("doc_id", "text_key", F.col("at").alias("low"), (F.col("at") + length).alias("high")))
    return spans


def remove_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): every row of ``docs`` (doc_id, text) without its repeated bytes.

    A byte goes when a string of ``length`` bytes over it begins anywhere else too, in another text
    or in the same one. ``spans`` are the removed runs (low, high), ``kept`` the other bytes. Null
    texts are empty; a null doc_id is a document like any other; rows that are equal repeat each other.
    """
    spans = stage(repeated_spans(docs, length, group), "spans")
    lists = (spans.groupBy(F.col("doc_id").alias("own_id"), F.col("text_key").alias("own_key"))
             .agg(F.collect_set(F.struct("low", "high")).alias("found")))  # of one text
    texts = _marked(_texts(docs), spans)
    none = F.array().cast("array<struct<low: int, high: int>>")
    whole = texts.where("not marked").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), none.alias("spans"),
        F.encode("text", "UTF-8").alias("kept"))
    joined = texts.where("marked").join(
        lists, (F.col("text_key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("own_id")), "left")

    def run(batches):
        for batch in batches:
            ids, sizes, gone, runs, kept = batch["doc_id"], [], [], [], []
            for text, found in zip(batch["text"].to_pylist(), batch["found"].to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                merged = []
                for low, high in sorted((x["low"], min(x["high"], len(raw))) for x in found or []):
                    if merged and low <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], high)
                    else:
                        merged.append([low, high])
                ends = [0, *(x[1] for x in merged)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends, [*(x[0] for x in merged), len(raw)], strict=True)))
                sizes.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                runs.append([{"low": a, "high": b} for a, b in merged])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(runs, pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return whole.union(joined.select("doc_id", "text", "found").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, spans array<struct<low: int, high: int>>, kept binary"))


def repeat_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                                       F.sha2("kept", 256).alias("kept_sha256"))
