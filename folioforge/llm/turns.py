"""Repair of conversations: generalised LR parsing of the role grammar with weighted edits."""

from __future__ import annotations

import hashlib
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.session import stage

# The role grammar: a conversation is empty, or pairs of user and assistant after at most one system
# turn. Small letters are initials of roles.
GRAMMAR = (("conversation", ""), ("conversation", "pairs"), ("conversation", "s pairs"),
           ("pairs", "pairs u a"), ("pairs", "u a"))
ROLES = {"u": "user", "a": "assistant"}  # what an edit can make of a turn, or insert
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs; the last is that of a truncated turn that stays
LEGAL = ("su", "ua", "au")  # initials of turns that may follow each other
SEGMENT_ROWS = 4_000  # turns of one conversation repaired in one piece
SEGMENT_BYTES = 32 << 20

BLANKS = " \t\n\x0b\x0c\r"
_END = "$"


def _first_and_follow():
    """Terminals that each symbol of the grammar can begin with, and that can follow it."""
    heads = {head for head, _ in GRAMMAR}
    first, follow, empty = {h: set() for h in heads}, {h: set() for h in heads}, set()
    follow[GRAMMAR[0][0]].add(_END)
    for _ in range(len(GRAMMAR) ** 2):  # more rounds than sets can grow
        for head, body in GRAMMAR:
            after, can_end = set(follow[head]), True
            for symbol in reversed(body.split()):
                if symbol not in heads:
                    after, can_end = {symbol}, False
                    continue
                follow[symbol] |= after
                after = first[symbol] | (after if symbol in empty else set())
                can_end = can_end and symbol in empty
            if can_end:
                empty.add(head)
            begin = set()
            for symbol in body.split():
                begin |= first[symbol] if symbol in heads else {symbol}
                if symbol not in empty:
                    break
            first[head] |= begin
    return heads, follow


def _tables():
    """SLR(1) tables: (state, symbol) -> next state, (state, terminal) -> (head, length of the body), final states."""
    heads, follow = _first_and_follow()
    rules = [("", GRAMMAR[0][0]), *GRAMMAR]

    def closed(items):
        items = set(items)
        while True:
            wanted = {rules[r][1].split()[dot] for r, dot in items if dot < len(rules[r][1].split())}
            more = {(r, 0) for r, (head, _) in enumerate(rules) if head in wanted} - items
            if not more:
                return frozenset(items)
            items |= more

    states, moves, reductions, final = [closed({(0, 0)})], {}, {}, set()
    for number, items in enumerate(states):  # grows while it is read
        by_symbol = {}
        for r, dot in items:
            head, body = rules[r][0], rules[r][1].split()
            if dot < len(body):
                by_symbol.setdefault(body[dot], set()).add((r, dot + 1))
            elif r == 0:
                final.add(number)
            else:
                for terminal in follow[head]:
                    reductions.setdefault((number, terminal), []).append((head, len(body)))
        for symbol, kernel in sorted(by_symbol.items()):
            target = closed(kernel)
            if target not in states:
                states.append(target)
            moves[number, symbol] = states.index(target)
    return moves, reductions, final


_MOVES, _REDUCTIONS, _FINAL = _tables()
ROOT = (0,)


@cache
def shifted(stack: tuple, terminal: str) -> tuple[tuple, ...]:
    """The stacks after all ways to reduce and then shift ``terminal``; for the end mark, the final stacks."""
    out = []
    if terminal == _END and stack[-1] in _FINAL:
        out.append(stack)
    elif (stack[-1], terminal) in _MOVES:
        out.append((*stack, _MOVES[stack[-1], terminal]))
    for head, length in _REDUCTIONS.get((stack[-1], terminal), ()):
        below = stack[: len(stack) - length]
        out += shifted((*below, _MOVES[below[-1], head]), terminal)
    return tuple(out)


def _merge(tops: dict, stack: tuple, cost: int, audit: str) -> bool:
    """Keep the cheapest stack of each top, of equal costs that of the least audit."""
    best = tops.get(stack[-1])
    if best is None or (cost, audit) < best[:2]:
        tops[stack[-1]] = (cost, audit, stack)
        return True
    return False


@cache
def _with_inserts(stack: tuple) -> tuple:
    """(cost, audit, stack) after any number of inserted turns."""
    tops, fresh = {}, [(0, "", stack)]
    _merge(tops, stack, 0, "")
    while fresh:
        cost, audit, stack = fresh.pop()
        for terminal in ROLES:
            for after in shifted(stack, terminal):
                if _merge(tops, after, cost + INSERT, audit + "I"):
                    fresh.append((cost + INSERT, audit + "I", after))
    return tuple(tops.values())


@cache
def _edits(stack: tuple, initial: str, fault: str | None) -> tuple:
    """(cost, audit, stack) of the ways past one turn, inserts before it included."""
    tops = {}
    for cost, audit, before in _with_inserts(stack):
        _merge(tops, before, cost + DELETE, audit + "D")
        if fault in ("blank", "duplicate"):
            continue
        cost += TRUNCATED if fault else 0
        for after in shifted(before, initial):
            _merge(tops, after, cost, audit + "K")
        for terminal in ROLES:
            for after in shifted(before, terminal):
                _merge(tops, after, cost + REROLE, audit + "R")
    return tuple(tops.values())


def parses(turns, start: tuple = ROOT) -> dict:
    """{top: (cost, audit, stack)} of the best edits past all ``turns``, given as (initial, fault).

    The tops are those of a graph-structured stack: after each turn, stacks that end in the same
    state are merged, the least (cost, audit) stays. That is exact. Stacks with equal tops of this
    grammar accept the same rests. Audits of equal cost differ before one of them ends, since
    after a turn both end with that turn's letter, so a common rest doesn't change their order.
    """
    tops = {start[-1]: (0, "", start)}
    for initial, fault in turns:
        following = {}
        for cost, audit, stack in tops.values():
            for more, letters, after in _edits(stack, initial, fault):
                best = following.get(after[-1])
                if best is None or cost + more <= best[0]:
                    _merge(following, after, cost + more, audit + letters)
        tops = following
    return tops


def finished(tops: dict) -> tuple[int, str]:
    """The least (cost, audit) that ends a conversation."""
    return min((cost + more, audit + letters) for cost, audit, stack in tops.values()
               for more, letters, after in _with_inserts(stack) if shifted(after, _END))


def _stacks() -> dict:
    """A stack for every top that a conversation can have between two turns."""
    found, fresh = {ROOT[-1]: ROOT}, [ROOT]
    while fresh:
        stack = fresh.pop()
        for terminal in (*ROLES, "s"):
            for after in shifted(stack, terminal):
                if after[-1] not in found:
                    found[after[-1]] = after
                    fresh.append(after)
    return found


def initial_of(role: str) -> str:
    """A role as a terminal; roles that the grammar doesn't know, and the end mark's letter, match nothing."""
    return role[:1] if role[:1].isalpha() else ""


def _faults(turns, seen_before) -> list[str | None]:
    """Each turn's first fault. ``seen_before``: whether an earlier segment holds the same turn."""
    out, seen = [], set()
    for (role, text), before in zip(turns, seen_before, strict=True):
        words = text.rstrip(BLANKS)
        if not words:
            out.append("blank")
        elif before or (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


_EDITS = ("conv_id long, place int, at int, edit string, fault string, illegal boolean, turn long, "
          "given_role string, role string, text string")
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(schema: str, rows: list) -> pa.RecordBatch:
    fields = [x.split() for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[kind]) for c, (_, kind) in zip(columns, fields, strict=True)],
                                      [name for name, _ in fields])


def _rows(batches, names):
    for batch in batches:
        yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)


def _replayed(conv_id, place, turns, faults, audit: str, stack: tuple, previous: str | None):
    """A row per edit: kept, reroled, deleted and inserted turns in order."""
    out, waiting = [], iter(zip(turns, faults, strict=True))
    for at, edit in enumerate(audit):
        if edit == "I":
            terminal = next(t for t in ROLES if shifted(stack, t))
            stack = shifted(stack, terminal)[0]
            out.append((conv_id, place, at, edit, None, None, None, None, ROLES[terminal], ""))
            continue
        (turn, role, text), fault = next(waiting)
        illegal = previous is not None and previous + role[:1] not in LEGAL
        previous, given = role[:1], role
        if edit == "K":
            stack = shifted(stack, initial_of(role))[0]
        elif edit == "R":
            terminal = next(t for t in ROLES if shifted(stack, t))
            stack, role = shifted(stack, terminal)[0], ROLES[terminal]
        out.append((conv_id, place, at, edit, fault, illegal, turn, given, role, text))
    return out


_TURNS = ("conv_id", "place", "turn", "role", "text", "before")


def _whole(batches):
    """Edits of conversations that come whole and in order."""
    out = []
    for (conv_id, place), group in groupby(_rows(batches, _TURNS), key=lambda r: r[:2]):
        turns = [row[2:5] for row in group]
        faults = _faults([t[1:] for t in turns], [False] * len(turns))
        _, audit = finished(parses([(initial_of(t[1]), f) for t, f in zip(turns, faults, strict=True)]))
        out += _replayed(conv_id, place, turns, faults, audit, ROOT, None)
        if len(out) >= 5_000:
            yield _batch(_EDITS, out)
            out = []
    yield _batch(_EDITS, out)


_WAYS = "conv_id long, place int, start int, stop int, cost long, audit string, opens string, closes string"


def _ways(batches):
    """For each segment of a long conversation the best edits from every top to every other."""
    for (conv_id, place), group in groupby(_rows(batches, _TURNS), key=lambda r: r[:2]):
        turns = [row[3:] for row in group]
        faults = _faults([t[:2] for t in turns], [t[2] for t in turns])
        marked = [(initial_of(t[0]), f) for t, f in zip(turns, faults, strict=True)]
        yield _batch(_WAYS, [
            (conv_id, place, start, stop, cost, audit, turns[0][0][:1], turns[-1][0][:1])
            for start, stack in _stacks().items() for stop, (cost, audit, _) in parses(marked, stack).items()])


_CHOSEN = "conv_id long, place int, start int, audit string, previous string"


def _chosen(batches):
    """Which way each segment takes in the best edits of its whole conversation.

    Segments come in order. Per top only the cost, the rank of the audit among the tops' audits and
    the ways taken are held, so a conversation needs memory for its number of segments.
    """
    stacks = _stacks()
    names = [x.split()[0] for x in _WAYS.split(", ")]
    for conv_id, group in groupby(_rows(batches, names), key=lambda r: r[0]):
        tops, places, closes = {ROOT[-1]: (0, 0, None)}, [], None
        for place, rows in groupby(group, key=lambda r: r[1]):
            best = {}
            for _, _, start, stop, cost, audit, opens, ends in rows:
                if start not in tops:
                    continue
                total, rank, link = tops[start]
                way = (total + cost, rank, audit)
                if stop not in best or way < best[stop][:3]:
                    best[stop] = (*way, (link, start, audit))
                last = ends
            ranks = {key: i for i, key in enumerate(sorted({(rank, audit) for _, rank, audit, _ in best.values()}))}
            tops = {stop: (cost, ranks[rank, audit], link) for stop, (cost, rank, audit, link) in best.items()}
            places.append((place, closes))
            closes = last
        cost, _, letters, link = min((cost + more, rank, letters, link) for stop, (cost, rank, link) in tops.items()
                                     for more, letters, after in _with_inserts(stacks[stop]) if shifted(after, _END))
        out = []
        for place, previous in reversed(places):
            link, start, audit = link
            out.append((conv_id, place, start, audit + letters, previous))
            letters = ""
        yield _batch(_CHOSEN, out)


def _segments_replayed(batches):
    stacks = _stacks()
    names = (*_TURNS, "start", "audit", "previous")
    for (conv_id, place, start, audit, previous), group in groupby(_rows(batches, names), key=lambda r: (*r[:2], *r[6:])):
        turns = [row[2:6] for row in group]
        faults = _faults([t[1:3] for t in turns], [t[3] for t in turns])
        yield _batch(_EDITS, _replayed(conv_id, place, [t[:3] for t in turns], faults, audit, stacks[start], previous))


_ORDER = (F.asc_nulls_first, "turn"), (F.asc, "role"), (F.asc, "text_key")


def conversation_edits(turns: DataFrame) -> DataFrame:
    """The cheapest repair of every conversation, a row per edit, of ``turns`` (conv_id, turn, role, text).

    conv_id, place, at (the edits' order), edit (Keep, Rerole, Delete, Insert by initial), fault, illegal
    (the turn before has initials that this one mustn't follow), turn, given_role, role, text; inserted
    turns have empty texts. Null roles and texts count as one space, null conv_ids are one conversation,
    null turns come first, turns of equal number by role and hash of the text. Rows of a
    conversation stand together and in order within a partition, except those of long ones:
    these are cut into segments (``place``) by range, so that no task holds one whole.

    A segment is parsed from every top the stack can have, and the segments' results are put
    together in order; only then is it replayed.
    """
    # Spark resolves functions when they are called, so orders are built here.
    order = [direction(name) for direction, name in _ORDER]
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    ).withColumn("text_key", F.xxhash64("text"))
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = stage(sizes.where((F.col("n") > SEGMENT_ROWS) | (F.col("bytes") > SEGMENT_BYTES)), "long")
    wanted = long.select(F.col("conv_id").alias("long_id"))
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    bare = rows.withColumn("before", F.lit(False))
    short = bare.join(wanted, same, "left_anti").withColumn("place", F.lit(0))
    edits = (short.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *order)
             .select(*_TURNS).mapInArrow(_whole, _EDITS))
    extent = long.agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).first()
    if extent["n"] is None:
        return edits
    parts = int(max(extent["n"] // SEGMENT_ROWS, extent["bytes"] // SEGMENT_BYTES)) + 1
    segments = stage(
        rows.join(wanted, same, "left_semi").withColumn("tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, F.asc_nulls_first("conv_id"), *order, "tie").withColumn("place", F.spark_partition_id()), "segments")
    key = ["conv_id", "role", "text_key", "text_key2"]
    twice = (segments.withColumn("text_key2", F.xxhash64(F.lit("second"), "text")).groupBy(*key)
             .agg(F.min("place").alias("first"), F.max("place").alias("last")).where("first < last")
             .select(*(F.col(k).alias(f"k_{k}") for k in key), "first"))
    marked = segments.withColumn("text_key2", F.xxhash64(F.lit("second"), "text"))
    marked = marked.join(twice, [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in key], "left")
    marked = stage(marked.withColumn("before", F.coalesce(F.col("first") < F.col("place"), F.lit(False))).select(*_TURNS, "text_key"), "marked")
    dealt = lambda df: df.repartition("conv_id", "place").sortWithinPartitions(F.asc_nulls_first("conv_id"), "place", *order)
    ways = dealt(marked).select(*_TURNS).mapInArrow(_ways, _WAYS)
    chosen = stage(ways.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "place").mapInArrow(_chosen, _CHOSEN), "chosen")
    chosen = chosen.withColumnRenamed("conv_id", "own_id").withColumnRenamed("place", "own_place")
    again = marked.join(chosen, F.col("conv_id").eqNullSafe(F.col("own_id")) & (F.col("place") == F.col("own_place")))
    replayed = dealt(again).select(*_TURNS, "start", "audit", "previous").mapInArrow(_segments_replayed, _EDITS)
    # Whoever reads the edits in order needs all segments of a conversation in one partition.
    replayed = replayed.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "place", "at")
    return edits.union(replayed)


_REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")


def _reported(batches):
    """One row per conversation from its edits in order; texts are hashed as they pass."""
    names = [x.split()[0] for x in _EDITS.split(", ")]
    out = []
    for conv_id, group in groupby(_rows(batches, names), key=lambda r: r[0]):
        faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        illegal = cost = distinct = 0
        low = high = None
        audit, digest, begun = [], hashlib.sha256(), False
        for _, _, _, edit, fault, unfit, turn, _, role, text in group:
            audit.append(edit)
            illegal += bool(unfit)
            cost += {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
            if fault:
                faults[fault] += 1
                cost += TRUNCATED if fault == "truncated" and edit != "D" else 0
            if turn is not None and turn != high:
                distinct, low, high = distinct + 1, turn if low is None else low, turn
            if edit != "D":
                digest.update((b"\n" if begun else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
                begun = True
        gaps = 0 if low is None else high - low + 1 - distinct
        out.append((conv_id, gaps, *faults.values(), illegal, cost, "".join(audit), digest.hexdigest()))
        if len(out) >= 2_000:
            yield _batch(_REPORT, out)
            out = []
    yield _batch(_REPORT, out)


def repair_report(conv_ids: DataFrame, turns: DataFrame) -> DataFrame:
    """A row for each distinct conv_id of ``conv_ids``: gaps, faults, cost and audit of the repair of ``turns``.

    A conversation without turns has zeros, an empty audit and the digest of nothing. The digest runs
    over a conversation's text from begin to end, as SHA-256 must, in one task that holds a row at a time.
    """
    done = conversation_edits(turns).mapInArrow(_reported, _REPORT).withColumnRenamed("conv_id", "own_id")
    all_ids = conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = all_ids.join(done, F.col("conv_id").eqNullSafe(F.col("own_id")), "left").drop("own_id")
    nothing = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    names = [x.split()[0] for x in _REPORT.split(", ")][1:]
    return joined.select("conv_id", *(F.coalesce(name, F.lit(nothing.get(name, 0))).alias(name) for name in names))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with the faults that ``crc32("conv_id:turn") % 20`` gives each row: 0 drops it, 1 empties
    its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat_ws(":", space("conv_id"), space("turn"))) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    return (turns.where(lot != 0).select("conv_id", "turn", F.when(lot == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"),
                                         F.explode(F.when(lot == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"))
            .drop("_copy"))
