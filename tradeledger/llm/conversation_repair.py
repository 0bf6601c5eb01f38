"""Cheapest repair of damaged conversations by a Viterbi search with survivor coalescence.

A conversation is read as a stream. For each state of the role automaton ``(s?(ua)+)?`` the
cheapest way to reach it survives. The survivors form a tree: a branch that no survivor uses any
more is dropped by its reference count, and what all survivors share is emitted at once, so
memory holds what is undecided and not the conversation. Ties go to the ASCII-least edits:
the complete undecided suffixes of both ways are compared.

The tables of ways through neighbouring stretches compose like matrices, so one conversation with
a large part of all rows is cut into ranges that tasks walk on their own.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tradeledger.llm.common import col
from tradeledger.session import stage

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1

#: States by what has been put out: nothing, the system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Next state after a role initial.
STEP = {
    "s": {NOTHING: SYSTEM},
    "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
LEGAL = {"su", "ua", "au"}
SPACES = "\t\n\x0b\x0c\r "
#: Conversations with more rows are cut into ranges.
HOT_ROWS = 200_000


def step(state: int, initial: str) -> int | None:
    return STEP.get(initial, {}).get(state)


def inserted(state: int) -> list[tuple[int, int]]:
    """(state, number of inserted turns) for each state that the fewest insertions reach."""
    found, seen = [(state, 0)], {state}
    for at, n in found:
        for initial in "ua":
            to = step(at, initial)
            if to is not None and to not in seen:
                seen.add(to)
                found.append((to, n + 1))
    return found


@lru_cache(maxsize=None)
def moves(initial: str, faulty: bool, truncated: bool) -> list[tuple[int, list[tuple[int, int, bytes]]]]:
    """For each state after a row: [(state before, cost, edits)], the best from each state before."""
    best: dict[tuple[int, int], tuple[int, bytes]] = {}
    for before in range(4):
        for at, n in inserted(before):
            ways = [(at, DELETE)]
            if not faulty:
                ways += [(step(at, initial), KEEP), (step(at, "u"), REROLE), (step(at, "a"), REROLE)]
            for after, edit in ways:
                if after is None:
                    continue
                cost = n * COST[INSERT] + COST[edit] + (TRUNCATED_COST if truncated and edit != DELETE else 0)
                way = (cost, (INSERT * n + edit).encode())
                if (after, before) not in best or way < best[after, before]:
                    best[after, before] = way
    return [(after, [(b, *best[after, b]) for b in range(4) if (after, b) in best]) for after in range(4)]


def ending(state: int) -> tuple[int, bytes] | None:
    """Cost and edits that complete a conversation from ``state``."""
    if state in (NOTHING, ASSISTANT):
        return 0, b""
    for at, n in inserted(state):
        if at == ASSISTANT:
            return n * COST[INSERT], (INSERT * n).encode()
    return None


def detour(better: int, state: int) -> int:
    """What a way in state ``better`` pays at most to follow every future of ``state``: insertions that
    lead there, or to a complete conversation, which can do all that ``state`` can but keep a system turn."""
    reached = dict(inserted(better))
    if state in reached:
        return reached[state] * COST[INSERT]
    return reached[ASSISTANT] * COST[INSERT] + (COST[DELETE] if state == NOTHING else 0)


DETOURS = [(b, s, detour(b, s)) for b in range(4) for s in range(4) if b != s]


class Node:
    """A stretch of edits without a branch; ``refs`` counts its children, or 1 for a survivor."""

    __slots__ = ("parent", "edits", "refs", "children")

    def __init__(self, parent: Node | None, edits: bytes = b"") -> None:
        self.parent, self.edits, self.refs, self.children = parent, bytearray(edits), 0, []


class Survivors:
    """The cheapest way to each state; ``take`` hands out the edits that are decided."""

    def __init__(self, entry: int = NOTHING) -> None:
        self.root = Node(None)
        self.root.refs = 1
        self.ways: dict[int, tuple[int, Node]] = {entry: (0, self.root)}

    def path(self, node: Node) -> list[Node]:
        made = []
        while node is not None:
            made.append(node)
            node = node.parent
        return made[::-1]

    def less(self, x: Node, x_more: bytes, y: Node, y_more: bytes) -> bool:
        """Compares the whole undecided edits of two ways of equal cost."""
        if x is y:
            return x_more < y_more
        one, two = self.path(x), self.path(y)
        i = 0
        while i < min(len(one), len(two)) and one[i] is two[i]:
            i += 1
        a, b = one[i].edits, two[i].edits
        if a.startswith(b) or b.startswith(a):
            return b"".join(n.edits for n in one[i:]) + x_more < b"".join(n.edits for n in two[i:]) + y_more
        return a < b

    def advance(self, initial: str, faulty: bool, truncated: bool) -> None:
        chosen: dict[int, tuple[int, int, bytes]] = {}
        for after, ways in moves(initial, faulty, truncated):
            best = None
            for before, cost, edits in ways:
                if before not in self.ways:
                    continue
                total, node = self.ways[before]
                total += cost
                if best is None or total < best[0] or total == best[0] and self.less(node, edits, self.ways[best[1]][1], best[2]):
                    best = (total, before, edits)
            if best:
                chosen[after] = best
        # a way that another one undercuts whatever follows cannot win
        lost = {s for b, s, more in DETOURS if b in chosen and s in chosen and chosen[b][0] + more < chosen[s][0]}
        chosen = {s: way for s, way in chosen.items() if s not in lost}
        users: dict[int, list[int]] = {}
        for after, (_, before, _) in chosen.items():
            users.setdefault(before, []).append(after)
        made = {}
        for before, (_, node) in self.ways.items():
            heirs = users.get(before, [])
            if len(heirs) == 1:
                node.edits += chosen[heirs[0]][2]
                made[heirs[0]] = node
            elif heirs:
                node.refs = len(heirs)
                for after in heirs:
                    child = Node(node, chosen[after][2])
                    child.refs = 1
                    node.children.append(child)
                    made[after] = child
        for before, (_, node) in self.ways.items():
            if before not in users:
                self.release(node)
        self.ways = {after: (chosen[after][0], made[after]) for after in chosen}

    def release(self, node: Node) -> None:
        """Drops a way; a parent with one child left takes it in."""
        node.refs -= 1
        if node.refs:
            return
        parent = node.parent
        if parent is None:
            return
        parent.children.remove(node)
        parent.refs -= 1
        if parent.refs == 0:
            parent.refs = 1
            self.release(parent)
        elif parent.refs == 1:
            self.absorb(parent)

    def absorb(self, parent: Node) -> None:
        (child,) = parent.children
        child.edits = parent.edits + child.edits
        child.parent = parent.parent
        if parent.parent is None:
            self.root = child
        else:
            parent.parent.children[parent.parent.children.index(parent)] = child

    def take(self) -> bytes:
        """Edits that all survivors share; they are not kept any longer."""
        shared = bytes(self.root.edits)
        self.root.edits.clear()
        return shared

    def undecided(self, state: int) -> bytes:
        return b"".join(bytes(n.edits) for n in self.path(self.ways[state][1]))

    def finish(self) -> tuple[int, bytes]:
        """Cost of the cheapest complete repair and its edits that were not taken yet."""
        ends = []
        for state, (cost, _) in self.ways.items():
            more = ending(state)
            if more:
                ends.append((cost + more[0], self.undecided(state) + more[1]))
        return min(ends)


class Row(NamedTuple):
    role: str
    text: str | None  # None where the edit cannot be but Delete
    faulty: bool
    truncated: bool


class Application:
    """Applies edits to rows in order: (role, text, edit) of every turn put out."""

    def __init__(self, state: int = NOTHING) -> None:
        self.state = state

    def turns(self, edits: bytes, rows: deque) -> Iterator[tuple[str, str, str]]:
        for edit in edits.decode():
            if edit == DELETE:
                rows.popleft()
                continue
            role, text = ("assistant" if self.state == USER else "user"), ""
            if edit != INSERT:
                row = rows.popleft()
                text = row.text
                role = row.role if edit == KEEP else role
            self.state = step(self.state, role[:1])
            yield role, text, edit


def flags(role: str, text: str, seen: bool, again: bool, blank: bool, truncated: bool) -> Row:
    faulty = blank or seen or again
    return Row(role, None if faulty else text, faulty, truncated and not faulty)


def marked(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with their faults: blank, seen (role and text in an earlier turn), truncated.

    Only groups of rows that span several turns are joined back; copies within one turn are
    neighbours in the order (turn, role, text) and found there.
    """
    shown = F.rtrim("text", F.lit(SPACES))
    rows = rows.withColumns(
        {"blank": shown == "", "truncated": ~F.right(shown, F.lit(1)).isin(".", "!", "?") & (shown != ""), "digest": F.md5(F.col("text").cast("binary"))}
    )
    groups = rows.groupBy(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d")).agg(
        F.min("turn").alias("_first"), F.max("turn").alias("_last"), F.max(F.col("turn").isNull()).alias("_null")
    )
    spread = groups.filter((F.col("_first") < F.col("_last")) | (F.col("_null") & F.col("_first").isNotNull()))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    seen = F.col("turn").isNotNull() & (F.col("_null") | (F.col("turn") > F.col("_first")))
    joined = rows.join(spread, same, "left")
    return joined.select("conv_id", "turn", "role", "text", F.coalesce(seen, F.lit(False)).alias("seen"), "blank", "truncated")


def walk_type(conv_type: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("conv_id", conv_type), *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())]
    )


INPUT = ["conv_id", "turn", "role", "text", "seen", "blank", "truncated"]


class Walk:
    """One conversation (or a range of it) row by row; ``entry`` states are walked side by side."""

    def __init__(self, conv_id, entries=(NOTHING,)) -> None:
        self.conv_id = conv_id
        self.survivors = {e: Survivors(e) for e in entries}
        self.last = None
        self.first_initial = self.last_initial = None
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}

    def add(self, turn, role: str, text: str, seen: bool, blank: bool, truncated: bool) -> Row:
        again = self.last == (turn, role, text)
        self.last = (turn, role, text)
        row = flags(role, text, seen, again, blank, truncated)
        fault = "blank" if blank else "duplicate" if seen or again else "truncated" if truncated else None
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last_initial is None:
            self.first_initial = initial
        else:
            self.counts["illegal"] += self.last_initial + initial not in LEGAL
        self.last_initial = initial
        for s in self.survivors.values():
            s.advance(initial, row.faulty, row.truncated)
        return row


def grouped(batches) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conv_id, its rows) of sorted batches; the rows are a stream."""
    rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
    yield from groupby(rows, key=lambda r: r[0])


def walked(sorted_rows: DataFrame) -> DataFrame:
    """Repair of every conversation of rows that are dealt and sorted by conversation."""
    kind = walk_type(sorted_rows.schema["conv_id"].dataType)
    arrow = to_arrow_schema(kind)

    def run(batches):
        for conv_id, rows in grouped(batches):
            walk, pending, applied = Walk(conv_id), deque(), Application()
            survivors, audit, digest, begun = walk.survivors[NOTHING], bytearray(), hashlib.sha256(), False

            def put(edits):
                nonlocal begun
                audit.extend(edits)
                for role, text, _ in applied.turns(edits, pending):
                    digest.update((("\n" if begun else "") + role + ":" + text).encode())
                    begun = True

            for r in rows:
                pending.append(walk.add(*r[1:]))
                put(survivors.take())
            cost, rest = survivors.finish()
            put(rest)
            out = [conv_id, *walk.counts.values(), cost, audit.decode(), digest.hexdigest()]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(out, arrow)], schema=arrow)

    return sorted_rows.mapInArrow(packed(run, arrow), kind)


def packed(run, schema: pa.Schema, rows: int = 4096):
    """Joins the small batches of ``run``."""

    def together(batches):
        held = []
        for b in run(batches):
            held.append(b)
            if len(held) == rows:
                yield pa.Table.from_batches(held, schema=schema).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held, schema=schema).combine_chunks().to_batches()[0]

    return together


COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def in_order(rows: pa.Table) -> list[tuple]:
    found = zip(*(rows.column(c).to_pylist() for c in INPUT[1:]))
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def walked_in_ranges(rows: DataFrame, range_rows: int = HOT_ROWS) -> DataFrame:
    """As ``walked``, with every conversation cut into ranges of the order (turn, role, text).

    Each range is walked from every state it may be entered in; the tables of ways are composed
    by conversation (16 ways of a byte a row), and each range then applies its edits. Only the
    digest of the repaired text, a sequence by definition, goes through one task for each
    conversation, as a stream.
    """
    conv = T.StructField("conv_id", rows.schema["conv_id"].dataType)
    part, long = T.StructField("part", T.IntegerType()), T.LongType()
    n = max(1, rows.count() // range_rows)
    # a prefix of the text keeps the sampled bounds small; rows alike stay together
    dealt = rows.repartitionByRange(n, "conv_id", "turn", "role", F.substring("text", 1, 64))
    dealt = stage(dealt.withColumn("part", F.spark_partition_id()), "ranges")

    way = T.StructType([T.StructField("entry", long), T.StructField("exit", long), T.StructField("cost", long), T.StructField("edits", T.StringType())])
    table_type = T.StructType(
        [conv, part, *[T.StructField(c, T.StringType()) for c in ("first", "last")], *[T.StructField(c, long) for c in COUNTS], T.StructField("ways", T.ArrayType(way))]
    )
    table_arrow = to_arrow_schema(table_type)

    def table_of(rows: pa.Table) -> pa.Table:
        walk = Walk(None, range(4))
        for r in in_order(rows):
            walk.add(*r)
        ways = [
            {"entry": a, "exit": b, "cost": cost, "edits": s.undecided(b).decode()} for a, s in walk.survivors.items() for b, (cost, _) in s.ways.items()
        ]
        made = {"conv_id": rows.column("conv_id")[0].as_py(), "part": rows.column("part")[0].as_py(), "first": walk.first_initial, "last": walk.last_initial}
        return pa.Table.from_pylist([{**made, **walk.counts, "ways": ways}], schema=table_arrow)

    tables = stage(dealt.groupBy("conv_id", "part").applyInArrow(table_of, table_type), "range-ways")

    piece = [T.StructField("entry", long), T.StructField("edits", T.StringType())]
    chosen_type = T.StructType([conv, part, *piece, *[T.StructField(c, long) for c in (*COUNTS, "cost")], T.StructField("audit", T.StringType())])
    chosen_arrow = to_arrow_schema(chosen_type)

    def fold(table: pa.Table) -> pa.Table:
        found = sorted(table.to_pylist(), key=lambda r: r["part"])
        ways = {NOTHING: (0, "", ())}
        for r in found:
            after = {}
            for w in r["ways"]:
                if w["entry"] in ways:
                    cost, edits, path = ways[w["entry"]]
                    made = (cost + w["cost"], edits + w["edits"], (*path, (w["entry"], w["edits"])))
                    if w["exit"] not in after or made[:2] < after[w["exit"]][:2]:
                        after[w["exit"]] = made
            ways = after
        ends = [(c + e[0], edits + e[1].decode(), path, e[1].decode()) for s, (c, edits, path) in ways.items() if (e := ending(s))]
        cost, audit, path, rest = min(ends, key=lambda e: e[:2])
        total = {c: sum(r[c] for r in found) for c in COUNTS}
        total["illegal"] += sum(x["last"] + y["first"] not in LEGAL for x, y in zip(found, found[1:]))
        out = [{"conv_id": r["conv_id"], "part": r["part"], "entry": a, "edits": edits} for r, (a, edits) in zip(found, path)]
        out[-1]["edits"] += rest
        out[0] |= {**total, "cost": cost, "audit": audit}  # once for a conversation
        return pa.Table.from_pylist(out, schema=chosen_arrow)

    chosen = stage(tables.groupBy("conv_id").applyInArrow(fold, chosen_type), "range-edits")

    line_type = T.StructType([conv, part, T.StructField("at", long), T.StructField("line", T.StringType())])
    line_arrow = to_arrow_schema(line_type)

    def apply(rows: pa.Table, edits: pa.Table) -> pa.Table:
        pending, last = deque(), None
        for turn, role, text, seen, blank, truncated in in_order(rows):
            pending.append(flags(role, text, seen, last == (turn, role, text), blank, truncated))
            last = (turn, role, text)
        turns = Application(edits.column("entry")[0].as_py()).turns(edits.column("edits")[0].as_py().encode(), pending)
        lines = [f"{role}:{text}" for role, text, _ in turns]
        same = [edits.column(c)[0].as_py() for c in ("conv_id", "part")]
        values = [[same[0]] * len(lines), [same[1]] * len(lines), range(len(lines)), lines]
        return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(values, line_arrow)], schema=line_arrow)

    pieces = chosen.select("conv_id", "part", "entry", "edits")
    lines = dealt.groupBy("conv_id", "part").cogroup(pieces.groupBy("conv_id", "part")).applyInArrow(apply, line_type)
    digest_type = T.StructType([conv, T.StructField("repaired_sha256", T.StringType())])
    digest_arrow = to_arrow_schema(digest_type)

    def hashed(batches):
        for conv_id, found in grouped(batches):
            digest = hashlib.sha256()
            for i, r in enumerate(found):
                digest.update((("\n" if i else "") + r[3]).encode())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv_id, digest.hexdigest()), digest_arrow)], schema=digest_arrow)

    digests = lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at").mapInArrow(hashed, digest_type)
    digests = digests.withColumnRenamed("conv_id", "_c")
    whole = chosen.filter("audit is not null").join(digests, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    nothing = hashlib.sha256().hexdigest()  # every turn was deleted
    return whole.select("conv_id", *COUNTS, "cost", "audit", F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def repair(rows: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row for each conv_id of ``rows`` (conv_id, turn, role, text, and ``dropped`` for rows that are gone).

    Columns: gaps, the faults blank, duplicate and truncated (each row's first), illegal neighbours,
    cost, audit (initials of the cheapest edits, ASCII-least on ties) and repaired_sha256. Rows are
    read by turn (nulls first); rows of one turn by role and text, so copies are neighbours. A
    null role or text is one space. A null conv_id is a conversation like any other. Without rows
    left: zeros, an empty audit and the digest of an empty text.
    """
    present = rows.filter(~F.col("dropped"))
    counted = rows.groupBy("conv_id").agg(
        F.sum(F.when(F.col("dropped"), 0).otherwise(1)).alias("_rows"),
        F.min(F.when(~F.col("dropped"), F.col("turn"))).alias("_low"),
        F.max(F.when(~F.col("dropped"), F.col("turn"))).alias("_high"),
    )
    turns = present.select("conv_id", "turn").distinct().groupBy(F.col("conv_id").alias("_t")).agg(F.count("turn").alias("_turns"))
    counted = counted.join(turns, F.col("conv_id").eqNullSafe(F.col("_t")), "left")
    gaps = F.coalesce(F.col("_high") - F.col("_low") + 1 - F.col("_turns"), F.lit(0)).cast("long").alias("gaps")
    counted = stage(counted.select("conv_id", "_rows", gaps), "conversations")
    faults = stage(marked(present), "marked-turns")
    # less than rows / hot_rows conversations; Spark broadcasts them if they turn out small
    hot = counted.filter(F.col("_rows") > hot_rows).select(F.col("conv_id").alias("_h"))
    same = F.col("conv_id").eqNullSafe(F.col("_h"))
    if hot.isEmpty():
        found = walked(faults.repartition("conv_id").sortWithinPartitions(*INPUT[:4]))
    else:
        some = faults.join(hot, same, "left_anti")
        found = walked(some.repartition("conv_id").sortWithinPartitions(*INPUT[:4]))
        found = found.unionByName(walked_in_ranges(stage(faults.join(hot, same, "left_semi"), "hot-turns"), hot_rows))
    found = found.withColumnRenamed("conv_id", "_f")
    joined = counted.join(found, F.col("conv_id").eqNullSafe(F.col("_f")), "left")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*COUNTS, "cost")]
    return joined.select(
        "conv_id", "gaps", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def plain_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, turn as long, role and text with one space for null, nothing dropped."""
    space = F.lit(" ")
    return conversations.select(
        col("conv_id").alias("conv_id"), col("turn").cast("long").alias("turn"), F.coalesce(col("role").cast("string"), space).alias("role"),
        F.coalesce(col("text").cast("string"), space).alias("text"), F.lit(False).alias("dropped"),
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Input of ``repair`` with a fixed fault on some rows, by crc32 of ``conv_id:turn`` modulo 20."""
    rows = plain_rows(conversations)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = rows.withColumn("_fault", F.crc32(key.cast("binary")) % 20)
    fault: Column = F.col("_fault")
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (fault == 0).alias("dropped"), copies).drop("_copy")


def oracle() -> str:
    """DuckDB statement of ``repair`` over damaged ``conversations``: a table of ways, row by row, in a recursive query."""
    table = ", ".join(
        f"('{initial}', {faulty}, {truncated}, {before}, {after}, {cost}, '{edits.decode()}')"
        for initial in "sua-" for faulty in (True, False) for truncated in (True, False)
        for after, ways in moves(initial, faulty, truncated) for before, cost, edits in ways
    )
    ends = ", ".join(f"({s}, {ending(s)[0]}, '{ending(s)[1].decode()}')" for s in range(4))
    return rf"""
with recursive crc as (
  select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k from conversations),
coded as (
  select conv_id, turn, role, text, xor(list_reduce(list_transform(range(1, length(k) + 1), lambda i: cast(ascii(substr(k, i, 1)) as bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as f from given, crc),
damaged as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case when f = 1 then '' when f = 2 then translate(text, '.!?', '') else text end as text
  from coded, unnest(range(case f when 0 then 0 when 3 then 2 else 1 end)) u(copy)),
ordered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged),
placed as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 as seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as shown from ordered),
faults as (
  select *, shown = '' as is_blank, shown <> '' and seen as is_duplicate,
    shown <> '' and not seen and right(shown, 1) not in ('.', '!', '?') as is_truncated,
    case when left(role, 1) in ('s', 'u', 'a') then left(role, 1) else '-' end as c,
    coalesce(lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) not in ('su', 'ua', 'au'), false) as is_illegal
  from placed),
counts as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    sum(cast(is_blank as int)) as blank, sum(cast(is_duplicate as int)) as duplicate,
    sum(cast(is_truncated as int)) as truncated, sum(cast(is_illegal as int)) as illegal
  from faults group by conv_id),
moves(c, faulty, cut, before, after, cost, edits) as (values {table}),
ends(state, cost, edits) as (values {ends}),
ways(conv_id, i, state, way) as (
  select conv_id, cast(0 as bigint), 0, {{'cost': 0, 'edits': ''}} from counts
  union all
  select w.conv_id, w.i + 1, m.after, min({{'cost': w.way.cost + m.cost, 'edits': w.way.edits || m.edits}})
  from ways w join faults f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1
  join moves m on m.c = f.c and m.faulty = (is_blank or is_duplicate) and m.cut = is_truncated and m.before = w.state
  group by w.conv_id, w.i, m.after),
best as (
  select w.conv_id, min({{'cost': way.cost + e.cost, 'edits': way.edits || e.edits}}) as way
  from ways w join counts n on n.conv_id is not distinct from w.conv_id and n.n = w.i join ends e on e.state = w.state group by w.conv_id),
edits as (select conv_id, j, substr(way.edits, j, 1) as e, from best, unnest(range(1, length(way.edits) + 1)) u(j)),
aimed as (select *, sum(case when e = 'I' then 0 else 1 end) over (partition by conv_id order by j) as i from edits),
turns as (
  select a.conv_id, a.j, e, f.role, f.text, row_number() over (partition by a.conv_id order by a.j) as p
  from aimed a left join faults f on f.conv_id is not distinct from a.conv_id and f.i = a.i and e <> 'I' where e <> 'D'),
begun as (
  select *, max(case when p = 1 and e = 'K' and left(role, 1) = 's' then 1 else 0 end) over (partition by conv_id) as s from turns),
lines as (
  select conv_id, j, case when e = 'K' then role when (p - s) % 2 = 1 then 'user' else 'assistant' end || ':' ||
    case when e = 'I' then '' else text end as line from begun),
repaired as (select conv_id, string_agg(line, chr(10) order by j) as body from lines group by conv_id)
select o.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, cast(coalesce(blank, 0) as bigint) as blank, cast(coalesce(duplicate, 0) as bigint) as duplicate,
  cast(coalesce(truncated, 0) as bigint) as truncated, cast(coalesce(illegal, 0) as bigint) as illegal,
  cast(coalesce(b.way.cost, 0) as bigint) as cost, coalesce(b.way.edits, '') as audit, sha256(coalesce(body, '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join counts c on c.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id left join repaired r on r.conv_id is not distinct from o.conv_id
"""
