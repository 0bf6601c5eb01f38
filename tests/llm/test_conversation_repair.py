"""Conversation repair against exhaustive search and against its SQL."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from helpers import write

from tradeledger.llm import conversation_repair as cr
from tradeledger.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
GOAL = re.compile(r"(s?(ua)+)?\Z")


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def faults(rows):
    """[(initial, fault)] of (turn, role, text) rows in order."""
    made, seen = [], set()
    for _, role, text in rows:
        shown = text.rstrip("\t\n\x0b\x0c\r ")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else None if shown[-1] in ".!?" else "truncated"
        seen.add((role, text))
        made.append((role[:1], fault))
    return made


def exhaustive(found, most_inserts=2):
    """Cheapest (cost, edits) over every edit of every row and every place of insertions."""
    best = None
    ways = [("K", "Ru", "Ra", "D") if f not in ("blank", "duplicate") else ("D",) for _, f in found]
    inserts = [w for n in range(most_inserts + 1) for w in itertools.product("ua", repeat=n)]
    for chosen in itertools.product(*ways):
        base = sum({"K": 0, "R": 2, "D": 3}[w[0]] + (w != "D" and f == "truncated") for w, (_, f) in zip(chosen, found))
        if best and base > best[0]:
            continue
        for gaps in itertools.product(inserts, repeat=len(found) + 1):
            roles = edits = ""
            cost = base + 2 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            for gap, w, (initial, _) in zip(gaps, (*chosen, None), (*found, (None, None))):
                roles += "".join(gap)
                edits += "I" * len(gap)
                if w:
                    edits += w[0]
                    roles += "" if w == "D" else initial if w == "K" else w[1]
                    roles += "?" if w == "K" and not initial else ""
            if GOAL.match(roles) and (best is None or (cost, edits) < best):
                best = (cost, edits)
    return best


def streamed(found, entry=cr.NOTHING):
    s, audit = cr.Survivors(entry), b""
    for initial, fault in found:
        s.advance(initial, fault in ("blank", "duplicate"), fault == "truncated")
        audit += s.take()
    cost, rest = s.finish()
    return cost, (audit + rest).decode()


def test_every_short_conversation():
    kinds = [("s", None), ("u", None), ("a", None), ("a", "truncated"), ("u", "truncated"), ("", None), ("t", "truncated"), ("u", "blank"), ("s", "duplicate")]
    for n in (0, 1, 2):
        for found in itertools.product(kinds, repeat=n):
            assert streamed(found) == exhaustive(found), found
    rng = random.Random(1)
    for _ in range(60):
        found = [rng.choice(kinds) for _ in range(3)]
        assert streamed(found) == exhaustive(found), found


def full_table(found):
    """Cheapest (cost, edits) with whole strings for each state, nothing dropped."""
    ways = {cr.NOTHING: (0, b"")}
    for initial, fault in found:
        after = {}
        for z, moves in cr.moves(initial, fault in ("blank", "duplicate"), fault == "truncated"):
            options = [(ways[x][0] + c, ways[x][1] + e) for x, c, e in moves if x in ways]
            if options:
                after[z] = min(options)
        ways = after
    return min((c + cr.ending(s)[0], (e + cr.ending(s)[1]).decode()) for s, (c, e) in ways.items())


def test_long_conversations_with_ties_and_long_undecided_runs():
    rng = random.Random(2)
    for weights in ((1,) * 8, (1, 1, 1, 1, 1, 1, 30, 30), (9, 1, 1, 0, 0, 9, 0, 0), (0, 0, 9, 0, 0, 0, 9, 0)):
        for _ in range(60):
            kinds = [("u", None), ("a", None), ("s", None), ("a", "truncated"), ("u", "truncated"), ("x", None), ("u", "blank"), ("a", "duplicate")]
            found = rng.choices(kinds, weights, k=rng.randrange(200))
            assert streamed(found) == full_table(found)


def nodes(s):
    todo, n = [s.root], 0
    while todo:
        node = todo.pop()
        n += 1
        todo += node.children
        assert node.refs == max(1, len(node.children))
    return n


def test_memory_is_what_is_undecided():
    s, rng, most = cr.Survivors(), random.Random(3), 0
    for _ in range(20000):
        s.advance(rng.choice("uuaas"), False, rng.random() < 0.1)
        s.take()
        assert nodes(s) <= 7
        most = max(most, *(len(s.undecided(z)) for z in s.ways))
    assert most < 100
    for _ in range(20000):  # undecided as long as all rows must go
        s.advance("u", True, False)
        s.take()
    assert nodes(s) <= 7


def brute(rows):
    """Result by conv_id of raw (conv_id, turn, role, text) rows, damage included."""
    made = {}
    for conv_id, turn, role, text in rows:
        own = made.setdefault(conv_id, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        own += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = {}
    for conv_id, own in made.items():
        own = ordered(own)
        found = faults(own)
        cost, audit = full_table(found)
        turns = {t for t, _, _ in own if t is not None}
        lines, state, left = [], "", list(own)
        for e in audit:
            row = left.pop(0) if e != "I" else None
            if e != "D":
                role = row[1] if e == "K" else "assistant" if state == "u" else "user"
                state = role[:1]
                lines.append(role + ":" + (row[2] if row else ""))
        assert GOAL.match("".join(x[:1] for x in lines)) and not left
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == k for _, f in found) for k in ("blank", "duplicate", "truncated")),
            sum(x[0] + y[0] not in ("su", "ua", "au") for x, y in zip(found, found[1:])),
            cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def awkward(rng, conversations=60):
    texts = ["Yes.", "No", "Why? ", "", " \t\n", None, "ends ", "é!", "a\nb.\r\n", "long. " * 3000]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ux"]
    rows = []
    for c in [None, *range(conversations)]:
        for t in range(rng.randrange(9)):
            turn = rng.choice([t, t, t, t + 1, None, -5, t * 1000]) if c is None or c % 3 else t
            rows.append((c, turn, rng.choice(roles[: 8 if c is None or c % 2 else 3]), rng.choice(texts)))
    return rows + rows[:3] + [(999, 5, "user", "Hi."), (999, 5, "user", "Hi."), (998, None, None, None)]


def results(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("hot_rows", [1, 3, cr.HOT_ROWS])
def test_rows_with_every_awkward_case(spark, tmp_path, hot_rows):
    rows = awkward(random.Random(hot_rows))
    given = spark.createDataFrame(rows, SCHEMA)
    clashing = given.selectExpr("*", "'own' as dropped", "1 as seen", "2 as blank", "3 as _rows", "4 as audit")
    got = cr.repair(cr.damage(clashing), hot_rows)
    assert got.count() == len({r[0] for r in rows})
    assert results(got) == brute(rows)


def test_one_hot_conversation_equals_the_stream(spark):
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant"]), rng.choice(["Yes.", "no", "Sure!", f"row {t}.", " "])) for t in range(3000)]
    rows += [(2, None, "user", "All null turns.")] * 50 + [(3, 1, "user", "x"), (3, 2, "assistant", "y.")]
    assert results(cr.repair(cr.damage(spark.createDataFrame(rows, SCHEMA)), 40)) == brute(rows)


def test_empty_table(spark):
    assert cr.repair(cr.damage(spark.createDataFrame([], SCHEMA))).collect() == []


def test_statement_on_awkward_rows(spark, tmp_path):
    rows = awkward(random.Random(11))
    folder = write(spark, tmp_path, conversations=spark.createDataFrame(rows, SCHEMA))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{folder}/conversations.parquet/*.parquet')")
    want = {r[0]: r[1:] for r in con.execute(queries.ORACLE["op12_conversation_repair"]).fetchall()}
    assert results(queries.QUERIES["op12_conversation_repair"](spark, folder)) == want == brute(rows)
