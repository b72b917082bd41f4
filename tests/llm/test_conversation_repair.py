"""Repairs against every edit script, and against a search over roles row by row."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.llm import conversation_repair as repair

GRAMMAR = re.compile(r"(s?(ua)+)?")
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def every_script(rows: str) -> tuple[int, str]:
    """The cheapest least audit of short rows (letters as the module has them), by trying all."""
    found = []

    def go(i, roles, cost, audit, inserted):
        if i == len(rows):
            if GRAMMAR.fullmatch(roles):
                found.append((cost, audit))
        if inserted < 3:
            for role in "ua":
                go(i, roles + role, cost + 2, audit + "I", inserted + 1)
        if i < len(rows):
            go(i + 1, roles, cost + 3, audit + "D", inserted)
            if rows[i] != "d":
                more = int(rows[i].isupper())
                go(i + 1, roles + rows[i].lower(), cost + more, audit + "K", inserted)
                for role in "ua":
                    go(i + 1, roles + role, cost + 2 + more, audit + "R", inserted)

    go(0, "", 0, "", 0)
    return min(found)


@pytest.mark.parametrize("size", range(5))
def test_every_short_conversation(size):
    for rows in map("".join, product("suaxdUS", repeat=size) if size < 4 else product("sUad", repeat=size)):
        assert min(repair.aligned(rows, "", True).values()) == every_script(rows), rows


def search(rows) -> tuple:
    """Result of one conversation of (turn, role, text) rows: the best repair by role, row by row."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes = set(), []
    counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
        seen.add((role, text))
        codes.append(fault)
        if fault:
            counts[fault] += 1
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    best = {"": (0, "", ())}

    def inserts(best):
        out = {}
        for state, (cost, audit, lines) in best.items():
            for _ in range(4):
                out[state] = min(out.get(state, (9**9,)), (cost, audit, lines))
                state = AFTER[state]
                cost, audit, lines = cost + 2, audit + "I", (*lines, NAMES[state] + ":")
        return out

    for (_, role, text), fault in zip(rows, codes):
        after = {}

        def offer(state, *way):
            after[state] = min(after.get(state, (9**9,)), way)

        for state, (cost, audit, lines) in inserts(best).items():
            offer(state, cost + 3, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            cost += fault == "truncated"
            to = AFTER[state]
            if role[:1] == to or (role[:1] == "s" and state == ""):
                offer(role[:1], cost, audit + "K", (*lines, f"{role}:{text}"))
            offer(to, cost + 2, audit + "R", (*lines, f"{NAMES[to]}:{text}"))
        best = after
    ends = inserts(best)
    cost, audit, lines = min(ends[s] for s in ("", "a") if s in ends)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts.values(), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)


def conversation(rows) -> tuple:
    one = repair._Conversation(None)
    seen = set()
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        one.take(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    return one.result()[1:]


ROWS = st.lists(
    st.tuples(
        st.integers(0, 30) | st.none(),
        st.sampled_from(["user", "assistant", "system", "user", "assistant", "tool", "", "Assistant"]),
        st.sampled_from(["Yes.", "No!", "why? ", "cut", "", " \n", "é.", "a", "b.", "c.", "d.", "e."]),
    ),
    max_size=24,
)


@settings(max_examples=400, deadline=None)
@given(ROWS, st.sampled_from([1, 2, 3, 5, 256]))
def test_blocks_give_the_best_repair(rows, block):
    kept = repair.BLOCK
    repair.BLOCK = block
    try:
        assert conversation(rows) == search(rows)
    finally:
        repair.BLOCK = kept


def test_long_conversations():
    draw = random.Random(11)
    for size in (255, 256, 257, 700):
        rows = [(i, draw.choice(["user", "assistant", "system"]), draw.choice([f"t{i}.", f"t{i}", "", "x."])) for i in range(size)]
        assert conversation(rows) == search(rows)
    # Far from the grammar: the band is widened until the answer lies within.
    rows = [(i, "user", f"{i}.") for i in range(300)]
    assert conversation(rows) == search(rows)
    assert conversation([(i, "system", "") for i in range(600)]) == search([(i, "system", "") for i in range(600)])


def damage(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        out.setdefault(conv_id, [])
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv_id] += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_query_with_damage(spark):
    draw = random.Random(2)
    rows = []
    for conv_id in [*range(120), None, 10**15]:
        for turn in range(draw.randrange(0, 14)):
            role = draw.choice(["user", "assistant"] * 8 + ["system", None, "tool"])
            text = draw.choice(["Well.", "Well.", f"It is {turn}!", f"cut {turn}", "", None, "é\n中?"])
            rows.append((conv_id, draw.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [(77, i // 2, "user" if i % 3 else "assistant", f"row {i % 400}.") for i in range(900)]
    names = "conv_id long, turn int, role string, text string, again string, copies_ string, content string"
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], names).repartition(4)
    got = repair.repaired(repair.damaged(frame), copies="copies").collect()
    want = {conv_id: search(own) for conv_id, own in damage(rows).items()}
    assert {r.conv_id: tuple(r)[1:] for r in got} == want
    assert len(got) == len(want)


def test_without_damage_and_empty(spark):
    names = "conv_id string, turn long, role string, text string"
    rows = [("a", 1, "system", "Be brief."), ("a", 2, "user", "Hi."), ("b", None, None, None)]
    got = {r.conv_id: r for r in repair.repaired(spark.createDataFrame(rows, names)).collect()}
    assert (got["a"].cost, got["a"].audit) == (2, "KKI")
    assert got["a"].repaired_sha256 == hashlib.sha256(b"system:Be brief.\nuser:Hi.\nassistant:").hexdigest()
    assert (got["b"].cost, got["b"].audit, got["b"].blank, got["b"].gaps) == (3, "D", 1, 0)
    # A column of that name is not looked at unless it is asked for; a null stands for one row.
    odd = spark.createDataFrame([(*r, c) for r, c in zip(rows, ("x", None, None))], f"{names}, copies string")
    assert {r.conv_id: r for r in repair.repaired(odd).collect()} == got
    nulls = odd.withColumn("copies", F.lit(None).cast("int"))
    assert {r.conv_id: r for r in repair.repaired(nulls, copies="copies").collect()} == got
    empty = spark.createDataFrame([], names)
    assert repair.repaired(repair.damaged(empty), copies="copies").count() == 0
