import hashlib
import itertools
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from chartmill.llm import conversations, minplus, queries

SCHEMA = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"


def brute_edits(rows, faults):
    """Cheapest audit, ASCII-least, by trying all edits row by row, with the lines it leaves."""
    best = {"": (0, "", [])}  # last initial so far, with its cost, audit and lines

    def offer(to, state, cost, audit, lines):
        if state not in to or (cost, audit) < to[state][:2]:
            to[state] = (cost, audit, lines)

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit, lines) in list(out.items()):
                role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
                offer(out, role[0], cost + 2, audit + "I", [*lines, (role, "")])
        return out

    # Prefixes of equal cost can be extended alike, so the least audit of each state is enough.
    for (role, text), fault in zip(rows, faults):
        to = {}
        for state, (cost, audit, lines) in inserted(best).items():
            offer(to, state, cost + 3, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            more = int(fault == "truncated")
            if role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[state] and role[:1]:
                offer(to, role[0], cost + more, audit + "K", [*lines, (role, text)])
            new = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            offer(to, new[0], cost + 2 + more, audit + "R", [*lines, (new, text)])
        best = to
    ends = inserted(best)
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda x: x[:2])


def brute(rows):
    """The report on one conversation's rows (turn, role, text)."""
    blanks, seen, faults = " \t\n\x0b\x0c\r", set(), []
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1].encode(), r[2].encode()))
    for _, role, text in rows:
        solid = [c for c in text if c not in blanks]
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else None if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit, lines = brute_edits([r[1:] for r in rows], faults)
    turns = {r[0] for r in rows if r[0] is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest(),
    ), lines


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = out.setdefault(conv, [])
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        if kind:
            mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def reports(df, **options):
    return {r.conv_id: tuple(r)[1:] for r in conversations.Repair(df, **options).reports().collect()}


roles = st.sampled_from(["user", "assistant", "system", "tool", "", " ", "unknown"])
texts = st.sampled_from(["Good.", "Well!", "cut off", "", " \t", "what? ", "x" * 70 + ".", "x" * 70 + "!", " ", "no end."])


@given(st.lists(st.tuples(st.none() | st.integers(-2, 6), roles, texts), max_size=14))
@settings(max_examples=1500, deadline=None)
def test_one_conversation_against_all_edits(rows):
    expected, lines = brute(rows)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1].encode(), r[2].encode()))
    report, left = conversations.examine(ordered)
    assert (tuple(report.values()), [x[1:] for x in left]) == (expected, lines)


def test_brute_force_itself():
    """Against the definition spelled out: every string of edits, every outcome."""
    import re

    options = [("user", None), ("assistant", "truncated"), ("system", None), ("x", None), ("user", "duplicate")]
    for rows in itertools.chain.from_iterable(itertools.product(options, repeat=n) for n in range(4)):
        best = None
        for audit in itertools.chain.from_iterable(itertools.product("DIKR", repeat=n) for n in range(len(rows) + 4)):
            if sum(c != "I" for c in audit) != len(rows) or audit.count("I") > 4:
                continue
            todo, outcomes, cost = iter(rows), [""], 0
            for letter in audit:
                role, fault = next(todo) if letter != "I" else ("", None)
                if letter == "D":
                    cost += 3
                elif fault == "duplicate":
                    cost = None
                    break
                else:
                    cost += (letter != "K") * 2 + (fault == "truncated")
                    outcomes = [o + i for o in outcomes for i in (role[0] if letter == "K" else "ua")]
            if cost is not None and any(re.fullmatch("(s?(ua)+)?", o) for o in outcomes) and (best is None or (cost, "".join(audit)) < best):
                best = (cost, "".join(audit))
        assert brute_edits([(r, "t.") for r, _ in rows], [f for _, f in rows])[:2] == best


@pytest.mark.parametrize("symbol", range(minplus.SYMBOLS))
def test_powers_of_long_runs(symbol):
    out = minplus.IDENTITY
    for n in range(40):
        assert minplus.product([(symbol, n)]) == out
        assert minplus.before(symbol, n, minplus.END) == minplus.apply(out, minplus.END)
        out = minplus.times(out, minplus.matrix(symbol))


def long_conversations(n):
    rnd = random.Random(n)
    rows = []
    for conv in [1, 2, 3, None]:
        for k in range(n if conv == 2 else 30):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None])
            turn = rnd.choice([None, k, k, k // 2, k + conv * 3 if conv else k])
            rows.append((conv, turn, role, rnd.choice([None, "", "same.", "same", f"text {rnd.random():.2f}{rnd.choice('.!?,')}", "y" * 80 + str(k % 3)])))
    return rows


@pytest.mark.parametrize("slice_rows", [3, 50, conversations.SLICE_ROWS])
def test_slices_make_no_difference(spark, slice_rows):
    rows = long_conversations(400)
    df = spark.createDataFrame(rows + [(7, 1, "user", "alone.")], SCHEMA).repartition(5)
    expected = {c: brute(x) for c, x in damaged(rows + [(7, 1, "user", "alone.")]).items()}
    wide = conversations.damage(df).withColumns({n: F.lit(f"own {n}") for n in ("conv", "kind", "slice", "pos", "edit", "fault", "first", "letters")})
    done = conversations.Repair(wide, present="present", with_lines=True, slice_rows=slice_rows)
    assert {r.conv_id: tuple(r)[1:] for r in done.reports().collect()} == {c: e[0] for c, e in expected.items()}
    lines = {}
    for r in sorted(done.lines().collect(), key=lambda r: (r.part, r.pos)):
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    assert lines == {c: e[1] for c, e in expected.items() if e[1]}


def test_edges(spark):
    empty = hashlib.sha256().hexdigest()
    df = spark.createDataFrame([(1, None, None, None), (1, None, None, None), (2, 5, "user", "Hi."), (3, 0, "user", "gone")], SCHEMA)
    found = reports(df.withColumn("there", F.col("conv_id") != 3), present="there")
    assert found[1] == (0, 2, 0, 0, 1, 6, "DD", empty) and found[3] == (0, 0, 0, 0, 0, 0, "", empty)
    assert found[2][5:7] == (2, "KI")
    assert reports(df.limit(0)) == {}


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r.conv_id: tuple(r)[1:] for r in queries.QUERIES["op13_conversations"](spark, SF).collect()}
    assert found == {c: brute(x)[0] for c, x in damaged(rows).items()}
