"""Repair of the turn structure of conversations, with an audit of every edit.

A conversation's rows are taken by turn, nulls first, those of one turn by role and text.  A null role or
text counts as one space; a null conversation id is a conversation.  A row's first fault counts: blank (no
character but white space), duplicate (role and text seen earlier in the conversation), truncated (its last
character, white space apart, is none of ``.!?``).  Rows are kept, reroled, deleted or inserted so that role
initials read ``(s?(ua)+)?`` at the least cost; :mod:`minplus` has the costs and finds the edits.

Rows are dealt by ranges of (conversation, turn, role, head of the text) and sorted, so that tasks get equal
shares however long a conversation is.  One that lies inside a range is repaired there, in one pass.  Those
that reach a border, at most two in a range, or that are longer than ``SLICE_ROWS`` are *held*: their rows
are cut into slices, each slice becomes runs of equal symbols and the min-plus product of these, products
are combined along the conversation, and each slice is then unrolled by itself for each state it may be
entered in.  No step gathers the rows of a conversation.  Only the digest of the repaired text, which must be
computed from its first byte to its last, reads a held conversation as one sorted stream, holding nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from chartmill.llm import minplus
from chartmill.llm.base import give_back, written

BLANKS = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
LEGAL = {"su", "ua", "au"}
FAULTS = ("blank", "duplicate", "truncated")
# A slice ends beyond this many rows or characters.
SLICE_ROWS = 20_000
SLICE_CHARS = 16_000_000
HEAD = 64  # characters of a text that take part in dealing rows by ranges
OUT_ROWS = 500

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_EMPTY = dict.fromkeys(("gaps", *FAULTS, "illegal", "cost"), 0) | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
_Row = tuple[int | None, str, str]


def damage(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults planted by ``crc32("conv:turn") % 20``, nulls read as one space, and a column ``present``.

    0 drops the row (``present`` is false, so its conversation is still known), 1 empties the text, 2 removes
    its sentence ends, 3 repeats the row, 4 makes it the user's.
    """

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"),
        F.pmod(F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn)).cast("binary")), F.lit(20)).alias("kind"),
    )
    kind, words = F.col("kind"), F.col("text")
    changed = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(words, "[.!?]", "")).otherwise(words)
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"),
        (kind != 0).alias("present"), F.explode(copies).alias("copy"),
    ).drop("copy").withColumnsRenamed({"conv": conv, "turn": turn, "role": role, "text": text})


def fault(role: str, text: str, seen: bool) -> int:
    """0 for none, else 1 + the place of the fault among ``FAULTS``."""
    body = text.rstrip(BLANKS)
    return 1 if not body else 2 if seen else 0 if body.endswith(ENDS) else 3


def as_symbol(role: str, fault: int) -> int:
    return minplus.symbol(role, (minplus.FINE, minplus.MUST_GO, minplus.MUST_GO, minplus.TRUNCATED)[fault])


def edits(rows: Iterator[tuple[str, str]], letters: str, state: int) -> Iterator[tuple[str, str, str]]:
    """Letter, role and text of every line that is left, in order, from the (role, text) of all rows."""
    for letter in letters:
        if letter == "I":
            state = minplus.FORCED[state]
            yield letter, minplus.ROLE[state], ""
            continue
        role, text = next(rows)
        if letter == "K":
            state = minplus.KEPT[minplus.INITIALS.get(role[:1], 3)][state]
            yield letter, role, text
        elif letter == "R":
            state = minplus.FORCED[state]
            yield letter, minplus.ROLE[state], text


class Digest:
    """SHA-256 of lines joined by line breaks, line by line."""

    def __init__(self):
        self.sha, self.begun = hashlib.sha256(), False

    def add(self, role: str, text: str) -> None:
        self.sha.update(f"\n{role}:{text}".encode() if self.begun else f"{role}:{text}".encode())
        self.begun = True

    def hexdigest(self) -> str:
        return self.sha.hexdigest()


def missing_turns(least: int | None, most: int | None, distinct: int) -> int:
    return 0 if least is None else min(most - least + 1 - distinct, 2**63 - 1)


def examine(rows: list[_Row]) -> tuple[dict, list[tuple[str, str, str]]]:
    """The report on one whole conversation, rows in order, and the lines that are left."""
    seen: set[tuple[str, str]] = set()
    found = []
    for _, role, text in rows:
        found.append(fault(role, text, (role, text) in seen))
        seen.add((role, text))
    runs = minplus.runs_of(as_symbol(row[1], f) for row, f in zip(rows, found))
    letters, state = minplus.unroll(runs, minplus.END, minplus.START)
    letters += minplus.ending(state)
    lines = list(edits(iter([row[1:] for row in rows]), letters, minplus.START))
    digest = Digest()
    for _, role, text in lines:
        digest.add(role, text)
    turns = {row[0] for row in rows} - {None}
    initials = [row[1][:1] for row in rows]
    report = {"gaps": missing_turns(min(turns, default=None), max(turns, default=None), len(turns))}
    report |= {name: found.count(k + 1) for k, name in enumerate(FAULTS)}
    report["illegal"] = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    report |= {"cost": minplus.cost(minplus.product(runs)), "audit": letters, "repaired_sha256": digest.hexdigest()}
    return report, lines


def _first_pass(schema: T.StructType, lines: bool, slice_rows: int):
    """Sorted rows of a task to reports on whole conversations, their lines if wanted, and rows held back."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, cuts = TaskContext.get().partitionId(), 0
        rows: list[_Row] = []
        out: list[dict] = []
        current, held, chars = (), True, 0  # no conversation is the empty tuple

        def hold() -> None:
            nonlocal cuts, chars
            at = (task << 32) + cuts
            out.extend({"kind": "held", "conv": current, "slice": at, "pos": k, "turn": r[0], "role": r[1], "text": r[2]} for k, r in enumerate(rows))
            if not rows and current != ():
                out.append({"kind": "held", "conv": current, "slice": at})  # nothing left, but it is to be reported
            rows.clear()
            cuts, chars = cuts + 1, 0

        def whole() -> None:
            report, left = examine(rows)
            out.append({"kind": "report", "conv": current} | report)
            if lines:
                out.extend({"kind": "line", "conv": current, "slice": 0, "pos": k, "edit": e, "role": r, "text": t} for k, (e, r, t) in enumerate(left))
            rows.clear()

        def ready(least: int) -> Iterator[pa.RecordBatch]:
            while len(out) > least:
                yield pa.RecordBatch.from_pylist(out[:OUT_ROWS], schema=arrow)
                del out[:OUT_ROWS]

        for batch in batches:
            for conv, turn, role, text, present in zip(*[batch.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "present")]):
                if conv != current or current == ():
                    if current != ():
                        hold() if held else whole()
                    held, current, chars = current == (), conv, 0
                if present:
                    rows.append((turn, role, text))
                    chars += len(text)
                    if len(rows) >= slice_rows or chars >= SLICE_CHARS:
                        held = True
                        hold()
                yield from ready(OUT_ROWS)
        if current != ():
            hold()
        yield from ready(0)
        rows = out = None
        give_back()

    return run


def _grouped(df: DataFrame, keys: list[str], schema: str, function) -> DataFrame:
    """``function`` turns the rows of a group, as dicts, into dicts; groups are slices or the slices of a conversation."""
    kinds = [f for f in df.schema.fields if f.name in keys]
    full = T.StructType(kinds + T.StructType.fromDDL(schema).fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(full)

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        key = {k: rows[0][k] for k in keys}
        return pa.Table.from_pylist([key | row for row in function(rows)], schema=arrow)

    return df.groupBy(*keys).applyInArrow(run, full)


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _slice_summary(rows: list[dict]) -> Iterator[dict]:
    """Runs, their product and what adds up along a conversation, of one slice."""
    rows = sorted((r for r in rows if r["pos"] is not None), key=lambda r: r["pos"])
    runs = minplus.runs_of(r["symbol"] for r in rows)
    turns = {r["turn"] for r in rows} - {None}
    initials = [r["initial"] for r in rows]
    yield {
        "runs": [{"symbol": s, "n": n} for s, n in runs], "product": [x for row in minplus.product(runs) for x in row],
        "counts": [sum(r["fault"] == k + 1 for r in rows) for k in range(3)],
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first": initials[0] if rows else None, "last": initials[-1] if rows else None,
        "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(turns),
    }


def _along(rows: list[dict]) -> Iterator[dict]:
    """For each slice of a conversation what is to be paid after it; with the first, the report on the whole."""
    rows = sorted(rows, key=lambda r: r["slice"])
    filled = [r for r in rows if r["first"] is not None]
    timed = [r for r in filled if r["turns"]]
    distinct = sum(r["turns"] for r in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
    illegal = sum(r["illegal"] for r in rows) + sum(a["last"] + b["first"] not in LEGAL for a, b in zip(filled, filled[1:]))
    after, out = minplus.END, []
    for r in reversed(rows):
        out.append({"slice": r["slice"], "after": list(after)})
        m = [r["product"][4 * i : 4 * i + 4] for i in range(4)]
        after = minplus.apply(m, after)
    report = {"gaps": missing_turns(timed[0]["low"], timed[-1]["high"], distinct) if timed else 0, "illegal": illegal, "cost": after[minplus.START]}
    out[-1] |= report | {name: sum(r["counts"][k] for r in rows) for k, name in enumerate(FAULTS)}
    yield from out


def _ways(rows: list[dict]) -> Iterator[dict]:
    """A slice's edits for every state it may be entered in."""
    (row,) = rows
    runs, after = [(r["symbol"], r["n"]) for r in row["runs"]], tuple(row["after"])
    ways = [minplus.unroll(runs, after, state) for state in minplus.STATES]
    yield {"letters": [w[0] for w in ways], "exits": [w[1] for w in ways]}


def _chain(rows: list[dict]) -> Iterator[dict]:
    """The state each slice is entered in."""
    state, rows = minplus.START, sorted(rows, key=lambda r: r["slice"])
    for i, row in enumerate(rows):
        entered, state = state, row["exits"][state]
        yield {"slice": row["slice"], "entered": entered, "ending": minplus.ending(state) if i == len(rows) - 1 else ""}


def _slice_lines(rows: list[dict]) -> Iterator[dict]:
    rows = sorted(rows, key=lambda r: (r["pos"] is not None, r["pos"]))
    head = rows[0]
    texts = iter([(r["role"], r["text"]) for r in rows if r["pos"] is not None])
    for k, (edit, role, text) in enumerate(edits(texts, head["letters"], head["entered"])):
        yield {"pos": k, "edit": edit, "role": role, "text": text}


def _digests(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = (), None
        for batch in batches:
            done = []
            for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")]):
                if conv != current or current == ():
                    if current != ():
                        done.append({"conv": current, "repaired_sha256": digest.hexdigest()})
                    current, digest = conv, Digest()
                digest.add(role, text)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
        if current != ():
            yield pa.RecordBatch.from_pylist([{"conv": current, "repaired_sha256": digest.hexdigest()}], schema=arrow)

    return run


class Repair:
    """The repaired conversations of a table: ``reports()`` and, if asked for, ``lines()``.

    ``present`` names a boolean column that is false for rows to be left out whose conversation is still to
    be reported on.  Other columns are not read.
    """

    def __init__(
        self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
        present: str | None = None, with_lines: bool = False, slice_rows: int = SLICE_ROWS,
    ):
        self.name = conv
        known = F.lit(True) if present is None else F.coalesce(F.col(present), F.lit(True))
        plain = rows.select(
            F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
            F.coalesce(F.col(text), F.lit(" ")).alias("text"), known.alias("present"),
        )
        order = ["conv", "turn", "role", "text"]
        dealt = plain.repartitionByRange("conv", "turn", "role", F.substring("text", 1, HEAD)).sortWithinPartitions(*order)
        self.kind = plain.schema["conv"].dataType
        schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("conv", self.kind)])
        for field in T.StructType.fromDDL(f"slice long, pos long, turn long, role string, text string, edit string, {REPORT}").fields:
            schema.add(field)
        self.passed = written(dealt.mapInArrow(_first_pass(schema, with_lines, slice_rows), schema), "conversations")
        self.with_lines = with_lines
        self._prepare()

    def _prepare(self) -> None:
        held = self.passed.where("kind = 'held'").select("conv", "slice", "pos", "turn", "role", "text")
        self.held = held
        marked = held.select(
            "conv", "slice", "pos", "turn", F.substring("role", 1, 1).alias("initial"), F.sha2(F.to_json(F.struct("role", "text")), 256).alias("same"),
            (F.length(F.rtrim(F.col("text"), F.lit(BLANKS))) == 0).alias("blank"),
            (~F.rtrim(F.col("text"), F.lit(BLANKS)).rlike("[.!?]\\z")).alias("open"),
        )
        first = marked.where("pos is not null").groupBy("conv", "same").agg(F.min(F.struct("slice", "pos")).alias("first"))
        seen = F.struct("slice", "pos") != F.col("first")
        kind = F.when(F.col("blank"), 1).when(seen, 2).when(F.col("open"), 3).otherwise(0)
        initial = F.coalesce(*[F.when(F.col("initial") == k, v) for k, v in minplus.INITIALS.items()], F.lit(3))
        fate = F.when(F.col("fault").isin(1, 2), minplus.MUST_GO).when(F.col("fault") == 3, minplus.TRUNCATED).otherwise(minplus.FINE)
        symbols = _same(marked, first, ["conv", "same"], "left").withColumn("fault", kind).select(
            "conv", "slice", "pos", "turn", "initial", "fault", (3 * initial + fate).alias("symbol")
        )
        summary = (
            "runs array<struct<symbol: int, n: long>>, product array<long>, counts array<long>, illegal long, first string, last string, "
            "low long, high long, turns long"
        )
        slices = written(_grouped(symbols, ["conv", "slice"], summary, _slice_summary), "slices")
        along = written(_grouped(
            slices.drop("runs"), ["conv"], "slice long, after array<long>, gaps long, blank long, duplicate long, truncated long, illegal long, cost long", _along
        ), "along")
        owed = _same(slices.select("conv", "slice", "runs"), along.select("conv", "slice", "after"), ["conv", "slice"])
        ways = written(_grouped(owed, ["conv", "slice"], "letters array<string>, exits array<int>", _ways), "ways")
        entered = _grouped(ways.drop("letters"), ["conv"], "slice long, entered int, ending string", _chain)
        chosen = _same(ways.drop("exits"), entered, ["conv", "slice"])
        self.chosen = chosen.select("conv", "slice", "entered", F.concat(F.expr("letters[entered]"), "ending").alias("letters"))
        self.totals = along.where("cost is not null").drop("slice", "after")

    def _held_lines(self) -> DataFrame:
        joined = _same(self.held.drop("turn"), self.chosen, ["conv", "slice"])
        return _grouped(joined, ["conv", "slice"], "pos long, edit string, role string, text string", _slice_lines)

    def reports(self) -> DataFrame:
        """Per conversation: gaps, faults, illegal neighbours, cost, the audit and the SHA-256 of the repaired lines."""
        columns = [f.name for f in T.StructType.fromDDL(REPORT).fields]
        whole = self.passed.where("kind = 'report'").select("conv", *columns)
        pieces = F.transform(F.sort_array(F.collect_list(F.struct("slice", "letters"))), lambda p: p["letters"])
        audits = self.chosen.groupBy("conv").agg(F.concat_ws("", pieces).alias("audit"))
        schema = T.StructType([T.StructField("conv", self.kind), T.StructField("repaired_sha256", T.StringType())])
        streamed = self._held_lines().repartition("conv").sortWithinPartitions("conv", "slice", "pos").mapInArrow(_digests(schema), schema)
        held = _same(_same(self.totals, audits, ["conv"]), streamed, ["conv"], "left").fillna({"repaired_sha256": _EMPTY["repaired_sha256"]})
        return whole.unionByName(held.select("conv", *columns)).withColumnRenamed("conv", self.name)

    def lines(self) -> DataFrame:
        """The repaired turns: ``part, pos`` order them within a conversation, ``edit`` is K, R or I."""
        columns = ["conv", F.col("slice").alias("part"), "pos", "edit", "role", "text"]
        whole = self.passed.where("kind = 'line'").select(*columns)
        return whole.unionByName(self._held_lines().select(*columns)).withColumnRenamed("conv", self.name)
