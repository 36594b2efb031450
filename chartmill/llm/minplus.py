"""Cheapest repair of a sequence of roles, by min-plus algebra over runs of equal rows.

Roles must read ``(s?(ua)+)?``: nothing, or perhaps a system turn and then pairs of user and assistant.  The
states are START, after the system turn, after a user, after an assistant; the first and the last may end.
A row is one of twelve symbols, its role's initial (s, u, a, other) times its fault (none, must go,
truncated).  Consuming a row, with any insertions before it, is a 4 x 4 matrix of costs between states; a
run of n equal rows is its n-th power, put together from cached powers of two.  Going backwards over runs
gives what is still to be paid from each state; going forwards, each step takes the least letter among
those that keep the cost, which gives the ASCII-least of the cheapest audits.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import cache, lru_cache
from itertools import groupby

NEVER = 1 << 40
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
INITIALS = {"s": 0, "u": 1, "a": 2}
FINE, MUST_GO, TRUNCATED = range(3)
SYMBOLS = 12
REROLE, DELETE, INSERT = 2, 3, 2
# Where an inserted or reroled turn leads: only one role fits after each state.
FORCED = (USER, USER, ASSISTANT, USER)
ROLE = (None, None, "user", "assistant")
# Where keeping a turn of each initial leads.
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
# What ending costs, with the insertions that takes.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]
Runs = list[tuple[int, int]]


def symbol(role: str, fault: int) -> int:
    return 3 * INITIALS.get(role[:1], 3) + fault


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(NEVER, *[a[i][k] + b[k][j] for k in STATES]) for j in STATES) for i in STATES)


def apply(a: Matrix, v: Sequence[int]) -> Vector:
    return tuple(min([a[i][k] + v[k] for k in STATES]) for i in STATES)


def choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """What may be done with a row, in the order of the letters: letter, cost, next state."""
    initial, fault = divmod(symbol, 3)
    out, more = [("D", DELETE, state)], int(fault == TRUNCATED)
    if fault != MUST_GO:
        if state in KEPT[initial]:
            out.append(("K", more, KEPT[initial][state]))
        out.append(("R", REROLE + more, FORCED[state]))
    return out


@cache
def matrix(symbol: int) -> Matrix:
    """Costs of consuming one row with any insertions before it."""
    insertions = [[NEVER] * 4 for _ in STATES]
    rows = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        at, cost = state, 0
        while insertions[state][at] > cost:
            insertions[state][at] = cost
            at, cost = FORCED[at], cost + INSERT
        for _, cost, after in choices(symbol, state):
            rows[state][after] = min(rows[state][after], cost)
    return times(tuple(map(tuple, insertions)), tuple(map(tuple, rows)))


@cache
def power(symbol: int, k: int) -> Matrix:
    """The matrix of 2**k equal rows."""
    if not k:
        return matrix(symbol)
    half = power(symbol, k - 1)
    return times(half, half)


def bits(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


IDENTITY: Matrix = tuple(tuple(0 if i == j else NEVER for j in STATES) for i in STATES)


def product(runs: Iterable[tuple[int, int]]) -> Matrix:
    """The matrix of a whole piece of a conversation; pieces multiply like their rows."""
    out = IDENTITY
    for symbol, n in runs:
        for k in bits(n):
            out = times(out, power(symbol, k))
    return out


@lru_cache(1 << 14)
def _before(symbol: int, n: int, after: Vector) -> Vector:
    for k in bits(n):
        after = apply(power(symbol, k), after)
    return after


def before(symbol: int, n: int, after: Vector) -> Vector:
    """What is still to be paid before a run, given what is to be paid after it."""
    low = min(after)
    return tuple(x + low for x in _before(symbol, n, tuple(x - low for x in after)))


@lru_cache(1 << 12)
def _unroll(symbol: int, n: int, after: Vector, state: int) -> tuple[str, int]:
    ahead = [after]
    for _ in range(n):
        ahead.append(apply(matrix(symbol), ahead[-1]))
    letters = []
    for left in range(n, 0, -1):
        here, there = ahead[left], ahead[left - 1]
        while True:
            options = {letter: (cost, to) for letter, cost, to in choices(symbol, state)}
            # An insertion stays at this row, so what is to be paid there is that of the row itself.
            paid = {letter: cost + there[to] for letter, (cost, to) in options.items()} | {"I": INSERT + here[FORCED[state]]}
            letter = min(x for x, cost in paid.items() if cost == here[state])
            letters.append(letter)
            state = FORCED[state] if letter == "I" else options[letter][1]
            if letter != "I":
                break
    return "".join(letters), state


def unroll(runs: Runs, after: Vector, state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest audits of a piece entered in ``state``, and the state it ends in."""
    vectors = [after]
    for run in reversed(runs):
        vectors.append(before(*run, vectors[-1]))
    letters = []
    for run, later in zip(runs, reversed(vectors[:-1])):
        low = min(later)
        part, state = _unroll(*run, tuple(x - low for x in later), state)
        letters.append(part)
    return "".join(letters), state


def ending(state: int) -> str:
    """The insertions after the last row."""
    return "I" * (END[state] // INSERT)


def runs_of(symbols: Iterable[int]) -> Runs:
    return [(s, sum(1 for _ in same)) for s, same in groupby(symbols)]


def cost(matrix: Matrix) -> int:
    return apply(matrix, END)[START]
