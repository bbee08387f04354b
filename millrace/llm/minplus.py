"""Matrices over (cost, audit) elements: edits of a conversation's turns as a product of 4x4 matrices.

States are what the repaired roles so far end in: 0 nothing, 1 a leading system turn, 2 a user turn, 3 an assistant turn.  Entry
(i, j) is the cheapest way from i to j, and of ways that cost the same the one whose letters are least in ASCII; None is no way.
A product adds costs and joins letters.  It is associative: among ways of equal cost none is the beginning of another
(it would have to go on by inserts alone, which cost), so appending letters keeps their order.
"""

from __future__ import annotations

from functools import lru_cache

Cell = tuple[int, str] | None
Matrix = tuple[Cell, ...]

STATES = 4
#: Next state by state and role initial, for `(s?(ua)+)?`.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPT = (0, 3)
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: Turns whose product is remembered.
WORD = 8


def times(a: Matrix, b: Matrix) -> Matrix:
    out = []
    for i in range(0, 16, 4):
        ways = [(k, x) for k, x in enumerate(a[i : i + 4]) if x is not None]
        for j in range(4):
            best = None
            for k, (cost, audit) in ways:
                if (y := b[4 * k + j]) is not None and (best is None or cost + y[0] <= best[0]):
                    way = (cost + y[0], audit + y[1])
                    if best is None or way < best:
                        best = way
            out.append(best)
    return tuple(out)


def _matrix(ways: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return tuple(ways.get((i, j)) for i in range(STATES) for j in range(STATES))


def _closure() -> Matrix:
    """Any number of inserted user and assistant turns."""
    one = {(i, i): (0, "") for i in range(STATES)}
    one |= {(i, j): (INSERT, "I") for (i, role), j in STEP.items() if role in "ua"}
    m = _matrix(one)
    for _ in range(3):
        m = times(m, m)
    return m


INSERTS = _closure()


@lru_cache(maxsize=64)
def turn(kind: str) -> Matrix:
    """Of one turn, with inserts on both sides.  kind: `d` must go; else the role's initial, or x for a role that can't stay; upper case: cut off."""
    ways = {(i, i): (DELETE, "D") for i in range(STATES)}
    if kind != "d":
        cut = CUT * kind.isupper()
        for (i, role), j in STEP.items():
            edits = [(cut, "K")] * (role == kind.lower()) + [(REROLE + cut, "R")] * (role in "ua")
            if edits:
                ways[i, j] = min(edits)
    return times(times(INSERTS, _matrix(ways)), INSERTS)


def reduce(matrices: list[Matrix]) -> Matrix:
    """The product in order, as a balanced tree."""
    if not matrices:
        return INSERTS
    while len(matrices) > 1:
        pairs = [times(a, b) for a, b in zip(matrices[::2], matrices[1::2], strict=False)]
        matrices = pairs + matrices[len(pairs) * 2 :]
    return matrices[0]


@lru_cache(maxsize=1 << 14)
def _word(kinds: str) -> Matrix:
    return reduce([turn(k) for k in kinds])


def product(kinds: str) -> Matrix:
    return reduce([_word(kinds[i : i + WORD]) for i in range(0, len(kinds), WORD)])


def cheapest(m: Matrix) -> tuple[int, str]:
    return min(m[j] for j in ACCEPT if m[j] is not None)


def role_at(place: int, odd: bool) -> str:
    """Role of an edited or inserted turn: repaired conversations of odd length begin with a system turn."""
    return "assistant" if (place - odd) % 2 else "user"
