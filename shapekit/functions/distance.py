"""Edit distance of long strings: time grows with the differences, or with length x length / word size."""

from __future__ import annotations

#: edits up to which the search by diagonals is tried
NEAR = 64


def _shared(a: str, i: int, b: str, j: int) -> int:
    """Length of the common run of ``a`` from ``i`` and ``b`` from ``j``."""
    n, step = 0, 16
    most = min(len(a) - i, len(b) - j)
    while n < most:  # grow while equal, then shrink to the first difference
        take = min(step, most - n)
        if a[i + n:i + n + take] == b[j + n:j + n + take]:
            n += take
            step *= 4
        elif take == 1:
            break
        else:
            step = max(1, take // 4)
            most = n + take
    return n


def _near(a: str, b: str, limit: int) -> int | None:
    """Distance by the furthest place reached on each diagonal with 0, 1, 2, ... edits; None beyond ``limit``."""
    goal = len(b) - len(a)
    if abs(goal) > limit:
        return None
    reach = {0: _shared(a, 0, b, 0)}
    for edits in range(limit + 1):
        if reach.get(goal, -1) >= len(a):
            return edits
        new = {}
        for d in range(-edits - 1, edits + 2):  # diagonal: place in b less place in a
            at = max(reach.get(d, -2) + 1, reach.get(d - 1, -2), reach.get(d + 1, -2) + 1)
            at = min(at, len(a), len(b) - d)
            if at >= 0 and at + d >= 0:
                new[d] = at + _shared(a, at, b, at + d)
        reach = new
    return None


def _far(a: str, b: str) -> int:
    """Distance by bit vectors: one column of the table, of the shorter string, per character of the longer one."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for c in set(a):
        bits = bytearray((len(a) >> 3) + 1)
        k = a.find(c)
        while k >= 0:
            bits[k >> 3] |= 1 << (k & 7)
            k = a.find(c, k + 1)
        places[c] = int.from_bytes(bits, "little")
    full, last = (1 << len(a)) - 1, len(a) - 1
    up, down, score = full, 0, len(a)
    for c in b:
        match = places.get(c, 0)
        zero = (((match & up) + up) ^ up) | match | down
        rise, fall = down | (full & ~(zero | up)), up & zero
        score += (rise >> last & 1) - (fall >> last & 1)
        rise, fall = (rise << 1 | 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(zero | rise)), rise & zero
    return score


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements of characters that turn ``a`` into ``b``."""
    if a == b:
        return 0
    head = _shared(a, 0, b, 0)
    a, b = a[head:], b[head:]
    tail = _shared(a[::-1], 0, b[::-1], 0)
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    near = _near(a, b, NEAR)
    return _far(a, b) if near is None else near
