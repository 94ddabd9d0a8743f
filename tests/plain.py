"""The same rules in plain Python, row by row, to compare with."""

from __future__ import annotations

MASK = ~(15 << 52)
PENTAGONS = {4, 14, 24, 38, 49, 58, 63, 72, 83, 97, 107, 117}


def make(base: int, digits: list[int]) -> int:
    out = 1 << 59 | len(digits) << 52 | base << 45
    for i in range(15):
        out |= (digits[i] if i < len(digits) else 7) << 3 * (14 - i)
    return out


def res(c: int) -> int:
    return c >> 52 & 15


def base(c: int) -> int:
    return c >> 45 & 127


def digits(c: int) -> list[int]:
    return [c >> 3 * (14 - i) & 7 for i in range(res(c))]


def parent(c: int, r: int) -> int:
    return make(base(c), digits(c)[:r])


def children(c: int) -> list[int]:
    below = digits(c)
    pentagon = base(c) in PENTAGONS and not any(below)
    return [make(base(c), [*below, d]) for d in range(7) if not (pentagon and d == 1)]


def descendants(c: int, r: int) -> list[int]:
    level = [c] if res(c) <= r else []
    while level and res(level[0]) < r:
        level = [k for x in level for k in children(x)]
    return level


def adaptive_pairs(src: set[int], tar: set[int], lo: int, hi: int) -> set[tuple[int, int]]:
    """Nearest ancestor-or-self, else topmost descendants, one cell at a time."""
    out = set()
    for s in src:
        up = next((parent(s, r) for r in range(res(s), lo - 1, -1) if parent(s, r) in tar), None)
        if up is not None:
            out.add((s, up))
            continue
        level = [s]
        for _ in range(res(s) + 1, hi + 1):
            below = [k for x in level for k in children(x)]
            out |= {(s, k) for k in below if k in tar}
            level = [k for k in below if k not in tar]
    return out
