"""Space-filling-curve keys of lines and points, and the key ranges that a box needs.

The world is a square of 360 degrees. A level ``l`` cuts it into cells of
360 / 2^l degrees; a shape belongs to the finest level (FINEST at most) whose cells are at least as wide
and high as its bounding box, and there to the cell of its lower left corner, so it
reaches at most into the next cell on either side. The key is the level above the cell's bits,
x and y interleaved (Z order). Shapes that are close get close keys, long lines
are on levels of their own and widen no one else's range, and a box is a few key
ranges per level.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FINEST = 20                 # cells of some 38 m
_WORLD = 360.0
_SHIFT = 2 * (FINEST + 1)
RANGES = 24                 # blocks of cells per level that a box is cut into, before neighbours are joined


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, so that expressions that need it often do not grow."""
    return F.transform(F.array(value), use)[0]


def _level(extent: Column) -> Column:
    """The finest level whose cells are as wide as ``extent``: the sizes are exact in binary, so is each comparison."""
    fits = [F.when(extent <= F.lit(_WORLD / 2 ** l), F.lit(1)).otherwise(F.lit(0)) for l in range(1, FINEST + 1)]
    return sum(fits[1:], fits[0]).cast("long")


def _spread(c: Column) -> Column:
    """The bits of a number below 2^21, each followed by a zero bit."""
    for shift, mask in ((16, 0x0000001F0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        c = _let(c, _folded(shift, mask))
    return c


def _folded(shift: int, mask: int) -> Callable[[Column], Column]:
    return lambda v: v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))


def _cell(c: Column, level: Column) -> Column:
    cells = F.call_function("shiftleft", F.lit(1).cast("long"), level.cast("int"))
    at = F.floor((c + F.lit(180.0)) / (F.lit(_WORLD) / cells.cast("double"))).cast("long")
    return F.greatest(F.lit(0).cast("long"), F.least(cells - F.lit(1), at))


def curve_key(min_x: Column, min_y: Column, max_x: Column, max_y: Column) -> Column:
    """The key of a shape's bounding box; NULL without one."""
    def key_at(level: Column) -> Column:
        z = _spread(_cell(min_x, level)).bitwiseOR(F.shiftleft(_spread(_cell(min_y, level)), 1))
        return F.shiftleft(level, _SHIFT).bitwiseOR(z)

    key = _let(_let(F.greatest(max_x - min_x, max_y - min_y), _level), key_at)
    return F.when(min_x.isNotNull() & min_y.isNotNull() & max_x.isNotNull() & max_y.isNotNull(), key)


def point_key(x: Column, y: Column) -> Column:
    return curve_key(x, y, x, y)


def _interleave(x: int, y: int) -> int:
    return sum((x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1 for i in range(FINEST + 1))


def _cell_of(v: float, level: int) -> int:
    return max(0, min(2 ** level - 1, int((v + 180.0) // (_WORLD / 2 ** level))))


def key_ranges(box, levels=range(FINEST + 1), ranges: int = RANGES) -> list[tuple[int, int]]:
    """Closed key ranges that hold every shape whose bounding box touches the closed box, in order."""
    x1, y1, x2, y2 = (float(v) for v in box)
    out: list[tuple[int, int]] = []
    for level in levels:
        size = _WORLD / 2 ** level
        reach = size * (1 + 1e-9) if level < FINEST or len(levels) > 1 else 0.0     # points reach nowhere
        low = _cell_of(x1 - reach, level), _cell_of(y1 - reach, level)
        high = _cell_of(x2, level), _cell_of(y2, level)
        k = 0       # blocks of 2^k x 2^k cells, as small as leaves few enough of them
        while ((high[0] >> k) - (low[0] >> k) + 1) * ((high[1] >> k) - (low[1] >> k) + 1) > ranges:
            k += 1
        blocks = sorted(_interleave(x, y) for x in range(low[0] >> k, (high[0] >> k) + 1)
                        for y in range(low[1] >> k, (high[1] >> k) + 1))
        for z in blocks:
            a, b = level << _SHIFT | z << 2 * k, level << _SHIFT | ((z + 1) << 2 * k) - 1
            if out and out[-1][1] + 1 == a:
                out[-1] = out[-1][0], b
            else:
                out.append((a, b))
    return out


def in_ranges(key: Column, ranges: list[tuple[int, int]]) -> Column:
    """Whether the key lies in one of the ranges: a predicate that Parquet tests on row groups and pages."""
    tests = [key.between(F.lit(a), F.lit(b)) if a < b else key == F.lit(a) for a, b in ranges]
    while len(tests) > 1:       # a balanced tree: many ranges make no deep expression
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return tests[0]
