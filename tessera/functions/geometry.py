"""Distances, and the nearest of many centroids for many points.

:func:`nearest` is the kernel of every 2-D assignment.  It works on arrays
inside a task and leaves distances out with bounds on boxes of neighbouring
points: a centroid that is farther than another one from every corner that
could favour it is farther from every point of the box.  Points in Morton
order make small boxes, most of which one centroid wins outright.  All
arithmetic is on integers, so ties are exact; they go to the first centroid.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: points of a box
BOX_POINTS = 64
#: box and centroid pairs tested at a time (some ten arrays of this length)
KERNEL_PAIRS = 1 << 18
#: coordinates stay below this, so that squared distances fit 64 bits
MAX_COORDINATE = 1 << 30


def sq_dist2d(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Exact squared distance of integer points, as bigint."""
    dx = x1.cast("bigint") - x2.cast("bigint")
    dy = y1.cast("bigint") - y2.cast("bigint")
    return dx * dx + dy * dy


def dist2d(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    dx = x1.cast("double") - x2.cast("double")
    dy = y1.cast("double") - y2.cast("double")
    return F.sqrt(dx * dx + dy * dy)


def dist_nd(a: Column, b: Column) -> Column:
    """Euclidean distance of two ``array<double>``, summed in index order."""
    sq = F.zip_with(a, b, lambda u, v: (u - v) * (u - v))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, t: acc + t))


def morton(x: Column, y: Column) -> Column:
    """The bits of two integers in turn: near points mostly have near codes."""
    def spread(c: Column) -> Column:
        c = (c.cast("bigint") + MAX_COORDINATE).bitwiseAND(0x7FFFFFFF)
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(mask)
        return c

    return F.shiftleft(spread(x), 1).bitwiseOR(spread(y))


def morton_codes(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """:func:`morton` of arrays."""
    def spread(c):
        c = (c + MAX_COORDINATE) & 0x7FFFFFFF
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            c = (c | c << shift) & mask
        return c

    return spread(x) << 1 | spread(y)


class Boxes:
    """Consecutive points in boxes of at most ``BOX_POINTS``."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        for c in (x, y):
            if len(c) and max(-int(c.min()), int(c.max())) >= MAX_COORDINATE:
                raise OverflowError(f"a coordinate beyond {MAX_COORDINATE}")
        self.x, self.y = x, y
        self.start = np.arange(0, len(x), BOX_POINTS)
        self.size = np.diff(np.append(self.start, len(x)))
        if len(x):
            self.x0, self.x1 = np.minimum.reduceat(x, self.start), np.maximum.reduceat(x, self.start)
            self.y0, self.y1 = np.minimum.reduceat(y, self.start), np.maximum.reduceat(y, self.start)


def candidates(boxes: Boxes, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(box, centroid) pairs, in order, of the centroids that may be the
    nearest one to a point of the box.

    The centroid nearest to a box's middle rules out every other one that is
    farther away even from the corner that lies farthest in its direction:
    the difference of the squared distances is linear over the box and least
    at that corner.
    """
    out, step = [], max(1, KERNEL_PAIRS // len(cx))
    for lo in range(0, len(boxes.start), step):
        part = slice(lo, lo + step)
        x0, x1, y0, y1 = (c[part, None] for c in (boxes.x0, boxes.x1, boxes.y0, boxes.y1))
        best = ((2 * cx - (x0 + x1)) ** 2 + (2 * cy - (y0 + y1)) ** 2).argmin(axis=1)
        bx, by = cx[best, None], cy[best, None]
        vx, vy = np.where(cx > bx, x1, x0), np.where(cy > by, y1, y0)
        keep = (cx - vx) ** 2 + (cy - vy) ** 2 <= (bx - vx) ** 2 + (by - vy) ** 2
        box, c = np.nonzero(keep)
        out.append((box + lo, c))
    return tuple(np.concatenate(p) for p in zip(*out))


def nearest_in(boxes: Boxes, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(the only candidate of each box or -1, the nearest centroid of each
    point, distances computed).

    The count has three distances for each box and centroid, the middle's and
    both at the corner, and one for each point and candidate where a box has
    several.
    """
    n = len(boxes.x)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    box, c = candidates(boxes, cx, cy)
    first = np.searchsorted(box, np.arange(len(boxes.start) + 1))
    many = np.diff(first)
    only = np.where(many == 1, c[first[:-1]], -1)
    pos = np.repeat(only, boxes.size)
    open_ = np.flatnonzero(only < 0)
    computed = 3 * len(boxes.start) * len(cx) + int((many[open_] * boxes.size[open_]).sum())
    if len(open_):
        points = np.flatnonzero(pos < 0)
        of = np.repeat(open_, boxes.size[open_])          # the box of each open point
        x, y = boxes.x[points], boxes.y[points]
        least = np.full(len(points), np.iinfo(np.int64).max)
        found = np.empty(len(points), np.int64)
        for j in range(int(many[open_].max())):
            at = np.flatnonzero(many[of] > j)
            cand = c[first[of[at]] + j]
            d = (x[at] - cx[cand]) ** 2 + (y[at] - cy[cand]) ** 2
            closer = d < least[at]
            least[at[closer]] = d[closer]
            found[at[closer]] = cand[closer]
        pos[points] = found
    return only, pos, computed


def nearest(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray) -> np.ndarray:
    """The nearest centroid of each point, in any order of points."""
    order = np.argsort(morton_codes(x, y), kind="stable")
    out = np.empty(len(x), np.int64)
    out[order] = nearest_in(Boxes(x[order], y[order]), cx, cy)[1]
    return out
