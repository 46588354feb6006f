"""Pitch geometry as Column expressions.

All built-in Spark functions: they stay inside whole-stage codegen and are
null-safe (a null or malformed point gives null, never an error, also with
ANSI mode on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.schemas import GOAL_X, GOAL_Y1, GOAL_Y2

ColumnLike = Column | str


def _c(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_point(text: ColumnLike) -> Column:
    """``"[x, y]"`` / ``"[x, y, z]"`` text -> ``array<double>``; null for null,
    malformed or non-numeric input (X1, X2)."""
    return F.from_json(_c(text), "array<double>")


def point_x(text: ColumnLike) -> Column:
    return F.get(parse_point(text), 0)


def point_y(text: ColumnLike) -> Column:
    """Second coordinate; null when the point has fewer than two."""
    return F.get(parse_point(text), 1)


def distance_to_goal(x: ColumnLike, y: ColumnLike, goal_x: float = GOAL_X,
                     goal_y1: float = GOAL_Y1, goal_y2: float = GOAL_Y2,
                     scale: int | None = 2) -> Column:
    """Euclidean distance from (x, y) to the centre of the goal."""
    mid = (goal_y1 + goal_y2) / 2.0
    d = F.sqrt(F.pow(_c(x) - F.lit(goal_x), 2) + F.pow(_c(y) - F.lit(mid), 2))
    return F.round(d, scale) if scale is not None else d


def shot_angle(x: ColumnLike, y: ColumnLike, goal_x: float = GOAL_X,
               goal_y1: float = GOAL_Y1, goal_y2: float = GOAL_Y2,
               scale: int | None = 6) -> Column:
    """Angle in degrees between the lines from (x, y) to the two posts.

    With u, v the vectors to the posts, the angle is atan2(|u x v|, u . v):
    it equals acos(u.v / |u||v|) without a domain guard, is 0 at a post and
    180 on the goal line between the posts.  ``scale`` rounds the result
    (the published feature is single precision); ``None`` keeps full double.
    """
    dx = F.lit(goal_x) - _c(x)
    d1 = F.lit(goal_y1) - _c(y)
    d2 = F.lit(goal_y2) - _c(y)
    cross = F.abs(dx * F.lit(goal_y2 - goal_y1))
    dot = dx * dx + d1 * d2
    a = F.degrees(F.atan2(cross, dot))
    return F.round(a, scale) if scale is not None else a


def triangle_area(x1, y1, x2, y2, x3, y3) -> Column:
    """Shoelace area of a triangle (X8); arguments are Columns or numbers."""
    def v(a):
        return a if isinstance(a, Column) else F.lit(a)
    x1, y1, x2, y2, x3, y3 = map(v, (x1, y1, x2, y2, x3, y3))
    return F.abs(x1 * (y2 - y3) + x2 * (y3 - y1) + x3 * (y1 - y2)) / 2.0


def shot_triangle_area(sx: ColumnLike, sy: ColumnLike, goal_x: float = GOAL_X,
                       goal_y1: float = GOAL_Y1, goal_y2: float = GOAL_Y2) -> Column:
    """Area of the triangle shot-post-post."""
    return triangle_area(_c(sx), _c(sy), goal_x, goal_y1, goal_x, goal_y2)


def players_in_triangle(frame: ColumnLike, sx: ColumnLike, sy: ColumnLike,
                        goal_x: float = GOAL_X, goal_y1: float = GOAL_Y1,
                        goal_y2: float = GOAL_Y2, whole: ColumnLike | None = None) -> Column:
    """Number of frame players inside the shot triangle (X10); both teams and
    the keeper count.  Null frame -> null, empty frame -> 0.

    A player is inside, or on an edge (X9), when the three sub-triangle areas
    add up to the whole one within ``1e-8 + 1e-10 * sum``.  The player point is
    read once, the sub-areas are summed in one ``transform`` and compared in a
    second pass.  Pass ``whole`` as a column (the shot's triangle area)
    to keep it out of the per-player loop."""
    frame, sx, sy = _c(frame), _c(sx), _c(sy)
    whole = shot_triangle_area(sx, sy, goal_x, goal_y1, goal_y2) if whole is None else _c(whole)
    pts = F.transform(frame, lambda p: p["location"])

    def parts(v):
        px, py = F.get(v, 0), F.get(v, 1)
        return (triangle_area(sx, sy, goal_x, goal_y1, px, py)
                + triangle_area(sx, sy, goal_x, goal_y2, px, py)
                + triangle_area(px, py, goal_x, goal_y2, goal_x, goal_y1))

    sums = F.transform(pts, parts)
    inside = F.filter(sums, lambda t: F.coalesce(
        F.abs(whole - t) <= F.lit(1e-8) + F.lit(1e-10) * F.abs(t), F.lit(False)))
    return F.when(frame.isNotNull(), F.size(inside))


def decimal_clock(minute: ColumnLike = "minute", second: ColumnLike = "second") -> Column:
    """``minute + round(second / 60, 2)``."""
    return _c(minute) + F.round(_c(second) / 60.0, 2)


def match_clock(period: ColumnLike = "period", minute: ColumnLike = "minute",
                offset: int = 100) -> Column:
    """Minute with the second half shifted by ``offset`` so halves never
    interleave (X21)."""
    return F.when(_c(period) == 2, _c(minute) + offset).otherwise(_c(minute))
