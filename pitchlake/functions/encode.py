"""Encoding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake.schemas import (FEET, FOOT_SHARE, PASS_HEIGHT_CODES, PASS_HEIGHT_OTHER,
                               TWO_FOOTED, VENDOR_THRESHOLD)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def flag(c) -> Column:
    """Nullable boolean -> int 0/1, null -> 0."""
    return F.coalesce(_c(c).cast("int"), F.lit(0))


def one_hot(source, value: str) -> Column:
    """1 when ``source == value`` else 0; null -> 0."""
    return F.when(_c(source) == F.lit(value), 1).otherwise(0)


def pass_height_code(c="pass_height") -> Column:
    """Ground 0, Low 1, anything else (null too) 2."""
    expr = None
    for label, code in PASS_HEIGHT_CODES.items():
        expr = (F.when(_c(c) == label, code) if expr is None else expr.when(_c(c) == label, code))
    return expr.otherwise(PASS_HEIGHT_OTHER)


def vendor_label(xg="shot_statsbomb_xg", threshold: float = VENDOR_THRESHOLD) -> Column:
    """Vendor probability >= threshold -> 1 else 0."""
    return F.when(_c(xg) >= F.lit(threshold), 1).otherwise(0)


def preferred_foot(left, right, share: float = FOOT_SHARE) -> Column:
    """Left share >= share -> Left Foot, else right share -> Right Foot, else
    Two-Footed (X5)."""
    total = _c(left) + _c(right)
    return (F.when(_c(left) / total >= F.lit(share), F.lit("Left Foot"))
             .when(_c(right) / total >= F.lit(share), F.lit("Right Foot"))
             .otherwise(F.lit(TWO_FOOTED)))


def used_preferred_foot(foot="preferred_foot", body_part="shot_body_part") -> Column:
    """Shot taken with the preferred foot (X6): a two-footed player using a
    foot counts; otherwise foot == body part (null stays null)."""
    return (F.when((_c(foot) == TWO_FOOTED) & _c(body_part).isin(*FEET), F.lit(True))
             .otherwise(_c(foot) == _c(body_part)))
