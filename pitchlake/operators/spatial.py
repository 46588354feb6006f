"""Spatial stage (P2): shot point, end point, distance and angle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.geometry import distance_to_goal, parse_point, shot_angle
from pitchlake.schemas import GOAL_X, GOAL_Y1, GOAL_Y2


def point_columns() -> dict[str, Column]:
    """Shot start and end coordinates parsed from their text."""
    start = parse_point("location")
    end = parse_point("shot_end_location")
    return {"shot_location_x": F.get(start, 0), "shot_location_y": F.get(start, 1),
            "shot_end_x": F.get(end, 0), "shot_end_y": F.get(end, 1)}


def geometry_columns(goal_x: float = GOAL_X, goal_y1: float = GOAL_Y1,
                     goal_y2: float = GOAL_Y2) -> dict[str, Column]:
    """Distance and angle from the parsed shot point."""
    return {"distance_to_goal": distance_to_goal("shot_location_x", "shot_location_y", goal_x, goal_y1, goal_y2),
            "shot_angle": shot_angle("shot_location_x", "shot_location_y", goal_x, goal_y1, goal_y2)}


def spatial(df: DataFrame, goal_x: float = GOAL_X, goal_y1: float = GOAL_Y1,
            goal_y2: float = GOAL_Y2, keep_location: bool = False) -> DataFrame:
    """Adds ``shot_location_x/y``, ``shot_end_x/y``, ``distance_to_goal`` and
    ``shot_angle``; drops ``location`` unless asked."""
    df = df.withColumns(point_columns()).withColumns(geometry_columns(goal_x, goal_y1, goal_y2))
    return df if keep_location else df.drop("location")
