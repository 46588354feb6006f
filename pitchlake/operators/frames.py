"""Freeze frames: typed parse (X7), exploded player table (P4, J9) and the
players-in-shot-triangle count (P5, X10, X11).  The frame is an array on the
shot row, so no join back to the shots is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.frames import parse_frame
from pitchlake.functions.geometry import players_in_triangle, shot_triangle_area
from pitchlake.schemas import GOAL_X, GOAL_Y1, GOAL_Y2


def with_frame(df: DataFrame, text_col: str = "shot_freeze_frame", out: str = "frame") -> DataFrame:
    return df.withColumn(out, parse_frame(text_col))


def frame_players(shots: DataFrame, id_col: str = "id", frame_col: str = "frame",
                  exclude_penalties: bool = True) -> DataFrame:
    """One row per frame player: ``id, x, y, position, teammate, player_id,
    player_name`` (P4).  Non-penalty shots with a frame only, as the frame
    table of the feature pipeline."""
    df = shots
    if exclude_penalties:
        df = df.filter(F.col("shot_type") != "Penalty")
    if frame_col not in df.columns:
        df = with_frame(df, out=frame_col)
    # inline_outer + a filter on the generated columns: with plain inline the
    # optimizer infers ``size(frame) > 0`` below the generator and pushes it
    # through the projection, which would parse every frame twice.
    gen = df.select(F.col(id_col), F.inline_outer(frame_col))
    gen = gen.filter(F.col("location").isNotNull() | F.col("player").isNotNull()
                     | F.col("position").isNotNull() | F.col("teammate").isNotNull())
    return (gen
              .select(F.col(id_col),
                      F.get(F.col("location"), 0).alias("x"),
                      F.get(F.col("location"), 1).alias("y"),
                      F.col("position.name").alias("position"),
                      F.col("teammate"),
                      F.col("player.id").alias("player_id"),
                      F.col("player.name").alias("player_name")))


def players_inside_area(shots: DataFrame, missing_frame: str = "null",
                        goal_x: float = GOAL_X, goal_y1: float = GOAL_Y1, goal_y2: float = GOAL_Y2,
                        keep_frame: bool = False) -> DataFrame:
    """``players_inside_area``: players of both teams inside the triangle from
    the shot to the posts; a penalty counts 1; a shot without a frame gets
    null (``missing_frame='null'``, as published), 0 (``'zero'``) or is
    removed (``'drop'``)."""
    if missing_frame not in ("null", "zero", "drop"):
        raise ValueError("missing_frame must be 'null', 'zero' or 'drop'")
    if "frame" in shots.columns:
        parsed = {}
    else:
        # only the location is needed for the count, unless the frame is kept
        parsed = {"frame": parse_frame("shot_freeze_frame", None if keep_frame else ("location",))}
    parsed["_whole"] = shot_triangle_area("shot_location_x", "shot_location_y", goal_x, goal_y1, goal_y2)
    df = shots.withColumns(parsed)
    count = players_in_triangle("frame", "shot_location_x", "shot_location_y", goal_x, goal_y1, goal_y2,
                                whole="_whole")
    value = F.when(F.col("shot_type") == "Penalty", F.lit(1)).otherwise(count)
    if missing_frame == "zero":
        value = F.coalesce(value, F.lit(0))
    drop = {"_whole"} | (set() if keep_frame else {"frame"})
    df = df.select(*[c for c in df.columns if c not in drop and c != "players_inside_area"],
                   value.alias("players_inside_area"))
    if missing_frame == "drop":
        df = df.filter(F.col("players_inside_area").isNotNull())
    return df
