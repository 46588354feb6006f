"""Preferred foot (P3): usage per player (U1, A2), classification (X5),
attach to shots (J1) and the used-preferred-foot flag (X6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.encode import preferred_foot, used_preferred_foot
from pitchlake.schemas import FEET, FOOT_SHARE


def foot_usage(events: DataFrame) -> DataFrame:
    """Left/right foot counts per player over passes and shots.

    One pass over the rows (no union): the body part is the pass's on passes
    and the shot's on shots.  Partial aggregation runs before the shuffle, so
    a player holding a third of all rows costs one pre-aggregated row per
    map task."""
    part = (F.when(F.col("type") == "Pass", F.col("pass_body_part"))
             .when(F.col("type") == "Shot", F.col("shot_body_part")))
    return (events.select("player_id", part.alias("body_part"))
            .filter(F.col("body_part").isin(*FEET))
            .groupBy("player_id")
            .agg(F.count_if(F.col("body_part") == "Left Foot").cast("bigint").alias("left_foot"),
                 F.count_if(F.col("body_part") == "Right Foot").cast("bigint").alias("right_foot")))


def preferred_foot_table(events: DataFrame, share: float = FOOT_SHARE) -> DataFrame:
    """``player_id, preferred_foot`` for every player with a foot action."""
    return (foot_usage(events)
            .select("player_id", preferred_foot("left_foot", "right_foot", share).alias("preferred_foot")))


def attach_preferred_foot(shots: DataFrame, feet: DataFrame, keep_foot: bool = False) -> DataFrame:
    """Left join of the foot table on ``player_id`` plus ``preferred_foot_shot``.

    No broadcast hint: the foot table is an aggregate whose size is only known
    at run time, so adaptive execution measures it and broadcasts it when it
    is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above that the
    join stays a shuffle join (with skew splitting of a hot player)."""
    out = shots.join(feet, "player_id", "left").withColumn(
        "preferred_foot_shot", used_preferred_foot("preferred_foot", "shot_body_part"))
    return out if keep_foot else out.drop("preferred_foot")
