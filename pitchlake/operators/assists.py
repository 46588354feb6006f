"""Assist stage (P6): the pass that set up each shot (J4) with pass-height
codes (X12) and defaults for unassisted shots (X13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.encode import pass_height_code
from pitchlake.schemas import (PASS_ANGLE_MISSING, PASS_COLUMNS, PASS_HEIGHT_MISSING,
                               PASS_LENGTH_MISSING)


def assisting_passes(events: DataFrame, one_per_shot: bool = False, with_match: bool = False) -> DataFrame:
    """Pass columns keyed by the shot they assisted; null keys removed before
    the shuffle.  ``one_per_shot`` keeps the latest pass by
    (period, minute, second, id) when several name one shot (D5);
    ``with_match`` carries ``match_id`` and takes the latest within it."""
    cols = [c for c in PASS_COLUMNS] + ["match_id"] * with_match
    keys = ["pass_assisted_shot_id"] + ["match_id"] * with_match
    p = events.filter(F.col("pass_assisted_shot_id").isNotNull())
    if one_per_shot:
        # Latest pass = max of a struct led by the clock: a plain aggregate with
        # map-side partial results, so a shot named by many passes never
        # gathers them in one task.
        rest = [c for c in cols if c not in keys]
        latest = F.max(F.struct("period", "minute", "second", "id", *rest)).alias("_l")
        p = (p.groupBy(*keys).agg(latest)
              .select(*keys, *[F.col(f"_l.{c}").alias(c) for c in rest]))
    return p.select(*cols).withColumn("pass_height", pass_height_code("pass_height"))


def attach_assist(shots: DataFrame, passes: DataFrame, same_match: bool = False,
                  split_above: int | None = None) -> DataFrame:
    """The shots with the columns of the passes that set them up."""
    out = join_assist(shots, passes, same_match, split_above)
    return out.withColumns(assist_columns()).drop("pass_assisted_shot_id")


def join_assist(shots: DataFrame, passes: DataFrame, same_match: bool = False,
                split_above: int | None = None) -> DataFrame:
    """Left join shot ``id`` = pass ``pass_assisted_shot_id`` (J4).  Two
    passes naming one shot give two rows, as published (D5 default).  Both
    sides grow with the data, neither is broadcast.

    ``same_match`` asks for equal ``match_id`` as well (``passes`` must carry
    it; a shot without a match has no assist then): tables bucketed by match and
    shot join without an exchange.  ``split_above`` splits the passes of a shot
    named by more than so many: adaptive execution cannot split the optional
    side of an outer join, so they get a part number by a hash of the row, and
    the shot meets each part."""
    base = shots.drop(*[c for c in PASS_COLUMNS if c in shots.columns])
    key = ["match_id", "pass_assisted_shot_id"] if same_match else ["pass_assisted_shot_id"]
    sides = passes.withColumnRenamed("match_id", "_match") if same_match else passes.drop("match_id")
    if split_above is not None:
        named = passes.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > split_above) \
            .select(*[F.col(c).alias(f"_hot_{c}") for c in key], F.ceil(F.col("_n") / split_above).cast("int").alias("_parts"))
        own = {"match_id": "_match" if same_match else None, "pass_assisted_shot_id": "pass_assisted_shot_id"}
        on_pass = [sides[own[c]] == named[f"_hot_{c}"] for c in key]
        plain = [c for c in sides.columns if c not in ("_match", "pass_assisted_shot_id")]
        sides = sides.join(named, on_pass, "left").withColumn(
            "_part", F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*plain), F.col("_parts"))).otherwise(0).cast("int")) \
            .drop("_parts", *[f"_hot_{c}" for c in key])
        on_shot = [base["match_id" if c == "match_id" else "id"] == named[f"_hot_{c}"] for c in key]
        base = base.join(named, on_shot, "left").drop(*[f"_hot_{c}" for c in key]) \
            .withColumn("_of", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
    on = base["id"] == sides["pass_assisted_shot_id"]
    if same_match:
        on = (base["match_id"] == sides["_match"]) & on
    if split_above is None:
        return base.join(sides, on, "left").drop("_match")
    out = base.join(sides, on & (base["_of"] == sides["_part"]), "left")
    # a part that got no pass is no shot without an assist
    return out.filter(F.col("pass_assisted_shot_id").isNotNull() | F.col("_parts").isNull()).drop("_match", "_parts", "_of", "_part")


def assist_columns() -> dict[str, Column]:
    """The assist columns of a joined shot, with values for no assist."""
    return {
        "assisted": F.when(F.col("pass_assisted_shot_id").isNotNull(), 1).otherwise(0),
        "pass_height": F.coalesce(F.col("pass_height"), F.lit(PASS_HEIGHT_MISSING)),
        "pass_angle": F.coalesce(F.col("pass_angle"), F.lit(PASS_ANGLE_MISSING)),
        "pass_length": F.coalesce(F.col("pass_length"), F.lit(PASS_LENGTH_MISSING)),
    }
