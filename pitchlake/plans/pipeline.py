"""Feature pipeline (P1): events -> one row per shot with the 57 published
columns (then ``team_id``).

One lazy plan, no action: season filter, shot-or-assist filter and column
pruning reach the scan; two shuffles at most (the foot aggregate, which
adaptive execution broadcasts when small, and the assist join); no Python
worker anywhere in the plan.  The row-level features are gathered into as
few projections as possible (shot point and frame count before the joins,
everything else in one final projection), which keeps both the plan and its
construction small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.functions.encode import flag, used_preferred_foot, vendor_label
from pitchlake.operators.assists import assist_columns, assisting_passes, join_assist
from pitchlake.operators.encode import dummy_columns, flag_columns
from pitchlake.operators.frames import players_inside_area
from pitchlake.operators.players import preferred_foot_table
from pitchlake.operators.spatial import geometry_columns, point_columns
from pitchlake.session import scratch_dir
from pitchlake.sinks.writers import kept
from pitchlake.schemas import BOOLEAN_INPUTS, EVENTS, GOAL_X, GOAL_Y1, GOAL_Y2, PASS_COLUMNS, VARIABLES


def shots_or_assists(events: DataFrame, season: str | None = None) -> DataFrame:
    """F5 + F6 + F7: optional season, then shots and passes that assisted one."""
    df = events if season is None else events.filter(F.col("season") == season)
    df = df.filter((F.col("type") == "Shot") | F.col("pass_assisted_shot_id").isNotNull())
    # team_id for entity filters; frame when the frames were parsed at ingest
    keep = [c for c in EVENTS if c in df.columns] + [c for c in ("team_id", "frame") if c in df.columns]
    return df.select(*keep)


def staged_rows(events: DataFrame, season: str | None = None) -> DataFrame:
    """The shots and assisting passes with the columns that the pipeline reads,
    written once.  Of millions of events a few per cent are left; foot usage,
    assists and shots then read this narrow table, and the events are scanned once."""
    return kept(shots_or_assists(events, season), scratch_dir(events.sparkSession, "shots-or-assists"))


def _feature_columns(geometry: dict) -> dict:
    """Every output column that is a per-row expression of the joined shot."""
    cols = dict(geometry)
    cols["preferred_foot_shot"] = flag(used_preferred_foot("preferred_foot", "shot_body_part"))
    cols.update(dummy_columns())
    cols.update(flag_columns([*BOOLEAN_INPUTS, "goal"]))
    cols.update(assist_columns())
    cols["sb_prediction"] = vendor_label("shot_statsbomb_xg")
    return cols


def shot_features(events: DataFrame, season: str | None = None, *, usage: str = "filtered",
                  one_per_shot: bool = False, missing_frame: str = "null",
                  goal_x: float = GOAL_X, goal_y1: float = GOAL_Y1, goal_y2: float = GOAL_Y2,
                  variables: list[str] | None = None, extra: tuple[str, ...] = ("team_id",),
                  keep_frame: bool = False, staged: bool = False) -> DataFrame:
    """The full feature table.

    ``usage='filtered'`` computes preferred feet from the same filtered rows
    (published behaviour, D4); ``'all'`` from every pass and shot of ``events``.
    ``one_per_shot`` and ``missing_frame`` are the D5/D8 options;
    ``keep_frame`` carries the parsed freeze frame as a ``frame`` column (P4).
    ``staged`` writes the narrow rows first (:func:`staged_rows`), so that the
    events are scanned once and not by each of the three branches; this runs
    when called.
    """
    if staged and usage != "filtered":
        raise ValueError("usage='all' needs all events: it cannot be staged")
    ev = staged_rows(events, season) if staged else shots_or_assists(events, season)
    if usage == "filtered":
        usage_rows = ev
    elif usage == "all":
        usage_rows = events if season is None else events.filter(F.col("season") == season)
    else:
        raise ValueError("usage must be 'filtered' or 'all'")
    feet = preferred_foot_table(usage_rows)
    passes = assisting_passes(ev, one_per_shot=one_per_shot)

    # shot rows: parsed point, then the frame count (frames never leave their row)
    shots = ev.filter(F.col("type") == "Shot").drop(*PASS_COLUMNS).withColumns(point_columns())
    shots = players_inside_area(shots, missing_frame, goal_x, goal_y1, goal_y2, keep_frame=keep_frame)
    joined = join_assist(shots.join(feet, "player_id", "left"), passes)
    cols = _feature_columns(geometry_columns(goal_x, goal_y1, goal_y2))
    wanted = list(VARIABLES if variables is None else variables)
    wanted += [c for c in extra if c in joined.columns and c not in wanted]
    if keep_frame:
        wanted.append("frame")
    return joined.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in wanted])
