"""Football view over the driver's synthetic ``events`` table.

The test tables hold no football data, so registered queries read events
through a deterministic mapping of ``events`` (integer arithmetic only).  The
mapping is one list of SQL expressions: Spark runs it with ``selectExpr`` and
the DuckDB oracle runs the same text as ``BINDING_SQL``.  Freeze frames are
rendered on the Spark side as landed text (so the library's text parser runs
on every frame query); the oracle uses the equivalent relation ``FRAME_SQL``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.functions.frames import frame_text
from pitchlake.schemas import EVENT_SCHEMA

# (column, expression): the mapping as SQL expressions that Spark SQL and
# DuckDB both accept.  ``bind_events`` runs it with ``selectExpr``; the oracle
# runs the same text as ``BINDING_SQL``.
_SHOT = "event_type IN ('purchase','error')"
_X, _Y = "60+event_id*7919%601/10e0", "event_id*104729%801/10e0"
_BAD_POINT = "event_id%101=50"  # landed as text that is no point
_NO_PLAYER, _NO_TEAM, _NO_MATCH = "event_id%97=13", "event_id%89=7", "event_id%211=100"
# goals get rarer with the distance: the signal that the models must find
_DIST2 = f"((120e0-({_X}))*(120e0-({_X}))+(40e0-({_Y}))*(40e0-({_Y})))"
_GOAL = f"(event_id*48271%1000)/1000e0 < 1e0/(1e0+{_DIST2}*{_DIST2}/200000e0)"
# flags take true, false and null, each with its own period
_SHOT_FLAGS = {"shot_aerial_won": 7, "shot_first_time": 5, "shot_open_goal": 13, "shot_follows_dribble": 11}
_PASS_FLAGS = {"pass_aerial_won": 7, "pass_cross": 3, "pass_cut_back": 13, "pass_switch": 11, "pass_through_ball": 8,
               "pass_inswinging": 9, "pass_outswinging": 14, "pass_straight": 17, "pass_no_touch": 19}
BINDING = [
    ("id", "event_id"),
    ("match_id", f"CASE WHEN {_NO_MATCH} THEN NULL ELSE CAST(floor(event_id/200e0) AS BIGINT) END"),
    ("competition", "concat('comp', CAST(floor(event_id/200e0)%5 AS INT))"),
    ("season", "CASE WHEN floor(event_id/200e0)%2=0 THEN '2014/2015' ELSE '2015/2016' END"),
    ("type", f"CASE WHEN {_SHOT} THEN 'Shot' ELSE 'Pass' END"),
    ("player_id", f"CASE WHEN {_NO_PLAYER} THEN NULL ELSE user_id END"),
    ("team_id", f"CASE WHEN {_NO_TEAM} THEN NULL ELSE CAST(user_id%2 AS INT) END"),
    ("team", f"CASE WHEN {_NO_TEAM} THEN NULL WHEN user_id%2=0 THEN 'home' ELSE 'away' END"),
    ("player", f"CASE WHEN {_NO_PLAYER} THEN NULL ELSE concat('player', CAST(user_id AS STRING)) END"),
    ("period", "CASE WHEN event_id%200<96 THEN 1 ELSE 2 END"),
    ("minute", "CAST(floor(event_id%200/2e0) AS INT)"),
    ("second", "CAST(event_id*7%60 AS INT)"),
    ("location", f"CASE WHEN {_BAD_POINT} THEN 'n/a' ELSE concat('[',CAST({_X} AS STRING),', ',"
                 f"CAST({_Y} AS STRING),']') END"),
    ("x", f"CASE WHEN {_BAD_POINT} THEN NULL ELSE {_X} END"),
    ("y", f"CASE WHEN {_BAD_POINT} THEN NULL ELSE {_Y} END"),
    ("shot_end_location", f"CASE WHEN {_SHOT} THEN concat('[120.0, ',CAST(event_id*31%801/10e0 AS STRING),"
                          "CASE WHEN event_id%4=0 THEN ', 1.5]' ELSE ']' END) END"),
    ("shot_type", f"CASE WHEN {_SHOT} THEN CASE event_id%23 WHEN 0 THEN 'Penalty' WHEN 1 THEN 'Free Kick' "
                  "ELSE 'Open Play' END END"),
    ("shot_body_part", f"CASE WHEN {_SHOT} THEN CASE (event_id*11+user_id)%7 WHEN 0 THEN 'Head' "
                       "WHEN 1 THEN 'Left Foot' WHEN 2 THEN 'Left Foot' ELSE 'Right Foot' END END"),
    ("pass_body_part", f"CASE WHEN {_SHOT} THEN NULL ELSE CASE (event_id*13+user_id)%5 WHEN 0 THEN 'Left Foot' "
                       "WHEN 1 THEN 'Other' ELSE 'Right Foot' END END"),
    ("shot_outcome", f"CASE WHEN {_SHOT} THEN CASE WHEN {_GOAL} THEN 'Goal' ELSE 'Saved' END END"),
    ("shot_technique", f"CASE WHEN {_SHOT} THEN CASE event_id%8 WHEN 0 THEN 'Volley' WHEN 1 THEN 'Lob' "
                       "WHEN 2 THEN 'Half Volley' WHEN 3 THEN 'Overhead Kick' WHEN 4 THEN 'Backheel' "
                       "WHEN 5 THEN 'Diving Header' ELSE 'Normal' END END"),
    ("play_pattern", "CASE event_id%10 WHEN 0 THEN 'Other' WHEN 1 THEN 'From Corner' WHEN 2 THEN 'From Throw In' "
                     "WHEN 3 THEN 'From Free Kick' WHEN 4 THEN 'From Counter' WHEN 5 THEN 'From Goal Kick' "
                     "WHEN 6 THEN 'From Keeper' WHEN 7 THEN 'From Kick Off' ELSE 'Regular Play' END"),
    ("under_pressure", "CASE event_id%6 WHEN 0 THEN true WHEN 1 THEN false END"),
    ("shot_one_on_one", "CASE event_id%9 WHEN 0 THEN true WHEN 1 THEN false END"),
    *[(c, f"CASE WHEN {_SHOT} THEN CASE event_id%{k} WHEN 1 THEN true WHEN 2 THEN false END END")
      for c, k in _SHOT_FLAGS.items()],
    *[(c, f"CASE WHEN NOT {_SHOT} THEN CASE event_id%{k} WHEN 1 THEN true WHEN 2 THEN false END END")
      for c, k in _PASS_FLAGS.items()],
    ("shot_statsbomb_xg", f"CASE WHEN {_SHOT} THEN event_id*37%100/100e0 END"),
    ("pass_assisted_shot_id", f"CASE WHEN NOT {_SHOT} THEN CASE event_id%5 WHEN 0 THEN event_id+1 "
                              "WHEN 1 THEN event_id+1 WHEN 2 THEN event_id-1 END END"),
    ("pass_height", f"CASE WHEN NOT {_SHOT} THEN CASE event_id%4 WHEN 0 THEN 'Ground Pass' WHEN 1 THEN 'Low Pass' "
                    "WHEN 2 THEN 'High Pass' END END"),
    ("pass_length", f"CASE WHEN NOT {_SHOT} THEN event_id%300/10e0 END"),
    ("pass_angle", f"CASE WHEN NOT {_SHOT} THEN event_id%63/10e0-3.1e0 END"),
    ("n_frame", f"CAST(CASE WHEN {_SHOT} AND event_id%23<>0 THEN event_id%12 ELSE 0 END AS INT)"),
    # an empty frame is text too ('[]'); other shots without players have none
    ("empty_frame", f"CASE WHEN {_SHOT} AND event_id%23<>0 AND event_id%24=0 THEN true END"),
]

BINDING_SQL = "SELECT " + ",\n  ".join(f"{e} AS {n}" for n, e in BINDING) + "\nFROM events"

# One row per freeze-frame player of each shot (oracle side); ``b`` is the binding.
FRAME_SQL = ("SELECT b.id, CAST(j AS INT) AS j, 100+(b.id*31+j*17)%201/10e0 AS px, "
             "(b.id*13+j*29)%801/10e0 AS py, (b.id+j)%2=0 AS teammate "
             "FROM b, unnest(range(b.n_frame)) AS e(j)")

# Frame players of a shot (Spark side), rendered to text by ``frame_text``.
_FRAME_PLAYERS = (
    "transform(sequence(0, n_frame - 1), j -> named_struct("
    "'location', array(100 + (id*31 + j*17) % 201 / 10e0, (id*13 + j*29) % 801 / 10e0), "
    "'player', named_struct('id', CAST(id*100 + j AS BIGINT), "
    "'name', element_at(array(\"O'Neil\", 'Kanté', 'Trueman'), CAST(j % 3 + 1 AS INT))), "
    "'position', named_struct('id', CAST(j AS INT), "
    "'name', CASE WHEN j = 0 THEN 'Goalkeeper' ELSE 'Center Back' END), "
    "'teammate', (id + j) % 2 = 0))")


def bind_events(events: DataFrame, with_frames: bool = True) -> DataFrame:
    """Map ``events(event_id, ts, user_id, event_type, value, props)`` to the
    football event columns, plus typed nulls for the event columns the
    mapping does not produce.  Row count and partitioning are those of the
    input: a narrow projection, no shuffle."""
    names = {n for n, _ in BINDING}
    missing = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`"
               for f in EVENT_SCHEMA.fields if f.name not in names and f.name != "shot_freeze_frame"]
    df = events.selectExpr(*[f"{e} AS {n}" for n, e in BINDING], *missing)
    frame = frame_text(F.expr(_FRAME_PLAYERS)) if with_frames else F.lit(None).cast("string")
    text = F.when(F.col("n_frame") > 0, frame)
    return df.withColumn("shot_freeze_frame", text.when(F.col("empty_frame"), "[]") if with_frames else text)


def events_view(spark: SparkSession, sf_dir: str, with_frames: bool = True) -> DataFrame:
    """Bound football events of one test scale (reads ``events.parquet``)."""
    return bind_events(spark.read.parquet(f"{sf_dir}/events.parquet"), with_frames=with_frames)


def oracle_with(sql_body: str, frames: bool = False) -> str:
    """Wrap an oracle query body with the binding CTE ``b`` (and ``fr``)."""
    ctes = [f"b AS ({BINDING_SQL})"]
    if frames:
        ctes.append(f"fr AS ({FRAME_SQL})")
    return "WITH " + ",\n".join(ctes) + "\n" + sql_body
