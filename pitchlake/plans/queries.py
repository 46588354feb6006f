"""Registered queries: one per operator group of the inventory, each a
function ``(spark, sf_dir) -> DataFrame`` over the whole test tables, and
(where SQL can say it) the DuckDB text computing the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.binding import BINDING, events_view
from pitchlake.operators import explore, metrics, ml, timeline
from pitchlake.operators.assists import assisting_passes, attach_assist
from pitchlake.operators.encode import bool_to_int, create_dummies, with_vendor_label
from pitchlake.operators.frames import frame_players, players_inside_area, with_frame
from pitchlake.operators.players import attach_preferred_foot, foot_usage, preferred_foot_table
from pitchlake.operators.spatial import spatial
from pitchlake.plans.oracle import binding_ctes, shots_ctes
from pitchlake.plans.pipeline import shot_features, shots_or_assists
from pitchlake.functions.encode import preferred_foot
from pitchlake.schemas import (BOOL_TO_INT, COMPETITION_SCHEMA, DUMMIES, EVENT_SCHEMA, FEATURES, FEATURES_NP,
                               MATCH_SCHEMA)
from pitchlake.sinks.writers import held, kept, write_batches, write_bucketed, write_csv, write_parquet, write_split
from pitchlake.session import scratch_dir
from pitchlake.sources import readers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _events(spark, sf, frames=True):
    return events_view(spark, sf, with_frames=frames)


def _shots(spark, sf, **kw):
    return shot_features(_events(spark, sf), **kw)


# ------------------------------------------------------------------ flagship

@register("player_summary", shots_ctes() + """
SELECT player, team, count(*) AS shots, CAST(sum(goal) AS BIGINT) AS goals,
  round(sum(shot_statsbomb_xg),3) AS xg, round(sum(distance_to_goal),6)/count(*) AS mean_distance,
  round(sum(shot_angle),6)/count(*) AS mean_angle
FROM shots GROUP BY player, team""")
def player_summary(spark, sf):
    """Flagship: shots, goals, xG, mean distance and angle per player."""
    s = _shots(spark, sf)
    return s.groupBy("player", "team").agg(
        F.count(F.lit(1)).alias("shots"), F.sum("goal").cast("bigint").alias("goals"),
        F.round(F.sum("shot_statsbomb_xg"), 3).alias("xg"),
        (F.round(F.sum("distance_to_goal"), 6) / F.count(F.lit(1))).alias("mean_distance"),
        (F.round(F.sum("shot_angle"), 6) / F.count(F.lit(1))).alias("mean_angle"))


# ------------------------------------------------------------------ P2 geometry

@register("shot_geometry", binding_ctes() + """
SELECT id, x AS shot_location_x, y AS shot_location_y,
  round(sqrt(pow(x-120e0,2)+pow(y-40e0,2)),2) AS distance_to_goal,
  round(degrees(atan2(abs((120e0-x)*8e0), (120e0-x)*(120e0-x)+(36e0-y)*(44e0-y))),6) AS shot_angle
FROM b WHERE type='Shot'""")
def shot_geometry(spark, sf):
    ev = shots_or_assists(_events(spark, sf, frames=False)).filter(F.col("type") == "Shot")
    return spatial(ev).select("id", "shot_location_x", "shot_location_y", "distance_to_goal", "shot_angle")


@register("shot_end_point", binding_ctes() + """
SELECT id, shot_end_location, 120e0 AS shot_end_x, id*31%801/10e0 AS shot_end_y
FROM b WHERE type='Shot'""")
def shot_end_point(spark, sf):
    ev = _events(spark, sf, frames=False).filter(F.col("type") == "Shot")
    return spatial(ev).select("id", "shot_end_location", "shot_end_x", "shot_end_y")


# ------------------------------------------------------------------ ingest / competitions

def _competitions(ev: DataFrame) -> DataFrame:
    """Competition-season rows derived from the bound events (one per
    competition and season), shaped like a landed competitions file."""
    c = ev.select("competition", "season").distinct()
    idx = F.regexp_extract("competition", r"(\d+)$", 1).cast("int")
    return c.select(
        idx.alias("competition_id"),
        F.when(F.col("season") == "2014/2015", F.lit(1)).otherwise(F.lit(2)).alias("season_id"),
        F.when(F.col("competition") == "comp2", F.lit("Indian Super league"))
         .when(F.col("competition") == "comp1", F.lit("Major League Soccer"))
         .otherwise(F.col("competition")).alias("competition_name"),
        F.when(F.col("competition") == "comp3", F.lit("female")).otherwise(F.lit("male")).alias("competition_gender"),
        F.when((F.col("competition") == "comp4") & (F.col("season") == "2014/2015"), F.lit("2014"))
         .otherwise(F.col("season")).alias("season_name"),
        F.lit(False).alias("competition_youth"),
        F.lit(None).cast("string").alias("match_updated"))


_COMPS_SQL = """comps AS (SELECT DISTINCT CAST(regexp_extract(competition, '(\\d+)$', 1) AS INT) AS competition_id,
  CASE WHEN season='2014/2015' THEN 1 ELSE 2 END AS season_id,
  CASE WHEN competition='comp2' THEN 'Indian Super league' WHEN competition='comp1' THEN 'Major League Soccer' ELSE competition END AS competition_name,
  CASE WHEN competition='comp3' THEN 'female' ELSE 'male' END AS competition_gender,
  CASE WHEN competition='comp4' AND season='2014/2015' THEN '2014' ELSE season END AS season_name
  FROM b)"""


@register("competition_filter", binding_ctes() + ", " + _COMPS_SQL + """
SELECT competition_id, season_id, competition_name, season_name FROM comps
WHERE competition_gender='male' AND season_name > '2014'
  AND competition_name NOT IN ('Indian Super league', 'Major League Soccer')""")
def competition_filter(spark, sf):
    comps = _competitions(_events(spark, sf, frames=False))
    return readers.filter_competitions(comps).orderBy(F.desc("season_name")).select(
        "competition_id", "season_id", "competition_name", "season_name")


def _matches(ev: DataFrame) -> DataFrame:
    idx = F.regexp_extract("competition", r"(\d+)$", 1).cast("int")
    return ev.groupBy("match_id", "competition", "season").agg(F.count(F.lit(1)).alias("n_events")).select(
        "match_id", idx.alias("competition_id"),
        F.when(F.col("season") == "2014/2015", F.lit(1)).otherwise(F.lit(2)).alias("season_id"),
        "competition", "season", F.lit("available").alias("match_status"))


@register("landed_scan", binding_ctes() + ", " + _COMPS_SQL + """,
kept AS (SELECT * FROM comps WHERE competition_gender='male' AND season_name > '2014'
  AND competition_name NOT IN ('Indian Super league', 'Major League Soccer')),
m AS (SELECT DISTINCT match_id, CAST(regexp_extract(competition, '(\\d+)$', 1) AS INT) AS competition_id,
  CASE WHEN season='2014/2015' THEN 1 ELSE 2 END AS season_id FROM b)
SELECT b.match_id, b.competition, b.season, count(*) AS events, count(*) FILTER (WHERE b.type='Shot') AS shots
FROM b WHERE b.match_id IN (SELECT match_id FROM m JOIN kept USING (competition_id, season_id))
GROUP BY b.match_id, b.competition, b.season""")
def landed_scan(spark, sf):
    """Land competitions (JSON), matches and events
    (Parquet) in the shared folder, read them back with declared schemas,
    keep the matches of the chosen competitions (semi join) and stamp
    competition and season on their events."""
    ev = _events(spark, sf, frames=False)
    base = scratch_dir(spark, "landed")
    _competitions(ev).write.mode("overwrite").json(f"{base}/competitions")
    _matches(ev).write.mode("overwrite").parquet(f"{base}/matches")
    ev.drop("competition", "season").write.mode("overwrite").parquet(f"{base}/events")
    comps = readers.filter_competitions(readers.read_table(spark, f"{base}/competitions", "json", COMPETITION_SCHEMA))
    matches = readers.matches_for(
        readers.read_table(spark, f"{base}/matches", schema=MATCH_SCHEMA), comps)
    events = readers.attach_match(readers.read_table(spark, f"{base}/events"), matches)
    return events.groupBy("match_id", "competition", "season").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("type") == "Shot").cast("bigint").alias("shots"))


# ------------------------------------------------------------------ F5 season

@register("season_filter", shots_ctes(season="2015/2016") + "SELECT * FROM shots")
def season_filter(spark, sf):
    return _shots(spark, sf, season="2015/2016")


# ------------------------------------------------------------------ P3 preferred foot

@register("preferred_foot", shots_ctes() + "SELECT player_id, left_foot, right_foot, preferred_foot FROM foot")
def preferred_foot_q(spark, sf):
    ev = shots_or_assists(_events(spark, sf, frames=False))
    u = foot_usage(ev)
    return u.select("player_id", "left_foot", "right_foot",
                    preferred_foot("left_foot", "right_foot").alias("preferred_foot"))


@register("preferred_foot_shot", shots_ctes() + """
SELECT s.id, s.player_id, f.preferred_foot,
  CASE WHEN f.preferred_foot='Two-Footed' AND s.shot_body_part IN ('Right Foot','Left Foot') THEN 1
       WHEN f.preferred_foot = s.shot_body_part THEN 1 ELSE 0 END AS preferred_foot_shot
FROM ev s LEFT JOIN foot f ON s.player_id = f.player_id WHERE s.type='Shot'""")
def preferred_foot_shot_q(spark, sf):
    ev = shots_or_assists(_events(spark, sf, frames=False))
    shots = attach_preferred_foot(ev.filter(F.col("type") == "Shot"), preferred_foot_table(ev), keep_foot=True)
    return shots.select("id", "player_id", "preferred_foot",
                        F.coalesce(F.col("preferred_foot_shot").cast("int"), F.lit(0)).alias("preferred_foot_shot"))


# ------------------------------------------------------------------ P4/P5 frames

@register("frame_explode", binding_ctes(frames=True) + """
SELECT fr.id, fr.px AS x, fr.py AS y, CASE WHEN fr.j=0 THEN 'Goalkeeper' ELSE 'Center Back' END AS position,
  fr.teammate, fr.id*100+fr.j AS player_id, list_element(['O''Neil','Kanté','Trueman'], fr.j%3+1) AS player_name
FROM fr JOIN b ON b.id = fr.id WHERE b.type='Shot' AND b.shot_type <> 'Penalty'""")
def frame_explode(spark, sf):
    shots = _events(spark, sf).filter(F.col("type") == "Shot")
    return frame_players(shots)


@register("players_inside_area", shots_ctes() + """
SELECT DISTINCT id, CASE WHEN pk_type=1 THEN 'Penalty' END AS penalty, players_inside_area FROM shots""")
def players_inside_q(spark, sf):
    shots = spatial(_events(spark, sf).filter(F.col("type") == "Shot"))
    out = players_inside_area(shots)
    return out.select("id", F.when(F.col("shot_type") == "Penalty", F.lit("Penalty")).alias("penalty"),
                      "players_inside_area")


# ------------------------------------------------------------------ P6 assists

@register("assist_features", shots_ctes() + """
SELECT id, assisted, pass_height, pass_length, pass_angle FROM shots""")
def assist_features(spark, sf):
    ev = shots_or_assists(_events(spark, sf, frames=False))
    out = attach_assist(ev.filter(F.col("type") == "Shot"), assisting_passes(ev))
    return out.select("id", "assisted", "pass_height", "pass_length", "pass_angle")


@register("assist_latest", shots_ctes(one_per_shot=True) + """
SELECT id, assisted, pass_height, pass_length, pass_angle FROM shots""")
def assist_latest(spark, sf):
    ev = shots_or_assists(_events(spark, sf, frames=False))
    out = attach_assist(ev.filter(F.col("type") == "Shot"), assisting_passes(ev, one_per_shot=True))
    return out.select("id", "assisted", "pass_height", "pass_length", "pass_angle")


_ASSIST_MATCH = shots_ctes() + """
SELECT s.id, CASE WHEN p.id IS NOT NULL THEN 1 ELSE 0 END AS assisted,
  CASE WHEN p.id IS NULL THEN -1 ELSE CASE p.pass_height WHEN 'Ground Pass' THEN 0 WHEN 'Low Pass' THEN 1 ELSE 2 END END AS pass_height,
  coalesce(p.pass_length, 0e0) AS pass_length, coalesce(p.pass_angle, 4e0) AS pass_angle
FROM ev s LEFT JOIN ev p ON p.pass_assisted_shot_id = s.id AND p.match_id = s.match_id WHERE s.type = 'Shot'"""


@register("assist_bucketed", _ASSIST_MATCH)
def assist_bucketed(spark, sf):
    """Shots and assisting passes as two tables bucketed by match and shot,
    joined on both without an exchange (J4)."""
    ev = shots_or_assists(_events(spark, sf, frames=False))
    base = scratch_dir(spark, "bucketed")
    name = base.rsplit("-", 1)[1]
    shots = write_bucketed(ev.filter(F.col("type") == "Shot").select("id", "match_id", "type"), f"shots_{name}", f"{base}/shots",
                           ["match_id", "id"], 16)
    passes = write_bucketed(assisting_passes(ev, with_match=True), f"passes_{name}", f"{base}/passes",
                            ["match_id", "pass_assisted_shot_id"], 16)
    out = attach_assist(shots, passes, same_match=True)
    return out.select("id", "assisted", "pass_height", "pass_length", "pass_angle")


@register("assist_split", shots_ctes() + """,
hot AS (SELECT min(id) AS h FROM ev WHERE type = 'Shot'),
pp AS (SELECT CASE WHEN p.id % 3 = 0 THEN hot.h ELSE p.pass_assisted_shot_id END AS shot, p.pass_length
       FROM ev p CROSS JOIN hot WHERE p.pass_assisted_shot_id IS NOT NULL)
SELECT s.id, count(pp.shot) AS passes, round(coalesce(sum(pp.pass_length), 0), 3) AS length
FROM ev s LEFT JOIN pp ON pp.shot = s.id WHERE s.type = 'Shot' GROUP BY s.id""")
def assist_split(spark, sf):
    """One shot named by a third of all passes: they are dealt to parts."""
    ev = shots_or_assists(_events(spark, sf, frames=False))
    shots = ev.filter(F.col("type") == "Shot")
    hot = shots.agg(F.min("id").alias("h"))
    named = ev.filter(F.col("pass_assisted_shot_id").isNotNull()).crossJoin(hot)  # one row
    passes = assisting_passes(named.withColumn("pass_assisted_shot_id", F.when(F.col("id") % 3 == 0, F.col("h")).otherwise(F.col("pass_assisted_shot_id"))))
    out = attach_assist(shots.select("id", "match_id"), passes, split_above=50)
    return out.groupBy("id").agg(F.sum(F.col("assisted").cast("bigint")).alias("passes"), F.round(F.sum("pass_length"), 3).alias("length"))


# ------------------------------------------------------------------ P7 encoding

_DUMMY_COLS = [c for m in DUMMIES.values() for c in m.values()]


@register("one_hot", shots_ctes() + """
SELECT s.id, """ + ", ".join(
    [f"CASE WHEN s.{src}='{v}' THEN 1 ELSE 0 END AS {name}" for src, m in DUMMIES.items() for v, name in m.items()]
) + """, CASE WHEN s.shot_outcome='Goal' THEN true WHEN s.shot_outcome IS NULL THEN NULL ELSE false END AS goal,
  CASE WHEN s.shot_body_part='Head' THEN 1 ELSE 0 END AS header
FROM ev s WHERE s.type='Shot'""")
def one_hot_q(spark, sf):
    ev = _events(spark, sf, frames=False).filter(F.col("type") == "Shot")
    return create_dummies(ev).select("id", *_DUMMY_COLS, "goal", "header")


_FLAG_COLS = [c for c in BOOL_TO_INT if c not in ("preferred_foot_shot", "goal")]


@register("bool_flags", shots_ctes() + """
SELECT id, """ + ", ".join(
    f"CASE WHEN shot_type='Penalty' THEN 1 ELSE coalesce(CAST({c} AS INT), 0) END AS {c}" if c == "shot_one_on_one"
    else f"coalesce(CAST({c} AS INT), 0) AS {c}" for c in _FLAG_COLS) + """,
  CASE WHEN shot_type='Penalty' THEN 1 ELSE 0 END AS pk_type,
  CASE WHEN shot_statsbomb_xg >= 0.5e0 THEN 1 ELSE 0 END AS sb_prediction
FROM ev WHERE type='Shot'""")
def bool_flags(spark, sf):
    ev = _events(spark, sf, frames=False).filter(F.col("type") == "Shot")
    out = with_vendor_label(bool_to_int(create_dummies(ev), _FLAG_COLS))
    return out.select("id", *_FLAG_COLS, "pk_type", "sb_prediction")


# ------------------------------------------------------------------ P1 complete

@register("shot_features", shots_ctes() + "SELECT * FROM shots")
def shot_features_q(spark, sf):
    return _shots(spark, sf)


@register("shot_features_staged", shots_ctes() + "SELECT * FROM shots")
def shot_features_staged(spark, sf):
    """The feature table from one scan of the events."""
    return _shots(spark, sf, staged=True)


# ------------------------------------------------------------------ S6, S10 conform

_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
_CONFORM_MISSING = ("shot_aerial_won", "pass_height")


def _conform_sql() -> str:
    bound = {n for n, _ in BINDING} - set(_CONFORM_MISSING)
    cols = [f'CAST({f.name if f.name in bound else "NULL"} AS {_DUCK_TYPES[f.dataType.simpleString()]}) AS "{f.name}"'
            for f in EVENT_SCHEMA.fields]
    return binding_ctes() + "SELECT " + ", ".join(cols) + " FROM b"


@register("conform_schema", _conform_sql())
def conform_schema(spark, sf):
    """All declared event columns, from a table with some missing and some extra."""
    ev = _events(spark, sf, frames=False).drop(*_CONFORM_MISSING).withColumn("vendor_extra", F.lit("x"))
    return readers.conform(readers.require_columns(ev, ["id", "match_id", "type"]), EVENT_SCHEMA)


# ------------------------------------------------------------------ S7, W4, J5, F15

@register("match_batch", binding_ctes() + """,
m AS (SELECT match_id, (row_number() OVER (ORDER BY match_id) - 1) // 10 AS batch FROM (SELECT DISTINCT match_id FROM b WHERE match_id IS NOT NULL) d)
SELECT m.batch, count(DISTINCT b.match_id) AS matches, count(*) AS events,
  count(*) FILTER (WHERE b.type='Shot') AS shots
FROM b JOIN m ON b.match_id = m.match_id GROUP BY m.batch""")
def match_batch(spark, sf):
    ev = _events(spark, sf, frames=False)
    matches = readers.match_batches(ev.filter("match_id IS NOT NULL").select("match_id").distinct(), batch_size=10)
    path = scratch_dir(spark, "batches")
    write_batches(ev.join(matches.select("match_id", "batch"), "match_id").select("batch", "match_id", "type"), path)
    # the partition column comes back with an inferred type: restore the long
    return (spark.read.parquet(path)
              .groupBy(F.col("batch").cast("bigint").alias("batch"))
              .agg(F.countDistinct("match_id").alias("matches"), F.count(F.lit(1)).alias("events"),
                   F.count_if(F.col("type") == "Shot").cast("bigint").alias("shots")))


# ------------------------------------------------------------------ J8 stamp (TPC-H sized)

@register("attach_match", """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, o.o_orderstatus, o.o_orderpriority
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def attach_match_q(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.col("l_orderkey").alias("match_id"), "l_linenumber", "l_quantity", "l_extendedprice")
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("match_id"), "o_orderstatus", "o_orderpriority")
    out = readers.attach_match(li, o, cols=("o_orderstatus", "o_orderpriority"))
    return out.select(F.col("match_id").alias("l_orderkey"), "l_linenumber", "l_quantity", "l_extendedprice",
                      "o_orderstatus", "o_orderpriority")


# ------------------------------------------------------------------ S4, U2 lineups

@register("lineup_flatten", binding_ctes() + """
SELECT DISTINCT match_id, team, player_id, player AS player_name FROM b WHERE team IS NOT NULL""")
def lineup_flatten(spark, sf):
    path = scratch_dir(spark, "lineups")
    _land_lineups(_events(spark, sf, frames=False), path)
    return readers.read_lineups(spark, path).select("match_id", "team", "player_id", "player_name")


def _land_lineups(ev: DataFrame, path: str) -> None:
    """Land team sheets as JSON, one object per match with a team -> players map."""
    ev = ev.filter("team IS NOT NULL")
    # distinct first: a team sheet is a few dozen players however many events
    # a match has, so the collected arrays stay small
    per_team = (ev.select("match_id", "team", F.struct("player_id", F.col("player").alias("player_name")).alias("p"))
                  .distinct()
                  .groupBy("match_id", "team").agg(F.collect_list("p").alias("players")))
    lineups = per_team.groupBy("match_id").agg(
        F.map_from_entries(F.collect_list(F.struct("team", "players"))).alias("teams"))
    lineups.write.json(path)


# ------------------------------------------------------------------ S3, S9, J5, K4, K5 rows of chosen matches

_KEPT_SQL = """,
kept AS (SELECT * FROM comps WHERE competition_gender='male' AND season_name > '2014'
  AND competition_name NOT IN ('Indian Super league', 'Major League Soccer')),
m AS (SELECT DISTINCT match_id, competition, season FROM b JOIN kept
  ON CAST(regexp_extract(b.competition, '(\\d+)$', 1) AS INT) = kept.competition_id
  AND CASE WHEN b.season='2014/2015' THEN 1 ELSE 2 END = kept.season_id WHERE match_id IS NOT NULL)
"""


def _chosen_matches(ev: DataFrame) -> DataFrame:
    return readers.matches_for(_matches(ev), readers.filter_competitions(_competitions(ev)))


@register("matches_rows", binding_ctes() + ", " + _COMPS_SQL + _KEPT_SQL + """
SELECT id, match_id, type FROM b WHERE match_id IN (SELECT match_id FROM m)""")
def matches_rows(spark, sf):
    """Events of the chosen matches, unstamped."""
    ev = _events(spark, sf, frames=False)
    return readers.rows_of_matches(ev, _chosen_matches(ev)).select("id", "match_id", "type")


@register("frames_split", binding_ctes(frames=True) + ", " + _COMPS_SQL + _KEPT_SQL + """
SELECT m.competition, count(*) AS players, count(DISTINCT b.id) AS shots, count(DISTINCT b.match_id) AS matches
FROM fr JOIN b ON b.id = fr.id JOIN m ON m.match_id = b.match_id AND m.competition = b.competition
WHERE b.type='Shot' AND b.shot_type <> 'Penalty' GROUP BY m.competition""")
def frames_split(spark, sf):
    """A landed frames table (one row per frame player), the rows of chosen
    matches, split by competition; competitions without frames give no folder
    (S9, J5, K4, K6)."""
    ev = _events(spark, sf)
    base = scratch_dir(spark, "frames")
    shots = ev.filter(F.col("type") == "Shot")
    frame_players(shots).join(shots.select("id", "match_id"), "id").write.parquet(f"{base}/landed")
    matches = _chosen_matches(ev)
    frames = readers.rows_of_matches(readers.read_table(spark, f"{base}/landed"), matches)
    stamped = readers.attach_match(frames, matches, cols=("competition",))
    write_split(stamped, f"{base}/split", key="competition", max_records_per_file=50_000)
    return spark.read.parquet(f"{base}/split").groupBy("competition").agg(
        F.count(F.lit(1)).alias("players"), F.countDistinct("id").alias("shots"),
        F.countDistinct("match_id").alias("matches"))


@register("lineups_split", binding_ctes() + ", " + _COMPS_SQL + _KEPT_SQL + """
SELECT m.competition, count(*) AS rows, count(DISTINCT l.match_id) AS matches, CAST(1 AS BIGINT) AS files
FROM (SELECT DISTINCT match_id, team, player_id, player FROM b WHERE team IS NOT NULL) l
JOIN m ON m.match_id = l.match_id GROUP BY m.competition""")
def lineups_split(spark, sf):
    """Lineups of the chosen matches, split by competition, one file each (S3,
    J5, K5, K6)."""
    ev = _events(spark, sf, frames=False)
    base = scratch_dir(spark, "lineups")
    _land_lineups(ev, f"{base}/landed")
    matches = _chosen_matches(ev)
    rows = readers.rows_of_matches(readers.read_lineups(spark, f"{base}/landed"), matches)
    write_split(readers.attach_match(rows, matches, cols=("competition",)), f"{base}/split", one_file=True)
    back = spark.read.parquet(f"{base}/split").select("*", F.col("_metadata.file_path").alias("file"))
    return back.groupBy("competition").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("match_id").alias("matches"),
                                           F.countDistinct("file").alias("files"))


# ------------------------------------------------------------------ S8 rejects

@register("reject_rows", binding_ctes() + """
SELECT CASE WHEN id%50=7 THEN 'rejected' ELSE 'good' END AS kind, count(*) AS rows,
  CAST(sum(CASE WHEN id%50=7 THEN 0 ELSE id END) AS BIGINT) AS ids FROM b GROUP BY 1""")
def reject_rows(spark, sf):
    """Land events as JSON lines, some cut off; both sides of the read."""
    ev = _events(spark, sf, frames=False).select("id", "match_id", "type", "minute")
    path = scratch_dir(spark, "rejects")
    line = F.to_json(F.struct("id", "match_id", "type", "minute"))
    ev.select(F.when(F.col("id") % 50 == 7, F.expr("substring(" + "to_json(struct(id, match_id, type, minute))" + ", 1, 20)"))
              .otherwise(line)).write.text(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("match_id", T.LongType()),
                           T.StructField("type", T.StringType()), T.StructField("minute", T.IntegerType())])
    good, bad = readers.read_events_checked(spark, path, schema)
    both = good.select(F.lit("good").alias("kind"), "id").unionByName(
        bad.select(F.lit("rejected").alias("kind"), F.lit(0).cast("bigint").alias("id")))
    return both.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))


def _drifting_units(ev: DataFrame, base: str) -> None:
    """The events by match as three landed units: all 122 columns, 121 and 120,
    with types that differ, as the seasons of a vendor do."""
    unit = F.coalesce(F.col("match_id") % 3, F.lit(0))
    rows = conformed = readers.conform(ev, EVENT_SCHEMA)
    full = rows.filter(unit == 0)
    other = conformed.filter(unit == 1).drop("shot_open_goal")
    third = conformed.filter(unit == 2).drop("shot_open_goal", "pass_switch")
    write_parquet(full, f"{base}/full")
    write_parquet(other.withColumns({"minute": F.col("minute").cast("string"), "shot_statsbomb_xg": F.col("shot_statsbomb_xg").cast("string"),
                                     "under_pressure": F.col("under_pressure").cast("string"), "team_id": F.col("team_id").cast("bigint")}),
                  f"{base}/text")
    write_parquet(third.withColumns({"second": F.col("second").cast("double"), "id": F.col("id").cast("string"),
                                     "pass_length": F.col("pass_length").cast("decimal(12,4)")}).select(*reversed(third.columns)), f"{base}/narrow")


def _drifting_sql() -> str:
    bound = {n for n, _ in BINDING}
    gone = {"shot_open_goal": "unit = 0", "pass_switch": "unit IN (0, 1)"}
    cols = []
    for f in EVENT_SCHEMA.fields:
        value = f.name if f.name in bound else "NULL"
        if f.name in gone and f.name in bound:
            value = f"CASE WHEN {gone[f.name]} THEN {value} END"
        cols.append(f'CAST({value} AS {_DUCK_TYPES[f.dataType.simpleString()]}) AS "{f.name}"')
    return binding_ctes() + "SELECT " + ", ".join(cols) + " FROM (SELECT *, coalesce(match_id % 3, 0) AS unit FROM b)"


@register("drifting_files", _drifting_sql())
def drifting_files(spark, sf):
    """Units of 122, 121 and 120 columns of differing types and order read as
    one table of the declared columns (S6, U2)."""
    base = scratch_dir(spark, "drifting")
    _drifting_units(_events(spark, sf, frames=False), base)
    return readers.read_drifting(spark, base, EVENT_SCHEMA)


_DRIFT_TEXT = ["id", "match_id", "type", "minute", "second", "team", "player", "location", "shot_statsbomb_xg", "under_pressure"]


@register("drifting_text_files", binding_ctes() + f"""
SELECT 'csv' AS fmt, CAST(id AS VARCHAR) AS id, {", ".join(_DRIFT_TEXT[1:-1])}, CASE WHEN id % 2 = 0 THEN under_pressure END AS under_pressure FROM b
UNION ALL SELECT 'json', CAST(id AS VARCHAR), {", ".join(_DRIFT_TEXT[1:-1])}, CASE WHEN id % 2 = 0 THEN under_pressure END FROM b""")
def drifting_text_files(spark, sf):
    """The same for CSV headers in differing order and for JSON records."""
    ev = _events(spark, sf, frames=False).select(*_DRIFT_TEXT)
    base = scratch_dir(spark, "drifting-text")
    schema = T.StructType([f for n in _DRIFT_TEXT for f in EVENT_SCHEMA.fields if f.name == n])
    one, two = ev.filter("id % 2 = 0"), ev.filter("id % 2 = 1").drop("under_pressure").withColumn("minute", F.col("minute").cast("double"))
    for k, part in enumerate((one, two.select(*reversed(two.columns)))):
        write_csv(part, f"{base}/csv/{k}", sep=";")
        part.write.json(f"{base}/json/{k}")
    back = [readers.read_drifting(spark, f"{base}/{fmt}", schema, fmt=fmt, sep=";").withColumn("fmt", F.lit(fmt)) for fmt in ("csv", "json")]
    return back[0].unionByName(back[1]).select("fmt", *_DRIFT_TEXT)


def _cut_off_copy(spark: SparkSession, source: str, target: str) -> None:
    """Half of the first data file below a folder, as an aborted download leaves it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(conf)
    part = next(f for f in fs.listStatus(path(source)) if f.getPath().getName().startswith("part-"))
    read, write = fs.open(part.getPath()), fs.create(path(target))
    jvm.org.apache.commons.io.IOUtils.copyLarge(read, write, 0, part.getLen() // 2)
    write.close()
    read.close()


@register("quarantined_files", binding_ctes() + """
SELECT 'good' AS kind, 4 AS files, count(*) AS rows, CAST(sum(id) AS BIGINT) AS ids FROM b WHERE id % 5 <> 2
UNION ALL SELECT 'no row could be read', 1, 0, 0""")
def quarantined_files(spark, sf):
    """Five landed files, one of them cut off: the rows of the others, and which
    file could not be read (S8)."""
    ev = _events(spark, sf, frames=False).select("id", "match_id", "type", "minute")
    base = scratch_dir(spark, "quarantine")
    for k in range(5):
        ev.filter(F.col("id") % 5 == k).coalesce(1).write.parquet(f"{base}/{'whole' if k == 2 else f'landed/unit={k}'}")
    _cut_off_copy(spark, f"{base}/whole", f"{base}/landed/unit=2/part-cut.parquet")
    good, bad = readers.read_quarantined(spark, f"{base}/landed", ev.schema)
    counts = good.select("id", F.col("_metadata.file_path").alias("file")).agg(
        F.lit("good").alias("kind"), F.countDistinct("file").cast("int").alias("files"), F.count(F.lit(1)).alias("rows"), F.sum("id").alias("ids"))
    listed = bad.filter("file LIKE '%.parquet'").groupBy(F.col("reason").alias("kind")).agg(
        F.count(F.lit(1)).cast("int").alias("files"), F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("ids"))
    return counts.unionByName(listed)


# ------------------------------------------------------------------ A12, F15, A1, T2

@register("ingest_quality", binding_ctes() + """
SELECT count(*) AS rows, CAST(count(*) FILTER (WHERE match_id IS NULL) AS BIGINT) AS null_keys,
  count(DISTINCT match_id) AS distinct_keys, CAST(count(*) FILTER (WHERE type='Shot') AS BIGINT) AS shots,
  4 AS columns FROM b""")
def ingest_quality(spark, sf):
    ev = _events(spark, sf, frames=False).select("match_id", "type", "id", "player_id")
    return readers.ingest_quality(ev)


@register("group_counts", binding_ctes() + "SELECT competition, count(*) AS count FROM b GROUP BY competition")
def group_counts(spark, sf):
    return readers.group_counts(_events(spark, sf, frames=False), "competition")


# ------------------------------------------------------------------ K3-K6 split writer

@register("split_by_key", binding_ctes() + """
SELECT competition, count(*) AS rows, count(DISTINCT match_id) AS matches FROM b GROUP BY competition""")
def split_by_key(spark, sf):
    ev = _events(spark, sf, frames=False).select("id", "match_id", "competition", "type", "minute")
    path = scratch_dir(spark, "split")
    write_split(ev, path, key="competition", spread="match_id")
    back = spark.read.parquet(path)
    return back.groupBy("competition").agg(F.count(F.lit(1)).alias("rows"),
                                           F.countDistinct("match_id").alias("matches"))


# ------------------------------------------------------------------ S11, S12, K1, K2 CSV

@register("csv_round_trip", binding_ctes(frames=True) + """
SELECT b.id, b.match_id, b.type, b.shot_statsbomb_xg, b.n_frame AS frame_players FROM b""")
def csv_round_trip(spark, sf):
    ev = _events(spark, sf)
    cols = ev.select("id", "match_id", "type", "shot_statsbomb_xg", "shot_freeze_frame")
    path = scratch_dir(spark, "csv")
    write_csv(cols, path, sep=";")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("match_id", T.LongType()),
                           T.StructField("type", T.StringType()), T.StructField("shot_statsbomb_xg", T.DoubleType()),
                           T.StructField("shot_freeze_frame", T.StringType())])
    back = readers.read_table(spark, path, "csv", schema=schema, sep=";")
    return with_frame(back).select("id", "match_id", "type", "shot_statsbomb_xg",
                                   F.coalesce(F.size("frame"), F.lit(0)).cast("int").alias("frame_players"))


@register("csv_comma", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders""")
def csv_comma(spark, sf):
    """Comma CSV written and read with a declared schema."""
    o = spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_orderstatus", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    path = scratch_dir(spark, "comma")
    write_csv(o, path, sep=",")
    return readers.read_table(spark, path, "csv", schema=o.schema, sep=",")


@register("persisted_counts", shots_ctes() + """
SELECT team, count(*) AS shots, (SELECT count(*) FROM shots) AS all_shots FROM shots GROUP BY team""")
def persisted_counts(spark, sf):
    """The feature table persisted, filled by the first read, read again by
    another, and released when the result is written (K8)."""
    with held(_shots(spark, sf)) as shots:
        n = shots.count()
        by_team = shots.groupBy("team").agg(F.count(F.lit(1)).alias("shots"))
        return kept(by_team.withColumn("all_shots", F.lit(n).cast("bigint")), scratch_dir(spark, "by-team"))


# ------------------------------------------------------------------ typed ingest of text frames

@register("ingest_typed_frames", shots_ctes() + """
SELECT match_id, count(*) AS shots, CAST(sum(players_inside_area) AS BIGINT) AS players_inside,
  count(players_inside_area) AS shots_with_count
FROM shots GROUP BY match_id""")
def ingest_typed_frames(spark, sf):
    """Events land as ';' CSV with text frames (S12); ingest reads them with
    the declared schema, parses the frames once into the typed column and
    writes Parquet; the feature pipeline then runs on the typed table."""
    ev = _events(spark, sf)
    base = scratch_dir(spark, "typed")
    write_csv(ev, f"{base}/csv", sep=";")
    typed = readers.read_events(spark, f"{base}/csv", ev.schema, fmt="csv", sep=";", parse_frames=True)
    typed.write.parquet(f"{base}/parquet")
    shots = shot_features(spark.read.parquet(f"{base}/parquet"))
    return shots.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("shots"), F.sum("players_inside_area").cast("bigint").alias("players_inside"),
        F.count("players_inside_area").alias("shots_with_count"))


# ------------------------------------------------------------------ streaming ingest

@register("stream_ingest", binding_ctes() + """
SELECT competition, season, count(*) AS events, CAST(count(*) FILTER (WHERE type='Shot') AS BIGINT) AS shots,
  count(DISTINCT match_id) AS matches
FROM b WHERE match_id IS NOT NULL GROUP BY competition, season""")
def stream_ingest(spark, sf):
    """Land the events as several files, ingest them with a file stream, two
    files per trigger, and summarise the sink table."""
    from pitchlake.streaming import run_ingest

    ev = _events(spark, sf, frames=False)
    base = scratch_dir(spark, "stream")
    landed = f"{base}/landed"
    ev.drop("competition", "season").repartition(5, "match_id").write.parquet(landed)
    matches = ev.filter("match_id IS NOT NULL").select("match_id", "competition", "season").distinct()
    schema = spark.read.parquet(landed).schema
    out = run_ingest(spark, landed, f"{base}/sink", f"{base}/checkpoint", schema, matches=matches,
                     files_per_trigger=2)
    return out.groupBy("competition", "season").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("type") == "Shot").cast("bigint").alias("shots"),
        F.countDistinct("match_id").alias("matches"))


# ------------------------------------------------------------------ V7, A4-A6

def _gxg_sql(keys: str) -> str:
    return shots_ctes() + f"""
SELECT {keys}, goals, xg, round(goals - xg, 5) AS g_minus_xg,
  CASE WHEN round(goals - xg, 5) < 0 THEN 'Underperformer' ELSE 'Overperformer' END AS performance
FROM (SELECT {keys}, CAST(sum(goal) AS BIGINT) AS goals, round(sum(shot_statsbomb_xg), 3) AS xg
      FROM shots GROUP BY {keys}) g
WHERE goals > 1 AND xg > 1"""


@register("goals_vs_expected_player", _gxg_sql("player, team"))
def gxg_player(spark, sf):
    return explore.goals_vs_expected(_shots(spark, sf), by="player")


@register("goals_vs_expected_team", _gxg_sql("team"))
def gxg_team(spark, sf):
    return explore.goals_vs_expected(_shots(spark, sf), by="team")


# ------------------------------------------------------------------ A7, E1-E11

_RATIOS_SQL = """
SELECT tp, tn, fp, fn,
  round(CASE WHEN tp+tn+fp+fn > 0 THEN CAST(tp+tn AS DOUBLE)/(tp+tn+fp+fn) END * 100, 2) AS accuracy,
  round(CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0e0 END * 100, 2) AS precision,
  round(CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0e0 END * 100, 2) AS recall,
  round(CASE WHEN tn+fp > 0 THEN CAST(tn AS DOUBLE)/(tn+fp) ELSE 0e0 END * 100, 2) AS specificity,
  round(CASE WHEN (CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0e0 END)
                + (CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0e0 END) > 0
        THEN 2*(CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0e0 END)
               *(CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0e0 END)
             / ((CASE WHEN tp+fp > 0 THEN CAST(tp AS DOUBLE)/(tp+fp) ELSE 0e0 END)
               +(CASE WHEN tp+fn > 0 THEN CAST(tp AS DOUBLE)/(tp+fn) ELSE 0e0 END)) ELSE 0e0 END * 100, 2) AS f1,
  round(CASE WHEN fp+tn > 0 THEN CAST(fp AS DOUBLE)/(fp+tn) ELSE 0e0 END * 100, 2) AS fpr,
  round(CASE WHEN fn+tp > 0 THEN CAST(fn AS DOUBLE)/(fn+tp) ELSE 0e0 END * 100, 2) AS fnr
FROM (SELECT CAST(count(*) FILTER (WHERE {a}=1 AND {p}=1) AS BIGINT) AS tp,
             CAST(count(*) FILTER (WHERE {a}=0 AND {p}=0) AS BIGINT) AS tn,
             CAST(count(*) FILTER (WHERE {a}=0 AND {p}=1) AS BIGINT) AS fp,
             CAST(count(*) FILTER (WHERE {a}=1 AND {p}=0) AS BIGINT) AS fn FROM {t}) c"""


@register("confusion_counts", shots_ctes() + _RATIOS_SQL.format(a="goal", p="sb_prediction", t="shots"))
def confusion_counts(spark, sf):
    """Agreement of goals with the vendor's label (E11) and all ratios."""
    return metrics.model_evaluation(_shots(spark, sf), "goal", "sb_prediction")


@register("confusion_labels", _RATIOS_SQL.format(a="quality", p="toxic", t="labels"))
def confusion_labels(spark, sf):
    """Same metrics over ``labels(quality, toxic)`` with its null rows."""
    return metrics.classification_metrics(spark.read.parquet(f"{sf}/labels.parquet"), "quality", "toxic")


@register("confusion_table", shots_ctes() + """
SELECT goal, CAST(count(*) FILTER (WHERE sb_prediction=0) AS BIGINT) AS sb_prediction_0,
  CAST(count(*) FILTER (WHERE sb_prediction=1) AS BIGINT) AS sb_prediction_1,
  CAST(0 AS BIGINT) AS sb_prediction_other, CAST(0 AS BIGINT) AS sb_prediction_null
FROM shots GROUP BY goal""")
def confusion_table(spark, sf):
    return metrics.confusion_table(_shots(spark, sf), "goal", "sb_prediction")


@register("confusion_table_open", shots_ctes() + """
SELECT goal, CAST(count(*) FILTER (WHERE players_inside_area=0) AS BIGINT) AS players_inside_area_0,
  CAST(count(*) FILTER (WHERE players_inside_area=1) AS BIGINT) AS players_inside_area_1,
  CAST(count(*) FILTER (WHERE players_inside_area NOT IN (0, 1)) AS BIGINT) AS players_inside_area_other,
  CAST(count(*) FILTER (WHERE players_inside_area IS NULL) AS BIGINT) AS players_inside_area_null
FROM shots GROUP BY goal""")
def confusion_table_open(spark, sf):
    """Values that are not listed, and nulls, are counted too."""
    return metrics.confusion_table(_shots(spark, sf), "goal", "players_inside_area")


@register("regression_metrics", shots_ctes() + """
SELECT round(sse/n, 5) AS mse, round(sqrt(sse/n), 5) AS rmse, round(sae/n, 5) AS mae,
  round(CASE WHEN va > 0 THEN 1 - sse/(va*n) END * 100, 2) AS r2
FROM (SELECT CAST(count(*) AS DOUBLE) AS n, sum((a-p)*(a-p)) AS sse, sum(abs(a-p)) AS sae, var_pop(a) AS va
      FROM (SELECT CAST(goal AS DOUBLE) AS a, shot_statsbomb_xg AS p FROM shots) x
      WHERE a IS NOT NULL AND p IS NOT NULL) s""")
def regression_metrics(spark, sf):
    """Vendor probability against the outcome (E10's metrics)."""
    return metrics.model_evaluation(_shots(spark, sf), "goal", "shot_statsbomb_xg", "regression")


# ------------------------------------------------------------------ V3 A9, V4 A10, V1 A11

@register("error_histogram", shots_ctes() + """,
e AS (SELECT round(abs(goal - shot_statsbomb_xg), 5) AS e FROM shots WHERE shot_statsbomb_xg IS NOT NULL),
st AS (SELECT min(e) AS lo, (max(e) - min(e)) / 20 AS w FROM e),
c AS (SELECT CASE WHEN st.w > 0 THEN least(19, CAST(floor((e.e - st.lo) / st.w) AS INT)) ELSE 0 END AS bin, count(*) AS n
      FROM e, st GROUP BY 1)
SELECT g.bin, round(st.lo + g.bin*st.w, 6) AS bin_start, round(st.lo + (g.bin+1)*st.w, 6) AS bin_end,
  CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT CAST(range AS INT) AS bin FROM range(0, 20)) g CROSS JOIN st LEFT JOIN c ON c.bin = g.bin""")
def error_histogram(spark, sf):
    return explore.error_histogram(_shots(spark, sf), "goal", "shot_statsbomb_xg", bins=20)


@register("goal_heatmap", shots_ctes() + """,
c AS (SELECT CAST(least(49, floor(shot_location_x / (120e0/50))) AS INT) AS x_bin,
             CAST(least(49, floor(shot_location_y / (80e0/50))) AS INT) AS y_bin, count(*) AS n
      FROM shots WHERE goal = 1 AND shot_location_x BETWEEN 0 AND 120 AND shot_location_y BETWEEN 0 AND 80 GROUP BY 1, 2)
SELECT CAST(g.i // 50 AS INT) AS x_bin, CAST(g.i % 50 AS INT) AS y_bin, CAST(coalesce(c.n, 0) AS BIGINT) AS goals
FROM (SELECT range AS i FROM range(0, 2500)) g LEFT JOIN c ON c.x_bin = g.i // 50 AND c.y_bin = g.i % 50""")
def goal_heatmap(spark, sf):
    return explore.goal_heatmap(_shots(spark, sf))


_CORR_FEATURES = [*FEATURES, "shot_statsbomb_xg", "goal"]


def _corr_sql() -> str:
    n = len(_CORR_FEATURES)
    pairs = [(i, j) for i in range(n) for j in range(i + 1, n)]
    aggs = ", ".join(f"round(corr({_CORR_FEATURES[i]}, {_CORR_FEATURES[j]}), 6) AS p{i}_{j}" for i, j in pairs)
    cells = ", ".join(
        f"{{'col_a': '{a}', 'col_b': '{b}', 'r': " + ("1e0" if i == j else f"p{min(i, j)}_{max(i, j)}") + "}"
        for i, a in enumerate(_CORR_FEATURES) for j, b in enumerate(_CORR_FEATURES))
    return shots_ctes() + f""",
known AS (SELECT *, coalesce(players_inside_area, 0) AS pia FROM shots WHERE distance_to_goal IS NOT NULL),
one AS (SELECT {aggs.replace("players_inside_area", "pia")} FROM known)
SELECT u.col_a, u.col_b, CASE WHEN isnan(u.r) THEN NULL ELSE u.r END AS r FROM (SELECT unnest([{cells}]) AS u FROM one)"""


@register("correlation_pairs", _corr_sql())
def correlation_pairs(spark, sf):
    """All model inputs and both targets, over the shots whose point parses."""
    known = _shots(spark, sf, missing_frame="zero").filter("distance_to_goal IS NOT NULL")
    return explore.correlation_pairs(known)


# ------------------------------------------------------------------ V5 F11-F13

@register("value_bands", shots_ctes() + """
SELECT s.id, s.shot_statsbomb_xg, bd.band, bd.label AS band_label
FROM shots s JOIN (VALUES (0, 0.0e0, 0.25e0, '0.00 - 0.25'), (1, 0.25e0, 0.5e0, '0.25 - 0.50'),
                          (2, 0.5e0, 0.75e0, '0.50 - 0.75'), (3, 0.75e0, 1.0e0, '0.75 - 1.00')) bd(band, lo, hi, label)
  ON s.shot_statsbomb_xg >= bd.lo AND s.shot_statsbomb_xg <= bd.hi""")
def value_bands(spark, sf):
    s = _shots(spark, sf).select("id", "shot_statsbomb_xg")
    return explore.value_bands(s)


@register("entity_shots", shots_ctes() + """
SELECT id, player, player_id, match_id, team, shot_location_x, shot_location_y, shot_end_location,
  shot_statsbomb_xg, sb_prediction, goal, goal AS band
FROM shots WHERE team = 'home'""")
def entity_shots(spark, sf):
    cols = ["id", "player", "player_id", "match_id", "team", "shot_location_x", "shot_location_y",
            "shot_end_location", "shot_statsbomb_xg", "sb_prediction", "goal"]
    s = explore.entity_filter(_shots(spark, sf), team="home")
    return explore.shot_distribution(s, cols, val="goal", t="goal")


def _entity_query(name: str, sql: str, **kw):
    @register(name, shots_ctes() + f"SELECT id, team_id, match_id, player_id FROM shots WHERE {sql}")
    def q(spark, sf):
        return explore.entity_filter(_shots(spark, sf), **kw).select("id", "team_id", "match_id", "player_id")
    return q


_entity_query("team_shots", "team_id = 1", team_id=1)
_entity_query("match_shots", "match_id = 3", match_id=3)

@register("player_shots", shots_ctes() + """
SELECT id, team_id, match_id, player_id FROM shots WHERE player_id = 7""")
def player_shots(spark, sf):
    return explore.entity_filter(_shots(spark, sf), player_id=7).select("id", "team_id", "match_id", "player_id")


@register("one_shot_picture", shots_ctes() + """
SELECT s.id, fr.px AS x, fr.py AS y FROM shots s JOIN fr ON fr.id = s.id WHERE s.id = 9""")
def one_shot_picture(spark, sf):
    """Point lookup of a single shot."""
    return explore.shot_picture(_shots(spark, sf, keep_frame=True), shot_id=9).select("id", "x", "y")


@register("shot_picture", shots_ctes() + """
SELECT s.id, s.shot_location_x, s.shot_location_y, s.shot_end_x, s.shot_end_y,
  CASE WHEN s.goal = 1 THEN 'goal' ELSE 'no_goal' END AS shot_class, round(s.shot_statsbomb_xg, 2) AS xg,
  s.distance_to_goal, s.shot_angle, s.players_inside_area, s.shot_outcome,
  fr.px AS x, fr.py AS y, CASE WHEN fr.j=0 THEN 'Goalkeeper' ELSE 'Center Back' END AS position,
  CASE WHEN fr.teammate THEN 'teammate' ELSE 'opponent' END AS side
FROM shots s JOIN fr ON fr.id = s.id""")
def shot_picture(spark, sf):
    return explore.shot_picture(_shots(spark, sf, keep_frame=True))


@register("random_shots", shots_ctes(one_per_shot=True) + """
SELECT * FROM shots ORDER BY md5(CAST(id AS VARCHAR) || ':7'), id LIMIT 25""")
def random_shots(spark, sf):
    return explore.random_rows(_shots(spark, sf, one_per_shot=True), 25, seed=7)


@register("random_match", shots_ctes() + """
SELECT * FROM shots WHERE match_id = (SELECT match_id FROM shots WHERE match_id IS NOT NULL
  ORDER BY md5(CAST(id AS VARCHAR) || ':7'), id LIMIT 1)""")
def random_match(spark, sf):
    return explore.random_match(_shots(spark, sf), seed=7)


_PLACE = "('0x' || substr(md5(CAST(id AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT"


@register("sampled_shots", shots_ctes(one_per_shot=True) + f"SELECT * FROM shots WHERE {_PLACE.format(seed=11)} < {int(0.15 * 2**32)}")
def sampled_shots(spark, sf):
    """A share of the rows by a threshold on the key's hash."""
    return explore.sample_fraction(_shots(spark, sf, one_per_shot=True), 0.15, seed=11)


_TEAM_SHARES = {"home": 0.5, "away": 0.05}


@register("sampled_by_team", shots_ctes(one_per_shot=True) + f"""
SELECT id, team FROM shots WHERE {_PLACE.format(seed=5)} < CASE team WHEN 'home' THEN {int(0.5 * 2**32)} WHEN 'away' THEN {int(0.05 * 2**32)} END""")
def sampled_by_team(spark, sf):
    """A share for each stratum."""
    return explore.sample_fraction(_shots(spark, sf, one_per_shot=True), _TEAM_SHARES, seed=5, by="team").select("id", "team")


@register("random_match_uniform", shots_ctes() + """
SELECT * FROM shots WHERE match_id = (SELECT match_id FROM shots WHERE match_id IS NOT NULL
  ORDER BY md5(CAST(match_id AS VARCHAR) || ':3'), match_id LIMIT 1)""")
def random_match_uniform(spark, sf):
    """The draw in which every match has the same chance (T4)."""
    return explore.random_match(_shots(spark, sf), seed=3, weighted=False)


# ------------------------------------------------------------------ timelines

@register("running_total", shots_ctes() + """
SELECT match_id, team, minute, second, id, shot_statsbomb_xg,
  round(sum(shot_statsbomb_xg) OVER (PARTITION BY match_id, team ORDER BY minute, second, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cxg
FROM shots""")
def running_total(spark, sf):
    s = _shots(spark, sf).select("match_id", "team", "minute", "second", "id", "shot_statsbomb_xg")
    return timeline.running_total(s)


@register("running_total_pair", shots_ctes() + """
SELECT match_id, team, minute, second, id, shot_statsbomb_xg, goal,
  round(sum(shot_statsbomb_xg) OVER w, 6) AS sb_cxg, CAST(sum(goal) OVER w AS BIGINT) AS cgoals
FROM shots WINDOW w AS (PARTITION BY match_id, team ORDER BY minute, second, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def running_total_pair(spark, sf):
    s = _shots(spark, sf).select("match_id", "team", "minute", "second", "id", "shot_statsbomb_xg", "goal")
    out = timeline.running_total(s, ("shot_statsbomb_xg", "goal"), ("sb_cxg", "cgoals"))
    return out.withColumn("cgoals", F.col("cgoals").cast("bigint"))


@register("tick_grid_timeline", shots_ctes() + """,
t AS (SELECT match_id, team, minute, second, id, shot_statsbomb_xg, goal FROM shots WHERE team IS NOT NULL AND match_id IS NOT NULL),
ends AS (SELECT DISTINCT match_id, team,
           CASE WHEN max(minute) OVER (PARTITION BY match_id) < 90 THEN 90 ELSE max(minute) OVER (PARTITION BY match_id) END AS last
         FROM t),
grid AS (SELECT ends.match_id, ends.team, CAST(g.i // 60 AS INT) AS minute, CAST(g.i % 60 AS INT) AS second
         FROM ends, unnest(range(0, (ends.last + 1) * 60)) AS g(i)),
j AS (SELECT grid.match_id, grid.team, grid.minute, grid.second, t.id, t.shot_statsbomb_xg, t.goal
      FROM grid LEFT JOIN t ON grid.match_id = t.match_id AND grid.team = t.team
        AND grid.minute = t.minute AND grid.second = t.second)
SELECT match_id, team, minute, second, id, shot_statsbomb_xg, CAST(coalesce(goal, 0) AS INT) AS goal,
  round(coalesce(sum(shot_statsbomb_xg) OVER (PARTITION BY match_id, team ORDER BY minute, second, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0e0), 6) AS cxg,
  minute + round(second / 60e0, 2) AS time
FROM j""")
def tick_grid_timeline(spark, sf):
    return timeline.tick_grid_timeline(_shots(spark, sf))


@register("tick_grid_pair", shots_ctes() + """,
t AS (SELECT match_id, team, minute, second, id, shot_statsbomb_xg, CAST(goal AS DOUBLE) AS goal_value, goal
      FROM shots WHERE team IS NOT NULL AND match_id IS NOT NULL),
ends AS (SELECT DISTINCT match_id, team,
           CASE WHEN max(minute) OVER (PARTITION BY match_id) < 90 THEN 91
                ELSE max(minute) OVER (PARTITION BY match_id) + 1 END AS last
         FROM t),
grid AS (SELECT ends.match_id, ends.team, CAST(g.i // 60 AS INT) AS minute, CAST(g.i % 60 AS INT) AS second
         FROM ends, unnest(range(0, (ends.last + 1) * 60)) AS g(i)),
j AS (SELECT grid.match_id, grid.team, grid.minute, grid.second, t.id, t.shot_statsbomb_xg, t.goal_value, t.goal
      FROM grid LEFT JOIN t ON grid.match_id = t.match_id AND grid.team = t.team
        AND grid.minute = t.minute AND grid.second = t.second)
SELECT match_id, team, minute, second, id, shot_statsbomb_xg, goal_value, CAST(coalesce(goal, 0) AS INT) AS goal,
  round(coalesce(sum(shot_statsbomb_xg) OVER w, 0e0), 6) AS sb_cxg,
  round(coalesce(sum(goal_value) OVER w, 0e0), 6) AS cgoals,
  minute + round(second / 60e0, 2) AS time
FROM j WINDOW w AS (PARTITION BY match_id, team ORDER BY minute, second, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def tick_grid_pair(spark, sf):
    """Two cumulative series on one grid (V9: vendor xG against a second
    per-shot value, here the goals), grid to minute 91 or last + 1."""
    s = _shots(spark, sf).withColumn("goal_value", F.col("goal").cast("double"))
    return timeline.tick_grid_timeline(s, ("shot_statsbomb_xg", "goal_value"), ("sb_cxg", "cgoals"), pad=2)


@register("tick_grid_by_period", shots_ctes() + """,
t AS (SELECT match_id, team, period, minute, second, id, shot_statsbomb_xg, goal FROM shots WHERE team IS NOT NULL AND match_id IS NOT NULL),
mp AS (SELECT match_id, period, min(minute) AS mn, max(minute) AS mx FROM t GROUP BY match_id, period),
seg AS (SELECT match_id, period,
          CASE WHEN period = min(period) OVER (PARTITION BY match_id) THEN 0 ELSE mn * 60 END AS a,
          (CASE WHEN period = max(period) OVER (PARTITION BY match_id)
                THEN CASE WHEN mx < 90 THEN 90 ELSE mx END ELSE mx END + 1) * 60 AS stop
        FROM mp),
teams AS (SELECT DISTINCT match_id, team FROM t),
ts AS (SELECT teams.match_id, teams.team, seg.period, seg.a, seg.stop FROM teams JOIN seg ON teams.match_id = seg.match_id),
grid AS (SELECT ts.match_id, ts.team, ts.period, CAST(g.i // 60 AS INT) AS minute, CAST(g.i % 60 AS INT) AS second
         FROM ts, unnest(range(ts.a, ts.stop)) AS g(i)),
j AS (SELECT grid.match_id, grid.team, grid.period, grid.minute, grid.second, t.id, t.shot_statsbomb_xg, t.goal
      FROM grid LEFT JOIN t ON grid.match_id = t.match_id AND grid.team = t.team AND grid.period = t.period
        AND grid.minute = t.minute AND grid.second = t.second)
SELECT match_id, team, period, minute, second, id, shot_statsbomb_xg, CAST(coalesce(goal, 0) AS INT) AS goal,
  round(coalesce(sum(shot_statsbomb_xg) OVER (PARTITION BY match_id, team ORDER BY period, minute, second, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0e0), 6) AS cxg,
  minute + round(second / 60e0, 2) AS time
FROM j""")
def tick_grid_by_period(spark, sf):
    """Tick grid with periods kept apart (D6 ``by_period``)."""
    return timeline.tick_grid_timeline(_shots(spark, sf), by_period=True)


@register("timeline_in_order", shots_ctes(one_per_shot=True) + """
SELECT match_id, team, id, round(sum(shot_statsbomb_xg) OVER (PARTITION BY match_id, team ORDER BY minute, second, id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cxg,
  row_number() OVER (ORDER BY match_id NULLS FIRST, team NULLS FIRST, minute, second, id) AS position
FROM shots""")
def timeline_in_order(spark, sf):
    """The ordered timeline (T5), its place read off the sorted partitions:
    position within the partition plus the rows of earlier ones."""
    s = _shots(spark, sf, one_per_shot=True).select("match_id", "team", "minute", "second", "id", "shot_statsbomb_xg")
    path = scratch_dir(spark, "ordered")
    ordered = timeline.in_clock_order(timeline.running_total(s))
    ordered.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    before = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).select(
        "_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("before"))  # a row per partition
    return rows.join(before, "_p").select(
        "match_id", "team", "id", "cxg", (F.col("before") + F.col("_i").bitwiseAND((1 << 33) - 1) + 1).alias("position"))


@register("timeline_extent", shots_ctes() + """
SELECT match_id, max(minute) AS last_minute, count(DISTINCT team) AS teams, greatest(1e0, max(cxg)) AS y_max
FROM (SELECT match_id, team, minute, round(sum(shot_statsbomb_xg) OVER (PARTITION BY match_id, team
        ORDER BY minute, second, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cxg FROM shots) r
GROUP BY match_id""")
def timeline_extent(spark, sf):
    s = _shots(spark, sf).select("match_id", "team", "minute", "second", "id", "shot_statsbomb_xg")
    return timeline.timeline_extent(timeline.running_total(s))


@register("stoppage_time", binding_ctes() + """
SELECT match_id, minute AS last_minute, second AS last_second, round(minute + second/60e0 - 45, 2) AS stoppage
FROM (SELECT match_id, minute, second, row_number() OVER (PARTITION BY match_id ORDER BY minute DESC, second DESC, id DESC) AS rn
      FROM b WHERE period = 1) x WHERE rn = 1""")
def stoppage_time(spark, sf):
    return timeline.stoppage_time(_events(spark, sf, frames=False))


@register("match_clock", binding_ctes() + """
SELECT id, period, minute, CASE WHEN period = 2 THEN minute + 100 ELSE minute END AS match_minute FROM b""")
def match_clock(spark, sf):
    ev = _events(spark, sf, frames=False).select("id", "period", "minute")
    return timeline.with_match_clock(ev)


# ------------------------------------------------------------------ M2 splits

_SIDE_SQL = "CASE WHEN ('0x' || substr(md5(CAST(id AS VARCHAR) || ':42'), 1, 8))::BIGINT % 10000 < 8000 THEN 'train' ELSE 'test' END"


@register("hash_split", shots_ctes() + f"SELECT id, goal, {_SIDE_SQL} AS side FROM shots")
def hash_split(spark, sf):
    return ml.with_side(_shots(spark, sf).select("id", "goal"))


@register("hash_split_sides", shots_ctes() + f"SELECT {_SIDE_SQL} AS side, count(*) AS rows FROM shots GROUP BY 1")
def hash_split_sides(spark, sf):
    """The two frames of the split, from one written table."""
    path = scratch_dir(spark, "split-sides")
    _shots(spark, sf).select("id", "goal").write.parquet(path)
    train, test = ml.hash_split(spark.read.parquet(path))
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test"))) \
        .groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


@register("random_split", shots_ctes(one_per_shot=True) + """
SELECT count(*) AS rows, true AS disjoint, true AS share_near FROM shots""")
def random_split(spark, sf):
    """The published split: the sides cover all rows, share none and have
    about the asked size."""
    shots = kept(_shots(spark, sf, one_per_shot=True).select("id"), scratch_dir(spark, "split-rows"))
    train, test = ml.random_split(shots)
    both = train.withColumn("s", F.lit(1)).unionByName(test.withColumn("s", F.lit(0)))
    return both.agg(F.count(F.lit(1)).alias("rows"), (F.countDistinct("id") == F.count(F.lit(1))).alias("disjoint"),
                    F.avg("s").between(0.7, 0.9).alias("share_near"))


# ------------------------------------------------------------------ M1-M13, E12

def _model_shots(spark, sf) -> DataFrame:
    """The feature table that all model queries read: written once, so that
    training and scoring do not run the pipeline again; shots whose point
    does not parse have no geometry to learn from."""
    path = scratch_dir(spark, "features")
    shots = _shots(spark, sf, missing_frame="zero", one_per_shot=True).filter("distance_to_goal IS NOT NULL")
    ml.with_side(shots).write.parquet(path)
    return spark.read.parquet(path)


def _sides(shots: DataFrame):
    return [shots.filter(F.col("side") == s).drop("side") for s in ("train", "test")]


# held-out AUC that a model must beat: the planted signal falls with distance
_AUC_FLOOR = {"logistic": 0.6, "rf": 0.6, "mlp": 0.55, "gbt": 0.55, "dt": 0.55, "svm": 0.6, "nb": 0.55}


def _checked_sql(model: str) -> str:
    return shots_ctes(one_per_shot=True) + f"""
SELECT id, goal, true AS in_range, true AS agrees, '{model}' AS model, true AS beats_floor
FROM shots WHERE distance_to_goal IS NOT NULL AND {_SIDE_SQL} = 'test'"""


def _checked(preds: DataFrame, model_type: str) -> DataFrame:
    """id and label of each held-out shot, with what must hold of its
    prediction: a probability in [0, 1] (any margin for the linear SVM) and a
    label on its side of the threshold; and AUC above the model's floor."""
    p = F.col("xG") if "xG" in preds.columns else None
    in_range = p.between(0, 1) if p is not None else ~F.isnan(ml.vector_to_array("rawPrediction")[1])
    above = (p >= 0.5) if p is not None else ml.vector_to_array("rawPrediction")[1] > 0
    agrees = ((F.col("prediction") == 1) == above) | (F.abs(p - 0.5) < 1e-9 if p is not None else F.lit(False))
    auc = metrics.auc_roc(preds, "goal")
    return preds.select("id", "goal", in_range.alias("in_range"), agrees.alias("agrees"), F.lit(model_type).alias("model"),
                        F.lit(bool(auc > _AUC_FLOOR[model_type])).alias("beats_floor"))


@register("train_logistic", _checked_sql("logistic"))
def train_logistic(spark, sf):
    """Logistic model; the predictions (vectors included) are written as
    Parquet in the shared folder and read back, as the published notebook
    did with CSV (K7, S14)."""
    train, test = _sides(_model_shots(spark, sf))
    preds = ml.score(ml.train(train, "logistic"), test)
    path = scratch_dir(spark, "predictions")
    write_parquet(preds.select("id", "goal", "shot_statsbomb_xg", "rawPrediction", "probability",
                               "prediction", "xG"), path)
    return _checked(spark.read.parquet(path), "logistic")


def _model_query(model_type, features=None, **kw):
    @register(f"train_{model_type}", _checked_sql(model_type))
    def q(spark, sf):
        train, test = _sides(_model_shots(spark, sf))
        return _checked(ml.score(ml.train(train, model_type, features=features, **kw), test), model_type)
    q.__name__ = f"train_{model_type}"
    return q


_model_query("rf", seed=42)
_model_query("mlp", layers=[len(FEATURES), 8, 2])
_model_query("gbt", seed=42)
_model_query("dt", seed=42)
_model_query("svm")
_model_query("nb", features=FEATURES_NP)


@register("feature_importance", "SELECT feature, true AS finite, true AS in_order FROM (VALUES "
          + ", ".join(f"('{f}')" for f in FEATURES) + ") v(feature)")
def feature_importance(spark, sf):
    """Each model input once, with a finite value, largest first."""
    train, _ = _sides(_model_shots(spark, sf))
    got = ml.feature_importance(ml.train(train, "logistic"), spark).collect()  # one value per model input
    values = [r.importance for r in got]
    rows = [(r.feature, abs(r.importance) < float("inf"), i == 0 or values[i - 1] >= r.importance) for i, r in enumerate(got)]
    return spark.createDataFrame(rows, "feature string, finite boolean, in_order boolean")


_TRAIN_SQL = shots_ctes(one_per_shot=True) + f""",
t AS (SELECT *, coalesce(players_inside_area, 0) AS pia, {_SIDE_SQL} AS side FROM shots WHERE distance_to_goal IS NOT NULL)"""


def _inputs(features) -> str:
    return ", ".join(f"CAST({'pia' if f == 'players_inside_area' else f} AS DOUBLE) AS {f}" for f in features)


@register("logistic_moments", _TRAIN_SQL + f""",
x AS (SELECT goal, CAST(1 AS DOUBLE) AS "1", {_inputs(FEATURES)} FROM t WHERE side = 'train'),
l AS (UNPIVOT x ON "1", {", ".join(FEATURES)} INTO NAME feature VALUE v)
SELECT feature, round(avg(goal * v), 6) AS observed, true AS fits FROM l GROUP BY feature""")
def logistic_moments(spark, sf):
    """The gradient of the fitted likelihood vanishes (M3): each feature's mean
    over the goals, and that the model gives the same."""
    train, _ = _sides(_model_shots(spark, sf))
    fitted = ml.score(ml.train(train, "logistic"), train)
    return ml.moment_check(fitted, FEATURES).select("feature", F.round("observed", 6).alias("observed"), F.col("holds").alias("fits"))


def _nb_sql(where: str) -> str:
    """Class priors and feature probabilities of a multinomial naive Bayes fit
    with Laplace smoothing, by counting."""
    return f""",
x AS (SELECT goal AS label, {_inputs(FEATURES_NP)} FROM t WHERE {where}),
l AS (UNPIVOT x ON {", ".join(FEATURES_NP)} INTO NAME feature VALUE v),
f AS (SELECT label, feature, sum(v) AS s FROM l GROUP BY label, feature),
nb AS (SELECT label, feature, ln((s + 1) / (sum(s) OVER (PARTITION BY label) + {len(FEATURES_NP)})) AS lp FROM f),
pr AS (SELECT label, ln((count(*) + 1e0) / (sum(count(*)) OVER () + 2e0)) AS lp FROM x GROUP BY label)"""


@register("naive_bayes_table", _TRAIN_SQL + _nb_sql("side = 'train'") + """
SELECT label, feature, round(lp, 6) AS log_probability FROM nb
UNION ALL SELECT label, '1', round(lp, 6) FROM pr""")
def naive_bayes_table(spark, sf):
    """Every fitted probability of the naive Bayes model against plain counts (M9)."""
    train, _ = _sides(_model_shots(spark, sf))
    return ml.naive_bayes_table(ml.train(train, "nb", features=FEATURES_NP), spark).select(
        "label", "feature", F.round("log_probability", 6).alias("log_probability"))


@register("model_metrics", _TRAIN_SQL + _nb_sql("side = 'train'") + f""",
q AS (SELECT id, goal AS label, {_inputs(FEATURES_NP)} FROM t WHERE side = 'test'),
ql AS (UNPIVOT q ON {", ".join(FEATURES_NP)} INTO NAME feature VALUE v),
sc AS (SELECT ql.id, ql.label, nb.label AS k, sum(ql.v * nb.lp) + any_value(pr.lp) AS score
       FROM ql JOIN nb ON nb.feature = ql.feature JOIN pr ON pr.label = nb.label GROUP BY ql.id, ql.label, nb.label),
pd AS (SELECT id, label, arg_max(k, score) AS prediction FROM sc GROUP BY id, label)
""" + _RATIOS_SQL.format(a="label", p="prediction", t="pd"))
def model_metrics(spark, sf):
    """All metrics of a trained model's held-out predictions (E1-E8): naive
    Bayes, as SQL can score it too."""
    train, test = _sides(_model_shots(spark, sf))
    return metrics.model_evaluation(ml.score(ml.train(train, "nb", features=FEATURES_NP), test), "goal", "prediction")


@register("tree_leaves", _TRAIN_SQL + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(sum(goal) AS BIGINT) AS goals, true AS holds, true AS several FROM t WHERE side = 'train'""")
def tree_leaves(spark, sf):
    """Each leaf of the fitted tree predicts its share of goals (M7)."""
    train, _ = _sides(_model_shots(spark, sf))
    leaves = ml.leaf_check(ml.score(ml.train(train, "dt", seed=42), train))
    return leaves.agg(F.sum("rows").alias("rows"), F.round(F.sum(F.col("rows") * F.col("probability"))).cast("bigint").alias("goals"),
                      F.min("holds").alias("holds"), (F.count(F.lit(1)) > 2).alias("several"))


def _auc_sql(name: str, score: str) -> str:
    """The share of (goal, no goal) pairs in the right order, ties half, by ranks."""
    return f"""SELECT '{name}' AS score, round((sum(r) FILTER (WHERE goal = 1) - p * (p + 1) / 2e0) / (p * n), 9) AS auc, p AS positives, n AS negatives
FROM (SELECT goal, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2e0 AS r,
        count(*) FILTER (WHERE goal = 1) OVER () AS p, count(*) FILTER (WHERE goal = 0) OVER () AS n
      FROM (SELECT goal, {score} AS s FROM shots) WHERE s IS NOT NULL AND goal IS NOT NULL) GROUP BY p, n"""


@register("auc_values", shots_ctes() + _auc_sql("vendor", "shot_statsbomb_xg") + " UNION ALL " + _auc_sql("nearness", "-distance_to_goal"))
def auc_values(spark, sf):
    """The AUC of two scores as rows."""
    shots = _shots(spark, sf).withColumn("nearness", -F.col("distance_to_goal"))
    parts = [metrics.auc_rank(shots, "goal", c).select(F.lit(name).alias("score"), F.round("auc", 9).alias("auc"), "positives", "negatives")
             for name, c in (("vendor", "shot_statsbomb_xg"), ("nearness", "nearness"))]
    return parts[0].unionByName(parts[1])


@register("auc_roc", "SELECT 'logistic' AS model, true AS beats_floor, true AS beats_shuffled, true AS equals_rank_sum")
def auc_roc(spark, sf):
    """AUC of the held-out predictions: above the floor, and above that of
    scores dealt by a hash (which carry no signal)."""
    train, test = _sides(_model_shots(spark, sf))
    preds = ml.score(ml.train(train, "logistic"), test)
    auc = metrics.auc_roc(preds, "goal")
    noise = preds.withColumn("noise", ml.hash_bucket("id", 1).cast("double"))
    exact = metrics.auc_rank(preds).first().auc  # the evaluator puts the scores into bins
    return spark.createDataFrame([("logistic", auc > _AUC_FLOOR["logistic"], auc > metrics.auc_roc(noise, "goal", "noise"), abs(auc - exact) < 1e-3)],
                                 "model string, beats_floor boolean, beats_shuffled boolean, equals_rank_sum boolean")
