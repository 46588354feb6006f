"""Golden rows for the feature stages (FIXTURES §2) and plan checks."""

import pytest
from pyspark.sql import functions as F

from pitchlake.functions.encode import pass_height_code, preferred_foot, vendor_label
from pitchlake.operators.assists import assisting_passes, attach_assist
from pitchlake.operators.encode import bool_to_int, create_dummies
from pitchlake.operators.players import attach_preferred_foot, preferred_foot_table
from pitchlake.plans.pipeline import shot_features
from pitchlake.schemas import VARIABLES
from pitchlake.binding import events_view

EV_SCHEMA = ("id long, type string, player_id long, pass_body_part string, shot_body_part string, "
             "pass_assisted_shot_id long")


def test_preferred_foot_thresholds(spark):
    df = spark.createDataFrame([(2, 1), (33, 17), (1, 1), (0, 3)], "l long, r long")
    got = [r.f for r in df.select(preferred_foot("l", "r").alias("f")).collect()]
    assert got == ["Left Foot", "Left Foot", "Two-Footed", "Right Foot"]


def test_preferred_foot_join(spark):
    rows = [
        (1, "Pass", 10, "Left Foot", None, 100), (2, "Pass", 10, "Left Foot", None, 101),
        (3, "Shot", 10, None, "Right Foot", None),
        (4, "Shot", 11, None, "Head", None),
        (5, "Pass", 12, "Left Foot", None, 100), (6, "Shot", 12, None, "Right Foot", None),
        (7, "Shot", 12, None, "Head", None),
    ]
    ev = spark.createDataFrame(rows, EV_SCHEMA)
    feet = {r.player_id: r.preferred_foot for r in preferred_foot_table(ev).collect()}
    assert feet == {10: "Left Foot", 12: "Two-Footed"}  # 11 has headers only -> no row
    shots = attach_preferred_foot(ev.filter("type = 'Shot'"), preferred_foot_table(ev))
    flags = {r.id: r.preferred_foot_shot for r in shots.collect()}
    assert flags[3] is False and flags[4] is None and flags[6] is True and flags[7] is False


def test_assist_defaults_and_fanout(spark):
    cols = ("id long, type string, pass_assisted_shot_id long, pass_height string, "
            "pass_length double, pass_angle double")
    rows = [(1, "Shot", None, None, None, None), (2, "Shot", None, None, None, None),
            (3, "Shot", None, None, None, None),
            (10, "Pass", 2, "Low Pass", 12.0, 0.5),
            (11, "Pass", 3, None, 5.0, 1.0), (12, "Pass", 3, "Ground Pass", 7.0, 2.0)]
    ev = spark.createDataFrame(rows, cols).withColumns(
        {"period": F.lit(1), "minute": F.col("id").cast("int"), "second": F.lit(0)})
    for c in ["pass_aerial_won", "pass_cross", "pass_cut_back", "pass_switch", "pass_through_ball",
              "pass_inswinging", "pass_outswinging", "pass_straight", "pass_no_touch"]:
        ev = ev.withColumn(c, F.lit(None).cast("boolean"))
    shots = ev.filter("type = 'Shot'")
    out = attach_assist(shots, assisting_passes(ev)).orderBy("id", "pass_height").collect()
    assert [(r.id, r.assisted, r.pass_height, r.pass_angle, r.pass_length) for r in out] == [
        (1, 0, -1, 4.0, 0.0), (2, 1, 1, 0.5, 12.0), (3, 1, 0, 2.0, 7.0), (3, 1, 2, 1.0, 5.0)]
    latest = attach_assist(shots, assisting_passes(ev, one_per_shot=True)).filter("id = 3").collect()
    assert len(latest) == 1 and latest[0].pass_length == 7.0


def test_encoding(spark):
    df = spark.createDataFrame(
        [("Penalty", "Regular Play", "Normal", "Goal", "Head", None, None, 0.5),
         ("Open Play", "From Corner", "Volley", "Saved", "Left Foot", True, True, 0.49)],
        "shot_type string, play_pattern string, shot_technique string, shot_outcome string, "
        "shot_body_part string, under_pressure boolean, shot_one_on_one boolean, xg double")
    out = bool_to_int(create_dummies(df), ["under_pressure", "shot_one_on_one", "goal"]) \
        .withColumn("sb", vendor_label("xg")).collect()
    a, b = out
    assert (a.pk_type, a.from_rp, a.header, a.goal, a.under_pressure, a.shot_one_on_one, a.sb) == (1, 1, 1, 1, 0, 1, 1)
    assert (b.pk_type, b.from_corner, b.volley_technique, b.goal, b.under_pressure, b.sb) == (0, 1, 1, 0, 1, 0)
    assert "play_pattern" not in df.select("*").transform(create_dummies).columns


def test_pass_height_code(spark):
    df = spark.createDataFrame([("Ground Pass",), ("Low Pass",), ("High Pass",), (None,)], "h string")
    assert [r.c for r in df.select(pass_height_code("h").alias("c")).collect()] == [0, 1, 2, 2]


@pytest.fixture(scope="module")
def small_features(spark):
    return shot_features(events_view(spark, "/root/testdata/sf0.001"))


def test_pipeline_columns_and_plan(small_features):
    assert small_features.columns == VARIABLES + ["team_id"]
    plan = small_features._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert small_features.count() > 0


def test_pipeline_metamorphic(spark, small_features):
    rows = small_features.select("shot_angle", "players_inside_area", "pk_type", "shot_one_on_one").collect()
    assert all(0 <= r.shot_angle <= 180 for r in rows if r.shot_angle is not None)
    assert any(r.shot_angle is None for r in rows)  # points that do not parse
    assert all(r.players_inside_area == 1 for r in rows if r.pk_type == 1)
    assert all(r.shot_one_on_one == 1 for r in rows if r.pk_type == 1)
    # repartitioning the input does not change the result
    ev = events_view(spark, "/root/testdata/sf0.001").repartition(7)
    a = sorted(map(str, shot_features(ev).select("id", "distance_to_goal", "assisted").collect()))
    b = sorted(map(str, small_features.select("id", "distance_to_goal", "assisted").collect()))
    assert a == b


def test_frames_parsed_at_ingest_give_same_features(spark, small_features):
    from pitchlake.functions.frames import parse_frame

    ev = events_view(spark, "/root/testdata/sf0.001")
    typed = ev.withColumn("frame", parse_frame("shot_freeze_frame")).drop("shot_freeze_frame")
    a = sorted(map(str, shot_features(typed).select("id", "players_inside_area", "assisted").collect()))
    b = sorted(map(str, small_features.select("id", "players_inside_area", "assisted").collect()))
    assert a == b


def test_season_filter_and_pruning_reach_the_scan(spark):
    from pitchlake.session import scratch_dir

    path = scratch_dir(spark, "t-landed-events")
    events_view(spark, "/root/testdata/sf0.001").write.partitionBy("season").parquet(path)
    df = shot_features(spark.read.parquet(path), season="2015/2016")
    plan = df._jdf.queryExecution().executedPlan().toString()
    # partition pruning on season, and the 120-odd landed columns are not all read
    assert "PartitionFilters: [isnotnull(season" in plan and "2015/2016" in plan
    assert "props" not in plan and "n_frame" not in plan.split("ReadSchema")[1][:400]
    assert df.count() > 0
