"""Golden rows for X1-X4, X8-X10 (FIXTURES §2)."""

import math

import pytest
from pyspark.sql import functions as F

from pitchlake.functions import (distance_to_goal, parse_frame, parse_point,
                                 players_in_triangle, shot_angle)

GEOMETRY = [
    ("[108, 40]", 12.0, 36.869898),
    ("[109, 38]", 11.18, 38.915306),
    ("[100.5, 55.2]", 24.72, 14.684563),
    ("[60, 0]", 72.11, 5.290081),
    ("[120, 36]", 4.0, 0.0),
    ("[120, 40]", 0.0, 180.0),
    ("[120, 30]", 10.0, 0.0),
]


def test_distance_and_angle(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in GEOMETRY] + [(None,), ("junk",), ("[1]",)], "location string")
    p = parse_point("location")
    out = df.select("location", distance_to_goal(F.get(p, 0), F.get(p, 1)).alias("d"),
                    shot_angle(F.get(p, 0), F.get(p, 1)).alias("a")).collect()
    got = {r.location: (r.d, r.a) for r in out}
    for loc, d, a in GEOMETRY:
        assert got[loc][0] == pytest.approx(d, abs=1e-9)
        assert got[loc][1] == pytest.approx(a, abs=1e-6)
    for bad in (None, "junk", "[1]"):
        assert got[bad] == (None, None)


def test_angle_properties(spark):
    df = spark.range(2000).select(((F.col("id") * 7919) % 1201 / 10.0).alias("x"),
                                  ((F.col("id") * 104729) % 801 / 10.0).alias("y"))
    rows = df.select("x", "y", shot_angle("x", "y", scale=None).alias("a"),
                     shot_angle("x", 80 - F.col("y"), scale=None).alias("m")).collect()
    for r in rows:
        assert 0.0 <= r.a <= 180.0
        assert r.a == pytest.approx(r.m, abs=1e-9)  # mirror symmetry y -> 80 - y
        ux, uy, vy = 120 - r.x, 36 - r.y, 44 - r.y
        nu, nv = math.hypot(ux, uy), math.hypot(ux, vy)
        if nu > 0 and nv > 0:
            ref = math.degrees(math.acos(max(-1.0, min(1.0, (ux * ux + uy * vy) / (nu * nv)))))
            assert r.a == pytest.approx(ref, abs=1e-6)


INSIDE = [
    ((118, 40), True), ((114, 38), True), ((108, 40), True), ((120, 36), True), ((120, 44), True),
    ((114, 36), False), ((120, 44.1), False), ((107.9, 40), False), ((110, 50), False),
]


def test_point_in_triangle(spark):
    rows = [(float(px), float(py), 108.0, 40.0, exp) for (px, py), exp in INSIDE]
    rows += [(120.0, 40.0, 120.0, 50.0, True), (119.0, 40.0, 120.0, 40.0, False)]
    df = spark.createDataFrame(rows, "px double, py double, sx double, sy double, exp boolean")
    got = df.select("exp", (players_in_triangle(F.array(F.struct(F.array("px", "py").alias("location"))), "sx", "sy") == 1).alias("g")).collect()
    assert all(r.exp == r.g for r in got)


FRAME_TEXT = (
    "[{'location': [118, 39.9], 'player': {'id': 1, 'name': \"N'Golo Kanté\"}, "
    "'position': {'id': 1, 'name': 'Goalkeeper'}, 'teammate': False}, "
    "{'location': [114.0, 38.0], 'player': {'id': 2, 'name': 'He said \"True\" O\\'Neil'}, "
    "'position': {'id': 5, 'name': 'Left Back'}, 'teammate': True}, "
    "{'location': [60.0, 10.0], 'player': {'id': 3, 'name': 'Trueman'}, "
    "'position': {'id': 9, 'name': 'Center Forward'}, 'teammate': True}]"
)


def test_frame_parse_and_count(spark):
    df = spark.createDataFrame([(1, FRAME_TEXT), (2, "[]"), (3, None), (4, "[{'location': oops")],
                               "id int, t string")
    out = df.select("id", parse_frame("t").alias("f")).select(
        "id", "f", players_in_triangle("f", F.lit(108.0), F.lit(40.0)).alias("n")).collect()
    got = {r.id: r for r in out}
    f = got[1].f
    assert [p.player.name for p in f] == ["N'Golo Kanté", 'He said "True" O\'Neil', "Trueman"]
    assert [p.teammate for p in f] == [False, True, True]
    assert f[0].location == [118.0, 39.9]
    assert got[1].n == 2
    assert got[2].n == 0 and got[2].f == []
    assert got[3].n is None and got[4].n is None
