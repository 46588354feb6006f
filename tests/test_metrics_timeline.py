"""Metrics (FIXTURES §2) and timelines."""

import pytest
from pyspark.sql import functions as F

from pitchlake.operators import explore, metrics, timeline


def test_classification_metrics(spark):
    rows = [(1, 1)] * 2 + [(0, 0)] * 5 + [(0, 1)] + [(1, 0)] * 2 + [(1, None)]
    df = spark.createDataFrame(rows, "goal int, prediction int")
    r = metrics.classification_metrics(df).first()
    assert (r.tp, r.tn, r.fp, r.fn) == (2, 5, 1, 2)
    assert (r.accuracy, r.precision, r.recall, r.specificity, r.f1, r.fpr, r.fnr) == \
        (70.0, 66.67, 50.0, 83.33, 57.14, 16.67, 50.0)
    empty = metrics.classification_metrics(df.limit(0)).first()
    assert empty.accuracy is None and empty.precision == 0.0
    with pytest.raises(ValueError):
        metrics.model_evaluation(df, "goal", "prediction", "other")


def test_running_total_and_grid(spark):
    df = spark.createDataFrame([(1, "a", 1, 5, 1, 0.1, 0), (1, "a", 1, 5, 2, 0.2, 1), (1, "a", 2, 0, 3, None, 0)],
                               "match_id long, team string, minute int, second int, id long, shot_statsbomb_xg double, goal int")
    rt = [r.cxg for r in timeline.running_total(df).orderBy("id").collect()]
    assert rt == [0.1, 0.3, 0.3]
    g = timeline.tick_grid_timeline(df).orderBy("minute", "second", "id").collect()
    assert len(g) == 91 * 60 + 1  # grid to minute 90; the 1:05 tick holds two shots
    by_tick = {}
    for r in g:
        by_tick.setdefault((r.minute, r.second), []).append(r.cxg)
    assert by_tick[(0, 0)] == [0.0] and by_tick[(1, 5)] == [0.1, 0.3] and by_tick[(1, 6)] == [0.3]
    assert by_tick[(90, 59)] == [0.3]


def test_stoppage(spark):
    df = spark.createDataFrame([(1, 1, 45, 3, 1), (1, 1, 44, 59, 2), (2, 1, 45, 30, 3), (2, 2, 90, 0, 4)],
                               "match_id long, period int, minute int, second int, id long")
    got = {r.match_id: r.stoppage for r in timeline.stoppage_time(df).collect()}
    assert got == {1: 0.05, 2: 0.5}


def test_bands_and_gxg(spark):
    df = spark.createDataFrame([(0.25,), (0.8,)], "shot_statsbomb_xg double")
    bands = sorted((r.shot_statsbomb_xg, r.band) for r in explore.value_bands(df).collect())
    assert bands == [(0.25, 0), (0.25, 1), (0.8, 3)]
    shots = spark.createDataFrame([("p", "t", 1, 0.9), ("p", "t", 1, 0.9), ("q", "t", 0, 0.3)],
                                  "player string, team string, goal int, shot_statsbomb_xg double")
    g = explore.goals_vs_expected(shots, "player", min_goal=1, min_xg=1).collect()
    assert [(r.player, r.team, r.goals, r.xg, r.g_minus_xg, r.performance) for r in g] == \
        [("p", "t", 2, 1.8, 0.2, "Overperformer")]
    with pytest.raises(ValueError):
        explore.goals_vs_expected(shots, "club")


def test_tick_grid_by_period_brute_force(spark):
    import pandas as pd

    rows = [  # match 1: period 1 to 46:10, period 2 from 45:00 (overlapping minutes); team b only in period 2
        (1, "a", 1, 3, 0, 1, 0.1, 0), (1, "a", 1, 46, 10, 2, 0.2, 1), (1, "a", 2, 45, 0, 3, 0.3, 0),
        (1, "a", 2, 45, 0, 4, 0.05, 0), (1, "b", 2, 60, 30, 5, 0.4, 1), (1, "b", 2, 92, 1, 6, None, 0)]
    cols = "match_id long, team string, period int, minute int, second int, id long, shot_statsbomb_xg double, goal int"
    df = spark.createDataFrame(rows, cols)
    got = timeline.tick_grid_timeline(df, by_period=True).toPandas()

    shots = pd.DataFrame(rows, columns=["match_id", "team", "period", "minute", "second", "id", "xg", "goal"])
    out = []
    for (m, team), g in shots.groupby(["match_id", "team"]):
        ms = shots[shots.match_id == m]
        periods = sorted(ms.period.unique())
        grid = []
        for p in periods:
            mp = ms[ms.period == p]
            a = 0 if p == periods[0] else mp.minute.min() * 60
            last = (max(90, mp.minute.max()) if p == periods[-1] else mp.minute.max())
            grid += [(p, t // 60, t % 60) for t in range(a, (last + 1) * 60)]
        gdf = pd.DataFrame(grid, columns=["period", "minute", "second"])
        j = gdf.merge(g, on=["period", "minute", "second"], how="left").sort_values(
            ["period", "minute", "second", "id"], na_position="first")
        j["cxg"] = j.xg.fillna(0).cumsum().round(6)
        j["team"] = team
        out.append(j)
    exp = pd.concat(out)
    key = ["team", "period", "minute", "second"]
    a = sorted(zip(*(got[c] for c in key), got.cxg.round(6)))
    b = sorted(zip(*(exp[c] for c in key), exp.cxg))
    assert len(a) == len(b) and a == b


def test_correlation_pairs_match_ml_matrix(spark):
    from pyspark.sql import functions as F

    df = spark.range(500).select((F.col("id") % 17).cast("double").alias("a"),
                                 ((F.col("id") * 7) % 23).cast("double").alias("b"),
                                 (F.col("id") % 17 * 2 + (F.col("id") % 3)).cast("double").alias("c"))
    feats = ["a", "b", "c"]
    pairs = {(r.col_a, r.col_b): r.r for r in explore.correlation_pairs(df, feats).collect()}
    m = explore.correlation_matrix(df, feats).first()["corr"].toArray()
    for i, x in enumerate(feats):
        for j, y in enumerate(feats):
            assert pairs[(x, y)] == pytest.approx(m[i][j], abs=1e-6)


@pytest.mark.parametrize("by_period", [False, True])
def test_tick_grid_is_expanded_by_many_tasks(spark, by_period):
    rows = [(m, t, 1, 10, 5, 2 * m + k, 0.5, 0) for m in range(60) for k, t in enumerate(("home", "away"))]
    shots = spark.createDataFrame(rows, "match_id long, team string, period int, minute int, second int, id long, "
                                        "shot_statsbomb_xg double, goal int")
    grid = timeline.tick_grid_timeline(shots, by_period=by_period)
    tasks = [r["count"] for r in grid.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()]
    assert sum(tasks) == 120 * 91 * 60
    assert max(tasks) < 0.5 * sum(tasks)
