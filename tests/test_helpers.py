"""Small operators: penalty rule of the frame count, split spreading,
lineage cutting and persistence."""

from pyspark.sql import functions as F

from pitchlake.operators.frames import players_inside_area
from pitchlake.sinks.writers import cut_lineage, held, kept

FRAME = ("[{'location': [118.0, 40.0], 'player': {'id': 1, 'name': 'K'}, "
         "'position': {'id': 1, 'name': 'Goalkeeper'}, 'teammate': False}]")


def test_penalty_counts_one_whatever_the_frame(spark):
    df = spark.createDataFrame(
        [(1, "Penalty", FRAME), (2, "Penalty", None), (3, "Open Play", FRAME), (4, "Open Play", None),
         (5, "Open Play", "[]")],
        "id long, shot_type string, shot_freeze_frame string") \
        .withColumns({"shot_location_x": F.lit(108.0), "shot_location_y": F.lit(40.0)})
    got = {r.id: r.players_inside_area for r in players_inside_area(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: None, 5: 0}
    zero = {r.id: r.players_inside_area for r in players_inside_area(df, "zero").collect()}
    assert zero[4] == 0
    dropped = {r.id for r in players_inside_area(df, "drop").collect()}
    assert 4 not in dropped


def test_random_rows_do_not_depend_on_partitions(spark):
    from pitchlake.operators.explore import random_rows

    df = spark.range(500)
    picks = [sorted(r.id for r in random_rows(df.repartition(n), 20, seed=7).collect()) for n in (1, 4, 9)]
    assert picks[0] == picks[1] == picks[2] and len(picks[0]) == 20


def test_checkpoint_dir_must_be_shared_off_local_masters(monkeypatch):
    import pytest

    from pitchlake import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_confusion_table_counts_every_row(spark):
    from pitchlake.operators.metrics import confusion_table

    df = spark.createDataFrame([(1, 1), (1, 0), (0, 2), (0, None), (None, 1)], "goal int, prediction int")
    rows = confusion_table(df).collect()
    assert sum(sum(r[1:]) for r in rows) == 5
    got = {r.goal: tuple(r[1:]) for r in rows}
    assert got == {1: (1, 1, 0, 0), 0: (0, 0, 1, 1), None: (0, 1, 0, 0)}


def test_null_features_are_an_error(spark):
    import pytest

    from pitchlake.operators import ml

    df = spark.createDataFrame([(1.0, 0), (None, 1), (3.0, 1)], "distance_to_goal double, goal int")
    with pytest.raises(Exception, match="(?i)null"):
        ml.train(df, "logistic", features=["distance_to_goal"])
    model = ml.train(df, "logistic", features=["distance_to_goal"], handle_invalid="skip")
    assert ml.score(model, df).count() == 2


def test_r2_of_large_values(spark):
    from pitchlake.operators.metrics import regression_metrics

    df = spark.range(1000).select((F.col("id") + 1e9).alias("a"), (F.col("id") + 1e9 + 0.5).alias("p"))
    assert regression_metrics(df, "a", "p").first().r2 == 100.0


def test_cut_lineage_and_held_tables(spark, tmp_path):
    import pytest

    df = spark.range(1000).withColumn("x", F.col("id") * 2)
    cut = cut_lineage(df)
    assert cut.count() == 1000 and "LogicalRDD" in cut._jdf.queryExecution().logical().toString()
    with held(df) as m:
        assert m.is_cached and m.count() == 1000
        out = kept(m.groupBy((F.col("x") % 3).alias("k")).count(), str(tmp_path / "out"))
    assert not df.is_cached and out.count() == 3
    with pytest.raises(RuntimeError):
        with held(df):
            raise RuntimeError
    assert not df.is_cached


def test_error_guards(spark):
    import pytest

    from pitchlake.operators import explore, ml

    with pytest.raises(ValueError, match="no such model"):
        ml.make_estimator("xgboost")
    df = spark.createDataFrame([(1.0, 0), (2.0, 1)], "distance_to_goal double, goal int")
    with pytest.raises(ValueError, match="layer sizes"):
        ml.train(df, "mlp", features=["distance_to_goal"])
    with pytest.raises(ValueError, match="no shots are left"):
        explore.require_rows(df.limit(0))
    with pytest.raises(ValueError, match="t must be 'xg'"):
        explore.shot_distribution(df, ["goal"], t="heat")
    model = ml.train(spark.createDataFrame([(float(i), i % 2) for i in range(20)],
                                           "distance_to_goal double, goal int"),
                     "nb", features=["distance_to_goal"])
    with pytest.raises(ValueError, match="neither importances nor coefficients"):
        ml.feature_importance(model, spark)


def test_intermediates_are_gone_when_the_session_has_ended(tmp_path):
    import os
    import subprocess
    import sys

    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from pyspark.sql import SparkSession\n"
            "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false')"
            ".config('spark.checkpoint.dir', sys.argv[2]).getOrCreate()\n"
            "from pitchlake.session import run_folder, scratch_dir\n"
            "from pitchlake.sinks.writers import kept\n"
            "print('ROWS', kept(spark.range(5), scratch_dir(spark, 'x')).count(), run_folder(spark))\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code, root, str(tmp_path)], capture_output=True, text=True, timeout=120).stdout
    said = out[out.index("ROWS"):].split()
    assert said[1] == "5" and said[2].removeprefix("file:").startswith(str(tmp_path))
    assert not os.path.exists(said[2].removeprefix("file:"))
