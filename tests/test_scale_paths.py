"""Scale-sensitive paths: the split running sum must equal the one-window
result when a hot group spans many partitions; plan shape of the pipeline;
metamorphic properties from the test plan."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pitchlake.binding import events_view
from pitchlake.functions.geometry import players_in_triangle
from pitchlake.operators import metrics
from pitchlake.operators.prefix import running_sum
from pitchlake.plans.pipeline import shot_features


def test_running_sum_hot_group_matches_window(spark):
    # the null group holds 90% of the rows, 500 ticks of 40 rows each
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).alias("g"), (F.col("id") % 500).alias("t"),
        F.col("id").alias("o"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise((F.col("id") % 5).cast("double")).alias("v"))
    got = running_sum(df.repartition(16), ["g"], ["t"], ["o"], ["v"], ["s"])
    w = Window.partitionBy("g").orderBy("t", "o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ref = df.withColumn("r", F.sum("v").over(w)).select("o", "r")
    bad = got.join(ref, "o").filter(~F.col("s").eqNullSafe(F.col("r")))
    assert got.count() == 20000 and bad.count() == 0


def test_plans_are_built_without_jobs(spark):
    """Nothing runs before an action."""
    from pitchlake.operators import explore, timeline

    sc = spark.sparkContext
    shots = shot_features(events_view(spark, "/root/testdata/sf0.001"))
    sc.setJobGroup("plans", "plan building")
    timeline.running_total(shots)
    timeline.tick_grid_timeline(shots)
    timeline.tick_grid_timeline(shots, by_period=True)
    explore.correlation_pairs(shots)
    jobs = sc.statusTracker().getJobIdsForGroup("plans")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


def test_running_total_of_rows_without_team(spark):
    from pitchlake.operators import timeline

    shots = shot_features(events_view(spark, "/root/testdata/sf0.01")).dropDuplicates(["id"]) \
        .withColumn("team", F.when(F.col("id") % 10 == 0, F.col("team")))
    a = timeline.running_total(shots)
    b = timeline.running_total(shots, method="window").select("id", F.col("cxg").alias("w"))
    assert a.join(b, "id").filter(~F.col("cxg").eqNullSafe(F.col("w"))).count() == 0
    assert a.count() == shots.count()


def test_pipeline_plan_shape(spark):
    df = shot_features(events_view(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 2  # J1 (preferred foot) and J4 (assist) only
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_adding_a_player_never_lowers_the_count(spark):
    base = [[118.0, 40.0], [60.0, 10.0]]
    rows = [(base, base + [[x / 10.0, y / 10.0]]) for x in range(1000, 1201, 50) for y in range(300, 501, 25)]
    df = spark.createDataFrame(rows, "a array<array<double>>, b array<array<double>>")
    frame = lambda c: F.transform(c, lambda p: F.struct(p.alias("location")))
    out = df.select(players_in_triangle(frame("a"), F.lit(108.0), F.lit(40.0)).alias("na"),
                    players_in_triangle(frame("b"), F.lit(108.0), F.lit(40.0)).alias("nb")).collect()
    assert all(r.nb >= r.na for r in out)


def test_confusion_counts_cover_non_null_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    c = metrics.confusion_counts(labels, "quality", "toxic").first()
    n = labels.filter(F.col("quality").isNotNull() & F.col("toxic").isNotNull()
                      & F.col("quality").isin(0, 1) & F.col("toxic").isin(0, 1)).count()
    assert c.tp + c.tn + c.fp + c.fn == n


def test_running_total_ends_at_group_total(spark):
    from pitchlake.operators import timeline

    shots = shot_features(events_view(spark, "/root/testdata/sf0.001")) \
        .select("match_id", "team", "minute", "second", "id", "shot_statsbomb_xg")
    rt = timeline.running_total(shots)
    last = rt.groupBy("match_id", "team").agg(F.max("cxg").alias("end"))
    tot = shots.groupBy("match_id", "team").agg(F.round(F.sum("shot_statsbomb_xg"), 6).alias("tot"))
    bad = last.join(tot, ["match_id", "team"]).filter(F.abs(F.col("end") - F.col("tot")) > 1e-6)
    assert bad.count() == 0


def test_running_total_by_period_prefix_equals_window(spark):
    from pitchlake.operators import timeline

    shots = shot_features(events_view(spark, "/root/testdata/sf0.001")) \
        .select("match_id", "team", "period", "minute", "second", "id", "shot_statsbomb_xg").dropDuplicates(["id"])
    a = timeline.running_total(shots, by_period=True, method="prefix")
    b = timeline.running_total(shots, by_period=True, method="window").withColumnRenamed("cxg", "w")
    bad = a.join(b.select("id", "w"), "id").filter(~F.col("cxg").eqNullSafe(F.col("w")))
    assert a.count() == shots.count() and bad.count() == 0


def executed(df):
    """The plan that ran, reused exchanges as such."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_timelines_scan_the_shots_once(spark):
    from pitchlake.operators import timeline

    ev = events_view(spark, "/root/testdata/sf0.001", with_frames=False).select("match_id", "team", "period", "minute", "second", "id",
                                                                               "shot_statsbomb_xg", "shot_outcome", "type")
    shots = ev.filter("type = 'Shot'").withColumn("goal", (F.col("shot_outcome") == "Goal").cast("int"))
    narrow = shots.select("match_id", "team", "minute", "second", "id", "shot_statsbomb_xg")
    for df in (timeline.running_total(narrow), timeline.tick_grid_timeline(shots), timeline.tick_grid_timeline(shots, by_period=True),
               timeline.timeline_extent(timeline.running_total(narrow))):
        plan = executed(df)
        assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1, plan


def test_correlation_is_one_lazy_scan(spark):
    from pitchlake.operators import explore

    ev = events_view(spark, "/root/testdata/sf0.001", with_frames=False).filter("type = 'Shot'")
    df = explore.correlation_pairs(ev.withColumn("x", F.col("minute") + F.col("second")), ["minute", "second", "x"])
    plan = executed(df)
    assert plan.count("Scan parquet") == 1 and df.count() == 9


def test_correlation_of_nulls_constants_and_no_rows(spark):
    import pytest

    from pitchlake.operators import explore

    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 1.0, 5.0), (4.0, None, 5.0), (3.0, 9.0, 5.0)], "a double, b double, c double")
    got = {(r.col_a, r.col_b): r.r for r in explore.correlation_pairs(df, ["a", "c"]).collect()}
    assert got == {("a", "a"): 1.0, ("a", "c"): None, ("c", "a"): None, ("c", "c"): 1.0}
    with pytest.raises(Exception, match="a feature is null"):
        explore.correlation_pairs(df, ["a", "b"]).collect()
    skipped = {(r.col_a, r.col_b): r.r for r in explore.correlation_pairs(df, ["a", "b"], handle_invalid="skip").collect()}
    assert skipped["a", "b"] == skipped["b", "a"] == round(df.dropna().corr("a", "b"), 6)
    assert explore.correlation_pairs(df.limit(0), ["a"]).count() == 0


def test_positions_of_awkward_keys_are_even(spark):
    from pitchlake.operators.prefix import in_order
    from pitchlake.sources import readers

    n = 40_000
    keys = {"text": F.concat(F.lit("match_0000000_"), F.format_string("%08d", F.col("id"))),
            "outlier": F.when(F.col("id") == 7, F.lit(10**15)).otherwise(F.col("id")),
            "hot": F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id"))}
    for name, key in keys.items():
        df = spark.range(n).select(key.alias("k")).repartition(8)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one range
        try:
            per = [r["count"] for r in in_order(df, ["k"]).groupBy("_part").count().collect()]
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert len(per) > 1 and max(per) < 3 * n / len(per), (name, per)
        got = [(r.k, r.pos) for r in readers.positional_index(df, "k").orderBy("pos").collect()]
        assert [p for _, p in got] == list(range(n))
        assert [k for k, _ in got] == sorted((k for k, _ in got), key=lambda k: (k is not None, k))


def test_auc_is_the_share_of_ordered_pairs(spark):
    rows = [(int(i % 7 < 3), float(i * i % 11)) for i in range(150)] + [(None, 1.0), (1, None), (2, 3.0)]
    got = metrics.auc_rank(spark.createDataFrame(rows, "goal int, xG double").repartition(5)).first()
    pos, neg = ([s for y, s in rows if y == k and s is not None] for k in (1, 0))
    want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)
    assert abs(got.auc - want) < 1e-12 and (got.positives, got.negatives) == (len(pos), len(neg))
    one_class = metrics.auc_rank(spark.createDataFrame([(1, 0.5)], "goal int, xG double")).first()
    assert one_class.auc is None and metrics.auc_rank(spark.createDataFrame([], "goal int, xG double")).first().positives == 0


def test_fractions_nest_and_follow_the_strata(spark):
    from pitchlake.operators import explore

    df = spark.range(20_000).withColumn("team", F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").when(F.col("id") % 4 == 2, "c"))
    small, large = ({r.id for r in explore.sample_fraction(df.repartition(k), f).collect()} for k, f in ((3, 0.1), (7, 0.3)))
    assert small < large and abs(len(small) - 2000) < 200
    assert explore.sample_fraction(df, 1.0).count() == 20_000 and explore.sample_fraction(df, 0.0).count() == 0
    by = {r.team: r["count"] for r in explore.sample_fraction(df, {"a": 1.0, "b": 0.2}, by="team").groupBy("team").count().collect()}
    assert by["a"] == 5000 and abs(by["b"] - 1000) < 150 and set(by) == {"a", "b"}


def test_bucketed_assist_join_has_no_exchange(spark):
    from pitchlake.operators.assists import assisting_passes, attach_assist
    from pitchlake.plans.pipeline import shots_or_assists
    from pitchlake.session import scratch_dir
    from pitchlake.sinks.writers import write_bucketed

    ev = shots_or_assists(events_view(spark, "/root/testdata/sf0.01", with_frames=False))
    base = scratch_dir(spark, "bucket-test")
    shots = write_bucketed(ev.filter("type = 'Shot'").select("id", "match_id"), "test_shots", f"{base}/s", ["match_id", "id"], 4)
    passes = write_bucketed(assisting_passes(ev, with_match=True), "test_passes", f"{base}/p", ["match_id", "pass_assisted_shot_id"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(attach_assist(shots, passes, same_match=True))
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        plain = executed(attach_assist(ev.filter("type = 'Shot'").select("id", "match_id"), assisting_passes(ev, with_match=True), same_match=True))
        assert plain.count("Exchange") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.sql("drop table test_shots")
        spark.sql("drop table test_passes")


def test_one_shot_named_by_a_third_of_the_passes(spark):
    """Split or not, the rows are the same; split, no part holds more than some
    times the bound."""
    from pitchlake.operators.assists import join_assist
    from pitchlake.schemas import PASS_COLUMNS

    n, bound = 9000, 100
    shots = spark.range(600).select("id", (F.col("id") % 7).alias("match_id"))
    named = F.when(F.col("i") % 3 == 0, F.lit(5)).when(F.col("i") % 3 == 1, F.col("i") % 400)
    passes = spark.range(n).withColumnRenamed("id", "i").select(
        named.alias("pass_assisted_shot_id"), (named % 7).alias("match_id"),
        *[F.col("i").cast("double").alias(c) if c == "pass_length" else F.lit(0).alias(c) for c in PASS_COLUMNS if c != "pass_assisted_shot_id"]) \
        .filter("pass_assisted_shot_id is not null")
    for same in (False, True):
        a = join_assist(shots, passes, same_match=same).select("id", "pass_assisted_shot_id", "pass_length")
        b = join_assist(shots, passes, same_match=same, split_above=bound).select("id", "pass_assisted_shot_id", "pass_length")
        rows = sorted(map(tuple, a.collect()), key=str)
        assert sorted(map(tuple, b.collect()), key=str) == rows and len(rows) == n * 2 // 3 + 600 - len({r[0] for r in rows if r[1] is not None})
    empty = join_assist(shots, passes.limit(0), split_above=bound)
    assert empty.count() == 600 and empty.filter("pass_assisted_shot_id is not null").count() == 0


def test_staged_features_scan_the_events_once(spark, tmp_path):
    import pytest

    ev = events_view(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "events")
    ev.write.parquet(path)
    events = spark.read.parquet(path)
    staged = shot_features(events, staged=True)
    assert path not in staged._jdf.queryExecution().optimizedPlan().toString()
    assert all("shots-or-assists" in f for f in staged.inputFiles())
    whole = shot_features(events)
    assert staged.exceptAll(whole).count() == 0 and whole.exceptAll(staged).count() == 0
    with pytest.raises(ValueError):
        shot_features(events, staged=True, usage="all")


def test_drifting_units_of_odd_values(spark, tmp_path):
    from pyspark.sql import types as T

    from pitchlake.sources import readers

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("on", T.BooleanType()),
                           T.StructField("name", T.StringType())])
    base = str(tmp_path / "units")
    spark.createDataFrame([(1, 2.5, True, "a")], schema).write.parquet(f"{base}/a")
    spark.createDataFrame([("2", "no number", "true", 7), ("3.0", "1e2", "maybe", None), (None, "", None, 8)],
                          "id string, x string, `on` string, name long").write.parquet(f"{base}/b")
    spark.createDataFrame([(9.0, "extra")], "id double, other string").write.parquet(f"{base}/c")
    got = sorted(map(tuple, readers.read_drifting(spark, base, schema).collect()), key=str)
    assert got == sorted([(1, 2.5, True, "a"), (2, None, True, "7"), (3, 100.0, None, None), (None, None, None, "8"), (9, None, None, None)], key=str)
    assert readers.read_drifting(spark, [], schema).count() == 0
    same = readers.read_drifting(spark, [f"{base}/a", f"{base}/a"], schema)
    assert same._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1  # one scan for units alike


def test_quarantine_lists_what_gave_no_row(spark, tmp_path):
    from pitchlake.sources import readers

    folder = tmp_path / "landed"
    for k in range(3):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.parquet(str(folder / f"u{k}"))
    whole = next(p for p in (folder / "u1").iterdir() if p.name.startswith("part-"))
    data = whole.read_bytes()
    for p in (folder / "u1").iterdir():
        if p.name.startswith("."):
            p.unlink()  # checksums of the files as they were
    whole.write_bytes(data[:len(data) // 2])
    (folder / "u2" / "part-other.parquet").write_bytes(b"PAR1 but no footer")
    good, bad = readers.read_quarantined(spark, str(folder / "*"), spark.range(1).schema)
    assert sorted(r.id for r in good.collect()) == [*range(10), *range(20, 30)]
    got = {r.file.rsplit("/", 1)[1]: (r.length, r.reason) for r in bad.collect() if r.file.endswith(".parquet")}
    assert got == {whole.name: (len(data) // 2, "no row could be read"), "part-other.parquet": (18, "no row could be read")}
