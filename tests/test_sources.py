"""Sources, sinks and streaming ingest: round trips in the session's
checkpoint folder."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.schemas import LINEUP_SCHEMA
from pitchlake.session import scratch_dir
from pitchlake.sinks.writers import drop_vectors, write_csv, write_split
from pitchlake.sources import readers

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("frame", T.StringType())])


def test_csv_semicolon_with_doubled_quotes(spark):
    rows = [(1, 'He said "hi"; then left', "[{'name': \"O'Neil\"}]"), (2, "plain", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    path = scratch_dir(spark, "t-csv")
    write_csv(df, path, sep=";")
    back = readers.read_table(spark, path, "csv", schema=SCHEMA, sep=";")
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_corrupt_rows_go_to_side_table(spark):
    path = scratch_dir(spark, "t-json")
    spark.createDataFrame([('{"id": 1, "name": "a"}',), ("{broken",), ('{"id": 2, "name": "b"}',)], "value string") \
        .write.text(path)
    s = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    good, bad = readers.read_checked(spark, path, s)
    assert sorted(r.id for r in good.collect()) == [1, 2]
    assert [r.line for r in bad.collect()] == ["{broken"] and bad.count() == 1
    assert not good.storageLevel.useMemory


def test_csv_rejects(spark):
    path = scratch_dir(spark, "t-csv-bad")
    spark.createDataFrame([("id;name",), ("1;a",), ("x;b",), ('2;"c;d"',)], "value string").coalesce(1).write.text(path)
    s = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    good, bad = readers.read_checked(spark, path, s, "csv", ";")
    assert sorted(map(tuple, good.collect())) == [(1, "a"), (2, "c;d")]
    assert [r.line for r in bad.collect()] == ["x;b"]


def test_events_need_their_match_columns(spark):
    ev = spark.createDataFrame([(1, "Shot")], "match_id long, type string")
    with pytest.raises(ValueError, match="columns not found"):
        readers.attach_match(ev, spark.createDataFrame([(1, "c")], "match_id long, competition string"))
    with pytest.raises(ValueError, match="columns not found"):
        readers.matches_for(ev, ev)


def test_positions_of_a_wide_table(spark):
    """400,000 rows, every column written: positions are those of the keys."""
    n = 400_000
    key = (F.col("id") * 48271) % 2147483647
    wide = spark.range(0, n, 1, 16).select(key.alias("match_id"), F.col("id"), F.repeat(F.lit("x"), 40).alias("pad"))
    path = scratch_dir(spark, "t-pos")
    readers.positional_index(wide, "match_id").write.parquet(path)
    back = spark.read.parquet(path)
    r = back.agg(F.count(F.lit(1)), F.countDistinct("pos"), F.min("pos"), F.max("pos")).first()
    assert tuple(r) == (n, n, 0, n - 1)
    keys = sorted((i * 48271) % 2147483647 for i in range(n))
    some = back.where("id % 1000 = 0").select("match_id", "pos").collect()
    assert all(keys[x.pos] == x.match_id for x in some)


def test_positions_of_text_nulls_and_ties(spark):
    rows = [(k,) for k in ["b", None, "a", "b", "", "zz", "é", "zzzzzzzza", "zzzzzzzzb"]]
    got = readers.positional_index(spark.createDataFrame(rows, "match_id string"), "match_id").collect()
    order = [x.match_id for x in sorted(got, key=lambda x: x.pos)]
    assert sorted(x.pos for x in got) == list(range(9))
    assert order == [None, "", "a", "b", "b", "zz", "zzzzzzzza", "zzzzzzzzb", "é"]


def test_batches_are_written_once(spark):
    from pitchlake.sinks.writers import write_batches

    df = spark.range(100).select("id", (F.col("id") % 5).alias("match_id"), (F.col("id") % 2).alias("batch"))
    path = scratch_dir(spark, "t-batch")
    write_batches(df, path)
    write_batches(df.where("batch = 1"), path)  # a retry of one batch
    assert spark.read.parquet(path).count() == 100


def test_small_batches_are_one_file_each(spark):
    from pitchlake.sinks.writers import write_batches

    df = spark.range(6000).select("id", (F.col("id") % 300).alias("match_id"), (F.col("id") % 300 % 30).alias("batch"))
    path = scratch_dir(spark, "t-batch-files")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # as on a cluster, where tasks are many
    try:
        write_batches(df, path)
    finally:
        spark.conf.set(coalesce, "true")
    back = spark.read.parquet(path)
    assert len(back.inputFiles()) == 30
    assert back.groupBy("batch").agg(F.countDistinct("match_id").alias("m"), F.count("*").alias("n")).where("m != 10 or n != 200").count() == 0
    assert back.count() == 6000


def test_split_spreads_rows_without_a_match(spark):
    df = spark.range(2000).select("id", F.lit(None).cast("long").alias("match_id"), F.lit("c").alias("competition"))
    path = scratch_dir(spark, "t-null")
    write_split(df, path)
    back = spark.read.parquet(path)
    assert back.count() == 2000
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # the rows are few: see how they are dealt
    try:
        spread = scratch_dir(spark, "t-null-spread")
        write_split(df, spread)
        assert len(spark.read.parquet(spread).inputFiles()) > 1
    finally:
        spark.conf.set(coalesce, "true")
    one = scratch_dir(spark, "t-one")
    write_split(df, one, one_file=True)
    assert len(spark.read.parquet(one).inputFiles()) == 1


def test_require_and_conform(spark):
    df = spark.createDataFrame([(1, "x", 3.5)], "id long, type string, extra double")
    with pytest.raises(ValueError, match="columns not found"):
        readers.require_columns(df, ["id", "match_id"])
    s = T.StructType([T.StructField("id", T.StringType()), T.StructField("match_id", T.LongType())])
    out = readers.conform(df, s)
    assert out.columns == ["id", "match_id"] and out.first() == ("1", None)


def test_split_writer_union_equals_input(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("match_id"),
                                  F.concat(F.lit("c"), (F.col("id") % 3).cast("string")).alias("competition"))
    path = scratch_dir(spark, "t-split")
    write_split(df, path, key="competition", spread="match_id")
    back = spark.read.parquet(path)
    assert sorted(back.select("id").rdd.flatMap(lambda r: r).collect()) == list(range(1000))
    assert {r.competition for r in back.select("competition").distinct().collect()} == {"c0", "c1", "c2"}


def test_lineups_flatten(spark):
    rows = [(7, {"home": [(1, "A", 9, "X")], "away": [(2, "B", 1, "Y"), (3, "C", 4, "Z")]})]
    df = spark.createDataFrame(rows, LINEUP_SCHEMA)
    out = sorted((r.match_id, r.team, r.player_id) for r in readers.flatten_lineups(df).collect())
    assert out == [(7, "away", 2), (7, "away", 3), (7, "home", 1)]


def test_match_batches_and_competition_filter(spark):
    m = spark.range(23).select((F.col("id") * 3 + 5).alias("match_id"))
    b = readers.match_batches(m, batch_size=5).collect()
    assert sorted(r.pos for r in b) == list(range(23))
    assert {r.match_id: r.batch for r in b}[5] == 0 and max(r.batch for r in b) == 4
    assert sorted(r.match_id for r in readers.match_batch(m, 5, 8).collect()) == [20, 23, 26]
    comps = spark.createDataFrame(
        [("male", "2014", "League"), ("male", "2014/2015", "League"), ("female", "2016", "Cup"),
         ("male", "2016", "Indian Super league")],
        "competition_gender string, season_name string, competition_name string")
    kept = readers.filter_competitions(comps).collect()
    assert [(r.season_name, r.competition_name) for r in kept] == [("2014/2015", "League")]


def test_drop_vectors(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(1, Vectors.dense([0.1, 0.9]))], ["id", "probability"])
    assert drop_vectors(df).columns == ["id"]


def test_stream_ingest_matches_batch(spark):
    from pitchlake.streaming import run_ingest

    base = scratch_dir(spark, "t-stream")
    ev = spark.range(600).select(F.col("id"), (F.col("id") % 12).alias("match_id"),
                                 F.when(F.col("id") % 5 == 0, "Shot").otherwise("Pass").alias("type"))
    ev.repartition(4, "match_id").write.parquet(f"{base}/landed")
    matches = spark.range(12).select(F.col("id").alias("match_id"),
                                     F.concat(F.lit("c"), (F.col("id") % 2).cast("string")).alias("competition"),
                                     F.lit("s").alias("season"))
    schema = spark.read.parquet(f"{base}/landed").schema
    out = run_ingest(spark, f"{base}/landed", f"{base}/sink", f"{base}/ckpt", schema, matches=matches)
    assert out.count() == 600
    assert {r.competition: r["count"] for r in out.groupBy("competition").count().collect()} == {"c0": 300, "c1": 300}


def test_stream_ingest_restart_is_exactly_once(spark):
    from pitchlake.streaming import run_ingest

    base = scratch_dir(spark, "t-stream-restart")
    ev = spark.range(300).select(F.col("id"), (F.col("id") % 6).alias("match_id"), F.lit("Pass").alias("type"))
    ev.repartition(3, "match_id").write.parquet(f"{base}/landed")
    schema = spark.read.parquet(f"{base}/landed").schema
    args = (f"{base}/landed", f"{base}/sink", f"{base}/ckpt", schema)
    assert run_ingest(spark, *args).count() == 300
    assert run_ingest(spark, *args).count() == 300  # restart: nothing read twice
    spark.range(300, 350).select(F.col("id"), F.lit(7).cast("long").alias("match_id"), F.lit("Shot").alias("type")) \
        .write.mode("append").parquet(f"{base}/landed")
    assert run_ingest(spark, *args).count() == 350  # only the new file is added
