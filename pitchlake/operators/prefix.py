"""Running sums that stay parallel when one group is huge.

A window ``partitionBy(keys).orderBy(order)`` puts every row of a group in one
task.  Here rows are dealt by tick (the keys and the leading order columns, a
game-clock second), once: that exchange gives the sums of the ticks and the
rows to which their totals come back.  The window over the ticks of a group runs
on that small table, at most one row per tick, and only the rows of one tick are
ordered among themselves, so a hot group is spread over its ticks.  Nothing runs
while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.session import scratch_dir
from pitchlake.sinks.writers import kept


def dealt_by_tick(df: DataFrame, keys: list[str], ticks: list[str]) -> DataFrame:
    """The rows exchanged by ``_tick``, which holds their keys and ticks."""
    # a struct is never null, so null keys meet in the join
    return df.select(F.struct(*keys, *ticks).alias("_tick"), *[c for c in df.columns if c not in (*keys, *ticks)]).repartition("_tick")


def tick_sums(dealt: DataFrame, values: list[str]) -> DataFrame:
    """``_tick`` and ``_tot{i}``, the sum of each value over the tick, from rows
    of :func:`dealt_by_tick`.

    The planner reuses an exchange only where both readers ask for the same
    columns, and would prune the ones not summed here; so this side looks at
    all of them (one hash a row) and the input is scanned once."""
    plain = [f.name for f in dealt.schema.fields if not isinstance(f.dataType, (T.MapType, T.UserDefinedType))]
    return (dealt.groupBy("_tick")
                 .agg(*[F.sum(v).alias(f"_tot{i}") for i, v in enumerate(values)], F.max(F.xxhash64(*plain)).alias("_seen"))
                 .filter(F.col("_seen").isNotNull()).drop("_seen"))


def add_running_sums(dealt: DataFrame, sums: DataFrame, keys: list[str], ticks: list[str], tie: list[str],
                     values: list[str], outs: list[str]) -> DataFrame:
    """The dealt rows with their running sums, given the tick sums."""
    before = (Window.partitionBy(*[F.col(f"_tick.{k}") for k in keys]).orderBy(*[F.col(f"_tick.{t}") for t in ticks])
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("_tick", *[F.sum(f"_tot{i}").over(before).alias(f"_off{i}") for i in range(len(values))])
    within = Window.partitionBy("_tick").orderBy(*tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = dealt.join(offsets, "_tick").withColumns(
        {f"_loc{i}": F.sum(v).over(within) for i, v in enumerate(values)})
    cols = {}
    for i, o in enumerate(outs):
        loc, off = F.col(f"_loc{i}"), F.col(f"_off{i}")
        # null + null stays null (nothing seen yet); otherwise nulls count as 0
        cols[o] = F.when(loc.isNull() & off.isNull(), F.lit(None)).otherwise(
            F.coalesce(loc, F.lit(0)) + F.coalesce(off, F.lit(0)))
    rest = [c for c in dealt.columns if c != "_tick"]
    return joined.select("_tick.*", *rest, *[c.alias(o) for o, c in cols.items()])


def running_sum(df: DataFrame, keys: list[str], ticks: list[str], tie: list[str], values: list[str],
                outs: list[str]) -> DataFrame:
    """Adds ``outs[i] = sum(values[i])`` over rows of the same ``keys`` up to
    and including the current row in (``ticks``, ``tie``) order (nulls
    ignored; null until the first non-null value, like SQL ``SUM`` over a ROWS
    frame).  Null keys and ticks form groups like any value; ``tie`` must make
    rows unique within a tick for a deterministic result."""
    dealt = dealt_by_tick(df, keys, ticks)
    return add_running_sums(dealt, tick_sums(dealt, values), keys, ticks, tie, values, outs).select(*df.columns, *outs)


def in_order(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows in global order (nulls first), written once: ``_part`` numbers
    the ranges of the order, ``_at`` the rows of a range.

    Ranges are cut at sampled rows, and rows of equal keys are told apart by
    where they came from, so ranges are even for text keys with a common
    prefix, numbers with an outlier and a key with a third of the rows alike.
    The write fixes the ranges: every later read sees the same.  Runs when
    called."""
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    placed = ranged.withColumn("_part", F.spark_partition_id()) \
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    return kept(placed, scratch_dir(df.sparkSession, "in-order"))


def positions(df: DataFrame, order: list[str], out: str = "pos") -> DataFrame:
    """0-based position of each row in the order: its place in its range after
    the counts of the ranges before."""
    rows = in_order(df, order)
    before = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select(
        "_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_before"))  # a row a range
    return rows.join(before, "_part").withColumn(out, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")
