"""Cumulative expected-goals timelines.

All matches are answered in one job; the published per-match driver loop
with pandas merge and forward fill becomes a union with a tick grid
generated on the executors and one running sum that is split by ticks
when a (match, team) group is large.  Rows without a match or team have no
timeline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.functions.geometry import decimal_clock
from pitchlake.operators.prefix import add_running_sums, dealt_by_tick, running_sum, tick_sums


def _order(by_period: bool) -> list[str]:
    return (["period"] if by_period else []) + ["minute", "second", "id"]


def running_window(by_period: bool = False) -> Window:
    return (Window.partitionBy("match_id", "team").orderBy(*_order(by_period))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def running_total(shots: DataFrame, xg_cols=("shot_statsbomb_xg",), out_cols=("cxg",),
                  by_period: bool = False, scale: int | None = 6, method: str = "prefix") -> DataFrame:
    """Running sum of each ``xg_cols`` per (match, team) in game-clock order
    (W1; several columns share one pass, W3).  ``id`` breaks ties, D6.

    ``method='prefix'`` (default) splits a large (match, team) group by its
    ticks (:func:`running_sum`); ``'window'`` is the single-window form, one
    task per group.  The result has no order of its own; see
    :func:`in_clock_order`."""
    keys, ticks = ["match_id", "team"], _order(by_period)[:-1]
    if method == "window":
        w = running_window(by_period)
        out = shots.withColumns({dst: F.sum(src).over(w) for src, dst in zip(xg_cols, out_cols)})
    elif method == "prefix":
        out = running_sum(shots, keys, ticks, ["id"], list(xg_cols), list(out_cols))
    else:
        raise ValueError("method must be 'prefix' or 'window'")
    if scale is not None:
        out = out.withColumns({c: F.round(c, scale) for c in out_cols})
    return out


def _dealt_gaps(gaps: DataFrame, keys: list[str]) -> DataFrame:
    """The gaps dealt out over all of ``spark.sql.shuffle.partitions``.  A gap
    is a few bytes and expands to up to thousands of ticks; without a number
    adaptive execution merges the partitions by those bytes, and one task
    expands nearly all of the grid."""
    parts = int(gaps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return gaps.repartition(parts, *keys, "g.a")


def tick_grid_timeline(shots: DataFrame, xg_cols=("shot_statsbomb_xg",), out_cols=("cxg",),
                       goal_col: str = "goal", pad: int = 1, scale: int | None = 6,
                       by_period: bool = False) -> DataFrame:
    """Per (match, team), one row per second of the game clock from 0:00 to
    the grid end, with the cumulative xG as of that tick (V8; ``pad=2`` and
    two columns give V9).  A tick holding shots is replaced by the shot rows
    (left-join semantics, J6); other ticks carry the last total forward, 0
    before the first shot (W2, J10); ``goal`` is 0 on empty ticks (X22);
    ``time`` is the decimal clock (X19).

    The dense grid is never joined or shuffled.  Shot rows are exchanged once,
    by tick, and get their running totals; the shot ticks of each
    (match, team) - at most one per second of the clock, whatever the data
    volume - get the total through that tick and the next shot tick; the
    empty ticks in each gap are then generated on the executors with
    ``sequence`` and carry the total of the gap's start.

    ``by_period=True`` (D6) orders by (period, minute, second) and gives each
    period its own stretch of grid, see :func:`_tick_grid_by_period`.
    """
    if by_period:
        return _tick_grid_by_period(shots, list(xg_cols), list(out_cols), goal_col, pad, scale)
    shots = shots.filter(F.col("team").isNotNull() & F.col("match_id").isNotNull())
    keys = ["match_id", "team"]
    tick = F.col("minute") * 60 + F.col("second")
    s = shots.select(*keys, "minute", "second", "id", goal_col, *xg_cols)
    dealt = dealt_by_tick(s, keys, ["minute", "second"])
    sums = tick_sums(dealt, list(xg_cols))
    shot_rows = add_running_sums(dealt, sums, keys, ["minute", "second"], ["id"], list(xg_cols), list(out_cols))

    # xG per shot tick, from the same exchange.  Everything after runs on at
    # most one row per second of the clock per (match, team).
    per_tick = sums.select("_tick.*", *[F.col(f"_tot{i}").alias(f"_s{i}") for i in range(len(xg_cols))]) \
        .withColumn("_t", tick)
    last_min = F.max((F.col("_t") / 60).cast("int")).over(Window.partitionBy("match_id"))
    stop = (F.when(last_min < 90, F.lit(90 + pad - 1)).otherwise(last_min + (pad - 1)) + 1) * 60
    w = Window.partitionBy(*keys).orderBy("_t")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = per_tick.select(
        *keys, "_t",
        F.coalesce(F.lead("_t").over(w), stop).alias("_next"),
        F.lag("_t").over(w).isNull().alias("_first"),
        *[F.sum(f"_s{i}").over(upto).alias(f"_c{i}") for i in range(len(xg_cols))])
    # gaps: after each shot tick up to the next one (its running total), and
    # before the first shot tick of the group (total 0)
    gap = F.struct(F.col("_t").alias("a"), F.col("_next").alias("b"),
                   *[F.col(f"_c{i}").alias(f"c{i}") for i in range(len(xg_cols))])
    head = F.struct(F.lit(-1).alias("a"), F.col("_t").alias("b"),
                    *[F.lit(None).cast("double").alias(f"c{i}") for i in range(len(xg_cols))])
    both = F.when(F.col("_first"), F.array(head, gap)).otherwise(F.array(gap))
    gaps = steps.select(*keys, F.explode(both).alias("g")).filter(F.col("g.b") > F.col("g.a") + 1)
    gap_rows = _dealt_gaps(gaps, keys).select(*keys, *[F.col(f"g.c{i}").alias(o) for i, o in enumerate(out_cols)],
                           F.explode(F.sequence(F.col("g.a") + 1, F.col("g.b") - 1)).alias("_g"))
    grid = gap_rows.select(*keys, (F.col("_g") / 60).cast("int").alias("minute"),
                           (F.col("_g") % 60).cast("int").alias("second"), *out_cols)
    u = shot_rows.unionByName(grid, allowMissingColumns=True)
    cols = {}
    for dst in out_cols:
        v = F.coalesce(F.col(dst), F.lit(0.0))
        cols[dst] = F.round(v, scale) if scale is not None else v
    return u.select("match_id", "team", "minute", "second", "id", *xg_cols,
                    F.coalesce(F.col(goal_col), F.lit(0)).cast("int").alias(goal_col),
                    *[cols[c].alias(c) for c in out_cols], decimal_clock().alias("time"))


def _tick_grid_by_period(shots: DataFrame, xg_cols: list[str], out_cols: list[str], goal_col: str,
                         pad: int, scale: int | None) -> DataFrame:
    """Tick grid with ``period`` first in the clock order.  Each period of a
    match covers the minutes from its first action (0 for the first period)
    to its last action; the last period runs to minute 90+pad-1, or to its
    last minute + pad - 1 when that is later.  Totals carry across periods.
    Same construction as the default grid: shot rows get running totals,
    and the empty ticks of each gap are generated from small per-tick and
    per-segment tables (teams x periods per match)."""
    keys = ["match_id", "team"]
    n = len(xg_cols)
    s = (shots.filter(F.col("team").isNotNull() & F.col("match_id").isNotNull())
              .select(*keys, "period", "minute", "second", "id", goal_col, *xg_cols))
    ticks = ["period", "minute", "second"]
    dealt = dealt_by_tick(s, keys, ticks)
    sums = tick_sums(dealt, xg_cols)
    shot_rows = add_running_sums(dealt, sums, keys, ticks, ["id"], xg_cols, out_cols)
    # one row per shot tick; segments and teams are read off it as well
    per_tick = sums.select("_tick.*", *[F.col(f"_tot{i}").alias(f"_s{i}") for i in range(n)]) \
        .withColumn("_t", F.col("minute") * 60 + F.col("second"))

    wm = Window.partitionBy("match_id")
    per_mp = per_tick.groupBy("match_id", "period").agg(F.min("minute").alias("_mn"), F.max("minute").alias("_mx"))
    last_minute = F.when(F.col("period") == F.max("period").over(wm),
                         F.when(F.col("_mx") < 90, F.lit(90 + pad - 1)).otherwise(F.col("_mx") + (pad - 1))) \
                   .otherwise(F.col("_mx"))
    seg = per_mp.select("match_id", "period",
                        F.when(F.col("period") == F.min("period").over(wm), F.lit(0))
                         .otherwise(F.col("_mn") * 60).alias("_a"),
                        ((last_minute + 1) * 60).alias("_stop"))
    segs = per_tick.select(*keys).distinct().join(seg, "match_id")

    w = Window.partitionBy(*keys).orderBy("period", "_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    wp = Window.partitionBy(*keys, "period").orderBy("_t")
    steps = per_tick.select(*keys, "period", "_t", F.lead("_t").over(wp).alias("_nt"),
                            *[F.sum(f"_s{i}").over(w).alias(f"_c{i}") for i in range(n)])
    seg_stats = steps.groupBy(*keys, "period").agg(
        F.min("_t").alias("_ft"),
        F.max_by(F.struct(*[F.col(f"_c{i}").alias(f"c{i}") for i in range(n)]), F.col("_t")).alias("_ce"))
    before = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    segs = segs.join(seg_stats, [*keys, "period"], "left").select(
        *keys, "period", "_a", "_stop", "_ft",
        *[F.last(F.col(f"_ce.c{i}"), ignorenulls=True).over(before).alias(f"_b{i}") for i in range(n)])
    # head of each period: from its start to its first shot tick (or its end)
    heads = segs.select(*keys, "period", F.struct(
        (F.col("_a") - 1).alias("a"), F.coalesce("_ft", "_stop").alias("b"),
        *[F.col(f"_b{i}").alias(f"c{i}") for i in range(n)]).alias("g"))
    # after each shot tick: to the next shot tick of the period (or its end)
    tails = steps.join(segs.select(*keys, "period", "_stop"), [*keys, "period"]).select(
        *keys, "period", F.struct(F.col("_t").alias("a"), F.coalesce("_nt", "_stop").alias("b"),
                                  *[F.col(f"_c{i}").alias(f"c{i}") for i in range(n)]).alias("g"))
    gaps = heads.unionByName(tails).filter(F.col("g.b") > F.col("g.a") + 1)
    gap_rows = _dealt_gaps(gaps, keys).select(*keys, "period", *[F.col(f"g.c{i}").alias(o) for i, o in enumerate(out_cols)],
                           F.explode(F.sequence(F.col("g.a") + 1, F.col("g.b") - 1)).alias("_g"))
    grid = gap_rows.select(*keys, "period", (F.col("_g") / 60).cast("int").alias("minute"),
                           (F.col("_g") % 60).cast("int").alias("second"), *out_cols)
    u = shot_rows.unionByName(grid, allowMissingColumns=True)
    cols = {}
    for dst in out_cols:
        v = F.coalesce(F.col(dst), F.lit(0.0))
        cols[dst] = F.round(v, scale) if scale is not None else v
    return u.select("match_id", "team", "period", "minute", "second", "id", *xg_cols,
                    F.coalesce(F.col(goal_col), F.lit(0)).cast("int").alias(goal_col),
                    *[cols[c].alias(c) for c in out_cols], decimal_clock().alias("time"))


def in_clock_order(timeline: DataFrame, by_period: bool = False) -> DataFrame:
    """The timeline sorted by match, team and clock (T5): a range exchange, so
    the order holds over all partitions of the result."""
    return timeline.orderBy("match_id", "team", *_order(by_period))


def timeline_extent(timeline: DataFrame, value_col: str = "cxg", floor: float = 1.0) -> DataFrame:
    """Per match: the last minute, the number of teams and the largest
    cumulative value floored at ``floor`` (A13: what sizes the published
    timeline's axes).  One partial aggregate."""
    return timeline.groupBy("match_id").agg(
        F.max("minute").alias("last_minute"),
        F.countDistinct("team").alias("teams"),
        F.greatest(F.lit(floor), F.max(value_col)).alias("y_max"))


def stoppage_time(events: DataFrame, period: int = 1, regular_end: int = 45) -> DataFrame:
    """Added time of a half per match (V10): clock of the last action of the
    period (by minute, second, id: T6) minus the regular end, 2 dp (X20).
    ``max`` of a struct is a plain aggregate: no sort, no window."""
    last = (events.filter(F.col("period") == period)
                  .groupBy("match_id")
                  .agg(F.max(F.struct("minute", "second", "id")).alias("_l")))
    clock = F.col("_l.minute") + F.col("_l.second") / 60.0
    return last.select("match_id", F.col("_l.minute").alias("last_minute"),
                       F.col("_l.second").alias("last_second"),
                       F.round(clock - regular_end, 2).alias("stoppage"))


def with_match_clock(df: DataFrame, offset: int = 100, out: str = "match_minute") -> DataFrame:
    """Second-half minutes shifted by ``offset``."""
    from pitchlake.functions.geometry import match_clock

    return df.withColumn(out, match_clock("period", "minute", offset))
