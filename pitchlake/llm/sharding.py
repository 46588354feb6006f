"""Histogram-sort sharding (operator 4), DataFrame functions only.

Law ``bytes``: shards of nearly equal bytes.  By default rows of equal text are
always in one shard, which no splitter cuts; with ``split_equal`` a splitter can
fall between them, by a hash of doc_id, so that a text with a third of all bytes
fills its share of shards like any other.  Rows are ordered by a 64-bit hash of their text; the shard
boundaries (splitters) are found by counting: candidate keys (probes) are laid
into the bracket around every splitter, one aggregation counts the exact bytes
below each probe, the brackets shrink, and this repeats until each splitter is
within ``tolerance`` of its share or no second key is left in its bracket.  Only
then are rows exchanged, once, already narrow (no texts).

Slots number the rows of a shard without gaps.  A shard is cut into bins of
about ``rows_per_bin`` rows, by key and then by a hash of doc_id, so that a
text with a third of all rows is numbered by many tasks; bin offsets come from
the bin counts.  Order within a shard: bin, key, doc_id.

Null texts have size 1 and are a group of their own; an empty table gives no
rows; repeated rows each get a slot; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import written

SHARDS = 8
TOLERANCE = 0.002
PROBES = 32
ROWS_PER_BIN = 1_000_000
# a splitter is key * WIDE + place, where place tells rows of equal text apart
WIDE = 1 << 64
LOW, HIGH = -(1 << 63) * WIDE, (1 << 63) * WIDE


def sized_rows(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, key and place; no text."""
    raw = F.col("text").cast("string").cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(raw), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64("text", F.lit(1)).alias("key"),
        F.xxhash64(F.col("doc_id").cast("long"), F.lit(2)).alias("place"))


def below(bound: int) -> Column:
    """Whether a row is before a bound."""
    key, place = F.col("key"), bound % WIDE
    if not place:
        return key < F.lit(bound // WIDE)
    return (key < F.lit(bound // WIDE)) | (key == F.lit(bound // WIDE)) & (F.col("place") < F.lit(place - (1 << 63)))


def interval(bounds: list[int], first: int = 0) -> Column:
    """Number of bounds that are <= the row, as a balanced tree of comparisons."""
    if not bounds:
        return F.lit(first)
    m = len(bounds) // 2
    return F.when(below(bounds[m]), interval(bounds[:m], first)) \
        .otherwise(interval(bounds[m + 1:], first + m + 1))


def probes_between(low: int, high: int, n: int, unit: int = WIDE) -> list[int]:
    """At most ``n`` multiples of ``unit`` evenly laid strictly between two."""
    low, high = low // unit, high // unit
    return sorted(unit * p for p in {low + (high - low) * i // (n + 1) for i in range(1, n + 1)} - {low, high})


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES,
              split_equal: bool = False) -> list[int]:
    """The first row, key * WIDE + place, of every shard but the first.  What reaches the driver
    is one count per probe: at most ``probes`` per splitter and round."""
    unit = 1 if split_equal else WIDE
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    goal = [total * i / shards for i in range(1, shards)]
    # a bracket: the key, the exact bytes and the rows below it, at either end
    bracket = {i: ((LOW, 0, 0), (HIGH, total, n_rows)) for i in range(shards - 1)}
    done: dict[int, int] = {}
    while total and len(done) < shards - 1:
        asked = sorted({p for i, (a, b) in bracket.items() if i not in done
                        for p in probes_between(a[0], b[0], probes, unit)})
        counts = {r[0]: r[1:] for r in rows.groupBy(interval(asked).alias("i"))
                  .agg(F.sum("size"), F.count(F.lit(1))).collect()} if asked else {}
        size, number, known = 0, 0, []
        for i, p in enumerate(asked):
            more = counts.get(i, (0, 0))
            size, number = size + more[0], number + more[1]
            known.append((p, size, number))
        for i in range(shards - 1):
            if i in done:
                continue
            a, b = bracket[i]
            for x in known:
                if a[0] < x[0] <= b[0] and x[1] <= goal[i]:
                    a = x
            for x in reversed(known):
                if a[0] < x[0] < b[0] and x[1] >= goal[i]:
                    b = x
            bracket[i] = (a, b)
            near = min((a, b), key=lambda x: abs(x[1] - goal[i]))
            settled = b[2] - a[2] <= 1 or not probes_between(a[0], b[0], probes, unit)
            if settled or abs(near[1] - goal[i]) <= tolerance * total / shards:
                done[i] = near[0]
    # a key wider than a shard that is not split leaves some splitters equal: those shards stay empty
    return sorted(done.get(i, HIGH) for i in range(shards - 1))


def shard_rows(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE,
               probes: int = PROBES, rows_per_bin: int = ROWS_PER_BIN, split_equal: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    rows = written(sized_rows(docs), "shard-keys")
    cuts = [c for c in splitters(rows, shards, tolerance, probes, split_equal)]
    inside = [c for c in cuts if LOW < c < HIGH]
    # cuts at either end of the key space bound empty shards
    shard = interval(inside, sum(c <= LOW for c in cuts)) if inside \
        else F.lit(sum(c <= LOW for c in cuts))
    slices = max(1, -(-rows.count() // rows_per_bin))
    bin_key = F.floor((F.col("key") / F.lit(2.0**64) + 0.5) * slices).cast("long")
    placed = rows.select("*", shard.cast("int").alias("shard"), bin_key.alias("bin"),
                         F.pmod(F.xxhash64("doc_id"), F.lit(min(slices, 256))).alias("part"))
    at = ["shard", "bin", "part"]
    offsets = placed.groupBy(*at).agg(F.count(F.lit(1)).alias("n")).select(
        *at, (F.sum("n").over(Window.partitionBy("shard").orderBy("bin", "part")
                              .rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("before"))
    numbered = placed.withColumn("rank", F.row_number().over(
        Window.partitionBy(*at).orderBy("key", "doc_id", "text_crc32", "size")))
    return numbered.join(offsets, at).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.col("rank") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
