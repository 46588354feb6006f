"""Approximate nearest neighbours by multi-index hashing (operator 2).

A rotation learned by iterative quantisation on a bounded sample turns every
vector into a binary code.  Codes are cut into substrings and each substring
is indexed: its rows in order of its value, with the offset of every value.
If two codes differ in at most r bits, then in one of m substrings they differ
in at most floor(r / m), so probing all values that near in each table
retrieves every code within the radius; their vectors are then ranked by the
exact cosine in double precision.

The radius is not guessed: the exact neighbours of ``calibration`` sampled
queries among all rows give the distance within which a share ``target`` of
true neighbours lies.  The index is kept in blocks of ``block`` rows; queries
come in blocks too, each pair of blocks is one unit of work, and each unit
returns the k best of its block for each of its queries, so that a value with
a third of all rows is spread over all blocks.  Queries that find fewer
than k rows within the radius go through the same blocks again with a larger
one, up to all bits, so each query gets k rows if there are so many.  Sample, calibration queries
and blocks are bounded whatever the input.

Vectors that are null, zero, of another length than most, or that hold null or
non-finite components take no part.  Equal vectors are ranked by vec_id;
every row is a candidate of its own, but rows of a query's vec_id are none of
its; a query row that is repeated asks once, and rows of one vec_id with other
vectors ask each for themselves; an empty table gives no rows; a query without
candidates has no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitchlake.llm.common import written

K = 5
EVERY = 50
SAMPLE = 5_000
CALIBRATION = 64
TARGET = 0.97
BLOCK = 1 << 14
QUERY_BLOCK = 1 << 12
SUBSTRING_BITS = 16


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id, v: the vectors that take part, as doubles."""
    v = F.col("embedding").cast("array<double>")
    rows = embeddings.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")) \
        .where(F.size("v") > 0) \
        .where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))) \
        .where(F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    return rows.join(F.broadcast(sizes.select("d")), F.size("v") == F.col("d")).drop("d")


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def normed(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def cosines(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosine of every row of x with q, each from its own sums."""
    return (x * q).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((q * q).sum()))


class Codes:
    """A learned rotation and the codes it gives."""

    def __init__(self, x: np.ndarray, rounds: int = 30, seed: int = 7):
        x = normed(x)
        self.mean = x.mean(axis=0)
        d = x.shape[1]
        r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0]
        v = x - self.mean
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(v @ r > 0, 1.0, -1.0).T @ v)
            r = (u @ w).T
        self.rotation = r
        # as many bits as dimensions, rounded to whole substrings
        self.bits = -(-d // SUBSTRING_BITS) * SUBSTRING_BITS

    def encode(self, x: np.ndarray) -> np.ndarray:
        """One row of 16-bit substrings for each vector."""
        b = np.zeros((len(x), self.bits), dtype=np.uint8)
        b[:, :x.shape[1]] = (normed(x) - self.mean) @ self.rotation > 0
        return np.packbits(b, axis=1, bitorder="little").view("<u2")


def distances(codes: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ q).sum(axis=1, dtype=np.int64)


def masks(radius: int) -> np.ndarray:
    """All 16-bit values with at most ``radius`` bits set."""
    if radius >= SUBSTRING_BITS:
        return np.arange(1 << SUBSTRING_BITS, dtype=np.uint16)
    out = [0]
    for n in range(1, radius + 1):
        out += [sum(1 << i for i in c) for c in combinations(range(SUBSTRING_BITS), n)]
    return np.array(out, dtype=np.uint16)


class MultiIndex:
    """The substring tables of a block of codes."""

    def __init__(self, codes: np.ndarray, radius: int):
        self.codes, self.radius = codes, radius
        self.masks = masks(radius // codes.shape[1])
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        values = np.arange((1 << SUBSTRING_BITS) + 1)
        self.offsets = [np.searchsorted(codes[o, j], values) for j, o in enumerate(self.order)]

    def within(self, q: np.ndarray) -> np.ndarray:
        """Rows whose code differs from q in at most ``radius`` bits."""
        found = np.zeros(len(self.codes), dtype=bool)
        for j, (order, at) in enumerate(zip(self.order, self.offsets)):
            probe = (self.masks ^ q[j]).astype(np.int64)
            first, n = at[probe], at[probe + 1] - at[probe]
            some = n > 0
            first, n = first[some], n[some]
            ends = np.cumsum(n)
            if len(ends):
                found[order[np.arange(ends[-1]) + np.repeat(first - (ends - n), n)]] = True
        rows = np.flatnonzero(found)
        return rows[distances(self.codes[rows], q) <= self.radius]


def best(ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller id."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        rows = np.flatnonzero(score >= edge)
    else:
        rows = np.arange(len(score))
    return rows[np.lexsort((ids[rows], -score[rows]))][:k]


def learn(rows: DataFrame, sample: int, calibration: int, target: float, k: int) -> tuple[Codes, int] | None:
    """The codes and the radius.  ``rows`` are those of :func:`usable`."""
    order = F.xxhash64("vec_id", F.lit(3))
    x = np.array([r[0] for r in rows.orderBy(order, "vec_id").limit(sample).select("v").collect()])
    if not len(x):
        return None
    codes = Codes(x)
    asked = rows.orderBy(F.xxhash64("vec_id", F.lit(5)), "vec_id").limit(calibration).collect()
    qid, q = np.array([r[0] for r in asked]), np.array([r[1] for r in asked])
    shared = rows.sparkSession.sparkContext.broadcast((codes, qid, q, codes.encode(q)))

    def nearest(batches):
        codes, qid, q, qcode = shared.value
        for b in batches:
            ids, x = b.column(0).to_numpy(), matrix(b.column(1))
            if not len(ids):
                continue
            own, score = codes.encode(x), normed(x) @ normed(q).T
            for i in range(len(q)):
                s = np.where(ids == qid[i], -2.0, score[:, i])
                top = best(ids, s, k)
                top = top[s[top] > -2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top), i)), pa.array(s[top]), pa.array(ids[top]),
                     pa.array(distances(own[top], qcode[i]))], names=["q", "score", "vec_id", "bits"])

    near = rows.select("vec_id", "v").mapInArrow(nearest, "q long, score double, vec_id long, bits long")
    true = near.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))) \
        .where(F.col("rank") <= k).select("bits").collect()
    far = sorted(r[0] for r in true)
    radius = far[min(len(far) - 1, int(np.ceil(target * len(far))) - 1)] if far else 0
    return codes, int(radius)


def search(embeddings: DataFrame, every: int = EVERY, k: int = K, sample: int = SAMPLE, calibration: int = CALIBRATION,
           target: float = TARGET, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose
    vec_id is divisible by ``every``, among all other rows."""
    rows = written(usable(embeddings), "ann-vectors")
    learned = learn(rows, sample, calibration, target, k)
    schema = "query_id long, query long, vec_id long, score double"
    if learned is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    is_query = F.col("vec_id") % every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // query_block))
    shared = rows.sparkSession.sparkContext.broadcast(learned[0])

    def units(side, own: int, other: int, salt: int, *more: str):
        """Rows of a side with the block pairs that they are part of."""
        at = F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(own))
        others = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        unit = F.col("o") * own + F.col("b") if salt == 1 else F.col("b") * other + F.col("o")
        return side.select("vec_id", "v", *more, at.alias("b"), others.alias("o")).select(unit.alias("unit"), "vec_id", "v", *more)

    index = units(rows, blocks, query_blocks, 1)
    codes, radius = learned

    def retrieve(radius: int, left: pa.Table, right: pa.Table) -> pa.Table:
        codes = shared.value
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            ids, x = left.column("vec_id").to_numpy(), matrix(left.column("v").combine_chunks())
            qid, q = right.column("vec_id").to_numpy(), matrix(right.column("v").combine_chunks())
            query = right.column("query").to_numpy()
            tables = MultiIndex(codes.encode(x), radius)
            for i, code in enumerate(codes.encode(q)):
                r = tables.within(code)
                r = r[ids[r] != qid[i]]
                s = cosines(x[r], q[i])
                top = best(ids[r], s, k)
                out.append((np.full(len(top), qid[i]), np.full(len(top), query[i]), ids[r][top], s[top]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        return pa.table({"query_id": cols[0], "query": cols[1], "vec_id": cols[2], "score": cols[3]})

    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")).cast("int")

    def nearest(asked: DataFrame, radius: int) -> DataFrame:
        queries = units(asked, query_blocks, blocks, 2, "query")
        found = index.groupBy("unit").cogroup(queries.groupBy("unit")) \
            .applyInArrow(lambda key, left, right: retrieve(radius, left, right), schema)
        top = found.select("query_id", "query", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
        return written(top, "ann-nearest")

    # distinct queries, numbered; the write keeps their numbers
    asked = written(rows.where(is_query).distinct().withColumn("query", F.monotonically_increasing_id()), "ann-queries")
    out = None
    while True:
        top = nearest(asked, radius)
        full = top.where(F.col("rank") == k).select("query").distinct()
        short = asked.join(full, "query", "left_anti")
        last = radius >= codes.bits or short.isEmpty()
        # a query without k rows is asked again, and its rows are those of its last pass
        done = top if last else top.join(full, "query", "left_semi").select(top.columns)
        out = done if out is None else out.unionByName(done)
        if last:
            return out.drop("query")
        asked, radius = written(short, "ann-short"), min(codes.bits, max(2 * radius, radius + 8))
