"""Helpers shared by the training-data operators."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitchlake.session import scratch_dir


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Inside, the shuffle files of a written table go as soon as it is
    written, so that the passes of one operator do not pile up on disk."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows as Parquet into the shared folder of
    ``spark.checkpoint.dir`` and read them back.  Any executor can read them,
    so a lost one costs nothing, and the optimiser sees the written size.  The
    files go when the session ends."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out() -> "F.Column":
    """The fold that no model learns from: crc32(doc_id as text) mod 4 is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample_by_class(rows: DataFrame, label: str, bound: int) -> DataFrame:
    """At most ``bound`` rows of (doc_id, ``label``) for each label, those of
    the least hash of doc_id.  The labels are counted first, so that only a few
    times ``bound`` rows of a label meet in one task, whatever its size."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}  # one per label
    if not counts:
        return rows
    part = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, (4 * bound + 100) / n))])
    h = F.xxhash64("doc_id")
    low = rows.where(h / F.lit(2.0**64) + 0.5 <= F.element_at(part, F.col(label)))
    rank = F.row_number().over(Window.partitionBy(label).orderBy(h, "doc_id"))
    return low.withColumn("rank", rank).where(F.col("rank") <= bound).drop("rank")


# ---------------------------------------------------------------- bytes and words

# fixed values: lower-casing touches A-Z only; word bytes are 0-9, a-z and
# every byte of a code point from U+0080 on
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.zeros(256, dtype=np.uint8)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = 1

SEGMENT = 1 << 20

_rng = np.random.default_rng(20240607)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE2 = 0xC2B2AE3D27D4EB4F


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            m = max(n, 4096, 2 * len(self.up))

            def table(b: int) -> np.ndarray:
                t = np.full(m, b, dtype=np.uint64)
                t[0] = 1
                return np.multiply.accumulate(t)

            self.up, self.down = table(self.base), table(self.inverse)
        return self.up[:n], self.down[:n]


POWERS, POWERS2 = Powers(BASE), Powers(BASE2)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_sums(values: np.ndarray, powers: Powers = POWERS) -> np.ndarray:
    """S with S[j] - S[i] = sum of values[k] * base**k for k from i to j-1."""
    up, _ = powers.upto(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=out[1:])
    return out


def segments(data: np.ndarray, is_word: np.ndarray, size: int = SEGMENT):
    """(start, end) parts of at most ``size`` bytes, or longer where one word
    is; no part ends inside a word."""
    n, at = len(data), 0
    while at < n:
        end = min(n, at + size)
        if end < n and is_word[end - 1] and is_word[end]:
            back = np.flatnonzero(is_word[at:end] == 0)
            if len(back):
                end = at + int(back[-1]) + 1
            else:
                ahead = np.flatnonzero(is_word[end:] == 0)
                end = end + int(ahead[0]) if len(ahead) else n
        yield at, end
        at = end


def words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the lower-cased words of a UTF-8 text."""
    data = LOWER[np.frombuffer(text, dtype=np.uint8)]
    flag = WORD_BYTE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag, [0]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, dtype=np.uint64)
    if len(data) <= SEGMENT:
        s = prefix_sums(BYTE_VALUE[data])
        _, down = POWERS.upto(len(s))
        return starts, ends, mix((s[ends] - s[starts]) * down[starts])
    parts = []
    for a, b in segments(data, flag):
        i, j = np.searchsorted(starts, [a, b])
        s = prefix_sums(BYTE_VALUE[data[a:b]])
        _, down = POWERS.upto(len(s))
        parts.append(mix((s[ends[i:j] - a] - s[starts[i:j] - a]) * down[starts[i:j] - a]))
    return starts, ends, np.concatenate(parts)


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the windows of ``n`` consecutive values."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = hashes[:m].copy()
    for j in range(1, n):
        acc *= np.uint64(BASE2)
        acc += hashes[j:j + m]
    return mix(acc)
