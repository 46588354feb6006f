"""Suffix dedup by difference covers, one suffix bucket at a time (operator 8).

Bytes covered by a ``length``-byte string that starts at two or more places
are removed.  The suffixes of the whole corpus are never held at once:

1. Documents are packed into blocks of about ``block_bytes`` bytes.
2. The cover sample, the positions p of a block with p mod v in a difference
   cover of period v, is sorted by its first ``length - v + 1`` bytes, bucket
   by bucket.  For any two positions i, j there is a d < v that puts both i+d
   and j+d into the sample, so two suffixes that tie over ``length`` bytes
   have sample suffixes that tie; the sample's ranks (here: tied or not) tell
   in advance which suffixes can have a long tie.
3. Only suffixes with a tied sample position in reach are sorted: by
   fingerprints (64 + 32 bits) of their first ``length`` bytes, one range of
   fingerprints (bucket) per group and ``passes`` ranges of buckets after one
   another, each pass freeing its shuffle files before the next.
4. Ties mark positions, marked positions cover bytes.

A block sends each distinct fingerprint once, so a passage found in a third of
all documents arrives once per block; buckets have a bounded share of the
distinct fingerprints since fingerprints are uniform.

Null and empty texts have no bytes; texts shorter than ``length`` lose none;
repeated rows are documents like any other, so they remove each other; an
empty table gives no rows; all other columns are carried, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.common import BYTE_VALUE, POWERS, POWERS2, mix, prefix_sums, written

LENGTH = 200
BLOCK_BYTES = 1 << 20
SEGMENT = 1 << 19
PASSES = 4
BUCKET_KEYS = 1 << 20

# fixed values: perfect difference sets by period
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
}


def cover(length: int) -> tuple[int, tuple[int, ...]]:
    """The largest cover whose period leaves a third of ``length`` to tell samples apart."""
    fit = [v for v in COVERS if 3 * v <= 2 * length]
    return (max(fit), COVERS[max(fit)]) if fit else (1, (0,))


def cover_positions(n: int, length: int) -> np.ndarray:
    """Positions of the cover sample in ``n`` bytes, in order."""
    v, d = cover(length)
    p = (np.arange(0, n, v)[:, None] + np.array(d)).ravel()
    return p[p < n]


def window_hashes(data: np.ndarray, size: int, at: np.ndarray, second: bool = False) -> np.ndarray:
    """Hash of the ``size`` bytes at each of the sorted positions ``at``; bounded memory."""
    powers = POWERS2 if second else POWERS
    out = np.zeros(len(at), dtype=np.uint64)
    for first in range(0, len(data), SEGMENT):
        i, j = np.searchsorted(at, [first, first + SEGMENT])
        if i == j:
            continue
        s = prefix_sums(BYTE_VALUE[data[first:first + SEGMENT + size - 1]], powers)
        p = at[i:j] - first
        out[i:j] = mix((s[p + size] - s[p]) * powers.upto(len(s))[1][p])
    return out


# ---------------------------------------------------------------- blocks

def packed(docs: DataFrame, block_bytes: int) -> DataFrame:
    """block, rows (all columns but the text), null (text is null), ends, data."""
    rest = [c for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*rest).alias("row"), F.col("text").cast("string").cast("binary").alias("text"))
    row_type = whole.schema["row"].dataType
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(row_type)),
        T.StructField("null", T.ArrayType(T.BooleanType())), T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("data", T.BinaryType())])

    def pack(batches):
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            rows, texts = b.column(0), b.column(1)
            size = np.array([0 if t is None else len(t) for t in (x.as_buffer() if x.is_valid else None for x in texts)], dtype=np.int64)
            ends = np.cumsum(size)
            at = 0
            while at < len(size):
                base = ends[at] - size[at]
                to = max(at + 1, int(np.searchsorted(ends, base + block_bytes, side="right")))
                own = rows.slice(at, to - at)
                data = b"".join(x.as_py() or b"" for x in texts.slice(at, to - at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + k], pa.int64()),
                     pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), pa.concat_arrays([own])),
                     pa.array([[not x.is_valid for x in texts.slice(at, to - at)]], pa.list_(pa.bool_())),
                     pa.array([(ends[at:to] - base).tolist()], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                    names=["block", "rows", "null", "ends", "data"])
                at, k = to, k + 1

    return whole.mapInArrow(pack, schema)


def valid_starts(ends: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of the first n - size + 1 positions have ``size`` bytes of their own document."""
    m = max(0, n - size + 1)
    edge = np.zeros(m + 1, dtype=np.int32)
    low = np.maximum(ends - size + 1, np.concatenate([[0], ends[:-1]])[:len(ends)])
    np.add.at(edge, np.minimum(low, m), 1)
    np.add.at(edge, np.minimum(ends, m), -1)
    return np.cumsum(edge[:m]) == 0


# ---------------------------------------------------------------- ties

def sorted_keys(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order that sorts the keys, equal ones by place, and the sorted keys.

    Numbers sort several times faster than places by numbers, so the upper bits
    of the keys (without those that all share) are sorted with the places in
    the bits below.  The few keys that differ only further down are put right."""
    n = len(keys)
    if not n:
        return np.zeros(0, dtype=np.int64), keys
    low = np.uint64((1 << (n - 1).bit_length()) - 1)
    mixed = keys << np.uint64(min(63, 64 - int(keys.min() ^ keys.max()).bit_length()))
    mixed &= ~low
    mixed |= np.arange(n, dtype=np.uint64)
    mixed.sort()
    order = (mixed & low).view(np.int64)
    k = keys[order]
    wrong = np.flatnonzero(k[1:] < k[:-1])
    if len(wrong) > 100:
        order = np.argsort(keys, kind="stable")
        return order, keys[order]
    for w in mixed[wrong]:
        i, j = np.searchsorted(mixed, w & ~low), np.searchsorted(mixed, w | low, side="right")
        places = np.sort(order[i:j])
        order[i:j] = places[np.argsort(keys[places], kind="stable")]
        k[i:j] = keys[order[i:j]]
    return order, k


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, first place of each, place of each key among them, how often)."""
    order, k = sorted_keys(keys)
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    at = np.flatnonzero(new)
    place = np.empty(len(k), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return k[at], order[at], place, np.diff(at, append=len(k))


def bucket_bits(keys: float, per_bucket: int) -> int:
    return max(0, int(np.ceil(np.log2(max(1.0, keys / per_bucket)))))


def by_bucket(keys: np.ndarray, bits: int, low: int, high: int):
    """(bucket, from, to) of sorted keys, for the buckets in [low, high)."""
    if not bits:
        yield 0, 0, len(keys)
        return
    edges = np.array([min(b << (64 - bits), (1 << 64) - 1) for b in range(low, high + 1)], dtype=np.uint64)
    at = np.searchsorted(keys, edges)
    if high == 1 << bits:
        at[-1] = len(keys)
    for i, b in enumerate(range(low, high)):
        if at[i + 1] > at[i]:
            yield b, int(at[i]), int(at[i + 1])


def tied(keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """Which (key, check) stand more than once."""
    order, k = sorted_keys(keys)
    c = checks[order]
    same = k[1:] == k[:-1]
    if (same & (c[1:] != c[:-1])).any():
        order = np.lexsort((checks, keys))
        k, c = keys[order], checks[order]
        same = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:][same]] = out[order[:-1][same]] = True
    return out


def ties(sent: DataFrame) -> DataFrame:
    """block, bucket, bits: for the keys that a block has sent to a bucket, in
    their order, whether another block has sent them too."""
    def sort_bucket(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table.column("keys")]
        checks = [np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in table.column("checks")]
        found = tied(np.concatenate(keys), np.concatenate(checks))
        bits, at = [], 0
        for k in keys:
            bits.append(np.packbits(found[at:at + len(k)]).tobytes())
            at += len(k)
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(sort_bucket, "block long, bucket int, bits binary")


SENT = "block long, bucket int, keys binary, checks binary"


def send(block: int, keys: np.ndarray, checks: np.ndarray, bits: int, low: int, high: int) -> pa.RecordBatch:
    parts = list(by_bucket(keys, bits, low, high))
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(parts), pa.int64()), pa.array([b for b, _, _ in parts], pa.int32()),
         pa.array([keys[i:j].tobytes() for _, i, j in parts], pa.binary()),
         pa.array([checks[i:j].tobytes() for _, i, j in parts], pa.binary())], names=["block", "bucket", "keys", "checks"])


def received(keys: np.ndarray, bits: int, answers: list[dict] | None) -> np.ndarray:
    """The answers of all buckets, laid out over the sorted keys of a block."""
    out = np.zeros(len(keys), dtype=bool)
    own = {a["bucket"]: a["bits"] for a in answers or ()}
    for b, i, j in by_bucket(keys, bits, 0, 1 << bits):
        if b in own:
            out[i:j] = np.unpackbits(np.frombuffer(own[b], dtype=np.uint8), count=j - i).astype(bool)
    return out


# ---------------------------------------------------------------- cover sample

def sample_keys(data: np.ndarray, ends: np.ndarray, length: int):
    """(positions, sorted distinct keys, place of each position's key, how often)."""
    v, _ = cover(length)
    size = length - v + 1
    at = cover_positions(max(0, len(data) - size + 1), length)
    at = at[valid_starts(ends, len(data), size)[at]]
    keys, _, place, number = distinct(window_hashes(data, size, at))
    return at, keys, place, number


def send_samples(blocks: DataFrame, length: int, bits: int) -> DataFrame:
    def sampled(batches):
        for b in batches:
            for block, ends, data in zip(b.column("block"), b.column("ends"), b.column("data")):
                _, keys, _, _ = sample_keys(np.frombuffer(data.as_buffer(), np.uint8), np.array(ends.as_py(), np.int64), length)
                yield send(block.as_py(), keys, np.zeros(len(keys), np.uint32), bits, 0, 1 << bits)

    return blocks.select("block", "ends", "data").mapInArrow(sampled, SENT)


def candidate_starts(data: np.ndarray, ends: np.ndarray, length: int, bits: int, answers) -> np.ndarray:
    """Positions whose ``length`` bytes hold a tied sample position in reach."""
    v, _ = cover(length)
    at, keys, place, number = sample_keys(data, ends, length)
    hit = (received(keys, bits, answers) | (number > 1))[place]
    seen = np.zeros(len(data) + v + 1, dtype=np.int32)
    seen[at[hit] + 1] = 1
    seen = np.cumsum(seen, dtype=np.int32)
    ok = valid_starts(ends, len(data), length)
    i = np.arange(len(ok))
    return ok & (seen[i + v] > seen[i])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[from, to) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def candidates(blocks: DataFrame, answers: DataFrame, length: int, bits: int) -> DataFrame:
    """block, starts, sizes, data: the stretches of a block that hold the candidate suffixes."""
    def cut(batches):
        for b in batches:
            for block, ends, data, own in zip(b.column("block"), b.column("ends"), b.column("data"), b.column("own")):
                d = np.frombuffer(data.as_buffer(), np.uint8)
                first, last = runs(candidate_starts(d, np.array(ends.as_py(), np.int64), length, bits, own.as_py()))
                if len(first):
                    size = last - first + length - 1
                    text = b"".join(d[i:i + n].tobytes() for i, n in zip(first.tolist(), size.tolist()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.as_py()], pa.int64()), pa.array([first.tolist()], pa.list_(pa.int64())),
                         pa.array([size.tolist()], pa.list_(pa.int64())), pa.array([text], pa.binary())],
                        names=["block", "starts", "sizes", "data"])

    return with_answers(blocks.select("block", "ends", "data"), answers) \
        .mapInArrow(cut, "block long, starts array<long>, sizes array<long>, data binary")


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    own = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("own"))
    return blocks.join(own, "block", "left")


# ---------------------------------------------------------------- suffixes

def suffix_hashes(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the candidate suffixes; places are offsets in ``data``."""
    at = np.flatnonzero(valid_starts(np.cumsum(sizes), len(data), length))
    return at, window_hashes(data, length, at)


def suffix_keys(data: np.ndarray, sizes: np.ndarray, length: int, bits: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and checks, of the candidate suffixes whose bucket
    is in [low, high): others are dropped before anything is sorted."""
    at, keys = suffix_hashes(data, sizes, length)
    if bits:
        bucket = keys >> np.uint64(64 - bits)
        own = (bucket >= low) & (bucket < high)
        at, keys = at[own], keys[own]
    keys, first, _, _ = distinct(keys)
    return keys, (window_hashes(data, length, at, second=True)[first] >> np.uint64(32)).astype(np.uint32)


def send_suffixes(found: DataFrame, length: int, bits: int, low: int, high: int) -> DataFrame:
    def suffixes(batches):
        for b in batches:
            for block, sizes, data in zip(b.column("block"), b.column("sizes"), b.column("data")):
                keys, checks = suffix_keys(np.frombuffer(data.as_buffer(), np.uint8), np.array(sizes.as_py(), np.int64), length,
                                           bits, low, high)
                yield send(block.as_py(), keys, checks, bits, low, high)

    return found.select("block", "sizes", "data").mapInArrow(suffixes, SENT)


def spans(found: DataFrame, answers: DataFrame, length: int, bits: int) -> DataFrame:
    """block, first, last: the removed stretches [first, last) of each block."""
    def cover_bytes(batches):
        for b in batches:
            for block, starts, sizes, data, own in zip(*(b.column(c) for c in ("block", "starts", "sizes", "data", "own"))):
                size, start = np.array(sizes.as_py(), np.int64), np.array(starts.as_py(), np.int64)
                at, keys = suffix_hashes(np.frombuffer(data.as_buffer(), np.uint8), size, length)
                keys, _, place, number = distinct(keys)
                hit = at[(received(keys, bits, own.as_py()) | (number > 1))[place]]
                run = np.searchsorted(np.cumsum(size), hit, side="right")
                p = start[run] + hit - (np.cumsum(size) - size)[run]
                if len(p):
                    new = np.concatenate([[True], p[1:] > p[:-1] + length])
                    last = p[np.append(np.flatnonzero(new)[1:] - 1, len(p) - 1)] + length
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.as_py()], pa.int64()), pa.array([p[new].tolist()], pa.list_(pa.int64())),
                         pa.array([last.tolist()], pa.list_(pa.int64()))], names=["block", "first", "last"])

    return with_answers(found, answers).mapInArrow(cover_bytes, "block long, first array<long>, last array<long>")


def removed_blocks(docs: DataFrame, length: int, passes: int, block_bytes: int, bucket_keys: int) -> DataFrame:
    """The blocks with their removed stretches."""
    blocks = written(packed(docs, block_bytes), "repeat-blocks")
    n = blocks.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    v, d = cover(length)
    bits = bucket_bits(n * len(d) / v, bucket_keys)
    ranks = written(ties(send_samples(blocks, length, bits)), "repeat-cover")
    found = written(candidates(blocks, ranks, length, bits), "repeat-candidates")
    n = found.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    bits = max(bucket_bits(n, bucket_keys), bucket_bits(passes, 1))
    edges = [(1 << bits) * i // passes for i in range(passes + 1)]
    answers = None
    for low, high in zip(edges, edges[1:]):
        one = written(ties(send_suffixes(found, length, bits, low, high)), "repeat-ties")
        answers = one if answers is None else answers.unionByName(one)
    gone = written(spans(found, answers, length, bits), "repeat-spans")
    return blocks.join(gone, "block", "left")


def kept_parts(ends: list[int], data: bytes, first: list[int] | None, last: list[int] | None):
    """(kept bytes, removed bytes, removed runs) of each document of a block."""
    gone = np.zeros(len(data), dtype=bool)
    for i, j in zip(first or (), last or ()):
        gone[i:j] = True
    d = np.frombuffer(data, np.uint8)
    at = 0
    for end in ends:
        g = gone[at:end]
        yield (d[at:end][~g].tobytes(), int(g.sum()), len(runs(g)[0])) if first and g.any() else (data[at:end], 0, 0)
        at = end


def report(docs: DataFrame, length: int = LENGTH, passes: int = PASSES, block_bytes: int = BLOCK_BYTES,
           bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    rows = removed_blocks(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length, passes, block_bytes, bucket_keys)

    def digests(batches):
        for b in batches:
            for own, ends, data, first, last in zip(*(b.column(c) for c in ("rows", "ends", "data", "first", "last"))):
                out = [(len(k) + r, r, s, hashlib.sha256(k).hexdigest())
                       for k, r, s in kept_parts(ends.as_py(), data.as_py(), first.as_py(), last.as_py())]
                n, r, s, h = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [own.values.field("doc_id"), pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(h)],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.select("rows", "ends", "data", "first", "last").mapInArrow(
        digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, passes: int = PASSES, block_bytes: int = BLOCK_BYTES,
                   bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """The documents with the repeated bytes cut out of ``text``; a character
    that loses some of its bytes goes.  Every row stays, null texts stay null,
    other columns are unchanged."""
    rows = removed_blocks(docs, length, passes, block_bytes, bucket_keys)
    out = T.StructType([T.StructField("row", rows.schema["rows"].dataType.elementType), T.StructField("_text", T.StringType())])

    def texts(batches):
        for b in batches:
            for own, null, ends, data, first, last in zip(*(b.column(c) for c in ("rows", "null", "ends", "data", "first", "last"))):
                kept = [k.decode("utf-8", "ignore") for k, _, _ in kept_parts(ends.as_py(), data.as_py(), first.as_py(), last.as_py())]
                t = pa.array([None if x else k for k, x in zip(kept, null.as_py())], pa.string())
                yield pa.RecordBatch.from_arrays([own.values, t], names=["row", "_text"])

    cut = rows.select("rows", "null", "ends", "data", "first", "last").mapInArrow(texts, out)
    return cut.select(*[F.col("_text").cast(docs.schema["text"].dataType).alias("text") if c == "text" else F.col("row")[c].alias(c)
                        for c in docs.columns])
