"""Benchmark decontamination (operator 3).

The benchmark's word windows become a set of hashes that every task holds;
documents are scanned window by window against it, each hit is verified word
by word, and the hit words give the spans to remove or the documents to drop.

The set is broadcast in parts of at most ``max_broadcast`` windows (some 220 MB
in a worker).  The driver holds one part at a time, the documents are scanned
against one part after another, the hits of each are written before the next is
collected, and those of all parts are put together; one part is the common case.

Null texts have no words and hit nothing; texts of any length are scanned whole;
items without words have no windows; equal items all count; repeated documents are
rows of their own; an empty benchmark hits nothing and an empty table of documents
gives no rows; columns besides the named ones are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import LOWER, shingles, words, written

WINDOW = 10
MAX_BROADCAST = 300_000

HIT_SCHEMA = "doc_id long, row long, n_words long, hits array<struct<first:int,last:int>>, items array<string>"


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, n, grams) with one row per distinct window of an item, its
    words joined by a space.  An item of fewer words, but not none, is one
    window."""
    low = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = F.regexp_extract_all(low, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), w.alias("w")).where("size(w) > 0")
    return items.select(
        "item_id", F.least(F.size("w"), F.lit(window)).alias("n"),
        F.explode(F.expr(f"transform(sequence(1, greatest(size(w) - {window} + 1, 1)),"
                         f" i -> array_join(slice(w, i, {window}), ' '))")).alias("gram")).distinct()


class WindowSet:
    """Windows by length: sorted hashes, and the exact words behind each."""

    def __init__(self, rows: list[tuple[str, int, str]]):
        self.items: dict[int, dict[bytes, list[str]]] = defaultdict(lambda: defaultdict(list))
        for item, n, gram in rows:
            self.items[n][gram.encode()].append(item)
        self.hashes = {}
        for n, grams in self.items.items():
            found = [shingles(words(g)[2], n) for g in grams]
            self.hashes[n] = np.unique(np.concatenate(found))
        self.items = {n: dict(g) for n, g in self.items.items()}

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, merged ranges [first, last) of hit words, items hit."""
        starts, ends, h = words(text)
        ranges, items = [], set()
        for n, sought in self.hashes.items():
            w = shingles(h, n)
            if not len(w):
                continue
            at = np.searchsorted(sought, w)
            at[at == len(sought)] = 0
            for i in np.flatnonzero(sought[at] == w).tolist():
                gram = b" ".join(LOWER[np.frombuffer(text[starts[k]:ends[k]], dtype=np.uint8)].tobytes()
                                 for k in range(i, i + n))
                own = self.items[n].get(gram)
                if own:
                    ranges.append((i, i + n))
                    items.update(own)
        return len(starts), merged(ranges), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def window_parts(benchmark: DataFrame, window: int, max_broadcast: int):
    """(number of parts, broadcast part) for each part of about ``max_broadcast``
    windows, one collected after another.  The items of one window are dealt
    out too, so a window that very many items have is in many parts."""
    found = benchmark_windows(benchmark, window)
    k = max(1, -(-found.count() // max_broadcast))
    if k > 1:
        found = written(found, "contamination-windows")
    part = F.pmod(F.xxhash64("gram", "item_id"), F.lit(k))
    for i in range(k):
        yield k, found.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, [tuple(r) for r in found.where(part == i).collect()]))


_held: dict[str, "WindowSet"] = {}


def window_set(shared) -> "WindowSet":
    """The set of a broadcast part, made once in each worker; only the last is held."""
    name, rows = shared.value
    if name not in _held:
        _held.clear()
        _held[name] = WindowSet(rows)
    return _held[name]


def scan_parts(rows: DataFrame, benchmark: DataFrame, window: int, max_broadcast: int) -> DataFrame:
    """row, doc_id, n_words, hits, items for rows of (row, doc_id, text), each
    row number once: the hits of all parts together."""
    out = None
    for parts, shared in window_parts(benchmark, window, max_broadcast):
        def scan(batches, shared=shared):
            sought = window_set(shared)
            for b in batches:
                n, hits, items = [], [], []
                for t in b.column("text"):
                    k, r, i = sought.scan((t.as_py() or "").encode())
                    n.append(k)
                    hits.append([{"first": x, "last": y} for x, y in r])
                    items.append(sorted(i))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("row"), pa.array(n, pa.int64()),
                     pa.array(hits, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                     pa.array(items, pa.list_(pa.string()))], names=["doc_id", "row", "n_words", "hits", "items"])

        one = rows.mapInArrow(scan, HIT_SCHEMA)
        if parts == 1:
            return one
        one = written(one, "contamination-hits")
        shared.unpersist()
        out = one if out is None else out.unionByName(one)
    # a row's hits of all parts meet: one row a part
    return out.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        merge_ranges(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per document: doc_id, n_words, hits (merged ranges of hit word
    positions), items (sorted ids of the items with occurring windows)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("row", F.monotonically_increasing_id())
    if benchmark_windows(benchmark, window).count() > max_broadcast:
        rows = written(rows, "contamination-rows")  # rows of several scans meet by their number
    return scan_parts(rows, benchmark, window, max_broadcast).drop("row")


def merge_ranges(col):
    last = lambda acc: F.element_at(acc, F.lit(-1))
    return F.aggregate(
        F.array_sort(col), F.expr("cast(array() as array<struct<first:int,last:int>>)"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["first"] <= last(acc)["last"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1),
                     F.array(F.struct(last(acc)["first"].alias("first"),
                                      F.greatest(last(acc)["last"], x["last"]).alias("last")))))
        .otherwise(F.concat(acc, F.array(x))))


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
           max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + (x["last"] - x["first"]))
    return scan_documents(docs, benchmark, window, max_broadcast).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """The documents without any hit, columns unchanged.  The verdict is made
    where the row is, so no text is shuffled."""
    out = docs
    for parts, shared in window_parts(benchmark, window, max_broadcast):
        def clean(batches, shared=shared):
            sought = window_set(shared)
            for b in batches:
                keep = [not sought.scan((t.as_py() or "").encode())[1] for t in b.column("text")]
                yield b.filter(pa.array(keep, pa.bool_()))

        out = out.mapInArrow(clean, out.schema)
        if parts > 1:
            out = written(out, "contamination-kept")
            shared.unpersist()
    return out


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                 max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """All documents, with the hit words, and what stands between words of the
    same hit range, cut out of ``text``.  Hits are judged on the input, not on
    what is left of it."""
    end = "_" * max(len(c) for c in docs.columns)  # no column ends so
    row, hits = "row" + end, "hits" + end
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "contamination-rows")
    found = scan_parts(rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                       benchmark, window, max_broadcast).where("size(hits) > 0").select(F.col("row").alias(row), F.col("hits").alias(hits))
    both = rows.join(found, row, "left").drop(row)
    at, of = both.columns.index("text"), both.columns.index(hits)

    def cut(batches):
        for b in batches:
            texts = []
            for t, ranges in zip(b.column(at), b.column(of).to_pylist()):
                text = t.as_py()
                if ranges:
                    raw = text.encode()
                    starts, ends, _ = words(raw)
                    kept, last = [], 0
                    for r in ranges:
                        kept.append(raw[last:starts[r["first"]]])
                        last = ends[r["last"] - 1]
                    text = b"".join([*kept, raw[last:]]).decode()
                texts.append(text)
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type)).drop_columns([hits])

    return both.mapInArrow(cut, docs.schema)


ORACLE = """
with d as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from documents),
b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') w from benchmark),
g as (
  select distinct item_id, least(len(w), 10) n,
    array_to_string(w[i:i + least(len(w), 10) - 1], ' ') gram
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) i from b where len(w) > 0)),
lens as (select distinct n from g),
h as (
  select p.doc_id, p.i, p.n, g.item_id
  from (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') gram
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) i from d, lens where len(w) >= n)) p
  join g on g.n = p.n and g.gram = p.gram),
hit as (select doc_id, count(distinct k) n_hit from (select doc_id, unnest(range(i, i + n)) k from h) group by 1),
it as (
  select doc_id, count(*) n_items, string_agg(x, ',' order by x) s
  from (select distinct doc_id, cast(item_id as varchar) x from h) group by 1)
select d.doc_id, cast(coalesce(len(d.w), 0) as bigint) n_words, coalesce(n_hit, 0) n_hit,
  coalesce(n_items, 0) n_items, sha256(coalesce(s, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hit using (doc_id) left join it using (doc_id)
"""
__all__ = ["benchmark_windows", "drop_contaminated", "remove_spans", "report", "scan_documents"]
