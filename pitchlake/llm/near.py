"""Order MinHash near-duplicates (operator 6).

A text's k-mers are its shingles of five words, each labelled with the number
of its earlier occurrences, which makes them distinct.  A sketch takes the
``length`` labelled k-mers of least hash and keeps them in text order; texts
share a sketch with a probability that grows with the share of k-mers that
they have in common in the same order, so moved text counts against them.
There are ``sketches`` of them, and texts that share one are candidates.
Sketches of short texts are too few k-mers to agree by chance, so texts of up to
``SHORT`` k-mers are candidates also if they share one of their least k-mers, as
any two that can reach the similarity do.

Candidates are verified by banded alignment of their labelled k-mers: the
longest common subsequence L with positions at most (a + b) / 9 apart, where a
and b are the lengths, and similarity L / (a + b - L).  At 0.8 or more no
match can lie outside the band, so the band costs nothing.

Work: texts of the same words are one class from the start (grouped by a
fingerprint).  In a bucket each member is compared with a hub, the member that
shares most sketches with others.  Members that do not reach it are compared
with those others that still can be near to them by what each adds to the hub
(:func:`stray_pairs`).  So every pair in a bucket is verified, in one class
already or shown to be too far apart, without all pairs of a group of copies.
Classes are connected components, found by Spark joins.

Texts of one to four words are one shingle.  Texts without words are copies of
equal texts only; null texts and null doc_ids are classes of their own; ties
go to the smaller doc_id; an empty table gives no rows; repeated rows keep
theirs; several texts under one doc_id are texts of their own, each with the
class of its words.  Extra columns are carried by :func:`keep_first` and ignored else.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlake.llm.common import POWERS, mix, shingles, words, written

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 32
LENGTH = 5
SHORT = 40
CELLS = 1 << 15
FREQUENT, PART = 8, 16

_rng = np.random.default_rng(611)
SEEDS = _rng.integers(1, 2**63, 256, dtype=np.uint64)


def labelled(text: str | None, n: int = SHINGLE) -> np.ndarray:
    """Hashes of the k-mers of a text, each with its occurrence number."""
    h = words((text or "").encode("utf-8", "surrogatepass"))[2]
    if not len(h):
        return h
    s = shingles(h, min(n, len(h)))
    order = np.argsort(s, kind="stable")
    o = s[order]
    new = np.concatenate([[True], o[1:] != o[:-1]])
    if new.all():
        return s
    start = np.flatnonzero(new)
    nth = np.arange(len(o)) - np.repeat(start, np.diff(np.append(start, len(o))))
    out = s.copy()
    out[order] = np.where(nth > 0, mix(o + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), o)
    return out


def sketch(kmers: np.ndarray, sketches: int = SKETCHES, length: int = LENGTH) -> np.ndarray:
    """One key for each sketch: its least k-mers in text order."""
    n = len(kmers)
    place = np.broadcast_to(np.arange(n), (sketches, n)) if n <= length else np.zeros((sketches, length), np.int64)
    # few hashes are low enough to matter; where a sketch has too few of them, all are looked at
    low = np.uint64(min((1 << 64) - 1, (2 * length + 10 << 64) // max(n, 1)))
    step = min(sketches, max(1, CELLS // max(n, 1)))
    for first in range(0, sketches if n > length else 0, step):
        h = kmers[None, :] ^ SEEDS[first:min(sketches, first + step), None]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        at = np.flatnonzero(h.ravel() < low)
        row = at // n
        count = np.bincount(row, minlength=len(h))
        if count.min() < length:
            place[first:first + step] = np.argpartition(h, length - 1, axis=1)[:, :length]
            continue
        start = np.cumsum(count) - count
        few = np.full((len(h), int(count.max())), (1 << 64) - 1, dtype=np.uint64)
        few[row, np.arange(len(at)) - start[row]] = h.ravel()[at]
        least = np.argpartition(few, length - 1, axis=1)[:, :length]
        place[first:first + step] = (at - row * n)[start[:, None] + least]
    in_order = np.sort(place, axis=1)
    return mix((mix(kmers)[in_order] * POWERS.upto(in_order.shape[1])[0]).sum(axis=1, dtype=np.uint64))


def least_kmers(kmers: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Keys of the k-mers of least hash of a short text: as many as leave fewer
    of the others than any text that reaches the similarity shares with it."""
    n = len(kmers)
    if n > SHORT:
        return np.zeros(0, dtype=np.uint64)
    return np.sort(mix(kmers))[:n - max(1, int(np.ceil(similarity * n - 1e-9))) + 1]


def alignment(a: np.ndarray, b: np.ndarray) -> float:
    """L / (a + b - L) of the banded longest common subsequence of two arrays
    without repeated values; exact where it is 0.8 or more."""
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) * 9 <= len(a) + len(b)
    i, j = i[near], j[near]
    tails: list[int] = []  # least last position of a common subsequence of each length
    for x in j[np.argsort(i)].tolist():
        at = bisect_left(tails, x)
        if at == len(tails):
            tails.append(x)
        else:
            tails[at] = x
    return len(tails) / (len(a) + len(b) - len(tails))


def fingerprints(docs: DataFrame, sketches: int, length: int, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, print (of the text), f1, f2 (of the word sequence), n (k-mers),
    keys (of the sketches, then of the least k-mers of a short text)."""
    def of(batches):
        for b in batches:
            f1, f2, n, keys = [], [], [], []
            for t in b.column("text"):
                text = t.as_py()
                h = words(text.encode("utf-8", "surrogatepass"))[2]
                k = labelled(text)
                # texts without words: the text itself, under a first value of its own
                f = h if len(h) else np.frombuffer(b"\0" + text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
                w = f * (np.arange(len(f), dtype=np.uint64) * np.uint64(2) + np.uint64(1))
                f1.append(int(mix(np.add.reduce(mix(w + np.arange(len(f), dtype=np.uint64)), keepdims=True))[0].view(np.int64)))
                f2.append(int(mix(np.bitwise_xor.reduce(mix(w ^ np.uint64(0x5851F42D4C957F2D)), keepdims=True) + np.uint64(len(f)))[0].view(np.int64)))
                n.append(len(k))
                keys.append(np.concatenate([sketch(k, sketches, length), least_kmers(k, similarity)]).view(np.int64) if len(k)
                            else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("print"), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(n, pa.int32()),
                 pa.array(keys, pa.list_(pa.int64()))], names=["doc_id", "print", "f1", "f2", "n", "keys"])

    return docs.where("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64("text").alias("print")) \
        .mapInArrow(of, "doc_id long, print long, f1 long, f2 long, n int, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of representatives whose alignment reaches ``similarity``."""
    def check(batches):
        for b in batches:
            keep, last, kmers = [], None, None
            for x, y in zip(b.column("text_a"), b.column("text_b")):
                x = x.as_py()
                if x != last:
                    last, kmers = x, labelled(x)
                keep.append(alignment(kmers, labelled(y.as_py())) >= similarity)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b") \
        .mapInArrow(check, "a long, b long")


def close(n, m, similarity: float):
    """Whether texts of so many k-mers can reach the similarity."""
    return F.least(n, m) >= similarity * F.greatest(n, m)


def pair(x, y):
    return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")


def deltas(members: DataFrame, texts: DataFrame) -> DataFrame:
    """hub, rep, common (k-mers that both have), added (k-mers the hub lacks)."""
    def compare(batches):
        for b in batches:
            common, added, last, own = [], [], None, None
            for x, y in zip(b.column("text_h"), b.column("text_r")):
                x = x.as_py()
                if x != last:
                    last, own = x, labelled(x)
                k = labelled(y.as_py())
                new = k[~np.isin(k, own, assume_unique=True)]
                common.append(len(k) - len(new))
                added.append(new.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("hub"), b.column("rep"), pa.array(common, pa.int32()), pa.array(added, pa.list_(pa.int64()))],
                names=["hub", "rep", "common", "added"])

    h = texts.select(F.col("doc_id").alias("hub"), F.col("text").alias("text_h"))
    r = texts.select(F.col("doc_id").alias("rep"), F.col("text").alias("text_r"))
    return members.select("hub", "rep").join(r, "rep").join(h, "hub").select("hub", "rep", "text_h", "text_r") \
        .mapInArrow(compare, "hub long, rep long, common int, added array<long>")


def stray_pairs(groups: DataFrame, root: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) to verify besides those of the hubs.

    Members of the hub's class need no more links to one another.  A stray,
    a member outside it, must be held against all others, but most cannot
    reach the similarity: texts x and y have at most D = (1 - s) / (1 + s) *
    (|x| + |y|) k-mers that only one of them has.  Let x lack d and add e k-mers
    compared with the hub.  If x and y share no added k-mer, then they differ in
    at least d_x + e_x + |y| - |hub| k-mers.  So y either shares an added k-mer
    with the stray (an equality join, counted and held against the bound) or
    is near enough by these counts alone (a join on the counts).  Of added
    k-mers that a good part of a group has, all are taken to be shared, which
    keeps the bound a bound and their rows out of the join."""
    node = root.select(F.col("node").alias("rep"), F.col("root").alias("class"))
    of_hub = root.select(F.col("node").alias("hub"), F.col("root").alias("h_class"))
    own = groups.join(node.hint("shuffle_merge"), "rep", "left").join(of_hub.hint("shuffle_merge"), "hub", "left").select(
        "hub", "h_n", "rep", "n", F.coalesce("class", "rep").alias("class"), F.coalesce("h_class", "hub").alias("h_class")) \
        .withColumn("stray", F.col("class") != F.col("h_class"))
    mixed = own.groupBy("hub").agg(F.count(F.lit(1)).alias("size"), F.max("stray").alias("some")).where("some and size > 2").select("hub")
    own = written(own.where("rep != hub").join(mixed, "hub"), "near-mixed")
    seen = written(own.join(deltas(own, texts), ["hub", "rep"]).withColumns({
        "lacks": F.col("h_n") - F.col("common"), "differs": F.col("h_n") + F.col("n") - 2 * F.col("common")}), "near-deltas")
    limit = (1 - similarity) / (1 + similarity)
    added = seen.select("hub", "rep", F.explode("added").alias("kmer"))
    # k-mers that a good part of a group adds are what the hub lacks of their
    # common text; they are counted, not joined
    size = seen.groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    common = written(added.groupBy("hub", "kmer").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") >= FREQUENT)
                     .join(size, "hub").where(F.col("times") * PART >= F.col("size")).select("hub", "kmer"), "near-common")
    often = added.join(common, ["hub", "kmer"]).groupBy("hub", "rep").agg(F.count(F.lit(1)).alias("often"))
    known = written(seen.drop("added", "common").join(often, ["hub", "rep"], "left").fillna(0, ["often"]), "near-known")
    cols = ["rep", "n", "class", "stray", "lacks", "differs", "often"]
    x_cols = [F.col(c).alias(f"x_{c}") for c in cols]

    def within(shared):
        """Whether y and x can reach the similarity if they share so many rarer added k-mers."""
        least = F.col("differs") + F.col("x_differs") - 2 * F.least("lacks", "x_lacks") - 2 * F.least("often", "x_often") - 2 * shared
        return (least <= limit * (F.col("n") + F.col("x_n")) + 1e-9) & close("n", "x_n", similarity)

    apart = (F.col("class") != F.col("x_class")) & (~F.col("stray") | (F.col("x_rep") < F.col("rep")))
    rare = added.join(common, ["hub", "kmer"], "left_anti")
    own = rare.join(known, ["hub", "rep"])
    x = own.where("stray").select("hub", "kmer", *x_cols)
    both = own.join(x, ["hub", "kmer"]).where(apart) \
        .groupBy("hub", *cols, *[f"x_{c}" for c in cols]).agg(F.count(F.lit(1)).alias("shared")).where(within(F.col("shared")))
    # without a rarer one: kinds of members, few for each hub, are held against kinds of strays
    kind = ["n", "lacks", "differs", "often"]
    kinds = known.select("hub", *kind).distinct()
    most = F.floor((limit * F.col("n") + F.col("h_n") + 2 * F.col("often") - F.col("differs")) / (1 - limit) + 1e-9)
    low, high = F.ceil(similarity * F.col("n") - 1e-9), F.least(most, F.floor(F.col("n") / similarity + 1e-9))
    reach = known.where("stray").select("hub", "h_n", *kind).distinct().where(low <= high).select(
        "hub", F.explode(F.sequence(low.cast("int"), high.cast("int"))).alias("n"), *[F.col(c).alias(f"x_{c}") for c in kind])
    x = known.where("stray").select("hub", *x_cols)
    near = kinds.join(reach, ["hub", "n"]).where(within(F.lit(0))) \
        .join(x, ["hub", *[f"x_{c}" for c in kind]]).join(known, ["hub", *kind]).where(apart)
    return both.select(*pair("rep", "x_rep")).unionByName(near.select(*pair("rep", "x_rep"))).distinct()


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """node, root (the least node of its component) of every node with a link.

    Each round links a node's neighbours to their least one, and then its
    larger neighbours to it alone (large star, small star), until nothing
    changes; a star of any size is done in one round."""
    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    before = state(edges)
    for _ in range(rounds if before[0] else 1):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(small.where("u != v").distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))


def classified(docs: DataFrame, similarity: float, sketches: int, length: int) -> DataFrame:
    """doc_id, print, class (a number), class_id, copy_of for every row with a
    doc_id and a text.  Inside, a text goes by a number of its own (``rep``), as
    several texts can have one doc_id; ``print`` tells those apart."""
    prints = written(fingerprints(docs, sketches, length, similarity), "near-prints")
    # the keys of one representative stand for all its copies; the write keeps the numbers
    chosen = written(prints.groupBy("f1", "f2").agg(F.min(F.struct("doc_id", "print", "n", "keys")).alias("r"))
                     .select("f1", "f2", "r.doc_id", "r.print", "r.n", "r.keys").withColumn("rep", F.monotonically_increasing_id()),
                     "near-representatives")
    members = chosen.select("rep", "n", F.posexplode("keys").alias("band", "key")) \
        .withColumn("band", F.least("band", F.lit(sketches)))  # the least k-mers are one band
    counted = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = written(members.join(counted, ["band", "key"]), "near-shared")
    # the text that others of a family were made from shares most sketches
    # with most of them: the hub of a bucket is the member met most often
    met = shared.groupBy("rep").agg(F.sum("size").alias("met"))
    buckets = written(shared.join(met, "rep").select("band", "key", "rep", "n", "met"), "near-buckets")
    first = buckets.groupBy("band", "key").agg(F.max(F.struct("met", (-F.col("rep")).alias("least"), "rep", "n")).alias("hub"))
    # hub, h_n, rep, n: a group for each hub, of all that meet it in a bucket
    groups = written(buckets.join(first, ["band", "key"]).select(
        F.col("hub.rep").alias("hub"), F.col("hub.n").alias("h_n"), "rep", "n").distinct(), "near-groups")
    asked = groups.where("rep != hub").where(close("n", "h_n", similarity)).select(*pair("rep", "hub")).distinct()
    # tables of numbers are small as files and large in memory: none of these joins may broadcast by the file's size
    used = groups.select("rep").distinct().hint("shuffle_merge").join(chosen.select("rep", "doc_id", "print"), "rep")
    # the same join at every size: the texts move once
    texts = written(docs.withColumn("print", F.xxhash64("text")).join(used.hint("shuffle_merge"), ["doc_id", "print"])
                    .dropDuplicates(["doc_id", "print"]).select(F.col("rep").alias("doc_id"), "text"), "near-texts")
    links = written(verified(asked, texts, similarity), "near-links")
    root = components(links)
    more = written(stray_pairs(groups, root, texts, similarity).join(asked, ["a", "b"], "left_anti"), "near-pairs")
    found = written(verified(more, texts, similarity), "near-links")
    # a star for each class so far, and the new links
    root = components(root.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))

    of_rep = chosen.select("f1", "f2", "rep", F.col("doc_id").alias("copy_of")) \
        .join(root.hint("shuffle_merge"), F.col("rep") == F.col("node"), "left") \
        .select("f1", "f2", "copy_of", F.coalesce("root", "rep").alias("class"))
    least = of_rep.groupBy("class").agg(F.min("copy_of").alias("class_id"))
    named = of_rep.hint("shuffle_merge").join(least, "class")
    return prints.select("doc_id", "print", "f1", "f2").join(named.hint("shuffle_merge"), ["f1", "f2"]) \
        .select("doc_id", "print", "class", "class_id", "copy_of")


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, length: int = LENGTH) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), copy_of (least doc_id of
    the same words), one row for each input row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    alone = docs.where("doc_id is null or text is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"))
    return classified(docs, similarity, sketches, length).select("doc_id", "class_id", "copy_of").unionByName(alone)


def keep_first(docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, length: int = LENGTH) -> DataFrame:
    """One document of each class: that with the least doc_id, of several texts
    of this id that with the least hash, and one row of it, if it is repeated.
    Texts of one id in different classes are documents of their own.  Columns
    are unchanged; rows without a doc_id stay, of those without a text one an id."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    classes = classified(narrow, similarity, sketches, length)
    first = classes.where("doc_id = class_id").groupBy("class").agg(F.min(F.struct("doc_id", "print")).alias("f")) \
        .select(F.col("f.doc_id").alias("_id"), F.col("f.print").alias("_print"))
    end = "_" * max(len(c) for c in docs.columns)  # no column ends so
    plain = [f.name for f in docs.schema.fields if not isinstance(f.dataType, T.MapType)]
    own = docs.withColumn("row" + end, F.xxhash64(F.col("text").cast("string")))
    order = Window.partitionBy("doc_id", "row" + end).orderBy(F.xxhash64(*plain))
    kept = own.where("doc_id is not null and text is not null") \
        .join(first.toDF("id" + end, "print" + end).hint("shuffle_merge"), (F.col("doc_id").cast("long") == F.col("id" + end)) & (F.col("row" + end) == F.col("print" + end)), "left_semi") \
        .unionByName(own.where("doc_id is not null and text is null"))
    known = kept.withColumn("nth" + end, F.row_number().over(order)).where(F.col("nth" + end) == 1).select(docs.columns)
    return known.unionByName(docs.where("doc_id is null"))
