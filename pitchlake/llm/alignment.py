"""Cross-tokenizer alignment (operator 11), by galloping intersection.

Each text is encoded by tokenizer A (byte-level BPE, given a leading space) and
tokenizer B (sentence pieces, which adds that space itself).  The byte offsets
at which tokens end are two increasing lists.  The shorter one drives: every
end of it searches the longer list, from where it should lie by its rank, in
exponentially growing steps and then by bisection; all ends of a slice of
documents search at once in numpy.  The indices of common ends cut both token
lists into groups, and differences of their ranks give the group sizes, hence
the ranges of tokens that overlap.  Every A token of a group is linked with
every B token of it.

How many documents hold an id pair linked is counted over the corpus: pairs are
pre-aggregated in every task and summed on Spark.  There are at most as many
pairs as the product of the vocabularies; they go back to the documents in
parts by A id, each of at most ``PAIRS`` pairs (and one A id more), so a task
holds one bounded part at a time whatever the corpus.

Texts are encoded in pieces cut before every space that follows another
character: A's pattern never goes on into such a space, and B has no piece with
a space behind another character (checked when the model is loaded; else texts
stay whole).  Each worker encodes a piece once and remembers up to ``KNOWN`` of
them.  New pieces go to A joined by ``JOINED``, as a call costs more than a
piece, and its tokens are dealt out by their byte ends.

Texts that are null or empty, or whose joined token bytes differ from
space + text, have no tokens: zeros and ''.  Repeated rows are kept, and each
counts as a document.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache
from itertools import chain, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import written

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PAIRS = 4_000_000
SLICE = 1 << 21
LINKS = 1 << 22

KNOWN = 500_000
JOINED = 256

# Python's white space holds that of the tokenizers; a last space stays where it is, as B gives nothing for no text
SEAM = re.compile(r"(?<=\S) (?=[\s\S])")
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "pairs binary, times binary")


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: printable
    Latin-1 characters for themselves, the others counted up from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes and byte lengths of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = byte_of_char()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self.bytes_a[i] = bytes(value[c] for c in entry) if all(c in value for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)
        self.n_a, self.n_b = len(self.bytes_a), len(self.bytes_b)
        self.cuttable = not any("▁" in p.lstrip("▁") for p in pieces)
        # an id with the sign that follows it: in a list, after the last A id, after the last B id of a group
        n = max(self.n_a, self.n_b)
        self.width = n
        self.signed = [b"%d%s" % (i, s) for s in (b",", b"|", b";") for i in range(n)]

        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        # of the known pieces: ids of all one after another, where each starts, whether its bytes add up
        self.ids = [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)]
        self.start = [np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)]
        self.exact = np.zeros(0, dtype=bool)

    def pieces(self, text: str) -> list[str]:
        """Parts of a text; a space belongs before each but the first."""
        return SEAM.split(text) if self.cuttable else [text]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def joined_a(self, pieces: list[str], loose: int, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """A's ids of all pieces and where each piece's start, from pieces joined
        to texts; the ``loose`` last ones, which end in white space, go alone.
        None unless all bytes are as in ``raw`` and a token ends where a piece does."""
        solid = len(pieces) - loose
        texts = [" " + " ".join(pieces[i:min(i + JOINED, solid)]) for i in range(0, solid, JOINED)]
        ids = np.fromiter(chain.from_iterable(self.encode_a(texts + [" " + p for p in pieces[solid:]])), dtype=np.int64)
        length = self.length_a[ids]
        if not len(ids) or not length.all():
            return None
        at = np.cumsum(length)
        last = np.searchsorted(at, ends)
        if at[-1] != ends[-1] or (at[last] != ends).any() or b"".join(map(self.bytes_a.__getitem__, ids.tolist())) != raw:
            return None
        return ids, np.concatenate([[0], last + 1])

    def learn(self, pieces: list[str]) -> None:
        loose = [p for p in pieces if p[-1:].isspace()] if self.cuttable else pieces
        if self.cuttable and loose:
            pieces = [p for p in pieces if not p[-1:].isspace()] + loose
        raw = [b" " + p.encode() for p in pieces]
        whole = b"".join(raw)
        exact = np.ones(len(pieces), dtype=bool)
        width = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        for k, (value, length) in enumerate(((self.bytes_a, self.length_a), (self.bytes_b, self.length_b))):
            joined = self.joined_a(pieces, len(loose), whole, np.cumsum(width)) if k == 0 else None
            if joined is not None:
                ids, edge = joined
            else:
                found = self.encode_a([" " + p for p in pieces]) if k == 0 else self.b.encode(pieces, num_threads=1)
                ids = np.fromiter(chain.from_iterable(found), dtype=np.int64)
                edge = np.concatenate([[0], np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)))])
                total = np.concatenate([[0], np.cumsum(length[ids])])[edge]
                # every piece as long as its text and all bytes equal: so is each piece; else they are looked at one by one
                if (np.diff(total) != width).any() or b"".join(map(value.__getitem__, ids.tolist())) != whole:
                    exact &= [b"".join([value[x] for x in i]) == r for i, r in zip(found, raw)]
            self.start[k] = np.concatenate([self.start[k], self.start[k][-1] + edge[1:]])
            self.ids[k] = np.concatenate([self.ids[k], ids])
        self.exact = np.concatenate([self.exact, exact])
        self.known.update(zip(pieces, range(len(self.known), len(self.known) + len(pieces))))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A's ids of all texts, where each text's start, and the same for B;
        none for empty texts and for those whose joined bytes differ."""
        parts = [self.pieces(t) if t else [] for t in texts]
        flat = [p for ps in parts for p in ps]
        if len(self.known) > KNOWN:
            self.forget()
        piece = np.fromiter(map(self.known.get, flat, repeat(-1)), dtype=np.int64, count=len(flat))
        if len(new := np.flatnonzero(piece < 0)):
            missing = [flat[i] for i in new.tolist()]
            self.learn(list(dict.fromkeys(missing)))
            piece[new] = list(map(self.known.__getitem__, missing))
        doc = np.repeat(np.arange(len(texts)), [len(ps) for ps in parts])
        good = np.bincount(doc, weights=~self.exact[piece], minlength=len(texts)) == 0
        piece, doc = piece[good[doc]], doc[good[doc]]
        out = []
        for ids, start in zip(self.ids, self.start):
            n = start[piece + 1] - start[piece]
            end = np.cumsum(n)
            out.append(ids[np.repeat(start[piece] - (end - n), n) + np.arange(end[-1] if len(end) else 0)])
            out.append(np.concatenate([[0], np.cumsum(np.bincount(doc, weights=n, minlength=len(texts)).astype(np.int64))]))
        return tuple(out)


@lru_cache(maxsize=1)
def tokenizers_of(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def gallop(wanted: np.ndarray, ends: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For every wanted value the first index in [low, high) of ``ends`` that is
    no smaller (high if none): steps that double, away from the guess, until the
    place is bracketed, then bisection."""
    left, right = low - 1, high.copy()  # ends[left] < wanted <= ends[right]
    up = ends[guess] < wanted
    left[up], right[~up] = guess[up], guess[~up]
    for rising in (True, False):
        active, step = np.flatnonzero(up == rising), 1
        while len(active):
            if rising:
                p = left[active] + step
                inside = p < high[active]
                on = inside.copy()
                on[inside] = ends[p[inside]] < wanted[active[inside]]
                left[active[on]] = p[on]
                right[active[~on]] = np.minimum(p[~on], high[active[~on]])
            else:
                p = right[active] - step
                inside = p >= low[active]
                on = inside.copy()
                on[inside] = ends[p[inside]] >= wanted[active[inside]]
                right[active[on]] = p[on]
                left[active[~on]] = np.maximum(p[~on], low[active[~on]] - 1)
            active, step = active[on], 2 * step
    active = np.flatnonzero(right - left > 1)
    while len(active):
        mid = (left[active] + right[active]) >> 1
        less = ends[mid] < wanted[active]
        left[active[less]], right[active[~less]] = mid[less], mid[~less]
        active = active[right[active] - left[active] > 1]
    return right


def common_ends(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into both lists of the ends they share.  The lists hold those of
    many documents one after another (``first`` has where each starts, and the
    length at last), each document's beyond those of the one before."""
    n_a, n_b = np.diff(first_a), np.diff(first_b)
    found = []
    for own, other, first, first_other, n, n_other, drives in (
            (ends_a, ends_b, first_a, first_b, n_a, n_b, n_a <= n_b), (ends_b, ends_a, first_b, first_a, n_b, n_a, n_a > n_b)):
        docs = np.flatnonzero(drives & (n > 0))
        doc = np.repeat(docs, n[docs])
        rank = np.arange(len(doc)) - np.repeat(np.cumsum(n[docs]) - n[docs], n[docs])
        at = first[doc] + rank
        low, high = first_other[doc], first_other[doc + 1]
        place = gallop(own[at], other, low, high, low + rank * n_other[doc] // n[doc])
        hit = place < high
        hit[hit] = other[place[hit]] == own[at[hit]]
        found.append((at[hit], place[hit]))
    a = np.concatenate([found[0][0], found[1][1]])
    b = np.concatenate([found[0][1], found[1][0]])
    return np.sort(a), np.sort(b)  # matches are in the same order in both lists


def linked_pairs(ids_a, ids_b, after_a, after_b, doc, n_b: int):
    """(document, pair, times) of every linked id pair: the tokens of group g
    end before ``after[g]``, pairs are a * n_b + b."""
    start_a, start_b = np.concatenate([[0], after_a[:-1]]), np.concatenate([[0], after_b[:-1]])
    size_a, size_b = after_a - start_a, after_b - start_b
    links = size_a * size_b
    edge = np.searchsorted(np.cumsum(links), np.arange(LINKS, links.sum() + LINKS, LINKS), side="right")
    docs, pairs, times, at = [], [], [], 0
    for end in np.unique(np.append(edge, len(links))):
        if end <= at and end < len(links):
            end = at + 1  # a group beyond the bound goes alone
        if end <= at:
            continue
        g = np.arange(at, end)
        if len(g) == 1 and links[at] > LINKS:
            ua, ca = np.unique(ids_a[start_a[at]:after_a[at]], return_counts=True)
            ub, cb = np.unique(ids_b[start_b[at]:after_b[at]], return_counts=True)
            pairs.append((ua[:, None] * n_b + ub).ravel())
            times.append((ca[:, None] * cb).ravel())
            docs.append(np.full(len(pairs[-1]), doc[at]))
        else:
            own = np.repeat(g, links[g])
            r = np.arange(len(own)) - np.repeat(np.cumsum(links[g]) - links[g], links[g])
            wide = size_b[own]
            pair = ids_a[start_a[own] + r // wide] * n_b + ids_b[start_b[own] + r % wide]
            key, count = np.unique((doc[own] - doc[at]) * (1 << 40) + pair, return_counts=True)
            docs.append((key >> 40) + doc[at])
            pairs.append(key & ((1 << 40) - 1))
            times.append(count)
        at = end
    if not docs:
        return (np.zeros(0, dtype=np.int64),) * 3
    docs, pairs, times = np.concatenate(docs), np.concatenate(pairs), np.concatenate(times)
    order = np.lexsort((pairs, docs)) if at and len(edge) > 1 else np.arange(len(docs))
    docs, pairs, times = docs[order], pairs[order], times[order]
    new = np.flatnonzero(np.concatenate([[True], (docs[1:] != docs[:-1]) | (pairs[1:] != pairs[:-1])]))
    return docs[new], pairs[new], np.add.reduceat(times, new)


def packed(values: np.ndarray) -> bytes:
    """int32 where it holds the values, else int64."""
    return values.astype(np.int32 if not len(values) or values.max() < 1 << 31 else np.int64).tobytes()


def unpacked(raw, n: int | None = None) -> np.ndarray:
    """The values; ``n`` is how many there are, where their width is not known."""
    return np.frombuffer(raw, dtype=np.int64 if n and len(raw) == 8 * n else np.int32).astype(np.int64)


def align(texts: list[str | None], t: Tokenizers) -> dict[str, list]:
    """The columns of ``ALIGNED`` (but doc_id) for some texts."""
    ids_a, first_a, ids_b, first_b = t.encode([x or "" for x in texts])
    # both lists of a document add up to the same bytes, so that ends go on increasing from one to the next
    ends_a, ends_b = np.cumsum(t.length_a[ids_a]), np.cumsum(t.length_b[ids_b])
    at_a, at_b = common_ends(ends_a, first_a, ends_b, first_b)
    after_a, after_b = at_a + 1, at_b + 1
    doc = np.searchsorted(first_a, at_a, side="right") - 1
    groups = np.bincount(doc, minlength=len(texts))
    first_group = np.concatenate([[0], np.cumsum(groups)])
    links = np.diff(np.concatenate([[0], np.cumsum(np.diff(after_a, prepend=0) * np.diff(after_b, prepend=0))])[first_group])
    # ids in the order A group, B group, A group, ...
    sign_a, sign_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
    sign_a[at_a], sign_b[at_b] = 1, 2
    group_a = np.cumsum(sign_a == 1) - (sign_a == 1)
    group_b = np.cumsum(sign_b == 2) - (sign_b == 2)
    mixed = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    if len(mixed):
        mixed[np.arange(len(ids_a)) + np.concatenate([[0], after_b[:-1]])[group_a]] = ids_a + t.width * sign_a
        mixed[np.arange(len(ids_b)) + after_a[group_b]] = ids_b + t.width * sign_b
    first = (first_a + first_b).tolist()
    digests = [""] * len(texts)
    for i in np.flatnonzero(groups):
        signs = itemgetter(*mixed[first[i]:first[i + 1]].tolist())(t.signed)
        digests[i] = hashlib.sha256(b"".join(signs)[:-1]).hexdigest()
    docs, pairs, times = linked_pairs(ids_a, ids_b, after_a, after_b, doc, t.n_b)
    cut = np.searchsorted(docs, np.arange(len(texts) + 1))
    return {"n_a": np.diff(first_a), "n_b": np.diff(first_b), "n_groups": groups, "n_links": links,
            "groups_sha256": digests,
            "pairs": [packed(pairs[i:j]) if t.n_a * t.n_b < 1 << 31 else pairs[i:j].tobytes() for i, j in zip(cut, cut[1:])],
            "times": [packed(times[i:j]) for i, j in zip(cut, cut[1:])]}


def slices(batch: pa.RecordBatch, column: str, size: int):
    """Parts of a batch of about ``size`` bytes of a column; a larger row is one part."""
    width = np.array([len(x) if x is not None else 0 for x in (v.as_buffer() if v.is_valid else None for v in batch.column(column))])
    at, held = 0, 0
    for i, n in enumerate(width):
        if held and held + n > size:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += n
    if at < len(batch):
        yield batch.slice(at)


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and each linked id
    pair of the document with how often it occurs (pairs, times)."""
    path_a, path_b = path_a or public_tokenizers.path(MODEL_A), path_b or public_tokenizers.path(MODEL_B)
    types = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                       ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary())])

    def run(batches):
        t = tokenizers_of(path_a, path_b)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                out = align(part.column("text").to_pylist(), t)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(out[f.name], f.type) for f in types if f.name != "doc_id")], schema=types)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, ALIGNED)


def pair_width(path_a: str | None = None, path_b: str | None = None) -> tuple[int, type]:
    """B's vocabulary size and the type in which ``pairs`` are stored."""
    t = tokenizers_of(path_a or public_tokenizers.path(MODEL_A), path_b or public_tokenizers.path(MODEL_B))
    return t.n_b, np.int32 if t.n_a * t.n_b < 1 << 31 else np.int64


def pair_counts(rows: DataFrame, n_b: int, kind: type) -> DataFrame:
    """a, b, n: the documents that hold an id pair linked."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for raw in batch.column("pairs"):
                held.append(np.frombuffer(raw.as_buffer(), dtype=kind).copy())
                size += len(held[-1])
                if size >= LINKS:
                    yield counted(held)
                    held, size = [], 0
        if held:
            yield counted(held)

    def counted(held):
        pair, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], names=["pair", "n"])

    return rows.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")) \
        .select((F.floor(F.col("pair") / n_b)).cast("long").alias("a"), F.pmod("pair", F.lit(n_b)).alias("b"), "n")


def parts_of(counts: DataFrame, pairs: int = PAIRS) -> list[tuple[int, int]]:
    """Ranges [low, high) of A ids of at most ``pairs`` pairs, or one A id.  The
    driver sees one count an A id."""
    out, held, low, last = [], 0, None, None
    for r in counts.groupBy("a").count().orderBy("a").collect():
        if held and held + r["count"] > pairs:
            out.append((low, r["a"]))
            held = 0
        low = r["a"] if not held else low
        held, last = held + r["count"], r["a"]
    return [*out, (low, last + 1)] if held else out


def scored(rows: DataFrame, counts: DataFrame, low: int, high: int, n_b: int, kind: type) -> DataFrame:
    """row, n_best, count_sum from the links whose A id is in [low, high)."""
    spark = rows.sparkSession
    table = counts.where((F.col("a") >= low) & (F.col("a") < high)).toArrow()
    a, b, n = (table.column(c).to_numpy() for c in ("a", "b", "n"))
    order = np.lexsort((b, a))
    a, pair, n = a[order], (a * n_b + b)[order], n[order]
    most = np.zeros(high - low, dtype=np.int64)
    np.maximum.at(most, a - low, n)
    known = spark.sparkContext.broadcast((pair, n, n == most[a - low]))

    def run(batches):
        pair, n, best = known.value
        for batch in batches:
            for part in slices(batch, "pairs", 1 << 25):
                own = [np.frombuffer(x.as_buffer(), dtype=kind) for x in part.column("pairs")]
                size = np.array([len(x) for x in own])
                keys = np.concatenate(own).astype(np.int64)
                times = np.concatenate([unpacked(x.as_buffer(), k) for x, k in zip(part.column("times"), size)])
                at = np.minimum(np.searchsorted(pair, keys), len(pair) - 1)
                hit = pair[at] == keys
                edge = np.concatenate([[0], np.cumsum(size)])
                total = np.concatenate([[0], np.cumsum(np.where(hit, times * n[at], 0))])
                tops = np.concatenate([[0], np.cumsum(np.where(hit & best[at], times, 0))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(np.diff(tops[edge])), pa.array(np.diff(total[edge]))],
                    names=["row", "n_best", "count_sum"])

    return rows.select("row", "pairs", "times").mapInArrow(run, "row long, n_best long, count_sum long")


def report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, pairs: int = PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    n_b, kind = pair_width(path_a, path_b)
    rows = written(aligned(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(pair_counts(rows, n_b, kind), "pair-counts")
    sums = None
    for low, high in parts_of(counts, pairs):
        part = scored(rows, counts, low, high, n_b, kind)
        sums = part if sums is None else sums.unionByName(part)
    narrow = rows.drop("pairs", "times")
    if sums is None:
        out = narrow.select("*", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    else:
        out = narrow.join(sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")), "row")
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


__all__ = ["align", "aligned", "common_ends", "gallop", "pair_counts", "report"]
