"""Byte-level BPE encoding and decoding (operator 7), by overlapping chunks.

A text of at most ``chunk`` characters is encoded where it is.  A longer one
is cut into chunks that overlap by ``overlap`` characters and are dealt out as
rows of their own.  Each chunk is pre-tokenised in parallel from its first
character, which may stand in the middle of a pre-token; its boundaries soon
agree with those of the chunk before it.  The first boundary that both chunks
have in their overlap is a stitch, for the pattern looks at nothing to the
left of a match, so both agree from there on.  The pieces between stitches are
then encoded in parallel.  Where an overlap holds no common boundary (a
pre-token longer than the overlap) its two chunks stay one piece.  Decoding
concatenates the raw bytes of the ids.

Null texts are empty texts; empty texts have no ids; repeated rows are kept;
a text without any boundary is one piece, whatever its length; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import written

CHUNK = 1 << 16
OVERLAP = 1 << 11
RANKS = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def encoder(ranks_path: str):
    """The tokenizer of a rank file, made once in each worker."""
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def pattern():
    return regex.compile(public_tokenizers.PATTERN)


def boundaries(text: str, start: int, low: int, high: int, last: bool) -> list[int]:
    """Ends of the pre-tokens of ``text`` (a chunk that starts at ``start`` of
    its document) that lie in [low, high).  A pre-token that touches the end
    of an unfinished chunk could go on, and is left out; so are ends after
    white space, whose match depends on what follows."""
    out = []
    for m in pattern().finditer(text):
        e = m.end()
        if start + e >= high or (e == len(text) and not last):
            break
        if start + e >= low and not text[e - 1].isspace():
            out.append(start + e)
    return out


def digest(ids: list[int]) -> str:
    return hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def decoded(ids: list[int], enc) -> bytes:
    """Raw bytes of the ids, concatenated."""
    return enc.decode_bytes(ids)


ENCODED = "doc_id long, ids array<int>"
REPORT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _with_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def chunks(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """row, k, n, start, part: the overlapping chunks of every text."""
    return rows.withColumn("n", F.ceil(F.char_length("text") / chunk).cast("int")) \
        .select("row", "text", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k")) \
        .select("row", "k", "n", (F.col("k") * chunk).alias("start"),
                F.expr(f"substring(text, k * {chunk} + 1, {chunk + overlap})").alias("part"))


def stitches(parts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """row, cuts: the sorted stitch positions of each text."""
    def pretokenise(batches):
        for b in batches:
            rows, seams, at = [], [], []
            for row, k, n, start, text in zip(*(b.column(c).to_pylist() for c in ("row", "k", "n", "start", "part"))):
                last = k == n - 1
                if k:
                    rows.append(row)
                    seams.append(k)
                    at.append(boundaries(text, start, start, start + overlap, last))
                if not last:
                    rows.append(row)
                    seams.append(k + 1)
                    at.append(boundaries(text, start, start + chunk, start + chunk + overlap, False))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows, pa.int64()), pa.array(seams, pa.int32()), pa.array(at, pa.list_(pa.int32()))],
                    names=["row", "seam", "at"])

    # a seam has the lists of two chunks, each at most ``overlap`` long; a
    # position that stands in both is common
    return parts.mapInArrow(pretokenise, "row long, seam int, at array<int>") \
        .select("row", "seam", F.explode("at").alias("at")).groupBy("row", "seam", "at").count().where("count = 2") \
        .groupBy("row", "seam").agg(F.min("at").alias("cut")) \
        .groupBy("row").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))


def encode(docs: DataFrame, ranks_path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids: the token ids of every whole text."""
    ranks_path = ranks_path or public_tokenizers.path(RANKS)
    docs = _with_text(docs)

    def whole(batches):
        enc = encoder(ranks_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([enc.encode_ordinary(t) for t in b.column("text").to_pylist()],
                                              pa.list_(pa.int32()))], names=["doc_id", "ids"])

    short = docs.where(F.char_length("text") <= chunk).mapInArrow(whole, ENCODED)
    return short.unionByName(joined(long_pieces(docs.where(F.char_length("text") > chunk), ranks_path, chunk, overlap)))


def joined(pieces: DataFrame) -> DataFrame:
    """doc_id, ids of each text from its pieces."""
    return pieces.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p")) \
        .select("doc_id", F.flatten(F.col("p.ids")).alias("ids"))


def long_pieces(docs: DataFrame, ranks_path: str, chunk: int, overlap: int) -> DataFrame:
    """row, doc_id, piece, ids for each piece of the long texts."""
    # written with their numbers: rows of one id and text stay apart, also where a lost task runs again
    rows = written(docs.withColumn("row", F.monotonically_increasing_id()), "long-texts")
    cuts = stitches(chunks(rows, chunk, overlap), chunk, overlap)
    cut = F.concat(F.array(F.lit(0)), F.coalesce("cuts", F.array().cast("array<int>")), F.array(F.char_length("text")))
    cut_rows = rows.join(cuts, "row", "left").select("row", "doc_id", "text", cut.alias("cut")) \
        .select("row", "doc_id", "text", "cut", F.posexplode(F.slice("cut", F.lit(1), F.size("cut") - 1)).alias("piece", "a")) \
        .select("row", "doc_id", "piece", F.expr("substring(text, a + 1, cut[piece + 1] - a)").alias("text"))

    def encode_pieces(batches):
        enc = encoder(ranks_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("piece"),
                 pa.array([enc.encode_ordinary(t) for t in b.column("text").to_pylist()], pa.list_(pa.int32()))],
                names=["row", "doc_id", "piece", "ids"])

    # the pieces of one text are dealt out again, so that a huge one is shared by many tasks
    return cut_rows.repartition("row", "piece").mapInArrow(encode_pieces, "row long, doc_id long, piece int, ids array<int>")


def report(docs: DataFrame, ranks_path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP,
           with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every whole text."""
    ranks_path = ranks_path or public_tokenizers.path(RANKS)
    docs = _with_text(docs)
    schema = REPORT + ", ids array<int>" * with_ids

    def rows(doc_ids, ids, enc):
        cols = {"doc_id": doc_ids, "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                "ids_sha256": pa.array([digest(i) for i in ids], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(decoded(i, enc)).hexdigest() for i in ids], pa.string())}
        if with_ids:
            cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    def whole(batches):
        enc = encoder(ranks_path)
        for b in batches:
            for s in (b.slice(i, 256) for i in range(0, len(b), 256)):
                yield rows(s.column("doc_id"), [enc.encode_ordinary(t) for t in s.column("text").to_pylist()], enc)

    def digested(batches):
        enc = encoder(ranks_path)
        for b in batches:
            for s in (b.slice(i, 1) for i in range(len(b))):
                yield rows(s.column("doc_id"), s.column("ids").to_pylist(), enc)

    short = docs.where(F.char_length("text") <= chunk).mapInArrow(whole, schema)
    long = joined(long_pieces(docs.where(F.char_length("text") > chunk), ranks_path, chunk, overlap)).mapInArrow(digested, schema)
    return short.unionByName(long)


def decode(encoded: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """doc_id, raw: the bytes that the ids stand for (null ids: empty)."""
    ranks_path = ranks_path or public_tokenizers.path(RANKS)

    def turn(batches):
        enc = encoder(ranks_path)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([decoded(i or [], enc) for i in b.column("ids").to_pylist()], pa.binary())],
                names=["doc_id", "raw"])

    return encoded.select("doc_id", "ids").mapInArrow(turn, "doc_id long, raw binary")


__all__ = ["boundaries", "decode", "encode", "report"]
