"""Threshold-scaled document sketches (operator 12), DataFrame functions only.

A text's sketch is every hash of its five-word shingles below a fixed
fraction of the hash space (``FRACTION``), so its size follows the text's, the
sketch of a union is the union of sketches, and the share of a small text's
hashes that a much larger one holds estimates containment without bias.  A
text whose hashes all lie above the threshold keeps its least one, so that a
text with words never has an empty sketch.

Words are those of the other word operators: A-Z lower-cased, maximal runs of
0-9, a-z and every code point from U+0080 on.  A text of one to four words is
one shingle.  A hash is the first 16 hex digits of the shingle's MD5; a
fingerprint is the sorted distinct hashes, concatenated.

``report`` holds each text against an edited copy of itself and against the
next document, which it finds with one exchange: rows go to ranges of doc_id
whose upper ends are ids of the table (so the first row of a range, in
descending order, is known beforehand and is sent to the range above as well),
and a window reads the next row.

Null texts are empty; a text without words has the empty fingerprint, and two
empty fingerprints are alike by 1.0 (equal texts always are).  Documents follow
one another by descending doc_id, null last, then by descending MD5 of the
text; a single document is followed by itself.  Repeated rows are kept and
follow one another.  An empty table gives no rows; other columns are ignored.
doc_id is the key of ``documents``: rows that share one (or have none) are put
in order by one task, which spills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FRACTION = 1 / 8
SHINGLE = 5
DIGITS = 16
ROWS_PER_RANGE = 50_000
MAX_RANGES = 100_000
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def threshold(fraction: float = FRACTION) -> str:
    """The least hash that is not retained (sorts after every hash where all are)."""
    bound = int(fraction * 16**DIGITS)
    return "g" if bound >= 16**DIGITS else f"{bound:0{DIGITS}x}"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def sketch_of(words: Column, fraction: float = FRACTION) -> Column:
    """Sorted distinct retained hashes of a column of words."""
    bound = threshold(fraction)
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    hashes = F.when(F.size(words) > 0, F.transform(
        F.sequence(F.lit(1), last + 1),
        lambda i: F.substring(F.md5(F.array_join(F.slice(words, i, SHINGLE), " ").cast("binary")), 1, DIGITS)))
    # one pass: hashes above the bound count only where none is below it
    return F.coalesce(F.transform(F.array(hashes), lambda h: _retained(h, bound))[0], F.array().cast("array<string>"))


def _retained(hashes: Column, bound: str) -> Column:
    low = F.sort_array(F.array_distinct(F.filter(hashes, lambda x: x < F.lit(bound))))
    return F.when(F.exists(hashes, lambda x: x < F.lit(bound)), low) \
        .when(F.size(hashes) > 0, F.array(F.array_min(hashes)))


def jaccard(a: Column, b: Column) -> Column:
    """Estimated share of common shingles among all; 1.0 for two empty sketches."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` holds; 1.0 where a is empty."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def sketches(docs: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """doc_id, sketch of every whole text."""
    return docs.select("doc_id", words_of(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words")) \
        .select("doc_id", sketch_of(F.col("words"), fraction).alias("sketch"))


def merged(sketched: DataFrame, by: str, fraction: float = FRACTION) -> DataFrame:
    """``by``, hash: the sketch of the union of each group's texts, a row a
    hash (a group may be of any size).  What short texts keep above the
    threshold has no part in it, so that merged sketches compare without bias."""
    return sketched.select(by, F.explode("sketch").alias("hash")).where(F.col("hash") < threshold(fraction)).distinct()


def containments(small: DataFrame, large: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, n_a, n_common, containment for each row (a, b) of ``pairs``: the
    share of the merged sketch a of ``small`` that b of ``large`` holds.  Both
    are rows (key, hash); nothing is gathered a group.  Null where a has no hash."""
    wanted = pairs.select("a", "b").distinct()
    left = small.toDF("a", "hash").join(wanted.select("a").distinct(), "a")
    size = left.groupBy("a").agg(F.count("hash").alias("n_a"))
    common = left.join(wanted, "a").join(large.toDF("b", "hash"), ["b", "hash"]) \
        .groupBy("a", "b").agg(F.count("hash").alias("n_common"))
    n = F.coalesce("n_common", F.lit(0))
    return wanted.join(size, "a", "left").join(common, ["a", "b"], "left").select(
        "a", "b", F.coalesce("n_a", F.lit(0)).alias("n_a"), n.alias("n_common"),
        F.when(F.col("n_a") > 0, n / F.col("n_a")).alias("containment"))


def range_ends(rows: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> list[int]:
    """Ids of the table that cut it into ranges of about equal counts, the
    largest among them.  The driver sees one id a range, at most ``MAX_RANGES``;
    beyond that the ranges grow, and the tasks that order them spill."""
    n, top = rows.agg(F.count(F.lit(1)), F.max("at")).first()
    if not n:
        return []
    ranges = min(MAX_RANGES, max(4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // rows_per_range))
    found = rows.agg(F.percentile_approx("at", [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0]
    return sorted({*found, top})


def _below(ends: Column, n: int) -> Column:
    """Number of the ``n`` sorted ends below ``at``, by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda found, step: F.when(F.get(ends, found + step - 1) < F.col("at"), found + step).otherwise(found))


def followed(docs: DataFrame, ends: list[int]) -> DataFrame:
    """at, tie, doc_id, text, range, guest for every row, and the guests that a
    range needs to know what follows its last row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .select("doc_id", "text", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("at"),
                F.md5(F.col("text").cast("binary")).alias("tie"))
    known = F.split(F.lit(",".join(map(str, ends))), ",").cast("array<bigint>")  # one literal, folded once
    rows = rows.withColumn("range", _below(known, len(ends)))
    # the first row of a range, and after the last row of all the first one
    above = F.when(F.col("range") == len(ends) - 1, F.lit(0)).otherwise(F.col("range") + 1)
    own = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    to = F.when(F.get(known, F.col("range")) == F.col("at"), F.array(own, F.struct(above.alias("range"), F.lit(True).alias("guest")))) \
        .otherwise(F.array(own))
    return rows.select(*[c for c in rows.columns if c != "range"], F.inline(to))


def report(docs: DataFrame, fraction: float = FRACTION, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (Jaccard estimates), then contained_edited and
    contained_next (share of the document's sketch held by the other)."""
    ends = range_ends(docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("at")), rows_per_range)
    rows = followed(docs, ends or [0])
    order = Window.partitionBy("range").orderBy("guest", F.desc("at"), F.desc("tie"))
    n = F.char_length("text")
    swapped = F.floor(n / 2).cast("int")
    pairs = rows.withColumn("next_text", F.lead("text").over(order)) \
        .withColumn("words", words_of(F.col("text"))) \
        .withColumn("sketch", sketch_of(F.col("words"), fraction)) \
        .withColumn("next_sketch", F.lead("sketch").over(order)).where(~F.col("guest"))
    edited = F.concat(F.substring("text", F.lit(1), n - swapped), F.substring("next_text", F.lit(1), swapped))
    out = pairs.select("doc_id", n.cast("long").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited")) \
        .withColumn("edited_words", words_of(F.col("edited"))) \
        .withColumn("edited_sketch", sketch_of(F.col("edited_words"), fraction))
    mine, other, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return out.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join(mine, "").alias("fingerprint"), F.array_join(other, "").alias("edited_fingerprint"),
        jaccard(mine, other).alias("near_edited"), jaccard(mine, after).alias("near_next"),
        containment(mine, other).alias("contained_edited"), containment(mine, after).alias("contained_next"))


ORACLE = f"""
with d as (
  select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id desc nulls last, md5(coalesce(text, '')) desc) as r
  from documents),
e as (
  select a.doc_id, a.r, length(a.text) as n, a.text,
    substring(a.text, 1, length(a.text) - length(a.text) // 2) || substring(b.text, 1, length(a.text) // 2) as edited
  from d a join d b on b.r = case when a.r = (select max(r) from d) then 1 else a.r + 1 end),
w as (
  select doc_id, r, n, edited,
    regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD}') as own_words,
    regexp_extract_all(translate(edited, '{UPPER}', '{LOWER}'), '{WORD}') as edited_words
  from e),
h as (
  select *,
    [substring(md5(array_to_string(own_words[i:i + {SHINGLE - 1}], ' ')), 1, {DIGITS}) for i in range(1, greatest(len(own_words) - {SHINGLE}, 0) + 2) if len(own_words) > 0] as own_all,
    [substring(md5(array_to_string(edited_words[i:i + {SHINGLE - 1}], ' ')), 1, {DIGITS}) for i in range(1, greatest(len(edited_words) - {SHINGLE}, 0) + 2) if len(edited_words) > 0] as edited_all
  from w),
k as (
  select *,
    list_sort(list_distinct([x for x in own_all if x < '{threshold()}' or x = list_min(own_all)])) as s,
    list_sort(list_distinct([x for x in edited_all if x < '{threshold()}' or x = list_min(edited_all)])) as e
  from h),
t as (
  select k.doc_id, k.n, k.edited, k.s, k.e, x.s as f
  from k join k x on x.r = case when k.r = (select max(r) from k) then 1 else k.r + 1 end),
c as (select *, len(list_intersect(s, e)) as se, len(list_intersect(s, f)) as sf from t)
select doc_id, cast(n as bigint) as n_chars, sha256(edited) as edited_sha256,
  array_to_string(s, '') as fingerprint, array_to_string(e, '') as edited_fingerprint,
  case when len(s) + len(e) = 0 then 1.0::double else se::double / (len(s) + len(e) - se) end as near_edited,
  case when len(s) + len(f) = 0 then 1.0::double else sf::double / (len(s) + len(f) - sf) end as near_next,
  case when len(s) = 0 then 1.0::double else se::double / len(s) end as contained_edited,
  case when len(s) = 0 then 1.0::double else sf::double / len(s) end as contained_next
from c
"""
__all__ = ["containment", "containments", "jaccard", "merged", "report", "sketches"]
