"""Preference formatting (operator 5).

Input: one row per turn of either side of a pair (pair_id, side 'chosen' or
'rejected', turn, role, text).  The longest prefix of turns that both sides
share (same role and text, nulls alike) is rendered once as the prompt; the
rest of each side is its completion, rendered with the spans, in characters,
of what the model is to learn: the text and the end mark of assistant turns.
Prompt, role marks and turns of others are masked.

A pair is one training example, so its turns meet in one row;
:func:`segments` returns the same rendering as one row per turn, for
conversations that should not be gathered.

Null roles and texts render as empty; turns of the same number are in order of
role and text, nulls first, and null turn numbers come first; repeated rows are
turns of their own; a side without turns has an empty completion; pairs whose
sides are equal have two empty completions; texts of any length are rendered
whole; an empty table gives no pairs; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: marks of a rendered turn
OPEN, MIDDLE, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.coalesce(role, F.lit("")), F.lit(MIDDLE))


def body(text: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit(CLOSE))


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two arrays."""
    short = F.least(F.size(a), F.size(b))
    differs = F.array_position(F.zip_with(F.slice(a, F.lit(1), short), F.slice(b, F.lit(1), short),
                                          lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(short).cast("int")


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t["role"]), body(t["text"]))), "")


def learned_spans(turns: Column) -> Column:
    """[start, end) of the learned parts of the rendered turns."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("spans"))

    def add(acc: Column, t: Column) -> Column:
        start = acc["at"] + F.char_length(head(t["role"]))
        end = start + F.char_length(body(t["text"]))
        return F.struct(end.cast("long").alias("at"), F.when(
            t["role"].eqNullSafe(F.lit(LEARNED_ROLE)),
            F.concat(acc["spans"], F.array(F.struct(start.cast("long").alias("start"), end.cast("long").alias("end")))))
            .otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, empty, add, lambda acc: acc["spans"])


def format_pairs(turns: DataFrame) -> DataFrame:
    """pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans."""
    turns = turns.select("pair_id", "side", "turn", "role", "text")
    turn = F.struct("turn", "role", "text")

    def of(side: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, turn))),
                           lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))

    pairs = turns.groupBy("pair_id").agg(of("chosen").alias("c"), of("rejected").alias("r")) \
        .withColumn("n", common_turns(F.col("c"), F.col("r")))
    rest = {k: F.slice(k, F.col("n") + 1, F.size(k)) for k in ("c", "r")}
    return pairs.select(
        "pair_id", F.col("n").alias("n_prompt_turns"), rendered(F.slice("c", F.lit(1), F.col("n"))).alias("prompt"),
        rendered(rest["c"]).alias("chosen"), rendered(rest["r"]).alias("rejected"),
        learned_spans(rest["c"]).alias("chosen_spans"), learned_spans(rest["r"]).alias("rejected_spans"))


def segments(turns: DataFrame) -> DataFrame:
    """The same rendering as rows pair_id, part ('prompt', 'chosen',
    'rejected'), turn, masked, rendered; no conversation is gathered.  Turn
    numbers must be distinct within a side."""
    turns = turns.select("pair_id", "side", "turn", "role", "text")
    by_turn = turns.groupBy("pair_id", "turn").agg(
        *[F.max(F.when(F.col("side") == s, F.struct("role", "text"))).alias(s) for s in ("chosen", "rejected")])
    first = by_turn.groupBy("pair_id").agg(
        F.min(F.when(~F.col("chosen").eqNullSafe(F.col("rejected")), F.col("turn"))).alias("first"))
    part = F.when(F.col("first").isNull() | (F.col("turn") < F.col("first")), F.array(F.lit("prompt"))) \
        .otherwise(F.array(F.lit("chosen"), F.lit("rejected")))
    own = F.when(F.col("part") == "rejected", F.col("rejected")).otherwise(F.col("chosen"))
    return by_turn.join(first, "pair_id").withColumn("part", F.explode(part)).withColumn("own", own) \
        .where("own is not null").select(
            "pair_id", "part", "turn",
            ((F.col("part") == "prompt") | ~F.col("own.role").eqNullSafe(F.lit(LEARNED_ROLE))).alias("masked"),
            F.concat(head(F.col("own.role")), body(F.col("own.text"))).alias("rendered"))


def stale_answer_pairs(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: chosen is the conversation; rejected
    ends with its last assistant turn, in which the text is that of the assistant
    turn before it (empty where there is none).

    The last turn is the largest turn number that an assistant row has; all
    assistant rows of that number are replaced, and of several rows of the number
    before it the largest text is taken (null is the least).  Rejected leaves out
    rows without a turn number.  Conversations without a numbered assistant turn
    give no pair, nor do turns of a null conv_id, which belong to none; repeated
    rows are turns like others; an empty table gives no pairs; other columns are
    ignored.  A pair is one row: its turns meet, however long they are."""
    conversations = conversations.where("conv_id is not null").select("conv_id", "turn", "role", "text")
    own = F.col("role") == LEARNED_ROLE
    last = conversations.where(own).groupBy("conv_id").agg(F.max("turn").alias("last")).where("last is not null")
    with_last = conversations.join(last, "conv_id")
    stale = with_last.groupBy("conv_id").agg(F.max(F.when(own & (F.col("turn") < F.col("last")), F.struct("turn", "text"))).alias("stale"))
    rows = with_last.join(stale, "conv_id")
    replaced = own & (F.col("turn") == F.col("last"))
    return rows.select("conv_id", "turn", "role", "text", "last", "stale", F.explode(F.array(F.lit("chosen"), F.lit("rejected"))).alias("side")) \
        .where("side = 'chosen' or turn <= last") \
        .select(F.col("conv_id").alias("pair_id"), "side", "turn", "role",
                F.when((F.col("side") == "rejected") & replaced, F.coalesce("stale.text", F.lit("")))
                .otherwise(F.col("text")).alias("text"))


ORACLE = """
with a as (select conv_id, list({'t': turn, 'r': role, 'x': text} order by turn nulls first, role nulls first, text nulls first) c,
    max(case when role = 'assistant' then turn end) m from conversations where conv_id is not null group by 1),
s as (select conv_id, list_filter(c, lambda t: t.t <= m) c0, c, m,
    list_filter(c, lambda t: t.r = 'assistant' and t.t < m) old from a where m is not null),
p as (select conv_id, c, list_transform(c0, lambda t: case when t.t = m and t.r = 'assistant'
      then {'t': t.t, 'r': t.r, 'x': coalesce(case when len(old) > 0 then old[-1].x end, '')} else t end) r from s),
n as (select *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1),
      lambda i: c[i].r is distinct from r[i].r or c[i].x is distinct from r[i].x)) - 1, least(len(c), len(r))) n from p),
o as (select conv_id, n, c[1:n] p, c[n + 1:] c, r[n + 1:] r from n),
f as (select conv_id, n, list_transform(p, lambda t: '<|im_start|>' || coalesce(t.r, '') || chr(10) || coalesce(t.x, '') || '<|im_end|>' || chr(10)) p,
  list_transform(c, lambda t: '<|im_start|>' || coalesce(t.r, '') || chr(10) || coalesce(t.x, '') || '<|im_end|>' || chr(10)) c,
  list_transform(r, lambda t: '<|im_start|>' || coalesce(t.r, '') || chr(10) || coalesce(t.x, '') || '<|im_end|>' || chr(10)) r,
  c c_t, r r_t from o)
select conv_id pair_id, cast(n as integer) n_prompt_turns, array_to_string(p, '') prompt,
  array_to_string(c, '') chosen, array_to_string(r, '') rejected,
  array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: c_t[i].r = 'assistant'), lambda i: 
    cast(coalesce(list_sum(list_transform(c[1:i - 1], lambda z: length(z))), 0) + 13 + length(coalesce(c_t[i].r, '')) as bigint)::varchar || '-' ||
    cast(coalesce(list_sum(list_transform(c[1:i], lambda z: length(z))), 0) as bigint)::varchar), ',') chosen_mask,
  array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: r_t[i].r = 'assistant'), lambda i: 
    cast(coalesce(list_sum(list_transform(r[1:i - 1], lambda z: length(z))), 0) + 13 + length(coalesce(r_t[i].r, '')) as bigint)::varchar || '-' ||
    cast(coalesce(list_sum(list_transform(r[1:i], lambda z: length(z))), 0) as bigint)::varchar), ',') rejected_mask
from f
"""
