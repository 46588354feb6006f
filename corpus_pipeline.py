"""Corpus pipeline: documents to token ids in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``n_chars`` follows the text where a
stage changes it.

Null and empty texts, and texts without a letter, have no language: the first
stage rejects them, so no later one sees them, but where a later stage cuts a
text to nothing the empty text goes on.  Texts of any length are read whole.
Repeated rows are judged alike by the first stage and are one class of the
second, which leaves the row of the least doc_id and one of its copies; rows
without a doc_id are held against nothing and stay.  An empty table of
documents gives no rows, an empty benchmark rejects none.  Other columns are
carried up to the fourth stage, whatever their names; the last returns its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import bpe, contamination, langid, near, repeats
from pitchlake.llm.common import read, written
from pitchlake.llm.queries import ship


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, the least doc_id."""
    return near.keep_first(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings of 200 bytes that occur elsewhere are cut from the texts."""
    out = repeats.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return contamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return bpe.report(docs, with_ids=True)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", remove_repeats),
    ("decontamination", decontaminate),
    ("tokens", encode),
]

#: A learned classifier, sketches, byte windows and merge ranks are not SQL;
#: tests/llm checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(ship(spark), sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
