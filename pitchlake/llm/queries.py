"""Registered queries of the training-data operators and their DuckDB SQL.

Each applies its operator with production parameters to the whole table.
op2 is approximate, op1 and op10 are learned, op6 is defined by its sketches,
op7 and op11 need vocabularies, op8 compares all byte windows and op9 parses
markup: these have no SQL and are tested against brute force, round trips and
held-out labels instead.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchlake.llm import (
    alignment, ann, bpe, collocations, contamination, fingerprints, html, langid, near, preference, repeats, sharding,
    toxicity)
from pitchlake.llm.common import read

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the workers this package where they could not import it (as
    ``--py-files`` would)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    app = spark.sparkContext.applicationId
    if root not in known and app not in _shipped:
        path = os.path.join(tempfile.mkdtemp(), "pitchlake.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(os.path.join(root, "pitchlake")):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, root))
        spark.sparkContext.addPyFile(path)
        _shipped.add(app)
    return spark


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read(ship(spark), sf_dir, "documents"))


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(ship(spark), sf_dir, "embeddings"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.report(read(ship(spark), sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read(spark, sf_dir, "documents"), split_equal=True)


def op5_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    def mask(spans: str):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws("-", x["start"], x["end"])), ",")

    return preference.format_pairs(preference.stale_answer_pairs(read(spark, sf_dir, "conversations"))).select(
        "pair_id", "n_prompt_turns", "prompt", "chosen", "rejected",
        mask("chosen_spans").alias("chosen_mask"), mask("rejected_spans").alias("rejected_mask"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(read(ship(spark), sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(read(ship(spark), sf_dir, "documents"))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(read(ship(spark), sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(ship(spark), sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(ship(spark), sf_dir, "documents")
    model = toxicity.fit(docs, toxicity.severity_labels(read(spark, sf_dir, "labels")))
    return toxicity.predictions(docs, model)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.report(read(ship(spark), sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read(ship(spark), sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_langid, op2_ann, op3_decontaminate, op4_shard, op5_preference, op6_near_duplicates, op7_bpe, op8_repeats,
    op9_html, op10_toxicity, op11_alignment, op12_fingerprints, op13_collocations)}
ORACLE = {"op3_decontaminate": contamination.ORACLE, "op5_preference": preference.ORACLE,
          "op12_fingerprints": fingerprints.ORACLE, "op13_collocations": collocations.ORACLE}
