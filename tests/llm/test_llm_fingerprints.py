"""Threshold-scaled sketches against a plain version."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pitchlake.llm import fingerprints
from test_llm_brute_force import clashing, plain_words, prose, small_docs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_sketch(text):
    w = plain_words(text)
    if not w:
        return set()
    h = {hashlib.md5(" ".join(w[i:i + 5]).encode()).hexdigest()[:16] for i in range(max(len(w) - 4, 1))}
    return {x for x in h if int(x, 16) < 2**61} or {min(h)}


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_report(rows):
    rows = sorted(((d, t or "") for d, t in rows),
                  key=lambda r: (-(1 << 63) if r[0] is None else r[0], hashlib.md5(r[1].encode()).hexdigest()), reverse=True)
    out = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        k = len(t) // 2
        edited = t[:len(t) - k] + after[:k]
        s, e, f = plain_sketch(t), plain_sketch(edited), plain_sketch(after)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(s)), "".join(sorted(e)),
                    like(s, e), like(s, f), len(s & e) / len(s) if s else 1.0, len(s & f) / len(s) if s else 1.0))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows_per_range", [50_000, 3])
def test_report(spark, rows_per_range):
    rows = small_docs()
    rows += [rows[2], rows[2], (None, "no id " + rows[3][1], "en", None, 0), (None, None, None, None, None),
             (7, "another text of one id", "en", "s", 3)]
    docs = clashing(spark.createDataFrame(rows, DOCS).repartition(3))
    got = fingerprints.report(docs, rows_per_range=rows_per_range)
    assert sorted(map(tuple, got.collect()), key=str) == plain_report([r[:2] for r in rows])


def test_single_and_no_document(spark):
    one = spark.createDataFrame([(4, "alpha beta gamma delta", "en", "s", 1)], DOCS)
    r = fingerprints.report(one).first()
    assert tuple(r) == plain_report([(4, "alpha beta gamma delta")])[0] and r.near_next == 1.0
    assert fingerprints.report(one.limit(0)).count() == 0


def test_no_python_and_one_exchange_of_texts(spark, tmp_path):
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(small_docs(), DOCS).write.parquet(path)
    plan = fingerprints.report(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SinglePartition" not in plan
    assert not re.search("Python|Pandas|Arrow", plan)


def test_merged_sketches_estimate_containment_between_unequal_groups(spark):
    import random

    rng = random.Random(3)
    parts = [prose(rng, 900) for _ in range(20)]
    rows = [(i, t, "en", "all", 0) for i, t in enumerate(parts)] + [(100, parts[4], "en", "one", 0),
            (101, prose(rng, 900), "en", "other", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    sets = fingerprints.merged(fingerprints.sketches(docs).join(docs.select("doc_id", "source"), "doc_id"), "source")
    union = set().union(*(plain_sketch(t) for t in parts))
    assert {r.hash for r in sets.where("source = 'all'").collect()} == union
    pairs = spark.createDataFrame([("one", "all"), ("other", "all"), ("all", "one"), ("none", "all")], "a string, b string")
    got = {(r.a, r.b): r for r in fingerprints.containments(sets, sets, pairs).collect()}
    assert got["one", "all"].containment == 1.0 and got["other", "all"].containment == 0.0
    assert abs(got["all", "one"].containment - 1 / 20) < 0.02
    assert got["none", "all"].containment is None and got["none", "all"].n_a == 0


def test_the_retained_share_is_the_fraction(spark):
    import random

    text = prose(random.Random(8), 20_000)
    n = fingerprints.sketches(spark.createDataFrame([(1, text)], "doc_id long, text string")).select(F.size("sketch")).first()[0]
    assert 0.11 < n / 20_000 < 0.14
