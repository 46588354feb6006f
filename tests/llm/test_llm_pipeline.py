"""The pipeline on a small corpus, stage by stage against plain versions."""

import hashlib
import random

import pytest
import public_tokenizers

from test_llm_brute_force import DOCS, languages, plain_classes, plain_words, prose

import corpus_pipeline
from pitchlake.llm import bpe


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    rows = [(d, t, lang, "s", len(t)) for d, t, lang in languages(rng, 160)]
    passage = prose(rng, 60)
    rows += [(500 + i, rows[i][1] + " " + passage, rows[i][2], None, 0) for i in range(5)]
    rows += [(600, rows[7][1], rows[7][2], "s", 0), (601, None, "en", "s", 0), (602, "12 34", "en", "s", 5), (603, "", None, None, 0)]
    leak = " ".join(rows[20][1].split(" ")[:12])
    folder = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, leak), (2, "never seen words")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, leak


def test_stages(spark, corpus):
    folder, rows, leak = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and "near_duplicates" in names
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder).persist()
        if k < 4:
            assert docs.columns == columns
            kept[name] = {r.doc_id: r.text for r in docs.collect()}
    assert {601, 602, 603}.isdisjoint(kept["language"]) and len(kept["language"]) >= len(rows) - 6
    classes = plain_classes(sorted(kept["language"].items()))
    assert set(kept["near_duplicates"]) == set(classes.values())
    before = {d: t.encode() for d, t in kept["near_duplicates"].items()}
    count = {}
    for b in before.values():
        for i in range(len(b) - 199):
            count[b[i:i + 200]] = count.get(b[i:i + 200], 0) + 1
    for d, b in before.items():
        gone = set()
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone.update(range(i, i + 200))
        assert kept["repeats"][d] == bytes(x for i, x in enumerate(b) if i not in gone).decode("utf-8", "ignore")
    assert any(kept["repeats"][d] != t for d, t in kept["near_duplicates"].items())
    leaked = " ".join(plain_words(leak))
    grams = [" ".join(leaked.split(" ")[i:i + 10]) for i in range(3)]
    dirty = {d for d, t in kept["repeats"].items() if any(f" {g} " in f" {' '.join(plain_words(t))} " for g in grams)}
    assert dirty and set(kept["decontamination"]) == set(kept["repeats"]) - dirty
    enc = bpe.encoder(public_tokenizers.path(bpe.RANKS))
    for r in docs.collect():
        ids = enc.encode_ordinary(kept["decontamination"][r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(kept["decontamination"][r.doc_id].encode()).hexdigest()


def test_run(spark, corpus):
    folder, rows, _ = corpus
    out = corpus_pipeline.run(spark, folder)
    assert 0 < out.count() < len(rows)


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


def test_stages_take_empty_tables_repeated_rows_and_clashing_columns(spark, corpus, tmp_path):
    from test_llm_brute_force import clashing

    folder, rows, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    # empty documents, empty benchmark
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    # every row twice under the same id, and once more with names that operators use inside
    twice = clashing(docs.unionByName(docs)).repartition(3)
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        twice = stage(spark, twice, folder)
        assert twice.columns == clashing(docs).columns, name
        kept[name] = [r.doc_id for r in twice.collect()]
    # copies are predicted alike, then one row of each class is left
    assert sorted(kept["language"]) == sorted(2 * list(set(kept["language"])))
    assert len(kept["near_duplicates"]) == len(set(kept["near_duplicates"]))
    assert sorted(kept["repeats"]) == sorted(kept["near_duplicates"])
    out = corpus_pipeline.STAGES[4][1](spark, twice, folder)
    assert sorted(r.doc_id for r in out.collect()) == sorted(kept["decontamination"])


def test_a_very_long_text_goes_through(spark, corpus, tmp_path):
    folder, rows, _ = corpus
    rng = random.Random(2)
    long = " ".join(t for _, t, _ in languages(rng, 1700) if t)
    spark.createDataFrame([r for r in rows[:60]] + [(9000, long, "en", "s", len(long))], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    enc = bpe.encoder(public_tokenizers.path(bpe.RANKS))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got[9000].ids == enc.encode_ordinary(long) and len(long) > 4 * bpe.CHUNK
