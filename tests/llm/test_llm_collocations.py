"""Phrase collocations against plain counting."""

import random
import re
import weakref
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitchlake.llm import collocations
from test_llm_brute_force import clashing

DOCS = "doc_id long, text string, lang string"


def plain(rows, least, longest=4, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, longest + 1):
                f[lang or "und"].update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, own in f.items():
        hidden = defaultdict(int)
        for p, a in own.items():
            if a >= least:
                for m in range(2, len(p)):
                    for i in range(len(p) - m + 1):
                        hidden[p[i:i + m]] = max(hidden[p[i:i + m]], a)
        best = []
        for p, a in own.items():
            if a < least or len(p) < 2 or 100 * hidden[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i + 1, b[2].decode(), -b[1], b[3], b[4], n[lang], -b[0]) for i, b in enumerate(sorted(best)[:top])]
    return sorted(out)


def texts(seed=3):
    rng = random.Random(seed)
    words = ["the", "Of", "straße", "a\x1cb", "x\x85y", "\x00", "é", "new", "york", "times", " ", "日本"]
    rows = []
    for i in range(150):
        t = ""
        for _ in range(rng.choice((0, 2, 30, 200))):
            t += rng.choice(words[:4] if rng.random() < .5 else words) + rng.choice((" ",) * 8 + ("  \t", ", ", ".", "\n", "\r\n", "! "))
            t += rng.choice(("",) * 6 + ("New York Times ", "of the new york "))
        rows.append((i, t, rng.choice(("en", "en", "de", None))))
    return rows + [(200, None, "en"), (201, "", None), (202, None, None), (203, " \t\n", "fr")] + rows[:3]


@pytest.mark.parametrize("words,phrases", [(collocations.WORDS, collocations.PHRASES), (5, 20)])
def test_mine(spark, words, phrases, monkeypatch):
    rows = texts()
    docs = clashing(spark.createDataFrame(rows, DOCS).repartition(3))
    want = plain([(t, lang) for _, t, lang in rows], 30)
    assert len({r[0] for r in want}) == 3 and {len(r[2].split(" ")) for r in want} >= {2, 3, 4}
    assert sorted(map(tuple, collocations.mine(docs, words=words, phrases=phrases).collect())) == want
    assert sorted(map(tuple, collocations.mine(docs, top=5, words=words, phrases=phrases).collect())) == [r for r in want if r[1] <= 5]


def test_segments_and_blocks_do_not_show(spark, monkeypatch):
    rows = texts(4)
    docs = spark.createDataFrame(rows, DOCS)
    want = plain([(t, lang) for _, t, lang in rows], 30)
    monkeypatch.setattr(collocations, "SEGMENT", 64)
    for t in [r[1] for r in rows if r[1]]:
        cut = [w for part in collocations.tokens(t) for w in part]
        monkeypatch.setattr(collocations, "SEGMENT", 1 << 22)
        assert cut == [w for part in collocations.tokens(t) for w in part]
        monkeypatch.setattr(collocations, "SEGMENT", 64)
    assert sorted(map(tuple, collocations.mine(docs).collect())) == want


def test_nothing_frequent_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "all different words here", "en")], DOCS)
    assert collocations.mine(docs).count() == 0 and collocations.mine(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(i, "once upon", "en") for i in range(30)], DOCS)
    assert [tuple(r) for r in collocations.mine(same).collect()] == [("en", 1, "once upon", 30, 30, 30, 60, 1_000_000)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4), st.integers(1, 40), st.integers(1, 300), st.integers(0, 10**6))
def test_trie_finds_exactly_its_phrases(depth, alphabet, n, seed):
    rng = np.random.default_rng(seed)
    phrases = np.unique(rng.integers(0, alphabet, (n, depth)).astype(np.int32) * 3, axis=0)
    rng.shuffle(phrases)
    ids = rng.integers(-1, alphabet * 3, 500).astype(np.int32)
    ids[::2] = ids[::2] // 3 * 3
    at = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    want = [at.get(tuple(ids[i:i + depth].tolist()), -1) for i in range(500)]
    assert collocations.Trie(phrases).accepting(ids).tolist() == want


def test_large_scores_stay_exact(spark):
    a, l, r = 9 * 10**15, 9 * 10**17, 8 * 10**18
    score = spark.sql(f"select (cast(2000000 as decimal(10,0)) * cast({a}L as decimal(20,0))) div "
                      f"(cast({l}L as decimal(20,0)) + cast({r}L as decimal(20,0))) s").first().s
    assert score == 2_000_000 * a // (l + r)


def test_tries_stay_small_where_words_have_many_successors():
    rng = np.random.default_rng(7)
    pairs = np.unique((3000 * rng.random((60_000, 2)) ** 3).astype(np.int32), axis=0)
    trie = collocations.Trie(pairs)
    assert len(trie.check) < 6 * len(pairs)
    assert sorted(trie.accepting(pairs.reshape(-1), np.arange(0, pairs.size, 2)).tolist()) == list(range(len(pairs)))


def test_parts_never_meet_in_memory_and_count_everything():
    alive, most = weakref.WeakSet(), []

    class Part:  # keeps its value as a broadcast does
        def __init__(self, phrases, names):
            self.made = phrases, names

        @property
        def value(self):
            if "_value" not in self.__dict__:
                self._value = collocations.Trie(self.made[0]), self.made[1]
                alive.add(self._value[0])
                most.append(len(alive))
            return self._value

    rng = np.random.default_rng(8)
    blocks = [rng.integers(-1, 12, 2000).astype(np.int32) for _ in range(3)]
    phrases = np.array([(a, b) for a in range(12) for b in range(12) if (a + b) % 3], dtype=np.int32)
    owner = collocations.part_of(phrases.reshape(-1), 2, 4)[::2]
    assert set(owner.tolist()) == {0, 1, 2, 3}
    tries = [(p, Part(phrases[owner == p], np.flatnonzero(owner == p).astype(np.int64))) for p in range(4)]
    got = Counter()
    for key, n in collocations.block_counts(blocks, tries, 4, 3, True):
        got.update(dict(zip(key.tolist(), n.tolist())))
    at = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    want = Counter()
    for ids in (b.tolist() for b in blocks):
        for i in range(len(ids) - 1):
            here, after = at.get(tuple(ids[i:i + 2])), at.get(tuple(ids[i + 1:i + 3]))
            if here is not None:
                want[here << 32 | collocations.NO_WORD] += 1
                if after is not None:
                    want[here << 32 | ids[i + 2]] += 1
    assert got == want and max(most) == 1 and len(most) == 4


def test_counts_leave_in_small_batches(monkeypatch):
    monkeypatch.setattr(collocations, "SENT", 50)
    key, n = np.arange(3000, dtype=np.int64) << 20, np.arange(3000, dtype=np.int64) % 400 + 1
    n[7] = 1 << 40
    found = {}
    for batch in collocations.dealt(key, n, 17):
        assert sum(len(k) for k in batch.column("keys").to_pylist()) <= 50 * 8
        for k, c in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
            found.update(zip(np.frombuffer(k, np.int64).tolist(), np.frombuffer(c, f"u{8 * len(c) // len(k)}").tolist()))
    assert found == dict(zip(key.tolist(), n.tolist()))


def test_parts_of_spark_and_numpy_agree(spark):
    rows = [([a, b, c],) for a in (0, 5, 2**31 - 1) for b in (1, 10**9) for c in (0, 77, 2**31 - 2)]
    df = spark.createDataFrame(rows, "words array<int>")
    got = {tuple(r.words): r.p for r in df.select("words", collocations.part_column(13).alias("p")).collect()}
    assert got == {tuple(w): int(collocations.part_of(np.array(w, dtype=np.int32), 3, 13)[0]) for w, in rows}
